import pytest
from pyspark.sql import functions as F

from panelwave.session import scratch_dir
from panelwave.sources import controls, files, layouts, ledger, manifest, sinks
from panelwave.spec import Control


def test_range_round_trip(spark, tmp_path):
    path = str(tmp_path / "range")
    spark.range(10).selectExpr("id", "id * 2 as twice").write.parquet(path)
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == 45


def test_scratch_dir_is_below_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_header_rules(spark):
    assert files.header_report(["a", " b ", "", "a", None, " "]) == {"width": 4, "blank": 1, "duplicates": ["a"]}
    df = spark.createDataFrame([(1, 2, 3)], "`a ` int, b int, c int")
    assert files.select_by_name(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError, match="missing"):
        files.select_by_name(df, ["z"])
    with pytest.raises(ValueError, match="more than once"):
        files.select_by_name(spark.createDataFrame([(1, 2)], "`a ` int, a int"), ["a"])


def test_text_row_numbers_follow_the_file(spark, tmp_path):
    for name, n in (("one.csv", 3000), ("two.csv", 5)):
        (tmp_path / name).write_text("k,v\n" + "".join(f"{i},{'x' * 40}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        plain = spark.read.csv(str(tmp_path), header=True)
        for scan in (plain, plain.select("*", "_metadata")):
            assert scan.rdd.getNumPartitions() > 3
            for blocks in (files.INDEX_BLOCKS, 3):
                got = files.number_text_rows(scan, index_blocks=blocks).select("k", "source_row").collect()
                assert len(got) == 3005 and all(int(r.k) + 2 == r.source_row for r in got)
        groups = files.file_groups(plain, 3)
        assert [len(g) for g in groups] == [1, 1]
        first = plain.where(F.col("_metadata.file_path").isin(groups[0]))
        assert first.rdd.getNumPartitions() < plain.rdd.getNumPartitions()  # the other files are not opened
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_text_rows_are_not_moved_to_be_numbered(spark, tmp_path):
    (tmp_path / "one.csv").write_text("k,v\n1,2\n")
    numbered = files.number_text_rows(spark.read.csv(str(tmp_path), header=True))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = numbered._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    rows = [line for line in plan.splitlines() if "Subquery" not in line and not line.strip().startswith((":", "|"))]
    assert not any("Join" in line or "Exchange" in line for line in rows)


def test_number_text_rows_of_no_rows(spark, tmp_path):
    (tmp_path / "one.csv").write_text("k,v\n")
    assert files.number_text_rows(spark.read.csv(str(tmp_path), header=True)).count() == 0


def test_layouts_are_grouped_and_read_by_name(spark, tmp_path):
    files_ = {
        "a1.csv": "k, v ,w\n1,x,p\n", "a2.csv": "k, v ,w\n2,y,q\n", "b.csv": "\ufeffw,\"z,z\",k,,z,z,,\nr,0,3,,5,6,,\n",
        "c.csv": "v,k\n", "empty.csv": "",
    }
    for name, text in files_.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    found = layouts.headers(spark, str(tmp_path))
    assert {r.file.rsplit("/")[-1]: r.names for r in found.collect()} == {
        "a1.csv": ["k", "v", "w"], "a2.csv": ["k", "v", "w"], "b.csv": ["w", "z,z", "k", "", "z", "z"], "c.csv": ["v", "k"],
    }
    report = {r.width: r for r in layouts.layouts(found, ["k"], ["z"]).collect()}
    assert (report[6].blank, report[6].duplicates, report[6].doubled, report[6].usable) == (1, ["z"], ["z"], False)
    assert (len(report[3].files), report[3].usable, report[2].missing) == (2, True, [])
    with pytest.raises(ValueError, match="more than once: \\['z'\\]"):
        layouts.scan_layouts(spark, str(tmp_path), ["k"], ["z"])
    with pytest.raises(ValueError, match="missing: \\['w'\\]"):
        layouts.scan_layouts(spark, str(tmp_path), ["w"])
    got = layouts.scan_layouts(spark, str(tmp_path), ["k"], ["v", "w"])
    assert sorted(map(tuple, got.collect())) == [("1", "x", "p", "a1.csv"), ("2", "y", "q", "a2.csv"), ("3", None, "r", "b.csv")]


def test_only_committed_periods_count(spark, tmp_path):
    rows = [(p, k, k % 3) for p in ("a", "b", "c") for k in range(6)]
    table = spark.createDataFrame(rows, "period string, k int, v int")
    steps = {"all": lambda part: part, "some": lambda part: part.where("v = 7")}
    store = ledger.PeriodStore(spark, str(tmp_path / "store"), steps)
    todo = lambda t=table, c=("k", "v"), **o: sorted(r.period for r in store.worklist(manifest.fingerprint(t, ["period"]), c, **o).collect())
    assert todo() == ["a", "b", "c"]

    def dies(period):
        if period == "b":
            raise InterruptedError

    with pytest.raises(ExceptionGroup):
        store.run(table, "period", ["k", "v"], before_commit=dies)
    assert todo() == ["b"] and sorted({r.period for r in store.read("all").collect()}) == ["a", "c"]
    assert store.run(table, "period", ["k", "v"]) == ["b"] and todo() == []
    assert store.read("all").count() == 18 and store.read("some").count() == 0
    assert store.differences("all").count() == 0
    assert todo(c=("k",)) == ["a", "b", "c"] and todo(force=True, only=["a"]) == ["a"]
    changed = table.withColumn("v", F.when(F.col("period") == "c", F.lit(7)).otherwise(F.col("v")))
    assert todo(changed) == ["c"] and store.run(changed, "period", ["k", "v"]) == ["c"]
    assert store.read("some").count() == 6 and store.read("all").count() == 18
    # A lost file of a committed attempt brings the period back.
    attempt = next(r.attempt for r in store.manifest().collect() if (r.period, r.output) == ("a", "all"))
    spark.createDataFrame([(1, 1)], "k int, v int").limit(0).write.mode("overwrite").parquet(f"{store.root}/all/period=a/attempt={attempt}")
    spark.catalog.refreshByPath(f"{store.root}/all")
    assert todo(changed) == ["a"]


def test_blank_rows(spark):
    df = spark.createDataFrame([("a", None), (" ", ""), (None, None), ("", "b")], "x string, y string")
    assert tuple(files.count_blank_rows(df).first()) == (4, 2, 2)
    assert files.drop_blank_rows(df).count() == 2


def test_discover_periods(spark, tmp_path):
    for name in ("Personas_2025T1.csv", "sub/personas 2025 t2.csv", "Base II 2025.csv", "notes.csv"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("x")
    got = {r.period: r.status for r in files.discover_periods(spark, str(tmp_path), ["2025T1", "2025T2", "2025T3"]).collect()}
    assert got == {"2025T1": "found", "2025T2": "duplicate", "2025T3": "missing"}


def test_write_periods_replaces_only_its_periods(spark, tmp_path):
    path = str(tmp_path / "panel")
    first = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1)], "period string, row int")
    sinks.write_periods(first, path, "period", "row")
    sinks.write_periods(spark.createDataFrame([("b", 9)], "period string, row int"), path, "period", "row")
    got = {(r.period, r.row) for r in sinks.read_stage(spark, path, "period", "row").collect()}
    assert got == {("a", 1), ("b", 9)}


def test_write_sorted_file_order_is_row_order(spark, tmp_path):
    path = str(tmp_path / "sorted")
    df = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("k"))
    sinks.write_sorted(df, path, "k")
    parts = spark.read.parquet(path).select("k", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()
    assert [r.k for r in parts] == list(range(2000))


def test_fingerprint_ignores_layout_but_not_content(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    same = manifest.fingerprint(df.repartition(3).select("v", "k")).first().fingerprint
    base = manifest.fingerprint(df).first().fingerprint
    assert base == same
    assert manifest.fingerprint(df.distinct()).first().fingerprint != base
    assert manifest.fingerprint(df.withColumn("v", F.lit("a"))).first().fingerprint != base


def test_worklist(spark):
    inputs = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")], "period string, fingerprint string")
    known = spark.createDataFrame(
        [("a", "1", "x,y", True), ("b", "old", "x,y", True), ("c", "3", "x", True), ("d", "4", "x,y", False)],
        "period string, fingerprint string, columns string, complete boolean",
    )
    todo = lambda **o: sorted(r.period for r in manifest.worklist(inputs, known, ["x", "y"], **o).collect())
    assert todo() == ["b", "c", "d"]
    assert todo(force=True) == ["a", "b", "c", "d"]
    assert todo(only=["a", "b"]) == ["b"]


def test_labels_and_controls(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "code string")
    got = [r.label for r in controls.with_label(df, "code", {"1": "uno"}).collect()]
    assert sorted(got) == ["DESCONOCIDO", "DESCONOCIDO", "uno"]
    assert controls.control_table(spark, [Control("n", ("p", "q"), 3)]).count() == 2
