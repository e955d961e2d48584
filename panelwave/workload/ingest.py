"""Scans, sinks, cleaning and typing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwave.functions import codes, numeric, text
from panelwave.operators import profile, quality
from panelwave.session import scratch_dir
from panelwave.sources import controls, files, layouts, ledger, manifest, sinks
from panelwave.workload.frames import OBS_SQL, normal_sql, typed_sql, obs, orders, table
from panelwave.workload.registry import query, rounded

# Text cells for every case of the cleaning rules; valid in both dialects.
DIRT = """CASE event_id % 18 WHEN 0 THEN ' N/A ' WHEN 1 THEN '1.0' WHEN 2 THEN '12.00' WHEN 3 THEN '1,234.5'
 WHEN 4 THEN '1,23' WHEN 5 THEN '-' WHEN 6 THEN '' WHEN 7 THEN '+infinity' WHEN 8 THEN 'NaN' WHEN 9 THEN '1.5'
 WHEN 10 THEN '3000000000' WHEN 11 THEN NULL WHEN 12 THEN '  77 ' WHEN 13 THEN '.5' WHEN 14 THEN '12,5'
 WHEN 15 THEN '1,234,567' WHEN 16 THEN concat(CAST(event_id AS STRING), '.0') ELSE CAST(user_id AS STRING) END"""
DIRT_SQL = f"dirt AS (SELECT event_id, {DIRT} AS raw FROM events)"
ODD_VALUE = """CASE event_id % 10 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN CAST('Infinity' AS DOUBLE)
 WHEN 2 THEN CAST('-Infinity' AS DOUBLE) WHEN 3 THEN NULL ELSE value END"""
FILE_NAME = """CASE event_id % 8 WHEN 0 THEN 'Personas_2025T1.xlsx' WHEN 1 THEN 'personas 2025 t2.csv'
 WHEN 2 THEN 'Base II 2025.xlsx' WHEN 3 THEN 'Personas 1er trimestre 2025.xlsx' WHEN 4 THEN 'datos.csv'
 WHEN 5 THEN 'Personas-2026-Q1.parquet' WHEN 6 THEN 'trimestre 3 2025'
 ELSE concat('wave_', CAST(2020 + event_id % 5 AS STRING), 'T', CAST(event_id % 4 + 1 AS STRING), '_', CAST(event_id AS STRING)) END"""
EXPECTED_PERIOD = """CASE event_id % 8 WHEN 0 THEN '2025T1' WHEN 1 THEN '2025T2' WHEN 2 THEN '2025T2' WHEN 3 THEN '2025T1'
 WHEN 4 THEN NULL WHEN 5 THEN '2026T1' WHEN 6 THEN '2025T3'
 ELSE concat(CAST(2020 + event_id % 5 AS STRING), 'T', CAST(event_id % 4 + 1 AS STRING)) END"""


def dirt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{DIRT} AS raw")


@query(f"WITH {DIRT_SQL} SELECT event_id, {normal_sql('raw')} AS clean FROM dirt")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirt(spark, sf_dir).select("event_id", text.normalize_cell(F.col("raw")).alias("clean"))


@query(f"""WITH {DIRT_SQL} SELECT event_id,
 CASE WHEN regexp_matches(replace(trim(raw), ',', '.'), '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$')
      THEN TRY_CAST(replace(trim(raw), ',', '.') AS DOUBLE) END AS number FROM dirt""")
def decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirt(spark, sf_dir).select("event_id", text.decimal_comma(F.col("raw")).alias("number"))


@query(f"""WITH {DIRT_SQL} SELECT event_id, CASE WHEN raw IS NULL OR trim(raw) = '' THEN 'DESCONOCIDO'
 ELSE regexp_replace(trim(raw), '[.]0$', '') END AS code FROM dirt""")
def clean_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirt(spark, sf_dir).select("event_id", text.clean_code(F.col("raw")).alias("code"))


@query(f"""WITH {DIRT_SQL}, norm AS (SELECT event_id, {normal_sql('raw')} AS c FROM dirt)
SELECT event_id, {typed_sql('c', 'int')} AS as_int, {typed_sql('c', 'bigint')} AS as_bigint,
 {typed_sql('c', 'double')} AS as_double FROM norm""")
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = dirt(spark, sf_dir).select("event_id", text.normalize_cell(F.col("raw")).alias("c"))
    wide = clean.select("event_id", *[F.col("c").alias(f"as_{t}") for t in ("int", "bigint", "double")])
    return quality.type_columns(wide, {"as_int": "int", "as_bigint": "bigint", "as_double": "double"}, ["event_id"])


@query(f"""WITH odd AS (SELECT event_id, {ODD_VALUE} AS v FROM events)
SELECT event_id, CASE WHEN isfinite(v) THEN v END AS finite FROM odd""")
def finite_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = table(spark, sf_dir, "events").selectExpr("event_id", f"{ODD_VALUE} AS v")
    return odd.select("event_id", numeric.finite_or_null(F.col("v")).alias("finite"))


@query("""WITH p AS (SELECT CAST(year(o_orderdate) AS VARCHAR) || 'T' || CAST(quarter(o_orderdate) AS VARCHAR) AS period,
 count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1)
SELECT period, round(f / CAST(n AS DOUBLE), 6) AS share, round(100.0 * f / CAST(n AS DOUBLE), 6) AS pct,
 round(100.0 * (n - f) / CAST(n AS DOUBLE), 6) AS reduction,
 (abs(n - f) <= 0.1 * greatest(1.0, n, f)) AS near FROM p""")
def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, f = F.col("n"), F.col("f")
    counted = orders(spark, sf_dir).groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f")
    )
    return rounded(
        counted.select(
            "period",
            numeric.ratio(f, n).alias("share"),
            numeric.percent(f, n).alias("pct"),
            numeric.relative_change(n, f).alias("reduction"),
            numeric.close_to(n.cast("double"), f.cast("double"), 0.1).alias("near"),
        ),
        6,
    )


@query(f"SELECT event_id, {EXPECTED_PERIOD} AS period FROM events")
def period_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "events").selectExpr("event_id", f"{FILE_NAME} AS name")
    return names.select("event_id", text.period_from_name(F.col("name")).alias("period"))


@query(f"""WITH f AS (SELECT {EXPECTED_PERIOD} AS period FROM events),
e AS (SELECT unnest(['2025T1', '2025T2', '2025T3', '2025T4', '2026T1']) AS period)
SELECT e.period, count(f.period) AS files,
 CASE WHEN count(f.period) = 0 THEN 'missing' WHEN count(f.period) > 1 THEN 'duplicate' ELSE 'found' END AS status
FROM e LEFT JOIN f ON e.period = f.period GROUP BY e.period""")
def period_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "events").selectExpr(f"{FILE_NAME} AS name")
    return files.period_status(names, ["2025T1", "2025T2", "2025T3", "2025T4", "2026T1"])


@query("SELECT c_custkey, c_mktsegment, c_nationkey FROM customer")
def select_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias(" c_nationkey"), "c_name", F.col("c_mktsegment").alias("c_mktsegment "), "c_custkey"
    )
    return files.select_by_name(wide, ["c_custkey", "c_mktsegment", "c_nationkey"])


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS "O_ORDERKEY", CAST(o_custkey AS VARCHAR) AS "O_CUSTKEY",
 o_orderstatus AS "O_ORDERSTATUS", o_orderpriority AS "O_ORDERPRIORITY" FROM orders""")
def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "orders_csv")
    table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" o_orderkey"), "o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("o_orderpriority ")
    ).write.csv(path, header=True)
    return files.scan_text_csv(spark, path)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS "C_CUSTKEY", CAST(c_nationkey AS VARCHAR) AS "C_NATIONKEY",
 c_mktsegment AS "C_MKTSEGMENT" FROM customer""")
def text_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = files.scan_text_parquet(spark, f"{sf_dir}/customer.parquet")
    return files.select_by_name(wide, ["C_CUSTKEY", "C_NATIONKEY", "C_MKTSEGMENT"])


@query("SELECT count(*) AS rows, true AS contiguous FROM orders")
def text_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "orders_rows")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").write.csv(path, header=True)
    scan = spark.read.csv(path, header=True).select("*", files.source_file_name().alias("source_file"), "_metadata")
    numbered = files.number_text_rows(scan)
    per_file = numbered.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.min("source_row").alias("lo"), F.max("source_row").alias("hi"),
        F.count_distinct("source_row").alias("d"),
    )
    whole = (F.col("lo") == 2) & (F.col("hi") == F.col("n") + 1) & (F.col("d") == F.col("n"))
    return per_file.agg(F.sum("n").alias("rows"), F.every(whole).alias("contiguous"))


@query("SELECT o_orderkey, 'orders.parquet' AS source_file, row_number() OVER (ORDER BY o_orderkey) + 1 AS source_row FROM orders")
def provenance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", files.source_file_name().alias("source_file"), files.parquet_row_number().alias("source_row")
    )


@query("""SELECT o_orderkey, 'orders.parquet' AS source_file, '2025T1' AS period, 2025 AS year, 1 AS quarter FROM orders""")
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = controls.small_table(
        spark,
        [("orders.parquet", "2025T1", 2025, 1), ("customer.parquet", "2025T2", 2025, 2)],
        "source_file string, period string, year int, quarter int",
    )
    scan = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", files.source_file_name().alias("source_file"))
    return files.with_provenance(scan, known).select("o_orderkey", "source_file", "period", "year", "quarter")


@query("""SELECT count(*) AS rows, count(*) FILTER (c_custkey % 10 < 3) AS blank_rows,
 count(*) FILTER (c_custkey % 10 >= 3) AS data_rows FROM customer""")
def blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.count_blank_rows(_with_blanks(spark, sf_dir))


@query("""SELECT CASE WHEN c_custkey % 10 >= 4 THEN c_name END AS name, c_mktsegment AS segment
FROM customer WHERE c_custkey % 10 >= 3""")
def drop_blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.drop_blank_rows(_with_blanks(spark, sf_dir))


def _with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_custkey % 10 >= 4 THEN c_name WHEN c_custkey % 10 = 1 THEN '  ' END AS name",
        "CASE WHEN c_custkey % 10 >= 3 THEN c_mktsegment WHEN c_custkey % 10 = 2 THEN '' END AS segment",
    )


@query("""SELECT o_orderkey, o_custkey, NULL AS o_orderstatus, o_totalprice FROM orders WHERE year(o_orderdate) < 1998
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, NULL FROM orders WHERE year(o_orderdate) >= 1998""")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    first = o.where(F.year("o_orderdate") < 1998).select("o_totalprice", "o_custkey", "o_orderkey")
    second = o.where(F.year("o_orderdate") >= 1998).select("o_orderkey", "o_orderstatus", "o_custkey")
    return files.union_by_name([first, second], allow_missing=True)


@query(f"WITH {OBS_SQL} SELECT id, period, target, qty FROM obs")
def write_read_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "periods")
    sinks.write_periods(obs(spark, sf_dir).select("id", "period", "target", "qty"), path, "period", "id")
    return sinks.read_stage(spark, path, "id", "period", "target", "qty")


@query(f"WITH {OBS_SQL} SELECT id, period, target FROM obs")
def consolidate_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "panel")
    sinks.write_sorted(obs(spark, sf_dir).select("id", "period", "target"), path, "period", "id")
    return sinks.read_stage(spark, path)


@query("SELECT count(*) AS written_rows, count(*) AS stored_rows, CAST(0 AS BIGINT) AS null_keys, true AS complete FROM orders")
def scored_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = orders(spark, sf_dir).select("o_orderkey", "period", "o_totalprice")
    return sinks.write_verified(scored, scratch_dir(spark, "scored"), ["o_orderkey"])


@query("""SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean,
 round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM orders GROUP BY 1""")
def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "report")
    report = profile.category_table(table(spark, sf_dir, "orders"), "o_orderstatus", "o_totalprice")
    sinks.write_report(report.drop("median"), path)
    back = spark.read.schema("o_orderstatus string, n long, mean double, pct double").json(path)
    return rounded(back, 4, ["mean"]).withColumn("pct", F.round("pct", 6))


@query("""SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus
 || '","o_orderpriority":"' || o_orderpriority || '"}' AS json FROM orders""")
def row_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return sinks.to_json_rows(o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || 'T' || CAST(quarter(o_orderdate) AS VARCHAR) AS period,
 o_totalprice FROM orders ORDER BY 2, 1 LIMIT 5""")
def first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.first_records(orders(spark, sf_dir).select("o_orderkey", "period", "o_totalprice"), 5, "period", "o_orderkey")


@query()
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.fingerprint(orders(spark, sf_dir), ["period"])


@query("""SELECT CAST(year(o_orderdate) AS VARCHAR) || 'T' || CAST(quarter(o_orderdate) AS VARCHAR) AS period, count(*) AS rows,
 true AS same_in_other_layout, true AS sees_one_lost_value FROM orders GROUP BY 1""")
def fingerprint_promises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every period, against other partitions and against one value made NULL."""
    now = orders(spark, sf_dir)
    last = now.groupBy("period").agg(F.max("o_orderkey").alias("_last"))
    price = F.when(F.col("o_orderkey") != F.col("_last"), F.col("o_totalprice"))
    changed = now.join(last, "period").withColumn("o_totalprice", price).select(*now.columns)
    moved = now.repartition(5, "o_custkey")
    marks = [
        manifest.fingerprint(df, ["period"]).withColumnsRenamed({"rows": f"rows_{name}", "fingerprint": name})
        for name, df in (("now", now), ("moved", moved), ("changed", changed))
    ]
    both = marks[0].join(marks[1], "period").join(marks[2], "period")
    return both.select(
        "period", F.col("rows_now").alias("rows"), (F.col("now") == F.col("moved")).alias("same_in_other_layout"),
        (F.col("now") != F.col("changed")).alias("sees_one_lost_value"),
    )


@query("""SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || 'T' || CAST(quarter(o_orderdate) AS VARCHAR) AS period
FROM orders WHERE year(o_orderdate) = 1999 AND quarter(o_orderdate) = 1 OR year(o_orderdate) = 1998 AND quarter(o_orderdate) = 2""")
def incremental_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier run saw other amounts in one period and did not see another one."""
    columns = ["o_orderkey", "o_totalprice", "period"]
    now = orders(spark, sf_dir).select(*columns)
    then = now.where(F.col("period") != "1999T1").withColumn(
        "o_totalprice", F.when(F.col("period") == "1998T2", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    path = scratch_dir(spark, "earlier")
    sinks.write_periods(then, path, "period", "o_orderkey")
    stored = sinks.read_stage(spark, path, "period").groupBy("period").agg(F.count(F.lit(1)).alias("rows"))
    recorded = manifest.manifest_rows(manifest.fingerprint(then, ["period"]), columns, stored)
    todo = manifest.worklist(manifest.fingerprint(now, ["period"]), recorded, columns)
    return todo.select("period")


@query("""SELECT CAST(year(o_orderdate) AS VARCHAR) AS period, year(o_orderdate) IN (1996, 1999) AS listed_again,
 count(*) AS selected_rows, count(*) FILTER (o_orderstatus = 'F') AS eligible_rows, true AS complete FROM orders GROUP BY 1, 2""")
def interrupted_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that dies in two periods between write and commit, the work list after it, and the run that resumes."""
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", "period"]
    table_ = orders(spark, sf_dir).withColumn("period", F.substring("period", 1, 4)).select(*columns)
    steps = {"selected": lambda part: part, "eligible": lambda part: part.where("o_orderstatus = 'F'")}
    store = ledger.PeriodStore(spark, scratch_dir(spark, "periods"), steps)

    def dies(period: str) -> None:
        if period in ("1996", "1999"):
            raise InterruptedError(period)

    try:
        store.run(table_, "period", columns, before_commit=dies)
    except ExceptionGroup as died:
        if died.split(InterruptedError)[1] is not None:
            raise
    inputs = manifest.fingerprint(table_, ["period"])
    todo = [r.period for r in store.worklist(inputs, columns).collect()]
    store.run(table_, "period", columns)
    counts = [store.read(name).groupBy("period").agg(F.count(F.lit(1)).alias(f"{name}_rows")) for name in steps]
    whole = store.complete().groupBy("period").agg(F.every("complete").alias("complete"))
    joined = counts[0].join(counts[1], "period", "left").join(whole, "period")
    return joined.select(
        "period", F.col("period").isin(todo).alias("listed_again"), "selected_rows",
        F.coalesce("eligible_rows", F.lit(0)).alias("eligible_rows"), "complete",
    )


@query("""SELECT [4, 7, 3][y % 3 + 1] AS width, [0, 1, 0][y % 3 + 1] AS blank, ['', 'o_clerk', ''][y % 3 + 1] AS duplicates,
 ['', '', 'o_orderstatus'][y % 3 + 1] AS missing, y % 3 < 2 AS usable, true AS has_files
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) GROUP BY ALL""")
def layout_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of the files of three layouts, against columns of which one layout lacks one."""
    found = layouts.headers(spark, _three_layouts(spark, sf_dir))
    report = layouts.layouts(found, ["o_orderkey", "o_custkey", "o_orderstatus"], ["o_orderpriority"])
    return report.select(
        "width", "blank", F.concat_ws(",", "duplicates").alias("duplicates"), F.concat_ws(",", "missing").alias("missing"),
        "usable", (F.size("files") > 0).alias("has_files"),
    )


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
 CASE WHEN year(o_orderdate) % 3 < 2 THEN o_orderstatus END AS o_orderstatus,
 CASE WHEN year(o_orderdate) % 3 < 2 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def layout_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of the three layouts in one scan: other places, a doubled unused column, two columns missing in some files."""
    folders = _three_layouts(spark, sf_dir)
    return layouts.scan_layouts(spark, folders, ["o_orderkey", "o_custkey"], ["o_orderstatus", "o_orderpriority"]).drop("source_file")


def _three_layouts(spark: SparkSession, sf_dir: str) -> list[str]:
    """Orders of every third year as text files: plain; wide with a doubled and a blank name; narrow."""
    path = scratch_dir(spark, "layouts")
    layout, price = F.year("o_orderdate") % 3, F.col("o_totalprice").cast("string")
    o = table(spark, sf_dir, "orders")
    o.where(layout == 0).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").write.csv(f"{path}/a", header=True)
    o.where(layout == 1).select(
        "o_orderpriority", F.lit("x").alias("o_clerk"), F.lit("n").alias(" "), F.col("o_custkey").alias(" o_custkey"),
        F.lit("y").alias("o_clerk "), F.col("o_orderstatus"), "o_orderkey",
    ).write.csv(f"{path}/b", header=True)
    o.where(layout == 2).select(price.alias("o_totalprice"), "o_orderkey", "o_custkey").write.csv(f"{path}/c", header=True)
    return [f"{path}/{k}" for k in "abc"]


@query("""SELECT o_orderkey, sha256(concat_ws('|', CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority)) AS fingerprint
FROM orders""")
def row_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.sha2(joined, 256).alias("fingerprint"))


@query()
def hash_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        codes.row_hash(F.col("o_orderkey"), seed=3066).alias("row_hash"),
        codes.row_fingerprint(["o_orderkey", "o_orderstatus"]).alias("fingerprint"),
    )


@query(f"""WITH {OBS_SQL} SELECT DISTINCT period, year FROM obs WHERE period IN ('1996T1', '1996T2', '1997T4')""")
def period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = obs(spark, sf_dir).select("period", "year")
    return panel.where(F.col("period").isin("1996T1", "1996T2", "1997T4")).distinct()


@query("""SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Empleado de gobierno'
 WHEN '2' THEN 'Empleado de empresa privada' WHEN '3' THEN 'Jornalero o peón' WHEN '4' THEN 'Servicio doméstico'
 ELSE 'DESCONOCIDO' END AS label FROM orders""")
def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelwave.plans.household import LABELS

    o = table(spark, sf_dir, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("code"))
    return controls.with_label(o, "code", LABELS["categoria_ocupacional"]).select("o_orderkey", "label")


@query("""SELECT 'categoria_ocupacional' AS variable, '5' AS code WHERE EXISTS
 (SELECT 1 FROM orders WHERE substr(o_orderpriority, 1, 1) = '5')""")
def label_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelwave.plans.household import LABELS

    used = table(spark, sf_dir, "orders").select(
        F.lit("categoria_ocupacional").alias("variable"), F.substring("o_orderpriority", 1, 1).alias("code")
    )
    return controls.label_coverage(used, controls.label_table(spark, LABELS))
