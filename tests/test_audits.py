import itertools

import pytest
from pyspark.sql import functions as F

from panelwave.operators import checks as ck
from panelwave.operators import compare, population, quality, sampling
from panelwave.operators.checks import Check
from panelwave.plans import household
from panelwave.plans.foundation import foundation
from panelwave.spec import Rule

RULES = (Rule("a", "x >= 15"), Rule("b", "y in (1, 2) and x < 90"), Rule("c", "z > 0"))


@pytest.fixture(scope="module")
def people(spark):
    rows = [(x, y, z) for x, y, z in itertools.product([None, 14, 15, 95], [None, 1, 3], [None, 0.0, 1.0])]
    return spark.createDataFrame(rows, "x int, y int, z double")


def test_funnel_equals_sequential_filters(people):
    current, want = people, []
    for i, rule in enumerate(RULES, 1):
        before = current.count()
        current = current.where(F.coalesce(F.expr(rule.condition), F.lit(False)))
        want.append((i, rule.name, before, before - current.count(), current.count()))
    got = population.funnel(people, RULES).orderBy("step").collect()
    assert [tuple(r) for r in got] == want
    assert population.eligible(people, RULES).count() == want[-1][-1]
    checked = population.chain_check(population.funnel(people, RULES)).collect()
    assert all(r.arithmetic_ok and r.chain_ok for r in checked)


def test_household_boundaries(spark):
    ok = dict(P02A03="15", OCUPADOS="1", P05C16="4", P05D01="1", P05C07A="14", P05C07B="11", P05H01A="168")
    cases = [
        ({}, None), ({"P02A03": "14.9"}, 1), ({"P02A03": None}, 1), ({"OCUPADOS": None}, 2), ({"P05C16": "5"}, 2),
        ({"P05D01": "0"}, 3), ({"P05C07B": "11.5"}, 4), ({"P05C07B": "12"}, 4), ({"P05C07A": "-1"}, 4),
        ({"P05C07A": "15", "P05C07B": "0"}, None), ({"P05C07A": "15", "P05C07B": "1"}, 5), ({"P05H01A": "0"}, 6), ({"P05H01A": "169"}, 6),
        ({"P05H01A": " N/A "}, 6), ({"P05D01": "1,234.5"}, None), ({"P05D01": "1,23"}, 3),
    ]
    rows = []
    for i, (change, _) in enumerate(cases):
        cell = {c: None for c in household.TYPES} | ok | {"NUM_HOGAR": "1", "NUM_PERSONA": str(i), "DOMINIO": "9", "P03A03A": "0"} | change
        rows.append(("f", "2025T1", 2025, 1, i, *[cell[c] for c in household.TYPES]))
    schema = "archivo_origen string, periodo_archivo string, anio_archivo int, trimestre_calendario int, fila_origen int, " + ", ".join(
        f"{c} string" for c in household.TYPES
    )
    stage = foundation(spark.createDataFrame(rows, schema), household.SPEC, household.PROVENANCE)
    fails = {r.fila_origen: r.f for r in stage.typed.select("fila_origen", population.first_failure(household.RULES).alias("f")).collect()}
    assert fails == {i: want for i, (_, want) in enumerate(cases)}
    eligible = stage.eligible
    assert {f.name: f.dataType.simpleString() for f in eligible.schema.fields} == household.ELIGIBLE_SCHEMA
    first = eligible.where("fila_origen = 0").first()
    assert (first.nivel_educativo, first.dominio, first.id_registro) == ("0", "DESCONOCIDO", "2025T1_1_0")
    assert ck.schema_check("s", eligible, household.ELIGIBLE_SCHEMA).first().passed


def test_missing_is_not_invalid(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("1.5",)], "a string")
    row = quality.missing_invalid(df, {"a": "int"}).first()
    assert (row.missing, row.invalid, row.missing_pct) == (1, 2, 25.0)


def test_empty_input_counts_zero(spark):
    empty = spark.createDataFrame([], "a string, k long")
    assert tuple(quality.missing_invalid(empty, {"a": "int"}).first())[1:4] == (0, 0, 0)
    assert tuple(quality.key_audit(empty, ["k"], ["a"]).first()) == (0, 0, 0, 0, 0, 0)
    assert [r.excluded for r in population.funnel(empty, [Rule("r", "a = '1'")]).collect()] == [0]
    assert quality.violation_counts(empty, {"v": "k > 1"}).first().rows == 0


def test_key_audit_with_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, "d")], "k int, v string")
    assert tuple(quality.key_audit(df, ["k"], ["v"]).first()) == (6, 2, 3, 3, 2, 2)
    assert tuple(quality.duplicate_versions(df, ["k"], ["v"]).first()) == (2, 1, 1)


def test_cross_period_keys_are_kept(spark):
    df = spark.createDataFrame([(1, "p"), (1, "q"), (2, "p"), (2, "p")], "k int, period string")
    assert tuple(quality.cross_period_keys(df, ["k"], "period").first()) == (4, 3, 1, 2, 1)


def test_value_counts_null_last(spark):
    df = spark.createDataFrame([(1,), (None,), (10,), (1,)], "a int")
    got = quality.order_value_counts(quality.value_counts(df, ["a"])).collect()
    assert [(r.value, r.n) for r in got] == [("1", 2), ("10", 1), ("NULO", 1)]


def test_comparisons_against_brute_force(spark):
    left = [(1, 1.0), (1, 2.0), (2, 5.0), (3, 1.0), (5, 4.0)]
    right = [(1, 1.0), (2, 5.0), (2, 5.5), (4, 9.0), (5, 4.0)]
    a, b = (spark.createDataFrame(x, "k int, v double") for x in (left, right))
    assert tuple(compare.coverage(a, b, "k", ["v"]).first()) == (1, 1, 2, 1)
    pairs = [abs(x - y) for k, x in left for j, y in right if k == j]
    got = compare.numeric_difference(a, b, "k", "v").first()
    assert got.max_abs_diff == max(pairs) and got.compared_keys == 3 and got.changed_keys == 2
    assert {r.k: r.rows for r in compare.orphans(a, b, "k").collect()} == {3: 1}
    assert {r.k for r in compare.overlap(a, b, "k").collect()} == {1, 2, 5}
    assert compare.members(a, b, "k").count() == 4


def test_hash_sample_is_the_true_top_n_on_any_layout(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    for method, seed in (("xxhash64", 3066), ("md5", None)):
        key = sampling._order_key(F.col("k"), seed, method)[0]
        want = [r.k for r in df.orderBy(key, "k").limit(50).collect()]
        for layout in (df, df.repartition(7)):
            got = sampling.sample_by_hash(layout, "k", 50, seed, method).collect()
            assert [r.k for r in got] == want
    assert sampling.sample_by_hash(df, "k", 5000).count() == 3000


def test_split_and_best_row(spark):
    df = spark.range(5000)
    share = sampling.hash_split(df, "id", 0.8).where("split = 'train'").count() / 5000
    assert abs(share - 0.8) < 0.03
    table = spark.createDataFrame([(2, 0.5), (3, 0.5000000001), (4, 0.2)], "k int, s double")
    assert sampling.best_row(table, F.round("s", 6).desc(), F.col("k")).first().k == 2


def test_checks_and_summary(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None)], "k int, v double")
    listed = [Check("nulls", "count_if(v is null)"), Check("dup", "count(*) - count(distinct k)", 0, "=", "warn"), Check("n", "count(*)", 2)]
    out = ck.run_checks("s", df, listed)
    assert {r.check: r.passed for r in out.collect()} == {"nulls": False, "dup": False, "n": True}
    assert tuple(ck.summary(out).first()) == ("s", 1, 1, 1, False)


def test_partition_checks_see_leaks(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None)], "id int, v double")
    b = spark.createDataFrame([(2, 1.0), (3, 1.0), (3, 1.0)], "id int, v double")
    got = {r.check: r.observed for r in ck.partition_checks("s", a, b, "id", ["v"]).collect()}
    assert got == {"train ids unique": 0, "test ids unique": 1, "no shared ids": 1, "no NULL in model columns": 1}
