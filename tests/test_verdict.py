"""Cases in which rows or values are missing, repeated or out of range."""

import random

from pyspark.sql import functions as F

from panelwave.functions.codes import code_order
from panelwave.operators.evaluate import error_table
from panelwave.operators.profile import numeric_summary
from panelwave.operators.quantiles import exact_quantiles, finer_bucket, magnitude_bucket
from panelwave.operators.sampling import sample_by_hash
from panelwave.operators.textaudit import claims
from panelwave.sources.manifest import fingerprint


def test_codes_sort_by_value(spark):
    codes = ["99999999999", "5", "99", "DESCONOCIDO", "100", None]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = [r["c"] for r in df.orderBy(code_order(F.col("c"))).collect()]
    assert got == ["5", "99", "100", "99999999999", "DESCONOCIDO", None]


def test_null_id_stays_in_samples(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    for method in ("md5", "xxhash64"):
        for seed in (None, 3):
            assert sample_by_hash(df, "id", 5, seed, method).count() == 3


def test_error_table_counts_known_predictions(spark):
    df = spark.createDataFrame([(10.0, 8.0, "a"), (10.0, None, None), (5.0, 4.0, "DESCONOCIDO")], "y double, p double, g string")
    rows = {(r["grouping"], r["label"]): r for r in error_table(df, "y", {"m": "p"}, ["g"]).collect()}
    assert rows["overall", "all"]["mae"] == 1.5 and rows["overall", "all"]["mean_prediction"] == 6.0
    assert len(rows) == 3 and rows["g", "DESCONOCIDO"]["rows"] == 2


def test_fingerprint_sees_moved_value(spark):
    a = spark.createDataFrame([(None, "x")], "a string, b string")
    b = spark.createDataFrame([("x", None)], "a string, b string")
    assert fingerprint(a).first() != fingerprint(b).first()


def test_summary_covers_finite_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    row = numeric_summary(df, ["v"]).first()
    assert (row["n"], row["min"], row["max"], row["mean"], row["p50"]) == (2, 1.0, 2.0, 1.5, 1.5)


def test_quantiles_of_a_narrow_range_part_into_buckets(spark):
    df = spark.range(200_000).select((F.lit(1.7e9) + F.col("id")).alias("v"))
    placed = df.groupBy(magnitude_bucket(F.col("v")), finer_bucket(F.col("v"))).count()
    assert placed.agg(F.max("count")).first()[0] == 1
    got = exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 1.0]).first()
    assert list(got)[1:] == [1.7e9 + q * 199_999 for q in (0.0, 0.25, 0.5, 1.0)]


def test_finer_buckets_rise_inside_a_bucket(spark):
    rng = random.Random(3)
    values = sorted({rng.choice((-1, 1)) * rng.uniform(1, 2) * 2.0 ** rng.choice((-1060, -3, 0, 30, 1000)) for _ in range(4000)} | {0.0, 8.0, 7.999999999999999})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    keys = [tuple(r) for r in df.orderBy("v").select(magnitude_bucket(F.col("v")), finer_bucket(F.col("v"))).collect()]
    assert keys == sorted(keys)


def test_text_with_very_many_claims(spark):
    text = "esto causa algo y " * 100_000 + "no causa. Todo el pais; causa"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string")
    found = claims(df, "id", "t")
    assert found.count() == 100_002
    assert found.where("start >= 1800000").count() == 2


def test_negator_inside_the_word_of_a_phrase(spark):
    df = spark.createDataFrame([(1, "lament"), (2, "la casa. ament"), (3, "xlament; ment la"), (4, "la ment")], "id int, t string")
    assert [(r.id, r.start) for r in claims(df, "id", "t", ["ment"], ["la"]).orderBy("id", "start").collect()] == [(2, 10), (3, 3), (3, 9)]
