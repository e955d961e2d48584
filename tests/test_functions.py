import pytest
from pyspark.sql import functions as F

from panelwave.functions import codes, numeric, text

CELLS = [
    ("1.0", "1"), ("12.00", "12"), ("1,234.5", "1234.5"), ("1,234,567", "1234567"), ("1,23", "1,23"),
    (" N/A ", None), ("-", None), (".", None), ("-inf", None), ("", None), ("  ", None), ("NaN", None), ("None", None),
    ("+infinity", "+infinity"), ("\t7\n", "7"), ("\u00a08\u2003", "8"), ("1.50", "1.50"), ("+5.0", "+5"), ("abc", "abc"),
    ("1,234.0", "1234"), ("12\n", "12"), (None, None), ("1.2.0", "1.2.0"), ("0", "0"), ("#N/A", None),
]


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()[0]


def test_normalize_cell(spark):
    rows = spark.createDataFrame(CELLS, "x string, want string").select("x", "want", text.normalize_cell(F.col("x")).alias("got"))
    assert [r for r in rows.collect() if r.want != r.got] == []


@pytest.mark.parametrize(
    "value, kind, want",
    [
        ("1.5", "int", None), ("3000000000", "int", None), ("3000000000", "bigint", 3000000000), ("12.00", "int", 12),
        ("1e3", "int", 1000), ("inf", "int", None), ("NaN", "bigint", None), ("+infinity", "double", None), ("abc", "double", None),
        ("-2.5", "double", -2.5), (None, "int", None), ("0", "int", 0), ("-7", "bigint", -7),
    ],
)
def test_typed(spark, value, kind, want):
    assert one(spark, lambda c: numeric.typed(c, kind), value) == want


@pytest.mark.parametrize("value, want", [("12,5", 12.5), (".5", 0.5), ("5.", 5.0), (" 7 ", 7.0), ("1,2,3", None), ("x", None), ("42", 42.0)])
def test_decimal_comma(spark, value, want):
    assert one(spark, text.decimal_comma, value) == want


@pytest.mark.parametrize("value, want", [("1.0", "1"), ("10", "10"), ("  ", "DESCONOCIDO"), (None, "DESCONOCIDO"), ("0", "0"), ("1.00", "1.00")])
def test_clean_code(spark, value, want):
    assert one(spark, text.clean_code, value) == want


@pytest.mark.parametrize(
    "name, want",
    [
        ("Personas_2025T1.xlsx", "2025T1"), ("personas 2025 t2.csv", "2025T2"), ("Personas I 2025.xlsx", "2025T1"),
        ("Base IV-2025.xlsx", "2025T4"), ("Personas 1er trimestre 2025.xlsx", "2025T1"), ("trimestre 3 2026", "2026T3"),
        ("Personas 2025.xlsx", None), ("readme.txt", None), ("Q2-2026.parquet", "2026T2"),
    ],
)
def test_period_from_name(spark, name, want):
    assert one(spark, text.period_from_name, name) == want


def test_finite_or_null(spark):
    rows = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1.5,), (None,)], "x double")
    assert [r[0] for r in rows.select(numeric.finite_or_null(F.col("x"))).collect()] == [None, None, None, 1.5, None]


def test_labels_ids_and_bands(spark):
    df = spark.createDataFrame([(0, 10.0), (99, 20.0), (None, 40.0), (7, None)], "c int, v double")
    got = df.select(
        codes.code_label(F.col("c"), range(8)).alias("label"),
        codes.band(F.col("v"), F.array(F.lit(10.0), F.lit(20.0), F.lit(40.0)), ["P25", "P50", "P95"]).alias("band"),
        codes.record_id(F.lit("p"), F.col("c"), F.lit(2)).alias("id"),
    ).collect()
    assert [r.label for r in got] == ["0", "DESCONOCIDO", "DESCONOCIDO", "7"]
    assert [r.band for r in got] == ["P25-P50", "P50-P95", ">=P95", None]
    assert [r.id for r in got] == ["p_0_2", "p_99_2", None, "p_7_2"]


def test_arithmetic_never_raises(spark):
    got = spark.range(1).select(
        numeric.ratio(F.lit(1.0), F.lit(0.0)).alias("a"),
        numeric.percent(F.lit(1), F.lit(4)).alias("b"),
        numeric.relative_change(F.lit(4.0), F.lit(3.0)).alias("c"),
        numeric.positive_log(F.lit(0.0)).alias("d"),
        numeric.close_to(F.lit(1e9), F.lit(1e9 + 1)).alias("e"),
    ).first()
    assert tuple(got) == (None, 25.0, 25.0, None, True)


def test_raw_text_of_typed_columns(spark):
    df = spark.createDataFrame([(True, 3.0, 2.5, float("nan"), 7)], "` a ` boolean, b double, c double, d double, e int")
    got = text.as_raw_text(df)
    assert got.columns == ["A", "B", "C", "D", "E"]
    assert tuple(got.first()) == ("1", "3", "2.5", None, "7")
