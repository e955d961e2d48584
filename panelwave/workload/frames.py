"""The panels the queries run on, derived from the given tables.

``obs`` has one row per order: its customer, its period and its line totals.
``household_raw`` gives the same orders the shape of a dirty survey file, with
text cells for every case the cleaning rules must handle. Both exist twice, as
DataFrames here and as SQL for the result checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRAIN_UNTIL = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def period_of(date: str) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("T"), F.quarter(date).cast("string"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("period", period_of("o_orderdate"))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer attributes and line totals (NULL for an order without lines)."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.avg("l_discount").alias("disc"),
            F.count(F.lit(1)).cast("double").alias("lines"),
        )
    )
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("person"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("acctbal"),
    )
    panel = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("person"),
        F.col("o_orderstatus").alias("status"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.year("o_orderdate").alias("year"),
        F.quarter("o_orderdate").alias("quarter"),
        period_of("o_orderdate").alias("period"),
        F.col("o_totalprice").alias("target"),
    )
    return panel.join(people, "person").join(lines, "id", "left")


OBS_SQL = """
obs AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS person, o.o_orderstatus AS status,
         substr(o.o_orderpriority, 1, 1) AS priority,
         CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(quarter(o.o_orderdate) AS INTEGER) AS quarter,
         CAST(year(o.o_orderdate) AS VARCHAR) || 'T' || CAST(quarter(o.o_orderdate) AS VARCHAR) AS period,
         o.o_totalprice AS target, c.c_mktsegment AS segment, c.c_nationkey AS nation, c.c_acctbal AS acctbal,
         l.qty, l.disc, l.lines
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS qty, avg(l_discount) AS disc,
                    CAST(count(*) AS DOUBLE) AS lines FROM lineitem GROUP BY l_orderkey) l
    ON l.l_orderkey = o.o_orderkey)"""

# One definition for both engines: these expressions are valid in either dialect.
HOUSEHOLD_CELLS = {
    "ANIO": "CASE WHEN id % 7 = 0 THEN concat(CAST(year AS STRING), '.0') ELSE CAST(year AS STRING) END",
    "TRIMESTRE": "CAST(quarter + CASE WHEN id % 211 = 0 THEN 2 ELSE 1 END AS STRING)",
    "DOMINIO": "CASE WHEN id % 3 = 0 THEN concat(CAST(nation % 4 + 1 AS STRING), '.0') ELSE CAST(nation % 4 + 1 AS STRING) END",
    "NUM_HOGAR": "CAST(person AS STRING)",
    "NUM_PERSONA": "concat(' ', CAST(id AS STRING), ' ')",
    "FACTOR": "CASE WHEN id % 89 = 0 THEN '+infinity' ELSE CAST(id % 900 + 100 AS STRING) END",
    "P02A03": "CASE WHEN id % 53 = 0 THEN ' N/A ' ELSE CAST(id % 70 + 10 AS STRING) END",
    "P03A03A": "CASE WHEN id % 8 = 0 THEN NULL WHEN id % 101 = 0 THEN '1.5' ELSE CAST(nation % 9 AS STRING) END",
    "P05C07A": "CAST(CAST(floor(qty / 5.0) AS BIGINT) AS STRING)",
    "P05C07B": "CASE WHEN id % 97 = 0 THEN '5.5' ELSE CAST(id % 13 AS STRING) END",
    "P05H01A": "CAST(CAST(lines AS BIGINT) * 13 AS STRING)",
    "P05C16": "priority",
    "OCUPADOS": "CASE WHEN status IN ('F', 'O') THEN '1' END",
    "P05D01": (
        "CASE WHEN id % 61 = 0 THEN 'n.d.' WHEN id % 59 = 0 THEN '-' WHEN id % 67 = 0 THEN '0' "
        "WHEN id % 5 = 0 AND pay >= 1000 THEN concat(CAST(CAST(floor(pay / 1000.0) AS BIGINT) AS STRING), ',', "
        "lpad(CAST(pay % 1000 AS STRING), 3, '0')) ELSE CAST(pay AS STRING) END"
    ),
}
PAY = "CAST(floor(target / 50.0) AS BIGINT)"
PROVENANCE_CELLS = {
    "archivo_origen": "concat('personas_', period, '.parquet')",
    "periodo_archivo": "period",
    "anio_archivo": "year",
    "trimestre_calendario": "quarter",
    "fila_origen": "CAST(id + 2 AS INT)",
}


def household_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = {**PROVENANCE_CELLS, **HOUSEHOLD_CELLS}
    return obs(spark, sf_dir).withColumn("pay", F.expr(PAY)).selectExpr(*[f"{e} AS {n}" for n, e in cells.items()])


def normal_sql(c: str) -> str:
    """The cell rule for the cases that occur in the derived file."""
    return f"""CASE WHEN lower(trim({c})) IN ('', 'nan', 'none', 'null', 'na', 'n/a', '#n/a', '.', '-', 'inf', '+inf',
      '-inf', 'infinity', '-infinity') THEN NULL
      WHEN regexp_matches(trim({c}), '^[+-]?[0-9]{{1,3}}(,[0-9]{{3}})+([.][0-9]+)?$') THEN replace(trim({c}), ',', '')
      ELSE regexp_replace(trim({c}), '^([+-]?[0-9]+)[.]0+$', '\\1') END"""


def typed_sql(c: str, t: str) -> str:
    value = f"TRY_CAST({c} AS DOUBLE)"
    finite = f"CASE WHEN isfinite({value}) THEN {value} END"
    if t == "double":
        return finite
    kind = "INTEGER" if t == "int" else "BIGINT"
    return f"CASE WHEN {finite} = floor({finite}) THEN TRY_CAST({finite} AS {kind}) END"


def household_sql() -> str:
    """CTEs ``raw``, ``norm`` and ``typed`` of the household file."""
    from panelwave.plans.household import RULES, TYPES

    cells = {**PROVENANCE_CELLS, **HOUSEHOLD_CELLS}
    prov = ", ".join(PROVENANCE_CELLS)
    raw = ", ".join(f"{e} AS {n}" for n, e in cells.items())
    norm = ", ".join(f"{normal_sql(c)} AS {c}" for c in TYPES)
    typed = ", ".join(f"{typed_sql(c, t)} AS {c}" for c, t in TYPES.items())
    passes = ", ".join(
        f"coalesce({r.condition.replace('12.0D', 'CAST(12.0 AS DOUBLE)')}, false) AS r{i}" for i, r in enumerate(RULES, 1)
    )
    return f"""{OBS_SQL},
raw AS (SELECT {raw} FROM (SELECT *, {PAY} AS pay FROM obs)),
norm AS (SELECT {prov}, {norm} FROM raw),
typed AS (SELECT {prov}, {typed} FROM norm),
ruled AS (SELECT *, {passes} FROM typed),
eligible AS (SELECT
  concat_ws('_', periodo_archivo, CAST(NUM_HOGAR AS VARCHAR), CAST(NUM_PERSONA AS VARCHAR)) AS id_registro,
  {prov}, ANIO, TRIMESTRE, NUM_HOGAR, NUM_PERSONA, FACTOR, P02A03 AS edad,
  P05C07A + P05C07B / CAST(12.0 AS DOUBLE) AS antiguedad, P05H01A AS horas_semanales, P05D01 AS salario_mensual,
  CASE WHEN P03A03A BETWEEN 0 AND 7 THEN CAST(P03A03A AS VARCHAR) ELSE 'DESCONOCIDO' END AS nivel_educativo,
  CASE WHEN P05C16 BETWEEN 1 AND 4 THEN CAST(P05C16 AS VARCHAR) ELSE 'DESCONOCIDO' END AS categoria_ocupacional,
  CASE WHEN DOMINIO BETWEEN 1 AND 3 THEN CAST(DOMINIO AS VARCHAR) ELSE 'DESCONOCIDO' END AS dominio,
  P03A03A, P05C16, DOMINIO AS codigo_dominio, OCUPADOS
  FROM ruled WHERE r1 AND r2 AND r3 AND r4 AND r5 AND r6)"""
