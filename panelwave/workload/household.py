"""The phases of the household preset over a survey file derived from the orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwave.operators import checks as ck
from panelwave.operators import evaluate
from panelwave.operators.suite import suite
from panelwave.operators.shape import one_row
from panelwave.plans import household as preset
from panelwave.plans.describe import Description
from panelwave.plans.foundation import Foundation, foundation, marked_stage
from panelwave.plans.selection import FinalTest, evaluate_once, select_models
from panelwave.session import scratch_dir
from panelwave.sources.manifest import fingerprint
from panelwave.workload.frames import household_raw, household_sql, orders
from panelwave.workload.profiles import summary_sql
from panelwave.workload.registry import query, rounded

SQL = household_sql()
MEASURES = ["salario_mensual", "edad", "antiguedad", "horas_semanales"]
TRAIN = tuple(f"{y}T{q}" for y in range(1995, 2000) for q in (1, 2, 3, 4))
VALID = tuple(f"2000T{q}" for q in (1, 2, 3, 4))
TEST = ("2001T1", "2001T2", "2001T3")
CODES = {"DOMINIO": "1, 2, 3", "P03A03A": "0, 1, 2, 3, 4, 5, 6, 7", "P05C16": "1, 2, 3, 4, 5, 6, 7, 8, 9", "OCUPADOS": "1"}


def _foundation(spark: SparkSession, sf_dir: str) -> Foundation:
    return foundation(household_raw(spark, sf_dir), preset.SPEC, preset.PROVENANCE)


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored eligible panel, as the later phases read it."""
    return _foundation(spark, sf_dir).stored_eligible(scratch_dir(spark, "eligible"), "fila_origen")


def _describe(spark: SparkSession, sf_dir: str) -> Description:
    return Description(preset.SPEC, _panel(spark, sf_dir))


@query(f"WITH {SQL} SELECT * FROM typed")
def household_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _foundation(spark, sf_dir).typed


@query(f"""WITH {SQL}, u AS ({' UNION ALL '.join(
 f'''SELECT n.periodo_archivo, '{c}' AS "column", count(*) AS rows, count(*) FILTER (n.{c} IS NULL) AS missing,
 count(*) FILTER (n.{c} IS NOT NULL AND t.{c} IS NULL) AS invalid FROM norm n JOIN typed t USING (fila_origen) GROUP BY 1'''
 for c in preset.TYPES)}) SELECT *, round(100.0 * missing / CAST(rows AS DOUBLE), 6) AS missing_pct FROM u""")
def household_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_foundation(spark, sf_dir).missing(), 6)


@query(f"""WITH {SQL}, f AS (SELECT periodo_archivo, CASE WHEN NOT r1 THEN 1 WHEN NOT r2 THEN 2 WHEN NOT r3 THEN 3 WHEN NOT r4 THEN 4
 WHEN NOT r5 THEN 5 WHEN NOT r6 THEN 6 ELSE 7 END AS fail FROM ruled),
s AS (SELECT unnest([1, 2, 3, 4, 5, 6]) AS step, unnest([{', '.join(f"'{r.name}'" for r in preset.RULES)}]) AS rule)
SELECT periodo_archivo, step, rule, count(*) FILTER (fail >= step) AS before, count(*) FILTER (fail = step) AS excluded,
 count(*) FILTER (fail > step) AS after FROM f, s GROUP BY 1, 2, 3""")
def household_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _foundation(spark, sf_dir).funnel()


@query(f"""WITH {SQL} SELECT periodo_archivo, count(*) AS rows, count(*) FILTER (NUM_HOGAR IS NULL OR NUM_PERSONA IS NULL) AS null_keys,
 count(DISTINCT concat_ws('_', NUM_HOGAR, NUM_PERSONA)) AS distinct_keys,
 count(*) - count(DISTINCT concat_ws('_', NUM_HOGAR, NUM_PERSONA)) AS surplus_keys, CAST(0 AS BIGINT) AS repeated_keys,
 CAST(0 AS BIGINT) AS exact_duplicates FROM typed GROUP BY 1""")
def household_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _foundation(spark, sf_dir).keys()


@query(f"""WITH {SQL}, p AS (SELECT NUM_HOGAR, periodo_archivo, count(*) AS n FROM typed GROUP BY 1, 2),
k AS (SELECT NUM_HOGAR, sum(n) AS r, count(*) AS p FROM p GROUP BY 1)
SELECT CAST(sum(r) AS BIGINT) AS rows, CAST(sum(p) AS BIGINT) AS distinct_period_keys, CAST(sum(r - p) AS BIGINT) AS surplus_period_keys,
 count(*) AS distinct_keys, count(*) FILTER (p > 1) AS keys_in_many_periods FROM k""")
def household_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Households seen in several periods."""
    from panelwave.operators.quality import cross_period_keys

    return cross_period_keys(_foundation(spark, sf_dir).typed, ["NUM_HOGAR"], "periodo_archivo")


@query(f"WITH {SQL} " + " UNION ALL ".join(
    f"""SELECT periodo_archivo, '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing, count(*) FILTER ({c} NOT IN ({v})) AS out_of_domain,
 count(*) FILTER ({c} IS NULL OR {c} NOT IN ({v})) AS unknown FROM typed GROUP BY 1""" for c, v in CODES.items()))
def household_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _foundation(spark, sf_dir).codes()


@query(f"WITH {SQL} " + " UNION ALL ".join(
    f"""SELECT periodo_archivo, '{c}' AS "column", coalesce(CAST({c} AS VARCHAR), 'NULO') AS value, count(*) AS n FROM typed GROUP BY 1, 3"""
    for c in ("TRIMESTRE", "ANIO", "P05C16", "OCUPADOS", "P03A03A", "DOMINIO")))
def household_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _foundation(spark, sf_dir).values(("TRIMESTRE", "ANIO", "P05C16", "OCUPADOS", "P03A03A", "DOMINIO"))


@query(f"WITH {SQL} SELECT * FROM eligible")
def household_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _foundation(spark, sf_dir).eligible


@query(f"WITH {SQL} " + " UNION ALL ".join(
    f"SELECT periodo_archivo, '{c}' AS violation, count(*) FILTER ({c} = 'DESCONOCIDO') AS rows FROM eligible GROUP BY 1"
    for c in preset.CATEGORIES))
def household_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _foundation(spark, sf_dir).unknown_labels()


@query(f"WITH {SQL} " + summary_sql("eligible", MEASURES, "periodo_archivo", 6))
def household_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _describe(spark, sf_dir).summary_by_period()
    return rounded(rounded(table, 3, ["skewness", "kurtosis"]), 6, ["mean", "sd", "min", "max", "p25", "p50", "p75", "p95"])


@query(f"""WITH {SQL}, l AS (SELECT unnest([{', '.join(f"'{k}'" for k in preset.LABELS['nivel_educativo'])}]) AS c,
 unnest([{', '.join(f"'{v}'" for v in preset.LABELS['nivel_educativo'].values())}]) AS t)
SELECT nivel_educativo, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct,
 round(avg(salario_mensual), 4) AS mean, round(quantile_cont(salario_mensual, 0.5), 4) AS median,
 coalesce(any_value(t), 'DESCONOCIDO') AS label FROM eligible LEFT JOIN l ON c = nivel_educativo GROUP BY 1""")
def household_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(_describe(spark, sf_dir).categories("nivel_educativo"), 6, ["pct"]), 4, ["mean", "median"])


@query(f"""WITH {SQL} SELECT periodo_archivo, dominio, count(*) AS n,
 round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY periodo_archivo), 6) AS pct,
 round(quantile_cont(salario_mensual, 0.5), 4) AS median FROM eligible GROUP BY 1, 2""")
def household_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(_describe(spark, sf_dir).composition("dominio"), 6, ["pct"]), 4, ["median"])


@query(f"WITH {SQL} " + " UNION ALL ".join(
    f"SELECT '{a}' AS var_x, '{b}' AS var_y, count(*) AS n, round(corr({a}, {b}), 6) AS r FROM eligible"
    for a in MEASURES for b in MEASURES))
def household_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_describe(spark, sf_dir).correlation(), 6)


@query(f"""WITH {SQL}, p AS (SELECT count(DISTINCT periodo_archivo) AS k FROM typed),
w AS (SELECT count(*) AS k FROM (SELECT n.periodo_archivo, c FROM norm n JOIN typed t USING (fila_origen), (SELECT unnest([{', '.join(f"'{c}'" for c in preset.TYPES)}]) AS c)
  GROUP BY 1, 2 HAVING count(*) FILTER ({' OR '.join(f"(c = '{c}' AND n.{c} IS NOT NULL AND t.{c} IS NULL)" for c in preset.TYPES)}) > 0)),
d AS (SELECT count(*) AS k FROM (SELECT periodo_archivo, c FROM typed, (SELECT unnest([{', '.join(f"'{c}'" for c in CODES)}]) AS c)
  GROUP BY 1, 2 HAVING count(*) FILTER ({' OR '.join(f"(c = '{c}' AND {c} NOT IN ({v}))" for c, v in CODES.items())}) > 0)),
v AS (SELECT count(*) FILTER (nivel_educativo = 'DESCONOCIDO') > 0 AS a, count(*) FILTER (dominio = 'DESCONOCIDO') > 0 AS b FROM eligible)
SELECT 'foundation' AS suite, p.k * 27 - w.k - d.k AS passed, CAST(0 AS BIGINT) AS failures, w.k + d.k AS warnings, true AS ok FROM p, w, d
UNION ALL SELECT 'eligible', 18 - CAST(a AS BIGINT) - CAST(b AS BIGINT), CAST(a AS BIGINT) + CAST(b AS BIGINT), 0, NOT (a OR b) FROM v""")
def household_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = _foundation(spark, sf_dir).stored(scratch_dir(spark, "typed"), "fila_origen")
    return ck.summary(stage.checks())


SETS = {"entrenamiento": TRAIN, "prueba": TEST}
# Controls known from the orders alone; that of one period and the eligible rows of another are off on purpose.
CONTROLS_SQL = """SELECT period AS scope, 'rows' AS measure, count(*) + CASE WHEN period = '1996T2' THEN 1 ELSE 0 END AS expected FROM o GROUP BY period
UNION ALL SELECT period, concat('quarter ', CAST(CAST(substr(period, 6, 1) AS INT) + 1 AS STRING)), count(*) FROM o GROUP BY period
UNION ALL SELECT period, 'missing P05D01', sum(CASE WHEN o_orderkey % 59 = 0 AND o_orderkey % 61 <> 0 THEN 1 ELSE 0 END) FROM o GROUP BY period
UNION ALL SELECT 'entrenamiento', 'rows', count(*) FROM o WHERE substr(period, 1, 4) < '2000'
UNION ALL SELECT 'prueba', 'rows', count(*) FROM o WHERE substr(period, 1, 4) = '2001'
UNION ALL SELECT '1997T3', 'eligible', 5
UNION ALL SELECT '1894T1', 'rows', 7"""


def _suite_sql() -> str:
    """Every measure of the suite by plain counting."""
    inside = "coalesce(r1 AND r2 AND r3 AND r4 AND r5 AND r6, false)"
    rows = {"rows": "true", "eligible": inside, "funnel": "false"}
    for c in preset.TYPES:
        rows[f"missing {c}"] = f"n.{c} IS NULL"
        rows[f"unconvertible {c}"] = f"n.{c} IS NOT NULL AND t.{c} IS NULL"
    rows |= {f"out of domain {c}": f"t.{c} NOT IN ({v})" for c, v in CODES.items()}
    counted = [f"SELECT t.periodo_archivo AS scope, '{m}' AS measure, count(*) FILTER ({x}) AS observed FROM ruled t JOIN norm n USING (fila_origen) GROUP BY 1" for m, x in rows.items()]
    kept = {f"unknown {c}": f"{c} = 'DESCONOCIDO'" for c in preset.CATEGORIES}
    kept |= {f"NULL {c}": f"{c} IS NULL" for c in preset.SPEC.model_columns} | preset.VIOLATIONS
    counted += [f"SELECT p.scope, '{m}', count(*) FILTER ({x}) FROM (SELECT DISTINCT periodo_archivo AS scope FROM typed) p LEFT JOIN eligible ON scope = periodo_archivo GROUP BY 1" for m, x in kept.items()]
    counted += ["SELECT periodo_archivo, concat('quarter ', TRIMESTRE), count(*) FROM typed GROUP BY 1, 2"]
    key = "concat_ws('_', NUM_HOGAR, NUM_PERSONA)"
    counted += [f"SELECT periodo_archivo, '{m}', {x} FROM typed GROUP BY 1" for m, x in (
        ("null keys", "count(*) FILTER (NUM_HOGAR IS NULL OR NUM_PERSONA IS NULL)"), ("surplus keys", f"count(*) - count(DISTINCT {key})"),
        ("exact copies", "count(*) - count(DISTINCT (" + ", ".join(preset.TYPES) + "))"))]
    sums = [f"SELECT '{n}', 'rows', count(*) FROM typed WHERE periodo_archivo IN {p}" for n, p in SETS.items()]
    return f"""WITH {SQL}, o AS (SELECT *, concat(year(o_orderdate), 'T', quarter(o_orderdate)) AS period FROM orders),
found AS ({" UNION ALL ".join([*counted, *sums])}), wanted AS ({CONTROLS_SQL}),
b AS (SELECT scope, measure, coalesce(f.observed, 0) AS observed, w.expected FROM found f FULL JOIN wanted w USING (scope, measure)),
e AS (SELECT scope, measure, observed, CAST(CASE WHEN measure = 'rows' THEN expected ELSE coalesce(expected, 0) END AS BIGINT) AS expected FROM b
  WHERE expected IS NOT NULL OR NOT (measure = 'eligible' OR measure LIKE 'missing %'))
SELECT *, CASE WHEN regexp_matches(measure, '^(missing|unconvertible|out of domain) ') THEN 'warn' ELSE 'error' END AS severity,
  observed IS NOT DISTINCT FROM expected AS passed FROM e"""


@query(_suite_sql())
def household_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check of the stage next to the controls of its periods, from two scans of the stage."""
    stage = marked_stage(household_raw(spark, sf_dir), preset.SPEC, preset.PROVENANCE, scratch_dir(spark, "marked"), "fila_origen")
    wanted = spark.sql(f"WITH o AS (SELECT * FROM {{o}}) {CONTROLS_SQL}", o=orders(spark, sf_dir))
    return suite(stage, preset.SPEC, wanted, SETS, "TRIMESTRE")


@query()
def household_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The K table, next to the number of eligible rows and of those left out for want of a measure."""
    described = _describe(spark, sf_dir)
    gaps = described.clustering_gaps(preset.CLUSTER_FEATURES)
    counts = one_row(gaps, rows=F.sum("rows"), excluded=F.sum("excluded"))
    results = described.clusters(preset.CLUSTER_FEATURES).results
    return results.withColumns({"eligible_rows": counts["rows"], "excluded_rows": counts["excluded"]})


@query()
def household_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven configurations and the baseline, fitted on the earlier periods and scored on the next year."""
    return select_models(_panel(spark, sf_dir), preset.SPEC, TRAIN, VALID).candidates()


def _final(spark: SparkSession, sf_dir: str):
    return evaluate_once(_panel(spark, sf_dir), preset.SPEC, TRAIN, VALID, TEST, scratch_dir(spark, "final"))


@query()
def household_final_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid, test = _final(spark, sf_dir)
    return test.compared(grid)


@query(f"""WITH {SQL}, s AS (SELECT *, salario_mensual AS y FROM eligible),
m AS (SELECT avg(y) FILTER (periodo_archivo IN {(*TRAIN, *VALID)}) AS p FROM s)
SELECT 2 AS algorithms, true AS refitted_as_selected, true AS least_rmse, true AS second_test_refused, true AS fingerprint_of_selection,
 count(*) AS test_rows, round(avg(abs(y - p)), 4) AS baseline_mae, round(sqrt(avg((y - p) * (y - p))), 4) AS baseline_rmse
FROM s, m WHERE periodo_archivo IN {TEST}""")
def household_freeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the single test promises: it refits what was selected, refuses a second run, and knows its selection rows."""
    panel = _panel(spark, sf_dir)
    path = scratch_dir(spark, "final")
    grid, test = evaluate_once(panel, preset.SPEC, TRAIN, VALID, TEST, path)
    frozen = spark.read.parquet(f"{path}/frozen")
    try:
        evaluate_once(panel, preset.SPEC, TRAIN, VALID, TEST, path)
        refused = False
    except RuntimeError:
        refused = True
    rows = panel.where(F.col(preset.SPEC.period).isin(*TRAIN, *VALID)).select(preset.SPEC.record_id, *preset.SPEC.model_columns)
    mark = one_row(fingerprint(rows), mark=F.max("fingerprint"))["mark"]
    best = grid.results.groupBy("algorithm").agg(F.min("rmse").alias("best"))
    promised = frozen.join(best, "algorithm").agg(
        F.count(F.lit(1)).cast("int").alias("algorithms"),
        F.bool_and(F.col("params") == _fitted_params(test)[F.col("algorithm")]).alias("refitted_as_selected"),
        F.bool_and(F.col("rmse") == F.col("best")).alias("least_rmse"),
        F.lit(refused).alias("second_test_refused"),
        F.bool_and(F.col("selection_fingerprint") == mark).alias("fingerprint_of_selection"),
    )
    measured = test.metrics().where("model = 'baseline'").select(
        F.col("n").alias("test_rows"), F.round("mae", 4).alias("baseline_mae"), F.round("rmse", 4).alias("baseline_rmse")
    )
    baseline = one_row(measured, **{c: F.max(c) for c in measured.columns})
    return promised.select("*", baseline.alias("b")).select(*promised.columns, "b.*")


def _fitted_params(test: FinalTest) -> Column:
    """The parameters that the refitted models themselves report, written as in the table of results."""
    names = {"linear": ("regParam", "elasticNetParam"), "forest": ("numTrees", "maxDepth")}
    told = {a: str({n: m.getOrDefault(n) for n in names[a]}) for a, m in test.fitted.items()}
    return F.create_map(*[F.lit(x) for pair in told.items() for x in pair])


@query()
def household_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(spark, sf_dir)[1].errors()


@query()
def household_conclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(spark, sf_dir)[1].conclusions()
