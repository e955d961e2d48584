"""Descriptive statistics, associations, pivots and text audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwave.functions import codes, numeric
from panelwave.operators import association, profile, sampling, textaudit
from panelwave.workload.audits import PERIOD_SQL
from panelwave.workload.frames import OBS_SQL, obs, orders, table
from panelwave.workload.registry import query, rounded

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
OBS_MEASURES = ["target", "qty", "lines", "acctbal"]


def summary_sql(source: str, columns: list[str], by: str = "", places: int = 4) -> str:
    """One SELECT per variable; skewness is the population one, as in the DataFrames."""
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    parts = []
    for c in columns:
        parts.append(f"""SELECT {lead}'{c}' AS variable, count({c}) AS n, round(avg({c}), {places}) AS mean,
 round(stddev_samp({c}), {places}) AS sd, round(min({c}), {places}) AS min, round(max({c}), {places}) AS max,
 round((avg({c}*{c}*{c}) - 3*avg({c})*avg({c}*{c}) + 2*avg({c})*avg({c})*avg({c})) / nullif(power(var_pop({c}), 1.5), 0), 3) + 0.0 AS skewness,
 round(kurtosis_pop({c}), 3) + 0.0 AS kurtosis,
 round(quantile_cont({c}, 0.25), {places}) AS p25, round(quantile_cont({c}, 0.5), {places}) AS p50,
 round(quantile_cont({c}, 0.75), {places}) AS p75, round(quantile_cont({c}, 0.95), {places}) AS p95 FROM {source} {group}""")
    return " UNION ALL ".join(parts)


def _round_summary(df: DataFrame, places: int = 4) -> DataFrame:
    shape = ["skewness", "kurtosis"]
    rest = ["mean", "sd", "min", "max", "p25", "p50", "p75", "p95"]
    return rounded(rounded(df, places, rest), 3, shape)


@query(summary_sql("lineitem", LINE_MEASURES))
def summary_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_summary(profile.numeric_summary(table(spark, sf_dir, "lineitem"), LINE_MEASURES))


@query("WITH l AS (SELECT *, CAST(year(l_shipdate) AS VARCHAR) || 'T' || CAST(quarter(l_shipdate) AS VARCHAR) AS period FROM lineitem) "
       + summary_sql("l", LINE_MEASURES, "period"))
def summary_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    period = F.concat(F.year("l_shipdate").cast("string"), F.lit("T"), F.quarter("l_shipdate").cast("string"))
    lines = table(spark, sf_dir, "lineitem").select(period.alias("period"), *LINE_MEASURES)
    return _round_summary(profile.numeric_summary(lines, LINE_MEASURES, ["period"]))


@query(f"WITH {OBS_SQL} " + summary_sql("obs", ["target", "qty"], "segment"))
def summary_with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_summary(profile.numeric_summary(obs(spark, sf_dir), ["target", "qty"], ["segment"]))


@query()
def summary_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_summary(table(spark, sf_dir, "lineitem"), LINE_MEASURES, exact=False)


@query(f"""WITH {OBS_SQL} SELECT segment, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct,
 round(avg(target), 4) AS mean, round(quantile_cont(target, 0.5), 4) AS median FROM obs GROUP BY 1""")
def category_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = profile.category_table(obs(spark, sf_dir), "segment", "target")
    return rounded(rounded(profile.order_by_size(t, "segment"), 6, ["pct"]), 4, ["mean", "median"])


@query(f"""WITH {OBS_SQL} SELECT period, priority, count(*) AS n,
 round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY period), 6) AS pct,
 round(quantile_cont(target, 0.5), 4) AS median FROM obs GROUP BY 1, 2""")
def composition_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = profile.composition_by_period(obs(spark, sf_dir), "period", "priority", "target")
    return rounded(rounded(t, 6, ["pct"]), 4, ["median"])


@query("""WITH s AS (SELECT quantile_cont(o_totalprice, 0.95) AS t, quantile_cont(o_totalprice, 0.5) AS m, avg(o_totalprice) AS a FROM orders),
l AS (SELECT ln(o_totalprice) AS v FROM orders WHERE o_totalprice > 0),
lm AS (SELECT avg(v) AS m FROM l),
ls AS (SELECT avg(power(v - m, 3)) / power(avg(power(v - m, 2)), 1.5) AS g FROM l, lm),
g AS (SELECT avg(power(o_totalprice - a, 3)) / power(avg(power(o_totalprice - a, 2)), 1.5) AS g FROM orders, s)
SELECT count(*) AS n, round(any_value(g.g), 6) AS skewness, round(kurtosis_pop(o_totalprice), 6) AS kurtosis,
 round(any_value(ls.g), 6) AS log_skewness, round(avg(o_totalprice) / any_value(m), 6) AS mean_median_ratio,
 round(any_value(t), 4) AS threshold, count(*) FILTER (o_totalprice >= t) AS n_high,
 round(100.0 * sum(o_totalprice) FILTER (o_totalprice >= t) / sum(o_totalprice), 6) AS high_mass_pct,
 round(100.0 * count(*) FILTER (o_totalprice > a) / CAST(count(*) AS DOUBLE), 6) AS above_mean_pct
FROM orders, s, ls, g""")
def tail_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(profile.tail_concentration(table(spark, sf_dir, "orders"), "o_totalprice"), 4, ["threshold"]), 6)


def pearson_sql(columns: list[str]) -> str:
    whole = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS var_x, '{b}' AS var_y, count(*) AS n, round(corr({a}, {b}), 6) AS r FROM c" for a in columns for b in columns
    )
    return f"WITH {OBS_SQL}, c AS (SELECT * FROM obs WHERE {whole}) {pairs}"


@query(pearson_sql(OBS_MEASURES))
def pearson_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(association.pearson(obs(spark, sf_dir), OBS_MEASURES), 6)


@query(f"""WITH {OBS_SQL}, c AS (SELECT * FROM obs WHERE qty IS NOT NULL) SELECT * FROM (
 SELECT 'qty' AS variable, round(corr(target, qty), 6) AS r FROM c UNION ALL
 SELECT 'lines', round(corr(target, lines), 6) FROM c UNION ALL SELECT 'acctbal', round(corr(target, acctbal), 6) FROM c)""")
def corr_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(association.ranked_with(association.pearson(obs(spark, sf_dir), OBS_MEASURES), "target"), 6)


def histogram_sql(bins: int, value: str, power: bool, places: int) -> str:
    edge = f"lo + (bin - 1) * ((hi - lo) / {bins}.0)"
    lower, upper = edge, f"({edge}) + (hi - lo) / {bins}.0"
    if power:
        lower, upper = f"power(10, {lower})", f"power(10, {upper})"
    return f"""WITH v AS (SELECT {value} AS x FROM orders), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
b AS (SELECT CAST(least(floor((x - lo) / ((hi - lo) / {bins}.0)) + 1, {bins}) AS INTEGER) AS bin, count(*) AS n FROM v, e GROUP BY 1),
g AS (SELECT CAST(unnest(range(1, {bins + 1})) AS INTEGER) AS bin)
SELECT g.bin, round({lower.replace('bin', 'g.bin')}, {places}) AS lower, round({upper.replace('bin', 'g.bin')}, {places}) AS upper,
 coalesce(b.n, 0) AS n FROM g CROSS JOIN e LEFT JOIN b ON g.bin = b.bin"""


@query(histogram_sql(40, "o_totalprice", False, 6))
def histogram_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.histogram(table(spark, sf_dir, "orders"), "o_totalprice"), 6)


@query(histogram_sql(50, "log10(o_totalprice)", True, 4))
def histogram_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.histogram(table(spark, sf_dir, "orders"), "o_totalprice", profile.LOG_BINS, log=True), 4)


@query(f"""WITH {OBS_SQL} SELECT period, {', '.join(
 f"round(coalesce(100.0 * count(*) FILTER (priority = '{p}') / count(*), 0), 6) AS \"{p}\"" for p in "12345")} FROM obs GROUP BY 1""")
def pivot_period_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = profile.composition_by_period(obs(spark, sf_dir), "period", "priority", "target")
    return rounded(profile.pivot_table(shares, "period", "priority", list("12345"), F.sum("pct"), 0.0), 6)


@query(f"""WITH {OBS_SQL} SELECT "column", {', '.join(f'CAST(count(*) FILTER (year = {y} AND gone) AS BIGINT) AS "{y}"' for y in range(1995, 2002))}
FROM (SELECT 'qty' AS "column", year, qty IS NULL AS gone FROM obs UNION ALL SELECT 'disc', year, disc IS NULL FROM obs) GROUP BY 1""")
def pivot_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelwave.operators.quality import missing_table

    years = [str(y) for y in range(1995, 2002)]
    counts = missing_table(obs(spark, sf_dir), ["qty", "disc"], ["year"])
    return profile.pivot_table(counts, "column", "year", years, F.sum("missing"), 0)


@query(f"""WITH {OBS_SQL} SELECT period, round(quantile_cont(target, 0.5), 4) AS target, round(quantile_cont(qty, 0.5), 4) AS qty
FROM obs GROUP BY 1""")
def pivot_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelwave.operators.quantiles import exact_quantiles

    medians = exact_quantiles(obs(spark, sf_dir), ["target", "qty"], [0.5], ["period"])
    return rounded(profile.pivot_table(medians, "period", "variable", ["target", "qty"], F.first("p50")), 4)


@query(f"""WITH p AS (SELECT {PERIOD_SQL} AS period, count(*) AS n, round(quantile_cont(o_totalprice, 0.5), 4) AS median FROM orders GROUP BY 1)
SELECT period, n, median, n - lag(n) OVER (ORDER BY period) AS n_change,
 round(median - lag(median) OVER (ORDER BY period), 4) AS median_change FROM p""")
def period_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelwave.operators.quantiles import exact_quantiles

    o = orders(spark, sf_dir)
    counted = o.groupBy("period").agg(F.count(F.lit(1)).alias("n"))
    medians = exact_quantiles(o, ["o_totalprice"], [0.5], ["period"]).select("period", F.round("p50", 4).alias("median"))
    return rounded(profile.period_change(counted.join(medians, "period"), "period", ["n", "median"]), 4)


@query(f"""WITH {OBS_SQL}, c AS (SELECT segment, priority, count(*) AS n FROM obs GROUP BY 1, 2),
r AS (SELECT *, sum(n) OVER (PARTITION BY segment) AS a, row_number() OVER (PARTITION BY segment ORDER BY n DESC, CAST(priority AS INTEGER)) AS k FROM c)
SELECT segment, priority, n, round(100.0 * n / a, 6) AS pct FROM r WHERE k = 1""")
def modal_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.modal_category(obs(spark, sf_dir), "priority", ["segment"]), 6)


@query(f"""WITH {OBS_SQL}, a AS (SELECT avg(target) AS t, avg(qty) AS q FROM obs)
SELECT segment, count(*) AS n, 'target' AS variable, round(avg(target), 4) AS mean, round(avg(target) - any_value(t), 4) AS deviation
FROM obs, a GROUP BY 1 UNION ALL
SELECT segment, count(*), 'qty', round(avg(qty), 4), round(avg(qty) - any_value(q), 4) FROM obs, a GROUP BY 1""")
def group_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.group_deviation(obs(spark, sf_dir), "segment", ["target", "qty"]), 4)


@query(f"""WITH {OBS_SQL}, c AS (SELECT segment, priority, count(*) AS n, round(avg(target), 4) AS mean FROM obs GROUP BY 1, 2)
SELECT segment, priority, n, mean FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY mean DESC) AS k FROM c) WHERE k = 1""")
def top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = rounded(
        obs(spark, sf_dir).groupBy("segment", "priority").agg(F.count(F.lit(1)).alias("n"), F.avg("target").alias("mean")), 4
    )
    return sampling.best_per_group(means, ["segment"], F.col("mean").desc())


ELIGIBLE_OBS = ["record", "year", "quarter", "tenure", "units", "level", "target"]


@query(f"""WITH {OBS_SQL} SELECT concat_ws('_', period, CAST(person AS VARCHAR), CAST(id AS VARCHAR)) AS record, year, quarter,
 round(lines + CAST(quarter AS DOUBLE) / 12.0, 6) AS tenure, qty AS units, TRY_CAST(priority AS DOUBLE) AS level, target FROM obs
WHERE qty > 0 AND target > 0""")
def eligible_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = obs(spark, sf_dir).where("qty > 0 and target > 0")
    return rounded(
        panel.select(
            codes.record_id(F.col("period"), F.col("person"), F.col("id")).alias("record"),
            "year",
            "quarter",
            numeric.tenure(F.col("lines"), F.col("quarter").cast("double")).alias("tenure"),
            F.col("qty").alias("units"),
            codes.ordinal(F.col("priority")).alias("level"),
            "target",
        ),
        6,
        ["tenure"],
    )


CLAIMS = ("ment(s)?", "th[ae]t", "que la")
NEGATORS = ("la", "the", "und")
WORD = r"[^\p{L}\p{N}_]"
HYGIENE = {"url": "https?://", "digits": "[0-9]{3,}", "and": "(?i)and", "license": "(?i)licen[cs]e"}


def claims_sql(before: int = 60, after: int = 20) -> str:
    """Matches and the pieces between them, numbered; a claim's sentence starts after the last break before it."""
    parts = " UNION ALL ".join(
        f"""SELECT doc_id, '{p}' AS pattern, text, regexp_extract_all(text, '(?i){p}') AS hits,
 regexp_split_to_array(text, '(?i){p}') AS pieces FROM documents WHERE regexp_matches(text, '(?i){p}')"""
        for p in CLAIMS
    )
    return f"""WITH m AS ({parts}),
x AS (SELECT doc_id, pattern, text, unnest(hits) AS phrase, unnest(pieces[1:len(hits)]) AS piece,
      unnest(range(1, len(hits) + 1)) AS i FROM m),
s AS (SELECT *, CAST(sum(length(piece) + length(phrase)) OVER (PARTITION BY doc_id, pattern ORDER BY i) - length(phrase) AS INTEGER) AS start FROM x),
h AS (SELECT *, regexp_extract(substr(text, 1, start), '[^.;\\n]*$') AS head FROM s)
SELECT doc_id, pattern, start, phrase,
 replace(substr(text, greatest(start - {before}, 0) + 1, start + length(phrase) + {after} - greatest(start - {before}, 0)), chr(10), ' ') AS context
FROM h WHERE NOT regexp_matches(head, '(?i)(^|{WORD})({'|'.join(NEGATORS)})({WORD}|$)')"""


@query(claims_sql())
def claim_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textaudit.claims(table(spark, sf_dir, "documents"), "doc_id", "text", CLAIMS, NEGATORS)


@query(" UNION ALL ".join(
    f"SELECT doc_id, '{n}' AS rule, CAST(len(regexp_extract_all(text, '{p}')) AS INTEGER) AS hits FROM documents" for n, p in HYGIENE.items()))
def hygiene_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textaudit.pattern_counts(table(spark, sf_dir, "documents"), "doc_id", "text", HYGIENE)
