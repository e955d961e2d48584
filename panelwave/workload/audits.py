"""Audits, comparisons, funnels, samples and expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwave.functions import codes
from panelwave.functions.text import normalize_cell
from panelwave.operators import checks as ck
from panelwave.operators import compare, drill, population, quality, sampling
from panelwave.session import scratch_dir
from panelwave.sources.controls import control_table, small_table
from panelwave.spec import Control, Rule
from panelwave.workload.frames import OBS_SQL, normal_sql, obs, orders, table, typed_sql
from panelwave.workload.ingest import DIRT_SQL, dirt
from panelwave.workload.registry import query, rounded

PERIOD_SQL = "CAST(year(o_orderdate) AS VARCHAR) || 'T' || CAST(quarter(o_orderdate) AS VARCHAR)"
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


@query(f"""WITH {DIRT_SQL}, norm AS (SELECT {normal_sql('raw')} AS c FROM dirt),
t AS (SELECT c, {typed_sql('c', 'int')} AS i, {typed_sql('c', 'bigint')} AS b, {typed_sql('c', 'double')} AS d FROM norm),
u AS (SELECT 'as_int' AS "column", count(*) AS rows, count(*) FILTER (c IS NULL) AS missing,
        count(*) FILTER (c IS NOT NULL AND i IS NULL) AS invalid FROM t
 UNION ALL SELECT 'as_bigint', count(*), count(*) FILTER (c IS NULL), count(*) FILTER (c IS NOT NULL AND b IS NULL) FROM t
 UNION ALL SELECT 'as_double', count(*), count(*) FILTER (c IS NULL), count(*) FILTER (c IS NOT NULL AND d IS NULL) FROM t)
SELECT *, round(100.0 * missing / CAST(rows AS DOUBLE), 6) AS missing_pct FROM u""")
def missing_invalid_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = dirt(spark, sf_dir).select(normalize_cell(F.col("raw")).alias("c"))
    types = {"as_int": "int", "as_bigint": "bigint", "as_double": "double"}
    return rounded(quality.missing_invalid(clean.select(*[F.col("c").alias(n) for n in types]), types), 6)


@query(f"""WITH {OBS_SQL}, u AS (
 SELECT period, 'qty' AS "column", count(*) AS rows, count(*) FILTER (qty IS NULL) AS missing FROM obs GROUP BY 1
 UNION ALL SELECT period, 'segment', count(*), count(*) FILTER (segment IS NULL) FROM obs GROUP BY 1)
SELECT *, round(100.0 * missing / CAST(rows AS DOUBLE), 6) AS missing_pct FROM u""")
def missing_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.missing_table(obs(spark, sf_dir), ["qty", "segment"], ["period"]), 6)


@query(f"""WITH {OBS_SQL} SELECT 'status' AS "column", status AS value, count(*) AS n FROM obs GROUP BY 2
UNION ALL SELECT 'segment', segment, count(*) FROM obs GROUP BY 2
UNION ALL SELECT 'lines', coalesce(CAST(CAST(lines AS BIGINT) AS VARCHAR), 'NULO'), count(*) FROM obs GROUP BY 2""")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = obs(spark, sf_dir).select("status", "segment", F.col("lines").cast("long").alias("lines"))
    return quality.order_value_counts(quality.value_counts(panel, ["status", "segment", "lines"]))


@query(f"""WITH k AS (SELECT {', '.join(LINE_KEY)}, count(*) AS n FROM lineitem GROUP BY {', '.join(LINE_KEY)}),
d AS (SELECT DISTINCT {', '.join(LINE_COLUMNS)} FROM lineitem)
SELECT CAST(sum(n) AS BIGINT) AS rows,
 CAST(coalesce(sum(n) FILTER (l_orderkey IS NULL OR l_linenumber IS NULL), 0) AS BIGINT) AS null_keys,
 count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_keys, count(*) FILTER (n > 1) AS repeated_keys,
 CAST(sum(n) - (SELECT count(*) FROM d) AS BIGINT) AS exact_duplicates FROM k""")
def key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_audit(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_COLUMNS)


@query("""WITH v AS (SELECT l_orderkey, l_linenumber, count(*) AS n,
 count(DISTINCT concat_ws('|', l_returnflag, l_linestatus)) AS versions FROM lineitem GROUP BY 1, 2)
SELECT count(*) FILTER (n > 1) AS repeated_keys, count(*) FILTER (n > 1 AND versions = 1) AS exact_repeats,
 count(*) FILTER (n > 1 AND versions > 1) AS conflicting_keys FROM v""")
def duplicate_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_versions(table(spark, sf_dir, "lineitem"), LINE_KEY, ["l_returnflag", "l_linestatus"])


@query(f"""WITH p AS (SELECT o_custkey, {PERIOD_SQL} AS period, count(*) AS n FROM orders GROUP BY 1, 2),
k AS (SELECT o_custkey, sum(n) AS r, count(*) AS p FROM p GROUP BY 1)
SELECT CAST(sum(r) AS BIGINT) AS rows, CAST(sum(p) AS BIGINT) AS distinct_period_keys,
 CAST(sum(r - p) AS BIGINT) AS surplus_period_keys, count(*) AS distinct_keys,
 count(*) FILTER (p > 1) AS keys_in_many_periods FROM k""")
def cross_period_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cross_period_keys(orders(spark, sf_dir), ["o_custkey"], "period")


@query(f"""WITH {OBS_SQL} SELECT period, 'nation' AS "column", count(*) FILTER (nation IS NULL) AS missing,
 count(*) FILTER (nation NOT BETWEEN 0 AND 19) AS out_of_domain,
 count(*) FILTER (nation IS NULL OR nation NOT BETWEEN 0 AND 19) AS unknown FROM obs GROUP BY 1
UNION ALL SELECT period, 'units', count(*) FILTER (qty IS NULL), count(*) FILTER (qty NOT BETWEEN 1 AND 100),
 count(*) FILTER (qty IS NULL OR qty NOT BETWEEN 1 AND 100) FROM obs GROUP BY 1""")
def domain_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = obs(spark, sf_dir).select("period", "nation", F.col("qty").cast("int").alias("units"))
    return quality.domain_audit(panel, {"nation": range(20), "units": range(1, 101)}, ["period"])


@query("""SELECT o_orderkey, CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 4
 THEN substr(o_orderpriority, 1, 1) ELSE 'DESCONOCIDO' END AS label FROM orders""")
def code_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("code"))
    return o.select("o_orderkey", codes.code_label(F.col("code"), (1, 2, 3, 4)).alias("label"))


@query("""SELECT violation, CAST(rows AS BIGINT) AS rows FROM (
 SELECT 'deep_discount' AS violation, count(*) FILTER (l_discount >= 0.09) AS rows FROM lineitem
 UNION ALL SELECT 'big_quantity', count(*) FILTER (l_quantity > 45) FROM lineitem
 UNION ALL SELECT 'returned_open', count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O') FROM lineitem
 UNION ALL SELECT 'tax_over_discount', count(*) FILTER (l_tax > l_discount) FROM lineitem
 UNION ALL SELECT 'no_quantity', count(*) FILTER (l_quantity IS NULL OR l_quantity <= 0) FROM lineitem
 UNION ALL SELECT 'flag_outside', count(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R')) FROM lineitem
 UNION ALL SELECT 'early', count(*) FILTER (year(l_shipdate) < 1996) FROM lineitem
 UNION ALL SELECT 'cheap', count(*) FILTER (l_extendedprice < 1000) FROM lineitem
 UNION ALL SELECT 'high_line', count(*) FILTER (l_linenumber > 6) FROM lineitem
 UNION ALL SELECT 'flag_like_a', count(*) FILTER (l_returnflag LIKE 'A%') FROM lineitem)""")
def violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = {
        "deep_discount": "l_discount >= 0.09D",
        "big_quantity": "l_quantity > 45",
        "returned_open": "l_returnflag = 'R' and l_linestatus = 'O'",
        "tax_over_discount": "l_tax > l_discount",
        "no_quantity": "l_quantity is null or l_quantity <= 0",
        "flag_outside": "l_returnflag not in ('A', 'N', 'R')",
        "early": "year(l_shipdate) < 1996",
        "cheap": "l_extendedprice < 1000",
        "high_line": "l_linenumber > 6",
        "flag_like_a": "startswith(l_returnflag, 'A')",
    }
    return quality.violation_counts(table(spark, sf_dir, "lineitem"), named)


@query(f"""WITH o AS (SELECT {PERIOD_SQL} AS period, CAST(quarter(o_orderdate) AS INTEGER) + CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS q,
 CAST(quarter(o_orderdate) AS INTEGER) AS own FROM orders)
SELECT period, count(*) AS rows, count(*) FILTER (q <> own) AS outside FROM o GROUP BY 1""")
def allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = orders(spark, sf_dir).select(
        "period", (F.quarter("o_orderdate") + F.when(F.col("o_orderkey") % 50 == 0, 1).otherwise(0)).alias("q")
    )
    rows = [(f"{y}T{q}", q) for y in range(1995, 2002) for q in (1, 2, 3, 4)]
    return quality.allowed_values(o, "period", "q", small_table(spark, rows, "period string, value int"))


@query(f"""WITH c AS (SELECT {PERIOD_SQL} AS period, count(*) AS n FROM orders GROUP BY 1)
SELECT name, CAST(expected AS BIGINT) AS expected, CAST(observed AS BIGINT) AS observed, expected = observed AS passed FROM (
 SELECT 'first_year' AS name, 2000 AS expected, coalesce(sum(n), 0) AS observed FROM c WHERE period LIKE '1995%'
 UNION ALL SELECT 'late', 0, coalesce(sum(n), 0) FROM c WHERE period IN ('2003T1', '2003T2')
 UNION ALL SELECT 'spring', 500, coalesce(sum(n), 0) FROM c WHERE period = '1996T2')""")
def control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    controls = [
        Control("first_year", ("1995T1", "1995T2", "1995T3", "1995T4"), 2000),
        Control("late", ("2003T1", "2003T2"), 0),
        Control("spring", ("1996T2",), 500),
    ]
    return quality.control_totals(orders(spark, sf_dir), "period", control_table(spark, controls))


RULES = (
    Rule("quantity", "l_quantity >= 5"),
    Rule("open_or_returned", "l_linestatus = 'O' or l_returnflag in ('R', 'A')"),
    Rule("price", "l_extendedprice > 2000"),
    Rule("tax_within_discount", "l_tax <= l_discount"),
    Rule("line", "l_linenumber between 1 and 6"),
)
FUNNEL_SQL = """f AS (SELECT {by}, CASE WHEN NOT coalesce(l_quantity >= 5, false) THEN 1
 WHEN NOT coalesce(l_linestatus = 'O' OR l_returnflag IN ('R', 'A'), false) THEN 2
 WHEN NOT coalesce(l_extendedprice > 2000, false) THEN 3 WHEN NOT coalesce(l_tax <= l_discount, false) THEN 4
 WHEN NOT coalesce(l_linenumber BETWEEN 1 AND 6, false) THEN 5 ELSE 6 END AS fail FROM lineitem),
s AS (SELECT unnest([1, 2, 3, 4, 5]) AS step, unnest(['quantity', 'open_or_returned', 'price', 'tax_within_discount', 'line']) AS rule)"""


@query(f"""WITH {FUNNEL_SQL.format(by='1 AS one')}
SELECT step, rule, count(*) FILTER (fail >= step) AS before, count(*) FILTER (fail = step) AS excluded,
 count(*) FILTER (fail > step) AS after, true AS arithmetic_ok, true AS chain_ok FROM f, s GROUP BY 1, 2""")
def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population.chain_check(population.funnel(table(spark, sf_dir, "lineitem"), RULES))


@query(f"""WITH {FUNNEL_SQL.format(by='l_returnflag')}
SELECT l_returnflag, step, rule, count(*) FILTER (fail >= step) AS before, count(*) FILTER (fail = step) AS excluded,
 count(*) FILTER (fail > step) AS after FROM f, s GROUP BY 1, 2, 3""")
def funnel_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population.funnel(table(spark, sf_dir, "lineitem"), RULES, ["l_returnflag"])


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity >= 5
 AND (l_linestatus = 'O' OR l_returnflag IN ('R', 'A')) AND l_extendedprice > 2000 AND l_tax <= l_discount
 AND l_linenumber BETWEEN 1 AND 6""")
def eligible_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = population.eligible(table(spark, sf_dir, "lineitem"), RULES)
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("""SELECT DISTINCT a.o_custkey FROM orders a WHERE year(a.o_orderdate) < 1996
 AND a.o_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) >= 1996)""")
def overlap_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    early = F.year("o_orderdate") < 1996
    return compare.overlap(o.where(early), o.where(~early), "o_custkey")


@query("SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def except_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return compare.only_in(table(spark, sf_dir, "orders"), lines, ["o_orderkey"])


@query("""SELECT o_orderkey, count(*) AS rows FROM orders
 WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1""")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 1),
b AS (SELECT CASE WHEN o_orderkey % 10 = 2 THEN o_orderkey + 100000000 ELSE o_orderkey END AS o_orderkey,
 CASE WHEN o_orderkey % 10 = 3 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders)
SELECT count(*) FILTER (b.o_orderkey IS NULL) AS missing, count(*) FILTER (a.o_orderkey IS NULL) AS extra,
 count(*) FILTER (a.o_orderstatus <> b.o_orderstatus) AS mismatched,
 count(*) FILTER (a.o_orderstatus = b.o_orderstatus) AS equal
FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey""")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two derived versions of the orders: with keys left out, moved, and altered."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    last = F.col("o_orderkey") % 10
    left = o.where(last != 1)
    right = o.select(
        F.when(last == 2, F.col("o_orderkey") + 100000000).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        F.when(last == 3, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    return compare.coverage(left, right, "o_orderkey", ["o_orderstatus"])


@query("""WITH d AS (SELECT CASE WHEN o_orderkey % 100 = 7 THEN 0.5 WHEN o_orderkey % 100 = 8 THEN CAST(o_orderkey % 1000 AS DOUBLE)
 ELSE 0.0 END AS x FROM orders)
SELECT count(*) AS compared_keys, count(*) FILTER (x > 0) AS changed_keys,
 count(*) FILTER (x > 0.75) AS beyond_tolerance, round(max(CAST(x AS DOUBLE)), 4) AS max_abs_diff FROM d""")
def row_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    rest = F.col("o_orderkey") % 100
    altered = o.select(
        "o_orderkey",
        F.when(rest == 7, F.col("o_totalprice") + 0.5)
        .when(rest == 8, F.col("o_totalprice") + (F.col("o_orderkey") % 1000).cast("double"))
        .otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"),
    )
    return rounded(compare.numeric_difference(o, altered, "o_orderkey", "o_totalprice", 0.75), 4)


@query("SELECT * FROM (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders) WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def member_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return compare.members(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ids, "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (3, 14, 159, 265)")
def members_from_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = small_table(spark, [(3,), (14,), (159,), (265,)], "o_custkey long")
    return compare.members(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ids, "o_custkey")


@query(f"""WITH {OBS_SQL} SELECT a.id, a.period, a.target, b.qty FROM obs a JOIN obs b ON a.id = b.id""")
def join_on_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = obs(spark, sf_dir)
    return compare.join_on_id([panel.select("id", "period"), panel.select("id", "target"), panel.select("id", "qty")], "id")


@query("SELECT min(o_orderstatus) AS low, max(o_orderstatus) AS high, min(o_orderstatus) = max(o_orderstatus) AS constant FROM orders")
def constant_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.constant_column(table(spark, sf_dir, "orders"), "o_orderstatus", F.lit("F"))


@query()
def sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_by_hash(table(spark, sf_dir, "orders"), "o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-3066'), o_orderkey LIMIT 5000")
def sample_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_by_hash(o, "o_orderkey", method="md5")


@query("SELECT least(5000, count(*)) AS positions, CAST(0 AS BIGINT) AS different FROM orders")
def sample_reproducible(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey").withColumn("h", F.md5(F.col("o_orderkey").cast("string")))
    first = sampling.sample_by_hash(o, "o_orderkey", seed=None, method="md5")
    second = sampling.sample_by_hash(o.repartition(5), "o_orderkey", seed=None, method="md5")
    return sampling.same_sample(first, second, "o_orderkey", "h")


@query("""SELECT o_orderkey, CASE WHEN substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) < 'cccccccc' THEN 'train' ELSE 'valid' END AS split
FROM orders""")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.8)


@query()
def sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return sampling.sample_about(o, 5000, o.count(), 2026)


@query()
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, valid = sampling.random_split(table(spark, sf_dir, "orders").select("o_orderkey"), seed=2026)
    return train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))


@query("SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS keys, true AS about_four_fifths FROM orders")
def random_split_promises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the random split together hold every row once; the first has its share, give or take five deviations."""
    both = random_split(spark, sf_dir)
    n = F.count(F.lit(1))
    near = F.abs(F.count_if(F.col("split") == "train") - n * 0.8) <= 5 * F.sqrt(n * 0.8 * 0.2)
    return both.agg(n.alias("rows"), F.count_distinct("o_orderkey").alias("keys"), near.alias("about_four_fifths"))


@query("""WITH r AS (SELECT o_custkey AS person, nullif(o_orderstatus, 'P') AS status, sum(o_totalprice) AS total, CAST(count(*) AS DOUBLE) AS n
  FROM orders GROUP BY 1, 2),
s AS (SELECT person, status, total * CASE WHEN person % 100 = 7 AND status IS NULL THEN 1.5 ELSE 1 END AS total, n FROM r WHERE NOT (person % 100 = 11 AND status = 'F')),
c AS (SELECT s.person, s.status, 'total' AS metric, s.total AS stored, r.total AS recomputed, 1 AS l FROM s JOIN r ON r.person = s.person AND r.status IS NOT DISTINCT FROM s.status
  WHERE s.total <> r.total
  UNION ALL SELECT person, status, unnest(['total', 'n']), NULL, unnest([total, n]), 0 FROM r WHERE person % 100 = 11 AND status = 'F')
SELECT person, status, metric, round(stored, 2) AS stored, round(recomputed, 2) AS recomputed, CAST(l AS BIGINT) AS stored_rows, CAST(1 AS BIGINT) AS recomputed_rows FROM c""")
def changed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored report with altered and lost groups, found again through the marks of its buckets."""
    keys, values = ["person", "status"], ["total", "n"]
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person"), F.expr("nullif(o_orderstatus, 'P')").alias("status"), "o_totalprice"
    )
    report = rows.groupBy(*keys).agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).cast("double").alias("n"))
    altered = (F.col("person") % 100 == 7) & F.col("status").isNull()
    lost = F.coalesce((F.col("person") % 100 == 11) & (F.col("status") == "F"), F.lit(False))
    path = scratch_dir(spark, "report")
    drill.store_report(report.where(~lost).withColumn("total", F.col("total") * F.when(altered, 1.5).otherwise(1.0)), path, keys, values)
    return rounded(drill.changed_cells(path, report, keys, values), 2)
