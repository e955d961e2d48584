"""Stored assignments next to their panel, both laid out by record id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwave.operators import checks, segments
from panelwave.session import scratch_dir
from panelwave.sources.keyed import KeyedStage, difference, store_keyed
from panelwave.workload.modelling import ASSIGNED_SQL, _assigned
from panelwave.workload.registry import query

# What a damaged copy lost, gained and holds wrong; valid in both engines.
COPIES = "CASE WHEN id % 101 = 0 THEN 0 WHEN id % 103 = 0 THEN 3 ELSE 1 END"
RENAMED = "CASE WHEN id % 107 = 0 THEN -id WHEN id % 113 = 0 THEN NULL ELSE id END"
MOVED = "CASE WHEN id % 109 = 0 THEN (cluster + 1) % 3 WHEN id % 127 = 0 THEN NULL ELSE cluster END"


def _stages(spark: SparkSession, sf_dir: str) -> tuple[KeyedStage, KeyedStage]:
    """Assignments as computed, and the damaged copy of them."""
    path = scratch_dir(spark, "assigned")
    right = store_keyed(_assigned(spark, sf_dir).select("id", "cluster"), f"{path}/right", "id")
    copies = F.expr(f"explode(array_repeat(0, {COPIES}))").alias("copy")
    damaged = right.rows.select("id", "cluster", copies).selectExpr(f"{RENAMED} AS id", f"CAST({MOVED} AS INT) AS cluster")
    return right, store_keyed(damaged, f"{path}/damaged", "id", right.buckets)


DAMAGED_SQL = f"""{ASSIGNED_SQL},
damaged AS (SELECT {RENAMED} AS id, {MOVED} AS cluster FROM (SELECT *, unnest(range({COPIES})) AS copy FROM assigned)),
l AS (SELECT id, count(*) AS n, min(cluster) AS a, max(cluster) AS b, count(cluster) AS c FROM damaged WHERE id IS NOT NULL GROUP BY id),
r AS (SELECT id, 1 AS n, cluster FROM assigned),
x AS (SELECT l.n AS ln, r.n AS rn, l.n = r.n AND l.a IS NOT DISTINCT FROM r.cluster AND l.b IS NOT DISTINCT FROM r.cluster AND l.c = 1 AS same
  FROM l FULL JOIN r ON l.id = r.id)"""


@query(f"""WITH {DAMAGED_SQL} SELECT CAST(sum(ln) AS BIGINT) AS rows, CAST(sum(rn) AS BIGINT) AS right_rows, count(*) FILTER (ln > 1) AS repeated,
 count(*) FILTER (rn IS NULL) AS orphans, count(*) FILTER (ln IS NULL) AS missing,
 count(*) FILTER (ln > 0 AND rn > 0 AND NOT same) AS changed, count(*) FILTER (ln > 0 AND rn > 0 AND same) AS equal,
 (SELECT count(*) FROM damaged WHERE id IS NULL) AS keyless FROM x""")
def keyed_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A damaged copy of the assignments against the assignments: every kind of damage is counted."""
    right, damaged = _stages(spark, sf_dir)
    return difference(damaged, right, "cluster")


@query(f"""WITH {DAMAGED_SQL},
s AS (SELECT cluster, count(*) AS n FROM damaged GROUP BY 1), t AS (SELECT cluster, count(*) AS n FROM assigned GROUP BY 1),
o AS (SELECT 'assigned repeated' AS "check", count(*) FILTER (ln > 1) AS observed, 0 AS expected FROM x
 UNION ALL SELECT 'assigned orphans', count(*) FILTER (rn IS NULL), 0 FROM x UNION ALL SELECT 'assigned missing', count(*) FILTER (ln IS NULL), 0 FROM x
 UNION ALL SELECT 'assigned keyless', count(*), 0 FROM damaged WHERE id IS NULL
 UNION ALL SELECT coalesce('size of ' || coalesce(s.cluster, t.cluster), 'size of no group'), coalesce(s.n, 0), coalesce(t.n, 0)
  FROM s FULL JOIN t ON s.cluster IS NOT DISTINCT FROM t.cluster),
w AS (SELECT 'damaged' AS suite, * FROM o UNION ALL SELECT 'right', 'assigned ' || unnest(['repeated', 'orphans', 'missing', 'keyless']), 0, 0
 UNION ALL SELECT 'right', 'size of ' || cluster, n, n FROM t)
SELECT suite, "check", 'error' AS severity, CAST(observed AS DOUBLE) AS observed, CAST(expected AS DOUBLE) AS expected, observed = expected AS passed FROM w""")
def assignment_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique, complete and of the reported sizes: true of the assignments, untrue of the damaged copy."""
    right, damaged = _stages(spark, sf_dir)
    sizes = segments.cluster_sizes(_assigned(spark, sf_dir)).select("cluster", F.col("n").alias("rows"))
    parts = [checks.assignment_checks(suite, stage, right, "cluster", sizes) for suite, stage in (("right", right), ("damaged", damaged))]
    return parts[0].unionByName(parts[1])
