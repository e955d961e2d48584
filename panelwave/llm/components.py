"""Connected components of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwave.llm.common import forest, stored

#: Links that one task joins at a time; bounds its memory.
CONTRACT = 500_000


def contracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replaces links by stars with the same components, CONTRACT links at a time."""

    def star(held: list[pd.DataFrame]) -> pd.DataFrame:
        both = pd.concat(held)
        u, v = forest(both["u"].to_numpy(np.int64), both["v"].to_numpy(np.int64))
        return pd.DataFrame({"u": u, "v": v})

    held: list[pd.DataFrame] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= CONTRACT:
            yield star(held)
            held, n = [], 0
    if held:
        yield star(held)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Every node of the links (long columns ``a``, ``b``) with ``root``, the smallest node it reaches.

    Links that name the same node twice or hold NULL are left out; no links give no rows. Each round is stored in the
    shared folder. A node with very many links costs partial minima and a join that adaptive execution can split.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} <> {b}")
    edges = stored(edges.mapInPandas(contracted, "u long, v long"), "links")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nearer = small.union(low.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(nearer.mapInPandas(contracted, "u long, v long").distinct(), "links")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select("root", "root").distinct())
