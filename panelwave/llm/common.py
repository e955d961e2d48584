"""Helpers shared by the operators: stored stages, text columns, sorted groups in bounded memory."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a Java pattern.
SPACES = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that the driver and all executors reach.

    It lies in ``spark.checkpoint.dir``; where a session names none, as in a
    local test, in its warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_stages"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: later plans start there, also after a lost executor."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of characters outside ``SPACES``, as an array; empty for an empty text."""
    return F.array_remove(F.split(text, SPACES), "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores added as make it differ from every column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id as text; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def labelled_sample(labels: DataFrame, label: str, id_col: str, training: Column, most: int) -> DataFrame:
    """Up to ``most`` training rows of each label value, those with the smallest hashes of the id; id and label.

    Rows with a NULL id or label are no training rows. Taken for each of the values 0 and 1 by a bounded top-n.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & training)
    known = known.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label")).distinct()
    order = [F.crc32(F.concat(F.lit("sample:"), F.col("id").cast("string")).cast("binary")), F.col("id")]
    parts = [known.where(F.col("label") == value).orderBy(*order).limit(most) for value in (0, 1)]
    return parts[0].union(parts[1])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connected components of the links a-b: every node but the smallest of its component, with that smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        up, vp = parent[a], parent[b]
        open_ = up != vp
        if not open_.any():
            break
        np.minimum.at(parent, np.maximum(up, vp)[open_], np.minimum(up, vp)[open_])
        while not np.array_equal(parent, jump := parent[parent]):
            parent = jump
        a, b = a[open_], b[open_]
    leaf = parent != np.arange(len(nodes))
    return nodes[leaf], nodes[parent[leaf]]


def sorted_groups(
    batches: Iterator[pd.DataFrame], keys: list[str], most: int
) -> Iterator[tuple[str, pd.DataFrame]]:
    """Cuts batches sorted by ``keys`` at group ends: ("whole", rows of complete groups of at most ``most`` rows each)
    or ("large", rows of a larger group). Holds one batch and ``most`` rows at a time.
    """
    rest: pd.DataFrame | None = None
    passing = None  # the key of the large group whose rows are passed through

    def key_at(df: pd.DataFrame, i: int) -> tuple:
        return tuple(df[k].iat[i] for k in keys)

    for batch in batches:
        if not len(batch):
            continue
        df = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        rest = None
        values = [df[k].to_numpy() for k in keys]
        change = np.zeros(len(df), bool)
        change[0] = True
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(change)
        sizes = np.diff(np.append(starts, len(df)))
        if passing is not None and key_at(df, 0) == passing:
            yield "large", df.iloc[: sizes[0]]
            if len(starts) == 1:
                continue
            begin = starts[1]
        else:
            begin = 0
        passing = None
        last = starts[-1]
        over = (sizes > most) & (starts >= begin)
        for s, n in zip(starts[over], sizes[over], strict=True):
            yield "large", df.iloc[s : s + n]
        if over[-1]:
            passing = key_at(df, len(df) - 1)
        elif last >= begin:
            rest = df.iloc[last:]
        keep = np.repeat(~over & (starts >= begin), sizes)
        keep[last:] = False
        if keep.any():
            yield "whole", df[keep]
    if rest is not None and len(rest):
        yield "whole", rest


def tiled(df: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """Deals the rows of large groups over tiles: a group of n rows is split in parts of about ``block`` rows, and tile
    (i, j), i <= j, holds parts i and j, so that every two rows meet in one tile. Adds ``part``, ``tile_i``, ``tile_j``.
    """
    parts = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    dealt = df.join(parts, key).withColumn("part", F.pmod(F.xxhash64(member), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return (
        dealt.withColumn("other", other)
        .withColumn("tile_i", F.least("part", "other"))
        .withColumn("tile_j", F.greatest("part", "other"))
        .drop("other", "parts")
    )


Groups = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
