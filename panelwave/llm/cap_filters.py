"""Near-duplicate vectors by spherical-cap filters: list decoding, join on filters, exact verification.

Filter directions form structured random product codes: after a seeded rotation the space is cut in two halves, each
with its own list of random unit codewords, and every pair of codewords is one direction. A vector belongs to all
directions whose inner product exceeds a threshold; they are found by decoding the two lists, not by trying all pairs.
Several codes with their own rotations serve vectors that one code covers thinly. The threshold follows from the caps of
the sphere in the vectors' dimension: pairs at the cosine asked for share 30 filters on average, however many directions
there are, and in 64 dimensions, measured up to 1,024 codewords, under one in a thousand shares none; of closer pairs fewer.
Vectors that share a filter are compared by cosine in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from panelwave.llm.common import forest, sorted_groups, stored, tiled
from panelwave.llm.components import components

#: Vectors of a filter compared within one task at a time; larger groups are dealt over tiles.
GROUP_ROWS = 2048
#: Filters of a vector on average from which on fewer codewords serve.
MOST_FILTERS = 256
PAYLOAD = ["key", "node", "size", "vec", "lower"]
DEALT = "key long, node long, size long, vec binary, lower binary"


@dataclass(frozen=True)
class Code:
    """Codewords per half, filters that two vectors at cosine ``least`` share on average, and the number of codes."""

    words: int
    shared: float = 30.0
    codes: int = 6
    seed: int = 20
    least: float = 0.9

    @classmethod
    def sized(cls, rows: int, occupancy: int = 4, least: float = 0.9) -> Code:
        """So many directions that a filter of fixed size holds as many vectors at every number of rows."""
        half = math.ceil(math.log2(max(1.0, rows / occupancy)) / 2)
        return cls(2 ** min(14, max(4, half)), least=least)


def cap(dim: int, height: np.ndarray) -> np.ndarray:
    """Share of the unit sphere in ``dim`` dimensions whose inner product with a fixed unit vector is ``height`` or more."""
    angle = np.linspace(0, math.pi, 20_001)
    rising = np.sin(angle) ** (dim - 2)
    below = np.concatenate([[0], np.cumsum(rising[1:] + rising[:-1])])
    return np.interp(np.arccos(np.clip(height, -1, 1)), angle, below / below[-1])


@lru_cache(maxsize=256)
def threshold(code: Code, dim: int) -> float:
    """Inner product from which a vector belongs to a filter.

    A direction is a unit vector, turned at random: it exceeds the threshold for both vectors of a pair at cosine
    ``code.least`` with a chance known from the caps of the sphere, and ``code.shared`` directions are to do so.
    """
    if dim < 3:
        # Only four directions a code: the best of each serves.
        return math.inf
    wanted = code.shared / (code.codes * code.words**2)
    c = min(max(code.least, -0.999), 0.999999)

    def both(height: float) -> float:
        angle = np.linspace(0, math.acos(height), 2001)
        x = np.cos(angle)
        rest = math.sqrt(1 - c * c) * np.maximum(np.sin(angle), 1e-300)
        rising = np.sin(angle) ** (dim - 2) * cap(dim - 1, (height - c * x) / rest)
        whole = math.sqrt(math.pi) * math.exp(math.lgamma((dim - 1) / 2) - math.lgamma(dim / 2))
        return float(np.sum(rising[1:] + rising[:-1]) / 2 * (angle[1] - angle[0]) / whole)

    low, high = 0.0, 1.0
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if both(middle) >= wanted else (low, middle)
    return low


@lru_cache(maxsize=32)
def codebook(code: Code, dim: int, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotation and the two codeword lists of the halves of one code; the same in every task."""
    rng = np.random.default_rng([code.seed, number, dim])
    turn, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    half = max(1, dim // 2)
    lists = [rng.standard_normal((code.words, k)) for k in (half, max(1, dim - half))]
    first, second = (w / np.linalg.norm(w, axis=1, keepdims=True) / math.sqrt(2) for w in lists)
    return turn, first, second


@lru_cache(maxsize=256)
def fitted(code: Code, dim: int) -> Code:
    """The code with as many codewords as ``dim`` bears: in few dimensions more directions only part close vectors."""
    while dim > 2 and code.words > 4 and code.codes * code.words**2 * cap(dim, threshold(code, dim)) > MOST_FILTERS:
        code = replace(code, words=code.words // 2)
    return code


def decode(code: Code, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter), ordered, for every filter that a row of unit vectors exceeds; the best of each code belongs."""
    code = fitted(code, unit.shape[1])
    found = [decode_one(code, unit, number) for number in range(code.codes)]
    rows = np.concatenate([r for r, _ in found])
    filters = np.concatenate([f + number * code.words**2 for number, (_, f) in enumerate(found)])
    order = np.lexsort((filters, rows))
    return rows[order], filters[order]


def decode_one(code: Code, unit: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    dim = unit.shape[1]
    turn, first, second = codebook(code, dim, number)
    turned = unit @ turn
    half = first.shape[1]
    left = turned[:, :half] @ first.T
    right = (turned[:, half:] if dim > half else turned[:, :1] * 0) @ second.T
    least = threshold(code, dim)
    order = np.argsort(-right, axis=1)
    falling = np.take_along_axis(right, order, axis=1)
    rows, i = np.nonzero(left >= least - falling[:, :1])
    rank = 0
    found_rows, found = [np.arange(len(unit))], [left.argmax(axis=1) * code.words + order[:, 0]]
    while len(rows) and rank < code.words:
        open_ = left[rows, i] + falling[rows, rank] >= least
        rows, i = rows[open_], i[open_]
        found_rows.append(rows)
        found.append(i * code.words + order[rows, rank])
        rank += 1
    both = np.unique(np.concatenate(found_rows) * code.words**2 + np.concatenate(found))
    return both // code.words**2, both % code.words**2


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; the largest component is taken out first."""
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def verified(
    rows: pd.DataFrame, least: float, kind: str, part: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, the links that this filter counts for each, and the spanning links of all that it holds.

    A pair that shares several filters is counted in its smallest common one only: ``lower`` has a vector's filters
    below this one. ``kind`` is the number format of the vectors' bytes.
    """
    unit = unit_rows(np.frombuffer(b"".join(rows["vec"]), kind).reshape(len(rows), -1))
    nodes, sizes, lower = rows["node"].to_numpy(np.int64), rows["size"].to_numpy(np.int64), rows["lower"].to_numpy()
    return in_group(unit, nodes, sizes, lower, least, part)


def in_group(
    unit: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, lower: np.ndarray, least: float, part: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    close = unit @ unit.T >= least
    np.fill_diagonal(close, False)
    if part is not None:
        close &= part[:, None] != part[None, :]
    used = np.flatnonzero(close.any(axis=1))
    if not len(used):
        return nodes[:0], nodes[:0], np.empty((2, 0), np.int64)
    close = close[np.ix_(used, used)]
    nodes, sizes = nodes[used], sizes[used]
    lists = [np.frombuffer(f, "<i4") for f in lower[used]]
    owner = np.repeat(np.arange(len(used)), [len(x) for x in lists])
    names, column = np.unique(np.concatenate(lists), return_inverse=True)
    shared = np.zeros((len(used), max(1, len(names))), np.float32)
    shared[owner, column] = 1
    counted = close & (shared @ shared.T == 0)
    a, b = np.nonzero(np.triu(close))
    return nodes, counted @ sizes, np.stack(forest(nodes[a], nodes[b]))


def answers(nodes: np.ndarray, n: np.ndarray, links: np.ndarray) -> pd.DataFrame:
    """Rows (a, NULL, n) with counts of nodes and rows (a, b, 0) with links."""
    counts = pd.DataFrame({"a": nodes[n > 0], "b": None, "n": n[n > 0]}).astype({"b": "Int64"})
    return pd.concat([counts, pd.DataFrame({"a": links[0], "b": links[1], "n": 0}).astype({"b": "Int64"})])


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.9,
    code: Code | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per input row: the id, ``n_links`` (other rows linked directly), ``component_id``, ``kept``.

    Rows link when their cosine is at least ``least``. A vector that is NULL, empty, zero or has a NULL or non-finite
    component links with nothing; vectors of different lengths do not link. Equal vectors are compared once and counted
    each. An empty table gives no rows. Pairs are missed only if they share no filter.
    """
    e = F.col(vector_col)
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = e.isNotNull() & ~bad & F.exists(e, lambda x: x != 0)
    rows = vectors.select(
        F.col(id_col).alias("id"), F.when(usable, F.transform(e, lambda x: x.cast("double") + 0)).alias("vec")
    )
    classes = rows.where("vec is not null").groupBy("vec").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least_id"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    chosen = code or Code.sized(classes.count(), least=least)
    single = vectors.schema[vector_col].dataType == ArrayType(FloatType(), True)
    kind = "<f4" if single else "<f8"

    def filtered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, same in batch.groupby(batch["vec"].map(len)):
                for begin in range(0, len(same), 256):
                    some = same.iloc[begin : begin + 256]
                    x = np.stack(some["vec"].to_numpy())
                    row, filters = decode(chosen, unit_rows(x))
                    begins = np.searchsorted(row, np.arange(len(some)))
                    local = filters.astype("<i4")
                    lower = [local[begins[r] : k].tobytes() for k, r in enumerate(row)]
                    out = pd.DataFrame({"node": some["node"].to_numpy(), "size": some["size"].to_numpy()})
                    out = out.assign(vec=[v.tobytes() for v in x.astype(kind)]).iloc[row]
                    yield out.assign(lower=lower, key=filters + (int(dim) << 32))[PAYLOAD]

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for extent, rows in sorted_groups(batches, ["key"], group_rows):
            if extent == "large":
                yield rows.assign(a=None, b=None, n=None)
                continue
            key = rows["key"].to_numpy()
            begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            ends = np.append(begins[1:], len(key))
            nodes, sizes, lower = rows["node"].to_numpy(np.int64), rows["size"].to_numpy(np.int64), rows["lower"].to_numpy()
            vectors = rows["vec"].to_numpy()
            found = []
            for s, e in zip(begins[ends - begins > 1], ends[ends - begins > 1], strict=True):
                unit = unit_rows(np.frombuffer(b"".join(vectors[s:e]), kind).reshape(e - s, -1))
                out = in_group(unit, nodes[s:e], sizes[s:e], lower[s:e], least)
                if len(out[0]):
                    found.append(out)
            if found:
                counted, n, links = zip(*found, strict=True)
                out = answers(np.concatenate(counted), np.concatenate(n), np.concatenate(links, axis=1))
                yield out.assign(**dict.fromkeys(PAYLOAD))

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = ["key", "tile_i", "tile_j"]
        for _, rows in sorted_groups(batches, keys, 1 << 40):
            for (_, i, j), tile in rows.groupby(keys):
                yield answers(*verified(tile, least, kind, None if i == j else tile["part"].to_numpy()))

    dealt = classes.select("node", "size", "vec").mapInPandas(filtered, DEALT)
    first = stored(dealt.repartition("key").sortWithinPartitions("key").mapInPandas(inside, DEALT + ", a long, b long, n long"), "filter-links")
    order = ["key", "tile_i", "tile_j"]
    large = first.where("key is not null").select(*PAYLOAD)
    tiles = tiled(large, "key", "node", group_rows).repartition(*order).sortWithinPartitions(*order)
    second = stored(tiles.mapInPandas(across, "a long, b long, n long"), "tile-links")
    found = first.where("key is null").select("a", "b", "n").union(second)

    linked = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = components(found.where("b is not null"), "a", "b")
    placed = classes.join(linked, "node", "left").join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    heads = placed.groupBy("root").agg(F.min("least_id").alias("component"))
    known = placed.join(heads, "root").select("vec", "component", (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n"))
    out = rows.join(known, "vec", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
