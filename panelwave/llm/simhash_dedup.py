"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming verification, components.

Words are the runs outside ASCII white space of the text with A-Z in lower case; shingles are ``width`` words joined by
one space, repeats included; a shorter text is one shingle, a text without words has fingerprint zero. A NULL text is
empty, a NULL id stays a row of its own. Equal fingerprints (and so repeated rows) are one node of the search.

``first_of_similar``, the pipeline's stage, then compares the rows that stay by sets of five-word shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwave.llm.common import forest, fresh, sorted_groups, stored, tiled, whole_text
from panelwave.llm.components import components

BITS = 64
RADIUS = 4
#: Two fingerprints at 4 or fewer differing bits agree on at least 3 of 7 blocks.
BLOCKS = 7
#: Rows of a block value compared within one task at a time; larger groups are dealt over tiles.
GROUP_ROWS = 2048
SHINGLES_AT_ONCE = 1 << 16
#: MinHash bands and the values of a band: two texts at similarity 0.8 agree in no band once in 14,000 pairs.
BANDS, BAND = 24, 5
#: Bytes of the shingle sets that one task compares with each other.
PART_BYTES = 8 << 20


def shingle_hashes(text: str | None, width: int, seed: int = 42) -> Iterator[bytes]:
    """Big-endian 64-bit hashes of the shingles of one text, up to ``SHINGLES_AT_ONCE`` in one piece."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(width, len(words))
    starts, ends = starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist()
    digest = xxhash.xxh64_digest
    for k in range(0, len(starts), SHINGLES_AT_ONCE):
        some = zip(starts[k : k + SHINGLES_AT_ONCE], ends[k : k + SHINGLES_AT_ONCE], strict=True)
        yield b"".join([digest(line[a:b], seed) for a, b in some])


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of one text."""
    counts = np.zeros(BITS, np.int64)
    n = 0
    for piece in shingle_hashes(text, width, seed):
        hashes = np.frombuffer(piece, np.uint8)
        counts += np.unpackbits(hashes).reshape(-1, BITS).sum(axis=0, dtype=np.int32)
        n += len(piece) // 8
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = 4) -> DataFrame:
    """``id``, ``th`` (hash of the text) and ``fp`` (the fingerprint's bits as a long) of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps.view(np.int64))], ["id", "th", "fp"])

    text = whole_text(text_col)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    return source.mapInArrow(rows, "id long, th long, fp long")


def block_keys(fp: str) -> Column:
    """One key for every choice of 3 of the 7 blocks: the choice in the top bits, the blocks' bits below."""
    edges = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - RADIUS)):
        value = F.lit(number).cast("long")
        for b in chosen:
            width = edges[b + 1] - edges[b]
            bits = F.shiftrightunsigned(F.col(fp), edges[b]).bitwiseAND(F.lit((1 << width) - 1))
            value = F.shiftleft(value, width).bitwiseOR(bits)
        keys.append(value)
    return F.array(*keys)


def near(fps: np.ndarray, key: np.ndarray, radius: int, part: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the pairs with equal key (sorted) at ``radius`` or fewer differing bits."""
    bits = fps.view(np.uint64)
    at = np.arange(len(key))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step = held = 0
    while True:
        step += 1
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            break
        close = np.bitwise_count(bits[at] ^ bits[at + step]) <= radius
        if part is not None:
            close &= part[at] != part[at + step]
        if close.any():
            found.append((fps[at[close]], fps[at[close] + step]))
            held += int(close.sum())
            if held > 500_000:
                found = [forest(*map(np.concatenate, zip(*found, strict=True)))]
                held = len(found[0][0])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(*map(np.concatenate, zip(*found, strict=True)))


def links(nodes: DataFrame, fp: str = "fp", radius: int = RADIUS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints that join all pairs within ``radius``, without listing them.

    Every fingerprint is dealt to 35 block keys. A task compares the fingerprints of a key pairwise and keeps a spanning
    forest. The rows of a key held by more than ``group_rows`` fingerprints pass on to tiles that share the pairs.
    """
    if radius > RADIUS:
        raise ValueError(f"the blocks guarantee pairs at {RADIUS} or fewer differing bits")

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for extent, rows in sorted_groups(batches, ["key"], group_rows):
            if extent == "large":
                yield pd.DataFrame({"key": rows["key"], "a": rows["fp"], "b": None}).astype({"b": "Int64"})
            else:
                a, b = near(rows["fp"].to_numpy(np.int64), rows["key"].to_numpy(np.int64), radius)
                yield pd.DataFrame({"key": None, "a": a, "b": b}).astype({"key": "Int64"})

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = ["key", "tile_i", "tile_j"]
        for _, rows in sorted_groups(batches, keys, 1 << 40):
            for (_, i, j), tile in rows.groupby(keys):
                part = None if i == j else tile["part"].to_numpy()
                a, b = near(tile["fp"].to_numpy(np.int64), np.zeros(len(tile), np.int64), radius, part)
                yield pd.DataFrame({"a": a, "b": b})

    dealt = nodes.select(F.explode(block_keys(fp)).alias("key"), F.col(fp).alias("fp"))
    first = dealt.repartition("key").sortWithinPartitions("key").mapInPandas(inside, "key long, a long, b long")
    first = stored(first, "simhash-links")
    large = first.where("key is not null").select("key", F.col("a").alias("fp"))
    tiles = tiled(large, "key", "fp", group_rows).select("key", "tile_i", "tile_j", "part", "fp")
    order = ["key", "tile_i", "tile_j"]
    second = tiles.repartition(*order).sortWithinPartitions(*order).mapInPandas(across, "a long, b long")
    return first.where("key is null").select("a", "b").union(second)


def grouped(docs: DataFrame, id_col: str, text_col: str, width: int = 4, radius: int = RADIUS) -> DataFrame:
    """``id``, ``th`` (hash of the text), ``fp``, ``root`` (a fingerprint of the group) and ``component_id`` of every row."""
    prints = stored(fingerprints(docs, id_col, text_col, width), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-nodes")
    roots = components(links(nodes, "fp", radius), "a", "b")
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return prints.join(placed.join(heads, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = RADIUS
) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable.

    An empty table gives no rows; NULL ids take part in no minimum.
    """
    return grouped(docs, id_col, text_col, width, radius).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, all columns: a row with the smallest id of the group.

    Of several rows with that id the one with the smallest hash of its text stays, of equal ones any. NULL ids come last.
    """
    groups = stored(grouped(docs, id_col, text_col), "simhash-groups")
    rows = groups.groupBy("root", "id", "th").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th", "n")).alias("h"))
    of_id, of_text, times = fresh(docs, "_id", "_text", "_times")
    heads = stored(first.select(F.col("h.id").alias(of_id), F.col("h.th").alias(of_text), F.col("h.n").alias(times)), "simhash-heads")
    same = docs[id_col].cast("long").eqNullSafe(heads[of_id]) & (F.xxhash64(whole_text(text_col)) == heads[of_text])
    chosen = docs.join(heads, same)
    repeated = chosen.where(F.col(times) > 1).dropDuplicates([of_id, of_text])
    return chosen.where(F.col(times) == 1).union(repeated).select(*docs.columns)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct shingle hashes of one text, ordered."""
    return np.unique(np.frombuffer(b"".join(shingle_hashes(text, width)), ">u8").astype(np.uint64))


def band_keys(shingles: np.ndarray, seed: int = 42) -> np.ndarray:
    """One key for each band of MinHash values of a set that is not empty."""
    rng = np.random.default_rng(seed)
    times, plus = rng.integers(0, 1 << 64, (2, BANDS * BAND, 1), np.uint64)
    least = np.full(BANDS * BAND, np.iinfo(np.uint64).max)
    for k in range(0, len(shingles), 4096):
        least = np.minimum(least, ((times | np.uint64(1)) * shingles[k : k + 4096] + plus).min(axis=1))
    weights = rng.integers(0, 1 << 64, (BANDS, BAND), np.uint64) | np.uint64(1)
    return (least.reshape(BANDS, BAND) * weights).sum(axis=1, dtype=np.uint64).view(np.int64)


def similar_sets(sets: list[np.ndarray], roots: list[int], least: float, parts: list[int] | None = None) -> list[tuple[int, int]]:
    """Spanning links (places in ``sets``) of the pairs at Jaccard similarity ``least`` or more.

    Sets with the same root are joined already. Pairs of sets of one part are left out. A set is compared with the sets
    of a group until one is similar, so a group of mutual copies costs one comparison a set.
    """
    groups: dict[int, list[int]] = {}
    of = {}
    found = []
    for x in range(len(sets)):
        own = of.setdefault(roots[x], roots[x])
        while of[own] != own:
            own = of[own]
        for other in [g for g in groups if g != own]:
            for y in groups[other]:
                small, large = sorted((len(sets[x]), len(sets[y])))
                if small < least * large or (parts is not None and parts[x] == parts[y]):
                    continue
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if common >= least * (small + large - common):
                    found.append((x, y))
                    groups.setdefault(own, []).extend(groups.pop(other))
                    of[other] = own
                    break
        groups.setdefault(own, []).append(x)
    return found


def compared(rows: DataFrame, sets: DataFrame, least: float, tiles: bool = False) -> DataFrame:
    """Spanning links ``a``, ``b`` between similar nodes of a (key, part), or of a tile of two parts.

    ``rows`` has ``key``, ``part``, ``node``, ``root`` and, with ``tiles``, ``tile_i`` and ``tile_j``; each node's set is
    sent once to each of its groups and verified there.
    """
    keys = ["key", "tile_i", "tile_j"] if tiles else ["key", "part"]

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, some in sorted_groups(batches, keys, 1 << 40):
            for name, group in some.groupby(keys):
                node = group["node"].to_numpy(np.int64)
                parts = group["part"].tolist() if tiles and name[1] != name[2] else None
                pairs = similar_sets(list(group["own"]), group["root"].tolist(), least, parts)
                x, y = np.array(pairs, np.int64).reshape(-1, 2).T
                yield pd.DataFrame({"a": node[x], "b": node[y]})

    known = rows.join(sets, "node").select(*dict.fromkeys([*keys, "part"]), "node", "root", "own")
    return known.repartition(*keys).sortWithinPartitions(*keys, "node").mapInPandas(inside, "a long, b long")


def open_keys(members: DataFrame, roots: DataFrame, part_bytes: int) -> DataFrame:
    """The members of keys that still hold several groups of joined nodes (``root``), with their group and part of the key.

    A key is cut into ``parts`` so that the sets of a part have about ``part_bytes``.
    """
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = placed.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("other"), F.ceil(F.sum("n") * 8 / part_bytes).cast("int").alias("parts"))
    sizes = stored(sizes.where("one < other").select("key", "parts"), "open-keys")
    return placed.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))


def similar_groups(
    docs: DataFrame, text_col: str = "text", width: int = 5, least: float = 0.8, part_bytes: int = PART_BYTES, distinct: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Links ``a``, ``b`` between hashes of different texts that join all texts whose shingle sets have Jaccard similarity
    ``least`` or more and agree in a band, without listing the pairs; and the components they make, ``node`` and ``root``.

    Equal sets are one node. The first two bands come first: what they join needs no comparison in the other bands, where
    only keys with several components are looked into. A key whose sets outgrow a task is cut into parts, compared part
    by part; then one node of each component of the key; and, if components remain, tiles of two parts. ``distinct`` says
    that no two rows have the same text, which saves the steps that would find them.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for th, text in zip(batch.column(0), batch.column(1), strict=True):
                own = shingle_set(text.as_py(), width)
                if len(own):
                    rows.append((th.as_py(), xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63), len(own), band_keys(own)))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["th", "sh", "n", "keys"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), width).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "own"])

    types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    text = whole_text(text_col)
    source = docs.select(F.xxhash64(text).alias("th"), text.alias("text"))
    signed = stored(source.mapInArrow(keys, "th long, sh long, n long, keys array<long>"), "minhash-keys")
    nodes = signed.groupBy("sh").agg(F.min("th").alias("node"))
    named = signed.join(nodes, "sh")
    equal = named.where("th <> node").select(F.col("th").alias("a"), F.col("node").alias("b"))
    once = named.where("th = node")
    once = once if distinct else once.dropDuplicates(["node"])
    each = once.select("node", "n", F.posexplode("keys").alias("band", "key"))
    each = stored(each, "minhash-bands")
    repeated = each.groupBy("key").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1").select("key")
    members = stored(each.join(stored(repeated, "repeated-bands"), "key", "left_semi"), "band-members")
    wanted = stored(members.select(F.col("node").alias("th")).distinct(), "set-nodes")
    chosen = source.join(wanted, "th", "left_semi")
    chosen = chosen if distinct else chosen.dropDuplicates(["th"])
    known = stored(chosen.mapInArrow(sets, "node long, own array<long>"), "shingle-sets")

    roots = docs.sparkSession.createDataFrame([], "node long, root long")
    links = [stored(equal, "equal-sets")]

    def joined(more: DataFrame, whole: bool = False) -> DataFrame:
        """Each linked node with its component or, unless ``whole``, its least neighbour: nodes with the same are joined."""
        links.append(stored(more, "similar-links"))
        every = reduce(DataFrame.union, links)
        if whole:
            return stored(components(every, "a", "b"), "similar-roots")
        both = every.union(every.select("b", "a"))
        return stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "similar-roots")

    for bands in (members.where("band < 2"), members):
        opened = open_keys(bands, roots, part_bytes)
        roots = joined(compared(opened, known, least))
    if not opened.where("parts > 1").isEmpty():
        hot = stored(opened.where("parts > 1").select("key", "node", "n"), "large-bands")
        roots = stored(components(reduce(DataFrame.union, links), "a", "b"), "similar-roots")
        opened = open_keys(hot, roots, part_bytes)
        one = opened.groupBy("key", "root").agg(F.min("node").alias("node")).withColumn("part", F.lit(0))
        one = one.join(hot, ["key", "node"])
        roots = joined(compared(open_keys(one.select("key", "node", "n"), roots, part_bytes), known, least), whole=True)
        opened = open_keys(hot, roots, part_bytes)
        both = opened.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        both = both.withColumn("tile_i", F.least("part", "tile")).withColumn("tile_j", F.greatest("part", "tile"))
        joined(compared(both, known, least, tiles=True))
    every = reduce(DataFrame.union, links)
    return every, components(every, "a", "b")


def first_of_similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: float = 0.8
) -> DataFrame:
    """Rows of ``first_of_each``, of which no two texts are at shingle similarity ``least`` or more; all columns.

    Of the texts that links join, the one with the smallest id stays; NULL ids come last.
    """
    once = stored(first_of_each(docs, id_col, text_col), "first-of-each")
    roots = similar_groups(once, text_col, width, least, distinct=True)[1].toDF("th", "root")
    named = once.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(whole_text(text_col)).alias("th"))
    placed = stored(named.join(roots, "th"), "similar-groups")
    heads = placed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("h"))
    later = placed.join(heads, "root").where("th <> h.th").select(F.col("th").alias(of_text := fresh(docs, "_text")[0]))
    later = stored(later, "similar-later")
    return once.join(later, F.xxhash64(whole_text(text_col)) == later[of_text], "left_anti")
