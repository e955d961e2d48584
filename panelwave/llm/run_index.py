"""Removal of long repeated byte strings, found by a run-length compressed suffix index.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in another text or the same one.
Texts are UTF-8 bytes, matches never cross texts, and every place of a repeated string is removed, the first included.

Routing. Each window of ``length`` bytes has an anchor: the rightmost least hash of its ``GRAM``-byte grams, a function of
the window alone. So two equal windows lie at the same offset to anchors with the same key. A region is what the windows
with one anchor cover; equal regions are one node, and a node with several places matches itself. Only keys with several
nodes go further: the regions of a key meet in one task.

Index. A task concatenates the regions of some keys, sorts the suffixes, and keeps the Burrows-Wheeler transform as runs
with the text positions at both ends of every run. A suffix inside a run follows its left neighbour in the text and in the
order, so its longest match is one shorter; only run boundaries need a comparison of texts. Streaming the samples in text
order therefore yields, for every position, the longest match with another place (the matching statistics of the regions
against themselves), and all positions at ``length`` or more are marked.

Hot keys. A key with more than ``GROUP_NODES`` nodes is split: its windows are parted by their offset to the anchor, the
parts are keyed by the bytes that all windows of a part share, and a part has a shorter region. Parts narrow down to one
window, where equal keys are equal regions, so no group grows without end and no place is left out.

NULL texts are empty; empty texts and those below ``length`` stay whole. NULL ids and repeated rows stay rows of their own
(copies of a long text are removed wholly). An empty table gives no rows; other columns are not read. Hashes of 128 bits
name a text, and of 64 bits a region below its 64-bit key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwave.llm.common import stored, whole_text

LENGTH = 400
#: Bytes of an anchor's gram, a power of two; the larger, the fewer chance meetings, the more regions.
GRAM = 64
#: Window starts whose anchors are searched at a time.
STARTS_AT_ONCE = 1 << 20
#: Bytes of regions in one index, and regions of one key that enter it together; both bound the memory of a task.
INDEX_BYTES = 256 << 10
GROUP_NODES = 1024
#: A 63-bit word holds so many symbols of 9 bits.
SYMBOLS = 7

#: a, b: the range of the region in its text.
ANCHORS = "th binary, p int, a int, b int, key long, rh long"
#: lo, hi: least and greatest start of a window less the anchor's place p; first: place of the region's first byte;
#: many: the region has several places; nodes: distinct regions of the key.
REGIONS = "key long, rh long, lo int, hi int, th binary, p int, first int, region binary, many boolean, nodes long"
MARKS = "th binary, a int, b int"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """A 64-bit hash of every gram of ``gram`` bytes (a power of two, 8 at least), by doubling."""
    out = mixed(np.ndarray((len(data) - 7,), "<u8", data, 0, (1,)).copy())
    width = 8
    while width < gram:
        out = mixed(out[:-width] * np.uint64(0xD6E8FEB86659FD93) + out[width:])
        width *= 2
    return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    step = 1
    out = values
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows of ``length`` bytes, in each the rightmost of the least gram hashes: place, key, and the
    range of bytes that the windows with this anchor cover. They are neighbours, so each window is in one range.
    """
    width = length - gram + 1
    found = [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
    for begin in range(0, len(data) - length + 1, STARTS_AT_ONCE):
        part = data[begin : begin + STARTS_AT_ONCE + length - 1]
        hashes = gram_hashes(part, gram)
        least = sliding_least(hashes, width)
        newest = np.flatnonzero(hashes[width - 1 :] == least)  # windows whose last gram is the anchor
        # Between them a window needs a search when the anchor before it has left.
        until = np.append(newest, len(least))
        since = np.append([0], newest + width)
        first, place = [], []
        for j, stop in zip(since[since < until].tolist(), until[since < until].tolist(), strict=True):
            while j < stop:
                first.append(j)
                j += width - int(np.argmax(hashes[j : j + width][::-1] == least[j]))
                place.append(j - 1)
        first = np.concatenate([newest, np.array(first, np.int64)])
        place = np.concatenate([newest + width - 1, np.array(place, np.int64)])
        by = np.argsort(first)
        first, place = first[by], place[by]
        found.append((place + begin, hashes[place], first + begin, np.append(first[1:], len(least)) + begin + length - 1))
    places, keys, begins, ends = (np.concatenate(c) for c in zip(*found, strict=True))
    return places, keys, begins, ends


class RunIndex:
    """Run-length Burrows-Wheeler transform of some regions, with the text positions at both ends of each run.

    ``symbols``, ``lengths``: the runs (0 separates regions and never joins a run). ``heads``, ``tails``: text positions
    of the first and last suffix of each run. The text is kept for comparisons at run boundaries.
    """

    def __init__(self, regions: list[bytes]):
        sizes = np.array([len(r) for r in regions], np.int64)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        text = np.zeros(int(sizes.sum()) + len(regions), np.int64)
        inside = np.ones(len(text), bool)
        inside[self.starts + sizes] = False
        text[inside] = np.frombuffer(b"".join(regions), np.uint8).astype(np.int64) + 1
        self.owner = np.repeat(np.arange(len(regions)), sizes + 1)
        self.left = (self.starts + sizes)[self.owner] - np.arange(len(text))  # symbols up to the separator
        self.words = self._words(text)
        order = self._suffixes()
        before = text[order - 1]  # position 0 has the last separator before it
        change = np.ones(len(order), bool)
        change[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        first = np.flatnonzero(change)
        self.symbols, self.lengths = before[first], np.diff(np.append(first, len(order)))
        self.heads, self.tails = order[first], order[np.append(first[1:], len(order)) - 1]

    def _words(self, text: np.ndarray) -> np.ndarray:
        """The next symbols of each position, packed; none from beyond the separator."""
        words = np.zeros(len(text), np.int64)
        for k in range(SYMBOLS):
            words <<= 9
            words[: len(text) - k] |= np.where(self.left[: len(text) - k] >= k, text[k:], 0)
        return words

    def _suffixes(self) -> np.ndarray:
        """All suffixes in order, by prefix doubling of those not yet told apart; separators rank by their place."""
        n = len(self.words)
        order = np.argsort(self.words)
        words, ends = self.words[order], np.flatnonzero(self.left[order] < SYMBOLS)
        # Words that reach a separator equal only each other, and follow the order of their regions.
        order[ends] = order[ends][np.lexsort((order[ends], words[ends]))]
        fresh = np.ones(n, bool)
        fresh[1:] = words[1:] != words[:-1]
        fresh[ends] = True
        order = order.astype(np.int32)
        rank = np.empty(n, np.int32)
        slots = np.arange(n, dtype=np.int32)
        rank[order] = np.maximum.accumulate(np.where(fresh, slots, 0))
        depth = SYMBOLS
        while True:
            alone = fresh.copy()
            alone[:-1] &= fresh[1:]
            slots = slots[~alone]
            if not len(slots):
                return order.astype(np.int64)
            some = order[slots]
            pair = (rank[some].astype(np.int64) << 32) | rank[np.minimum(some + depth, n - 1)]
            by = np.argsort(pair, kind="stable")
            some, pair = some[by], pair[by]
            fresh = np.ones(len(some), bool)
            fresh[1:] = pair[1:] != pair[:-1]
            order[slots] = some
            rank[some] = np.maximum.accumulate(np.where(fresh, slots, 0))
            depth *= 2

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``x`` and ``y``, within their regions."""
        most = np.minimum(self.left[x], self.left[y])
        out = most.copy()
        active = np.flatnonzero(most > 0)
        off = 0
        while len(active):
            differ = self.words[x[active] + off] ^ self.words[y[active] + off]
            ends = differ != 0
            if ends.any():
                bits = np.frexp(differ[ends].astype(np.float64))[1]  # position of the highest bit, at most one too high
                bits -= (differ[ends] >> np.minimum(bits - 1, 62)) == 0
                equal = SYMBOLS - (bits + 8) // 9
                out[active[ends]] = np.minimum(off + equal, most[active[ends]])
            active = active[~ends]
            off += SYMBOLS
            active = active[most[active] > off]
        return out

    def statistics(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Matching statistics as streams, for the neighbour before and the one behind: position, the neighbour's position,
        match length, and how far the stream runs; ``t`` positions on, the match is ``t`` shorter.
        """
        x, y = self.tails[:-1], self.heads[1:]
        match = self.common(x, y)
        for at, other, none in ((y, x, self.heads[:1]), (x, y, self.tails[-1:])):
            place = np.concatenate([none, at])
            by = np.argsort(place)
            place = place[by]
            reach = np.diff(np.append(place, len(self.owner)))
            yield place, np.concatenate([none, other])[by], np.concatenate([[0], match])[by], reach


def marks_of(regions: list[bytes], th: list[bytes], first: np.ndarray, many: np.ndarray, length: int):
    """Ranges (th, from, to) of the regions' texts in which strings of ``length`` bytes start that other places hold too.

    Regions that stand for several places count as partners only; their ranges are known. A place never matches itself,
    though it may lie in several regions.
    """
    index = RunIndex(regions)
    names = {t: k for k, t in enumerate(dict.fromkeys(th))}
    text_of = np.array([names[t] for t in th])
    for at, other, match, reach in index.statistics():
        long = match >= length
        at, other, match, reach = at[long], other[long], match[long], reach[long]
        own, of = index.owner[at], index.owner[other]
        a, b = first[own] + at - index.starts[own], first[of] + other - index.starts[of]
        same = (text_of[own] == text_of[of]) & (a == b) & ~many[of]
        new = ~same & ~many[own]
        stop = a + np.minimum(reach, match - length + 1) - 1 + length
        yield [th[k] for k in own[new]], a[new], stop[new]


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """The anchors of all texts: the text's hash, the anchor's place and key, range and hash of its region."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for th, text in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_py()
                every = anchors(data, length)
                for k in range(0, len(every[0]), 1 << 16):
                    places, keys, begins, ends = (c[k : k + (1 << 16)] for c in every)
                    ranges = zip(begins.tolist(), ends.tolist(), strict=True)
                    hashes = np.array([xxhash.xxh64_intdigest(data[a:b]) for a, b in ranges], np.uint64)
                    columns = [pa.array([th.as_py()] * len(places), pa.binary())]
                    columns += [pa.array(c.astype(np.int32)) for c in (places, begins, ends)]
                    columns += [pa.array(c.view(np.int64)) for c in (keys, hashes)]
                    yield pa.RecordBatch.from_arrays(columns, ["th", "p", "a", "b", "key", "rh"])

    return docs.where(F.octet_length("text") >= length).select("th", F.col("text").cast("binary").alias("text")).mapInArrow(rows, ANCHORS)


def region_rows(texts: DataFrame, length: int) -> DataFrame:
    """The wanted regions cut out of their texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in region_schema.names}
            for th, text, wanted in zip(*batch.columns, strict=True):
                data = text.as_py()
                for w in wanted.as_py():
                    cells = (w["key"], w["rh"], GRAM - length, 0, th.as_py(), w["p"], w["a"], data[w["a"] : w["b"]], w["many"], w["nodes"])
                    for name, cell in zip(out, cells, strict=True):
                        out[name].append(cell)
            yield pa.RecordBatch.from_pydict(out, schema=region_schema)

    return texts.where("size(wanted) > 0").select("th", "text", "wanted").mapInArrow(rows, REGIONS)


region_schema = pa.schema([
    ("key", pa.int64()), ("rh", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("th", pa.binary()),
    ("p", pa.int32()), ("first", pa.int32()), ("region", pa.binary()), ("many", pa.bool_()), ("nodes", pa.int64()),
])


def index_marks(regions: DataFrame, length: int) -> DataFrame:
    """Marks of keys that fit into an index; whole keys are packed up to ``INDEX_BYTES``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def emptied() -> Iterator[pa.RecordBatch]:
            _, th, first, region, many = zip(*held, strict=True)
            for names, a, b in marks_of(region, th, np.array(first, np.int64), np.array(many, bool), length):
                columns = [pa.array(names, pa.binary()), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["th", "a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= INDEX_BYTES and row[0] != held[-1][0]:
                    yield from emptied()
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) + 1
        if held:
            yield from emptied()

    chosen = regions.select("key", "th", "first", "region", "many")
    return chosen.repartition("key").sortWithinPartitions("key").mapInArrow(rows, MARKS)


def narrower(regions: DataFrame, length: int) -> DataFrame:
    """Each region parted by the offset of its windows to the anchor, keyed by the bytes that a part's windows share."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in region_schema.names}
            for row in batch.to_pylist():
                p, begin, data, middle = row["p"], row["first"], row["region"], (row["lo"] + row["hi"]) // 2
                for lo, hi in ((row["lo"], middle), (middle + 1, row["hi"])):
                    a, b = max(p + lo, begin), min(p + hi + length, begin + len(data))
                    if lo > hi or b - a < length:
                        continue
                    shared = data[p + hi - begin if p + hi - begin < len(data) else 0 : p + lo + length - begin]
                    part = data[a - begin : b - begin]
                    seed = (lo - GRAM + length) * length + hi - GRAM + length
                    key = xxhash.xxh64_intdigest(shared, seed) ^ (row["key"] & 0xFFFFFFFFFFFFFFFF)
                    signed = [v - (1 << 64) if v >> 63 else v for v in (key, xxhash.xxh64_intdigest(part))]
                    for name, cell in zip(out, (*signed, lo, hi, row["th"], p, a, part, row["many"], 0), strict=True):
                        out[name].append(cell)
            yield pa.RecordBatch.from_pydict(out, schema=region_schema)

    return regions.select(*region_schema.names).mapInArrow(rows, REGIONS)


def region_marks(regions: DataFrame, length: int = LENGTH, group_nodes: int = GROUP_NODES) -> DataFrame:
    """Marks (th, a, b) from regions that are distinct within each key; keys above ``group_nodes`` are split until they fit."""
    marks = []
    while True:
        regions = stored(regions, "regions")
        marks.append(index_marks(regions.where(F.col("nodes") <= group_nodes), length))
        hot = regions.where(F.col("nodes") > group_nodes)
        if hot.isEmpty():
            break
        parts = stored(narrower(hot, length), "narrow-regions")
        nodes = parts.groupBy("key", "rh").agg(F.count(F.lit(1)).alias("places"), F.max("many").alias("held_many"), F.min(F.struct("th", "p")).alias("one"))
        nodes = stored(nodes, "narrow-nodes")
        named = parts.join(nodes, ["key", "rh"])
        again = named.where("places > 1 and not many")
        marks.append(again.select("th", F.col("first").alias("a"), (F.col("first") + F.octet_length("region")).alias("b")))
        one = named.where("th = one.th and p = one.p").withColumn("many", F.col("held_many") | (F.col("places") > 1))
        sizes = stored(nodes.groupBy("key").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1"), "key-sizes")
        regions = one.drop("nodes").join(sizes, "key").select(*region_schema.names)
    out = marks[0]
    for more in marks[1:]:
        out = out.union(more)
    return out


def removed(text: bytes, ranges: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs of them, and the rest of ``text`` without the ranges (rows of from, to)."""
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    new = np.append([True], ranges[1:, 0] > reach[:-1])
    begins = ranges[new, 0]
    ends = reach[np.append(np.flatnonzero(new)[1:], len(ranges)) - 1]
    kept = b"".join([text[a:b] for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(text)], strict=True)])
    return len(text) - len(kept), len(begins), kept


def cut_texts(marked: DataFrame, keep_text: bool) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for th, text, ranges in zip(*batch.columns, strict=True):
                pairs = np.array([(r["a"], r["b"]) for r in ranges.as_py()], np.int64)
                n, spans, kept = removed(text.as_py(), pairs)
                out.append((th.as_py(), n, spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["th", "n_removed", "n_spans", "kept_sha256", "kept"]
    types = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return marked.select("th", "text", "ranges").mapInArrow(rows, "th binary, n_removed long, n_spans long, kept_sha256 string, kept binary")


def without_long_matches(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    keep_text: bool = False, group_nodes: int = GROUP_NODES,
) -> DataFrame:
    """One row per document: the id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and, if
    asked for, ``kept``, the bytes that stay.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    text = whole_text(text_col)
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("th"), text.alias("text"))
    found = stored(anchor_rows(named, length), "anchors")
    repeated = found.groupBy("key").agg(F.count(F.lit(1)).alias("places")).where("places > 1").select("key")
    places = stored(found.join(stored(repeated, "repeated-keys"), "key", "left_semi"), "repeated-anchors")
    nodes = places.groupBy("key", "rh").agg(F.count(F.lit(1)).alias("places"), F.min(F.struct("th", "p", "a", "b")).alias("one"))
    nodes = stored(nodes.select("key", "rh", "places", "one.*"), "region-nodes")
    # Regions with several places are marked whole; keys with several regions are looked into.
    several = stored(nodes.where("places > 1").select("key", "rh"), "repeated-regions")
    several = places.join(several, ["key", "rh"]).select("th", "a", "b")
    mixed_keys = nodes.groupBy("key").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
    wanted = nodes.join(stored(mixed_keys, "mixed-keys"), "key")
    wanted = wanted.select("th", F.struct("p", "a", "b", "key", "rh", (F.col("places") > 1).alias("many"), "nodes").alias("w"))
    wanted = wanted.withColumn("r", F.lit(None).cast("struct<a:int,b:int>"))
    whole = several.distinct().select("th", F.lit(None).cast(wanted.schema["w"].dataType).alias("w"), F.struct("a", "b").alias("r"))
    needs = wanted.union(whole).groupBy("th").agg(F.collect_list("w").alias("wanted"), F.collect_list("r").alias("ranges"))
    long_texts = named.where(F.octet_length("text") >= length)
    texts = long_texts.groupBy("th").agg(F.first(F.col("text").cast("binary")).alias("text")).join(needs, "th")
    texts = stored(texts, "texts-with-repeats")
    marks = region_marks(region_rows(texts, length), length, group_nodes)
    more = marks.distinct().groupBy("th").agg(F.collect_list(F.struct("a", "b")).alias("more"))
    marked = texts.select("th", "text", "ranges").join(more, "th", "left")
    marked = marked.withColumn("ranges", F.concat("ranges", F.coalesce("more", F.array().cast("array<struct<a:int,b:int>>"))))
    cut = cut_texts(marked.where("size(ranges) > 0"), keep_text)
    cut = stored(cut if keep_text else cut.drop("kept"), "cut-texts")
    own = named.select(
        "id", "th", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("own"),
        *([F.col("text").cast("binary").alias("whole")] if keep_text else []),
    )
    none = F.lit(0).cast("long")
    out = own.join(cut, "th", "left").select(
        F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept_sha256", "own").alias("kept_sha256"),
        *([F.coalesce("kept", "whole").alias("kept")] if keep_text else []),
    )
    return out
