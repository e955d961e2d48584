"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Words are the runs outside ASCII white space of the lower-case text, shingles five words (a shorter text is one
shingle). The similarity of an item and a window is the weight of the shingles they share, each weighing its number of
occurrences, over the weight of the item. Everything runs as DataFrame expressions.

A window that reaches the similarity holds shingles of the item. Moved right to the first of them it shares no less, so
only windows that begin there, or end with the document, are tried: that loses nothing. Windows then need enough item
shingles inside their borders to reach the similarity; the rest cannot pass either. Fingerprints of the windows meet the
item's in blocks: two that differ in at most RADIUS bits agree on one of RADIUS + 1 blocks. The shared weight is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwave.llm.common import fresh, stored, whole_text, words_of

WIDTH = 5
SIMILARITY = 0.8
BITS = 64
#: Windows at the similarity differ from their item in some 13 of 64 bits, with a deviation of about 3.
RADIUS = 28
#: Rows of the benchmark's shingles, or of windows, up to which they are sent to all tasks (some 40 bytes each).
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if its counted rows allow it; otherwise Spark shuffles."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def shingle_rows(df: DataFrame, words: str, widths: tuple[int, ...]) -> DataFrame:
    """Explodes ``words`` to ``pos`` and ``h``, the hash of every run of as many words as one of ``widths``."""
    rest = [c for c in df.columns if c != words]

    def runs(width: int) -> DataFrame:
        several = F.size(words) - (width - 1)
        columns = [F.slice(F.col(words), F.lit(k + 1), several).alias(f"w{k}") for k in range(width)]
        each = df.where(F.size(words) >= width).select(*rest, F.posexplode(F.arrays_zip(*columns)).alias("pos", "w"))
        return each.select(*rest, "pos", F.xxhash64(*[f"w.w{k}" for k in range(width)]).alias("h"))

    return reduce(DataFrame.union, map(runs, widths))


def own_shingles(df: DataFrame, words: str, width: int) -> DataFrame:
    """``pos`` and ``h`` of all shingles of ``words``; up to ``width`` words are one shingle.

    The hash of an array is that of its elements in turn, so ``h`` equals that of ``shingle_rows``.
    """
    last = F.greatest(F.size(words) - (width - 1), F.lit(1))
    each = F.transform(F.sequence(F.lit(1), last), lambda k: F.xxhash64(F.slice(words, k, width)))
    rest = [c for c in df.columns if c != words]
    return df.where(F.size(words) > 0).select(*rest, F.posexplode(each).alias("pos", "h"))


def simhash(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``fp`` for each key: a bit is 1 if it is set in over half the weight ``c`` of the hashes ``h``."""
    sums = [F.sum(F.when(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1)) == 1, F.col("c")).otherwise(-F.col("c"))).alias(f"b{b}") for b in range(BITS)]
    bit = [F.when(F.col(f"b{b}") > 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")) for b in range(BITS)]
    return rows.groupBy(*keys).agg(*sums).select(*keys, reduce(Column.bitwiseOR, bit).alias("fp"))


def blocks(fp: str, radius: int) -> Column:
    """Array of (block number, bits of the block) for ``radius`` + 1 blocks."""
    edges = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    parts = [
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned(F.col(fp), edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1).cast("long")).alias("value"),
        )
        for i in range(radius + 1)
    ]
    return F.array(*parts)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """The best window of every document and item at ``similarity`` or more: ``id_col``, ``item_col``, ``start``
    (words before the window), ``similarity``.

    NULL and empty texts, and items without words, match nothing; rows with a NULL id count as one document per text;
    repeated rows count once. An empty table gives no rows. Ties go to the earliest window.
    """
    items = benchmark.select(F.col(item_col).alias("item"), words_of(F.lower(whole_text(item_text_col))).alias("w"))
    items = items.where(F.size("w") > 0).distinct().withColumn("item_words", F.size("w"))
    item_shingles = own_shingles(items, "w", width).groupBy("item", "item_words", "h").agg(F.count(F.lit(1)).alias("c"))
    item_shingles = stored(item_shingles, "item-shingles")
    wanted = item_shingles.select("item", "item_words", "h")
    n_wanted = wanted.count()
    short = [r[0] for r in wanted.where(F.col("item_words") < width).select("item_words").distinct().collect()]

    text = F.lower(whole_text(text_col))
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), words_of(text).alias("w"))
    keyed = keyed.withColumn("doc_words", F.size("w"))
    met = shingle_rows(keyed, "w", (width, *sorted(short))).join(bounded(wanted, n_wanted), "h")
    anchors = stored(met.select("id", "th", "doc_words", "item", "item_words", "pos", "h").distinct(), "anchors")

    pair = ["id", "th", "item", "item_words"]
    same_pair = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in pair])
    whole = F.greatest(F.col("item_words") - (width - 1), F.lit(1))
    need = F.greatest(F.ceil(whole * similarity - 1e-9), F.lit(1)).cast("int")
    ranked = anchors.withColumn("rn", F.row_number().over(W.partitionBy(*pair).orderBy("pos")))
    begin = F.least(F.col("pos"), F.greatest(F.col("doc_words") - F.col("item_words"), F.lit(0)))
    starts = ranked.withColumn("start", begin).groupBy(*pair, "start").agg(F.min("rn").alias("rn"))
    starts = starts.withColumn("at", F.col("rn") + need - 1).withColumn("last", F.col("start") + whole - 1)
    full = starts.alias("s").join(ranked.alias("r"), same_pair("s", "r") & (F.col("s.at") == F.col("r.rn")) & (F.col("r.pos") <= F.col("s.last")))
    windows = stored(full.select(*[f"s.{c}" for c in pair], "s.start"), "windows")
    n_windows = windows.count()

    inside = keyed.alias("k").join(
        bounded(windows, n_windows).alias("v"), F.col("k.id").eqNullSafe(F.col("v.id")) & (F.col("k.th") == F.col("v.th"))
    )
    cut = inside.select(
        "v.id", "v.th", "v.item", "v.item_words", "v.start", F.slice("k.w", F.col("v.start") + 1, F.col("v.item_words")).alias("w")
    ).distinct()
    window = [*pair, "start"]
    content = own_shingles(cut, "w", width).groupBy(*window, "h").agg(F.count(F.lit(1)).alias("c"))
    content = stored(content, "window-shingles")
    prints = simhash(content, window)
    item_prints = simhash(item_shingles, ["item"])
    left = prints.select(*window, "fp", F.explode(blocks("fp", radius)).alias("b"))
    right = item_prints.select(F.col("item").alias("of"), F.col("fp").alias("item_fp"), F.explode(blocks("fp", radius)).alias("ib"))
    on = F.col("item").eqNullSafe(F.col("of")) & (F.col("b.block") == F.col("ib.block")) & (F.col("b.value") == F.col("ib.value"))
    candidates = left.join(right, on).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select(*window).distinct()

    same_window = reduce(lambda x, y: x & y, [F.col(f"c.{c}").eqNullSafe(F.col(f"n.{c}")) for c in window])
    held = candidates.alias("c").join(content.alias("n"), same_window).select(*[f"n.{c}" for c in window], "n.h", "n.c")
    on = F.col("held.item").eqNullSafe(F.col("i.item")) & (F.col("held.h") == F.col("i.h"))
    shared = held.alias("held").join(item_shingles.alias("i"), on).groupBy(*[F.col(f"held.{c}").alias(c) for c in window])
    shared = shared.agg(F.sum(F.least("held.c", "i.c")).alias("shared"))
    sure = shared.withColumn("similarity", F.col("shared") / F.greatest(F.col("item_words") - (width - 1), F.lit(1)))
    sure = sure.where(F.col("similarity") >= similarity)
    best = F.max_by(F.struct("similarity", "start"), F.struct("similarity", -F.col("start"))).alias("best")
    out = sure.groupBy("id", "th", "item").agg(best)
    return out.select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("best.start").cast("long").alias("start"),
        F.col("best.similarity").alias("similarity"), F.col("th").alias("text_hash"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that match no item."""
    hits = contaminated(docs, benchmark, id_col, text_col, **options)
    of_id, of_text = fresh(docs, "_id", "_text")
    hits = stored(hits.select(F.col(id_col).alias(of_id), F.col("text_hash").alias(of_text)).distinct(), "leaks")
    hits = bounded(hits, hits.count())
    on = F.col(id_col).eqNullSafe(F.col(of_id)) & (F.xxhash64(F.lower(whole_text(text_col))) == F.col(of_text))
    return docs.join(hits, on, "left_anti")
