"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sizes count words. Every source has a target; the mix is cut in blocks of equal words and in shards, and each shard's
quota of blocks per source follows from the highest quotients target / (2 k - 1) over all blocks up to that shard. A
source's documents, laid end to end in a seeded order and repeated, form its blocks; the quotas take them in that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwave.llm.common import fresh, stored, whole_text, words_of

WEIGHTS = (3, 1, 2)
#: Words in a block. Small blocks keep every source near its target.
BLOCK_WORDS = 32
SHARDS = 8
#: Groups of a source's documents by the first bits of their place in the seeded order; sums run over groups first.
GROUPS = 4096


def word_count(text_col: str = "text") -> Column:
    return F.size(words_of(whole_text(text_col))).cast("long")


def seeded(id_col: str, seed: int) -> Column:
    """Place in the seeded order, as hexadecimal text; a NULL id counts as the empty text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``).

    Sources by code point, NULL last, take the weights in turn and share ``share`` times all sizes. A target stops at
    ``most`` times its source; the excess goes to the others by weight. The sources that stop are those with the least
    size per weight, so one pass over that order finds them.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(W.orderBy(F.asc_nulls_last("source"))))
    given = F.array(*map(F.lit, weights))
    ranked = ranked.withColumn("weight", F.element_at(given, F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("double"))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    order = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    below = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(below), F.lit(0.0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))
    ranked = ranked.withColumn("level", left / rest)
    ranked = ranked.withColumn("stops", F.col("cap") <= F.col("level") * F.col("weight"))
    # Past the first source that does not stop the level only falls, so that source has the largest.
    level = F.max(F.when(~F.col("stops"), F.col("level"))).over(everything)
    target = F.when(F.col("stops"), F.col("cap")).otherwise(level * F.col("weight"))
    return ranked.select("source", "source_size", "rank", target.alias("target"))


def quotas(aims: DataFrame, shards: int = SHARDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Blocks that each source gives to each shard: ``rank``, ``shard``, ``blocks`` (whole numbers, 0 or more).

    For the blocks up to a shard's end, seats below a source's rounded share less a margin are certain; the seats around
    it compete by their quotients, ties to the earlier source. The margin covers every deviation: the rounded shares
    miss the total by at most half the number of sources, and a source takes its share of that.
    """
    everything = W.partitionBy(F.lit(0))
    facts = aims.select(
        "rank", "target", F.sum("target").over(everything).alias("total"), F.count(F.lit(1)).over(everything).alias("sources")
    ).where("total > 0")
    facts = facts.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards))))
    facts = facts.withColumn("house", F.round(F.round(F.col("total") / block_words) * F.col("shard") / shards).cast("long"))
    near = F.floor(F.col("house") * F.col("target") / F.col("total") + 0.5)
    margin = F.ceil(F.col("target") / F.col("total") * F.col("sources")) + 2
    facts = facts.withColumn("sure", F.greatest(near - margin, F.lit(0))).withColumn("last", near + margin)
    seats = facts.withColumn("seat", F.explode(F.sequence(F.col("sure") + 1, F.col("last"))))
    quotient = F.col("target") / (2 * F.col("seat") - 1)
    place = F.row_number().over(W.partitionBy("shard").orderBy(quotient.desc(), "rank", "seat"))
    seats = seats.withColumn("place", place).withColumn(
        "open", F.col("house") - F.sum(F.when(F.col("seat") == F.col("sure") + 1, F.col("sure"))).over(W.partitionBy("shard"))
    )
    upto = seats.groupBy("rank", "shard").agg(
        (F.first("sure") + F.count(F.when((F.col("place") <= F.col("open")) & (F.col("target") > 0), 1))).alias("upto")
    )
    earlier = F.coalesce(F.lag("upto").over(W.partitionBy("rank").orderBy("shard")), F.lit(0))
    return upto.select("rank", "shard", (F.col("upto") - earlier).alias("blocks"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    most: int = 2,
    seed: int = 42,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
) -> DataFrame:
    """``id_col``, ``size``, ``source_size``, ``target``, ``taken``, ``shard_words`` for every row.

    ``taken`` counts the words that the selected blocks hold of the row, repeats included, at most ``most`` times its
    size; ``shard_words`` is the part of each shard, in order. NULL texts have size 0; NULL is a source of its own; rows that repeat an id and a text follow each other in
    the order. An empty table gives no rows. Reruns agree.
    """
    rows, bins = laid_out(docs, id_col, text_col, source_col, weights, share, most, seed, block_words, shards)
    return taken_of(rows, bins, most).select(
        F.col("id").alias(id_col), "size", "source_size", "target", "taken", "shard_words", "source", "bin"
    )


def bin_of(id_col: str, seed: int) -> Column:
    return F.conv(F.substring(seeded(id_col, seed), 1, 3), 16, 10).cast("int") % GROUPS


def laid_out(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], share: float, most: int,
    seed: int, block_words: int, shards: int,
) -> tuple[DataFrame, DataFrame]:
    """The rows with their places, and the groups of each source with the words before them and the source's plan."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        seeded(id_col, seed).alias("place"), bin_of(id_col, seed).alias("bin"),
    )
    rows = stored(rows, "mix-sizes")
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    sizes = bins.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    aims = targets(sizes, weights, share, float(most))
    given = quotas(aims, shards, block_words).groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("shard", "blocks"))).alias("given"))
    aims = stored(aims.join(given, "rank", "left"), "mix-targets")
    aims = aims.select("source", "source_size", "target", shard_ends(shards, block_words, most).alias("ends"))
    aims = aims.withColumn("words", F.element_at("ends", -1))
    before = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumn("bin_before", F.coalesce(F.sum("bin_size").over(before), F.lit(0)))
    same = F.col("b.source").eqNullSafe(F.col("a.source"))
    return rows, bins.alias("b").join(aims.alias("a"), same).select(
        "b.*", "a.source_size", "a.target", "a.words", "a.ends"
    )


def shard_ends(shards: int, block_words: int, most: int) -> Column:
    """Words of a source up to the end of each shard: its quotas summed, at most ``most`` times the source."""

    def end(shard: Column) -> Column:
        upto = F.aggregate(F.slice("given", 1, shard), F.lit(0).cast("long"), lambda n, g: n + g["blocks"])
        return F.least(F.coalesce(upto, F.lit(0)) * block_words, F.col("source_size") * most)

    return F.transform(F.sequence(F.lit(1), F.lit(shards)), end)


def taken_of(rows: DataFrame, bins: DataFrame, most: int) -> DataFrame:
    """Adds the plan of its source, ``taken`` and ``shard_words`` to every row of the groups ``bins``.

    The source's seeded order, passed ``most`` times, is cut at the ends of its shards.
    """
    inside = W.partitionBy("source", "bin").orderBy("place", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    on = F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.bin") == F.col("b.bin"))
    plan = ("source_size", "target", "words", "ends", "bin_before")
    placed = rows.alias("r").join(bins.alias("b"), on).select("r.*", *[f"b.{c}" for c in plan])
    begin = F.col("before") + F.col("bin_before")

    def upto(end: Column) -> Column:
        """Words of the row before the place ``end`` of its source's passes."""
        passes = [end - F.col("source_size") * k - begin for k in range(most)]
        return sum((F.least(F.greatest(p, F.lit(0)), F.col("size")) for p in passes), F.lit(0))

    placed = placed.withColumn("taken", upto(F.col("words")))
    cut = F.transform("ends", lambda end, k: upto(end) - F.when(k > 0, upto(F.get("ends", k - 1))).otherwise(0))
    return placed.withColumn("shard_words", cut)


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 42,
    block_words: int = BLOCK_WORDS, shards: int = SHARDS,
) -> DataFrame:
    """The mix as whole documents, all columns: each row as many times as the mix takes its size, to the nearest; rows
    without words once.

    A pass over a source takes its groups up to one that it cuts. Rows of all other groups know their number from the
    plan of their source, one small row; only rows of cut groups are counted one by one. Repeated ids of one source and
    size in a cut group get the same number of copies each, by their mean.
    """
    rows, bins = laid_out(docs, id_col, text_col, source_col, weights, share, most, seed, block_words, shards)
    over = [F.col("words") - F.col("source_size") * k - F.col("bin_before") for k in range(most)]
    whole = [o >= F.col("bin_size") for o in over]
    cut = F.lit(False)
    for o, w in zip(over, whole, strict=True):
        cut = cut | (~w & (o > 0))
    bins = stored(bins.withColumn("cut", cut), "mix-groups")
    plans = bins.groupBy("source").agg(
        F.array(*[F.coalesce(F.max(F.when(w, F.col("bin"))), F.lit(-1)) for w in whole]).alias("upto"),
        F.collect_set(F.when(F.col("cut"), F.col("bin"))).alias("cuts"),
    )
    of_source, upto, cuts, at, of_id, of_size, times, copy = fresh(
        docs, "_source", "_upto", "_cuts", "_bin", "_id", "_size", "_times", "_copy"
    )
    plans = stored(plans.select(F.col("source").alias(of_source), F.col("upto").alias(upto), F.col("cuts").alias(cuts)), "mix-plans")
    dealt = docs.withColumn(at, bin_of(id_col, seed)).join(plans, docs[source_col].eqNullSafe(plans[of_source]))
    inside = F.array_contains(cuts, F.col(at))
    some = F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    number = sum((F.element_at(upto, k + 1) >= F.col(at)).cast("int") for k in range(most))
    number = F.when(F.coalesce(some, F.lit(False)), number).otherwise(1)
    known = dealt.where(~inside).select(*docs.columns, number.alias(times))

    counted = taken_of(rows, bins.where("cut"), most).groupBy(F.col("id").alias(of_id), F.col("source").alias(of_source), F.col("size").alias(of_size))
    share_taken = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(1)
    counted = counted.agg(F.round(F.avg(share_taken)).cast("int").alias(times))
    open_rows = dealt.where(inside).select(*docs.columns)
    on = open_rows[id_col].eqNullSafe(counted[of_id]) & open_rows[source_col].eqNullSafe(counted[of_source])
    met = open_rows.join(counted, on & (word_count(text_col) == counted[of_size])).select(*docs.columns, times)
    kept = known.union(met).where(F.col(times) > 0)
    return kept.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
