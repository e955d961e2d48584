"""Source divergence audit: how far the term shares of a language's sources lie apart, in whole numbers.

A term is a run of ASCII letters and non-ASCII characters, A-Z in lower case. Each language keeps the terms found in at
least ``least_docs`` of its documents. With ``n`` occurrences of a kept term among the ``N`` of a group, a (language,
source), and ``V`` kept terms, the group's share is p = 1 + floor(10^9 (n + 2) / (N + 2V)), and two shares p, q of a term
lie floor((p - q)^2 / (p + q)) apart.

A share depends on its term only through the count, the term's level in the group. So the terms are rows of a one-hot
matrix with a column for each (group, level); the product of that matrix with its own transpose says how many terms are
at level l in one group and at level m in another, which is all that the sum over terms needs. The product is formed in
blocks of terms by parts of groups, its cells are added up over the blocks, and the cells of level 0 follow from margins.

NULL texts, languages and sources are read as empty. Repeated rows count as documents of their own. Groups without terms
and languages that keep none stay in the result, with value 0; an empty table gives no rows. Very long texts are counted
whole; the tallies of a task are passed on whenever they hold ``TALLY_TERMS`` entries. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwave.llm.common import stored, whole_text

#: Bytes of terms in lower case; all other bytes become spaces.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
TALLY_TERMS = 400_000
#: Terms in a block and groups in a part of the matrix: a task holds at most BLOCK_TERMS x 2 GROUP_PART entries at once.
BLOCK_TERMS = 2048
GROUP_PART = 128
#: Columns with this many terms in a block are multiplied as dense matrices, the others entry by entry.
DENSE_TERMS = 32
DENSE_COLUMNS = 2048
PAIRS_AT_ONCE = 1 << 21
LEVELS = "a int, a_level long, b int, b_level long, terms long"


def term_tallies(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences), ``docs`` (documents that hold it), one row per group and term."""

    def tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def emptied() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in counts.items():
                if n:
                    some = [pa.array([v] * len(n)) for v in (lang, source)]
                    rest = [pa.array(list(n), pa.binary()), pa.array(list(n.values())), pa.array([docs[t] for t in n])]
                    yield pa.RecordBatch.from_arrays([*some, *rest], ["lang", "source", "term", "n", "docs"])
            counts.clear()

        for batch in batches:
            groups: dict[tuple[str, str], list[list[bytes]]] = {}
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                groups.setdefault((lang, source), []).append(text.translate(TERM_BYTES).split())
            for group, texts in groups.items():
                n, docs = counts.setdefault(group, (Counter(), Counter()))
                n.update(chain.from_iterable(texts))
                docs.update(chain.from_iterable(map(set, texts)))
            if sum(len(n) for n, _ in counts.values()) >= TALLY_TERMS:
                yield from emptied()
        yield from emptied()

    names = [whole_text(lang_col).alias("lang"), whole_text(source_col).alias("source")]
    source = docs.select(*names, whole_text(text_col).cast("binary").alias("text"))
    partial = source.mapInArrow(tallies, "lang string, source string, term binary, n long, docs long")
    summed = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return summed.withColumn("term", F.col("term").cast("string"))


def dense_cells(term: np.ndarray, column: np.ndarray, left: np.ndarray, right: np.ndarray, terms: int, columns: int):
    """Cells of the product of the one-hot columns ``left`` and ``right`` with each other, block by block.

    Each entry is a number of terms of one block, far below 2^24, so single precision is exact.
    """

    def one_hot(chosen: np.ndarray) -> np.ndarray:
        at = np.full(columns, -1)
        at[chosen] = np.arange(len(chosen))
        held = at[column] >= 0
        matrix = np.zeros((terms, len(chosen)), np.float32)
        matrix[term[held], at[column[held]]] = 1
        return matrix

    for i in range(0, len(left), DENSE_COLUMNS):
        x = one_hot(left[i : i + DENSE_COLUMNS]).T
        for j in range(0, len(right), DENSE_COLUMNS):
            product = x @ one_hot(right[j : j + DENSE_COLUMNS])
            a, b = np.nonzero(product)
            yield left[i + a], right[j + b], product[a, b].astype(np.int64)


def sparse_cells(term: np.ndarray, column: np.ndarray, entries: np.ndarray, terms: int):
    """Cells of the one-hot entries ``entries`` with all entries of the same terms, a bounded number of pairs at a time."""
    order = np.argsort(term, kind="stable")
    ends = np.cumsum(np.bincount(term, minlength=terms))
    sizes = np.diff(ends, prepend=0)[term[entries]]
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(PAIRS_AT_ONCE, sizes.sum(), PAIRS_AT_ONCE))
    for some, n in zip(np.split(entries, cuts), np.split(sizes, cuts), strict=True):
        if len(some):
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            other = order[np.repeat(ends[term[some]] - n, n) + within]
            yield np.repeat(column[some], n), column[other], np.ones(n.sum(), np.int64)


def block_product(rows: pd.DataFrame) -> pd.DataFrame:
    """The product's cells of one block of terms and one tile of groups: ``a`` < ``b``, their levels, number of terms.

    Rows have ``term``, ``g`` (group), ``part`` (the group's part), ``n`` (level), ``tile_i``, ``tile_j``.
    """
    term, names = pd.factorize(rows["term"])
    column, pairs = pd.MultiIndex.from_arrays([rows["g"], rows["n"]]).factorize()
    group, level = (pairs.get_level_values(k).to_numpy() for k in (0, 1))
    part = np.zeros(len(pairs), np.int64)
    part[column] = rows["part"].to_numpy()
    size = np.bincount(column, minlength=len(pairs))
    common = size >= DENSE_TERMS
    rare_entries = np.flatnonzero(~common[column])
    frequent = np.flatnonzero(common)
    found = []
    for a, b, n in dense_cells(term, column, frequent, frequent, len(names), len(pairs)):
        found.append((a, b, n))
    for a, b, n in sparse_cells(term, column, rare_entries, len(names)):
        mirrored = common[b]  # the cells of a common and a rare column arise once, from the rare one
        found += [(a, b, n), (b[mirrored], a[mirrored], n[mirrored])]
    i, j = int(rows["tile_i"].iat[0]), int(rows["tile_j"].iat[0])
    cells = []
    for a, b, n in found:
        here = (part[a] == i) & (part[b] == j) & (group[a] < group[b])
        frame = pd.DataFrame({"a": a[here], "b": b[here], "terms": n[here]})
        cells.append(frame.groupby(["a", "b"], as_index=False)["terms"].sum())
    cell = pd.concat(cells) if cells else pd.DataFrame({"a": [], "b": [], "terms": []})
    a, b = cell["a"].to_numpy(np.int64), cell["b"].to_numpy(np.int64)
    return pd.DataFrame({"a": group[a], "a_level": level[a], "b": group[b], "b_level": level[b], "terms": cell["terms"].to_numpy()})


def joint_tables(levels: DataFrame, groups: DataFrame) -> DataFrame:
    """How many kept terms are at level ``a_level`` in group ``a`` and at ``b_level`` in group ``b`` of a language, a < b.

    ``levels`` has ``lang``, ``g``, ``term`` and ``n`` > 0, the level; ``groups`` has ``lang``, ``g``, numbered from 0 in
    each language, and ``terms``, the language's number of kept terms. Level 0 is part of the tables; empty cells are not.
    """
    blocks = F.ceil(F.col("terms") / BLOCK_TERMS).cast("int")
    sides = groups.groupBy("lang").agg(F.max("terms").alias("terms"), F.floor(F.max("g") / GROUP_PART).cast("int").alias("last"))
    placed = levels.join(sides, "lang").select(
        "lang", "term", "g", "n", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"),
        F.floor(F.col("g") / GROUP_PART).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), "last")).alias("other"),
    )
    tiles = placed.withColumn("tile_i", F.least("part", "other")).withColumn("tile_j", F.greatest("part", "other"))

    def product(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return block_product(rows).assign(lang=key[0])

    cells = tiles.groupBy("lang", "block", "tile_i", "tile_j").applyInPandas(product, f"lang string, {LEVELS}")
    cells = cells.groupBy("lang", "a", "a_level", "b", "b_level").agg(F.sum("terms").alias("terms"))
    margin = levels.groupBy("lang", "g", F.col("n").alias("level")).agg(F.count(F.lit(1)).alias("at"))
    a, b = groups.select("lang", F.col("g").alias("a"), "terms"), groups.select("lang", F.col("g").alias("b"))
    pairs = a.join(b, "lang").where("a < b")
    # A positive cell leaves the three cells in which one or both levels are 0; a margin enters them.
    inside = cells.select("lang", F.col("a"), F.col("b"), F.inline(F.array(*_cells("a_level", "b_level", "terms"))))
    of_a = pairs.join(margin.withColumnRenamed("g", "a"), ["lang", "a"])
    of_b = pairs.join(margin.withColumnRenamed("g", "b"), ["lang", "b"])
    none = F.lit(0).cast("long")
    outside = (
        of_a.select("lang", "a", "b", F.inline(F.array(_cell("level", none, "at"), _cell(none, none, -F.col("at")))))
        .union(of_b.select("lang", "a", "b", F.inline(F.array(_cell(none, "level", "at"), _cell(none, none, -F.col("at"))))))
        .union(pairs.select("lang", "a", "b", F.inline(F.array(_cell(none, none, "terms")))))
    )
    every = inside.union(outside).groupBy("lang", "a", "b", "a_level", "b_level").agg(F.sum("terms").alias("terms"))
    return every.where("terms > 0")


def _cell(a_level: str | Column, b_level: str | Column, terms: str | Column) -> Column:
    columns = {"a_level": a_level, "b_level": b_level, "terms": terms}
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).cast("long").alias(name) for name, c in columns.items()])


def _cells(a_level: str, b_level: str, terms: str) -> list[Column]:
    none, less = F.lit(0), -F.col(terms)
    return [_cell(a_level, b_level, terms), _cell(a_level, none, less), _cell(none, b_level, less), _cell(none, none, terms)]


def share(n: str, total: str, terms: str) -> Column:
    """p of ``n`` occurrences among ``total`` with ``terms`` kept terms; decimal, as 10^9 n may exceed 64 bits."""
    return F.expr(
        f"1 + cast(1000000000 as decimal(10,0)) * cast({n} + 2 as decimal(20,0)) div cast({total} + 2 * {terms} as decimal(20,0))"
    )


def apart(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def source_divergence(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
    least_docs: int = 10, most_terms: int = 10,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: for each group its distance to every other source of
    the language (part ``pair``), and the terms it uses more than the language, the ``most_terms`` farthest (``term``).

    Ranks run from 1 by falling value, then by the item's UTF-8 bytes.
    """
    tallies = stored(term_tallies(docs, lang_col, source_col, text_col), "terms")
    kept = tallies.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = stored(kept.drop("docs"), "kept-terms")
    named = docs.select(whole_text(lang_col).alias("lang"), whole_text(source_col).alias("source")).distinct()
    numbered = named.withColumn("g", F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1)
    counted = tallies.drop("docs").join(kept, ["lang", "term"])
    totals = counted.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    groups = numbered.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    groups = stored(groups, "groups")
    levels = stored(counted.join(groups, ["lang", "source"]).select("lang", "source", "g", "term", "n", "lang_n"), "levels")

    def side(name: str) -> DataFrame:
        return groups.select("lang", F.col("g").alias(name), F.col("source").alias(f"{name}_source"), F.col("total").alias(f"{name}_total"))

    joint = joint_tables(levels, groups).withColumnRenamed("terms", "at")
    priced = joint.join(side("a"), ["lang", "a"]).join(side("b"), ["lang", "b"]).join(langs, "lang")
    priced = priced.withColumn("p", share("a_level", "a_total", "terms")).withColumn("q", share("b_level", "b_total", "terms"))
    values = priced.groupBy("lang", "a", "b").agg(F.sum(apart("p", "q") * F.col("at")).alias("value"))
    pairs = side("a").join(side("b"), "lang").where("a < b").join(values, ["lang", "a", "b"], "left")
    both = F.array(
        F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")),
        F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item")),
    )
    pairs = pairs.select("lang", F.coalesce("value", F.lit(0).cast("long")).alias("value"), F.inline(both))
    own = levels.join(groups.drop("source"), ["lang", "g"])
    own = own.withColumn("p", share("n", "total", "terms")).withColumn("q", share("lang_n", "lang_total", "terms"))
    own = own.where("p > q").select("lang", "source", F.col("term").alias("item"), apart("p", "q").alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    own = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most_terms).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).union(own.select(*columns))
