"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

Features are words and word beginnings, counted in the whole text. One weight vector serves all ordered thresholds:
P(grade > k) = sigmoid(w.x - t_k). The result is the expected severity, sum over k of P(grade > k).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwave.llm.common import fresh, stored
from panelwave.llm.decontaminate import bounded

WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
BUCKETS = 1 << 22
PREFIXES = (5, 6, 7, 8)
#: Log-likelihood gain over the training rows that a feature must bring.
LEAST_GAIN = 10.0
#: Words whose weight a task remembers.
CACHE_WORDS = 400_000
#: Bytes of training rows, reduced to the chosen features, whose gradient is summed at a time.
PART_BYTES = 8 << 20
#: Tasks that share these parts; each sends one sum a step to the driver.
TASKS = 128


def features_of(word: str) -> list[int]:
    """Hashed features of a lower-case word: itself and its beginnings."""
    names = [f"w:{word}", *(f"p:{word[:k]}" for k in PREFIXES if len(word) > k)]
    return [zlib.crc32(n.encode("utf-8", "replace")) % BUCKETS for n in names]


def word_counts(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


@dataclass
class OrdinalModel:
    """Weights by feature, shared by all thresholds, which rise with the grade."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    _known: dict = field(default_factory=dict, repr=False, compare=False)
    _table: dict = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}, "_table": {}}

    def margin(self, text: str | None) -> float:
        if not self._table:
            self._table = dict(zip(self.features.tolist(), self.weights.tolist(), strict=True))
        total = 0.0
        for word, n in word_counts(text).items():
            w = self._known.get(word)
            if w is None:
                if len(self._known) >= CACHE_WORDS:
                    self._known.clear()
                w = self._known[word] = sum(self._table.get(f, 0.0) for f in features_of(word))
            if w:
                total += w * np.log1p(n)
        return total

    def above(self, margins: np.ndarray) -> np.ndarray:
        """P(grade > k) for every row and threshold."""
        return 1 / (1 + np.exp(-np.clip(margins[:, None] - self.thresholds, -40, 40)))


@dataclass
class Rows:
    """Some training rows: how many chosen features each has, these (``column``, 16 bits or 32; ``value``, 32 bits) row by row,
    the grades and the weights. They go to a task in every step, so they are kept small.
    """

    sizes: np.ndarray
    column: np.ndarray
    value: np.ndarray
    grade: np.ndarray
    share: np.ndarray

    def gradient(self, w: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Of the weighted negative log likelihood of the grades: by weight, then by threshold."""
        n, levels = len(self.grade), len(cuts)
        edge = np.concatenate([[-np.inf], cuts, [np.inf]])
        grade, share = self.grade, self.share
        column, value, some = self.column.astype(np.intp), self.value.astype(float), self.sizes > 0
        margin = np.zeros(n)
        if some.any():
            margin[some] = np.add.reduceat(value * w[column], (np.cumsum(self.sizes) - self.sizes)[some])
        low, high = edge[grade] - margin, edge[grade + 1] - margin
        p_low, p_high = 1 / (1 + np.exp(-np.clip(low, -40, 40))), 1 / (1 + np.exp(-np.clip(high, -40, 40)))
        p_low[grade == 0], p_high[grade == levels] = 0, 1
        p = np.maximum(p_high - p_low, 1e-12)
        d_low, d_high = p_low * (1 - p_low) / p * share, p_high * (1 - p_high) / p * share
        g_w = np.bincount(column, weights=np.repeat(d_high - d_low, self.sizes) * value, minlength=len(w))
        d_cut = np.zeros(levels)
        np.add.at(d_cut, np.minimum(grade, levels - 1), np.where(grade < levels, -d_high, 0))
        np.add.at(d_cut, np.maximum(grade - 1, 0), np.where(grade > 0, d_low, 0))
        return np.concatenate([g_w, d_cut])


def rows_of(cells: Iterable[tuple], median: float, weights: tuple[float, float]) -> Rows:
    """From (label, density, places, x) of each row; the weights are those of the labels 0 and 1."""
    label, density, places, x = list(zip(*cells, strict=True)) or [()] * 4
    label = np.array(label, np.int64)
    grade = np.where(label == 1, 1 + (np.array(density) > median), 0)
    sizes = np.array([len(v) // 4 for v in x], np.int64)
    at = b"".join(places)
    column, value = np.frombuffer(at, "<u2" if len(at) == 2 * sizes.sum() else "<u4"), np.frombuffer(b"".join(x), "<f4")
    return Rows(sizes, column, value, grade, np.array(weights)[label])


def parts_of(cells: Iterable[tuple], median: float, weights: tuple[float, float], part_bytes: int) -> Iterator[Rows]:
    """``rows_of`` for rows of about ``part_bytes`` at a time."""
    held, size = [], 0
    for cell in cells:
        held.append(cell)
        size += len(cell[2]) + len(cell[3]) + 24
        if size >= part_bytes:
            yield rows_of(held, median, weights)
            held, size = [], 0
    if held:
        yield rows_of(held, median, weights)


def fit_ordinal(
    gradient: Callable[[np.ndarray, np.ndarray], np.ndarray], rates: list[float], n_columns: int, steps: int = 300
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds by Adam on ``gradient`` of all rows; ``rates`` are the shares of rows above each grade."""
    levels = len(rates)
    w = np.zeros(n_columns)
    rates = np.clip(rates, 1e-3, 1 - 1e-3)
    start = -np.log(rates / (1 - rates))
    # t_0, then logarithms of the steps between thresholds, so that they stay in order.
    t = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    for step in range(1, steps + 1):
        cuts = t[0] + np.concatenate([[0], np.cumsum(np.exp(t[1:]))])
        g = gradient(w, cuts)
        g_w, d_cut = g[:-levels] + 1e-5 * w, g[-levels:]
        after = np.cumsum(d_cut[::-1])[::-1]
        g_t = np.concatenate([after[:1], after[1:] * np.exp(t[1:])])
        for k, (theta, g) in enumerate(((w, g_w), (t, g_t))):
            m, v = state[2 * k], state[2 * k + 1]
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w, t[0] + np.concatenate([[0], np.cumsum(np.exp(t[1:]))])


def feature_counts(texts: DataFrame) -> DataFrame:
    """``feature``, and the rows of each label that hold it: ``pos``, ``neg``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, BUCKETS), np.int32)
        known: dict[str, bytes] = {}
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names = []
                for word in word_counts(text.as_py()):
                    of = known.get(word)
                    if of is None:
                        if len(known) >= CACHE_WORDS:
                            known.clear()
                        of = known[word] = np.array(features_of(word), "<i4").tobytes()
                    names.append(of)
                # A feature that several words have is counted once.
                found[label, np.frombuffer(b"".join(names), "<i4")] += 1
        some = np.flatnonzero(found.any(axis=0))
        for k in range(0, len(some), 1 << 16):
            at = some[k : k + (1 << 16)]
            columns = [pa.array(at.astype(np.int32)), pa.array(found[1, at].astype(np.int64)), pa.array(found[0, at].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["feature", "pos", "neg"])

    counted = texts.select("label", "text").mapInArrow(rows, "feature int, pos long, neg long")
    return counted.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def chosen_features(counts: DataFrame, n_pos: int, n_neg: int) -> list[tuple[int, bool]]:
    """All features that gain at least ``LEAST_GAIN``, in their order, and whether each tells of toxic rows."""
    rate_pos, rate_neg = (F.col("pos") + 0.5) / (n_pos + 1), (F.col("neg") + 0.5) / (n_neg + 1)
    rate = (F.col("pos") + F.col("neg") + 1) / (n_pos + n_neg + 2)

    def part(n: int, own: Column) -> Column:
        return n * (own * F.log(own / rate) + (1 - own) * F.log((1 - own) / (1 - rate)))

    # Below LEAST_GAIN chance alone picks features: there are some millions to pick from.
    gains = counts.where("pos + neg >= 3").withColumn("gain", part(n_pos, rate_pos) + part(n_neg, rate_neg))
    best = gains.where(F.col("gain") >= LEAST_GAIN)
    telling = (rate_pos > 4 * rate_neg) & (F.col("gain") > 4)
    return sorted((r[0], r[1]) for r in best.select("feature", telling).collect())


def chosen_cells(texts: DataFrame, chosen: list[tuple[int, bool]]) -> DataFrame:
    """``id``, ``label``, and the chosen features of every text: their places in ``chosen`` (16 bits each where these suffice, else 32), the values
    ``x`` (32 bits each), and ``density``, the values of the telling ones summed.
    """
    place = {feature: k for k, (feature, _) in enumerate(chosen)}
    telling = np.array([t for _, t in chosen])
    kind = "<u2" if len(chosen) <= 1 << 16 else "<u4"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            places, values, density = [], [], []
            for text in batch.column("text"):
                x: dict[int, float] = {}
                for word, n in word_counts(text.as_py()).items():
                    of = known.get(word)
                    if of is None:
                        if len(known) >= CACHE_WORDS:
                            known.clear()
                        of = known[word] = tuple(place[f] for f in features_of(word) if f in place)
                    for k in of:
                        x[k] = x.get(k, 0.0) + float(np.log1p(n))
                at, value = np.fromiter(x, kind, len(x)), np.fromiter(x.values(), "<f4", len(x))
                places.append(at.tobytes())
                values.append(value.tobytes())
                density.append(float((value.astype(float) * telling[at]).sum()))
            columns = [batch.column("id"), batch.column("label"), pa.array(density, pa.float64())]
            columns += [pa.array(places, pa.binary()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "density", "places", "x"])

    return texts.select("id", "label", "text").mapInArrow(rows, "id long, label int, density double, places binary, x binary")


def learn(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    part_bytes: int = PART_BYTES,
) -> OrdinalModel | None:
    """Fits on all labelled rows that ``training`` holds for, weighted by the labels' own numbers of rows.

    The label marks toxic rows. Severity grades them: grade 1, or 2 where the telling features occur more often than in
    the median toxic row. Features are chosen by their gain over all rows, as many as gain enough. None where one of the values has no row.

    Rows with a NULL id or label are no training rows. Texts are read twice, to count features and to keep the chosen
    ones. Every step of the fit sums the gradients of parts of ``part_bytes`` in at most ``TASKS`` tasks; a single part is
    summed on the driver.
    """
    known = labels.where(F.col(id_col).isNotNull() & training)
    totals = {r[0]: r[1] for r in known.groupBy(F.col(label_col).cast("int")).count().collect()}
    known = known.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = stored(known.where("label in (0, 1)").distinct(), "training-labels")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = stored(source.join(bounded(known, known.count()), "id").select("id", "label", "text"), "training-texts")
    rows = {r[0]: r[1] for r in texts.groupBy("label").count().collect()}
    if len(rows) < 2:
        return None
    chosen = chosen_features(feature_counts(texts), rows[1], rows[0])
    if not chosen:
        return None
    cells = stored(chosen_cells(texts, chosen), "training-cells")
    # One in a million of the rows at most lies between this and the exact median.
    median = cells.where("label = 1").agg(F.percentile_approx("density", 0.5, 1_000_000)).head()[0]
    above, size = cells.agg(
        F.count(F.when((F.col("label") == 1) & (F.col("density") > median), 1)),
        F.sum(F.octet_length("places") + F.octet_length("x") + 24),
    ).head()
    every = totals[0] + totals[1]
    weights = (totals[0] / rows[0] / every, totals[1] / rows[1] / every)
    rates = [rows[1] * weights[1], above * weights[1]] if above else [rows[1] * weights[1]]
    order = ["id", "label", "places", "x"]
    parts = -(-size // part_bytes)
    if parts == 1:
        own = sorted(cells.collect(), key=lambda r: tuple(r[c] for c in order))
        gradient = rows_of([tuple(r)[1:] for r in own], median, weights).gradient
        w, t = fit_ordinal(gradient, rates, len(chosen))
    else:
        dealt = cells.repartition(min(parts, TASKS), "id").sortWithinPartitions(*order).drop("id")
        held = dealt.rdd.mapPartitions(lambda some: parts_of(some, median, weights, part_bytes)).persist(StorageLevel.MEMORY_AND_DISK)

        def gradient(w: np.ndarray, cuts: np.ndarray) -> np.ndarray:
            # A task's sum has as many numbers as there are features; in the order of the tasks, so that reruns agree.
            return sum(held.mapPartitions(lambda some: [sum(part.gradient(w, cuts) for part in some)]).collect())

        w, t = fit_ordinal(gradient, rates, len(chosen))
        held.unpersist()
    used = np.abs(w) > 1e-4
    return OrdinalModel(np.array([f for f, _ in chosen])[used], w[used], t)


def toxicity_scores(
    docs: DataFrame,
    model: OrdinalModel | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.5,
    keep_columns: bool = False,
    also: tuple[Column, ...] = (),
) -> DataFrame:
    """``id_col``, the columns ``also``, ``severity`` (expected grade), ``p_toxic`` and ``toxic`` (P(grade > 0) at least
    ``threshold``) of every row.

    A NULL or empty text has no features. Without a model severity is 0. With ``keep_columns`` all input columns come
    first, and the three results, now ``_severity``, ``_p_toxic``, ``_toxic``, are renamed where they clash.
    """
    first = [F.col(c) for c in docs.columns] if keep_columns else [F.col(id_col), *also]
    source = docs.select(*first, F.col(text_col).alias(fresh(docs, "_text")[0]))
    kept = source.columns[:-1]
    results = fresh(docs, "_severity", "_p_toxic", "_toxic") if keep_columns else ["severity", "p_toxic", "toxic"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            if model is None:
                severity = p = np.zeros(batch.num_rows)
            else:
                above = model.above(np.array([model.margin(t.as_py()) for t in texts]))
                severity, p = above.sum(axis=1), above[:, 0]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(severity), pa.array(p), pa.array(p >= threshold)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *results])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    kinds = zip(results, ("double", "double", "boolean"), strict=True)
    return source.mapInArrow(rows, fields + ", ".join(f"`{n}` {k}" for n, k in kinds))
