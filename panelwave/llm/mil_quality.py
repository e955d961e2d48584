"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_WORDS words. Every passage is encoded from surface measures (case, symbols,
word lengths, repetition); a hidden layer, gated attention weights and a logistic output are learned together from the
labels of documents. The score is the output for the attention-weighted passage representation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwave.llm.common import labelled_sample

PASSAGE_WORDS = 64
#: Characters measured at a time; bounds the memory of a task.
CHARS_AT_ONCE = 1_000_000
SYMBOLS = "#$%&*@^~<>{}[]\\/=+_`"
MEASURES = 20


def _classes() -> np.ndarray:
    """Bit set of character classes by code point below 0x3000; beyond, letters."""
    table = np.zeros(0x3000, np.uint16)
    for k in range(0x3000):
        c = chr(k)
        table[k] = (
            1 * c.isspace()
            | 2 * c.isalpha()
            | 4 * c.isupper()
            | 8 * c.isdigit()
            | 16 * (c in ".,;:")
            | 32 * (c in SYMBOLS)
            | 64 * (c in "!?")
            | 128 * (c == "|")
            | 256 * (c == "\n")
        )
    return table


CLASSES = _classes()


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Document number and measures of every passage; a text without words is one passage of zeros."""
    # A space ends every text, so no word crosses into the next.
    raw = " ".join(texts) + " "
    codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = CLASSES[np.minimum(codes, 0x2FFF)]
    kinds[codes >= 0x3000] = 2
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    text_ends = np.cumsum(lengths)
    space = (kinds & 1) > 0
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)
    doc = np.searchsorted(text_ends, starts, "right")
    words = np.bincount(doc, minlength=len(texts))
    first_word = np.concatenate([[0], np.cumsum(words)[:-1]])
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    owner = np.repeat(np.arange(len(texts)), passages)
    first_passage = np.concatenate([[0], np.cumsum(passages)[:-1]])
    out = np.zeros((len(owner), MEASURES), np.float32)
    if not len(starts):
        return owner, out
    place = np.arange(len(starts)) - first_word[doc]
    passage = first_passage[doc] + place // PASSAGE_WORDS

    def per_passage(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, weights=values, minlength=len(owner))

    def in_words(mask: int) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum((kinds & mask) > 0)])
        return total[ends] - total[starts]

    # Case is folded before hashing; sums of mixed code points stand for words.
    folded = np.where((kinds & 4) > 0, codes | 0x20, codes).astype(np.uint64)
    mixed = (folded + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    begins = np.concatenate([[0], starts])
    position = np.arange(len(codes)) - np.repeat(begins, np.diff(np.append(begins, len(codes))))
    mixed *= 2 * position.astype(np.uint64) + np.uint64(1)
    mixed[space] = 0
    with np.errstate(over="ignore"):
        name = np.add.reduceat(mixed, starts)
    size = (ends - starts).astype(float)
    alpha, upper = in_words(2), in_words(4)
    n = np.maximum(per_passage(np.ones(len(starts))), 1)
    chars = np.maximum(per_passage(size), 1)
    same_doc = np.concatenate([[False], doc[1:] == doc[:-1]])
    repeat = same_doc & np.concatenate([[False], name[1:] == name[:-1]])
    pair = name + np.concatenate([[np.uint64(0)], name[:-1]]) * np.uint64(0xC2B2AE3D27D4EB4F)

    def seen(values: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether the value stands earlier in the same group."""
        order = np.lexsort((np.arange(len(values)), values, group))
        again = np.zeros(len(values), bool)
        again[order[1:]] = (values[order][1:] == values[order][:-1]) & (group[order][1:] == group[order][:-1])
        return again

    tail = kinds[ends - 1]
    measures = [
        np.log1p(per_passage(np.ones(len(starts)))) / 4,
        per_passage(size) / n / 10,
        per_passage(upper) / np.maximum(per_passage(alpha), 1),
        per_passage(in_words(8)) / chars,
        per_passage(in_words(16)) / chars * 5,
        per_passage(in_words(32)) / chars * 3,
        per_passage(in_words(64)) / chars * 3,
        per_passage((size == 1) & ((kinds[starts] & 128) > 0)) / n,
        per_passage(seen(name, passage)) / n,
        per_passage(repeat) / n,
        per_passage((tail & 2) == 0) / n,
        per_passage((tail & 16) > 0) / n,
        per_passage(seen(pair, doc)) / n,
        per_passage((kinds[starts] & 4) > 0) / n,
        per_passage(size <= 3) / n,
        per_passage(size >= 12) / n,
        per_passage((size > 1) & (alpha == upper) & (alpha > 0)) / n,
        per_passage(alpha == 0) / n,
    ]
    for k, m in enumerate(measures):
        out[:, k] = m
    out[:, len(measures)] = (np.log1p(words) / 8)[owner]
    out[:, len(measures) + 1] = per_passage((codes[np.maximum(starts - 1, 0)] == 10)) / n
    return owner, out


@dataclass
class AttentionModel:
    """Weights: hidden layer (w, b), attention (v, u, a), output (c, d); ``mean`` and ``scale`` of the measures."""

    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, owner: np.ndarray, x: np.ndarray, n: int) -> dict[str, np.ndarray]:
        p = self.parts
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-np.clip(h @ p["u"], -30, 30)))
        e = np.exp(np.clip((t * g) @ p["a"], -30, 30))
        a = e / np.bincount(owner, weights=e, minlength=n)[owner]
        starts = np.searchsorted(owner, np.arange(n))
        bag = np.add.reduceat(h * a[:, None], starts, axis=0)
        score = 1 / (1 + np.exp(-np.clip(bag @ p["c"] + p["d"], -30, 30)))
        return {"x": x, "h": h, "t": t, "g": g, "attention": a, "bag": bag, "score": score}

    def gradient(self, owner: np.ndarray, f: dict[str, np.ndarray], error: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss, given ``error`` = (score - label) * weight for each document."""
        p, h, t, g, a = self.parts, f["h"], f["t"], f["g"], f["attention"]
        d_bag = error[:, None] * p["c"]
        to_passage = d_bag[owner]
        d_a = (to_passage * h).sum(axis=1)
        d_s = a * (d_a - np.bincount(owner, weights=a * d_a, minlength=len(error))[owner])
        d_tg = d_s[:, None] * p["a"]
        d_t, d_g = d_tg * g * (1 - t * t), d_tg * t * g * (1 - g)
        d_h = (to_passage * a[:, None] + d_t @ p["v"].T + d_g @ p["u"].T) * (1 - h * h)
        out = {"w": f["x"].T @ d_h, "b": d_h.sum(axis=0), "v": h.T @ d_t, "u": h.T @ d_g, "a": (t * g).T @ d_s}
        return out | {"c": f["bag"].T @ error, "d": error.sum(keepdims=True)}


def fit(
    owner: np.ndarray, x: np.ndarray, label: np.ndarray, weight: np.ndarray, hidden: int = 16, gate: int = 8, steps: int = 250
) -> AttentionModel:
    """Adam over the whole sample; seeded, so that reruns agree."""
    rng = np.random.default_rng(3)
    n = len(label)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    shapes = {"w": (x.shape[1], hidden), "b": (hidden,), "v": (hidden, gate), "u": (hidden, gate), "a": (gate,), "c": (hidden,), "d": (1,)}
    parts = {k: rng.standard_normal(s) * 0.3 for k, s in shapes.items()}
    rate = np.clip((label * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    parts["d"][:] = np.log(rate / (1 - rate))
    model = AttentionModel(mean, scale, parts)
    first = {k: np.zeros(s) for k, s in shapes.items()}
    second = {k: np.zeros(s) for k, s in shapes.items()}
    share = weight / weight.sum()
    for step in range(1, steps + 1):
        f = model.forward(owner, x, n)
        for k, g in model.gradient(owner, f, (f["score"] - label) * share).items():
            g = g + (1e-4 * parts[k] if k != "d" else 0)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            parts[k] -= 0.03 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def measured(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about CHARS_AT_ONCE characters: begin, end, document numbers and measures."""
    texts = [t or "" for t in batch.column("text").to_pylist()]
    begin = held = 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= CHARS_AT_ONCE or k == len(texts) - 1:
            yield begin, k + 1, *encode(texts[begin : k + 1])
            begin, held = k + 1, 0


def learn(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    most_rows: int = 3000,
) -> AttentionModel | None:
    """Fits on at most ``most_rows`` labelled rows of each value, by smallest hash, weighted back to all labelled rows.

    Whole texts are encoded on the executors. None where the sample lacks one of the values.
    """
    known = labels.where(F.col(id_col).isNotNull() & training)
    totals = {r[0]: r[1] for r in known.groupBy(F.col(label_col).cast("int")).count().collect()}
    sample = labelled_sample(labels, label_col, id_col, training, most_rows)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, owner, x in measured(batch):
                at = np.searchsorted(owner, np.arange(end - begin + 1))
                values = [x[at[k] : at[k + 1]].astype("<f4").tobytes() for k in range(end - begin)]
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), pa.array(values, pa.binary())], ["id", "label", "x"]
                )

    encoded = source.select("id", "label", "text").mapInArrow(rows, "id long, label int, x binary")
    taken = sorted((r["id"], r["label"], bytes(r["x"])) for r in encoded.collect())
    label = np.array([t[1] for t in taken], float)
    if not 0 < label.sum() < len(label):
        return None
    x = [np.frombuffer(t[2], "<f4").reshape(-1, MEASURES) for t in taken]
    owner = np.repeat(np.arange(len(x)), [len(v) for v in x])
    share = {v: totals[v] / (label == v).sum() for v in (0, 1)}
    return fit(owner, np.concatenate(x).astype(float), label, np.where(label == 1, share[1], share[0]))


def quality_scores(
    docs: DataFrame,
    model: AttentionModel | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.3,
    also: tuple[Column, ...] = (),
) -> DataFrame:
    """``id_col``, the columns ``also``, ``score`` and ``predicted`` (score at least ``threshold``) of every row.

    NULL and empty texts are one empty passage and get its score; without a model every score is 0.5.
    """
    source = docs.select(F.col(id_col).alias("id"), *also, F.col(text_col).alias("text"))
    kept = source.drop("text").schema
    names = [*kept.names, "score", "predicted"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, owner, x in measured(batch):
                n = end - begin
                score = np.full(n, 0.5) if model is None else model.forward(owner, x, n)["score"]
                part = batch.slice(begin, n)
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                columns += [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    return source.mapInArrow(rows, f"{fields}, score double, predicted int").withColumnRenamed("id", id_col)
