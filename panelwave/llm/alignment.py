"""Alignment of two tokenizers: which tokens of one cover the bytes of which tokens of the other, counted over a corpus.

A text with a space before it is encoded by a byte-level BPE (A) and, without that space, by a piece model that adds it
(B). Byte offsets at which a token of both ends cut the two sequences into groups; a token of A and one of B in the same
group are linked. A pair of ids counts in every document that holds it linked.

Neither tokenizer has a token that goes on from another character into a space, and of B only runs of spaces hold one
after their start. So tokens of both end before every single space between two characters that are no white space, and
what stands between two such places is encoded the same alone and in its text. A text is cut there into segments, mostly
words; tokens, groups and links of a segment are worked out once for each worker and looked up afterwards.

Counting moves no document: rows are dealt to chunks of bounded text as they are read, each chunk numbers its own pairs,
only these pairs (with how many of its documents hold each) are summed over the corpus, and they come back to the chunk
with their counts. A document keeps the numbers of its pairs and how often it holds each.

NULL and empty texts, and texts whose joined tokens of A or B differ from the text with its space, have no tokens: zeros
and an empty ``groups_sha256``. NULL ids and repeated rows stay rows of their own, and each counts as a document. An empty
table gives no rows. Texts are encoded whole; a long one is a chunk of its own. Other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwave.llm.common import stored, whole_text

#: Text bytes and documents of a chunk; they bound the memory of a task.
CHUNK_BYTES = 32 << 20
CHUNK_DOCS = 20_000
#: Text bytes handed to the tokenizers at a time, if more than one text.
ENCODE_BYTES = 256 << 10
#: Segments of the newer half of those that a worker remembers, and the longest of them in characters; others are worked out anew.
MEMO_SEGMENTS = 200_000
MEMO_CHARACTERS = 64
#: Pairs that a worker has numbered before it starts anew with the next chunk.
NUMBERED_PAIRS = 1_000_000
#: Links of a group up to which they are listed one by one.
SMALL_GROUP = 256
#: Texts of these characters, whose classes no release of Unicode has changed, take the faster of two equal encoders.
RANKED_CHARACTERS = 200_000
SETTLED = re.compile(r"[\n\t\r -~\u00a0-\u024f\u2010-\u2027]*")

#: A single space between two characters that are no white space.
BREAK = re.compile(r" (?<=\S )(?=\S)")

ENCODED = (
    "chunk long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
    "n_pairs int, pair_at binary, times binary, pairs array<long>, docs array<long>"
)
COUNTED = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_characters() -> dict[str, int]:
    """The printable characters by which a byte-level vocabulary writes the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Bytes of every id and their lengths."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.by_id = [len(p) for p in pieces]

    def spells(self, ids: list[int], text: bytes) -> bool:
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids]) == text


@lru_cache(maxsize=4)
def byte_level(path: str):
    """Tokenizer A, which takes the strings of special tokens for plain text, its vocabulary, and a second encoder."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    of = byte_characters()
    pieces = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        pieces[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    special = set(tokenizer.get_added_tokens_decoder())
    ranks = {piece: i for i, piece in enumerate(pieces) if i not in special}
    ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return tokenizer, Vocabulary(pieces), ranked


@lru_cache(maxsize=4)
def piece_level(path: str):
    """Tokenizer B and its vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        pieces.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return model, Vocabulary(pieces)


class Segment(NamedTuple):
    """Groups of one segment as text; its tokens of A and of B, its groups and links (four longs); the numbers of its pairs
    (ints); and how often each is meant (longs, None: once).
    """

    text: str
    counts: bytes
    pairs: bytes
    times: bytes | None


def cut_segment(a: list[int], b: list[int], size_a: list[int], size_b: list[int], numbers: dict[int, int]) -> Segment:
    """Cuts one segment, at whose end tokens of both end, where tokens of both end; sizes are by id. Pairs (A's id in the
    upper half) are given as the worker's ``numbers``, which grow with new pairs.
    """
    texts, pairs, times = [], [], None
    i = j = links = 0
    while i < len(a):
        from_i, from_j, x, y = i, j, a[i], b[j]
        end_a, end_b = size_a[x], size_b[y]
        i += 1
        j += 1
        if end_a == end_b:
            texts.append(f"{x}|{y}")
            pairs.append(x << 32 | y)
            if times is not None:
                times.append(1)
            links += 1
            continue
        while end_a != end_b:
            if end_a < end_b:
                end_a += size_a[a[i]]
                i += 1
            else:
                end_b += size_b[b[j]]
                j += 1
        of_a, of_b = a[from_i:i], b[from_j:j]
        texts.append(f"{str(of_a)[1:-1]}|{str(of_b)[1:-1]}".replace(" ", ""))
        n = len(of_a) * len(of_b)
        if n <= SMALL_GROUP:
            pairs += [x << 32 | y for x in of_a for y in of_b]
            if times is not None:
                times += [1] * n
        else:
            times = [1] * links if times is None else times
            x, n_x = np.unique(np.array(of_a, np.int64), return_counts=True)
            y, n_y = np.unique(np.array(of_b, np.int64), return_counts=True)
            pairs += ((x[:, None] << 32) | y).ravel().tolist()
            times += (n_x[:, None] * n_y).ravel().tolist()
        links += n
    counts = array("q", (len(a), len(b), len(texts), links)).tobytes()
    of_pairs = array("i", [numbers.setdefault(p, len(numbers)) for p in pairs]).tobytes()
    return Segment(";".join(texts), counts, of_pairs, None if times is None else array("q", times).tobytes())


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their times."""
    distinct, at = np.unique(keys, return_inverse=True)
    order = np.argsort(at, kind="stable")
    starts = np.searchsorted(at[order], np.arange(len(distinct)))
    return distinct, np.add.reduceat(times[order], starts)


class Aligner:
    """Aligns documents by remembered segments."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.vocabulary_a, self.ranked = byte_level(path_a)
        self.b, self.vocabulary_b = piece_level(path_b)
        #: Segments by their text, False where A or B does not spell it: those used of late, and those before them.
        self.memo: dict[str, Segment | bool] = {}
        self.older: dict[str, Segment | bool] = {}
        self.numbers: dict[int, int] = {}

    def fresh(self) -> None:
        """Forgets segments and pair numbers when the numbers have become many; only between chunks, which hold numbers."""
        if len(self.numbers) >= NUMBERED_PAIRS:
            self.memo, self.older, self.numbers = {}, {}, {}

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of A and B for each text; none where they do not spell it.

        The ids of A's vocabulary are the ranks of its merges, so the second encoder gives the same; what it gives always
        spells the text, as it merges the text's own bytes.
        """
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            whole = b" " + text.encode("utf-8", "surrogatepass")
            if not text or not self.vocabulary_b.spells(b, whole):
                yield [], []
            elif len(text) <= RANKED_CHARACTERS and SETTLED.fullmatch(text):
                yield self.ranked.encode_ordinary(f" {text}"), b
            else:
                a = self.a.encode(f" {text}", add_special_tokens=False).ids
                yield (a, b) if self.vocabulary_a.spells(a, whole) else ([], [])

    def segments(self, texts: list[str]) -> list[list[Segment]]:
        """The segments of each text in order; none where A or B does not spell it."""
        cut = [BREAK.split(text) if text else [] for text in texts]
        memo, older = self.memo, self.older
        found = [list(map(memo.get, words)) for words in cut]
        missing = {word for words, of in zip(cut, found, strict=True) if None in of for word, s in zip(words, of, strict=True) if s is None}
        wanted = []
        for word in missing:
            if word in older:
                memo[word] = older[word]
            else:
                wanted.append(word)
        size_a, size_b = self.vocabulary_a.by_id, self.vocabulary_b.by_id
        for word, (a, b) in zip(wanted, self.encode(wanted), strict=True):
            memo[word] = cut_segment(a, b, size_a, size_b, self.numbers) if a else False
        found = [list(map(memo.get, words)) if None in of else of for words, of in zip(cut, found, strict=True)]
        for word in wanted:
            if len(word) > MEMO_CHARACTERS:
                del memo[word]
        if len(memo) >= MEMO_SEGMENTS:
            self.memo, self.older = {}, memo
        return [[] if False in of else of for of in found]


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def document_links(pairs: Sequence[bytes], times: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of a document's segments and how often it holds each."""
    every = np.frombuffer(b"".join(pairs), np.int32)
    if not any(times):
        return np.unique(every, return_counts=True)
    of = [np.frombuffer(t, np.int64) if t else np.ones(len(p) // 4, np.int64) for t, p in zip(times, pairs, strict=True)]
    return summed(every, np.concatenate(of))


def packed(values: np.ndarray) -> bytes:
    """The values in the narrowest whole-number type that holds them all; the width shows in the length."""
    return values.astype(np.min_scalar_type(int(values.max()))).tobytes() if len(values) else b""


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64) if n else np.empty(0, np.int64)


def encoded(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, keep_groups: bool = False) -> DataFrame:
    """One row per document with what is known from itself, and one row per chunk with its pairs."""

    def closed(chunk: int, rows: list[dict], align: Aligner) -> Iterator[pa.RecordBatch]:
        held = [r.pop("held") for r in rows]
        numbers = np.concatenate([p for p, _ in held])
        docs_of = np.bincount(numbers, minlength=len(align.numbers))
        here = docs_of > 0
        place = np.cumsum(here) - 1  # the chunk's own numbers, in the order of the worker's
        for row, (pairs, times) in zip(rows, held, strict=True):
            row |= {"chunk": chunk, "n_pairs": len(times), "pair_at": packed(place[pairs]), "times": packed(times)}
        if here.any():
            known = np.fromiter(align.numbers, np.int64, len(align.numbers))
            rows.append({"chunk": chunk, "pairs": known[here], "docs": docs_of[here]})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # no cycles arise, and remembered segments need no scan
        try:
            yield from chunks_of(batches)
        finally:
            gc.enable()

    def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(path_a, path_b)
        none = np.empty(0, np.int64)
        chunk, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for ids, texts in portions(batch):
                for i, text, own in zip(ids, texts, align.segments(texts), strict=True):
                    texts_of, counts, pairs, times = zip(*own, strict=True) if own else ((),) * 4
                    groups = ";".join(texts_of)
                    n_a, n_b, n_groups, n_links = np.frombuffer(b"".join(counts), np.int64).reshape(-1, 4).sum(axis=0).tolist()
                    rows.append({
                        "id": i, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
                        "groups": groups if keep_groups else None,
                        "groups_sha256": hashlib.sha256(groups.encode()).hexdigest() if own else "",
                        "held": document_links(pairs, times) if own else (none, none),
                    })
                    size += len(text)
                if size >= CHUNK_BYTES or len(rows) >= CHUNK_DOCS:
                    yield from closed(chunk, rows, align)
                    chunk, rows, size = chunk + 1, [], 0
                    align.fresh()
        if rows:
            yield from closed(chunk, rows, align)
            align.fresh()

    schema = pa.schema([
        *[(n, pa.int64()) for n in ("chunk", "id", "n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()),
        ("groups", pa.large_string()), ("n_pairs", pa.int32()), ("pair_at", pa.binary()), ("times", pa.binary()),
        ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())),
    ])
    return docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text")).mapInArrow(rows_of, ENCODED)


def portions(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of a batch, a bounded number of bytes at a time."""
    ids, texts, size = [], [], 0
    for i, text in zip(batch.column(0), batch.column(1), strict=True):
        ids.append(i.as_py())
        texts.append(text.as_py())
        size += len(texts[-1])
        if size >= ENCODE_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def pair_counts(rows: DataFrame) -> DataFrame:
    """``chunk``, ``at`` (the pair's number there), ``a``, ``b``, ``count`` (documents of the corpus) of every chunk's pairs.

    A pair has at most one row per chunk, so no group grows with the documents.
    """
    each = rows.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "seen"))
    pair = F.col("seen.pairs")
    count = F.sum("seen.docs").over(W.partitionBy(pair)).alias("count")
    a, b = F.shiftright(pair, 32).alias("a"), pair.bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    return each.select("chunk", "at", a, b, count)


def aligned(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False
) -> DataFrame:
    """One row per document: the id, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose count is the
    highest of their A id), ``count_sum`` (counts over links), ``groups_sha256`` and, if asked for, ``groups`` themselves,
    written as ``a1,a2|b1;a3|b2,b3``.
    """
    rows = stored(encoded(docs, path_a, path_b, id_col, text_col, keep_groups), "aligned")
    counted = stored(pair_counts(rows), "pair-counts")
    most = counted.groupBy("a").agg(F.max("count").alias("most"))
    priced = counted.join(most, "a").select("chunk", "at", "count", (F.col("count") == F.col("most")).alias("best"))
    added = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if keep_groups else [])]

    def totals(key: tuple, documents: pa.Table, pairs: pa.Table) -> pa.Table:
        count, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, bool)
        at = pairs.column("at").to_numpy()
        count[at], best[at] = pairs.column("count").to_numpy(), pairs.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for n, numbers, times in zip(*(documents.column(c).to_pylist() for c in ("n_pairs", "pair_at", "times")), strict=True):
            numbers, times = unpacked(numbers, n), unpacked(times, n)
            n_best.append(int(times[best[numbers]].sum()))
            count_sum.append(int((times * count[numbers]).sum()))
        own = documents.append_column("n_best", pa.array(n_best, pa.int64()))
        own = own.append_column("count_sum", pa.array(count_sum, pa.int64())).select(["id", *added])
        return own.rename_columns([id_col, *added])

    own = rows.where("pairs is null").drop("pairs", "docs").groupBy("chunk")
    shape = f"`{id_col}` long, {COUNTED}" + (", groups string" if keep_groups else "")
    return own.cogroup(priced.groupBy("chunk")).applyInArrow(totals, shape)
