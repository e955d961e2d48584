"""Token files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

An id is replaced by its rank in the corpus (0 is the most frequent), written in one to four little-endian bytes; the
lengths of four ids share one control byte, and control bytes precede the data bytes of a block, so numpy decodes a
block by table lookup. A shard holds the documents of one id range in ascending order as a sequence of blocks:

    header   5 unsigned 32-bit integers: magic, documents, ids, control bytes, data bytes
    ids of documents (64 bits each), a byte each with flags (1: NULL id, 2: the document goes on in the next block),
    lengths in ids (64 bits each)
    control bytes, data bytes

A long document may run through several blocks; its parts follow each other. ``ranks`` in the same folder lists the ids
by rank, 32 bits each.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwave.llm.common import shared_folder, stored, whole_text

MAGIC = 0x314B5450
HEADER = "<5I"
#: Ids in a block and, on average, in a shard; they bound the memory of a task.
BLOCK_IDS = 1 << 20
SHARD_IDS = 8_000_000
#: Pieces whose ids a worker remembers.
CACHE_PIECES = 1_500_000
# Fixed value: the pattern by which the tokenizer of the queries cuts texts.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of these characters are their own normal form but for case, and PIECE cuts them as SPLIT does.
PLAIN = re.compile("[\t-\r -~\u00c0-\u012f\u0131-\u017e]*")
PIECE = re.compile(
    "[a-z\u00df-\u00f6\u00f8-\u017e]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\t-\r a-z0-9\u00df-\u00f6\u00f8-\u017e]+"
)
LENGTHS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def coded(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of the ranks."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    bits = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    bits[: len(ranks)] = size - 1
    four = bits.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.tobytes(), data.tobytes()


def decoded(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of a block: lengths by table, four bytes from every offset, masked by length."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    four = raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16 | raw[at + 3] << 24
    return four & MASKS[size]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> tuple:
    """The tokenizer, its model's encoder, the ids of pieces met so far, and whether it cuts texts at PIECE."""
    # Tasks share the cores already; threads for a few new pieces cost more than they save.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    rules = json.loads(model.to_str())
    steps = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
    cuts = [x["type"] for x in steps] == ["Split", "ByteLevel"] and steps[0]["pattern"] == {"Regex": SPLIT}
    lower = "Lowercase" in [x["type"] for x in (rules["normalizer"] or {}).get("normalizers", [])]
    return model, model.model.tokenize, {}, cuts and lower and rules["post_processor"] is None


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


LETTERS = {b: c for b, c in enumerate(byte_letters())}


def text_ids(text: str, path: str, kind: str) -> bytes:
    """Ids of a text. A plain text is cut as the tokenizer cuts it, and each new piece is encoded once."""
    model, encoder, known, cuts = tokenizer(path)
    if not (cuts and PLAIN.fullmatch(text) and "<|" not in text):
        return np.array(model.encode(text, add_special_tokens=False).ids, kind).tobytes()
    if len(known) > CACHE_PIECES:
        known.clear()
    letter = {"2": "<%dH", "4": "<%dI"}[kind[2]]
    pieces = PIECE.findall(text.lower())
    ids = list(map(known.get, pieces))
    if None in ids:
        for at, found in enumerate(ids):
            if found is None:
                piece = pieces[at]
                found = known.get(piece)
                if found is None:
                    new = [t.id for t in encoder(piece.encode().decode("latin-1").translate(LETTERS))]
                    found = known[piece] = struct.pack(letter % len(new), *new)
                ids[at] = found
    return b"".join(ids)


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that Spark names."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:") :]
    return fs.FileSystem.from_uri(folder)


def encode(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``ids`` (bytes of its ids with the end id) and ``n`` of every row, stored."""
    from tokenizers import Tokenizer

    kind = "<u2" if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    end = np.array([end_id], kind).tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [text_ids(t.as_py(), path, kind) + end for t in batch.column(1)]
            n = pa.array([len(x) // int(kind[2]) for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), n], ["id", "ids", "n"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    out = stored(source.mapInArrow(rows, "id long, ids binary, n long"), "token-ids")
    return out.withColumn("width", F.lit(int(kind[2])))


def rank_order(encoded: DataFrame) -> tuple[np.ndarray, int]:
    """All ids that occur, most frequent first (ties: smaller id), and how many ids there are in all."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                kind = f"<u{batch.column('width')[0].as_py()}"
                for k in range(0, batch.num_rows, 512):
                    raw = b"".join(batch.column("ids").slice(k, 512).to_pylist())
                    new = np.bincount(np.frombuffer(raw, kind), minlength=len(total))
                    new[: len(total)] += total
                    total = new
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["token", "n"])

    counts = encoded.select("ids", "width").mapInArrow(rows, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    # One row per id of the vocabulary at most.
    known = counts.orderBy(F.desc("n"), "token").collect()
    return np.array([r["token"] for r in known], np.int64), sum(r["n"] for r in known)


def write_files(encoded: DataFrame, folder: str, order: np.ndarray, total: int) -> DataFrame:
    """Writes the shards and ``ranks``; one row per shard: ``shard``, ``file``, ``n_docs``, ``n_ids``, stored.

    A task writes to a name of its own attempt and moves the complete file to its place, so retries leave one file.
    """
    target, root = file_system(folder)
    target.create_dir(root, recursive=True)
    with target.open_output_stream(f"{root}/ranks") as out:
        out.write(order.astype("<u4").tobytes())
    rank_of = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    rank_of[order] = np.arange(len(order))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard = task.partitionId()
        name = f"{root}/shard-{shard:06d}"
        n_docs = n_ids = 0
        to, _ = file_system(folder)
        with to.open_output_stream(f"{name}.{task.taskAttemptId()}") as out:
            held: list[tuple[int | None, np.ndarray, int]] = []
            size = 0

            def flush() -> None:
                nonlocal held, size
                ids = np.concatenate([x for _, x, _ in held])
                control, data = coded(rank_of[ids])
                out.write(struct.pack(HEADER, MAGIC, len(held), len(ids), len(control), len(data)))
                out.write(np.array([k or 0 for k, _, _ in held], "<i8").tobytes())
                out.write(np.array([flags for _, _, flags in held], np.uint8).tobytes())
                out.write(np.array([len(x) for _, x, _ in held], "<i8").tobytes())
                out.write(control)
                out.write(data)
                held, size = [], 0

            for batch in batches:
                for key, raw, width in zip(*(batch.column(c) for c in ("id", "ids", "width")), strict=True):
                    ids = np.frombuffer(raw.as_py(), f"<u{width.as_py()}")
                    n_docs += 1
                    n_ids += len(ids)
                    for k in range(0, len(ids), BLOCK_IDS):
                        flags = (key.as_py() is None) | 2 * (k + BLOCK_IDS < len(ids))
                        held.append((key.as_py(), ids[k : k + BLOCK_IDS], flags))
                        size += len(held[-1][1])
                        if size >= BLOCK_IDS:
                            flush()
            if held:
                flush()
        to.move(f"{name}.{task.taskAttemptId()}", name)
        yield pa.RecordBatch.from_arrays(
            [pa.array([v]) for v in (shard, f"{folder}/shard-{shard:06d}", n_docs, n_ids)], ["shard", "file", "n_docs", "n_ids"]
        )

    shards = max(1, -(-total // SHARD_IDS))
    keys = [F.asc_nulls_first("id"), F.xxhash64("ids"), F.col("ids")]
    dealt = encoded.repartitionByRange(shards, *keys[:2]).sortWithinPartitions(*keys)
    written = dealt.select("id", "ids", "width").mapInArrow(rows, "shard long, file string, n_docs long, n_ids long")
    return stored(written, "token-shards")


def read_blocks(file: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of every block of a shard: document ids, flags, lengths, and the ranks."""
    source, path = file_system(file)
    with source.open_input_stream(path) as f:
        while head := f.read(struct.calcsize(HEADER)):
            magic, docs, n, control, data = struct.unpack(HEADER, head)
            if magic != MAGIC:
                raise ValueError(f"{file} is no token file")
            keys = np.frombuffer(f.read(8 * docs), "<i8")
            flags = np.frombuffer(f.read(docs), np.uint8)
            lengths = np.frombuffer(f.read(8 * docs), "<i8")
            yield keys, flags, lengths, decoded(f.read(control), f.read(data), n)


def read_ranks(folder: str) -> np.ndarray:
    """The ids by rank, as unsigned 32-bit integers."""
    source, path = file_system(f"{folder}/ranks")
    with source.open_input_stream(path) as f:
        return np.frombuffer(f.read(), "<u4")


def digest(shards: DataFrame) -> DataFrame:
    """Reads the shards and their ``ranks`` back: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document."""
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    placed = shards.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).select("shard", "file", "base")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                at, crc, n = base, 0, 0
                table = read_ranks(file.rpartition("/")[0])
                for keys, flags, lengths, ranks in read_blocks(file):
                    ids = table[ranks]
                    out = []
                    begin = 0
                    for key, flag, length in zip(keys.tolist(), flags.tolist(), lengths.tolist(), strict=True):
                        part = ids[begin : begin + length]
                        begin += length
                        crc, n = zlib.crc32(part.tobytes(), crc), n + length
                        if not flag & 2:
                            out.append((None if flag & 1 else key, at, n, crc))
                            at, crc, n = at + n, 0, 0
                    columns = list(zip(*out, strict=True)) or [()] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, shards.count())
    return placed.repartition(files, "shard").select("file", "base").mapInArrow(
        rows, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_files(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encodes all texts, writes the files to ``folder`` (by default in the shared folder) and returns ``digest``.

    NULL texts are empty and give the end id alone. Rows with a NULL id come first, repeated ids follow each other, each
    with its own entry. An empty table writes one empty shard and gives no rows.
    """
    encoded = encode(docs, tokenizer_path, end_id, id_col, text_col)
    order, total = rank_order(encoded)
    shards = write_files(encoded, folder or shared_folder(docs.sparkSession, "token-files"), order, total)
    return digest(shards)
