"""Language by compression: one zstandard raw-content dictionary per language, the smallest encoding wins.

A text is reduced to its lower-case letters with single spaces and encoded in pieces, whole, with each language's
dictionary. Equal sizes go to the language with more training rows, then by name. A narrow margin between the two
smallest sizes marks the prediction as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwave.llm.common import whole_text

UNKNOWN = "und"
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")
#: Bytes of a text that are encoded at a time; all pieces count.
PIECE = 8192


@dataclass
class LanguageModel:
    """Dictionaries by language, in order of preference on ties."""

    dictionaries: dict[str, bytes]
    level: int = 9
    least_margin: float = 0.01
    _coders: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_coders": []}

    def coders(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        if not self._coders:
            for name, raw in self.dictionaries.items():
                content = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(level=self.level)
                self._coders.append((name, zstandard.ZstdCompressor(dict_data=content)))
        return self._coders

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the margin is too narrow to trust."""
        plain = letters(text)
        if not plain or not self.dictionaries:
            return UNKNOWN, 0.0, True
        data = plain.encode("utf-8", "replace")
        pieces = [data[k : k + PIECE] for k in range(0, len(data), PIECE)]
        sizes = [(sum(len(c.compress(p)) for p in pieces), rank) for rank, (_, c) in enumerate(self.coders())]
        sizes.sort()
        margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0] if len(sizes) > 1 else 1.0
        return self.coders()[sizes[0][1]][0], 1 - 2.0 ** (-margin / 0.02), margin < self.least_margin


def letters(text: str | None) -> str:
    """Letters and their marks with single spaces; empty without a letter."""
    if not LETTER.search(text or ""):
        return ""
    return NOT_LETTERS.sub(" ", (text or "").lower()).strip()


def learn(
    docs: DataFrame,
    training: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    dictionary_bytes: int = 98_304,
    most_languages: int = 400,
) -> LanguageModel:
    """Dictionaries from a bounded sample: for each language the rows with the smallest hashes of the id, whole texts,
    until ``dictionary_bytes`` are full. Only the ``most_languages`` values with most training rows get a dictionary.
    """
    text = F.regexp_replace(F.lower(whole_text(text_col)), r"[^\p{L}\p{M}]+", " ")
    rows = docs.where(training & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.groupBy(F.col(lang_col).alias("lang")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.octet_length(text_col)).alias("mean")
    )
    known = counts.orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    if not known:
        return LanguageModel({})
    # A row enters the sample by its hash; the share is set so that a few times the wanted bytes are expected.
    share = {r["lang"]: min(1.0, (8 * dictionary_bytes / max(1.0, r["mean"]) + 64) / r["n"]) for r in known}
    table = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    place = F.crc32(F.concat(F.lit("lang:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    some = rows.where(place < table[F.col(lang_col)] * float(1 << 32)).select(
        F.col(lang_col).alias("lang"), place.alias("place"), F.trim(text).alias("text")
    )
    before = W.partitionBy("lang").orderBy("place", "text").rowsBetween(W.unboundedPreceding, -1)
    some = some.where("text <> ''").withColumn("before", F.coalesce(F.sum(F.octet_length("text") + 1).over(before), F.lit(0)))
    some = some.where(F.col("before") < dictionary_bytes).withColumn("text", F.substring("text", 1, dictionary_bytes))
    texts: dict[str, list[bytes]] = {r["lang"]: [] for r in known}
    for r in some.orderBy("lang", "before").collect():
        texts[r["lang"]].append(r["text"].encode())
    return LanguageModel({k: b" ".join(v)[:dictionary_bytes] for k, v in texts.items() if v})


def predict_languages(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", also: tuple[Column, ...] = ()
) -> DataFrame:
    """``id_col``, the columns ``also``, ``lang_pred``, ``score``, ``rejected`` for every row.

    ``und`` with score 0 if the text is NULL or has no letter. The whole text is encoded.
    """
    source = docs.select(F.col(id_col).alias("id"), *also, F.col(text_col).alias("text"))
    kept = source.drop("text").schema
    names = [*kept.names, "lang_pred", "score", "rejected"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, rejected = zip(*[model.predict(t.as_py()) for t in batch.column("text")], strict=True)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    out = source.mapInArrow(rows, f"{fields}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", id_col)
