"""A training corpus from ``documents``: drop toxic rows, near copies and benchmark leaks, mix sources, write tokens.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``. Rows with NULL texts or ids pass like empty texts; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwave.llm import decontaminate, mixing, ordinal_toxicity, simhash_dedup, token_files
from panelwave.llm.common import stored, table
from panelwave.llm.queries import tokenizer_path

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the ordinal model does not hold toxic; it learns from all labels, as nothing is measured here."""
    model = ordinal_toxicity.learn(docs, table(spark, sf_dir, "labels"), F.lit(True))
    scored = ordinal_toxicity.toxicity_scores(docs, model, keep_columns=True)
    return scored.where(~F.col(scored.columns[-1])).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies (SimHash, then similarity 0.8 on five words), once."""
    return simhash_dedup.first_of_similar(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which no benchmark item occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents by the words that the mix takes of them, to the nearest whole document."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns one row per document read back from them."""
    return token_files.token_files(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("source_mix", mix_sources),
    ("token_output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
