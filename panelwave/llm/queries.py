"""The operators as queries over the whole tables, with their reference SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwave.llm import alignment, cap_filters, decontaminate, divergence, html_blocks, langid, mil_quality, mixing
from panelwave.llm import ordinal_toxicity, run_index, secret_ledger, simhash_dedup, token_files
from panelwave.llm.common import crc_of_id, table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(crc_of_id(), F.lit(3)) == 1
    model = langid.learn(docs, ~held_out)
    return langid.predict_languages(docs, model, also=(held_out.alias("held_out"),))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.pmod(crc_of_id(), F.lit(5)) == 0
    model = mil_quality.learn(docs, labels, ~held_out)
    return mil_quality.quality_scores(docs, model, also=(held_out.alias("held_out"),))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "item_id", "start", F.round("similarity", 6).alias("similarity"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.pmod(crc_of_id(), F.lit(5)) == 0
    model = ordinal_toxicity.learn(docs, labels, ~held_out)
    return ordinal_toxicity.toxicity_scores(docs, model, also=(held_out.alias("held_out"),))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ledger.secret_scan(table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document, in all and for each shard."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    by_shard = F.array_join(F.col("shard_words").cast("array<string>"), ",").alias("shard_words")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", by_shard)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language from each other, and their most telling terms."""
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two public tokenizers, counted over all documents."""
    docs = table(spark, sf_dir, "documents")
    return alignment.aligned(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_long_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each text without the bytes of 400-byte strings that start anywhere else too."""
    return run_index.without_long_matches(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def reachable(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Lets Python workers on the driver's machine import this package wherever the driver was started."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {
    q.__name__: reachable(q)
    for q in (
        op1_vector_dedup, op2_language_id, op3_quality, op4_token_files, op5_html_text, op6_decontamination,
        op7_simhash_dedup, op8_toxicity, op9_secret_scan, op10_source_mix,
        op11_source_divergence, op12_token_alignment, op13_long_matches, pipeline,
    )
}
MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
  md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][(rank - 1) % 3 + 1] AS DOUBLE) AS weight, CAST(2 * source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE) - coalesce(sum(cap) OVER below, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS level FROM w
  WINDOW below AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (SELECT *, CASE WHEN cap <= level * weight THEN cap
    ELSE weight * max(level) FILTER (WHERE cap > level * weight) OVER () END AS target FROM l),
seats AS (SELECT rank, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, rank, k) AS place
  FROM a, generate_series(1, CAST(source_size // 16 + 2 AS BIGINT)) AS g(k) WHERE target > 0),
houses AS (SELECT shard, round((SELECT round(sum(target) / 32) FROM a) * shard / 8) AS house FROM generate_series(1, 8) AS g(shard)),
blocks AS (SELECT rank, shard, count(*) FILTER (place <= house) AS n FROM seats, houses GROUP BY rank, shard),
ends AS (SELECT rank, shard, least(coalesce(n, 0) * 32, 2 * source_size) AS upto FROM a CROSS JOIN houses LEFT JOIN blocks USING (rank, shard)),
plan AS (SELECT source, source_size, target, max(upto) AS words, list(upto ORDER BY shard) AS upto
  FROM a JOIN ends USING (rank) GROUP BY ALL),
laid AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(least(greatest(words - before, 0), size) + least(greatest(words - source_size - before, 0), size) AS BIGINT) AS taken,
  array_to_string(list_transform(range(1, 9), lambda j: CAST(
    least(greatest(upto[j] - before, 0), size) + least(greatest(upto[j] - source_size - before, 0), size)
    - least(greatest(coalesce(upto[j - 1], 0) - before, 0), size)
    - least(greatest(coalesce(upto[j - 1], 0) - source_size - before, 0), size) AS BIGINT)), ',') AS shard_words
FROM laid JOIN plan ON laid.source IS NOT DISTINCT FROM plan.source"""


def _secret_sql() -> str:
    """Every match of every rule with its place, from the pieces between the matches."""
    kinds = []
    for number, rule in enumerate(secret_ledger.RULES, 1):
        pattern = rule.pattern.replace("((?i)password|passwd|secret|token|api_?key)", "((?i:password|passwd|secret|token|api_?key))")
        quoted = pattern.replace("'", "''")
        kinds.append(
            f"SELECT doc_id, '{rule.kind}' AS kind, {number} AS k, unnest(string_split_regex(t, '{quoted}')) AS gap, "
            f"unnest(regexp_extract_all(t, '{quoted}', 0)) AS m, unnest(regexp_extract_all(t, '{quoted}', {rule.group})) AS part, "
            f"{rule.least} AS least, generate_subscripts(string_split_regex(t, '{quoted}'), 1) AS n FROM d"
        )
    base = ", ".join(f"'{r.kind}'" for r in secret_ledger.BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secret_ledger.BASE_RULES)
    out = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_ledger.BASE_RULES)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), each AS ({" UNION ALL ".join(kinds)}),
placed AS (SELECT *, sum(length(gap) + coalesce(length(m), 0)) OVER (PARTITION BY doc_id, k ORDER BY n) AS stop FROM each),
kept AS (SELECT doc_id, kind, k, CAST(stop - length(m) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM placed
  WHERE m IS NOT NULL AND length(part) >= least),
found AS (SELECT doc_id, {counts},
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (WHERE kind IN ({base})) AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans FROM kept GROUP BY doc_id)
SELECT doc_id, {out}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN found USING (doc_id)"""


DIVERGENCE_SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT lang, source, doc, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= 10),
l AS (SELECT lang, count(*) AS v, CAST(sum(lang_n) AS HUGEINT) AS lang_total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
s AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 2) // (CAST(coalesce(total, 0) AS HUGEINT) + 2 * v) AS BIGINT) AS p,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (lang_n + 2) // (lang_total + 2 * v) AS BIGINT) AS q
  FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM s AS a JOIN s AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM s WHERE n > 0 AND p > q),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r)
SELECT * FROM o WHERE part = 'pair' OR rank <= 10"""


SQL: dict[str, str] = {
    "op9_secret_scan": _secret_sql(), "op10_source_mix": MIX_SQL, "op11_source_divergence": DIVERGENCE_SQL,
}
