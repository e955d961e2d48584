"""Secret scans with an incremental blob ledger.

Every version of a path is addressed by the SHA-256 of its content. Only pairs of blob and rule version that the ledger
does not hold are scanned; findings join back to all paths by the address. Everything runs as DataFrame expressions:
positions follow from the lengths of the pieces between matches.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwave.llm.common import shared_folder, stored, whole_text


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` is a Java pattern without empty matches; matches of ``group`` under ``least``
    characters are dropped after matching. ``hint`` is a cheap pattern that every kept match contains.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    hint: str = ""


BASE_RULES = (
    Rule(
        "assign",
        r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        hint=r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    ),
    # A run that is long enough is matched whole, so the least length can stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{16,}", hint="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}", hint="[0-9a-f]{24}"),
)
RULES = (
    *BASE_RULES,
    Rule("key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("bearer", r"gh[pousr]_[A-Za-z0-9]{36,}", hint="gh[pousr]_"),
)
LEDGER = "blob binary, kind string, version int, start int, stop int"


def address(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def suspected(text: Column, rules: tuple[Rule, ...]) -> Column:
    """Whether any rule can match; decides nothing but where the exact scan runs."""
    return reduce(lambda a, b: a | b, [text.rlike(r.hint or r.pattern) for r in rules])


def spans(blobs: DataFrame, rule: Rule) -> DataFrame:
    """``blob``, ``kind``, ``version``, ``start``, ``stop`` (code points, end exclusive) of the kept matches of one rule.

    ``blobs`` has ``blob`` and ``text``. Matches are leftmost and do not overlap; dropped ones still use up their text.
    """
    pattern = F.lit(rule.pattern)
    hit = blobs.where(F.col("text").rlike(rule.hint or rule.pattern))
    found = hit.select(
        "blob",
        F.transform(F.split("text", rule.pattern), F.length).alias("gaps"),
        F.transform(F.regexp_extract_all("text", pattern, F.lit(0)), F.length).alias("sizes"),
        F.transform(F.regexp_extract_all("text", pattern, F.lit(rule.group)), F.length).alias("kept"),
    )
    each = found.select("blob", F.posexplode(F.arrays_zip("gaps", "sizes", "kept")).alias("n", "m"))
    each = each.select("blob", "n", "m.gaps", "m.sizes", "m.kept").where("sizes is not null")
    upto = W.partitionBy("blob").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    stop = F.sum(F.col("gaps") + F.col("sizes")).over(upto).cast("int")
    each = each.select("blob", (stop - F.col("sizes")).alias("start"), stop.alias("stop"), "kept")
    return each.where(F.col("kept") >= rule.least).select(
        "blob", F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), "start", "stop"
    )


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def scan_new(
    versions: DataFrame, ledger: DataFrame, id_col: str, text_col: str, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Ledger rows of the blob and rule-version pairs that ``ledger`` lacks, stored.

    A scanned pair without a finding has one row with NULL ``start``. Each new blob is scanned once, by the rules that
    have not seen it; its text is not moved unless a rule's hint occurs in it.
    """
    text = whole_text(text_col)
    addressed = versions.select(F.col(id_col).alias("id"), text.alias("text"), address(text).alias("blob"))
    known = ledger.select("blob", "kind", "version").distinct()
    pairs = addressed.select("blob").distinct().select(
        "blob", F.explode(F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])).alias("r")
    )
    unseen = stored(
        pairs.select("blob", "r.kind", "r.version").join(known, ["blob", "kind", "version"], "left_anti"), "unseen-pairs"
    )
    fresh = addressed.where(suspected(F.col("text"), rules)).select("blob", "text").dropDuplicates(["blob"])
    waiting = unseen.groupBy("blob").agg(F.collect_set("kind").alias("kinds"))
    fresh = stored(fresh.join(waiting, "blob"), "unseen-blobs")
    found = reduce(DataFrame.union, [spans(fresh.where(F.array_contains("kinds", r.kind)), r) for r in rules])
    return stored(unseen.join(found, ["blob", "kind", "version"], "left").select("blob", "kind", "version", "start", "stop"), "ledger")


def findings(
    versions: DataFrame, ledger: DataFrame, id_col: str, text_col: str, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per version: the id, counts ``n_<kind>`` of the base rules, ``base_sha256`` and ``spans``.

    Spans are written kind:start:end, by start, then in the order of the rules, joined by commas; ``base_sha256`` hashes
    those of the base rules. Blobs without findings give 0, the hash of the empty text, and the empty text.
    """
    place = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    current = reduce(lambda a, b: a | b, [(F.col("kind") == r.kind) & (F.col("version") == r.version) for r in rules])
    rows = ledger.where(F.col("start").isNotNull() & current).distinct()
    base = [r.kind for r in BASE_RULES]
    span = F.struct("start", place.alias("place"), F.concat_ws(":", "kind", "start", "stop").alias("span"), F.col("kind").isin(base).alias("base"))
    found = rows.groupBy("blob").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in base], F.sort_array(F.collect_list(span)).alias("all")
    )
    written = lambda spans: F.array_join(F.transform(spans, lambda s: s["span"]), ",")
    found = found.select(
        "blob", *[f"n_{k}" for k in base],
        F.sha2(written(F.filter("all", lambda s: s["base"])), 256).alias("base_sha256"), written(F.col("all")).alias("spans"),
    )
    paths = versions.select(F.col(id_col), address(whole_text(text_col)).alias("_blob"))
    out = paths.join(found, paths["_blob"] == found["blob"], "left")
    return out.select(
        id_col, *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in base],
        F.coalesce("base_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )


def secret_scan(
    versions: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ledger_path: str | None = None,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Scans what the ledger at ``ledger_path`` lacks, appends it there, and returns ``findings`` for all versions.

    Without a path the ledger starts empty in the shared folder. NULL texts are empty. Repeated versions are scanned once
    and reported each. A run that dies before it appended is done again; repeated ledger rows change nothing.
    """
    spark = versions.sparkSession
    path = ledger_path or shared_folder(spark, "secret-ledger")
    files = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files)
    ledger = spark.read.schema(LEDGER).parquet(path) if exists else empty_ledger(spark)
    scan_new(versions, ledger, id_col, text_col, rules).write.mode("append").parquet(path)
    return findings(versions, spark.read.schema(LEDGER).parquet(path), id_col, text_col, rules)
