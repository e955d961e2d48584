"""Scans of wide, differing period files by column name."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwave.functions.text import as_raw_text, is_blank, period_from_name

#: File blocks whose row counts one scan holds as an index, and the slots of its hash table.
INDEX_BLOCKS = 4096
INDEX_SLOTS = 1024


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the named columns reach the scan (see ``ReadSchema`` in the plan)."""
    return spark.read.parquet(path).select(*columns)


def scan_text_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """All columns as text, header trimmed and upper-cased, nothing inferred."""
    raw = spark.read.options(**options).csv(path, header=True, inferSchema=False)
    return as_raw_text(raw)


def scan_text_parquet(spark: SparkSession, path: str) -> DataFrame:
    return as_raw_text(spark.read.parquet(path))


def header_report(columns: Sequence[str]) -> dict[str, object]:
    """Width, blank and duplicate names of a header; trailing blanks do not count."""
    names = [(c or "").strip() for c in columns]
    while names and not names[-1]:
        names.pop()
    counts = Counter(n for n in names if n)
    return {
        "width": len(names),
        "blank": sum(not n for n in names),
        "duplicates": sorted(n for n, k in counts.items() if k > 1),
    }


def select_by_name(df: DataFrame, required: Sequence[str], extra: Sequence[str | Column] = ()) -> DataFrame:
    """The required columns of any layout, in the required order.

    Names are compared without surrounding blanks and exactly in case. A missing
    or doubly present required column is an error found before any data is read.
    """
    positions: dict[str, list[str]] = {}
    for name in df.columns:
        positions.setdefault(name.strip(), []).append(name)
    missing = [c for c in required if c not in positions]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    doubled = [c for c in required if len(positions[c]) > 1]
    if doubled:
        raise ValueError(f"required columns present more than once: {doubled}")
    return df.select(*extra, *[F.col(f"`{positions[c][0]}`").alias(c) for c in required])


def union_by_name(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def all_blank(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [is_blank(F.col(f"`{c}`").cast("string")) for c in columns])


def drop_blank_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.where(~all_blank(columns or df.columns))


def count_blank_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    blank = all_blank(columns or df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(blank).alias("blank_rows"),
        F.count_if(~blank).alias("data_rows"),
    )


def parquet_row_number(first: int = 2) -> Column:
    """Row number within a Parquet file, the first data row being ``first``."""
    return F.col("_metadata.row_index") + F.lit(first)


def number_text_rows(df: DataFrame, first: int = 2, name: str = "source_row", index_blocks: int = INDEX_BLOCKS) -> DataFrame:
    """Row number within each text file; rows stay in the task that reads them.

    A first pass counts the rows of each file block, and only those counts are
    shuffled. Their prefix sums form an index, which the numbering scan gets as
    one value and looks up by hash. Files are read in groups of about
    ``index_blocks`` blocks (or of one larger file), each with an index of its
    own, so the index of a scan does not grow with the table. ``df`` is a scan,
    possibly projected, whose ``_metadata`` can be resolved.
    """
    groups = file_groups(df, index_blocks)
    scans = [df] if len(groups) < 2 else [df.where(F.col("_metadata.file_path").isin(group)) for group in groups]
    numbered = [_numbered(scan, first, name) for scan in scans]
    return reduce(DataFrame.unionByName, numbered)


def file_groups(df: DataFrame, blocks: int) -> list[list[str]]:
    """The files of a scan in order, cut into groups of about ``blocks`` blocks; a larger file is a group of its own."""
    spark = df.sparkSession
    files = df.inputFiles()
    if not files:
        return []
    size = int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b"))
    lengths = spark.read.format("binaryFile").load(files).select("path", "length").collect()
    groups, held = [], blocks
    for path, length in sorted(map(tuple, lengths)):
        n = 1 + length // size
        if held + n > blocks:
            groups.append([])
            held = 0
        groups[-1].append(path)
        held += n
    return groups


def _numbered(scan: DataFrame, first: int, name: str) -> DataFrame:
    key = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
    place = F.monotonically_increasing_id()
    blocks = (
        scan.select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
            key.alias("key"), place.alias("place"),
        )
        .groupBy("file", "start", "key")
        .agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"))
    )
    ahead = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("place") + F.lit(first)
    entry = F.struct("key", F.col("shift").cast("long").alias("shift"))
    slots = blocks.withColumn("shift", shift).groupBy(F.pmod("key", F.lit(INDEX_SLOTS)).alias("slot")).agg(F.collect_list(entry).alias("held"))
    every = scan.sparkSession.range(INDEX_SLOTS).select(F.col("id").alias("slot")).join(slots, "slot", "left")
    rows = F.sort_array(F.collect_list(F.struct("slot", F.coalesce("held", F.array().cast("array<struct<key:bigint,shift:bigint>>")).alias("held"))))
    index = every.agg(F.transform(rows, lambda row: F.map_from_entries(row["held"])).alias("index")).scalar()
    slot = F.element_at(index, F.pmod(key, F.lit(INDEX_SLOTS)).cast("int") + 1)
    return scan.select(*scan.columns, (place + F.element_at(slot, key)).alias(name))


def with_provenance(df: DataFrame, manifest: DataFrame, file_name: str = "source_file") -> DataFrame:
    """Period, year and quarter of each row's file, from the manifest and never from the row.

    The manifest has one row per file ``(source_file, period, year, quarter)``;
    a file it does not list is left out, as an unidentifiable file is.
    """
    return df.join(manifest.select(file_name, "period", "year", "quarter"), file_name)


def source_file_name() -> Column:
    return F.col("_metadata.file_name")


def discover_periods(spark: SparkSession, root: str, periods: Sequence[str], glob: str = "*") -> DataFrame:
    """Expected periods against the files below ``root``: found, duplicate or missing.

    File contents are never read: only the path column of the listing is used.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path")
    )
    return period_status(listing.select(F.element_at(F.split("path", "/"), -1).alias("name")), periods)


def period_status(names: DataFrame, periods: Sequence[str]) -> DataFrame:
    """``(period, files, status)`` for a frame of file names (column ``name``)."""
    spark = names.sparkSession
    expected = spark.createDataFrame([(p,) for p in periods], "period string")
    found = (
        names.select(period_from_name(F.col("name")).alias("period"))
        .where(F.col("period").isNotNull())
        .groupBy("period")
        .agg(F.count(F.lit(1)).alias("files"))
    )
    files = F.coalesce(F.col("files"), F.lit(0))
    return expected.join(found, "period", "left").select(
        "period",
        files.alias("files"),
        F.when(files == 0, "missing").when(files > 1, "duplicate").otherwise("found").alias("status"),
    )
