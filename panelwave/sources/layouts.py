"""Text files of one table whose headers differ: layouts found in tasks, one scan for each.

The driver holds what a file listing holds: the path of each file, grouped by
layout, and each distinct header once. Data rows are read by Spark's own CSV
scan, by position, so a column may stand anywhere and unused ones may repeat.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A file larger than this is still one partition of the header scan, of which one line is read.
WHOLE_FILE = str(1 << 50)


def headers(spark: SparkSession, path: str | Sequence[str], separator: str = ",") -> DataFrame:
    """``(file, names)`` of every file: its first line cut into trimmed names, blank ones at the end left out.

    Each file is one task, which stops after the first line. ``width`` counts
    all cells of that line. A file without a line has no row.
    """
    quiet = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):
        quiet.conf.set(f"spark.sql.files.{name}", WHOLE_FILE)
    quiet.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                line = batch.column(1)[0].as_py().removeprefix("﻿")
                cells = [c.strip() for c in next(csv.reader([line], delimiter=separator), [])]
                names = list(cells)
                while names and not names[-1]:
                    names.pop()
                columns = [batch.column(0).slice(0, 1), pa.array([len(cells)], pa.int32()), pa.array([names], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["file", "cells", "names"])
                return

    lines = quiet.read.text(path if isinstance(path, str) else list(path))
    return lines.select("_metadata.file_path", "value").mapInArrow(first_line, "file string, cells int, names array<string>")


def layouts(found: DataFrame, required: Sequence[str] = (), optional: Sequence[str] = ()) -> DataFrame:
    """One row per layout: its fingerprint, files, width, blank names, names present more than once, and, of the wanted
    columns, the required ones that are missing and the wanted ones present more than once; ``usable`` if there are none.
    """
    wanted, needed = F.array(*[F.lit(c) for c in (*required, *optional)]), F.array(*[F.lit(c) for c in required])
    none = F.array().cast("array<string>")
    named = F.filter("names", lambda c: c != "")
    repeated = F.array_sort(F.array_distinct(F.filter(named, lambda c: F.size(F.filter(named, lambda d: d == c)) > 1)))
    return (
        found.groupBy("cells", "names")
        .agg(F.sort_array(F.collect_list("file")).alias("files"))
        .select(
            F.sha2(F.to_json(F.struct("cells", "names")), 256).alias("layout"), "cells", "names", "files",
            F.size("names").alias("width"), F.size(F.filter("names", lambda c: c == "")).alias("blank"),
            repeated.alias("duplicates"), F.array_except(F.coalesce(needed.cast("array<string>"), none), "names").alias("missing"),
        )
        .withColumn("doubled", F.array_intersect(wanted.cast("array<string>"), "duplicates"))
        .withColumn("usable", (F.size("missing") == 0) & (F.size("doubled") == 0))
    )


def scan_layouts(
    spark: SparkSession, path: str | Sequence[str], required: Sequence[str], optional: Sequence[str] = (), separator: str = ","
) -> DataFrame:
    """The wanted columns as text from files of any layout, with ``source_file``; an optional column that a file lacks is NULL.

    A missing required column, or a wanted one present more than once, is an
    error that names the file, found before any data row is read.
    """
    every = layouts(headers(spark, path, separator), required, optional).collect()
    for row in every:
        if not row.usable:
            raise ValueError(f"{row.files[0]}: required columns missing: {row.missing}, columns present more than once: {row.doubled}")
    columns = [*required, *optional]
    if not every:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*columns, "source_file"]))
    scans = []
    for row in sorted(every, key=lambda r: r.layout):
        schema = ", ".join(f"_c{i} string" for i in range(row.cells))
        raw = spark.read.schema(schema).option("sep", separator).csv(row.files, header=True)
        place = {name: i for i, name in enumerate(row.names)}
        cells = [F.col(f"_c{place[c]}") if c in place else F.lit(None).cast("string") for c in columns]
        named = [cell.alias(c) for c, cell in zip(columns, cells, strict=True)]
        scans.append(raw.select(*named, F.col("_metadata.file_name").alias("source_file")))
    return reduce(DataFrame.unionByName, scans)
