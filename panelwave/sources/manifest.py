"""Fingerprints of tables and the list of periods that still need work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprint_columns(df: DataFrame) -> tuple[Column, Column, Column, Column]:
    """Aggregates that identify the rows whatever their order: count, xor and sum of a 64-bit row hash, sum of a second one.

    A sum tells repeated rows apart, which cancel out in the xor. The hashes
    skip NULLs, so which cells are NULL is hashed as well.
    """
    cells = [c for name in sorted(df.columns) for c in (F.col(name), F.col(name).isNull())]
    one, two = F.xxhash64(*cells), F.xxhash64(F.lit(1), *cells)
    return F.count(F.lit(1)), F.bit_xor(one), F.sum(one.cast("decimal(20,0)")), F.sum(two.cast("decimal(20,0)"))


def fingerprint_text(rows: object, xor: object, total: object, second: object) -> str:
    """The text that ``fingerprint`` gives for these aggregates; an empty table has a count alone."""
    return "-".join([str(rows), *([] if xor is None else [f"{xor & 0xFFFFFFFFFFFFFFFF:X}", str(total), str(second)])])


def fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Content fingerprint that ignores row order and file layout, from partial aggregates."""
    rows, xor, total, second = fingerprint_columns(df)
    text = F.concat_ws("-", rows.cast("string"), F.hex(xor), total.cast("string"), second.cast("string"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), text.alias("fingerprint"))


def worklist(
    inputs: DataFrame,
    manifest: DataFrame,
    columns: Sequence[str],
    *,
    force: bool = False,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Input periods to process: content, column list or completeness changed.

    ``inputs`` is ``(period, fingerprint)``, ``manifest`` is ``(period,
    fingerprint, columns, complete)`` as recorded by earlier runs.
    """
    listed = F.lit(",".join(columns))
    wanted = inputs.where(F.col("period").isin(*only)) if only is not None else inputs
    if force:
        return wanted
    current = manifest.where(F.col("complete") & (F.col("columns") == listed)).select("period", "fingerprint")
    return wanted.join(current, ["period", "fingerprint"], "left_anti")


def manifest_rows(fingerprints: DataFrame, columns: Sequence[str], stored: DataFrame) -> DataFrame:
    """Manifest of the periods: ``complete`` where the stored output ``(period, rows)`` has the rows of the input."""
    found = fingerprints.join(stored.select("period", F.col("rows").alias("_stored")), "period", "left")
    same = F.coalesce(F.col("rows") == F.col("_stored"), F.lit(False))
    return found.select("period", "fingerprint", F.lit(",".join(columns)).alias("columns"), same.alias("complete"))
