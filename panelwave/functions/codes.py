"""Category codes, labels, bands and record identity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import pairwise
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwave.spec import UNKNOWN


def code_label(col: Column, domain: Sequence[int], unknown: str = UNKNOWN) -> Column:
    """The code as text if it lies in the domain, else (also for NULL) ``unknown``."""
    return F.when(col.isin(*domain), col.cast("string")).otherwise(F.lit(unknown))


def code_order(col: Column) -> Column:
    """Sort key: whole-number codes by value, then everything else by text, NULL last."""
    number = F.when(col.rlike(r"^\d+$"), col.try_cast("decimal(38,0)"))
    return F.struct(number.isNull().alias("other"), number.alias("number"), col.isNull().alias("none"), col.alias("text"))


def ordinal(col: Column) -> Column:
    return col.try_cast("double")


def record_id(*parts: Column) -> Column:
    """Parts joined by ``_``; NULL if any part is NULL, so no two ids can collapse."""
    return F.when(
        ~F.array_contains(F.array(*[p.isNull() for p in parts]), True),
        F.concat_ws("_", *[p.cast("string") for p in parts]),
    )


def band_names(names: Sequence[str]) -> list[str]:
    """Labels of the half-open bands between consecutive edges; the outer two have no edge on one side."""
    edges = [None, *names, None]
    return [
        f"<{upper}" if lower is None else f">={lower}" if upper is None else f"{lower}-{upper}"
        for lower, upper in pairwise(edges)
    ]


def band(value: Column, thresholds: Column, names: Sequence[str]) -> Column:
    """Band of a value: the number of edges at or below it is the place of its label. NULL has no band."""
    passed = reduce(add, [(value >= thresholds[i]).cast("int") for i in range(len(names))])
    return F.get(F.array(*map(F.lit, band_names(names))), passed)


def row_hash(*cols: Column, seed: int | None = None) -> Column:
    """64-bit hash for stable orderings; the seed enters as an int literal."""
    return F.xxhash64(*cols) if seed is None else F.xxhash64(*cols, F.lit(seed).cast("int"))


def row_fingerprint(columns: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256)


def row_json(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in columns]))
