"""Cleaning of raw survey text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwave.spec import UNKNOWN

# Texts that mean "no answer", whatever their case.
SENTINELS = (
    "", "nan", "none", "null", "na", "n/a", "#n/a", ".", "-",
    "inf", "+inf", "-inf", "infinity", "-infinity",
)
# Number formats found in period files.
INTEGRAL_TEXT = r"^([+-]?\d+)\.0+$"
THOUSANDS_TEXT = r"^[+-]?\d{1,3}(,\d{3})+(\.\d+)?$"
CLEAN_NUMBER = r"^[+-]?\d+(\.\d*[1-9])?\z"
PLAIN_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)$"
PERIOD_TEXT = r"20\d{2}T[1-4]"

WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0      "
    "          　"
)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def normalize_cell(col: Column) -> Column:
    """Trimmed text; sentinels become NULL, ``1,234.5`` and ``12.0`` plain numbers.

    Most cells are numbers that need no cleaning; one match lets them pass.
    """
    text = strip(col)
    number = F.when(text.rlike(THOUSANDS_TEXT), F.translate(text, ",", "")).otherwise(text)
    cleaned = F.when(~F.lower(text).isin(*SENTINELS), F.regexp_replace(number, INTEGRAL_TEXT, "$1"))
    return F.when(col.rlike(CLEAN_NUMBER), col).otherwise(cleaned)


def decimal_comma(col: Column) -> Column:
    """Number whose comma is the decimal mark; anything else is NULL."""
    text = F.regexp_replace(strip(col), ",", ".")
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def clean_code(col: Column, unknown: str = UNKNOWN) -> Column:
    text = strip(col)
    return F.when(col.isNull() | (text == ""), F.lit(unknown)).otherwise(
        F.regexp_replace(text, r"\.0$", "")
    )


def is_blank(col: Column) -> Column:
    return col.isNull() | (strip(col) == "")


def period_from_name(name: Column) -> Column:
    """``YYYYTn`` from a file name, or NULL.

    A plain ``YYYYTn`` wins. Otherwise a year plus a quarter that is marked as
    such (``T2``, ``Q2``, ``2do trimestre``, ``trimestre 2``, or a roman numeral
    standing alone) is used, so a digit of the year is never taken for a quarter.
    """
    upper = F.upper(name)
    squeezed = F.regexp_replace(upper, "[^A-Z0-9]", "")
    direct = F.regexp_extract(squeezed, PERIOD_TEXT, 0)
    words = F.regexp_replace(upper, r"[^A-Z0-9]+", " ")
    year = F.regexp_extract(words, r"(20\d{2})", 1)
    rest = F.regexp_replace(words, r"20\d{2}", " ")
    before = F.regexp_extract(rest, r"([1-4])\s*(?:ER|DO|TO|RO|O)?\s*TRIM", 1)
    after = F.regexp_extract(rest, r"(?:TRIMESTRE|TRIM|T|Q)\s*([1-4])(?!\d)", 1)
    roman = F.regexp_extract(rest, r"(?:^|\s)(IV|III|II|I)(?:\s|$)", 1)
    quarter = F.coalesce(
        F.nullif(before, F.lit("")),
        F.nullif(after, F.lit("")),
        F.when(roman == "I", "1").when(roman == "II", "2").when(roman == "III", "3").when(roman == "IV", "4"),
    )
    return F.when(direct != "", direct).when(year != "", F.concat(year, F.lit("T"), quarter))


def as_raw_text(df: DataFrame) -> DataFrame:
    """Every column as the text a raw file would hold, header trimmed and upper-cased."""
    return df.select(*[_cell_text(f.name, f.dataType.simpleString()) for f in df.schema.fields])


def _cell_text(name: str, kind: str) -> Column:
    col = F.col(f"`{name}`")
    if kind == "boolean":
        text = col.cast("int").cast("string")
    elif kind in ("double", "float"):
        whole = col.try_cast("decimal(38,0)")
        finite = ~F.isnan(col) & (F.abs(col) < F.lit(float("inf")))
        text = F.when(finite, F.when(col == whole.cast("double"), whole.cast("string")).otherwise(col.cast("string")))
    else:
        text = col.cast("string")
    return text.alias(name.strip().upper())


def stated(*parts: tuple[str, Column, int]) -> Column:
    """Named values as one text, ``value name`` each with its number of decimals; NULL values are left out."""
    return F.concat_ws(", ", *[F.concat(F.format_number(v, places), F.lit(f" {name}")) for name, v, places in parts])
