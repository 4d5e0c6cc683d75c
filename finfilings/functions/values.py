"""Cell values: missing text, printed decimals, company numbers, charsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a missing cell, footnote marker, company-number width.
MISSING = ("", "NA")
FOOTNOTE = "FONTE"
CNPJ_WIDTH = 8


def decode_bytes(content: Column, charset: str = "ISO-8859-1") -> Column:
    """Bytes to text.  A string column from the text source holds the file's raw
    bytes, so it is decoded the same way."""
    return F.decode(content.cast("binary"), charset)


def null_text(c: Column) -> Column:
    """Trimmed text, NULL where the cell is empty or spelled as missing."""
    cell = F.trim(c)
    return F.when(~cell.isin(*MISSING), cell)


def parse_decimal(c: Column, precision: int = 38, scale: int = 10) -> Column:
    """Printed number to decimal; NULL where it is not one.  No digit that a filing prints
    is lost at the usual scale.

    With a comma the points are grouping marks and the comma is the decimal
    mark; without one the text is cast as it stands.
    """
    comma = F.translate(F.translate(c, ".", ""), ",", ".")
    return F.when(c.contains(","), comma).otherwise(c).try_cast(f"decimal({precision},{scale})")


def parse_integer(c: Column) -> Column:
    return F.trim(c).try_cast("int")


def cnpj_number(c: Column) -> Column:
    """Company number without points as a number; NULL when other signs remain."""
    return F.translate(c, ".", "").try_cast("double")


def cnpj_digits(c: Column) -> Column:
    """Digits of a company number as text."""
    return F.regexp_replace(c, r"\D", "")


def pad_cnpj(c: Column, width: int = CNPJ_WIDTH) -> Column:
    """Give a company number its leading zeros back; longer ones stay whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def is_footnote(c: Column) -> Column:
    return c.startswith(FOOTNOTE)
