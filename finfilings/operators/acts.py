"""Search, paging and text lookup of normative acts."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from finfilings.functions.text import cut_decimal_in, html_to_line, scrub_prefix_in, strip_tags_in
from finfilings.operators.numbering import number_rows
from finfilings.vocab import PAGE_ROWS

# Search fields that are cleaned, by kind of cleaning.
MARKED_FIELDS = ("RefinableString01", "RefinableString03")
TAGGED_FIELDS = ("AssuntoNormativoOWSMTXT", "HitHighlightedSummary")
NUMBER_FIELDS = ("NumeroOWSNMBR",)


def holds_any(text: Column, terms) -> Column:
    """Does the text contain one of the phrases, in any case?"""
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [lowered.contains(str(t).lower()) for t in terms])


def search_acts(
    df: DataFrame, terms, ini_date, end_date, text: str | list[str], date: str, key: str | None = None
) -> DataFrame:
    """Acts of a closed date interval that hold one of the terms.

    An end that is a day without a time takes in the whole day.  The bounds are plain
    comparisons, so they reach the scan; with a ``key`` the result is sorted by date
    descending, then key.
    """
    terms = [terms] if isinstance(terms, str) else list(terms)
    texts = [text] if isinstance(text, str) else list(text)
    hit = reduce(lambda a, b: a | b, [F.coalesce(holds_any(F.col(c), terms), F.lit(False)) for c in texts])
    until = F.col(date) <= F.lit(end_date)
    if isinstance(df.schema[date].dataType, (TimestampType, TimestampNTZType)) and len(str(end_date)) == 10:
        until = F.col(date) < F.lit(str(datetime.date.fromisoformat(str(end_date)) + datetime.timedelta(days=1)))
    found = df.where((F.col(date) >= F.lit(ini_date)) & until).where(hit)
    return latest_first(found, date, key) if key else found


def latest_first(df: DataFrame, date: str, key: str) -> DataFrame:
    return df.orderBy(F.col(date).desc(), F.col(key))


def one_page(df: DataFrame, order, start_row: int, page_rows: int = PAGE_ROWS) -> DataFrame:
    """One page of the sorted rows."""
    return df.orderBy(*order).offset(start_row).limit(page_rows)


def paged(df: DataFrame, order, page_rows: int = PAGE_ROWS) -> DataFrame:
    """All rows with the offset of the page each belongs to."""
    numbered = number_rows(df, order)
    start = (F.floor((F.col("row_number") - 1) / page_rows) * page_rows).cast("bigint")
    return numbered.withColumn("start_row", start)


def clean_search_fields(df: DataFrame) -> DataFrame:
    """List markers, tags and decimal parts out of the fields that have them."""
    df = scrub_prefix_in(df, MARKED_FIELDS)
    df = strip_tags_in(df, TAGGED_FIELDS)
    return cut_decimal_in(df, NUMBER_FIELDS)


def join_texts(acts: DataFrame, texts: DataFrame, on) -> DataFrame:
    """Every act with its landed text elements; acts without text are kept.

    A plain left equi-join: adaptive execution broadcasts a text side it has measured
    to be small and splits hot keys otherwise.
    """
    return acts.join(texts, on, "left")


def clean_act_texts(df: DataFrame, names=("Assunto", "Texto"), block_sep: str = "") -> DataFrame:
    """HTML fields to one line of plain text."""
    present = [n for n in names if n in df.columns]
    return df.withColumns({n: html_to_line(F.col(n), block_sep) for n in present}) if present else df
