"""Months and years as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_month(month: Column) -> Column:
    return F.lpad(month.cast("string"), 2, "0")


def yyyymm(year: Column, month: Column) -> Column:
    return F.format_string("%d%02d", year.cast("int"), month.cast("int"))


def parse_month(c: Column) -> Column:
    """``YYYYMM`` or an ISO date, as a date; NULL when it is neither."""
    text = F.trim(c)
    compact = F.concat(text, F.lit("01")).try_cast("string")
    return F.when(
        text.rlike(r"^\d{6}$"), F.try_to_date(compact, "yyyyMMdd")
    ).otherwise(F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.substring(text, 1, 10).try_cast("date")))


def months_between(start: Column, end: Column) -> Column:
    """Every month from start to end, both included, as an array of YYYYMM."""
    first, last = F.trunc(start, "MM"), F.trunc(end, "MM")
    months = F.sequence(first, last, F.make_interval(months=F.lit(1)))
    return F.transform(months, lambda d: F.date_format(d, "yyyyMM"))


def ref_month(period: Column) -> Column:
    """First day of a YYYYMM period."""
    return F.try_to_date(F.concat(period, F.lit("01")), "yyyyMMdd")
