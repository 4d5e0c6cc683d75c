"""Expected periods: every combination of years, months and institution tokens.

A grid is one row of parameter arrays unfolded by generators: no join, no shuffle
but the final sort.  The arrays come from arguments or, in the ``*_of`` forms, from
an aggregate over a table.
"""

from __future__ import annotations

import datetime
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.functions.names import file_of_period
from finfilings.functions.periods import months_between, pad_month, yyyymm
from finfilings.vocab import BALANCE_TYPES, INDICATOR_TYPES, INSTITUTION_TYPES, PAGE_ROWS


# --- argument checks --------------------------------------------------------------


def wanted_tokens(tokens, vocabulary, strict: bool = True) -> list[str]:
    """The wanted tokens in the vocabulary's order, each once, whatever their case.

    Tokens that the vocabulary lacks fail the call if ``strict``, and are left out with a
    warning otherwise; a call that keeps no token fails too.
    """
    wanted = {str(t).upper() for t in _as_list(tokens)}
    strangers = ", ".join(sorted(wanted.difference(vocabulary)))
    kept = [t for t in vocabulary if t in wanted]
    if strangers and not strict:
        warnings.warn(f"left out, as no list of that kind exists: {strangers}", stacklevel=2)
    if (strangers and strict) or not kept:
        raise ValueError(f"kinds to choose from: {', '.join(vocabulary)}; asked for: {strangers or 'none'}")
    return kept


def month_argument(text) -> datetime.date:
    """``YYYYMM`` or an ISO date; anything else is an error."""
    value = str(text).strip()
    try:
        if len(value) == 6 and value.isdigit():
            return datetime.date(int(value[:4]), int(value[4:]), 1)
        return datetime.date.fromisoformat(value[:10])
    except ValueError:
        raise ValueError(f"{text!r} is neither YYYYMM nor a date") from None


def checked_months(months) -> list[int]:
    months = [int(m) for m in _as_list(months)]
    if any(m < 1 or m > 12 for m in months):
        raise ValueError("months go from 1 to 12")
    return months


def checked_years(years) -> list[int]:
    years = [int(y) for y in _as_list(years)]
    if any(y < 2000 or y > datetime.date.today().year for y in years):
        warnings.warn("year outside the published range; data may be missing", stacklevel=2)
    return years


def checked_types(types) -> list[int]:
    types = [int(t) for t in _as_list(types)]
    if any(t not in INDICATOR_TYPES for t in types):
        raise ValueError("institution types are 1, 2, 3 and 4")
    return types


def _as_list(value) -> list:
    return list(value) if isinstance(value, (list, tuple, set, range)) else [value]


# --- token tables -------------------------------------------------------------------


def known_tokens(df: DataFrame, name: str, vocabulary) -> DataFrame:
    """Rows whose token, in upper case, is in the vocabulary."""
    return df.where(F.upper(F.col(name)).isin(list(vocabulary)))


def unknown_tokens(df: DataFrame, name: str, vocabulary) -> DataFrame:
    """Distinct tokens that are not in the vocabulary."""
    token = F.upper(F.col(name))
    return df.where(token.isNotNull() & ~token.isin(list(vocabulary))).select(token.alias(name)).distinct()


def label_of(token: Column, vocabulary: dict) -> Column:
    """Label of a token, NULL for an unknown one."""
    pairs = [F.lit(x) for pair in vocabulary.items() for x in pair]
    return F.create_map(*pairs)[token]


# --- grids --------------------------------------------------------------------------


def unfold(dims: DataFrame, *names: str, sort: bool = False) -> DataFrame:
    """Cross product of the array columns of a table, duplicates kept."""
    out = dims
    for name in names:
        rest = [c for c in out.columns if c != name]
        out = out.select(*rest, F.explode(name).alias(name))
    out = out.select(*names, *[c for c in dims.columns if c not in names])
    return out.orderBy(*names) if sort else out


def _row(spark: SparkSession, **arrays) -> DataFrame:
    return spark.range(1).select(*[F.array(*[F.lit(x) for x in v]).alias(k) for k, v in arrays.items()])


def balance_grid_of(dims: DataFrame) -> DataFrame:
    """Balance grid from arrays ``year, month, institution``: distinct and sorted, with
    padded month, label and expected name."""
    sets = dims.select(*[F.array_distinct(c).alias(c) for c in ("year", "month", "institution")])
    grid = unfold(sets, "year", "month", "institution")
    period = yyyymm(F.col("year"), F.col("month"))
    return grid.select(
        "year",
        "month",
        "institution",
        pad_month(F.col("month")).alias("month_text"),
        label_of(F.col("institution"), BALANCE_TYPES).alias("label"),
        F.concat(period, F.col("institution"), F.lit(".CSV")).alias("expected_name"),
    ).orderBy("year", "month", "institution")


def balance_grid(spark: SparkSession, institution, months=12, first_year=1993, final_year=None) -> DataFrame:
    final_year = final_year or datetime.date.today().year - 1
    step = 1 if final_year >= first_year else -1
    return balance_grid_of(
        _row(
            spark,
            year=range(first_year, final_year + step, step),
            month=checked_months(months),
            institution=wanted_tokens(institution, BALANCE_TYPES),
        )
    )


def institution_grid_of(dims: DataFrame) -> DataFrame:
    """Expected institution lists from ``institution`` (array), ``start`` and ``end``."""
    months = dims.select("institution", months_between(F.col("start"), F.col("end")).alias("period"))
    grid = unfold(months, "institution", "period")
    return grid.select(
        "institution",
        "period",
        label_of(F.col("institution"), INSTITUTION_TYPES).alias("label"),
        F.concat_ws("_", "institution", F.concat("period", F.lit(".zip"))).alias("expected_name"),
    )


def institution_grid(spark: SparkSession, institution, start_date, end_date) -> DataFrame:
    tokens = wanted_tokens(institution, INSTITUTION_TYPES, strict=False)
    start, end = month_argument(start_date), month_argument(end_date)
    if (start.year, start.month) > (end.year, end.month):
        raise ValueError("start_date lies after end_date")
    row = _row(spark, institution=tokens)
    return institution_grid_of(row.select("institution", F.lit(start).alias("start"), F.lit(end).alias("end")))


def values_grid_of(dims: DataFrame) -> DataFrame:
    """Indicator grid from arrays ``year, month, inst_type``; duplicates kept."""
    grid = unfold(dims.select("year", "month", "inst_type"), "year", "month", "inst_type")
    return grid.withColumn("period", yyyymm(F.col("year"), F.col("month")))


def values_grid(spark: SparkSession, year, month, type_institution=3) -> DataFrame:
    return values_grid_of(
        _row(spark, year=checked_years(year), month=checked_months(month), inst_type=checked_types(type_institution))
    )


def registry_grid_of(dims: DataFrame) -> DataFrame:
    """Registry grid from arrays ``year, month``; duplicates kept."""
    grid = unfold(dims.select("year", "month"), "year", "month")
    return grid.withColumn("period", yyyymm(F.col("year"), F.col("month")))


def registry_grid(spark: SparkSession, year, month) -> DataFrame:
    return registry_grid_of(_row(spark, year=checked_years(year), month=checked_months(month)))


def page_offsets(total: Column, page_rows: int = PAGE_ROWS) -> Column:
    """Offsets of the pages that cover ``total`` rows: 0, 500, … up to the total; none
    for an empty result."""
    none = F.array().cast("array<bigint>")
    return F.when(total > 0, F.sequence(F.lit(0).cast("bigint"), total.cast("bigint"), F.lit(page_rows).cast("bigint"))).otherwise(none)


def page_plan(totals: DataFrame, total: str = "total_rows", page_rows: int = PAGE_ROWS) -> DataFrame:
    """One row per planned page of each result."""
    rest = [c for c in totals.columns if c != total]
    return totals.select(*rest, total, F.explode(page_offsets(F.col(total), page_rows)).alias("start_row"))


def expected_landing(period: Column, institution: Column, suffix: str) -> Column:
    return file_of_period(period, institution, suffix)
