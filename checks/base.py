"""Registry of queries and helpers that print tables as raw filings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that must agree."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a table with fewer splits than cores, over all cores.  A table of many
    splits is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def money_text(c: Column) -> Column:
    """1234,56"""
    return F.translate(money(c).cast("string"), ".", ",")


def as_double(c: Column) -> Column:
    return F.round(c.cast("double"), 2)


def month_text(c: Column) -> Column:
    return F.date_format(c, "yyyyMM")


def lines_with_head(body: DataFrame, head_of: Callable[[], list], *keys: str) -> DataFrame:
    """Add header lines to printed rows, as lines ``file_name, pos, line``.

    ``body`` has ``file_name, pos, line`` and the columns ``keys``; the head lines of
    a file may depend on them.  Rows stay rows: no file is gathered anywhere.
    """
    files = body.select("file_name", *keys).distinct()
    head = files.select("file_name", F.posexplode(F.array(*head_of())).alias("pos", "line"))
    # behind a generator, as behind a scan, nothing moves into the printing of a line
    printed = body.select("file_name", (F.col("pos") + 1_000).cast("bigint").alias("pos"), F.explode(F.array("line")).alias("line"))
    return head.select("file_name", F.col("pos").cast("bigint"), "line").unionByName(printed)


def payload_of(df: DataFrame, file_name: Column, lines: list[Column], charset: str = "ISO-8859-1", *keep: str) -> DataFrame:
    """Print each row as a file of its own."""
    content = F.encode(F.concat_ws("\n", *lines), charset)
    return df.select(file_name.alias("file_name"), F.explode(F.array(content)).alias("content"), *keep)
