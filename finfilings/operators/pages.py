"""Are the landed pages of a search complete, and which file holds a page of a result?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finfilings.operators.numbering import number_rows
from finfilings.sources.pages import SEARCH_PAGE
from finfilings.vocab import PAGE_ROWS


def page_spans(pages: DataFrame, keys=("search",), start: str = "start_row", payload: str = "payload") -> DataFrame:
    """``keys, begin, end, total_rows`` of each landed page: the rows of its search that it
    holds (end exclusive) and the number of rows the search announced.  Payloads that are no
    page hold nothing and announce nothing."""
    page = F.from_json(F.col(payload), SEARCH_PAGE)
    n = F.coalesce(F.size(page["Rows"]), F.lit(0))
    begin = F.col(start).cast("bigint")
    return pages.select(*keys, begin.alias("begin"), (begin + F.greatest(n, F.lit(0))).alias("end"), page["TotalRows"].alias("total_rows"))


def page_coverage(spans: DataFrame, keys=("search",)) -> DataFrame:
    """What is wrong with the landed pages of each search: ``keys, kind, begin, end``.

    ``gap``: rows that no page holds, up to the largest total announced; ``overlap``: rows
    that a page holds though one before it does; ``total``: pages announced different
    totals, the smallest and the largest; ``unknown``: no page announced one.  Searches
    without a fault give no rows.  The pages of a search are swept in order of their begin;
    a page is a row here, whatever it holds.
    """
    keys = list(keys)
    held = spans.where(F.col("end") > F.col("begin"))
    before = Window.partitionBy(*keys).orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    swept = held.select(*keys, "begin", "end", F.coalesce(F.max("end").over(before), F.lit(0)).alias("upto"))
    gaps = swept.where("begin > upto").select(*keys, F.lit("gap").alias("kind"), F.col("upto").alias("begin"), F.col("begin").alias("end"))
    doubled = swept.where("begin < upto").select(*keys, F.lit("overlap").alias("kind"), "begin", F.least("end", "upto").alias("end"))
    known = F.when(F.col("end") > F.col("begin"), F.col("end"))
    totals = spans.groupBy(*keys).agg(F.min("total_rows").alias("least"), F.max("total_rows").alias("most"), F.coalesce(F.max(known), F.lit(0)).alias("last"))
    tails = totals.where("most > last").select(*keys, F.lit("gap").alias("kind"), F.col("last").alias("begin"), F.col("most").alias("end"))
    changed = totals.where("least < most").select(*keys, F.lit("total").alias("kind"), F.col("least").alias("begin"), F.col("most").alias("end"))
    unknown = totals.where("most is null").select(*keys, F.lit("unknown").alias("kind"), F.lit(0).cast("bigint").alias("begin"), F.col("last").alias("end"))
    return gaps.unionByName(doubled).unionByName(tails).unionByName(changed).unionByName(unknown)


def land_pages(df: DataFrame, order, out_dir: str) -> str:
    """A result in its order, numbered from 0 as ``row``, with an index of its files.

    Rows are sorted by range, so each file holds a run of them; the index has the first and
    the last row of each file.  It is written last: a folder without one is not landed.
    """
    rows = number_rows(df, order, "row").withColumn("row", F.col("row") - 1)
    rows.write.mode("overwrite").parquet(f"{out_dir}/rows")
    spark = df.sparkSession
    files = spark.read.parquet(f"{out_dir}/rows").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("row").alias("first"), F.max("row").alias("last"))
    files.write.mode("overwrite").parquet(f"{out_dir}/index")
    return out_dir


def landed_page(spark: SparkSession, out_dir: str, start_row: int, page_rows: int = PAGE_ROWS) -> DataFrame:
    """One page of a landed result, in its order; only the files it lies in are opened."""
    schema = spark.read.parquet(f"{out_dir}/rows").schema
    index = spark.read.parquet(f"{out_dir}/index").where((F.col("first") < start_row + page_rows) & (F.col("last") >= start_row))
    files = [f"{out_dir}/rows/{r['file']}" for r in index.orderBy("first").limit(page_rows).collect()]
    if not files:
        return spark.createDataFrame([], schema).drop("row")
    page = spark.read.schema(schema).parquet(*files).where(F.col("row").between(start_row, start_row + page_rows - 1))
    return page.orderBy("row").drop("row")
