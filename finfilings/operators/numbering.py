"""Row numbers over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finfilings.session import settle


def number_rows(df: DataFrame, order, name: str = "row_number") -> DataFrame:
    """Number all rows from 1 in a total order, in parallel.

    A window without partitions would sort everything in one task.  Here the rows are
    range-sorted and settled; each partition learns how many rows stand before it
    from a table with one row per partition.
    """
    settled = settle(df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn(
        "_at", F.monotonically_increasing_id()
    ))
    parts = settled.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = F.broadcast(parts.select("_part", "_first", before.alias("_before")))
    number = (F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("bigint")
    return settled.join(starts, "_part").select(*df.columns, number.alias(name))
