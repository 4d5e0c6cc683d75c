"""Incremental landing: parse files as they arrive.

The checkpoint of the stream remembers which files were read, which replaces the
"already there" test of a batch run.  The parse is one narrow stage without state,
so nothing has to be kept between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from finfilings.plans.balances import balances_from_lines, balances_from_payloads
from finfilings.session import stored
from finfilings.sources.delimited import BALANCES, reject_lines, reject_payloads
from finfilings.sources.landing import BALANCE_GLOB, WHOLE_FILE_BYTES, lines_of

FILE = "path string, modificationTime timestamp, length bigint, content binary"


def payload_stream(
    spark: SparkSession, path: str, glob: str = BALANCE_GLOB, files_per_batch: int = 1_000
) -> DataFrame:
    """New files of a folder as ``file_name, content``."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
    return files.select(F.substring_index("path", "/", -1).alias("file_name"), "content")


def stream_balances(
    spark: SparkSession, path: str, out_dir: str, checkpoint: str, files_per_batch: int = 1_000
) -> StreamingQuery:
    """Append the rows of newly landed balance files to a Parquet table, then stop.

    Partitioned by type and period, so readers prune; the file sink commits each batch
    exactly once.
    """
    rows = balances_from_payloads(payload_stream(spark, path, files_per_batch=files_per_batch))
    return (
        rows.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .partitionBy("inst_type", "data")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_balances_with_rejects(
    spark: SparkSession, path: str, out_dir: str, rejects_dir: str, checkpoint: str, files_per_batch: int = 1_000,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> StreamingQuery:
    """Like :func:`stream_balances`, and what gave no rows goes to a table ``file_name, reason,
    record`` (the record's first line, null for a whole file).

    Each batch is read once, with its broken records tagged, and written to folders of its
    own number, so a batch that is run again replaces what it wrote before.  Files above the
    size are read line by line, by many tasks.
    """
    files = (
        spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", BALANCE_GLOB).option("maxFilesPerTrigger", files_per_batch).load(path)
    )

    def land(batch: DataFrame, number: int) -> None:
        name = F.substring_index("path", "/", -1).alias("file_name")
        small = batch.where(F.col("length") <= whole_file_bytes).select(name, "content")
        tagged, bad = balances_from_payloads(small, tagged=True), reject_payloads(small, BALANCES)
        large = [r["path"] for r in batch.where(F.col("length") > whole_file_bytes).select("path").collect()]  # of files_per_batch at most
        if large:
            lines = lines_of(batch.sparkSession, large, BALANCES.charset)
            tagged, bad = tagged.unionByName(balances_from_lines(lines, tagged=True)), bad.unionByName(reject_lines(lines, BALANCES))
        tagged = stored(tagged)
        rows = tagged.where("reason IS NULL").drop("reason", "record")
        rows.write.mode("overwrite").partitionBy("inst_type", "data").parquet(f"{out_dir}/batch={number}")
        broken = tagged.where("reason IS NOT NULL").select("file_name", "reason", "record")
        broken.unionByName(bad.withColumn("record", F.lit(None).cast("string"))).write.mode("overwrite").parquet(f"{rejects_dir}/batch={number}")

    return files.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
