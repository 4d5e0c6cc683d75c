"""Session helpers: configuration, reliable checkpoints, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only after its measured size is found to be below this.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app: str = "finfilings", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the package relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, as named by the session.

    Only a local-mode session without the setting gets a folder of its own: on a
    cluster a folder of one machine would be lost with that machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="finfilings-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Evaluate ``df`` once and cut its lineage with a reliable checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once, as Parquet in the shared checkpoint folder.

    Every later read sees the same rows, whatever the session's split settings or the
    number of executors are by then, and reads only the columns it needs.  The table goes
    when the session ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def row_width(df: DataFrame):
    """Rough bytes per row, measured on the text form of each column."""
    width = F.lit(16)
    for name in df.columns:
        width = width + F.coalesce(F.length(F.col(f"`{name}`").cast("string")), F.lit(0)) + 16
    return width


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a *settled* relation for broadcast if its measured size allows.

    Beyond the bound the relation comes back unmarked, so the join shuffles and
    adaptive execution splits hot keys on the large side.
    """
    size = df.select(F.sum(row_width(df)).alias("n")).first()["n"] or 0
    return F.broadcast(df) if size <= max_bytes else df
