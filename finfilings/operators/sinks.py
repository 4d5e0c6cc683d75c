"""Writers.  All write folders of part files from every task; nothing is coalesced."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finfilings.functions.names import safe_name
from finfilings.operators.reshape import distinct_values, pivot_wide
from finfilings.session import settle


CONCURRENT = "spark.sql.maxConcurrentOutputFileWriters"


class Staged:
    """Folders that take the place of earlier ones together, once all of them are written.

    Each is written beside its target; until :meth:`commit` nothing that was there before is
    touched, so a run that fails in between leaves the earlier result whole.
    """

    def __init__(self, spark):
        self.spark, self.moves = spark, []

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def folder(self, target: str) -> str:
        """Where to write what is to stand at ``target``."""
        target = target.rstrip("/")
        parent, _, name = target.rpartition("/")
        staging = f"{parent}/_staged-{name}-{uuid.uuid4().hex}" if parent else f"_staged-{name}-{uuid.uuid4().hex}"
        files, path = self._path(staging)
        files.deleteOnExit(path)  # what is never committed goes with the session
        self.moves.append((staging, target))
        return staging

    def commit(self) -> None:
        for staging, target in self.moves:
            files, new = self._path(staging)
            if not files.exists(new):  # no row was written
                continue
            _, old = self._path(target)
            files.delete(old, True)
            if not files.rename(new, old):
                raise OSError(f"{target} could not be replaced; the new rows are in {staging}")
            files.cancelDeleteOnExit(new)
        self.moves = []


def by_partition(df: DataFrame, keys) -> DataFrame:
    """Bring rows of one target partition together before a partitioned write.

    Without it every task writes a file into every partition.  The rebalance hint lets
    adaptive execution split a hot partition over several tasks and merge small ones.
    """
    return df.hint("rebalance", *keys)


#: So many files a task keeps open before it sorts the rest of its rows by partition.
OPEN_FILES = 16


@contextmanager
def unsorted(spark):
    """Partitioned writes whose tasks keep a file open for each of a few partitions, so that
    they need not sort, and hold, what a hot partition gave them.  A session that has its own
    setting keeps it."""
    before = spark.conf.get(CONCURRENT, "0")
    if int(before) <= 0:
        spark.conf.set(CONCURRENT, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(CONCURRENT, before)


def write_long(df: DataFrame, out_dir: str, mode: str = "overwrite", by=("documento", "inst_type")) -> str:
    """The long table as Parquet, partitioned for later pruning."""
    with unsorted(df.sparkSession):
        by_partition(df, by).write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*by).parquet(out_dir)
    return out_dir


def balance_folder(out_dir: str, document: int, inst_type: str) -> str:
    return f"{out_dir.rstrip('/')}/{document}_{inst_type.lower()}.csv"


def write_wide_by_type(
    long: DataFrame, out_dir: str, document: int, ids, mode: str = "overwrite", on_duplicate: str = "error"
) -> dict[str, str]:
    """One CSV folder ``{document}_{type}.csv`` per institution type.

    ``long`` should be a stored table partitioned by ``inst_type`` (see
    :func:`write_long`): each of the few types then reads its own partition only.  The
    folders are replaced together once all are written.
    """
    written, staged = {}, Staged(long.sparkSession)
    for inst_type in distinct_values(long, "inst_type"):
        rows = long.where(F.col("inst_type") == inst_type)
        folder = balance_folder(out_dir, document, inst_type)
        wide = pivot_wide(rows, ids, on_duplicate=on_duplicate)
        wide.write.mode(mode).option("header", True).csv(folder if mode == "append" else staged.folder(folder))
        written[inst_type] = folder
    staged.commit()
    return written


def write_institutions(df: DataFrame, out_dir: str, own: dict[str, set[str]] | None = None) -> str:
    """Institution lists as CSV, one folder per institution under a path-safe name.

    ``own`` names the columns of each institution; without it all have all.  Folders that
    an earlier run left for other institutions are replaced together with the rest, once
    everything is written.
    """
    tagged = df.withColumn("safe_name", safe_name(F.col("institution")))
    if own is None:
        own = {}
    groups: dict[tuple, list[str]] = {}
    for name in distinct_values(df, "institution"):
        columns = tuple(c for c in df.columns if c in own.get(name, df.columns))
        groups.setdefault(columns, []).append(name)
    staged = Staged(df.sparkSession)
    folder = staged.folder(out_dir)
    for columns, names in groups.items():  # one write for institutions of the same columns
        rows = tagged.where(F.col("institution").isin(names)).select(*columns, "safe_name")
        by_partition(rows, ["safe_name"]).write.mode("append").partitionBy("safe_name").option("header", True).csv(folder)
    staged.commit()
    return out_dir


def land(df: DataFrame, out_dir: str, by, overwrite: bool = False) -> DataFrame:
    """Land a table by partition; partitions already there are kept unless
    ``overwrite``.  Returns the partitions with ``written`` and a note.

    Only partition values of the folder are listed, never its rows.
    """
    spark = df.sparkSession
    keys = list(by)
    wanted = df.select(*keys).distinct()
    there = existing_partitions(spark, out_dir, wanted.schema)
    there = there.select(*[F.col(f"`{k}`").alias(f"_there_{k}") for k in keys], F.lit(True).alias("_there"))
    # a null partition value is a value like any other
    same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"_there_{k}")) for k in keys])
    report = wanted.join(there, same, "left")
    kept = F.coalesce("_there", F.lit(False)) & F.lit(not overwrite)
    note = F.when(kept, "landed earlier and kept")
    # settled, since the write below changes what is there
    report = settle(
        report.select(*keys, (~kept).alias("written"), F.lit(True).alias("success"), note.alias("note"))
    )
    rows = df if overwrite else df.join(there, same, "left_anti")
    writer = by_partition(rows, keys).write.mode("overwrite" if overwrite else "append").partitionBy(*keys)
    with unsorted(spark):
        writer.option("partitionOverwriteMode", "dynamic").parquet(out_dir)
    return report


def existing_partitions(spark, out_dir: str, schema) -> DataFrame:
    """Partition values already stored in a folder; only footers are touched."""
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    try:
        stored = spark.read.schema(names).parquet(out_dir)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return stored.select(*[f.name for f in schema.fields]).distinct()
