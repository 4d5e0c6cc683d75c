"""What the operators share: tables, texts without nulls, settled tables, words as numbers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.session import settle, small_side, stored

__all__ = ["Numbers", "crc_of", "dropped", "free_name", "held", "released", "settle", "small_side", "stored", "table", "texts_of", "whole_text"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dropped(df: DataFrame) -> None:
    """Removes a table of :func:`stored` that nothing reads any more, before the session ends."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if not folder.rpartition("/")[2].startswith("table-"):
            raise ValueError(f"{folder} is not a stored table")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """A name like this one that no column of the table has."""
    while name in df.columns:
        name += "_"
    return name


def whole_text(name: str = "text") -> Column:
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_of(c: Column, modulus: int) -> Column:
    """crc32 of an id's text modulo ``modulus``; null for a null id."""
    return F.crc32(c.cast("string").cast("binary")) % modulus


class Numbers(dict):
    """Word (bytes) → 64-bit number, remembered for words met before.

    The memory is bounded: once full it starts anew, so a worker that lives through
    many partitions does not grow with the vocabulary.
    """

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        number = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = number
        return number


def texts_of(column: pa.Array, rows: int = 128) -> Iterator[str | None]:
    """The texts of an Arrow column; only a few rows at a time are Python objects."""
    for begin in range(0, len(column), rows):
        yield from column.slice(begin, rows).to_pylist()


def released() -> None:
    """Gives back to the machine what a Python worker has freed; where the C library cannot,
    only Arrow's part.  Workers live on between tasks, with the peak of the last one else."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], object]):
    """What a Python worker keeps from task to task: one thing at a time, so that a worker
    that served another operator before does not hold that one's memory as well."""
    if name not in _HELD:
        _HELD.clear()
        released()
        _HELD[name] = make()
    return _HELD[name]
