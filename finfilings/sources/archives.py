"""ZIP archives as tables.

A damaged archive is a row with an error, never a failed job, and the archives
themselves are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finfilings.functions.values import decode_bytes

INDEX = "archive string, member string, size bigint, error string"
MEMBERS = "archive string, member string, content binary, error string"
LINES = "archive string, file_name string, pos bigint, raw binary, error string"


def _payloads(batches, rows: int = 16):
    """Name and content of each payload; only a few rows of a batch at a time are Python objects."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            part = batch.slice(begin, rows)
            yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def _batch(rows, schema: str):
    """Rows as an Arrow batch of a schema as Spark writes it."""
    import pyarrow as pa

    kinds = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows), fields)], names=[name for name, _ in fields])


def _released():
    """Gives what a worker has freed back to the machine: it lives on with its peak else."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def list_members(payloads: DataFrame) -> DataFrame:
    """Names and unpacked sizes of the members from the archives' directories; nothing is
    inflated.  What is no archive is a row with an error."""

    def members(batches):
        import io
        import zipfile

        import pandas as pd

        for batch in batches:
            rows = []
            for archive, content in zip(batch["file_name"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as bundle:
                        rows += [(archive, i.filename, i.file_size, None) for i in bundle.infolist() if not i.is_dir()]
                except Exception as problem:
                    rows.append((archive, None, None, f"{type(problem).__name__}: {problem}"))
            yield pd.DataFrame(rows, columns=["archive", "member", "size", "error"])

    return payloads.select("file_name", "content").mapInPandas(members, INDEX)


def expand_archives(
    payloads: DataFrame, batch_bytes: int = 8 * 1024 * 1024, max_member_bytes: int | None = None
) -> DataFrame:
    """Members of each archive (``file_name, content``), one row per member, up to the
    given unpacked size.

    Members leave in batches of about ``batch_bytes``; a larger one is a batch of its
    own.  For members too large to be one row see :func:`expand_archive_lines`.
    """

    def members(batches):
        import io
        import zipfile

        rows, held = [], 0
        for archive, content in _payloads(batches):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as bundle:
                    for info in bundle.infolist():
                        if info.is_dir() or (max_member_bytes is not None and info.file_size > max_member_bytes):
                            continue
                        data = bundle.read(info)
                        rows.append((archive, info.filename, data, None))
                        held += len(data)
                        if held >= batch_bytes:
                            yield _batch(rows, MEMBERS)
                            rows, held = [], 0
            except Exception as problem:
                rows.append((archive, None, None, f"{type(problem).__name__}: {problem}"))
        if rows:
            yield _batch(rows, MEMBERS)
        del rows
        _released()

    return payloads.select("file_name", "content").mapInArrow(members, MEMBERS)


def index_archives(payloads: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """Names and sizes of the members, each inflated once in chunks to see that it is
    whole; no content leaves the task."""

    def index(batches):
        import io
        import zipfile

        import pandas as pd

        rows = []
        for batch in batches:
            for archive, content in zip(batch["file_name"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as bundle:
                        found = []
                        for info in bundle.infolist():
                            if not info.is_dir():
                                with bundle.open(info) as stream:
                                    while stream.read(chunk):
                                        pass
                                found.append((archive, info.filename, info.file_size, None))
                        rows += found
                except Exception as problem:
                    rows.append((archive, None, None, f"{type(problem).__name__}: {problem}"))
        if rows:
            yield pd.DataFrame(rows, columns=["archive", "member", "size", "error"])

    return payloads.select("file_name", "content").mapInPandas(index, INDEX)


def expand_archive_lines(
    payloads: DataFrame, rows_per_batch: int = 20_000, above_member_bytes: int | None = None, batch_bytes: int = 8 * 1024 * 1024
) -> DataFrame:
    """Lines of every member above the given unpacked size, inflated as a stream: a member of any size passes
    through in batches instead of becoming one row."""

    def lines(batches):
        import io
        import zipfile

        rows, held = [], 0
        for archive, content in _payloads(batches):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as bundle:
                    for info in bundle.infolist():
                        if info.is_dir() or (above_member_bytes is not None and info.file_size <= above_member_bytes):
                            continue
                        with bundle.open(info) as stream:
                            for pos, raw in enumerate(stream):
                                rows.append((archive, info.filename, pos, raw.rstrip(b"\r\n"), None))
                                held += len(raw)
                                if len(rows) >= rows_per_batch or held >= batch_bytes:
                                    yield _batch(rows, LINES)
                                    rows, held = [], 0
            except Exception as problem:
                rows.append((archive, None, None, None, f"{type(problem).__name__}: {problem}"))
        if rows:
            yield _batch(rows, LINES)
        del rows
        _released()

    return payloads.select("file_name", "content").mapInArrow(lines, LINES)


def usable_members(members: DataFrame) -> DataFrame:
    """Members as payloads for the readers."""
    name = F.substring_index("member", "/", -1)
    return members.where("error IS NULL").select(name.alias("file_name"), "content")


def usable_lines(lines: DataFrame, charset: str = "ISO-8859-1") -> DataFrame:
    """Member lines as a line table; files are told apart by archive and member."""
    good = lines.where("error IS NULL")
    name = F.concat_ws("/", "archive", "file_name")
    return good.select(name.alias("file_name"), "pos", decode_bytes(F.col("raw"), charset).alias("line"))


def bad_archives(members: DataFrame) -> DataFrame:
    """Archives that could not be expanded: ``file_name, reason``."""
    return members.where("error IS NOT NULL").select(F.col("archive").alias("file_name"), F.col("error").alias("reason"))
