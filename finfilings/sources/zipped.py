"""Members of ZIP archives of any size, unpacked by many tasks.

An archive is read once, in splits, as the byte runs between line feeds (the text source
hands bytes on as they are), and kept as slices with their offsets.  The directory at its
end names the members; each member's bytes are cut out of the slices that hold them and go,
in order, to a task of their own, which inflates them as a stream and checks size and
checksum.  No row holds more than a slice, a small member, or a line, and an archive's
members are spread over tasks.

Whether a member is whole is known only at its end, so what was unpacked is stored and read
through the table of members: a damaged one is a row with an error and gives nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finfilings.session import settle, small_side, stored
from finfilings.sources.landing import list_files, plain_path

#: Bytes of a slice, about, and of the buckets by which slices meet members (a power of two).
SLICE_BYTES, BUCKET_BITS = 1 << 20, 20
#: The end record and its longest comment, and the parts of a local header.
TAIL_BYTES, HEAD_BYTES = 22 + 65_535 + 76, 30 + 2 * 65_535

SLICES = "archive string, split bigint, k int, size bigint, content binary"
DIRECTORY = "archive string, number int, member string, method int, flags int, crc bigint, packed bigint, size bigint, at bigint, until bigint, error string"
UNPACKED = "archive string, number int, member string, size bigint, pos bigint, raw binary, error string"


def archive_slices(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """``archive, split, k, at, n, size, content`` of all archives of a folder, stored."""
    rows = spark.read.format("text").option("pathGlobFilter", glob).option("lineSep", "\n").load(path)
    rows = rows.select(
        plain_path(F.col("_metadata.file_name")).alias("archive"), F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"))

    def joined(batches):
        import pyarrow as pa

        names, key, held, n, k = ["archive", "split", "k", "size", "content"], None, [], 0, 0

        def row():
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([k], pa.int32()), pa.array([key[2]], pa.int64()),
                                               pa.array([b"\n".join(held) + b"\n"], pa.binary())], names=names)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("archive", "split", "size")]
            for at, value in enumerate(batch.column("value")):
                now = tuple(c[at] for c in columns)
                if now != key or n >= SLICE_BYTES:
                    if held:
                        yield row()
                    key, held, n, k = now, [], 0, (k + 1 if now == key else 0)
                held.append(value.as_py())
                n += len(held[-1]) + 1
        if held:
            yield row()

    slices = stored(rows.mapInArrow(joined, SLICES))
    order = Window.partitionBy("archive").orderBy("split", "k").rowsBetween(Window.unboundedPreceding, -1)
    places = slices.select("archive", "split", "k", F.octet_length("content").cast("bigint").alias("n")).withColumn("at", F.coalesce(F.sum("n").over(order), F.lit(0)))
    return slices.join(places, ["archive", "split", "k"])


def _entries(directory: bytes, count: int):
    """Members out of a directory: the values of its fixed 46-byte records, then the name and
    the 64-bit values that an extra field has instead."""
    import struct

    at = 0
    for _ in range(count):
        if directory[at:at + 4] != b"PK\1\2":
            raise ValueError("damaged directory")
        flags, method, crc, packed, size, n_name, n_extra, n_note, offset = (
            *struct.unpack_from("<HH", directory, at + 8), *struct.unpack_from("<III", directory, at + 16), *struct.unpack_from("<HHH", directory, at + 28),
            struct.unpack_from("<I", directory, at + 42)[0])
        name = directory[at + 46:at + 46 + n_name]
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = list(struct.unpack(f"<{length // 8}Q", extra[4:4 + length // 8 * 8]))
                size = wide.pop(0) if size == 0xFFFFFFFF else size
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            extra = extra[4 + length:]
        yield name.decode("utf-8" if flags & 0x800 else "cp437"), method, flags, crc, packed, size, offset
        at += 46 + n_name + n_extra + n_note


def _ends(pdf):
    """Where an archive's directory lies, from its last bytes."""
    import struct

    import pandas as pd

    pdf = pdf.sort_values("at")
    archive, size, first = pdf["archive"].iloc[0], int(pdf["size"].iloc[0]), int(pdf["at"].iloc[0])
    tail = b"".join(pdf["content"])[:size - first]
    at = tail.rfind(b"PK\5\6")
    row = [archive, None, None, None, None]
    try:
        if at < 0:
            raise ValueError("BadZipFile: no end record")
        count, length, begin = struct.unpack_from("<HII", tail, at + 10)
        shift = first + at - (begin + length)  # bytes before the archive proper
        if 0xFFFFFFFF in (length, begin) or count == 0xFFFF:
            wide = tail.rfind(b"PK\6\6", 0, at)
            if wide < 0:
                raise ValueError("BadZipFile: no end record for large archives")
            count, length, begin = struct.unpack_from("<QQQ", tail, wide + 32)
            shift = first + wide - (begin + length)
        if shift < 0:
            raise ValueError("BadZipFile: the directory does not fit before the end record")
        row[1:4] = begin + shift, length, count
    except (ValueError, struct.error) as problem:
        row[4] = str(problem)
    row.append(row[1] - begin if row[1] is not None else None)
    return pd.DataFrame([row], columns=["archive", "begin", "length", "count", "error", "shift"])


def _members(pdf):
    """An archive's members, from the slices that hold its directory."""
    import struct

    import pandas as pd

    pdf = pdf.sort_values("at")
    archive, begin, length = pdf["archive"].iloc[0], int(pdf["begin"].iloc[0]), int(pdf["length"].iloc[0])
    first = int(pdf["at"].iloc[0])
    directory = b"".join(pdf["content"])[begin - first:begin - first + length]
    rows, shift = [], int(pdf["shift"].iloc[0])
    try:
        for number, (name, method, flags, crc, packed, size, at) in enumerate(_entries(directory, int(pdf["count"].iloc[0]))):
            if not name.endswith("/"):
                at += shift
                rows.append((archive, number, name, method, flags, crc, packed, size, at, min(at + HEAD_BYTES + packed, begin), None))
    except (ValueError, struct.error) as problem:
        rows = [(archive, *[None] * 9, f"damaged directory: {problem}")]
    columns = [c.split()[0] for c in DIRECTORY.split(", ")]
    return pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in columns[1:-1] if c != "member"})


def archive_directory(slices: DataFrame) -> DataFrame:
    """One row a member: name, sizes, checksum, place; or one with the archive's ``error``."""
    tail = slices.where(F.col("at") + F.col("n") > F.col("size") - TAIL_BYTES).select("archive", "size", "at", "content")
    ends = settle(tail.groupBy("archive").applyInPandas(_ends, "archive string, begin bigint, length bigint, count bigint, error string, shift bigint"))
    good = small_side(ends.where("error is null").drop("error"))
    held = slices.select("archive", "at", "n", "content").join(good, "archive").where(
        (F.col("at") < F.col("begin") + F.col("length")) & (F.col("at") + F.col("n") > F.col("begin")))
    members = held.groupBy("archive").applyInPandas(_members, DIRECTORY)
    bad = ends.where("error is not null").select("archive", "error")
    return settle(members.unionByName(bad, allowMissingColumns=True))


class _Member:
    """Takes a member's bytes in order, gives back what they hold, a piece at a time."""

    PIECE = 1 << 20

    def __init__(self, row):
        import zlib

        self.row, self.head, self.left, self.crc, self.size, self.error = row, b"", row["packed"], 0, 0, None
        self.open = None
        self.inflate = zlib.decompressobj(-15) if row["method"] == 8 else None
        if row["flags"] & 1:
            self.error = "member is encrypted"
        elif row["method"] not in (0, 8):
            self.error = f"compression method {row['method']}"

    def feed(self, data: bytes):
        import struct
        import zlib

        if self.error:
            return
        if self.open is None:
            self.head += data
            if len(self.head) < 30:
                return
            n_name, n_extra = struct.unpack_from("<HH", self.head, 26)
            if self.head[:4] != b"PK\3\4":
                self.error = "damaged member header"
                return
            if len(self.head) < 30 + n_name + n_extra:
                return
            data, self.head, self.open = self.head[30 + n_name + n_extra:], b"", True
        data = data[:self.left]
        self.left -= len(data)
        while data:
            try:
                piece = self.inflate.decompress(data, self.PIECE) if self.inflate else data
                data = self.inflate.unconsumed_tail if self.inflate else b""
            except zlib.error as problem:
                self.error = str(problem)
                return
            self.crc, self.size = zlib.crc32(piece, self.crc), self.size + len(piece)
            if self.size > self.row["size"]:
                self.error = "member is longer than the directory says"
                return
            if piece:
                yield piece
            if not piece and self.inflate and (self.inflate.eof or not data):
                break

    def verdict(self) -> str | None:
        if self.error:
            return self.error
        if self.open is None or self.left or self.size != self.row["size"]:
            return "member is cut off"
        return None if self.crc == self.row["crc"] else "checksum differs"


def unpack(spark: SparkSession, path: str, glob: str, max_member_bytes: int | None = None, wanted: str | None = None,
           contents: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``members, payloads, lines`` of all archives of a folder.

    ``members``: ``archive, member, size, error``, one row a member, proven by size and
    checksum, or one with the error of an archive.  ``payloads``: ``archive, member, content``
    of whole members up to ``max_member_bytes`` (null: all).  ``lines``: ``archive, member,
    pos, raw`` of larger ones.  ``wanted`` is a pattern of member names that are unpacked at
    all; without ``contents`` members are proven only.
    """
    slices = archive_slices(spark, path, glob)
    directory = archive_directory(slices)
    entries = directory.where("error is null")
    if wanted:
        entries = entries.where(F.col("member").rlike(wanted))
    first = lambda at: F.shiftright(at, BUCKET_BITS)
    own = slices.select("archive", "at", "n", "content", F.explode(F.sequence(first(F.col("at")), first(F.col("at") + F.col("n") - 1))).alias("bucket"))
    asked = entries.withColumnsRenamed({"at": "from", "error": "_"}).drop("_").select(
        "*", F.explode(F.sequence(first(F.col("from")), first(F.col("until") - 1))).alias("bucket"))
    start, end = F.greatest("at", "from"), F.least(F.col("at") + F.col("n"), "until")
    # a slice and a member that share several buckets meet in the first of them
    parts = own.join(asked, ["archive", "bucket"]).where((start < end) & (F.col("bucket") == first(start))).select(
        "archive", "number", "member", "method", "flags", "crc", "packed", F.col("size"), start.alias("at"),
        F.substring(F.col("content"), (start - F.col("at") + 1).cast("int"), (end - start).cast("int")).alias("part"))
    ordered = parts.repartition("archive", "number").sortWithinPartitions("archive", "number", "at")

    def run(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
        names = [c.split()[0] for c in UNPACKED.split(", ")]
        out, n = [], 0
        member = None

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)

        def add(pos, raw=None, error=None):
            nonlocal n
            row = member.row
            out.append((row["archive"], row["number"], row["member"], row["size"], pos, raw, error))
            n += len(raw or b"") + 64

        def pieces_of(piece):
            """Rows for what a member gave; ``None`` at its end."""
            if not contents:
                return
            if max_member_bytes is None or member.row["size"] <= max_member_bytes:
                if piece is not None:
                    member.held.append(piece)
                elif not member.error:
                    add(-1, b"".join(member.held))
                return
            if piece is not None:
                *whole, member.rest = (member.rest + piece).split(b"\n")
            else:
                whole, member.rest = [member.rest] if member.rest else [], b""
            for line in whole:
                add(member.pos, line.rstrip(b"\r"))
                member.pos += 1

        def close():
            member.error = member.verdict()
            pieces_of(None)
            add(None, None, member.error)

        for rows in batches:
            for row in (r for k in range(0, rows.num_rows, 16) for r in rows.slice(k, 16).to_pylist()):
                if member is None or (row["archive"], row["number"]) != (member.row["archive"], member.row["number"]):
                    if member is not None:
                        close()
                    member = _Member(row)
                    member.held, member.rest, member.pos = [], b"", 0
                for piece in member.feed(row["part"]):
                    pieces_of(piece)
                    if n >= 8 * SLICE_BYTES or len(out) >= 20_000:
                        yield batch()
                        out, n = [], 0
        if member is not None:
            close()
        if out:
            yield batch()

    unpacked = stored(ordered.mapInArrow(run, UNPACKED))
    proven = settle(unpacked.where("pos is null").select("archive", "number", "member", "size", "error"))
    # a member without any byte of its own in the slices was cut off as a whole
    lost = entries.join(proven.select("archive", "number"), ["archive", "number"], "left_anti").select(
        "archive", "member", "size", F.lit("member is cut off").alias("error"))
    members = proven.select("archive", "member", "size", "error").unionByName(lost).unionByName(
        directory.where("error is not null").select("archive", "member", "size", "error"))
    sound = small_side(proven.where("error is null").select("archive", "number"))
    rows = unpacked.join(sound, ["archive", "number"], "left_semi")
    payloads = rows.where("pos = -1").select("archive", "member", F.col("raw").alias("content"))
    return members, payloads, rows.where("pos >= 0").select("archive", "member", "pos", "raw")


def archive_members(spark: SparkSession, path: str, glob: str = "*.[zZ][iI][pP]") -> DataFrame:
    """``archive, member, size, error`` of a folder's archives; nothing but this is kept."""
    if list_files(spark, path, glob).isEmpty():
        return spark.createDataFrame([], "archive string, member string, size bigint, error string")
    return unpack(spark, path, glob, contents=False)[0]
