"""Landed files as tables.

Small files arrive as one row each (``file_name, content``) and are parsed inside
that row, without a shuffle.  Files above ``whole_file_bytes`` arrive as lines
(``file_name, pos, line``) from the splittable text source, so one huge file is
read by as many tasks as it has splits.  No file is dropped for its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.functions.names import base_name, plain_file_name
from finfilings.functions.values import decode_bytes
from finfilings.session import stored

#: Up to this size a file is one row; above it is read as lines.
WHOLE_FILE_BYTES = 32 * 1024 * 1024

# File-name globs of the two families.
BALANCE_GLOB = "*.[cC][sS][vV]"
INSTITUTION_FILES = r"\.(xlsx|xls|csv)$"


def file_payloads(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    recursive: bool = False,
    max_bytes: int | None = None,
    above_bytes: int | None = None,
    periods=None,
) -> DataFrame:
    """One row per file.  Size bounds, and the periods that names may tell (see
    :func:`of_periods`), are pushed to the source, so other files are never opened here.

    ``file_name`` tells files apart: below one folder it is the name, in a recursive
    listing, where names may repeat, the whole path.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    if periods is not None:
        files = files.where(of_periods(F.col("_metadata.file_name"), periods))
    if max_bytes is not None:
        files = files.where(F.col("length") <= max_bytes)
    if above_bytes is not None:
        files = files.where(F.col("length") > above_bytes)
    name = F.col("path") if recursive else base_name(F.col("path"))
    return files.select(name.alias("file_name"), "path", "length", "content")


def file_lines(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    recursive: bool = False,
    charset: str = "ISO-8859-1",
    above_bytes: int | None = None,
    periods=None,
) -> DataFrame:
    """Lines of the files above a size, with their place in the file.

    ``pos`` is (start of the split, running number).  Both follow from how the scan is
    split, which may differ from one scan to the next, so the lines are stored once with
    their places: the header search and the reader then see the same ones.
    """
    reader = spark.read.format("text").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.load(path)
    if periods is not None:
        lines = lines.where(of_periods(F.col("_metadata.file_name"), periods))
    if above_bytes is not None:
        lines = lines.where(F.col("_metadata.file_size") > above_bytes)
    name = F.col("_metadata.file_path" if recursive else "_metadata.file_name")
    return _placed(lines, name, charset)


def lines_of(spark: SparkSession, paths: list[str], charset: str = "ISO-8859-1") -> DataFrame:
    """Lines of these files, under their names, with their places."""
    return _placed(spark.read.text(paths), F.col("_metadata.file_name"), charset)


def _placed(lines: DataFrame, name: Column, charset: str) -> DataFrame:
    return stored(lines.select(
        plain_path(name).alias("file_name"),
        F.struct(
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("pos"),
        decode_bytes(F.col("value"), charset).alias("line"),
    ))


def of_periods(name: Column, periods) -> Column:
    """May a file of this name hold rows of the periods (YYYYMM)?  Names that tell no period may."""
    around = r"(?<!\d)(?:{})(?!\d)"
    return name.rlike(around.format("|".join(periods))) | ~name.rlike(around.format(r"(?:19|20)\d\d(?:0[1-9]|1[0-2])"))


def plain_path(c: Column) -> Column:
    """A file's path as it is called; ``_metadata`` has it URL-encoded."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def list_files(
    spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False, above_bytes: int | None = None, periods=None
) -> DataFrame:
    """Names and sizes only; contents are pruned from the scan."""
    return file_payloads(spark, path, glob, recursive, above_bytes=above_bytes, periods=periods).select("file_name", "path", "length")


def balance_files(spark: SparkSession, path: str) -> DataFrame:
    """Balance CSVs of one folder, in any case of the extension; none is an error."""
    files = list_files(spark, path, BALANCE_GLOB)
    if files.isEmpty():
        raise FileNotFoundError(f"no CSV files in {path!r}; names start with YYYYMM")
    return files


def institution_files(spark: SparkSession, path: str, ignore_case: bool = False) -> DataFrame:
    """Institution lists below a folder; none gives an empty table."""
    pattern = ("(?i)" if ignore_case else "") + INSTITUTION_FILES
    return list_files(spark, path, recursive=True).where(F.col("file_name").rlike(pattern))


def name_collisions(files: DataFrame) -> DataFrame:
    """Files that share their plain name with others: ``plain_name, file_name, n_files``."""
    named = files.select(plain_file_name(F.col("file_name")).alias("plain_name"), "file_name").distinct()
    shared = named.groupBy("plain_name").agg(F.count("*").alias("n_files")).where("n_files > 1")
    return named.join(shared, "plain_name")


def forbid_collisions(files: DataFrame) -> DataFrame:
    """Fail if files would have the same plain name, naming them."""
    clashes = name_collisions(files).orderBy("plain_name", "file_name").collect()  # all of them, as the message names them
    if clashes:
        raise ValueError("files share a plain name: " + ", ".join(r["file_name"] for r in clashes))
    return files
