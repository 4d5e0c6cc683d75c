"""Lists of supervised institutions: landing audit and tidy table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.functions.names import clean_name, file_period, file_type, plain_file_name, unique_names
from finfilings.functions.values import cnpj_digits, cnpj_number, is_footnote
from finfilings.operators.audit import landing_report
from finfilings.operators.grids import institution_grid
from finfilings.operators.reshape import split_by_type
from finfilings.operators.sinks import write_institutions
from finfilings.session import settle, stored
from finfilings.sources.delimited import (
    INSTITUTIONS,
    find_headers,
    parse_lines_by_name,
    reject_lines,
)
from finfilings.sources.landing import BALANCE_GLOB, file_lines, file_payloads, institution_files
from finfilings.sources.zipped import archive_members
from finfilings.sources.workbooks import bad_workbooks, sheet_lines, usable_sheets


BOOK_GLOB = "*.[xX][lL][sS]*"


def drop_footnotes(df: DataFrame, name: str = "cnpj") -> DataFrame:
    """Rows that are not footnotes; a row without company number drops out too."""
    return df.where(~is_footnote(F.col(name)))


def _per_file() -> dict:
    """Institution and month of a list; lists without a conforming name give no rows."""
    name = plain_file_name(F.col("file_name"))
    return {"institution": file_type(name), "data": file_period(name)}


def tidy_rows(rows: DataFrame) -> DataFrame:
    """Footnotes out, company number as number and as digits."""
    if "cnpj" not in rows.columns:
        raise ValueError("missing required columns: cnpj")
    cnpj = F.col("cnpj")
    return drop_footnotes(rows).withColumns({"cnpj_num": cnpj_number(cnpj), "cnpj": cnpj_digits(cnpj)})


def institutions_from_lines(lines: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """All columns of all lists, united by name."""
    return tidy_rows(parse_lines_by_name(lines, INSTITUTIONS, headers, _per_file()))


def institution_lines(
    spark: SparkSession, path: str, charset: str = "UTF-8", ignore_case: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Lines of every list below a folder and the workbooks that could not be read."""
    flag = "(?i)" if ignore_case else ""
    csv_glob = BALANCE_GLOB if ignore_case else "*.csv"
    csv_lines = file_lines(spark, path, csv_glob, recursive=True, charset=charset)
    # the glob keeps the bytes of every other file out of the scan
    books = file_payloads(spark, path, BOOK_GLOB, recursive=True)
    # settled, since the header search and the reader both need the unpacked sheets
    sheets = settle(sheet_lines(books.where(F.col("file_name").rlike(flag + r"\.(xlsx|xls)$"))))
    sheet_rows = usable_sheets(sheets).withColumn(
        "pos", F.struct(F.lit(0).cast("bigint").alias("split"), F.col("pos").alias("row"))
    )
    return csv_lines.unionByName(sheet_rows), bad_workbooks(sheets)


def read_institutions(spark: SparkSession, path: str, charset: str = "UTF-8", ignore_case: bool = False) -> DataFrame:
    lines, _ = institution_lines(spark, path, charset, ignore_case)
    return institutions_from_lines(lines)


def institution_rejects(spark: SparkSession, path: str, charset: str = "UTF-8", ignore_case: bool = False) -> DataFrame:
    """Lists that give no rows, with the reason."""
    lines, bad_books = institution_lines(spark, path, charset, ignore_case)
    headers = settle(find_headers(lines, INSTITUTIONS))
    names = institution_files(spark, path, ignore_case)
    bad_name = names.where(file_type(plain_file_name(F.col("file_name"))).isNull())
    return (
        reject_lines(lines, INSTITUTIONS, headers, ("CNPJ",))
        .unionByName(bad_books)
        .unionByName(bad_name.select("file_name", F.lit("file name is not YYYYMM and a type").alias("reason")))
    )


def tidy_institutions(
    spark: SparkSession, path: str, out_dir: str | None = None, charset: str = "UTF-8", ignore_case: bool = False
) -> dict[str, DataFrame]:
    """Lists per institution; written as CSV when ``out_dir`` is given.  A folder
    without lists gives an empty dict."""
    if institution_files(spark, path, ignore_case).isEmpty():
        return {}
    lines, _ = institution_lines(spark, path, charset, ignore_case)
    headers = settle(find_headers(lines, INSTITUTIONS))
    # parsed once, for the written folders, the types and each returned table
    rows = stored(institutions_from_lines(lines, headers).drop("file_name"))
    own = own_columns(headers)
    if out_dir:
        write_institutions(rows, out_dir, own)
    return {name: df.select(*[c for c in df.columns if c in own.get(name, df.columns)]) for name, df in split_by_type(rows, "institution").items()}


def own_columns(headers: DataFrame) -> dict[str, set[str]]:
    """The columns that the lists of each institution have: a bounded vocabulary."""
    named = headers.select(_per_file()["institution"].alias("institution"), "names").where("institution IS NOT NULL")
    out: dict[str, set[str]] = {}
    for row in named.distinct().collect():
        out.setdefault(row["institution"], {"institution", "data", "cnpj_num"}).update(unique_names(clean_name(n) for n in row["names"]))
    return out


def get_institutions(spark: SparkSession, path: str, institution, start_date, end_date) -> DataFrame:
    """Landing report of the expected lists: present, missing or damaged archive.

    An archive that was already unpacked and cleaned away counts by its member.
    """
    grid = institution_grid(spark, institution, start_date, end_date)
    members = archive_members(spark, path)
    name = plain_file_name(F.col("file_name"))
    archive = F.concat(file_type(name), F.lit("_"), file_period(name), F.lit(".zip"))
    unpacked = institution_files(spark, path, ignore_case=True).select(archive.alias("file_name"))
    unpacked = unpacked.where("file_name IS NOT NULL")
    landed = members.select(F.col("archive").alias("file_name")).distinct().unionByName(unpacked)
    damaged = members.where("error IS NOT NULL").groupBy(F.col("archive").alias("file_name")).agg(
        F.min(F.concat_ws(": ", "member", "error")).alias("reason"))
    return landing_report(grid, landed, damaged)
