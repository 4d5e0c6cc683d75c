"""Indicator values and registry payloads (UTF-8 CSV with fixed columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.functions.names import clean_names
from finfilings.functions.values import parse_decimal, parse_integer
from finfilings.sources.delimited import Layout, parse_lines, parse_payloads, reject_lines, reject_payloads
from finfilings.sources.landing import WHOLE_FILE_BYTES, file_lines, file_payloads, list_files
from finfilings.vocab import REGISTRY_COLUMNS, VALUE_COLUMNS

CORRUPT = "_corrupt"


def _schema(columns, corrupt: bool = False) -> str:
    names = list(columns) + ([CORRUPT] if corrupt else [])
    return ", ".join(f"{name} string" for name in names)


def _layout(columns, marks: int) -> Layout:
    """Payloads name their columns in the first line, in any order."""
    words = tuple(columns[:marks])
    return Layout(words=words, marks=tuple(f"(?i)^{w}$" for w in words), sep=",")


VALUES, REGISTRY = _layout(VALUE_COLUMNS, 3), _layout(REGISTRY_COLUMNS, 2)


def read_values(spark: SparkSession, path: str, periods=None, tagged: bool = False, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Raw values from all payloads below a folder, all text; one read unites the periods."""
    return _read(spark, path, VALUES, VALUE_COLUMNS, periods, tagged, whole_file_bytes)


def read_registry(spark: SparkSession, path: str, periods=None, tagged: bool = False, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Raw registry from all payloads below a folder, all text."""
    return _read(spark, path, REGISTRY, REGISTRY_COLUMNS, periods, tagged, whole_file_bytes)


def _read(spark, path, layout, columns, periods, tagged, whole_file_bytes):
    """Columns are found by the names in each payload's header.  A record of more or fewer
    cells than the header, or with a quote that is never closed, is broken: it gives no row,
    or with ``tagged`` one with a ``reason`` and the ``record``'s first line.  Payloads
    whose names tell another period are not opened; those above a size are read by line.
    """
    named = {c: c.upper() for c in columns}
    small = file_payloads(spark, path, recursive=True, max_bytes=whole_file_bytes, periods=periods).select("file_name", "content")
    out = parse_payloads(small, layout, named, strict=True, tagged=tagged)
    if not list_files(spark, path, recursive=True, above_bytes=whole_file_bytes, periods=periods).isEmpty():
        lines = file_lines(spark, path, recursive=True, charset=layout.charset, above_bytes=whole_file_bytes, periods=periods)
        out = out.unionByName(parse_lines(lines, layout, named, strict=True, tagged=tagged))
    return out if tagged else out.drop("file_name")


def payload_rejects(spark: SparkSession, path: str, layout: Layout, periods=None, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Payloads that give no rows, with the reason; a refused request's answer has no header."""
    small = file_payloads(spark, path, recursive=True, max_bytes=whole_file_bytes, periods=periods).select("file_name", "content")
    out = reject_payloads(small, layout)
    if not list_files(spark, path, recursive=True, above_bytes=whole_file_bytes, periods=periods).isEmpty():
        out = out.unionByName(reject_lines(file_lines(spark, path, recursive=True, charset=layout.charset, above_bytes=whole_file_bytes, periods=periods), layout))
    return out


def parse_csv_lines(lines: DataFrame, columns) -> DataFrame:
    """Payload lines (``file_name, line``) to raw columns plus ``_corrupt``.

    The header is recognised by its first column's name at the start of the line.
    """
    record = F.from_csv(
        F.col("line"), _schema(columns, corrupt=True),
        {"escape": '"', "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"},
    )
    body = lines.where((F.trim("line") != "") & ~F.col("line").startswith(columns[0] + ","))
    return body.select("file_name", F.explode(F.array(record)).alias("r")).select("file_name", "r.*")


def answered(payloads: DataFrame) -> DataFrame:
    """Payloads whose request was answered; the others contribute no rows."""
    return payloads.where("status = 200")


def unanswered(payloads: DataFrame) -> DataFrame:
    """The other payloads, as rejects."""
    reason = F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("unknown")))
    return payloads.where("NOT (status <=> 200)").select("file_name", reason.alias("reason"))


def corrupt_lines(parsed: DataFrame) -> DataFrame:
    """Payload lines that do not fit the columns."""
    return parsed.where(F.col(CORRUPT).isNotNull()).select(
        "file_name", F.concat(F.lit("bad line: "), F.col(CORRUPT)).alias("reason")
    )


def tidy_values(raw: DataFrame) -> DataFrame:
    """Clean names, the institution code as company number, the printed balance kept
    as text beside its decimal value so that periods unite without type conflicts."""
    kept = raw.drop(CORRUPT)
    named = clean_names(kept.withColumnRenamed("CodInst", "cnpj").withColumnRenamed("Saldo", "saldo_raw"))
    grouped = F.translate(F.col("saldo_raw"), ",", "")
    return named.withColumn("tipo_instituicao", parse_integer(F.col("tipo_instituicao"))).withColumn(
        "saldo", parse_decimal(grouped)
    )


def tidy_registry(raw: DataFrame) -> DataFrame:
    """Clean names; every column stays text."""
    return clean_names(raw.drop(CORRUPT))
