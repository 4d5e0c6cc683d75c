"""Indicator values and registry over landed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.operators.grids import checked_months, checked_types, checked_years
from finfilings.operators.sinks import by_partition
from finfilings.sources.delimited import split_tagged
from finfilings.sources.indicators import REGISTRY, VALUES, payload_rejects, read_registry, read_values, tidy_registry, tidy_values
from finfilings.vocab import INDICATOR_REPORTS


def _periods(year, month) -> list[str]:
    return [f"{y}{m:02d}" for y in checked_years(year) for m in checked_months(month)]


def get_ifdata_values(
    spark: SparkSession, path: str, year, month, type_institution=3, relatorio: str = "T"
) -> DataFrame:
    """Indicator values of the wanted periods and institution types, tidied.

    ``path`` is either a folder of payload files or a table written by
    :func:`land_values`; there the period and type are partition columns and the
    filter prunes folders.  Payloads whose names tell another period are not opened.
    ``relatorio`` other than T (all) keeps the rows with that report code in
    ``NumeroRelatorio``.  Records that cannot be read give no rows; :func:`read_ifdata_values`
    returns them too.
    """
    _checked_report(relatorio)
    if is_landed(spark, path):
        found = landed_values(spark, path, year, month, type_institution)
        return found if relatorio == "T" else found.where(F.col("numero_relatorio") == relatorio)
    raw = read_values(spark, path, _periods(year, month))
    return tidy_values(raw.where(_wanted_values(year, month, type_institution, relatorio)))


def _checked_report(relatorio: str) -> None:
    if relatorio not in INDICATOR_REPORTS:
        raise ValueError("relatorio is one of " + ", ".join(INDICATOR_REPORTS))


def _wanted_values(year, month, type_institution, relatorio):
    types = [str(t) for t in checked_types(type_institution)]
    wanted = F.col("AnoMes").isin(_periods(year, month)) & F.col("TipoInstituicao").isin(types)
    return wanted if relatorio == "T" else wanted & (F.col("NumeroRelatorio") == relatorio)


def read_ifdata_values(
    spark: SparkSession, path: str, year, month, type_institution=3, relatorio: str = "T"
) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`get_ifdata_values` out of payloads, and what gave none: ``file_name,
    reason, record`` (null for a whole payload).  One pass stores both."""
    _checked_report(relatorio)
    tagged = read_values(spark, path, _periods(year, month), tagged=True)
    return _rows_and_rejects(spark, path, VALUES, tagged, _wanted_values(year, month, type_institution, relatorio), tidy_values, _periods(year, month))


def _rows_and_rejects(spark, path, layout, tagged, wanted, tidy, periods):
    rows, rejects = split_tagged(tagged.where(wanted | F.col("reason").isNotNull()))
    files = payload_rejects(spark, path, layout, periods).withColumn("record", F.lit(None).cast("string"))
    return tidy(rows.drop("file_name")), rejects.unionByName(files)


def _wanted_registry(year, month):
    return F.substring(F.translate("Data", "-", ""), 1, 6).isin(_periods(year, month))


def get_ifdata_registry(spark: SparkSession, path: str, year, month) -> DataFrame:
    """Registry of the wanted periods, tidied; out of payloads or of a table written by
    :func:`land_registry`, of which the other periods' folders are not read."""
    if is_landed(spark, path):
        return landed_registry(spark, path, year, month)
    return tidy_registry(read_registry(spark, path, _periods(year, month)).where(_wanted_registry(year, month)))


def read_ifdata_registry(spark: SparkSession, path: str, year, month) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`get_ifdata_registry` out of payloads, and what gave none."""
    tagged = read_registry(spark, path, _periods(year, month), tagged=True)
    return _rows_and_rejects(spark, path, REGISTRY, tagged, _wanted_registry(year, month), tidy_registry, _periods(year, month))


def is_landed(spark: SparkSession, path: str) -> bool:
    """Is the folder a table of :func:`land_values`?  Names are listed, nothing is read."""
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    return not parts.select("path").isEmpty()


def land_values(df: DataFrame, out_dir: str, mode: str = "overwrite") -> str:
    """Tidy values as Parquet, partitioned by the columns that requests filter on."""
    keys = ["ano_mes", "tipo_instituicao"]
    writer = by_partition(df, keys).write.mode(mode).partitionBy(*keys)
    writer.option("partitionOverwriteMode", "dynamic").parquet(out_dir)
    return out_dir


def landed_values(spark: SparkSession, path: str, year, month, type_institution=3, columns=None) -> DataFrame:
    """Values out of a table of :func:`land_values`: partitions are pruned by period and
    type, and only the wanted columns are read."""
    table = spark.read.parquet(path)
    wanted = table.where(
        F.col("ano_mes").cast("string").isin(_periods(year, month))
        & F.col("tipo_instituicao").isin(checked_types(type_institution))
    )
    return wanted.select(*columns) if columns else wanted


def land_registry(df: DataFrame, out_dir: str, mode: str = "overwrite") -> str:
    """Tidy registry as Parquet, a folder per period; periods that are not in ``df`` stay."""
    keyed = df.withColumn("ano_mes", F.substring(F.translate("data", "-", ""), 1, 6))
    writer = by_partition(keyed, ["ano_mes"]).write.mode(mode).partitionBy("ano_mes")
    writer.option("partitionOverwriteMode", "dynamic").parquet(out_dir)
    return out_dir


def landed_registry(spark: SparkSession, path: str, year, month) -> DataFrame:
    """Registry out of a table of :func:`land_registry`, pruned to the wanted periods."""
    table = spark.read.parquet(path)
    return table.where(F.col("ano_mes").cast("string").isin(_periods(year, month))).drop("ano_mes")
