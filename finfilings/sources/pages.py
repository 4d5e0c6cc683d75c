"""JSON payloads of the act search and of act texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names of the two payloads.
SEARCH_PAGE = "TotalRows bigint, Rows array<map<string,string>>"
ACT_TEXT = "conteudo array<map<string,string>>"


def total_rows(payload: Column) -> Column:
    """Number of hits a search page announces."""
    return F.from_json(payload, "TotalRows bigint")["TotalRows"]


def page_records(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per search hit, its fields in the map ``record``.

    Pages without rows and payloads that are not JSON give none.
    """
    page = F.from_json(F.col(payload), SEARCH_PAGE)
    rest = [c for c in pages.columns if c != payload]
    return pages.select(*rest, F.explode(page["Rows"]).alias("record"))


def text_records(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per content element of an act-text payload, in the map ``record``."""
    body = F.from_json(F.col(payload), ACT_TEXT)
    rest = [c for c in payloads.columns if c != payload]
    return payloads.select(*rest, F.explode(body["conteudo"]).alias("record"))


def record_fields(records: DataFrame, names) -> DataFrame:
    """Named fields of a record map as columns; a field a record lacks is NULL."""
    rest = [c for c in records.columns if c != "record"]
    return records.select(*rest, *[F.col("record")[n].alias(n) for n in names])


def record_names(records: DataFrame) -> list[str]:
    """Sorted field names met in the records: the columns of a result, so a vocabulary."""
    names = records.select(F.explode(F.map_keys("record")).alias("name")).distinct().orderBy("name")
    return [r["name"] for r in names.collect()]


def bad_pages(pages: DataFrame, payload: str = "payload", schema: str = SEARCH_PAGE) -> DataFrame:
    """Payloads that are not JSON, as rejects."""
    parsed = F.from_json(
        F.col(payload), schema + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}
    )
    bad = F.col(payload).isNull() | parsed["_corrupt"].isNotNull()
    return pages.where(bad).select("file_name", F.lit("not a JSON payload").alias("reason"))
