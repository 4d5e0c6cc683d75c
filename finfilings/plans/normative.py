"""Normative acts over landed search pages and act texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finfilings.operators.acts import clean_act_texts, clean_search_fields, join_texts, search_acts
from finfilings.sources.pages import page_records, record_fields, record_names, text_records

# Field names of act type, number, date and the searched texts.
TYPE, NUMBER, DATE = "TipodoNormativoOWSCHCS", "NumeroOWSNMBR", "Data1OWSDATE"
TEXTS = ("AssuntoNormativoOWSMTXT", "HitHighlightedSummary")


def acts_table(pages: DataFrame, fields=None, payload: str = "payload", distinct: bool = False) -> DataFrame:
    """Landed search pages to one clean row per hit; with ``distinct`` an act that several
    pages hold, as overlapping ones do, comes once."""
    records = page_records(pages, payload)
    fields = list(fields or record_names(records))
    table = clean_search_fields(record_fields(records.select("record"), fields))
    table = table.distinct() if distinct else table
    return table.withColumn(DATE, F.col(DATE).try_cast("timestamp")) if DATE in fields else table


def get_normative_data(
    pages: DataFrame, terms, ini_date, end_date, fields=None, payload: str = "payload", distinct: bool = False
) -> DataFrame:
    """Acts of a date interval that hold one of the terms, latest first.

    Whether all pages landed is told by :func:`finfilings.operators.pages.page_coverage`.
    """
    table = acts_table(pages, fields, payload, distinct)
    texts = [c for c in TEXTS if c in table.columns]
    return search_acts(table, terms, ini_date, end_date, texts, DATE, NUMBER)


def get_normative_txt(
    normative_data: DataFrame, texts: DataFrame, fields=None, payload: str = "payload"
) -> DataFrame:
    """Every act with its cleaned text.

    ``texts`` holds landed act-text payloads with the act's type and number.  The HTML
    is cleaned once per landed text, before the join repeats it per act.  Without
    ``fields`` all fields met are returned, which takes a pass over the payloads.
    """
    records = text_records(texts.select(TYPE, NUMBER, payload), payload)
    fields = [f for f in fields or record_names(records) if f not in (TYPE, NUMBER)]
    cleaned = clean_act_texts(record_fields(records, fields))
    return join_texts(normative_data, cleaned, [TYPE, NUMBER])
