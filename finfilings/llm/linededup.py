"""Repeated passages of three consecutive lines, cut out of all but the first document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.llm.common import table
from finfilings.llm.registry import query
from finfilings.llm.repeats import Unit, cut_repeats, n_cut

#: Consecutive lines that make a window.
WINDOW = 3
_BLANK = " \t\r\v\f"


def lines(text: str) -> list[Unit]:
    """Lines with content, compared without blanks around them; the line break after a line
    goes with it."""
    out, at, size = [], 0, len(text)
    for line in text.split("\n"):
        body, end = line.strip(_BLANK), at + len(line)
        if body:
            out.append((body.encode("utf-8", "surrogatepass"), 1, at, min(end + 1, size)))
        at = end + 1
    return out


def dedup_lines(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``documents`` with the text without repeated three-line windows, plus ``cuts, first_ids``.

    A window is three consecutive lines with content; blank lines neither make nor break
    one, and go with a window around them.  Of equal windows the first in the order of
    doc_id (null first) and position stays; lines that any other one covers go.

    Null and empty texts, and texts of fewer than three lines with content, stay as they
    are.  Rows equal in id and text count as one document.  A text may lose all its lines
    and is then empty.  Extra columns pass through; ``cuts`` and ``first_ids`` are replaced.
    """
    return cut_repeats(documents, lines, WINDOW, text=text, doc_id=doc_id, separated=True)


SQL = r"""
WITH line AS (
  SELECT doc_id, i, l, trim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS body
  FROM (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS l FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))),
win AS (
  SELECT doc_id, i, lead(i, 2) OVER w AS j, body AS a, lead(body, 1) OVER w AS b, lead(body, 2) OVER w AS c
  FROM line WHERE body <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
later AS (
  SELECT doc_id, i, j FROM (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS n FROM win WHERE j IS NOT NULL) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i FROM later),
kept AS (
  SELECT doc_id, string_agg(l, chr(10) ORDER BY i) AS text, count(*) AS n FROM line WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = line.doc_id AND gone.i = line.i) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CASE WHEN g.n IS NULL THEN 0 ELSE length(d.text) - length(coalesce(k.text, '')) END::BIGINT AS n_cut
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
"""


@query("op5_line_dedup", SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text", n_cut().alias("n_cut"))
