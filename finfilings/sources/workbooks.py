"""First sheet of .xlsx workbooks as a line table.

Each sheet row becomes one comma-separated line, quoted where needed, so the
header search and the readers for delimited text apply unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHEET = "file_name string, pos bigint, line string, error string"


def sheet_lines(payloads: DataFrame, rows_per_batch: int = 5_000) -> DataFrame:
    """``file_name, pos, line, error`` of each workbook's first sheet.

    Rows stream out of the sheet while it is read.  What is not an .xlsx workbook
    (the older binary format included) becomes one row with an error.
    """

    def rows_of(batches):
        import csv
        import io
        import re
        import zipfile
        from xml.etree import ElementTree

        import pandas as pd

        columns = ["file_name", "pos", "line", "error"]

        def local(tag):
            return tag.rsplit("}", 1)[-1]

        def text_in(node):
            """Text of a string item, phonetic hints left out."""
            parts = []
            for child in node:
                if local(child.tag) == "t":
                    parts.append(child.text or "")
                elif local(child.tag) == "r":
                    parts += [t.text or "" for t in child if local(t.tag) == "t"]
            return "".join(parts)

        def shared_texts(book):
            if "xl/sharedStrings.xml" not in book.namelist():
                return []
            found = []
            with book.open("xl/sharedStrings.xml") as stream:
                for _, node in ElementTree.iterparse(stream):
                    if local(node.tag) == "si":
                        found.append(text_in(node))
                        node.clear()
            return found

        def first_sheet(book):
            target = None
            with book.open("xl/workbook.xml") as stream:
                for _, node in ElementTree.iterparse(stream):
                    if local(node.tag) == "sheet":
                        target = next((v for k, v in node.attrib.items() if local(k) == "id"), None)
                        break
            if target and "xl/_rels/workbook.xml.rels" in book.namelist():
                with book.open("xl/_rels/workbook.xml.rels") as stream:
                    for _, node in ElementTree.iterparse(stream):
                        if node.attrib.get("Id") == target:
                            path = node.attrib["Target"].lstrip("/")
                            return path if path.startswith("xl/") else "xl/" + path
            return "xl/worksheets/sheet1.xml"

        def column_of(ref, fallback):
            letters = re.match(r"[A-Z]+", ref or "")
            if not letters:
                return fallback
            n = 0
            for letter in letters.group():
                n = n * 26 + ord(letter) - 64
            return n - 1

        def cell_text(cell, shared):
            kind = cell.attrib.get("t")
            if kind == "inlineStr":
                return "".join(text_in(c) for c in cell if local(c.tag) == "is")
            value = next((c.text or "" for c in cell if local(c.tag) == "v"), "")
            if kind == "s" and value:
                return shared[int(value)]
            return value

        def as_line(values):
            out = io.StringIO()
            csv.writer(out, lineterminator="").writerow(values)
            return out.getvalue()

        def sheet(content):
            with zipfile.ZipFile(io.BytesIO(content)) as book:
                shared = shared_texts(book)
                with book.open(first_sheet(book)) as stream:
                    pos = 0
                    for _, node in ElementTree.iterparse(stream):
                        if local(node.tag) != "row":
                            continue
                        values = []
                        for cell in node:
                            at = column_of(cell.attrib.get("r"), len(values))
                            values += [""] * (at - len(values))
                            values.append(cell_text(cell, shared))
                        pos = int(node.attrib.get("r", pos + 1))
                        yield pos, as_line(values)
                        node.clear()

        rows = []
        for batch in batches:
            for name, content in zip(batch["file_name"], batch["content"]):
                try:
                    for pos, line in sheet(content):
                        rows.append((name, pos, line, None))
                        if len(rows) >= rows_per_batch:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                except Exception as problem:
                    rows.append((name, None, None, f"{type(problem).__name__}: {problem}"))
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    return payloads.select("file_name", "content").mapInPandas(rows_of, SHEET)


def usable_sheets(sheets: DataFrame) -> DataFrame:
    return sheets.where("error IS NULL").select("file_name", "pos", "line")


def bad_workbooks(sheets: DataFrame) -> DataFrame:
    return sheets.where("error IS NOT NULL").select("file_name", F.col("error").alias("reason"))
