"""Delimited text with banner lines: find each file's header, then read by name.

The header of a file is its first line that carries the marks of a
:class:`Layout`.  The separator is guessed from that line, cells are addressed by
the position of their name in it.  Files of different generations therefore union
by name at no cost: a name a file lacks reads as NULL.

Two entry points share all expressions:

* :func:`parse_payloads` – one row per file; a single narrow stage, no shuffle, no
  join, so it runs on streams too;
* :func:`parse_lines` – one row per line; the header table (one row per file) is
  settled once and joined, broadcast only when its measured size allows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finfilings.functions.names import clean_name, unique_names
from finfilings.functions.values import decode_bytes, null_text
from finfilings.session import BROADCAST_BYTES, settle, small_side, stored
from finfilings.sources.records import SOME_LEFT_OPEN, broken_record, join_records, may_open, opens, split_records


@dataclass(frozen=True)
class Layout:
    """What a header line looks like.

    ``words`` must all occur in the raw line; each of ``marks`` must match some
    token of it.  ``renames`` are (pattern, name) pairs applied to the tokens.
    """

    words: tuple[str, ...]
    marks: tuple[str, ...] = ()
    sep: str | None = None
    renames: tuple[tuple[str, str], ...] = ()
    charset: str = "UTF-8"


# Marks of a balance header and the spellings of two of its columns.
BALANCES = Layout(
    words=("DOCUMENTO", "CONTA", "SALDO"),
    marks=(r"(?i)^DOCUMENTO", r"(?i)^CONTA$", r"(?i)^SALDO$"),
    renames=(
        (r"(?i)^#?DATA[_ ]?BASE$", "DATA"),
        (r"(?i)^NOME[_ ]INSTITUICAO$", "NOME_INSTITUICAO"),
        (r"(?i)^DOCUMENTOS$", "DOCUMENTO"),
    ),
    charset="ISO-8859-1",
)

# Mark of an institution-list header.
INSTITUTIONS = Layout(words=("CNPJ",), sep=",")


# The byte-order mark as UTF-8 and as Latin-1 text.
BYTE_ORDER_MARK = "^(?:\ufeff|\u00ef\u00bb\u00bf)"


# --- expressions -----------------------------------------------------------------


def guess_sep(line: Column) -> Column:
    """``;`` if there is one, else ``,``, else blanks."""
    return F.when(line.contains(";"), ";").when(line.contains(","), ",").otherwise(" ")


def _cells(line: Column, sep: str) -> Column:
    """Cells of a line for one separator.

    Lines without quotes are split plainly.  For the others the pattern takes the
    inside of a quoted cell, or else everything up to the separator; it is possessive,
    so that the engine never goes back into a cell it has passed.
    """
    if sep == " ":
        plain = F.split(F.trim(line), r"\s+")
        padded = F.concat(F.trim(line), F.lit(" "))
        blank, inner, end = "", r"\S*+", r"\s++"
    else:
        mark = re.escape(sep)
        plain = F.split(line, mark)
        padded = F.concat(line, F.lit(sep))
        blank, inner, end = r"[ \t]*+", rf"[^{mark}]*+", mark
    pattern = rf'{blank}"?+((?<=")[^"]*+(?:""[^"]*+)*+(?="{blank}{end})|{inner})"?+{blank}{end}'
    quoted = F.regexp_extract_all(padded, F.lit(pattern), F.lit(1))
    doubled = F.transform(quoted, lambda c: F.replace(c, F.lit('""'), F.lit('"')))
    return F.when(~line.contains('"'), plain).when(line.contains('""'), doubled).otherwise(quoted)


def split_cells(line: Column, sep: Column | str) -> Column:
    """Cells of a line; quoted cells may hold the separator."""
    if isinstance(sep, str):
        return _cells(line, sep)
    return (
        F.when(sep == ";", _cells(line, ";")).when(sep == ",", _cells(line, ",")).otherwise(_cells(line, " "))
    )


def header_tokens(line: Column, sep: Column | str | None = None) -> Column:
    """Tokens of a header line: byte-order mark, quotes and outer blanks removed."""
    line = F.regexp_replace(line, BYTE_ORDER_MARK, "")
    cells = split_cells(line, guess_sep(line) if sep is None else sep)
    return F.transform(cells, lambda t: F.trim(F.regexp_replace(F.trim(t), "^[\"']|[\"']$", "")))


def has_words(line: Column, layout: Layout) -> Column:
    """Does the raw line hold every word of the layout?"""
    return reduce(and_, [line.rlike("(?i)" + re.escape(word)) for word in layout.words])


def is_header(line: Column, layout: Layout) -> Column:
    """Does the line carry every word and every mark of the layout?"""
    if not layout.marks:
        return has_words(line, layout)
    tokens = header_tokens(line, layout.sep)
    return has_words(line, layout) & reduce(and_, [F.exists(tokens, _matches(m)) for m in layout.marks])


def _matches(pattern: str):
    return lambda t: t.rlike(pattern)


def header_names(tokens: Column, layout: Layout) -> Column:
    """Upper-case column names of a header after renaming."""

    def rename(t: Column) -> Column:
        name = F.upper(t)
        for pattern, target in reversed(layout.renames):
            name = F.when(t.rlike(pattern), target).otherwise(name)
        return name

    return F.transform(tokens, rename)


def first_match(lines: Column, predicate) -> Column:
    """First array element for which the predicate holds, else NULL."""
    return F.get(F.filter(lines, predicate), 0)


# --- header tables ------------------------------------------------------------------


def once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column behind a generator, so that Catalyst evaluates it once per row
    however often it is used above."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_layout(df: DataFrame, layout: Layout) -> DataFrame:
    """Add separator and column names to rows holding a ``header`` line."""
    df = df.withColumn("sep", F.lit(layout.sep) if layout.sep else guess_sep(F.col("header")))
    tokens = header_tokens(F.col("header"), layout.sep or F.col("sep"))
    return once(df, header_names(tokens, layout), "names")


def find_headers(lines: DataFrame, layout: Layout) -> DataFrame:
    """One row per file with a header: ``file_name, header_pos, header, odd, sep, names``.

    Only lines that pass the header test, and lines that end inside a quoted cell, reach
    the aggregate, so the shuffle moves a few rows per file whatever the files' sizes.
    ``odd`` files have such lines; their records are put together before they are read.
    """
    # the plain tests stay in generated code; tokens are looked at behind a generator
    words, left_open = has_words(F.col("line"), layout), opens(F.col("line"), layout.sep) if layout.sep else may_open(F.col("line"))
    near = lines.where(words | left_open)
    near = near.select("file_name", "pos", "line", F.explode(F.array(F.struct(is_header(F.col("line"), layout).alias("head"), left_open.alias("open")))).alias("is"))
    first = near.groupBy("file_name").agg(
        F.min(F.when(F.col("is.head"), F.struct(F.col("pos").alias("header_pos"), F.col("line").alias("header")))).alias("h"), F.max("is.open").alias("odd")
    ).where("h is not null")
    return with_layout(first.select("file_name", "h.*", "odd"), layout)


def payload_headers(payloads: DataFrame, layout: Layout) -> DataFrame:
    """Add the header line to one-row-per-file payloads; files without one drop out.

    The regex engine walks the text up to the first candidate line, and on to the others
    only if that one is no header; the generators keep Catalyst from evaluating a search
    again for each later use.
    """
    lookaheads = "".join(rf"(?=[^\n]*{re.escape(w)})" for w in layout.words)
    pattern = F.lit(rf"(?im)^{lookaheads}[^\n]*")
    texts = once(payloads.select("file_name", _text(layout.charset).alias("text")), F.regexp_substr("text", pattern), "candidate")
    others = F.slice(F.filter(F.regexp_extract_all("text", pattern, F.lit(0)), lambda line: is_header(line, layout)), 1, 1)
    hit = F.when(is_header(F.col("candidate"), layout), F.array("candidate")).when(F.col("candidate").isNotNull(), others)
    return with_layout(texts.select("file_name", "text", F.explode(hit).alias("header")), layout)


def _text(charset: str) -> Column:
    text = decode_bytes(F.col("content"), charset)
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)


def _body_lines(df: DataFrame, sep: str | None) -> DataFrame:
    """Records after the header of each payload, and what is broken about them."""
    framed_text = F.concat(F.lit("\n"), "text", F.lit("\n"))
    framed_head = F.concat(F.lit("\n"), "header", F.lit("\n"))
    start = F.call_function("instr", framed_text, framed_head) + F.length("header") + 1
    keep = [c for c in df.columns if c not in ("text", "header")]
    sep = sep or F.col("sep")
    body = once(df.select(*keep, F.substr(F.col("text"), start).alias("text")), F.col("text"), "body")
    odd = F.col("body").rlike(SOME_LEFT_OPEN) & F.exists(F.split("body", "\n"), lambda line: opens(line, sep))
    body = once(body, odd, "odd")
    lines = F.when(F.col("odd"), split_records(F.col("body"), sep)).otherwise(F.split("body", "\n"))
    rows = body.select(*keep, "odd", F.explode(lines).alias("line"))
    return rows.select(*keep, "line", F.when(F.col("odd"), broken_record(F.col("line"), sep)).alias("broken"))


# --- readers --------------------------------------------------------------------------


def _positions(columns) -> Column:
    """Zero-based cell of each wanted column, NULL where the file lacks it."""
    return F.struct(
        *[
            F.nullif(F.array_position("names", F.lit(source)), F.lit(0).cast("bigint")).cast("int").alias(target)
            for target, source in columns.items()
        ]
    )


def _read_cells(df: DataFrame, per_file, columns, sep: str | None, strict: bool = False, tagged: bool = False) -> DataFrame:
    """Split each record once and pick the wanted cells.

    The generator keeps filters on cells from splitting the line again; blank lines go
    after it, so that the test does not move below a table that prints its lines.
    With ``strict`` a record of more or fewer cells than the header is broken.  Broken
    records give no rows, unless ``tagged``: then all records come, with the ``reason`` and
    the first line of the broken ones.
    """
    keep = ["file_name", *per_file]
    cells = once(df, split_cells(F.col("line"), sep or F.col("sep")), "cells")
    cells = cells.where((F.size("cells") > 1) | (F.trim(F.get("cells", F.lit(0))) != ""))
    reason = F.col("broken")
    if strict:
        reason = F.coalesce(reason, F.when(F.size("cells") != F.col("width"), F.format_string("%d cells for %d columns", F.size("cells"), F.col("width"))))
    found = [null_text(F.get("cells", at)).alias(name) for name, at in columns.items()]
    if tagged:
        return cells.select(*keep, *found, reason.alias("reason"), F.when(reason.isNotNull(), F.substring_index("line", "\n", 1)).alias("record"))
    return cells.where(reason.isNull()).select(*keep, *found)


def _by_position(columns) -> dict[str, Column]:
    return {target: F.col(f"at.{target}") - 1 for target in columns}


def _whole_files(heads: DataFrame, per_file) -> DataFrame:
    """Add columns computed once per file; files for which one is NULL drop out.

    They drop out through a generator: a plain filter would be inferred across the
    join and then run on every line.
    """
    for name, value in per_file.items():
        heads = heads.select("*", F.explode(F.array_compact(F.array(value))).alias(name))
    return heads


def parse_payloads(
    payloads: DataFrame, layout: Layout, columns: dict[str, str], per_file: dict[str, Column] | None = None,
    strict: bool = False, tagged: bool = False, holding: str | None = None,
) -> DataFrame:
    """Rows of one-row-per-file payloads, as text columns.

    ``columns`` maps output names to header names (upper case, after renaming);
    ``per_file`` adds columns computed from ``file_name`` once per file.  ``holding``: see
    :func:`parse_lines`; ``strict`` and ``tagged``: see :func:`_read_cells`.
    """
    per_file = per_file or {}
    heads = _whole_files(payload_headers(payloads, layout), per_file)
    heads = heads.select("file_name", *per_file, "text", "header", "sep", F.size("names").alias("width"), _positions(columns).alias("at"))
    body = _body_lines(heads, layout.sep)
    if holding:  # what is broken may have held it
        body = body.where(F.col("line").contains(holding) | F.col("broken").isNotNull())
    return _read_cells(body, per_file, _by_position(columns), layout.sep, strict, tagged)


def parse_lines(
    lines: DataFrame,
    layout: Layout,
    columns: dict[str, str],
    headers: DataFrame | None = None,
    per_file: dict[str, Column] | None = None,
    holding: str | None = None,
    strict: bool = False,
    tagged: bool = False,
) -> DataFrame:
    """Rows of a line table, as text columns.

    ``headers`` takes a settled result of :func:`find_headers`.  ``holding`` is a text
    that wanted lines are known to contain; others are passed over before they are split.
    ``strict`` and ``tagged``: see :func:`_read_cells`.
    """
    per_file = per_file or {}
    if headers is None:
        headers = settle(find_headers(lines, layout))
    heads = _whole_files(headers, per_file)
    heads = heads.select("file_name", *per_file, "header_pos", "sep", "odd", F.size("names").alias("width"), _positions(columns).alias("at"))
    return _read_cells(_records(lines, heads, layout.sep, holding), per_file, _by_position(columns), layout.sep, strict, tagged)


def _records(lines: DataFrame, heads: DataFrame, sep: str | None, holding: str | None = None) -> DataFrame:
    """Lines after the headers; those of odd files are joined to records."""
    def held(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("line").contains(holding)) if holding else rows

    def after(rows: DataFrame, heads: DataFrame) -> DataFrame:
        return rows.join(small_side(heads.drop("odd")), "file_name").where(F.col("pos") > F.col("header_pos"))

    none = F.lit(None).cast("string").alias("broken")
    if heads.where("odd").isEmpty():
        return after(held(lines), heads).select("*", none)
    joined = join_records(after(lines, heads.where("odd")), sep or F.col("sep"))
    if holding:  # what is broken may have held it
        joined = joined.where(F.col("line").contains(holding) | F.col("broken").isNotNull())
    return after(held(lines), heads.where("not odd")).select("*", none).unionByName(joined)


def _layout_map(headers: DataFrame):
    """The union of all headers' clean names, in first-seen order, and a table ``names, at`` of
    where each distinct header has them.

    Headers stay a table, however many differ; only the distinct names, which become columns,
    pass through the driver.
    """
    spark = headers.sparkSession
    seen = settle(headers.groupBy("names").agg(F.min("file_name").alias("first_file")).withColumn("layout", F.monotonically_increasing_id()))
    cells = seen.select("layout", "first_file", F.posexplode("names").alias("pos", "raw"))
    raw = [r["raw"] for r in cells.select("raw").distinct().collect()]  # the vocabulary of column names
    clean = spark.createDataFrame([(n, clean_name(n)) for n in raw], "raw string, clean string")
    clean = F.broadcast(clean) if sum(2 * len(n) + 32 for n in raw) <= BROADCAST_BYTES else clean
    rows = cells.join(clean, "raw").groupBy("layout", "first_file").agg(F.array_sort(F.collect_list(F.struct("pos", "clean"))).alias("cells"))
    # a later copy of a name in the same header gets a number
    copies = lambda c, i: F.size(F.filter(F.slice("cleans", F.lit(1), i), lambda x: x == c))
    rows = rows.select("layout", "first_file", F.transform("cells", lambda c: c["clean"]).alias("cleans")).withColumn(
        "cleans", F.transform("cleans", lambda c, i: F.when(copies(c, i) == 0, c).otherwise(F.concat_ws("_", c, copies(c, i) + 1))))
    rows = settle(rows)
    first = rows.select("first_file", F.posexplode("cleans").alias("pos", "name")).groupBy("name").agg(F.min(F.struct("first_file", "pos")).alias("first"))
    union = [r["name"] for r in first.orderBy("first", "name").collect()]
    at = F.transform(F.array(*[F.lit(n) for n in union]), lambda n: F.nullif(F.array_position("cleans", n), F.lit(0).cast("bigint")).cast("int") - 1)
    table = seen.select("layout", "names").join(rows.select("layout", at.alias("at")), "layout").drop("layout")
    return union, small_side(settle(table))


def _by_union(union, per_file) -> dict[str, Column]:
    """Columns by name; one that is called like a column of every result gets a number."""
    taken = ["file_name", *per_file]
    names = unique_names([*taken, *union])[len(taken):]
    return {name: F.get("at", F.lit(i)) for i, name in enumerate(names)}


def parse_lines_by_name(
    lines: DataFrame,
    layout: Layout,
    headers: DataFrame | None = None,
    per_file: dict[str, Column] | None = None,
) -> DataFrame:
    """Like :func:`parse_lines` with every column any file has, names cleaned, in
    first-seen order."""
    per_file = per_file or {}
    if headers is None:
        headers = settle(find_headers(lines, layout))
    heads = _whole_files(headers, per_file)
    union, table = _layout_map(heads)
    heads = heads.join(table, "names").select("file_name", *per_file, "header_pos", "sep", "odd", "at")
    return _read_cells(_records(lines, heads, layout.sep), per_file, _by_union(union, per_file), layout.sep)


def parse_payloads_by_name(
    payloads: DataFrame, layout: Layout, per_file: dict[str, Column] | None = None
) -> DataFrame:
    """Like :func:`parse_payloads` with every column any file has."""
    per_file = per_file or {}
    heads = _whole_files(payload_headers(payloads, layout), per_file)
    union, table = _layout_map(heads.select("file_name", "names"))
    heads = heads.join(table, "names")
    heads = heads.select("file_name", *per_file, "text", "header", "sep", "at")
    return _read_cells(_body_lines(heads, layout.sep), per_file, _by_union(union, per_file), layout.sep)


# --- rejects ------------------------------------------------------------------------------


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows, and broken records as ``file_name, reason, record``, of a tagged reading: it is
    run once and stored, and both are read from there."""
    kept = stored(tagged)
    return kept.where("reason IS NULL").drop("reason", "record"), kept.where("reason IS NOT NULL").select("file_name", "reason", "record")


def _missing(required) -> Column:
    absent = F.array_except(F.array(*[F.lit(n) for n in required]), F.coalesce("names", F.array().cast("array<string>")))
    return F.when(F.col("names").isNull(), F.lit("no header line")).when(
        F.size(absent) > 0, F.concat(F.lit("missing columns: "), F.array_join(absent, ", "))
    )


def reject_payloads(payloads: DataFrame, layout: Layout, required=()) -> DataFrame:
    """Files that give no rows and why: ``file_name, reason``."""
    lookaheads = "".join(rf"(?=[^\n]*{re.escape(w)})" for w in layout.words)
    texts = payloads.select("file_name", _text(layout.charset).alias("text"))
    candidates = F.regexp_extract_all("text", F.lit(rf"(?im)^{lookaheads}[^\n]*"), F.lit(0))
    header = first_match(candidates, lambda line: is_header(line, layout))
    texts = once(texts.select("file_name", header.alias("h"), (~F.col("text").rlike(r"\S")).alias("empty")), F.col("h"), "header")
    rows = with_layout(texts, layout)
    reason = F.when(F.col("empty"), "empty file").otherwise(_missing(required))
    return rows.select("file_name", reason.alias("reason")).where("reason IS NOT NULL")


def reject_lines(lines: DataFrame, layout: Layout, headers: DataFrame | None = None, required=()) -> DataFrame:
    """The same over a line table."""
    if headers is None:
        headers = settle(find_headers(lines, layout))
    files = lines.groupBy("file_name").agg(F.max(F.col("line").rlike(r"\S")).alias("has_text"))
    rows = files.join(headers.select("file_name", "names"), "file_name", "left")
    reason = F.when(~F.col("has_text"), "empty file").otherwise(_missing(required))
    return rows.select("file_name", reason.alias("reason")).where("reason IS NOT NULL")
