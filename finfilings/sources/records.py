"""Records whose quoted cells hold line breaks.

A cell that begins with a quote ends at the next quote that is not doubled, be it lines away,
if a separator or the end of a line follows there.  So whether a line goes on with the record
before it depends on how the lines before it were left, and on the next line with a quote.

How a line leaves things is a function of two values, *entered between records or cells* and
*entered inside a quoted cell*.  Such functions compose: each split of a file is folded to one
of them, the splits of a file are put in order, and then every split reads its lines knowing
how it is entered and what comes behind it.  Lines are shuffled by file and split, never by
file alone.  A quote that opens a cell at the end of a line, and that no later line closes,
is not an opening: its line alone is broken and the next one begins a record.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finfilings.session import settle, small_side, stored

BLANK = r"[ \t]*+"
#: From inside a quoted cell up to the first quote that is not doubled.
INSIDE = r'[^"]*+(?:""[^"]*+)*+'
#: Positions that are plain numbers are cut into pieces of this many (a power of two).
PIECE_BITS = 17
#: A record of more lines is broken.
RECORD_LINES = 10_000

SEPARATORS = (";", ",")


def _by_sep(sep: Column | str, what) -> Column:
    """``what`` for each separator; lines of blanks have no quoted cells."""
    if isinstance(sep, str):
        return what(re.escape(sep)) if sep in SEPARATORS else F.lit(False)
    out = F.when(sep == SEPARATORS[0], what(SEPARATORS[0]))
    for one in SEPARATORS[1:]:
        out = out.when(sep == one, what(one))
    return out.otherwise(False)


def _ends_inside(record: Column, sep: Column | str) -> Column:
    def of(s: str) -> Column:
        tail = rf'{BLANK}"{INSIDE}\z'
        whole = rf'{BLANK}"{INSIDE}"{BLANK}(?={s}|\z)'
        return record.rlike(rf"^(?:(?>{whole}|(?!{tail})[^{s}]*+){s})*+{tail}")

    return _by_sep(sep, of)


#: A quote that might begin a cell, and no single quote after it: few lines pass, whatever the
#: separator.  The quote stands first, so that the engine passes over all else at once.
LEFT_OPEN = rf'"(?<=(?:^|[{"".join(SEPARATORS)} \t])"){INSIDE}\z'
#: The same for any line of a text.
SOME_LEFT_OPEN = rf'"(?<=(?:^|[{"".join(SEPARATORS)} \t\n])")[^"\n]*+(?:""[^"\n]*+)*+(?=\n|\z)'


def opens(line: Column, sep: Column | str) -> Column:
    """Does the line, read from the beginning of a cell, end inside a quoted cell?"""
    return line.contains('"') & line.rlike(LEFT_OPEN) & _ends_inside(line, sep)


def _closing(s: str) -> str:
    return rf'^{INSIDE}"{BLANK}(?:{s}|\z)'


def closes(line: Column, sep: Column | str) -> Column:
    """Does the line, read from inside a quoted cell, end that cell properly?"""
    return _by_sep(sep, lambda s: line.rlike(_closing(s)))


def may_open(line: Column) -> Column:
    """Could the line end inside a quoted cell, whatever the separator?"""
    found = F.lit(False)
    for sep in SEPARATORS:
        found = found | _ends_inside(line, sep)
    return line.contains('"') & line.rlike(LEFT_OPEN) & found


def split_records(text: Column, sep: Column | str) -> Column:
    """Records of a whole text, as :func:`join_records` finds them in its lines."""
    def of(s: str) -> Column:
        whole = rf'{BLANK}"{INSIDE}"{BLANK}(?={s}|\n|\z)'
        tail = r'[ \t]*+"[^"\n]*+(?:""[^"\n]*+)*+(?=\n|\z)'
        cell = rf"(?>{whole}|{tail}|[^{s}\n]*+)"
        return F.regexp_extract_all(text, F.lit(rf"(?:{cell}{s})*+{cell}(?=\n|\z)"), F.lit(0))

    lines = F.split(text, "\n")
    if isinstance(sep, str):
        return of(re.escape(sep)) if sep in SEPARATORS else lines
    out = F.when(sep == SEPARATORS[0], of(SEPARATORS[0]))
    for one in SEPARATORS[1:]:
        out = out.when(sep == one, of(one))
    return out.otherwise(lines)


def broken_record(record: Column, sep: Column | str) -> Column:
    """Why a record of :func:`split_records` cannot be read, or null."""
    n = F.length(record) - F.length(F.translate(record, "\n", "")) + 1
    return F.when(n > RECORD_LINES, F.format_string("a quoted cell over %d lines", n)).when(_ends_inside(record, sep), F.lit("a quote is never closed"))


def _behaviour(line: Column, sep: Column | str) -> Column:
    """How a line leaves things: ``out`` and ``into`` (inside a quoted cell afterwards, when
    entered outside or inside one), ``ends`` (it has a quote that ends a cell or spoils it),
    ``closes`` (ends it properly), ``again`` (and then opens another)."""
    rest = _by_sep_text(line, sep)
    quoted, closed, ended = line.contains('"'), closes(line, sep), line.rlike(rf'^{INSIDE}"')
    out, again = opens(line, sep), closed & opens(rest, sep)
    into = F.when(closed, again).when(~ended, True).otherwise(out)
    # a line without quotes is not looked at further
    plain = F.struct(F.lit(0).alias("out"), F.lit(1).alias("into"), *[F.lit(False).alias(c) for c in ("ends", "closes", "again")])
    return F.when(~quoted, plain).otherwise(
        F.struct(out.cast("int").alias("out"), into.cast("int").alias("into"), ended.alias("ends"), closed.alias("closes"), again.alias("again")))


def _by_sep_text(line: Column, sep: Column | str) -> Column:
    cut = lambda s: F.regexp_replace(line, _closing(s), "")
    if isinstance(sep, str):
        return cut(re.escape(sep)) if sep in SEPARATORS else line
    out = F.when(sep == SEPARATORS[0], cut(SEPARATORS[0]))
    for one in SEPARATORS[1:]:
        out = out.when(sep == one, cut(one))
    return out.otherwise(line)


def _odd(c: Column) -> Column:
    return F.pmod(c, F.lit(2))


def join_records(lines: DataFrame, sep: Column | str) -> DataFrame:
    """Lines ``file_name, pos, line, …`` with the lines of a record joined by line breaks,
    plus ``broken``, the reason why a record cannot be read, or null.

    ``pos`` orders the lines of a file: a number, or (split, row).  The other columns are
    those of the record's first line.  How each line behaves is found once and stored with
    the line, as are the lines of records of several.
    """
    columns = lines.columns
    struct = lines.schema["pos"].dataType.typeName() == "struct"
    split = F.col("pos.split") if struct else F.shiftright(F.col("pos"), PIECE_BITS)
    row = F.col("pos.row") if struct else F.col("pos")
    rows = lines.select("*", split.alias("_split"), row.alias("_row"), F.explode(F.array(_behaviour(F.col("line"), sep))).alias("_b"))

    piece = Window.partitionBy("file_name", "_split").orderBy("_row")
    upto = piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = piece.rowsBetween(Window.unboundedPreceding, -1)
    # backwards, as a frame that looks forward is built anew for each row
    behind = Window.partitionBy("file_name", "_split").orderBy(F.col("_row").desc()).rowsBetween(Window.unboundedPreceding, -1)
    swap = ((F.col("_b.out") == 1) & (F.col("_b.into") == 0)).cast("int")
    rows = rows.withColumn("_k", F.sum(swap).over(upto))
    # the last line that leaves things alike however it is entered
    fixed = F.when(F.col("_b.out") == F.col("_b.into"), F.struct("_row", F.col("_b.out").alias("v"), "_k"))
    rows = rows.select("*", F.max(fixed).over(before).alias("_fixed"), F.coalesce(F.lag("_k").over(piece), F.lit(0)).alias("_kb"), fixed.alias("_own"),
                       F.last(F.when(F.col("_b.ends"), F.col("_b.closes")), ignorenulls=True).over(behind).alias("_next"))
    rows = stored(rows)

    pieces = rows.groupBy("file_name", "_split").agg(
        F.max("_own").alias("own"), F.max("_k").alias("k"), F.min(F.when(F.col("_b.ends"), F.struct("_row", "_b.closes"))).alias("ends"))
    files = Window.partitionBy("file_name").orderBy("_split")
    pieces = pieces.withColumn("p", F.sum("k").over(files.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    left = F.when(F.col("own").isNotNull(), F.struct("_split", _odd(F.col("own.v") + F.col("k") - F.col("own._k")).alias("v"), "p"))
    pieces = pieces.withColumn("left", left)
    known = F.max("left").over(files.rowsBetween(Window.unboundedPreceding, -1))
    sofar = F.col("p") - F.col("k")
    later = F.last("ends.closes", ignorenulls=True).over(
        Window.partitionBy("file_name").orderBy(F.col("_split").desc()).rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("file_name", "_split", known.alias("known"), sofar.alias("sofar"), later.alias("_later")).select(
        "file_name", "_split", F.when(F.col("known").isNull(), _odd(F.col("sofar"))).otherwise(_odd(F.col("known.v") + F.col("sofar") - F.col("known.p"))).alias("_entry"), "_later")

    rows = rows.join(small_side(settle(pieces)), ["file_name", "_split"])
    inside = F.when(F.col("_fixed").isNull(), _odd(F.col("_entry") + F.col("_kb"))).otherwise(_odd(F.col("_fixed.v") + F.col("_kb") - F.col("_fixed._k"))) == 1
    rows = rows.select("*", inside.alias("_inside"), F.coalesce("_next", "_later", F.lit(False)).alias("_closed"))
    goes_on = F.col("_inside") & F.when(F.col("_b.ends"), F.col("_b.closes")).otherwise(F.col("_closed"))
    opened = F.when(F.col("_inside"), F.when(F.col("_b.closes"), F.col("_b.again")).otherwise(F.col("_b.ends") & (F.col("_b.out") == 1))).otherwise(F.col("_b.out") == 1)
    rows = rows.select("*", goes_on.alias("_on"), opened.alias("_opened"))
    rows = rows.select(*columns, "_split", "_row", "_on", (F.col("_opened") & ~F.col("_closed")).alias("_unclosed"),
                       (F.col("_on") | (F.col("_opened") & F.col("_closed"))).alias("_many"), (~F.col("_on")).cast("long").alias("_start"))

    never = F.when(F.col("_unclosed"), F.lit("a quote is never closed"))
    single = rows.where(~F.col("_many")).select(*columns, never.alias("broken"))

    # records of several lines: numbered over the splits by the lines that begin them
    many = rows.where("_many")
    begun = many.groupBy("file_name", "_split").agg(F.sum("_start").alias("n"))
    begun = begun.select("file_name", "_split", F.coalesce(F.sum("n").over(files.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    many = stored(many.join(small_side(settle(begun)), ["file_name", "_split"]).withColumn("_record", F.col("_before") + F.sum("_start").over(upto)))
    sizes = many.groupBy("file_name", "_record").agg(F.count("*").alias("_n"), F.max("_unclosed").alias("_spoilt"))
    many = many.join(sizes, ["file_name", "_record"])
    # of a record with too many lines the first one stands for all
    kept = many.where((F.col("_n") <= RECORD_LINES) | (F.col("_start") == 1))
    others = [c for c in columns if c not in ("file_name", "pos", "line")]
    whole = kept.groupBy("file_name", "_record").agg(
        F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("_lines"), F.min(F.struct("pos", *others)).alias("_first"), F.first("_n").alias("_n"), F.first("_spoilt").alias("_spoilt"))
    reason = F.when(F.col("_n") > RECORD_LINES, F.format_string("a quoted cell over %d lines", F.col("_n"))).when(F.col("_spoilt"), F.lit("a quote is never closed"))
    joined = whole.select(
        "file_name", "_first.*", F.array_join(F.transform("_lines", lambda x: x["line"]), "\n").alias("line"), reason.alias("broken"))
    return single.unionByName(joined.select(*columns, "broken"))
