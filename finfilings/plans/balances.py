"""Balance sheets: landing plan and report, long table, wide table per type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.functions.names import base_name, clean_name, drop_listed, file_type, plain_file_name
from finfilings.functions.periods import ref_month
from finfilings.functions.values import pad_cnpj, parse_decimal, parse_integer
from finfilings.operators.audit import landing_report, suffix_rank
from finfilings.operators.grids import balance_grid
from finfilings.operators.reshape import filter_document, pivot_wide, split_by_type
from finfilings.operators.sinks import write_long, write_wide_by_type
from finfilings.session import checkpoint_dir, settle, small_side, stored
from finfilings.functions.values import decode_bytes
from finfilings.sources.delimited import (
    BALANCES,
    find_headers,
    parse_lines,
    parse_lines_by_name,
    parse_payloads,
    parse_payloads_by_name,
    reject_lines,
    reject_payloads,
    split_tagged,
)
from finfilings.sources.landing import (
    BALANCE_GLOB,
    WHOLE_FILE_BYTES,
    balance_files,
    file_lines,
    file_payloads,
    forbid_collisions,
    list_files,
)
from finfilings.sources.zipped import unpack
from finfilings.vocab import BALANCE_IDS, DROPPED_BALANCE_COLUMNS

# Output column → header name of the balance columns that are kept.
COLUMNS = {
    "data": "DATA",
    "documento": "DOCUMENTO",
    "cnpj": "CNPJ",
    "nome_instituicao": "NOME_INSTITUICAO",
    "conta": "CONTA",
    "saldo": "SALDO",
}
REQUIRED = tuple(COLUMNS.values())
ZIP_GLOB = "*.[zZ][iI][pP]"
CSV_NAME = r"(?i)\.csv$"


def _per_file() -> dict:
    """Type of a file; files without a conforming name give no rows."""
    return {"inst_type": file_type(plain_file_name(F.col("file_name")))}


def type_rows(rows: DataFrame, keep=("reason", "record")) -> DataFrame:
    """Text rows of the reader with their types; tags stay."""
    return rows.select(
        "file_name",
        "inst_type",
        "data",
        ref_month(F.col("data")).alias("ref_month"),
        parse_integer(F.col("documento")).alias("documento"),
        pad_cnpj(F.col("cnpj")).alias("cnpj"),
        "nome_instituicao",
        "conta",
        parse_decimal(F.col("saldo")).alias("saldo"),
        *[c for c in keep if c in rows.columns],
    )


def balances_from_payloads(payloads: DataFrame, tagged: bool = False, document: int | None = None) -> DataFrame:
    """Long balances from one-row-per-file payloads; also runs on a stream.  ``document``:
    see :func:`balances_from_lines`."""
    rows = type_rows(parse_payloads(payloads, BALANCES, COLUMNS, _per_file(), tagged=tagged, holding=_holding(document)))
    return _of_document(rows, document)


def balances_from_lines(
    lines: DataFrame, document: int | None = None, headers: DataFrame | None = None, tagged: bool = False
) -> DataFrame:
    """Long balances from a line table.  With a document number, lines that do not even
    contain its digits are passed over before they are split."""
    rows = type_rows(parse_lines(lines, BALANCES, COLUMNS, headers, _per_file(), _holding(document), tagged=tagged))
    return _of_document(rows, document)


def _holding(document: int | None) -> str | None:
    """What a line of the document is known to contain."""
    return None if document is None else str(document)


def _of_document(rows: DataFrame, document: int | None) -> DataFrame:
    """Rows of a document, and whatever cannot be read."""
    if document is None:
        return rows
    kept = F.col("documento") == document
    return rows.where(kept | F.col("reason").isNotNull()) if "reason" in rows.columns else filter_document(rows, document)


def _archives(spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES, contents: bool = True):
    """Members, small members and lines of large members of a folder's archives; nothing is
    run where there is none."""
    if list_files(spark, path, ZIP_GLOB).isEmpty():
        none = lambda schema: spark.createDataFrame([], schema)
        return (none("archive string, member string, size bigint, error string"), none("archive string, member string, content binary"),
                none("archive string, member string, pos bigint, raw binary"))
    return unpack(spark, path, ZIP_GLOB, whole_file_bytes, CSV_NAME, contents)


def balance_forms(spark: SparkSession, path: str, members: DataFrame) -> DataFrame:
    """CSV files of a folder and sound CSV members of its archives, in the best form that each
    period has: ``name, file_name, member, size``.

    ``name`` is the plain name in upper case, ``file_name`` the file or archive, ``member``
    null for a file, ``size`` the unpacked size.  The order of forms is that of
    ``LANDING_SUFFIXES``.  A member counts only if size and checksum were proven, so a
    damaged one stands behind every other form.
    """
    files = list_files(spark, path, BALANCE_GLOB).select("file_name", F.lit(None).cast("string").alias("member"), F.col("length").alias("size"))
    sound = members.where("error IS NULL").where(F.col("member").rlike(CSV_NAME))
    both = files.unionByName(sound.select(F.col("archive").alias("file_name"), "member", "size"))
    suffix = F.regexp_extract("file_name", r"(?i)(\.csv\.zip|\.csv|\.zip)$", 1)
    named = settle(both.withColumns({
        "name": F.upper(plain_file_name(F.coalesce("member", "file_name"))), "rank": suffix_rank(suffix),
    }))
    best = named.groupBy("name").agg(F.min("rank").alias("rank"))
    return named.join(best, ["name", "rank"]).drop("rank")


def balance_sources(spark: SparkSession, path: str, members: DataFrame | None = None) -> DataFrame:
    """One form of each period: of equal forms that of the first file name counts."""
    if members is None:
        members = _archives(spark, path, contents=False)[0]
    first = F.min(F.struct("file_name", "member", "size")).alias("first")
    return settle(balance_forms(spark, path, members).groupBy("name").agg(first).select("name", "first.*"))


def import_balance_sheets(
    spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES, document: int | None = None
) -> DataFrame:
    """All rows of all balance files of a folder, archives included, each period once.

    Files and members are parsed one per row up to ``whole_file_bytes`` (of members: the
    unpacked size) and line by line above; the rows are the same.  With a ``document`` only
    its rows are returned, and long files' other lines are passed over unsplit.  Quoted
    cells may hold line breaks.  Archives are read once; a period whose archive is damaged
    comes from its next form.
    """
    return _imported(spark, path, whole_file_bytes, document, False)


def read_balance_sheets(
    spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES, document: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`import_balance_sheets` and the records that give none (``file_name,
    reason, record``: its first line), from one pass that stores both."""
    return split_tagged(_imported(spark, path, whole_file_bytes, document, True))


def _imported(spark, path, whole_file_bytes, document, tagged, archives=None) -> DataFrame:
    archives = archives or _archives(spark, path, whole_file_bytes)
    sources = balance_sources(spark, path, archives[0])
    out = None
    for payloads in _small_payloads(spark, path, whole_file_bytes, sources, archives[1]):
        rows = balances_from_payloads(payloads, tagged, document)
        out = rows if out is None else out.unionByName(rows)
    for lines in _large_sources(spark, path, whole_file_bytes, sources, archives[2]):
        rows = balances_from_lines(lines, document, tagged=tagged)
        out = out.unionByName(rows.withColumn("file_name", base_name(F.col("file_name"))))
    return out


def import_all_columns(spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Like :func:`import_balance_sheets` with every column that any file has, names cleaned,
    but for those of ``DROPPED_BALANCE_COLUMNS``; what a file lacks is null.

    The columns of :func:`import_balance_sheets` come first, typed; the others are text.
    """
    archives = _archives(spark, path, whole_file_bytes)
    sources = balance_sources(spark, path, archives[0])
    found = [parse_payloads_by_name(p, BALANCES, _per_file()) for p in _small_payloads(spark, path, whole_file_bytes, sources, archives[1])]
    for lines in _large_sources(spark, path, whole_file_bytes, sources, archives[2]):
        found.append(parse_lines_by_name(lines, BALANCES, None, _per_file()).withColumn("file_name", base_name(F.col("file_name"))))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    out = drop_listed(out, [clean_name(c) for c in DROPPED_BALANCE_COLUMNS])
    out = out.withColumns({c: F.lit(None).cast("string") for c in COLUMNS if c not in out.columns})
    typed = ("file_name", "inst_type", "ref_month", *COLUMNS)
    return type_rows(out, keep=[c for c in out.columns if c not in typed])


def _of_files(df: DataFrame, sources: DataFrame) -> DataFrame:
    wanted = small_side(settle(sources.where("member IS NULL").select("file_name")))
    return df.join(wanted, "file_name", "left_semi")


def _of_members(df: DataFrame, sources: DataFrame) -> DataFrame:
    wanted = small_side(settle(sources.where("member IS NOT NULL").select(F.col("file_name").alias("archive"), "member")))
    return df.join(wanted, ["archive", "member"], "left_semi")


def _small_payloads(spark, path, whole_file_bytes, sources, unpacked) -> list[DataFrame]:
    small = file_payloads(spark, path, BALANCE_GLOB, max_bytes=whole_file_bytes).select("file_name", "content")
    out = [_of_files(small, sources)]
    if not sources.where("member IS NOT NULL").isEmpty():
        out.append(_of_members(unpacked, sources).select(base_name(F.col("member")).alias("file_name"), "content"))
    return out


def _large_sources(spark, path, whole_file_bytes, sources, unpacked) -> list[DataFrame]:
    """Line tables of what is above the size, stored; none if there is nothing."""
    large = sources.where(F.col("size") > whole_file_bytes)
    out = []
    if not large.where("member IS NULL").isEmpty():
        lines = file_lines(spark, path, BALANCE_GLOB, charset=BALANCES.charset, above_bytes=whole_file_bytes)
        out.append(_of_files(lines, sources))
    if not large.where("member IS NOT NULL").isEmpty():
        # files are told apart by archive and member
        name = F.concat_ws("/", "archive", "member").alias("file_name")
        out.append(_of_members(unpacked, sources).select(name, "pos", decode_bytes(F.col("raw"), BALANCES.charset).alias("line")))
    return out


def _damaged(members: DataFrame) -> DataFrame:
    """Archives, and members of them, that cannot be read: ``file_name, reason``."""
    return members.where("error IS NOT NULL").select(F.col("archive").alias("file_name"), F.concat_ws(": ", "member", "error").alias("reason"))


def balance_rejects(
    spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES, required=()
) -> DataFrame:
    """Files that give no rows, with the reason: ``file_name, reason``.

    ``required`` names columns whose lack counts as a reason too, though such a file does
    give rows (see :func:`balance_gaps`).  Spark scans pass over files of zero bytes; the
    landing report shows them as not landed.  Single records that cannot be read are told
    by :func:`read_balance_sheets`.
    """
    names = list_files(spark, path, BALANCE_GLOB)
    bad_name = names.where(file_type(plain_file_name(F.col("file_name"))).isNull())
    out = bad_name.select("file_name", F.lit("file name is not YYYYMM and a type").alias("reason"))
    members, payloads, lines = _archives(spark, path, whole_file_bytes)
    out = out.unionByName(_damaged(members))
    sources = balance_sources(spark, path, members)
    for found in _small_payloads(spark, path, whole_file_bytes, sources, payloads):
        out = out.unionByName(reject_payloads(found, BALANCES, required))
    for found in _large_sources(spark, path, whole_file_bytes, sources, lines):
        headers = settle(find_headers(found, BALANCES))
        out = out.unionByName(reject_lines(found, BALANCES, headers, required))
    return out


def balance_gaps(spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Files that lack a required column and give rows with nulls there: ``file_name, reason``."""
    found = balance_rejects(spark, path, whole_file_bytes, REQUIRED)
    return found.where(F.col("reason").startswith("missing columns: "))


def long_balances(spark: SparkSession, path: str, doc_filter: int = 4010, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Long balances of one document, names checked for collisions first."""
    archives = _archives(spark, path, whole_file_bytes)
    forms = settle(balance_forms(spark, path, archives[0]))
    if forms.isEmpty():
        balance_files(spark, path)
    forbid_collisions(forms.select(F.concat_ws("/", "file_name", "member").alias("file_name")))
    return _imported(spark, path, whole_file_bytes, doc_filter, False, archives)


def forbid_missing_columns(long: DataFrame, spark: SparkSession, path: str, **options) -> DataFrame:
    """Fail, naming type and columns, if no file of a type has a required one.

    Headers are looked at only where all values of a column are null.
    """
    counts = long.groupBy("inst_type").agg(*[F.count(c).alias(c) for c in COLUMNS])
    absent = F.array_compact(F.array(*[F.when(F.col(c) == 0, F.lit(c)) for c in COLUMNS]))
    bad = counts.select("inst_type", absent.alias("absent")).where(F.size("absent") > 0).orderBy("inst_type").collect()
    if bad:
        kind = file_type(plain_file_name(F.col("file_name"))).alias("inst_type")
        files = balance_sources(spark, path).select(F.coalesce("member", "file_name").alias("file_name")).groupBy(kind).agg(F.count("*").alias("n"))
        gaps = balance_gaps(spark, path, **options).select(kind, F.explode(F.split(F.substring_index("reason", ": ", -1), ", ")).alias("c"))
        absent = gaps.groupBy("inst_type", "c").agg(F.count("*").alias("n")).join(files, ["inst_type", "n"])
        named = {v: k for k, v in COLUMNS.items()}
        lacks = {(r["inst_type"], named[r["c"]]) for r in absent.collect()}
        bad = [{"inst_type": r["inst_type"], "absent": [c for c in r["absent"] if (r["inst_type"], c) in lacks]} for r in bad]
        bad = [r for r in bad if r["absent"]]
    if bad:
        raise ValueError("missing required columns: " + "; ".join(f"{r['inst_type']}: {', '.join(r['absent'])}" for r in bad))
    return long


def wide_balances(long: DataFrame, accounts=None, on_duplicate: str = "error", names=None) -> DataFrame:
    """One row per institution and month, one column per account."""
    return pivot_wide(long, BALANCE_IDS, "conta", "saldo", accounts, on_duplicate, names)


def tidy_balance_sheets(
    spark: SparkSession,
    path_raw: str,
    out_dir: str | None = None,
    doc_filter: int = 4010,
    save: bool = True,
    on_duplicate: str = "error",
    **options,
) -> dict[str, DataFrame]:
    """Wide balances per institution type; with ``save`` also written as CSV folders.

    The parsed long table is stored once, partitioned by type; each type's accounts
    and wide table then read their own partition.
    """
    if save and not out_dir:
        raise ValueError("out_dir is needed to save")
    long = long_balances(spark, path_raw, doc_filter, **options)
    # a folder of this document's own, replaced as a whole
    folder = f"{out_dir.rstrip('/')}/long_{doc_filter}" if save else _scratch(spark)
    write_long(long.drop("file_name"), folder, by=("inst_type",))
    kept = forbid_missing_columns(spark.read.schema(long.drop("file_name").schema).parquet(folder), spark, path_raw, **options)
    if save:
        write_wide_by_type(kept, out_dir, doc_filter, BALANCE_IDS, on_duplicate=on_duplicate)
    return {
        inst_type: wide_balances(rows, on_duplicate=on_duplicate)
        for inst_type, rows in split_by_type(kept).items()
    }


def _scratch(spark: SparkSession) -> str:
    """A new folder under the session's shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/long-{uuid.uuid4().hex}"


def get_balance_sheets(
    spark: SparkSession,
    path: str,
    institution,
    months=12,
    first_year: int = 1993,
    final_year: int | None = None,
) -> DataFrame:
    """Landing report: one row per expected file with success and a note.

    Fetching is left to a downloader; this plans the periods, looks into the archives
    that landed and tells what is there, what is missing and what is damaged.
    """
    grid = balance_grid(spark, institution, months, first_year, final_year)
    files = list_files(spark, path, BALANCE_GLOB).select("file_name")
    members = _archives(spark, path, contents=False)[0]
    landed = files.unionByName(
        members.where("error IS NULL").select(F.substring_index("member", "/", -1).alias("file_name"))
    )
    # a damaged archive stands for the file of its own name
    damaged = _damaged(members).withColumn(
        "file_name", F.concat(F.regexp_extract("file_name", r"(?i)^(.*?)(\.csv)?\.zip$", 1), F.lit(".CSV"))
    ).groupBy("file_name").agg(F.min("reason").alias("reason"))
    return landing_report(grid, landed.unionByName(damaged.select("file_name")), damaged)
