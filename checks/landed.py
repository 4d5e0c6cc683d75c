"""Queries over files: tables are landed as real files and go through the public functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.base import ORACLES, as_double, lines_with_head, money_text, month_text, query, table
from checks.filings import ACCOUNTS, DOCUMENT_OF_LINE, INSTITUTION_SQL, TYPE_OF_STATUS, _pick, filing_lines, institution_list_lines
from checks.tables import registry_lines, value_lines
from finfilings.functions.names import file_period, file_type, plain_file_name, safe_name
from finfilings.operators.pages import land_pages, landed_page, page_coverage, page_spans
from finfilings.operators.sinks import balance_folder, land
from finfilings.plans.balances import import_all_columns, import_balance_sheets, read_balance_sheets, tidy_balance_sheets
from finfilings.plans.indicators import (
    get_ifdata_registry,
    get_ifdata_values,
    land_registry,
    land_values,
    read_ifdata_registry,
    read_ifdata_values,
)
from finfilings.plans.institutions import tidy_institutions
from finfilings.session import checkpoint_dir
from finfilings.sources.landing import balance_files
from finfilings.vocab import VALUE_COLUMNS


def _folder(spark: SparkSession, what: str) -> str:
    """A new folder under the shared checkpoint folder, removed when the session ends."""
    name = f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return name


def landed(lines: DataFrame) -> str:
    """Lines ``file_name, pos, line`` as one UTF-8 text file per name; returns the folder.

    One task streams each file out; the driver only gives the files (one per month and
    type) their names.
    """
    spark = lines.sparkSession
    parts, folder = _folder(spark, "printed"), _folder(spark, "landed")
    ordered = lines.repartition("file_name").sortWithinPartitions("file_name", "pos")
    ordered.select("line", "file_name").write.partitionBy("file_name").text(parts)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    for found in files.globStatus(path(f"{parts}/file_name=*/part-*")):
        name = found.getPath().getParent().getName().split("=", 1)[1]
        if not files.rename(found.getPath(), path(f"{folder}/{name}")):
            raise OSError(f"{name} was not landed")
    return folder


def _summed(long: DataFrame) -> DataFrame:
    keys = [F.col("inst_type"), F.col("data"), F.date_format("ref_month", "yyyy-MM-dd").alias("ref_month"),
            F.col("documento").cast("bigint").alias("documento"), F.col("cnpj"), F.col("conta")]
    return long.groupBy(*keys).agg(F.count("*").alias("n_rows"), as_double(F.sum("saldo")).alias("saldo"))


def landed_bytes(files: DataFrame) -> str:
    """Rows ``file_name, content`` as files of these bytes (and a line feed); returns the folder."""
    return landed(files.select("file_name", F.lit(0).alias("pos"), F.col("content").cast("string").alias("line")))


@query(ORACLES["long_filing"])
def landed_balances(spark, sf_dir):
    """lineitem landed as one balance sheet per month and type, imported file by file."""
    return _summed(import_balance_sheets(spark, landed(filing_lines(spark, sf_dir))))


@query(ORACLES["long_filing"])
def landed_balances_by_line(spark, sf_dir):
    """The same files, all of them read line by line."""
    return _summed(import_balance_sheets(spark, landed(filing_lines(spark, sf_dir)), whole_file_bytes=0))


@query(
    """
    SELECT DISTINCT strftime(l_shipdate, '%Y%m') || '_' || CASE l_linestatus WHEN 'F' THEN 'BANCOS' ELSE 'COOPERATIVAS' END || '.CSV' AS file_name
    FROM lineitem
    """
)
def landed_files(spark, sf_dir):
    """The balance files that are found in the folder."""
    return balance_files(spark, landed(filing_lines(spark, sf_dir))).select("file_name")


@query(
    """
    SELECT CASE l_linestatus WHEN 'F' THEN 'BANCOS' ELSE 'COOPERATIVAS' END AS inst_type,
           CASE l_linenumber WHEN 1 THEN 4010 ELSE 4016 END AS documento,
           strftime(l_shipdate, '%Y%m') AS data, lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS cnpj,
           round(CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE), 2) AS conta_10000007,
           round(CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE), 2) AS conta_20000004,
           round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE), 2) AS conta_30000001
    FROM lineitem WHERE l_linenumber IN (1, 6) GROUP BY 1, 2, 3, 4
    """
)
def landed_tidy_documents(spark, sf_dir):
    """Two documents of the same files tidied into one folder, one after the other; the
    written CSV folders are read back."""
    raw, out, found = landed(filing_lines(spark, sf_dir)), _folder(spark, "tidy"), []
    for document in (4010, 4016):
        for inst_type in tidy_balance_sheets(spark, raw, out, document, on_duplicate="sum"):
            wide = spark.read.option("header", True).csv(balance_folder(out, document, inst_type))
            accounts = [F.col(c).cast("decimal(28,2)").alias(f"conta_{c}") for c in wide.columns if c.isdigit()]
            found.append(wide.select(
                F.lit(inst_type).alias("inst_type"), F.col("documento").cast("int").alias("documento"), "data", "cnpj", *accounts))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows.select(*[as_double(F.col(c)).alias(c) if c.startswith("conta_") else c for c in rows.columns])


@query(INSTITUTION_SQL)
def landed_institutions(spark, sf_dir):
    """Lists landed per segment, tidied and written; the written folders are read back."""
    out, rows = _folder(spark, "lists"), None
    for name in tidy_institutions(spark, landed(institution_list_lines(spark, sf_dir)), out):
        safe = spark.range(1).select(safe_name(F.lit(name))).first()[0]
        own = spark.read.option("header", True).csv(f"{out}/safe_name={safe}")
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    return rows.select("data", "institution", "nome_instituicao", F.col("cnpj_num").cast("double").alias("cnpj_num"), "cnpj", "uf")


@query(ORACLES["ifdata_values"].replace("IN (1, 2, 3, 4)", "IN (1, 3) AND l_returnflag = 'A' AND year(l_shipdate) BETWEEN 1995 AND 2001 AND month(l_shipdate) IN (3, 6, 9, 12)"))
def landed_values(spark, sf_dir):
    """Landed payloads read by period and type, stored by partition, and one report of them
    read from there."""
    years, months = range(1995, 2002), (3, 6, 9, 12)
    values = get_ifdata_values(spark, landed(value_lines(spark, sf_dir)), years, months, (1, 2, 3))
    stored = land_values(values, _folder(spark, "values"))
    found = get_ifdata_values(spark, stored, years, months, (1, 3), "A")
    return found.select(*[
        as_double(F.col(c)).alias(c) if c == "saldo" else F.col(c).cast("string").alias(c) if c == "ano_mes" else F.col(c) for c in values.columns
    ])


@query(ORACLES["ifdata_registry"])
def landed_registry(spark, sf_dir):
    """The registry out of a landed payload."""
    return get_ifdata_registry(spark, landed(registry_lines(spark, sf_dir)), 2023, 12)


@query(
    """
    SELECT nullif(l_returnflag, 'N') AS flag, CAST(count(*) AS BIGINT) AS n_rows,
           round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS price
    FROM lineitem GROUP BY 1
    """
)
def landed_once(spark, sf_dir):
    """A table landed twice by a key that is null for some rows: what is there is kept."""
    items = table(spark, sf_dir, "lineitem").select(
        F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    out = _folder(spark, "once")
    for _ in range(2):
        land(items, out, ["flag"])
    return spark.read.parquet(out).groupBy("flag").agg(F.count("*").alias("n_rows"), as_double(F.sum("price")).alias("price"))


def _broken_names(spark, sf_dir) -> DataFrame:
    """lineitem as balance sheets with names over two lines, and names that open a quote for good."""
    items = table(spark, sf_dir, "lineitem")
    month, key = month_text(F.col("l_shipdate")), F.col("l_suppkey").cast("string")
    name = F.when(F.col("l_linenumber").isin(2, 4), F.concat(F.lit('"INSTITUIÇÃO; \nNº ""'), key, F.lit('"""'))).when(
        F.col("l_linenumber") == 7, F.concat(F.lit('"ABERTA '), key)).otherwise(key)
    line = F.concat_ws(";", month, _pick("l_linenumber", DOCUMENT_OF_LINE), key, name, _pick("l_returnflag", ACCOUNTS), money_text(F.col("l_extendedprice")))
    body = items.select(
        F.concat(month, F.lit("_"), _pick("l_linestatus", TYPE_OF_STATUS), F.lit(".CSV")).alias("file_name"), F.col("l_orderkey").alias("pos"), line.alias("line"))
    return lines_with_head(body, lambda: [F.lit('banner with a "'), F.lit("#DATA_BASE;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;SALDO")])


BREAKS_SQL = """
    SELECT inst_type, data, what, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (l_linenumber IN (2, 4)) AS BIGINT) AS n_breaks,
           round(CAST(sum(CASE WHEN what = 'row' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE), 2) AS saldo
    FROM (SELECT *, CASE l_linestatus WHEN 'F' THEN 'BANCOS' ELSE 'COOPERATIVAS' END AS inst_type, strftime(l_shipdate, '%Y%m') AS data,
                 CASE l_linenumber WHEN 7 THEN 'reject' ELSE 'row' END AS what FROM lineitem)
    GROUP BY 1, 2, 3
"""


def _rows_and_rejects(spark, folder: str, **options) -> DataFrame:
    rows, rejects = read_balance_sheets(spark, folder, **options)
    rows = rows.groupBy("inst_type", "data", F.lit("row").alias("what")).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("nome_instituicao").contains("\n")).alias("n_breaks"), as_double(F.sum("saldo")).alias("saldo"))
    name = plain_file_name(F.col("file_name"))
    rejects = rejects.groupBy(file_type(name).alias("inst_type"), file_period(name).alias("data"), F.lit("reject").alias("what")).agg(
        F.count_if(F.col("record").contains("ABERTA")).alias("n_rows"), F.lit(0).cast("bigint").alias("n_breaks"), F.lit(None).cast("double").alias("saldo"))
    return rows.unionByName(rejects)


@query(BREAKS_SQL)
def landed_breaks(spark, sf_dir):
    """Quoted names over two lines are one record; a quote that is never closed is a reject."""
    return _rows_and_rejects(spark, landed(_broken_names(spark, sf_dir)))


@query(BREAKS_SQL)
def landed_breaks_by_line(spark, sf_dir):
    """The same files read line by line, records put together over lines and splits."""
    return _rows_and_rejects(spark, landed(_broken_names(spark, sf_dir)), whole_file_bytes=0)


def _in_many_forms(lines: DataFrame) -> DataFrame:
    """Files ``file_name, content``: of banks the file beside a damaged archive of it, of the
    others the same member in two archives."""
    def run(batches):
        import io
        import zipfile

        import pandas as pd

        def forms(name, rows):
            text, data = "\n".join(rows).encode("latin-1"), io.BytesIO()
            with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as bundle:
                bundle.writestr(name, text)
            whole = data.getvalue()
            if "COOPERATIVAS" in name:
                return [(f"one_{name}.ZIP", whole), (f"two_{name}.ZIP", whole)]
            middle = 30 + len(name) + (len(whole) - 130 - 2 * len(name)) // 2
            return [(name, text), (f"{name}.ZIP", whole[:middle] + bytes([whole[middle] ^ 0x55]) + whole[middle + 1:])]

        now, held = None, []
        for batch in batches:
            for name, line in zip(batch["file_name"], batch["line"]):
                if name != now:
                    if held:
                        yield pd.DataFrame(forms(now, held), columns=["file_name", "content"])
                    now, held = name, []
                held.append(line)
        if held:
            yield pd.DataFrame(forms(now, held), columns=["file_name", "content"])

    ordered = lines.repartition("file_name").sortWithinPartitions("file_name", "pos")
    return ordered.select("file_name", "line").mapInPandas(run, "file_name string, content binary")


@query(ORACLES["long_filing"])
def landed_forms(spark, sf_dir):
    """Periods that landed in several forms: a damaged archive gives way to the file beside
    it, and a member in two archives counts once."""
    return _summed(import_balance_sheets(spark, landed_bytes(_in_many_forms(filing_lines(spark, sf_dir)))))


@query(ORACLES["long_filing"])
def landed_forms_by_line(spark, sf_dir):
    """The same files and members line by line."""
    return _summed(import_balance_sheets(spark, landed_bytes(_in_many_forms(filing_lines(spark, sf_dir))), whole_file_bytes=0))


def _odd_values(spark, sf_dir) -> DataFrame:
    """Value payloads: those of even months name their columns backwards, one type's records
    lack the last cell, and a refused request stands beside them."""
    items = table(spark, sf_dir, "lineitem")
    cells = [
        F.col("l_linenumber").cast("string"), F.col("l_suppkey").cast("string"), month_text(F.col("l_shipdate")), F.lit("Report"), F.col("l_returnflag"), F.lit(""),
        F.col("l_partkey").cast("string"), F.lit("Ativo"), F.lit('"soma, \ntotal"'), F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
    ]
    even = F.month("l_shipdate") % 2 == 0
    line = F.when(even, F.concat_ws(",", *cells[::-1])).otherwise(F.concat_ws(",", *cells))
    line = F.when(F.col("l_linenumber") == 3, F.regexp_replace(line, ",[^,]*$", "")).otherwise(line)
    body = items.select(F.concat(F.lit("values_"), month_text(F.col("l_shipdate")), F.lit(".csv")).alias("file_name"), F.col("l_orderkey").alias("pos"), line.alias("line"), even.alias("even"))
    head = F.when(F.col("even"), ",".join(VALUE_COLUMNS[::-1])).otherwise(",".join(VALUE_COLUMNS))
    refused = items.limit(1).select(F.lit("refused.csv").alias("file_name"), F.lit(0).cast("bigint").alias("pos"), F.lit("<html>not found</html>").alias("line"))
    return lines_with_head(body, lambda: [head], "even").unionByName(refused)


@query(
    """
    SELECT what, period, CAST(count(*) AS BIGINT) AS n_rows, round(CAST(sum(CASE WHEN what = 'row' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE), 2) AS saldo
    FROM (SELECT *, strftime(l_shipdate, '%Y%m') AS period, CASE l_linenumber WHEN 3 THEN 'reject' ELSE 'row' END AS what FROM lineitem
          WHERE year(l_shipdate) IN (1995, 1996) AND l_linenumber IN (1, 2, 3)) GROUP BY 1, 2
    UNION ALL SELECT 'no header line', NULL, 1, NULL
    """
)
def landed_value_rejects(spark, sf_dir):
    """Payloads with columns in either order are read by name, over line breaks; records that
    lack a cell and refused requests are rejects; other years' payloads are not opened."""
    rows, rejects = read_ifdata_values(spark, landed(_odd_values(spark, sf_dir)), [1995, 1996], range(1, 13), (1, 2, 3))
    rows = rows.groupBy(F.lit("row").alias("what"), F.col("ano_mes").alias("period")).agg(F.count("*").alias("n_rows"), as_double(F.sum("saldo")).alias("saldo"))
    what = F.when(F.col("record").isNull(), F.col("reason")).otherwise(F.when(F.col("reason") == "9 cells for 10 columns", "reject").otherwise(F.col("reason")))
    period = F.nullif(F.regexp_extract("file_name", r"values_(\d{6})", 1), F.lit(""))
    rejects = rejects.groupBy(what.alias("what"), period.alias("period")).agg(F.count("*").alias("n_rows"), F.lit(None).cast("double").alias("saldo"))
    return rows.unionByName(rejects)


@query(ORACLES["ifdata_registry"])
def landed_registry_table(spark, sf_dir):
    """The registry landed twice as a table by period and read from there."""
    rows, _ = read_ifdata_registry(spark, landed(registry_lines(spark, sf_dir)), 2023, 12)
    out = _folder(spark, "registry")
    for _ in range(2):
        land_registry(rows, out)
    return get_ifdata_registry(spark, out, [2022, 2023], 12)


@query(
    """
    SELECT inst_type, extra, regiao, CAST(count(*) AS BIGINT) AS n_rows, round(CAST(sum(v) AS DOUBLE), 4) AS saldo, 0 AS n_dropped
    FROM (SELECT CASE l_linestatus WHEN 'F' THEN 'BANCOS' ELSE 'COOPERATIVAS' END AS inst_type, CASE l_linestatus WHEN 'F' THEN CAST(l_linenumber AS VARCHAR) END AS extra,
                 CASE l_linestatus WHEN 'O' THEN 'R' || CAST(l_linenumber AS VARCHAR) END AS regiao, CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS v FROM lineitem)
    GROUP BY 1, 2, 3
    """
)
def landed_all_columns(spark, sf_dir):
    """All columns that any file has, values with four places."""
    items = table(spark, sf_dir, "lineitem")
    month, kind = month_text(F.col("l_shipdate")), _pick("l_linestatus", TYPE_OF_STATUS)
    value = F.translate((F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")).cast("string"), ".", ",")
    bank = F.col("l_linestatus") == "F"
    cells = [month, F.lit("4010"), F.col("l_suppkey").cast("string"), F.lit("N"), _pick("l_returnflag", ACCOUNTS), value, F.lit("atr")]
    body = items.select(
        F.concat(month, F.lit("_"), kind, F.lit(".CSV")).alias("file_name"), F.col("l_orderkey").alias("pos"), bank.alias("bank"),
        F.concat_ws(";", *cells, F.concat(F.when(bank, "").otherwise("R"), F.col("l_linenumber").cast("string"))).alias("line"))
    head = F.concat(F.lit("#DATA_BASE;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;SALDO;ATRIBUTO;"), F.when(F.col("bank"), "Extra").otherwise("REGIAO"))
    rows = import_all_columns(spark, landed(lines_with_head(body, lambda: [head], "bank")))
    n_dropped = sum(c in rows.columns for c in ("atributo", "ATRIBUTO"))
    return rows.groupBy("inst_type", "extra", "regiao").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("saldo").cast("double"), 4).alias("saldo"), F.lit(n_dropped).alias("n_dropped"))


@query(
    """
    WITH t AS (SELECT o_orderpriority AS search, count(*) AS total FROM orders GROUP BY 1),
    p AS (SELECT search, total, unnest(range(0, (total + 99) // 100)) AS k FROM t)
    SELECT search, 'gap' AS kind, CAST(100 * k AS BIGINT) AS begin_row, CAST(least(100 * k + 100, total) AS BIGINT) AS end_row FROM p WHERE k % 7 = 3
    UNION ALL SELECT search, 'overlap', CAST(100 * k - 10 AS BIGINT), CAST(100 * k AS BIGINT) FROM p WHERE k % 7 = 5
    """
)
def page_gaps(spark, sf_dir):
    """Orders as the pages of one search for each priority, of which some are missing and some
    begin within the one before."""
    search = Window.partitionBy("o_orderpriority")
    place = F.row_number().over(search.orderBy("o_orderkey")) - 1
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("search"), F.col("o_orderkey").cast("string").alias("id"), place.alias("i"), F.count("*").over(search).alias("total"))
    page = F.floor(F.col("i") / 100)
    late = (F.col("i") % 100 >= 90) & ((page + 1) % 7 == 5) & ((page + 1) * 100 < F.col("total"))
    rows = rows.select("*", F.explode(F.when(late, F.array(page, page + 1)).otherwise(F.array(page))).alias("page")).where("page % 7 <> 3")
    hits = F.to_json(F.struct(F.first("total").alias("TotalRows"), F.collect_list(F.create_map(F.lit("id"), F.col("id"))).alias("Rows")))  # of one page
    found = rows.groupBy("search", "page").agg(F.min("i").alias("start_row"), hits.alias("payload"))
    return page_coverage(page_spans(found)).withColumnsRenamed({"begin": "begin_row", "end": "end_row"})


@query(
    """
    SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice
    FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) - 1 AS r FROM orders) WHERE r BETWEEN 500 AND 999 OR r BETWEEN 1200 AND 1249
    """
)
def landed_page_index(spark, sf_dir):
    """Two pages out of the orders landed latest first, by the index of their files."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    out = land_pages(orders, [F.col("o_orderdate").desc(), F.col("o_orderkey")], _folder(spark, "pages"))
    return landed_page(spark, out, 500, 500).unionByName(landed_page(spark, out, 1200, 50)).select("o_orderkey", "o_totalprice")
