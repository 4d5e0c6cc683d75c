"""Queries over printed balance sheets and institution lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import as_double, lines_with_head, money, money_text, month_text, payload_of, query, spread, table
from finfilings.functions.values import decode_bytes, parse_decimal
from finfilings.operators.reshape import pivot_wide
from finfilings.plans.balances import balances_from_lines, balances_from_payloads
from finfilings.plans.institutions import institutions_from_lines
from finfilings.session import settle
from finfilings.sources.archives import expand_archive_lines, expand_archives
from finfilings.sources.delimited import (
    BALANCES,
    Layout,
    find_headers,
    parse_lines,
    parse_lines_by_name,
    parse_payloads,
    parse_payloads_by_name,
    reject_lines,
    reject_payloads,
)
from finfilings.sources.workbooks import sheet_lines, usable_sheets

ACCOUNTS = {"A": "10000007", "N": "20000004", "R": "30000001"}
BANNERS = ("Balancetes; CONTA e SALDO por DOCUMENTO", "Posição mensal, em reais", "")


def _pick(column: str, values: dict):
    out = F.lit(None).cast("string")
    for key, value in values.items():
        out = F.when(F.col(column) == key, value).otherwise(out)
    return out


DOCUMENT_OF_LINE = {1: "4010", 2: "4413", 3: "4423", 4: "4433", 5: "4060", 6: "4016", 7: "4066"}
TYPE_OF_STATUS = {"F": "BANCOS", "O": "COOPERATIVAS"}


def filing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem printed as monthly balance sheets of two institution types."""
    items = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", "l_extendedprice")
    month = month_text(F.col("l_shipdate"))
    line = F.concat_ws(
        ";",
        month,
        _pick("l_linenumber", DOCUMENT_OF_LINE),
        F.col("l_suppkey").cast("string"),
        F.lit("0"),
        F.concat(F.lit('"INSTITUIÇÃO; Nº '), F.col("l_suppkey").cast("string"), F.lit('"')),
        _pick("l_returnflag", ACCOUNTS),
        F.lit("CONTA"),
        money_text(F.col("l_extendedprice")),
    )
    body = items.select(
        F.concat(month, F.lit("_"), _pick("l_linestatus", TYPE_OF_STATUS), F.lit(".CSV")).alias("file_name"),
        F.col("l_orderkey").alias("pos"),
        line.alias("line"),
    )
    header = "#DATA_BASE;DOCUMENTO;CNPJ;AGENCIA;NOME_INSTITUICAO;CONTA;NOME_CONTA;SALDO"
    return lines_with_head(body, lambda: [F.lit(b) for b in (*BANNERS, header)])


@query(
    """
    SELECT CASE l_linestatus WHEN 'F' THEN 'BANCOS' ELSE 'COOPERATIVAS' END AS inst_type,
           strftime(l_shipdate, '%Y%m') AS data, CAST(4010 AS BIGINT) AS documento,
           lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS cnpj,
           'INSTITUIÇÃO; Nº ' || CAST(l_suppkey AS VARCHAR) AS nome_instituicao,
           round(CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE), 2) AS conta_10000007,
           round(CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE), 2) AS conta_20000004,
           round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE), 2) AS conta_30000001
    FROM lineitem WHERE l_linenumber = 1 GROUP BY 1, 2, 3, 4, 5
    """
)
def tidy_wide_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Print, find headers, read, keep one document, pivot accounts to columns."""
    long = balances_from_lines(filing_lines(spark, sf_dir), 4010)
    ids = ["inst_type", "data", "documento", "cnpj", "nome_instituicao"]
    accounts = list(ACCOUNTS.values())
    names = [f"conta_{a}" for a in accounts]
    wide = pivot_wide(long, ids, "conta", "saldo", accounts, "sum", names)
    return wide.select(
        "inst_type", "data", F.col("documento").cast("bigint").alias("documento"), "cnpj", "nome_instituicao",
        *[as_double(F.col(n)).alias(n) for n in names],
    )


@query(
    """
    SELECT CASE l_linestatus WHEN 'F' THEN 'BANCOS' ELSE 'COOPERATIVAS' END AS inst_type,
           strftime(l_shipdate, '%Y%m') AS data, strftime(l_shipdate, '%Y-%m-01') AS ref_month,
           CAST(CASE l_linenumber WHEN 1 THEN 4010 WHEN 2 THEN 4413 WHEN 3 THEN 4423 WHEN 4 THEN 4433
                WHEN 5 THEN 4060 WHEN 6 THEN 4016 ELSE 4066 END AS BIGINT) AS documento,
           lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS cnpj,
           CASE l_returnflag WHEN 'A' THEN '10000007' WHEN 'N' THEN '20000004' ELSE '30000001' END AS conta,
           CAST(count(*) AS BIGINT) AS n_rows,
           round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS saldo
    FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6
    """
)
def long_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long table of all documents, summed per cell."""
    long = balances_from_lines(filing_lines(spark, sf_dir))
    keys = [F.col("inst_type"), F.col("data"), F.date_format("ref_month", "yyyy-MM-dd").alias("ref_month"),
            F.col("documento").cast("bigint").alias("documento"), F.col("cnpj"), F.col("conta")]
    return long.groupBy(*keys).agg(F.count("*").alias("n_rows"), as_double(F.sum("saldo")).alias("saldo"))


# --- orders printed with each separator -------------------------------------------

ORDERS = Layout(
    words=("O_ORDERKEY", "O_TOTALPRICE"),
    marks=(r"(?i)^O_ORDERKEY$", r"(?i)^O_TOTALPRICE$"),
    charset="UTF-8",
)
ORDER_COLUMNS = {
    "o_orderkey": "O_ORDERKEY",
    "o_orderstatus": "O_ORDERSTATUS",
    "o_totalprice": "O_TOTALPRICE",
    "o_orderpriority": "O_ORDERPRIORITY",
}
ORDERS_SQL = """
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus,
           round(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE), 2) AS o_totalprice, o_orderpriority
    FROM orders
"""


def _typed_orders(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
        "o_orderstatus",
        as_double(parse_decimal(F.col("o_totalprice"))).alias("o_totalprice"),
        "o_orderpriority",
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    line = F.concat_ws(
        ";", F.col("o_orderkey").cast("string"), "o_orderstatus", money_text(F.col("o_totalprice")),
        F.concat(F.lit('"'), "o_orderpriority", F.lit('"')),
    )
    body = orders.select(
        F.concat(month_text(F.col("o_orderdate")), F.lit("ORDERS.CSV")).alias("file_name"),
        F.col("o_orderkey").alias("pos"), line.alias("line"),
    )
    head = ["Orders; not O_ORDERKEY yet", "o_totalprice_sum; o_orderkey_count", "",
            'o_orderkey; "O_ORDERSTATUS" ; "o_totalprice";O_ORDERPRIORITY']
    return lines_with_head(body, lambda: [F.lit(h) for h in head])


@query(ORDERS_SQL)
def sniff_roundtrip_semicolon(spark, sf_dir):
    return _typed_orders(parse_lines(order_lines(spark, sf_dir), ORDERS, ORDER_COLUMNS))


def order_payloads(spark, sf_dir, sep: str, head: list[str]) -> DataFrame:
    """Each order as a file: banners, header, one row."""
    orders = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    cells = [
        F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), money(F.col("o_totalprice")).cast("string"),
        F.concat(F.lit('"'), "o_orderpriority", F.lit('"')),
    ]
    name = F.concat(F.col("o_orderkey").cast("string"), F.lit(".csv"))
    return payload_of(orders, name, [*[F.lit(h) for h in head], F.concat_ws(sep, *cells)], "UTF-8")


@query(ORDERS_SQL)
def sniff_roundtrip_comma(spark, sf_dir):
    head = ["banner, one", "o_orderkey and o_totalprice, in words", "", "O_ORDERKEY,O_ORDERSTATUS,O_TOTALPRICE,O_ORDERPRIORITY"]
    return _typed_orders(parse_payloads(order_payloads(spark, sf_dir, ",", head), ORDERS, ORDER_COLUMNS))


@query(ORDERS_SQL)
def sniff_roundtrip_blank(spark, sf_dir):
    head = ["banner one", "  O_ORDERKEY   O_ORDERSTATUS O_TOTALPRICE\tO_ORDERPRIORITY "]
    return _typed_orders(parse_payloads(order_payloads(spark, sf_dir, "  ", head), ORDERS, ORDER_COLUMNS))


@query(
    """
    SELECT strftime(o_orderdate, '%Y%m') || 'ORDERS.CSV' AS file_name, CAST(3 AS BIGINT) AS header_pos,
           'O_ORDERKEY|O_ORDERSTATUS|O_TOTALPRICE|O_ORDERPRIORITY' AS names, ';' AS sep
    FROM orders GROUP BY 1
    """
)
def header_lines(spark, sf_dir):
    """Place, separator and names of each file's header."""
    found = find_headers(order_lines(spark, sf_dir), ORDERS)
    return found.select("file_name", "header_pos", F.array_join("names", "|").alias("names"), "sep")


LATIN = Layout(words=("CONV_ID", "TEXT"), marks=("(?i)^CONV_ID$", "(?i)^TEXT$"), sep=";", charset="ISO-8859-1")


@query(
    r"""
    SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role,
           nullif(nullif(trim(regexp_replace(replace(text, chr(10), ' '), '[^\x00-\xff]', '?', 'g')), ''), 'NA') AS text
    FROM conversations
    """
)
def sniff_latin1_text(spark, sf_dir):
    """Every turn as a Latin-1 file; signs outside Latin-1 are printed as ``?``."""
    turns = table(spark, sf_dir, "conversations")
    safe = F.regexp_replace(F.translate("text", "\n", " "), r"[^\x00-\xff]", "?")
    quoted = F.concat(F.lit('"'), F.replace(safe, F.lit('"'), F.lit('""')), F.lit('"'))
    name = F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    row = F.concat_ws(";", F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", quoted)
    files = payload_of(turns, name, [F.lit("Relação"), F.lit("CONV_ID;TURN;ROLE;TEXT"), row], "ISO-8859-1")
    columns = {"conv_id": "CONV_ID", "turn": "TURN", "role": "ROLE", "text": "TEXT"}
    rows = parse_payloads(files, LATIN, columns)
    return rows.select(
        F.col("conv_id").try_cast("bigint").alias("conv_id"), F.col("turn").try_cast("bigint").alias("turn"), "role", "text"
    )


@query(
    r"""
    SELECT CAST(doc_id AS BIGINT) AS doc_id, regexp_replace(text, '[^\x00-\xff]', '?', 'g') AS text FROM documents
    """
)
def charset_decode(spark, sf_dir):
    """Whole texts through Latin-1 bytes and back."""
    docs = table(spark, sf_dir, "documents")
    content = F.encode(F.regexp_replace("text", r"[^\x00-\xff]", "?"), "ISO-8859-1")
    return docs.select("doc_id", decode_bytes(content).alias("text"))


# --- rejects ---------------------------------------------------------------------------

_STATUS_HEADERS = {"F": "DATA BASE;DOCUMENTO;CNPJ;CONTA;SALDO", "O": "DATA BASE;DOCUMENTO;CONTA;SALDO"}


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) || '.CSV' AS file_name,
           CASE o_orderstatus WHEN 'O' THEN 'missing columns: CNPJ' ELSE 'no header line' END AS reason
    FROM orders WHERE o_orderstatus <> 'F'
    """
)
def sniff_rejects(spark, sf_dir):
    """Each order as a file; pending ones lack the header, open ones a column."""
    orders = table(spark, sf_dir, "orders")
    head = F.coalesce(_pick("o_orderstatus", _STATUS_HEADERS), F.lit("DOCUMENTO e CONTA, sem SALDO"))
    name = F.concat(F.col("o_orderkey").cast("string"), F.lit(".CSV"))
    files = payload_of(orders, name, [F.lit("Posição"), head, F.lit("199801;4010;1;10000007;1,00")])
    return reject_payloads(files, BALANCES, ("DATA", "CNPJ"))


@query(
    """
    SELECT strftime(o_orderdate, '%Y%m') || '_' || o_orderstatus || '.CSV' AS file_name,
           CASE o_orderstatus WHEN 'O' THEN 'missing columns: CNPJ' ELSE 'no header line' END AS reason
    FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2
    """
)
def sniff_rejects_lines(spark, sf_dir):
    """The same over files of one month and status."""
    orders = table(spark, sf_dir, "orders")
    body = orders.select(
        F.concat(month_text(F.col("o_orderdate")), F.lit("_"), "o_orderstatus", F.lit(".CSV")).alias("file_name"),
        F.col("o_orderkey").alias("pos"), F.lit("199801;4010;1;10000007;1,00").alias("line"), "o_orderstatus",
    )
    head = F.coalesce(_pick("o_orderstatus", _STATUS_HEADERS), F.lit("DOCUMENTO e CONTA, sem SALDO"))
    lines = lines_with_head(body, lambda: [F.lit("Posição"), head], "o_orderstatus")
    return reject_lines(lines, BALANCES, required=("DATA", "CNPJ"))


# --- institution lists ----------------------------------------------------------------------

INSTITUTION_SQL = """
    SELECT '202312' AS data, c_mktsegment AS institution, c_name AS nome_instituicao,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_custkey AS DOUBLE) END AS cnpj_num,
           CASE WHEN c_acctbal < 0 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '0') || '000190'
                ELSE lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS cnpj,
           CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS uf
    FROM customer
"""


def _institution_cells():
    key = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    dotted = F.concat(F.substring(key, 1, 2), F.lit("."), F.substring(key, 3, 3), F.lit("."), F.substring(key, 6, 3))
    cnpj = F.when(F.col("c_acctbal") < 0, F.concat(dotted, F.lit("/0001-90"))).otherwise(dotted)
    return cnpj, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))


def _institution_result(rows: DataFrame) -> DataFrame:
    return rows.select("data", "institution", "nome_instituicao", "cnpj_num", "cnpj", "uf")


def institution_list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers printed as one list per segment, with title, footnote and dotted numbers.
    One segment's list lacks a column."""
    customers = table(spark, sf_dir, "customer")
    cnpj, uf = _institution_cells()
    short = F.col("c_mktsegment") == "BUILDING"
    name = F.concat(F.lit('"'), "c_name", F.lit('"'))
    line = F.when(short, F.concat_ws(",", cnpj, name)).otherwise(F.concat_ws(",", cnpj, name, uf))
    body = customers.select(
        F.concat(F.lit("202312"), "c_mktsegment", F.lit(".csv")).alias("file_name"),
        F.col("c_custkey").alias("pos"), line.alias("line"), "c_mktsegment",
    )
    header = F.when(short, "CNPJ,NOME INSTITUIÇÃO").otherwise("CNPJ,NOME INSTITUIÇÃO,UF")
    return lines_with_head(body, lambda: [F.lit("RELAÇÃO DE INSTITUIÇÕES"), header, F.lit("FONTE: Unicad,,"), F.lit(",SEM NUMERO,")], "c_mktsegment")


@query(INSTITUTION_SQL)
def institution_csv(spark, sf_dir):
    """Lists read without their files."""
    return _institution_result(institutions_from_lines(institution_list_lines(spark, sf_dir)))


def _workbooks(rows: DataFrame) -> DataFrame:
    """Each row (``file_name, cells``) as an .xlsx workbook of its own: title, header, row, footnote."""

    def write(batches):
        import io
        import zipfile
        from xml.sax.saxutils import escape

        import pandas as pd

        for batch in batches:
            out = []
            for name, header, cells in zip(batch["file_name"], batch["header"], batch["cells"]):
                rows = [["RELAÇÃO"], list(header), list(cells), ["FONTE: Unicad"]]
                xml = []
                for r, values in enumerate(rows, 1):
                    inner = "".join(
                        f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{escape(v)}</t></is></c>' for c, v in enumerate(values)
                    )
                    xml.append(f'<row r="{r}">{inner}</row>')
                data = io.BytesIO()
                with zipfile.ZipFile(data, "w") as book:
                    book.writestr(
                        "xl/workbook.xml",
                        '<workbook xmlns:r="urn:r"><sheets><sheet name="L" sheetId="1" r:id="rId1"/></sheets></workbook>',
                    )
                    book.writestr(
                        "xl/_rels/workbook.xml.rels",
                        '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
                    )
                    book.writestr("xl/worksheets/sheet1.xml", f"<worksheet><sheetData>{''.join(xml)}</sheetData></worksheet>")
                out.append((name, data.getvalue()))
            yield pd.DataFrame(out, columns=["file_name", "content"])

    return rows.mapInPandas(write, "file_name string, content binary")


@query(INSTITUTION_SQL)
def institution_xlsx(spark, sf_dir):
    """Every customer as a workbook; the segment without the column stays without it."""
    customers = spread(table(spark, sf_dir, "customer"), "c_custkey", "c_name")
    cnpj, uf = _institution_cells()
    short = F.col("c_mktsegment") == "BUILDING"
    books = customers.select(
        F.concat(F.col("c_custkey").cast("string"), F.lit("/202312"), "c_mktsegment", F.lit(".xlsx")).alias("file_name"),
        F.when(short, F.array(F.lit("CNPJ"), F.lit("NOME INSTITUIÇÃO")))
        .otherwise(F.array(F.lit("CNPJ"), F.lit("NOME INSTITUIÇÃO"), F.lit("UF"))).alias("header"),
        F.when(short, F.array(cnpj, "c_name")).otherwise(F.array(cnpj, "c_name", uf)).alias("cells"),
    )
    # settled: the header search and the reader both need the unpacked sheets
    sheets = settle(usable_sheets(sheet_lines(_workbooks(books))))
    return _institution_result(institutions_from_lines(sheets))


# --- generations -------------------------------------------------------------------------------

GENERATIONS_SQL = """
    SELECT strftime(o_orderdate, '%Y%m') AS data, CAST(4010 AS BIGINT) AS documento,
           lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cnpj,
           CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL ELSE 'CUSTOMER ' || CAST(o_custkey AS VARCHAR) END AS nome_instituicao,
           CAST(o_orderkey AS VARCHAR) AS conta,
           round(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE), 2) AS saldo
    FROM orders
"""


@query(GENERATIONS_SQL)
def ragged_union(spark, sf_dir):
    """Files of two generations: other names, other separator, a column less."""
    orders = table(spark, sf_dir, "orders")
    month = month_text(F.col("o_orderdate"))
    old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    line_old = F.concat_ws(",", month, F.lit("4010"), cust, F.lit("X"), key, money(F.col("o_totalprice")).cast("string"))
    line_new = F.concat_ws(";", month, F.lit("4010"), cust, F.concat(F.lit("CUSTOMER "), cust), key, F.lit("N"), money_text(F.col("o_totalprice")))
    body = orders.select(
        F.concat(month, F.lit("BANCOS.CSV")).alias("file_name"), F.col("o_orderkey").alias("pos"),
        F.when(old, line_old).otherwise(line_new).alias("line"), old.alias("old"),
    )
    head = F.when(F.col("old"), "DATA BASE,DOCUMENTOS,CNPJ,ATRIBUTO,CONTA,SALDO").otherwise(
        "#data_base;documento;cnpj;Nome_Instituicao;conta;nome_conta;saldo"
    )
    long = balances_from_lines(lines_with_head(body, lambda: [F.lit("Balancetes"), head], "old"))
    return long.select(
        "data", F.col("documento").cast("bigint").alias("documento"), "cnpj", "nome_instituicao", "conta",
        as_double(F.col("saldo")).alias("saldo"),
    )


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS part_key, p_brand AS brand,
           CASE WHEN p_size < 25 THEN p_type END AS part_type,
           CASE WHEN p_size < 25 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS number_size
    FROM part
    """
)
def union_by_header(spark, sf_dir):
    """Every part as a file of one of two layouts; all columns of both are united."""
    parts = table(spark, sf_dir, "part")
    small = F.col("p_size") < 25
    key = F.col("p_partkey").cast("string")
    head = F.when(small, "PartKey;Brand;Part_Type").otherwise("Brand;PartKey;#Size")
    row = F.when(small, F.concat_ws(";", key, "p_brand", "p_type")).otherwise(F.concat_ws(";", "p_brand", key, F.col("p_size").cast("string")))
    layout = Layout(words=("PARTKEY",), sep=";")
    rows = parse_payloads_by_name(payload_of(parts, F.concat(key, F.lit(".csv")), [F.lit("Parts"), head, row], "UTF-8"), layout)
    return rows.select(F.col("partkey").alias("part_key"), "brand", "part_type", "number_size")


@query(
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'BANCOS' WHEN 'O' THEN 'COOPERATIVAS' ELSE 'CONSORCIO' END AS institution,
           strftime(o_orderdate, '%Y%m') AS data, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS BIGINT) AS n_priority
    FROM orders GROUP BY 1, 2
    """
)
def combine_by_type(spark, sf_dir):
    """Ragged lists of three institutions, tagged from their file names, counted."""
    orders = table(spark, sf_dir, "orders")
    kind = _pick("o_orderstatus", {"F": "BANCOS", "O": "cooperativas", "P": "Consorcio"})
    key = F.col("o_orderkey").cast("string")
    rich = F.col("o_orderstatus") == "F"
    body = orders.select(
        F.concat(month_text(F.col("o_orderdate")), kind, F.lit(".csv")).alias("file_name"), F.col("o_orderkey").alias("pos"),
        F.when(rich, F.concat_ws(",", key, "o_orderpriority")).otherwise(key).alias("line"), "o_orderstatus",
    )
    head = F.when(rich, "CNPJ,Priority").otherwise("CNPJ")
    rows = institutions_from_lines(lines_with_head(body, lambda: [F.lit("Lista"), head], "o_orderstatus"))
    return rows.groupBy("institution", "data").agg(
        F.count("*").alias("n_rows"), F.count("priority").alias("n_priority")
    )


# --- archives ------------------------------------------------------------------------------------


def _zipped(rows: DataFrame) -> DataFrame:
    """Each row (``file_name, text, lang, damaged``) as a ZIP of two members."""

    def write(batches):
        import io
        import zipfile

        import pyarrow as pa

        for batch in batches:
            for begin in range(0, batch.num_rows, 256):  # of a batch, a few archives at a time
                out = []
                for row in batch.slice(begin, 256).to_pylist():
                    data = io.BytesIO()
                    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as bundle:
                        bundle.writestr("text.txt", row["text"].encode())
                        bundle.writestr("meta/lang.txt", row["lang"].encode())
                    content = data.getvalue()
                    out.append((row["file_name"], content[: len(content) // 2] if row["damaged"] else content))
                names, contents = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], names=["file_name", "content"])

    return rows.mapInArrow(write, "file_name string, content binary")


def _document_archives(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    return _zipped(
        docs.select(
            F.concat(F.col("doc_id").cast("string"), F.lit(".zip")).alias("file_name"), "text", "lang",
            (F.col("lang") == "de").alias("damaged"),
        )
    )


@query(
    """
    SELECT CAST(doc_id AS VARCHAR) || '.zip' AS archive, 'text.txt' AS member, text, false AS failed FROM documents WHERE lang <> 'de'
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR) || '.zip', 'meta/lang.txt', lang, false FROM documents WHERE lang <> 'de'
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR) || '.zip', NULL, NULL, true FROM documents WHERE lang = 'de'
    """
)
def zip_roundtrip(spark, sf_dir):
    """Every document zipped and expanded; those in one language are damaged archives."""
    members = expand_archives(_document_archives(spark, sf_dir))
    return members.select(
        "archive", "member", decode_bytes(F.col("content"), "UTF-8").alias("text"), F.col("error").isNotNull().alias("failed")
    )


@query(
    """
    WITH l AS (
      -- a line break at the very end begins no further line
      SELECT doc_id, unnest(string_split(regexp_replace(text, '\n$', ''), chr(10))) AS line FROM documents WHERE lang <> 'de' AND text <> ''
    )
    SELECT CAST(doc_id AS VARCHAR) || '.zip' AS archive, CAST(count(*) AS BIGINT) AS n_lines,
           CAST(sum(length(line)) AS BIGINT) AS n_chars
    FROM l GROUP BY 1
    """
)
def zip_lines(spark, sf_dir):
    """Lines of zipped members without inflating a member whole."""
    lines = expand_archive_lines(_document_archives(spark, sf_dir))
    text = decode_bytes(F.col("raw"), "UTF-8")
    rows = lines.where("file_name = 'text.txt'").select("archive", text.alias("line"))
    return rows.groupBy("archive").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).cast("bigint").alias("n_chars"))
