"""Queries over grids, audits, reshaping, names, values, text, acts and indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import as_double, lines_with_head, money, month_text, query, spread, table
from finfilings.functions import names, periods, text, values
from finfilings.operators import acts, audit, grids, reshape
from finfilings.plans.institutions import drop_footnotes
from finfilings.plans.normative import acts_table, get_normative_txt
from finfilings.sources import indicators, pages
from finfilings.sources.landing import name_collisions
from finfilings.vocab import BALANCE_TYPES, INSTITUTION_TYPES, REGISTRY_COLUMNS, VALUE_COLUMNS

TOKEN_SQL = "CASE o_orderstatus WHEN 'F' THEN 'BANCOS' WHEN 'O' THEN 'COOPERATIVAS' ELSE 'CONSORCIOS' END"


def token(column: str = "o_orderstatus"):
    return F.when(F.col(column) == "F", "BANCOS").when(F.col(column) == "O", "COOPERATIVAS").otherwise("CONSORCIOS")


# --- file names ---------------------------------------------------------------------


def _order_files(spark, sf_dir) -> DataFrame:
    """A landed file per order: month and token, some with underscore, some without a
    conforming name."""
    orders = table(spark, sf_dir, "orders")
    month = month_text(F.col("o_orderdate"))
    name = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(month, F.lit("_"), token(), F.lit(".CSV")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("readme_"), F.col("o_orderkey").cast("string"), F.lit(".csv")))
        .otherwise(F.concat(month, F.lower(token()), F.lit(".csv")))
    )
    return orders.select("o_orderkey", name.alias("file_name"))


ORDER_FILES_SQL = f"""
    SELECT o_orderkey, CASE o_orderpriority
             WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y%m') || '_' || {TOKEN_SQL} || '.CSV'
             WHEN '5-LOW' THEN 'readme_' || CAST(o_orderkey AS VARCHAR) || '.csv'
             ELSE strftime(o_orderdate, '%Y%m') || lower({TOKEN_SQL}) || '.csv' END AS file_name
    FROM orders
"""


@query(
    f"""
    WITH f AS ({ORDER_FILES_SQL}), p AS (SELECT *, replace(file_name, '_', '') AS plain_name FROM f)
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, file_name, plain_name,
           CASE WHEN plain_name LIKE 'readme%' THEN NULL ELSE substr(plain_name, 1, 6) END AS data,
           CASE WHEN plain_name LIKE 'readme%' THEN NULL
                ELSE upper(substr(plain_name, 7, length(plain_name) - 10)) END AS inst_type
    FROM p
    """
)
def file_name_parts(spark, sf_dir):
    plain = names.plain_file_name(F.col("file_name"))
    return _order_files(spark, sf_dir).select(
        "o_orderkey", "file_name", plain.alias("plain_name"),
        names.file_period(plain).alias("data"), names.file_type(plain).alias("inst_type"),
    )


@query(
    f"""
    WITH f AS (SELECT DISTINCT upper(file_name) AS file_name FROM ({ORDER_FILES_SQL}))
    SELECT plain_name, file_name, CAST(n_files AS BIGINT) AS n_files
    FROM (SELECT replace(file_name, '_', '') AS plain_name, file_name, count(*) OVER (PARTITION BY replace(file_name, '_', '')) AS n_files FROM f)
    WHERE n_files > 1
    """
)
def file_name_collisions(spark, sf_dir):
    files = _order_files(spark, sf_dir).select(F.upper("file_name").alias("file_name"))
    return name_collisions(files)


@query(
    f"""
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, file_name FROM ({ORDER_FILES_SQL})
    WHERE regexp_matches(upper(file_name), '^[0-9]{{6}}BANCOS\\.CSV$')
    """
)
def files_of_type(spark, sf_dir):
    files = _order_files(spark, sf_dir)
    return files.where(names.is_type_file(F.col("file_name"), "BANCOS"))


@query("SELECT CAST(page_id AS BIGINT) AS page_id, regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g') AS safe_name FROM pages")
def safe_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", names.safe_name(F.col("url")).alias("safe_name"))


@query("SELECT DISTINCT upper(event_type) AS inst_type FROM events")
def distinct_types(spark, sf_dir):
    mixed = table(spark, sf_dir, "events").select(
        F.when(F.col("value") > 20, F.upper("event_type")).otherwise(F.initcap("event_type")).alias("kind")
    )
    return reshape.distinct_types(mixed, "kind")


# --- column names ---------------------------------------------------------------------


@query(
    """
    SELECT CAST(p_partkey AS BIGINT) AS nome_instituicao, p_name AS number_x, p_brand AS percent_total,
           p_type AS segmento_tb, CAST(p_size AS BIGINT) AS a, p_retailprice AS a_2 FROM part
    """
)
def clean_names(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", F.col("p_size").cast("bigint"), "p_retailprice"
    )
    return names.clean_names(parts.toDF("NOME INSTITUIÇÃO", "#X", "% Total", "SegmentoTb", "a", "A"))


@query(
    """
    SELECT CAST(c_custkey AS BIGINT) AS cnpj, c_name AS nome_instituicao, CAST(c_nationkey AS BIGINT) AS "DATA",
           c_mktsegment AS "NOME INSTITUICAO" FROM customer
    """
)
def rename_matching(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").cast("bigint"), "c_mktsegment")
    raw = customers.toDF("CodInst", "Nome_Instituicao", "#data_base", "NOME INSTITUICAO")
    rules = {r"^(#)?DATA[_ ]?BASE$": "DATA", r"^NOME[_ ]INSTITUICAO$": "nome_instituicao", "^CodInst$": "cnpj"}
    return names.rename_matching(raw, rules)


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus FROM orders")
def drop_listed(spark, sf_dir):
    from finfilings.vocab import DROPPED_BALANCE_COLUMNS

    orders = table(spark, sf_dir, "orders").drop("o_orderdate", "o_custkey")
    odd = orders.withColumnsRenamed({"o_totalprice": "AGENCIA", "o_orderpriority": "NOME CONTA"})
    return names.require_columns(names.drop_listed(odd, DROPPED_BALANCE_COLUMNS), ["o_orderkey", "o_orderstatus"])


# --- values ---------------------------------------------------------------------------


@query(
    """
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE round(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE), 2) END AS saldo
    FROM orders
    """
)
def decimal_text(spark, sf_dir):
    """Totals printed as 1.234,56, as 1234.56, or as something that is no number."""
    price = F.col("o_totalprice")
    us = F.format_number(money(price), 2)
    swapped = F.translate(us, ",.", ".,")
    printed = F.when(F.col("o_orderstatus") == "F", swapped).when(F.col("o_orderstatus") == "O", money(price).cast("string")).otherwise(
        F.concat(swapped, F.lit(" D"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", printed.alias("saldo_raw"))
    return orders.select("o_orderkey", as_double(values.parse_decimal(F.col("saldo_raw"))).alias("saldo"))


@query(
    """
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN o_orderpriority END AS nome
    FROM orders
    """
)
def missing_text(spark, sf_dir):
    cell = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), "o_orderpriority", F.lit("  "))).when(
        F.col("o_orderstatus") == "O", "NA"
    ).otherwise("  ")
    return table(spark, sf_dir, "orders").select("o_orderkey", values.null_text(cell).alias("nome"))


@query(
    """
    SELECT CAST(c_custkey AS BIGINT) AS c_custkey,
           CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE CAST(c_custkey AS DOUBLE) END AS cnpj_num,
           CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN CAST(c_custkey AS VARCHAR) || '000190' ELSE CAST(c_custkey AS VARCHAR) END AS cnpj,
           lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS padded
    FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_mktsegment <> 'FURNITURE'
    """
)
def company_numbers(spark, sf_dir):
    """Footnote rows and rows without number drop out; signs make the number NULL."""
    key = F.col("c_custkey").cast("string")
    raw = (
        F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("FONTE: "), key))
        .when(F.col("c_mktsegment") == "FURNITURE", F.lit(None))
        .when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(key, F.lit("/0001-90")))
        .otherwise(F.regexp_replace(key, r"(\d)(\d{3})$", r"$1.$2"))
    )
    rows = drop_footnotes(table(spark, sf_dir, "customer").withColumn("cnpj", raw))
    return rows.select(
        "c_custkey", values.cnpj_number(F.col("cnpj")).alias("cnpj_num"), values.cnpj_digits(F.col("cnpj")).alias("cnpj"),
        values.pad_cnpj(key).alias("padded"),
    )


# --- periods and grids --------------------------------------------------------------------


@query(
    """
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-01') WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END AS month
    FROM orders
    """
)
def parse_month_arg(spark, sf_dir):
    printed = (
        F.when(F.col("o_orderstatus") == "F", month_text(F.col("o_orderdate")))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("m"), month_text(F.col("o_orderdate"))))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", printed.alias("arg"))
    return orders.select("o_orderkey", F.date_format(periods.parse_month(F.col("arg")), "yyyy-MM-dd").alias("month"))


@query(
    """
    WITH s AS (SELECT o_custkey, date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) AS b FROM orders GROUP BY 1)
    SELECT CAST(o_custkey AS BIGINT) AS o_custkey, strftime(m, '%Y%m') AS period
    FROM (SELECT o_custkey, unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM s)
    """
)
def months_between(spark, sf_dir):
    """Every month from each customer's first order to the last."""
    span = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return span.select("o_custkey", F.explode(periods.months_between(F.col("a"), F.col("b"))).alias("period"))


def _dims(spark, sf_dir) -> DataFrame:
    """Grid parameters out of the orders: years covered, months met, tokens met."""
    return table(spark, sf_dir, "orders").agg(
        F.sequence(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).alias("year"),
        F.collect_set(F.month("o_orderdate")).alias("month"),
        F.collect_set(token()).alias("institution"),
        F.collect_set(F.size(F.split("o_orderpriority", "[- ]"))).alias("inst_type"),
        F.min("o_orderdate").alias("start"),
        F.max("o_orderdate").alias("end"),
    )


GRID_SQL = f"""
    SELECT y AS year, m AS month, t AS institution, lpad(CAST(m AS VARCHAR), 2, '0') AS month_text,
           CASE t WHEN 'BANCOS' THEN 'Bancos' WHEN 'COOPERATIVAS' THEN 'Cooperativas-de-credito' ELSE 'Administradoras-de-consorcios' END AS label,
           CAST(y AS VARCHAR) || lpad(CAST(m AS VARCHAR), 2, '0') || t || '.CSV' AS expected_name
    FROM (SELECT unnest(generate_series(min(year(o_orderdate)), max(year(o_orderdate)))) AS y FROM orders),
         (SELECT DISTINCT month(o_orderdate) AS m FROM orders), (SELECT DISTINCT {TOKEN_SQL} AS t FROM orders)
"""


@query(f"SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, institution, month_text, label, expected_name FROM ({GRID_SQL})")
def balance_grid(spark, sf_dir):
    return _grid(spark, sf_dir)


def _grid(spark, sf_dir):
    grid = grids.balance_grid_of(_dims(spark, sf_dir))
    return grid.withColumns({c: F.col(c).cast("bigint") for c in ("year", "month")})


@query(
    """
    SELECT CAST(y AS BIGINT) AS year, CAST(m AS BIGINT) AS month, CAST(t AS BIGINT) AS inst_type,
           CAST(y AS VARCHAR) || lpad(CAST(m AS VARCHAR), 2, '0') AS period
    FROM (SELECT unnest(generate_series(min(year(o_orderdate)), max(year(o_orderdate)))) AS y FROM orders),
         (SELECT DISTINCT month(o_orderdate) AS m FROM orders),
         (SELECT DISTINCT len(string_split_regex(o_orderpriority, '[- ]')) AS t FROM orders)
    """
)
def values_grid(spark, sf_dir):
    grid = grids.values_grid_of(_dims(spark, sf_dir))
    return grid.withColumns({c: F.col(c).cast("bigint") for c in ("year", "month", "inst_type")})


@query(
    """
    SELECT CAST(y AS BIGINT) AS year, CAST(m AS BIGINT) AS month, CAST(y AS VARCHAR) || lpad(CAST(m AS VARCHAR), 2, '0') AS period
    FROM (SELECT unnest(generate_series(min(year(o_orderdate)), max(year(o_orderdate)))) AS y FROM orders),
         (SELECT DISTINCT month(o_orderdate) AS m FROM orders)
    """
)
def registry_grid(spark, sf_dir):
    grid = grids.registry_grid_of(_dims(spark, sf_dir))
    return grid.withColumns({c: F.col(c).cast("bigint") for c in ("year", "month")})


@query(
    f"""
    WITH s AS (SELECT date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) AS b FROM orders)
    SELECT t AS institution, strftime(m, '%Y%m') AS period,
           CASE t WHEN 'BANCOS' THEN 'Bancos_comerciais-multiplos-caixa' WHEN 'COOPERATIVAS' THEN 'Cooperativas-de-credito' END AS label,
           t || '_' || strftime(m, '%Y%m') || '.zip' AS expected_name
    FROM (SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM s),
         (SELECT DISTINCT {TOKEN_SQL} AS t FROM orders)
    """
)
def expected_names(spark, sf_dir):
    return grids.institution_grid_of(_dims(spark, sf_dir))


@query(
    """
    SELECT CAST(user_id AS BIGINT) AS user_id, CAST(n AS BIGINT) AS total_rows, CAST(s AS BIGINT) AS start_row
    FROM (SELECT user_id, n, unnest(generate_series(0, n, 500)) AS s
          FROM (SELECT user_id, CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE json_extract(props, '$.k')::INT END) AS BIGINT) AS n FROM events GROUP BY 1) WHERE n > 0)
    """
)
def page_plan(spark, sf_dir):
    """Pages that cover each user's total; none for a total of zero."""
    k = F.from_json("props", "k int")["k"]
    totals = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.sum(F.when(F.col("event_type") == "error", 0).otherwise(k)).alias("total_rows")
    )
    return grids.page_plan(totals)


# --- landing --------------------------------------------------------------------------------


@query(
    f"""
    SELECT CAST(g.year AS BIGINT) AS year, CAST(g.month AS BIGINT) AS month, g.institution, g.expected_name, f.name IS NOT NULL AS present
    FROM ({GRID_SQL}) g LEFT JOIN (SELECT DISTINCT upper(replace(file_name, '_', '')) AS name FROM ({ORDER_FILES_SQL})) f ON f.name = g.expected_name
    """
)
def landing_audit(spark, sf_dir):
    found = audit.landing_audit(_grid(spark, sf_dir), _order_files(spark, sf_dir))
    return found.select("year", "month", "institution", "expected_name", "present")


@query(
    f"""
    SELECT g.expected_name FROM ({GRID_SQL}) g
    WHERE NOT EXISTS (SELECT 1 FROM ({ORDER_FILES_SQL}) f WHERE upper(replace(f.file_name, '_', '')) = g.expected_name)
    """
)
def missing_files(spark, sf_dir):
    return audit.missing_files(_grid(spark, sf_dir), _order_files(spark, sf_dir)).select("expected_name")


@query(
    """
    WITH f AS (
      SELECT strftime(ts, '%Y%m%d') AS period, 'U' || CAST(user_id AS VARCHAR) AS institution,
             CASE event_type WHEN 'click' THEN '.CSV.ZIP' WHEN 'view' THEN '.csv' WHEN 'purchase' THEN '.ZIP' WHEN 'error' THEN '.CSV.ZIP' ELSE '.CSV' END AS suffix,
             CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 END AS rank
      FROM events),
    n AS (SELECT *, period || institution || suffix AS file_name FROM f)
    SELECT period, institution, coalesce(arg_min(file_name, rank), period || '_' || institution || '.CSV.ZIP') AS file_name,
           count(rank) > 0 AS usable, CAST(count(*) AS BIGINT) AS n_variants
    FROM n GROUP BY period, institution
    """
)
def variant_choice(spark, sf_dir):
    """Which of a day's variants to use; errors and sign-ups stand for unusable ones."""
    kinds = {"click": ".CSV.ZIP", "view": ".csv", "purchase": ".ZIP", "error": ".CSV.ZIP"}
    suffix = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in kinds.items()], F.lit(".CSV"))
    files = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("period"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("institution"),
        suffix.alias("suffix"), (~F.col("event_type").isin("error", "signup")).alias("usable"),
    )
    return audit.choose_variant(files.withColumn("file_name", F.concat("period", "institution", "suffix")))


@query(
    f"""
    WITH f AS (
      SELECT strftime(o_orderdate, '%Y%m') || {TOKEN_SQL} || '.CSV' AS name,
             max(CASE WHEN o_orderpriority = '1-URGENT' THEN 200 END) AS good,
             min(CASE WHEN o_orderpriority = '2-HIGH' THEN 404 WHEN o_orderpriority = '3-MEDIUM' THEN 500 END) AS bad,
             bool_or(o_orderpriority = '4-NOT SPECIFIED') AS existed
      FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1),
    r AS (
      SELECT strftime(o_orderdate, '%Y%m') || {TOKEN_SQL} || '.CSV' AS name FROM orders
      WHERE o_orderpriority = '5-LOW' AND o_totalprice > 450000 GROUP BY 1)
    SELECT CAST(g.year AS BIGINT) AS year, CAST(g.month AS BIGINT) AS month, g.institution, f.name AS file_name,
           coalesce(f.good = 200 OR f.existed, false) AND r.name IS NULL AS success,
           CAST(coalesce(f.good, f.bad) AS INTEGER) AS status,
           CASE WHEN r.name IS NOT NULL THEN 'bad archive' WHEN f.name IS NULL THEN 'not landed'
                WHEN f.existed AND f.good IS NULL AND f.bad IS NULL THEN 'landed earlier and kept'
                WHEN NOT coalesce(f.good = 200 OR f.existed, false) THEN 'status ' || CAST(coalesce(f.good, f.bad) AS VARCHAR) END AS error
    FROM ({GRID_SQL}) g LEFT JOIN f ON f.name = g.expected_name LEFT JOIN r ON r.name = g.expected_name
    """
)
def landing_report(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    name = F.concat(month_text(F.col("o_orderdate")), token(), F.lit(".CSV"))
    p = F.col("o_orderpriority")
    status = F.when(p == "1-URGENT", 200).when(p == "2-HIGH", 404).when(p == "3-MEDIUM", 500)
    files = orders.where(p != "5-LOW").select(name.alias("file_name"), status.alias("status"), (p == "4-NOT SPECIFIED").alias("existed"))
    rejects = orders.where((p == "5-LOW") & (F.col("o_totalprice") > 450000)).select(name.alias("file_name"), F.lit("bad archive").alias("reason"))
    report = audit.landing_report(_grid(spark, sf_dir), files, rejects)
    return report.select("year", "month", "institution", "file_name", "success", "status", "error")


@query(
    """
    SELECT CAST(event_id AS BIGINT) AS event_id, upper(event_type) AS token,
           CASE event_type WHEN 'click' THEN 'Clicks' WHEN 'view' THEN 'Views' END AS label
    FROM events WHERE event_type IN ('click', 'view', 'purchase')
    """
)
def token_skip(spark, sf_dir):
    """Known tokens kept and labelled."""
    known = grids.known_tokens(table(spark, sf_dir, "events"), "event_type", ("CLICK", "VIEW", "PURCHASE"))
    kind = F.upper("event_type")
    return known.select("event_id", kind.alias("token"), grids.label_of(kind, {"CLICK": "Clicks", "VIEW": "Views"}).alias("label"))


@query("SELECT DISTINCT upper(event_type) AS event_type FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')")
def token_unknown(spark, sf_dir):
    return grids.unknown_tokens(table(spark, sf_dir, "events"), "event_type", ("CLICK", "VIEW", "PURCHASE"))


# --- filters and reshaping ---------------------------------------------------------------------


def _items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("documento"), F.col("l_returnflag").alias("inst_type"), F.col("l_orderkey"),
        F.col("l_extendedprice").alias("saldo"),
    )


@query(
    """
    SELECT l_returnflag AS inst_type, CAST(l_orderkey AS BIGINT) AS l_orderkey, l_extendedprice AS saldo, CAST(l_linenumber AS BIGINT) AS documento
    FROM lineitem WHERE l_linenumber = 4
    """
)
def doc_filter(spark, sf_dir):
    return reshape.filter_document(_items(spark, sf_dir), 4).withColumn("documento", F.col("documento").cast("bigint"))


@query(
    """
    SELECT p_brand AS inst_type, CAST(count(CASE WHEN p_size = 7 THEN 1 END) AS BIGINT) AS n_rows,
           count(CASE WHEN p_size = 7 THEN 1 END) = 0 AS is_empty FROM part GROUP BY 1
    """
)
def doc_filter_counts(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("inst_type"), F.col("p_size").alias("documento"))
    return reshape.document_counts(parts, 7)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _pivot_sql(aggregate: str, group: str) -> str:
    cells = ", ".join(
        f"round(CAST({aggregate}(CASE WHEN o_orderpriority = '{p}' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE), 2) AS p{i}"
        for i, p in enumerate(PRIORITIES, 1)
    )
    return f"SELECT {group}, {cells} FROM orders GROUP BY 1, 2"


def _order_cells(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").cast("bigint").alias("order_year"), "o_orderkey", "o_orderpriority",
        money(F.col("o_totalprice")).alias("price"),
    )


def _rounded(df, columns):
    return df.withColumns({c: as_double(F.col(c)) for c in columns})


P_NAMES = [f"p{i}" for i in range(1, 6)]


@query(_pivot_sql("sum", "CAST(o_custkey AS BIGINT) AS o_custkey, CAST(year(o_orderdate) AS BIGINT) AS order_year"))
def pivot_sum(spark, sf_dir):
    wide = reshape.pivot_wide(_order_cells(spark, sf_dir), ["o_custkey", "order_year"], "o_orderpriority", "price", PRIORITIES, "sum", P_NAMES)
    return _rounded(wide, P_NAMES)


@query(_pivot_sql("min", "CAST(o_custkey AS BIGINT) AS o_custkey, CAST(year(o_orderdate) AS BIGINT) AS order_year"))
def pivot_first(spark, sf_dir):
    wide = reshape.pivot_wide(_order_cells(spark, sf_dir), ["o_custkey", "order_year"], "o_orderpriority", "price", PRIORITIES, "first", P_NAMES)
    return _rounded(wide, P_NAMES)


@query(_pivot_sql("min", "CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS order_year"))
def pivot_unique(spark, sf_dir):
    """The default policy: each cell claimed once, or the query fails."""
    wide = reshape.pivot_wide(_order_cells(spark, sf_dir), ["o_orderkey", "order_year"], "o_orderpriority", "price", PRIORITIES, names=P_NAMES)
    return _rounded(wide, P_NAMES)


@query(
    """
    WITH d AS (
      SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS order_year, o_orderstatus, CAST(o_orderpriority AS VARCHAR) AS v, count(*) AS n
      FROM orders GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, order_year, o_orderstatus ORDER BY v) AS copy FROM d)
    SELECT CAST(o_custkey AS BIGINT) AS o_custkey, order_year, CAST(copy AS BIGINT) AS copy,
           max(CASE WHEN o_orderstatus = 'F' THEN v END) AS f, CAST(max(CASE WHEN o_orderstatus = 'F' THEN n END) AS BIGINT) AS f_n,
           max(CASE WHEN o_orderstatus = 'O' THEN v END) AS o, CAST(max(CASE WHEN o_orderstatus = 'O' THEN n END) AS BIGINT) AS o_n,
           max(CASE WHEN o_orderstatus = 'P' THEN v END) AS p, CAST(max(CASE WHEN o_orderstatus = 'P' THEN n END) AS BIGINT) AS p_n
    FROM k GROUP BY 1, 2, 3
    """
)
def pivot_rows(spark, sf_dir):
    """Every copy of a cell kept, with its count."""
    return reshape.pivot_wide(
        _order_cells(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey"),
        ["o_custkey", "order_year"], "o_orderstatus", "o_orderpriority", ["F", "O", "P"], "rows", ["f", "o", "p"],
    )


@query(
    """
    SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(year(o_orderdate) AS BIGINT) AS order_year, o_orderpriority, CAST(count(*) AS BIGINT) AS n_rows
    FROM orders GROUP BY ALL HAVING count(*) > 1
    """
)
def duplicate_cells(spark, sf_dir):
    return reshape.duplicate_cells(_order_cells(spark, sf_dir), ["o_custkey", "order_year"], "o_orderpriority")


@query(
    """
    SELECT strftime(o_orderdate, '%Y%m') AS data, CAST(o_custkey AS BIGINT) AS o_custkey, CAST(day(o_orderdate) AS VARCHAR) AS conta,
           round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS saldo
    FROM orders GROUP BY ALL
    """
)
def pivot_unpivot(spark, sf_dir):
    """Accounts found in the data, pivoted to columns and back."""
    orders = table(spark, sf_dir, "orders").select(
        month_text(F.col("o_orderdate")).alias("data"), "o_custkey", F.dayofmonth("o_orderdate").cast("string").alias("conta"),
        money(F.col("o_totalprice")).alias("saldo"),
    )
    wide = reshape.pivot_wide(orders, ["data", "o_custkey"], on_duplicate="sum")
    return _rounded(reshape.unpivot_long(wide, ["data", "o_custkey"]), ["saldo"])


@query(
    """
    SELECT CAST(l_suppkey AS BIGINT) AS l_suppkey, strftime(l_shipdate, '%Y%m') AS data, 'q' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || l_linestatus AS conta,
           round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS saldo
    FROM lineitem GROUP BY ALL
    """
)
def pivot_many_accounts(spark, sf_dir):
    """More accounts than conditional aggregates are used for."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", month_text(F.col("l_shipdate")).alias("data"),
        F.concat(F.lit("q"), F.col("l_quantity").cast("int").cast("string"), "l_linestatus").alias("conta"),
        money(F.col("l_extendedprice")).alias("saldo"),
    )
    wide = reshape.pivot_wide(items, ["l_suppkey", "data"], on_duplicate="sum")
    return _rounded(reshape.unpivot_long(wide, ["l_suppkey", "data"]), ["saldo"])


@query(
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_institutions, CAST(count(DISTINCT event_type) AS BIGINT) AS n_types FROM events"
)
def load_summary(spark, sf_dir):
    return reshape.load_summary(table(spark, sf_dir, "events"), "user_id", "event_type")


@query("SELECT o_orderstatus AS inst_type, CAST(count(*) AS BIGINT) AS n_rows FROM orders GROUP BY 1")
def split_by_type(spark, sf_dir):
    parts = reshape.split_by_type(table(spark, sf_dir, "orders"), "o_orderstatus")
    counts = [df.agg(F.lit(k).alias("inst_type"), F.count("*").alias("n_rows")) for k, df in parts.items()]
    return reshape.union_by_name(*counts)


@query(
    """
    SELECT CAST(o_orderkey AS BIGINT) AS cod, o_orderpriority AS grupo, CAST(NULL AS VARCHAR) AS uf FROM orders
    UNION ALL SELECT CAST(c_custkey AS BIGINT), NULL, c_mktsegment FROM customer
    """
)
def union_periods(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("cod"), F.col("o_orderpriority").alias("grupo"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("uf"), F.col("c_custkey").alias("cod"))
    return reshape.union_by_name(orders, customers)


# --- text -----------------------------------------------------------------------------------------


@query("SELECT CAST(page_id AS BIGINT) AS page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages")
def strip_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.strip_tags(F.col("html")).alias("text"))


@query("SELECT CAST(event_id AS BIGINT) AS event_id, event_type || event_type AS field FROM events")
def scrub_prefix(spark, sf_dir):
    marked = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("string;#"), "event_type", F.lit("string;#"), "event_type").alias("field")
    )
    return text.scrub_prefix_in(marked, ("field", "absent"))


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS number FROM orders")
def cut_decimal(spark, sf_dir):
    printed = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,10)").cast("string").alias("number"))
    return text.cut_decimal_in(printed, ("number",))


@query(
    r"""
    SELECT CAST(doc_id AS BIGINT) AS doc_id, trim(regexp_replace(text, '[\t\n\f\r\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000} ]+', ' ', 'g')) AS text FROM documents
    """
)
def squish(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.squish(F.col("text")).alias("text"))


@query("SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, replace(text, chr(10), ' ') AS text FROM conversations")
def newline_space(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.newline_space(F.col("text")).alias("text"))


@query(
    r"""
    WITH p AS (
      SELECT page_id, regexp_extract(html, '(?s)^(.*?)<script[^>]*>', 1) AS a,
             regexp_extract(html, '(?s)<script[^>]*>(.*?)</script>', 1) AS s,
             regexp_extract(html, '(?s)</script>(.*)$', 1) AS b
      FROM pages),
    t AS (
      SELECT page_id, s, regexp_replace(regexp_replace(a, '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g') AS a,
             regexp_replace(regexp_replace(regexp_replace(b, '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g'), '<[/a-zA-Z!][^<>]*$', '') AS b
      FROM p)
    SELECT CAST(page_id AS BIGINT) AS page_id,
           replace(replace(replace(regexp_replace(a, '&amp;?', '&', 'g'), '', ''), '', ''), '', '') || s ||
           regexp_replace(replace(replace(replace(b, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') AS text
    FROM t
    """
)
def html_text(spark, sf_dir):
    """Text nodes of whole pages, script and style text included."""
    return table(spark, sf_dir, "pages").select("page_id", text.html_text(F.col("html")).alias("text"))


# --- acts ---------------------------------------------------------------------------------------------


@query(
    """
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderpriority FROM orders
    WHERE (o_orderpriority ILIKE '%urgent%' OR o_orderpriority ILIKE '%not spec%')
      AND o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate <= TIMESTAMP '1998-10-31'
    """
)
def search_acts(spark, sf_dir):
    found = acts.search_acts(
        table(spark, sf_dir, "orders"), ["Urgent", "NOT SPEC"], "1996-03-01", "1998-10-31", "o_orderpriority", "o_orderdate", "o_orderkey"
    )
    return found.select("o_orderkey", "o_orderpriority")


@query(
    """
    SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(n_chars AS BIGINT) AS n_chars FROM documents
    WHERE (contains(lower(text), 'that the') OR contains(lower(text), 'für') OR contains(lower(text), 'de la')) AND n_chars BETWEEN 500 AND 100000000
    """
)
def search_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return acts.search_acts(docs, ["That the", "FÜR", "de la"], 500, 100_000_000, "text", "n_chars").select("doc_id", "n_chars")


@query(
    """
    SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(rn AS BIGINT) AS row_number, CAST(((rn - 1) // 500) * 500 AS BIGINT) AS start_row
    FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rn FROM documents)
    """
)
def page_rows(spark, sf_dir):
    """Every document with its place and page, longest first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return acts.paged(docs, [F.col("n_chars").desc(), F.col("doc_id")]).select("doc_id", "row_number", "start_row")


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 500 OFFSET 1000")
def one_page(spark, sf_dir):
    """The third page of the orders, latest first."""
    orders = table(spark, sf_dir, "orders")
    return acts.one_page(orders, [F.col("o_orderdate").desc(), F.col("o_orderkey")], 1000).select("o_orderkey", "o_totalprice")


def event_pages(spark, sf_dir) -> DataFrame:
    """Each event as a search page; errors are pages that are not JSON, sign-ups empty."""
    hit = F.struct(
        F.col("event_type").alias("TipodoNormativoOWSCHCS"),
        F.concat(F.col("event_id").cast("string"), F.lit(".0000000000")).alias("NumeroOWSNMBR"),
        F.concat(F.lit("string;#"), "event_type").alias("RefinableString01"),
        F.concat(F.lit("<p>User <b>"), F.col("user_id").cast("string"), F.lit("</b></p>")).alias("AssuntoNormativoOWSMTXT"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Data1OWSDATE"),
        F.when(F.col("value") > 10, F.col("value")).alias("Valor"),
    )
    page = F.to_json(F.struct(F.lit(1).alias("TotalRows"), F.array(hit).alias("Rows")))
    payload = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("<html>"), page))
        .when(F.col("event_type") == "signup", F.lit('{"TotalRows": 0, "Rows": []}'))
        .otherwise(page)
    )
    return table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("file_name"), payload.alias("payload"))


@query(
    """
    SELECT event_type AS tipo, CAST(event_id AS VARCHAR) AS numero, event_type AS campo, 'User ' || CAST(user_id AS VARCHAR) AS assunto,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS data, CASE WHEN value > 10 THEN value END AS valor, CAST(NULL AS VARCHAR) AS ausente
    FROM events WHERE event_type NOT IN ('error', 'signup')
    """
)
def json_pages(spark, sf_dir):
    """Search pages parsed and their fields cleaned."""
    fields = ["TipodoNormativoOWSCHCS", "NumeroOWSNMBR", "RefinableString01", "AssuntoNormativoOWSMTXT", "Data1OWSDATE", "Valor", "HitHighlightedSummary"]
    rows = acts_table(event_pages(spark, sf_dir), fields)
    return rows.select(
        F.col("TipodoNormativoOWSCHCS").alias("tipo"), F.col("NumeroOWSNMBR").alias("numero"), F.col("RefinableString01").alias("campo"),
        F.col("AssuntoNormativoOWSMTXT").alias("assunto"), F.date_format("Data1OWSDATE", "yyyy-MM-dd HH:mm:ss").alias("data"),
        F.col("Valor").try_cast("double").alias("valor"), F.col("HitHighlightedSummary").alias("ausente"),
    )


@query("SELECT CAST(event_id AS VARCHAR) AS file_name, 'not a JSON payload' AS reason FROM events WHERE event_type = 'error'")
def json_rejects(spark, sf_dir):
    return pages.bad_pages(event_pages(spark, sf_dir))


@query(
    """
    SELECT event_type AS tipo, CAST(sum(CASE event_type WHEN 'signup' THEN 0 WHEN 'error' THEN NULL ELSE 1 END) AS BIGINT) AS total FROM events GROUP BY 1
    """
)
def page_totals(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("file_name"), "event_type")
    joined = event_pages(spark, sf_dir).join(events, "file_name")
    return joined.groupBy(F.col("event_type").alias("tipo")).agg(F.sum(pages.total_rows(F.col("payload"))).alias("total"))


@query(
    r"""
    SELECT l.doc_id AS doc_id, CAST(l.quality AS BIGINT) AS quality, d.source AS "Assunto",
           trim(regexp_replace(d.text, '[\t\n\f\r\x{00a0} ]+', ' ', 'g')) AS "Texto"
    FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id
    """
)
def act_text_join(spark, sf_dir):
    """Labels as acts, each with the text its landed payload holds."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("NumeroOWSNMBR"), F.lit("Comunicado").alias("TipodoNormativoOWSCHCS"), "doc_id", F.col("quality").cast("bigint").alias("quality")
    )
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    escaped = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.to_json(F.struct(F.array(F.struct(
        F.concat(F.lit("<p>"), "source", F.lit("</p>")).alias("Assunto"), F.concat(F.lit("<div>"), escaped, F.lit("\n</div><!-- c -->")).alias("Texto"),
    )).alias("conteudo")))
    landed = docs.select(
        F.col("doc_id").cast("string").alias("NumeroOWSNMBR"), F.lit("Comunicado").alias("TipodoNormativoOWSCHCS"), body.alias("payload")
    )
    return get_normative_txt(labels, landed, ["Assunto", "Texto"]).select("doc_id", "quality", "Assunto", "Texto")


# --- indicators -----------------------------------------------------------------------------------------


def _csv_cell(c):
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def value_lines(spark, sf_dir):
    items = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", "l_extendedprice")
    cells = [
        F.col("l_linenumber").cast("string"), F.col("l_suppkey").cast("string"), month_text(F.col("l_shipdate")),
        _csv_cell(F.concat(F.lit("Report, "), "l_returnflag")), F.col("l_returnflag"), F.lit(""), F.col("l_partkey").cast("string"),
        F.lit("Ativo Total"), _csv_cell(F.concat(F.lit('soma "'), "l_linestatus", F.lit('"'))), money(F.col("l_extendedprice")).cast("string"),
    ]
    body = items.select(
        F.concat(month_text(F.col("l_shipdate")), F.lit(".csv")).alias("file_name"), F.col("l_orderkey").alias("pos"), F.concat_ws(",", *cells).alias("line")
    )
    return lines_with_head(body, lambda: [F.lit(",".join(VALUE_COLUMNS))])


@query(
    """
    SELECT CAST(l_linenumber AS INTEGER) AS tipo_instituicao, CAST(l_suppkey AS VARCHAR) AS cnpj, strftime(l_shipdate, '%Y%m') AS ano_mes,
           'Report, ' || l_returnflag AS nome_relatorio, l_returnflag AS numero_relatorio, CAST(NULL AS VARCHAR) AS grupo, CAST(l_partkey AS VARCHAR) AS conta,
           'Ativo Total' AS nome_coluna, 'soma "' || l_linestatus || '"' AS descricao_coluna,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS saldo_raw, round(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE), 2) AS saldo
    FROM lineitem WHERE l_linenumber IN (1, 2, 3, 4)
    """
)
def ifdata_values(spark, sf_dir):
    raw = indicators.parse_csv_lines(value_lines(spark, sf_dir), VALUE_COLUMNS).drop("file_name")
    tidy = indicators.tidy_values(raw).where(F.col("tipo_instituicao").isin(1, 2, 3, 4))
    return tidy.withColumn("saldo", as_double(F.col("saldo")))


def registry_lines(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    cells = [
        key, F.lit("202312"), _csv_cell(F.col("c_name")), F.lit(""), F.lit("b1"), F.lit("1"), F.lit("2"), F.col("c_mktsegment"), F.lit('"Atividade, várias"'),
        F.lit("SP"), F.lit("São Paulo"), F.concat(F.lit("S"), nation), F.lit(""), F.concat(F.lit("C"), nation), key, F.lit("A"),
    ]
    body = customers.select(F.lit("202312.csv").alias("file_name"), F.col("c_custkey").alias("pos"), F.concat_ws(",", *cells).alias("line"))
    return lines_with_head(body, lambda: [F.lit(",".join(REGISTRY_COLUMNS))])


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS cod_inst, '202312' AS data, c_name AS nome_instituicao, CAST(NULL AS VARCHAR) AS data_inicio_atividade,
           'b1' AS tcb, '1' AS td, '2' AS tc, c_mktsegment AS segmento_tb, 'Atividade, várias' AS atividade, 'SP' AS uf, 'São Paulo' AS municipio,
           'S' || CAST(c_nationkey AS VARCHAR) AS sr, CAST(NULL AS VARCHAR) AS cod_conglomerado_financeiro, 'C' || CAST(c_nationkey AS VARCHAR) AS cod_conglomerado_prudencial,
           CAST(c_custkey AS VARCHAR) AS cnpj_instituicao_lider, 'A' AS situacao
    FROM customer
    """
)
def ifdata_registry(spark, sf_dir):
    return indicators.tidy_registry(indicators.parse_csv_lines(registry_lines(spark, sf_dir), REGISTRY_COLUMNS).drop("file_name"))


@query(
    """
    SELECT CAST(event_id AS VARCHAR) AS file_name, CASE event_type WHEN 'error' THEN 'status 500' ELSE 'status unknown' END AS reason
    FROM events WHERE event_type IN ('error', 'signup')
    """
)
def unanswered_payloads(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") != "signup", 200)
    events = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("file_name"), status.alias("status"))
    return indicators.unanswered(events)


@query(
    """
    SELECT 'month.csv' AS file_name, 'bad line: ' || CAST(o_orderkey AS VARCHAR) || ',only two' AS reason FROM orders WHERE o_orderstatus = 'P'
    """
)
def corrupt_payload_lines(spark, sf_dir):
    """Lines with too few cells are reported with their text."""
    key = F.col("o_orderkey").cast("string")
    full = F.concat_ws(",", key, *[F.lit("x") for _ in VALUE_COLUMNS[1:]])
    lines = table(spark, sf_dir, "orders").select(
        F.lit("month.csv").alias("file_name"), F.when(F.col("o_orderstatus") == "P", F.concat(key, F.lit(",only two"))).otherwise(full).alias("line")
    )
    return indicators.corrupt_lines(indicators.parse_csv_lines(lines, VALUE_COLUMNS))
