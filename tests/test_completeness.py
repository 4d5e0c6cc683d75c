"""Coverage of landed pages, the page index, all columns, pruned payloads, rejects of a stream."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

import finfilings
from finfilings.operators import pages as ops
from finfilings.plans.balances import import_all_columns
from finfilings.plans.indicators import land_registry
from finfilings.sources.indicators import read_values
from finfilings.streaming.landing import stream_balances_with_rejects
from finfilings.vocab import REGISTRY_COLUMNS, VALUE_COLUMNS
from tests.conftest import rows


def page(start, n, total, search="a"):
    return (search, start, json.dumps({"TotalRows": total, "Rows": [{"id": str(start + k)} for k in range(n)]}))


def test_gaps_overlaps_and_changed_totals(spark):
    landed = [
        page(0, 500, 2100), page(500, 500, 2100), page(1500, 500, 2100), page(1400, 300, 2100),  # 1000-1400 and 2000-2100 are missing
        page(0, 10, 10, "whole"), page(0, 0, 0, "none"), ("bad", 0, "<html>"), ("bad", None, None),
        page(0, 500, 600, "grown"), page(500, 200, 700, "grown"), page(100, 5, 105, "late"), page(0, 3, 3, "twice"), page(0, 3, 3, "twice"),
    ]
    spans = ops.page_spans(spark.createDataFrame(landed, "search string, start_row long, payload string").repartition(3))
    assert rows(ops.page_coverage(spans)) == [
        ("a", "gap", 1000, 1400), ("a", "gap", 2000, 2100), ("a", "overlap", 1500, 1700), ("bad", "unknown", 0, 0),
        ("grown", "total", 600, 700), ("late", "gap", 0, 100), ("twice", "overlap", 0, 3),
    ]
    assert ops.page_coverage(spans.limit(0)).collect() == []


def test_a_page_opens_the_files_it_lies_in(spark, tmp_path):
    table = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("k")).repartition(6)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = ops.land_pages(table, [F.col("k")], str(tmp_path / "pages"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    index = spark.read.parquet(f"{out}/index")
    assert index.count() > 3 and index.agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0] == 10_000
    want = [r["k"] for r in table.orderBy("k").collect()]
    for start, n in ((0, 500), (4900, 500), (9900, 500), (10_000, 500), (3, 1)):
        found = ops.landed_page(spark, out, start, n)
        assert [r["k"] for r in found.collect()] == want[start:start + n]
        assert len(found.inputFiles()) <= 2


def test_all_columns_of_all_forms(spark, tmp_path):
    (tmp_path / "202312BANCOS.CSV").write_text("#DATA_BASE;DOCUMENTO;CNPJ;NOME INSTITUICAO;CONTA;SALDO;ATRIBUTO;Nota %\n202312;4010;1;A;1;1.234,567;x;n\n")
    (tmp_path / "202306COOPERATIVAS.CSV").write_text("DATA,DOCUMENTO,CNPJ,CONTA,SALDO,File_Name\n202306,4010,2,1,0.1534,f\n")
    for whole in (0, 1 << 20):
        found = import_all_columns(spark, str(tmp_path), whole)
        assert "atributo" not in found.columns
        assert rows(found.select("inst_type", "documento", "cnpj", "nome_instituicao", "saldo", "nota_percent")) == [
            ("BANCOS", 4010, "00000001", "A", Decimal("1234.567"), "n"), ("COOPERATIVAS", 4010, "00000002", None, Decimal("0.1534"), None)]


def test_payloads_of_other_periods_are_not_opened(spark, tmp_path):
    def payload(period, *lines):
        (tmp_path / f"values_{period}.csv").write_text(",".join(VALUE_COLUMNS) + "\n" + "".join(f"{line}\n" for line in lines))

    cells = ",".join(["r"] * 6)
    for period in ("202403", "202406", "202409"):
        payload(period, f"1,7,{period},{cells},1.5")
    payload("all", f"1,8,202406,{cells},2.5", f"1,9,202406,{cells}", f'1,10,202406,"{cells},1')
    (tmp_path / "answer.txt").write_text("<html>202406</html>\n")
    got, rejects = finfilings.read_ifdata_values(spark, str(tmp_path), 2024, 6, 1)
    assert rows(got.select("cnpj", "ano_mes", "saldo")) == [("7", "202406", Decimal("1.5")), ("8", "202406", Decimal("2.5"))]
    assert rows(rejects.select(F.substring_index("file_name", "/", -1), "reason")) == [
        ("answer.txt", "no header line"), ("values_all.csv", "9 cells for 10 columns"), ("values_all.csv", "a quote is never closed")]
    raw = read_values(spark, str(tmp_path), ["202406"])
    assert raw.count() == 2 and "values_202403" not in " ".join(raw.select("CodInst").inputFiles()) or _files_read(raw) == 3


def _files_read(df):
    """Files that the scans of an executed plan opened."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numFiles").value() for k in range(leaves.size()) if "numFiles" in str(leaves.apply(k).metrics().keys()))


def test_the_registry_lands_by_period(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for period in ("202306", "202312"):
        backwards = REGISTRY_COLUMNS[::-1]
        cells = [period if c == "Data" else f"{c}{period}" for c in backwards]
        (raw / f"registry_{period}.csv").write_text(",".join(backwards) + "\n" + ",".join(cells) + "\nshort,line\n")
    out = str(tmp_path / "out")
    for month in (6, 12, 12):
        found, rejects = finfilings.read_ifdata_registry(spark, str(raw), 2023, month)
        assert rows(rejects.select("reason")) == [("2 cells for 16 columns",)]
        land_registry(found, out)
    back = finfilings.get_ifdata_registry(spark, out, 2023, [6, 12])
    assert rows(back.select("data", "uf")) == [("202306", "Uf202306"), ("202312", "Uf202312")]
    assert rows(finfilings.get_ifdata_registry(spark, out, 2023, 6).select("data")) == [("202306",)]


def test_a_stream_lands_rows_and_rejects_of_small_and_large_files(spark, tmp_path):
    landing, out, bad = tmp_path / "landing", str(tmp_path / "rows"), str(tmp_path / "bad")
    landing.mkdir()
    head = "#DATA_BASE;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;SALDO\n"
    (landing / "202312BANCOS.CSV").write_text(head + '202312;4010;1;"A\nB";1;1,00\n202312;4010;2;"OPEN;1;1,00\n')
    (landing / "202311BANCOS.CSV").write_text(head + '202311;4010;3;"A\nB";1;1,00\n202311;4010;4;"OPEN;1;1,00\n' + "202311;4010;5;C;1;1,00\n" * 50)
    (landing / "202310BANCOS.CSV").write_text("nothing\n")
    for number in range(2):
        stream_balances_with_rejects(spark, str(landing), out, bad, str(tmp_path / f"state{number}"), whole_file_bytes=300).awaitTermination(120)
        # a batch that is run again replaces itself
        assert rows(spark.read.parquet(out).groupBy("data").count()) == [(202311, 51), (202312, 1)]
        assert rows(spark.read.parquet(bad).select("file_name", "reason")) == [
            ("202310BANCOS.CSV", "no header line"), ("202311BANCOS.CSV", "a quote is never closed"), ("202312BANCOS.CSV", "a quote is never closed")]


def test_twelve_thousand_headers_of_few_names(spark):
    """More distinct headers than were ever collected: names in any order, some of them twice."""
    import itertools

    from finfilings.sources.delimited import INSTITUTIONS, parse_lines_by_name

    names = ["CNPJ", "Nome", "UF", "Município", "E-mail", "Nome", "Telefone", "% Capital"]
    orders = list(itertools.islice(itertools.permutations(range(8)), 0, 40_000, 3))[:12_000]
    lines = [(f"{k:06d}", 0, ",".join(names[i] for i in order)) for k, order in enumerate(orders)]
    lines += [(f"{k:06d}", 1, ",".join(f"{i}:{k}" for i in order)) for k, order in enumerate(orders)]
    rows_ = parse_lines_by_name(spark.createDataFrame(lines, "file_name string, pos long, line string").repartition(4), INSTITUTIONS)
    assert set(rows_.columns) == {"file_name", "cnpj", "nome", "nome_2", "uf", "municipio", "e_mail", "telefone", "percent_capital"}
    got = {r["file_name"]: r for r in rows_.collect()}
    assert len(got) == len(set(orders)) == 12_000
    for k in (0, 777, 11_999):
        r = got[f"{k:06d}"]
        twice = [i for i in orders[k] if names[i] == "Nome"]
        assert (r["cnpj"], r["percent_capital"], r["nome"], r["nome_2"]) == (f"0:{k}", f"7:{k}", *(f"{i}:{k}" for i in twice))


def test_a_write_that_fails_leaves_the_earlier_folders(spark, tmp_path, monkeypatch):
    from finfilings.operators import sinks
    from finfilings.vocab import BALANCE_IDS

    schema = "inst_type string, data string, documento int, cnpj string, nome_instituicao string, conta string, saldo decimal(38,10)"
    long = spark.createDataFrame([(t, "202312", 4010, "1", "A", "10", Decimal(k)) for k, t in enumerate(("BANCOS", "COOPERATIVAS"), 1)], schema)
    out = str(tmp_path / "out")
    sinks.write_wide_by_type(long, out, 4010, BALANCE_IDS)
    read = lambda: {t: spark.read.option("header", True).csv(f"{out}/4010_{t}.csv").first()["10"] for t in ("bancos", "cooperativas")}
    before = read()
    pivot = sinks.pivot_wide

    def broken(rows_, *args, **options):
        if rows_.first()["inst_type"] == "COOPERATIVAS":
            raise RuntimeError("lost")
        return pivot(rows_, *args, **options)

    monkeypatch.setattr(sinks, "pivot_wide", broken)
    try:
        sinks.write_wide_by_type(long.withColumn("saldo", F.col("saldo") + 5), out, 4010, BALANCE_IDS)
    except RuntimeError:
        pass
    assert read() == before
    monkeypatch.setattr(sinks, "pivot_wide", pivot)
    sinks.write_wide_by_type(long.withColumn("saldo", F.col("saldo") + 5), out, 4010, BALANCE_IDS)
    assert {t: float(v) for t, v in read().items()} == {t: float(v) + 5 for t, v in before.items()}
