"""Institution lists, indicators and acts from landed files."""

import io
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import finfilings
from finfilings.operators import acts
from finfilings.plans import indicators, institutions, normative
from finfilings.sources import indicators as payloads
from finfilings.sources import pages
from finfilings.vocab import REGISTRY_COLUMNS, VALUE_COLUMNS
from tests.conftest import rows

LIST = """RELAÇÃO DE INSTITUIÇÕES
CNPJ,NOME INSTITUIÇÃO,UF
00.000.001,COOP A,SP
12.345.678/0001-90,"COOP B, MG",MG
,COOP SEM CNPJ,RJ
FONTE: X,,
"""


def workbook(table, shared=False):
    """A minimal .xlsx; with ``shared`` the texts live in the shared table."""
    texts, xml = [], []
    for r, values in enumerate(table, 1):
        cells = []
        for c, v in enumerate(values):
            ref = f"{chr(65 + c)}{r}"
            if v is None:
                continue
            if shared:
                cells.append(f'<c r="{ref}" t="s"><v>{len(texts)}</v></c>')
                texts.append(v)
            else:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>')
        xml.append(f'<row r="{r}">{"".join(cells)}</row>')
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as book:
        book.writestr("xl/workbook.xml", '<workbook xmlns:r="urn:r"><sheets><sheet name="L" r:id="rId7"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId7" Target="/xl/worksheets/s.xml"/></Relationships>')
        book.writestr("xl/worksheets/s.xml", f"<worksheet><sheetData>{''.join(xml)}</sheetData></worksheet>")
        if shared:
            book.writestr("xl/sharedStrings.xml", "<sst>" + "".join(f"<si><r><t>{t}</t></r></si>" for t in texts) + "</sst>")
    return data.getvalue()


@pytest.fixture
def lists(tmp_path):
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    (tmp_path / "202312COOPERATIVAS.csv").write_text(LIST)
    (deep / "202401COOPERATIVAS.csv").write_text("CNPJ,Situação\n00.000.009,ok\n")
    table = [["TITULO"], ["CNPJ", "NOME INSTITUIÇÃO"], ["11.111.111", "BANCO Z"], ["FONTE: Y"], [None, "sem cnpj"]]
    (deep / "202312BANCOS.xlsx").write_bytes(workbook(table))
    (tmp_path / "202401BANCOS.xlsx").write_bytes(workbook(table, shared=True))
    (tmp_path / "202402BANCOS.xls").write_bytes(b"\xd0\xcf\x11\xe0 old format")
    (tmp_path / "202403BANCOS.csv").write_text("nothing here\n")
    (tmp_path / "202404BANCOS.CSV").write_text(LIST)
    return tmp_path


def test_tidy_institutions(spark, lists, tmp_path):
    tables = finfilings.tidy_institutions(spark, str(lists), str(tmp_path / "out"))
    assert sorted(tables) == ["BANCOS", "COOPERATIVAS"]
    coop = tables["COOPERATIVAS"]
    assert {"nome_instituicao", "uf", "situacao"} <= set(coop.columns)
    assert rows(coop.select("data", "cnpj", "cnpj_num", "nome_instituicao", "uf", "situacao")) == [
        ("202312", "00000001", 1.0, "COOP A", "SP", None),
        ("202312", "12345678000190", None, "COOP B, MG", "MG", None),
        ("202401", "00000009", 9.0, None, None, "ok"),
    ]
    assert rows(tables["BANCOS"].select("data", "cnpj", "nome_instituicao")) == [
        ("202312", "11111111", "BANCO Z"), ("202401", "11111111", "BANCO Z"),
    ]
    written = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert rows(written.groupBy("safe_name").count()) == [("BANCOS", 2), ("COOPERATIVAS", 3)]


def test_upper_case_extension_is_an_option(spark, lists):
    assert institutions.read_institutions(spark, str(lists), ignore_case=True).where("institution = 'BANCOS'").count() == 4


def test_institution_rejects(spark, lists):
    found = {r["file_name"].rsplit("/", 1)[-1]: r["reason"] for r in institutions.institution_rejects(spark, str(lists)).collect()}
    assert found["202403BANCOS.csv"] == "no header line"
    assert "BadZipFile" in found["202402BANCOS.xls"]
    assert set(found) == {"202403BANCOS.csv", "202402BANCOS.xls"}


def test_no_lists_give_an_empty_dict(spark, tmp_path):
    (tmp_path / "x.txt").write_text("x")
    assert finfilings.tidy_institutions(spark, str(tmp_path)) == {}


def test_institution_landing_report(spark, tmp_path):
    (tmp_path / "COOPERATIVAS_202311.zip").write_bytes(b"broken")
    (tmp_path / "202312COOPERATIVAS.csv").write_text(LIST)
    with pytest.warns(UserWarning, match="FOO"):
        report = finfilings.get_institutions(spark, str(tmp_path), ["cooperativas", "foo"], "202311", "2024-01-31")
    assert {r["period"]: r["success"] for r in report.collect()} == {"202311": False, "202312": True, "202401": False}


# --- indicators ---------------------------------------------------------------------


@pytest.fixture
def values_folder(tmp_path):
    header = ",".join(VALUE_COLUMNS)
    for period in ("202406", "202412"):
        lines = [f'{t},{c},{period},"Resumo, geral",1,,{c}0,Ativo Total,"soma ""x""",{v}' for t, c, v in ((1, 7, "1234.5"), (3, 8, "-0.01"), (3, 9, ""))]
        (tmp_path / f"values_{period}.csv").write_text("\n".join([header, *lines]) + "\n")
    return str(tmp_path)


def test_values_from_files(spark, values_folder):
    table = finfilings.get_ifdata_values(spark, values_folder, 2024, [6, 12], 3)
    assert table.columns[:3] == ["tipo_instituicao", "cnpj", "ano_mes"]
    assert rows(table.select("ano_mes", "cnpj", "saldo_raw", "saldo", "nome_relatorio", "descricao_coluna", "grupo"))[0] == (
        "202406", "8", "-0.01", Decimal("-0.01"), "Resumo, geral", 'soma "x"', None,
    )
    assert table.count() == 4


def test_landed_values_prune_partitions_and_columns(spark, values_folder, tmp_path):
    table = finfilings.get_ifdata_values(spark, values_folder, 2024, [6, 12], [1, 3])
    out = indicators.land_values(table, str(tmp_path / "landed"))
    read = indicators.landed_values(spark, out, 2024, 12, 1, ["cnpj", "saldo"])
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<cnpj:string,saldo:decimal(38,10)>" in text
    assert "PartitionFilters: [" in text and "ano_mes" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert rows(read) == [("7", Decimal("1234.50"))]


def test_values_arguments_are_checked(spark, values_folder):
    with pytest.raises(ValueError):
        finfilings.get_ifdata_values(spark, values_folder, 2024, 13)
    with pytest.raises(ValueError):
        finfilings.get_ifdata_values(spark, values_folder, 2024, 12, 5)
    with pytest.warns(UserWarning):
        finfilings.get_ifdata_values(spark, values_folder, 1999, 12)


def test_registry(spark, tmp_path):
    (tmp_path / "r.csv").write_text(",".join(REGISTRY_COLUMNS) + "\n" + "1,202412,Banco São,1999,b1,1,2,S1,Banco,SP,São Paulo,S2,,C1,00000001,A\n")
    table = finfilings.get_ifdata_registry(spark, str(tmp_path), 2024, 12)
    row = table.first()
    assert row["cod_inst"] == "1" and row["municipio"] == "São Paulo" and row["cod_conglomerado_financeiro"] is None
    assert len(table.columns) == 16


def test_unanswered_and_corrupt_payloads(spark):
    answers = spark.createDataFrame([("a", 200), ("b", 404), ("c", None)], "file_name string, status int")
    assert rows(payloads.answered(answers).select("file_name")) == [("a",)]
    assert rows(payloads.unanswered(answers)) == [("b", "status 404"), ("c", "status unknown")]


# --- acts -----------------------------------------------------------------------------

PAGE = """{"TotalRows": 2, "Rows": [
  {"TipodoNormativoOWSCHCS": "Comunicado", "NumeroOWSNMBR": "41234.0000000000",
   "RefinableString01": "string;#Comunicado", "RefinableString03": "string;#Ativo",
   "AssuntoNormativoOWSMTXT": "<p>Divulga <b>taxa</b></p>", "HitHighlightedSummary": "x <c0>y</c0>",
   "Data1OWSDATE": "2025-01-03T00:00:00Z"},
  {"TipodoNormativoOWSCHCS": "Resolução", "NumeroOWSNMBR": "12", "Data1OWSDATE": "2025-01-05T00:00:00Z", "AssuntoNormativoOWSMTXT": "Outra TAXA"},
  {"TipodoNormativoOWSCHCS": "Resolução", "NumeroOWSNMBR": "13", "Data1OWSDATE": "2026-01-05T00:00:00Z", "AssuntoNormativoOWSMTXT": "taxa"}]}"""


@pytest.fixture
def act_pages(spark):
    data = [("p1", PAGE), ("p2", '{"TotalRows": 0, "Rows": []}'), ("p3", "<html>"), ("p4", '{"TotalRows": 0}')]
    return spark.createDataFrame(data, "file_name string, payload string")


def test_normative_data(spark, act_pages):
    found = finfilings.get_normative_data(act_pages, ["Taxa", "juros"], "2025-01-01", "2025-12-31")
    got = [(r["TipodoNormativoOWSCHCS"], r["NumeroOWSNMBR"], r["RefinableString01"], r["RefinableString03"], r["AssuntoNormativoOWSMTXT"], r["HitHighlightedSummary"]) for r in found.collect()]
    assert got == [
        ("Resolução", "12", None, None, "Outra TAXA", None),
        ("Comunicado", "41234", "Comunicado", "Ativo", "Divulga taxa", "x y"),
    ]


def test_bad_pages(spark, act_pages):
    assert rows(pages.bad_pages(act_pages)) == [("p3", "not a JSON payload")]
    assert rows(act_pages.select(pages.total_rows(F.col("payload"))))[-1] == (2,)


def test_normative_txt(spark, act_pages):
    found = finfilings.get_normative_data(act_pages, "taxa", "2025-01-01", "2025-12-31")
    landed = spark.createDataFrame(
        [("Comunicado", "41234", '{"conteudo": [{"Assunto": "<p>A&amp;B</p>", "Texto": "<div>um\\n dois</div><div>três&nbsp; </div>"}]}')],
        f"{normative.TYPE} string, {normative.NUMBER} string, payload string",
    )
    got = finfilings.get_normative_txt(found, landed).select(normative.NUMBER, "Assunto", "Texto")
    assert rows(got) == [("12", None, None), ("41234", "A&B", "um doistrês")]


def test_row_numbers_are_whole_and_ordered(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("k"), F.col("id"))
    got = acts.paged(df, [F.col("k").desc(), "id"]).orderBy("row_number").collect()
    assert [r["row_number"] for r in got] == list(range(1, 10_001))
    assert [(r["k"], r["id"]) for r in got] == sorted(((i % 3, i) for i in range(10_000)), key=lambda x: (-x[0], x[1]))
    assert {r["start_row"] for r in got} == set(range(0, 10_000, 500))
