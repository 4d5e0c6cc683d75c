import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finfilings.functions import names, periods, text, values
from tests.conftest import rows


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw, clean", [
    ("NomeInstituicao", "nome_instituicao"), ("SegmentoTb", "segmento_tb"), ("NOME INSTITUIÇÃO", "nome_instituicao"),
    ("#X", "number_x"), ("% Total", "percent_total"), ("1x", "x1x"), ("CodInst", "cod_inst"), ("", "x"),
    ("CodConglomeradoFinanceiro", "cod_conglomerado_financeiro"), ("Nome  da (Rua)", "nome_da_rua"),
])
def test_clean_name(raw, clean):
    assert names.clean_name(raw) == clean


def test_unique_names():
    assert names.unique_names(["a", "a", "b", "a"]) == ["a", "a_2", "b", "a_3"]


@given(st.text(max_size=20))
@settings(max_examples=200, deadline=None)
def test_clean_name_is_stable(name):
    clean = names.clean_name(name)
    assert clean.isascii() and names.clean_name(clean) == clean


@pytest.mark.parametrize("printed, value", [
    ("1234,56", "1234.56"), ("1234.56", "1234.56"), ("1.234,56", "1234.56"), ("-10,00", "-10.00"), ("abc", None), ("", None), (None, None),
])
def test_parse_decimal(spark, printed, value):
    assert one(spark, printed, values.parse_decimal) == (None if value is None else Decimal(value))


@pytest.mark.parametrize("raw, number, digits", [
    ("12.345.678", 12345678.0, "12345678"), ("12.345.678/0001-90", None, "12345678000190"), ("00.000.001", 1.0, "00000001"),
])
def test_company_number(spark, raw, number, digits):
    assert one(spark, raw, values.cnpj_number) == number
    assert one(spark, raw, values.cnpj_digits) == digits


def test_pad_keeps_long_numbers(spark):
    assert one(spark, "208", values.pad_cnpj) == "00000208"
    assert one(spark, "12345678000190", values.pad_cnpj) == "12345678000190"


@pytest.mark.parametrize("raw, cell", [("NA", None), ("  ", None), (" a ", "a"), ("NAO", "NAO"), (None, None)])
def test_null_text(spark, raw, cell):
    assert one(spark, raw, values.null_text) == cell


@pytest.mark.parametrize("html, plain", [
    ("<p>A&amp;B</p>", "A&B"), ("<div>um\n dois</div><div>três&nbsp; </div>", "um doistrês"), ("<!-- c -->x", "x"),
    (None, None), ("<p>a<p>b", "ab"), ("plain  text", "plain text"), ("<script>var t='<p>';</script>z", "var t='<p>';z"),
    ("a &lt;b&gt; &#231;", "a <b> ç"),
])
def test_html_to_line(spark, html, plain):
    assert one(spark, html, text.html_to_line) == plain


def test_html_block_separator(spark):
    assert one(spark, "<p>a</p><p>b</p>", lambda c: text.html_to_line(c, " ")) == "a b"


def test_squish_knows_the_no_break_space(spark):
    assert one(spark, " a  \n b ", text.squish) == "a b"
    once = one(spark, " x \t y ", text.squish)
    assert one(spark, once, text.squish) == once


def test_scrubs(spark):
    assert one(spark, "string;#Comunicado", text.scrub_prefix) == "Comunicado"
    assert one(spark, "41234.0000000000", text.cut_decimal) == "41234"
    assert one(spark, "12", text.cut_decimal) == "12"
    assert one(spark, "x <c0>y</c0>", text.strip_tags) == "x y"


@pytest.mark.parametrize("arg, day", [
    ("202312", datetime.date(2023, 12, 1)), ("2023-12-31", datetime.date(2023, 12, 31)), ("202313", None), ("x", None),
])
def test_parse_month(spark, arg, day):
    assert one(spark, arg, periods.parse_month) == day


def test_months_between_from_day_31(spark):
    df = spark.sql("SELECT DATE'2023-12-31' AS a, DATE'2024-03-01' AS b")
    assert df.select(periods.months_between(F.col("a"), F.col("b"))).first()[0] == ["202312", "202401", "202402", "202403"]


def test_file_names(spark):
    df = spark.createDataFrame([("x/202312_BANCOS.CSV",), ("readme.csv",), ("202401coop.xlsx",)], "f string")
    plain = names.plain_file_name(F.col("f"))
    got = rows(df.select(names.file_period(plain), names.file_type(plain)))
    assert got == [(None, None), ("202312", "BANCOS"), ("202401", "COOP")]


def test_rename_matching_takes_the_first(spark):
    df = spark.createDataFrame([(1, 2)], "`DATA BASE` int, `#DATA_BASE` int")
    assert names.rename_matching(df, {"^(#)?DATA[_ ]?BASE$": "DATA"}).columns == ["DATA", "#DATA_BASE"]


def test_require_columns_lists_all_missing(spark):
    with pytest.raises(ValueError, match="conta, saldo"):
        names.require_columns(spark.range(1).withColumnRenamed("id", "data"), ["data", "conta", "saldo"])
