"""Balance files on disk, from landing to the wide table."""

import io
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import finfilings
from finfilings.plans import balances, institutions
from finfilings.sources.delimited import BALANCES, parse_lines, parse_payloads
from finfilings.sources.landing import file_lines, file_payloads, list_files, name_collisions
from finfilings.streaming.landing import stream_balances
from tests.conftest import rows

FIRST = '''Some banner line
Another banner; with a delimiter CONTA SALDO DOCUMENTO

#DATA_BASE;DOCUMENTO;CNPJ;AGENCIA;NOME_INSTITUICAO;CONTA;NOME_CONTA;SALDO
202312;4010;00000001;0;BANCO SÃO JOÃO;10000007;ATIVO;1234,56
202312;4010;00000001;0;BANCO SÃO JOÃO;20000004;PASSIVO;-10,00
202312;4010;208;0;"BANCO; B";10000007;ATIVO;5,00
202312;4016;00000208;0;"BANCO ""B""";10000007;ATIVO;
'''
OLD = """Relatorio
"DATA BASE" ,DOCUMENTOS,CNPJ, "NOME INSTITUICAO",ATRIBUTO,CONTA,SALDO
202306,4010,33,COOP X,A,10000007,7.25\r
\r
202306,4010,34,"COOP, Y",A,30000001,NA\r
"""
BLANKS = "data_base documento cnpj conta saldo\n202212  4010 5 10000007   1.5\n"


@pytest.fixture
def folder(tmp_path):
    def put(name, text):
        (tmp_path / name).write_bytes(text.encode("latin-1") if isinstance(text, str) else text)

    put("202312BANCOS.CSV", FIRST)
    put("202306_COOPERATIVAS.csv", OLD)
    put("202212BANCOS.csv", BLANKS)
    put("202301BANCOS.CSV", "no header here\n1;2;3\n")
    put("202302BANCOS.CSV", "\n  \n")
    put("readme.csv", FIRST)
    put("notes.txt", FIRST)
    put.path = str(tmp_path)
    return put


LONG = [
    ("BANCOS", "202212", 4010, "00000005", None, "10000007", Decimal("1.50")),
    ("BANCOS", "202312", 4010, "00000001", "BANCO SÃO JOÃO", "10000007", Decimal("1234.56")),
    ("BANCOS", "202312", 4010, "00000001", "BANCO SÃO JOÃO", "20000004", Decimal("-10.00")),
    ("BANCOS", "202312", 4010, "00000208", "BANCO; B", "10000007", Decimal("5.00")),
    ("BANCOS", "202312", 4016, "00000208", 'BANCO "B"', "10000007", None),
    ("COOPERATIVAS", "202306", 4010, "00000033", "COOP X", "10000007", Decimal("7.25")),
    ("COOPERATIVAS", "202306", 4010, "00000034", "COOP, Y", "30000001", None),
]


def long_rows(df):
    return rows(df.select("inst_type", "data", "documento", "cnpj", "nome_instituicao", "conta", "saldo"))


def test_import_small_files(spark, folder):
    assert long_rows(finfilings.import_balance_sheets(spark, folder.path)) == LONG


def test_import_as_lines_gives_the_same(spark, folder):
    assert long_rows(finfilings.import_balance_sheets(spark, folder.path, whole_file_bytes=0)) == LONG


def test_import_mixed_sizes_gives_the_same(spark, folder):
    assert long_rows(finfilings.import_balance_sheets(spark, folder.path, whole_file_bytes=200)) == LONG


@pytest.mark.parametrize("whole", [0, 1 << 20])
def test_byte_order_mark_is_not_part_of_a_name(spark, tmp_path, whole):
    text = "DATA_BASE;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;SALDO\n202312;4010;1;X;1;2,00\n"
    (tmp_path / "202312BANCOS.CSV").write_bytes(b"\xef\xbb\xbf" + text.encode())
    got = finfilings.import_balance_sheets(spark, str(tmp_path), whole)
    assert rows(got.select("data", "saldo")) == [("202312", Decimal("2.00"))]


def test_large_file_over_many_splits(spark, tmp_path):
    body = "".join(f"202312;4010;{i};BANCO SÃO;{i % 7};{i},10\n" for i in range(20_000))
    text = "banner\n#DATA_BASE;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;SALDO\n" + body
    (tmp_path / "202312BANCOS.CSV").write_bytes(text.encode("latin-1"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        lines = file_lines(spark, str(tmp_path), charset="ISO-8859-1")
        assert lines.rdd.getNumPartitions() > 5
        got = balances.balances_from_lines(lines, 4010).agg(F.count("*"), F.countDistinct("cnpj"), F.sum("saldo")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tuple(got) == (20_000, 20_000, Decimal(sum(range(20_000))) + Decimal("2000.00"))


def test_rejects(spark, folder):
    folder("202303BANCOS.zip", b"not a zip")
    expected = [
        ("202301BANCOS.CSV", "no header line"), ("202302BANCOS.CSV", "empty file"), ("202303BANCOS.zip",),
        ("readme.csv", "file name is not YYYYMM and a type"),
    ]
    found = {r["file_name"]: r["reason"] for r in balances.balance_rejects(spark, folder.path).collect()}
    for row in expected:
        assert row[0] in found
        assert len(row) == 1 or found[row[0]] == row[1]
    as_lines = {r["file_name"]: r["reason"] for r in balances.balance_rejects(spark, folder.path, 0).collect()}
    assert as_lines == found
    # a file with rows is no reject; what it lacks is told apart
    assert "202212BANCOS.csv" not in found
    gaps = [(r["file_name"], r["reason"]) for r in balances.balance_gaps(spark, folder.path).collect()]
    assert gaps == [("202212BANCOS.csv", "missing columns: NOME_INSTITUICAO")]


@pytest.mark.parametrize("setting,value", [
    ("spark.sql.files.minPartitionNum", "2"), ("spark.sql.files.minPartitionNum", "64"),
    ("spark.sql.leafNodeDefaultParallelism", "3"), ("spark.sql.files.maxPartitionBytes", "32k"),
])
def test_no_row_is_lost_when_the_splits_change_later(spark, tmp_path, setting, value):
    lists = tmp_path / "lists"
    lists.mkdir()
    head = "#DATA_BASE;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;SALDO\n"
    for k in range(3):
        (tmp_path / f"20231{k}BANCOS.CSV").write_text("banner\n" + head + "".join(f"20231{k};4010;{i};B;{i % 7};1,00\n" for i in range(4_000)))
        (lists / f"20231{k}BANCOS.csv").write_text("Lista\nCNPJ,NOME\n" + "".join(f"{i},B\n" for i in range(4_000)))
    long = finfilings.import_balance_sheets(spark, str(tmp_path), whole_file_bytes=0)
    listed = institutions.read_institutions(spark, str(lists))
    before = spark.conf.get(setting, None)
    try:
        spark.conf.set(setting, value)
        assert (long.count(), listed.count()) == (12_000, 12_000)
    finally:
        spark.conf.set(setting, before) if before else spark.conf.unset(setting)


@pytest.mark.parametrize("whole", [0, 1 << 20])
def test_a_period_in_several_forms_is_read_once(spark, folder, whole):
    import io
    import zipfile

    def zipped(member, text):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as bundle:
            bundle.writestr(member, text.encode("latin-1"))
        return data.getvalue()

    folder("202312_BANCOS.CSV.ZIP", zipped("202312BANCOS.CSV", FIRST))
    folder("202306COOPERATIVAS.ZIP", zipped("202306_COOPERATIVAS.csv", OLD))
    folder("202212BANCOS.CSV.ZIP", b"not a zip")
    got = finfilings.import_balance_sheets(spark, folder.path, whole)
    assert long_rows(got) == LONG
    assert {r[0] for r in got.select("file_name").distinct().collect()} == {"202312BANCOS.CSV", "202306_COOPERATIVAS.csv", "202212BANCOS.csv"}


def test_two_documents_in_one_folder_stay_apart(spark, folder, tmp_path):
    out = str(tmp_path.parent / f"{tmp_path.name}-out")
    first = finfilings.tidy_balance_sheets(spark, folder.path, out, doc_filter=4010, on_duplicate="first")
    second = finfilings.tidy_balance_sheets(spark, folder.path, out, doc_filter=4016, on_duplicate="first")
    assert set(second) == {"BANCOS"} and set(first) == {"BANCOS", "COOPERATIVAS"}
    assert {r["documento"] for df in first.values() for r in df.collect()} == {4010}
    assert {r["documento"] for df in second.values() for r in df.collect()} == {4016}


def test_a_type_without_a_required_column_fails(spark, tmp_path):
    (tmp_path / "202312BANCOS.CSV").write_text("DATA_BASE;DOCUMENTO;CNPJ;CONTA;SALDO\n202312;4010;1;1;2,00\n")
    with pytest.raises(ValueError, match="BANCOS: nome_instituicao"):
        finfilings.tidy_balance_sheets(spark, str(tmp_path), save=False)


def test_tidy_writes_one_folder_per_type(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    tables = finfilings.tidy_balance_sheets(spark, folder.path, out, 4010)
    assert sorted(tables) == ["BANCOS", "COOPERATIVAS"]
    wide = tables["BANCOS"].where("data = '202312'")
    assert rows(wide.select("data", "documento", "cnpj", "nome_instituicao", "10000007", "20000004")) == [
        ("202312", 4010, "00000001", "BANCO SÃO JOÃO", Decimal("1234.56"), Decimal("-10.00")),
        ("202312", 4010, "00000208", "BANCO; B", Decimal("5.00"), None),
    ]
    back = spark.read.option("header", True).csv(out + "/4010_bancos.csv")
    assert back.count() == 3 and "20000004" in back.columns
    assert spark.read.option("header", True).csv(out + "/4010_cooperativas.csv").count() == 2


def test_tidy_without_saving(spark, folder):
    tables = finfilings.tidy_balance_sheets(spark, folder.path, doc_filter=4016, save=False)
    assert list(tables) == ["BANCOS"]


def test_duplicate_cell_fails_by_default(spark, folder):
    folder("202311BANCOS.CSV", FIRST.replace("20000004", "10000007"))
    long = balances.long_balances(spark, folder.path)
    with pytest.raises(Exception, match="several rows for one cell"):
        balances.wide_balances(long).collect()
    summed = balances.wide_balances(long.where("cnpj = '00000001'"), on_duplicate="sum").where("data = '202312'")
    assert summed.first()["10000007"] == Decimal("2459.12")


def test_colliding_names_fail(spark, folder):
    folder("202312_BANCOS.CSV", FIRST)
    assert rows(name_collisions(list_files(spark, folder.path))) == [
        ("202312BANCOS.CSV", "202312BANCOS.CSV", 2), ("202312BANCOS.CSV", "202312_BANCOS.CSV", 2),
    ]
    with pytest.raises(ValueError, match="202312_BANCOS.CSV"):
        balances.long_balances(spark, folder.path)


def test_no_files_fails(spark, tmp_path):
    (tmp_path / "x.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        balances.long_balances(spark, str(tmp_path))


def zip_bytes(members):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as bundle:
        for name, text in members.items():
            bundle.writestr(name, text.encode("latin-1"))
    return data.getvalue()


def test_archives_are_read_and_kept(spark, tmp_path):
    (tmp_path / "202312_BANCOS.CSV.ZIP").write_bytes(zip_bytes({"202312BANCOS.CSV": FIRST}))
    long = balances.long_balances(spark, str(tmp_path))
    assert long.count() == 3
    assert long_rows(balances.long_balances(spark, str(tmp_path), whole_file_bytes=0)) == long_rows(long)
    assert (tmp_path / "202312_BANCOS.CSV.ZIP").exists()


def test_landing_report(spark, tmp_path):
    (tmp_path / "202206_BANCOS.CSV.ZIP").write_bytes(zip_bytes({"202206BANCOS.CSV": FIRST}))
    (tmp_path / "202212_BANCOS.CSV.ZIP").write_bytes(b"broken")
    (tmp_path / "202306BANCOS.CSV").write_text(FIRST)
    report = finfilings.get_balance_sheets(spark, str(tmp_path), "bancos", [6, 12], 2022, 2023)
    got = {(r["year"], r["month"]): (r["success"], r["error"]) for r in report.collect()}
    assert got[(2022, 6)][0] and got[(2023, 6)][0]
    assert not got[(2022, 12)][0] and "BadZipFile" in got[(2022, 12)][1]
    assert got[(2023, 12)] == (False, "not landed")


def test_unknown_token_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="BAR, FOO"):
        finfilings.get_balance_sheets(spark, str(tmp_path), ["foo", "bancos", "bar"], 12, 2022, 2022)


def test_stream_reads_each_file_once(spark, folder, tmp_path):
    out, state = str(tmp_path / "table"), str(tmp_path / "state")
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "202312BANCOS.CSV").write_bytes(FIRST.encode("latin-1"))
    stream_balances(spark, str(landing), out, state).awaitTermination(120)
    assert spark.read.parquet(out).count() == 4
    (landing / "202306COOPERATIVAS.csv").write_bytes(OLD.encode("latin-1"))
    stream_balances(spark, str(landing), out, state).awaitTermination(120)
    table = spark.read.parquet(out)
    assert rows(table.groupBy("inst_type").count()) == [("BANCOS", 4), ("COOPERATIVAS", 2)]


def test_hot_file_without_broadcast(spark, monkeypatch):
    """One file with a third of all rows, headers joined by shuffle: no row is lost."""
    from finfilings.sources import delimited

    monkeypatch.setattr(delimited, "small_side", lambda df: df)
    hot = F.col("id") % 3 == 0
    name = F.when(hot, "202301").otherwise((200001 + F.col("id") % 90).cast("string"))
    lines = spark.range(30_000).select(
        F.concat(name, F.lit("BANCOS.CSV")).alias("file_name"), (F.col("id") + 10).alias("pos"),
        F.concat(F.lit("202301;4010;"), F.col("id").cast("string"), F.lit(";N;1;1,00")).alias("line"),
    )
    heads = lines.select("file_name").distinct().select(
        "file_name", F.lit(0).cast("bigint").alias("pos"), F.lit("DATA;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;SALDO").alias("line")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = balances.balances_from_lines(lines.unionByName(heads), 4010)
        assert got.agg(F.count("*"), F.countDistinct("cnpj")).first()[:] == (30_000, 30_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- plans -----------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_payload_parse_needs_no_shuffle_and_splits_once(spark, folder):
    payloads = file_payloads(spark, folder.path, max_bytes=1 << 20).select("file_name", "content")
    text = plan(parse_payloads(payloads, BALANCES, balances.COLUMNS).where("documento = '4010'"))
    assert "Exchange" not in text and "Join" not in text
    assert text.count("Contains(line#") == text.split("Generate explode(array(CASE WHEN (sep")[1].split("\n")[0].count("Contains(line#")


def test_size_bound_reaches_the_source(spark, folder):
    text = plan(file_payloads(spark, folder.path, max_bytes=100))
    assert "LessThanOrEqual(length,100)" in text


def test_line_parse_broadcasts_measured_headers(spark, folder):
    lines = file_lines(spark, folder.path, "*.[cC][sS][vV]")
    text = plan(parse_lines(lines, BALANCES, balances.COLUMNS))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
