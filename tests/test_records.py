"""Records over line breaks, in files and over splits, and members of archives."""

import io
import os
import random
import re
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import finfilings
from finfilings.plans import balances
from finfilings.sources import records, zipped
from finfilings.sources.delimited import BALANCES, parse_lines_by_name, parse_payloads_by_name
from finfilings.sources.landing import file_lines, file_payloads
from tests.conftest import rows


def read_plainly(text, sep):
    """Records and whether they end in a cell that is never closed, cell by cell."""
    quoted = re.compile(rf'[ \t]*+"[^"]*+(?:""[^"]*+)*+"[ \t]*+(?={sep}|\n|\Z)')
    left_open = re.compile(r'[ \t]*+"[^"\n]*+(?:""[^"\n]*+)*+(?=\n|\Z)')
    other = re.compile(rf"[^{sep}\n]*+")
    out, at = [], 0
    while at <= len(text):
        begin, broken = at, False
        while True:
            if m := quoted.match(text, at):
                at = m.end()
            elif m := left_open.match(text, at):
                broken, at = True, m.end()
            else:
                at = other.match(text, at).end()
            if at == len(text) or text[at] == "\n":
                break
            at += 1
        out.append((text[begin:at], broken))
        at += 1
    return out


def odd_files(seed, n=40):
    r = random.Random(seed)
    out = {}
    for k in range(n):
        sep, lines = r.choice(";,"), []
        for _ in range(r.randint(1, 25)):
            cells = [r.choice(["a", 'b"c', '"x"', '"x;y,z"', '""', '"a""b"', '"x;"', '";,"', "12", ' "q" ', '"z"z', ""]) for _ in range(r.randint(1, 4))]
            chance = r.random()
            if chance < 0.35:
                cells[-1] = r.choice(['"open', '"op;en,', '  "op""en', '"'])
            if 0.3 < chance < 0.6:
                cells[0] = r.choice(['mid"', 'close" ', 'a;b"', 'a,b"', 'x""y"', 'no"t', '"', '""'])
            lines.append(sep.join(cells))
        out[f"{k:03d}"] = (sep, lines)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_records_are_those_of_a_plain_reader_at_any_split(spark, monkeypatch, seed):
    files, r = odd_files(seed), random.Random(seed)
    want = sorted((name, *x) for name, (sep, lines) in files.items() for x in read_plainly("\n".join(lines), sep))
    numbered = [(name, k, line, sep, 7) for name, (sep, lines) in files.items() for k, line in enumerate(lines)]
    split = []
    for name, (sep, lines) in files.items():
        at = 0
        for k, line in enumerate(lines):
            at += 10 * (r.random() < 0.3)
            split.append((name, (at, k), line, sep, 7))
    monkeypatch.setattr(records, "PIECE_BITS", 1)
    for schema, data in (("long", numbered), ("struct<split:long,row:long>", split)):
        frame = spark.createDataFrame(data, f"file_name string, pos {schema}, line string, sep string, at int").repartition(4)
        got = records.join_records(frame, F.col("sep")).collect()
        assert sorted((x["file_name"], x["line"], x["broken"] is not None) for x in got) == want
    texts = spark.createDataFrame([(name, "\n".join(lines), sep) for name, (sep, lines) in files.items()], "file_name string, text string, sep string")
    found = texts.select("file_name", "sep", F.explode(records.split_records(F.col("text"), F.col("sep"))).alias("line"))
    found = found.select("file_name", "line", records.broken_record(F.col("line"), F.col("sep")).isNotNull().alias("broken"))
    kept = lambda x: sorted(t for t in x if t[1])  # noqa: E731  blank lines are passed over
    assert kept(tuple(x) for x in found.collect()) == kept(want)


HEAD = "banner with a \"\n#DATA_BASE;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;SALDO;EXTRA\n"
BODY = '''202312;4010;1;"BANCO
UM";10000007;1,00;x
202312;4010;2;"BANCO; ""DOIS""


DE TUDO" ;10000007;2,00;"y
z"
202312;4010;3;"NEVER CLOSED;10000007;3,00;x
202312;4010;4;PLAIN;10000007;4,00;x
202312;4016;5;"A
B";10000007;5,00
202312;4010;6;"ALSO
NEVER;10000007;6,00;x
'''
SOUND = [
    ("00000001", "BANCO\nUM", Decimal("1.00")), ("00000002", 'BANCO; "DOIS"\n\n\nDE TUDO', Decimal("2.00")),
    ("00000004", "PLAIN", Decimal("4.00")), ("00000005", "A\nB", Decimal("5.00")),
]


@pytest.mark.parametrize("whole,split", [(1 << 20, "128m"), (0, "128m"), (0, "64"), (0, "150")])
def test_breaks_read_alike_whole_and_by_line(spark, tmp_path, whole, split):
    (tmp_path / "202312BANCOS.CSV").write_text(HEAD + BODY)
    (tmp_path / "202311BANCOS.CSV").write_text(HEAD + "202311;4010;9;PLAIN;1;9,00;x\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got, rejects = finfilings.read_balance_sheets(spark, str(tmp_path), whole)
        assert rows(got.where("data = '202312'").select("cnpj", "nome_instituicao", "saldo")) == SOUND
        assert rows(rejects) == [
            ("202312BANCOS.CSV", "a quote is never closed", '202312;4010;3;"NEVER CLOSED;10000007;3,00;x'),
            ("202312BANCOS.CSV", "a quote is never closed", '202312;4010;6;"ALSO'),
        ]
        imported = finfilings.import_balance_sheets(spark, str(tmp_path), whole, document=4010)
        assert rows(imported.select("cnpj")) == [("00000001",), ("00000002",), ("00000004",), ("00000009",)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_breaks_with_all_columns_by_name(spark, tmp_path):
    (tmp_path / "202312BANCOS.CSV").write_text(HEAD + BODY)
    for found in (parse_payloads_by_name(file_payloads(spark, str(tmp_path)), BALANCES), parse_lines_by_name(file_lines(spark, str(tmp_path)), BALANCES)):
        assert rows(found.select("cnpj", "extra")) == [("1", "x"), ("2", "y\nz"), ("4", "x"), ("5", None), ("6,00", None)]


def test_a_record_of_too_many_lines_is_broken(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "RECORD_LINES", 20)
    (tmp_path / "202312BANCOS.CSV").write_text(HEAD + '202312;4010;1;"A' + "\n" * 30 + '";1;1,00;x\n202312;4010;2;B;1;2,00;x\n')
    for whole in (0, 1 << 20):
        got, rejects = finfilings.read_balance_sheets(spark, str(tmp_path), whole)
        assert rows(got.select("cnpj")) == [("00000002",)]
        assert rows(rejects.select("reason", "record")) == [("a quoted cell over 31 lines", '202312;4010;1;"A')]


def zipped_file(members, method=zipfile.ZIP_DEFLATED, spoil=None):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", method) as bundle:
        for name, content in members.items():
            bundle.writestr(name, content)
    raw = bytearray(data.getvalue())
    if spoil:
        raw[raw.find(spoil.encode()) + len(spoil) + 20] ^= 0x55
    return bytes(raw)


@pytest.mark.parametrize("slice_bytes,bits", [(1 << 20, 20), (4000, 11)])
def test_members_come_back_whole_whatever_the_slices(spark, tmp_path, monkeypatch, slice_bytes, bits):
    monkeypatch.setattr(zipped, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(zipped, "BUCKET_BITS", bits)
    r, want = random.Random(3), {}
    for k in range(3):
        members = {f"dir/m{m}é.csv": os.urandom(60_000) if m == 2 else bytes(r.choice(b"abc\n\r;0") for _ in range(r.choice([0, 3, 9000]))) for m in range(2 * k)}
        (tmp_path / f"a{k}.zip").write_bytes(zipped_file({"dir/": b"", **members}, zipfile.ZIP_DEFLATED if k % 2 else zipfile.ZIP_STORED))
        want |= {(f"a{k}.zip", name): content for name, content in members.items()}
    damaged = zipped_file({"good.csv": "x;y\n" * 500, "bad.csv": bytes(r.choice(b"0123456789;") for _ in range(5000))}, spoil="bad.csv")
    (tmp_path / "damaged.ZIP").write_bytes(b"bytes before it" + damaged + b"\n")
    want["damaged.ZIP", "good.csv"] = b"x;y\n" * 500
    (tmp_path / "none.zip").write_bytes(b"not a zip\n")
    (tmp_path / "cut.zip").write_bytes(damaged[:200])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        for largest in (None, 1000):
            members, payloads, lines = zipped.unpack(spark, str(tmp_path), "*.[zZ][iI][pP]", largest)
            bad = {(x["archive"], x["member"]) for x in members.where("error is not null").collect()}
            assert bad == {("damaged.ZIP", "bad.csv"), ("none.zip", None), ("cut.zip", None)}
            assert members.where("error is null").count() == len(want)
            small = {k: v for k, v in want.items() if largest is None or len(v) <= largest}
            assert {(x["archive"], x["member"]): bytes(x["content"]) for x in payloads.collect()} == small
            got = {}
            for x in lines.orderBy("archive", "member", "pos").collect():
                got.setdefault((x["archive"], x["member"]), []).append(bytes(x["raw"]))
            assert got == {k: [y.rstrip(b"\r\n") for y in io.BytesIO(v)] for k, v in want.items() if k not in small}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("whole", [0, 1 << 20])
def test_a_damaged_form_gives_way_and_equal_forms_count_once(spark, tmp_path, whole):
    text = "#DATA_BASE;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;SALDO\n" + "".join(f"202312;4010;{k};B;1;{k},00\n" for k in range(5))
    (tmp_path / "202312BANCOS.CSV").write_text(text)
    (tmp_path / "202312BANCOS.CSV.ZIP").write_bytes(zipped_file({"202312BANCOS.CSV": text}, spoil="202312BANCOS.CSV"))
    older = text.replace("202312", "202311")
    for name in ("one.zip", "two.zip"):
        (tmp_path / name).write_bytes(zipped_file({"202311BANCOS.CSV": older}))
    got = finfilings.import_balance_sheets(spark, str(tmp_path), whole)
    assert rows(got.groupBy("data").count()) == [("202311", 5), ("202312", 5)]
    reasons = {r["file_name"]: r["reason"] for r in balances.balance_rejects(spark, str(tmp_path), whole).collect()}
    assert list(reasons) == ["202312BANCOS.CSV.ZIP"] and reasons["202312BANCOS.CSV.ZIP"].startswith("202312BANCOS.CSV: ")
    with pytest.raises(ValueError, match="one.zip/202311BANCOS.CSV, two.zip"):
        balances.long_balances(spark, str(tmp_path), whole_file_bytes=whole)
