"""What tasks hold and how work is dealt out, so that it grows no faster than the input."""

import io
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from finfilings.operators import reshape, sinks
from finfilings.plans import balances
from finfilings.sources import archives, records
from finfilings.sources.delimited import BALANCES, payload_headers
from tests.conftest import rows
from tests.test_records import odd_files


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().lower()


def test_a_wide_pivot_holds_no_rows_of_all_columns(spark):
    n = reshape.NARROW + 90
    data = [(k % 5 or None, f"a.{k % n}", k) for k in range(4 * n)] + [(7, None, 1), (8, "unwanted", 1)]
    df = spark.createDataFrame([(i, c, Decimal(v)) for i, c, v in data], "id int, conta string, saldo decimal(18,2)")
    values = sorted({x[1] for x in data if x[1] and x[1] != "unwanted"})
    wide = reshape.pivot_wide(df, ["id"], values=values, on_duplicate="sum")
    assert "pivotfirst" not in plan_of(wide) and wide.columns == ["id", *values]
    want = {}
    for key, name, value in data:
        row = want.setdefault(key, dict.fromkeys(values))
        if name in row:
            row[name] = (row[name] or 0) + value
    assert {r["id"]: r.asDict() for r in wide.collect()} == {k: {"id": k, **v} for k, v in want.items()}
    twice = spark.createDataFrame([(1, f"n{k}", 1) for k in range(n)] + [(1, "n3", 2)], "id int, conta string, saldo int")
    with pytest.raises(Exception, match="several rows for one cell: 1 / n3"):
        reshape.pivot_wide(twice, ["id"]).collect()
    assert rows(reshape.pivot_wide(twice, ["id"], on_duplicate="first").select("n3", "n4")) == [(1, 1)]
    numbers = spark.createDataFrame([(k % 2, k, k) for k in range(n)], "id int, conta int, saldo int")
    assert rows(reshape.pivot_wide(numbers, ["id"]).select("id", "`0`", "`1`", "`2`")) == [(0, 0, None, 2), (1, None, 1, None)]


def test_workbooks_of_a_small_table_are_printed_by_all_cores(spark, tmp_path, monkeypatch):
    from checks import filings

    spark.createDataFrame([(k, f"N{k}", k % 25, 1.0, "AUTO") for k in range(50)],
                          "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    seen, plain = [], filings._workbooks
    monkeypatch.setattr(filings, "_workbooks", lambda books: seen.append(books.rdd.getNumPartitions()) or plain(books))
    assert filings.institution_xlsx(spark, str(tmp_path)).count() == 50
    assert seen[0] >= spark.sparkContext.defaultParallelism


HEAD = "#DATA_BASE;DOCUMENTO;CNPJ;NOME_INSTITUICAO;CONTA;SALDO"


def test_partitioned_writes_do_not_sort_a_few_partitions(spark, tmp_path, monkeypatch):
    seen, plain = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: seen.append(spark.conf.get(sinks.CONCURRENT, "0")) or plain(self, *a, **b))
    df = spark.range(500).select("id", F.nullif(F.col("id") % 40, F.lit(3)).alias("k"))  # more partitions than files are kept open
    before = spark.conf.get(sinks.CONCURRENT, "0")
    for _ in range(2):
        sinks.land(df, f"{tmp_path}/t", ["k"])
    assert seen and all(int(n) > 0 for n in seen) and spark.conf.get(sinks.CONCURRENT, "0") == before
    assert rows(spark.read.parquet(f"{tmp_path}/t").select("id", "k")) == rows(df)


def test_archive_lines_leave_in_batches_of_bytes(spark):
    def zipped(members):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as bundle:
            for name, text in members.items():
                bundle.writestr(name, text)
        return data.getvalue()

    files = {f"{k}.zip": {"a.txt": f"x{k}\r\ny\n", "d/b.txt": "z" * k} for k in range(70)}
    payloads = spark.createDataFrame([*((n, bytearray(zipped(m))) for n, m in files.items()), ("bad.zip", bytearray(b"no")), ("none.zip", None)], "file_name string, content binary")
    lines = archives.expand_archive_lines(payloads.coalesce(1), batch_bytes=50).collect()
    want = {(n, m, i, x) for n, f in files.items() for m, t in f.items() for i, x in enumerate(t.split())}
    assert {(r["archive"], r["file_name"], r["pos"], bytes(r["raw"]).decode()) for r in lines if r["error"] is None} == want
    members = archives.expand_archives(payloads.coalesce(1), batch_bytes=50).collect()
    assert {(r["archive"], r["member"], bytes(r["content"]).decode()) for r in members if r["error"] is None} == {(n, m, t) for n, f in files.items() for m, t in f.items()}
    for found in (lines, members):
        assert {r["archive"] for r in found if r["error"] is not None} == {"bad.zip", "none.zip"}


def test_how_lines_behave_is_found_once(spark):
    lines = [(name, k, line, sep) for name, (sep, found) in odd_files(5, 4).items() for k, line in enumerate(found)]
    joined = records.join_records(spark.createDataFrame(lines, "file_name string, pos long, line string, sep string"), F.col("sep"))
    assert "rlike" not in plan_of(joined) and joined.count() > 0


def test_no_open_quote_of_a_text_is_missed(spark):
    texts = [(name, sep, "\n".join(lines)) for name, (sep, lines) in odd_files(6, 80).items()]
    df = spark.createDataFrame(texts, "file_name string, sep string, text string")
    opened = F.exists(F.split("text", "\n"), lambda line: records.opens(line, F.col("sep")))
    exact = F.exists(F.split("text", "\n"), lambda line: records._ends_inside(line, F.col("sep")))
    found = df.select(opened.alias("o"), exact.alias("e"), F.col("text").rlike(records.SOME_LEFT_OPEN).alias("s")).collect()
    assert {r["e"] for r in found} == {True, False}
    assert all(r["o"] == r["e"] and (r["s"] or not r["e"]) for r in found)


def test_a_header_behind_lines_that_hold_its_words_is_found(spark):
    decoy = "os DOCUMENTO, a CONTA e o SALDO"
    files = [("a", f"banner\n{decoy}\n{HEAD}\nx"), ("b", f"{HEAD}\nx\n{decoy}"), ("c", decoy), ("d", "nothing")]
    heads = payload_headers(spark.createDataFrame([(n, bytearray(t.encode())) for n, t in files], "file_name string, content binary"), BALANCES)
    assert rows(heads.select("file_name", "header")) == [("a", HEAD), ("b", HEAD)]
    assert "regexp_substr" in plan_of(heads) or "regexp_extract(" in plan_of(heads)


def test_whole_files_split_only_lines_of_the_document(spark):
    text = f'{HEAD}\n202312;4010;1;"A;\nB";1;1,00\n202312;4016;2;C;1;2,00\n202312;4010;3;D;1;4016,00\n202312;4016;4;"OPEN;1;1,00\n'
    payloads = spark.createDataFrame([("202312BANCOS.CSV", bytearray(text.encode()))], "file_name string, content binary")
    assert rows(balances.balances_from_payloads(payloads, document=4010).select("cnpj")) == [("00000001",), ("00000003",)]
    assert rows(balances.balances_from_payloads(payloads, True, 4016).where("reason is null").select("cnpj")) == [("00000002",)]
    assert balances.balances_from_payloads(payloads, True, 4010).where("reason is not null").count() == 1
