"""Grids, audits, reshaping and sinks on small fixtures."""

import datetime
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finfilings.operators import audit, grids, reshape, sinks
from finfilings.session import small_side
from tests.conftest import rows


def test_balance_grid(spark):
    grid = grids.balance_grid(spark, ["bancos", "BANCOS", "combinados"], [12, 6], 2022, 2023)
    assert grid.count() == 8
    assert grid.first().asDict() == {
        "year": 2022, "month": 6, "institution": "BANCOS", "month_text": "06", "label": "Bancos", "expected_name": "202206BANCOS.CSV",
    }


def test_institution_grid(spark):
    grid = grids.institution_grid(spark, "cooperativas", "202311", "2024-01-31")
    assert [r["expected_name"] for r in grid.collect()] == ["COOPERATIVAS_202311.zip", "COOPERATIVAS_202312.zip", "COOPERATIVAS_202401.zip"]
    with pytest.raises(ValueError):
        grids.institution_grid(spark, "cooperativas", "202401", "202312")


def test_arguments():
    assert grids.month_argument("202312") == datetime.date(2023, 12, 1)
    assert grids.month_argument("2023-12-31") == datetime.date(2023, 12, 31)
    with pytest.raises(ValueError):
        grids.month_argument("Dec 2023")
    with pytest.raises(ValueError, match="A, B"):
        grids.wanted_tokens(["x", "a", "b", "a"], ("X",))
    assert grids.wanted_tokens(["y", "X", "x"], ("X", "Y")) == ["X", "Y"]
    with pytest.warns(UserWarning, match="A"):
        assert grids.wanted_tokens(["x", "a"], ("X",), strict=False) == ["X"]
    with pytest.raises(ValueError), pytest.warns(UserWarning):
        grids.wanted_tokens(["a"], ("X",), strict=False)


@pytest.mark.parametrize("total, starts", [(0, []), (-1, []), (1, [0]), (499, [0]), (500, [0, 500]), (1001, [0, 500, 1000])])
def test_page_plan(spark, total, starts):
    plan = grids.page_plan(spark.createDataFrame([(total,)], "total_rows bigint"))
    assert [r["start_row"] for r in plan.collect()] == starts


def test_grid_has_no_join(spark):
    text = grids.values_grid(spark, [2023, 2024], [6, 12], [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Cartesian" not in text and "Exchange" not in text


def test_variant_choice(spark):
    data = [
        ("202312", "BANCOS", "a.ZIP", ".ZIP", True), ("202312", "BANCOS", "a.csv", ".csv", True), ("202312", "BANCOS", "a.CSV.ZIP", ".CSV.ZIP", False),
        ("202401", "BANCOS", "b.CSV", ".CSV", False),
    ]
    files = spark.createDataFrame(data, "period string, institution string, file_name string, suffix string, usable boolean")
    assert rows(audit.choose_variant(files)) == [("202312", "BANCOS", "a.csv", True, 3), ("202401", "BANCOS", "202401_BANCOS.CSV.ZIP", False, 1)]


def test_large_side_is_not_broadcast(spark):
    df = spark.range(100)
    assert "ResolvedHint" in small_side(df)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in small_side(df, max_bytes=10)._jdf.queryExecution().analyzed().toString()


cells = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", "c"]), st.integers(-5, 5) | st.none()), min_size=1, max_size=25)


@given(cells)
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_pivot_keeps_every_row(spark, data):
    df = spark.createDataFrame(data, "id int, conta string, saldo int")
    expected = defaultdict(int)
    for row in data:
        expected[row] += 1
    wide = reshape.pivot_wide(df, ["id"], values=["a", "b", "c"], on_duplicate="rows")
    got = {}
    for r in wide.collect():
        for name in "abc":
            if r[f"{name}_n"]:
                got[(r["id"], name, r[name])] = r[f"{name}_n"]
    assert got == dict(expected)


def test_wide_and_narrow_pivots_agree(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("id"), F.concat(F.lit("c"), (F.col("id") % 60).cast("string")).alias("conta"), F.col("id").alias("saldo"))
    wide = reshape.pivot_wide(df, ["id"], on_duplicate="sum")
    assert len(wide.columns) == 61
    back = reshape.unpivot_long(wide, ["id"])
    assert rows(back) == rows(df.groupBy("id", "conta").agg(F.sum("saldo").alias("saldo")))
    few = reshape.pivot_wide(df, ["id"], values=["c1", "c2"], on_duplicate="sum")
    assert rows(few) == rows(wide.select("id", "c1", "c2"))


def test_duplicates_fail_in_wide_pivots_too(spark):
    df = spark.range(120).select(F.lit(1).alias("id"), F.concat(F.lit("c"), (F.col("id") % 60).cast("string")).alias("conta"), F.col("id").alias("saldo"))
    with pytest.raises(Exception, match="several rows for one cell"):
        reshape.pivot_wide(df, ["id"]).collect()
    assert rows(reshape.duplicate_cells(df, ["id"], "conta"))[0][2] == 2


def test_vocabularies_are_checked_not_cut(spark):
    with pytest.raises(ValueError):
        reshape.distinct_values(spark.range(100), "id", max_values=10)


def test_landing_keeps_what_is_there(spark, tmp_path):
    out = str(tmp_path / "t")
    first = spark.createDataFrame([("202312", "BANCOS", 1)], "data string, inst_type string, v int")
    both = spark.createDataFrame([("202312", "BANCOS", 2), ("202401", "BANCOS", 3)], "data string, inst_type string, v int")
    keys = ["data", "inst_type"]
    assert rows(sinks.land(first, out, keys)) == [("202312", "BANCOS", True, True, None)]
    report = rows(sinks.land(both, out, keys))
    assert report == [("202312", "BANCOS", False, True, "landed earlier and kept"), ("202401", "BANCOS", True, True, None)]
    assert sorted(r["v"] for r in spark.read.parquet(out).collect()) == [1, 3]
    sinks.land(both, out, keys, overwrite=True)
    assert sorted(r["v"] for r in spark.read.parquet(out).collect()) == [2, 3]


def test_institution_folders_have_safe_names(spark, tmp_path):
    df = spark.createDataFrame([("A/B ç", 1)], "institution string, v int")
    out = sinks.write_institutions(df, str(tmp_path / "o"))
    assert [p.name for p in (tmp_path / "o").iterdir() if p.name.startswith("safe")] == ["safe_name=A_B__"]
    assert spark.read.option("header", True).csv(out).first()["institution"] == "A/B ç"
