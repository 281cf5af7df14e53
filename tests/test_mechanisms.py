"""Page chains, ordinals, windows of any length, date forms, exports, sinks, bucketed state, late rows, shredding, collation."""

from __future__ import annotations

import datetime as dt
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from snaprecon.functions import dates
from snaprecon.functions import text as tx
from snaprecon.operators import chains as ch
from snaprecon.operators import layouts as ly
from snaprecon.operators import normalize as nz
from snaprecon.operators import ordinals as od
from snaprecon.operators import quality as qa
from snaprecon.operators import runs as rs
from snaprecon.operators import snapshot as sn
from snaprecon.operators import state as ss
from snaprecon.plans.spec import SPECS
from snaprecon.sinks import files as sk
from snaprecon.sources import exports as ex
from snaprecon.streaming import alerts as al
from snaprecon.streaming import ingest
from snaprecon.streaming import late as lt


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- page chains


def ranked(spark, rows):
    pages = spark.createDataFrame(rows, "chain string, asked string, token string, empty boolean, landed int")
    return ch.rank_pages(pages, "chain", "asked", "token", F.col("empty"), F.col("landed"))


def test_a_long_chain_is_ranked_in_order(spark):
    rows = [("a", f"t{i}" if i else None, f"t{i + 1}" if i < 300 else None, False, 0) for i in range(301)]
    random.Random(1).shuffle(rows)
    got = ranked(spark, rows)
    assert sorted((r.position, r.page) for r in got.collect()) == [(i, f"=t{i}" if i else "-") for i in range(301)]
    assert [tuple(r) for r in ch.chain_report(got).collect()] == [("a", "whole", 301, 0, 0)]


def test_chains_end_break_circle_and_lack_a_head(spark):
    rows = [
        ("empty", None, "x", False, 0), ("empty", "x", "y", True, 0), ("empty", "y", None, False, 0),
        ("gap", None, "x", False, 0), ("gap", "z", None, False, 0),
        ("circle", "", "x", False, 0), ("circle", "x", "y", False, 0), ("circle", "y", "x", False, 0),
        ("self", None, "x", False, 0), ("self", "x", "x", False, 0),
        ("headless", "x", "y", False, 0), ("headless", "y", None, False, 0),
        ("twice", None, "x", False, 0), ("twice", None, "y", False, 1), ("twice", "x", None, False, 0), ("twice", "y", "", False, 0),
        ("one", None, None, None, 0),
    ]
    got = ranked(spark, rows)
    assert {r.chain: tuple(r)[1:] for r in ch.chain_report(got).collect()} == {
        "empty": ("whole", 2, 1, 0), "gap": ("broken", 1, 1, 0), "circle": ("cyclic", 3, 0, 0), "self": ("cyclic", 2, 0, 0),
        "headless": ("headless", 0, 2, 0), "twice": ("whole", 2, 1, 1), "one": ("whole", 1, 0, 0),
    }
    assert ranked(spark, []).count() == 0


def test_a_branch_that_merges_does_not_disturb_the_order(spark):
    rows = [("a", None, "x", False, 0), ("a", "x", "y", False, 0), ("a", "y", None, False, 0), ("a", "stray", "y", False, 0)]
    assert sorted((r.page, r.position, r.state) for r in ranked(spark, rows).collect()) == [("-", 0, "in order"), ("=stray", None, "orphan"), ("=x", 1, "in order"), ("=y", 2, "in order")]


# ---- ordinals


def test_ordinals_are_gapless_and_ordered(spark):
    rows = [(random.Random(i).randrange(40), i) for i in range(2000)]
    got = od.with_ordinals(spark.createDataFrame(rows, "v int, i int").repartition(7), [F.desc("v")]).collect()
    assert sorted(r.ordinal for r in got) == list(range(2000))
    assert [r.v for r in sorted(got, key=lambda r: r.ordinal)] == sorted((v for v, _ in rows), reverse=True)
    assert od.with_ordinals(spark.createDataFrame([], "v int"), [F.asc("v")]).count() == 0


def test_ordinals_use_no_single_task(spark):
    df = od.with_ordinals(spark.range(1000).toDF("v"), [F.asc("v")])
    assert "SinglePartition" not in plan_of(df) and "Window" not in plan_of(df)


# ---- windows of any length


def test_windows_of_any_length(spark):
    rng = random.Random(3)
    days = [dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(900)) for _ in range(400)]
    windows = [(i, a := dt.date(2019, 6, 1) + dt.timedelta(rng.randrange(1400)), a + dt.timedelta(rng.choice([-1, 0, 1, 30, 700, 3000]))) for i in range(60)]
    items = spark.createDataFrame([(d,) for d in days] + [(None,)], "d date")
    frame = spark.createDataFrame(windows, "run int, window_from date, window_to date")
    want = {i: n for i, lo, hi in windows if (n := sum(lo <= d <= hi for d in days))}
    assert {r.run: r.n_tickets for r in sn.rolling_counts(items, "d", frame, keep=("run",)).collect()} == want
    assert {r.run: r["count"] for r in sn.rolling_membership(items, "d", frame).groupBy("run").count().collect()} == want
    assert sn.rolling_counts(items.limit(0), "d", frame, keep=("run",)).count() == 0


# ---- dates


FORMS = (
    "2026-03-01 8:26 PM", "03/Mar/26 20:26:15", "2026-03-01T10", "2026-03-01 10:00:00 GMT", "01-Mar-2026", "3 Mar 2026", "03.03.2026", "3/3/26",
    "20260301T101500", "March 3, 2026", "2026-03", "2026-03-01T10:00+02:00", "25/12/2025", "12/25/2025 1:05:09 am", "31-12-2025 23:59", "2026/3/1",
    "3/Mar/2026 12:01 AM", "Sept 5, 2025", "May 5, 2025 3 pm", "01-Mar-99", "2026-13-01", "2026-02-30", "2026-03-01T25:00", "garbage", "12345", "2026-03-01x",
    "32/01/2026", "3 de mar 2026", "Marvel 3, 2026", "2026-03-01 13:00 PM", "", " ", "2026-03-01T23:30:00-03:00", "20260301T101500Z",
)


def test_date_forms_are_read_as_data_frames_read_them(spark):
    df = spark.createDataFrame([(t,) for t in FORMS], "t string")
    for r in df.select("t", dates.parse_timestamp("t").cast("timestamp_ntz").alias("at"), dates.local_date("t").alias("d")).collect():
        want = pd.to_datetime(r.t, errors="coerce")
        if want is pd.NaT:
            assert r.at is None and r.d is None, r.t
        else:
            assert r.d == want.date(), r.t
            assert pd.Timestamp(r.at) == (want.tz_convert("UTC").tz_localize(None) if want.tz is not None else want), r.t


def test_the_run_date_is_the_day_of_the_zone(spark):
    rows = [("2026-03-02 02:59:59", dt.date(2026, 3, 1)), ("2026-03-02 03:00:00", dt.date(2026, 3, 2)), (None, None)]
    df = spark.createDataFrame([(a,) for a, _ in rows], "at string").withColumn("at", F.col("at").cast("timestamp"))
    assert [r.d for r in df.select(dates.run_date_in_zone("at", "America/Bahia").alias("d")).collect()] == [d for _, d in rows]


# ---- exports


def test_repeated_headers_keep_their_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Issue key,Summary,Status,Status,updated,Updated,\nK-1,"two\nlines",Open,other,1999-01-01,2026-03-01,x\nK-2,NA,Done,o,1999-01-01,,\n')
    export, names = ex.read_export(spark, str(tmp_path / "a.csv"))
    assert names == ["Issue key", "Summary", "Status", "Status.1", "updated", "Updated", "Unnamed: 6"] == list(pd.read_csv(tmp_path / "a.csv").columns)
    run = nz.Run("2026-03-03T00:00:00+00:00", "2026-02-02", "2026-03-02")
    got = nz.normalize_fallback(export, SPECS["encerradas"], run, headers=names).select("issue_key", "summary", "status", "updated").collect()
    assert [tuple(r) for r in got] == [("K-1", "two\nlines", "Open", "2026-03-01"), ("K-2", None, "Done", None)]


def test_names_are_made_unique():
    assert ex.unique_names(["a", "a", "a.1", "a", None, "", "A"]) == ["a", "a.2", "a.1", "a.3", "Unnamed: 4", "Unnamed: 5", "A"]


# ---- sinks


def files_below(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_a_snapshot_write_leaves_other_windows_alone(spark, tmp_path):
    rows = lambda month, n: spark.createDataFrame([(f"K{i}", "b", f"2026-{month:02}-01", f"2026-{month:02}-28") for i in range(n)], "k string, base_origem string, periodo_inicio string, periodo_fim string")
    path = str(tmp_path / "snap")
    assert sk.write_snapshot(rows(1, 3), path, ("parquet",)) == {"record_count": 3, "formats": ["parquet"], "written": ["parquet"]}
    first = files_below(path)
    assert sk.write_snapshot(rows(2, 5), path, ("csv", "parquet"))["record_count"] == 5
    assert {f: t for f, t in files_below(path).items() if f in first} == first
    assert spark.read.parquet(f"{path}/parquet").count() == 8
    assert spark.read.options(**sk.CSV).csv(f"{path}/csv").select("periodo_inicio").distinct().count() == 1
    second = files_below(path)
    assert sk.write_snapshot(rows(3, 0), path, ("csv", "parquet"))["record_count"] == 0
    assert {f: t for f, t in files_below(path).items() if f in second} == second and spark.read.parquet(f"{path}/parquet").count() == 8


def test_rollup_of_awkward_runs(spark):
    schema = "base string, duration_ms long, total_records long, source_mode string, status string"
    rows = [("a", 10, 5, "api", "success"), ("a", 5000, 7, "playwright_fallback", "error"), ("a", None, 1, None, None), (None, -3, None, "api", "success"), ("c", None, 2, "api", "success")]
    got = {r.base: r for r in rs.rollup(spark.createDataFrame(rows, schema)).collect()}
    assert (got["a"].runs, got["a"].min_ms, got["a"].median_ms, got["a"].max_ms, got["a"].fallback_rate) == (3, 10, 2505.0, 5000, 0.5)
    assert got[None].median_ms == -3.0 and got["c"].median_ms is None and got["c"].runs == 1
    assert plan_of(rs.rollup(spark.createDataFrame(rows, schema))).count("Exchange hashpartitioning") <= 4


def test_a_write_counts_what_it_builds(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("z",), (None,)], "base string")
    out, seen = qa.counted(df, "base", ["a", "b", "c"])
    out.write.parquet(str(tmp_path / "t"))
    n = seen.get
    assert n == {"n": 5, "n0": 2, "n1": 1, "n2": 0}


# ---- bucketed state


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    root, schema = str(tmp_path / "state"), "k int, at int, v string"
    merge = lambda rows, b: ss.merge_batch(spark.createDataFrame(rows, schema), root, ["k"], ["at"], b, buckets=8)
    assert ss.read_state(spark, root, schema).count() == 0
    assert merge([(k, 1, "old") for k in range(100)] + [(0, 0, "older")], 0) == 1
    before = files_below(root)
    assert merge([(3, 2, "new"), (3, 1, "late"), (500, 1, "more")], 1) == 2
    after = files_below(root)
    assert {f: t for f, t in after.items() if f in before} == before
    touched = {d for f in set(after) - set(before) for d in f.split(os.sep) if d.startswith("bucket=")}
    assert 1 <= len(touched) <= 2
    want = {k: ("new" if k == 3 else "old") for k in range(100)} | {500: "more"}
    assert {r.k: r.v for r in ss.read_state(spark, root, schema).collect()} == want
    assert merge([(1, 9, "again")], 1) == 2 and {r.k: r.v for r in ss.read_state(spark, root, schema).collect()} == want
    assert merge([], 2) == 3 and {r.k: r.v for r in ss.read_state(spark, root, schema).collect()} == want
    assert merge([(7, 0, "older than the state")], 3) == 4 and {r.k: r.v for r in ss.read_state(spark, root, schema).collect()} == want


def test_an_uncommitted_write_is_not_seen(spark, tmp_path):
    root, schema = str(tmp_path / "state"), "k int, at int"
    ss.merge_batch(spark.createDataFrame([(1, 1), (2, 1)], schema), root, ["k"], ["at"], 0, buckets=2)
    spark.createDataFrame([(9, 9, 0)], schema + ", bucket int").write.partitionBy("bucket").parquet(f"{root}/data/version=2")
    assert {r.k for r in ss.read_state(spark, root, schema).collect()} == {1, 2}
    ss.merge_batch(spark.createDataFrame([(3, 1)], schema), root, ["k"], ["at"], 1, buckets=2)
    assert {r.k for r in ss.read_state(spark, root, schema).collect()} == {1, 2, 3}


# ---- late rows


def test_late_and_repeated_rows_are_kept_beside_the_sink(spark, tmp_path):
    schema = "id int, ts timestamp"
    landing, sink = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda day, hour=0: dt.datetime(2026, 3, day, hour)
    batches = [
        [(1, at(10)), (2, at(1)), (1, at(10)), (None, at(9))],
        [(3, at(8)), (4, at(9, 1)), (1, at(10)), (5, None), (6, at(20)), (None, at(9))],
        [],
        [(7, at(18)), (6, at(20)), (8, at(19)), (9, at(30))],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        lt.drain(spark.readStream.schema(schema).parquet(landing), sink, ["id"], "ts", "1 DAY")
    read = lambda t: sorted((r.id or 0 for r in spark.read.schema("id int, ts timestamp").parquet(f"{sink}/{t}").collect()))
    assert (read("kept"), read("late"), read("repeated")) == ([0, 1, 2, 4, 6, 8, 9], [3, 5, 7], [0, 1, 1, 6])


def test_every_batch_and_late_row_is_counted(spark, tmp_path):
    """More batches than a query keeps reports of."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        schema, landing, sink = "id int, ts timestamp", str(tmp_path / "in"), str(tmp_path / "out")
        for i in range(5):
            spark.createDataFrame([(i, dt.datetime(2026, 3, 10 + i)), (100 + i, dt.datetime(2026, 3, 1))], schema).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        seen = ingest.drain(ingest.dedup_events(stream, ["id"], "1 hour"), sink)
        kept = spark.read.schema(schema).parquet(sink).count()
        assert seen["batches"] >= 5 and seen["late_rows"] + kept == 10 and seen["late_rows"] >= 3
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


# ---- shredded landing


def test_a_shredded_scan_reads_only_the_requested_paths(spark, tmp_path):
    rows = [('{"key":"K%d","fields":{"summary":"s%d","big":"%s","status":{"name":"Open"}}}' % (i, i, "x" * 50), "b", "p") for i in range(50)] + [('{"key":"K","fields":"broken"}', "b", "p")]
    good, _ = nz.split_malformed(nz.parse_raw(spark.createDataFrame(rows, "value string, base_origem string, periodo string")))
    sk.write_shredded(good, str(tmp_path / "v"))
    run = nz.Run("2026-03-03T00:00:00+00:00", "2026-02-02", "2026-03-02")
    out = nz.normalize_api_bases(spark.read.parquet(str(tmp_path / "v")), "base_origem", SPECS, {}, run, custom=False).select("issue_key", "summary", "status")
    assert sorted(tuple(r) for r in out.collect()) == sorted((f"K{i}", f"s{i}", "Open") for i in range(50))
    plan = plan_of(out)
    schema = plan[plan.index("ReadSchema: ") :].split("\n")[0]
    assert schema.startswith("ReadSchema: struct<v:struct<0:") and "v:variant" not in schema


# ---- collation


def test_the_equality_key_agrees_with_canonical_text_on_latin(spark):
    words = ["Análise", "ANALISE", " analise ", "a  nalise", "Ação", "acao", "ACAO\t", "Ärger", "arger", "naïve", "naive", "x", "", "ﬁ", "fi", "ñ", "n"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    pairs = df.alias("a").join(df.alias("b"), tx.equality_key("a.w") == tx.equality_key("b.w")).select("a.w", F.col("b.w").alias("x")).collect()
    canon = {r.w: r.c for r in df.select("w", tx.canonical_text("w").alias("c")).collect()}
    assert {(p[0], p[1]) for p in pairs} == {(a, b) for a in words for b in words if canon[a] == canon[b]}


def test_where_the_equality_key_and_canonical_text_differ(spark):
    same = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select((tx.equality_key("a") == tx.equality_key("b")).alias("k"), (tx.canonical_text("a") == tx.canonical_text("b")).alias("c")).first()
    assert tuple(same("Straße", "STRASSE")) == (True, False)
    assert tuple(same("ı", "i")) == (False, False)
    assert tuple(same("АНАЛИЗ", "анализ")) == (True, True)


def test_rules_by_collation_run_without_python(spark):
    df = spark.createDataFrame([("a", "ANÁLISE"), ("a", "x"), ("b", "analise"), (None, "analise"), ("a", None)], "base string, status string")
    rules = spark.createDataFrame([("a", "Analise")], "base string, status string")
    got = sn.rules_filter_collated(df, rules, "base", "status")
    assert [tuple(r) for r in got.collect()] == [("a", "ANÁLISE")] and "Python" not in plan_of(got)


@pytest.mark.parametrize("text,want", [("Ação  Ω", "acao ω"), ("plain ASCII\t", "plain ascii"), ("ﬃ", "ffi"), ("Ａ", "a")])
def test_canonical_text_on_every_path(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(tx.canonical_text("t").alias("c")).first().c == want


# ---- day alerts


def test_days_without_events_alert_and_a_restart_goes_on(spark, tmp_path):
    schema = "base string, ts timestamp, total_records long, source_mode string"
    landing, sink = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda day, hour=12: dt.datetime(2026, 3, day, hour)
    deliveries = [
        [("a", at(1), 10, "api"), ("a", at(1, 13), 5, "api"), ("b", at(2), 4, "playwright_fallback"), (None, at(1), 1, "api"), ("a", None, 1, "api")],
        [("b", at(3), None, "playwright_fallback"), ("a", at(6), 7, "api")],
        [("b", at(1), 99, "api"), ("b", at(9), 1, "api")],
    ]
    for rows in deliveries:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        al.drain(spark.readStream.schema(schema).parquet(landing), sink, "1 day")
    got = sorted((r.base, r.day.day, r.volume, r.trailing_avg, r.alert, r.streak) for r in spark.read.schema(al.RESULT).parquet(sink).collect())
    # the watermark ends on the 8th at noon; b's row of the 1st came behind it
    assert got == [
        ("a", 1, 15, None, False, 0), ("a", 2, 0, 15.0, True, 0), ("a", 3, 0, 7.5, True, 0), ("a", 4, 0, 5.0, True, 0), ("a", 5, 0, 3.75, True, 0), ("a", 6, 7, 3.0, False, 0), ("a", 7, 0, 3.666667, True, 0),
        ("b", 2, 4, None, False, 1), ("b", 3, 0, 4.0, True, 2), ("b", 4, 0, 2.0, True, 0), ("b", 5, 0, 1.333333, True, 0), ("b", 6, 0, 1.0, True, 0), ("b", 7, 0, 0.8, True, 0),
    ]


# ---- versions and layouts


def test_two_refreshes_at_once_are_two_versions(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    assert sk.pointer(spark, root) == (0, None)
    assert sk.publish(spark, root, "first") == 1
    monkeypatch.setattr(sk, "pointer", lambda *_: (0, None))  # both saw the table before the first was there
    assert sk.publish(spark, root, "second") == 2
    monkeypatch.undo()
    assert sk.pointer(spark, root) == (2, "second")


def test_only_stale_partitions_are_rewritten(spark, tmp_path):
    path, expected = str(tmp_path / "t"), spark.createDataFrame([], "k string, d date, extra string").schema
    put = lambda rows, schema, year: spark.createDataFrame(rows, schema).write.parquet(f"{path}/year={year}")
    put([("a", "01-Mar-2026"), ("b", "pendente")], "k string, d string", 2024)
    put([("c", dt.date(2026, 3, 2))], "k string, d date", 2025)
    put([("d", dt.date(2026, 3, 3), "x")], "k string, d date, extra string", 2026)
    rows = lambda df: sorted((r.k, r.d, r.extra, str(r.year)) for r in df.collect())
    want = [("a", dt.date(2026, 3, 1), None, "2024"), ("b", None, None, "2024"), ("c", dt.date(2026, 3, 2), None, "2025"), ("d", dt.date(2026, 3, 3), "x", "2026")]
    before = files_below(path)
    assert rows(ly.read_layouts(spark, path, expected, ["year"])) == want and files_below(path) == before
    assert [os.path.basename(f) for f in ly.migrate(spark, path, expected, ["year"])] == ["year=2024"]
    after = files_below(path)
    assert {f: t for f, t in after.items() if "year=2024" not in f} == {f: t for f, t in before.items() if "year=2024" not in f}
    assert rows(spark.read.schema(ly.with_parts(expected, ["year"], ["int"])).parquet(path)) == want
    assert ly.migrate(spark, path, expected, ["year"]) == []
