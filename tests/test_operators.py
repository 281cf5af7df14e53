"""Operator tests on literal frames: dedup order, multiset identities, reconciliation scope, evolution."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaprecon.operators import normalize as nz
from snaprecon.operators import quality as qa
from snaprecon.operators import reconcile as rc
from snaprecon.operators import runs as rs
from snaprecon.operators import snapshot as sn
from snaprecon.plans.spec import SPECS, resolve_bases
from snaprecon.sinks import files as sk
from snaprecon.sources import pages as pg


def test_keep_last_null_keys_equal(spark):
    df = spark.createDataFrame(
        [("A", None, 1, "old"), ("A", None, 2, "new"), ("A", "t1", 3, "x"), ("B", "t1", 1, "b")],
        "k string, u string, o int, p string",
    )
    got = {(r.k, r.u): r.p for r in sn.keep_last(df, ["k", "u"], [F.col("o")]).collect()}
    assert got == {("A", None): "new", ("A", "t1"): "x", ("B", "t1"): "b"}
    # idempotent
    once = sn.keep_last(df, ["k", "u"], [F.col("o")])
    assert sorted(once.collect(), key=repr) == sorted(sn.keep_last(once, ["k", "u"], [F.col("o")]).collect(), key=repr)


def test_typed_dedup_collapses_one_instant(spark):
    df = spark.createDataFrame([("K", "2026-03-01T10:00:00+0000", 1), ("K", "2026-03-01T07:00:00-03:00", 2)], "k string, u string, o int")
    typed = df.select(F.col("k").alias("chave_ticket"),
                      sn.resolved_updated(F.col("u"), F.lit(None), F.lit(None), "2026-03-03 00:00:00").alias("data_atualizacao"), "o")
    assert sn.dedup_typed(typed, [F.col("o")]).count() == 1


def _sig(spark, rows):
    return spark.createDataFrame(rows, "base string, month string, summary string, status string")


def test_reconcile_identities_and_self(spark):
    local = _sig(spark, [("b", "2026-02", "s1", "open")] * 3 + [("b", "2026-02", "s2", "done"), ("b", "2026-03", "s3", "x")])
    ref = _sig(spark, [("b", "2026-02", "s1", "open")] * 2 + [("b", "2026-02", "s2", "open"), ("b", "2026-04", "s9", "y")])
    rep = {r.month: r for r in rc.monthly_report(rc.signature_counts(local, ref), scope="all").collect()}
    for r in rep.values():
        assert r.matched_count + r.missing_in_local_count == r.reference_count
        assert r.matched_count + r.extra_in_local_count == r.local_count
        assert r.relaxed_matched_count + r.relaxed_missing_count == r.reference_count
    feb = rep["2026-02"]
    assert (feb.matched_count, feb.missing_in_local_count, feb.extra_in_local_count) == (2, 1, 2)
    assert (feb.relaxed_matched_count, feb.relaxed_missing_count, feb.relaxed_extra_count) == (3, 0, 1)
    assert "2026-04" in rep  # reference-only month with scope 'all'
    assert "2026-04" not in {r.month for r in rc.monthly_report(rc.signature_counts(local, ref)).collect()}
    same = rc.monthly_report(rc.signature_counts(local, local)).collect()
    assert all(r.missing_in_local_count == 0 and r.extra_in_local_count == 0 for r in same)


def test_multiset_ops_keep_multiplicity(spark):
    a = _sig(spark, [("b", "m", "s", "x")] * 3)
    b = _sig(spark, [("b", "m", "s", "x")])
    assert rc.multiset_except(a, b).count() == 2
    assert rc.multiset_intersect(a, b).count() == 1


def test_top_examples_ties_and_k(spark):
    counts = spark.createDataFrame(
        [("b", "m", f"s{i:02d}", "st", 0, 1 + (i % 3)) for i in range(15)],
        "base string, month string, summary string, status string, local_qty bigint, reference_qty bigint",
    )
    ex = rc.top_examples(counts, k=10).where("side = 'missing'").orderBy("rank").collect()
    assert len(ex) == 10 and ex[0].qty == 3 and ex[0].summary == "s02"


def test_catalog_keep_last_and_resolution(spark):
    cat = spark.createDataFrame(
        [("Data Última Análise", "cf_1", 1), ("DATA ULTIMA ANALISE", "cf_2", 2), ("  ", "cf_3", 3), ("TEMA", "", 4)],
        "name string, id string, ordinal int",
    )
    entries = {r.canon: r.field_id for r in nz.catalog_entries(cat).collect()}
    assert entries == {"data ultima analise": "cf_2"}
    req = nz.required_frame(spark, ("analisadas",))
    res = {r.display_name: r.field_id for r in nz.resolve_fields(cat, req).collect()}
    assert res["DATA ULTIMA ANALISE"] == "cf_2" and res["TEMA"] is None
    miss = nz.missing_fields(req, nz.resolve_fields(cat, req)).first()
    assert miss.n_missing == 21 and "TEMA" in miss.missing_names.split(",")


def test_fallback_header_pick_and_null_tokens(spark):
    export = spark.createDataFrame([("K-1", "NA", "Open", "X", "2026-02-10")], "`Chave` string, `Resumo` string, `Status` string, `Espaço` string, `DATA ABERTURA` string")
    run = nz.Run("2026-03-03T00:00:00+00:00", "2026-02-02", "2026-03-02")
    r = nz.normalize_fallback(export, SPECS["ingressadas"], run).first()
    assert (r.issue_key, r.summary, r.espaco, r.data_referencia, r.source_mode) == ("K-1", None, "X", "2026-02-10", "playwright_fallback")
    assert list(nz.normalize_fallback(export, SPECS["ingressadas"], run).columns) == list(SPECS["ingressadas"].text_columns)


def test_malformed_split(spark):
    df = spark.createDataFrame([('{"key":"A","fields":{}}',), ('{"key":"B","fields":"x"}',), ('{"key":"C"}',), ("not json",)], "value string")
    good, bad = nz.split_malformed(nz.parse_raw(df))
    assert sorted(r.value for r in good.collect()) == ['{"key":"A","fields":{}}', '{"key":"C"}']
    assert bad.count() == 2


def test_schema_diff_and_evolve(spark):
    existing = T.StructType([T.StructField("a", T.StringType()), T.StructField("d", T.StringType())])
    expected = T.StructType([T.StructField("a", T.StringType()), T.StructField("d", T.DateType()), T.StructField("n", T.StringType())])
    assert [r[3] for r in qa.schema_diff(expected, existing)] == ["keep", "to_date", "add"]
    old = spark.createDataFrame([("x", "2026-03-01"), ("y", "pendente")], "a string, d string")
    got = [r.d for r in qa.evolve(old, expected).orderBy("a").collect()]
    assert got == [dt.date(2026, 3, 1), None]


def test_fingerprint_golden(spark):
    df = spark.createDataFrame([(10719, "data fechou salesforce[date]", dt.date(2026, 2, 2), dt.date(2026, 3, 2))],
                               "fid int, dn string, lo date, hi date")
    h = df.select(rs.fingerprint(F.col("fid"), F.col("dn"), F.col("lo"), F.col("hi")).alias("h")).first().h
    assert h == "9ee8dd52c799ad92803116be294dff4ab04e09c50aa60bf100cfc8317865da57"


def test_resolve_bases():
    assert resolve_bases("all") == ("encerradas", "analisadas", "ingressadas")
    assert resolve_bases("analisadas") == ("analisadas",)
    try:
        resolve_bases("nope")
    except ValueError:
        pass
    else:
        raise AssertionError


def test_rolling_membership(spark):
    items = spark.createDataFrame([(dt.date(2026, 2, 2),), (dt.date(2026, 3, 2),), (dt.date(2026, 3, 3),)], "d date")
    runs = spark.createDataFrame([(dt.date(2026, 3, 3),)], "run_date date")
    got = sn.rolling_membership(items, "d", sn.run_windows(runs)).count()
    assert got == 2


def test_rollup_median_equals_percentile(spark):
    rows = [(k, v) for k, vs in {"a": [5], "b": [1, 4000], "c": [-3000, -1, 7, 7, 90000], "d": [2, 2, 2, 9, 9, 9], None: [1, 2, 3, 1024], "e": [None]}.items() for v in vs]
    df = spark.createDataFrame(rows, "base string, duration_ms bigint").selectExpr("*", "1L AS total_records", "'api' AS source_mode", "'success' AS status")
    got = {r.base: r.median_ms for r in rs.rollup(df).collect()}
    assert got == {r.base: r.m for r in df.groupBy("base").agg(F.percentile("duration_ms", F.lit(0.5)).alias("m")).collect()}


def test_latest_window_by_run_date(spark):
    snap = spark.createDataFrame([("a", 1, "2024-01-31"), ("a", 2, "2024-02-29"), ("b", 3, "2024-01-31")], "base string, id int, day string").withColumn("day", F.to_date("day"))
    assert sorted(r.id for r in sn.latest_window(snap, "base", "day").collect()) == [2, 3]
    assert sorted(r.id for r in sn.latest_window(snap, "base", "day", "2024-02-10").collect()) == [1, 3]
    with pytest.raises(LookupError):
        sn.latest_window(snap, "base", "day", "2023-12-31")


def test_latest_window_reads_footers_and_prunes(spark, tmp_path):
    rows = [(k, base, day) for k, (base, day) in enumerate([("a", "2024-01-31"), ("a", "2024-02-29"), ("b", "2024-01-31"), (None, "2024-01-31"), (None, "2024-03-31"), ("c", None)])]
    path = str(tmp_path / "snap")
    spark.createDataFrame(rows, "id int, base string, day string").withColumn("day", F.to_date("day")).write.partitionBy("base", "day").parquet(path)
    snap = spark.read.schema("id int, base string, day date").parquet(path)
    chosen = sn.latest_window(snap, "base", "day")
    assert sorted(r.id for r in chosen.collect()) == [1, 2, 4]
    plan = spark._jvm.PythonSQLUtils.explainString(chosen._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [array_contains(Subquery" in plan
    assert plan.count("Scan parquet") >= 2 and "ReadSchema: struct<>" in plan  # the choice itself opens no column
    files = {r.f for r in chosen.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(files) == 3


def test_manifest_rows_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "snap")
    rows = spark.range(40).selectExpr("id", "string(id % 2) AS base_origem", "date'2024-01-01' AS periodo_inicio", "date'2024-01-31' AS periodo_fim")
    sk.write_snapshot(rows, path, ("parquet",))
    got = sk.manifest_rows(spark.read.parquet(f"{path}/parquet"), ("parquet",), "2026-03-03 20:27:05")
    assert "ReadSchema: struct<>" in spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert sorted(r.record_count for r in got.collect()) == [20, 20]


def test_verify_groups_reports_lost_and_extra_rows(spark):
    staged = spark.createDataFrame([("a",), ("b",), ("c",)], "base string")
    got = {r.base: (r.expected, r.loaded, r.ok) for r in qa.verify_groups({"a": 2, "b": 1}, 3, staged, "base").collect()}
    assert got == {"a": (2, 1, False), "b": (1, 1, True), "c": (0, 1, False)}


def test_drop_blank_rows(spark):
    df = spark.createDataFrame([(1, None, " "), (2, "x", None), (3, "", "é"), (4, "", "")], "id int, s string, t string")
    assert sorted(r.id for r in sn.drop_blank_rows(df, ["s", "t"]).collect()) == [2, 3]


def test_rejected_pages_carry_their_reason(spark):
    pages = spark.createDataFrame([('{"page":1,"issues":[{"key":"A"},3]}',), ('{"page":2}',), ("{oops",), (None,)], "value string")
    issues, rejects = pg.explode_pages(pages)
    assert [(r.page_no, r.pos) for r in issues.collect()] == [(1, 0)]
    assert sorted((r.page_no or 0, r.reason) for r in rejects.collect()) == [(0, "not JSON"), (0, "not JSON"), (2, "no issues list")]


def test_raw_text_is_parsed_once(spark):
    good, _ = nz.split_malformed(nz.parse_raw(spark.createDataFrame([('{"key":"A","fields":{"summary":"s"}}',)], "value string")))
    out = good.select(F.try_variant_get("v", "$.key", "string").alias("k"), F.try_variant_get("v", "$.fields.summary", "string").alias("s"))
    assert out._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson") <= 1
    assert out.collect()[0] == ("A", "s")
