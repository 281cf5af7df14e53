"""Trap tests for text, date and VARIANT expressions on tiny literal frames."""

import datetime as dt

from pyspark.sql import functions as F

from snaprecon.functions import dates as D
from snaprecon.functions import text as X
from snaprecon.functions import variant as V
from snaprecon.plans.spec import SPECS, canonical, canonical_name


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_canonical_text_matches_python(spark):
    samples = ["  Ação   Número\tÚltima ", "ÉÍÓÚ çñ ß", "ﬁ ª ½", "Ǆ ĳ", "İstanbul", "a b c", "übeŕ", None]
    rows = spark.createDataFrame([(s,) for s in samples], "s string").select("s", X.canonical_text("s").alias("c")).collect()
    for r in rows:
        assert r["c"] == (None if r["s"] is None else canonical(r["s"])), r


def test_every_native_character_is_canonical_without_python(spark):
    chars = [chr(cp) for first, last in X._NATIVE for cp in range(first, last + 1)]
    samples = [f" x{c}Y{c} z{c}" for c in chars] + ["“Ação…” – ﬁm", "e\u0301 Việt\u2028Nam"]
    rows = spark.createDataFrame([(s,) for s in samples], "s string").select("s", X.canonical_text("s", exact_fallback=False).alias("c")).collect()
    assert [(r.s, r.c) for r in rows if r.c != canonical(r.s)] == []


def test_canonical_column_names(spark):
    names = ["DATA DA ACAO/ ENVIO AREA", "COMPROMISSO GERADO:", "N ORDEM INGRESSADA (OUV)", "NÚMERO DE CASO PAI",
             "FaixaDiasUteis_Simples", "1 PRAZO POSTERGADO AO CLIENTE"]
    got = {r["s"]: r["c"] for r in spark.createDataFrame([(n,) for n in names], "s string")
           .select("s", X.canonical_column("s").alias("c")).collect()}
    assert got == {n: canonical_name(n) for n in names}
    assert got["FaixaDiasUteis_Simples"] == "faixa_dias_uteis_simples"
    assert got["1 PRAZO POSTERGADO AO CLIENTE"] == "1_prazo_postergado_ao_cliente"


def test_spec_sizes_and_no_collisions():
    assert len(SPECS["ingressadas"].custom_fields) == 24
    assert len(SPECS["analisadas"].custom_fields) == 22
    assert len(SPECS["encerradas"].custom_fields) == 25
    for spec in SPECS.values():
        cols = [f.column for f in spec.custom_fields]
        assert len(cols) == len(set(cols))
    assert SPECS["analisadas"].custom_fields[0].is_date  # "Data limite" is a date by exact name


def test_comparison_scalar(spark):
    for raw, want in [(None, ""), ("  12.0 ", "12"), ("12.05", "12.05"), (".0", ".0"), ("abc.0", "abc.0")]:
        assert one(spark, X.comparison_scalar("s"), raw) == want


def test_table_text(spark):
    assert one(spark, X.table_text("s"), "   ") is None
    assert one(spark, X.table_text("s"), " x ") == "x"


def test_three_date_readings_differ_near_midnight(spark):
    v = "2026-03-01T23:30:00-03:00"
    assert one(spark, D.local_date("s"), v) == dt.date(2026, 3, 1)
    assert one(spark, D.utc_date("s"), v) == dt.date(2026, 3, 2)
    assert one(spark, D.comparison_date("s"), v) == dt.date(2026, 3, 1)


def test_date_text_coverage(spark):
    assert one(spark, D.local_date("s"), "12345") is None  # not year 12345
    assert one(spark, D.local_date("s"), "20260302") == dt.date(2026, 3, 2)
    assert one(spark, D.local_date("s"), "03/02/2026") == dt.date(2026, 3, 2)  # month first
    assert one(spark, D.local_date("s"), "25/02/2026") == dt.date(2026, 2, 25)  # day first when month > 12
    assert one(spark, D.parse_timestamp("s"), "2026-03-01T01:00:00.000+0000") == dt.datetime(2026, 3, 1, 1, 0)


def test_excel_serials(spark):
    assert one(spark, D.comparison_date("s"), "46082") == dt.date(2026, 3, 1)
    assert one(spark, D.comparison_date("s"), "46082.75") == dt.date(2026, 3, 1)
    assert one(spark, D.comparison_date("s"), "123") is None
    assert one(spark, D.comparison_date("s"), "") is None


def test_month_back_clamps(spark):
    assert one(spark, D.one_month_back("d"), dt.date(2026, 3, 31), "d date") == dt.date(2026, 2, 28)
    assert one(spark, D.one_month_back("d"), dt.date(2026, 2, 28), "d date") == dt.date(2026, 1, 28)
    lo, hi = D.default_window("d")
    r = spark.createDataFrame([(dt.date(2026, 3, 3),)], "d date").select(lo.alias("lo"), hi.alias("hi")).first()
    assert (r.lo, r.hi) == (dt.date(2026, 2, 2), dt.date(2026, 3, 2))
    r = spark.createDataFrame([(dt.date(2026, 4, 1),)], "d date").select(lo.alias("lo"), hi.alias("hi")).first()
    assert (r.lo, r.hi) == (dt.date(2026, 2, 28), dt.date(2026, 3, 31))


def test_pick_scalar_shapes(spark):
    cases = {
        '"abc"': "abc", "5": "5", "5.0": "5.0", "112946.26": "112946.26", "true": "True", "null": None,
        '{"value":"x"}': "x", '{"name":5}': "5", '{"value":null,"displayName":"d"}': "d", '{"id":1}': '{"id":1}',
        "[]": None, '[null,"x"]': None, '[{"value":"y"},"z"]': "y", '"[1]"': "[1]", "[[7]]": "7",
    }
    df = spark.createDataFrame([(k,) for k in cases], "j string").withColumn("v", F.parse_json("j"))
    single = {r.j: r.p for r in df.select("j", V.pick_scalar(F.col("v")).alias("p")).collect()}
    staged = {r.j: r.p for r in V.pick_scalars(df, {"p": F.col("v")}, keep=["j"]).collect()}
    assert single == cases
    assert staged == cases


def test_status_name_only_name(spark):
    df = spark.createDataFrame([('{"value":"x"}',), ('{"name":"Open"}',), ('"Closed"',)], "j string")
    got = [r.s for r in df.select(V.status_name(F.parse_json("j")).alias("s")).collect()]
    assert got == [None, "Open", "Closed"]
