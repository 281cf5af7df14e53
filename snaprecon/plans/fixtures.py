"""Ticket-shaped frames derived from the driver tables.

Every frame here is a pure DataFrame transformation of the given tables, so
its size grows with them. The DuckDB oracles recompute the expected values
straight from the same columns (see ``plans/oracles.py``), which is what
makes them independent checks of the operators.

Mapping: an order is a ticket. ``o_orderstatus`` F/O/P -> base
encerradas/analisadas/ingressadas, customer name -> summary, order priority
-> status, order date -> reference date.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaprecon.session import table as scan

_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey", "documents": "doc_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Rows of a driver table as they are split; a large table in a single file (one row group is one task) is dealt out by key first."""
    rows = scan(spark, sf_dir, name)
    return rows.repartition(_KEYS[name]) if name in _KEYS and len(rows.inputFiles()) == 1 else rows


# status code -> base name, and its SQL twin used by the oracles
BASE_OF_STATUS = {"F": "encerradas", "O": "analisadas", "P": "ingressadas"}


def base_of(status: Column) -> Column:
    expr = None
    for code, base in BASE_OF_STATUS.items():
        expr = (F.when(status == code, base) if expr is None else expr.when(status == code, base))
    return expr


def tickets(spark: SparkSession, sf: str) -> DataFrame:
    """Orders joined to their customer, with the ticket-facing columns."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
        "c_name", "c_mktsegment",
        base_of(F.col("o_orderstatus")).alias("base"),
    )


def _summary_local(t: DataFrame) -> Column:
    # every 29th ticket carries a numeric summary written by a float-typed export
    return F.when(F.col("o_orderkey") % 29 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).otherwise(F.col("c_name"))


def recon_local(spark: SparkSession, sf: str) -> DataFrame:
    """Local snapshot side: (base, summary, status, data_referencia) as text."""
    t = tickets(spark, sf)
    return t.select(
        "o_orderkey",
        "base",
        _summary_local(t).alias("summary"),
        F.col("o_orderpriority").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("data_referencia"),
    )


def recon_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Reference side: drops every 17th ticket, re-opens every 13th, doubles every 19th.

    Text differs in case, accents and padding only (equal after canonical
    form); the reference date is an Excel serial for every third ticket,
    blank (undatable) for every 23rd.
    """
    t = tickets(spark, sf).where(F.col("o_orderkey") % 17 != 0)
    k = F.col("o_orderkey")
    serial = F.datediff(F.col("o_orderdate"), F.lit("1899-12-30").cast("date")).cast("string")
    ref_date = (
        F.when(k % 23 == 0, F.lit(""))
        .when(k % 6 == 0, F.concat(serial, F.lit(".0")))
        .when(k % 3 == 0, serial)
        .when(k % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    summary = F.when(k % 29 == 0, F.col("o_custkey").cast("string")).otherwise(
        F.concat(F.lit("  "), F.upper("c_name"), F.lit(" "))
    )
    status = F.when(k % 13 == 0, F.lit("Reaberto")).otherwise(F.translate("o_orderpriority", "EI", "ÉÍ"))
    rows = t.select(
        "o_orderkey",
        F.col("base").alias("Base"),
        summary.alias("Resumo"),
        status.alias("Status"),
        ref_date.alias("Data"),
        F.when(k % 19 == 0, 2).otherwise(1).alias("copies"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")


def scalar_values(spark: SparkSession, sf: str) -> DataFrame:
    """Text cells as an export would hold them: numbers as float text, padding, blanks."""
    t = tickets(spark, sf)
    k = F.col("o_orderkey")
    value = (
        F.when(k % 4 == 0, F.col("o_totalprice").cast("string"))
        .when(k % 4 == 1, F.concat(F.lit("  "), F.col("o_custkey").cast("string"), F.lit(".0 ")))
        .when(k % 4 == 2, F.lit(None).cast("string"))
        .otherwise(F.col("c_name"))
    )
    return t.select("o_orderkey", value.alias("raw"))


def timestamp_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamp text in the shapes seen in exports, plus junk."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    hh = F.lpad((k % 24).cast("string"), 2, "0")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (
        F.when(k % 5 == 0, F.concat(day, F.lit("T"), hh, F.lit(":15:00.000+0000")))
        .when(k % 5 == 1, F.concat(day, F.lit("T"), hh, F.lit(":30:00-03:00")))
        .when(k % 5 == 2, day)
        .when(k % 5 == 3, F.lit("n/a"))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    return o.select("o_orderkey", text.alias("raw"))


def offset_texts(spark: SparkSession, sf: str) -> DataFrame:
    """``yyyy-MM-ddTHH:30:00-03:00``: late hours fall on the next UTC day."""
    o = table(spark, sf, "orders")
    hh = F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T"), hh, F.lit(":30:00-03:00"))
    return o.select("o_orderkey", text.alias("raw"))


#: forms of a date and time that exports hold: the pattern, the hours east of UTC it says, and what of the time it keeps (s, m, h or d)
DATE_FORMS = (
    ("yyyy-MM-dd h:mm a", 0, "m"), ("dd/MMM/yy HH:mm:ss", 0, "s"), ("yyyy-MM-dd'T'HH", 0, "h"), ("yyyy-MM-dd HH:mm:ss 'GMT'", 0, "s"),
    ("dd-MMM-yyyy", 0, "d"), ("d MMM yyyy", 0, "d"), ("MM.dd.yyyy", 0, "d"), ("M/d/yy", 0, "d"), ("yyyyMMdd'T'HHmmss", 0, "s"), ("MMMM d, yyyy", 0, "d"),
    ("yyyy-MM-dd'T'HH:mm'+02:00'", 2, "m"), ("dd/MMM/yy h:mm a", 0, "m"), ("MM/dd/yyyy HH:mm", 0, "m"), ("yyyy/MM/dd HH:mm:ss", 0, "s"), ("yyyy-MM-dd h:mm:ss a '-0300'", -3, "s"), ("'due' yyyy", 0, ""),
)


def date_form_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A date and time per order (order date, plus key hours and a few minutes) written in one of the forms, by key."""
    k = F.col("o_orderkey")
    at = F.expr("timestampadd(SECOND, CAST(o_orderkey % 24 * 3600 + o_orderkey % 60 * 60 + o_orderkey % 59 AS INT), o_orderdate)")
    written = F.lit(None).cast("string")
    for n, (pattern, _, _) in enumerate(DATE_FORMS):
        written = F.when(k % len(DATE_FORMS) == n, F.date_format(at, pattern)).otherwise(written)
    return table(spark, sf, "orders").select("o_orderkey", written.alias("raw"))


def serial_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Reference-workbook date cells: Excel serials (with fractions), ISO text, out-of-range numbers."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    serial = F.datediff(F.col("o_orderdate"), F.lit("1899-12-30").cast("date")).cast("string")
    text = (
        F.when(k % 4 == 0, serial)
        .when(k % 4 == 1, F.concat(serial, F.lit(".75")))
        .when(k % 4 == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise((k % 1000).cast("string"))
    )
    return o.select("o_orderkey", text.alias("raw"))


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Free text of documents and conversation turns, with its origin."""
    d = table(spark, sf, "documents").select(F.lit("documents").alias("origin"), "text")
    c = table(spark, sf, "conversations").select(F.lit("conversations").alias("origin"), "text")
    return d.unionByName(c)


def display_names(spark: SparkSession, sf: str) -> DataFrame:
    """Field display names with accents, camelCase, punctuation (from parts)."""
    p = table(spark, sf, "part")
    name = F.concat(
        F.col("p_brand"), F.lit(" ÁREA "), F.lower("p_type"), F.lit("Size"), F.col("p_size").cast("string"),
        F.lit("/ ("), F.col("p_name"), F.lit(")"),
    )
    return p.select("p_partkey", name.alias("display_name"))


# ------------------------------------------------------------------ issues as JSON

from snaprecon.plans.spec import all_custom_columns  # noqa: E402

CUSTOM_ID_BASE = 10100
# the one spec name absent from the catalogue, and the one whose id is overridden later in it
CATALOG_GAP = "RELATO"
CATALOG_OVERRIDE = "TEMA"


def custom_ids() -> list[tuple[str, str, bool]]:
    """(display name, id the issues carry, is_date) for every distinct custom field."""
    return [(f.display_name, f"customfield_{CUSTOM_ID_BASE + i}", f.is_date) for i, f in enumerate(all_custom_columns())]


def js(c: Column) -> Column:
    """JSON literal of a string column ("null" for null)."""
    a = F.to_json(F.array(c.cast("string")))
    return F.substr(a, F.lit(2), F.length(a) - 2)


def mixed_value(k: Column) -> Column:
    """A custom-field value whose JSON shape rotates with the key (12 shapes)."""
    m = k % 12
    return (
        F.when(m == 0, js(F.col("o_orderpriority")))
        .when(m == 1, F.col("o_totalprice").cast("string"))
        .when(m == 2, F.col("o_custkey").cast("string"))
        .when(m == 3, F.when(F.col("o_totalprice") > 250000, F.lit("true")).otherwise(F.lit("false")))
        .when(m == 4, F.lit("null"))
        .when(m == 5, F.concat(F.lit('{"value":'), js(F.col("c_mktsegment")), F.lit("}")))
        .when(m == 6, F.concat(F.lit('{"name":'), F.col("o_custkey").cast("string"), F.lit("}")))
        .when(m == 7, F.concat(F.lit('{"displayName":'), js(F.col("c_name")), F.lit(',"value":null}')))
        .when(m == 8, F.concat(F.lit('{"id":'), F.col("o_custkey").cast("string"), F.lit("}")))
        .when(m == 9, F.lit("[]"))
        .when(m == 10, F.concat(F.lit("[null,"), js(F.col("c_name")), F.lit("]")))
        .otherwise(F.concat(F.lit('[{"value":'), js(F.col("o_orderpriority")), F.lit('},"x"]')))
    )


#: stand for the escaped customer name, the order date and the mixed value in a text of fields; JSON texts hold no control character
_NAME, _DAY, _MIXED = "\x00", "\x01", "\x02"


def _filled(custom: list[tuple[str, str]], marks: str) -> Column:
    """Literal ``,"id":mark`` of the custom fields whose mark is one of ``marks``."""
    return F.lit("".join(f',"{fid}":{mark}' for fid, mark in custom if mark in marks))


def issue_parts(t: DataFrame) -> DataFrame:
    """What :func:`issue_text` makes an issue of, per ticket: (o_orderkey, base, o_orderdate, parts).

    The values that many fields repeat are held once, so an issue moves at a
    fifth of its length; ``t`` holds the columns of :func:`tickets`.
    """
    k = F.col("o_orderkey")
    ts_fmt = "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'"
    updated = F.expr("timestampadd(HOUR, CAST(o_orderkey % 48 AS INT), o_orderdate)")
    core = [
        F.col("c_name").alias("summary"),
        F.date_format("o_orderdate", ts_fmt).alias("created"),
        F.date_format(updated, ts_fmt).alias("updated"),
        F.struct(F.lit("PRJ").alias("key"), F.col("c_mktsegment").alias("name")).alias("project"),
        F.struct(F.lit("1").alias("id"), F.col("o_orderstatus").alias("name")).alias("issuetype"),
    ]
    status = (
        F.when(k % 11 == 0, F.to_json(F.struct(F.col("o_orderpriority").alias("value"))))
        .otherwise(F.to_json(F.struct(F.lit("3").alias("id"), F.col("o_orderpriority").alias("name"))))
    )
    parts = F.struct(
        F.to_json(F.struct(*core)).alias("core"), status.alias("st"), mixed_value(k).alias("mx"),
        F.when(F.col("c_name").isNotNull(), js(F.col("c_name"))).alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    return t.select("o_orderkey", "base", "o_orderdate", parts.alias("parts"))


def issue_text(k: Column, parts: Column) -> Column:
    """The JSON text of the issue with key ``k``; null values are left out."""
    uniform, odd = [], []
    for i, (_, fid, is_date) in enumerate(custom_ids()):
        if is_date or i % 2 == 0:
            uniform.append((fid, _DAY if is_date else _NAME))
        else:
            odd.append((fid, _MIXED))
    name, day, mx = parts["name"], parts["day"], parts["mx"]
    quoted = F.concat(F.lit('"'), day, F.lit('"'))
    of_name = lambda text: F.replace(text, F.lit(_NAME), name)
    of_day = lambda text: F.replace(text, F.lit(_DAY), quoted)
    custom = (
        F.when(name.isNotNull() & day.isNotNull(), of_day(of_name(_filled(uniform, _NAME + _DAY))))
        .when(name.isNotNull(), of_name(_filled(uniform, _NAME)))
        .when(day.isNotNull(), of_day(_filled(uniform, _DAY)))
        .otherwise(F.lit(""))
    )
    odd_part = F.coalesce(F.replace(_filled(odd, _MIXED), F.lit(_MIXED), mx), F.lit(""))
    head = F.substr(parts["core"], F.lit(1), F.length(parts["core"]) - 1)
    fields = F.concat(head, custom, F.lit(',"status":'), parts["st"], odd_part, F.lit("}"))
    body = (
        F.when(k % 97 == 0, F.lit(',"fields":"broken"}'))
        .when(k % 89 == 0, F.lit("}"))
        .otherwise(F.concat(F.lit(',"fields":'), fields, F.lit("}")))
    )
    return F.concat(F.lit('{"key":"TCK-'), k.cast("string"), F.lit('"'), body)


def issue_json(spark: SparkSession, sf: str) -> DataFrame:
    """One API issue per order: (o_orderkey, base, o_orderdate, json).

    Every 11th status lacks ``name``; every 89th issue has no ``fields``;
    every 97th has ``fields`` as a string (malformed). Date fields carry the
    order date, even-numbered text fields the customer name, odd-numbered
    ones a value whose JSON shape rotates with the key.
    """
    parts = issue_parts(tickets(spark, sf))
    return parts.select("o_orderkey", "base", "o_orderdate", issue_text(F.col("o_orderkey"), F.col("parts")).alias("json"))


def field_catalog_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The remote field catalogue as (name, id, ordinal).

    Spec names come first (one left out, case / accent variants for the rest);
    then one entry per part (``type brand`` in varying case; blank name at
    size 1, blank id at size 2); then, for parts 7, 507, ..., a later entry
    that re-uses a spec name with another id (the last one wins).
    """
    spec_rows = [
        (n if i % 3 == 0 else (n.lower() if i % 3 == 1 else n.replace("A", "Á")), fid, i)
        for i, (n, fid, _) in enumerate(custom_ids())
        if n != CATALOG_GAP
    ]
    spec_df = spark.createDataFrame(spec_rows, "name string, id string, ordinal bigint")
    p = table(spark, sf, "part")
    noise_name = F.when(F.col("p_size") == 1, F.lit("  ")).otherwise(
        F.when(F.col("p_partkey") % 2 == 0, F.concat_ws(" ", "p_type", "p_brand")).otherwise(F.lower(F.concat_ws("  ", "p_type", "p_brand")))
    )
    noise_id = F.when(F.col("p_size") == 2, F.lit("")).otherwise(F.concat(F.lit("customfield_"), (F.col("p_partkey") + 20000).cast("string")))
    noise = p.select(noise_name.alias("name"), noise_id.alias("id"), (F.col("p_partkey") + 1000).alias("ordinal"))
    override = p.where(F.col("p_partkey") % 500 == 7).select(
        F.lit(CATALOG_OVERRIDE.lower()).alias("name"),
        F.concat(F.lit("customfield_"), (F.col("p_partkey") + 30000).cast("string")).alias("id"),
        (F.col("p_partkey") + 1000).alias("ordinal"),
    )
    return spec_df.unionByName(noise).unionByName(override)


# ------------------------------------------------------------------ text contract rows, versions, audit runs

RUN_TS = "2026-03-03 20:26:35"


def contract_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Text-contract records built straight from tickets, with the usual defects.

    Blank key every 31st, null summary every 7th, null status every 37th,
    null ``updated`` every 5th (offset ``-03:00`` every 5th + 1), reference
    date as plain date (even keys), as a late ``-03:00`` timestamp (odd keys),
    unparseable every 43rd. Windows are calendar years of the order date.
    """
    t = tickets(spark, sf)
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.select(
        k.alias("o_orderkey"),
        F.when(k % 31 == 0, F.lit("  ")).otherwise(F.concat(F.lit("TCK-"), k.cast("string"))).alias("issue_key"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("summary"),
        F.when(k % 37 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'").alias("created"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .when(k % 5 == 1, F.concat(day, F.lit("T07:00:00-03:00")))
        .otherwise(F.concat(day, F.lit("T10:00:00.000+0000"))).alias("updated"),
        F.col("base").alias("base_origem"),
        F.when(k % 43 == 0, F.lit("garbage")).when(k % 2 == 0, day).otherwise(F.concat(day, F.lit("T23:30:00-03:00"))).alias("data_referencia"),
        F.col("c_mktsegment").alias("espaco"),
        F.col("o_orderstatus").alias("tipo_ticket"),
        F.lit("2026-03-03T20:26:35.558569+00:00").alias("extracted_at"),
        F.lit("api").alias("source_mode"),
        day.alias("data_fechou_salesforce"),
        F.col("c_mktsegment").alias("tema"),
        F.trunc("o_orderdate", "year").alias("periodo_inicio"),
        F.date_sub(F.add_months(F.trunc("o_orderdate", "year"), 12), 1).alias("periodo_fim"),
    )


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as versions of an issue: key (order, line); arrival order = all columns, lexicographic.

    ``updated`` is the ship date as text (null every 10th part); the typed
    view has two spellings of one instant (``+0000`` / ``-03:00``).
    """
    li = table(spark, sf, "lineitem")
    key = F.concat(F.lit("LI-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    m = F.col("l_partkey") % 3
    return li.select(
        key.alias("issue_key"),
        F.when(F.col("l_partkey") % 10 == 0, F.lit(None).cast("string")).otherwise(day).alias("updated"),
        F.when(m == 0, F.concat(day, F.lit("T10:00:00+0000")))
        .when(m == 1, F.concat(day, F.lit("T07:00:00-03:00")))
        .otherwise(F.lit(None).cast("string")).alias("updated_ts"),
        F.when(F.col("l_suppkey") % 4 == 0, F.lit("bad")).otherwise(F.concat(day, F.lit("T00:00:00+0000"))).alias("created"),
        F.col("l_returnflag").alias("base"),
        F.concat(F.col("l_returnflag"), F.lit("/"), F.col("l_quantity").cast("string")).alias("summary"),
        F.col("l_linestatus").alias("status"),
        F.trunc("l_shipdate", "year").alias("periodo_inicio"),
        F.date_sub(F.add_months(F.trunc("l_shipdate", "year"), 12), 1).alias("periodo_fim"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus").alias("ordinal"),
    )


# event_type -> base of the audit runs (the other types stand for further bases)
AUDIT_BASE = {"purchase": "encerradas", "view": "analisadas", "signup": "ingressadas"}


def audit_events(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction audit events, one per driver event.

    base from the event type; failed (``error``) when the value is under 20,
    auth error when the user id is divisible by 3, else transient; fallback
    source when the value is within [20, 40); duration = value x 100 ms;
    records = user id x 10; run time = ts.
    """
    e = table(spark, sf, "events")
    base = F.coalesce(F.element_at(F.create_map(*[x for kv in AUDIT_BASE.items() for x in map(F.lit, kv)]), F.col("event_type")), F.col("event_type"))
    failed = F.col("value") < 20
    return e.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        base.alias("base"),
        F.when(failed, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        F.when(failed & (F.col("user_id") % 3 == 0), F.lit("auth")).when(failed, F.lit("transient")).alias("error_kind"),
        F.when((F.col("value") >= 20) & (F.col("value") < 40), F.lit("playwright_fallback")).otherwise(F.lit("api")).alias("source_mode"),
        F.round(F.col("value") * 100).cast("bigint").alias("duration_ms"),
        (F.col("user_id") * 10).alias("total_records"),
    )


# export headers per base (first existing candidate wins on read)
EXPORT_HEADERS = {
    # a name twice (the first counts) and one that differs in case only (the last counts)
    "encerradas": ("Issue key", "Summary", "Status", "Created", "updated", "Project key", "Issue Type", "DATA FECHOU SALESFORCE", "TEMA", "Status", "Updated"),
    "analisadas": ("Chave", "Resumo", "Status", "Data de criação", "Atualizado", "Espaço", "Tipo de item", "DATA ÚLTIMA ANÁLISE", "Tema"),
    "ingressadas": ("Issue key", "Summary", "Status", "Created", "Updated", "Project", "Ticket type", "DATA ABERTURA", "TEMA"),
}


def write_exports(spark: SparkSession, sf: str, root: str) -> dict[str, str]:
    """Fallback CSV exports, one directory per base, headers as that base's export names them, one in each file.

    Summary is the null token ``NA`` every 7th ticket.
    """

    def under(header: str):
        def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield pd.DataFrame({"value": [header]})
            yield from frames

        return task

    t = tickets(spark, sf)
    k = F.col("o_orderkey")
    values = [
        F.concat(F.lit("TCK-"), k.cast("string")),
        F.when(k % 7 == 0, F.lit("NA")).otherwise(F.col("c_name")),
        F.col("o_orderpriority"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'10:00:00.000'+0000'"),
        F.col("c_mktsegment"),
        F.col("o_orderstatus"),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.col("c_mktsegment"),
    ]
    paths = {}
    updated, decoy = values[4], F.lit("2000-01-01")
    for base, headers in EXPORT_HEADERS.items():
        path = f"{root}/{base}"
        cells = values if len(headers) == len(values) else [*values[:4], decoy, *values[5:], F.lit("other"), updated]
        line = F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"')) for c in cells])
        rows = t.where(F.col("base") == base).select(line.alias("value"))
        rows.mapInPandas(under(",".join(f'"{h}"' for h in headers)), "value string").write.text(path)
        paths[base] = path
    return paths


PAGE_SIZE = 100


def _issues_by_page(spark: SparkSession, sf: str) -> DataFrame:
    """(page, items): the parts of its issues, by order key; only parts are moved to their page, texts are made there.

    A page holds at most 100 issues by construction, so collecting one is bounded.
    """
    parts = issue_parts(tickets(spark, sf)).select((F.col("o_orderkey") / PAGE_SIZE).cast("bigint").alias("page"), "o_orderkey", "parts")
    return parts.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "parts"))).alias("items"))


def _joined_issues() -> Column:
    return F.array_join(F.transform("items", lambda x: issue_text(x["o_orderkey"], x["parts"])), ",")


def issue_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Search-result pages of 100 issues (by order key), each ending with a non-object item.

    Every 50th page (page % 50 = 49) is malformed: it has no ``issues`` list.
    """
    pages = _issues_by_page(spark, sf)
    body = F.concat(
        F.lit('{"page":'), F.col("page").cast("string"),
        F.lit(',"issues":['), _joined_issues(), F.lit(',"end-of-page"]'),
        F.lit(',"nextPageToken":"p'), (F.col("page") + 1).cast("string"), F.lit('"}'),
    )
    bad = F.concat(F.lit('{"page":'), F.col("page").cast("string"), F.lit(',"nextPageToken":"x"}'))
    return pages.select(F.when(F.col("page") % 50 == 49, bad).otherwise(body).alias("value"))


CHAIN_PAGES = 16


def page_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Search pages as they are landed: (chain, asked, value, landed), the payload without a page number, dealt out of order.

    Sixteen pages of :func:`issue_pages`' issues make a chain, whose last page
    names no token. Faults by chain c and place i: c % 5 = 4 lacks page 6;
    c % 3 = 1 has an empty page 9; c % 7 = 3 names page 2 on page 12 (a
    cycle); c % 4 = 2 landed page 4 twice; c % 11 = 5 lacks its first page.
    """
    pages = _issues_by_page(spark, sf)
    c, i = F.floor(F.col("page") / CHAIN_PAGES), F.col("page") % CHAIN_PAGES
    token = lambda at: F.substring(F.md5(F.concat_ws("/", c.cast("string"), at.cast("string"))), 1, 16)
    asked = F.when(i > 0, token(i))
    then = F.when((c % 7 == 3) & (i == 12), token(F.lit(2))).when(i < CHAIN_PAGES - 1, token(i + 1))
    body = F.when((c % 3 == 1) & (i == 9), F.lit("")).otherwise(_joined_issues())
    value = F.concat(F.lit('{"issues":['), body, F.lit("]"), F.coalesce(F.concat(F.lit(',"nextPageToken":"'), then, F.lit('"')), F.lit("")), F.lit("}"))
    kept = pages.where(~((c % 5 == 4) & (i == 6)) & ~((c % 11 == 5) & (i == 0)))
    copies = F.when((c % 4 == 2) & (i == 4), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # dealt while the items are short; the payloads are made where they are written
    dealt = kept.select("page", "items", F.explode(copies).alias("landed")).repartition(F.md5(F.concat_ws("/", F.col("page").cast("string"), F.col("landed").cast("string"))))
    return dealt.select(c.alias("chain"), asked.alias("asked"), value.alias("value"), "landed")


def event_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Events as they arrive: batch 0 to 3 by eight days of January, a tenth a batch late, a thirteenth again in the batch after."""
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    due = F.greatest(F.lit(0), F.least(F.lit(3), F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 8))).cast("int") + (F.col("event_id") % 10 == 0).cast("int")
    batches = F.when((F.col("event_id") % 13 == 0) & (due < 4), F.array(due, due + 1)).otherwise(F.array(due))
    return e.select("event_id", "ts", "event_type", F.explode(batches).alias("batch"))


# texts of business_predicates: name -> (every how many order keys the text changes, texts)
PREDICATE_VALUES = {
    "status": (1, ("ENCERRADO", "Encerrado ", "ANÁLISE", "analise", "Reiteradas  em aberto", "em verificacao", "FECHADO")),
    "espaco": (7, ("Atendimento Ouv", "ATENDIMENTO OUV", "Outro", None)),
    "tipo_ticket": (2, ("Atendimento", "ATENDIMENTO ", "Tarefa")),
}
