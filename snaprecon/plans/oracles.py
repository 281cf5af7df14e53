"""DuckDB statements that recompute each registered query from the raw tables.

They are written independently of the Spark operators: plain GROUP BY /
FULL JOIN / window SQL over the driver tables, with the fixture rules of
``plans/fixtures.py`` spelled out as CASE expressions.
"""

from __future__ import annotations

from snaprecon.plans.fixtures import DATE_FORMS

ORACLES: dict[str, str] = {}

# canonical text of a SQL expression (NFKD/strip accents, lower, trim, collapse whitespace)
def canon(x: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents({x})), '\\s+', ' ', 'g'))"


def scalar(x: str) -> str:
    return f"regexp_replace(trim(coalesce(CAST({x} AS VARCHAR), '')), '^([0-9]+)\\.0$', '\\1')"


BASE_CASE = "CASE o.o_orderstatus WHEN 'F' THEN 'encerradas' WHEN 'O' THEN 'analisadas' WHEN 'P' THEN 'ingressadas' END"

TICKETS = f"""
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
         c.c_name, c.c_mktsegment, {BASE_CASE} AS base
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

RECON_SIDES = f"""
WITH t AS ({TICKETS}),
loc AS (
  SELECT base,
         strftime(o_orderdate, '%Y-%m') AS month,
         {canon(scalar("CASE WHEN o_orderkey % 29 = 0 THEN CAST(o_custkey AS VARCHAR) || '.0' ELSE c_name END"))} AS summary,
         {canon(scalar('o_orderpriority'))} AS status
  FROM t
),
ref AS (
  SELECT base,
         strftime(o_orderdate, '%Y-%m') AS month,
         {canon(scalar("CASE WHEN o_orderkey % 29 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE c_name END"))} AS summary,
         CASE WHEN o_orderkey % 13 = 0 THEN 'reaberto' ELSE {canon(scalar('o_orderpriority'))} END AS status
  FROM t, range(CASE WHEN o_orderkey % 19 = 0 THEN 2 ELSE 1 END) AS r(i)
  WHERE o_orderkey % 17 <> 0 AND o_orderkey % 23 <> 0
),
lc AS (SELECT base, month, summary, status, count(*) AS l FROM loc GROUP BY ALL),
rcnt AS (SELECT base, month, summary, status, count(*) AS r FROM ref GROUP BY ALL),
sig AS (
  SELECT coalesce(lc.base, rcnt.base) AS base, coalesce(lc.month, rcnt.month) AS month,
         coalesce(lc.summary, rcnt.summary) AS summary, coalesce(lc.status, rcnt.status) AS status,
         coalesce(l, 0) AS l, coalesce(r, 0) AS r
  FROM lc FULL JOIN rcnt USING (base, month, summary, status)
),
rel AS (
  SELECT base, month, summary, sum(l) AS l, sum(r) AS r FROM sig GROUP BY ALL
)
"""

ORACLES["reconcile_month"] = RECON_SIDES + """
SELECT s.base, s.month,
       CAST(s.local_count AS BIGINT) AS local_count,
       CAST(s.reference_count AS BIGINT) AS reference_count,
       CAST(s.matched_count AS BIGINT) AS matched_count,
       CAST(s.missing_in_local_count AS BIGINT) AS missing_in_local_count,
       CAST(s.extra_in_local_count AS BIGINT) AS extra_in_local_count,
       CAST(x.relaxed_matched_count AS BIGINT) AS relaxed_matched_count,
       CAST(x.relaxed_missing_count AS BIGINT) AS relaxed_missing_count,
       CAST(x.relaxed_extra_count AS BIGINT) AS relaxed_extra_count
FROM (
  SELECT base, month, sum(l) AS local_count, sum(r) AS reference_count,
         sum(least(l, r)) AS matched_count, sum(greatest(r - l, 0)) AS missing_in_local_count,
         sum(greatest(l - r, 0)) AS extra_in_local_count
  FROM sig GROUP BY ALL
) s JOIN (
  SELECT base, month, sum(least(l, r)) AS relaxed_matched_count,
         sum(greatest(r - l, 0)) AS relaxed_missing_count, sum(greatest(l - r, 0)) AS relaxed_extra_count
  FROM rel GROUP BY ALL
) x USING (base, month)
WHERE s.local_count > 0
"""

ORACLES["signature_counts"] = RECON_SIDES + """
SELECT base, month, summary, status, CAST(l AS BIGINT) AS local_qty, CAST(r AS BIGINT) AS reference_qty FROM sig
"""

ORACLES["reconcile_relaxed"] = RECON_SIDES + """
SELECT base, month, CAST(sum(l) AS BIGINT) AS local_count, CAST(sum(r) AS BIGINT) AS reference_count,
       CAST(sum(least(l, r)) AS BIGINT) AS relaxed_matched_count,
       CAST(sum(greatest(r - l, 0)) AS BIGINT) AS relaxed_missing_count,
       CAST(sum(greatest(l - r, 0)) AS BIGINT) AS relaxed_extra_count
FROM rel GROUP BY ALL HAVING sum(l) > 0
"""

ORACLES["reconcile_scope"] = (
    RECON_SIDES.replace("  FROM t\n),\nref AS", "  FROM t WHERE o_orderdate < DATE '1998-01-01'\n),\nref AS")
    + """
SELECT base, month, CAST(sum(l) AS BIGINT) AS local_count, CAST(sum(r) AS BIGINT) AS reference_count,
       CAST(sum(least(l, r)) AS BIGINT) AS matched_count, sum(l) > 0 AS in_default_scope
FROM sig GROUP BY ALL
"""
)

ORACLES["reconcile_examples"] = RECON_SIDES + """
, sided AS (
  SELECT base, month, summary, status, 'missing' AS side, r - l AS qty FROM sig WHERE r > l
  UNION ALL
  SELECT base, month, summary, status, 'extra' AS side, l - r AS qty FROM sig WHERE l > r
)
SELECT base, month, summary, status, side, CAST(qty AS BIGINT) AS qty, CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY base, month, side ORDER BY qty DESC, summary, status) AS rank FROM sided
) WHERE rank <= 10
"""

ORACLES["multiset_except"] = RECON_SIDES + """
SELECT base, month, summary, status FROM ref
EXCEPT ALL
SELECT base, month, summary, status FROM loc
"""

ORACLES["multiset_intersect"] = RECON_SIDES + """
SELECT base, month, summary, status FROM loc
INTERSECT ALL
SELECT base, month, summary, status FROM ref
"""

TEXTS = """
  SELECT 'documents' AS origin, text FROM documents
  UNION ALL
  SELECT 'conversations' AS origin, text FROM conversations
"""

ORACLES["canonical_text"] = f"""
SELECT origin, md5(canon) AS canon_md5, CAST(length(canon) AS BIGINT) AS canon_chars, count(*) AS n_rows
FROM (SELECT origin, {canon('text')} AS canon FROM ({TEXTS})) GROUP BY origin, canon
"""

ORACLES["canonical_collisions"] = f"""
SELECT md5(canon) AS canon_md5, count(DISTINCT md5(text)) AS n_variants, count(*) AS n_rows
FROM (SELECT text, {canon('text')} AS canon FROM ({TEXTS})) GROUP BY canon HAVING count(DISTINCT md5(text)) > 1
"""

_DISPLAY = "p_brand || ' ÁREA ' || lower(p_type) || 'Size' || CAST(p_size AS VARCHAR) || '/ (' || p_name || ')'"
ORACLES["canonical_names"] = f"""
SELECT display_name,
       trim(regexp_replace({canon("regexp_replace(display_name, '([a-z0-9])([A-Z])', '\\1 \\2', 'g')")}, '[^a-z0-9]+', '_', 'g'), '_') AS column_name,
       count(*) AS n_parts
FROM (SELECT {_DISPLAY} AS display_name FROM part) GROUP BY display_name
"""

ORACLES["comparison_scalar"] = f"""
SELECT o.o_orderkey,
  {scalar('''CASE WHEN o.o_orderkey % 4 = 0 THEN CAST(o.o_totalprice AS VARCHAR)
            WHEN o.o_orderkey % 4 = 1 THEN '  ' || CAST(o.o_custkey AS VARCHAR) || '.0 '
            WHEN o.o_orderkey % 4 = 2 THEN NULL ELSE c.c_name END''')} AS value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

ORACLES["timestamp_parse"] = """
SELECT o_orderkey,
  CASE o_orderkey % 5
    WHEN 0 THEN CAST(o_orderdate AS DATE) + to_hours(o_orderkey % 24) + INTERVAL 15 MINUTE
    WHEN 1 THEN CAST(o_orderdate AS DATE) + to_hours(o_orderkey % 24 + 3) + INTERVAL 30 MINUTE
    WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
  END AS ts_utc
FROM orders
"""

ORACLES["date_local_vs_utc"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS local_date,
       CAST(CAST(o_orderdate AS DATE) + to_hours(o_orderkey % 24 + 3) + INTERVAL 30 MINUTE AS DATE) AS utc_date
FROM orders
"""

ORACLES["excel_serial_dates"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1, 2) THEN CAST(o_orderdate AS DATE) END AS d FROM orders
"""

_AT = "CAST(o_orderdate AS DATE) + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60)"
_KEPT = {"s": f"{_AT} + to_seconds(o_orderkey % 59)", "m": _AT, "h": "CAST(o_orderdate AS DATE) + to_hours(o_orderkey % 24)", "d": "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)", "": "CAST(NULL AS TIMESTAMP)"}
_FORMS = " ".join(f"WHEN {n} THEN {_KEPT[kept]}" for n, (_, _, kept) in enumerate(DATE_FORMS))
_EAST = " ".join(f"WHEN {n} THEN {east}" for n, (_, east, _) in enumerate(DATE_FORMS) if east)
ORACLES["date_forms"] = f"""
SELECT o_orderkey, wall - to_hours(east) AS ts_utc, CAST(wall AS DATE) AS local_date, CAST(wall - to_hours(east) AS DATE) AS utc_date, CAST(wall AS DATE) AS comparison_date
FROM (SELECT o_orderkey, CASE o_orderkey % {len(DATE_FORMS)} {_FORMS} END AS wall, CASE o_orderkey % {len(DATE_FORMS)} {_EAST} ELSE 0 END AS east FROM orders)
"""

ORACLES["month_volume"] = f"""
SELECT base, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_tickets FROM ({TICKETS}) GROUP BY ALL
"""

ORACLES["large_text_profile"] = """
SELECT lang, count(*) AS n_docs, CAST(sum(CASE WHEN length(text) > 4000 THEN 1 ELSE 0 END) AS BIGINT) AS n_large,
       CAST(max(length(text)) AS BIGINT) AS max_chars
FROM documents GROUP BY lang
"""


# ---------------------------------------------------------------- JSON ingest family

from snaprecon.plans.fixtures import CATALOG_GAP, CATALOG_OVERRIDE, PREDICATE_VALUES, custom_ids  # noqa: E402
from snaprecon.plans.spec import BASE_RULES, BUSINESS_RULES, CORE_API_FIELDS, SPECS  # noqa: E402

RUN_EXTRACTED_AT = "2026-03-03T20:26:35.558569+00:00"


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


MIXED = """CASE o_orderkey % 12
      WHEN 0 THEN o_orderpriority WHEN 1 THEN CAST(o_totalprice AS VARCHAR) WHEN 2 THEN CAST(o_custkey AS VARCHAR)
      WHEN 3 THEN CASE WHEN o_totalprice > 250000 THEN 'True' ELSE 'False' END WHEN 4 THEN NULL
      WHEN 5 THEN c_mktsegment WHEN 6 THEN CAST(o_custkey AS VARCHAR) WHEN 7 THEN c_name
      WHEN 8 THEN '{"id":' || CAST(o_custkey AS VARCHAR) || '}' WHEN 9 THEN NULL WHEN 10 THEN NULL
      ELSE o_orderpriority END"""

NOFIELDS = "o_orderkey % 89 = 0"
GOOD = "o_orderkey % 97 <> 0"
TS = "'%Y-%m-%dT%H:%M:%S.000+0000'"


def _nf(expr: str) -> str:
    return f"CASE WHEN {NOFIELDS} THEN NULL ELSE {expr} END"


CORE_SELECT = f"""
  'TCK-' || CAST(o_orderkey AS VARCHAR) AS issue_key,
  {_nf('c_name')} AS summary,
  CASE WHEN {NOFIELDS} OR o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS status,
  {_nf(f"strftime(o_orderdate, {TS})")} AS created,
  {_nf(f"strftime(o_orderdate + to_hours(CAST(o_orderkey % 48 AS INT)), {TS})")} AS updated,
  base AS base_origem,
  {_nf("strftime(o_orderdate, '%Y-%m-%d')")} AS data_referencia,
  {_nf('c_mktsegment')} AS espaco,
  {_nf('o_orderstatus')} AS tipo_ticket,
  {lit(RUN_EXTRACTED_AT)} AS extracted_at,
  'api' AS source_mode
"""

ORACLES["normalize_core"] = f"SELECT {CORE_SELECT} FROM ({TICKETS}) WHERE {GOOD}"


def _custom_value(i: int, name: str, is_date: bool) -> str:
    if name in (CATALOG_GAP, CATALOG_OVERRIDE):
        return "NULL"
    if is_date:
        return "strftime(o_orderdate, '%Y-%m-%d')"
    return "c_name" if i % 2 == 0 else MIXED


def _custom_columns() -> list[str]:
    cols = []
    for i, (name, _fid, is_date) in enumerate(custom_ids()):
        bases = [b for b, s in SPECS.items() if any(f.display_name == name for f in s.custom_fields)]
        column = next(f.column for s in SPECS.values() for f in s.custom_fields if f.display_name == name)
        in_base = " OR ".join(f"base = {lit(b)}" for b in bases)
        cols.append(f"CASE WHEN NOT ({in_base}) OR {NOFIELDS} THEN NULL ELSE {_custom_value(i, name, is_date)} END AS {q(column)}")
    return cols


ORACLES["normalize_custom"] = (
    "SELECT 'TCK-' || CAST(o_orderkey AS VARCHAR) AS issue_key, base AS base_origem,\n  "
    + ",\n  ".join(_custom_columns())
    + f"\nFROM ({TICKETS}) WHERE {GOOD}"
)

ORACLES["pick_scalar"] = f"""
SELECT 'TCK-' || CAST(o_orderkey AS VARCHAR) AS issue_key, o_orderkey % 12 AS shape, {_nf(MIXED)} AS value
FROM ({TICKETS}) WHERE {GOOD}
"""

ORACLES["status_name"] = f"""
SELECT 'TCK-' || CAST(o_orderkey AS VARCHAR) AS issue_key,
       CASE WHEN {NOFIELDS} OR o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS status,
       {_nf('o_orderpriority')} AS status_any
FROM ({TICKETS}) WHERE {GOOD}
"""

ORACLES["malformed_split"] = f"""
SELECT 'TCK-' || CAST(o_orderkey AS VARCHAR) AS issue_key,
       (o_orderkey % 97 = 0 OR NOT ({NOFIELDS})) AS has_fields,
       CASE WHEN o_orderkey % 97 = 0 THEN 'rejected' ELSE 'record' END AS verdict
FROM ({TICKETS})
"""

_PERIOD = "strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') || '__' || strftime(o_orderdate, '%Y') || '-12-31'"
ORACLES["raw_roundtrip"] = f"""
SELECT 'TCK-' || CAST(o_orderkey AS VARCHAR) AS issue_key, base AS base_origem, {_PERIOD} AS periodo FROM ({TICKETS})
"""

ORACLES["raw_scan"] = f"""
SELECT 'TCK-' || CAST(o_orderkey AS VARCHAR) AS issue_key, base AS base_origem, {_nf('c_name')} AS summary,
       CASE WHEN {NOFIELDS} OR o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS status,
       {_nf(f"strftime(o_orderdate + to_hours(CAST(o_orderkey % 48 AS INT)), {TS})")} AS updated
FROM ({TICKETS}) WHERE {GOOD}
"""


def _spec_catalog_values() -> str:
    rows = []
    for i, (n, fid, _) in enumerate(custom_ids()):
        if n == CATALOG_GAP:
            continue
        shown = n if i % 3 == 0 else (n.lower() if i % 3 == 1 else n.replace("A", "Á"))
        rows.append(f"({lit(shown)}, {lit(fid)}, {i})")
    return "VALUES " + ", ".join(rows)


CATALOG = f"""
  SELECT * FROM ({_spec_catalog_values()}) AS s(name, id, ordinal)
  UNION ALL
  SELECT CASE WHEN p_size = 1 THEN '  '
              WHEN p_partkey % 2 = 0 THEN p_type || ' ' || p_brand
              ELSE lower(p_type || '  ' || p_brand) END,
         CASE WHEN p_size = 2 THEN '' ELSE 'customfield_' || CAST(p_partkey + 20000 AS VARCHAR) END,
         p_partkey + 1000
  FROM part
  UNION ALL
  SELECT {lit(CATALOG_OVERRIDE.lower())}, 'customfield_' || CAST(p_partkey + 30000 AS VARCHAR), p_partkey + 1000
  FROM part WHERE p_partkey % 500 = 7
"""

CATALOG_CLEAN = f"""
  SELECT trim(name) AS display_name, trim(id) AS field_id, ordinal, {canon('trim(name)')} AS canon
  FROM ({CATALOG}) WHERE trim(name) <> '' AND trim(id) <> ''
"""

ORACLES["field_catalog"] = f"""
SELECT canon, arg_max(field_id, ordinal) AS field_id, arg_max(display_name, ordinal) AS display_name
FROM ({CATALOG_CLEAN}) GROUP BY canon
"""

_REQUIRED = "VALUES " + ", ".join(
    f"({lit(s.base)}, {pos}, {lit(f.display_name)})" for s in SPECS.values() for pos, f in enumerate(s.custom_fields)
)
RESOLVED = f"""
  SELECT r.display_name, {canon('r.display_name')} AS canon, w.field_id
  FROM (SELECT DISTINCT display_name FROM ({_REQUIRED}) AS x(base, position, display_name)) r
  LEFT JOIN (SELECT canon, arg_max(field_id, ordinal) AS field_id FROM ({CATALOG_CLEAN}) GROUP BY canon) w
    ON w.canon = {canon('r.display_name')}
"""

ORACLES["field_resolution"] = f"SELECT display_name, canon, field_id FROM ({RESOLVED})"

ORACLES["field_missing"] = f"""
SELECT x.base, string_agg(DISTINCT x.display_name, ',' ORDER BY x.display_name) AS missing_names,
       count(DISTINCT x.display_name) AS n_missing
FROM ({_REQUIRED}) AS x(base, position, display_name)
JOIN ({RESOLVED}) r USING (display_name)
WHERE r.field_id IS NULL
GROUP BY x.base
"""

_CORE_FIELDS = " UNION ALL ".join(
    f"SELECT b AS base, {i} AS position, {lit(f)} AS field FROM (VALUES ('encerradas'), ('analisadas'), ('ingressadas')) t(b)"
    for i, f in enumerate(CORE_API_FIELDS)
)
ORACLES["required_fields"] = f"""
SELECT base, CAST(position AS BIGINT) AS position, field FROM ({_CORE_FIELDS})
UNION ALL
SELECT base, CAST({len(CORE_API_FIELDS)} + row_number() OVER (PARTITION BY base ORDER BY x.position) - 1 AS BIGINT) AS position,
       r.field_id AS field
FROM ({_REQUIRED}) AS x(base, position, display_name) JOIN ({RESOLVED}) r USING (display_name)
WHERE r.field_id IS NOT NULL
"""


# ---------------------------------------------------------------- snapshots, dedup, typed load, quality

VERSIONS = """
  SELECT 'LI-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS issue_key,
         CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS updated,
         CASE WHEN l_partkey % 3 IN (0, 1) THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL 10 HOUR
              WHEN l_suppkey % 4 = 0 THEN TIMESTAMP '2026-03-03 20:26:35'
              ELSE CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) END AS resolved,
         l_returnflag AS base, l_returnflag || '/' || CAST(l_quantity AS VARCHAR) AS summary, l_linestatus AS status,
         make_date(year(l_shipdate), 12, 31) AS periodo_fim,
         l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
  FROM lineitem
"""
ORD = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"

ORACLES["dedup_keep_last"] = f"""
SELECT issue_key, updated, summary, status FROM (
  SELECT *, row_number() OVER (PARTITION BY issue_key, updated ORDER BY {ORD}) AS rn FROM ({VERSIONS})
) WHERE rn = 1
"""

ORACLES["resolved_updated"] = f"SELECT issue_key, l_partkey, l_suppkey, l_extendedprice, resolved FROM ({VERSIONS})"

ORACLES["dedup_typed"] = f"""
SELECT issue_key AS chave_ticket, resolved AS data_atualizacao, summary, status FROM (
  SELECT *, row_number() OVER (PARTITION BY issue_key, resolved ORDER BY {ORD}) AS rn FROM ({VERSIONS})
) WHERE rn = 1
"""

ORACLES["current_state"] = f"""
SELECT issue_key, periodo_fim, summary, status FROM (
  SELECT *, row_number() OVER (PARTITION BY issue_key ORDER BY periodo_fim DESC, {ORD}) AS rn FROM ({VERSIONS})
) WHERE rn = 1
"""

ORACLES["volume_and_dedup_rate"] = f"""
SELECT base, count(*) AS raw_rows, count(DISTINCT issue_key || '|' || coalesce(updated, '<null>')) AS kept_rows,
       round(1 - count(DISTINCT issue_key || '|' || coalesce(updated, '<null>')) / count(*), 6) AS discarded_share
FROM ({VERSIONS}) GROUP BY base
"""

CONTRACT = f"""
  SELECT o_orderkey, base, o_orderdate, o_orderpriority, c_name, c_mktsegment,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'TCK-' || CAST(o_orderkey AS VARCHAR) END AS key_text,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_name END AS summary,
         CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_orderpriority END AS status,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS created_ts,
         CASE WHEN o_orderkey % 5 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
              ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 10 HOUR END AS updated_ts,
         o_orderkey % 5 = 0 AS updated_null,
         CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS ref_local,
         CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE)
              ELSE CAST(o_orderdate AS DATE) + 1 END AS ref_utc,
         o_orderkey % 43 = 0 AS ref_bad
  FROM ({TICKETS})
"""

ORACLES["typed_projection"] = f"""
SELECT key_text AS chave_ticket, summary AS resumo, status, created_ts AS data_criacao, updated_ts AS data_atualizacao,
       base AS base_origem, ref_local AS data_referencia, c_mktsegment AS espaco, 'api' AS modo_origem,
       DATE '1995-01-01' AS periodo_inicio, DATE '2001-12-31' AS periodo_fim,
       CAST(o_orderdate AS DATE) AS data_fechou_salesforce, c_mktsegment AS tema, CAST(NULL AS DATE) AS data_de_abertura
FROM ({CONTRACT}) WHERE key_text IS NOT NULL
"""

_OUT = "(ref_utc < DATE '1995-01-01' OR ref_utc > DATE '1999-12-31')"
ORACLES["quality_report"] = f"""
SELECT base AS base_origem, count(*) AS n_rows, CAST(0 AS BIGINT) AS null_issue_key,
       CAST(sum(CASE WHEN status IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_status,
       CAST(sum(CASE WHEN updated_null THEN 1 ELSE 0 END) AS BIGINT) AS null_updated,
       CAST(sum(CASE WHEN {_OUT} THEN 1 ELSE 0 END) AS BIGINT) AS ref_outside_window,
       CAST(sum(CASE WHEN ref_bad THEN 1 ELSE 0 END) AS BIGINT) AS ref_unparseable,
       CASE WHEN sum(CASE WHEN status IS NULL THEN 1 ELSE 0 END) > 0 OR sum(CASE WHEN {_OUT} THEN 1 ELSE 0 END) > 0 THEN 'fail'
            WHEN sum(CASE WHEN updated_null THEN 1 ELSE 0 END) > 0 THEN 'warn' ELSE 'pass' END AS verdict
FROM ({CONTRACT}) GROUP BY base
"""

ORACLES["quarantine"] = f"""
SELECT o_orderkey, base AS base_origem, 'null_status' AS rule FROM ({CONTRACT}) WHERE status IS NULL
UNION ALL SELECT o_orderkey, base, 'null_updated' FROM ({CONTRACT}) WHERE updated_null
UNION ALL SELECT o_orderkey, base, 'ref_outside_window' FROM ({CONTRACT}) WHERE {_OUT}
"""

ORACLES["table_full_refresh"] = f"""
SELECT key_text AS chave_ticket, base AS base_origem, status, ref_local AS data_referencia
FROM ({CONTRACT}) WHERE key_text IS NOT NULL AND base <> 'encerradas'
"""

ORACLES["load_verification"] = f"""
SELECT base, count(*) AS expected, count(*) AS loaded, true AS ok FROM ({CONTRACT}) WHERE key_text IS NOT NULL GROUP BY base
"""


# ---------------------------------------------------------------- audit analytics, windows, rules

AUDIT = """
  SELECT event_id, ts,
         CASE event_type WHEN 'purchase' THEN 'encerradas' WHEN 'view' THEN 'analisadas' WHEN 'signup' THEN 'ingressadas'
              ELSE event_type END AS base,
         CASE WHEN value < 20 THEN 'error' ELSE 'success' END AS status,
         CASE WHEN value < 20 AND user_id % 3 = 0 THEN 'auth' WHEN value < 20 THEN 'transient' END AS error_kind,
         CASE WHEN value >= 20 AND value < 40 THEN 'playwright_fallback' ELSE 'api' END AS source_mode,
         CAST(round(value * 100) AS BIGINT) AS duration_ms,
         user_id * 10 AS total_records
  FROM events
"""

ORACLES["audit_append"] = f"SELECT event_id, base, CAST(ts AS DATE) AS recorded_date FROM ({AUDIT})"

ORACLES["audit_scan"] = f"SELECT event_id, base, status, error_kind, source_mode, duration_ms, total_records, ts FROM ({AUDIT})"

ORACLES["audit_rollup"] = f"""
SELECT base, count(*) AS runs, min(duration_ms) AS min_ms, quantile_cont(CAST(duration_ms AS DOUBLE), 0.5) AS median_ms,
       max(duration_ms) AS max_ms, round(sum(total_records) / (sum(duration_ms) / 1000.0), 6) AS records_per_sec,
       round(avg(CASE WHEN source_mode <> 'api' THEN 1.0 ELSE 0.0 END), 6) AS fallback_rate,
       round(avg(CASE WHEN status = 'success' THEN 1.0 ELSE 0.0 END), 6) AS success_rate
FROM ({AUDIT}) GROUP BY base
"""

ORACLES["fallback_streaks"] = f"""
WITH d AS (SELECT DISTINCT base, CAST(ts AS DATE) AS day FROM ({AUDIT}) WHERE source_mode <> 'api'),
g AS (SELECT base, day, day - CAST(row_number() OVER (PARTITION BY base ORDER BY day) AS INTEGER) AS grp FROM d)
SELECT base, min(day) AS streak_start, max(day) AS streak_end, count(*) AS days FROM g GROUP BY base, grp HAVING count(*) >= 2
"""

ORACLES["zero_volume_alert"] = f"""
WITH ev AS (SELECT * FROM ({AUDIT}) WHERE status = 'success' AND total_records > 0),
daily AS (SELECT base, CAST(ts AS DATE) AS day, sum(CASE WHEN source_mode = 'api' THEN total_records ELSE 0 END) AS volume
          FROM ev GROUP BY ALL),
span AS (SELECT base, min(day) AS lo, max(day) AS hi FROM daily GROUP BY base),
cal AS (SELECT base, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
f AS (SELECT cal.base, cal.day, coalesce(daily.volume, 0) AS volume FROM cal LEFT JOIN daily USING (base, day)),
w AS (SELECT *, avg(volume) OVER (PARTITION BY base ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS a FROM f)
SELECT base, day, CAST(volume AS BIGINT) AS volume, round(a, 6) AS trailing_avg, (volume = 0 AND coalesce(a > 0, false)) AS alert FROM w
"""

ORACLES["repeated_error_alert"] = f"""
SELECT base, event_id, ts, error_kind FROM (
  SELECT *, lag(error_kind) OVER (PARTITION BY base ORDER BY ts, event_id) AS prev FROM ({AUDIT})
) WHERE error_kind = 'auth' AND prev = 'auth'
"""

_RULES = "VALUES " + ", ".join(f"({lit(b)}, {fid}, {lit(dn)})" for b, (fid, _, dn) in BASE_RULES.items())
ORACLES["query_fingerprint"] = f"""
WITH r AS (SELECT event_id, base, CAST(ts AS DATE) - 1 AS to_date FROM ({AUDIT})),
w AS (SELECT event_id, base, CAST(to_date - INTERVAL 1 MONTH AS DATE) AS from_date, to_date FROM r)
SELECT w.event_id, w.base, w.from_date, w.to_date,
       sha256('filter = ' || CAST(x.fid AS VARCHAR) || ' AND "' || x.dn || '" >= "' || CAST(w.from_date AS VARCHAR)
              || '" AND "' || x.dn || '" <= "' || CAST(w.to_date AS VARCHAR) || '" ORDER BY created DESC') AS query_hash
FROM w JOIN ({_RULES}) AS x(base, fid, dn) USING (base)
"""

_CONTRACT_KEY = "CASE WHEN o_orderkey % 31 = 0 THEN '  ' ELSE 'TCK-' || CAST(o_orderkey AS VARCHAR) END"
ORACLES["source_preference"] = f"""
WITH last AS (
  SELECT base, status = 'success' AS ok FROM (
    SELECT *, row_number() OVER (PARTITION BY base ORDER BY ts DESC, event_id DESC) AS rn FROM ({AUDIT})) WHERE rn = 1
), c AS (SELECT {_CONTRACT_KEY} AS issue_key, base AS base_origem, status FROM ({CONTRACT}))
SELECT c.issue_key, c.base_origem, c.status, 'api' AS source_mode, CAST(NULL AS VARCHAR) AS fallback_file
FROM c JOIN last ON last.base = c.base_origem AND last.ok
UNION ALL
SELECT c.issue_key, c.base_origem, c.status, 'playwright_fallback', 'export_' || c.base_origem || '.csv'
FROM c JOIN last ON last.base = c.base_origem AND NOT last.ok
"""

ORACLES["rolling_windows"] = f"""
WITH t AS (SELECT CAST(o_orderdate AS DATE) AS ref_date FROM ({TICKETS})),
runs AS (SELECT DISTINCT ref_date AS run_date FROM t),
w AS (SELECT run_date, CAST((run_date - 1) - INTERVAL 1 MONTH AS DATE) AS window_from, run_date - 1 AS window_to FROM runs)
SELECT w.run_date, w.window_from, w.window_to, count(*) AS n_tickets
FROM w JOIN t ON t.ref_date BETWEEN w.window_from AND w.window_to GROUP BY ALL
"""

ORACLES["window_filter"] = f"""
SELECT 'TCK-' || CAST(o_orderkey AS VARCHAR) AS issue_key, {BASE_CASE} AS base FROM orders o
WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31 23:59:59.999999'
"""

ORACLES["business_rules_filter"] = f"""
SELECT 'TCK-' || CAST(o_orderkey AS VARCHAR) AS issue_key, base, o_orderpriority AS status FROM ({TICKETS})
WHERE (base = 'encerradas' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))
   OR (base = 'analisadas' AND o_orderpriority = '3-MEDIUM')
   OR (base = 'ingressadas' AND o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW'))
"""

ORACLES["ordered_extract"] = f"""
SELECT {_CONTRACT_KEY} AS issue_key, base AS base_origem, strftime(o_orderdate, {TS}) AS created
FROM ({TICKETS}) WHERE year(o_orderdate) = 1998
"""


# ---------------------------------------------------------------- fallback exports, snapshots, report, evolution

_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_EXPORT = {
    "issue_key": "'TCK-' || CAST(o_orderkey AS VARCHAR)",
    "summary": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_name END",
    "status": "o_orderpriority",
    "created": f"strftime(o_orderdate, {TS})",
    "updated": "strftime(o_orderdate, '%Y-%m-%dT10:00:00.000+0000')",
    "base_origem": "base",
    "data_referencia": _DAY,
    "espaco": "c_mktsegment",
    "tipo_ticket": "o_orderstatus",
    "extracted_at": lit(RUN_EXTRACTED_AT),
    "source_mode": "'playwright_fallback'",
    "tema": "c_mktsegment",
    "data_fechou_salesforce": f"CASE WHEN base = 'encerradas' THEN {_DAY} END",
    "data_ultima_analise": f"CASE WHEN base = 'analisadas' THEN {_DAY} END",
}

ORACLES["csv_contract"] = "SELECT " + ", ".join(
    f"{_EXPORT[c]} AS {c}" for c in ("issue_key", "summary", "status", "created", "updated", "base_origem", "data_referencia",
                                      "espaco", "tipo_ticket", "source_mode", "tema")
) + f" FROM ({TICKETS})"

ORACLES["header_candidates"] = f"""
SELECT base AS base_origem, c_mktsegment AS espaco, o_orderstatus AS tipo_ticket, strftime(o_orderdate, '%Y') AS ref_year,
       count(*) AS n
FROM ({TICKETS}) GROUP BY ALL
"""

ORACLES["contract_align"] = "SELECT " + ", ".join(
    f"{_EXPORT.get(c, 'CAST(NULL AS VARCHAR)')} AS {q(c)}" for c in SPECS["ingressadas"].text_columns
) + f" FROM ({TICKETS})"

SNAP = f"""
  SELECT * FROM (
    SELECT {_CONTRACT_KEY} AS issue_key,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_name END AS summary,
           CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_orderpriority END AS status,
           CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN {_DAY} || 'T07:00:00-03:00'
                ELSE {_DAY} || 'T10:00:00.000+0000' END AS updated,
           base AS base_origem, make_date(year(o_orderdate), 1, 1) AS periodo_inicio,
           make_date(year(o_orderdate), 12, 31) AS periodo_fim, o_orderkey
    FROM ({TICKETS})
  ) QUALIFY row_number() OVER (PARTITION BY issue_key, updated ORDER BY o_orderkey DESC) = 1
"""

ORACLES["snapshot_roundtrip"] = f"SELECT issue_key, summary, status, base_origem, periodo_inicio, periodo_fim FROM ({SNAP})"
ORACLES["snapshot_scan"] = f"SELECT issue_key, summary, status, updated, base_origem, periodo_inicio, periodo_fim FROM ({SNAP})"
ORACLES["snapshot_manifest"] = f"""
SELECT base_origem AS base, periodo_inicio AS from_date, periodo_fim AS to_date, count(*) AS record_count,
       'csv,parquet,xlsx' AS formats, CAST(periodo_inicio AS VARCHAR) || '__' || CAST(periodo_fim AS VARCHAR) AS period_token
FROM ({SNAP}) GROUP BY ALL
"""
ORACLES["latest_snapshot"] = f"""
SELECT issue_key, base_origem, periodo_inicio, periodo_fim FROM ({SNAP}) s
WHERE periodo_fim = (SELECT max(periodo_fim) FROM ({SNAP}) x WHERE x.base_origem = s.base_origem)
"""
ORACLES["snapshot_by_run_date"] = f"""
SELECT issue_key, base_origem, periodo_inicio, periodo_fim FROM ({SNAP}) s
WHERE periodo_fim = (SELECT max(periodo_fim) FROM ({SNAP}) x WHERE x.base_origem = s.base_origem AND x.periodo_fim <= DATE '1997-06-30')
"""
ORACLES["blank_row_drop"] = "SELECT o_orderkey FROM orders WHERE o_orderkey % 13 <> 0"
ORACLES["base_overwrite"] = f"""
SELECT base_origem, periodo_inicio, periodo_fim, count(*) AS n FROM ({SNAP})
WHERE base_origem <> 'analisadas' OR periodo_inicio = DATE '2001-01-01' GROUP BY ALL
"""
ORACLES["report_flat"] = (
    ORACLES["reconcile_month"].replace("SELECT s.base, s.month,", "SELECT s.base, s.month, 'processed/latest.csv' AS csv_file,", 1)
)

_OLD = {"chave_ticket": "string", "resumo": "string", "status": "string", "data_criacao": "string", "base_origem": "string",
        "data_fechou_salesforce": "string"}


def _diff_rows() -> str:
    rows = []
    for f in SPECS["encerradas"].typed_schema().fields:
        exp = f.dataType.simpleString()
        cur = _OLD.get(f.name)
        if cur is None:
            action = "add"
        elif cur == exp:
            action = "keep"
        elif exp == "date" and cur == "string":
            action = "to_date"
        else:
            action = "retype"
        rows.append(f"({lit(f.name)}, {lit(exp)}, {lit(cur) if cur else 'NULL'}, {lit(action)})")
    return "VALUES " + ", ".join(rows)


# old column -> (null, longest text, lost) over the old table's tickets
_OLD_FACTS = {
    "chave_ticket": ("0", f"max(length({_CONTRACT_KEY}))", "0"),
    "resumo": ("count(*) FILTER (WHERE o_orderkey % 7 = 0)", "max(length(c_name)) FILTER (WHERE o_orderkey % 7 <> 0)", "0"),
    "status": ("count(*) FILTER (WHERE o_orderkey % 37 = 0)", "max(length(o_orderpriority)) FILTER (WHERE o_orderkey % 37 <> 0)", "0"),
    "data_criacao": ("0", "max(28)", "0"),
    "base_origem": ("0", "max(length(base))", "0"),
    "data_fechou_salesforce": ("0", "10", "count(*) FILTER (WHERE o_orderkey % 9 = 0)"),
}
_OLD_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {n} AS n_null, {longest} AS max_chars, {lost} AS n_lost FROM ({TICKETS}) WHERE year(o_orderdate) < 2000"
    for c, (n, longest, lost) in _OLD_FACTS.items()
)
ORACLES["schema_diff"] = f"""
SELECT d.column_name, d.expected_type, d.existing_type, d.action, c.existing_rows,
       CAST(coalesce(f.n_null, c.existing_rows) AS BIGINT) AS n_null, CAST(f.max_chars AS BIGINT) AS max_chars, CAST(coalesce(f.n_lost, 0) AS BIGINT) AS n_lost
FROM ({_diff_rows()}) AS d(column_name, expected_type, existing_type, action)
CROSS JOIN (SELECT count(*) AS existing_rows FROM ({TICKETS}) WHERE year(o_orderdate) < 2000) c
LEFT JOIN ({_OLD_ROWS}) f USING (column_name)
"""
ORACLES["schema_add_columns"] = f"""
SELECT base AS base_origem, count(*) AS n_rows, count(*) FILTER (WHERE year(o_orderdate) >= 2000) AS n_tema,
       count(*) FILTER (WHERE year(o_orderdate) < 2000) AS n_fechou
FROM ({TICKETS}) GROUP BY base
"""
ORACLES["schema_text_to_date"] = f"""
SELECT {_CONTRACT_KEY} AS chave_ticket, base AS base_origem,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS data_fechou_salesforce
FROM ({TICKETS}) WHERE year(o_orderdate) < 2000
"""


# ---------------------------------------------------------------- paged payloads, streaming

ORACLES["paged_explode"] = f"""
SELECT page_no, pos, issue_key FROM (
  SELECT o_orderkey // 100 AS page_no,
         row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS pos,
         'TCK-' || CAST(o_orderkey AS VARCHAR) AS issue_key
  FROM ({TICKETS})
) WHERE page_no % 50 <> 49
"""

ORACLES["paged_rejects"] = f"""
SELECT DISTINCT o_orderkey // 100 AS page_no, 'no issues list' AS reason FROM ({TICKETS}) WHERE (o_orderkey // 100) % 50 = 49
"""

ORACLES["stream_ingest"] = ORACLES["raw_scan"]

ORACLES["stream_dedup_volume"] = """
SELECT CAST(ts AS DATE) AS day, event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY ALL
"""

ORACLES["large_text_rows"] = """
SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE greatest(length(text), length(lang), length(source)) > 4000) AS n_large
FROM documents GROUP BY source
"""

ORACLES["name_collisions"] = f"""
SELECT canon, count(*) AS n_variants, CAST(sum(n) AS BIGINT) AS n_rows FROM (
  SELECT raw, {canon('raw')} AS canon, count(*) AS n FROM (
    SELECT CASE p_partkey % 3 WHEN 0 THEN upper(p_type) WHEN 1 THEN lower(p_type) ELSE ' ' || p_type || '  ' END AS raw FROM part
  ) GROUP BY raw
) GROUP BY canon HAVING count(*) > 1
"""

_CONTRACT_COLUMNS = ("issue_key", "summary", "status", "created", "updated", "base_origem", "data_referencia", "espaco", "tipo_ticket",
                     "extracted_at", "source_mode", "data_fechou_salesforce", "tema")
_MISSING = ", ".join(f"('{b}', '{','.join(c for c in spec.text_columns if c not in _CONTRACT_COLUMNS)}')" for b, spec in SPECS.items())
ORACLES["contract_report"] = f"""
SELECT base AS base_origem, count(*) AS n_rows, count(*) FILTER (WHERE key_text IS NULL) AS null_issue_key,
       count(*) FILTER (WHERE status IS NULL) AS null_status, count(*) FILTER (WHERE updated_null) AS null_updated,
       count(*) FILTER (WHERE {_OUT}) AS ref_outside_window, count(*) FILTER (WHERE ref_bad) AS ref_unparseable,
       'fail' AS verdict, missing
FROM ({CONTRACT}) JOIN (VALUES {_MISSING}) m(b, missing) ON b = base GROUP BY base, missing
"""

_PREDICATES = ", ".join(
    "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + f"][CAST(o_orderkey // {step} % {len(values)} AS INTEGER) + 1] AS {name}"
    for name, (step, values) in PREDICATE_VALUES.items()
)
_ALLOWED = " OR ".join(
    f"(base = '{base}' AND " + " AND ".join(f"{canon(a)} IN (" + ", ".join(canon(f"'{v}'") for v in values) + ")" for a, values in by.items()) + ")"
    for base, by in BUSINESS_RULES.items()
)
ORACLES["business_predicates"] = f"SELECT * FROM (SELECT o_orderkey, base, {_PREDICATES} FROM ({TICKETS})) WHERE {_ALLOWED}"

ORACLES["paged_chain"] = f"""
SELECT page_no, n_issues FROM (SELECT o_orderkey // 100 AS page_no, count(*) AS n_issues FROM ({TICKETS}) GROUP BY ALL)
WHERE page_no % 50 <> 49 AND page_no % 10 <= 6 AND NOT ((page_no // 10) % 2 = 1 AND page_no % 10 >= 3)
"""

ORACLES["stream_window_counts"] = "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n_events FROM events GROUP BY ALL"
ORACLES["stream_current_state"] = """
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
"""

# ---------------------------------------------------------------- page chains by token, ordinals, windows of any length

# the faults of a chain's pages, by arithmetic on the order keys; cutoff: the last place that is reached
_CHAINS = f"""
WITH pages AS (
  SELECT o_orderkey // 100 // 16 AS c, o_orderkey // 100 % 16 AS i, count(*) AS n, 'TCK-' || CAST(min(o_orderkey) AS VARCHAR) AS first_issue
  FROM ({TICKETS}) GROUP BY ALL
), landed AS (
  SELECT c, i, CASE WHEN c % 3 = 1 AND i = 9 THEN 0 ELSE n END AS n, CASE WHEN c % 3 = 1 AND i = 9 THEN NULL ELSE first_issue END AS first_issue
  FROM pages WHERE NOT (c % 5 = 4 AND i = 6) AND NOT (c % 11 = 5 AND i = 0)
), gaps AS (
  SELECT c, min(i) FILTER (i <> rn) AS gap, max(i) AS top FROM (SELECT c, i, row_number() OVER (PARTITION BY c ORDER BY i) - 1 AS rn FROM landed) GROUP BY c
), runs AS (  -- contiguous pages from the first
  SELECT c, (SELECT coalesce(min(k), 16) - 1 FROM range(17) r(k) WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.c = gaps.c AND l.i = k)) AS solid FROM gaps
), cut AS (
  SELECT c, solid, least(solid, CASE WHEN c % 3 = 1 THEN 9 ELSE 99 END, CASE WHEN c % 7 = 3 THEN 12 ELSE 99 END) AS cutoff FROM runs
)
"""

ORACLES["page_chain_order"] = _CHAINS + """
SELECT c AS chain, i AS position, n AS n_issues, first_issue FROM landed JOIN cut USING (c) WHERE i <= cutoff
"""

ORACLES["page_chain_report"] = _CHAINS + """
SELECT c AS chain,
       CASE WHEN cutoff < 0 THEN 'headless' WHEN c % 3 = 1 AND cutoff = 9 THEN 'whole' WHEN c % 7 = 3 AND cutoff = 12 THEN 'cyclic'
            WHEN cutoff = 15 THEN 'whole' ELSE 'broken' END AS chain_state,
       count(*) FILTER (i <= cutoff) AS n_pages, count(*) FILTER (i > cutoff) AS n_orphans, count(*) FILTER (c % 4 = 2 AND i = 4) AS n_repeated
FROM landed JOIN cut USING (c) GROUP BY c, cutoff
"""

ORACLES["extract_ordinals"] = f"""
SELECT {_CONTRACT_KEY} AS issue_key, base AS base_origem, strftime(o_orderdate, {TS}) AS created,
       row_number() OVER (ORDER BY strftime(o_orderdate, {TS}) DESC, o_orderkey) - 1 AS ordinal
FROM ({TICKETS}) WHERE year(o_orderdate) = 1998
"""

_WINDOWS = f"""
WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ref_date FROM ({TICKETS})),
w AS (
  SELECT length, window_to - days + 1 AS window_from, window_to
  FROM (SELECT min(ref_date) AS window_to FROM t GROUP BY date_trunc('month', ref_date)), (VALUES ('day', 1), ('week', 7), ('quarter', 91), ('year', 365), ('five_years', 1826)) l(length, days)
)
"""

ORACLES["rolling_windows_any"] = _WINDOWS + """
SELECT length, window_from, window_to, count(*) AS n_tickets FROM w JOIN t ON ref_date BETWEEN window_from AND window_to GROUP BY ALL
"""

ORACLES["window_membership"] = _WINDOWS + """
SELECT length, window_from, window_to, count(*) AS n_tickets, min(o_orderkey) AS least_key, max(o_orderkey) AS greatest_key
FROM w JOIN t ON ref_date BETWEEN window_from AND window_to GROUP BY ALL
"""

ORACLES["load_loss"] = f"""
SELECT base, count(*) AS expected, count(*) FILTER (NOT lost) AS loaded, count(*) FILTER (lost) = 0 AS ok
FROM (SELECT base, base = 'analisadas' AND o_orderkey % 10 = 7 AS lost FROM ({TICKETS}) WHERE o_orderkey % 31 <> 0) GROUP BY base
"""

ORACLES["normalize_shredded"] = ORACLES["normalize_core"]
ORACLES["current_state_incremental"] = ORACLES["current_state"]
ORACLES["stream_state_incremental"] = ORACLES["stream_current_state"]
ORACLES["rules_by_collation"] = ORACLES["business_rules_filter"]

ORACLES["shredded_volume"] = f"""
SELECT base AS base_origem, count(*) AS n_issues, count(DISTINCT c_name) FILTER (has_fields) AS n_summaries, count(*) FILTER (has_fields AND o_orderkey % 11 <> 0) AS n_named_status
FROM (SELECT *, o_orderkey % 89 <> 0 AS has_fields FROM ({TICKETS}) WHERE o_orderkey % 97 <> 0) GROUP BY base
"""

ORACLES["stream_late_rows"] = """
WITH due AS (
  SELECT event_id, ts, greatest(0, least(3, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 8)) + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS b FROM events
), d AS (
  SELECT event_id, ts, b FROM due UNION ALL SELECT event_id, ts, b + 1 FROM due WHERE event_id % 13 = 0 AND b < 4
), marks AS (
  SELECT n AS b, (SELECT max(ts) FROM d WHERE d.b < n) - INTERVAL 1 DAY AS mark FROM range(5) r(n)
), judged AS (
  SELECT d.*, coalesce(ts < mark, false) AS late FROM d JOIN marks USING (b)
), ranked AS (
  SELECT *, CASE WHEN NOT late THEN row_number() OVER (PARTITION BY event_id, late ORDER BY b) END AS nth FROM judged
)
SELECT b AS batch_id, count(*) AS n_landed, count(*) FILTER (nth = 1) AS n_kept, count(*) FILTER (late) AS n_late, count(*) FILTER (nth > 1) AS n_repeated
FROM ranked GROUP BY b
"""

ORACLES["zone_run_windows"] = f"""
SELECT event_id, run_date, CAST((run_date - 1) - INTERVAL 1 MONTH AS DATE) AS window_from, run_date - 1 AS window_to
FROM (SELECT event_id, CAST(ts - INTERVAL 3 HOUR AS DATE) AS run_date FROM ({AUDIT}))
"""

_LAYERS = f"""
SELECT year(o_orderdate) AS ano, {_CONTRACT_KEY} AS chave_ticket, CASE WHEN o_orderkey % 7 <> 0 THEN c_name END AS resumo,
       CASE WHEN o_orderkey % 37 <> 0 THEN o_orderpriority END AS status, base AS base_origem,
       CASE WHEN o_orderkey % 43 = 0 OR (year(o_orderdate) <= 1994 AND o_orderkey % 9 = 0) THEN NULL ELSE CAST(o_orderdate AS DATE) END AS data_referencia,
       CASE WHEN year(o_orderdate) > 1996 THEN c_mktsegment END AS tema
FROM ({TICKETS}) WHERE o_orderkey % 31 <> 0
"""
ORACLES["layouts_read"] = f"SELECT CAST(ano AS VARCHAR) AS ano, * EXCLUDE (ano) FROM ({_LAYERS})"
ORACLES["layouts_migrate"] = f"SELECT CAST(ano AS INTEGER) AS ano, count(*) AS n_rows, count(data_referencia) AS n_dates, count(tema) AS n_themes FROM ({_LAYERS}) GROUP BY ano"

ORACLES["stream_day_alerts"] = f"""
WITH ev AS (SELECT base, CAST(ts AS DATE) AS day, CASE WHEN event_id % 3 > 0 THEN total_records ELSE 0 END AS volume, source_mode <> 'api' AS fallback, ts FROM ({AUDIT})),
daily AS (SELECT base, day, sum(volume) AS volume, bool_or(fallback) AS fallback FROM ev GROUP BY ALL),
cal AS (
  SELECT base, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT base, min(day) AS lo FROM daily GROUP BY base), (SELECT CAST(max(ts) - INTERVAL 2 DAY AS DATE) AS hi FROM ev)
),
f AS (SELECT base, day, coalesce(volume, 0) AS volume, coalesce(fallback, false) AS fallback FROM cal LEFT JOIN daily USING (base, day)),
w AS (
  SELECT *, avg(volume) OVER (PARTITION BY base ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS a,
         count(*) FILTER (NOT fallback) OVER (PARTITION BY base ORDER BY day) AS grp FROM f
)
SELECT base, day, CAST(volume AS BIGINT) AS volume, round(a, 6) AS trailing_avg, (volume = 0 AND coalesce(a > 0, false)) AS alert, fallback,
       CAST(CASE WHEN fallback THEN count(*) FILTER (fallback) OVER (PARTITION BY base, grp ORDER BY day) ELSE 0 END AS INTEGER) AS streak FROM w
"""
