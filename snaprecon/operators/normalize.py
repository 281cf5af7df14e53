"""Raw issues -> the per-base text contract.

One generated ``select`` per base: core columns (P1), custom columns from
resolved field ids (P2), run literals (P9). Each value goes through P3/P4 on
a VARIANT parsed once per record, so the JSON text is never re-parsed per
column. Malformed records (``fields`` present but not an object) are split
off into a rejects frame (F3); the raw text stays available for the raw sink.

Field ids are resolved by a join (J1); the resolved map is bounded by the
spec (a few dozen names) and is what compiles the ``select`` list, the same
way a schema would.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaprecon.functions import text as tx
from snaprecon.functions import variant as vx
from snaprecon.plans.spec import (
    HEADER_CANDIDATES,
    INGRESSADAS_EXTRA_DATE_HEADER,
    SOURCE_API,
    SOURCE_FALLBACK,
    SPECS,
    BaseSpec,
    canonical,
)


@dataclass(frozen=True)
class Run:
    """Literals fixed once per run on the driver (never ``current_timestamp()`` per write)."""

    extracted_at: str  # ISO text with offset, as records carry it
    period_from: str  # yyyy-MM-dd
    period_to: str


# ------------------------------------------------------------------ parsing

def parse_raw(df: DataFrame, text_col: str = "value") -> DataFrame:
    """JSON text -> VARIANT column ``v`` (bad JSON -> null ``v``).

    The value comes out of a generator of one element: no filter is pushed
    below it, so the text is parsed once however often ``v`` is used.
    """
    return df.select("*", F.explode(F.array(F.try_parse_json(F.col(text_col)))).alias("v"))


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, rejects). ``fields`` absent -> kept (all-null record); present but not an object -> rejected."""
    v = F.col("v")
    # the copy of ``fields`` is made only for a record where it is no object
    bad = v.isNull() | (~vx.is_object(v, "$.fields") & vx.path(v, "$.fields").isNotNull())
    flagged = parsed.withColumn("_bad", bad)
    return flagged.where(~F.col("_bad")).drop("_bad"), flagged.where(F.col("_bad")).drop("_bad")


# ------------------------------------------------------------------ field catalogue / resolution

def catalog_entries(catalog: DataFrame, name: str = "name", fid: str = "id", ordinal: str = "ordinal") -> DataFrame:
    """S3: blank names / ids dropped; the last entry per canonical name wins."""
    clean = catalog.select(
        F.trim(F.col(name)).alias("display_name"), F.trim(F.col(fid)).alias("field_id"), F.col(ordinal).alias("ordinal")
    ).where((F.col("display_name") != "") & (F.col("field_id") != ""))
    keyed = clean.withColumn("canon", tx.canonical_text("display_name"))
    return keyed.groupBy("canon").agg(
        F.max_by(F.struct("field_id", "display_name"), "ordinal").alias("w")
    ).select("canon", "w.field_id", "w.display_name")


def required_frame(spark: SparkSession, bases: tuple[str, ...] | None = None) -> DataFrame:
    """Required custom display names per base (from the spec; bounded by it)."""
    rows = [
        (s.base, pos, f.display_name, f.column, f.is_date)
        for s in SPECS.values()
        if bases is None or s.base in bases
        for pos, f in enumerate(s.custom_fields)
    ]
    return spark.createDataFrame(rows, "base string, position int, display_name string, column_name string, is_date boolean")


def resolve_fields(catalog: DataFrame, required: DataFrame) -> DataFrame:
    """Required display name -> field id via canonical name; unresolved -> null id.

    The catalogue may be large; the required list is bounded by the spec, so
    it is the broadcast side and the catalogue is semi-joined down to the
    required names before its keep-last aggregation.
    """
    names = required.select("display_name").distinct().withColumn("canon", tx.canonical_text("display_name"))
    wanted = F.broadcast(names.select("canon").distinct())
    clean = catalog.select(
        F.trim(F.col("name")).alias("cat_name"), F.trim(F.col("id")).alias("field_id"), F.col("ordinal")
    ).where((F.col("cat_name") != "") & (F.col("field_id") != ""))
    keyed = clean.withColumn("canon", tx.canonical_text("cat_name")).join(wanted, "canon", "left_semi")
    winners = keyed.groupBy("canon").agg(F.max_by("field_id", "ordinal").alias("field_id"))
    return names.join(winners, "canon", "left").select("display_name", "canon", "field_id")


def missing_fields(required: DataFrame, resolved: DataFrame) -> DataFrame:
    """Unresolved names per base, sorted and comma-joined."""
    unresolved = required.join(resolved.where(F.col("field_id").isNotNull()), "display_name", "left_anti")
    return unresolved.groupBy("base").agg(
        F.array_join(F.sort_array(F.collect_set("display_name")), ",").alias("missing_names"),
        F.count_distinct("display_name").alias("n_missing"),
    )


def field_id_map(resolved: DataFrame) -> dict[str, str]:
    """Resolved ids as a driver dict to compile the select list: at most one per display name of the spec."""
    return {r.display_name: r.field_id for r in resolved.where(F.col("field_id").isNotNull()).select("display_name", "field_id").collect()}


def requested_fields(spark: SparkSession, resolved: DataFrame, core: tuple[str, ...]) -> DataFrame:
    """Per base, the ordered distinct list of fields to request (core first, then resolved ids)."""
    req = required_frame(spark)
    ids = req.join(resolved.select("display_name", "field_id"), "display_name", "left").where(F.col("field_id").isNotNull())
    per_base = ids.groupBy("base").agg(F.sort_array(F.collect_list(F.struct("position", "field_id"))).alias("ids"))
    core_arr = F.array(*[F.lit(c) for c in core])
    return per_base.select(
        "base",
        F.posexplode(F.array_distinct(F.concat(core_arr, F.transform("ids", lambda x: x["field_id"])))).alias("position", "field"),
    ).withColumn("position", F.col("position").cast("bigint"))


# ------------------------------------------------------------------ projection

def normalize_api_bases(records: DataFrame, base_col: str, specs: dict[str, BaseSpec], ids: dict[str, str], run: Run,
                        keep: tuple[str, ...] = (), source_mode: str = SOURCE_API, custom: bool = True) -> DataFrame:
    """All bases in one pass: one parse, one P3 stage, columns nulled where a base lacks them.

    All values of a record travel in one array, which column pruning does not
    reach into: ``custom=False`` leaves the custom columns out and unrendered.

    Output columns: core contract + the union of the bases' custom columns
    (in first-seen order). Cheaper than one filtered pass per base.
    """
    v = F.col("v")
    picks: dict[str, Column] = {
        "summary": vx.member(v, "fields", "summary"),
        "created": vx.member(v, "fields", "created"),
        "updated": vx.member(v, "fields", "updated"),
        "espaco": vx.member(v, "fields", "project"),
        "tipo_ticket": vx.member(v, "fields", "issuetype"),
    }
    owners: dict[str, list[str]] = {}
    ref_by_base = {}
    for b, spec in specs.items():
        date_id = ids.get(spec.date_field)
        if date_id:
            key = f"__ref_{date_id}"
            picks.setdefault(key, vx.member(v, "fields", date_id))
            ref_by_base[b] = key
        for cf in spec.custom_fields if custom else ():
            fid = ids.get(cf.display_name)
            owners.setdefault(cf.column, [])
            if b not in owners[cf.column]:
                owners[cf.column].append(b)
            if fid:
                picks.setdefault(cf.column, vx.member(v, "fields", fid))
    direct = [
        F.try_variant_get(v, "$.key", "string").alias("issue_key"),
        vx.status_name(vx.member(v, "fields", "status")).alias("status"),
    ]
    # whole paths and no ``v`` beyond this select: of a shredded landing only the requested paths are read
    picked = records.select(*keep, base_col, *direct, *[c.alias(f"__p{i}") for i, c in enumerate(picks.values())])
    staged = vx.pick_scalars(picked, {name: F.col(f"__p{i}") for i, name in enumerate(picks)}, keep=[*keep, base_col, "issue_key", "status"])
    b = F.col(base_col)
    ref = F.lit(None).cast("string")
    for base, key in ref_by_base.items():
        ref = F.when(b == base, F.col(key)).otherwise(ref)
    core = [
        F.col("issue_key"), F.col("summary"), F.col("status"), F.col("created"), F.col("updated"),
        b.alias("base_origem"), ref.alias("data_referencia"), F.col("espaco"), F.col("tipo_ticket"),
        F.lit(run.extracted_at).alias("extracted_at"), F.lit(source_mode).alias("source_mode"),
    ]
    extra = [
        (F.when(b.isin(*bases), F.col(c)) if c in staged.columns else F.lit(None).cast("string")).alias(c)
        for c, bases in owners.items()
    ]
    return staged.select(*keep, *core, *extra)


# ------------------------------------------------------------------ fallback CSV

def header_for(columns: list[str], wanted: tuple[str, ...]) -> str | None:
    """P5: of the export's columns that a wanted header names, the one named earliest (the last such column of equals)."""
    rank = {canonical(name): k for k, name in reversed(list(enumerate(wanted)))}
    named = [(rank[key], -at, column) for at, column in enumerate(columns) if (key := canonical(column)) in rank]
    return min(named)[2] if named else None


#: Cells that count as missing, compared as written (no trimming).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _cell(columns: dict[str, str], *wanted: str) -> Column:
    hit = header_for(list(columns), wanted)
    if hit is None:
        return F.lit(None).cast("string")
    c = F.col("`" + columns[hit].replace("`", "``") + "`").cast("string")
    return F.when(~c.isin(*NULL_TOKENS), c)


def normalize_fallback(export: DataFrame, spec: BaseSpec, run: Run, keep: tuple[str, ...] = (), headers: list[str] | None = None) -> DataFrame:
    """S4 + P5: an export read as text -> the same text contract; ``headers`` are its columns' names, by position, if not their own."""
    cols = dict(zip(headers or export.columns, export.columns))
    date_candidates = (spec.date_field,) + ((INGRESSADAS_EXTRA_DATE_HEADER,) if spec.base == "ingressadas" else ())
    core = [
        _cell(cols, *HEADER_CANDIDATES["issue_key"]).alias("issue_key"),
        _cell(cols, *HEADER_CANDIDATES["summary"]).alias("summary"),
        _cell(cols, *HEADER_CANDIDATES["status"]).alias("status"),
        _cell(cols, *HEADER_CANDIDATES["created"]).alias("created"),
        _cell(cols, *HEADER_CANDIDATES["updated"]).alias("updated"),
        F.lit(spec.base).alias("base_origem"),
        _cell(cols, *date_candidates).alias("data_referencia"),
        _cell(cols, *HEADER_CANDIDATES["espaco"]).alias("espaco"),
        _cell(cols, *HEADER_CANDIDATES["tipo_ticket"]).alias("tipo_ticket"),
        F.lit(run.extracted_at).alias("extracted_at"),
        F.lit(SOURCE_FALLBACK).alias("source_mode"),
    ]
    custom, seen = [], set()
    for cf in spec.custom_fields:
        if cf.column in seen:
            continue
        seen.add(cf.column)
        custom.append(_cell(cols, cf.display_name).alias(cf.column))
    return export.select(*[F.col(k) for k in keep], *core, *custom)


def align(df: DataFrame, spec: BaseSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the contract columns in order; missing -> null; extras dropped."""
    have = set(df.columns)
    return df.select(*keep, *[(F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in spec.text_columns])


def prefer_primary(primary: DataFrame, fallback: DataFrame, run_status: DataFrame) -> DataFrame:
    """J2 + U5: per base, the fallback rows replace the primary ones only when the primary run failed.

    A base without a status row, or with a null one, keeps its primary rows.
    ``run_status`` (base_origem, primary_ok) has one row per base, so it is the
    broadcast side.
    """
    failed = F.broadcast(run_status.where(~F.col("primary_ok")).select("base_origem"))
    return primary.join(failed, "base_origem", "left_anti").unionByName(
        fallback.join(failed, "base_origem", "left_semi"), allowMissingColumns=True
    )
