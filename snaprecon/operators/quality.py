"""Data quality in one pass, quarantine, load verification, schema evolution.

The reference validates with several scans and raises on the first failure.
Here every check is a conditional sum inside a single aggregation (one scan,
partial aggregation), and failing rows can be listed with the rules they
break instead of aborting the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaprecon.functions import dates as dt
from snaprecon.plans.spec import LARGE_TEXT_CHARS, BaseSpec


def missing_columns(df: DataFrame, spec: BaseSpec) -> list[str]:
    """V1: contract columns absent from the frame (a plan-time schema difference)."""
    have = set(df.columns)
    return [c for c in spec.text_columns if c not in have]


def _rules(window_from: Column, window_to: Column) -> dict[str, Column]:
    ref = dt.utc_date("data_referencia")
    return {
        "null_issue_key": F.col("issue_key").isNull(),
        "null_status": F.col("status").isNull(),
        "null_updated": F.col("updated").isNull(),
        "ref_outside_window": ref.isNotNull() & ((ref < window_from) | (ref > window_to)),
        "ref_unparseable": F.col("data_referencia").isNotNull() & ref.isNull(),
    }


def quality_report(df: DataFrame, group_cols: list[str], window_from: Column, window_to: Column) -> DataFrame:
    """V2-V4 + A3: all checks in a single aggregation per group.

    ``ref_unparseable`` counts dates the validator would ignore (they pass);
    ``null_updated`` is a warning, not an error.
    """
    rules = _rules(window_from, window_to)
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [F.sum(c.cast("bigint")).alias(n) for n, c in rules.items()]
    rep = df.groupBy(*group_cols).agg(*aggs)
    errors = (F.col("null_issue_key") > 0) | (F.col("null_status") > 0) | (F.col("ref_outside_window") > 0)
    return rep.withColumn("verdict", F.when(errors, F.lit("fail")).when(F.col("null_updated") > 0, F.lit("warn")).otherwise(F.lit("pass")))


def contract_report(df: DataFrame, group_col: str, specs: dict[str, BaseSpec], window_from: Column, window_to: Column) -> DataFrame:
    """V1-V4: the quality report with the contract columns that a group's base asks for and the frame lacks.

    A group's base is its value in ``group_col``; without rows there is no
    group, so an empty frame passes. ``missing`` is a list in contract order.
    """
    absent = [(base, missing_columns(df, spec)) for base, spec in specs.items()]
    known = df.sparkSession.createDataFrame(absent, "__base string, missing array<string>")
    report = quality_report(df, [group_col], window_from, window_to)
    joined = report.join(F.broadcast(known), F.col(group_col).eqNullSafe(F.col("__base")), "left").drop("__base")
    return joined.withColumn("verdict", F.when(F.size("missing") > 0, F.lit("fail")).otherwise(F.col("verdict")))


def has_large_text(df: DataFrame, limit: int = LARGE_TEXT_CHARS) -> Column:
    """Whether any text column of ``df`` holds more than ``limit`` characters in the row."""
    lengths = [F.length(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return F.greatest(F.lit(0), F.lit(0), *lengths) > limit


def quarantine(df: DataFrame, keep: list[str], window_from: Column, window_to: Column) -> DataFrame:
    """V7: one row per (record, broken rule), for inspection."""
    rules = {n: c for n, c in _rules(window_from, window_to).items() if n != "ref_unparseable"}
    failed = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    return df.select(*keep, F.explode(failed).alias("rule"))


def verify_load(expected: int, staged: DataFrame) -> tuple[int, bool]:
    """V5/A4: rows in the staged output must equal the rows built."""
    loaded = staged.count()
    return loaded, loaded == expected


def counted(df: DataFrame, key: str, values: list[str]) -> tuple[DataFrame, Observation]:
    """``df`` and what a write of it will count on the way: its rows, in all and of each of ``values`` in ``key``."""
    seen = Observation("load")
    counts = [F.count_if(F.col(key) == v).alias(f"n{i}") for i, v in enumerate(values)]
    return df.observe(seen, F.count(F.lit(1)).alias("n"), *counts), seen


def verify_groups(expected: dict[str, int], total: int, staged: DataFrame, key: str) -> DataFrame:
    """V5/A4 per key: the rows built, as the write counted them, the rows found, and whether they agree.

    Keys on one side only have a row, too; rows built under other keys than
    the expected are summed under null. The plan that built them is not run
    again: what is read is the staged output.
    """
    spark = staged.sparkSession
    other = total - sum(expected.values())
    built = spark.createDataFrame([*expected.items(), *([(None, other)] if other else [])], f"{key} string, expected bigint")
    sides = built.unionByName(staged.select(key, F.lit(1).alias("found")), allowMissingColumns=True)
    counts = sides.groupBy(key).agg(F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"), F.coalesce(F.sum("found"), F.lit(0)).cast("bigint").alias("loaded"))
    return counts.where("expected > 0 or loaded > 0").withColumn("ok", F.col("expected") == F.col("loaded"))


# ------------------------------------------------------------------ schema evolution

def _type_name(t: T.DataType) -> str:
    return t.simpleString()


def schema_diff(expected: T.StructType, existing: T.StructType) -> list[tuple[str, str, str | None, str]]:
    """V6/M1-M3: one row per expected column with the action needed.

    ``add`` (missing), ``keep`` (same type), ``widen`` (text stays text: a
    no-op on ``StringType``), ``to_date`` (text -> date, unconvertible to
    null), ``retype`` (anything else).
    """
    have = {f.name.lower(): f.dataType for f in existing.fields}
    rows = []
    for f in expected.fields:
        cur = have.get(f.name.lower())
        if cur is None:
            action = "add"
        elif cur == f.dataType:
            action = "keep"
        elif isinstance(f.dataType, T.StringType) and isinstance(cur, T.StringType):
            action = "widen"
        elif isinstance(f.dataType, T.DateType) and isinstance(cur, T.StringType):
            action = "to_date"
        else:
            action = "retype"
        rows.append((f.name, _type_name(f.dataType), None if cur is None else _type_name(cur), action))
    return rows


def _converted(field: T.StructField, current: T.DataType | None) -> Column:
    """The expected column from the existing one of that name (any case); null where it is absent or does not convert."""
    if current is None:
        return F.lit(None).cast(field.dataType)
    column = F.col(f"`{field.name}`")
    if isinstance(current, T.StringType) and isinstance(field.dataType, T.DateType):
        return dt.local_date(column)
    if isinstance(current, T.StringType) and isinstance(field.dataType, T.TimestampType):
        return dt.parse_timestamp(column)
    return column.try_cast(field.dataType)


def evolve(existing: DataFrame, expected: T.StructType) -> DataFrame:
    """M1 + M3: add missing columns as null, convert text to date or timestamp and retype (bad -> null), keep order of ``expected``."""
    have = {f.name.lower(): f.dataType for f in existing.schema.fields}
    return existing.select(*[_converted(f, have.get(f.name.lower())).alias(f.name) for f in expected.fields])


def schema_profile(existing: DataFrame, expected: T.StructType) -> DataFrame:
    """V6/M1-M3 with what each action would do to the rows, in one aggregation.

    One row per expected column: its action (see :func:`schema_diff`), the
    table's rows, the null cells, the longest text (text columns only) and the
    cells that hold a value which the action turns into null.
    """
    have = {f.name.lower(): f.dataType for f in existing.schema.fields}
    entries = []
    for field, (name, wanted, found, action) in zip(expected.fields, schema_diff(expected, existing.schema), strict=True):
        current = have.get(name.lower())
        cell = F.lit(None).cast("string") if current is None else F.col(f"`{name}`")
        lost = F.lit(False) if current is None else cell.isNotNull() & _converted(field, current).isNull()
        longest = F.max(F.length(cell)) if isinstance(current, T.StringType) else F.lit(None)
        entries.append(F.struct(
            F.lit(name).alias("column_name"), F.lit(wanted).alias("expected_type"), F.lit(found).cast("string").alias("existing_type"), F.lit(action).alias("action"),
            F.count(F.lit(1)).alias("existing_rows"), F.count_if(cell.isNull()).alias("n_null"), longest.cast("bigint").alias("max_chars"), F.count_if(lost).alias("n_lost"),
        ))
    return existing.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))
