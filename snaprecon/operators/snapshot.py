"""Snapshot operators: dedup (text and typed), update-time resolution,
typed projection, current state over overlapping snapshots, window and rule
filters, rolling windows.

Keep-last uses ``row_number() = 1`` over the dedup key ordered by arrival
ordinal descending: Spark plans it with a partial ``WindowGroupLimit`` before
the shuffle, so a key with millions of versions ships one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snaprecon.functions import dates as dt
from snaprecon.functions import text as tx
from snaprecon.plans.spec import BaseSpec


def keep_last(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The last-arriving row per key (nulls in keys compare equal)."""
    w = Window.partitionBy(*keys).orderBy(*[o.desc() for o in order])
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def resolved_updated(updated: Column, created: Column, extracted_at: Column, run_ts: str) -> Column:
    """D3: updated, else created, else extracted_at, else the run's own timestamp."""
    return F.coalesce(
        dt.parse_timestamp(updated), dt.parse_timestamp(created), dt.parse_timestamp(extracted_at),
        F.lit(run_ts).cast("timestamp"),
    )


def typed_projection(text: DataFrame, spec: BaseSpec, period_from: str, period_to: str, run_ts: str, load_ts: str,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """P8 + P9 + F4 + X4: text contract -> typed contract (blank keys dropped).

    One generated ``select``; every converter is a Column expression.
    """
    key = tx.table_text("issue_key")
    cols = [
        key.alias("chave_ticket"),
        tx.table_text("summary").alias("resumo"),
        tx.table_text("status").alias("status"),
        dt.parse_timestamp("created").alias("data_criacao"),
        resolved_updated(F.col("updated"), F.col("created"), F.col("extracted_at"), run_ts).alias("data_atualizacao"),
        tx.table_text("base_origem").alias("base_origem"),
        dt.local_date("data_referencia").alias("data_referencia"),
        tx.table_text("espaco").alias("espaco"),
        tx.table_text("tipo_ticket").alias("tipo_ticket"),
        F.coalesce(dt.parse_timestamp("extracted_at"), F.lit(run_ts).cast("timestamp")).alias("extraido_em"),
        tx.table_text("source_mode").alias("modo_origem"),
        F.lit(period_from).cast("date").alias("periodo_inicio"),
        F.lit(period_to).cast("date").alias("periodo_fim"),
    ]
    have = set(text.columns)
    seen: set[str] = set()
    for cf in spec.custom_fields:
        if cf.column in seen:
            continue
        seen.add(cf.column)
        src = F.col(cf.column) if cf.column in have else F.lit(None).cast("string")
        cols.append((dt.local_date(src) if cf.is_date else tx.table_text(src)).alias(cf.column))
    cols.append(F.lit(load_ts).cast("timestamp").alias("carga_em"))
    return text.select(*keep, *cols).where(F.col("chave_ticket").isNotNull())


def dedup_typed(typed: DataFrame, order: list[Column]) -> DataFrame:
    """Keep-last per (chave_ticket, instant of data_atualizacao)."""
    return keep_last(typed, ["chave_ticket", "data_atualizacao"], order)


def current_state(snapshots: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Newest version per key across overlapping snapshots (latest window, then arrival)."""
    return keep_last(snapshots, [key], order)


def window_filter(df: DataFrame, date_col: str, lo: str, hi: str) -> DataFrame:
    """both ends inclusive, on the raw column so the predicate reaches the scan."""
    return df.where(F.col(date_col).between(F.lit(lo).cast(df.schema[date_col].dataType), F.lit(hi).cast(df.schema[date_col].dataType)))


def drop_blank_rows(df: DataFrame, cells: list[str]) -> DataFrame:
    """rows go in which every one of ``cells`` is null or white space."""
    return df.where(F.exists(F.array(*[F.col(c).cast("string") for c in cells]), lambda c: F.coalesce(F.trim(c) != "", F.lit(False))))


def latest_window(snapshots: DataFrame, base_col: str, end_col: str, run_date: str | None = None) -> DataFrame:
    """Per base, the rows of the window that ends last (not after ``run_date``, when given).

    The ends come from the partition values, one per base (bounded by
    configuration), as a scalar subquery of the same plan: nothing is
    collected, the choice is made when the query runs, and where both columns
    are partition columns it prunes the files before they are opened. Only
    whether there is any such window is asked at once; if not, LookupError.
    """
    windows = snapshots if run_date is None else snapshots.where(F.col(end_col) <= F.lit(run_date).cast("date"))
    if windows.where(F.col(end_col).isNotNull()).select(end_col).isEmpty():
        raise LookupError("no snapshot" + (f" up to {run_date}" if run_date else ""))
    ends = windows.groupBy(F.col(base_col).alias("base")).agg(F.max(end_col).alias("end")).where("end is not null")
    chosen = ends.agg(F.collect_list(F.struct("base", "end"))).scalar()
    own = F.struct(F.col(base_col).alias("base"), F.col(end_col).alias("end"))
    return snapshots.where(F.array_contains(chosen, own))  # structs compare field by field, null equal to null


def rules_filter(df: DataFrame, rules: DataFrame, base_col: str, status_col: str) -> DataFrame:
    """Keep rows whose canonical status is allowed for their base.

    ``rules`` (base, status) is one row per allowed value per base, bounded by
    configuration, so it is broadcast; the data side is never shuffled.
    """
    allowed = F.broadcast(
        rules.select(F.col("base").alias("__rb"), tx.canonical_text("status").alias("__rs")).distinct()
    )
    keyed = df.withColumn("__s", tx.canonical_text(status_col))
    return keyed.join(allowed, (F.col(base_col) == F.col("__rb")) & (F.col("__s") == F.col("__rs")), "left_semi").drop("__s")


def rules_filter_collated(df: DataFrame, rules: DataFrame, base_col: str, status_col: str) -> DataFrame:
    """F2/J4 by collation: rows whose status equals one allowed for their base, case, accents and spacing aside.

    The join compares collation keys, so no row is canonicalised and no Python
    worker is in the plan. ``rules`` is bounded by configuration and broadcast.
    """
    allowed = F.broadcast(rules.select(F.col("base").alias("__rb"), tx.equality_key("status").alias("__rs")))
    keyed = df.withColumn("__s", tx.equality_key(status_col))
    return keyed.join(allowed, (F.col(base_col) == F.col("__rb")) & (F.col("__s") == F.col("__rs")), "left_semi").drop("__s")


def predicates_filter(df: DataFrame, rules: DataFrame, base_col: str, attributes: list[str]) -> DataFrame:
    """Keep rows that satisfy every rule of their base.

    ``rules`` (base, attribute, value) lists the allowed values. A row stays
    if, for each attribute its base has rules on, its canonical value is one of
    them; an attribute without rules allows everything, and so does a base
    without any. Folded to one row per base (bounded by configuration) and
    broadcast, so the data side is never shuffled.
    """
    lists = [F.collect_set(F.when(F.col("attribute") == a, tx.canonical_text("value"))).alias(f"__allow_{a}") for a in attributes]
    allowed = rules.groupBy(F.col("base").alias("__rb")).agg(*lists)
    joined = df.join(F.broadcast(allowed), F.col(base_col) == F.col("__rb"), "left")
    for a in attributes:
        values = F.col(f"__allow_{a}")
        # a null value is in no list
        joined = joined.where((F.coalesce(F.size(values), F.lit(0)) <= 0) | F.coalesce(F.array_contains(values, tx.canonical_text(a)), F.lit(False)))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns])


def run_windows(run_dates: DataFrame, date_col: str = "run_date") -> DataFrame:
    """Default window (from, to) of each run date."""
    lo, hi = dt.default_window(date_col)
    return run_dates.select(F.col(date_col).alias("run_date"), lo.alias("window_from"), hi.alias("window_to"))


def rolling_counts(items: DataFrame, date_col: str, windows: DataFrame, keep: tuple[str, ...] = ("run_date",)) -> DataFrame:
    """Items per window (window_from <= date <= window_to), windows of any length.

    Items are counted per day, the days of the calendar between the first and
    the last item get running totals, and a window is the difference of two of
    them, looked up by equality. What is joined is two rows a window, however
    long it is, to one row a calendar day. Windows without items have no row.
    """
    daily = items.where(F.col(date_col).isNotNull()).groupBy(F.col(date_col).alias("__day")).agg(F.count(F.lit(1)).alias("__n"))
    first, last = daily.agg(F.min("__day")), daily.agg(F.max("__day"))
    # a calendar: as many rows as days between the first and the last item, whatever the items
    calendar = daily.agg(F.min("__day").alias("lo"), F.max("__day").alias("hi")).where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("__day"))
    whole = Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, 0)
    totals = calendar.join(daily, "__day", "left").select("__day", F.sum(F.coalesce("__n", F.lit(0))).over(whole).alias("__total"))
    upto = totals.select(F.col("__day").alias("__to"), F.col("__total").alias("__upto"))
    before = totals.select(F.col("__day").alias("__from"), F.col("__total").alias("__before"))
    asked = windows.select(*keep, "window_from", "window_to").where("window_from <= window_to").where(F.col("window_from") <= last.scalar())
    ends = asked.withColumn("__to", F.least("window_to", last.scalar())).withColumn("__from", F.date_sub("window_from", 1))
    counted = ends.where(F.col("__to") >= first.scalar()).join(upto, "__to").join(before, "__from", "left")
    n = F.col("__upto") - F.coalesce("__before", F.lit(0))
    return counted.select(*keep, "window_from", "window_to", n.alias("n_tickets")).where("n_tickets > 0")


def rolling_membership(items: DataFrame, date_col: str, windows: DataFrame, days: int = 32) -> DataFrame:
    """J5 row by row: items x windows where window_from <= item date <= window_to, windows of any length.

    An interval join by bins of ``days`` days: a window has one row for each
    bin it touches, an item has one, and both ends are checked. The plan
    chooses the join's strategy; no nested loop.
    """
    bin_of = lambda c: F.floor(F.unix_date(c) / days)
    spread = windows.where("window_from <= window_to").select("*", F.explode(F.sequence(bin_of(F.col("window_from")), bin_of(F.col("window_to")))).alias("__bin"))
    near = items.withColumn("__bin", bin_of(F.col(date_col).cast("date"))).join(spread, "__bin")
    return near.where(F.col(date_col).between(F.col("window_from"), F.col("window_to"))).drop("__bin")
