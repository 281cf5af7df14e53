"""Run / audit analytics: volumes, latency roll-ups, alerts, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def volume_and_dedup(raw: DataFrame, base_col: str, key_cols: list[str]) -> DataFrame:
    """A5: rows per base before and after dedup, and the discarded share."""
    return raw.groupBy(base_col).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_distinct(F.struct(*key_cols)).alias("kept_rows"),
    ).withColumn("discarded_share", F.round(1 - F.col("kept_rows") / F.col("raw_rows"), 6))


def rollup(events: DataFrame, width: int = 1024) -> DataFrame:
    """A6 + X13: runs, latency min / median / max, records per second, fallback and success rates.

    One scan: runs are summed per (base, duration), those per range of
    ``width`` durations, whose distinct values travel along (``width`` at
    most), and a window over a base's ranges finds the one with the middle
    ranks. All other figures are sums of the same rows.
    """
    d = F.col("duration_ms")
    per = events.groupBy("base", "duration_ms").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("total_records").alias("records"),
        F.count_if(F.col("source_mode") != "api").alias("fallbacks"), F.count("source_mode").alias("modes"),
        F.count_if(F.col("status") == "success").alias("successes"), F.count("status").alias("statuses"),
    )
    sums = ("runs", "records", "fallbacks", "modes", "successes", "statuses")
    slots = per.groupBy("base", F.floor(d / width).alias("slot")).agg(
        *[F.sum(c).alias(c) for c in sums], F.min(d).alias("lo"), F.max(d).alias("hi"), F.sum(d * F.col("runs")).alias("total_ms"),
        F.sum(F.when(d.isNotNull(), F.col("runs")).otherwise(0)).alias("timed"), F.sort_array(F.collect_list(F.when(d.isNotNull(), F.struct(d.alias("ms"), "runs")))).alias("times"),
    )
    whole = Window.partitionBy("base")
    before = F.sum("timed").over(whole.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)) - F.col("timed")
    ranked = slots.withColumn("before", before).withColumn("all", F.sum("timed").over(whole))

    def at(rank: Column) -> Column:
        inside = (F.col("before") <= rank) & (rank < F.col("before") + F.col("timed"))
        first = F.struct(F.col("before").alias("upto"), F.lit(None).cast("bigint").alias("ms"))
        step = lambda acc, x: F.struct((acc["upto"] + x["runs"]).alias("upto"), F.when(acc["ms"].isNull() & (acc["upto"] + x["runs"] > rank), x["ms"]).otherwise(acc["ms"]).alias("ms"))
        return F.max(F.when(inside, F.aggregate("times", first, step)["ms"]))

    return ranked.groupBy("base").agg(
        F.sum("runs").alias("runs"), F.min("lo").alias("min_ms"),
        ((at(F.floor((F.col("all") - 1) / 2)) + at(F.floor(F.col("all") / 2))) / 2).alias("median_ms"), F.max("hi").alias("max_ms"),
        F.round(F.sum("records") / (F.sum("total_ms") / 1000.0), 6).alias("records_per_sec"),
        F.round(F.sum("fallbacks") / F.sum("modes"), 6).alias("fallback_rate"), F.round(F.sum("successes") / F.sum("statuses"), 6).alias("success_rate"),
    )


def fallback_streaks(events: DataFrame, min_days: int = 2) -> DataFrame:
    """Runs of consecutive days with a fallback, per base (gaps and islands).

    Aggregate to one row per (base, day) first, so the window only ever sees
    one row per calendar day per base.
    """
    days = events.groupBy("base", F.to_date("ts").alias("day")).agg(
        F.max((F.col("source_mode") != "api").cast("int")).alias("fb")
    ).where(F.col("fb") == 1)
    w = Window.partitionBy("base").orderBy("day")
    islands = days.withColumn("grp", F.date_sub("day", F.row_number().over(w).cast("int")))
    return islands.groupBy("base", "grp").agg(
        F.min("day").alias("streak_start"), F.max("day").alias("streak_end"), F.count(F.lit(1)).alias("days")
    ).where(F.col("days") >= min_days).drop("grp")


def zero_volume(events: DataFrame, trailing: int = 7) -> DataFrame:
    """Per base and calendar day, volume vs the trailing average; alert on an unexpected zero.

    The calendar is generated per base from its own first to last day, so
    days without any run count as zero.
    """
    daily = events.groupBy("base", F.to_date("ts").alias("day")).agg(F.sum("total_records").alias("volume"))
    span = daily.groupBy("base").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    cal = span.select("base", F.explode(F.sequence("lo", "hi")).alias("day"))
    full = cal.join(daily, ["base", "day"], "left").fillna(0, ["volume"])
    w = Window.partitionBy("base").orderBy("day").rowsBetween(-trailing, -1)
    avg = F.avg("volume").over(w)
    return full.select(
        "base", "day", F.col("volume").cast("bigint").alias("volume"), F.round(avg, 6).alias("trailing_avg"),
        ((F.col("volume") == 0) & F.coalesce(avg > 0, F.lit(False))).alias("alert"),
    )


def repeated_errors(events: DataFrame, kind: str = "auth") -> DataFrame:
    """A run whose error is ``kind`` right after a run with the same error, per base.

    Runs are compared within a base's day; the first of a day is compared with
    the last of the base's day before, of which there is one row per day.
    """
    marked = events.withColumn("__day", F.to_date("ts"))
    w = Window.partitionBy("base", "__day").orderBy("ts", "event_id")
    ranked = marked.select("base", "event_id", "ts", "error_kind", "__day", F.row_number().over(w).alias("__n"), F.lag("error_kind").over(w).alias("__prev"))
    days = marked.groupBy("base", "__day").agg(F.max_by("error_kind", F.struct("ts", "event_id")).alias("__end"))
    before = days.select("base", "__day", F.lag("__end").over(Window.partitionBy("base").orderBy("__day")).alias("__before"))
    same = ranked.where(F.col("error_kind") == kind).join(before, ["base", "__day"])
    return same.where(F.when(F.col("__n") == 1, F.col("__before")).otherwise(F.col("__prev")) == kind).select("base", "event_id", "ts", "error_kind")


def filter_text(filter_id: Column, date_name: Column, lo: Column, hi: Column) -> Column:
    """The deterministic remote filter text of one (base, window)."""
    return F.format_string(
        'filter = %s AND "%s" >= "%s" AND "%s" <= "%s" ORDER BY created DESC',
        filter_id.cast("string"), date_name, lo.cast("string"), date_name, hi.cast("string"),
    )


def fingerprint(filter_id: Column, date_name: Column, lo: Column, hi: Column) -> Column:
    """SHA-256 of the filter text."""
    return F.sha2(filter_text(filter_id, date_name, lo, hi), 256)
