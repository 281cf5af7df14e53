"""Multiset reconciliation of a snapshot against a reference dataset, by month.

Both sides become signatures ``(base, month, summary, status)`` in canonical
form. Instead of a full outer join of two count tables, the sides are united
with +1 flags and aggregated once (partial aggregation map-side, so a hot
signature such as the empty summary is pre-combined before the shuffle).
The relaxed view (status ignored) and the monthly totals are further
aggregations of that same result, because every count involved is additive
over the finer key. Three exchanges in total, each on pre-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaprecon.functions.dates import comparison_date, month_token
from snaprecon.functions.text import signature_text

SIG_KEYS = ("base", "month", "summary", "status")


def signatures(df: DataFrame, base: str | Column, summary: str, status: str, ref_date: str) -> DataFrame:
    """A1 input: one canonical signature per dated row (F5 drops undatable rows)."""
    base_col = F.col(base) if isinstance(base, str) else base
    return (
        df.select(
            base_col.alias("base"),
            month_token(comparison_date(ref_date)).alias("month"),
            signature_text(summary).alias("summary"),
            signature_text(status).alias("status"),
        )
        .where(F.col("month").isNotNull())
    )


def signature_counts(local_sig: DataFrame, reference_sig: DataFrame) -> DataFrame:
    """Multiplicity of every signature on each side, in one aggregation."""
    flagged = local_sig.select(*SIG_KEYS, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        reference_sig.select(*SIG_KEYS, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return flagged.groupBy(*SIG_KEYS).agg(
        F.sum("l").cast("bigint").alias("local_qty"),
        F.sum("r").cast("bigint").alias("reference_qty"),
    )


def _matched(l: Column, r: Column) -> Column:
    return F.least(l, r)


def _missing(l: Column, r: Column) -> Column:
    return F.greatest(r - l, F.lit(0))


def _extra(l: Column, r: Column) -> Column:
    return F.greatest(l - r, F.lit(0))


def monthly_report(counts: DataFrame, scope: str = "local", month: str | None = None) -> DataFrame:
    """A2 + A2r: strict and relaxed totals per (base, month).

    ``scope='local'`` keeps months with at least one local row (the default),
    ``scope='all'`` adds reference-only months (F7/U3). ``month`` restricts.
    """
    l, r = F.col("local_qty"), F.col("reference_qty")
    per_summary = counts.groupBy("base", "month", "summary").agg(
        F.sum(l).alias("l"),
        F.sum(r).alias("r"),
        F.sum(_matched(l, r)).alias("m"),
        F.sum(_missing(l, r)).alias("mi"),
        F.sum(_extra(l, r)).alias("ex"),
    )
    sl, sr = F.col("l"), F.col("r")
    report = per_summary.groupBy("base", "month").agg(
        F.sum(sl).cast("bigint").alias("local_count"),
        F.sum(sr).cast("bigint").alias("reference_count"),
        F.sum("m").cast("bigint").alias("matched_count"),
        F.sum("mi").cast("bigint").alias("missing_in_local_count"),
        F.sum("ex").cast("bigint").alias("extra_in_local_count"),
        F.sum(_matched(sl, sr)).cast("bigint").alias("relaxed_matched_count"),
        F.sum(_missing(sl, sr)).cast("bigint").alias("relaxed_missing_count"),
        F.sum(_extra(sl, sr)).cast("bigint").alias("relaxed_extra_count"),
    )
    if scope == "local":
        report = report.where(F.col("local_count") > 0)
    elif scope != "all":
        raise ValueError(f"unknown scope {scope!r}")
    if month is not None:
        report = report.where(F.col("month") == month)
    return report


def ordered(report: DataFrame, base_order: tuple[str, ...]) -> DataFrame:
    """O3: configured base order, months ascending (only where order is observable)."""
    rank = F.array_position(F.array(*[F.lit(b) for b in base_order]), F.col("base"))
    return report.orderBy(rank, "month")


def top_examples(counts: DataFrame, k: int = 10) -> DataFrame:
    """The k signatures with the largest surplus per (base, month, side).

    Ties break on (summary, status). ``row_number() <= k`` plans a
    ``WindowGroupLimit`` before the shuffle, so even a month holding a third
    of all rows only ships k candidates per partition.
    """
    l, r = F.col("local_qty"), F.col("reference_qty")
    sided = counts.select(
        "base", "month", "summary", "status",
        F.explode(F.array(
            F.struct(F.lit("missing").alias("side"), _missing(l, r).alias("qty")),
            F.struct(F.lit("extra").alias("side"), _extra(l, r).alias("qty")),
        )).alias("s"),
    ).select("base", "month", "summary", "status", "s.side", "s.qty").where(F.col("qty") > 0)
    w = Window.partitionBy("base", "month", "side").orderBy(F.desc("qty"), "summary", "status")
    return sided.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


def nested_examples(examples: DataFrame) -> DataFrame:
    """Report shape: ``missing_examples`` / ``extra_examples`` as ranked arrays of structs."""
    grouped = examples.groupBy("base", "month").agg(
        F.sort_array(F.collect_list(F.when(F.col("side") == "missing", F.struct("rank", "summary", "status", "qty")))).alias("m"),
        F.sort_array(F.collect_list(F.when(F.col("side") == "extra", F.struct("rank", "summary", "status", "qty")))).alias("e"),
    )
    strip = lambda a: F.transform(a, lambda x: F.struct(x["summary"].alias("summary"), x["status"].alias("status"), x["qty"].alias("qty")))
    return grouped.select("base", "month", strip(F.col("m")).alias("missing_examples"), strip(F.col("e")).alias("extra_examples"))


def multiset_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` not matched in ``right``, multiplicity kept (EXCEPT ALL)."""
    return left.exceptAll(right)


def multiset_intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows present on both sides, min multiplicity (INTERSECT ALL)."""
    return left.intersectAll(right)


def relaxed_report(local_sig: DataFrame, reference_sig: DataFrame) -> DataFrame:
    """A2r on its own: multiplicity per (base, month, summary), status ignored."""
    keys = ("base", "month", "summary")
    flagged = local_sig.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        reference_sig.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per = flagged.groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    l, r = F.col("l"), F.col("r")
    return (
        per.groupBy("base", "month")
        .agg(
            F.sum(l).cast("bigint").alias("local_count"),
            F.sum(r).cast("bigint").alias("reference_count"),
            F.sum(_matched(l, r)).cast("bigint").alias("relaxed_matched_count"),
            F.sum(_missing(l, r)).cast("bigint").alias("relaxed_missing_count"),
            F.sum(_extra(l, r)).cast("bigint").alias("relaxed_extra_count"),
        )
        .where(F.col("local_count") > 0)
    )
