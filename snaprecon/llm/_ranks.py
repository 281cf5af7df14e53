"""Gapless positions within groups, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaprecon.llm._common import cut


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (long, gapless from 0 in the order of ``order``, nulls first) and ``n`` (rows) of their group.

    Rows equal in ``order`` follow one another in any order. The rows are range
    partitioned and sorted, numbered within their partition, and shifted by the
    counts of the partitions before; a group of any size is spread over many
    tasks, and a window sees one row for each partition of its group. ``group``
    must not be null; ``rows`` must not have columns named ``pos``, ``n`` or
    ``__*`` of their own.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "__tie")]
    rows = cut(rows.withColumn("__tie", F.monotonically_increasing_id()))
    at = F.monotonically_increasing_id()
    placed = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie").withColumn("__at", at)).withColumn("__part", F.shiftright("__at", 33))
    runs = placed.groupBy(group, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy(group)
    before = F.sum("__rows").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(group, "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__rows").over(whole).alias("n"))
    return placed.join(runs, [group, "__part"]).withColumn("pos", F.col("__at") + F.col("__shift")).drop("__at", "__part", "__shift")
