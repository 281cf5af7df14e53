"""Gapless arrival ordinals without a window over all rows.

A range sort orders the rows across partitions; within a partition the number
is the row's place, and the rows of the partitions before it are added. What
the driver sees is one count per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaprecon.session import cut


def with_ordinals(rows: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """``rows`` with ``name``: bigint from 0, without gaps, in the order of ``order``.

    Ties follow the order of the input (file, then line), so the numbers do
    not change when a task is run again. The sorted rows are written to the
    shared folder once, so that count and number come from the same run.
    """
    tie = F.monotonically_increasing_id()
    sortable = rows.select("*", tie.alias("__tie"))
    dealt = sortable.repartitionByRange(*order, F.col("__tie")).sortWithinPartitions(*order, F.col("__tie")).drop("__tie")
    placed = cut(dealt.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    counts = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, shifts = 0, []
    for p in sorted(counts):
        shifts += [F.lit(p), F.lit(before - (p << 33))]
        before += counts[p]
    shift = F.element_at(F.create_map(*shifts), part) if shifts else F.lit(0)
    return placed.withColumn(name, (F.col("__at") + shift).cast("bigint")).drop("__at")
