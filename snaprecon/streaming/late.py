"""A stream that keeps what comes too late, as a table beside its sink.

Spark's own watermark drops late rows and counts them. Here every batch is
landed, and split by the watermark of the batches before it (their greatest
event time less the delay): rows behind it go to ``late``, re-deliveries of an
event that was kept to ``repeated``, the rest to ``kept``. Each batch replaces
its own part of every table, and reads only what earlier batches wrote, so one
that is run again comes to the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaprecon.session import cut

TABLES = ("kept", "late", "repeated")


def numbered_schema(schema: T.StructType) -> T.StructType:
    """The schema of a table of parts: the rows' own and ``batch_id``."""
    return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])


def drain(stream: DataFrame, sink: str, keys: list[str], ts: str, delay: str) -> None:
    """Take what has arrived (availableNow) into ``sink``/kept, late and repeated, each partitioned by ``batch_id``.

    ``keys`` name an event; its copies carry the same event time, so the copy
    of a row in front of the watermark is looked for in front of it only, and
    the lookup does not grow with the history. Rows without an event time are
    late. Copies within a batch: one is kept.
    """
    spark = stream.sparkSession
    marks = f"{sink}/marks"

    def part(table: str, epoch: int) -> str:
        return f"{sink}/{table}/batch_id={epoch}"

    def split(batch: DataFrame, epoch: int) -> None:
        def put(rows: DataFrame, path: str) -> None:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

        put(batch, part("landed", epoch))
        landed = spark.read.schema(batch.schema).parquet(part("landed", epoch))
        mark = None
        if epoch:
            before = spark.read.schema("seen timestamp, batch_id long").parquet(marks).where(F.col("batch_id") < epoch)
            mark = before.agg((F.max("seen") - F.expr(f"INTERVAL {delay}")).alias("mark")).first()["mark"]
        front = F.col(ts).isNotNull() if mark is None else F.coalesce(F.col(ts) >= F.lit(mark), F.lit(False))
        named = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
        same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
        numbered = cut(landed.where(front).withColumn("__copy", F.monotonically_increasing_id()))
        first = numbered.groupBy(*keys).agg(F.min("__copy").alias("__first")).select(*named, "__first")
        judged = numbered.join(first, same).withColumn("__new", F.col("__copy") == F.col("__first")).drop("__copy", "__first", *[f"__k{i}" for i in range(len(keys))])
        if epoch:
            earlier = spark.read.schema(numbered_schema(batch.schema)).parquet(f"{sink}/kept").where(F.col("batch_id") < epoch)
            known = earlier.where(front).select(*named, F.lit(True).alias("__known")).distinct()
            judged = judged.join(known, same, "left").withColumn("__new", F.col("__new") & F.col("__known").isNull())
        columns = [F.col(c) for c in batch.columns]
        put(judged.where("__new").select(*columns), part("kept", epoch))
        put(judged.where("not __new").select(*columns), part("repeated", epoch))
        put(landed.where(~front), part("late", epoch))
        put(landed.agg(F.max(ts).alias("seen")), f"{marks}/batch_id={epoch}")

    query = stream.writeStream.foreachBatch(split).option("checkpointLocation", f"{sink}.checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
