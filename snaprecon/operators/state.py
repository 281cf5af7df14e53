"""The current state as a table in buckets, of which a batch rewrites only those it touches.

Layout below ``root``: ``data/version=V/bucket=B`` holds a bucket as version V
left it, ``commits/version=V`` says which version of every bucket is current.
A batch reads the buckets of its keys, merges, writes them under a new
version, and becomes visible with its commit; until then, and to readers of
the old commit, nothing has changed. A batch that was committed is not applied
again. One writer at a time, as a stream's batches are.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from snaprecon.streaming.ingest import newest

COMMIT = "version bigint, bucket int, at bigint, batch_id bigint"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def committed(spark: SparkSession, root: str) -> tuple[int, int, dict[int, int]]:
    """(version, last batch id, current version of each bucket) of the highest commit; (0, -1, {}) before the first."""
    try:
        commits = spark.read.schema(COMMIT).parquet(f"{root}/commits")
        last = commits.agg(F.max("version").alias("v")).first()["v"]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    if last is None:
        return 0, -1, {}
    rows = commits.where(F.col("version") == last).collect()  # one row a bucket
    return last, rows[0]["batch_id"], {r["bucket"]: r["at"] for r in rows if r["bucket"] is not None}


def read_state(spark: SparkSession, root: str, schema) -> DataFrame:
    """The rows of the highest commit."""
    _, _, current = committed(spark, root)
    return _buckets(spark, root, schema, current)


def _buckets(spark: SparkSession, root: str, schema, current: dict[int, int]) -> DataFrame:
    paths = [f"{root}/data/version={v}/bucket={b}" for b, v in sorted(current.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_batch(batch: DataFrame, root: str, keys: list[str], order: list[str], batch_id: int, buckets: int = 64) -> int:
    """Apply a batch of versions to the state: the newest row of each key by ``order`` stays. Returns the state's version.

    Rewritten are the buckets that hold a key of the batch; rows older than
    the state's change nothing. ``buckets`` is fixed for the life of a state.
    """
    spark = batch.sparkSession
    version, last_batch, current = committed(spark, root)
    if batch_id <= last_batch:
        return version
    own = batch.columns
    # set aside as it came and read from there: its newest rows are found in the merge, so a batch is shuffled once
    landed = f"{root}/incoming/version={version + 1}"
    batch.select(*own, bucket_of(keys, buckets).alias("bucket")).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(landed)
    incoming = spark.read.schema(StructType([*batch.schema, StructField("bucket", IntegerType())])).parquet(landed)
    touched = [r["bucket"] for r in incoming.select("bucket").distinct().collect()]  # at most ``buckets``
    before = _buckets(spark, root, batch.schema, {b: v for b, v in current.items() if b in set(touched)})
    merged = newest(before.unionByName(incoming.drop("bucket")), keys, order).select(*own)
    if touched:
        merged.withColumn("bucket", bucket_of(keys, buckets)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{root}/data/version={version + 1}")
    entries = [(b, v, batch_id) for b, v in (current | {b: version + 1 for b in touched}).items()] or [(None, None, batch_id)]
    rows = spark.createDataFrame(entries, "bucket int, at bigint, batch_id bigint").coalesce(1)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/commits/version={version + 1}")
    return version + 1
