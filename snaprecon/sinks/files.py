"""File sinks: raw landing, snapshots + manifest, audit log, base overwrite.

All writes are partitioned by base and window so a re-run replaces exactly
the partitions it produced (dynamic partition overwrite), and every path is
below the shared folder of the session (``session.fresh_path``).
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snaprecon.session import fresh_path
from snaprecon.functions.dates import month_token  # noqa: F401  (re-exported for callers)


#: One set of options for every CSV read and write: quoted line breaks, doubled quotes and blanks survive.
CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "inferSchema": False}

#: Landed lines of JSON repeat their keys: compressed they take a tenth or less of the disk.
LINES = "gzip"

# ISO-8601 with microseconds and offset, as audit lines carry it
AUDIT_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_audit(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The JSONL audit log with a declared schema (never inference)."""
    return spark.read.schema(schema).option("timestampFormat", AUDIT_TS_FORMAT).json(path)


def period_token(period_from: Column | str, period_to: Column | str) -> Column:
    """``from__to`` label of a window."""
    a = F.col(period_from) if isinstance(period_from, str) else period_from
    b = F.col(period_to) if isinstance(period_to, str) else period_to
    return F.concat_ws("__", a.cast("string"), b.cast("string"))


def write_raw(issues: DataFrame, path: str, text_col: str = "json", partition_cols: tuple[str, ...] = ("base_origem", "periodo")) -> None:
    """K1: one JSON document per line, partitioned by base and window.

    A window without issues writes nothing (partitioned writes create no
    empty partition).
    """
    (
        issues.select(*partition_cols, F.col(text_col).alias("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .option("compression", LINES)
        .text(path)
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """One text a line (column ``value``), compressed; readers see the same lines."""
    lines.write.option("compression", LINES).text(path)


def write_shredded(parsed: DataFrame, path: str, partition_cols: tuple[str, ...] = ("base_origem", "periodo")) -> None:
    """K1 beside the lines: well-formed parsed issues (column ``v``) as VARIANT Parquet.

    Spark shreds the paths that most rows agree on into typed columns of their
    own, file by file, and keeps the rest as it is; a scan that asks for some
    paths reads the columns of those.
    """
    (
        parsed.select(*partition_cols, "v")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """S1 scan of a raw landing: text lines + partition columns (never schema inference on JSON)."""
    return spark.read.option("basePath", path).text(path)


def write_snapshot(
    df: DataFrame,
    path: str,
    formats: tuple[str, ...] = ("csv", "parquet"),
    partition_cols: tuple[str, ...] = ("base_origem", "periodo_inicio", "periodo_fim"),
    mode: str = "dynamic",
) -> dict:
    """K2 + K3: snapshot in the requested formats, counted on the way.

    Each format gets the partitions of ``df`` and no other: what was written
    for other windows stays as it is, file by file. For two formats the rows
    are staged once, so the plan of ``df`` runs once; the count is an
    ``Observation`` on its first write. Unknown formats are ignored. An empty
    input leaves one readable empty file with all columns where there is none.
    ``mode='static'`` replaces every partition below ``path`` (K7).
    """
    spark, wanted = df.sparkSession, sorted({"csv", "parquet"} & set(formats), reverse=True)
    if not wanted:
        return {"record_count": df.count(), "formats": list(formats), "written": []}
    obs = Observation("snapshot")
    source = df.observe(obs, F.count(F.lit(1)).alias("record_count"))
    if len(wanted) > 1:
        stage = fresh_path(spark, "snapshot-stage")
        source.write.parquet(stage)
        source = spark.read.schema(df.schema).parquet(stage)
    for fmt in wanted:
        options = CSV if fmt == "csv" else {}
        source.write.mode("overwrite").format(fmt).options(**options).option("partitionOverwriteMode", mode).partitionBy(*partition_cols).save(f"{path}/{fmt}")
    count = int(obs.get["record_count"])
    if not count:
        for fmt in wanted:
            options = CSV if fmt == "csv" else {}
            df.limit(0).coalesce(1).write.mode("overwrite" if mode == "static" else "append").format(fmt).options(**options).save(f"{path}/{fmt}")
    return {"record_count": count, "formats": list(formats), "written": sorted(wanted)}


def manifest_rows(snapshot: DataFrame, formats: tuple[str, ...], generated_at: str) -> DataFrame:
    """K3: one manifest row per (base, window) of a snapshot, counted after dedup."""
    return snapshot.groupBy(
        F.col("base_origem").alias("base"), F.col("periodo_inicio").alias("from_date"), F.col("periodo_fim").alias("to_date")
    ).agg(F.count(F.lit(1)).alias("record_count")).select(
        "base", "from_date", "to_date", F.lit(generated_at).cast("timestamp").alias("generated_at"), "record_count",
        F.array(*[F.lit(f) for f in formats]).alias("formats"),
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("overwrite").json(path)


def append_audit(events: DataFrame, path: str, recorded_at: Column | None = None) -> None:
    """K8: append events, adding ``recorded_at``, partitioned by its date."""
    rec = recorded_at if recorded_at is not None else F.current_timestamp()
    (
        events.withColumn("recorded_at", rec)
        .withColumn("recorded_date", F.to_date("recorded_at"))
        .write.mode("append")
        .option("timestampFormat", AUDIT_TS_FORMAT)
        .partitionBy("recorded_date")
        .json(path)
    )


def overwrite_base(df: DataFrame, table_path: str, base: str,
                   partition_cols: tuple[str, ...] = ("periodo_inicio", "periodo_fim")) -> None:
    """K7: replace the whole subtree of one base (older windows removed), leaving other bases untouched.

    The rows go to the base's own directory with a static overwrite, so every
    window previously written for that base disappears.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_cols).parquet(
        f"{table_path}/base_origem={base}"
    )


# ------------------------------------------------------------------ versions of a table

def _claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with ``text`` unless it is there already (the file system's own put-if-absent)."""
    from py4j.protocol import Py4JJavaError

    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = fs.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True


POINTER = "version bigint, path string"


def pointer(spark: SparkSession, table_root: str) -> tuple[int, str | None]:
    """The highest committed (version, path) of a table; (0, None) before its first refresh."""
    try:
        last = spark.read.schema(POINTER).json(f"{table_root}/pointers").where("path is not null").agg(F.max(F.struct("version", "path")).alias("p")).first()["p"]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    return (last["version"], last["path"]) if last else (0, None)


def publish(spark: SparkSession, table_root: str, path: str) -> int:
    """Make ``path`` the table's current version and return its number.

    A version is one file, created only if absent: of two refreshes at once
    one gets the number and the other the next, so each is a version and the
    later one is current; none is lost in silence.
    """
    version = pointer(spark, table_root)[0] + 1
    while not _claim(spark, f"{table_root}/pointers/{version:012d}.json", json.dumps({"version": version, "path": path})):
        version += 1
    return version
