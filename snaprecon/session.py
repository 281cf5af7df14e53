"""Session construction and shared-folder helpers.

Everything that lands files (sinks, stage-verify-swap, streaming checkpoints)
writes below the folder the cluster names in ``spark.checkpoint.dir``. Only
when that setting is absent (local tests) do we pick our own folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_ROOT: str | None = None


def build_session(master: str | None = None, app: str = "snaprecon", shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings every job here assumes (UTC, AQE, no UI)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SNAPRECON_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on, applied to any session we are handed."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from the session (``spark.checkpoint.dir``); our own temporary folder
    serves only where it is unset in local mode. On a cluster that is an error.
    """
    global _OWN_ROOT
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    try:
        conf_dir = conf_dir or spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - conf may be static-only on some deployments
        pass
    ctx_dir = spark.sparkContext.getCheckpointDir()
    if ctx_dir:
        return ctx_dir
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return spark.sparkContext.getCheckpointDir() or conf_dir
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _OWN_ROOT is None:
        _OWN_ROOT = tempfile.mkdtemp(prefix="snaprecon-")
    spark.sparkContext.setCheckpointDir(_OWN_ROOT)
    return spark.sparkContext.getCheckpointDir() or _OWN_ROOT


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new, unused path below the shared folder (see :func:`shared_root`)."""
    root = shared_root(spark).rstrip("/")
    return f"{root}/out/{tag}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str):
    """Scan one driver table; how it is split is a matter of ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage (survives lost executors)."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
