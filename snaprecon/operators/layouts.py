"""M1-M3: partitioned tables whose files have come to differ in columns and types.

A partition is written in one layout. The layouts are read from footers, one a
partition; partitions of equal layout are one scan, each is brought to the
expected schema (``quality.evolve``), and the scans are united. Migrating
rewrites only partitions whose files hold another type: a column that is
absent reads as null in place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from snaprecon.operators.quality import evolve
from snaprecon.session import fresh_path


def with_parts(schema: T.StructType, parts: list[str], kinds: list[str]) -> T.StructType:
    """``schema`` and the partition columns after it."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(", ".join(f"`{p}` {k}" for p, k in zip(parts, kinds, strict=True))).fields])


def layouts(spark: SparkSession, path: str, parts: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """(layout, paths of its partitions) of a table: a listing of the partition values, then one footer a partition."""
    kinds = ", ".join(f"`{p}` string" for p in parts)
    # no data column is asked for: the scan reads row counts from the footers
    found = spark.read.schema(kinds).parquet(path).select(*parts).distinct().collect()
    grouped: dict[str, tuple[T.StructType, list[str]]] = {}
    for row in sorted(found, key=str):
        folder = "/".join(f"{p}={row[p]}" for p in parts)
        layout = spark.read.parquet(f"{path}/{folder}").schema
        grouped.setdefault(layout.json(), (layout, []))[1].append(f"{path}/{folder}")
    return list(grouped.values())


def _brought(spark: SparkSession, path: str, layout: T.StructType, folders: list[str], expected: T.StructType, parts: list[str]) -> DataFrame:
    rows = spark.read.option("basePath", path).schema(with_parts(layout, parts, ["string"] * len(parts))).parquet(*folders)
    target = with_parts(expected, parts, ["string"] * len(parts))
    return evolve(rows, target)


def read_layouts(spark: SparkSession, path: str, expected: T.StructType, parts: list[str]) -> DataFrame:
    """All rows of the table in the expected schema, then its partition columns (as text): one scan a layout."""
    scans = [_brought(spark, path, layout, folders, expected, parts) for layout, folders in layouts(spark, path, parts)]
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], with_parts(expected, parts, ["string"] * len(parts)))


def migrate(spark: SparkSession, path: str, expected: T.StructType, parts: list[str]) -> list[str]:
    """Rewrite the partitions whose files hold another type than expected; returns their folders.

    The new rows are staged first, then replace exactly those partitions
    (dynamic overwrite), so a failed run leaves the table as it was.
    """
    wanted = {f.name.lower(): f.dataType for f in expected.fields}
    stale = [(layout, folders) for layout, folders in layouts(spark, path, parts) if any(f.dataType != wanted.get(f.name.lower(), f.dataType) for f in layout.fields)]
    if not stale:
        return []
    stage = fresh_path(spark, "migrate")
    rows = reduce(DataFrame.unionByName, [_brought(spark, path, layout, folders, expected, parts) for layout, folders in stale])
    rows.write.parquet(stage)
    staged = spark.read.parquet(stage)
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    return [folder for _, folders in stale for folder in folders]
