"""CSV exports whose header may repeat names, or name columns that differ in case only.

The columns are read by position, all as text, and named apart from the data:
a name that comes again gets ``.1``, ``.2`` and so on, as data frames do, and
an empty one ``Unnamed: <position>``. Which column a contract field takes is
decided on those names (see ``normalize.header_for``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snaprecon.sinks.files import CSV


def unique_names(header: list[str | None]) -> list[str]:
    """The header's names, each once: the first of equal names keeps it, later ones are numbered."""
    named = [name if name else f"Unnamed: {at}" for at, name in enumerate(header)]
    taken, seen, out = set(named), {}, []
    for name in named:
        times = seen.get(name, 0)
        unique = name
        while times and (unique := f"{name}.{times}") in taken:
            times += 1
        seen[name] = times + 1
        taken.add(unique)
        out.append(unique)
    return out


def read_export(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(the rows with columns ``_c0``, ``_c1``, ..., the names of those columns) of an export; every file has the header."""
    first = spark.read.options(**CSV | {"header": False}).csv(path).limit(1).collect()
    names = unique_names(list(first[0])) if first else []
    schema = ", ".join(f"_c{at} string" for at in range(len(names))) or "_c0 string"
    return spark.read.options(**CSV).schema(schema).csv(path), names
