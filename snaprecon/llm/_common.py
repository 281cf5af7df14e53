"""Helpers shared by the operators: scans, lineage cuts, byte-level numpy kernels.

The kernels work on one block of texts at a time (a few MB), so a task's
memory does not depend on the size of its partition.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyspark.cloudpickle as cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import snaprecon
from snaprecon.session import shared_root

# task functions travel by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[snaprecon.__name__])

BLOCK_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark compares names case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` with null as empty; every other column is dropped."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def digest(docs: DataFrame):
    """The binary SHA-256 of each whole text (null: empty)."""
    return F.unhex(F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")), 256))


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` by a decision (doc_id, digest, kept) for each of its rows; rows equal in doc_id and text keep one.

    Rows that are kept only once, nearly all, do not move for it.
    """
    own_id, own_digest, mark = (free_name(docs, name) for name in ("__id", "__digest", "__kept"))
    keys = decided.groupBy("doc_id", "digest").agg(F.first("kept").alias(mark), F.count(F.lit(1)).alias("n"))
    keys = keys.filter(f"not {mark} or n > 1").select(F.col("doc_id").alias(own_id), F.col("digest").alias(own_digest), mark)
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(own_id)) & (digest(docs) == F.col(own_digest))
    again = docs.join(keys.filter(mark), same).dropDuplicates([own_id, own_digest])
    return docs.join(keys, same, "left_anti").unionByName(again.select(*[again[c] for c in docs.columns]))


def blocks(texts: Iterable[str | None], limit: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The texts as UTF-8 bytes, in lists of about ``limit`` bytes (one longer text makes its own list)."""
    block, size = [], 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        if block and size + len(raw) > limit:
            yield block
            block, size = [], 0
        block.append(raw)
        size += len(raw) + 1
    if block:
        yield block


def joined(block: list[bytes], sep: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """One byte array with ``sep`` after each text, and the start of each text (with the end as last entry)."""
    starts = np.zeros(len(block) + 1, np.int64)
    starts[1:] = np.cumsum([len(b) + len(sep) for b in block])
    return np.frombuffer(sep.join(block) + sep, np.uint8), starts


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class SpanHasher:
    """64-bit hashes of any spans of a byte array from one pass of prefix sums modulo 2**64."""

    BASE = 0x9E3779B97F4A7C15 | 1
    _pow = np.ones(1, np.uint64)
    _inv = np.ones(1, np.uint64)
    _byte = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(SpanHasher._pow) < n:
            base, inverse = np.full(n, self.BASE, np.uint64), np.full(n, pow(self.BASE, -1, 1 << 64), np.uint64)
            base[0] = inverse[0] = 1
            SpanHasher._pow, SpanHasher._inv = np.cumprod(base), np.cumprod(inverse)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(self._byte[data] * self._pow[: n - 1], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self._inv[start] + (end - start).astype(np.uint64))
