"""Token-count rollups kept by signed deltas.

A batch lists changes of documents: inserted with a count, deleted with the
count they had, or revised from one count to another. Each becomes a signed
delta of documents and tokens under (source, lang, tokenizer version), and the
totals are the sums of all committed deltas, so no document is counted anew.

A commit writes the batch's own partition of the ledger, already summed by
key, and replaces it when it is there: committing a batch again, after a lost
executor or a doubtful answer, changes nothing. Only finished commits are
read (a write that did not finish leaves no files in the partition).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from snaprecon.llm.packing import byte_bpe

KEYS = ["source", "lang", "version"]


def token_counter(rank_file: str):
    """A function of a text column: its tokens under a byte-level BPE rank file (null: 0)."""

    @pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = byte_bpe(rank_file)
        for texts in parts:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return count


def signed(changes: DataFrame) -> DataFrame:
    """Deltas (source, lang, version, documents, tokens) of changes (op, source, lang, version, tokens, before).

    op is insert, delete or revise; ``tokens`` is the count inserted, deleted
    or revised to, ``before`` the count revised from (null counts are 0). Rows
    with another op, or none, are refused with an error. Null keys are groups
    of their own.
    """
    tokens, before = F.coalesce(F.col("tokens").cast("long"), F.lit(0)), F.coalesce(F.col("before").cast("long"), F.lit(0))
    op = F.lower(F.col("op"))
    wrong = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(F.col("op"), F.lit("null"))))
    documents = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0).otherwise(wrong.cast("int"))
    delta = F.when(op == "insert", tokens).when(op == "delete", -tokens).otherwise(tokens - before)
    return changes.select(*KEYS, documents.cast("long").alias("documents"), delta.alias("tokens"))


class Ledger:
    """Committed batches below ``path`` (a folder that all executors share)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Add a batch, or replace it by the same batch; an empty one commits no rows."""
        summed = signed(changes).groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        summed.write.mode("overwrite").parquet(f"{self.path}/batch={int(batch)}")

    def totals(self) -> DataFrame:
        """source, lang, version, documents, tokens over all committed batches; keys whose documents and tokens are both 0 are left out."""
        rows = self.spark.read.parquet(self.path)
        summed = rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return summed.filter("documents <> 0 or tokens <> 0")
