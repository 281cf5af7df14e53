"""Exact dedup over a cuckoo-filter index of live digests.

Equal texts have equal SHA-256 digests. Each task keeps a :class:`DigestIndex`:
a cuckoo filter of 16-bit fingerprints in buckets of four, and beside every
slot the full digest it stands for. A filter miss is a new digest; a hit
counts only after the stored digest is found equal. When an insertion cannot
be placed, the index doubles and is refilled from the stored digests.

On Spark the index runs twice: over each input partition (so a digest that a
third of all rows share leaves every task as one row) and over each digest
bucket of the shuffle. No task ever holds more than the distinct digests of
its bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaprecon.llm._common import digest, free_name, id_and_text, keep_rows

SLOTS = 4
MAX_KICKS = 200


class DigestIndex:
    """Cuckoo filter with stored keys: ``insert``, ``get``, ``delete``, and growth on overflow.

    Keys are digests of at least 16 bytes; each live key has one value.
    """

    def __init__(self, buckets: int = 64):
        self._reset(buckets)

    def _reset(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tags: list[list[int]] = [[] for _ in range(buckets)]
        self.cells: list[list[list]] = [[] for _ in range(buckets)]
        self.size = 0

    def _place(self, key: bytes) -> tuple[int, int, int]:
        tag = (key[0] << 8 | key[1]) or 1
        first = int.from_bytes(key[2:10], "little") & self.mask
        return tag, first, self._other(first, tag)

    def _other(self, bucket: int, tag: int) -> int:
        return (bucket ^ (tag * 0x5BD1E995)) & self.mask

    def _find(self, key: bytes) -> tuple[int, int] | None:
        tag, first, second = self._place(key)
        for bucket in (first, second):
            tags = self.tags[bucket]
            if tag in tags:
                for slot, cell in enumerate(self.cells[bucket]):
                    if tags[slot] == tag and cell[0] == key:
                        return bucket, slot
        return None

    def get(self, key: bytes):
        at = self._find(key)
        return None if at is None else self.cells[at[0]][at[1]][1]

    def insert(self, key: bytes, value) -> None:
        """Add a live digest, or replace the value of one that is live."""
        at = self._find(key)
        if at is not None:
            self.cells[at[0]][at[1]][1] = value
            return
        cell = [key, value]
        while not self._put(cell):
            cell = self._grow(cell)
        self.size += 1

    def _put(self, cell: list) -> bool:
        """Place a cell; on failure ``cell`` holds what was left without a slot."""
        tag, bucket, other = self._place(cell[0])
        for at in (bucket, other):
            if len(self.tags[at]) < SLOTS:
                self.tags[at].append(tag)
                self.cells[at].append(cell)
                return True
        held = cell
        for kick in range(MAX_KICKS):
            slot = kick % SLOTS
            tag, self.tags[bucket][slot] = self.tags[bucket][slot], tag
            held, self.cells[bucket][slot] = self.cells[bucket][slot], held
            bucket = self._other(bucket, tag)
            if len(self.tags[bucket]) < SLOTS:
                self.tags[bucket].append(tag)
                self.cells[bucket].append(held)
                return True
        self._left = held
        return False

    def _grow(self, cell: list) -> list:
        """Double the table and refill it from the stored keys; the homeless cell is returned for another try."""
        stored, homeless, buckets = [c for cells in self.cells for c in cells], self._left, self.mask + 1
        while True:
            buckets *= 2
            size = self.size
            self._reset(buckets)
            self.size = size
            if all(self._put(c) for c in stored):
                return homeless

    def delete(self, key: bytes) -> bool:
        """Remove a live digest; false if it is not live."""
        at = self._find(key)
        if at is None:
            return False
        del self.tags[at[0]][at[1]], self.cells[at[0]][at[1]]
        self.size -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        return ((key, value) for cells in self.cells for key, value in cells)


def _best(a, b):
    return b if a is None else a if b is None else max(a, b)


def _merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(digest, keep_id, group_size) summed over equal digests, through one index."""
    index = DigestIndex()
    for frame in frames:
        ids = frame["keep_id"].astype("Int64")
        for digest, keep, known, n in zip(frame["digest"], ids.fillna(0).tolist(), ids.notna().tolist(), frame["group_size"].tolist(), strict=True):
            digest, keep = bytes(digest), keep if known else None
            entry = index.get(digest)
            if entry is None:
                index.insert(digest, [keep, n])
            else:
                entry[0], entry[1] = _best(entry[0], keep), entry[1] + n
    rows = list(index.items())
    for at in range(0, len(rows), 50_000):
        part = rows[at : at + 50_000]
        yield pd.DataFrame({"digest": [k for k, _ in part], "keep_id": pd.array([v[0] for _, v in part], "Int64"), "group_size": [v[1] for _, v in part]})


_PARTIAL = "digest binary, keep_id long, group_size long"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the binary SHA-256 of each whole text (null: empty)."""
    return id_and_text(docs).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))


def copy_groups(docs: DataFrame) -> DataFrame:
    """One row per distinct text: digest, keep_id (largest doc_id), group_size."""
    ones = digests(docs).select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return ones.mapInPandas(_merge, _PARTIAL).repartition("digest").mapInPandas(_merge, _PARTIAL)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    A null text equals an empty one. Among equal texts the largest doc_id
    stays; null ids rank lowest, and a group of null ids alone keeps its rows
    (keep_id null). Rows repeated with one doc_id count in group_size and share
    the decision. Other columns are ignored. An empty table gives no rows.
    """
    joined = digests(docs).join(copy_groups(docs), "digest")
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the copies that :func:`exact_dedup` drops; all columns stay."""
    own_id, own_digest = free_name(docs, "__dropped"), free_name(docs, "__digest")
    dropped = exact_dedup(docs).filter("not kept").select(F.col("doc_id").alias(own_id), F.unhex("text_sha256").alias(own_digest))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(own_id)) & (digest(docs) == F.col(own_digest))
    return docs.join(dropped, same, "left_anti")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with exactly one row of each text, that of the largest doc_id; one of rows that share it or have none."""
    decided = exact_dedup(docs).select("doc_id", F.unhex("text_sha256").alias("digest"), "kept")
    return keep_rows(docs, decided)


def _apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Balances by digest through one index: a digest enters it with its first row and leaves it when its balance is nought."""
    index = DigestIndex()
    for frame in frames:
        for key, refs in zip(frame["digest"], frame["refs"].tolist(), strict=True):
            key = bytes(key)
            balance = (index.get(key) or 0) + refs
            index.insert(key, balance) if balance else index.delete(key)
    rows = list(index.items())
    yield pd.DataFrame({"digest": [k for k, _ in rows], "refs": [v for _, v in rows]})


def update_live(live: DataFrame, changes: DataFrame) -> DataFrame:
    """Next state of a live-digest table (digest, refs) after signed changes (digest, refs).

    Positive refs insert, negative delete. The index of a digest bucket holds
    the state's digests; each one's changes, summed before the shuffle (so
    their order and a hot digest do not matter), are then applied: a digest
    leaves the index when its last reference goes. A negative balance stays in
    the state, so a delete that comes before its insert is not lost; the live
    digests are those with positive refs. Null digests are ignored.
    """
    summed = changes.groupBy("digest").agg(F.sum(F.col("refs").cast("long")).alias("refs"))
    rows = live.select("digest", F.col("refs").cast("long").alias("refs")).unionByName(summed).filter("digest is not null")
    return rows.repartition("digest").mapInPandas(_apply, "digest binary, refs long")
