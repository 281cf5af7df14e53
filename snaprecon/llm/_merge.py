"""Sorted symbol runs of text blocks, merged in buckets, answered to their blocks.

An operator reads its documents in blocks of a few MB (a shard). Of each block
it makes one sorted run of symbol tuples with counts. The run is cut by the
first symbol's leading bits into buckets; a bucket task merges the runs of all
blocks and answers each entry of each run; the answers meet the block's texts
again and finish them. A tuple travels once per block however often it occurs,
so a symbol that a third of all rows hold is not a hot key, and bucket and
block tasks hold one bucket or one block at a time.

Both passes read the documents, and a block is known by its partition and its
place there: ``pinned`` fixes how files are split, and a block whose run does
not have as many entries as answers came stops the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 2 << 20
_REQUEST = "block long, bucket int, size int, symbols binary, counts binary"
_ANSWER = "block long, bucket int, answers binary"


def pinned(spark: SparkSession) -> None:
    """Fix the number of file splits asked for, which else follows the executors that happen to be alive."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def bucket_bits(spark: SparkSession) -> int:
    return max(4, (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length())


class Block:
    """Documents of one shard: ids, texts as bytes, and the caller's extra bytes."""

    def __init__(self, number: int):
        self.number, self.ids, self.texts, self.extra, self.size = number, [], [], [], 0

    def add(self, doc_id, text: bytes, extra) -> None:
        self.ids.append(doc_id)
        self.texts.append(text)
        self.extra.append(extra)
        self.size += len(text) + 1


def _cut_blocks(frames: Iterator[pd.DataFrame], limit: int) -> Iterator[Block]:
    """Blocks of the partition's rows in their order; where they end does not depend on the frames."""
    number = TaskContext.get().partitionId() << 32
    block = Block(number)
    for frame in frames:
        known = frame["doc_id"].notna().tolist()
        ids = frame["doc_id"].astype("Int64").fillna(0).tolist()
        for doc_id, has, text, extra in zip(ids, known, frame["text"], frame["extra"], strict=True):
            raw = text.encode("utf-8", "surrogatepass") if text else b""
            if block.ids and block.size + len(raw) > limit:
                yield block
                number += 1
                block = Block(number)
            block.add(doc_id if has else None, raw, extra)
    if block.ids:
        yield block


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Numbers as byte planes, compressed: planes of small numbers cost nearly nothing."""
    wide = np.dtype(kind).newbyteorder("<")
    return zstandard.ZstdCompressor(level=1).compress(values.astype(wide).view(np.uint8).reshape(values.size, wide.itemsize).T.tobytes())


def _from_planes(raw: bytes, kind: str) -> np.ndarray:
    wide = np.dtype(kind).newbyteorder("<")
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(raw)), np.uint8)
    return np.ascontiguousarray(flat.reshape(wide.itemsize, -1).T).view(wide).ravel()


def pack_symbols(symbols: np.ndarray) -> bytes:
    """Columns of a sorted run, the first symbols as differences."""
    out = symbols.copy()
    out[0, 1:] = symbols[0, 1:] - symbols[0, :-1]
    return _planes(out.ravel(), "Q")


def unpack_symbols(raw: bytes, size: int) -> np.ndarray:
    flat = _from_planes(raw, "Q").reshape(-1, size).astype(np.uint64)
    flat[0] = np.cumsum(flat[0])
    return flat


def pack_numbers(values: np.ndarray) -> bytes:
    """Unsigned integers in the fewest bytes that hold the largest."""
    kind = next(k for k, top in (("B", 1 << 8), ("H", 1 << 16), ("I", 1 << 32), ("Q", 1 << 64)) if not len(values) or int(values.max()) < top)
    return kind.encode() + _planes(values, kind)


def unpack_numbers(raw: bytes) -> np.ndarray:
    return _from_planes(raw[1:], bytes(raw[:1]).decode())


def sorted_run(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct columns of ``symbols`` in order, their counts, and the entry of each given column."""
    order = np.lexsort(symbols[::-1])
    ranked = symbols[:, order]
    new = np.ones(ranked.shape[1], bool)
    new[1:] = (ranked[:, 1:] != ranked[:, :-1]).any(0)
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    return ranked[:, new], np.bincount(entry, minlength=int(new.sum())) if len(order) else np.zeros(0, np.int64), entry


def interleave(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted runs of symbol tuples by refining one interleave, symbol by symbol.

    The interleave starts as the runs one after the other. Pass h brings the
    tuples into the order of their symbols h and later by one stable sort on
    symbol h (numpy's, which takes advantage of ordered runs); after the last
    pass (the first symbol) the order is that of the whole tuples. Returns the
    order, and at each place the common prefix, in symbols, with the tuple
    before it.
    """
    symbols = np.concatenate(runs, axis=1)
    order = np.arange(symbols.shape[1])
    for row in symbols[::-1]:
        order = order[np.argsort(row[order], kind="stable")]
    ranked = symbols[:, order]
    common = np.zeros(len(order), np.int64)
    equal = np.ones(max(0, len(order) - 1), bool)
    for row in ranked:
        equal &= row[1:] == row[:-1]
        common[1:] += equal
    return order, common


def exchange(
    docs: DataFrame,
    run_of: Callable[[Block], tuple[np.ndarray, np.ndarray]],
    answer: Callable[[list[np.ndarray], list[np.ndarray]], list[np.ndarray]],
    finish: Callable[[Block, np.ndarray], pd.DataFrame],
    schema: str,
    limit: int = BLOCK,
) -> DataFrame:
    """Run the exchange over docs (doc_id, text, extra).

    ``run_of`` gives a block's sorted distinct symbol tuples (2-d, one row per
    symbol) and counts, ``answer`` the answers to the runs that meet in a
    bucket, ``finish`` a block's result rows from its texts and the answers in
    the order of its run.
    """
    spark = docs.sparkSession
    pinned(spark)
    bits = bucket_bits(spark)

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _cut_blocks(frames, limit):
            symbols, counts = run_of(block)
            home = (symbols[0] >> np.uint64(64 - bits)).astype(np.int64)
            edges = np.append(np.flatnonzero(np.diff(home, prepend=-1)), len(home))
            rows = [(block.number, int(home[a]), int(b - a), pack_symbols(symbols[:, a:b]), pack_numbers(counts[a:b])) for a, b in zip(edges, edges[1:], strict=False)]
            yield pd.DataFrame(rows, columns=["block", "bucket", "size", "symbols", "counts"])

    def solve(rows: list[tuple]) -> pd.DataFrame:
        runs = [unpack_symbols(r[3], r[2]) for r in rows]
        answers = answer(runs, [unpack_numbers(r[4]).astype(np.int64) for r in rows])
        return pd.DataFrame([(r[0], r[1], pack_numbers(a)) for r, a in zip(rows, answers, strict=True)], columns=["block", "bucket", "answers"])

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for frame in frames:
            for row in frame.itertuples(index=False):
                if held and row[1] != held[0][1]:
                    yield solve(held)
                    held = []
                held.append(tuple(row))
        if held:
            yield solve(held)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for block in _cut_blocks(frames, limit):
            n = len(block.ids)
            yield pd.DataFrame({"block": block.number, "bucket": 1 << 30, "seq": np.arange(n), "doc_id": pd.array(block.ids, "Int64"), "text": [pack(t) for t in block.texts], "extra": block.extra, "answers": None})

    def close(block: Block, answers: list[bytes]) -> pd.DataFrame:
        got = [unpack_numbers(a) for a in answers]
        return finish(block, np.concatenate(got).astype(np.int64) if got else np.zeros(0, np.int64))

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, answers, unpack = None, [], zstandard.ZstdDecompressor().decompress
        for frame in frames:
            known = frame["doc_id"].notna().tolist()
            ids = frame["doc_id"].astype("Int64").fillna(0).tolist()
            for number, doc_id, has, text, extra, got in zip(frame["block"].tolist(), ids, known, frame["text"], frame["extra"], frame["answers"], strict=True):
                if block is None or number != block.number:
                    if block is not None:
                        yield close(block, answers)
                    block, answers = Block(number), []
                if got is not None:
                    answers.append(got)
                else:
                    block.add(doc_id if has else None, unpack(bytes(text)), extra)
        if block is not None:
            yield close(block, answers)

    answered = docs.mapInPandas(ask, _REQUEST).repartition("bucket").sortWithinPartitions("bucket").mapInPandas(merge, _ANSWER)
    texts = docs.mapInPandas(place, "block long, bucket int, seq int, doc_id long, text binary, extra binary, answers binary")
    none = [F.lit(0).cast("int").alias("seq"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("text"), F.lit(None).cast("binary").alias("extra")]
    both = texts.unionByName(answered.select("block", "bucket", *none, "answers"))
    return both.repartition("block").sortWithinPartitions("block", "bucket", "seq").mapInPandas(gather, schema)


def check_answers(size: int, answers: np.ndarray) -> None:
    if size != len(answers):
        raise RuntimeError("the documents were read in another order the second time; store them before this operator")
