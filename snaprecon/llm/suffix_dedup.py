"""Removal of repeated byte strings by merging runs of sampled suffixes of text shards.

Every byte covered by a string of ``LENGTH`` (400) bytes that also starts
elsewhere goes. A Burrows-Wheeler transform of all bytes needs 400 refinement
passes over all of them; none is built here. What is merged are runs of the
sampled suffixes that can matter, over an alphabet of hashed strings:

* Each 400-byte string has 201 substrings of 200 bytes; the one with the least
  hash (the last of equals) is its anchor. Equal strings have equal anchors at
  equal places. The strings that share an anchor occurrence start in one
  stretch; the bytes they cover are the anchor's context.
* A shard's run holds, for each anchor, the suffix (anchor, context) as two
  symbols in suffix order. Bucket by bucket the runs of all shards are merged
  by one stable pass a symbol, which gives common prefixes:
  0 symbols - the anchor is unique, none of its strings repeats; 2 - the whole
  context occurs elsewhere, all its strings repeat; 1 - equal anchors in
  different contexts, which the second round decides.
* In the second round the strings of such contexts (one holder of each
  distinct context) are suffixes of two symbols, their halves. The same merge
  finds the intervals with a common prefix of both, the repeated strings.

Hashes have 64 bits, a string's two halves 128. The sampled suffixes of the
first round are about a hundredth of all; the second round handles what lies
within 400 bytes of the end of a repeat.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaprecon.llm._common import SpanHasher, id_and_text, joined
from snaprecon.llm._merge import Block, check_answers, exchange, interleave, sorted_run
from snaprecon.session import fresh_path

LENGTH = 400
REPEATED_ANCHOR, REPEATED_CONTEXT, TELL = 1, 2, 4


def _window_least(h: np.ndarray, width: int) -> np.ndarray:
    """For each i, the place of the least of h[i : i + width], the last of equals."""
    at = np.arange(len(h), dtype=np.int32 if len(h) < 1 << 31 else np.int64)
    value, span = h, 1
    while 2 * span <= width:
        right = value[span:] <= value[:-span]
        at = np.where(right, at[span:], at[: len(at) - span])
        value = np.where(right, value[span:], value[:-span])
        span *= 2
    if rest := width - span:
        at = np.where(value[rest:] <= value[:-rest], at[rest:], at[: len(at) - rest])
    return at


def anchors(texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """Anchors of the texts: document, first and last string start they answer for (places in the joined bytes), anchor and context hash."""
    data, starts = joined(texts)
    hasher = SpanHasher(data)
    half, empty = length // 2, np.zeros(0, np.int64)
    count = np.maximum(0, np.diff(starts) - 1 - length + 1)
    out = {"hasher": hasher, "data": data, "starts": starts, "doc": empty, "first": empty, "last": empty, "anchor": empty.astype(np.uint64), "context": empty.astype(np.uint64)}
    if not count.sum():
        return out
    p = np.arange(len(data) - half + 1)
    h = hasher.spans(p, p + half)
    least = _window_least(h, length - half + 1)
    begin = np.repeat(starts[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    doc = np.repeat(np.arange(len(texts)), count)
    where = least[begin]
    edge = np.ones(len(begin), bool)
    edge[1:] = (where[1:] != where[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(edge)
    first, last = begin[at], begin[np.append(at[1:], len(begin)) - 1]
    return out | {"doc": doc[at], "first": first, "last": last, "anchor": h[where[at]], "context": hasher.spans(first, last + length)}


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the closed ranges, in order."""
    n = last - first + 1
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _anchor_answers(runs: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    order, common = interleave(runs)
    count = np.concatenate(counts)[order]
    anchor, context = np.cumsum(common < 1) - 1, np.cumsum(common < 2) - 1
    in_anchor, in_context = np.bincount(anchor, count)[anchor], np.bincount(context, count)[context]
    flags = REPEATED_ANCHOR * (in_anchor > 1) + REPEATED_CONTEXT * (in_context > 1)
    # the first holder of each context tells its strings, where the anchor has other contexts too
    flags += TELL * ((common < 2) & (np.bincount(anchor, common < 2)[anchor] > 1))
    out = np.empty(len(order), np.int64)
    out[order] = flags
    return np.split(out, np.cumsum([r.shape[1] for r in runs])[:-1])


def _string_answers(runs: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    order, common = interleave(runs)
    group = np.cumsum(common < 2) - 1
    repeated = np.bincount(group, np.concatenate(counts)[order])[group] > 1
    out = np.empty(len(order), np.int64)
    out[order] = repeated
    return np.split(out, np.cumsum([r.shape[1] for r in runs])[:-1])


def _removed(text: bytes, starts: np.ndarray, length: int) -> tuple[int, int, str]:
    """Bytes removed, maximal runs and digest of the rest, when a repeated string begins at each of ``starts`` (ordered)."""
    if not len(starts):
        return 0, 0, hashlib.sha256(text).hexdigest()
    new = np.concatenate(([True], np.diff(starts) > length))
    first, last = starts[new], starts[np.append(np.flatnonzero(new)[1:], len(starts)) - 1] + length
    rest, at = hashlib.sha256(), 0
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        rest.update(text[at:a])
        at = b
    rest.update(text[at:])
    return int((last - first).sum()), len(first), rest.hexdigest()


_ROUND = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text binary, extra binary"
_COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def _first_round(length: int):
    def run(block: Block) -> tuple[np.ndarray, np.ndarray]:
        a = anchors(block.texts, length)
        symbols, counts, _ = sorted_run(np.stack((a["anchor"], a["context"])))
        return symbols, counts

    def finish(block: Block, answers: np.ndarray) -> pd.DataFrame:
        a = anchors(block.texts, length)
        symbols, _, entry = sorted_run(np.stack((a["anchor"], a["context"])))
        check_answers(symbols.shape[1], answers)
        flags = answers[entry]
        teller = np.zeros(len(entry), bool)
        teller[np.unique(entry, return_index=True)[1]] = True
        whole = (flags & REPEATED_CONTEXT) > 0
        ask = ((flags & REPEATED_ANCHOR) > 0) & ~whole & ((flags & TELL) > 0)
        tell = whole & teller & ((flags & TELL) > 0)
        bounds = np.searchsorted(a["doc"], np.arange(len(block.texts) + 1))
        rows = []
        for k, (doc_id, text) in enumerate(zip(block.ids, block.texts, strict=True)):
            part = slice(bounds[k], bounds[k + 1])
            known, more, said = whole[part], ask[part], tell[part]
            first, last = a["first"][part] - a["starts"][k], a["last"][part] - a["starts"][k]
            if not (more | said).any():
                rows.append((doc_id, len(text), *_removed(text, _ranges(first[known], last[known]), length), None, None))
            else:
                kind = known + 2 * (more | said)
                keep = kind > 0
                rows.append((doc_id, len(text), None, None, None, text, np.stack((first[keep], last[keep], kind[keep])).astype("<i8").tobytes()))
        out = pd.DataFrame(rows, columns=[*_COLUMNS, "text", "extra"])
        return out.astype({c: "Int64" for c in ("doc_id", "n_removed", "n_spans")})

    return run, finish


def _told(block: Block, length: int) -> tuple[SpanHasher, np.ndarray, list]:
    """String starts (in the joined bytes) that the block's open contexts send, and each document's ranges."""
    data, starts = joined(block.texts)
    ranges = [np.frombuffer(e, "<i8").reshape(3, -1) for e in block.extra]
    parts = [_ranges(r[0][r[2] >= 2], r[1][r[2] >= 2]) + s for r, s in zip(ranges, starts[:-1], strict=True)]
    return SpanHasher(data), np.concatenate(parts), [ranges, starts, np.cumsum([0, *(len(p) for p in parts)])]


def _second_round(length: int):
    def symbols_of(hasher: SpanHasher, at: np.ndarray) -> np.ndarray:
        return np.stack((hasher.spans(at, at + length // 2), hasher.spans(at + length // 2, at + length)))

    def run(block: Block) -> tuple[np.ndarray, np.ndarray]:
        hasher, at, _ = _told(block, length)
        symbols, counts, _ = sorted_run(symbols_of(hasher, at))
        return symbols, counts

    def finish(block: Block, answers: np.ndarray) -> pd.DataFrame:
        hasher, at, (ranges, starts, bounds) = _told(block, length)
        symbols, _, entry = sorted_run(symbols_of(hasher, at))
        check_answers(symbols.shape[1], answers)
        repeated = answers[entry] > 0
        rows = []
        for k, (doc_id, text) in enumerate(zip(block.ids, block.texts, strict=True)):
            part = slice(bounds[k], bounds[k + 1])
            first, last, kind = ranges[k]
            sure = _ranges(first[kind % 2 == 1], last[kind % 2 == 1])
            rows.append((doc_id, len(text), *_removed(text, np.union1d(sure, at[part][repeated[part]] - starts[k]), length)))
        return pd.DataFrame(rows, columns=_COLUMNS).astype({"doc_id": "Int64"})

    return run, finish


def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``.

    Strings never cross documents; a string that starts twice in one document
    repeats, overlaps count. A null text is empty; shorter texts than
    ``length`` keep all their bytes. A row repeated with its doc_id is a
    document of its own, so both lose what they share. Other columns are
    ignored; an empty table gives no rows. ``docs`` is read twice and must give
    its rows in the same order both times, as files do.
    """
    spark = docs.sparkSession
    run, finish = _first_round(length)
    first = exchange(id_and_text(docs).withColumn("extra", F.lit(None).cast("binary")), run, _anchor_answers, finish, _ROUND)
    path = fresh_path(spark, "repeats")
    first.write.option("compression", "zstd").parquet(path)
    decided = spark.read.parquet(path)
    run, finish = _second_round(length)
    # the texts are UTF-8 by origin, so the string type holds the same bytes
    still = decided.filter("text is not null").select("doc_id", F.col("text").cast("string").alias("text"), "extra")
    late = exchange(still, run, _string_answers, finish, ", ".join(f"{c} {'string' if c == 'kept_sha256' else 'long'}" for c in _COLUMNS))
    return decided.filter("text is null").select(*_COLUMNS).unionByName(late)
