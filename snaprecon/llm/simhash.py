"""SimHash near-dedup with pigeonring candidate filtering.

Fingerprints: 64 majority bits over the XXH64 (seed 42) of word shingles.
Two fingerprints link when at most ``max_bits`` (4) bits differ.

Pigeonring: lay the 64 bits on a ring of m = max_bits + 1 segments. If two
fingerprints differ in at most t bits, some segment starts a chain in which,
for every length l, the first l segments differ in at most l*t/m bits. For
t = 4 and m = 5 the budgets are 0, 1, 2, 3, 4: the first segment is equal and
the first two differ in one bit at most. Those two segments are the join key:
a fingerprint is stored under its five keys and probes each with every zero
bit of the second segment set (one of two keys that differ in one bit has the
zero). Within a key, the longer chain budgets prune before the Hamming check.

Equal fingerprints are one class before any key is made, so copies cost
nothing. Within a key a breadth-first search over the not yet reached
fingerprints yields a spanning forest of the links, never all pairs, and
connectivity is the same. Components are found by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from snaprecon.llm._common import cut, digest, id_and_text, keep_rows
from snaprecon.llm._components import components

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint_of(text: str, words: int = 4) -> int:
    """The fingerprint of one text as an unsigned integer.

    ASCII letters are lower-cased, words are runs without space, tab, line
    feed, vertical tab, form feed or carriage return; repeated shingles count
    each time; fewer than ``words`` words make one shingle, none gives 0.
    """
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    stops = ends[words - 1 :].tolist()
    starts = [0, *(ends[: len(tokens) - words] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], 42) for a, b in zip(starts, stops, strict=True)], "<u8")
    columns = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(columns[:, k], minlength=256) @ _BITS for k in range(8)])
    set_bits = np.flatnonzero(2 * ones > len(hashes))
    return sum(1 << b for b in set_bits.tolist())


def fingerprints(docs: DataFrame, words: int = 4, with_digest: bool = False) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long), and the text's digest if asked for."""

    @pandas_udf("long")
    def fp(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(np.array([fingerprint_of(t, words) for t in texts], np.uint64).view(np.int64))

    rows = id_and_text(docs)
    return rows.select("doc_id", fp("text").alias("fp"), *([digest(rows).alias("digest")] if with_digest else []))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the ring's max_bits + 1 segments of the 64 bits."""
    m = max_bits + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _part(fp: np.ndarray, segment: tuple[int, int]) -> np.ndarray:
    return (fp >> np.uint64(segment[0])) & np.uint64((1 << segment[1]) - 1)


def _keys(max_bits: int):
    """Map task: each distinct fingerprint under its stored and its probing keys."""
    ring = segments(max_bits)
    # budget of a chain of two; with one segment the whole word is the key
    second = len(ring) > 1 and 2 * max_bits // len(ring) >= 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fp = frame["fp"].to_numpy(np.int64).view(np.uint64)
            for i, head in enumerate(ring):
                tail = ring[(i + 1) % len(ring)]
                key = (_part(fp, head) << np.uint64(tail[1])) | _part(fp, tail) if len(ring) > 1 else fp
                name = _key_of(key, i)
                yield pd.DataFrame({"key": name, "fp": fp.view(np.int64)})
                for bit in range(tail[1] if second else 0):
                    one = np.uint64(1 << bit)
                    zero = (key & one) == 0
                    yield pd.DataFrame({"key": _key_of(key[zero] | one, i), "fp": fp[zero].view(np.int64)})

    return run


def _key_of(key: np.ndarray, i: int) -> np.ndarray:
    """Key of rotation ``i`` as a signed long; keys of two 32-bit segments at most need no more room."""
    return ((np.uint64(i) << np.uint64(58)) ^ key).view(np.int64)


def _near(one: np.uint64 | np.ndarray, others: np.ndarray, ring: list[tuple[int, int]], max_bits: int) -> np.ndarray:
    """Which of ``others`` are within ``max_bits`` of ``one`` (or of its entry): chain budgets first, the full Hamming check on what is left."""
    diff = others ^ one
    m = len(ring)
    parts = [np.bitwise_count(_part(diff, s)).astype(np.int16) for s in ring]
    alive = np.zeros(len(others), bool)
    for start in range(m):
        total, ok = np.zeros(len(others), np.int16), np.ones(len(others), bool)
        for length in range(1, m + 1):
            total = total + parts[(start + length - 1) % m]
            ok &= total * m <= length * max_bits
        alive |= ok
    at = np.flatnonzero(alive)
    return at[np.bitwise_count(diff[at]) <= max_bits]


def _forest(fps: np.ndarray, ring: list[tuple[int, int]], max_bits: int) -> list[tuple[int, int]]:
    """Links that connect the fingerprints of one key exactly as all their links would."""
    left, links = fps, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            hit = _near(one, left, ring, max_bits)
            if len(hit):
                found = left[hit]
                links += [(one, x) for x in found]
                queue += list(found)
                keep = np.ones(len(left), bool)
                keep[hit] = False
                left = left[keep]
    return links


def _links(max_bits: int):
    """Task over rows sorted by key: the spanning links of every key."""
    ring = segments(max_bits)

    def solve(key: np.ndarray, fp: np.ndarray) -> pd.DataFrame | None:
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])
        key, fp = key[new], fp[new]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(first, len(key)))
        two = first[size == 2]
        close = two[_near(fp[two], fp[two + 1], ring, max_bits)]
        out = [(fp[close], fp[close + 1])]
        for at, n in zip(first[size > 2], size[size > 2], strict=True):
            if links := _forest(fp[at : at + n], ring, max_bits):
                out.append(tuple(np.array(side, np.uint64) for side in zip(*links, strict=True)))
        a, b = (np.concatenate([o[k] for o in out]) for k in (0, 1))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}) if len(a) else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for frame in frames:
            if not len(frame):
                continue
            key, fp = frame["key"].to_numpy(np.int64), frame["fp"].to_numpy(np.int64).view(np.uint64)
            if held and key[0] == held[-1][0][-1] and key[0] == key[-1]:
                held.append((key, fp))
                continue
            tail = int(np.searchsorted(key, key[-1]))
            ready = [*held, (key[:tail], fp[:tail])]
            held = [(key[tail:], fp[tail:])]
            k, f = (np.concatenate([r[j] for r in ready]) for j in (0, 1))
            if len(k) and (got := solve(k, f)) is not None:
                yield got
        if held and (got := solve(*(np.concatenate([r[j] for r in held]) for j in (0, 1)))) is not None:
            yield got

    return run


def near_links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints of column fp; they connect what all links within ``max_bits`` connect."""
    keyed = fps.select("fp").mapInPandas(_keys(max_bits), "key long, fp long")
    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInPandas(_links(max_bits), "a long, b long").distinct()


def _rooted(docs: DataFrame, words: int, max_bits: int, with_digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows' :func:`fingerprints`, and of each fp the root of its component and the least doc_id."""
    marks = cut(fingerprints(docs, words, with_digest))
    classes = cut(marks.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(classes, max_bits))
    return marks, classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")


def simhash_dedup(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of ``docs``.

    Null and blank texts have fingerprint zero and link like any other. The
    component_id is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits; null doc_ids never name a component (a
    component of null ids alone has a null id). Repeated rows and other
    columns change nothing; an empty table gives no rows.
    """
    marks, rooted = _rooted(docs, words, max_bits)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(names, "root").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return marks.join(by_fp, "fp").select("doc_id", hexed, "component_id")


def drop_near_copies(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with exactly one row of each component: the smallest doc_id (null last), then the smallest digest."""
    marks, rooted = _rooted(docs, words, max_bits, with_digest=True)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    # the smallest of a fingerprint first, so a hot fingerprint or component is one row
    best = marks.groupBy("fp").agg(F.min(rank).alias("best")).join(rooted.select("fp", "root"), "fp")
    chosen = best.select("fp", "root").join(best.groupBy("root").agg(F.min("best").alias("best")), "root").select("fp", "best")
    kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("digest") == F.col("best.digest"))
    return keep_rows(docs, marks.join(chosen, "fp").select("doc_id", "digest", kept.alias("kept")))
