"""Exact top-k inner products by dual-tree search over cover trees.

The rows are dealt out by their nearest pivot (range partitioned, so a pivot
or a vector that a third of all rows share is spread over many tasks) and
every block of rows is one written row. Queries come in
chunks of a proven size. A chunk's cover tree meets each block's: a pair
of nodes goes when even the best inner product that their covering radii allow
is below the worst k-th score of the query node's group, else the wider node
is opened, until leaves meet leaves and are scored. Queries are rows too:
searching a chunk against itself first gives every group a k-th score that
holds for the whole table, so blocks are pruned from their root on. Each task
keeps its k best; their merge is a ranking per query of k rows a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaprecon.llm._common import cut
from snaprecon.llm._ranks import positions
from snaprecon.session import fresh_path

BLOCK_ROWS = 2048
CHUNK_QUERIES = 8192
PIVOTS = 256
LEAF = 32
BASE = 1.25  # ratio of a node's cover distance to its children's
LOWEST = np.iinfo(np.int64).min
NO_ID = np.iinfo(np.int64).max  # stands for a null vec_id, which ranks after all others


class CoverTree:
    """Cover tree over integer points, as arrays; ``order`` lists the points so that a node's descendants are ``lo:hi``.

    Nesting: a node's point is the point of its first child. Covering: every
    descendant lies within the node's cover distance, and ``radius`` is the
    distance of the farthest. Separation: siblings are farther apart than the
    cover distance of their level. A node of at most ``LEAF`` points or of
    copies of one point is a leaf.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        wide = points.astype(float)
        order = np.arange(len(points))
        centre, radius, lo, hi, kids = [], [], [], [], []
        away = np.sqrt(((wide - wide[:1]) ** 2).sum(axis=1))
        todo = [(0, 0, len(points), away)] if len(points) else []
        for first, start, end, away in todo:  # breadth first: the children of a node follow one another
            reach = float(away.max())
            centre.append(first)
            radius.append(reach)
            lo.append(start)
            hi.append(end)
            if end - start <= leaf or reach == 0:
                kids.append((0, 0))
                continue
            members = order[start:end].copy()
            cover = reach / BASE
            at, begin, point = start, len(todo), first
            left, spans = np.arange(len(members)), away
            while True:
                inside = spans <= cover
                mine = members[left[inside]]
                order[at : at + len(mine)] = mine
                todo.append((point, at, at + len(mine), spans[inside]))
                at += len(mine)
                left = left[~inside]
                if not len(left):
                    break
                point = int(members[left[0]])
                spans = np.sqrt(((wide[members[left]] - wide[point]) ** 2).sum(axis=1))
            kids.append((begin, len(todo)))
        self.order = order
        self.centre, self.radius = np.array(centre, np.int64), np.array(radius, float)
        self.lo, self.hi = np.array(lo, np.int64), np.array(hi, np.int64)
        self.kid, self.end = np.array(kids, np.int64).reshape(-1, 2).T


class Group:
    """Points and their ids in the order of their cover tree, with what the bounds need."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.tree = CoverTree(points, leaf)
        self.points, self.ids, self.rows = points[self.tree.order], ids[self.tree.order], self.tree.order
        self.wide = self.points.astype(float)
        self.centres = points[self.tree.centre].astype(float)
        self.norms = np.sqrt((self.centres**2).sum(axis=1))
        self.reach = float(np.sqrt((self.wide**2).sum(axis=1)).max(initial=0))


class Best:
    """The ``k`` best (score, id) of each query, ids ascending among equal scores; ``floor`` is a k-th score known from elsewhere."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.k, self.floor = k, np.full(queries, LOWEST, np.int64) if floor is None else floor
        self.scores = np.full((queries, k), LOWEST, np.int64)
        self.ids = np.full((queries, k), NO_ID, np.int64)
        self.known = np.zeros((queries, k), bool)

    def kth(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1], self.floor)

    def offer(self, lo: int, hi: int, row: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of the queries ``lo:hi``, ``row`` counted from ``lo``."""
        held = self.known[lo:hi]
        at = np.concatenate([np.repeat(np.arange(hi - lo), self.k)[held.ravel()], row])
        scores = np.concatenate([self.scores[lo:hi][held], scores])
        ids = np.concatenate([self.ids[lo:hi][held], ids])
        order = np.lexsort((ids, -scores, at))
        at, scores, ids = at[order], scores[order], ids[order]
        first = np.searchsorted(at, np.arange(hi - lo))
        rank = np.arange(len(at)) - first[at]
        best = rank < self.k
        at, rank = at[best] + lo, rank[best]
        self.scores[at, rank], self.ids[at, rank], self.known[at, rank] = scores[best], ids[best], True


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``lo:hi``, one range after another."""
    many = hi - lo
    return np.repeat(lo - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())


def _opened(tree: CoverTree, nodes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node's children, each beside the node's other half."""
    return _ranges(tree.kid[nodes], tree.end[nodes]), np.repeat(others, tree.end[nodes] - tree.kid[nodes])


def _inner(queries: Group, block: Group, q: np.ndarray, d: np.ndarray, step: int = 1 << 15) -> np.ndarray:
    """The inner products of the centres of node pairs: one product of matrices where most combinations are asked for."""
    some_q, at_q = np.unique(q, return_inverse=True)
    some_d, at_d = np.unique(d, return_inverse=True)
    if len(some_q) * len(some_d) <= 4 * len(q):
        return (queries.centres[some_q] @ block.centres[some_d].T)[at_q, at_d]
    return np.concatenate([np.einsum("ij,ij->i", queries.centres[q[i : i + step]], block.centres[d[i : i + step]]) for i in range(0, len(q), step)])


def _ceilings(queries: Group, block: Group, q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The greatest inner product that any two descendants of each node pair can have."""
    q_radius, d_radius = queries.tree.radius[q], block.tree.radius[d]
    return _inner(queries, block, q, d) + q_radius * block.norms[d] + d_radius * queries.norms[q] + q_radius * d_radius


def search(queries: Group, block: Group, best: Best) -> None:
    """Improve ``best`` (queries in the tree's order) by the rows of ``block``, but for those that share the query's id."""
    if not len(queries.points) or not len(block.points):
        return
    most = queries.reach * block.reach
    if most >= 2.0**62:
        raise ArithmeticError("an inner product of these vectors does not fit 64 bits")
    slack = 1.0 + 1e-9 * most  # of rounding; scores are whole numbers
    qt, dt = queries.tree, block.tree
    spans = np.stack([qt.lo, qt.hi], axis=1).ravel()
    worst = np.minimum.reduceat(np.append(best.kth(), NO_ID), spans)[::2]
    q = d = np.zeros(1, np.int64)
    leaves = []
    while len(q):
        ceiling = _ceilings(queries, block, q, d)
        alive = ceiling + slack >= worst[q]
        q, d, ceiling = q[alive], d[alive], ceiling[alive]
        q_leaf, d_leaf = qt.kid[q] == qt.end[q], dt.kid[d] == dt.end[d]
        both = q_leaf & d_leaf
        leaves.append((q[both], d[both], ceiling[both]))
        wide_q = ~q_leaf & (d_leaf | (qt.radius[q] >= dt.radius[d]))
        wide_d = ~both & ~wide_q
        q1, d1 = _opened(qt, q[wide_q], d[wide_q])
        d2, q2 = _opened(dt, d[wide_d], q[wide_d])
        q, d = np.concatenate([q1, q2]), np.concatenate([d1, d2])
    q, d, ceiling = (np.concatenate(part) for part in zip(*leaves, strict=True))
    order = np.argsort(q, kind="stable")
    q, d, ceiling = q[order], d[order], ceiling[order]
    edges = np.flatnonzero(np.diff(q)) + 1
    for begin, end in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(q)])), strict=True):
        if begin == end:
            continue
        lo, hi = int(qt.lo[q[begin]]), int(qt.hi[q[begin]])
        kth = best.kth()[lo:hi]
        near = d[begin:end][ceiling[begin:end] + slack >= kth.min()]
        if not len(near):
            continue
        rows = _ranges(dt.lo[near], dt.hi[near])
        scores = (queries.wide[lo:hi] @ block.wide[rows].T).astype(np.int64) if most < 2.0**53 else queries.points[lo:hi] @ block.points[rows].T
        ids = block.ids[rows]
        wanted = (scores >= kth[:, None]) & (ids[None, :] != queries.ids[lo:hi, None])
        row, column = np.nonzero(wanted)
        if len(row):
            best.offer(lo, hi, row, scores[row, column], ids[column])


# ---- on Spark


def integer_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, x): whole numbers floor(scale * component) of every row whose vector is not null and holds no null or non-finite entry.

    Vectors of several lengths are filled up with zeros to the longest.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    whole = rows.where(F.col("e").isNotNull() & F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    width = whole.agg(F.max(F.size("e"))).first()[0] or 0
    x = F.transform("e", lambda c: F.floor(c * scale))
    return whole.select("vec_id", F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("e"))).alias("x"))


def _matrix(column) -> np.ndarray:
    rows = column.tolist() if hasattr(column, "tolist") else column
    return np.array(rows, np.int64).reshape(len(rows), -1)


def _ids(column: pd.Series) -> np.ndarray:
    return column.astype("Int64").fillna(NO_ID).to_numpy(np.int64)


def index(vectors: DataFrame) -> DataFrame:
    """The blocks of the table (rows, ids, points), each at most ``BLOCK_ROWS`` rows that lie near the same pivot.

    The pivots are the ``PIVOTS`` rows with the least hashes: any choice gives
    the same answers, a better one prunes more.
    """
    sample = vectors.orderBy(F.xxhash64("vec_id", "x")).limit(PIVOTS).collect()
    pivots = _matrix([r["x"] for r in sample]).astype(float) if sample else np.zeros((1, 0))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = _matrix(frame["x"])
            wide = points.astype(float)
            far = (wide**2).sum(axis=1)[:, None] - 2 * wide @ pivots.T + (pivots**2).sum(axis=1)
            small = points.min(initial=0) >= -(1 << 31) and points.max(initial=0) < 1 << 31
            packed = points.astype("<i4" if small else "<i8")
            yield pd.DataFrame({"vec_id": frame["vec_id"].astype("Int64"), "pivot": far.argmin(axis=1).astype(np.int32), "away": far.min(axis=1, initial=np.inf), "small": small, "x": [p.tobytes() for p in packed]})

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, points = np.zeros(0, np.int64), None

        def block(n: int) -> pd.DataFrame:
            return pd.DataFrame({"rows": [n], "ids": [ids[:n].tobytes()], "points": [points[:n].tobytes()]})

        for frame in frames:
            more = np.stack([np.frombuffer(x, "<i4" if small else "<i8").astype(np.int64) for x, small in zip(frame["x"], frame["small"], strict=True)])
            ids = np.concatenate([ids, _ids(frame["vec_id"])])
            points = more if points is None else np.concatenate([points, more])
            while len(ids) >= BLOCK_ROWS:
                yield block(BLOCK_ROWS)
                ids, points = ids[BLOCK_ROWS:], points[BLOCK_ROWS:]
        if len(ids):
            yield block(len(ids))

    near = vectors.mapInPandas(assign, "vec_id long, pivot int, away double, small boolean, x binary")
    keys = ["pivot", "away", F.xxhash64("vec_id", F.monotonically_increasing_id())]
    dealt = near.repartitionByRange(*keys).sortWithinPartitions("pivot", "away")
    return dealt.select("vec_id", "small", "x").mapInPandas(build, "rows int, ids binary, points binary")


_FOUND = "number long, query_id long, vec_id long, score long"


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` greatest inner products of each row whose id ``every`` divides with all rows of other ids.

    Scores are exact; ties go to the smaller vec_id. Rows whose vector is null
    or holds a null or non-finite component take no part; shorter vectors
    count as filled up with zeros. A row without an id is no query; as a
    candidate it ranks after equal scores with one. Rows that repeat an id are
    candidates each, but none of them of their own id; a query row that is
    repeated is answered as often. An empty table gives no rows. Where a score
    could pass 62 bits the query stops with an error.
    """
    spark = embeddings.sparkSession
    vectors = integer_vectors(embeddings, scale)
    path = fresh_path(spark, "topk-index")
    index(vectors).write.parquet(path)
    asked = positions(vectors.where(F.col("vec_id") % every == 0).select(F.lit(0).alias("all"), "vec_id", "x"), "all", ["vec_id"])
    asked = cut(asked.select("pos", "vec_id", "x"))
    answers = fresh_path(spark, "topk-answers")
    for first in range(0, asked.count(), CHUNK_QUERIES):
        chunk = asked.where(F.col("pos").between(first, first + CHUNK_QUERIES - 1)).toArrow()
        group = Group(_matrix(chunk["x"].to_pylist()), chunk["vec_id"].to_numpy().astype(np.int64))
        among = Best(len(group.points), k)
        search(group, group, among)  # rows of the chunk are rows of the table: their k-th scores are a floor
        sent = spark.sparkContext.broadcast((group, among.kth(), chunk["pos"].to_numpy()[group.rows]))

        def task(blocks: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            queries, floor, numbers = sent.value
            best = Best(len(queries.points), k, floor)
            for frame in blocks:
                for rows, ids, points in zip(frame["rows"], frame["ids"], frame["points"], strict=True):
                    search(queries, Group(np.frombuffer(points, np.int64).reshape(rows, -1), np.frombuffer(ids, np.int64)), best)
            at, rank = np.nonzero(best.known)
            ids = best.ids[at, rank]
            yield pd.DataFrame({"number": numbers[at], "query_id": queries.ids[at], "vec_id": pd.Series(ids).astype("Int64").mask(ids == NO_ID), "score": best.scores[at, rank]})

        found = spark.read.parquet(path).mapInPandas(task, _FOUND)
        order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(answers)
        sent.destroy()
    schema = "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.mode("append").parquet(answers)
    return spark.read.schema(schema).parquet(answers)
