"""Whitening, the Merkle manifest and exact top-k against brute force, and on awkward input."""

from __future__ import annotations

import collections
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snaprecon.llm import merkle, topk, whitening
from snaprecon.llm._ranks import positions
from snaprecon.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, path string, pos long, n long, root string"
VECTORS = "vec_id long, embedding array<float>, label int, x string, n long, score double"


def written(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


# ---- positions


def test_positions_are_gapless_in_groups(spark):
    rows = [(g, v, k) for g, many in (("a", 500), ("b", 1), ("c", 40)) for k, v in enumerate([None, *range(many - 1)])] + [("d", 7, 0)] * 30
    got = positions(spark.createDataFrame(rows, "grp string, v long, k long"), "grp", ["v"]).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["grp"]].append((r["pos"], r["v"], r["n"]))
    assert len(got) == len(rows)
    for found in by.values():
        found.sort()
        assert [p for p, *_ in found] == list(range(len(found))) and {n for *_, n in found} == {len(found)}
        values = [(-1 if v is None else v) for _, v, _ in found]
        assert values == sorted(values)


# ---- Merkle manifest


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def entry(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, i):
    found = []
    for level in levels[:-1]:
        run = i // 3 * 3
        found.append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
        i //= 3
    return found


def brute_manifest(rows):
    groups = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        head = "".join(entry(v) for v in (doc_id, source, lang, n_chars))
        leaf = H(head + entry(text))
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None
        groups[source].append((doc_id is not None, doc_id or 0, leaf, H(head + entry(text.replace("\n", ""))) if bad else leaf, doc_id))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([r[2] for r in sorted(groups[s], key=lambda r: r[:3])]) for s in sources}
    top = levels_of([trees[s][-1][0] for s in sources]) if sources else [[None]]
    root, out = top[-1][0], []
    for k, s in enumerate(sources):
        for i, (_, _, leaf, changed, doc_id) in enumerate(sorted(groups[s], key=lambda r: r[:3])):
            path, node = way(trees[s], i) + way(top, k), changed
            for left, right in path:
                node = H(left + node + right)
            out.append((doc_id, leaf, trees[s][-1][0], root, H("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("most", [2, 9, 60])
def test_manifest_against_brute_force(spark, tmp_path, most):
    """Sources of one to many blocks, a null source, null and repeated ids and rows, empty, blank and very long texts."""
    rows = [(i, f"line {i}\nof text\n", "en", f"s{i % most}" if i % most else None, i) for i in range(700)]
    rows += [(10_000 + i, f"x{i}\n", None, "one long source", None) for i in range(1_600)]
    rows += [(None, "a\nb", "en", "s1", 3), (None, None, None, None, None), (5, "other", "en", "s1", 1), (6, "line 6", "en", "é", 1), (6, "line 6", "en", "é", 1), (7, "", "", "", 0), (8, "word\n" * 200_000, "en", "s1", 1)]
    sf = written(spark, tmp_path, "documents", [(d, t, la, s, n, "leaf", "path", 1, 2, "root") for d, t, la, s, n in rows], DOCS)
    got = QUERIES["op12_merkle_manifest"](spark, sf)
    assert sorted([tuple(r[c] for c in COLUMNS) for r in got.collect()], key=str) == brute_manifest(rows)


@pytest.mark.parametrize("many", [0, 1, 2, 3, 4, 243, 244])
def test_manifest_of_few_rows(spark, tmp_path, many):
    rows = [(i, f"text\n{i}", "en", "s", 1) for i in range(many)]
    sf = written(spark, tmp_path, "documents", [(*r, "", "", 0, 0, "") for r in rows], DOCS)
    got = QUERIES["op12_merkle_manifest"](spark, sf).collect()
    assert sorted([tuple(r[c] for c in COLUMNS) for r in got], key=str) == brute_manifest(rows)


def test_manifest_proves_what_it_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("leaf", merkle.leaf(F.col("doc_id"), F.col("text")))
    found = merkle.manifest(docs, "source", ["doc_id"], ["doc_id", "leaf"])
    ends = found.select(merkle.fold(F.col("leaf"), F.col("path")).alias("right"), merkle.fold(F.sha2(F.lit("x"), 256), F.col("path")).alias("wrong"), "root")
    assert ends.where("right <> root or wrong = root").count() == 0 and ends.count() == docs.count()


# ---- whitening


def symmetric(values, seed):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * values) @ q.T


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 40), st.integers(0, 10**6), st.integers(1, 20))
def test_leading_components(size, seed, wanted):
    rng = np.random.default_rng(seed)
    values = np.sort(rng.choice([1.0, 2.0, 2.0 + 1e-7, 30.0, 31.0, rng.uniform(0.5, 50)], size))[::-1]
    matrix = symmetric(values, seed)
    found, vectors = whitening.leading(matrix, wanted)
    assert np.allclose(found, values[:wanted], rtol=1e-11)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-11
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-10


def test_inertia_counts_and_intervals():
    values = np.array([1.0, 1.0, 1.0, 2.0, 3.0, 3.5, 9.0])
    form = whitening.tridiagonal(symmetric(values, 3))
    assert [whitening.above(form, s) for s in (0.0, 1.5, 2.5, 3.2, 5.0, 10.0)] == [7, 4, 3, 2, 1, 0]
    parts = whitening.intervals(form, 0.0, 10.0, 7, size=2)
    assert sum(c for *_, c in parts) == 7 and all(((values > lo) & (values <= hi)).sum() == c for lo, hi, c in parts)
    assert whitening.intervals(form, 0.0, 10.0, 1, size=2)[0][1] == 10.0


def test_a_rank_that_is_short_has_fewer_components():
    assert len(whitening.leading(np.zeros((3, 3)), 2)[0]) == 0
    assert len(whitening.leading(np.outer(np.arange(6.0), np.arange(6.0)), 4)[0]) == 1


def brute_whitening(rows, wanted=16):
    whole = [(i, [float(np.float32(c)) for c in e]) for i, e in rows if e and all(c is not None and np.isfinite(c) for c in e)]
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in e] for _, e in whole], np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    deviation = ((n * x - total) ** 2).sum(axis=1)
    return [i for i, _ in whole], n, deviation, (x - total / n) @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


AWKWARD_VECTORS = [(900, None), (901, [None] * 5), (902, [1.0, float("nan"), 0.0, 0.0, 0.0]), (903, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (904, [])]


def vector_rows(seed=0, many=300, size=5):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(c) for c in rng.standard_normal(size).astype(np.float32)]) for i in range(many)]
    rows += [(1000 + i, rows[50][1]) for i in range(150)] + [(None, rows[3][1]), (7, rows[7][1]), (50, [float(c) for c in rng.standard_normal(size).astype(np.float32)])]
    return rows + AWKWARD_VECTORS


def test_whitening_against_brute_force(spark, tmp_path):
    """A vector that a third of the rows share, repeated rows, a null id; null, empty and non-finite vectors go."""
    rows = vector_rows()
    sf = written(spark, tmp_path, "embeddings", [(i, e, 1, "x", 9, 0.5) for i, e in rows], VECTORS)
    got = QUERIES["op11_whitening"](spark, sf).collect()
    ids, n, deviation, y, explained = brute_whitening(rows)
    assert len(got) == len(ids) * 5 and {r["n"] for r in got} == {n} and all(r["identity_error"] < 1e-9 for r in got)
    found = collections.Counter((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1)
    assert found == collections.Counter(zip(ids, deviation.tolist(), strict=True))
    assert np.allclose([next(r["explained"] for r in got if r["component"] == k) for k in range(1, 6)], explained, rtol=1e-9)
    for k in range(5):
        mine = sorted((r["deviation"], r["whitened"]) for r in got if r["component"] == k + 1)
        sign = np.sign(sum(a * b for (_, a), b in zip(mine, [v for _, v in sorted(zip(deviation.tolist(), y[:, k], strict=True))], strict=True)))
        theirs = sorted(zip(deviation.tolist(), (sign * y[:, k]).tolist(), strict=True))
        assert np.allclose(mine, theirs, rtol=1e-8, atol=1e-9)


@pytest.mark.parametrize("rows", [[], AWKWARD_VECTORS, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_whitening_without_components(spark, tmp_path, rows):
    sf = written(spark, tmp_path, "embeddings", [(i, e, 1, "x", 9, 0.5) for i, e in rows], VECTORS)
    assert QUERIES["op11_whitening"](spark, sf).collect() == []


def test_whitening_drops_odd_lengths_and_keeps_low_ranks(spark, tmp_path):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0]), (3, [0.0, 0.0]), (4, [-1.0, 0.0, 0.0])]
    sf = written(spark, tmp_path, "embeddings", [(i, e, 1, "x", 9, 0.5) for i, e in rows], VECTORS)
    got = QUERIES["op11_whitening"](spark, sf).collect()
    assert sorted((r["vec_id"], r["component"]) for r in got) == [(i, k) for i in (1, 2, 4) for k in (1, 2)]


# ---- exact top-k


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 200), st.integers(1, 6), st.integers(1, 40))
def test_cover_tree_invariants(seed, many, size, spread):
    points = np.random.default_rng(seed).integers(-spread, spread + 1, (many, size))
    tree = topk.CoverTree(points, leaf=4)
    assert sorted(tree.order.tolist()) == list(range(many))
    for node in range(len(tree.centre)):
        centre = points[tree.centre[node]]
        own = points[tree.order[tree.lo[node] : tree.hi[node]]]
        away = np.sqrt(((own - centre) ** 2).sum(axis=1).astype(float))
        assert np.isclose(away.max(), tree.radius[node])
        kids = range(tree.kid[node], tree.end[node])
        if kids:
            cover = tree.radius[node] / topk.BASE
            assert tree.centre[kids[0]] == tree.centre[node] and all(tree.radius[c] <= cover + 1e-9 for c in kids)
            assert sum(tree.hi[c] - tree.lo[c] for c in kids) == len(own)
            heads = points[tree.centre[list(kids)]].astype(float)
            apart = np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(axis=2)) + np.eye(len(heads)) * 1e9
            assert apart.min() > cover - 1e-9


def brute_top(rows, k=5, every=50):
    whole = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in e]) for i, e in rows if e is not None and all(c is not None and np.isfinite(c) for c in e)]
    out = []
    for i, x in whole:
        if i is not None and i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), j is None, j) for j, y in whole if j != i)[:k]
            out += [(i, rank, j, -score) for rank, (score, _, j) in enumerate(scored, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,size", [(0, 5), (1, 2), (2, 16)])
def test_top_k_against_brute_force(spark, tmp_path, monkeypatch, seed, size):
    """Ties, a hot vector, repeated ids and rows, a null id, ragged and unusable vectors; several blocks and chunks."""
    monkeypatch.setattr(topk, "CHUNK_QUERIES", 4)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    rows = [(i, e) for i, e in vector_rows(seed, 300, size)] + [(100, [0.5]), (100, [0.5])]
    sf = written(spark, tmp_path, "embeddings", [(i, e, 1, "x", 9, 0.5) for i, e in rows], VECTORS)
    got = QUERIES["op13_topk"](spark, sf)
    assert sorted([(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()], key=str) == brute_top(rows)


@pytest.mark.parametrize("rows", [[], AWKWARD_VECTORS[:4], [(50, [1.0])], [(1, [1.0]), (2, [2.0])]])
def test_top_k_without_answers(spark, tmp_path, rows):
    sf = written(spark, tmp_path, "embeddings", [(i, e, 1, "x", 9, 0.5) for i, e in rows], VECTORS)
    assert QUERIES["op13_topk"](spark, sf).collect() == []


def test_scores_of_large_vectors_are_exact_or_refused():
    points = np.array([[1 << 29, 3], [(1 << 29) + 1, 5], [7, -(1 << 29)]], np.int64)
    group = topk.Group(points, np.array([1, 2, 3]))
    best = topk.Best(3, 2)
    topk.search(group, group, best)
    at = group.ids.tolist().index(1)
    assert best.ids[at].tolist() == [2, 3] and best.scores[at].tolist() == [(1 << 29) * ((1 << 29) + 1) + 15, 7 * (1 << 29) - 3 * (1 << 29)]
    huge = topk.Group(np.array([[1 << 40], [1 << 40]], np.int64), np.array([1, 2]))
    with pytest.raises(ArithmeticError):
        topk.search(huge, huge, topk.Best(2, 1))
