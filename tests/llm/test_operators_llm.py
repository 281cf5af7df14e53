"""The training-data operators against brute force, and on awkward input."""

from __future__ import annotations

import collections
import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

import corpus_pipeline
from snaprecon.llm import decontaminate, exact_dedup, lm_score, packing, quality, secret_scan, simhash, suffix_dedup, token_rollup, toxicity
from snaprecon.llm._components import components
from snaprecon.llm._merge import interleave, pack_numbers, pack_symbols, sorted_run, unpack_numbers, unpack_symbols
from snaprecon.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: awkward rows: null id, null and empty text, blanks, a repeated row, a tie of equal texts, one very long text
AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (None, "some text"), (4, "tie"), (5, "tie"), (6, "again"), (6, "again"), (7, "word " * 60_000), (8, "Ünïcode ✓   x"), (9, "one")]
SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, score double, digest string, host string, __id long, __digest string, __bad string, __kept boolean, __dropped long, pos long, n long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i, t, None, "s", True, 0.5, "x", "h", 1, "d", "b", False, 2, 3, 4) for i, t in AWKWARD], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(df):
    return [(r["doc_id"], (r["text"] or "")) for r in df.select("doc_id", "text").collect()]


# ---- exact dedup


def test_cuckoo_index_grows_finds_and_forgets():
    index, keys = exact_dedup.DigestIndex(1), [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, key in enumerate(keys):
        index.insert(key, i)
    assert index.size == 3000 and index.mask + 1 >= 3000 / exact_dedup.SLOTS
    assert [index.get(k) for k in keys] == list(range(3000))
    assert all(index.delete(k) for k in keys[::2]) and not index.delete(keys[0])
    assert [index.get(k) for k in keys] == [None if i % 2 == 0 else i for i in range(3000)]
    index.insert(keys[1], "new")
    assert index.size == 1500 and index.get(keys[1]) == "new" and len(list(index.items())) == 1500


def test_a_tag_hit_is_verified():
    index = exact_dedup.DigestIndex(1)
    index.insert(b"ab" + bytes(30), 1)
    assert index.get(b"ab" + bytes(29) + b"x") is None


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_exact_dedup(request, which):
    df = request.getfixturevalue(which)
    rows = texts(df)
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    expected = []
    for i, t in rows:
        ids = [x for x in groups[t] if x is not None]
        keep = max(ids) if ids else None
        expected.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_dedup(df).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    left = exact_dedup.drop_copies(df)
    assert left.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(i) for i, k, *_ in expected if i == k)


def test_live_digests(spark):
    d = [hashlib.sha256(bytes([i])).digest() for i in range(4)]
    live = spark.createDataFrame([(bytearray(d[0]), 2), (bytearray(d[1]), 1)], "digest binary, refs long")
    changes = spark.createDataFrame([(bytearray(d[0]), -1), (bytearray(d[1]), -1), (bytearray(d[2]), 1), (bytearray(d[2]), 1), (bytearray(d[3]), 1), (bytearray(d[3]), -1), (None, 1)], "digest binary, refs long")
    assert {bytes(r["digest"]): r["refs"] for r in exact_dedup.update_live(live, changes).collect()} == {d[0]: 1, d[2]: 2}


def test_a_delete_before_its_insert_is_kept(spark):
    schema, one = "digest binary, refs long", bytearray(hashlib.sha256(b"x").digest())
    state = spark.createDataFrame([], schema)
    for refs in (-1, 1):
        state = exact_dedup.update_live(state, spark.createDataFrame([(one, refs)], schema))
        state = spark.createDataFrame(state.collect(), schema)
    assert state.collect() == []
    behind = exact_dedup.update_live(state, spark.createDataFrame([(one, -2)], schema))
    assert [r["refs"] for r in exact_dedup.update_live(behind, spark.createDataFrame([(one, 3)], schema)).collect()] == [1]


# ---- SimHash


def fingerprint(text, words=4):
    tokens = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        tokens = tokens.replace(c, " ")
    tokens = [t for t in tokens.split(" ") if t]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB c\td\n\x85é ", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) == fingerprint(text)


def brute_components(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_simhash_dedup(request, which):
    df = request.getfixturevalue(which)
    rows = texts(df)
    fps = [fingerprint(t) for _, t in rows]
    root = brute_components(fps, 4)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    expected = [(i, f"{f:016x}", least[r]) for (i, _), f, r in zip(rows, fps, root, strict=True)]
    assert sorted(map(str, (tuple(r) for r in simhash.simhash_dedup(df).collect()))) == sorted(map(str, expected))


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 7])
def test_near_links_connect_what_all_links_connect(spark, bits):
    rng = np.random.default_rng(bits)
    seeds = rng.integers(0, 1 << 63, 25, dtype=np.uint64)
    fps = set(seeds.tolist())
    for s in seeds.tolist():
        for _ in range(12):
            x = s
            for b in rng.choice(64, rng.integers(0, 9), replace=False).tolist():
                x ^= 1 << b
            fps.add(x)
    dense = int(seeds[0])
    fps |= {dense ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.near_links(frame, bits)).collect()}
    got = [roots.get(x, x) for x in signed]
    want = brute_components(fps, bits)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300), (300, 301)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {300: 300, 301: 300}


# ---- packing


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_packer_fills_windows(lengths):
    packer, out = packing.Packer(16), []
    for k, n in enumerate(lengths):
        out += packer.add(k, np.arange(n, dtype=np.uint32))
    out += packer.close()
    seen = collections.defaultdict(list)
    for doc, start, ids, total, sequence, offset in out:
        assert total == lengths[doc] and list(ids) == list(range(start, start + len(ids)))
        seen[doc] += list(ids)
        assert offset + len(ids) <= 16
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in enumerate(lengths)}
    sizes = collections.Counter()
    for *_, ids, _, sequence, offset in sorted(out, key=lambda p: (p[4], p[5])):
        assert sizes[sequence] == offset
        sizes[sequence] += len(ids)
    assert all(n.bit_count() == 1 for n in sizes.values())


@pytest.mark.parametrize(("lengths", "most"), [([600] * 5000, 64), ([600, 1024, 1, 999, 3000] * 400, 1), ([700, 20, 40] * 700, 1024)])
def test_packer_holds_a_bounded_number_of_windows(lengths, most):
    packer, out, widest = packing.Packer(1024, most), [], 0
    for k, n in enumerate(lengths):
        out += packer.add(k, np.arange(n, dtype=np.uint32))
        widest = max(widest, sum(map(len, packer.levels.values())))
        assert packer.open == packer.counts.sum() == sum(map(len, packer.levels.values()))
    assert widest <= most
    placed = len(out)
    out += packer.close()
    assert placed >= 0.9 * len(out) or most == 1024  # nearly all is placed by the level array
    seen, sizes = collections.defaultdict(list), collections.Counter()
    for doc, start, ids, total, sequence, offset in out:
        assert total == lengths[doc] and list(ids[[0, -1]]) == [start, start + len(ids) - 1]
        seen[doc].append((start, len(ids)))
        sizes[sequence] += len(ids)
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[doc]):
            assert start == at
            at += length
        assert at == n
    assert all(n.bit_count() == 1 and n <= 1024 for n in sizes.values()) and sum(n < 1024 for n in sizes.values()) <= 10


def test_level_takes_the_least_sum_of_squares():
    packer = packing.Packer(8)
    packer.counts[[2, 5]] = [3, 1]
    best = {}
    for fill in (0, 2, 5):
        after = packer.counts.copy()
        if fill:
            after[fill] -= 1
        if fill + 3 < 8:
            after[fill + 3] += 1
        best[fill] = int((after[1:8] ** 2).sum())
    assert best[packer.level(3)] == min(best.values())


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_pack_holds_every_id_once(request, which):
    from tokenizers import Tokenizer

    df = request.getfixturevalue(which).filter("doc_id is null or doc_id <> 6")
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*t.encode(x, add_special_tokens=False).ids, 0] for i, x in texts(df)}
    got = packing.pack(df, RANKS).toPandas()
    for doc, pieces in got.groupby("doc_id", dropna=False):
        whole = ids[None if doc != doc or doc is None else int(doc)]
        at = 0
        for p in pieces.sort_values("start").itertuples():
            part = whole[p.start : p.start + p.length]
            assert p.start == at and p.doc_tokens == len(whole) and p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p.length
        assert at == len(whole)
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s["offset"]) == [0, *np.cumsum(s["length"])[:-1]] and s["length"].sum() <= 1024


def test_special_strings_are_encoded_as_by_tokenizers():
    from tokenizers import Tokenizer

    t, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.byte_bpe(RANKS)
    assert encode("a<|endoftext|>b").tolist() == [64, 50256, 65]
    for text in ("<|endoftext|>", "one  <|endoftext|>  two<|endoftext|><|endoftext|>", "<|endoftext", "a \n<|endoftext|>\n\n b", "plain ✓ text"):
        assert encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


# ---- merging runs, repeated bytes, language model


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=20), min_size=1, max_size=5))
def test_interleave_orders_all_runs(lists):
    runs = [sorted_run(np.array(x, np.uint64).T)[0] for x in lists]
    order, common = interleave(runs)
    flat = [tuple(c) for r in runs for c in r.T.tolist()]
    assert [flat[i] for i in order] == sorted(flat)
    for k in range(1, len(order)):
        a, b = flat[order[k - 1]], flat[order[k]]
        assert common[k] == (0 if a[0] != b[0] else 1 if a != b else 2)
    for r in runs:
        assert (unpack_symbols(pack_symbols(r), r.shape[1]) == r).all()
    assert unpack_numbers(pack_numbers(np.array([0, 255, 70_000]))).tolist() == [0, 255, 70_000]


def brute_removed(rows, length):
    raw = [t.encode() for _, t in rows]
    count = collections.Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, raw, strict=True):
        off = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                off[k : k + length] = True
        spans = int((np.diff(np.concatenate(([0], off.astype(int)))) == 1).sum())
        out.append((i, len(b), int(off.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~off].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("length", [400, 40])
def test_repeated_bytes(spark, docs, length):
    rows = texts(docs)[:: 1 if length == 400 else 4]
    passage = "".join(f"{k * 7919 % 1000:03d} " for k in range(150))
    rows += [(900, passage), (901, "x" + passage[30:] + "tail"), (902, "abc " * 300), (903, None or ""), (904, passage[:399] + "!" + passage[400:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in suffix_dedup.repeated_bytes(df, length).collect())
    assert got == sorted(brute_removed(rows, length))


def test_repeated_bytes_awkward(awkward):
    got = sorted((tuple(r) for r in suffix_dedup.repeated_bytes(awkward).collect()), key=str)
    rows = [(i, t or "") for i, t in AWKWARD if i != 7]
    long = next(t for i, t in AWKWARD if i == 7)
    assert got == sorted([*brute_removed(rows, 400), (7, len(long), len(long), 1, hashlib.sha256(b"").hexdigest())], key=str)


def brute_lm(rows):
    words = [t.lower().encode().split() for _, t in rows]
    own = []
    for w in words:
        c = collections.Counter(tuple(w[k : k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1))
        c[()] = len(w)
        own.append(c)
    total = sum(own, collections.Counter())
    for (i, _), w, mine in zip(rows, words, own, strict=True):
        n = lambda *g: total[g] - mine[g]  # noqa: B023, E731
        score = 0.0
        for k in range(len(w)):
            if k > 1 and n(*w[k - 2 : k + 1]):
                s = n(*w[k - 2 : k + 1]) / n(*w[k - 2 : k])
            elif k and n(*w[k - 1 : k + 1]):
                s = 0.4 * n(*w[k - 1 : k + 1]) / n(w[k - 1])
            else:
                s = 0.16 * (n(w[k]) or 0.5) / max(1, n())
            score += math.log(s)
        yield i, len(w), score


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_lm_scores(request, which):
    df = request.getfixturevalue(which)
    got = sorted(((r["doc_id"], r["n_words"], r["log_score"]) for r in lm_score.lm_scores(df).collect()), key=str)
    want = sorted(brute_lm(texts(df)), key=lambda x: str((x[0], x[1], x[2])))
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want, key=lambda x: str(x))]
    by = {(w[0], w[1]): w[2] for w in want}
    assert all(abs(g[2] - by[g[:2]]) < 1e-4 * max(1, abs(g[2])) for g in got)


# ---- decontamination


BENCH = [(1, "A train leaves the old station at 9 and travels 120 miles in 3 hours before it stops near the river for fuel and water"), (2, None), (3, "too short"), (4, "When Anna meets Robert at noon beside the quiet harbour Anna gives Robert seven heavy boxes of green apples")]


def found(spark, *rows):
    docs = spark.createDataFrame(list(rows), "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in decontaminate.contaminated(docs, bench).collect()}


def test_contamination(spark):
    again = BENCH[0][1].replace("9", "11").replace("120", "88").replace("3", "two")
    names = BENCH[3][1].replace("Anna", "Maria").replace("Robert", "Peter")
    mixed = names.replace("harbour Maria", "harbour Clara")  # one name of the item would stand for two
    hits = found(spark, (1, "Intro words here. " + BENCH[0][1].upper() + "!!"), (2, again), (3, "Some text. " + names), (4, "Some text. " + mixed), (5, None), (6, ""), (7, "too short"), (None, BENCH[0][1]), (8, " ".join(BENCH[0][1].split()[3:18])), (9, "a b c d e f g h i j k l m n"))
    assert hits == {(1, 1): False, (2, 1): True, (3, 4): True, (7, 3): False, (8, 1): False}


def test_short_items_are_matched_whole_as_copies(spark):
    bench = spark.createDataFrame([(1, "what is seven squared"), (2, "")], "item_id long, text string")
    rows = [(1, "so What is seven squared? It is 49"), (2, "what is eight squared"), (3, "what is seven"), (4, "")]
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert [(r["doc_id"], r["item_id"], r["reparameterised"]) for r in got] == [(1, 1, False)]


def test_contamination_by_items_of_numbers(spark):
    bench = spark.createDataFrame([(1, "12 + 7 + 33 - 5 = what number"), (2, "2 3 5 7 11 13 17 19 23 29 31 37 41 43 47 and then")], "item_id long, text string")
    rows = [(1, "Solve this. 12 + 7 + 33 - 5 = what number, please"), (2, "13 + 8 + 34 - 6 = what number"), (3, "primes 3 5 7 11 13 17 19 23 29 31 37 41 43 follow"), (4, "4 6 8 10 12 14 16 18 20 22 24 26 28 30 32")]
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {(r["doc_id"], r["item_id"], r["reparameterised"]) for r in got} == {(1, 1, False), (2, 1, True), (3, 2, False)}


def test_items_rich_in_numbers_count_when_whole_and_consistent(spark):
    bench = spark.createDataFrame([(1, "add 3 to 4 and 3 to 5 then 9 9 9 9 9 9 9 9 9 9 9 9 make what sum")], "item_id long, text string")
    rows = [
        (1, "add 6 to 4 and 6 to 5 then 8 8 8 8 8 8 8 8 8 8 8 8 make what sum"),
        (2, "add 6 to 4 and 7 to 5 then 8 8 8 8 8 8 8 8 8 8 8 8 make what sum"),
        (3, "then 8 8 8 8 8 8 8 8 8 8 8 8 make what sum"),
        (4, "then 9 9 9 9 9 9 9 9 9 9 9 9 make what sum"),
    ]
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {(r["doc_id"], r["reparameterised"]) for r in got} == {(1, True), (4, False)}


def test_contamination_with_values_changed_apart(spark):
    bench = [(1, "Tom buys 3 apples at the market and eats them all within 3 days of coming home"), (2, "A bus leaves at 9 and drives 120 miles until it stops after 3 hours"), (3, "When Anna sells 25 red boxes of green apples to the neighbour"), (4, "the cook gives 3 apples to a girl and later gives 3 apples to a boy")]
    rows = [
        (1, "Tom buys 4 apples at the market and eats them all within 5 days of coming home"),
        (2, "A bus leaves at 5 and drives 120 miles until it stops after 5 hours"),
        (3, "When Mary Ann sells twenty five red boxes of green apples to the neighbour"),
        (4, "When Anna sells two hundred and six red boxes of green apples to the neighbour"),
        (5, "the cook gives 4 apples to a girl and later gives 5 apples to a boy"),
        (6, "the cook gives 4 apples to a girl and later gives 4 apples to a boy"),
    ]
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["reparameterised"]) for r in got} == {(1, 1, True), (2, 2, True), (3, 3, True), (4, 3, True), (6, 4, True)}


def test_contaminated_documents_go_and_others_stay(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r["doc_id"] for r in decontaminate.contaminated(docs, bench).collect()}
    items = [r["text"] for r in bench.collect()]
    whole = {i for i, t in texts(docs) if any(x in t for x in items)}
    assert whole <= bad
    left = decontaminate.drop_contaminated(docs, bench)
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in texts(docs)} - bad


# ---- classifiers


def test_network_gradient():
    net = toxicity.Network(3)
    rng = np.random.default_rng(0)
    f = toxicity.Words([b"the quick brown fox jumps over the lazy dog " * 2, b"one two"])
    net.p["word"][f.word] = rng.normal(size=len(f.word))
    windows, _ = f.windows()
    keep = {}
    out = net.logits(f, windows, keep)
    grads = net.gradient(f, windows, np.ones(len(out), np.float32), keep)
    for name, at in (("uf", (1, 2)), ("ub", (2, 20)), ("xf", (0, 5)), ("cb", (9,)), ("att", (3,)), ("out", (4,)), ("gram", (int(f.gram[0]), 1))):
        old, step = net.p[name][at], 1e-2
        net.p[name][at] = old + step
        up = net.logits(f, windows).sum()
        net.p[name][at] = old - step
        down = net.logits(f, windows).sum()
        net.p[name][at] = old
        assert abs((up - down) / (2 * step) - grads[name][at]) < 0.02 * max(1, abs(grads[name][at])), name


def test_toxicity_learns_and_uses_only_the_text(spark):
    rng = np.random.default_rng(5)
    words, bad = [f"w{k}" for k in range(300)], ["idiot", "scum", "moron"]
    rows = []
    for i in range(600):
        text = rng.choice(words, int(rng.integers(20, 120))).tolist()
        if i % 3 == 0:
            for at in range(0, len(text), 12):
                text[at] = str(rng.choice(bad))
        rows.append((i, " ".join(text), i % 3 == 0))
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    got = toxicity.toxicity(df, marks).toPandas().set_index("doc_id")
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _, _ in rows}
    assert got["held_out"].to_dict() == held
    right = [(got["predicted"][i] == int(y)) for i, _, y in rows if held[i]]
    assert sum(right) >= 0.95 * len(right)
    left = toxicity.drop_toxic(df, marks)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == set(got.index[got["predicted"] == 0])


def test_toxicity_trains_on_whole_texts(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(180):
        text = [f"w{k}" for k in rng.integers(0, 300, 600)]
        if i % 2:
            text[int(rng.integers(45, 60))] = "scum"  # between what eight spread stretches of 24 words would hold
        rows.append((i, " ".join(text), i % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.toxicity(df, df.select("doc_id", "toxic")).filter("held_out").toPandas()
    assert (got["predicted"] == got["doc_id"] % 2).mean() >= 0.95


def test_classifiers_on_awkward_rows(awkward, spark):
    none = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 0, 0)], "doc_id long, toxic int, quality int")
    got = toxicity.toxicity(awkward, none).collect()
    assert len(got) == len(AWKWARD) and all(r["score"] == 0 and r["predicted"] == 0 for r in got)
    rows = quality.quality(awkward, none, F.col("source"), F.col("lang")).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)


def test_quality_shrinks_sparse_sites(spark, labels):
    clean, junk = "The quick brown fox jumps over the lazy dog and runs home. " * 4, "%%% *** $$$ !!! ### && " * 10
    rows = [(i, junk if i % 4 == 0 else clean + str(i), "big", "a") for i in range(400)] + [(1000 + i, junk, "bad", "a") for i in range(200)] + [(2000, junk, "tiny", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    marks = spark.createDataFrame([(i, int(t != junk)) for i, t, _, _ in rows if i % 2 == 0], "doc_id long, quality int")
    got = quality.quality(df, marks, F.col("source"), F.col("lang")).toPandas().set_index("doc_id")
    assert (got["kept"] == [t != junk for _, t, _, _ in sorted(rows)]).sum() >= 0 and got.loc[1, "kept"] and not got.loc[0, "kept"]
    overall = np.mean([t != junk for _, t, _, _ in rows])
    assert got.loc[1000, "host_score"] < 0.2 < got.loc[2000, "host_score"] <= overall + 0.05


def test_secret_scan(spark):
    seen = Observation("before")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rows = [(i, f"some words here token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" and more text", "s") for i in range(60)]
    rows += [(100 + i, f"a plain {'verylongwordwithoutend' * (1 + i % 2)} in a sentence of words {i}", "s") for i in range(60)]
    rows += [(500, None, None), (501, "", "s"), (None, 'token = "0123456789abcdef0123"', "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = secret_scan.secret_scan(df).toPandas()
    assert set(got[got["secret"]]["doc_id"].dropna().astype(int)) == set(range(60)) and len(got) == 121
    assert (got.groupby(got["doc_id"].fillna(-1))["ordinal"].min() == 0).all()


def test_candidates_lie_between_their_neighbours(spark):
    df = spark.createDataFrame([(1, "aa key=AAAAAAAAAAAAAAAA1 mid BBBBBBBBBBBBBBBB2 end")], "doc_id long, text string")
    got = [(r["ordinal"], r["candidate"], r["before"], r["after"]) for r in secret_scan.candidates(df).orderBy("ordinal").collect()]
    assert got == [(0, "AAAAAAAAAAAAAAAA1", "aa key=", " mid "), (1, "BBBBBBBBBBBBBBBB2", " mid ", " end")]


def test_unquoted_and_short_secrets(spark):
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N-XgL0n3I9P"
    rows = ["API_KEY=abcd1234efgh5678", 'password = "hunter42x"', "PASSWORD=hunter2", f"Authorization: Bearer {jwt} end", "https://h.io/p?token=abcd1234efgh5678&page=2", "MY_SERVICE_API_TOKEN=ab12cd34", "colour: plain, size=3", "padded QUJDREVGR0hJSktMTU5P== end", "id=abc12345x"]
    want = ["abcd1234efgh5678", "hunter42x", "hunter2", jwt, "abcd1234efgh5678", "ab12cd34", None, "QUJDREVGR0hJSktMTU5P==", "abc12345x"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = secret_scan.candidates(df)
    got = {r["doc_id"]: (r["candidate"], r["ordinal"], r["before"]) for r in found.orderBy("ordinal").collect()}
    assert [got.get(i, (None,))[0] for i in range(len(rows))] == want
    assert got[0][2] == "API_KEY=" and got[5][2] == "MY_SERVICE_API_TOKEN="
    marks = {(r["doc_id"], r["ordinal"]): r["secret"] for r in secret_scan.seed_labels(found).collect()}
    assert all(marks.get((i, got[i][1])) == 1 for i in (0, 1, 2, 4, 5)) and marks.get((7, 0)) == 0


def test_unquoted_secrets_are_learned(spark):
    rows = [(i, f"export API_KEY={hashlib.sha1(str(i).encode()).hexdigest()[:20]} in the file") for i in range(60)]
    rows += [(100 + i, f"a plain {'verylongwordwithoutend' * (1 + i % 2)} in a sentence of words {i}") for i in range(60)]
    got = secret_scan.secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert set(got[got["secret"]]["doc_id"]) == set(range(60)) and len(got) == 120


# ---- token rollups


def test_ledger(spark, tmp_path):
    ledger = token_rollup.Ledger(spark, f"file://{tmp_path}/ledger")
    change = lambda *rows: spark.createDataFrame(list(rows), "op string, source string, lang string, version string, tokens long, before long")
    ledger.commit(0, change(("insert", "a", "en", "v1", 10, None), ("insert", "a", "en", "v1", 5, None), ("insert", None, "en", "v1", 1, None)))
    ledger.commit(1, change(("revise", "a", "en", "v1", 12, 10), ("delete", "a", "en", "v1", 5, None), ("insert", "b", "de", "v2", None, None)))
    for _ in range(2):
        ledger.commit(2, change(("delete", "b", "de", "v2", 0, None)))
    ledger.commit(3, change())
    assert sorted(map(str, (tuple(r) for r in ledger.totals().collect()))) == sorted(map(str, [("a", "en", "v1", 1, 12), (None, "en", "v1", 1, 1)]))
    with pytest.raises(Exception, match="unknown change"):
        ledger.commit(4, change(("upsert", "a", "en", "v1", 1, None)))


def test_rollup_equals_a_fresh_count(spark, docs, labels):
    t = packing.byte_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    toxic = {r["doc_id"] for r in labels.filter("toxic = 1").collect()}
    want = collections.defaultdict(lambda: [0, 0])
    for r in docs.collect():
        if r["doc_id"] not in toxic:
            want[r["source"], r["lang"]][0] += 1
            want[r["source"], r["lang"]][1] += len(t(r["text"]))
    got = {(r["source"], r["lang"]): [r["documents"], r["tokens"]] for r in QUERIES["op6_token_rollup"](spark, SF).collect()}
    assert got == dict(want)


# ---- all


def test_empty_tables(spark, nothing, labels):
    none = labels.limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    results = [quality.quality(nothing, none, F.col("source"), F.col("lang")), suffix_dedup.repeated_bytes(nothing), lm_score.lm_scores(nothing), simhash.simhash_dedup(nothing), packing.pack(nothing, RANKS), secret_scan.secret_scan(nothing), decontaminate.contaminated(nothing, bench), toxicity.toxicity(nothing, none), exact_dedup.exact_dedup(nothing)]
    assert [r.count() for r in results] == [0] * len(results)


def test_pipeline_stages_keep_the_columns_and_the_clean(spark, awkward):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "decontamination", "packing"]
    now = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, SF)
        assert after.columns == awkward.columns, name
        now = after
    assert {"4", "7"}.isdisjoint(str(r["doc_id"]) for r in now.collect()) is False


def test_pipeline_equals_its_stages_by_brute_force(spark, docs, labels):
    rows = dict(texts(docs))
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, labels).collect()}
    rows = {i: t for i, t in rows.items() if not scores[i]}
    best = {}
    for i, t in rows.items():
        best[t] = max(best.get(t, -1), i)
    rows = {i: t for i, t in rows.items() if best[t] == i}
    ids = sorted(rows)
    root = brute_components([fingerprint(rows[i]) for i in ids], 4)
    least = {}
    for i, r in zip(ids, root, strict=True):
        least.setdefault(r, i)
    rows = {i: rows[i] for i in least.values()}
    bad = {r["doc_id"] for r in decontaminate.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert set(got["doc_id"]) == set(rows) - bad


def test_stages_keep_one_row_of_each_group(spark):
    schema = "doc_id long, text string, lang string"
    a, b = "one text of some words that is here again and again", "another text"
    df = spark.createDataFrame([(1, a, "x"), (1, a, "x"), (None, a, "x"), (None, b, "y"), (None, b, "y"), (2, "two", "z"), (2, "quite different", "z"), (3, None, "n"), (3, "", "n")], schema)
    left = corpus_pipeline.drop_copies(spark, df, SF)
    assert left.columns == df.columns
    want = [(1, a), (None, b), (2, "two"), (2, "quite different"), (3, "")]
    assert sorted(map(str, texts(left))) == sorted(map(str, want))
    assert sorted(map(str, texts(corpus_pipeline.drop_near_copies(spark, df, SF)))) == sorted(map(str, want))
    leak = BENCH[0][1]
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    rows = spark.createDataFrame([(1, leak, "x"), (1, "clean", "x"), (None, leak, "x"), (None, "clean too", "x")], schema)
    assert sorted(map(str, texts(decontaminate.drop_contaminated(rows, bench)))) == sorted(map(str, [(1, "clean"), (None, "clean too")]))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_says_the_same(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.sql(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    key = list(want.columns)
    assert got.sort_values(key).reset_index(drop=True).astype(str).equals(want.sort_values(key).reset_index(drop=True).astype(str))


# ---- secret scans: names, signs and values of any length


def test_values_behind_long_names_blanks_and_quotes(spark):
    rows = ["password =" + " " * 600 + "hunter2", "SECRET_" + "abcdefghijklmnopqrstuvwxyz" * 40 + "=hunter2", 'password="p@ss!w0rd#9"', "the password is hunter42x9 today", "the password is required here", "token: password=hunter2", "a.b.c." * 20_000 + "end", 'x = "" key: \'\'']
    found = secret_scan.candidates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    got: dict = {}
    for r in found.orderBy("doc_id", "ordinal").collect():
        got.setdefault(r["doc_id"], []).append(r["candidate"])
    assert got == {0: ["hunter2"], 1: ["hunter2"], 2: ["p@ss!w0rd#9"], 3: ["hunter42x9"], 5: ["hunter2"]}


def test_neighbouring_words_lie_beyond_the_sign_at_any_distance(spark):
    far = "." * 300
    row = secret_scan.candidates(spark.createDataFrame([(1, f"use it{far}  api_key = 'abcd1234efgh5678'{far}now and then")], "doc_id long, text string")).collect()
    assert [(r["candidate"], r["sign"]) for r in row] == [("abcd1234efgh5678", "api_key = '")]
    assert row[0]["before"].strip().startswith("it.") and row[0]["after"].strip().endswith("now")


def test_forest_finds_secrets_without_the_rule(spark):
    """Recall on secrets in plain words, which the rule takes for harmless, and false alarms on long words and numbers."""
    value = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    word = lambda i: "we log keep in with at the some once call number plain".split()[value(-i)[0].encode()[0] % 12]
    rows = [(i, f"{word(i)} token = \"{value(i)}\" {word(i + 7)}", "a") for i in range(120)]
    rows += [(1000 + i, f"{word(i)} {value(1000 + i)} {word(i + 7)}", "a") for i in range(20)]
    rows += [(2000 + i, f"{word(i)} {'verylongwordwithoutend' * (1 + i % 3)} {word(i + 7)}", "a") for i in range(80)]
    rows += [(3000 + i, f"{word(i)} {4000000000000000 + i * 7919} {word(i + 7)}", "a") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = secret_scan.secret_scan(docs).toPandas()
    bare = got[got["doc_id"].between(1000, 1999)]
    assert len(bare) == 20 and bare["secret"].mean() >= 0.9
    assert got[got["doc_id"] < 1000]["secret"].mean() >= 0.95 and got[got["doc_id"] >= 2000]["secret"].mean() <= 0.05
    marks = spark.createDataFrame([(i, 0, int(i < 2000)) for i, _, _ in rows if i % 2], "doc_id long, ordinal int, secret int")
    reviewed = secret_scan.secret_scan(docs, marks).toPandas()
    assert (reviewed["secret"] == (reviewed["doc_id"] < 2000)).mean() >= 0.98


def test_secret_scan_on_awkward_rows(awkward, spark):
    got = secret_scan.secret_scan(awkward).toPandas()
    assert set(got.columns) >= {"doc_id", "ordinal", "secret"} and got["secret"].notna().all()
    twice = spark.createDataFrame([(1, "token = \"abcd1234efgh5678\" x"), (1, "token = \"abcd1234efgh5678\" x"), (None, None)], "doc_id long, text string")
    assert len(secret_scan.secret_scan(twice).toPandas()) == 2
