"""Toxicity scores from a bidirectional GRU with attention pooling, trained in numpy.

A text is lower-cased and cut at white space; a step of the network is a word.
Its inputs are the evidence (how much oftener toxic training texts hold it
than others, beyond chance) of the word and of its prefixes of 4 to 8
bytes, and the mean of learned embeddings of its character 4-grams. Windows of ``STEPS`` words overlap by a third; every window of every
text is scored. A forward and a backward GRU run over the window, attention
weights pool their states, and a linear layer gives the window's logit.

Only document labels exist, so the window model learns from windows under
their document's label: windows like those of harmless documents settle low,
windows seen only in toxic ones high. A second, logistic stage turns the
largest three and the mean window logit, the number of windows that look toxic
and the number of windows into the document's score.

Training reads at most ``TRAIN_DOCS`` labelled documents of each class (those
with the smallest hash of doc_id; the bound is a parameter), each whole: the
evidence is counted over all its words, and all its windows are learned from.
Scoring covers all windows of all texts. Only the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from snaprecon.llm._common import SpanHasher, blocks, cut, id_and_text, joined, runs

STEPS, STRIDE = 24, 16
HIDDEN, CHARS = 8, 4
SLOTS = {"word": 1 << 15, "prefix": 1 << 15, "gram": 1 << 13}
PREFIXES = (4, 5, 6, 7, 8)
GRAM = 4
WIDTH = 1 + len(PREFIXES) + CHARS
TRAIN_DOCS, EPOCHS, BATCH, CHUNK = 2500, 5, 256, 2048
CHANCE, STEPS_LEAST = 4.0, 300
THRESHOLD = 0.7
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """The words of a block of texts: distinct words, their features, and each text's word numbers."""

    def __init__(self, block: list[bytes]):
        data, starts = joined([b.decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass") for b in block])
        first, last = runs(~_SPACE[data])
        hasher = SpanHasher(data)
        _, where, self.number = np.unique(hasher.spans(first, last), return_index=True, return_inverse=True)
        a, b = first[where], last[where]
        bounds = np.searchsorted(first, starts)
        self.first, self.count = bounds[:-1], np.diff(bounds)
        self.word = (hasher.spans(a, b) % np.uint64(SLOTS["word"])).astype(np.int64)
        self.prefix = np.stack([(hasher.spans(a, np.minimum(a + k, b)) % np.uint64(SLOTS["prefix"])).astype(np.int64) for k in PREFIXES], 1)
        n = np.maximum(1, b - a - GRAM + 1)
        self.gram_start = np.concatenate(([0], np.cumsum(n)))
        at = np.arange(self.gram_start[-1]) - np.repeat(self.gram_start[:-1] - a, n)
        self.gram = (hasher.spans(at, np.minimum(at + GRAM, np.repeat(b, n))) % np.uint64(SLOTS["gram"])).astype(np.int64)

    def sizes(self) -> np.ndarray:
        """The number of windows of each text."""
        return np.where(self.count > 0, 1 + np.maximum(0, -(-(self.count - STEPS) // STRIDE)), 0)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct-word numbers (-1: past the end) of each window, and its text."""
        per = self.sizes()
        text = np.repeat(np.arange(len(per)), per)
        k = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
        at = (k * STRIDE)[:, None] + np.arange(STEPS)
        inside = at < self.count[text][:, None]
        numbers = np.where(inside, self.number[np.minimum(self.first[text][:, None] + at, max(0, len(self.number) - 1))] if len(self.number) else 0, -1)
        return numbers, text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """The window model's weights, its forward pass and its training."""

    def __init__(self, seed: int = 7, weights: dict[str, np.ndarray] | None = None):
        if weights is not None:
            self.p = weights
            return
        rng = np.random.default_rng(seed)
        w = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        self.p = {"word": np.zeros(SLOTS["word"], np.float32), "prefix": np.zeros(SLOTS["prefix"], np.float32), "gram": w(SLOTS["gram"], CHARS, s=0.1)}
        for d in "fb":
            self.p |= {f"x{d}": w(WIDTH, 3 * HIDDEN, s=0.4), f"u{d}": w(HIDDEN, 3 * HIDDEN, s=0.3), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"att": w(2 * HIDDEN, s=0.3), "out": w(2 * HIDDEN, s=0.3), "bias": np.zeros(1, np.float32)}

    def embed(self, f: Words) -> np.ndarray:
        """Input of each distinct word."""
        grams = np.add.reduceat(self.p["gram"][f.gram], f.gram_start[:-1], axis=0) if len(f.word) else np.zeros((0, CHARS), np.float32)
        grams /= np.diff(f.gram_start)[:, None].astype(np.float32)
        return np.hstack((self.p["word"][f.word][:, None], self.p["prefix"][f.prefix], grams))

    def logits(self, f: Words, windows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """The logit of each window; ``keep`` collects what the backward pass needs."""
        p, n = self.p, len(windows)
        x = self.embed(f)
        mask = windows >= 0
        states = np.zeros((n, STEPS, 2 * HIDDEN), np.float32)
        saved: dict[str, list] = {"f": [], "b": []}
        for d, side, order in (("f", 0, range(STEPS)), ("b", HIDDEN, range(STEPS - 1, -1, -1))):
            table = np.concatenate((x @ p[f"x{d}"] + p[f"c{d}"], np.zeros((1, 3 * HIDDEN), np.float32)))
            h, u = np.zeros((n, HIDDEN), np.float32), p[f"u{d}"]
            for t in order:
                inputs, rec = table[windows[:, t]], h @ u
                gates = _sigmoid(inputs[:, : 2 * HIDDEN] + rec[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(inputs[:, 2 * HIDDEN :] + r * rec[:, 2 * HIDDEN :])
                m = mask[:, t, None]
                nxt = np.where(m, new + z * (h - new), h)
                if keep is not None:
                    saved[d].append((t, h, z, r, new, rec[:, 2 * HIDDEN :], m))
                h = nxt
                states[:, t, side : side + HIDDEN] = h
        score = np.where(mask, states @ p["att"], -1e9)
        weight = np.exp(score - score.max(1, keepdims=True))
        weight /= weight.sum(1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", weight, states)
        if keep is not None:
            keep |= {"x": x, "mask": mask, "states": states, "weight": weight, "pooled": pooled, "saved": saved}
        return pooled @ p["out"] + p["bias"][0]

    def gradient(self, f: Words, windows: np.ndarray, grad: np.ndarray, keep: dict) -> dict[str, np.ndarray]:
        """Gradients of all weights given that of the logits."""
        p, n = self.p, len(windows)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"], g["bias"][0] = keep["pooled"].T @ grad, grad.sum()
        dpool = grad[:, None] * p["out"]
        dweight = np.einsum("nth,nh->nt", keep["states"], dpool)
        dscore = keep["weight"] * (dweight - (keep["weight"] * dweight).sum(1, keepdims=True))
        g["att"] = np.einsum("nt,nth->h", dscore, keep["states"])
        dstates = keep["weight"][:, :, None] * dpool[:, None, :] + dscore[:, :, None] * p["att"]
        dx = np.zeros((len(f.word) + 1, WIDTH), np.float32)
        for d, side in (("f", 0), ("b", HIDDEN)):
            dh = np.zeros((n, HIDDEN), np.float32)
            for t, h, z, r, new, rec, m in reversed(keep["saved"][d]):
                dh = dh + dstates[:, t, side : side + HIDDEN]
                live = np.where(m, dh, 0)
                dz, dnew = live * (h - new) * z * (1 - z), live * (1 - z) * (1 - new * new)
                dr = dnew * rec * r * (1 - r)
                drec = np.concatenate((dz, dr, dnew * r), 1)
                dins = np.concatenate((dz, dr, dnew), 1)
                g[f"u{d}"] += h.T @ drec
                g[f"c{d}"] += dins.sum(0)
                at = windows[:, t]
                g[f"x{d}"] += np.concatenate((keep["x"], np.zeros((1, WIDTH), np.float32)))[at].T @ dins
                np.add.at(dx, at, dins @ p[f"x{d}"].T)
                dh = np.where(m, live * z, dh) + np.where(m, drec @ p[f"u{d}"].T, 0)
        share = dx[:-1, WIDTH - CHARS :] / np.diff(f.gram_start)[:, None].astype(np.float32)
        np.add.at(g["gram"], f.gram, np.repeat(share, np.diff(f.gram_start), axis=0))
        return g

    def weigh(self, seen: dict[str, np.ndarray], total: np.ndarray) -> None:
        """Set the evidence tables: the signed root of the likelihood ratio of a word or prefix being as frequent in toxic texts as in others, beyond CHANCE.

        ``seen`` counts by class the texts that hold each, ``total`` all texts.
        """
        for k, (clean, toxic) in seen.items():
            there, size = np.stack((clean, toxic)), clean + toxic
            usual = total[:, None] * size / total.sum()
            gain = there * np.log(np.maximum(there, 1e-9) / np.maximum(usual, 1e-9))
            gain += (total[:, None] - there) * np.log(np.maximum(total[:, None] - there, 1e-9) / np.maximum(total[:, None] - usual, 1e-9))
            z = np.sign(toxic - usual[1]) * np.sqrt(np.maximum(0, 2 * gain.sum(0)))
            self.p[k] = (np.sign(z) * np.clip(np.abs(z) - CHANCE, 0, 12) / 4).astype(np.float32)

    def fit(self, texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, decay: float = 0.1, seed: int = 7) -> None:
        """Adam on the texts' windows (weight decay on the character embeddings), the two classes weighing the same.

        A toxic text's windows count by how toxic they look beside its most
        toxic one (all alike in the first fifth of the steps), so what is
        harmless in it is not learned as toxic. A step takes whole texts, of
        BATCH windows together. Few texts are read more often, for STEPS_LEAST
        steps in all. The evidence tables are to be set before.
        """
        rng = np.random.default_rng(seed)
        sizes = np.concatenate([np.zeros(0, np.int64), *(Words(b).sizes() for b in blocks(texts, 1 << 20))])
        learned = {k: x for k, x in self.p.items() if k not in ("word", "prefix")}
        m = {k: np.zeros_like(x) for k, x in learned.items()}
        v = {k: np.zeros_like(x) for k, x in learned.items()}
        many = np.bincount(labels, sizes, 2)
        weight = (0.5 / np.maximum(1, many))[labels] * sizes.sum()
        step, batches = 0, max(1, int(sizes.sum()) // BATCH)
        epochs = max(epochs, -(-STEPS_LEAST // batches))
        for epoch in range(epochs):
            order = rng.permutation(np.flatnonzero(sizes))
            turn = (np.cumsum(sizes[order]) - sizes[order]) // BATCH
            for pick in np.split(order, np.flatnonzero(np.diff(turn)) + 1):
                f = Words([texts[i].encode("utf-8", "surrogatepass") for i in pick])
                windows, text = f.windows()
                if not len(windows):
                    continue
                y, w, keep = labels[pick][text], weight[pick][text], {}
                # the windows of long texts pass in chunks, a second time for the gradient
                parts = [slice(a, a + CHUNK) for a in range(0, len(windows), CHUNK)]
                chance = _sigmoid(np.concatenate([self.logits(f, windows[c], keep if len(parts) == 1 else None) for c in parts]))
                if 5 * epoch >= epochs:
                    top = np.zeros(len(pick))
                    np.maximum.at(top, text, chance)
                    w = np.where(y == 1, w * chance / np.maximum(top[text], 1e-6), w)
                grad = ((chance - y) * w / len(windows)).astype(np.float32)
                grads: dict[str, np.ndarray] = {}
                for c in parts:
                    if len(parts) > 1:
                        self.logits(f, windows[c], keep)
                    for k, x in self.gradient(f, windows[c], grad[c], keep).items():
                        grads[k] = grads[k] + x if k in grads else x
                step += 1
                for k, x in learned.items():
                    m[k] += 0.1 * (grads[k] - m[k])
                    v[k] += 0.001 * (grads[k] ** 2 - v[k])
                    x -= rate * ((m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8) + decay * x * (k == "gram"))


def window_features(net: Network, texts: Iterator[str | None]) -> np.ndarray:
    """Of each text: the three largest window logits (the last repeated if there are fewer), the mean, ln(1 + windows over 0), ln(1 + windows); no window gives zeros."""
    out = [np.zeros((0, 6))]
    for block in blocks(texts, 1 << 20):
        f = Words(block)
        windows, text = f.windows()
        got = np.concatenate([net.logits(f, windows[a : a + 8192]) for a in range(0, len(windows), 8192)]) if len(windows) else np.zeros(0)
        n = np.bincount(text, minlength=len(block))
        feats = np.zeros((len(block), 6))
        order, ends, some = np.lexsort((got, text)), np.cumsum(n), n > 0
        for k in range(3):
            feats[some, k] = got[order[ends[some] - 1 - np.minimum(k, n[some] - 1)]]
        feats[:, 3] = np.bincount(text, got, len(block)) / np.maximum(1, n)
        feats[:, 4] = np.log1p(np.bincount(text, got > 0, len(block)))
        feats[:, 5] = np.log1p(n)
        out.append(feats)
    return np.concatenate(out)


class Model:
    """Window network and document stage."""

    def __init__(self, net: Network, coef: np.ndarray | None):
        self.net, self.coef = net, coef

    def scores(self, feats: np.ndarray) -> np.ndarray:
        if self.coef is None:
            return np.zeros(len(feats))
        got = _sigmoid(feats @ self.coef[:-1] + self.coef[-1])
        return np.where(feats[:, 5] > 0, got, 0.0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last coefficient is the intercept."""
    x = np.hstack((x, np.ones((len(x), 1))))
    c = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6]) * len(x)
    for _ in range(rounds):
        q = _sigmoid(x @ c)
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + penalty, x.T @ (q - y) + penalty @ c)
        c -= step
        if np.abs(step).max() < 1e-8:
            break
    return c


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> Model:
    """Fit on at most ``bound`` labelled documents of each class.

    Label rows with a null id or label are ignored; an id labelled twice counts
    as toxic if any row says so. Without both classes every score is 0.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = reduce(DataFrame.unionByName, [marks.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound) for k in (0, 1)])
    # one row per id: repeated documents train once
    sample = cut(id_and_text(docs).join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")))
    many = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    net = Network()
    if len(many) < 2:
        return Model(net, None)
    net.weigh(evidence(sample), np.array([many[0], many[1]], float))
    net = Network(weights=_fitted(sample, net.p))
    feats = sample.select("doc_id", "toxic", _features(net)("text").alias("f")).toPandas().sort_values("doc_id")
    x, y = np.array(feats["f"].tolist()), feats["toxic"].to_numpy(np.int64)
    return Model(net, logistic(x, y))


def _fitted(sample: DataFrame, start: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The weights after training on ``sample`` (bounded), in one task, so that the texts never reach the driver."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values("doc_id")
        net = Network(weights=start)
        net.fit(rows["text"].tolist(), rows["toxic"].to_numpy(np.int64))
        yield pd.DataFrame({"name": list(net.p), "weights": [w.tobytes() for w in net.p.values()]})

    found = sample.coalesce(1).mapInPandas(run, "name string, weights binary").collect()
    return {r["name"]: np.frombuffer(r["weights"], np.float32).reshape(start[r["name"]].shape) for r in found}


def evidence(sample: DataFrame) -> dict[str, np.ndarray]:
    """By class, the number of texts that hold each word or prefix (by slot), counted over the whole texts of ``sample`` (toxic, text)."""

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text, label in zip(frame["text"], frame["toxic"], strict=True):
                f = Words([text.encode("utf-8", "surrogatepass")])
                for k in ("word", "prefix"):
                    yield pd.DataFrame({"toxic": label, "kind": k, "slot": np.unique(getattr(f, k))})

    counts = sample.select("toxic", "text").mapInPandas(held, "toxic int, kind string, slot int").groupBy("toxic", "kind", "slot").agg(F.count(F.lit(1)).alias("n")).toPandas()
    seen = {k: np.zeros((2, SLOTS[k])) for k in ("word", "prefix")}
    for k, part in counts.groupby("kind"):
        seen[k][part["toxic"], part["slot"]] = part["n"]
    return seen


def _features(net: Network):
    @pandas_udf(T.ArrayType(T.DoubleType()))
    def features(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(list(window_features(net, texts)))

    return features


def score_column(docs: DataFrame, model: Model):
    """A function of a text column: the score, 0 for texts without a word (null and empty ones too)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.net.p, model.coef))  # a few MB, whatever the input

    @pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net, coef = Network(weights=shared.value[0]), shared.value[1]
        for texts in parts:
            yield pd.Series(Model(net, coef).scores(window_features(net, texts)))

    return score


def learnable(frame: DataFrame) -> DataFrame:
    """Rows whose doc_id is not held out."""
    return frame.filter(~held_out("doc_id"))


def held_out(column: str):
    """Whether crc32 of the id as text leaves 1 modulo 3 (false for a null id)."""
    return F.coalesce(F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Labels of held-out ids are not read. Null ids are scored like others;
    repeated rows are scored each; other columns are ignored. An empty table
    gives no rows; without labels of both classes all scores are 0.
    """
    model = train(docs, learnable(labels))
    score = score_column(docs, model)
    rows = id_and_text(docs).select("doc_id", held_out("doc_id").alias("held_out"), score("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; the columns stay as they are."""
    score = score_column(docs, train(docs, learnable(labels)))
    return docs.filter(score(F.coalesce(docs["text"].cast("string"), F.lit(""))) < threshold)
