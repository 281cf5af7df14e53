"""Document quality by hierarchical empirical Bayes.

Three layers of evidence: a classifier reads the document; a host's mean
posterior is shrunk toward the global mean; a path's toward its host's. How
hard a level is pulled is estimated from the data: kappa = m(1 - m) / tau2 - 1
with tau2 the spread of the group means beyond sampling noise, so sites with
few documents stay near their prior. A document's own posterior is left out of
its site's sums. The final score adds the site's log-odds, relative to the
global prior, to the classifier's.

Site sums are one grouped aggregation by (host, path), host sums are made from
it, and both are joined back on their keys: a host with a third of all rows is
pre-aggregated by every map task. The classifier (logistic regression in
numpy over byte and word statistics) is fitted on at most ``TRAIN_DOCS``
labelled documents of each class, those with the smallest hash of doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from snaprecon.llm._common import SpanHasher, blocks, cut, joined, runs

TRAIN_DOCS = 5000
THRESHOLD = 0.5
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_GROUPS = [
    [*range(97, 123)], [*range(65, 91)], [*range(48, 58)], [*range(128, 256)], [32, 9, 13], [10], [46], [44], [33, 63], [124], [*map(ord, "%$#&*@^~")], [*map(ord, "=<>{}[]()/\\_+")], [*map(ord, "\"':;-")],
]
_CLASS = np.zeros((256, len(_GROUPS)))
for _k, _members in enumerate(_GROUPS):
    _CLASS[_members, _k] = 1
N_FEATURES = len(_GROUPS) + 7


def text_features(texts: Iterator[str | None]) -> np.ndarray:
    """Statistics of whole texts: shares of byte classes, length, words, their length, distinct words, the commonest one, capital starts, and emptiness."""
    out = [np.zeros((0, N_FEATURES))]
    for block in blocks(texts):
        data, starts = joined(block)
        n = np.diff(starts) - 1
        rows = np.zeros((len(block), N_FEATURES))
        for k, (a, size) in enumerate(zip(starts[:-1].tolist(), n.tolist(), strict=True)):
            rows[k, : len(_GROUPS)] = np.bincount(data[a : a + size], minlength=256) @ _CLASS / max(1, size)
        first, last = runs(~_SPACE[data])
        doc = np.searchsorted(starts, first, "right") - 1
        words = np.bincount(doc, minlength=len(block))
        _, word = np.unique(SpanHasher(data).spans(first, last), return_inverse=True)
        pair, times = np.unique(doc * np.int64(len(word) + 1) + word, return_counts=True)
        owner = pair // (len(word) + 1)
        most = np.zeros(len(block))
        np.maximum.at(most, owner, times)
        per = np.maximum(1, words)
        capital = (data[first] >= 65) & (data[first] < 91)
        rows[:, -7:] = np.stack((np.log1p(n), np.log1p(words), np.bincount(doc, last - first, len(block)) / per, np.bincount(owner, minlength=len(block)) / per, most / per, np.bincount(doc, capital, len(block)) / per, words == 0), 1)
        out.append(rows)
    return np.concatenate(out)


def logit(p):
    return np.log(p) - np.log1p(-p)


class Classifier:
    """Ridge logistic regression on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 40):
        self.prior = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        self.coef = None
        if len(set(y.tolist())) < 2:
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = np.hstack(((x - self.mean) / self.scale, np.ones((len(x), 1))))
        c = np.zeros(z.shape[1])
        c[-1] = logit(self.prior)
        pull = np.full(z.shape[1], ridge * len(x))
        pull[-1] = 1e-6
        for _ in range(rounds):
            q = 1 / (1 + np.exp(-np.clip(z @ c, -30, 30)))
            step = np.linalg.solve((z * (q * (1 - q))[:, None]).T @ z + np.diag(pull), z.T @ (q - y) + pull * c * (np.arange(len(c)) < len(c) - 1))
            c -= np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-7:
                break
        self.coef = c

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of good quality, kept within 0.001 and 0.999 so that no layer is deaf to the others."""
        if self.coef is None:
            return np.full(len(x), self.prior)
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.coef[:-1] + self.coef[-1]
        return np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.001, 0.999)


def _rows(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"))


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> Classifier:
    """Fit on at most ``bound`` labelled documents of each class; an id labelled twice counts as bad if any row says so."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y"))
    picked = reduce(DataFrame.unionByName, [marks.filter(F.col("y") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound) for k in (0, 1)])

    @pandas_udf(T.ArrayType(T.DoubleType()))
    def features(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(list(text_features(texts)))

    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "y", features("text").alias("x")).toPandas()
    rows = rows.sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
    return Classifier(np.array(rows["x"].tolist()).reshape(-1, N_FEATURES), rows["y"].to_numpy(float))


def shrinkage(n: float, mean: float, groups: float, square: float, noise: float) -> float:
    """Prior strength from group moments: ``square`` the weighted squared distance of group means from their prior, ``noise`` what sampling alone gives."""
    spread = (square - noise) / max(n, 1.0)
    if groups < 2 or spread <= 0:
        return 1e6
    return float(np.clip(mean * (1 - mean) / spread - 1, 1.0, 1e6))


def quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, threshold: float = THRESHOLD, bound: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, host, path, doc_score, host_score, path_score, score, kept for every row of ``docs``.

    ``host`` and ``path`` are columns of ``docs`` (null: the empty site);
    a path belongs to its host. Null texts are empty. Repeated rows each count
    in their site. Without labels of both classes every document has the
    labelled share (or 0.5) as doc_score. An empty table gives no rows.
    """
    rows = _rows(docs, host, path)
    model = fit(rows, labels, bound)

    @pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(model.scores(text_features(texts)))

    # rounded before any sum, so sums do not depend on the order of the rows beyond the last bits
    seen = cut(rows.select("doc_id", "host", "path", F.round(scored("text"), 9).alias("p")))
    paths = cut(seen.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"), F.sum("q").alias("host_q"))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s"), F.count(F.lit(1)).alias("g")).first()
    n = float(total["n"] or 0)
    mean = float(np.clip((total["s"] or 0.0) / n, 1e-4, 1 - 1e-4)) if n else 0.5

    def moments(groups: DataFrame, size: str, total_: str, squares: str, prior: Column):
        m = F.col(total_) / F.col(size)
        return groups.agg(F.count(F.lit(1)).alias("g"), F.sum(F.col(size) * (m - prior) * (m - prior)).alias("square"), F.sum(F.greatest(F.lit(0.0), F.col(squares) / F.col(size) - m * m)).alias("noise")).first()

    of_hosts = moments(hosts, "host_n", "host_s", "host_q", F.lit(mean))
    k_host = shrinkage(n, mean, of_hosts["g"], of_hosts["square"] or 0.0, of_hosts["noise"] or 0.0)
    both = paths.join(hosts, "host")
    host_mean = (F.col("host_s") + k_host * mean) / (F.col("host_n") + k_host)
    of_paths = moments(both, "n", "s", "q", host_mean)
    k_path = shrinkage(n, mean, of_paths["g"], of_paths["square"] or 0.0, of_paths["noise"] or 0.0)

    own = F.col("p")
    host_score = (F.col("host_s") - own + k_host * mean) / (F.col("host_n") - 1 + k_host)
    joined_ = seen.join(both.select("host", "path", "n", "s", "host_n", "host_s"), ["host", "path"])
    out = joined_.withColumn("host_score", host_score).withColumn("path_score", (F.col("s") - own + k_path * F.col("host_score")) / (F.col("n") - 1 + k_path))
    odds = lambda c: F.log(c) - F.log(1 - c)
    inside = F.least(F.greatest(F.col("path_score"), F.lit(1e-4)), F.lit(1 - 1e-4))
    score = 1 / (1 + F.exp(-(odds(own) + odds(inside) - float(logit(mean)))))
    return out.select("doc_id", "host", "path", own.alias("doc_score"), F.round("host_score", 6).alias("host_score"), F.round("path_score", 6).alias("path_score"), F.round(score, 6).alias("score"), (score >= threshold).alias("kept"))
