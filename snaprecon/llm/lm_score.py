"""Stupid-backoff language-model scores of documents under the corpus itself.

Words are runs without ASCII white space, lower-cased. The tables hold the
counts of all 1-, 2- and 3-grams of the corpus (and, as the 0-gram, of its
words), partitioned by n-gram hash. A document's n-grams are joined to them
and its log scores summed:

    S(w | u v) = c(u v w) / c(u v)            if c(u v w) > 0
                 0.4 * c(v w) / c(v)          else if c(v w) > 0
                 0.16 * c(w) / N              else if c(w) > 0
                 0.16 * 0.5 / N               else

All counts leave out the document that is scored, or no n-gram would ever be
unseen. Tables and join travel as sorted runs per block of documents
(:mod:`snaprecon.llm._merge`): an n-gram costs a few bytes per block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaprecon.llm._common import SpanHasher, id_and_text, joined, mix, runs
from snaprecon.llm._merge import Block, check_answers, exchange

ALPHA = 0.4
UNSEEN = 0.5
BLOCK = 3 << 20
#: An n-gram is known by 56 bits of its hash: at 10**12 distinct n-grams one in 70,000 meets another.
_KEPT = np.uint64(0xFFFFFFFFFFFFFF00)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ROOT = mix(np.array([0x5B0F], np.uint64))[0]


def _words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the block and the number of its document."""
    data, starts = joined([t.decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass") for t in block.texts])
    first, last = runs(~_SPACE[data])
    return SpanHasher(data).spans(first, last), np.searchsorted(starts, first, "right") - 1


def _grams(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes of all n-grams: the 0-gram of each word, then orders 1 to 3; and the positions at which each order starts an n-gram within a document."""
    at = [np.arange(len(words))]
    hashes = [np.full(len(words), _ROOT), mix(words + np.uint64(1))]
    for order in (2, 3):
        n = max(0, len(words) - order + 1)
        inside = np.flatnonzero(doc[:n] == doc[order - 1 :][:n])
        h = words[inside]
        for k in range(1, order):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[inside + k])
        hashes.append(h + np.uint64(order))
        at.append(inside)
    return [h & _KEPT for h in hashes], at


def _run(block: Block) -> tuple[np.ndarray, np.ndarray]:
    hashes, _ = _grams(*_words(block))
    values, counts = np.unique(np.concatenate(hashes), return_counts=True)
    return values[None, :], counts


def _answer(runs: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    values = np.concatenate([r[0] for r in runs])
    _, entry = np.unique(values, return_inverse=True)
    total = np.bincount(entry, np.concatenate(counts)).astype(np.int64)[entry]
    return np.split(total, np.cumsum([r.shape[1] for r in runs])[:-1])


def _finish(block: Block, totals: np.ndarray) -> pd.DataFrame:
    words, doc = _words(block)
    hashes, at = _grams(words, doc)
    flat = np.concatenate(hashes)
    values, entry = np.unique(flat, return_inverse=True)
    check_answers(len(values), totals)
    owner = np.concatenate([doc, doc, *(doc[a] for a in at[1:])])
    _, pair, own = np.unique(owner * np.int64(len(values) + 1) + entry, return_inverse=True, return_counts=True)
    others = totals[entry] - own[pair]  # counts without the document's own
    n = len(words)
    whole, one = others[:n], others[n : 2 * n]
    two, three = np.zeros(n, np.int64), np.zeros(n, np.int64)
    two[at[1] + 1] = others[2 * n : 2 * n + len(at[1])]
    three[at[2] + 2] = others[2 * n + len(at[1]) :]
    before_one, before_two = np.roll(one, 1), np.roll(two, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        low = ALPHA * ALPHA * np.where(one > 0, one, UNSEEN) / np.maximum(whole, 1)
        mid = np.where(two > 0, ALPHA * two / before_one, low)
        score = np.where(three > 0, three / before_two, mid)
    size = np.bincount(doc, minlength=len(block.ids))
    total = np.bincount(doc, np.log(score), len(block.ids))
    seen = [np.bincount(doc, x, len(block.ids)).astype(np.int64) for x in (three > 0, (three == 0) & (two > 0), (three == 0) & (two == 0) & (one > 0))]
    return pd.DataFrame({"doc_id": pd.array(block.ids, "Int64"), "n_words": size, "log_score": np.round(total, 6), "mean_log_score": np.where(size > 0, np.round(total / np.maximum(size, 1), 6), 0.0), "n_trigram": seen[0], "n_bigram": seen[1], "n_unigram": seen[2]})


SCHEMA = "doc_id long, n_words long, log_score double, mean_log_score double, n_trigram long, n_bigram long, n_unigram long"


def lm_scores(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: words, summed and mean log score, and at how many words each order gave the score.

    A null or blank text has no word and scores 0. Repeated rows count as
    documents of their own; null ids are scored too; other columns are
    ignored; an empty table gives no rows. ``docs`` is read twice and must
    give its rows in the same order both times, as files do.
    """
    return exchange(id_and_text(docs).withColumn("extra", F.lit(None).cast("binary")), _run, _answer, _finish, SCHEMA, BLOCK)
