"""Benchmark decontamination by template windows.

Both sides are brought to templates: numbers, units and names become typed
placeholders, other words are lower-cased. A number phrase (twenty five, two
hundred and six, 3 million) is one placeholder, and so is a name of several
words. Windows of 13 template tokens (all of a shorter item) are hashed and
joined. Along one alignment, two equal names, two equal units, or two equal
numbers before the same word that lie within one window of each other must
meet the same document value; a window that holds a slot which does not is
refused, unless it is copied word for word. So a question asked again with
other values is found and a chance template match is not. Equal numbers before
different words are different quantities, and different values may become
equal. Windows of which less than half are literal words are hashed by their
values: of them only exact copies count.

A name is a capitalised word inside a sentence, which copies in another case
lose; so each side is hashed twice, with and without the name slot.

The benchmark's windows are joined in blocks of about ``BLOCK_WINDOWS``, dealt
out by item: a block is a sorted hash array of a few MB that is broadcast, so a
benchmark of any number of items is worked through without one large broadcast
and without moving any document text. One item is not split: an item of more
than ``BLOCK_WINDOWS`` words (some MB of text) makes a larger block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaprecon.llm._common import SpanHasher, blocks, cut, digest, free_name, id_and_text, joined, mix, runs

WIDTH = 13
MIN_TOKENS = 5
BLOCK_WINDOWS = 400_000
UNITS = (
    "km m cm mm mi mile miles meter meters metre metres kilometer kilometers kilometre kilometres foot feet ft inch inches yard yards "
    "kg g mg lb lbs pound pounds ounce ounces oz gram grams kilogram kilograms ton tons l ml liter liters litre litres gallon gallons "
    "s ms sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros usd eur percent degree degrees celsius fahrenheit kelvin watt watts volt volts joule joules newton newtons hz mph kmh"
).split()
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
DIGITS = "one two three four five six seven eight nine".split()
SCALES = "hundred thousand million billion".split()
LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3


def _hashes_of(words: list[str]) -> np.ndarray:
    data, starts = joined([w.encode() for w in words])
    return np.sort(SpanHasher(data).spans(starts[:-1], starts[1:] - 1))


_CLASS = np.zeros(256, np.uint8)  # 1 word byte, 2 digit, 3 joins digits, 4 ends a sentence
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2
_CLASS[[44, 46]] = 3
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SLOT = mix(np.array([0, 1, 2, 3], np.uint64) + np.uint64(77))


def _merged(t: dict[str, np.ndarray], follows: np.ndarray) -> dict[str, np.ndarray]:
    """The tokens with each that ``follows`` its neighbour made one with it; the value of several is a hash of all."""
    head = np.flatnonzero(~follows)
    if len(head) == len(follows):
        return t
    size = np.diff(np.append(head, len(follows)))
    place = (np.arange(len(follows)) - np.repeat(head, size) + 1).astype(np.uint64)
    value = np.where(size > 1, mix(np.add.reduceat(mix(t["value"] + place), head)), t["value"][head])
    out = {k: x[head] for k, x in t.items()}
    return out | {"value": value, "end": t["end"][head + size - 1], "slot": t["slot"][head + size - 1]}


def template(block: list[bytes]) -> dict[str, dict[str, np.ndarray]]:
    """Of both forms (plain, names) the tokens of the texts: text number, byte start and end (in the text), slot type, value hash, template hash."""
    data, starts = joined(block)
    kind = _CLASS[data]
    word = (kind == 1) | (kind == 2)
    digit = kind == 2
    inner = np.zeros(len(data), bool)
    inner[1:-1] = (kind[1:-1] == 3) & digit[:-2] & digit[2:]
    first, last = runs(word | inner)
    low = SpanHasher(_FOLD[data]).spans(first, last)
    slot = np.zeros(len(first), np.int8)
    slot[np.isin(low, _hashes_of(UNITS))] = UNIT
    slot[digit[first] | np.isin(low, _hashes_of(NUMBER_WORDS))] = NUMBER
    stops = np.concatenate(([0], np.cumsum((data == 46) | (data == 33) | (data == 63) | (data == 10) | (data == 58))))
    text = np.searchsorted(starts, first, "right") - 1
    inside = np.zeros(len(first), bool)
    inside[1:] = stops[first[1:]] == stops[last[:-1]]
    # only blanks or one hyphen before it
    near = np.zeros(len(first), bool)
    blanks = np.concatenate(([0], np.cumsum(data == 32)))
    gap = first[1:] - last[:-1]
    near[1:] = (blanks[first[1:]] - blanks[last[:-1]] == gap) | ((gap == 1) & (data[last[:-1]] == 45))
    near[1:] &= text[1:] == text[:-1]
    tens, ones, scale, link = (np.isin(low, _hashes_of(w)) for w in (TENS, DIGITS, SCALES, ["and"]))
    spelt = (slot == NUMBER) & ~digit[first]
    follows = np.zeros(len(first), bool)
    follows[1:] = (tens[:-1] & ones[1:]) | ((slot[:-1] == NUMBER) & scale[1:]) | (scale[:-1] & spelt[1:])
    follows &= near
    middle = np.flatnonzero(link[1:-1] & scale[:-2] & spelt[2:] & near[1:-1] & near[2:]) + 1
    follows[middle] = follows[middle + 1] = True
    named = inside & (slot == LITERAL) & (data[first] >= 65) & (data[first] < 91)
    tokens = {"text": text, "start": first - starts[text], "end": last - starts[text], "slot": slot, "value": low}
    out = {"plain": _merged(tokens, follows)}
    with_names = follows.copy()
    with_names[1:] |= named[1:] & named[:-1] & near[1:]
    out["names"] = _merged(tokens | {"slot": np.where(named, NAME, slot).astype(np.int8)}, with_names)
    for t in out.values():
        t["hash"] = np.where(t["slot"] > 0, _SLOT[t["slot"]], t["value"])
    out["plain"]["raw"] = np.bincount(text, minlength=len(block))
    # known by values: the plain tokens without their templates
    return out | {"value": out["plain"] | {"hash": out["plain"]["value"]}}


def rolling(tokens: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(max(0, len(tokens) - width + 1), np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + tokens[k : k + len(out)]
    return mix(out + np.uint64(width))


def _literals(t: dict, width: int) -> np.ndarray:
    """The literal words of every window."""
    total = np.concatenate(([0], np.cumsum(t["slot"] == LITERAL)))
    return total[width:] - total[:-width]


def _item_windows(items: list[tuple[int, bytes]], width: int, least: int) -> pd.DataFrame:
    """Every window of every item: hash, form, width, item_id, position, the item's slots and values (as bytes), whether it is poor in literals, and the windows of its form."""
    rows = []
    for item_id, raw in items:
        forms = template([raw])
        short = forms["plain"]["raw"].sum() < least
        for form, t in forms.items():
            w = min(width, len(t["hash"]))
            if not w:
                continue
            words = _literals(t, w)
            poor = 2 * words < max(w, min(least, width))
            # what is too poor in literals to be known by its template is known by its values, too
            keep = poor | short if form == "value" else ~poor | (words > 0) & ((t["slot"] == LITERAL).sum() >= 2)
            keep &= (form == "value") | (not short)
            for at in np.flatnonzero(keep).tolist():
                rows.append((int(rolling(t["hash"][at : at + w], w)[0].view(np.int64)), form, w, item_id, at, t["slot"][at : at + w].astype(np.int8).tobytes(), t["value"][at : at + w].tobytes(), bool(poor[at]), int(keep.sum())))
    return pd.DataFrame(rows, columns=["hash", "form", "width", "item_id", "position", "slots", "values", "poor", "total"])


_WINDOWS = "hash long, form string, width int, item_id long, position int, slots binary, values binary, poor boolean, total int"
_HITS = "doc_id long, item_id long, n_windows long, first_start long, last_end long, reparameterised boolean"


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH, least: int = MIN_TOKENS) -> DataFrame:
    """All windows of the benchmark items; null ones have none, short ones (fewer than ``least`` tokens) one, known by its values."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield _item_windows([(int(i), t.encode("utf-8", "surrogatepass")) for i, t in zip(f["item_id"], f["text"], strict=True)], width, least)

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id is not null and text is not null")
    return items.mapInPandas(run, _WINDOWS)


def clashes(at: np.ndarray, slots: np.ndarray, ours: np.ndarray, theirs: np.ndarray, reach: int) -> set[int]:
    """Positions of equal slots of an item (``at`` ascending) that meet different values less than ``reach`` tokens apart.

    Numbers are equal if the next token is equal too; one whose next token did
    not match is a quantity of its own.
    """
    seen: dict[tuple, list[tuple[int, int]]] = {}
    bad: set[int] = set()
    positions, values, there = at.tolist(), ours.tolist(), theirs.tolist()
    for n in np.flatnonzero(slots != LITERAL).tolist():
        key = (int(slots[n]), values[n])
        if slots[n] == NUMBER:
            if n + 1 == len(positions) or positions[n + 1] != positions[n] + 1:
                continue
            key += (values[n + 1],)
        earlier = [(p, v) for p, v in seen.get(key, ()) if positions[n] - p < reach]
        for p, v in earlier:
            if v != there[n]:
                bad |= {p, positions[n]}
        seen[key] = [*earlier, (positions[n], there[n])]
    return bad


def _scan(shared, width: int):
    """Map task: the hits of each document against one block of benchmark windows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bench = shared.value
        index = {}
        for (form, w), part in bench.groupby(["form", "width"]):
            part = part.sort_values("hash", kind="stable").reset_index(drop=True)
            keys = part["hash"].to_numpy(np.int64).view(np.uint64)
            order = np.argsort(keys, kind="stable")
            part, keys = part.iloc[order].reset_index(drop=True), keys[order]
            gate = np.zeros(1 << 20, bool)
            gate[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            index[form, int(w)] = (keys, gate, part["item_id"].tolist(), part["position"].tolist(), [np.frombuffer(s, np.int8) for s in part["slots"]], [np.frombuffer(v, np.uint64) for v in part["values"]], part["poor"].tolist(), part["total"].tolist())
        for frame in frames:
            ids, rows, at = frame["doc_id"].tolist(), [], 0
            for block in blocks(frame["text"]):
                own, at = ids[at : at + len(block)], at + len(block)
                forms = template(block)
                found: dict[tuple[int, int], dict] = {}
                for (form, w), (keys, gate, item_of, position_of, slots_of, values_of, poor_of, total_of) in index.items():
                    t = forms[form]
                    if len(t["hash"]) < w:
                        continue
                    h = rolling(t["hash"], w)
                    # a window lies in one text and, of its keys, one is found
                    maybe = np.flatnonzero(gate[(h & np.uint64((1 << 20) - 1)).astype(np.int64)] & (t["text"][: len(h)] == t["text"][w - 1 :]))
                    lo = np.searchsorted(keys, h[maybe], "left")
                    hi = np.searchsorted(keys, h[maybe], "right")
                    for p, a, b in zip(maybe[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                        for k in range(a, b):
                            aligned = found.setdefault((int(t["text"][p]), item_of[k]), {})
                            aligned.setdefault((form, p - position_of[k]), []).append((p, w, slots_of[k], values_of[k], poor_of[k], total_of[k]))
                for (n, item), aligned in found.items():
                    good, changed, spans = set(), False, []
                    for (form, _), matches in aligned.items():
                        t = forms[form]
                        same = [bool((values == t["value"][p : p + w]).all()) for p, w, _, values, _, _ in matches]
                        bad: set[int] = set()
                        if not all(same):
                            at_all = np.concatenate([np.arange(p, p + w) for p, w, *_ in matches])
                            own_at, once = np.unique(at_all, return_index=True)
                            bad = clashes(own_at, np.concatenate([m[2] for m in matches])[once], np.concatenate([m[3] for m in matches])[once], t["value"][own_at], matches[0][1])
                        # every window of the item, and no slot against another
                        whole = not bad and len({m[0] for m in matches}) == matches[0][5]
                        for (p, w, _, _, poor, _), copied in zip(matches, same, strict=True):
                            # what is copied word for word counts all the same
                            if copied or (bad.isdisjoint(range(p, p + w)) and (whole or not poor)):
                                # by its place in the text, so a window found in both forms counts once
                                good.add(int(t["start"][p]))
                                changed |= not copied
                                spans.append((int(t["start"][p]), int(t["end"][p + w - 1])))
                    if good:
                        rows.append((own[n], item, len(good), min(s for s, _ in spans), max(e for _, e in spans), changed))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "n_windows", "first_start", "last_end", "reparameterised"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, least: int = MIN_TOKENS) -> DataFrame:
    """One row per document and benchmark item found in it.

    doc_id, item_id, n_windows (matched windows), first_start and last_end
    (bytes of the text from the first to the last match), reparameterised
    (whether a slot value differs). A window with a slot that clashes (see
    :func:`clashes`) counts only as an exact copy; the others of its run stay. Documents without a match have no row.
    Null ids, null and empty texts never match; repeated documents give one
    row; an item whose windows repeat in a text counts each. Other columns are
    ignored. Either table may be empty.
    """
    return _hits(id_and_text(docs).filter("doc_id is not null and text <> ''"), benchmark, width, least)


def _hits(rows: DataFrame, benchmark: DataFrame, width: int = WIDTH, least: int = MIN_TOKENS) -> DataFrame:
    """The rows of :func:`contaminated` for ``rows`` (doc_id of any type, text)."""
    from pyspark.sql import types as T

    spark = rows.sparkSession
    schema = T.StructType.fromDDL(_HITS)
    schema["doc_id"].dataType = rows.schema["doc_id"].dataType
    windows = benchmark_windows(benchmark, width, least)
    sizes = windows.count()
    parts = max(1, -(-sizes // BLOCK_WINDOWS))
    found = []
    if sizes:
        windows = windows.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)))
        for k in range(parts):
            block = windows.filter(F.col("part") == k).drop("part").toPandas()
            if len(block):
                sent = spark.sparkContext.broadcast(block)
                found.append(cut(rows.mapInPandas(_scan(sent, width), schema)))
                sent.destroy()
    hits = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)
    return hits.groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"), F.min("first_start").alias("first_start"), F.max("last_end").alias("last_end"), F.max("reparameterised").alias("reparameterised"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; each is judged by its text, whatever its doc_id."""
    rows = docs.select(digest(docs).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter("text <> ''")
    name = free_name(docs, "__bad")
    bad = _hits(rows, benchmark).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, digest(docs) == F.col(name), "left_anti")
