"""Sum-of-squares online packing of tokenised documents.

Each input partition is one stream with its own level array: ``open[f]`` counts
the partly filled windows that hold ``f`` tokens. A document's full windows
are cut off first; its remainder goes, as it arrives, to the fill level whose
use leaves the smallest sum of squared counts (level 0 opens a window). Only
placement is sequential, and only within a partition: no shuffle, and a task
that is run again reads the same rows in the same order and gives the same
sequences.

At most ``most_open`` windows are open in a stream, so its memory does not
depend on how well the lengths go together: with that many open, a remainder
that would open another goes to the best level it fits, and one that fits
none is cut to fill the fullest window, the rest of it placed anew.

When the stream ends, the windows that are still open are topped up from each
other by cutting, and the last one is cut into pieces whose lengths are powers
of two, which need no padding.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from snaprecon.llm._common import id_and_text

WINDOW = 1024
MOST_OPEN = 1024
END = "<|endoftext|>"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def byte_bpe(rank_file: str) -> Callable[[str], np.ndarray]:
    """Encoder for a byte-level BPE rank file; ``END`` in a text is the special token after the last rank, as it is to `tokenizers`."""
    import public_tokenizers
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    coder = tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END: max(ranks.values()) + 1})
    return lambda text: np.array(coder.encode(text, allowed_special="all"), np.uint32)


class Packer:
    """One stream: ``add`` documents, then ``close``; both give finished pieces.

    A piece is (doc_id, start, ids, doc_tokens); a finished piece also has its
    sequence number within the stream and its offset there.
    """

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN):
        if most_open < 1:
            raise ValueError("at least one window must be allowed to be open")
        self.window, self.most_open, self.open = window, most_open, 0
        self.counts = np.zeros(window + 1, np.int64)
        self.levels: dict[int, list[list[tuple]]] = {}
        self.sequence = 0

    def _finish(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for piece in pieces:
            yield (*piece, self.sequence, offset)
            offset += len(piece[2])
        self.sequence += 1

    def level(self, length: int) -> int:
        """The fill level for a piece: least growth of the sum of squares, the fuller level on a tie; -1: it fits no window and none may be opened."""
        room = self.window - length
        counts = self.counts
        growth = np.full(room + 1, np.iinfo(np.int64).max)
        used = counts[: room + 1] > 0
        growth[used] = 2 - 2 * counts[: room + 1][used] + 2 * counts[length : self.window + 1][used]
        if self.open < self.most_open:
            growth[0] = 1 + 2 * counts[length]
        if used[room]:
            growth[room] = 1 - 2 * counts[room]  # the window is full and leaves the array
        best = growth.min()
        return int(np.flatnonzero(growth == best)[-1]) if best < np.iinfo(np.int64).max else -1

    def _take(self, fill: int) -> list[tuple]:
        """The pieces of an open window of that level, which leaves the array."""
        self.counts[fill] -= 1
        self.open -= 1
        return self.levels[fill].pop()

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        total, whole = len(ids), len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            yield from self._finish([(doc_id, start, ids[start : start + self.window], total)])
        rest = ids[whole:].copy()
        while len(rest) and (fill := self.level(len(rest))) < 0:
            fullest = int(np.flatnonzero(self.counts)[-1])
            room = self.window - fullest
            yield from self._finish([*self._take(fullest), (doc_id, total - len(rest), rest[:room], total)])
            rest = rest[room:]
        if not len(rest):
            return
        pieces = self._take(fill) if fill else []
        pieces.append((doc_id, total - len(rest), rest, total))
        fill += len(rest)
        if fill == self.window:
            yield from self._finish(pieces)
        else:
            self.levels.setdefault(fill, []).append(pieces)
            self.counts[fill] += 1
            self.open += 1

    def close(self) -> Iterator[tuple]:
        """Finish the open windows: the fullest are topped up with the pieces of the emptiest."""
        still = [w for fill in sorted(self.levels, reverse=True) for w in self.levels[fill]]
        stream = [p for w in still for p in w]
        left = sum(len(p[2]) for p in stream)
        room, now = self._next_size(left), []
        for doc_id, start, ids, total in stream:
            while len(ids):
                take = min(room, len(ids))
                now.append((doc_id, start, ids[:take], total))
                start, ids, room, left = start + take, ids[take:], room - take, left - take
                if not room:
                    yield from self._finish(now)
                    room, now = self._next_size(left), []
        self.levels, self.counts, self.open = {}, np.zeros(self.window + 1, np.int64), 0

    def _next_size(self, left: int) -> int:
        return self.window if left >= self.window else 1 << (left.bit_length() - 1) if left else 0


def pack(docs: DataFrame, rank_file: str, window: int = WINDOW, most_open: int = MOST_OPEN) -> DataFrame:
    """One row per piece of every document's ids (its tokens, then id 0).

    doc_id, start, length, ids_crc32 (unsigned CRC-32 of the ids as
    little-endian unsigned 32-bit), doc_tokens, sequence_id (unique over all
    partitions) and offset (gapless from 0 in each sequence). A null or empty
    text is the one id 0. Rows repeated with one doc_id and null doc_ids are
    packed each for itself; other columns are ignored; an empty table gives
    no rows. A task holds ``most_open`` windows of ids, a batch of texts and
    what one text is cut into.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, packer = byte_bpe(rank_file), Packer(window, most_open)
        base = TaskContext.get().partitionId() << 40

        def table(rows: list[tuple]) -> pd.DataFrame:
            done = [(d, s, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, base + q, o) for d, s, ids, n, q, o in rows]
            out = pd.DataFrame(done, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            return out.astype({"doc_id": "Int64"})

        for frame in frames:
            rows: list[tuple] = []
            known = frame["doc_id"].notna()
            ids = frame["doc_id"].astype("Int64").fillna(0)
            for doc_id, has, text in zip(ids.tolist(), known.tolist(), frame["text"], strict=True):
                rows += packer.add(doc_id if has else None, np.append(encode(text), np.uint32(0)))
                if len(rows) >= 20_000:
                    yield table(rows)
                    rows = []
            if rows:
                yield table(rows)
        if rows := list(packer.close()):
            yield table(rows)

    return id_and_text(docs).mapInPandas(run, PIECES)
