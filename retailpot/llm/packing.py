"""Order-preserving packing of token streams into sequences of at most ``capacity`` ids.

Documents keep their stored order and lie end to end; window cuts go to document or sentence ends. A cut inside a document costs a
truncation penalty, a short sequence its padding (none where its length is a power of two, which needs no padding). The cheapest set
of cuts is found by dynamic programming: with ``f[i]`` the least cost up to cut point ``i``,
``f[i] = penalty[i] + capacity - P[i] + min(f[j] + P[j])`` over ``P[i] - P[j] <= capacity``, a sliding-window minimum that a monotone queue
gives in constant time per point. A sentence longer than the step gets extra cut points, so a window always exists.

Each task packs the rows of its own input partition as a stream, a block at a time, and carries the undecided end into the next block;
no shuffle, no group, memory bounded by a block and one document. Sequences never span tasks; what a task has left over at its end is cut
at powers of two where that saves more padding than the cuts cost, and the choice of the last cut counts that in.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpot.llm.tokens import word_ids

CAPACITY = 4096
END_OF_DOCUMENT = 2
SENTENCE_PENALTY = 8      # in ids of padding: a cut at a sentence end
FORCED_PENALTY = 32       # a cut inside a sentence
STEP = 64                 # longest run without a cut point
BLOCK = 1 << 18           # ids that are packed at once
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cut_points(doc_ends: np.ndarray, sentence_ends: np.ndarray, total: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Ordered cut positions (0 first, ``total`` last) and the penalty of each."""
    natural = np.union1d(np.concatenate(([0], doc_ends, [total])), sentence_ends)
    gap = np.diff(natural)
    extra = gap // step - (gap % step == 0)
    wide = np.flatnonzero(extra > 0)
    forced = np.concatenate([natural[i] + step * np.arange(1, extra[i] + 1) for i in wide]) if len(wide) else np.zeros(0, np.int64)
    at = np.union1d(natural, forced).astype(np.int64)
    penalty = np.full(len(at), FORCED_PENALTY, np.int64)
    penalty[np.isin(at, sentence_ends)] = SENTENCE_PENALTY
    penalty[np.isin(at, doc_ends)] = 0
    penalty[0] = penalty[-1] = 0
    return at, penalty


def best_cuts(at: np.ndarray, penalty: np.ndarray, capacity: int = CAPACITY, tail_cost=lambda length: 0) -> list[int]:
    """Positions of the cheapest cuts of a stream whose rest behind the last cut (shorter than a sequence) costs ``tail_cost``.

    Ties take the longer sequence and the later last cut.
    """
    n = len(at)
    position, cost = at.tolist(), penalty.tolist()
    total = position[-1]
    back, queue = [0] * n, deque([(0, 0)])  # (f[j] + P[j], j), smallest in front
    last, least = 0, tail_cost(total) if total < capacity else None
    for i in range(1, n):
        here = position[i]
        while here - position[queue[0][1]] > capacity:
            queue.popleft()
        best, back[i] = queue[0]
        value = cost[i] + capacity + best  # f[i] + P[i]
        while queue and queue[-1][0] > value:
            queue.pop()
        queue.append((value, i))
        if total - here < capacity and (least is None or value - here + tail_cost(total - here) <= least):
            last, least = i, value - here + tail_cost(total - here)
    cuts = []
    while last:
        cuts.append(position[last])
        last = back[last]
    return cuts[::-1]


def tail_cuts(length: int, capacity: int = CAPACITY, penalty: int = FORCED_PENALTY) -> list[int]:
    """Lengths into which the last ids of a stream are cut: powers of two, largest first, while that saves padding."""
    out: list[int] = []
    while length:
        power = 1 << (length.bit_length() - 1)
        if power == length or capacity - length <= penalty * (length.bit_count() - 1):
            return [*out, length]
        out.append(power)
        length -= power
    return out


def tail_cost(length: int, capacity: int = CAPACITY, penalty: int = FORCED_PENALTY) -> int:
    """Padding and penalties of ``tail_cuts``."""
    return min(penalty * max(0, length.bit_count() - 1), capacity - length) if length else 0


class Packer:
    """Packs a stream of documents; ``add`` and ``finish`` return finished pieces as columns."""

    def __init__(self, sequence_base: int, enders: np.ndarray, capacity: int = CAPACITY):
        self.capacity, self.enders, self.next_sequence = capacity, enders, sequence_base
        self.ids = np.zeros(0, np.uint32)
        self.docs: list[tuple[int, int, int]] = []   # (document, its ids, of those already packed) of what waits
        self.parts: list[np.ndarray] = []
        self.waiting = 0

    def add(self, doc_id: int, ids: np.ndarray) -> list[tuple]:
        self.parts.append(ids)
        self.docs.append((doc_id, len(ids), 0))
        self.waiting += len(ids)
        return self._pack(False) if self.waiting >= BLOCK else []

    def finish(self) -> list[tuple]:
        return self._pack(True) if self.waiting else []

    def _pack(self, last: bool) -> list[tuple]:
        ids = np.concatenate([self.ids, *self.parts]).astype("<u4")
        left = np.array([n - done for _, n, done in self.docs], np.int64)
        doc_ends = np.cumsum(left)
        sentence_ends = np.flatnonzero(np.isin(ids, self.enders)) + 1
        points = cut_points(doc_ends, sentence_ends, len(ids))
        if last:
            cuts = best_cuts(*points, self.capacity, lambda length: tail_cost(length, self.capacity))
            start = cuts[-1] if cuts else 0
            cuts += (start + np.cumsum(tail_cuts(len(ids) - start, self.capacity))).tolist()
        else:
            cuts = best_cuts(*points, self.capacity)  # the rest goes on with the next documents
        out = self._pieces(ids, doc_ends, cuts)
        done = cuts[-1] if cuts else 0
        first = int(np.searchsorted(doc_ends, done, side="right"))
        rest = self.docs[first:]
        if rest:
            doc, n, packed = rest[0]
            rest[0] = (doc, n, n - int(doc_ends[first] - done))
        self.docs, self.ids, self.parts, self.waiting = rest, ids[done:], [], len(ids) - done
        return out

    def _pieces(self, ids: np.ndarray, doc_ends: np.ndarray, cuts: list[int]) -> list[tuple]:
        out, begin, d = [], 0, 0
        for cut in cuts:
            at = begin
            while at < cut:
                while doc_ends[d] <= at:
                    d += 1
                doc, n, _ = self.docs[d]
                to = min(cut, int(doc_ends[d]))
                out.append((doc, n - int(doc_ends[d] - at), to - at, zlib.crc32(ids[at:to].tobytes()), n, self.next_sequence, at - begin))
                at = to
            self.next_sequence += 1
            begin = cut
        return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_OF_DOCUMENT) -> DataFrame:
    """One row per piece (``PIECES``) of ``docs`` (doc_id, text); every id of a document and its end id lies in exactly one piece.

    A null or empty text is its end id alone; a repeated row is packed again; an empty table gives no rows; other columns are ignored.
    A document longer than a sequence spans several. ``offset`` counts from the sequence's start without gaps.
    """
    names = PIECES.replace(" long", "").split(", ")

    def run(batches):
        counter = word_ids(tokenizer_path)
        marks = [counter.tokenizer.token_to_id(m + "</w>") for m in ".!?…"] + [counter.tokenizer.token_to_id(m) for m in ".!?"]
        packer = Packer(TaskContext.get().partitionId() << 40, np.array([m for m in marks if m is not None], np.uint32), capacity)
        for b in batches:
            doc_ids, out = b["doc_id"].tolist(), []
            for first, ids, n in counter.ids(b["text"].tolist()):
                for k, part in enumerate(np.split(ids, np.cumsum(n)[:-1])):
                    out += packer.add(doc_ids[first + k], np.append(part, np.uint32(end_id)))
            yield pd.DataFrame(out, columns=names)
        yield pd.DataFrame(packer.finish(), columns=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, PIECES)
