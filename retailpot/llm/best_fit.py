"""Best-fit packing of token pieces by vector capacities.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece lengths, which bounds what attention within
documents costs). A piece is the vector (length, 1, length squared). Pieces are taken by falling length; each goes to the open sequence that
has room under every capacity and the best score: the least weighted norm of what would be left (the tightest fit), or the greatest
weighted dot product of piece and residual; no such sequence, and a new one is opened.

Texts are encoded once, in the task that reads them; from then on a piece is its place, length and checksum, a few bytes. Pieces are dealt
to groups of near equal count by a hash of their number, whatever their document or source, and each group is packed apart: a task holds
one group, and a group leaves about one sequence with room. Without limits of one's own on documents and attention (the defaults), the
token capacity alone decides what fits, and sequences are as few as best fit makes them.
"""

from __future__ import annotations

import zlib
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpot.llm.common import stored
from retailpot.llm.tokens import word_ids

TOKENS = 4096
END_OF_DOCUMENT = 1
GROUP = 8192          # pieces that are packed together
PIECES = "piece_no long, doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

PIECE_NAMES = [c.split()[0] for c in PIECES.split(", ")]


class Limits(NamedTuple):
    """Capacities of a sequence; without limits of their own, documents and attention cost reach theirs no sooner than tokens do."""

    tokens: int = TOKENS
    documents: int | None = None
    attention: int | None = None

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], np.int64)

    @property
    def piece(self) -> int:
        """Longest piece that fits an empty sequence."""
        return min(self.tokens, isqrt(self.attention or self.tokens**2))


class Rule(NamedTuple):
    """How an open sequence is chosen: ``norm`` or ``dot``, with the weights of tokens, documents and attention cost."""

    score: str = "norm"
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)


def best_fit(lengths: np.ndarray, limits: Limits = Limits(), rule: Rule = Rule()) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece. Longer pieces go first, of equal ones the earlier; ties take the older sequence."""
    room = limits.vector()
    weights = np.array(rule.weights) / room.astype(float) ** 2
    left = np.zeros((max(16, len(lengths)), 3), np.int64)   # residuals of open sequences
    name = np.zeros(len(left), np.int64)
    n_open = n_all = 0
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        need = np.array([n, 1, n * n], np.int64)
        rest = left[:n_open] - need
        fits = np.flatnonzero((rest >= 0).all(1))
        if len(fits):
            if rule.score == "norm":
                best = int(fits[np.argmin((rest[fits].astype(float) ** 2) @ weights)])
            else:
                best = int(fits[np.argmax(left[fits].astype(float) @ (weights * need))])
        else:
            best, n_open = n_open, n_open + 1
            left[best], name[best] = room, n_all
            n_all += 1
        where[k], offset[k] = name[best], room[0] - left[best, 0]
        left[best] -= need
        if left[best, 0] == 0 or left[best, 1] == 0 or left[best, 2] == 0:  # closed: later ones move up and keep their order
            left[best : n_open - 1], name[best : n_open - 1] = left[best + 1 : n_open].copy(), name[best + 1 : n_open].copy()
            n_open -= 1
    return where, offset


def pieces(docs: DataFrame, tokenizer_path: str, longest: int = TOKENS, end_id: int = END_OF_DOCUMENT) -> DataFrame:
    """``PIECES`` of ``docs`` (doc_id, text): ids and ``end_id``, cut after every ``longest`` ids; ``piece_no`` numbers them."""

    def run(batches):
        counter, number = word_ids(tokenizer_path), TaskContext.get().partitionId() << 40
        for b in batches:
            row, out = [], []
            for first, ids, n in counter.ids(b.column("text").to_pylist()):
                ids = np.insert(ids.astype("<u4"), np.cumsum(n), end_id)
                ends = np.cumsum(n + 1)
                for d, (end, size) in enumerate(zip(ends.tolist(), (n + 1).tolist(), strict=True)):
                    for p, start in enumerate(range(0, size, longest)):
                        length = min(longest, size - start)
                        at = end - size + start
                        row.append(first + d)
                        out.append((p, start, length, zlib.crc32(ids[at : at + length])))
            if out:
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(number, number + len(out))), b.column("doc_id").take(pa.array(row)), *columns], names=PIECE_NAMES)
                number += len(out)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer_path: str, limits: Limits = Limits(), rule: Rule = Rule(), end_id: int = END_OF_DOCUMENT, group: int = GROUP) -> DataFrame:
    """One row per piece (``PLACED``) of ``docs`` (doc_id, text); only documents longer than a sequence holds are cut.

    A null or empty text is its end id alone; null ids are kept, a repeated row is packed again, an empty table gives no rows, other columns
    are ignored. ``sequence_id`` is unique to a sequence, ``offset`` counts from its start without gaps.
    """
    cut = stored(pieces(docs, tokenizer_path, limits.piece, end_id), "pieces")
    n_groups = max(1, -(-cut.count() // group))

    def place(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("piece_no")
        where, offset = best_fit(table.column("length").to_numpy(), limits, rule)
        return table.select(PIECE_NAMES[1:]).append_column("sequence_id", pa.array((key[0].as_py() << 32) + where)).append_column("offset", pa.array(offset))

    return cut.groupBy(F.pmod(F.xxhash64("piece_no"), F.lit(n_groups)).alias("_group")).applyInArrow(place, PLACED)
