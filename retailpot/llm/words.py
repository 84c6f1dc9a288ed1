"""Words of whole texts as numpy arrays: byte spans and 64-bit hashes, a bounded chunk of texts at a time.

A word is a maximal run of bytes other than space and \\x09-\\x0D. Hashes come from one running polynomial sum over the chunk,
so the hash of any byte span costs two lookups. They depend on the bytes only: equal in every task, process and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser: spreads a 64-bit sum over all bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; those for ordinary chunks are kept, longer ones belong to one very long text."""
    size = 2 * CHUNK_BYTES
    if n > size:
        return _powers(_BASE, n), _powers(_INVERSE, n)
    if size not in _TABLES:
        _TABLES[size] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _TABLES[size]


def chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, encoded texts) of about ``limit`` bytes each; a null text is empty."""
    first, size, part = 0, 0, []
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if t else b""
        if part and size + len(b) > limit:
            yield first, part
            first, size, part = i, 0, []
        part.append(b)
        size += len(b) + 1
    if part:
        yield first, part


class Words:
    """Words of the texts of one chunk, in order; ``doc`` is the text's index within the chunk."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.n_docs = len(texts)
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.doc_end = np.cumsum(sizes + 1) - 1
        self.doc_start = self.doc_end - sizes
        if lower:
            self.data = LOWER[self.data]
        blank = SPACE[self.data]
        edge = np.flatnonzero(np.diff(blank, prepend=True))  # the chunk ends with a blank, so edges come in pairs
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.doc_end, self.start, side="right")
        self.per_doc = np.bincount(self.doc, minlength=self.n_docs)
        self.first = np.concatenate(([0], np.cumsum(self.per_doc)))
        self._sums: np.ndarray | None = None

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each byte span [start, end)."""
        power, inverse = power_tables(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.empty(len(self.data) + 1, np.uint64)
            self._sums[0] = 0
            np.cumsum(BYTE_VALUES[self.data] * power[: len(self.data)], out=self._sums[1:])
        return mix((self._sums[end] - self._sums[start]) * inverse[start])

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def shingle_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of each run of ``width`` words; a text with fewer words gives its whole sequence as one; none gives nothing."""
    h, n = words.hashes() | _U(1), words.per_doc
    runs = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    doc = np.repeat(np.arange(words.n_docs), runs)
    if not len(doc):
        return doc, np.zeros(0, np.uint64)
    sums = np.full(len(h), width, np.uint64)  # from each word on, over the borders of texts: runs of whole width lie within one
    short = np.flatnonzero((n > 0) & (n < width))
    first = words.first[short]
    within = np.full(len(short), width, np.uint64)
    multiplier = 1
    for k in range(width):
        multiplier = multiplier * 0xD6E8FEB86659FD93 % (1 << 64)
        sums[: max(0, len(h) - k)] += h[k:] * _U(multiplier)
        some = n[short] > k
        within[some] += h[first[some] + k] * _U(multiplier)
    sums[first] = within
    before = np.cumsum(runs) - runs
    return doc, mix(sums[np.arange(len(doc)) + np.repeat(words.first[:-1] - before, runs)])


def distinct_per_doc(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, hash) pairs ordered by document, then hash; ``doc`` comes in ascending order."""
    h = h.copy()
    edges = [0, *(np.flatnonzero(np.diff(doc)) + 1).tolist(), len(doc)]
    for a, b in zip(edges, edges[1:]):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[keep], h[keep]
