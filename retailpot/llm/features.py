"""Hashed word and character n-gram features of whole texts, and linear scores over them.

A text's features are, for every word: the word itself, its character n-grams (3 to 5 code points of ``<word>``), and one shared
feature where the word repeats the word before it (a word pair with its own content left out). A score that is linear in the averaged
features is the sum of its words' scores over the sum of their feature counts, so each distinct word is cut into n-grams once and then
looked up. The table of known words is bounded; when full it starts anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

from retailpot.llm.words import Words, chunks, mix

N_GRAMS = (3, 4, 5)
BUCKET_BITS = 18
MAX_WORDS = 1_000_000
_U = np.uint64


def _buckets(h: np.ndarray, kind: int, bits: int) -> np.ndarray:
    return (mix(h + _U(kind)) >> _U(64 - bits)).astype(np.int64)


def word_features(words: list[bytes], bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(word's index, bucket) of every feature of the words, n-grams in byte spans that begin and end at code points."""
    part = Words([b" ".join([b"<" + w + b">" for w in words])])
    first = np.flatnonzero((part.data & 0xC0) != 0x80)
    first = first[~np.isin(part.data[first], (10, 32))]
    owner = np.searchsorted(part.start, first, side="right") - 1
    index, bucket = [np.arange(len(words))], [_buckets(part.hashes(), 0, bits)]
    last = np.searchsorted(first, part.end)  # code points before each word's end
    for n in N_GRAMS:
        at = np.flatnonzero(np.arange(len(first)) + n <= last[owner])
        end = np.where(at + n < last[owner[at]], first[np.minimum(at + n, len(first) - 1)], part.end[owner[at]])
        index.append(owner[at])
        bucket.append(_buckets(part.span_hash(first[at], end), n, bits))
    return np.concatenate(index), np.concatenate(bucket)


REPEAT = 1  # bucket of the shared feature


def document_features(texts: list, bits: int = BUCKET_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of each text, buckets distinct."""
    for _, part in chunks(texts):
        w = Words(part)
        distinct, first, inverse = np.unique(w.hashes(), return_index=True, return_inverse=True)
        owner, bucket = word_features([w.word(i) for i in first], bits) if len(first) else (np.zeros(0, np.int64),) * 2
        order = np.argsort(owner, kind="stable")
        owner, bucket = owner[order], bucket[order]
        begin = np.searchsorted(owner, np.arange(len(distinct) + 1))
        for d in range(len(part)):
            mine = inverse[w.first[d] : w.first[d + 1]]
            ids, n = np.unique(mine, return_counts=True)
            size = begin[ids + 1] - begin[ids]
            at = np.repeat(begin[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            repeats = int((mine[1:] == mine[:-1]).sum())
            found, inv = np.unique(np.concatenate((bucket[at], [REPEAT] * (repeats > 0))).astype(np.int64), return_inverse=True)
            yield found, np.bincount(inv, np.concatenate((np.repeat(n, size), [repeats] * (repeats > 0))), len(found))


class LinearScorer:
    """Mean feature weight of each text (0 for a text without words)."""

    def __init__(self, weights: np.ndarray, max_words: int = MAX_WORDS):
        self.weights, self.max_words = weights, max_words
        self.bits = len(weights).bit_length() - 1
        self._clear()

    def _clear(self) -> None:
        self.keys, self.sums, self.sizes = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)

    def _lookup(self, w: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > self.max_words:
            self._clear()
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if not known.all():
            new = ~known
            owner, bucket = word_features([w.word(i) for i in first[new]], self.bits)
            n = int(new.sum())
            self.keys = np.insert(self.keys, at[new], distinct[new])
            self.sums = np.insert(self.sums, at[new], np.bincount(owner, self.weights[bucket], n))
            self.sizes = np.insert(self.sizes, at[new], np.bincount(owner, minlength=n))
            at = np.searchsorted(self.keys, distinct)
        return self.sums[at][inverse], self.sizes[at][inverse]

    def __call__(self, texts: list) -> np.ndarray:
        out = np.zeros(len(texts))
        for first, part in chunks(texts):
            out[first : first + len(part)] = self.score(Words(part))
        return out

    def score(self, w: Words) -> np.ndarray:
        if not len(w.start):
            return np.zeros(w.n_docs)
        h = w.hashes()
        sums, sizes = self._lookup(w, h)
        repeat = np.zeros(len(h))
        repeat[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
        total = np.bincount(w.doc, sums + repeat * self.weights[REPEAT], w.n_docs)
        return total / np.maximum(np.bincount(w.doc, sizes + repeat, w.n_docs), 1)


_SCORERS: dict[int, LinearScorer] = {}


def worker_scorer(weights: np.ndarray) -> LinearScorer:
    """One scorer per Python worker and weights, so that known words outlive a task; the last few are kept."""
    key = zlib.crc32(weights.tobytes())
    if key not in _SCORERS:
        if len(_SCORERS) >= 2:
            _SCORERS.clear()
        _SCORERS[key] = LinearScorer(weights, MAX_WORDS // 2)
    return _SCORERS[key]
