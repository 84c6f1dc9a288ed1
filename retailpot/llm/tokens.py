"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library, encoded once per distinct word.

Splitting at blanks is safe for a tokenizer whose pre-tokenizer never joins text across white space and drops it
(``splits_at_blanks``); each distinct blank-separated word is then encoded once by the library and looked up after that.
Other tokenizers get whole texts. The table of known words is bounded; when full it starts anew, which costs time, never results.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np

from retailpot.llm.words import Words, chunks

MAX_WORDS = 1_000_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def splits_at_blanks(spec: dict) -> bool:
    """True where white space ends every pre-token and no token holds any: an inverted split pattern without blanks."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = steps[0] if steps else {}
    pattern = first.get("pattern", {}).get("Regex", "")
    norms = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    return (first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed" and "\\s\\p{L}\\p{N}]+" in pattern
            and set(norms) <= {"NFC", "Replace", "Lowercase"} and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]))


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)  # ASCII punctuation but the apostrophe, which may begin a contraction
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_MARK[39] = False


def pieces(part: list[bytes]) -> Words:
    """Words of a chunk in lower case, cut once more where a Latin letter is followed by an ASCII mark: pre-tokens end there in any case.

    Where a text may hold a special token, words stay as they are.
    """
    if any(b"<|" in b for b in part):
        return Words(part)
    w = Words(part, lower=True)
    d = w.data
    latin = np.zeros(len(d), bool)  # last byte of a letter of the Latin-1 block
    latin[1:] = (d[:-1] == 0xC3) & (d[1:] != 0x97) & (d[1:] != 0xB7)
    cut = np.flatnonzero((_LETTER[d] | latin)[:-1] & _MARK[d[1:]]) + 1
    w.start, w.end = np.sort(np.concatenate((w.start, cut))), np.sort(np.concatenate((w.end, cut)))
    w.doc = np.searchsorted(w.doc_end, w.start, side="right")
    return w


class WordTable:
    """Ids of words by their hash; ``encode`` (words to lists of ids, or to all ids end to end and their numbers) is asked only for new ones."""

    def __init__(self, encode, max_words: int = MAX_WORDS):
        self.encode, self.max_words = encode, max_words
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)   # sorted hashes of known words
        self.slot = np.zeros(0, np.int64)    # their place in offset and length
        self.offset, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        found = self.encode([w.decode("utf-8", "surrogatepass") for w in words])
        if isinstance(found, tuple):
            flat, n = found
        else:
            n = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(n.sum()))
        start = len(self.store) + np.concatenate(([0], np.cumsum(n)[:-1]))
        slots = len(self.length) + np.arange(len(n))
        self.store = np.concatenate((self.store, flat))
        self.offset, self.length = np.concatenate((self.offset, start)), np.concatenate((self.length, n))
        at = np.searchsorted(self.keys, hashes)
        self.keys, self.slot = np.insert(self.keys, at, hashes), np.insert(self.slot, at, slots)

    def slots(self, words: Words) -> np.ndarray:
        """Slot of each word of the chunk."""
        distinct, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        known = self._known(distinct)
        if len(self.keys) + len(distinct) - known.sum() > self.max_words:
            self._clear()
            known[:] = False
        if not known.all():
            self._learn(distinct[~known], [words.word(i) for i in first[~known]])
        return self.slot[np.searchsorted(self.keys, distinct)][inverse]

    def _known(self, distinct: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        return known

    def learn(self, parts: Iterable[Words]) -> None:
        """Encode the new words of several chunks at once, where ``encode`` works better on many."""
        new: dict[int, bytes] = {}
        for w in parts:
            distinct, first = np.unique(w.hashes(), return_index=True)
            ask = ~self._known(distinct)
            new.update(zip(distinct[ask].tolist(), [w.word(i) for i in first[ask]], strict=True))
        if new and len(self.keys) + len(new) <= self.max_words:
            hashes = np.sort(np.fromiter(new, np.uint64, len(new)))
            self._learn(hashes, [new[h] for h in hashes.tolist()])

    def joined(self, slot: np.ndarray) -> np.ndarray:
        """Ids of the words end to end."""
        n = self.length[slot]
        where = np.repeat(self.offset[slot] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return self.store[where]


class WordIds:
    """Ids of texts by a tokenizer of the library."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = splits_at_blanks(json.loads(self.tokenizer.to_str()))
        self.table = WordTable(self._encode, max_words)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        for first, part in chunks(texts):
            if self.by_word:
                w = pieces(part)
                slot = self.table.slots(w)
                out[first : first + len(part)] = np.bincount(w.doc, self.table.length[slot], len(part))
            else:
                out[first : first + len(part)] = list(map(len, self._encode([b.decode("utf-8", "surrogatepass") for b in part])))
        return out

    def ids(self, texts: list):
        """(first index, ids of the chunk's texts end to end, ids per text) a chunk at a time."""
        for first, part in chunks(texts):
            if not self.by_word:
                got = self._encode([b.decode("utf-8", "surrogatepass") for b in part])
                n = np.fromiter(map(len, got), np.int64, len(got))
                yield first, np.fromiter((i for ids in got for i in ids), np.uint32, int(n.sum())), n
                continue
            w = pieces(part)
            slot = self.table.slots(w)
            yield first, self.table.joined(slot), np.bincount(w.doc, self.table.length[slot], len(part)).astype(np.int64)


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per Python worker and file: workers live for many tasks."""
    if path not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
