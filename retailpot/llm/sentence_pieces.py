"""SentencePiece encoding and decoding of whole texts by batched numpy Viterbi.

Words of one length advance together, one code point at a time: hashes of their substrings probe the sorted keys of the pieces, and
for each end position the best last piece is kept as a backpointer. The library reads the model file and normalises texts; pieces never
span the end of a word (a run of word marks and what follows), so words are independent and each distinct one is encoded once.

* A unigram model takes the path of the greatest score sum.
* A BPE model has no score sum: its result is the one segmentation in which no two neighbours would have merged across their border before
  they were complete. So a step to a piece is admitted only where that holds with the piece before it, which each prefix's backpointer
  names; the admitted path is unique and equals the merge procedure's result.

Characters that no piece covers become their bytes' pieces, or the unknown piece where the model has none.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpot.llm.tokens import WordTable
from retailpot.llm.words import Words, chunks

MARK = "▁"
BLOCK = 20_000        # words that advance together
FILTER_BITS = 20      # of the table that tells most substrings apart from pieces before the sorted keys are searched
PAIR_BITS = 20        # of the table of piece pairs whose border has been looked at; a newer pair takes the place of an older one
NEVER = np.int64(1) << 40
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))


def _field(data: bytes, number: int) -> list:
    """Values of one field of a protocol message (varints and byte strings)."""
    out, at = [], 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value, at = data[at : at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        if key >> 3 == number:
            out.append(value)
    return out


def _code_hash(codes: np.ndarray) -> np.ndarray:
    """Running hash sums along the last axis, a zero in front; a substring's hash is their difference over a power of the base."""
    n = codes.shape[-1]
    power = np.multiply.accumulate(np.concatenate(([_U(1)], np.full(max(n - 1, 0), _BASE))))[:n]
    x = (codes.astype(np.uint64) + _U(1)) * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x = x * _U(0xC2B2AE3D27D4EB4F) * power
    return np.concatenate([np.zeros((*codes.shape[:-1], 1), np.uint64), np.cumsum(x, axis=-1, dtype=np.uint64)], axis=-1)


class Codec:
    """Encodes and decodes by one model file."""

    def __init__(self, path: str | None = None, proto: bytes | None = None):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path) if path else SentencePieceProcessor(model_proto=proto)
        lib, n = self.library, self.library.get_piece_size()
        kind = (_field((_field(lib.serialized_model_proto(), 2) or [b""])[0], 3) or [1])[0]
        if kind not in (1, 2):
            raise ValueError("only unigram and BPE models are read")
        self.bpe = kind == 2
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        plain = np.array([not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)) for i in range(n)])
        if any(MARK in p.lstrip(MARK) for p, ok in zip(self.pieces, plain, strict=True) if ok):
            raise ValueError("a piece spans the end of a word")
        self.score = np.array([lib.get_score(i) for i in range(n)])
        self.unknown, self.unknown_score = lib.unk_id(), self.score[plain].min() - 10
        self.bytes_of = {int(self.pieces[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        ids = np.flatnonzero(plain)
        self.longest = max(len(self.pieces[i]) for i in ids)
        keys = np.array([self._key(self.pieces[i]) for i in ids], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], ids[order]
        self.likely = np.zeros(1 << FILTER_BITS, bool)
        self.likely[(self.keys >> _U(64 - FILTER_BITS)).astype(np.int64)] = True
        self.pair_keys, self.pair_free = np.full(1 << PAIR_BITS, np.iinfo(np.int64).min), np.zeros(1 << PAIR_BITS, bool)
        self.length = np.array([len(p) for p in self.pieces])
        if self.bpe:
            self._split_pieces(ids)
        self._tables()
        self.table = WordTable(self._learn)

    @staticmethod
    def _key(piece: str) -> np.uint64:
        return _code_hash(np.array([ord(c) for c in piece], np.uint32))[-1]

    def _split_pieces(self, ids: np.ndarray) -> None:
        """Time of each piece's last merge and its two halves; a piece that merging its own characters doesn't give is never used."""
        by_text = {self.pieces[i]: int(i) for i in ids}
        n = len(self.pieces)
        self.time, self.left, self.right = np.full(n, NEVER), np.full(n, -1), np.full(n, -1)
        for text, i in by_text.items():
            if len(text) == 1:
                self.time[i] = -1
                continue
            parts = list(text)
            while len(parts) > 1:
                best = max(((self.score[by_text[a + b]], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in by_text), default=None)
                if best is None:
                    break
                k = -best[1]
                if len(parts) == 2:
                    self.time[i] = round(-self.score[i])
                    self.left[i], self.right[i] = by_text.get(parts[0], -2), by_text.get(parts[1], -2)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def _tables(self) -> None:
        """Bytes of each piece in decoded text."""
        raw = []
        for i, p in enumerate(self.pieces):
            if self.library.is_control(i):
                raw.append(b"")
            elif self.library.is_unknown(i):
                raw.append(" ⁇ ".encode())
            elif self.library.is_byte(i):
                raw.append(bytes([int(p[3:5], 16)]))
            else:
                raw.append(p.replace(MARK, " ").encode())
        size = np.array([len(r) for r in raw])
        self.raw, self.raw_size, self.raw_at = np.frombuffer(b"".join(raw), np.uint8), size, np.cumsum(size) - size

    # --- encoding ------------------------------------------------------------------------
    def _found(self, codes: np.ndarray) -> tuple[np.ndarray, dict[tuple[int, int], np.ndarray]]:
        """Piece at (word, start, length), -1 where there is none; and the words that have one, by (start, length)."""
        words, n = codes.shape
        sums = _code_hash(codes)
        inverse = np.multiply.accumulate(np.concatenate(([_U(1)], np.full(n, _INVERSE))))
        out, hits = np.full((words, n, min(n, self.longest) + 1), -1, np.int32), {}
        for k in range(1, out.shape[2]):
            h = (sums[:, k:] - sums[:, :-k]) * inverse[: n - k + 1]
            start, word = np.nonzero(self.likely[(h >> _U(64 - FILTER_BITS)).astype(np.int64)].T)
            some = h[word, start]
            at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
            real = self.keys[at] == some
            start, word = start[real], word[real]
            out[word, start, k] = self.key_ids[at[real]]
            begin = np.searchsorted(start, np.arange(n - k + 2))
            hits |= {(s, k): word[begin[s] : begin[s + 1]] for s in range(n - k + 1)}
        return out, hits

    def _free(self, found: np.ndarray, w: np.ndarray, at: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_apart`` by pair: what merges across a border depends on the two pieces alone, so a pair is looked at once while it is kept."""
        pair = a * len(self.pieces) + b
        slot = ((pair.astype(np.uint64) * _BASE) >> _U(64 - PAIR_BITS)).astype(np.int64)
        new = np.flatnonzero(self.pair_keys[slot] != pair)
        free = self.pair_free[slot]
        if len(new):
            _, first, inverse = np.unique(pair[new], return_index=True, return_inverse=True)
            one = new[first]
            apart = self._apart(found, w[one], at, a[one], b[one])
            free[new] = apart[inverse]
            self.pair_keys[slot[one]], self.pair_free[slot[one]] = pair[one], apart
        return free

    def _apart(self, found: np.ndarray, w: np.ndarray, at: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a (ending at ``at``) and b (beginning there) of words ``w`` form without a merge across their border.

        Walks back in time: the half formed later is replaced by its part next to the border; in between, the joined piece would
        have had to come before either side's next merge (the left neighbour's merge goes first at equal times).
        """
        free = np.ones(len(w), bool)
        live = np.arange(len(w))
        a, b, after_a, after_b = a.copy(), b.copy(), np.full(len(w), NEVER), np.full(len(w), NEVER)
        while len(live):
            x, y = a[live], b[live]
            known = (x >= 0) & (y >= 0)
            la, size = np.where(known, self.length[x], 0), np.where(known, self.length[x] + self.length[y], 0)
            fits = known & (size < found.shape[2])
            joined = np.where(fits, found[w[live], np.maximum(at - la, 0), np.where(fits, size, 0)], -1)
            when = np.where(joined >= 0, np.round(-self.score[joined]), NEVER)
            crosses = (joined >= 0) & (when < after_a[live]) & (when <= after_b[live])
            free[live[crosses]] = False
            ta, tb = np.where(x >= 0, self.time[x], -1), np.where(y >= 0, self.time[y], -1)
            go = ~crosses & ((ta >= 0) | (tb >= 0)) & known
            live, x, y, ta, tb = live[go], x[go], y[go], ta[go], tb[go]
            back_a = ta > tb
            i, j = live[back_a], live[~back_a]
            after_a[i], a[i] = ta[back_a], self.right[x[back_a]]
            after_b[j], b[j] = tb[~back_a], self.left[y[~back_a]]
        return free

    def _advance(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of the words of a block of equal lengths, word after word, and how many each has; -(code + 2) stands for an uncovered character."""
        words, n = codes.shape
        found, hits = self._found(codes)
        best = np.full((words, n + 1), -np.inf)
        best[:, 0] = 0
        last = np.full((words, n + 1), -1, np.int64)   # piece that ends here, -1 for an uncovered character
        step = np.ones((words, n + 1), np.int64)
        for end in range(1, n + 1):
            for k in range(min(end, found.shape[2] - 1), 0, -1):
                start = end - k
                w = hits[start, k]
                w = w[np.isfinite(best[w, start])]
                if k == 1:  # an uncovered character stands alone
                    bare = np.flatnonzero((found[:, start, 1] < 0) & np.isfinite(best[:, start]))
                    value = best[bare, start] + (0 if self.bpe else self.unknown_score)
                    better = value > best[bare, end]
                    best[bare[better], end], last[bare[better], end], step[bare[better], end] = value[better], -1, 1
                if self.bpe:
                    w = w[~np.isfinite(best[w, end])]
                    piece = found[w, start, k].astype(np.int64)
                    w, piece = w[self.time[piece] < NEVER], piece[self.time[piece] < NEVER]
                    if len(w) and start:
                        free = self._free(found, w, start, last[w, start], piece)
                        w, piece = w[free], piece[free]
                    value = np.zeros(len(w))
                else:
                    piece = found[w, start, k].astype(np.int64)
                    value = best[w, start] + self.score[piece]
                    better = value > best[w, end]
                    w, piece, value = w[better], piece[better], value[better]
                best[w, end], last[w, end], step[w, end] = value, piece, k
        open_, ends, steps = np.arange(words), np.full(words, n), []
        while len(open_):
            e = ends[open_]
            p = last[open_, e]
            bare = p < 0
            p[bare] = -codes[open_[bare], e[bare] - 1].astype(np.int64) - 2
            steps.append((open_, e, p))
            ends[open_] -= step[open_, e]
            open_ = open_[ends[open_] > 0]
        word, end, piece = (np.concatenate(x) for x in zip(*steps, strict=True))
        order = np.lexsort((end, word))
        return self._spelled(piece[order], word[order], words)

    def _spelled(self, ids: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Uncovered characters as their bytes' pieces or the unknown piece."""
        bare = ids < 0
        if bare.any():
            spelled = [[self.bytes_of[b] for b in chr(-i - 2).encode("utf-8", "surrogatepass")] if self.bytes_of else [self.unknown] for i in ids[bare].tolist()]
            times = np.ones(len(ids), np.int64)
            times[bare] = [len(x) for x in spelled]
            ids, word, bare = np.repeat(ids, times), np.repeat(word, times), np.repeat(bare, times)
            ids[bare] = [i for x in spelled for i in x]
        return ids, np.bincount(word, minlength=words)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order, blocks = np.argsort(size, kind="stable"), []
        for same in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
            n = int(size[same[0]])
            block = max(1, min(BLOCK, 4_000_000 // (n * self.longest)))
            for k in range(0, len(same), block):
                part = same[k : k + block]
                codes = np.frombuffer("".join([words[i] for i in part.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), n)
                blocks.append((part, *self._advance(codes)))
        count = np.zeros(len(words), np.int64)
        for part, _, n in blocks:
            count[part] = n
        begin, ids = np.cumsum(count) - count, np.empty(int(count.sum()), np.uint32)
        for part, own, n in blocks:
            ids[np.repeat(begin[part] - (np.cumsum(n) - n), n) + np.arange(len(own))] = own
        return ids, count

    @staticmethod
    def _cut(part: list[bytes]) -> Words:
        """Words of normalised texts: a run of word marks with what follows, whatever else that holds."""
        w = Words(part)
        d = w.data
        mark = np.zeros(len(d), bool)
        mark[:-2] = (d[:-2] == 0xE2) & (d[1:-1] == 0x96) & (d[2:] == 0x81)
        again = np.zeros(len(d), bool)
        again[3:] = mark[:-3]
        filled = w.doc_start[w.doc_end > w.doc_start]
        w.start = np.union1d(np.flatnonzero(mark & ~again), filled)
        w.doc = np.searchsorted(w.doc_end, w.start, side="right")
        w.end = np.minimum(np.append(w.start[1:], len(d)), w.doc_end[w.doc])
        return w

    def encode(self, texts: list) -> list[np.ndarray]:
        """Ids of each text as the library gives them without begin and end; a null text is empty."""
        out: list[np.ndarray] = []
        parts = [part for _, part in chunks([self.library.normalize(t) if t else "" for t in texts])]
        self.table.learn(self._cut(part) for part in parts)
        for part in parts:
            w = self._cut(part)
            slot = self.table.slots(w)
            n = np.bincount(w.doc, self.table.length[slot], len(part)).astype(np.int64)
            out += np.split(self.table.joined(slot), np.cumsum(n)[:-1])
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of id sequences: the pieces' bytes end to end, word marks as spaces, the first one (put there by encoding) left out."""
        n = np.array([len(x) for x in ids])
        flat = np.concatenate([np.asarray(x, np.int64) for x in ids]) if len(ids) else np.zeros(0, np.int64)
        size = self.raw_size[flat]
        at = np.repeat(self.raw_at[flat] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        data, cut = self.raw[at].tobytes(), np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(n)))]
        return [data[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


_LOADED: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per Python worker and file."""
    if path not in _LOADED:
        _LOADED[path] = Codec(path)
    return _LOADED[path]


def encoded(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, n_ids, ids_crc32, decoded, round_trip, [ids]): ids of each whole text and the text decoded from them.

    ``round_trip`` tells whether decoding gives the very text again (normalisation may have changed it).
    ``ids_crc32`` covers the ids as little-endian unsigned 32-bit numbers. Null texts are empty and have no ids; repeated rows get equal
    results; an empty table gives none; other columns are ignored.
    """
    schema = "doc_id long, n_ids long, ids_crc32 long, decoded string, round_trip boolean" + (", ids array<int>" if keep_ids else "")

    def run(batches):
        c = codec(path)
        for b in batches:
            doc_ids, texts = b["doc_id"].tolist(), b["text"].tolist()
            first = 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last] or "") <= 8_000_000):
                    size += len(texts[last] or "")
                    last += 1
                ids = c.encode(texts[first:last])
                decoded = c.decode(ids)
                out = {"doc_id": doc_ids[first:last], "n_ids": [len(x) for x in ids], "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids], "decoded": decoded, "round_trip": [d == (t or "") for d, t in zip(decoded, texts[first:last], strict=True)]}
                yield pd.DataFrame(out | ({"ids": [x.astype(np.int32) for x in ids]} if keep_ids else {}))
                first = last

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)
