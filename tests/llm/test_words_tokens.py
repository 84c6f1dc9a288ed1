import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import cases  # noqa: E402

from retailpot.llm import packing, sentence_pieces, token_counts  # noqa: E402
from retailpot.llm.common import scratch  # noqa: E402
from retailpot.llm.tokens import WordIds, tokenizer_path  # noqa: E402
from retailpot.llm.words import Words, chunks, shingle_hashes  # noqa: E402

BPE = tokenizer_path("word_bpe_49k.json")
ODD = ["<|endoftext|>a <|endoftext|>", "it's I'LL <|ENDOFTEXT|> x", "İstanbul ΣΑΣ ﬁ", "éń a", "a…, b×, c÷! é, x≮ it's! don't're", "Abc###def, É!x"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def test_words_and_shingles_equal_plain_splitting():
    texts = [t or "" for t in cases.TEXTS]
    seen = {}
    for first, part in chunks(texts, 5_000):
        w = Words(part)
        got = [[] for _ in part]
        for i, d in enumerate(w.doc):
            got[d].append(w.word(i).decode())
        assert got == [re.findall(r"[^\x20\x09-\x0D]+", texts[first + k]) for k in range(len(part))]
        for d, h in zip(*shingle_hashes(w, 3), strict=True):
            seen.setdefault(first + int(d), []).append(int(h))
    for i, t in enumerate(texts):
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        runs = [tuple(ws[k : k + 3]) for k in range(max(1, len(ws) - 2))] if ws else []
        assert len(seen.get(i, [])) == len(runs) and len(set(seen.get(i, []))) == len(set(runs))


@pytest.mark.parametrize("max_words", [40, 1_000_000])
def test_ids_equal_the_library(library, max_words):
    texts = [t for t in cases.TEXTS if t is None or len(t) < 60_000] + ODD + [t for _, t in cases.read()[:60]]
    ids = WordIds(BPE, max_words)
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = [x.tolist() for _, flat, n in ids.ids(texts) for x in np.split(flat, np.cumsum(n)[:-1])]
    assert got == want and ids.counts(texts).tolist() == [len(x) for x in want]


def test_token_counts_use_and_extend_the_cache(spark, library):
    df, cache = cases.clashing(cases.frame(spark), "content_sha256"), scratch(spark, "cache")
    first = token_counts.count_tokens(df, cache, BPE).select("doc_id", "n_tokens").collect()
    want = {i: len(e) for i, e in enumerate(library.encode_batch([t or "" for t in cases.TEXTS], add_special_tokens=False))}
    assert {r.doc_id: r.n_tokens for r in first} == want
    size = spark.read.parquet(cache).count()
    assert size < len(cases.TEXTS)  # copies and blank texts share an entry
    more = token_counts.count_tokens(cases.frame(spark, [*cases.TEXTS, "something new"]), cache, BPE)
    assert more.count() == len(cases.TEXTS) + 1 and spark.read.parquet(cache).count() == size + 1
    assert token_counts.count_tokens(df.limit(0), scratch(spark, "cache"), BPE).count() == 0


def check_packing(rows, want, capacity=4096):
    """Every id in exactly one piece, right digests, gapless sequences; returns the padding."""
    seq, got = {}, dict.fromkeys(want, 0)
    for doc, start, length, crc, n, s, offset in rows:
        assert n == len(want[doc]) and zlib.crc32(want[doc][start : start + length].tobytes()) == crc
        seq.setdefault(s, []).append((offset, length))
        got[doc] += length
    assert got == {d: len(x) for d, x in want.items()}
    padding = 0
    for parts in seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_packing_round_trip(spark, library):
    df = cases.clashing(cases.frame(spark), "start")
    want = {i: np.array([*e.ids, 2], "<u4") for i, e in enumerate(library.encode_batch([t or "" for t in cases.TEXTS], add_special_tokens=False))}
    rows = [tuple(r) for r in packing.pack(df.coalesce(1), BPE).collect()]
    assert check_packing(rows, want) < 0.05 * sum(map(len, want.values())) + 4096
    assert packing.pack(df.limit(0), BPE).count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(3)
    for _ in range(200):
        gaps = rng.integers(1, 9, rng.integers(1, 14))
        at, cap = np.concatenate(([0], np.cumsum(gaps))), 16
        pen = rng.integers(0, 6, len(at))
        pen[0] = 0
        cost = {0: 0}
        for i in range(1, len(at)):
            cost[i] = min(cost[j] + int(pen[i]) + cap - int(at[i] - at[j]) for j in range(i) if at[i] - at[j] <= cap)
        tail = lambda n: 3 * n
        least = min(cost[i] + tail(int(at[-1] - at[i])) for i in cost if at[-1] - at[i] < cap)
        cuts = [0, *packing.best_cuts(at, pen, cap, tail)]
        paid = sum(int(pen[list(at).index(b)]) + cap - (b - a) for a, b in zip(cuts, cuts[1:])) + tail(int(at[-1] - cuts[-1]))
        assert paid == least and all(b - a <= cap for a, b in zip(cuts, cuts[1:]))
    assert packing.tail_cuts(6, 16, 1) == [4, 2] and packing.tail_cuts(15, 16, 1) == [15] and packing.tail_cuts(0) == []


@pytest.fixture(scope="module")
def pieces():
    return sentence_pieces.Codec(tokenizer_path("piece_bpe_32k.model"))


def test_pieces_equal_the_library(pieces):
    rng = np.random.default_rng(5)
    texts = [t for t in cases.TEXTS if t is None or len(t) < 60_000] + ODD + [t for _, t in cases.read()[:80]]
    texts += ["  two  spaces\n\nnew ", "aaaaaaaaaaaaaaaaaaaaaaaa aaaaa aaa", "▁▁x y▁", "    " * 20 + "a", "<s></s><unk>", "\t\ta\x00b", "ﬁ ½ İ"]
    texts += ["".join(rng.choice(list("aeinrst  hT.,é\n"), 60)) for _ in range(300)]
    got = pieces.encode(texts)
    want = pieces.library.encode([t or "" for t in texts])
    assert [x.tolist() for x in got] == want
    assert pieces.decode(got) == pieces.library.decode(want)


def test_unigram_takes_the_best_path(pieces):
    import copy

    one = copy.copy(pieces)
    one.bpe = False
    rng = np.random.default_rng(9)
    one.score = rng.normal(-8, 3, len(one.pieces))
    one.unknown_score = -40.0
    by_text = {one.pieces[i]: i for i in one.key_ids}
    for word in ["▁the", "▁thenation", "abcétion", "▁▁in", "x"]:
        codes = np.array([[ord(c) for c in word]], np.uint32)
        best = {0: 0.0}
        for e in range(1, len(word) + 1):
            best[e] = max(best[s] + (one.score[by_text[word[s:e]]] if word[s:e] in by_text else -40.0 if e - s == 1 else -1e9) for s in range(e))
        ids = one._advance(codes)[0]
        assert sum(one.score[i] if i >= 0 else -40.0 for i in ids) == pytest.approx(best[len(word)])


def test_encoded_frame(spark, pieces):
    df = cases.clashing(cases.frame(spark), "n_ids")
    got = {r.doc_id: r for r in sentence_pieces.encoded(df, tokenizer_path("piece_bpe_32k.model"), keep_ids=True).collect()}
    for i, t in enumerate(cases.TEXTS):
        if t is None or len(t) < 60_000:
            assert got[i].ids == pieces.library.encode(t or "") and got[i].n_ids == len(got[i].ids)
        assert got[i].round_trip == (got[i].decoded == (t or ""))
    assert sentence_pieces.encoded(df.limit(0), tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_token_query_encodes_once_and_clashing_columns_give_way(spark, monkeypatch):
    import __spark_entry__ as entry

    df = cases.clashing(cases.frame(spark), "n_tokens", "_digest", "content_sha256")
    got = token_counts.count_tokens(df, scratch(spark, "cache"), BPE)
    assert sorted(got.columns) == ["_digest", "content_sha256", "doc_id", "n_tokens", "text"] and {r._digest for r in got.collect()} == {"mine"}
    run, d = entry.queries()["op4_token_counts"], "/root/testdata/sf0.001"
    first = sorted(map(tuple, run(spark, d).collect()))
    asked = []
    real = type(df).mapInPandas
    monkeypatch.setattr(type(df), "mapInPandas", lambda self, *a, **k: asked.append(self.count()) or real(self, *a, **k))
    assert sorted(map(tuple, run(spark, d).collect())) == first and asked == [0]
