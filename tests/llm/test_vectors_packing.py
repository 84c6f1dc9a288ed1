import sys
import zlib
from fractions import Fraction
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import cases  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from retailpot.llm import best_fit, vector_codes, whitening  # noqa: E402
from retailpot.llm.tokens import tokenizer_path  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(seed=5, n=150, dims=16, copies=60):
    """Rows with near and exact copies, ties, repeated rows, null ids and labels, and vectors that must be left out."""
    rng = np.random.default_rng(seed)
    base = (rng.integers(-6, 6, (n, dims)) / 64).astype(np.float32)
    out = [(i, [float(v) for v in base[i % n]], None if i % 11 == 0 else i % 4) for i in range(n)]
    out += [(1000 + i, out[7][1], 2) for i in range(copies)] + [out[3], out[3], (None, out[9][1], 1), (None, out[12][1], None)]
    bad = [float("nan"), float("inf"), float("-inf"), None]
    return out + [(5000 + i, [*base[0][:-1].tolist(), b], 1) for i, b in enumerate(bad)] + [(6000, None, 1), (6001, None, None)]


def good(rows):
    return [r for r in rows if r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1])]


# --- op11 ------------------------------------------------------------------------------------

def brute_codes(rows, parts, k, rounds):
    rows = good(rows)
    x = [[int(np.floor(4096 * v)) for v in r[1]] for r in rows]
    width = len(x[0]) // parts
    first = {}
    for r, v in zip(rows, x, strict=True):
        first[r[0]] = min(first.get(r[0], v), v)
    ids = sorted(first, key=lambda i: (i is None, i or 0))[:k]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in x]
    books = [[first[i][p * width : (p + 1) * width] for i in ids] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), j) for j, e in enumerate(book))

    for r in range(rounds + 1):
        found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
        for p in range(parts if r < rounds else 0):
            for j in range(len(ids)):
                own = [c[p] for c, f in zip(cut, found, strict=True) if f[p][1] == j]
                if own:
                    books[p][j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    error = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for r, e in zip(rows, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    flat = ",".join(str(v) for book in books for e in book for v in e)
    import hashlib
    digest = hashlib.sha256(flat.encode()).hexdigest()
    return sorted(((r[0], "".join(f"{j:02x}" for _, j in f), e, by_label[r[2]], digest) for r, f, e in zip(rows, found, error, strict=True)), key=repr)


@pytest.mark.parametrize("seed,k,limit", [(5, 16, 1 << 16), (6, 5, 0), (7, 300, 1 << 16)])
def test_vector_codes_equal_brute_force(spark, monkeypatch, seed, k, limit):
    monkeypatch.setattr(vector_codes, "MAX_BROADCAST", limit)
    data = vectors(seed)
    df = spark.createDataFrame(data, VECTORS).repartition(5)
    got, books = vector_codes.compress(cases.clashing(df, "code", "part", "x", "id", "n"), entries=k, rounds=3)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_codes(data, 8, k, 3)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and books[0].shape[1] == 2


def test_balls_skip_work_but_change_no_assignment():
    rng = np.random.default_rng(1)
    x = rng.integers(-30, 30, (4000, 4))
    entries, before, radius = x[:12].copy(), None, None
    entries[5] = entries[2]                                    # two entries in one place: the lower number wins
    code, dist = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64)
    skipped = compared = 0
    for _ in range(30):
        b = vector_codes.balls(entries, before, radius)
        vector_codes.assign(x, code, dist, b)
        d = ((x[:, None, :] - entries) ** 2).sum(2)
        assert (code == d.argmin(1)).all() and (dist == d.min(1)).all()
        skipped += int(b.stable.sum())
        compared += sum(map(len, b.order))
        radius = [int(dist[code == j].max(initial=0)) for j in range(12)]
        before, entries = entries, np.array([x[code == j].sum(0) // max(1, (code == j).sum()) if (code == j).any() else entries[j] for j in range(12)])
    assert skipped and compared < 30 * 12 * 11                 # stable balls were met, and not every entry was a neighbour


def test_vector_codes_of_odd_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    got, books = vector_codes.compress(empty)
    assert got.collect() == [] and books == [] and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes.compress(spark.createDataFrame(vectors()[-6:], VECTORS))[0].count() == 0
    ragged = spark.createDataFrame([(1, [0.1] * 8, 1), (2, [0.1] * 16, 1)], VECTORS)
    for wrong in (ragged, ragged.where("vec_id = 1").withColumn("embedding", F.slice("embedding", 1, 7)), ragged.where("vec_id = 1").withColumn("embedding", F.transform("embedding", lambda v: v * 1e30))):
        with pytest.raises(ValueError):
            vector_codes.compress(wrong)
    one = vector_codes.compress(spark.createDataFrame([(None, [0.5] * 8, None)], VECTORS))[0].collect()
    assert [tuple(r)[:4] for r in one] == [(None, "00" * 8, 0, 0)]


def test_vector_codes_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{d}/embeddings.parquet'")
    want = con.sql(entry.oracle_sql()["op11_vector_codes"])
    got = entry.queries()["op11_vector_codes"](spark, d).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


# --- op12 ------------------------------------------------------------------------------------

def brute_whitening(rows, weights="one", scale=64, shift=1_000_000):
    rows = good(rows)
    x = np.array([[int(np.floor(scale * np.float64(v))) + shift for v in r[1]] for r in rows], np.int64)
    fit = np.unique(x, axis=0) if weights == "one" else x
    n, s = len(fit), fit.sum(0)
    deviation = [sum(int(v) ** 2 for v in n * row - s) for row in x]
    mean = [Fraction(int(v), n) for v in s]
    exact = lambda m: np.array([[float(Fraction(int(a)) - b) for a, b in zip(row, mean, strict=True)] for row in m])
    z = exact(fit)
    value, axes = np.linalg.eigh(z.T @ z / n)
    return n, deviation, value[::-1], exact(x) @ axes[:, ::-1], [r[0] for r in rows]


@pytest.mark.parametrize("weights,hot", [("one", 1000), ("count", 1000), ("one", 4)])
def test_whitening_equals_brute_force(spark, monkeypatch, weights, hot):
    monkeypatch.setattr(whitening, "HOT", hot)   # 4: the copied vector alone is broadcast
    data = [(i, v, n) for i, (_, v, n) in enumerate(vectors(dims=24, copies=120))]
    df = cases.clashing(spark.createDataFrame(data, VECTORS).repartition(4), "x", "key", "w", "n", "id", "component")
    got = whitening.whiten(df, weights=weights).collect()
    n, deviation, value, projected, ids = brute_whitening(data, weights)
    assert len(got) == len(ids) * 16 and {r.n for r in got} == {n}
    by = {(r.vec_id, r.component): r for r in got}
    out = np.array([[by[i, c].whitened for c in range(1, 17)] for i in ids])
    want = projected[:, :16] / np.sqrt(value[:16])
    want *= np.sign((out * want).sum(0))
    assert np.abs(out - want).max() < 1e-9
    assert [by[i, 1].deviation for i in ids] == deviation
    assert all(by[ids[0], c].explained == pytest.approx(value[c - 1] / value.sum(), rel=1e-9) for c in range(1, 17))
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_of_odd_tables(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    empty = whitening.whiten(spark.createDataFrame([], VECTORS))
    assert empty.collect() == [] and empty.columns == columns
    assert whitening.whiten(spark.createDataFrame(vectors()[-6:], VECTORS)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(1, [0.5] * 4, 1), (1, [0.5] * 4, 1), (None, [0.5] * 4, 1)], VECTORS)).collect()
    assert len(same) == 12 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.n == 1 and r.identity_error == 0 for r in same)
    line = whitening.whiten(spark.createDataFrame([(i, [i / 4, 1.0, i / 4], 1) for i in range(9)], VECTORS)).collect()
    assert len(line) == 27 and all((r.whitened is None) == (r.component > 1) for r in line)
    assert max(r.explained for r in line) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [0.1] * 8, 1), (2, [0.1] * 16, 1)], VECTORS))


def test_whitening_query(spark):
    d = "/root/testdata/sf0.001"
    got = entry.queries()["op12_whitening"](spark, d).collect()
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{d}/embeddings.parquet'").fetchall()
    n, deviation, value, projected, ids = brute_whitening(rows)
    by = {(r.vec_id, r.component): r for r in got}
    assert len(got) == 16 * len(ids) and [by[i, 3].deviation for i in ids] == deviation and got[0].n == n and got[0].identity_error < 1e-9
    out = np.array([[by[i, c].whitened for c in range(1, 17)] for i in ids])
    assert np.abs(np.abs(out) - np.abs(projected[:, :16] / np.sqrt(value[:16]))).max() < 1e-8


# --- op13 ------------------------------------------------------------------------------------

def slow_best_fit(lengths, room, weights, dot):
    open_, where, offset = [], {}, {}
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = (lengths[k], 1, lengths[k] ** 2)
        best = None
        for b, left in enumerate(open_):
            if all(x >= y for x, y in zip(left, need, strict=True)):
                if dot:
                    score = -sum(w * x / c * y / c for w, x, y, c in zip(weights, left, need, room, strict=True))
                else:
                    score = sum(w * ((x - y) / c) ** 2 for w, x, y, c in zip(weights, left, need, room, strict=True))
                if best is None or score < best[0] - 1e-15:
                    best = (score, b)
        if best is None:
            open_.append(list(room))
            best = (0, len(open_) - 1)
        left = open_[best[1]]
        where[k], offset[k] = best[1], room[0] - left[0]
        open_[best[1]] = [x - y for x, y in zip(left, need, strict=True)]
    return [where[k] for k in range(len(lengths))], [offset[k] for k in range(len(lengths))]


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize("limits", [best_fit.Limits(100), best_fit.Limits(100, 3), best_fit.Limits(100, 5, 4000)])
def test_best_fit_equals_a_plain_walk(score, limits):
    rng = np.random.default_rng(3)
    lengths = np.concatenate((rng.integers(1, limits.piece + 1, 200), np.full(9, limits.piece), np.ones(40, np.int64)))
    rule = best_fit.Rule(score, (1.0, 0.25, 0.125))
    where, offset = best_fit.best_fit(lengths, limits, rule)
    a, b = slow_best_fit(lengths.tolist(), limits.vector().tolist(), rule.weights, score == "dot")
    assert where.tolist() == a and offset.tolist() == b
    for s in range(where.max() + 1):
        own = lengths[where == s]
        assert own.sum() <= limits.tokens and len(own) <= limits.vector()[1] and (own**2).sum() <= limits.vector()[2]


def check_packed(rows, texts, limits, end_id=1):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, end_id] for d, t in texts}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == ids.keys()
    for d, own in by_doc.items():
        at = 0
        for k, r in enumerate(sorted(own, key=lambda r: r.piece)):
            part = np.array(ids[d][r.start : r.start + r.length], "<u4")
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(part.tobytes())
            assert r.length == limits.piece or r.start + r.length == len(ids[d])
            at += r.length
        assert at == len(ids[d])
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(own) <= limits.vector()[1] and sum(r.length**2 for r in own) <= limits.vector()[2]
    return sum(map(len, ids.values())), len(by_sequence)


@pytest.mark.parametrize("limits,group", [(best_fit.Limits(), best_fit.GROUP), (best_fit.Limits(512, 4, 90_000), 7), (best_fit.Limits(64), 16)])
def test_best_fit_packing_holds_every_id_once(spark, limits, group):
    df = cases.clashing(cases.frame(spark).repartition(3), "piece", "length", "offset", "sequence_id", "_group")
    got = best_fit.pack(df, tokenizer_path("word_bpe_49k.json"), limits, group=group)
    assert got.columns == [c.split()[0] for c in best_fit.PLACED.split(", ")]
    check_packed(got.collect(), list(enumerate(cases.TEXTS)), limits)


def test_best_fit_packing_of_odd_tables(spark):
    path = tokenizer_path("word_bpe_49k.json")
    assert best_fit.pack(cases.frame(spark).limit(0), path).collect() == []
    rows = best_fit.pack(spark.createDataFrame([(None, "a b"), (2**60 + 1, None), (2**60 + 1, None)], "doc_id long, text string"), path).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 3), (2**60 + 1, 1), (2**60 + 1, 1)] and len({r.sequence_id for r in rows}) == 1


def test_best_fit_packing_query_is_near_the_least(spark):
    rows = entry.queries()["op13_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    total, used = check_packed(rows, cases.read(), best_fit.Limits())
    assert used <= -(-total // 4096) + 1
