import hashlib
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import cases  # noqa: E402

from retailpot.llm import fingerprints, html_text, ngram_join, pii, quality_model, quality_rules, sharding  # noqa: E402
from retailpot.llm.features import LinearScorer  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def shingles(t, n):
    w = words((t or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_components(docs, n, num, den):
    sets, parent, lists = {k: shingles(t, n) for k, t in docs}, {k: k for k, _ in docs}, defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k in sorted(sets):
        for y, i in Counter(y for s in sets[k] for y in lists[s]).items():
            if den * i >= num * (len(sets[k]) + len(sets[y]) - i):
                a, b = root(k), root(y)
                parent[max(a, b)] = min(a, b)
        for s in sets[k]:
            lists[s].append(k)
    return {k: (len(sets[k]), root(k)) for k in sets}


def edited(seed, n_words, n_copies):
    """A base text and near copies of it, chained and starred, around the threshold."""
    rng = np.random.default_rng(seed)
    base = [f"w{seed}_{rng.integers(10**6)}" for _ in range(n_words)]
    out, last = [" ".join(base)], base
    for k in range(n_copies):
        w = list(last if k % 3 else base)
        for _ in range(rng.integers(1, 4)):
            w[rng.integers(len(w))] = f"e{rng.integers(10**6)}"
        out.append(" ".join(w))
        last = w
    return out


@pytest.mark.parametrize("n,num", [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, n, num, monkeypatch):
    texts = list(cases.TEXTS) + [t for _, t in cases.read()[:120]]
    for seed, size in enumerate((6, 7, 9, 12, 15, 20, 24, 30, 60, 150)):
        texts += edited(seed, size, 9)
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{cases.prose(100 + i, 25)} {passage} {cases.prose(200 + i, 20)}" for i in range(40)]  # a passage in many texts
    monkeypatch.setattr(ngram_join, "LONG_LIST", 4)
    monkeypatch.setattr(ngram_join, "PAIRS_PER_ENTRY", 0.01)
    got = ngram_join.components(cases.clashing(cases.frame(spark, texts), "n", "cls"), n, ngram_join.Threshold(num, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(list(enumerate(texts)), n, num, 100)
    assert len(got) == len(texts)


def test_components_of_nothing(spark):
    assert ngram_join.components(cases.frame(spark).limit(0)).count() == 0
    assert {r.component_id for r in ngram_join.components(cases.frame(spark, [None, "", " "])).collect()} == {0, 1, 2}


def test_boundary_and_bounds():
    t = ngram_join.Threshold(85, 100)
    assert t.overlap(2) == 1 and t.overlap(14) == 7 and t.prefix(100) == 16 and t.least(13) == 12
    assert ngram_join.boundary({1: 10**6}, t) >= 1 and ngram_join.boundary({24: 10**6}, t) < 24 and ngram_join.boundary({}, t) == 0
    rng = np.random.default_rng(0)
    for n, m in ((5, 9), (100, 140), (3000, 700)):
        a, b = rng.integers(0, 1 << 62, n).astype(np.uint64), rng.integers(0, 1 << 62, m).astype(np.uint64)
        b[: m // 2] = a[: m // 2] if n >= m // 2 else b[: m // 2]
        real = len(set(a.tolist()) ^ set(b.tolist()))
        assert ngram_join.difference_bound(ngram_join.parity(a), ngram_join.parity(b)) <= real


def test_fingerprints(spark):
    df = cases.clashing(cases.frame(spark), "fingerprint", "bucket").repartition(5)
    got = {r.doc_id: r for r in fingerprints.fingerprint(df).collect()}
    texts, order = [t or "" for t in cases.TEXTS], list(range(len(cases.TEXTS)))[::-1]
    assert sorted(got) == sorted(order)
    for i, k in enumerate(order):
        t, after = texts[k], texts[order[(i + 1) % len(order)]]
        want = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert (got[k].n_chars, got[k].edited_sha256) == (len(t), hashlib.sha256(want.encode()).hexdigest())
        a, b = shingles(t, 5), shingles(want, 5)
        assert abs(got[k].near_edited - (len(a & b) / len(a | b) if a | b else 1)) < 0.3
    assert got[5].fingerprint == got[6].fingerprint and got[7].fingerprint == got[8].fingerprint != got[10].fingerprint
    assert fingerprints.fingerprint(df.limit(0)).count() == 0
    one = fingerprints.fingerprint(cases.frame(spark, ["a b c"])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    twice = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y")], "doc_id long, text string")
    assert fingerprints.fingerprint(twice).count() == 3


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    a, b = cases.prose(31, 120), cases.prose(32, 120)
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (None, a), (None, "alone in the world it stands here"), (7, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.components(df, 5, ngram_join.Threshold(80, 100)).collect())
    n, m = len(set(zip(*[a.lower().split()[i:] for i in range(5)]))), len(set(zip(*[b.lower().split()[i:] for i in range(5)])))
    assert got == sorted([(1, n, 1), (2, n, 1), (2, m, 2), (3, m + 1, 2), (0, n, 1), (0, 3, None), (7, 0, 7), (7, 0, 7)], key=lambda r: (r[0], r[1]))
    import corpus_pipeline
    docs = df.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted([(1, a), (2, b), (0, "alone in the world it stands here"), (7, ""), (7, "")])


def test_successors_with_many_partitions(spark):
    texts = [cases.prose(i, 20) for i in range(40)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        rows = fingerprints.with_successors(cases.frame(spark, texts)).select("bucket", "edge", "doc_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    follows = {}
    for bucket in {r.bucket for r in rows}:
        own = [r for r in rows if r.bucket == bucket]
        own = [r.doc_id for r in sorted(own, key=lambda r: (r.edge, -r.doc_id))]
        follows |= dict(zip(own, own[1:]))
    assert follows == {i: (i - 1) % 40 for i in range(40)}


def test_band_classes_are_the_verified_components(spark):
    texts = list(cases.TEXTS) + [t for s, n in enumerate((8, 30, 60, 150)) for t in edited(s, n, 9)]
    want = brute_components(list(enumerate(texts)), 5, 80, 100)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in fingerprints.near_duplicates(cases.frame(spark, texts)).collect()}
    assert len(got) == len(texts) and sum(got[k] == want[k] for k in want) >= 0.98 * len(want)
    assert all(want[got[k][1]][1] == want[k][1] for k in want)  # nothing unlike is put together
    assert fingerprints.near_duplicates(cases.frame(spark).limit(0)).count() == 0


def test_a_crowded_band_loses_no_link(spark):
    """Pairs that meet in one crowded band alone, beside texts that are unlike them."""
    texts = [cases.prose(2000 + i, 60) for i in range(80)]
    texts += [" ".join(t.split()[:-3]) for t in texts[:20]]
    docs = cases.frame(spark, texts).repartition(3)
    band = F.substring("signature", 1, 16)  # the first of 16 bands of four values
    others = F.unhex(F.concat(*[F.sha2(F.concat_ws("-", F.lit(k), "doc_id"), 512) for k in range(4)]))
    one_band = F.concat(F.unhex(F.lit("00" * 16)), F.substring(others, 17, 240))
    rows = fingerprints.stored(fingerprints.signed_rows(docs).where(F.length(band) == 16).withColumn("signature", one_band), "signed")
    got = rows.join(fingerprints.classes(rows, docs, 16, fingerprints.NEAR), "cls").collect()
    want = brute_components(list(enumerate(texts)), 5, 80, 100)
    assert {r.doc_id: r.component_id for r in got} == {k: c for k, (_, c) in want.items()}
    assert sum(c != k for k, (_, c) in want.items()) == 20


def test_sketches_never_rule_a_link_out(spark):
    rng = np.random.default_rng(5)
    t = ngram_join.Threshold(80, 100)
    rows = []
    for n in (1, 9, 100, 130, 700, 5000):
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        for drop in {0, n // 9, n // 2}:
            b = a[: n - drop]
            rows.append((len(a), ngram_join.parity(a), len(b), ngram_join.parity(b), t.den * len(b) >= t.num * len(a)))
    df = spark.createDataFrame(rows, "na long, a binary, nb long, b binary, linked boolean").select("*", ngram_join.sketch_of("a").alias("xa"), ngram_join.sketch_of("b").alias("xb"))
    got = df.select("na", "nb", "linked", ngram_join.may_link(F.col("na"), F.col("xa"), F.col("nb"), F.col("xb"), t).alias("may")).collect()
    assert all(r.may for r in got if r.linked) and not all(r.may for r in got)


def test_sketches_of_long_unlike_sets_rule_pairs_out(spark):
    rng = np.random.default_rng(6)
    t = ngram_join.Threshold(80, 100)
    rows = [(n, ngram_join.parity(rng.integers(0, 1 << 62, n).astype(np.uint64)), m, ngram_join.parity(rng.integers(0, 1 << 62, m).astype(np.uint64)))
            for n, m in ((2000, 2000), (1800, 2100), (1000, 1030), (300, 290))]
    df = spark.createDataFrame(rows, "na long, a binary, nb long, b binary").select("*", ngram_join.sketch_of("a").alias("xa"), ngram_join.sketch_of("b").alias("xb"))
    assert not any(r.may for r in df.select(ngram_join.may_link(F.col("na"), F.col("xa"), F.col("nb"), F.col("xb"), t).alias("may")).collect())


def test_members_of_a_list_meet_several_hubs(spark):
    """Of a chain of near copies few meet a hub that is like them, so a round needs several hubs; pairs grow with members, not with their square."""
    n, seen = 120, []
    empty = ngram_join.stored(spark.createDataFrame([], "a long, b long"), "links")
    lists = ngram_join.stored(spark.createDataFrame([(k, i, 100, 0) for k in range(6) for i in range(n)], "key long, id long, n long, pos int"), "lists")

    def check(pairs):
        seen.append([(r.a, r.b) for r in pairs.collect()])
        return ngram_join.stored(pairs.where("b - a <= 40"), "linked")

    links = ngram_join.hub_round(lists, ngram_join.Links.of(empty), check, 0, ngram_join.Threshold())
    met = {i: {a + b - i for a, b in seen[0] if i in (a, b)} for i in range(n)}
    assert min(map(len, met.values())) >= ngram_join.HUBS - 1 and len(seen[0]) <= ngram_join.HUBS * n
    assert links.pairs.count() == sum(b - a <= 40 for a, b in seen[0])


def test_fingerprint_query_brings_near_copies_together(spark, tmp_path):
    from retailpot.llm.queries import QUERIES

    texts = list(cases.TEXTS) + [cases.prose(900 + i, 200) for i in range(20)]
    far = texts[20].split()
    texts.append(" ".join(far[:-1] + ["changed"]))  # near copy of 20, no neighbour of it
    rows = [*enumerate(texts), (8, "another text under an id that is taken, of its own class")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op8_fingerprints"](spark, str(tmp_path)).collect()
    want = brute_components(list(enumerate(texts)), 5, 80, 100)
    assert len(got) == len(rows) and sorted((r.doc_id, r.component_id) for r in got) == sorted([(k, c) for k, (_, c) in want.items()] + [(8, 8)])
    assert len(texts) - 1 in {r.doc_id for r in got if r.component_id == 20} and want[8][1] == 7


def test_quality_model_learns_and_scores(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.fit(*quality_model.labelled_sample(docs, labels))
    test = docs.join(labels.select("doc_id", "quality"), "doc_id").where(quality_model.held_out(F.col("doc_id")))
    rows = quality_model.score(test, model).select("score", "quality").collect()
    assert len(rows) > 30 and np.mean([(r.score >= 0.3) == (r.quality == 1) for r in rows]) >= 0.95
    odd = quality_model.score(cases.clashing(cases.frame(spark), "weights"), model).collect()
    assert len(odd) == len(cases.TEXTS) and all(0 <= r.score <= 1 for r in odd)
    assert quality_model.score(cases.frame(spark).limit(0), model).count() == 0


def test_models_without_both_labels():
    for fit in (quality_model.fit, quality_rules.fit):
        assert fit([], np.zeros(0)).bias == 0
        assert fit(["a b", "c"], np.ones(2)).bias > 0
    scorer = LinearScorer(np.ones(1 << 8, np.float32), max_words=3)  # the table of known words overflows
    assert scorer([None, "", "a b c d e f", "a a"]).tolist() == [0, 0, 1, 1]


def test_rules_base_columns(spark):
    rules = quality_rules.fit(["good text here now"] * 5 + ["### $$$ ***"] * 5, np.array([1.0] * 5 + [0.0] * 5))
    texts = [*cases.TEXTS, *[t for _, t in cases.read()]]
    got = {r.doc_id: r for r in quality_rules.judge(cases.clashing(cases.frame(spark, texts), "n_words", "kept"), rules).collect()}
    for i, t in enumerate(texts):
        w, lines = words(t), [x for x in (t or "").split("\n") if words(x)]
        runs = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        times, covered = Counter(runs), set()
        for k, x in enumerate(runs):
            if times[x] > 1:
                covered |= {k, k + 1, k + 2}
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.kept and r.base_failed)
    assert quality_rules.judge(cases.frame(spark).limit(0), rules).count() == 0


def sized(spark, n, seed=1):
    return spark.range(n).select(F.shiftrightunsigned(F.xxhash64("id"), 4).alias("g"), (16 + F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(4000)) * F.pmod("id", F.lit(7))).alias("size"))


@pytest.mark.parametrize("bits", [3, 6, 16])
def test_minimax_cuts_equal_a_walk_over_all_groups(spark, bits, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_BITS", bits)
    groups = sized(spark, 3000).cache()
    rows = sorted((r.g, r["size"]) for r in groups.collect())
    sizes, keys = [s for _, s in rows], [g for g, _ in rows]
    starts = [np.searchsorted(keys, s) for s in sharding.minimax_cuts(groups, 20)]
    parts = [sum(sizes[a:b]) for a, b in zip([0, *starts], [*starts, len(sizes)], strict=True)]
    assert max(parts) <= sharding.smallest_capacity(sizes, 20)


def test_smallest_capacity_by_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(300):
        sizes, k = rng.choice([16, 17, 30, 90, 400], rng.integers(1, 9)).tolist(), int(rng.integers(1, 5))
        best = {(0, 0): 0}
        for j in range(1, k + 1):
            for i in range(len(sizes) + 1):
                best[j, i] = min(max(best.get((j - 1, h), 10**9), sum(sizes[h:i])) for h in range(i + 1))
        c = sharding.smallest_capacity(sizes, k)
        cuts = [0, *sharding.cut_indices(sizes, k, c), len(sizes)]
        assert c == best[k, len(sizes)] == max(sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:]))


def test_shards_keep_groups_and_number_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_BLOCK", 7)
    texts = [*cases.TEXTS, *["hot"] * 40, *[t for _, t in cases.read()]]
    df = cases.clashing(cases.frame(spark, texts), "slot")
    slim = df.select("doc_id", sharding.digest(F.col("text")).alias("g"), (F.octet_length(F.coalesce("text", F.lit(""))) + 16).alias("size"), F.lit(1).alias("shard"))
    rows = sharding.shard(slim, 6).collect()
    assert len(rows) == len(texts)
    by_text, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        by_text[texts[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in by_text.values()) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard(slim.limit(0), 6).count() == 0


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0


def base_spans(t):
    out = []
    for k, p in BASE:
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if k == "email" or k == "ip" and max(map(int, m[0].split("."))) <= 255 or k == "card" and 16 <= len(d) <= 19 and luhn(d) or k == "phone" and 8 <= len(d) <= 15:
                out.append((k, m.start(), m.end()))
    return out


def test_pii_base_spans_and_redaction(spark):
    texts = [*cases.TEXTS, "a@b.c_d@e.f, x@y.z.", "é👍 1.2.3.4.5.6.7.8 0255.00.1.2 256.1.1.1", "4111-1111 1111 1111", "4111 1111 1111 1111 1", "++12345678 +1-2-3-4-5-6-7-8-9)",
             "tel 555-123-4567", "1" * 20_000, "a.b+c%d@x-y.co.uk@z.a", "1.2.3.4" * 300, *[t for _, t in cases.read()]]
    model = pii.Trees([(2, 9.5, -1.0, 1.0)], [1.0], [2.0, 2.0, 2.0, 0.5])  # adds numbers of ten digits or more as phones
    df = cases.clashing(cases.frame(spark, texts), "base", "hit")
    got = pii.find(df, model).select("doc_id", "text", pii.spelled(F.col("base")).alias("b"), "spans", pii.redacted(F.col("text"), F.col("spans")).alias("clean")).collect()
    assert len(got) == len(texts)
    for r in got:
        want = base_spans(r.text)
        assert r.b == ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        spans = [(pii.KINDS[s.kind], s.start, s.end) for s in r.spans]
        assert set(want) <= set(spans)
        extra = sorted(set(spans) - set(want), key=lambda s: s[1])
        assert all(e[2] <= w[1] or w[2] <= e[1] for e in extra for w in want) and all(a[2] <= b[1] for a, b in zip(extra, extra[1:]))
        clean, at = "", 0
        for k, a, b in sorted(spans, key=lambda s: s[1:]):
            if a >= at:
                clean += r.text[at:a] + f"[{k.upper()}]"
            at = max(at, b)
        assert r.clean == (clean + r.text[at:] if r.text is not None else None)
    assert any("PHONE" in (r.clean or "") and "555-123-4567" in (r.text or "") for r in got)
    assert pii.find(df.limit(0), model).count() == 0


def test_pii_fit(spark):
    model = pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert model.trees and len(model.thresholds) == 4
    assert pii.fit(cases.frame(spark, ["no data here", None])) == pii.NO_TREES


def test_pii_fitted_model_adds_planted_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    planted = [("phone", "555-123-4567"), ("phone", "(415) 555-0123"), ("email", "jane.roe (at) example (dot) com"), ("ip", "10[.]0[.]0[.]1"), ("card", "4111.1111.1111.1111")]
    none = ["2024-01-15", "1234567890", "978-3-16-148410-0", "999[.]0[.]0[.]1", "4111.1111.1111.1112", "we look at this. Then we go"]
    texts = [f"you can reach them under {x} in the week" for x in [p for _, p in planted] + none]
    common = cases.frame(spark, texts[: len(planted)] * 40)  # a form that is common is found no less
    model = pii.fit(docs.unionByName(common))
    got = {r.doc_id: [(pii.KINDS[x.kind], r.text[x.start : x.end]) for x in r.spans] for r in pii.find(cases.frame(spark, texts), model).collect()}
    assert [got[i] for i in range(len(texts))] == [[p] for p in planted] + [[] for _ in none]


PAGE = ('<html><head><title>x</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></ul></nav><div class="ad">Buy this, now.</div>'
        "<article><h1>Head</h1><p><b>First, one &amp; two.<br><p>Second\n  one. To.</p></article><section id='comments'><p>Nice, thanks. Really.</p></section><footer>&copy; me.</footer></body></html>")


def test_html_text(spark):
    plain = "<body><div class='sidebar'><p>no, never.</p></div><div><h2>T</h2><p>Long text, with marks. More of it.</p><p>Short.</p></div><form>x</form></body>"
    pages = {PAGE: "Head First, one & two. Second one. To.", plain: "T Long text, with marks. More of it. Short.", "": "", None: "", "just text": "just text", "<p>a<b>b</b>c": "abc",
             "<div class=ad>x</div>": "", "<ul><li>a<li>b</ul><!-- open": "a b", "<p" * 500: "<p" * 500, "<p>" + "word. " * 20_000: ("word. " * 20_000).strip()}
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").withColumn("url", F.lit("u")).withColumn("text", F.lit("mine"))
    got = html_text.extract(df).orderBy("page_id").collect()
    assert [r.text for r in got] == list(pages.values()) and [r.n_chars for r in got] == [len(t) for t in pages.values()]
    assert html_text.extract(df.limit(0)).count() == 0


STORY = [f"Paragraph {i} tells a good deal of the story, with marks, and goes on. It has a second sentence, too, and a third. Here it is." for i in range(6)]
PARAGRAPHS = "".join(f"<p>{p}</p>" for p in STORY)
CARD = '<article class="card"><h3>Other story</h3><p>Read it here.</p></article>'


@pytest.mark.parametrize("body", [
    f"<div><div>Home</div><div>News</div></div><div><h1>Title</h1>{PARAGRAPHS}</div>",                      # no article at all
    f"<div><h1>Title</h1>{PARAGRAPHS}</div><div>{CARD * 5}</div>",                                          # teasers are the articles
    f"<div><h1>Title</h1>{PARAGRAPHS}</div>{CARD * 5}",
    f"<main><div><h1>Title</h1>{PARAGRAPHS}</div><div><h3>More</h3><ul><li>One</li><li>Two</li></ul></div></main>",  # boxes without a label
    f"<main><div><p>Just in</p></div><h1>Title</h1>{PARAGRAPHS}<div><p>Get it now.</p></div></main>",
])
def test_path_ratios_select_the_story(body):
    assert html_text.main_text(f"<html><body><nav>Menu</nav>{body}</body></html>") == "Title " + " ".join(STORY)


@pytest.mark.parametrize("before,after", [
    ('<div id="page" class="site right-sidebar">', "</div>"), ('<div class="content no-comments">', "</div>"),
    ('<section class="post share-enabled">', "</section>"), ("<form action=x>", "</form>"),
    ('<form><div class="site right-sidebar"><div class="ad">Buy now, cheap.</div>', '<div class="comments"><p>Nice, thanks.</p></div></div></form>'),
    ('<div class="content no-comments">', '</div><div class="comments">' + "<p>So it is, thanks. Yes.</p>" * 60 + "</div>"),
    ('<div class="cookie"><p>We use cookies, as all do. ' + "You can say no, but you will not. " * 10 + '</p></div><div class="no-sidebar">', "</div>"),
])
def test_words_of_a_wrapper_do_not_lose_the_article(before, after):
    assert html_text.main_text(f"<html><body><nav>Menu</nav>{before}<h1>Title</h1>{PARAGRAPHS}{after}</body></html>") == "Title " + " ".join(STORY)


def test_short_articles_link_lists_and_formulas():
    links = "<ul>" + "".join(f"<li><a href=x>Link {i}</a></li>" for i in range(8)) + "</ul>"
    story = f"<h1>Head</h1><p>{STORY[0]}</p><p>{STORY[1]}</p>"
    want = " ".join(["Head", *STORY[:2]])
    notice = "<div><p>We use cookies, as all do. By staying here, you agree to them. Read more, or leave; it is up to you.</p></div>"
    text = html_text.main_text
    assert text(f"<html><body><article><h1>Recipe</h1><ul><li>egg, two</li><li>flour</li></ul><p>Mix.</p></article>{notice}</body></html>") == "Recipe egg, two flour Mix."
    assert text(f"<html><body><div>{links}{story}</div></body></html>") == want
    assert text(f"<html><body><div>{story}{links}</div></body></html>") == want
    inner = f'<p>{STORY[0]} <a href="y">See this page, and that</a>.</p>'
    assert text(f"<html><body><div><h1>Head</h1>{inner}<p>{STORY[1]}</p></div></body></html>") == f"Head {STORY[0]} See this page, and that. {STORY[1]}"
    assert text("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be given, so that it holds.</p>") == "Let x=2 be given, so that it holds."
    cards = "".join(f'<article class="card"><h3>More {i}</h3><p>Teaser {i}, short.</p></article>' for i in range(3))
    assert text(f"<html><body><div>{story}<p>{STORY[0]}</p></div><div>{cards}</div></body></html>").startswith(want)


def test_long_pages_take_linear_time():
    import time

    def seconds(page):
        t = time.process_time()
        html_text.main_text(page)
        return time.process_time() - t

    def commented(n):
        return f"<html><body><article><h1>T</h1><p>{STORY[0]}</p></article><div id=comments>" + "".join(f'<div class="comment"><p>Comment {i}, nice.</p></div>' for i in range(n)) + "</div></body></html>"

    assert html_text.main_text(commented(3000)) == f"T {STORY[0]}"
    assert seconds(commented(20_000)) < 5 and seconds("<div>" * 4000 + "text" + "</div>" * 4000) < 2 and seconds("<p>a" + "<button>b " * 20_000) < 3


def test_pages_give_back_their_documents(spark):
    docs = {" ".join((t or "").split()) for _, t in cases.read("sf0.01")}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    heads = {r.page_id: " ".join(re.search("<h1>(.*?)</h1>", r.html)[1].split()) for r in pages.collect()}
    import html

    hits = [r.text.removeprefix(html.unescape(heads[r.page_id])).strip() in docs for r in html_text.extract(pages).collect()]
    assert np.mean(hits) == 1


def test_entries_become_rows_only_where_they_are_shared(spark, monkeypatch):
    """Counts and lists of shingles come from one shuffle of packed columns each: no row an entry, no join of the entries with their counts."""
    monkeypatch.setattr(ngram_join, "HELD", 7)
    rng = np.random.default_rng(4)
    hot = [-(1 << 62), -5, 3, 1 << 62]
    sets = [(i, 100 + i % 3, [*hot[: i % 5], *rng.integers(-(1 << 63), (1 << 63) - 1, 3).tolist()]) for i in range(40)]
    heavy = spark.createDataFrame(sets, "id long, n long, prefix array<long>").repartition(3)
    by_key = {}
    for i, n, prefix in sets:
        for pos, key in enumerate(prefix):
            by_key.setdefault(key, []).append((key, i, n, pos))
    lists = ngram_join.shared_lists(heavy)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "Join" not in plan and "Generate" not in plan
    assert sorted(map(tuple, lists.collect())) == sorted(r for rows in by_key.values() if len(rows) > 1 for r in rows)
    assert sorted(map(tuple, ngram_join.listed_counts(heavy, 16).collect())) == sorted((k, len(r)) for k, r in by_key.items() if len(r) > 16)
    assert ngram_join.shared_lists(heavy.limit(0)).count() == 0 and ngram_join.listed_counts(heavy.limit(0), 0).count() == 0


def test_sets_of_a_chunk_equal_sets_one_by_one():
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcDE"), n)).encode() for n in (0, 1, 2, 3, 4, 5, 9, 0, 60, 300, 2)]
    for width in (1, 4):
        sets = ngram_join.Sets.of(texts, width)
        words = [t.decode().lower().split() for t in texts]
        runs = [{tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set() for w in words]
        assert sets.at.tolist() == [i for i, r in enumerate(runs) if r] and sets.n.tolist() == [len(r) for r in runs if r]
        alone = [ngram_join.Sets.of([texts[i]], width) for i in sets.at]
        for i, (h, one) in enumerate(zip(np.split(sets.h, sets.begin[1:]), alone, strict=True)):
            assert np.array_equal(h, one.h) and (np.diff(h.view(np.uint64)) > 0).all()
            assert sets.classes()[i] == one.classes()[0] and ngram_join.parities(sets.h, sets.begin, sets.n)[i] == ngram_join.parity(h)
            assert len(ngram_join.parity(h)) == ngram_join.bitmap_bytes(len(h))
    often = ngram_join.Frequent.of(np.sort(sets.h)[::3], np.arange(len(sets.h[::3]), dtype=np.int8))
    want = dict(zip(often.keys.tolist(), often.levels.tolist(), strict=True))
    assert often.level(sets.h).tolist() == [want.get(x, 0) for x in sets.h.tolist()]
