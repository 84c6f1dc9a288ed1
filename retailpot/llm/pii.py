"""Personal data in texts: fixed base patterns, plus candidate spans chosen by gradient-boosted trees. Column expressions only.

Base spans (email, ip, card, phone) come from patterns with checks and always stay. Besides, generators with high recall propose overlapping
candidates of each kind (spelled-out addresses, defanged or spaced numbers, numbers without a country code, ...). Boosted trees over format
and context features score them. They are trained on variants of base spans that no base pattern takes (plus sign or country code dropped,
dots and @ spelled out or defanged, other separators) against ids, dates, versions, book numbers, failed checks and plain prose; thresholds per
kind are calibrated on a held-out part of that bounded sample for a stated precision. The trees are compiled to one column expression, so scoring happens in the same
projection as the patterns: no join, no shuffle, no Python on the rows.

Positions: ``split`` gives the text between matches and ``regexp_extract_all`` the matches; running lengths give start and end in code points.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# Patterns of the base spans, rewritten without backtracking: a run that fails at its beginning fails at every later place in it.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Generators of candidates: wide on purpose.
WIDE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+ ?(?:@|\(at\)|\[at\]|(?<= )at(?= )) ?[A-Za-z0-9-]{{1,63}}+(?: ?(?:\.|\(dot\)|\[dot\]|(?<= )dot(?= )) ?[A-Za-z0-9-]{{2,63}}+){{1,5}}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?: ?(?:\.|\[\.\]|\(\.\)) ?[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ .-]?[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9+])[+(]?[0-9](?:[ ().-]{0,2}[0-9]){6,14}+(?![0-9])",
}
# A text without any of these marks holds no match of the kind.
MARK = {"email": "@|\\(at\\)|\\[at\\]|\\(dot\\)|\\[dot\\]| dot ", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
CONTEXT = 24             # code points ahead of a candidate that features look at
FEATURES = ("kind", "n_chars", "n_digits", "n_groups", "longest", "shortest", "spaces", "dots", "dashes", "brackets", "before", "after", "named", "secret", "checked")
SAMPLE = 8_000           # source spans that a fit reads at most
TREES, DEPTH = 8, 4
PRECISION = 0.98         # held-out share of right candidates that a threshold must reach
SPAN = "array<struct<kind:int,start:int,end:int>>"


HIT = "array<struct<kind:int,start:int,end:int,hit:string,ahead:string,after:string>>"


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """``HIT`` of the leftmost non-overlapping matches; ``ahead`` and ``after`` are what stands next to a match, up to its neighbours."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    n = F.size(hits)
    parts = F.zip_with(F.zip_with(F.slice(gaps, 1, n), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit"))), F.slice(gaps, 2, n),
                       lambda x, g: F.struct(F.length(x["gap"]).alias("gap"), x["hit"].alias("hit"), F.right(x["gap"], F.lit(CONTEXT)).alias("ahead"), F.left(g, F.lit(1)).alias("after")))
    return F.aggregate(
        parts, F.struct(F.lit(0).alias("at"), F.array().cast(HIT).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["hit"])).alias("at"),
            F.array_append(acc["out"], F.struct(F.lit(kind).alias("kind"), (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + F.length(x["hit"])).alias("end"),
                                                x["hit"].alias("hit"), x["ahead"].alias("ahead"), x["after"].alias("after"))).alias("out")),
        lambda acc: acc["out"])


def _guarded(text: Column, kind: str, patterns: dict[str, str], keep=lambda m: F.lit(True)) -> Column:
    found = F.filter(_matches(text, patterns[kind], KINDS.index(kind)), keep)
    return F.when(F.regexp_like(text, F.lit(MARK[kind])), found).otherwise(F.array().cast(HIT))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _octets_fit(m: Column) -> Column:
    """Every part is at most 255, whatever leading zeros it has."""
    return F.forall(F.split(m["hit"], r"\."), lambda p: F.regexp_like(p, F.lit(r"^0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])?$")))


_CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": _octets_fit,
    "card": lambda m: F.length(_digits(m["hit"])).between(16, 19) & F.call_function("luhn_check", _digits(m["hit"])),
    "phone": lambda m: F.length(_digits(m["hit"])).between(8, 15),
}


def base_spans(text: Column) -> Column:
    """Base spans (kind, start, end, hit) of a text that is not null, by kind, then start."""
    return F.concat(*[_guarded(text, k, BASE, _CHECKS[k]) for k in KINDS])


def _letters(c: Column) -> Column:
    """Class of one code point: none, digit, letter, blank, quote or equals sign, other."""
    return (F.when(F.coalesce(c, F.lit("")) == "", 0).when(F.regexp_like(c, F.lit("[0-9]")), 1).when(F.regexp_like(c, F.lit(r"\p{L}")), 2)
            .when(F.regexp_like(c, F.lit(r"\s")), 3).when(F.regexp_like(c, F.lit("[=\"'_]")), 4).otherwise(5))


def _passes(m: Column) -> Column:
    """Whether a candidate, however it is written, passes its kind's check; an address does when it is marked as one."""
    octets = F.filter(F.split(m["hit"], "[^0-9]+"), lambda p: p != "")
    tests = {"email": F.regexp_like(m["hit"], F.lit(r"@|[(\[]at[)\]]|[(\[]dot[)\]]| dot ")), "ip": F.forall(octets, lambda p: p.cast("int") <= 255),
             "card": _CHECKS["card"](m), "phone": _CHECKS["phone"](m)}
    return F.coalesce(reduce(lambda out, k: F.when(m["kind"] == KINDS.index(k), tests[k]).otherwise(out), KINDS, F.lit(False)), F.lit(False))


def _variants(kind: Column, hit: Column) -> Column:
    """Array of (text, label): ways to write a base span that no base pattern takes (1), and what looks like them but is none (0)."""
    d = _digits(hit)
    t = F.right(d, F.lit(10))
    a, b, c = F.substring(t, 1, 3), F.substring(t, 4, 3), F.substring(t, 7, 4)
    date = [F.concat(F.lit("20"), F.substring(t, 1, 2), F.lit(x), F.substring(t, 3, 2), F.lit(x), F.substring(t, 5, 2)) for x in "-."]
    book = F.concat(F.lit("978-"), F.substring(t, 1, 1), F.lit("-"), F.substring(t, 2, 2), F.lit("-"), F.substring(t, 4, 6), F.lit("-"), F.substring(t, 10, 1))
    few = [F.regexp_replace(hit, f"([0-9]{{1,{k}}})[0-9]*", "$1") for k in (1, 2)]  # octets of fewer digits
    number = lambda x: F.regexp_replace(x, "([0-9]{4})(?=[0-9])", "$1.")
    wrong = F.concat(F.substring(d, F.lit(1), F.length(d) - 1), F.pmod(F.right(d, F.lit(1)).cast("int") + 1, F.lit(10)).cast("string"))
    short = F.regexp_replace(hit, r"@.*?([A-Za-z0-9-]+\.[A-Za-z0-9-]+)$", "@$1")  # the host's last two labels
    dots = lambda x, at, dot: F.regexp_replace(F.regexp_replace(x, r"\.(?=[^@]*$)", dot), "@", at)
    ways = {
        "email": ([dots(x, at, dot) for x in (hit, short) for at, dot in ((" (at) ", " (dot) "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "."))],
                  [F.lit(x) for x in ("look at this. Then we", "is at home.After that", "stay at night . But no", "arrived at last. So it was", "good at sums. They", "all at once.It is")]),
        "ip": ([F.regexp_replace(y, r"\.", x) for y in (hit, *few) for x in ("[.]", "(.)", " . ")],
               [F.regexp_replace(hit, r"[0-9]+\.", x) for x in ("999[.]", "700(.)", "800 . ")] + [F.regexp_replace(y, r"\.", ". ") for y in (hit, *few)]),
        "card": ([number(d)], [number(wrong), wrong, F.regexp_replace(number(wrong), r"\.", "-"), F.regexp_replace(number(wrong), r"\.", " ")]),
        "phone": ([F.concat_ws("-", a, b, c), F.concat(F.lit("("), a, F.lit(") "), b, F.lit("-"), c), F.concat_ws(".", a, b, c), F.concat_ws(" ", a, b, c),
                   F.when(F.regexp_like(hit, F.lit("[0-9][ ().-]+[0-9]+[ ().-]+[0-9]")), F.regexp_replace(hit, r"^\+", ""))],
                  [d, t, *date, book, F.array_join(F.split(t, ""), "."), F.concat_ws("-", F.substring(t, 1, 2), F.substring(t, 3, 8)), F.concat(t, F.lit("e"))]),
    }
    arrays = [F.array(*[F.struct(v.alias("text"), F.lit(y).alias("label")) for y, vs in ((1.0, good), (0.0, bad)) for v in vs]) for good, bad in ways.values()]
    return F.get(F.array(*arrays), kind)


def _features(m: Column) -> list[Column]:
    groups = F.filter(F.split(m["hit"], "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, lambda g: F.length(g))
    ahead = F.lower(m["ahead"])
    count = lambda p: F.length(m["hit"]) - F.length(F.regexp_replace(m["hit"], p, ""))
    values = [m["kind"], F.length(m["hit"]), F.length(_digits(m["hit"])), F.size(groups), F.coalesce(F.array_max(sizes), F.lit(0)), F.coalesce(F.array_min(sizes), F.lit(0)),
              count(" "), count(r"\."), count("-"), count(r"[()\[\]]"),
              _letters(F.right(m["ahead"], F.lit(1))), _letters(m["after"]),
              F.regexp_like(ahead, F.lit("tel|phone|call|mail|contact|card|visa|addr|ip ")).cast("int"),
              F.regexp_like(ahead, F.lit("token|passw|key|secret|hash|version|isbn|order")).cast("int"), _passes(m).cast("int")]
    return [v.cast("double").alias(n) for v, n in zip(values, FEATURES, strict=True)]


def candidates(text: Column) -> Column:
    """Candidate spans (kind, start, end, f) with their features, of all generators; they may overlap each other and base spans."""
    wide = F.concat(*[_guarded(text, k, WIDE) for k in KINDS])
    return F.transform(wide, lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.array(*_features(m)).alias("f")))


class Trees(NamedTuple):
    """Nested (feature, threshold, left, right) or leaf values, with weights; the score is their weighted sum's logistic value."""

    trees: list
    weights: list[float]
    thresholds: list[float]   # per kind; above 1: none of that kind is added


NO_TREES = Trees([], [], [2.0] * len(KINDS))


def _read(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _read(node.leftChild()), _read(node.rightChild())


def _tree_column(node, f: Column) -> Column:
    if isinstance(node, float):
        return F.lit(node)
    feature, threshold, left, right = node
    return F.when(F.get(f, F.lit(feature)) <= threshold, _tree_column(left, f)).otherwise(_tree_column(right, f))


def _score(f: Column, model: Trees) -> Column:
    margin = reduce(lambda a, b: a + b, [w * _tree_column(t, f) for t, w in zip(model.trees, model.weights, strict=True)], F.lit(0.0))
    return 1 / (1 + F.exp(-2 * margin))


def labelled(docs: DataFrame, limit: int) -> DataFrame:
    """(kind, label, features, aside) of at most ``limit`` source spans of ``docs`` (text) of each label and kind alike, chosen by a hash.

    Sources are base spans, of which variants are made in their context, and candidates apart from base spans that are surely none:
    numbers that fail their kind's check, unbroken digit runs, prose with a plain "at".
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    some = docs.select(text.alias("text")).where(F.regexp_like("text", F.lit("[0-9@]|\\(at\\)|\\[at\\]| dot ")))
    wide = F.concat(*[_guarded(F.col("text"), k, WIDE) for k in KINDS])
    run = lambda m: (m["kind"] == KINDS.index("phone")) & F.regexp_like(m["hit"], F.lit("^[0-9]+$"))
    some = some.select(F.xxhash64("text").alias("h"), base_spans(F.col("text")).alias("base"), wide.alias("wide"))
    free = F.filter("wide", lambda m: (~_passes(m) | run(m)) & ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    both = F.concat(F.transform("base", lambda m: F.struct(m.alias("m"), F.lit(True).alias("source"))), F.transform(free, lambda m: F.struct(m.alias("m"), F.lit(False).alias("source"))))
    rows = some.select("h", F.explode(both).alias("x")).select("h", "x.source", "x.m")
    order = Window.partitionBy("m.kind", "source").orderBy(F.xxhash64("h", "m.start", "m.hit"), "h", "m.start")
    rows = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= max(1, limit // (2 * len(KINDS)))).drop("_n")
    rows = docs.sparkSession.createDataFrame(rows.collect(), rows.schema)  # at most ``limit`` rows
    aside = (F.pmod("h", F.lit(5)) == 0).alias("aside")
    found = rows.where("not source").select(F.col("m.kind").alias("kind"), F.lit(0.0).alias("label"), F.array(*_features(F.col("m"))).alias("f"), aside)
    made = rows.where("source").select("h", "m", F.explode(_variants(F.col("m.kind"), F.col("m.hit"))).alias("v")).where("v.text is not null")
    # what stands after a span is shown by one code point, a blank at the end of a text
    made = made.withColumn("text", F.concat("m.ahead", "v.text", F.when(F.col("m.after") == "", " ").otherwise(F.col("m.after"))))
    at, end = F.length("m.ahead"), F.length("m.ahead") + F.length("v.text")
    same, exact = (lambda c: c["kind"] == F.col("m.kind")), (lambda c: (c["start"] == at) & (c["end"] == end))
    over = lambda c: (c["start"] < end) & (at < c["end"])
    whole = F.filter(candidates(F.col("text")), lambda c: over(c) & (~same(c) | (F.col("v.label") == 0) | exact(c)))  # a part of another kind's span is none
    apart = F.filter(whole, lambda c: ~F.exists(base_spans(F.col("text")), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    made = made.select("h", "m", "v", F.explode(apart).alias("c"))
    made = made.select("c.kind", F.when(F.col("c.kind") == F.col("m.kind"), F.col("v.label")).otherwise(0.0).alias("label"), "c.f", aside)
    return found.unionByName(made).select("kind", "label", *[F.get("f", F.lit(i)).alias(n if n != "kind" else "kind_code") for i, n in enumerate(FEATURES)], "aside")


def fit(docs: DataFrame, limit: int = SAMPLE) -> Trees:
    """Trees and thresholds from ``labelled`` spans of ``docs`` (text); without both labels nothing is added to the base spans."""
    rows = labelled(docs, limit)
    sample = docs.sparkSession.createDataFrame(rows.collect(), rows.schema)  # variants of at most ``limit`` rows
    names = ["kind_code", *FEATURES[1:]]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(sample).coalesce(1).cache()
    learn = vectors.where("not aside")
    try:
        if learn.select("label").distinct().count() < 2:
            return NO_TREES
        fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=5).fit(learn)
    finally:
        vectors.unpersist()
    trees = Trees([_read(t._java_obj.rootNode()) for t in fitted.trees], [float(w) for w in fitted.treeWeights], [])
    held = sample.where("aside").select("kind", "label", _score(F.array(*names), trees).alias("s")).collect()
    return trees._replace(thresholds=[_threshold(sorted(((r.s, r.label) for r in held if r.kind == k), reverse=True)) for k in range(len(KINDS))])


def _threshold(scored: list[tuple[float, float]]) -> float:
    """Least score of at least one half down to which ``PRECISION`` of the held-out candidates are right; 2 where there is none."""
    best, right = 2.0, 0.0
    for k, (s, y) in enumerate(scored, 1):
        right += y
        if s >= 0.5 and right >= PRECISION * k and (k == len(scored) or scored[k][0] < s):
            best = s
    return best


def added_spans(text: Column, base: Column, model: Trees) -> Column:
    """Candidates above their kind's threshold that touch no base span; of overlapping ones the earliest, then the longest."""
    none = F.array().cast(SPAN)
    if not model.trees:
        return none
    least = F.array(*[F.lit(t) for t in model.thresholds])
    good = F.filter(candidates(text), lambda c: _score(c["f"], model) >= F.get(least, c["kind"]))
    event = lambda s, new: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"), F.lit(new).alias("new"))
    events = F.array_sort(F.concat(F.transform(base, lambda s: event(s, False)), F.transform(good, lambda s: event(s, True))))

    def clear(events: Column, edge: Column, reach, touches) -> Column:
        """Events without the new ones that touch a base span already passed."""
        none = F.array().cast("array<struct<start:int,back:int,kind:int,new:boolean>>")
        return F.aggregate(events, F.struct(edge.alias("edge"), none.alias("out")), lambda acc, e: F.when(e["new"] & touches(acc["edge"], e), acc).otherwise(
            F.struct(F.when(e["new"], acc["edge"]).otherwise(reach(acc["edge"], e)).alias("edge"), F.array_append(acc["out"], e).alias("out"))), lambda acc: acc["out"])

    ahead = clear(events, F.lit(-1), lambda at, e: F.greatest(at, -e["back"]), lambda at, e: e["start"] < at)
    both = clear(F.reverse(ahead), F.lit(2147483647), lambda at, e: F.least(at, e["start"]), lambda at, e: -e["back"] > at)
    order = F.filter(F.reverse(both), lambda e: e["new"])
    return F.aggregate(
        order, F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, c: F.when(c["start"] < acc["at"], acc).otherwise(F.struct((-c["back"]).alias("at"), F.array_append(
            acc["out"], F.struct(c["kind"].alias("kind"), c["start"].alias("start"), (-c["back"]).alias("end"))).alias("out"))),
        lambda acc: acc["out"])


def find(docs: DataFrame, model: Trees) -> DataFrame:
    """``docs`` with ``base`` and ``spans`` (arrays of kind, start, end by kind, then start); columns of these names give way.

    A null text is empty and has no spans; repeated rows get equal spans; an empty table stays empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.drop("base", "spans")
    out = out.withColumn("base", F.when(F.regexp_like(text, F.lit("[0-9@]")), F.transform(base_spans(text), lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))).otherwise(F.array().cast(SPAN)))
    more = F.when(F.regexp_like(text, F.lit("[0-9@]|\\(at\\)|\\[at\\]| dot ")), added_spans(text, F.col("base"), model)).otherwise(F.array().cast(SPAN))
    return out.withColumn("spans", F.array_sort(F.concat("base", more)))


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by ``[KIND]`` (the earliest span's); null stays null."""
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(order, start, lambda acc, s: F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(
        F.struct(s["end"].alias("at"), F.array_append(acc["out"], F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(marks, s["kind"]))).alias("out"))))
    return F.when(F.size(spans) <= 0, text).otherwise(F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text))))
