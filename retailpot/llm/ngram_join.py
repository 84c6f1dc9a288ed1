"""Size-aware heavy-light Jaccard join on word n-gram sets, answered as components.

A set is the distinct n-word shingles of a text (a shorter text is one shingle; a text without words is empty and links with nothing). Two
sets link when ``den * intersection >= num * union``. Equal sets are one class and enter the join once.

* **Light sets** (size at most the boundary) enumerate subsets: sets of sizes a and b link exactly when they share a subset of the least
  overlap c(a + b), so each emits a signature per c-subset and partner size, and equal signatures are links without a comparison.
* **Heavy sets** scan inverted lists. Under one global order of shingles (rare before frequent, then by hash) two linked sets share one of
  their first n - ceil(t n) + 1 shingles, so only those are listed. Frequent are at first the shingles with long lists and those that documents would list in their place; once near copies have merged, those
  whose lists still span many components join them, and sets are ordered again until the lists of the other shingles are short. All counts cover all sets.
* **Boundary**: the size that makes signatures plus list work least for the size histogram of the data.

Lists are answered hub by hub: each list's members are compared with one of them, components merge, and lists inside one component are
done. Once few pairs across components are left, all of them are compared. So a group of thousands of near copies costs about one comparison
each, and no link between components is missed. A list proposes a pair only if what follows the shingle in both orders leaves room for the
overlap, which the list of their first common shingle always does for linked sets. A pair is then held against an exact lower bound of its symmetric difference (parity bitmaps),
then both whole shingle sets are intersected.
"""

from __future__ import annotations

from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from retailpot.llm.common import released, stored
from retailpot.llm.words import Words, chunks, distinct_per_doc, mix, shingle_hashes
from retailpot.operators.clusters import connected_components

LIGHT_LIMIT = 24        # sizes among which the boundary is looked for
POSTING_COST = 4.0      # work of one list entry in signatures (counting, joining, its share of comparisons)
LONG_LIST = 64          # components in its list from which a shingle counts as frequent
PAIRS_PER_ENTRY = 2     # pairs left to compare, per list entry, that end the search for frequent shingles and the hub rounds
SKETCH = 16             # longs of a sketch at most (1,024 bits)
FREQUENT_BITS = 20      # at most 2 ** this many frequent shingles are told apart
FILTER_BITS = 23        # bits of the document filter before an exact join
WIDE = 3                # prefixes' worth of shingles that are counted where frequent ones will move back
HUB_ROUNDS = 4
HUBS = 4                # hubs of a list, and hubs that a member is compared with, in a round
GAIN = 0.75             # share of the pairs left that a further round must leave at most for another one to follow
MERGED = 0.01           # share by which a hub round must add to the links for another one to follow while frequent shingles are looked for
LINK_BLOCK = 500_000    # links that one task merges
BUCKET_BITS = 10        # entries with equal keys meet in one of 2 ** this many groups
HELD = 1 << 18          # entries that a task puts in order at once
_U = np.uint64


class Threshold(NamedTuple):
    num: int = 85
    den: int = 100

    def least(self, n: int) -> int:
        """Least size of a partner, and least overlap with any partner."""
        return -(-self.num * n // self.den)

    def most(self, n: int) -> int:
        return self.den * n // self.num

    def overlap(self, total: int) -> int:
        """Least overlap of two linked sets whose sizes add up to ``total``."""
        return -(-self.num * total // (self.num + self.den))

    def prefix(self, n):
        return n - -(-self.num * n // self.den) + 1


def light_cost(n: int, t: Threshold) -> int:
    return sum(comb(n, c) for m in range(max(1, t.least(n)), t.most(n) + 1) if (c := t.overlap(n + m)) <= min(n, m))


def boundary(sizes: dict[int, int], t: Threshold) -> int:
    """Largest light size: the cut of the size histogram (sizes to ``LIGHT_LIMIT``) with the least work."""
    light = [0.0] + [sizes.get(n, 0) * light_cost(n, t) for n in range(1, LIGHT_LIMIT + 1)]
    heavy = [0.0] + [sizes.get(n, 0) * t.prefix(n) * POSTING_COST for n in range(1, LIGHT_LIMIT + 1)]
    work = [sum(light[: b + 1]) + sum(heavy[b + 1 :]) for b in range(LIGHT_LIMIT + 1)]
    return min(range(LIGHT_LIMIT + 1), key=lambda b: (work[b], b))


def bitmap_bytes(n: int) -> int:
    """Bytes of a set's parity bitmap: a power of two with one to two bits per element, so that bitmaps fold onto each other."""
    return max(16, 1 << max(0, int(n - 1).bit_length() - 3))


def parities(h: np.ndarray, begin: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Parity bitmaps of the sets of ``n`` hashes each that lie in ``h`` from ``begin`` on."""
    size = np.maximum(16, 1 << np.maximum(0, np.frexp(n - 1.0)[1] - 3).astype(np.int64))  # bitmap_bytes
    end = np.cumsum(size)
    at = ((mix(h) >> _U(3)).astype(np.int64) & np.repeat(size * 8 - 1, n)) + np.repeat((end - size) * 8, n)
    bits = np.packbits((np.bincount(at, minlength=int(size.sum()) * 8) & 1).astype(np.uint8)).tobytes()
    return [bits[e - k : e] for e, k in zip(end.tolist(), size.tolist(), strict=True)]


def parity(h: np.ndarray) -> bytes:
    return parities(h, np.zeros(1, np.int64), np.array([len(h)]))[0]


def difference_bound(a: bytes, b: bytes) -> int:
    """Lower bound of the symmetric difference of two sets from their bitmaps; the longer one is folded to the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    return int(np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, size), 0) ^ np.bitwise_xor.reduce(y.reshape(-1, size), 0)).sum())


@F.pandas_udf(ArrayType(LongType()))
def sketch_of(bits: pd.Series) -> pd.Series:
    """Parity bitmaps folded to ``SKETCH`` longs at most: a lower bound of the symmetric difference that a join's condition can read."""
    longs = [np.frombuffer(b, np.int64) for b in bits]
    return pd.Series([np.bitwise_xor.reduce(x.reshape(-1, min(len(x), SKETCH)), 0) for x in longs])


def _halved(x: Column) -> Column:
    half = (F.size(x) / 2).cast("int")
    return F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))


def may_link(na: Column, xa: Column, nb: Column, xb: Column, t: Threshold) -> Column:
    """Whether the sketches ``xa`` and ``xb`` of sets of sizes ``na`` and ``nb`` leave room for a link; never false for linked sets.

    Lengths are powers of two; the longer sketch is folded once. Sketches that still differ in length rule nothing out.
    """
    longer = F.size(xa) - F.size(xb)
    x, y = F.when(longer > 0, _halved(xa)).otherwise(xa), F.when(longer < 0, _halved(xb)).otherwise(xb)
    apart = F.aggregate(F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda s, k: s + k)
    return F.coalesce(apart, F.lit(0)) * (t.num + t.den) <= (t.den - t.num) * (na + nb)


def classes_of(h: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Digests of the sets of ``n`` distinct hashes each that lie in ``h`` from ``begin`` on."""
    return mix(np.add.reduceat(mix(h + np.repeat(n.astype(np.uint64), n)), begin)).view(np.int64) if len(h) else np.zeros(0, np.int64)


SETS = "doc_id long, text_hash long, n long, cls long, prefix array<long>, elements array<long>, bits binary"


class Sets(NamedTuple):
    """Shingle sets of a chunk of texts: the place of each text with words, its number of shingles, and the sorted distinct hashes from ``begin`` on."""

    at: np.ndarray
    n: np.ndarray
    begin: np.ndarray
    h: np.ndarray

    @staticmethod
    def of(texts: list[bytes], width: int) -> Sets:
        doc, h = distinct_per_doc(*shingle_hashes(Words(texts, lower=True), width))
        begin = np.flatnonzero(np.diff(doc, prepend=-1))
        return Sets(doc[begin], np.diff(begin, append=len(h)), begin, h)

    def classes(self) -> np.ndarray:
        return classes_of(self.h, self.begin, self.n)

    def first(self, k: np.ndarray) -> np.ndarray:
        """Marks the first ``k`` hashes of each set."""
        return np.arange(len(self.h)) < np.repeat(self.begin + k, self.n)


def _lists(values: np.ndarray, sizes: np.ndarray, some: np.ndarray | None = None) -> pa.ListArray:
    """Lists of longs of the given sizes; null where ``some`` is false."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64)), mask=None if some is None else pa.array(~some))


def _chunked_sets(texts: list, width: int):
    """Chunk by chunk: the first text's index, the number of texts and their ``Sets``."""
    for first, part in chunks(texts):
        yield first, len(part), Sets.of(part, width)


def document_sets(docs: DataFrame, width: int, t: Threshold) -> DataFrame:
    """``SETS``: hash of the text, size, class (digest of the set), first shingles in hash order, all shingles of a light set, parity bitmap. Empty sets have size 0."""

    def run(batches):
        for b in batches:
            for first, many, sets in _chunked_sets(b["text"].to_pylist(), width):
                n, cls, bits = np.zeros(many, np.int64), np.zeros(many, np.int64), [None] * many
                n[sets.at], cls[sets.at] = sets.n, sets.classes()
                for i, x in zip(sets.at.tolist(), parities(sets.h, sets.begin, sets.n), strict=True):
                    bits[i] = x
                some, light = n > 0, (n > 0) & (n <= LIGHT_LIMIT)
                prefix = np.where(some, t.prefix(n), 0)
                yield pa.RecordBatch.from_arrays([
                    *[b[c].slice(first, many) for c in ("doc_id", "text_hash")], pa.array(n), pa.array(cls),
                    _lists(sets.h[sets.first(prefix[sets.at])], prefix, some), _lists(sets.h[np.repeat(light[sets.at], sets.n)], np.where(light, n, 0), light),
                    pa.array(bits, pa.binary())], ["doc_id", "text_hash", "n", "cls", "prefix", "elements", "bits"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, SETS)


class Frequent(NamedTuple):
    """Sorted hashes of frequent shingles and their levels; ``some`` tells by its first bits that a hash is none."""

    keys: np.ndarray
    levels: np.ndarray
    some: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, levels: np.ndarray) -> Frequent:
        some = np.zeros(1 << 22, bool)
        some[(keys >> _U(42)).astype(np.int64)] = True
        return Frequent(keys, levels, some)

    def level(self, h: np.ndarray) -> np.ndarray:
        """Level of each hash, 0 where it is not frequent."""
        out = np.zeros(len(h), np.int8)
        maybe = np.flatnonzero(self.some[(h >> _U(42)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == h[maybe]
        out[maybe[hit]] = self.levels[at[hit]]
        return out


def reordered_prefixes(docs: DataFrame, width: int, t: Threshold, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(id, prefix): classes whose first shingles change when ``frequent`` (sorted hashes, levels) come last, by level, once a document."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most 2 ** FREQUENT_BITS shingles a round

    def run(batches):
        often = Frequent.of(*shared.value)
        for b in batches:
            for _, _, sets in _chunked_sets(b["text"].to_pylist(), width):
                level, p = often.level(sets.h), t.prefix(sets.n)
                moved = np.flatnonzero(np.add.reduceat(sets.first(p) & (level > 0), sets.begin)) if len(sets.h) else np.zeros(0, int)
                out = [np.zeros(0, np.uint64)]
                for i in moved.tolist():
                    begin, end = sets.begin[i], sets.begin[i] + sets.n[i]
                    out.append(sets.h[begin:end][np.argsort(level[begin:end], kind="stable")[: p[i]]])
                yield pa.RecordBatch.from_arrays([pa.array(sets.classes()[moved]), _lists(np.concatenate(out), p[moved])], ["id", "prefix"])

    return docs.select("text").mapInArrow(run, "id long, prefix array<long>")


def _dealt(entries, columns: dict[str, type], ordered):
    """Rows (bucket, a blob per column) of ``entries``, batches of arrays of which the first holds keys; ``ordered`` puts many of them in the order of their keys."""
    names, held, size = ["bucket", *columns], [], 0

    def flush():
        arrays = ordered(*[np.concatenate(x) for x in zip(*held, strict=True)])
        cuts = np.searchsorted(arrays[0] >> _U(64 - BUCKET_BITS), np.arange((1 << BUCKET_BITS) + 1, dtype=np.uint64))
        some = np.flatnonzero(np.diff(cuts))
        blobs = [[a[i:j].tobytes() for i, j in zip(cuts[some].tolist(), cuts[some + 1].tolist(), strict=True)]
                 for a in (x.astype(kind, copy=False) for x, kind in zip(arrays, columns.values(), strict=True))]
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(x, pa.binary()) for x in blobs]], names)

    for arrays in entries:
        held.append(arrays)
        size += len(arrays[0])
        if size >= HELD:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def _met(dealt: DataFrame, columns: dict[str, type], answer, schema: str) -> DataFrame:
    """What ``answer`` makes of the entries of each bucket, given in the order of their keys beside the places where a new key begins."""

    def run(table: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(b"".join(table[c].to_pylist()), kind) for c, kind in columns.items()]
        order = np.argsort(arrays[0])
        arrays = [a[order] for a in arrays]
        return answer(np.flatnonzero(np.diff(arrays[0], prepend=~arrays[0][:1])), *arrays)

    return dealt.groupBy("bucket").applyInArrow(run, schema)


COUNTED = {"key": np.uint64, "k": np.int64}


def _counted(keys) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _many(dealt: DataFrame, least: int) -> DataFrame:
    """(key, k) of the keys that occur more than ``least`` times."""

    def answer(begin, key, k):
        total = np.add.reduceat(k, begin)
        return pa.table({"key": key[begin][total > least].view(np.int64), "k": total[total > least]})

    return _met(dealt, COUNTED, answer, "key long, k long")


DEALT = "bucket int, " + ", ".join(f"{c} binary" for c in COUNTED)


def wide_counts(docs: DataFrame, width: int, t: Threshold, frequent: np.ndarray, least: int) -> DataFrame:
    """(key, k): shingles that occur more than ``least`` times among the first ``WIDE`` prefixes' worth of the documents that list a ``frequent`` one (sorted hashes).

    When frequent shingles move back, a document lists what comes next; these counts tell beforehand which of that is frequent too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most 2 ** FREQUENT_BITS shingles

    def run(batches):
        often = Frequent.of(shared.value, np.ones(len(shared.value), np.int8))

        def entries():
            for b in batches:
                for _, _, sets in _chunked_sets(b["text"].to_pylist(), width):
                    if len(sets.h):
                        p = t.prefix(sets.n)
                        listing = np.add.reduceat(sets.first(p) & (often.level(sets.h) > 0), sets.begin) > 0
                        yield (sets.h[sets.first(np.where(listing, WIDE * p, 0))],)

        yield from _dealt(entries(), COUNTED, _counted)

    return _many(docs.select("text").mapInArrow(run, DEALT), least)


def listed_counts(heavy: DataFrame, least: int) -> DataFrame:
    """(key, k): shingles that more than ``least`` of the sets ``heavy`` (prefix) list."""

    def run(batches):
        yield from _dealt(((b["prefix"].flatten().to_numpy().view(np.uint64),) for b in batches), COUNTED, _counted)

    return _many(heavy.select("prefix").mapInArrow(run, DEALT), least)


POSTINGS = {"key": np.uint64, "id": np.int64, "n": np.int64, "pos": np.int32}


def shared_lists(heavy: DataFrame) -> DataFrame:
    """(key, id, n, pos): the sets ``heavy`` (id, n, prefix) by the shingles that several of them list, and the shingle's place in each set's order.

    Most shingles are listed once. Entries travel as columns of numbers, and only the shared ones become rows.
    """

    def entries(batches):
        for b in batches:
            sizes = b["prefix"].value_lengths().to_numpy(zero_copy_only=False)
            end = np.cumsum(sizes)
            pos = np.arange(int(sizes.sum())) - np.repeat(end - sizes, sizes)
            yield b["prefix"].flatten().to_numpy().view(np.uint64), np.repeat(b["id"].to_numpy(), sizes), np.repeat(b["n"].to_numpy(), sizes), pos

    def ordered(*arrays):
        order = np.argsort(arrays[0])
        return [a[order] for a in arrays]

    def answer(begin, key, id_, n, pos):
        size = np.diff(begin, append=len(key))
        some = np.repeat(size > 1, size)
        return pa.table({"key": key[some].view(np.int64), "id": id_[some], "n": n[some], "pos": pos[some]})

    dealt = heavy.select("id", "n", "prefix").mapInArrow(lambda batches: _dealt(entries(batches), POSTINGS, ordered), "bucket int, " + ", ".join(f"{c} binary" for c in POSTINGS))
    return _met(dealt, POSTINGS, answer, "key long, id long, n long, pos int")


def light_links(reps: DataFrame, limit: int, t: Threshold) -> DataFrame:
    """(a, b): links between light sets, each group of equal signatures tied to one member of its smaller size."""

    def run(batches):
        index: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            out = []
            for doc, elements in zip(batch["id"], batch["elements"], strict=True):
                h, n = mix(np.asarray(elements, np.int64).view(np.uint64)), len(elements)
                for m in range(max(1, t.least(n)), min(t.most(n), limit) + 1):
                    c = t.overlap(n + m)
                    if c > min(n, m):
                        continue
                    if (n, c) not in index:
                        index[n, c] = np.array(list(combinations(range(n), c)))
                    for s in mix(h[index[n, c]].sum(1, dtype=np.uint64) + _U((n + m) * 1000 + min(n, m))).view(np.int64):
                        out.append((s, doc, n <= m))
            yield pd.DataFrame(out, columns=["signature", "id", "smaller"])

    light = reps.where((F.col("n") > 0) & (F.col("n") <= limit)).select("id", "elements")
    signed = stored(light.mapInPandas(run, "signature long, id long, smaller boolean"), "signatures")
    centre = signed.groupBy("signature").agg(F.min(F.when(F.col("smaller"), F.col("id"))).alias("b"), F.count("*").alias("k")).where("b is not null and k > 1").drop("k")
    same = signed.join(centre, "signature").where("id <> b").select(F.col("id").alias("a"), "b").distinct()
    both = same.join(light.select(F.col("id").alias("a"), F.col("elements").alias("ea")), "a").join(light.select(F.col("id").alias("b"), F.col("elements").alias("eb")), "b")
    links = stored(both.where(overlap_enough("ea", "eb", F.size("ea") + F.size("eb"), t)).select("a", "b"), "links")
    released(signed)
    return links


def overlap_enough(x: str, y: str, total: Column, t: Threshold) -> Column:
    """Whether two arrays of distinct shingles, of ``total`` elements together, are linked."""
    shared = F.size(F.array_intersect(x, y))
    return t.den * shared >= t.num * (total - shared)


def filter_bits(n: int) -> int:
    """Sixteen bits for each of ``n`` ids, as a power of two; 128 MB at most, beyond which a filter lets more through."""
    return min(30, max(16, (16 * n).bit_length()))


def _filter_of(ids: DataFrame, bits: int) -> np.ndarray:
    """Bit filter over a hash of the ids."""
    at = F.pmod(F.xxhash64("id"), F.lit(1 << bits)) + 1  # bit positions count from 1
    rows = ids.select(at.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("m")).collect()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        piece = np.frombuffer(bytes(r.m), np.uint8)
        at = (r.k - 1) * len(piece)
        out[at : at + len(piece)] = piece[: len(out) - at]
    return out


def whole_sets(docs: DataFrame, reps: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, elements) of the classes ``ids``, and of whatever else the bit filter over their documents lets through.

    Texts that the filter rules out are never cut into shingles; the rest meets an exact join afterwards.
    """
    owners = reps.join(ids, "id", "left_semi").select(F.col("doc").alias("id"))
    bits = filter_bits(owners.count())
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(owners, bits))

    def run(batches):
        for b in batches:
            h = b["h"].to_numpy()
            texts = b["text"].filter(pa.array((shared.value[h >> 3] >> (h & 7)) & 1 == 1)).to_pylist()
            for _, _, sets in _chunked_sets(texts, width):
                yield pa.RecordBatch.from_arrays([pa.array(sets.classes()), _lists(sets.h, sets.n)], ["id", "elements"])

    h = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << bits))
    return docs.select("text", h.alias("h")).mapInArrow(run, "id long, elements array<long>")


def verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int, t: Threshold) -> DataFrame:
    """The linked ones among ``pairs`` (a, b) of classes, as a stored table."""

    @F.pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series, total: pd.Series) -> pd.Series:
        return pd.Series([difference_bound(a, b) * (t.num + t.den) <= (t.den - t.num) * n for a, b, n in zip(x, y, total, strict=True)], dtype=bool)

    sketch = reps.select("id", "n", "bits")
    both = (pairs.join(sketch.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa")), "a")
            .join(sketch.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb")), "b")
            .where(t.den * F.least("na", "nb") >= t.num * F.greatest("na", "nb")))
    left = stored(both.where(near("xa", "xb", F.col("na") + F.col("nb"))).select("a", "b", "na", "nb"), "candidates")
    ids = left.select(F.explode(F.array("a", "b")).alias("id"))
    sets = whole_sets(docs, reps, ids.distinct(), width)
    sets = stored(sets.join(ids.distinct(), "id", "left_semi").dropDuplicates(["id"]), "sets")
    full = left.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("ea")), "a").join(sets.select(F.col("id").alias("b"), F.col("elements").alias("eb")), "b")
    linked = stored(full.where(overlap_enough("ea", "eb", F.col("na") + F.col("nb"), t)).select("a", "b"), "linked")
    released(left, sets)
    return linked


def component_labels(pairs: DataFrame) -> DataFrame:
    """(id, label): the smallest id that each id in ``pairs`` (a, b; a stored table) reaches.

    Blocks of at most ``LINK_BLOCK`` links are merged inside a task each; what remains of several blocks, a tree edge per id and
    block, is merged by distributed label propagation. One block leaves nothing to merge.
    """

    def merge(batches):
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent.setdefault(p, p)
            return x

        for b in batches:
            for x, y in zip(b["a"].tolist(), b["b"].tolist(), strict=True):
                x, y = root(x), root(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        ids = list(parent)
        yield pd.DataFrame({"id": ids, "label": [root(x) for x in ids]}, dtype="int64")

    blocks = max(1, -(-pairs.count() // LINK_BLOCK))
    forest = stored((pairs.coalesce(1) if blocks == 1 else pairs.repartition(blocks)).mapInPandas(merge, "id long, label long"), "forest")
    if blocks == 1:
        return forest
    nodes = forest.select(F.col("id").alias("node")).distinct()
    merged = stored(connected_components(nodes, forest.where("id <> label").select(F.col("id").alias("u"), F.col("label").alias("v"))).withColumnRenamed("node", "id"), "labels")
    released(forest)
    return merged


class Links(NamedTuple):
    """Confirmed links (a, b) and the component of each linked id (id, label)."""

    pairs: DataFrame
    labels: DataFrame

    @classmethod
    def of(cls, pairs: DataFrame) -> Links:
        return cls(pairs, component_labels(pairs))

    def plus(self, pairs: DataFrame) -> Links:
        """With the stored ``pairs``; the tables of both are given up."""
        out = Links.of(stored(self.pairs.unionByName(pairs), "links"))
        released(self.pairs, self.labels, pairs)
        return out

    def on(self, lists: DataFrame) -> DataFrame:
        """``lists`` (key, id) with the component of each id."""
        return lists.join(self.labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def can_link(na: Column, pa: Column, nb: Column, pb: Column, t: Threshold) -> Column:
    """Whether two sets whose first common shingle has the places ``pa`` and ``pb`` in their orders can still overlap enough."""
    return F.least(na - pa, nb - pb) * (t.num + t.den) >= t.num * (na + nb)


def hub_round(lists: DataFrame, links: Links, check, round_: int, t: Threshold) -> Links:
    """``links`` plus confirmed ones of each list's members with a few of them, its hubs, for lists that span several components.

    A member is compared with the ``HUBS`` hubs that most of its lists name, so a round compares ``HUBS`` pairs a member at most, and a member
    that is like a third of its group only still meets one of those. What is missed across components is left to later rounds and to the
    comparison of all pairs that ends them.
    """
    now = links.on(lists)
    hubs = F.array(*[F.min_by(F.struct("id", "label", "n", "pos"), F.xxhash64("id", F.lit(HUBS * round_ + k))) for k in range(HUBS)])
    state = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.array_distinct(hubs).alias("hubs")).where("lo < hi")
    now = now.join(state.select("key", "hubs"), "key")
    open_ = F.filter("hubs", lambda h: (F.col("label") != h["label"]) & can_link(F.col("n"), F.col("pos"), h["n"], h["pos"], t))
    named = now.select("id", F.explode(F.transform(open_, lambda h: h["id"])).alias("to")).groupBy("id", "to").agg(F.count("*").alias("k"))
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("k"), F.xxhash64("to", F.lit(round_))))
    some = named.withColumn("place", place).where(F.col("place") <= HUBS)
    return links.plus(check(some.select(F.greatest("id", "to").alias("b"), F.least("id", "to").alias("a")).distinct()))


def crowded(lists: DataFrame, links: Links, least: int) -> DataFrame:
    """(key, k): lists whose members lie in ``k`` > ``least`` components."""
    return links.on(lists).select("key", "label").distinct().groupBy("key").agg(F.count("*").alias("k")).where(F.col("k") > least)


def list_links(lists: DataFrame, links: Links, check, limit: int, t: Threshold, sketches: DataFrame) -> Links:
    """``links`` plus those between members of one list that ``check`` confirms, as many as components need.

    Hub rounds go on while more than ``limit`` pairs across components are left, the last round has made them fewer by a good share and
    rounds are left; then all those pairs are compared, by their ``sketches`` (id, sketch) before they become rows.
    ``lists`` (key, id, n, pos: the set's size and the shingle's place in its order) is read several times: pass a stored table, which is given up.
    """
    before = None
    for round_ in range(1, HUB_ROUNDS + 1):
        now = links.on(lists)
        many = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
        now = stored(now.join(many, "key"), "open")
        released(lists)
        per = now.groupBy("key", "label").count().groupBy("key").agg(((F.sum("count") * F.sum("count") - F.sum(F.col("count") * F.col("count"))) / 2).alias("p"))
        across = per.agg(F.sum("p")).first()[0] or 0
        if not across:
            released(now)
            return links
        stuck = before is not None and across > GAIN * before
        before = across
        if across <= limit or stuck or round_ == HUB_ROUNDS:
            held = now.join(sketches, "id")
            x, y = (held.select("key", *[F.col(c).alias(f"{s}_{c}") for c in ("id", "label", "n", "pos", "sketch")]) for s in "ab")
            open_ = ((F.col("a_label") != F.col("b_label")) & (F.col("a_id") < F.col("b_id")) & can_link(F.col("a_n"), F.col("a_pos"), F.col("b_n"), F.col("b_pos"), t)
                     & may_link(F.col("a_n"), F.col("a_sketch"), F.col("b_n"), F.col("b_sketch"), t))
            pairs = x.join(y, "key").where(open_).select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()
            links = links.plus(check(pairs))
            released(now)
            return links
        lists = now.drop("label")
        lists.stored_at = now.stored_at
        links = hub_round(lists, links, check, round_, t)
    return links


def representatives(sets: DataFrame) -> DataFrame:
    """One row per class of equal sets: its digest as ``id`` and its smallest doc_id as ``doc``.

    Classes, not documents, are the nodes, so rows that share an id but differ in text stay apart.
    """
    reps = sets.where("n > 0").groupBy(F.col("cls").alias("id")).agg(F.min("doc_id").alias("doc"), *[F.first(c).alias(c) for c in ("n", "prefix", "elements", "bits")])
    return stored(reps.withColumn("sketch", sketch_of("bits")), "reps")


def exact_links(docs: DataFrame, reps: DataFrame, width: int, t: Threshold, links: Links | None = None) -> Links:
    """Links between the classes ``reps`` of ``docs``, as many as their components need; ``links`` are known ones, whose tables are given up."""
    limit = boundary({r.n: r["count"] for r in reps.where(F.col("n") <= LIGHT_LIMIT).groupBy("n").count().collect()}, t)
    heavy = reps.where(F.col("n") >= t.least(limit + 1)).select("id", "n", "prefix")
    light = light_links(reps, limit, t)
    links = links.plus(light) if links else Links.of(light)

    def check(pairs: DataFrame) -> DataFrame:
        return verified(pairs, reps, docs, width, t)

    entries = heavy.agg(F.sum(F.size("prefix"))).first()[0] or 0
    least = max(LONG_LIST, entries >> FREQUENT_BITS)
    found, frequent = listed_counts(heavy, least).collect(), (np.zeros(0, np.uint64), np.zeros(0, np.int8))  # at most entries / least
    if found:
        listed = np.sort(np.array([r.key for r in found], np.int64).view(np.uint64))
        found = wide_counts(docs, width, t, listed, max(least, WIDE * entries >> FREQUENT_BITS)).collect()
    lists, merging = None, True
    while True:
        new = np.array([r.key for r in found], np.int64).view(np.uint64)
        fresh = ~np.isin(new, frequent[0])
        if fresh.any():
            keys = np.concatenate((frequent[0], new[fresh]))
            levels = np.concatenate((frequent[1], np.array([int(r.k).bit_length() for r, f in zip(found, fresh, strict=True) if f], np.int8)))
            order = np.argsort(keys)
            frequent = keys[order], levels[order]
            moved = reordered_prefixes(docs, width, t, frequent).groupBy("id").agg(F.first("prefix").alias("_p"))
            before, heavy = heavy, reps.where(F.col("n") >= t.least(limit + 1)).select("id", "n", "prefix").join(moved, "id", "left")
            heavy = stored(heavy.select("id", "n", F.coalesce("_p", "prefix").alias("prefix")), "prefixes")
            released(before)
        before, lists = lists, stored(shared_lists(heavy), "lists")
        if before is not None:
            released(before)
        if merging:
            known = links.pairs.count()
            links = hub_round(lists, links, check, 0, t)
            merging = links.pairs.count() > known * (1 + MERGED)
        found = crowded(lists, links, least).collect()  # at most entries / least
        known = set(frequent[0].view(np.int64).tolist())
        if sum(r.k * r.k for r in found if r.key not in known) <= PAIRS_PER_ENTRY * entries:
            break
    released(heavy)
    return list_links(lists, links, check, PAIRS_PER_ENTRY * entries, t, reps.select("id", "sketch"))


def components(docs: DataFrame, width: int = 4, t: Threshold = Threshold()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of ``docs`` (doc_id, text), one row per input row.

    ``component_id`` is the smallest doc_id reachable over links, the row's own included. Null and empty texts have 0 shingles and stand alone.
    Repeated rows are answered each, rows that share a doc_id but differ in text each by its own text; an empty table gives an empty result;
    other columns are ignored.
    """
    return grouped(docs, width, t).select("doc_id", "n_shingles", "component_id")


def grouped(docs: DataFrame, width: int = 4, t: Threshold = Threshold()) -> DataFrame:
    """``components`` as a stored table, with ``text_hash`` (xxhash64 of the row's text) and ``group``, the component's own number (null without words)."""
    sets = stored(document_sets(docs, width, t), "sets")
    reps = representatives(sets)
    places = stored(sets.select("doc_id", "text_hash", "n", "cls"), "places")
    released(sets)
    links = exact_links(docs, reps, width, t)
    out = stored(placed(places, reps, links), "components")
    released(places, reps, *links)
    return out


def labelled(reps: DataFrame, links: Links) -> DataFrame:
    """(cls, group, component_id): the component of each class and the component's smallest doc_id."""
    own = reps.select(F.col("id").alias("cls"), "doc").join(links.labels.withColumnRenamed("id", "cls"), "cls", "left").withColumn("group", F.coalesce("label", "cls"))
    linked = own.where("label is not null").groupBy("group").agg(F.min("doc").alias("_c"))
    return own.join(linked, "group", "left").select("cls", "group", F.when(F.col("label").isNull(), F.col("doc")).otherwise(F.col("_c")).alias("component_id"))


def placed(sets: DataFrame, reps: DataFrame, links: Links) -> DataFrame:
    """(doc_id, text_hash, n_shingles, group, component_id) of every document of ``sets``."""
    out = sets.where("n > 0").join(labelled(reps, links), "cls").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "group", "component_id")
    none = sets.where("n = 0").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("group"), F.col("doc_id").alias("component_id"))
    return out.unionByName(none)
