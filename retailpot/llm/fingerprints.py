"""MinHash fingerprints of documents, their likeness, and near-duplicate classes over signature bands.

Shingles are runs of five lower-cased words; a fingerprint is the least value of each of ``PERMUTATIONS`` multiply-shift hashes over a
document's shingles, eight hex digits each. Likeness is the share of equal values, an estimate of the shingle sets' Jaccard similarity.
Texts that share a band of values are held against each other with their whole shingle sets; what is alike forms a class.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpot.llm import ngram_join
from retailpot.llm.common import released, stored
from retailpot.llm.words import Words, chunks, distinct_per_doc, mix, shingle_hashes

WIDTH = 5
PERMUTATIONS = 64
_U = np.uint64
_A = mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | _U(1)
_B = mix(np.arange(1001, PERMUTATIONS + 1001, dtype=np.uint64))
EMPTY = np.uint32(0xFFFFFFFF)


def _least(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(documents, PERMUTATIONS) least hash values of shingles ``h``, document after document from ``begin`` on."""
    return np.stack([np.minimum.reduceat(((h * _A[k] + _B[k]) >> _U(32)).astype(np.uint32), begin) for k in range(PERMUTATIONS)], 1)


def signed_sets(texts: list) -> tuple[np.ndarray, list[int], list[int], list[bytes | None]]:
    """(texts, PERMUTATIONS) least hash values, and size, class and parity bitmap of each shingle set.

    A text without words has the largest value throughout, size and class 0, and no bitmap.
    """
    out = np.full((len(texts), PERMUTATIONS), EMPTY, np.uint32)
    n, cls, bits = [0] * len(texts), [0] * len(texts), [None] * len(texts)
    for first, part in chunks(texts):
        doc, h = distinct_per_doc(*shingle_hashes(Words(part, lower=True), WIDTH))
        if not len(h):
            continue
        begin = np.flatnonzero(np.diff(doc, prepend=-1))
        rows = first + doc[begin]
        out[rows] = _least(h, begin)
        size = np.diff(begin, append=len(h))
        for i, *one in zip(rows.tolist(), size.tolist(), ngram_join.classes_of(h, begin, size).tolist(), ngram_join.parities(h, begin, size), strict=True):
            n[i], cls[i], bits[i] = one
    return out, n, cls, bits


def signatures(texts: list) -> np.ndarray:
    """(texts, PERMUTATIONS) least hash values; a text without words has the largest value throughout."""
    out = np.full((len(texts), PERMUTATIONS), EMPTY, np.uint32)
    for first, part in chunks(texts):
        doc, h = shingle_hashes(Words(part, lower=True), WIDTH)
        if not len(h):
            continue
        begin = np.flatnonzero(np.diff(doc, prepend=-1))
        out[first + doc[begin]] = _least(h, begin)
    return out


def to_bytes(sig: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in sig.astype(">u4")]


ROWS = """doc_id long, n_chars long, edited_sha256 string, signature binary, edited_signature binary, near_edited double, near_next double,
    n long, cls long, bits binary"""


def with_successors(docs: DataFrame) -> DataFrame:
    """Rows (bucket, edge, doc_id, text) partitioned by ranges of ``doc_id`` and sorted descending, each range followed by its successor as an ``edge`` row.

    The text is shuffled once. Ranges come from the ids alone, one per shuffle partition; the first row of each range is also sent to the
    end of the range before it in descending order, and the very first to the end of all. Equal ids are ordered by text.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    marks = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 10_000)).first()[0] if n > 1 else []
    marks = sorted(set(marks or []))
    bucket = F.size(F.filter(F.array(*[F.lit(m) for m in marks]), lambda m: m < F.col("doc_id"))) if marks else F.lit(0)
    docs = docs.withColumn("bucket", bucket)
    firsts = sorted(((r.bucket, r.first) for r in docs.groupBy("bucket").agg(F.max("doc_id").alias("first")).collect()), key=lambda x: x[0])  # a row per range
    after = {first: firsts[(k + 1) % len(firsts)][0] for k, (_, first) in enumerate(firsts)}
    keys = [k for k in after if k is not None]   # as many as shuffle partitions
    found = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col("doc_id")) if keys else F.lit(0)
    target = F.when(found > 0, F.get(F.array(*[F.lit(after[k]) for k in keys]), (found - 1).cast("int"))) if keys else F.lit(None).cast("int")
    if None in after:
        target = F.when(F.col("doc_id").isNull(), F.lit(after[None])).otherwise(target)
    places = F.filter(F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("edge")), F.struct(target.alias("b"), F.lit(1).alias("edge"))), lambda x: x["b"].isNotNull())
    rows = docs.select(F.explode(places).alias("p"), "doc_id", "text").select(F.col("p.b").alias("bucket"), F.col("p.edge").alias("edge"), "doc_id", "text")
    return rows.repartitionByRange(n, "bucket").sortWithinPartitions("bucket", "edge", F.desc("doc_id"), "text")


def signed_rows(docs: DataFrame) -> DataFrame:
    """``ROWS`` of ``docs`` (doc_id, text): signatures of each text and of its edited text, their likeness, and size, class and bitmap of its shingle set."""

    def run(batches):
        held = None
        for b in batches:
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            held = b.iloc[-1:]
            yield compared(b)

    def compared(b: pd.DataFrame) -> pd.DataFrame:
        text, bucket, edge = b["text"].tolist(), b["bucket"].to_numpy(), b["edge"].to_numpy()
        own = np.flatnonzero((edge[:-1] == 0) & (bucket[:-1] == bucket[1:]))
        edited = [text[i][: (len(text[i]) + 1) // 2] + text[i + 1][: len(text[i]) // 2] for i in own]
        (sig, n, cls, bits), after = signed_sets(text), signatures(edited)
        return pd.DataFrame({
            "doc_id": b["doc_id"].astype("Int64").to_numpy()[own], "n_chars": [len(text[i]) for i in own],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
            "signature": to_bytes(sig[own]), "edited_signature": to_bytes(after),
            "near_edited": (sig[own] == after).mean(1), "near_next": (sig[own] == sig[own + 1]).mean(1),
            "n": [n[i] for i in own], "cls": [cls[i] for i in own], "bits": [bits[i] for i in own]})

    return with_successors(docs).mapInPandas(run, ROWS)


BANDS = 16  # of four values each: a pair at similarity 0.8 shares none with probability 2e-4
CROWDED = 16  # components in a band's list from which its members are joined on their whole sets instead
NEAR = ngram_join.Threshold(80, 100)


def _uncrowded(lists: DataFrame, links: ngram_join.Links, reps: DataFrame, docs: DataFrame, t: ngram_join.Threshold) -> tuple[DataFrame, ngram_join.Links]:
    """``lists`` without the crowded ones, and ``links`` with all that the members of those have among each other.

    A list is crowded when its members lie in many components even after a hub round: many texts with a common line, say, that are else
    unlike. Its members meet in the exact join of whole shingle sets instead, which finds every link a crowded list could propose.
    """
    full = stored(ngram_join.crowded(lists, links, CROWDED).select("key"), "crowded")
    if not full.limit(1).count():
        released(full)
        return lists, links
    members = reps.join(lists.join(full, "key", "left_semi").select("id").distinct(), "id", "left_semi")
    owners = members.select(F.col("doc").alias("_doc")).distinct()
    own = docs.select(F.col("doc_id").cast("long"), "text")
    own = stored(own.join(owners, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi"), "members")
    rest = stored(lists.join(full, "key", "left_anti"), "bands")
    released(lists, full)
    held = ngram_join.representatives(ngram_join.document_sets(own, WIDTH, t))
    links = ngram_join.exact_links(own, held, WIDTH, t, links)
    released(own, held)
    return rest, links


def classes(rows: DataFrame, docs: DataFrame, bands: int, t: ngram_join.Threshold) -> DataFrame:
    """(cls, component_id): near-duplicate classes of the shingle sets in ``rows`` (stored ``ROWS`` of ``docs``), empty ones left out.

    Sets, not ids, are the nodes: equal sets enter once, and rows that share an id but differ in text stay apart. Sets that share a band of
    their signatures meet hub by hub, members of crowded bands in the exact join, sizes and sketches rule pairs out before they are formed,
    and each pair is verified on both whole sets, which are cut anew from the texts of the pair's documents.
    """
    sets = rows.where("n > 0").groupBy(F.col("cls").alias("id"))
    reps = sets.agg(F.min("doc_id").alias("doc"), *[F.first(c).alias(c) for c in ("n", "bits")])
    reps = stored(reps.withColumn("sketch", ngram_join.sketch_of("bits")), "reps")
    width = PERMUTATIONS // bands

    def band_keys(batches):
        place = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for b in batches:
            sig = np.frombuffer(b"".join(b["signature"]), ">u4").reshape(len(b), PERMUTATIONS)[:, : width * bands].reshape(len(b), bands, width).astype(np.uint64)
            keys = np.repeat(place[None], len(b), axis=0)
            for k in range(width):
                keys = mix(keys * _U(0x9E3779B97F4A7C15) + sig[:, :, k])
            yield pd.DataFrame({"id": b["id"], "n": b["n"], "keys": list(keys.view(np.int64))})

    signed = sets.agg(F.first("n").alias("n"), F.first("signature").alias("signature"))
    keys = signed.mapInPandas(band_keys, "id long, n long, keys array<long>")
    lists = keys.select("id", "n", F.explode("keys").alias("k")).select(F.xxhash64("k").alias("key"), "id", "n", F.lit(0).alias("pos"))
    every = stored(lists, "entries")
    lists = stored(every.join(every.groupBy("key").count().where("count > 1").select("key"), "key"), "bands")
    released(every)
    links = ngram_join.Links.of(stored(docs.sparkSession.createDataFrame([], "a long, b long"), "links"))

    def check(pairs: DataFrame) -> DataFrame:
        return ngram_join.verified(pairs, reps, docs, WIDTH, t)

    links = ngram_join.hub_round(lists, links, check, 0, t)  # bands have no order, so only sizes bound the overlap (pos is 0)
    lists, links = _uncrowded(lists, links, reps, docs, t)
    links = ngram_join.list_links(lists, links, check, ngram_join.PAIRS_PER_ENTRY * lists.count(), t, reps.select("id", "sketch"))
    out = stored(ngram_join.labelled(reps, links).drop("group"), "classes")
    released(reps, *links)
    return out


def classed(docs: DataFrame, bands: int, t: ngram_join.Threshold) -> DataFrame:
    """``ROWS`` of ``docs`` with ``component_id``: the smallest id of the row's near-duplicate class; a text without words stands alone."""
    rows = stored(signed_rows(docs), "signed")
    full = rows.where("n > 0").join(classes(rows, docs, bands, t), "cls")
    return full.unionByName(rows.where("n = 0").withColumn("component_id", F.col("doc_id")))


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text): each text, and the same with its last half replaced by the next document's beginning; and its class.

    The last floor(n_chars / 2) code points give way to the first as many (or all) of the document with the next smaller id; the smallest
    id is followed by the largest. Null texts are empty; rows without an id come last; a repeated row is followed by its repetition;
    a single document is followed by itself. Two texts without words are wholly alike, but each is a class of its own.
    """
    spelled = [F.lower(F.hex(s)).alias(f) for s, f in (("signature", "fingerprint"), ("edited_signature", "edited_fingerprint"))]
    return classed(docs, BANDS, NEAR).select("doc_id", "n_chars", "edited_sha256", *spelled, "near_edited", "near_next", "component_id")


def near_duplicates(docs: DataFrame, bands: int = BANDS, t: ngram_join.Threshold = NEAR) -> DataFrame:
    """(doc_id, n_shingles, component_id): near-duplicate classes over documents that share a signature band and whose Jaccard similarity is verified."""
    return classed(docs, bands, t).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
