"""Vector code compression by ball k-means over integer parts.

Components become integers, vectors are cut into equal parts, and each part position has a codebook. A round assigns every part to the
nearest entry and then moves each entry to the componentwise floor of its parts' mean. All distances are squared integers, so every
comparison is exact.

The parts of an entry lie in a ball around it. With D the squared distance of two entries and d that of a part to its own entry, an
entry farther off than D = 4 d cannot be nearer to the part, nor tie with it. So
* only entries with D <= 4 R are neighbours of a ball of squared radius R (the others are never looked at);
* a part with 4 d below the nearest neighbour's D lies in the stable core and stays without any comparison;
* the neighbours, sorted by D, cut the rest into annular rings; a part in ring m is compared with the m nearest neighbours only;
* a ball that has not moved, with no neighbour that has, keeps its parts and their distances; one that has not moved itself is compared
  with moved neighbours only.
The radius about a moved entry is bounded by the old radius plus the move, rounded up.

Each round is one scan that writes one table below the shared folder: the parts with their codes and distances, and, as further rows, a
task's sums, counts and radii by entry, which the next round reads alone (other columns are not touched). The table before it is
deleted then. The driver holds codebooks only: entries x dimensions.
"""

from __future__ import annotations

import hashlib
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from retailpot.llm.common import removed, scratch
from retailpot.llm.vectors import Shape, floored, lists, matrix, whole

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
MAX_BROADCAST = 1 << 16   # labels whose sums are broadcast; more are joined by salted keys
SALTS = 32


class Balls(NamedTuple):
    """Entries of one part position with what is known about their balls."""

    entries: np.ndarray   # (k, width)
    moved: np.ndarray     # (k,) since the parts were assigned last
    order: list           # of each entry, its neighbours by distance, then number
    far: list             # their squared distances
    stable: np.ndarray    # (k,) neither the entry nor a neighbour has moved


def _ceil_sqrt(v: int) -> int:
    r = isqrt(v)
    return r + (r * r < v)


def balls(entries: np.ndarray, before: np.ndarray | None = None, radius: list[int] | None = None) -> Balls:
    """``before``: the entries when parts were assigned; ``radius``: squared radii about those, or None where no part has been assigned."""
    k = len(entries)
    between = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
    moved = np.ones(k, bool) if before is None else (entries != before).any(1)
    order, far = [], []
    for i in range(k):
        near = np.ones(k, bool)
        if radius is not None:
            reach = _ceil_sqrt(radius[i]) + _ceil_sqrt(int(((entries[i] - before[i]) ** 2).sum()))
            near = between[i] <= 4 * reach * reach
        near[i] = False
        index = np.flatnonzero(near)
        index = index[np.argsort(between[i][index], kind="stable")]
        order.append(index)
        far.append(between[i][index])
    stable = np.array([not moved[i] and not moved[order[i]].any() for i in range(k)], bool)
    return Balls(entries, moved, order, far, stable)


def assign(x: np.ndarray, code: np.ndarray, dist: np.ndarray, b: Balls) -> None:
    """Move the parts ``x`` to their nearest entries in place; ``dist`` holds the squared distance to the entry in ``code``."""
    was = code.copy()
    for i in range(len(b.entries)):
        if b.stable[i]:
            continue
        rows = np.flatnonzero(was == i)
        if not len(rows):
            continue
        best = ((x[rows] - b.entries[i]) ** 2).sum(1) if b.moved[i] else dist[rows]
        ring = np.searchsorted(b.far[i], 4 * best, side="right")
        at = np.full(len(rows), i, code.dtype)
        for m in range(int(ring.max())):
            j = b.order[i][m]
            if not (b.moved[i] or b.moved[j]):
                continue
            some = np.flatnonzero(ring > m)
            to = ((x[rows[some]] - b.entries[j]) ** 2).sum(1)
            nearer = (to < best[some]) | ((to == best[some]) & (j < at[some]))
            some, to = some[nearer], to[nearer]
            best[some], at[some] = to, j
        code[rows], dist[rows] = at, best


def _state(source: DataFrame, id_column: str, label: str | None) -> StructType:
    fields = [StructField("id", source.schema[id_column].dataType), StructField("label", source.schema[label].dataType if label else StringType())]
    return StructType(fields + [StructField("x", ArrayType(LongType())), StructField("code", ArrayType(IntegerType())), StructField("dist", ArrayType(LongType())),
                                StructField("part", IntegerType()), StructField("entry", IntegerType()), StructField("n", LongType()), StructField("radius", LongType()),
                                StructField("sums", ArrayType(LongType()))])


def _round(state: DataFrame, schema: StructType, books: list[Balls], length: int, first: bool) -> DataFrame:
    """Parts assigned to ``books``, and after them each task's sums by part and entry."""
    width, k = length // len(books), len(books[0].entries)

    def run(batches):
        sums, counts, radius = np.zeros((len(books), k, width), np.int64), np.zeros((len(books), k), np.int64), np.zeros((len(books), k), np.int64)
        kinds = None
        for b in batches:
            n = b.num_rows
            kinds = kinds or (b.schema.field("id").type, b.schema.field("label").type)
            x = matrix(b.column("x"), length)
            code = np.zeros((n, len(books)), np.int32) if first else matrix(b.column("code"), len(books)).copy()
            dist = np.zeros((n, len(books)), np.int64) if first else matrix(b.column("dist"), len(books)).copy()
            for p, book in enumerate(books):
                part, own, far = x[:, p * width : (p + 1) * width], code[:, p].copy(), dist[:, p].copy()
                assign(part, own, far, book)
                code[:, p], dist[:, p] = own, far
                counts[p] += np.bincount(own, minlength=k)
                np.add.at(sums[p], own, part)
                np.maximum.at(radius[p], own, far)
            none = [pa.nulls(n, pa.int32())] * 2 + [pa.nulls(n, pa.int64())] * 2 + [pa.nulls(n, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), lists(x, pa.int64()), lists(code, pa.int32()), lists(dist, pa.int64()), *none], names=schema.names)
        p, e = np.nonzero(counts)
        if len(p):
            none = [pa.nulls(len(p), kind) for kind in (*kinds, pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*none, pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]), pa.array(radius[p, e]), lists(sums[p, e], pa.int64())], names=schema.names)

    return state.mapInArrow(run, schema)


def _moved(table: DataFrame, entries: list[np.ndarray], width: int) -> tuple[list[np.ndarray], list[list[int]]]:
    """Entries at the floor of their parts' mean, and squared radii about the old ones (entries x parts rows come to the driver)."""
    total = table.where("part is not null").groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.max("radius").alias("radius"), F.array(*[F.sum(F.col("sums")[j]) for j in range(width)]).alias("sums"))
    new, radius = [e.copy() for e in entries], [[0] * len(e) for e in entries]
    for r in total.collect():
        new[r.part][r.entry] = [s // r.n for s in r.sums]
        radius[r.part][r.entry] = r.radius
    return new, radius


def _seeds(rows: DataFrame, length: int, parts: int, k: int) -> list[np.ndarray]:
    """Parts of the rows with the ``k`` smallest distinct ids, nulls last; of rows that share an id the smallest vector stands for it."""
    ids = [r.id for r in rows.select("id").where("id is not null").orderBy("id").limit(k).collect()]
    if len(set(ids)) < len(ids):
        ids = [r.id for r in rows.select("id").where("id is not null").distinct().orderBy("id").limit(k).collect()]
    own = F.col("id").isin(ids) if ids else F.lit(False)
    if len(ids) < k:
        own = own | F.col("id").isNull()
    top = sorted(((r.id is None, r.id, r.x) for r in rows.where(own).groupBy("id").agg(F.min("x").alias("x")).collect()), key=lambda r: (r[0], r[1] if not r[0] else 0))
    whole_rows = np.array([r[2] for r in top], np.int64).reshape(len(top), length)
    return np.split(whole_rows, parts, axis=1)


def digest(entries: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(v)) for part in entries for v in part.ravel()).encode()).hexdigest()


def _labelled(coded: DataFrame) -> DataFrame:
    """``label_error``: the sum of ``error`` over equal labels, nulls together."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    if sums.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        return coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("_label")), "left")
    salted = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = coded.withColumn("_s", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_s") == F.col("_salt")), "left")


def compress(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str | None = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(``id_column``, code, error, label_error, codebooks_sha256) of the rows with a whole vector, and the codebook of each part.

    Rows whose vector is null or holds null or non-finite components are left out; null ids and labels are values like others, and repeated
    rows each get their code. A codebook has as many entries as there are distinct ids, ``entries`` at most. An empty table gives an empty
    result and no entries; other columns are ignored. Vectors must have one length, a multiple of ``parts``, and components small enough
    for exact sums of squares in 63 bits; else ValueError.
    """
    spark = rows.sparkSession
    picked = rows.where(whole(F.col(vector))).select(F.col(id_column).alias("id"), (F.col(label) if label else F.lit(None).cast("string")).alias("label"),
                                                     floored(F.col(vector), scale).alias("x"))
    shape = Shape(picked, "x")
    if shape.length % parts:
        raise ValueError(f"{shape.length} components do not make {parts} equal parts")
    if (2 * shape.top) ** 2 * max(1, shape.length) >= 1 << 60:  # four times a squared distance is compared
        raise ValueError(f"components up to {shape.top} are too large for exact distances")
    schema, width = _state(rows, id_column, label), shape.length // parts
    books = _seeds(picked, shape.length, parts, entries) if shape.n else []
    code = F.lower(F.array_join(F.transform("code", lambda c: F.lpad(F.hex(c), 2, "0")), "")) if shape.n else F.lit("")
    error = F.aggregate("dist", F.lit(0).cast("long"), lambda a, d: a + d)
    if not shape.n:
        none = picked.limit(0).select(F.col("id").alias(id_column), code.alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")])
        return none.withColumn("codebooks_sha256", F.lit(digest([]))), []
    state, known, before = picked, [balls(b) for b in books], None
    for r in range(rounds + 1):
        path = scratch(spark, "vector_codes")
        _round(state, schema, known, shape.length, not r).write.parquet(path)
        table = spark.read.schema(schema).parquet(path)
        if before:
            removed(spark, before)
        if r < rounds:
            old = books
            books, radius = _moved(table, old, width)
            known = [balls(*p) for p in zip(books, old, radius, strict=True)]
        state, before = table.where("part is null").select("id", "label", "x", "code", "dist"), path
    coded = state.select("id", "label", code.alias("code"), error.alias("error"))
    out = _labelled(coded).select(F.col("id").alias(id_column), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
    return out, books
