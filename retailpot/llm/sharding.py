"""Shards of near-equal size by minimax contiguous partition over ordered atomic groups.

Groups (equal texts) are ordered by a 60-bit digest. A binary search finds the smallest shard capacity for which a greedy walk over
the ordered group sizes needs at most ``n_shards`` shards; the cuts go where that capacity allows, as near the even split as possible.
A group larger than an even share gets a shard of its own first, so that it doesn't raise every other shard's capacity.

The walk needs single groups only near its cuts. Sizes are first summed by leading digest bits (at most 2 ** 16 rows come to the driver,
however many groups there are); bounds on the capacity bound where each cut can lie, and only ranges in which one can lie are split
further, until those are single groups. The capacity is the one a walk over all groups would find. Only DataFrame functions touch rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailpot.llm.common import stored

DIGEST_BITS = 60
RANGE_BITS = 16        # one summary that the driver reads has at most 2 ** RANGE_BITS rows
SLOT_BLOCK = 500_000   # rows in one numbering block (all shards together)


def _walk(ends: list[int], capacity: int, n_shards: int) -> bool:
    """Greedy check: do ``n_shards`` shards of ``capacity`` hold pieces whose running sizes are ``ends``?"""
    at, total = 0, ends[-1]
    for _ in range(n_shards):
        if at >= total:
            return True
        k = bisect_right(ends, at + capacity) - 1
        if k < 0 or ends[k] <= at:
            return False
        at = ends[k]
    return at >= total


def smallest_capacity(sizes: list[int], n_shards: int) -> int:
    """Least capacity for which ``n_shards`` contiguous shards hold all atomic pieces."""
    ends = list(accumulate(sizes))
    if not ends:
        return 0
    low, high = max(max(sizes), -(-ends[-1] // n_shards)), ends[-1]
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if _walk(ends, mid, n_shards) else (mid + 1, high)
    return low


def cut_indices(sizes: list[int], n_shards: int, capacity: int) -> list[int]:
    """For each shard but the last the number of pieces before its end: within ``capacity``, as near the even split as that allows."""
    ends = [0, *accumulate(sizes)]
    total, least = ends[-1], [len(sizes)]
    for _ in range(n_shards - 1):  # from the right: an earlier cut would leave too much behind it
        least.append(min(bisect_left(ends, ends[least[-1]] - capacity), least[-1]))
    least.reverse()
    cuts, at = [], 0
    for j in range(1, n_shards):
        even = j * total / n_shards
        k = bisect_left(ends, even)
        k = k - 1 if k and even - ends[k - 1] < ends[min(k, len(sizes))] - even else min(k, len(sizes))
        most = bisect_right(ends, ends[at] + capacity) - 1
        at = max(at, min(max(k, least[j]), most))
        cuts.append(at)
    return cuts


def undecided(pieces: list[Piece], n_shards: int) -> list[int]:
    """Indices of the divisible pieces in which a cut of the walk over single groups can lie."""
    sizes = [p.size for p in pieces]
    ends, total = list(accumulate(sizes)), sum(sizes)
    high = smallest_capacity(sizes, n_shards)
    low = max(max((p.size for p in pieces if p.single), default=0), -(-total // n_shards))
    found, first, last = [], 0, 0
    for _ in range(n_shards - 1):
        k = bisect_right(ends, first + low) - 1
        first, last = max(first, ends[k] if k >= 0 else 0), min(total, last + high)
        k = max(bisect_right(ends, first), found[-1] + 1 if found else 0)
        while k < len(pieces) and ends[k] - sizes[k] <= last:
            found.append(k)
            k += 1
    return [k for k in found if not pieces[k].single]


class Piece(NamedTuple):
    low: int      # digests from
    high: int     # to, inclusive
    size: int

    @property
    def single(self) -> bool:
        return self.low == self.high


def _sums(groups: DataFrame, shift: int) -> list[Piece]:
    """Sizes by the leading digest bits: at most 2 ** (DIGEST_BITS - shift) rows, fewer where ``groups`` holds some ranges only."""
    got = groups.groupBy(F.shiftright("g", shift).alias("p")).agg(F.min("g").alias("low"), F.max("g").alias("high"), F.sum("size").alias("size"))
    return [Piece(r.low, r.high, r.size) for r in got.select("low", "high", "size").collect()]


def minimax_cuts(groups: DataFrame, n_shards: int) -> list[int]:
    """First digests of shards 1, 2, ... (``n_shards`` - 1 values) for ``groups`` (g, size), one row per group."""
    shift = DIGEST_BITS - RANGE_BITS
    pieces = sorted(_sums(groups, shift))
    while todo := undecided(pieces, n_shards):
        finer = max(0, shift - max(1, RANGE_BITS - len(todo).bit_length()))
        marks = groups.sparkSession.createDataFrame([(pieces[k].low >> shift,) for k in todo], "p long").distinct()
        inside = groups.join(F.broadcast(marks), F.shiftright("g", shift) == marks["p"], "left_semi")  # no more marks than 2 ** RANGE_BITS
        split, gone = _sums(inside, finer), {pieces[k].low >> shift for k in todo}
        pieces = sorted([p for p in pieces if p.low >> shift not in gone] + split)
        shift = finer
    sizes = [p.size for p in pieces]
    cuts = cut_indices(sizes, n_shards, smallest_capacity(sizes, n_shards))
    return [pieces[k].low if k < len(pieces) else 1 << DIGEST_BITS for k in cuts]


def digest(key: Column) -> Column:
    """Order of the groups: 60 bits, so that ranges are plain shifts. Two keys that share a digest are one atomic group."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - DIGEST_BITS)


def shard(rows: DataFrame, n_shards: int, key: str = "g", size: str = "size", row_id: str = "doc_id") -> DataFrame:
    """``rows`` with ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0 within the shard).

    ``rows`` has the group digest ``key`` (``digest``), the row's ``size`` and ``row_id``; it is read several times, so pass a stored table.
    Rows of a group share a shard. An empty table gives an empty result; repeated rows get a slot each; other columns are kept.
    """
    groups = stored(rows.groupBy(F.col(key).alias("g")).agg(F.sum(size).alias("size")), "groups")
    top = [(r.g, r.size) for r in groups.orderBy(F.desc("size"), "g").limit(n_shards).collect()]
    total, left, alone = groups.agg(F.sum("size")).first()[0] or 0, n_shards, []
    while len(alone) < len(top) and left > 1 and top[len(alone)][1] * left >= total:
        alone.append(top[len(alone)][0])
        total, left = total - top[len(alone) - 1][1], left - 1
    starts = minimax_cuts(groups.where(~F.col("g").isin(alone)) if alone else groups, left)
    number = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in starts]), lambda c: c <= F.col(key))) if starts else F.lit(0)
    for k, g in enumerate(alone):
        number = F.when(F.col(key) == g, left + k).otherwise(number)
    out = rows.withColumn("shard", number.cast("int"))
    return with_slots(out, row_id)


def with_slots(rows: DataFrame, row_id: str) -> DataFrame:
    """``slot`` numbers the rows of each shard; blocks of a bounded mean size are numbered apart and moved by the counts before them."""
    n_blocks = max(1, -(-rows.count() // SLOT_BLOCK))
    block = F.pmod(F.xxhash64(row_id), F.lit(n_blocks)).cast("int")
    rows = rows.withColumn("_block", block)
    before = rows.groupBy("shard", "_block").count()
    before = before.select("shard", "_block", (F.sum("count").over(Window.partitionBy("shard").orderBy("_block")) - F.col("count")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("shard", "_block").orderBy(row_id))
    return rows.withColumn("slot", within.cast("long")).join(before, ["shard", "_block"]).withColumn("slot", F.col("slot") - 1 + F.col("_before")).drop("_block", "_before")
