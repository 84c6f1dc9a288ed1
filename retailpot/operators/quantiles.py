"""Exact quantiles with linear interpolation, safe for groups of any size.

A group is sorted in one task only where a count has shown that every group is small. Beyond that size,
rows are first counted per (group, value); groups with few distinct values go to the built-in
``percentile`` with frequencies, and a group with many is cut into value bands: the band that holds the wanted order statistic is found from band counts, and
only that band is sorted. Of whole frames beyond the size, the wanted order statistics are selected in rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_DISTINCT = 200_000
BANDS = 4096
SPLITTERS = 500   # bands of a round when the values of a whole frame are selected


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str | Column, probs: Sequence[float],
                      out: str = "q", hot_distinct: int = HOT_DISTINCT, bands: int = BANDS) -> DataFrame:
    """``keys``, an array column ``out`` with one quantile per probability (nulls ignored) and ``group_rows``."""
    ks = list(keys)
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(*ks, v.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    probs_sql = ", ".join(repr(float(p)) + "D" for p in probs)
    if _largest(rows, ks) <= hot_distinct:
        return _sorted_groups(rows, ks, probs, out)
    counts = rows.groupBy(*ks, "_v").agg(F.count("*").alias("_n"))
    hot = counts.groupBy(*ks).agg(F.count("*").alias("_d")).where(F.col("_d") > hot_distinct).select(*ks)
    small = (counts.join(hot, ks, "left_anti").groupBy(*ks)
             .agg(F.expr(f"percentile(_v, array({probs_sql}), _n)").alias(out), F.sum("_n").alias("group_rows")))
    big = _banded(counts.join(hot, ks, "left_semi"), ks, probs, out, bands)
    return small.unionByName(big)


def with_group_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], out: str = "q",
                         hot_distinct: int = HOT_DISTINCT) -> DataFrame:
    """Every row with the quantiles of its group (``out``) and the number of non-null values (``group_rows``).

    Small groups get them from one sort of the group; otherwise the quantiles are joined on.
    """
    ks, v = list(keys), F.col(value)
    if _largest(df.where(v.isNotNull()), ks) > hot_distinct:
        return df.join(grouped_quantiles(df, ks, value, probs, out, hot_distinct), ks, "left")
    group = Window.partitionBy(*ks)
    ranked = df.withColumns({"_r": F.row_number().over(group.orderBy(v.asc_nulls_last())) - 1, "group_rows": F.count(v).over(group)})
    n = F.col("group_rows")

    def picked(p: float) -> Column:
        pos = F.lit(float(p)) * (n - 1)
        a = F.max(F.when(F.col("_r") == F.floor(pos), v)).over(group)
        z = F.max(F.when(F.col("_r") == F.least(F.floor(pos) + 1, n - 1), v)).over(group)
        frac = pos - F.floor(pos)
        return F.when(frac == 0, a).otherwise(a * (1 - frac) + z * frac)

    return ranked.withColumn(out, F.array(*[picked(p) for p in probs])).drop("_r")


def _largest(rows: DataFrame, ks: list[str]) -> int:
    """Rows of the largest group: one map-side-combined pass over the keys."""
    return rows.groupBy(*ks).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def _sorted_groups(rows: DataFrame, ks: list[str], probs: Sequence[float], out: str) -> DataFrame:
    """Quantiles of groups known to be small: number the values of each group and pick the two around each position."""
    group = Window.partitionBy(*ks)
    ranked = rows.withColumns({"_r": F.row_number().over(group.orderBy("_v")) - 1, "_t": F.count("*").over(group)})

    def picked(p: float) -> Column:
        pos = F.lit(float(p)) * (F.col("_t") - 1)
        below = F.floor(pos)
        a = F.max(F.when(F.col("_r") == below, F.col("_v")))
        z = F.max(F.when(F.col("_r") == F.least(below + 1, F.col("_t") - 1), F.col("_v")))
        frac = F.max(pos - below)
        return F.when(frac == 0, a).otherwise(a * (1 - frac) + z * frac)

    return ranked.groupBy(*ks).agg(F.array(*[picked(p) for p in probs]).alias(out), F.count("*").alias("group_rows"))


def _banded(counts: DataFrame, ks: list[str], probs: Sequence[float], out: str, bands: int) -> DataFrame:
    span = counts.groupBy(*ks).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_t"))
    band = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(float(bands))), F.lit(bands - 1))
    banded = counts.join(span, ks).withColumn("_b", band).select(*ks, "_b", "_v", "_n")
    upto = Window.partitionBy(*ks).orderBy("_b")  # at most `bands` rows per group
    bc = (banded.groupBy(*ks, "_b").agg(F.sum("_n").alias("_bn"))
          .withColumn("_before", F.sum("_bn").over(upto) - F.col("_bn")))
    wanted = span.select(*ks, F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_i", "_p"), "_t")
    pos = F.col("_p") * (F.col("_t") - 1)
    wanted = wanted.withColumn("_frac", pos - F.floor(pos)).withColumn(
        "_k", F.explode(F.array(F.floor(pos), F.least(F.floor(pos) + 1, F.col("_t") - 1)))).withColumn("_low", F.col("_k") == F.floor(pos))
    hit = wanted.join(bc, ks).where((F.col("_before") <= F.col("_k")) & (F.col("_k") < F.col("_before") + F.col("_bn")))
    inside = Window.partitionBy(*ks, "_b").orderBy("_v")
    ranked = (banded.join(hit.select(*ks, "_b").distinct(), [*ks, "_b"], "left_semi")
              .withColumn("_upto", F.sum("_n").over(inside)))
    found = hit.join(ranked, [*ks, "_b"]).where(
        (F.col("_before") + F.col("_upto") - F.col("_n") <= F.col("_k")) & (F.col("_k") < F.col("_before") + F.col("_upto")))
    ends = found.groupBy(*ks, "_i", "_frac", "_t").agg(F.min("_v").alias("_a"), F.max("_v").alias("_z"))
    q = F.when(F.col("_frac") == 0, F.col("_a")).otherwise(F.col("_a") * (1 - F.col("_frac")) + F.col("_z") * F.col("_frac"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_i", q.alias("q")))), lambda s: s.q)
    return ends.groupBy(*ks).agg(listed.alias(out), F.first("_t").alias("group_rows"))


def frame_quantiles(df: DataFrame, value: str | Column, probs: Sequence[float], bands: int = SPLITTERS,
                    small: int = HOT_DISTINCT) -> DataFrame:
    """One row with the quantiles of the whole frame as array ``q`` (no row for an empty frame).

    Beyond ``small`` values the order statistics are selected in rounds (``order_statistics``), so no task sorts more than ``small``
    values however they are spread. Hand in a stored table where computing ``df`` is dear.
    """
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(v.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    n = rows.count()
    if n <= small:
        probs_sql = ", ".join(repr(float(p)) + "D" for p in probs)
        return rows.agg(F.expr(f"percentile(_v, array({probs_sql}))").alias("q")).where("q is not null")
    at = [float(p) * (n - 1) for p in probs]
    found = order_statistics(rows, {k for x in at for k in (int(x), min(int(x) + 1, n - 1))}, bands, small)
    q = []
    for x in at:
        a, z, frac = found[int(x)], found[min(int(x) + 1, n - 1)], x - int(x)
        q.append(a if frac == 0 else a * (1 - frac) + z * frac)
    return df.sparkSession.createDataFrame([(q,)], "q array<double>")


def order_statistics(rows: DataFrame, ranks: set[int], bands: int = SPLITTERS, small: int = HOT_DISTINCT) -> dict[int, float]:
    """The values of ``rows._v`` (no nulls) at the given ranks, counted from 0.

    A rank is known to lie between two values. Each round is one map-side-combined pass: for every such span it counts what lies below, on
    its ends and inside, and splits the inside at ``bands`` approximate quantiles, whose rank error is bounded. The next span is the few
    bands around the rank; ties on its ends are answered from the counts. So the inside shrinks by a factor of about ``bands`` / 4 a round
    whatever the distribution, until at most ``small`` values are left to be numbered in one task. The driver keeps two values a rank.
    """
    v = F.col("_v")
    first = rows.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    spans, parents, margin, found = {k: (first.lo, first.hi) for k in ranks}, {}, dict.fromkeys(ranks, 1), {}
    grid = [i / bands for i in range(bands + 1)]
    while spans:
        todo = sorted(set(spans.values()))
        cells = []
        for lo, hi in todo:
            inside = (v > lo) & (v < hi)
            cells.append(F.struct(F.count_if(v < lo).alias("below"), F.count_if(v == lo).alias("at_lo"), F.count_if(inside).alias("inner"), F.count_if(v == hi).alias("at_hi"),
                                  F.percentile_approx(F.when(inside, v), grid, 8 * bands).alias("cuts")))
        seen = dict(zip(todo, rows.agg(F.array(*cells).alias("c")).first().c, strict=True))
        finish: dict[tuple, list[int]] = {}
        for k, span in list(spans.items()):
            c, (lo, hi) = seen[span], span
            if k < c.below or k >= c.below + c.at_lo + c.inner + (c.at_hi if hi > lo else 0):
                spans[k], margin[k] = parents[k], margin[k] * 4   # beyond the approximation's bound: a wider span
            elif k < c.below + c.at_lo:
                found[k] = lo
            elif k >= c.below + c.at_lo + c.inner:
                found[k] = hi
            elif c.inner <= small:
                finish.setdefault(span, []).append(k)
            else:
                j = int((k - c.below - c.at_lo) / c.inner * bands)
                parents[k] = span
                low, high = j - margin[k], j + 1 + margin[k]
                spans[k] = (c.cuts[low] if low >= 0 else lo, c.cuts[high] if high <= bands else hi)
        for (lo, hi), ks in finish.items():
            base = seen[lo, hi].below + seen[lo, hi].at_lo
            ranked = rows.where((v > lo) & (v < hi)).select("_v", (F.row_number().over(Window.orderBy("_v")) - 1 + base).alias("_k"))
            found |= {r._k: r._v for r in ranked.where(F.col("_k").isin(ks)).collect()}
        spans = {k: s for k, s in spans.items() if k not in found}
    return found


def scalar_quantiles(df: DataFrame, value: str | Column, probs: Sequence[float]) -> Column:
    """Whole-frame quantiles as an array constant (null for an empty frame).

    They are computed once, here: the driver reads one double per probability, and every use of the
    result in the caller's plan is a literal.
    """
    row = frame_quantiles(df, value, probs).first()
    return F.lit(None).cast("array<double>") if row is None else F.array(*[F.lit(float(x)) for x in row.q])


def scalar_median(df: DataFrame, value: str | Column) -> Column:
    return scalar_quantiles(df, value, [0.5])[0]
