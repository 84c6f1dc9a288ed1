"""Global order at scale: ranks and running sums without a one-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailpot.session import cut

BLOCK = 1 << 16


def global_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``row_number()`` over the whole frame under a total ``order``.

    Up to a block of rows is numbered in one window. Beyond that, rows are range-partitioned by the
    order and written out once, so that the ranges stay fixed; each range is numbered on its own and
    shifted by the sizes of the ranges before it.
    """
    if df.count() <= BLOCK:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    ranged = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size")).withColumn(
        "_shift", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_local", local).join(sizes, "_part").withColumn(
        name, (F.col("_local") + F.col("_shift")).cast("long")).drop("_part", "_local", "_shift")


def running_sum(df: DataFrame, rank: str, value: Column, name: str, groups: Sequence[str] = (),
                block: int = BLOCK, rows: int | None = None) -> DataFrame:
    """Exclusive running sum of ``value`` in ``rank`` order, optionally per group.

    ``rank`` numbers the rows 1..n, so a block of ranks is a bounded piece of work even when one
    group holds most rows; block totals (n / block rows) carry the sum from block to block. Where the caller knows that
    there are no more ``rows`` than one block holds, no totals are needed.
    """
    return running_sums(df, rank, {name: value}, groups, block, rows)


def running_sums(df: DataFrame, rank: str, values: Mapping[str, Column], groups: Sequence[str] = (),
                 block: int | None = None, rows: int | None = None) -> DataFrame:
    """``running_sum`` of several values by name. Totals are a second reading of ``df``: calls that build on each other double it each time."""
    groups, names, block = list(groups), list(values), block or BLOCK
    if rows is not None and rows <= block:
        w = Window.partitionBy(*groups).orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({n: F.coalesce(F.sum(values[n]).over(w), F.lit(0)) for n in names})
    d = df.withColumns({"_blk": F.floor((F.col(rank) - 1) / F.lit(block)), **{f"_val{i}": values[n] for i, n in enumerate(names)}})
    before = Window.partitionBy(*groups).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    sums = d.groupBy(*groups, "_blk").agg(*[F.sum(f"_val{i}").alias(f"_s{i}") for i in range(len(names))])
    carry = sums.select(*groups, "_blk", *[F.coalesce(F.sum(f"_s{i}").over(before), F.lit(0)).alias(f"_carry{i}") for i in range(len(names))])
    inside = Window.partitionBy(*groups, "_blk").orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    within = d.withColumns({f"_in{i}": F.coalesce(F.sum(f"_val{i}").over(inside), F.lit(0)) for i in range(len(names))})
    out = within.join(carry, [*groups, "_blk"]).withColumns({n: F.col(f"_carry{i}") + F.col(f"_in{i}") for i, n in enumerate(names)})
    return out.drop("_blk", *[f"{x}{i}" for x in ("_val", "_in", "_carry") for i in range(len(names))])
