"""Numeric codes of categories by ordered target statistics.

A category's code is its mean target, drawn to the overall mean by a prior. For a row that is trained on, only the rows before it count, in
an order given by a hash of its id: no row's code holds its own target, so a model cannot read the target off the code. Rows that are only
scored get the statistics of all training rows. The order is a rank and the sums before a row are running sums in bounded blocks, so a
category with most of the rows is no task of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpot.operators.ranking import global_row_number, running_sums
from retailpot.session import cut


def _category(column: str) -> Column:
    """The value as a key; missing values are a category of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


class TargetCodes(NamedTuple):
    """``<column>_code`` for each of ``columns``; ``weight`` is how many rows of the overall mean the prior counts as."""

    columns: Sequence[str]
    target: str = "target"
    key: str = "Outlet_ID"
    weight: float = 1.0
    seed: int = 42

    def fit(self, train: DataFrame) -> TargetCodeModel:
        prior = train.agg(F.avg(self.target)).first()[0]
        totals = {c: train.groupBy(_category(c).alias("_key")).agg(F.sum(self.target).alias("_sum"), F.count(self.target).alias("_n")) for c in self.columns}
        return TargetCodeModel(self, 0.0 if prior is None else float(prior), totals)


class TargetCodeModel(NamedTuple):
    settings: TargetCodes
    prior: float
    totals: dict[str, DataFrame]

    def _code(self, total: Column, n: Column) -> Column:
        a = float(self.settings.weight)
        return (F.coalesce(total, F.lit(0.0)) + F.lit(a * self.prior)) / (F.coalesce(n, F.lit(0)) + F.lit(a))

    def transform(self, rows: DataFrame) -> DataFrame:
        """Codes from all training rows; a category that none of them has gets the overall mean."""
        for c in self.settings.columns:
            rows = rows.withColumn("_key", _category(c)).join(self.totals[c], "_key", "left").withColumn(f"{c}_code", self._code(F.col("_sum"), F.col("_n"))).drop("_key", "_sum", "_n")
        return rows

    def ordered(self, train: DataFrame) -> DataFrame:
        """Codes of the training rows, each from the rows before it.

        The ordered rows are written once; each column's sums are taken over three narrow columns of them and come back by rank.
        """
        s = self.settings
        n = train.count()
        rows = cut(global_row_number(train, [F.xxhash64(s.key, F.lit(s.seed)), F.col(s.key)], "_order"))
        out = rows.drop(*[f"{c}_code" for c in s.columns])
        sums = {"_sum": F.coalesce(F.col("_target"), F.lit(0.0)), "_n": F.col("_target").isNotNull().cast("int")}
        for c in s.columns:
            narrow = running_sums(rows.select("_order", _category(c).alias("_key"), F.col(s.target).alias("_target")), "_order", sums, ["_key"], rows=n)
            out = out.join(narrow.select("_order", self._code(F.col("_sum"), F.col("_n")).alias(f"{c}_code")), "_order")
        return out.drop("_order")
