"""Column helpers for rounding, clamping, scaling and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(c: str | Column, digits: int) -> Column:
    """Round a double to ``digits`` decimals, ties to even (the scaled value is what is tied)."""
    scale = float(10**digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def clamp(c: Column, low: float | None = None, high: float | None = None) -> Column:
    if low is not None:
        c = F.greatest(c, F.lit(float(low)))
    if high is not None:
        c = F.least(c, F.lit(float(high)))
    return c


def literal_map(key: Column, mapping: dict, default=None) -> Column:
    """Map a key through a small fixed dictionary as a literal ``when`` chain."""
    out = None
    for k, v in mapping.items():
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def is_blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return c.isNull() | c.cast("string").rlike(r"^\s*$")


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest."""
    pieces = F.split(c, r"(?<=[^A-Za-z])")
    return F.array_join(F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))), "")


def scalar_struct(df: DataFrame, **aggs: Column) -> Column:
    """A one-row aggregate as a scalar-subquery struct: no join, no driver round trip."""
    return df.agg(F.struct(*[a.alias(n) for n, a in aggs.items()]).alias("s")).scalar()


def with_min_max(df: DataFrame, name: str, value: str, digits: int = 2) -> DataFrame:
    """Add ``value`` scaled to 0..100 over the frame; 0 where it is constant."""
    r = scalar_struct(df, lo=F.min(value), hi=F.max(value))
    lo, hi = r.getField("lo"), r.getField("hi")
    scaled = (F.col(value) - lo) / (hi - lo) * F.lit(100.0)
    return df.withColumn(name, F.when(hi > lo, half_even(scaled, digits)).otherwise(F.lit(0.0)))
