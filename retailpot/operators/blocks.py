"""Sums over all points within a radius, block by block.

The plane is cut into cells a little wider than the radius. A block holds locations of one cell and the points of that cell and its eight
neighbours; cells with many of either are dealt to several blocks by a hash, so that a block is bounded whatever the crowd. Spark deals the
points, a task sees one block, and only a row per location leaves it: the pairs are never rows.

Within a block the points lie in thin bands of latitude, each sorted by longitude. Of a band, a circle holds one run of points for sure and
may hold the few at both ends of it. Counts take the run from running sums and measure only the ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from retailpot.functions import geo

LEFT_ROWS, RIGHT_ROWS = 16_384, 262_144   # of a block
PAIRS = 1 << 21                           # point pairs measured at once
TILE_PAIRS = 1 << 15                      # the same where all pairs of a tile are measured: they stay in the cache
BAND_COST = 10.0                          # a look into a band costs about as much as measuring this many points
KEYS = ["cy", "cx", "pa", "pb"]


def dealt(left: DataFrame, right: DataFrame, sides: tuple[float, float], weights: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with the block they belong to (``KEYS``): each pair of points less than a cell apart meets in one block."""
    at = lambda df: df.withColumns({"cy": geo.cell(F.col("lat"), sides[0]), "cx": geo.cell(F.col("lon"), sides[1])})
    around = F.explode(F.array(*[F.struct((F.col("cy") + y).alias("y"), (F.col("cx") + x).alias("x")) for y in (-1, 0, 1) for x in (-1, 0, 1)]))
    parts = lambda n, most: F.ceil(n / F.lit(most)).cast("int")
    a, b = at(left), at(right)
    crowd = a.groupBy("cy", "cx").agg(F.count("*").alias("na"))
    reach = b.groupBy("cy", "cx").agg(F.count("*").alias("n")).select(around.alias("o"), "n").groupBy(F.col("o.y").alias("cy"), F.col("o.x").alias("cx")).agg(F.sum("n").alias("nb"))
    plan = crowd.join(reach, ["cy", "cx"]).select("cy", "cx", parts(F.col("na"), LEFT_ROWS).alias("na"), parts(F.col("nb"), RIGHT_ROWS).alias("nb"))
    targets = plan.select(F.struct("cy", "cx", "na", "nb").alias("t"), around.alias("o")).groupBy(F.col("o.y").alias("cy"), F.col("o.x").alias("cx")).agg(F.collect_list("t").alias("t"))
    place = F.xxhash64("lat", "lon")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = a.join(plan, ["cy", "cx"]).select("lat", "lon", "cy", "cx", F.pmod(place, F.col("na")).cast("int").alias("pa"), each("nb").alias("pb"))
    b = b.join(targets, ["cy", "cx"]).select("lat", "lon", *weights, F.explode("t").alias("t")).select("lat", "lon", *weights, "t.*")
    b = b.select("*", F.pmod(place, F.col("nb")).cast("int").alias("pb"))
    return a, b.select(F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"), *[F.col(w).alias(f"b_{w}") for w in weights],
                       *[F.col(c).alias(f"b_{c}") for c in ("cy", "cx")], each("na").alias("b_pa"), F.col("pb").alias("b_pb"))


def block_sums(left: DataFrame, right: DataFrame, sides: tuple[float, float], weights: Sequence[str], names: Sequence[str], whole: bool,
               work: Callable[[Block], np.ndarray]) -> DataFrame:  # noqa: F821
    """(lat, lon, ``names``) of the left locations with anything in reach: what ``work`` makes of their blocks, added up."""
    a, b = dealt(left, right, sides, weights)
    cols = list(names)

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        lat, lon = x["lat"].to_numpy(), x["lon"].to_numpy()
        sums = np.zeros((len(lat), len(cols)))
        if len(lat) and y.num_rows:
            w = np.stack([y[f"b_{c}"].to_numpy() for c in weights], axis=1)
            sums = work(Block(lat, lon, Bands.of(y["b_lat"].to_numpy(), y["b_lon"].to_numpy(), w, sides[0] * geo.KM_PER_DEGREE)))
        some = sums.any(axis=1)
        kind = np.int64 if whole else np.float64
        return pa.table({"lat": lat[some], "lon": lon[some], **{n: sums[some, i].astype(kind) for i, n in enumerate(cols)}})

    schema = ", ".join(["lat double", "lon double", *[f"`{n}` {'long' if whole else 'double'}" for n in cols]])
    out = a.groupBy(*KEYS).cogroup(b.groupBy(*[f"b_{c}" for c in KEYS])).applyInArrow(run, schema)
    return out.groupBy("lat", "lon").agg(*[F.sum(f"`{n}`").alias(n) for n in cols])


def whole_numbers(df: DataFrame, columns: Sequence[str]) -> bool:
    return all(isinstance(df.schema[c].dataType, IntegralType) for c in columns)


class Bands(NamedTuple):
    """Points by band of latitude, within it by longitude; ``edges`` are the bands' first places, ``low`` and ``high`` their latitudes."""

    lat: np.ndarray
    lon: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def of(lat: np.ndarray, lon: np.ndarray, weights: np.ndarray, reach_km: float) -> Bands:
        # low bands leave few points to measure, high ones are fewer to look into: the best height goes with the root of the density
        area = max(np.ptp(lat) * np.ptp(lon), 1e-12) * geo.KM_PER_DEGREE**2
        height = np.clip(np.sqrt(BAND_COST * area / len(lat)), reach_km / 512, reach_km) / geo.KM_PER_DEGREE
        band = np.floor(lat / height)
        order = np.lexsort((lon, band))
        lat, lon, band = lat[order], lon[order], band[order]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(band)) + 1, [len(lat)]])
        return Bands(lat, lon, weights[order], edges, np.minimum.reduceat(lat, edges[:-1]), np.maximum.reduceat(lat, edges[:-1]))


class Block(NamedTuple):
    lat: np.ndarray
    lon: np.ndarray
    right: Bands


def _sin2_half(d: np.ndarray) -> np.ndarray:
    """Square of the sine of half an angle given in degrees."""
    s = np.sin(d * (np.pi / 360))
    return s * s


def _half_width(lat_gap: np.ndarray, cosines: np.ndarray, radius_km: float) -> np.ndarray:
    """Longitudes in degrees that a circle reaches at a latitude gap; -1 where it does not get there."""
    q = (np.sin(radius_km / (2 * geo.EARTH_KM)) ** 2 - _sin2_half(lat_gap)) / cosines
    return np.where(q < 0, -1.0, np.degrees(2 * np.arcsin(np.sqrt(np.clip(q, 0, 1)))))


def haversine_km(lat1, lon1, lat2, lon2) -> np.ndarray:
    h = _sin2_half(lat2 - lat1) + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * _sin2_half(lon2 - lon1)
    return 2 * geo.EARTH_KM * np.arcsin(np.sqrt(np.minimum(h, 1.0)))


def geodesic_km(lat1, lon1, lat2, lon2) -> np.ndarray:
    """Lambert's formula as in ``geo.with_geodesic_m``."""
    b1, b2 = (np.arctan((1 - geo.WGS84_F) * np.tan(np.radians(x))) for x in (lat1, lat2))
    s = np.sin((b2 - b1) / 2)
    h = np.minimum(s * s + np.cos(b1) * np.cos(b2) * _sin2_half(lon2 - lon1), 1.0)
    sg, ss = 2 * np.arcsin(np.sqrt(h)), 2 * np.sqrt(h * (1 - h))
    mid, half = (b1 + b2) / 2, (b2 - b1) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        x = (sg - ss) * (np.sin(mid) * np.cos(half)) ** 2 / (1 - h)
        y = (sg + ss) * (np.cos(mid) * np.sin(half)) ** 2 / h
        return np.where(h == 0, 0.0, geo.WGS84_A * (sg - geo.WGS84_F / 2 * (x + y)) / 1000.0)


DISTANCES = {"haversine": haversine_km, "geodesic": geodesic_km}


def _ragged(starts: np.ndarray, stops: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, place) for every place from start to stop of each row, at most about ``PAIRS`` at once."""
    n = stops - starts
    row = np.flatnonzero(n > 0)
    upto = np.cumsum(n[row])
    done = 0
    while done < len(row):
        base = upto[done - 1] if done else 0
        end = max(done + 1, int(np.searchsorted(upto, base + PAIRS, "right")))
        rows = row[done:end]
        k = n[rows]
        first = np.cumsum(k) - k
        yield np.repeat(rows, k), np.arange(int(k.sum())) + np.repeat(starts[rows] - first, k)
        done = end


def counts(block: Block, radii_km: Sequence[float], metric: str, slack: float) -> np.ndarray:
    """Per location the weights within each radius: one column per weight and radius, weight by weight."""
    order = np.argsort(block.lat, kind="stable")
    lat, lon, right, km = block.lat[order], block.lon[order], block.right, DISTANCES[metric]
    k = right.weights.shape[1]
    running = np.concatenate([np.zeros((1, k), right.weights.dtype), np.cumsum(right.weights, axis=0)])
    out = np.zeros((len(lat), k, len(radii_km)))
    cos_a = np.cos(np.radians(lat))
    for i, r in enumerate(radii_km):
        reach = np.degrees(r / geo.EARTH_KM) * (1 + 2 * slack)
        first, last = np.searchsorted(lat, right.low - reach, "left"), np.searchsorted(lat, right.high + reach, "right")
        for band in np.flatnonzero(last > first).tolist():
            rows, start, stop, low, high = slice(first[band], last[band]), right.edges[band], right.edges[band + 1], right.low[band], right.high[band]
            y, x, c = lat[rows], lon[rows], cos_a[rows]
            least, most = sorted(np.cos(np.radians([low, high])).tolist())
            most = 1.0 if low <= 0 <= high else most
            wide = _half_width(np.maximum(np.maximum(low - y, y - high), 0), c * least, r * (1 + slack))
            sure = _half_width(np.maximum(np.abs(y - low), np.abs(y - high)), c * most, r * (1 - slack))
            lons = right.lon[start:stop]
            lo, hi = np.searchsorted(lons, x - wide, "left") + start, np.searchsorted(lons, x + wide, "right") + start
            hi = np.where(wide < 0, lo, hi)
            mid_lo, mid_hi = np.searchsorted(lons, x - sure, "left") + start, np.searchsorted(lons, x + sure, "right") + start
            mid_lo, mid_hi = np.where(sure < 0, lo, mid_lo), np.where(sure < 0, lo, mid_hi)
            out[rows, :, i] += running[mid_hi] - running[mid_lo]
            n = len(y)
            for row, place in _ragged(np.concatenate([lo, mid_hi]), np.concatenate([mid_lo, hi])):
                row = row % n
                hit = km(y[row], x[row], right.lat[place], right.lon[place]) <= r
                row, place = row[hit], place[hit]
                for j in range(k):
                    out[rows, j, i] += np.bincount(row, right.weights[place, j], n)
    back = np.empty_like(out)
    back[order] = out
    return back.reshape(len(lat), -1)


def pulls(block: Block, radius_km: float, epsilon_km: float) -> np.ndarray:
    """Per location and weight the sum of weight / (km + epsilon)^2 over the points within the radius: every pair is measured."""
    right = block.right
    density = len(block.lat) / max(np.ptp(block.lat) * np.ptp(block.lon), 1e-12)
    side = np.clip(np.sqrt(64 / density), radius_km / geo.KM_PER_DEGREE / 16, radius_km / geo.KM_PER_DEGREE / 2)
    ty, tx = np.floor(block.lat / side), np.floor(block.lon / side)
    order = np.lexsort((tx, ty))
    tiles = np.split(order, np.flatnonzero((np.diff(ty[order]) != 0) | (np.diff(tx[order]) != 0)) + 1)
    out = np.zeros((len(block.lat), right.weights.shape[1]))
    cos_b, weights = np.cos(np.radians(right.lat)), right.weights.astype(float)
    for tile in tiles:
        y, x = block.lat[tile], block.lon[tile]
        c = np.cos(np.radians(y))
        gap = np.maximum(np.maximum(right.low - y.max(), y.min() - right.high), 0)
        least = min(c.min(), 1.0) * np.minimum(np.cos(np.radians(right.low)), np.cos(np.radians(right.high)))
        wide = _half_width(gap, least, radius_km * (1 + 1e-9))
        runs = []
        for band in np.flatnonzero(wide >= 0).tolist():
            start, stop = right.edges[band], right.edges[band + 1]
            lo, hi = np.searchsorted(right.lon[start:stop], (x.min() - wide[band], x.max() + wide[band]))
            runs.append(np.arange(start + lo, min(start + hi + 1, stop)))
        near = np.concatenate(runs) if runs else np.zeros(0, int)
        rows = max(1, min(len(tile), 64))
        for s in range(0, len(tile), rows):
            part = slice(s, s + rows)
            for t in range(0, len(near), TILE_PAIRS // rows):
                p = near[t:t + TILE_PAIRS // rows]
                km = _short_km(right.lat[p] - y[part, None], right.lon[p] - x[part, None], c[part, None] * cos_b[p], radius_km)
                pull = km + epsilon_km
                np.multiply(pull, pull, out=pull)
                np.divide(km <= radius_km, pull, out=pull)
                out[tile[part]] += pull @ weights[p]
    return out


def _short_km(d_lat: np.ndarray, d_lon: np.ndarray, cosines: np.ndarray, radius_km: float) -> np.ndarray:
    """Great-circle distances from differences in degrees. Within 60 km a few terms of the series give sine and arc sine to the last digits."""
    if radius_km > 60:
        return 2 * geo.EARTH_KM * np.arcsin(np.sqrt(np.minimum(_sin2_half(d_lat) + cosines * _sin2_half(d_lon), 1.0)))

    def sin2(d):
        d *= np.pi / 360
        d *= d
        t = d * (-2 / 45)
        t += 1 / 3
        t *= d
        np.subtract(1, t, out=t)
        d *= t
        return d

    h = sin2(d_lon)
    h *= cosines
    h += sin2(d_lat)
    s = h * (15 / 336)
    for term in (3 / 40, 1 / 6):
        s += term
        s *= h
    s += 1
    s *= np.sqrt(h)
    s *= 2 * geo.EARTH_KM
    return s
