"""Polygon-collection centroids and boundary helpers.

Geometry is a column ``ARRAY<ARRAY<STRUCT<x DOUBLE, y DOUBLE>>>`` (a polygon
as rings; outer ring counter-clockwise, holes clockwise).  The shoelace
terms of each ring are computed with array higher-order functions inside the
row (no explode, no window), then summed by a distributed aggregate, so a
collection of any size is one partial aggregation.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.strings import pad_left


def ring_terms(ring: Column) -> Column:
    """STRUCT(a2 = 2*signed area, cx6, cy6) shoelace sums of one ring (open or
    closed: a closing vertex adds a zero term)."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    terms = F.zip_with(ring, nxt, lambda p, q: F.struct(
        (p["x"] * q["y"] - q["x"] * p["y"]).alias("cr"),
        (p["x"] + q["x"]).alias("sx"), (p["y"] + q["y"]).alias("sy")))
    zero = F.struct(F.lit(0.0).alias("a2"), F.lit(0.0).alias("cx6"), F.lit(0.0).alias("cy6"))
    return F.aggregate(terms, zero, lambda acc, t: F.struct(
        (acc["a2"] + t["cr"]).alias("a2"), (acc["cx6"] + t["sx"] * t["cr"]).alias("cx6"),
        (acc["cy6"] + t["sy"] * t["cr"]).alias("cy6")))


def polygon_terms(geometry: Column) -> Column:
    """Shoelace sums over all rings of a polygon."""
    zero = F.struct(F.lit(0.0).alias("a2"), F.lit(0.0).alias("cx6"), F.lit(0.0).alias("cy6"))
    return F.aggregate(F.transform(geometry, ring_terms), zero, lambda acc, t: F.struct(
        (acc["a2"] + t["a2"]).alias("a2"), (acc["cx6"] + t["cx6"]).alias("cx6"),
        (acc["cy6"] + t["cy6"]).alias("cy6")))


def collection_centroid(df: DataFrame, geometry: str = "geometry", by: Sequence[str] = ()) -> DataFrame:
    """Area-weighted centroid (cx, cy) and total area of the polygons in each
    ``by`` group (or of the whole table)."""
    t = df.select(*by, polygon_terms(F.col(geometry)).alias("t"))
    g = t.groupBy(*by) if by else t.groupBy()
    s = g.agg(F.sum("t.a2").alias("a2"), F.sum("t.cx6").alias("cx6"), F.sum("t.cy6").alias("cy6"))
    # a degenerate (zero-area) collection has no centroid: NULL, not an ANSI error
    return s.select(*by, F.try_divide(F.col("cx6"), 3.0 * F.col("a2")).alias("cx"),
                    F.try_divide(F.col("cy6"), 3.0 * F.col("a2")).alias("cy"),
                    (F.col("a2") / 2.0).alias("area"))


def composite_fips(state: str, county: str) -> Column:
    """``STATEFP || COUNTYFP`` with both parts zero-padded (no truncation)."""
    return F.concat(pad_left(state, 2), pad_left(county, 3))
