"""Roads as lines of any number of points: legs in the grid, places along a line, matching.

A line is an array of struct<x,y> in metres. Joins take its legs one by one, so a bent road costs the
cells along it and not those of its whole box.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smoothway.operators import roads as straight
from smoothway.operators import spatial


def legs(roads: DataFrame, line: str = "line") -> DataFrame:
    """A row for each leg of each road: the road's other columns, leg (from 0), its ends x0, y0, x1, y1, its
    length leg_m and offset_m, the line's length up to it. Legs without length are left out."""
    offsets = F.aggregate("_lengths", F.array(F.lit(0.0)), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
    rows = roads.withColumn("_lengths", straight.leg_lengths(F.col(line))).withColumn("_offsets", offsets)
    each = rows.select(*[c for c in rows.columns if c != "_lengths"], F.posexplode("_lengths").alias("leg", "leg_m")).filter("leg_m > 0")
    a, b = F.get(line, F.col("leg")), F.get(line, F.col("leg") + 1)
    ends = {"x0": a["x"], "y0": a["y"], "x1": b["x"], "y1": b["y"], "offset_m": F.get("_offsets", F.col("leg"))}
    return each.withColumns(ends).drop("_offsets", line)


def share_along(x: Column, y: Column) -> Column:
    """How far along the leg of a row the foot of a point lies, from 0 to 1."""
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    t = ((x - F.col("x0")) * dx + (y - F.col("y0")) * dy) / (dx * dx + dy * dy)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))


def candidates(points: DataFrame, roads: DataFrame, radius: float = spatial.RADIUS_M, key: str | tuple[str, ...] = "event_id", **options) -> DataFrame:
    """Points with each road within the radius: distance_m to its line, the leg that is nearest (the first
    of equally near ones) and along_m, the place of its foot from the line's start.

    A point without a road near, or without coordinates, stays once with nulls. key (one column or several) tells
    points apart.
    The leg's bearing isn't the road's: the columns bx0, by0, bx1, by1 have the line's two ends.
    """
    ends = {"bx0": F.element_at("line", 1)["x"], "by0": F.element_at("line", 1)["y"], "bx1": F.element_at("line", -1)["x"], "by1": F.element_at("line", -1)["y"]}
    near = spatial.candidates(points, legs(roads.withColumns(ends)), radius, **options)
    near = near.withColumn("along_m", F.col("offset_m") + share_along(F.col("x"), F.col("y")) * F.col("leg_m"))
    by = (key,) if isinstance(key, str) else key
    # both this window and the best match are dealt by the key alone, so points move once
    near = near.repartition(spatial.parts(near), *by)
    first = Window.partitionBy(*by, "segment_id").orderBy(F.round("distance_m", 6), "leg")
    return near.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n", "x0", "y0", "x1", "y1", "leg_m", "offset_m")


def match(points: DataFrame, roads: DataFrame, radius: float = spatial.RADIUS_M, **options) -> DataFrame:
    """The best road of each point by distance and heading, with its leg and the place along it; points alike in
    both are matched once.

    A road's bearing is that from its first point to its last, turned round for direction A.
    """
    at = ("x", "y", "heading")

    def best(places: DataFrame) -> DataFrame:
        found = candidates(places, roads, radius, at, **options).withColumnsRenamed({f"b{c}": c for c in ("x0", "y0", "x1", "y1")})
        return spatial.best_match(spatial.match_scores(found, radius), *at)

    return spatial.once_a_place(points, best, *at)


def pavement(roads: DataFrame, ratings: DataFrame, as_of: int | None, **options) -> DataFrame:
    """As spatial.pavement, by the distance of a rating to the road's nearest leg."""
    return spatial.pavement(roads, ratings, as_of, legs=legs(roads.select("segment_id", "street", "line")), **options)


def speed_humps(roads: DataFrame, humps: DataFrame, as_of: int, **options) -> DataFrame:
    """As roads.speed_humps, by the distance of a hump to a road's nearest leg."""
    return straight.speed_humps(roads, humps, as_of, legs=legs(roads.select("segment_id", "street", "line")), **options)
