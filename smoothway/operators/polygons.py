"""Polygons of any shape: overlay, union areas, dissolved outlines, regions, inner and nearest points.

A ring is an array of struct<x,y> whose last point is its first. Work on pairs and unions is cut into
grid cells: each ring is clipped to a cell before it meets others there, so no task holds more than the
pieces in one cell, and areas add up.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smoothway.operators.spatial import inside_polygon, parts, ring_box
from smoothway.operators.zones import safe_ratio
from smoothway.sources.scratch import written

#: Rings in one cell beyond which it is cut in four, and how often that may happen.
MOST_RINGS, MOST_CUTS = 64, 8
#: Zones that are merged into regions in one task.
MOST_ZONES = 20_000
RING = "array<struct<x: double, y: double>>"


# --- one polygon -----------------------------------------------------------------------------------


def _edges(ring: Column) -> Column:
    return F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def signed_area(ring: Column) -> Column:
    """Above 0 for a ring that runs counterclockwise."""
    return F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + (e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]) / 2)


def nearest_on_ring(x: Column, y: Column, ring: Column) -> Column:
    """Struct (far, x, y): the point of a ring's edges that is nearest to a point, the first in ties."""

    def foot(e: Column) -> Column:
        dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        t = F.coalesce(F.try_divide((x - e["a"]["x"]) * dx + (y - e["a"]["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        fx, fy = e["a"]["x"] + t * dx, e["a"]["y"] + t * dy
        return F.struct(F.hypot(x - fx, y - fy).alias("far"), fx.alias("x"), fy.alias("y"))

    return F.array_min(F.transform(_edges(ring), foot))


def inner_point(ring: Column) -> tuple[Column, Column]:
    """A point inside a ring: the middle of the widest stretch of a level line. The line lies half way
    between the corners next below and next above the middle of the ring's box, so it meets no corner."""
    ys = F.transform(ring, lambda p: p["y"])
    middle = (F.array_min(ys) + F.array_max(ys)) / 2
    level = (F.array_max(F.filter(ys, lambda v: v <= middle)) + F.array_min(F.filter(ys, lambda v: v > middle))) / 2
    crossing = F.filter(_edges(ring), lambda e: (e["a"]["y"] > level) != (e["b"]["y"] > level))
    xs = F.array_sort(F.transform(crossing, lambda e: e["a"]["x"] + (level - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) * (e["b"]["x"] - e["a"]["x"])))
    inside = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(xs), 1) - 1), lambda k: F.struct((F.get(xs, 2 * k + 1) - F.get(xs, 2 * k)).alias("wide"), ((F.get(xs, 2 * k + 1) + F.get(xs, 2 * k)) / 2).alias("x")))
    return F.when(F.size(xs) > 1, F.array_max(inside)["x"]), level


# --- in a cell -------------------------------------------------------------------------------------


def _clip(ring: np.ndarray, low: tuple[float, float], high: tuple[float, float]) -> np.ndarray:
    """The part of a ring in a box, as a ring whose edges may run along the box (Sutherland-Hodgman)."""
    for axis in (0, 1):
        for bound, keep in ((low[axis], 1.0), (high[axis], -1.0)):
            if not len(ring):
                return ring
            side = (ring[:, axis] - bound) * keep
            out = []
            for p, q, a, b in zip(ring, np.roll(ring, -1, axis=0), side, np.roll(side, -1), strict=True):
                if a >= 0:
                    out.append(p)
                if (a > 0) != (b > 0) and a != b and a * b < 0:
                    out.append(p + a / (a - b) * (q - p))
            ring = np.array(out).reshape(-1, 2)
    return ring


def _clip_all(rings: list[np.ndarray], low: np.ndarray, size: float) -> list[np.ndarray]:
    """Each ring's part in its box (low, with sides of size). Where all edges run along the axes, corners outside
    move to the box's nearest points, all rings at once; others are clipped one by one."""
    sizes = np.array([len(r) for r in rings], np.int64)
    if not sizes.sum():
        return rings
    flat, ends = np.concatenate(rings), np.cumsum(sizes)
    of, first = np.repeat(np.arange(len(rings)), sizes), ends - sizes
    after = np.arange(len(flat)) + 1
    after[ends[sizes > 0] - 1] = first[sizes > 0]
    low, high = low[of], low[of] + size
    slanted = np.bincount(of, ((flat != flat[after]).all(axis=1)) | ~np.isfinite(flat).all(axis=1), len(rings)) > 0
    moved = np.clip(flat, low, high)
    out = []
    for k, r in enumerate(np.split(moved, ends[:-1])):
        if slanted[k]:
            r = _clip(rings[k], tuple(low[first[k]]), tuple(high[first[k]]))
        elif len(r):
            r = r[(r != np.roll(r, 1, axis=0)).any(axis=1)]
            if len(r) and (np.ptp(r, axis=0) == 0).any():
                r = r[:0]
        out.append(r)
    return out


def common_area(groups: list[list[np.ndarray]]) -> float:
    """The area of what lies in at least one ring of each group.

    Level lines through all corners and crossings cut the plane into slabs in which no edges cross; in a
    slab the edges are walked from left to right, and each changes whether its ring is inside.
    """
    rings = [(g, r) for g, group in enumerate(groups) for r in group if len(r) > 2]
    if not rings:
        return 0.0
    a = np.concatenate([r for _, r in rings])
    b = np.concatenate([np.roll(r, -1, axis=0) for _, r in rings])
    of = np.repeat(np.arange(len(rings)), [len(r) for _, r in rings])
    slanted = a[:, 1] != b[:, 1]
    a, b, of = a[slanted], b[slanted], of[slanted]
    swap = a[:, 1] > b[:, 1]
    a[swap], b[swap] = b[swap], a[swap].copy()
    levels = [a[:, 1], b[:, 1]]
    d = b - a
    for k in range(len(a) - 1):  # crossings of edge k with all later ones
        cross = d[k, 0] * d[k + 1 :, 1] - d[k, 1] * d[k + 1 :, 0]
        gap = a[k + 1 :] - a[k]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (gap[:, 0] * d[k + 1 :, 1] - gap[:, 1] * d[k + 1 :, 0]) / cross
            u = (gap[:, 0] * d[k, 1] - gap[:, 1] * d[k, 0]) / cross
        met = (t > 0) & (t < 1) & (u > 0) & (u < 1)
        levels.append(a[k, 1] + t[met] * d[k, 1])
    ys = np.unique(np.concatenate(levels))
    group = np.array([g for g, _ in rings])
    total = 0.0
    for low, high in zip(ys[:-1], ys[1:], strict=True):
        live = np.flatnonzero((a[:, 1] <= low) & (b[:, 1] >= high))
        if len(live) < 2:
            continue
        left = a[live, 0] + (low - a[live, 1]) / d[live, 1] * d[live, 0]
        right = a[live, 0] + (high - a[live, 1]) / d[live, 1] * d[live, 0]
        order = np.argsort(left + right, kind="stable")
        r = of[live[order]]
        # an edge enters its ring if an even number of the ring's edges lie left of it, else it leaves
        alike = np.argsort(r, kind="stable")
        start = np.flatnonzero(np.r_[True, np.diff(r[alike]) != 0])
        nth = np.empty(len(r), np.int64)
        nth[alike] = np.arange(len(r)) - np.repeat(start, np.diff(np.r_[start, len(r)]))
        step = np.zeros((len(groups), len(r)), np.int64)
        step[group[r], np.arange(len(r))] = 1 - 2 * (nth % 2)
        open_ = (np.cumsum(step, axis=1)[:, :-1] > 0).all(axis=0)
        wide = np.diff(left[order]) + np.diff(right[order])
        total += float(wide[open_].sum()) / 2 * (high - low)
    return float(total)


def _points(column: pa.Array) -> list[np.ndarray]:
    """Rings as arrays without their repeated last point."""
    flat, ends = column.flatten(), np.cumsum([len(x) for x in column])
    xy = np.stack([flat.field("x").to_numpy(zero_copy_only=False), flat.field("y").to_numpy(zero_copy_only=False)], axis=1) if len(flat) else np.zeros((0, 2))
    return [r[:-1] if len(r) and (r[0] == r[-1]).all() else r for r in np.split(xy, ends[:-1])] if len(column) else []


def in_cells(df: DataFrame, key: str, size: float, name: str) -> DataFrame:
    """Rows (key, cx, cy, name): the pieces of each ring in the grid cells that it touches, without empty ones."""
    cell = lambda v: F.floor(v / size).cast("long")
    left, bottom, right, top = ring_box("ring")
    wide = df.select(key, "ring", F.explode(F.sequence(cell(left), cell(right))).alias("cx"), cell(bottom).alias("_b"), cell(top).alias("_t")).select(key, "ring", "cx", F.explode(F.sequence("_b", "_t")).alias("cy"))
    kind = df.schema[key].dataType.simpleString()

    def clip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cx, cy = (batch.column(c).to_numpy() for c in ("cx", "cy"))
            made = _clip_all(_points(batch.column("ring")), np.stack([cx, cy], axis=1) * size, size)
            kept = pa.array([k for k, r in enumerate(made) if len(r) > 2], pa.int64())
            rings = [r for r in made if len(r) > 2]
            xy = np.concatenate([np.zeros((0, 2)), *rings])
            offsets = np.cumsum([0, *map(len, rings)], dtype=np.int32)
            listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([xy[:, 0].copy(), xy[:, 1].copy()], names=["x", "y"]))
            yield pa.RecordBatch.from_arrays([batch.column(key).take(kept), batch.column("cx").take(kept), batch.column("cy").take(kept), listed], names=[key, "cx", "cy", name])

    return wide.mapInArrow(clip, f"{key} {kind}, cx long, cy long, {name} {RING}")


# --- many polygons ---------------------------------------------------------------------------------


def overlaid(one: DataFrame, other: DataFrame, key: str = "id", other_key: str = "location_id", size: float = 500.0) -> DataFrame:
    """Shares of each ring of one (key, ring) that lie in rings of the other: (key, other_key, area, share).

    Pairs meet in cells by an equality join and are measured there; pairs that only touch have no row.
    """
    met = in_cells(one, key, size, "_a").join(in_cells(other, other_key, size, "_b"), ["cx", "cy"])
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((one, key), (other, other_key))}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            areas = [common_area([[a], [b]]) for a, b in zip(_points(batch.column("_a")), _points(batch.column("_b")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column(other_key), pa.array(areas, pa.float64())], names=[key, other_key, "area"])

    pieces = met.select(key, other_key, "_a", "_b").mapInArrow(measure, f"{key} {kinds[key]}, {other_key} {kinds[other_key]}, area double")
    summed = pieces.groupBy(key, other_key).agg(F.sum("area").alias("area")).filter("area > 0")
    whole = one.select(key, F.abs(signed_area(F.col("ring"))).alias("_whole"))
    return summed.join(whole, key).select(key, other_key, "area", safe_ratio(F.col("area"), F.col("_whole")).alias("share"))


def covered_areas(zones: DataFrame, parks: DataFrame, size: float = 500.0) -> DataFrame:
    """For each zone (location_id, ring) the area that at least one park (ring) covers, and its share.

    Parks that overlap or repeat count once. Cells with more than MOST_RINGS different pieces are cut in
    four, again and again, so that no task meets a whole crowd. A zone without parks has 0.
    """
    areas = zones.select("location_id", F.abs(signed_area(F.col("ring"))).alias("_whole"))
    ring = parks.select("ring").filter("ring is not null").distinct().repartition(parts(parks)).withColumn("id", F.lit(0))
    found, zone_rings = None, zones.select("location_id", "ring")
    for cut in range(MOST_CUTS + 1):
        side = size / 2**cut
        # written, as both the areas and the next cut read them; else each cut would do all those before it twice
        pieces = written(in_cells(ring, "id", side, "_park").select("cx", "cy", "_park"), "pieces")
        each = pieces.groupBy("cx", "cy").agg(F.count("*").alias("_n"), F.slice(F.collect_set("_park"), 1, MOST_RINGS + 1).alias("_parks") if cut < MOST_CUTS else F.collect_set("_park").alias("_parks"))
        each = written(each, "cells")
        full = F.size("_parks") > MOST_RINGS if cut < MOST_CUTS else F.lit(False)
        zone_pieces = written(in_cells(zone_rings, "location_id", side, "_zone"), "zones")
        part = zone_pieces.join(each.filter(~full).select("cx", "cy", "_parks"), ["cx", "cy"])
        kind = zones.schema["location_id"].dataType.simpleString()

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parks_of = [_points(p.values) for p in batch.column("_parks")]
                areas = [common_area([[z], ps]) for z, ps in zip(_points(batch.column("_zone")), parks_of, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("location_id"), pa.array(areas, pa.float64())], names=["location_id", "area"])

        made = part.select("location_id", "_zone", "_parks").repartition(parts(part)).mapInArrow(measure, f"location_id {kind}, area double")
        found = made if found is None else found.unionByName(made)
        crowded = each.filter(full)
        if cut == MOST_CUTS or crowded.isEmpty():
            break
        # only the pieces in crowded cells go on
        keys = crowded.select("cx", "cy")
        ring = pieces.join(keys, ["cx", "cy"]).select(F.col("_park").alias("ring")).distinct().repartition(parts(pieces)).withColumn("id", F.lit(0))
        zone_rings = zone_pieces.join(keys, ["cx", "cy"]).select("location_id", F.col("_zone").alias("ring"))
    summed = found.groupBy("location_id").agg(F.sum("area").alias("park_area"))
    out = areas.join(summed, "location_id", "left").withColumn("park_area", F.coalesce("park_area", F.lit(0.0)))
    return out.select("location_id", "park_area", safe_ratio(F.col("park_area"), F.col("_whole")).alias("park_area_ratio"))


def dissolved(zones: DataFrame, group: str, places: int = 6, size: float = 500.0) -> DataFrame:
    """Outlines of groups of adjoining rings: (group, ring_no, ring, area), area below 0 for a hole.

    Edges are cut where a corner of the same group lies on them, and edges that two rings of a group
    share, one in each direction, cancel; what is left is walked into rings. Only this walk needs a
    group's outline in one task, as its row does. Rows without a group or a ring are left out; a ring
    that lies on another one isn't united with it.
    """
    r = lambda c: F.round(c, places) + F.lit(0.0)  # noqa: E731  (no -0.0)
    tidy = F.transform("ring", lambda p: F.struct(r(p["x"]).alias("x"), r(p["y"]).alias("y")))
    rows = zones.filter(F.col(group).isNotNull() & (F.size("ring") > 3)).select(F.col(group).alias("g"), tidy.alias("ring"))
    rows = rows.withColumn("ring", F.when(signed_area(F.col("ring")) < 0, F.reverse("ring")).otherwise(F.col("ring")))
    edge = rows.select("g", F.explode(_edges(F.col("ring"))).alias("e")).filter((F.col("e.a.x") != F.col("e.b.x")) | (F.col("e.a.y") != F.col("e.b.y")))
    edge = edge.select("g", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by"))
    corner = rows.select("g", F.explode("ring").alias("p")).select("g", F.col("p.x").alias("x"), F.col("p.y").alias("y")).distinct()
    cell = lambda v: F.floor(v / size).cast("long")
    wide = edge.distinct().select("*", F.explode(F.sequence(cell(F.least("ax", "bx")), cell(F.greatest("ax", "bx")))).alias("cx")).select("*", F.explode(F.sequence(cell(F.least("ay", "by")), cell(F.greatest("ay", "by")))).alias("cy"))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    long = F.hypot(dx, dy)
    off = F.abs((F.col("x") - F.col("ax")) * dy - (F.col("y") - F.col("ay")) * dx) / long
    t = ((F.col("x") - F.col("ax")) * dx + (F.col("y") - F.col("ay")) * dy) / (long * long)
    on = (off <= 10.0**-places) & (t > 0) & (t < 1) & ~((F.col("x") == F.col("ax")) & (F.col("y") == F.col("ay"))) & ~((F.col("x") == F.col("bx")) & (F.col("y") == F.col("by")))
    ends = ["g", "ax", "ay", "bx", "by"]
    cuts = wide.join(corner.withColumns({"cx": cell(F.col("x")), "cy": cell(F.col("y"))}), ["g", "cx", "cy"]).filter(on)
    cuts = cuts.groupBy(*ends).agg(F.array_sort(F.collect_set(F.struct(t.alias("t"), "x", "y"))).alias("_cuts"))
    chain = F.concat(F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"))), F.transform(F.coalesce("_cuts", F.array().cast("array<struct<t: double, x: double, y: double>>")), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))), F.array(F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))))
    small = edge.join(cuts, ends, "left").select("g", F.explode(_edges(chain)).alias("e"))
    a, b = F.struct("e.a.x", "e.a.y"), F.struct("e.b.x", "e.b.y")
    net = small.select("g", F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.when(a < b, 1).otherwise(-1).alias("way")).groupBy("g", "a", "b").agg(F.sum("way").alias("way")).filter("way <> 0")
    first, last = F.when(F.col("way") > 0, F.col("a")).otherwise(F.col("b")), F.when(F.col("way") > 0, F.col("b")).otherwise(F.col("a"))
    left = net.select("g", first.alias("p"), last.alias("q")).select("g", F.col("p.x").alias("ax"), F.col("p.y").alias("ay"), F.col("q.x").alias("bx"), F.col("q.y").alias("by"))
    kind = rows.schema["g"].dataType.simpleString()

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        rings = _walked([((r.ax, r.ay), (r.bx, r.by)) for r in pdf.itertuples(index=False)])
        areas = [sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring[:-1], ring[1:], strict=True)) / 2 for ring in rings]
        return pd.DataFrame({"g": [pdf["g"].iloc[0]] * len(rings), "ring_no": range(len(rings)), "ring": [[{"x": x, "y": y} for x, y in ring] for ring in rings], "area": areas})

    return left.groupBy("g").applyInPandas(walk, f"g {kind}, ring_no int, ring {RING}, area double").withColumnRenamed("g", group)


def _walked(edges: list[tuple[tuple[float, float], tuple[float, float]]]) -> list[list[tuple[float, float]]]:
    """Directed edges as closed rings, each from its least corner; the rightmost turn is taken where several edges
    go on, so rings that touch in a corner stay apart. Corners in the middle of a straight line are left out."""
    after: dict[tuple[float, float], list[tuple[float, float]]] = {}
    for a, b in sorted(edges):
        after.setdefault(a, []).append(b)
    rings = []
    for start in sorted(after):
        while after[start]:
            ring, here = [start], after[start].pop(0)
            before = start
            while here != start:
                ring.append(here)
                back = np.arctan2(before[1] - here[1], before[0] - here[0])
                ways = after[here]
                best = min(range(len(ways)), key=lambda k: (back - np.arctan2(ways[k][1] - here[1], ways[k][0] - here[0])) % (2 * np.pi) or 2 * np.pi) if len(ways) > 1 else 0
                before, here = here, ways.pop(best)
            n = len(ring)
            turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - q[1]) - (q[1] - p[1]) * (r[0] - q[0])
            kept = [q for k, q in enumerate(ring) if abs(turn(ring[k - 1], q, ring[(k + 1) % n])) > 1e-9]
            if len(kept) > 2:
                low = kept.index(min(kept))
                kept = kept[low:] + kept[:low]
                rings.append([*kept, kept[0]])
    return sorted(rings)


def _meet(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two rings touch, cross, or lie in one another."""
    p, q = np.concatenate([a, a[:1]]), np.concatenate([b, b[:1]])
    if ((a.max(axis=0) < b.min(axis=0)) | (b.max(axis=0) < a.min(axis=0))).any():
        return False
    return _apart(p, q) <= 1e-9 or _inside(a[0], q) or _inside(b[0], p)


def _inside(point: np.ndarray, ring: np.ndarray) -> bool:
    a, b = ring[:-1], ring[1:]
    up = (a[:, 1] > point[1]) != (b[:, 1] > point[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        x = a[:, 0] + (point[1] - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0])
    return bool((up & (x > point[0])).sum() % 2)


def _apart(p: np.ndarray, q: np.ndarray) -> float:
    """The least distance of two closed lines; 0 if they cross."""

    def one_way(points: np.ndarray, line: np.ndarray) -> float:
        a, d = line[:-1], np.diff(line, axis=0)
        rel = points[:, None] - a[None]
        t = np.clip((rel * d).sum(axis=2) / np.maximum((d * d).sum(axis=1), 1e-300), 0, 1)
        return float(np.sqrt(((rel - t[..., None] * d) ** 2).sum(axis=2)).min())

    a, c = p[:-1, None], q[None, :-1]
    r, s = np.diff(p, axis=0)[:, None], np.diff(q, axis=0)[None]
    cross = lambda u, v: u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]
    area = cross(r, s)
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = cross(c - a, s) / area, cross(c - a, r) / area
    if ((t > 0) & (t < 1) & (u > 0) & (u < 1)).any():
        return 0.0
    return min(one_way(p[:-1], q), one_way(q[:-1], p))


def adjacent(zones: DataFrame, size: float = 500.0) -> DataFrame:
    """Pairs of zones (a < b) whose rings touch, cross or lie in one another; pairs meet in grid cells of their boxes."""
    cell = lambda v: F.floor(v / size).cast("long")
    left, bottom, right, top = ring_box("ring")
    wide = zones.select("location_id", "ring", F.explode(F.sequence(cell(left), cell(right))).alias("cx"), cell(bottom).alias("_b"), cell(top).alias("_t")).select("location_id", "ring", "cx", F.explode(F.sequence("_b", "_t")).alias("cy"))
    keys = wide.select("location_id", "cx", "cy")
    pairs = keys.withColumnRenamed("location_id", "a").join(keys.withColumnRenamed("location_id", "b"), ["cx", "cy"]).filter("a < b").select("a", "b").distinct()
    side = lambda n: zones.select(F.col("location_id").alias(n), F.col("ring").alias(f"_{n}"))
    kind = zones.schema["location_id"].dataType.simpleString()

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = pa.array([_meet(x, y) for x, y in zip(_points(batch.column("_a")), _points(batch.column("_b")), strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(met)

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "_a", "_b").mapInArrow(test, f"a {kind}, b {kind}")


def regions(zones: DataFrame, count: int) -> DataFrame:
    """Zones (location_id, ring) merged into count regions: (location_id, region).

    The region of least area joins, again and again, the neighbour of least area, or, if it touches none,
    the nearest region; ties go by the least zone. Regions are numbered from 1 by their least zone. Areas of
    zones add up, as zones don't overlap. It is one chain of decisions over a small graph, so one task
    takes it; more than MOST_ZONES zones are refused.
    """
    rows = zones.filter("ring is not null").select("location_id", "ring", F.abs(signed_area(F.col("ring"))).alias("area"))
    touching = adjacent(zones.filter("ring is not null"))
    links = touching.unionByName(touching.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.collect_list("b").alias("near"))
    kind = zones.schema["location_id"].dataType.simpleString()
    if rows.limit(MOST_ZONES + 1).count() > MOST_ZONES:
        raise ValueError(f"more than {MOST_ZONES} zones")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rings = {r.location_id: [np.array([(p["x"], p["y"]) for p in r.ring])] for r in pdf.itertuples(index=False)}
        area = dict(zip(pdf["location_id"], pdf["area"], strict=True))
        near = {r.location_id: set(r.near) if r.near is not None else set() for r in pdf.itertuples(index=False)}
        members = {k: [k] for k in rings}
        queue = [(v, k) for k, v in area.items()]
        heapq.heapify(queue)
        while len(members) > max(1, count):
            size, source = heapq.heappop(queue)
            if source not in members or size != area[source]:
                continue  # it has grown or gone since
            if near[source]:
                target = min(near[source], key=lambda k: (area[k], k))
            else:
                target = min((k for k in members if k != source), key=lambda k: (min(_apart(p, q) for p in rings[source] for q in rings[k]), k))
            members[target] += members.pop(source)
            rings[target] += rings.pop(source)
            area[target] += area.pop(source)
            heapq.heappush(queue, (area[target], target))
            for k in near.pop(source):
                near[k].discard(source)
                if k != target:
                    near[k].add(target)
                    near[target].add(k)
        listed = sorted(members.values(), key=min)
        return pd.DataFrame([(z, k) for k, group in enumerate(listed, 1) for z in group], columns=["location_id", "region"])

    return rows.join(links, rows["location_id"] == links["a"], "left").drop("a").groupBy().applyInPandas(merge, f"location_id {kind}, region int")


def region_points(zones: DataFrame, of: DataFrame) -> DataFrame:
    """The point that stands for each region: the mean of its zones' points (x, y), or the nearest point of its
    zones' outlines if that lies in none of them. zones: location_id, ring, x, y; of: location_id, region."""
    rows = zones.join(of, "location_id")
    mean = rows.groupBy("region").agg(F.avg("x").alias("_mx"), F.avg("y").alias("_my"))
    met = rows.select("region", "ring").join(mean, "region")
    near = nearest_on_ring(F.col("_mx"), F.col("_my"), F.col("ring"))
    found = met.select("region", "_mx", "_my", inside_polygon(F.col("_mx"), F.col("_my"), F.col("ring")).alias("_in"), near.alias("_near"))
    each = found.groupBy("region").agg(F.max("_in").alias("_in"), F.first("_mx").alias("_mx"), F.first("_my").alias("_my"), F.min("_near").alias("_near"))
    return each.select("region", F.when(F.col("_in"), F.col("_mx")).otherwise(F.col("_near.x")).alias("x"), F.when(F.col("_in"), F.col("_my")).otherwise(F.col("_near.y")).alias("y"), (~F.col("_in")).alias("snapped"))


def zone_master(zones: DataFrame) -> DataFrame:
    """Zones (location_id, borough, ring) with their area and a point inside; rows without a ring keep nulls."""
    x, y = inner_point(F.col("ring"))
    return zones.select("location_id", "borough", "ring", F.abs(signed_area(F.col("ring"))).alias("area"), x.alias("x"), y.alias("y"))
