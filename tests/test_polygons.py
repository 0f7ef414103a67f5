"""Polygons against rasters, closed forms and plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from smoothway.operators import polygons, polylines, roads, spatial
from smoothway.plans import catalog, geometry_catalog
from smoothway.plans.adapters import spark_view

RING = "array<struct<x: double, y: double>>"


def closed(points):
    return [(float(x), float(y)) for x, y in [*points, points[0]]]


def star(rng, x, y, size, n=9):
    """A ring of n corners around a point that is hardly ever convex."""
    a = np.sort(rng.uniform(0, 2 * np.pi, n))
    r = rng.uniform(0.3, 1.0, n) * size
    return closed(list(zip(x + r * np.cos(a), y + r * np.sin(a), strict=True)))


def frame(spark, rows, key="location_id"):
    return spark.createDataFrame(rows, f"{key} int, ring {RING}")


def raster(rings, step=0.5, side=100):
    """For each ring the squares whose middle it holds."""
    at = np.arange(step / 2, side, step)
    x, y = (v.ravel() for v in np.meshgrid(at, at))
    out = []
    for ring in rings:
        inside = np.zeros(len(x), dtype=bool)
        for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:], strict=True):
            if ay != by:
                inside ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
        out.append(inside)
    return out, step * step


@pytest.mark.parametrize("size", [30.0, 500.0])
def test_overlay_against_a_raster(spark, size):
    rng = np.random.default_rng(4)
    one, two = ([star(rng, *rng.uniform(25, 75, 2), 22) for _ in range(n)] for n in (6, 5))
    found = {(r["id"], r["location_id"]): r for r in polygons.overlaid(frame(spark, list(enumerate(one)), "id"), frame(spark, list(enumerate(two))), size=size).collect()}
    a, unit = raster(one)
    b, _ = raster(two)
    for i in range(6):
        for j in range(5):
            want, got = (a[i] & b[j]).sum() * unit, found[i, j]["area"] if (i, j) in found else 0.0
            assert abs(want - got) < 12
            if got > 100:
                assert abs(found[i, j]["share"] - want / (a[i].sum() * unit)) < 0.02


@pytest.mark.parametrize("most", [2, 64])
def test_park_union_against_a_raster(spark, monkeypatch, most):
    monkeypatch.setattr(polygons, "MOST_RINGS", most)
    monkeypatch.setattr(polygons, "MOST_CUTS", 3)
    rng = np.random.default_rng(8)
    zones, parks = [star(rng, *p, 30) for p in ((35, 35), (65, 60), (40, 70))], [star(rng, *rng.uniform(20, 80, 2), 9) for _ in range(30)]
    parks += parks[:10]  # copies count once
    away = closed([(500, 500), (510, 500), (510, 510)])
    found = {r["location_id"]: r for r in polygons.covered_areas(frame(spark, list(enumerate([*zones, away]))), frame(spark, [(0, p) for p in parks]), size=60.0).collect()}
    z, unit = raster(zones)
    p, _ = raster(parks)
    for k in range(3):
        want = (z[k] & np.any(p, axis=0)).sum() * unit
        assert abs(found[k]["park_area"] - want) < 25
        assert abs(found[k]["park_area_ratio"] - want / (z[k].sum() * unit)) < 0.02
    assert found[3]["park_area"] == 0


def test_common_area_of_overlapping_copies_is_exact():
    square = np.array([(0, 0), (4, 0), (4, 4), (0, 4)], dtype=float)
    assert polygons.common_area([[square], [square + 1, square + 1, square + 2]]) == pytest.approx(9)
    assert polygons.common_area([[square], [square + 4]]) == 0
    assert polygons.common_area([[square], []]) == 0


def test_dissolve_with_a_hole_corners_in_edges_and_touching_corners(spark):
    box = lambda x, y, w=1, h=1: closed([(x, y), (x + w, y), (x + w, y + h), (x, y + h)])
    around = [(1, box(x, y)) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    stepped = [(2, box(10, 0, 2, 1)), (2, box(10, 1, 1, 1)), (2, list(reversed(box(11, 1, 1, 1)))), (2, box(12, 0.5, 1, 1))]  # the last meets the middle of two edges
    corners = [(3, box(20, 0)), (3, box(21, 1))]
    rows = [(g, r) for g, r in around + stepped + corners] + [(None, box(0, 0)), (4, None)]
    found = polygons.dissolved(spark.createDataFrame(rows, f"b int, ring {RING}"), "b", size=5.0).collect()
    told = {}
    for r in found:
        told.setdefault(r["b"], []).append((round(r["area"], 6), len(r["ring"]) - 1))
    assert sorted(told[1]) == [(-1.0, 4), (9.0, 4)]
    assert told[2] == [(5.0, 8)]
    assert told[3] == [(1.0, 4), (1.0, 4)]
    assert set(told) == {1, 2, 3}


def test_adjacent_rings(spark):
    rows = [(1, closed([(0, 0), (10, 0), (10, 10), (0, 10)])), (2, closed([(10, 2), (14, 2), (14, 4)])), (3, closed([(3, 3), (4, 3), (4, 4)])), (4, closed([(10.5, 3.9), (12, 9), (10.5, 9)])), (5, closed([(20, 20), (21, 20), (21, 21)]))]
    found = polygons.adjacent(frame(spark, rows), size=3.0).collect()
    assert sorted(map(tuple, found)) == [(1, 2), (1, 3)]


def plain_regions(boxes, count):
    """The greedy loop over boxes (x, y, w, h) by location_id."""
    members, area = {k: {k} for k in boxes}, {k: b[2] * b[3] for k, b in boxes.items()}
    gap = lambda a, b: np.hypot(max(0, b[0] - a[0] - a[2], a[0] - b[0] - b[2]), max(0, b[1] - a[1] - a[3], a[1] - b[1] - b[3]))
    far = lambda s, t: min(gap(boxes[a], boxes[b]) for a in members[s] for b in members[t])
    while len(members) > count:
        source = min(members, key=lambda k: (area[k], k))
        touching = [k for k in members if k != source and far(source, k) == 0]
        target = min(touching, key=lambda k: (area[k], k)) if touching else min((k for k in members if k != source), key=lambda k: (far(source, k), k))
        members[target] |= members.pop(source)
        area[target] += area.pop(source)
    return {z: n for n, group in enumerate(sorted(members.values(), key=min), 1) for z in group}


@pytest.mark.parametrize("count", [1, 4, 9, 40])
def test_regions_against_the_plain_loop(spark, count):
    rng = random.Random(count)
    # a grid of boxes of different sizes with gaps between some of them, so that some are islands
    boxes = {3 * k + 1: (10.0 * (k % 6), 10.0 * (k // 6), 10.0 if rng.random() < 0.6 else rng.uniform(3, 9), 10.0 if rng.random() < 0.6 else rng.uniform(3, 9)) for k in range(30)}
    rows = [(k, closed([(x, y), (x + w, y), (x + w, y + h), (x, y + h)])) for k, (x, y, w, h) in boxes.items()]
    found = {r["location_id"]: r["region"] for r in polygons.regions(frame(spark, rows), count).collect()}
    assert found == plain_regions(boxes, count)


def test_g6_regions_of_the_given_zones(spark, sf_dir):
    found = catalog.QUERIES["g6_regions"](spark, sf_dir).collect()
    assert len(found) == 25 and {r["region"] for r in found} == set(range(1, 9))


def test_too_many_zones_are_refused(spark, monkeypatch):
    monkeypatch.setattr(polygons, "MOST_ZONES", 1)
    with pytest.raises(ValueError, match="more than 1"):
        polygons.regions(frame(spark, [(k, closed([(k, 0), (k + 1, 0), (k, 1)])) for k in range(3)]), 2)


def test_points_in_and_on_regions(spark):
    u = closed([(0, 0), (9, 0), (9, 9), (6, 9), (6, 3), (3, 3), (3, 9), (0, 9)])
    rows = spark.createDataFrame([(1, u, 4.5, 8.0), (2, closed([(20, 0), (22, 0), (22, 2), (20, 2)]), 21.0, 1.0)], f"location_id int, ring {RING}, x double, y double")
    of = spark.createDataFrame([(1, 1), (2, 2)], "location_id int, region int")
    found = {r["region"]: (r["x"], r["y"], r["snapped"]) for r in polygons.region_points(rows, of).collect()}
    assert found == {1: (3.0, 8.0, True), 2: (21.0, 1.0, False)}  # of two equally near points the lesser
    x, y = polygons.inner_point(F.col("ring"))
    inner = rows.select("location_id", x.alias("px"), y.alias("py"), spatial.inside_polygon(x, y, F.col("ring")).alias("inside")).collect()
    assert all(r["inside"] for r in inner)
    assert (inner[0]["px"], inner[0]["py"]) in {(1.5, 6.0), (7.5, 6.0)}
    assert rows.select(polygons.signed_area(F.col("ring")).alias("a")).collect()[0]["a"] == 63.0


# --- bent roads ------------------------------------------------------------------------------------


def test_points_along_a_line(spark):
    rows = [(1, [(0.0, 0.0), (3.0, 0.0), (3.0, 1.0)]), (2, [(0.0, 0.0), (0.0, 0.0), (2.0, 0.0)]), (3, [(5.0, 5.0), (5.0, 5.0)]), (4, [(1.0, 1.0)])]
    lines = spark.createDataFrame(rows, f"k int, line {RING}")
    at = lambda share: [tuple(r) for r in lines.select(*[c.alias(n) for c, n in zip(roads.point_along(F.col("line"), share), "xy", strict=True)]).collect()]
    assert at(0.5) == [(2.0, 0.0), (1.0, 0.0), (5.0, 5.0), (None, None)]
    assert at(1.0)[:2] == [(3.0, 1.0), (2.0, 0.0)]
    assert at(0.0)[0] == (0.0, 0.0)


@pytest.mark.parametrize("most", [0, 1 << 30])
def test_candidates_on_bent_roads_against_all_pairs(spark, most):
    """Both ways of joining: legs broadcast, and both sides dealt by cell."""
    rng = np.random.default_rng(6)
    lines = [(f"s{k}", "WAT"[k % 3], [tuple(p) for p in np.round(rng.uniform(0, 300, 2) + np.cumsum(rng.uniform(-30, 30, (rng.integers(2, 7), 2)), axis=0), 2).tolist()]) for k in range(60)]
    lines.append(("tie", "T", [(400.0, 0.0), (410.0, 0.0), (410.0, 10.0)]))
    points = [(k, *np.round(rng.uniform(0, 300, 2), 2).tolist(), float(rng.uniform(0, 360))) for k in range(150)] + [(900, 415.0, -5.0, 10.0), (901, None, 3.0, None), (902, 9e5, 3.0, None)]
    roads_df = spark.createDataFrame(lines, f"segment_id string, traffic_direction string, line {RING}")
    found = polylines.candidates(spark.createDataFrame(points, "event_id int, x double, y double, heading double"), roads_df, most_bytes=most).collect()
    got = {(r["event_id"], r["segment_id"]): (r["leg"], r["distance_m"], r["along_m"]) for r in found}
    assert len(got) == len(found)
    want = {}
    for k, x, y, _ in points:
        for name, _, line in lines:
            best = None
            for leg, (a, b) in enumerate(zip(line[:-1], line[1:], strict=True)):
                if x is None:
                    continue
                d = np.subtract(b, a)
                t = min(1.0, max(0.0, float(np.dot(np.subtract((x, y), a), d) / np.dot(d, d))))
                far = float(np.hypot(*(np.subtract((x, y), a) - t * d)))
                along = sum(float(np.hypot(*np.subtract(q, p))) for p, q in zip(line[:leg], line[1 : leg + 1], strict=True)) + t * float(np.hypot(*d))
                if best is None or round(far, 6) < round(best[1], 6):
                    best = (leg, far, along)
            if best and best[1] <= 30:
                want[k, name] = best
        if not any(key[0] == k for key in want):
            want[k, None] = (None, None, None)
    assert set(got) == set(want)
    for key, (leg, far, along) in want.items():
        assert got[key][0] == leg
        if leg is not None:
            assert got[key][1:] == pytest.approx((far, along), abs=1e-6)
    assert got[900, "tie"] == (0, pytest.approx(50**0.5), 10.0)


def test_all_given_events_come_out_once(spark, sf_dir):
    read = lambda v: spark_view(spark, sf_dir, v)
    found = polylines.match(read("sensor_events"), geometry_catalog.bent(read))
    assert found.count() == read("sensor_events").count() == found.select("event_id").distinct().count()
