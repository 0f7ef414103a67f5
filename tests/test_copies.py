"""Rows that are alike in all that an operator looks at cost it no more than one of them."""

import os
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from smoothway.operators import polygons, roads, spatial
from smoothway.plans import catalog
from smoothway.sources import publish
from smoothway.streaming import raw
from tests.compare import assert_same

KEYS = {"events": "event_id", "part": "p_partkey"}
TIMES = 20


@pytest.fixture
def copies(spark, duck, sf_dir, tmp_path):
    """The tables with events and parts repeated: 18,000 keys on, a point is at the same place on the same street."""
    con = duck.cursor()
    for path in Path(sf_dir).glob("*.parquet"):
        rows = f"SELECT * FROM read_parquet('{path}')"
        if path.stem in KEYS:
            k = KEYS[path.stem]
            rows = f"SELECT * REPLACE ({k} + 18000 * n AS {k}) FROM read_parquet('{path}'), range({TIMES}) r(n)"
        con.execute(f"COPY ({rows}) TO '{tmp_path}/{path.name}'")
        con.execute(f"CREATE TEMP VIEW {path.stem} AS SELECT * FROM read_parquet('{tmp_path}/{path.name}')")
    return str(tmp_path), con


@pytest.mark.parametrize("name", ["j1_road_candidates", "j3_map_matching", "f9_match_quarantine", "j1_polyline_candidates", "j3_polyline_matching", "m5_line_distance"])
def test_a_place_is_looked_for_once(spark, sf_dir, copies, monkeypatch, name):
    seen, plain = [], spatial.in_grid

    def watched(points, *rest, **options):
        seen.append(points.count())
        return plain(points, *rest, **options)

    monkeypatch.setattr(spatial, "in_grid", watched)
    catalog.QUERIES[name](spark, sf_dir)
    assert_same(catalog.QUERIES[name](spark, copies[0]), copies[1], catalog.ORACLES[name])
    assert seen[1] <= 2 * seen[0]  # whether an event has a heading may differ between copies


@pytest.mark.parametrize(("name", "module"), [("j11_pavement", spatial), ("j11_polyline_pavement", spatial), ("j32_degree_pavement", spatial), ("j12_speed_humps", roads), ("j12_polyline_humps", roads), ("j32_degree_humps", roads)])
def test_ratings_and_humps_at_one_place_meet_a_road_once(spark, sf_dir, copies, monkeypatch, name, module):
    assert_same(catalog.QUERIES[name](spark, copies[0]), copies[1], catalog.ORACLES[name])
    measured = spark.sparkContext.accumulator(0)

    def distance(*ends):
        measured.add(1)
        return 1.0

    monkeypatch.setattr(module, "segment_distance", lambda *ends: F.udf(distance, "double")(*ends))
    counts = []
    for path in (sf_dir, copies[0]):
        before = measured.value
        catalog.QUERIES[name](spark, path).collect()
        counts.append(measured.value - before)
    assert 0 < counts[1] <= 2 * counts[0]  # other copies may be known at the date


@pytest.mark.parametrize("name", ["j32_degree_pavement", "j12_speed_humps", "j32_degree_humps"])
def test_roads_stay_dealt_to_all_tasks(spark, sf_dir, name):
    found = catalog.QUERIES[name](spark, sf_dir)
    assert found.rdd.getNumPartitions() >= spatial.parts(found)  # few bytes, so Spark puts what it may into one task


def test_points_without_coordinates_or_heading_stay(spark):
    points = spark.createDataFrame([(1, 5.0, 5.0, 90.0), (2, 5.0, 5.0, 90.0), (3, 5.0, 5.0, None), (4, None, 5.0, 90.0), (5, None, None, None), (6, 900.0, 5.0, 90.0)], "event_id int, x double, y double, heading double")
    lines = spark.createDataFrame([("a", 0.0, 0.0, 10.0, 0.0, "W"), ("b", 0.0, 9.0, 10.0, 9.0, "T")], "segment_id string, x0 double, y0 double, x1 double, y1 double, traffic_direction string")
    found = {r["event_id"]: (r["segment_id"], r["candidate_count"]) for r in spatial.match(points, lines).collect()}
    assert found == {1: ("b", 2), 2: ("b", 2), 3: ("b", 2), 4: (None, 0), 5: (None, 0), 6: (None, 0)}


def _box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def test_parks_are_read_once_however_often_cells_are_cut(spark):
    read = spark.sparkContext.accumulator(0)
    rng = np.random.default_rng(5)
    boxes = [_box(float(x), float(y), float(w), float(h)) for x, y, w, h in np.column_stack([rng.integers(0, 40, 400), rng.integers(0, 40, 400), rng.integers(1, 6, 400), rng.integers(1, 6, 400)])]

    def watched(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    parks = spark.createDataFrame([([{"x": a, "y": b} for a, b in r],) for r in boxes], f"ring {polygons.RING}").mapInArrow(watched, f"ring {polygons.RING}")
    zones = spark.createDataFrame([(1, [{"x": a, "y": b} for a, b in _box(0.0, 0.0, 40.0, 40.0)])], f"location_id int, ring {polygons.RING}")
    squares = np.zeros((50, 50), bool)
    for (x, y), _, (right, top), *_ in boxes:
        squares[int(x) : int(right), int(y) : int(top)] = True
    assert polygons.covered_areas(zones, parks, size=64.0).first()["park_area"] == pytest.approx(squares[:40, :40].sum())
    assert read.value == 400


def test_rings_are_clipped_together_as_one_by_one():
    rng = np.random.default_rng(3)
    rings = [np.array(_box(*rng.integers(-9, 9, 2).astype(float), *rng.integers(1, 9, 2).astype(float))[:4]) for _ in range(60)]
    rings += [rng.integers(-9, 9, (k % 4 + 3, 2)).astype(float) for k in range(60)] + [np.zeros((0, 2))]
    low = rng.integers(-6, 6, (len(rings), 2)).astype(float)
    for r, corner, made in zip(rings, low, polygons._clip_all(rings, low, 4.0), strict=True):
        assert polygons.common_area([[made]]) == pytest.approx(polygons.common_area([[polygons._clip(r, tuple(corner), tuple(corner + 4.0))]]))


def test_a_task_writes_several_sorted_files(spark, tmp_path):
    rows = spark.range(2000).select(F.hash("id").alias("k"))
    publish.write_sorted(rows, f"file://{tmp_path}/out", ["k"], 10)
    names = sorted(n for n in os.listdir(tmp_path / "out") if n.startswith("part-"))
    assert len(names) >= 200 and len({n[:10] for n in names}) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.read.parquet(*[f"file://{tmp_path}/out/{n}" for n in names]).count() == 2000


def test_hours_are_dealt_to_more_tasks_than_an_hour_has_files(spark, tmp_path):
    rows = spark.range(3000).select(F.concat(F.lit("row "), F.col("id").cast("string")).alias("value"), F.timestamp_seconds(F.col("id") % 50 * 3600).alias("timestamp"))
    rows.write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"file://{tmp_path}/in")
    raw.into_hours(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/state", files=2).awaitTermination(120)
    files = defaultdict(set)
    for path in (tmp_path / "out").rglob("part-*.parquet"):
        files[path.parent].add(path.name[:10])
    assert len(files) == 50 and max(map(len, files.values())) <= 2
    assert len(set().union(*files.values())) > 2
