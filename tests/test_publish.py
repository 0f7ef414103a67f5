"""Tables stay whole when a write fails; readers of files; figures of streams; the projection."""

import json

import pytest
from pyspark.sql import functions as F

from smoothway.operators import profiles, roads, routing
from smoothway.plans import catalog, reference_catalog
from smoothway.plans.adapters import spark_view
from smoothway.sources import publish, scans
from smoothway.streaming import raw


def _table(spark, path):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, part string")
    rows.repartition(3).write.partitionBy("part").parquet(path)
    return rows


def _ids(spark, path):
    return sorted((r["id"], r["part"]) for r in spark.read.parquet(path).collect())


def test_a_failed_replacement_leaves_the_table(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    rows = _table(spark, path)
    with pytest.raises(ValueError):
        publish.replace_partitions(rows.filter("false"), path, ("part",), may_be_empty=False)
    real, turns = publish._fs, []

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            turns.append(1)
            return False if "_stage" in a.toString() and len(turns) > 2 else self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    def broken(spark, path):
        fs, at = real(spark, path)
        return Broken(fs), at

    monkeypatch.setattr(publish, "_fs", broken)
    with pytest.raises(OSError):
        publish.replace_partitions(rows.withColumn("id", F.col("id") + 10), path, ("part",))
    assert _ids(spark, path) == [(1, "a"), (2, "a"), (3, "b")]
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_backup")]
    monkeypatch.setattr(publish, "_fs", real)
    assert publish.replace_partitions(rows.filter("part = 'a'").withColumn("id", F.col("id") + 10), path, ("part",)) == 2
    assert _ids(spark, path) == [(3, "b"), (11, "a"), (12, "a")]


def test_compaction_skips_what_is_small_or_recent(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    _table(spark, path)
    recent = publish.compact(spark, path, ("part",), settled=F.col("newest") < F.lit("2000-01-01").cast("timestamp"))
    assert {r["part"]: r["why"] for r in recent.collect()} == {"a": "too recent", "b": "few files"}
    assert {r["part"]: r["compacted"] for r in publish.compact(spark, path, ("part",)).collect()} == {"a": True, "b": False}
    assert _ids(spark, path) == [(1, "a"), (2, "a"), (3, "b")]
    assert {r["files"] for r in publish.file_statistics(spark.read.parquet(path), "part").collect()} == {1}


def test_a_snapshot_needs_its_pointer(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    df = spark.range(3)
    version = publish.write_snapshot(df, root, as_of="2026-01-05")
    assert publish.active_manifest(spark, root) == {"version": version, "rows": 3, "as_of": "2026-01-05"}
    (tmp_path / "s" / "active.json").write_text("{}")
    (tmp_path / "s" / ".active.json.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError):
        publish.active_snapshot(spark, root)


def test_a_collection_of_many_lines(spark, tmp_path):
    whole = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": k}, "geometry": {"type": "LineString", "coordinates": [[k, 0.5], [k + 1, 2]]}} for k in range(3)]}
    (tmp_path / "c.json").write_text(json.dumps(whole, indent=1))
    found = scans.features(spark, f"file://{tmp_path}/c.json").select(F.try_element_at("properties", F.lit("id")).alias("id"), scans.line(F.col("coordinates")).alias("line")).collect()
    assert sorted((r["id"], [tuple(p) for p in r["line"]]) for r in found) == [(str(k), [(float(k), 0.5), (k + 1.0, 2.0)]) for k in range(3)]
    assert scans.features(spark, f"file://{tmp_path}/c.json", geometry=False).columns == ["properties"]


def test_projection(spark):
    x, y = roads.projected(F.col("lon"), F.col("lat"))
    df = spark.createDataFrame([(-74.0, 40 + 10 / 60), (-73.9857, 40.7484), (-74.3, 40.9)], "lon double, lat double")
    found = [(r["x"], r["y"]) for r in df.select(x.alias("x"), y.alias("y")).collect()]
    assert abs(found[0][0] - 300_000) < 1e-6 and abs(found[0][1]) < 1e-6  # the origin
    # near the origin's meridian a degree of latitude is some 111 km, and the scale is within a few parts in 10,000
    assert abs(found[1][1] - (40.7484 - 40 - 10 / 60) * 111_045) < 100 and abs(found[1][0] - 300_000 - 0.0143 * 84_480) < 15
    assert found[2][0] < 275_500


def test_figures_of_a_batch():
    told = {"numInputRows": 5, "processedRowsPerSecond": 2.5, "durationMs": {"triggerExecution": 40}, "observedMetrics": {"events": {"latest": 90.0}}, "sources": [{"endOffset": {"t": {"0": 4, "1": 6}}, "latestOffset": {"t": {"0": 5, "1": 9}}}]}
    assert raw.progress_figures(told, 100.0) == {"rows": 5, "rows_per_second": 2.5, "batch_ms": 40, "event_lag_s": 10.0, "offset_lag": 4, "end_offset": 10}
    assert raw.progress_figures({}, 1.0)["event_lag_s"] is None
    assert raw.source_options(600_000, 1_200_000, "30s") == {"minOffsetsPerTrigger": "600000", "maxOffsetsPerTrigger": "1200000", "maxTriggerDelay": "30s"}
    with pytest.raises(ValueError):
        raw.source_options(least=1)


def test_routes_against_all_pairs_of_anchors(spark, sf_dir):
    read = lambda view: spark_view(spark, sf_dir, view)
    both = profiles.anchors(reference_catalog._nodes(read), reference_catalog._centres(read)).collect()
    ends = {r["location_id"]: [n for n in (r["first"], r["second"]) if n] for r in both}
    edges = routing.directed_edges(read("road_segments"))
    every = edges.selectExpr("source AS node").distinct()
    far = {(r["source"], r["target"]): r["distance"] for r in routing.shortest_paths(edges, every).collect()}
    from smoothway.operators import zones

    asked = {(r["pickup_zone"], r["dropoff_zone"]): r["median_miles"] * 1609.344 for r in zones.od_statistics(zones.valid_trips(read("trips"))).collect()}
    found = catalog.QUERIES["g4_chosen_routes"](spark, sf_dir).collect()
    assert len(found) == len(asked)
    for r in found:
        a, b = r["pickup_zone"], r["dropoff_zone"]
        paths = sorted((round(abs(far[s, t] - asked[a, b]), 6), s, t) for s in ends.get(a, []) for t in ends.get(b, []) if s != t and (s, t) in far)
        if paths:
            assert (r["start_node"], r["end_node"], r["skip_reason"]) == (*paths[0][1:], None)
        else:
            assert r["skip_reason"] == ("PICKUP_ZONE_NO_ROUTABLE_NODES" if a not in ends else "DROPOFF_ZONE_NO_ROUTABLE_NODES" if b not in ends else "NO_DIRECTED_ROUTE")
    told = {r["skip_reason"]: r["pairs"] for r in catalog.QUERIES["a34_route_summary"](spark, sf_dir).collect()}
    assert sum(told.values()) == len(asked)
