"""Routes to targets against Dijkstra's search, and route choice against the plain loop."""

import hashlib
import random

import pytest

from smoothway.operators import profiles, routing
from smoothway.plans import catalog, reference_catalog
from smoothway.plans.adapters import spark_view
from smoothway.sources import scratch
from tests.test_routing import dijkstra

EDGES = "segment_id string, reverse boolean, source string, target string, length double"


def _check(found, edges, asked):
    far = {s: dijkstra(edges, s) for s in {s for s, _ in asked}}
    assert {(r["source"], r["target"]) for r in found} == {(s, t) for s, t in asked if t in far[s]}
    by = {(e["source"], e["segment_id"], e["reverse"]): e for e in edges}
    for r in found:
        assert abs(r["distance"] - far[r["source"]][r["target"]]) < 1e-5
        at, total = r["source"], 0.0
        for s in r["segments"]:
            e = by[at, s["segment_id"], s["reverse"]]
            at, total = e["target"], total + e["length"]
        assert at == r["target"] and abs(total - r["distance"]) < 1e-5 and len(r["segments"]) == r["hops"]


def test_paths_to_targets_on_random_graphs(spark):
    rng = random.Random(5)
    rows = [(f"s{k}", rng.random() < 0.3, f"n{rng.randrange(40)}", f"n{rng.randrange(40)}", rng.choice([0.0, 1.0, 2.5, 7.0])) for k in range(110)]
    asked = [(f"n{rng.randrange(40)}", f"n{rng.randrange(42)}") for _ in range(30)] + [("n1", "n1"), ("none", "n2")]
    edges = spark.createDataFrame(rows, EDGES)
    found = routing.paths_to(edges, spark.createDataFrame(asked, "source string, target string")).collect()
    _check(found, edges.collect(), set(asked) - {("none", "n2")})


def test_a_search_ends_when_its_targets_are_settled(spark, monkeypatch):
    """A long chain behind the target isn't walked, and hops write only what they improve."""
    rows = [(f"s{k}", False, f"n{k}", f"n{k + 1}", 1.0) for k in range(40)] + [("up", False, "n0", "far", 3.0)]
    edges = spark.createDataFrame(rows, EDGES)
    sizes, written = [], scratch.written
    monkeypatch.setattr(routing, "written", lambda df, name: (lambda t: sizes.append((name, t.count())) or t)(written(df, name)))
    found = routing.paths_to(edges, spark.createDataFrame([("n0", "n3"), ("n0", "far")], "source string, target string")).collect()
    _check(found, edges.collect(), [("n0", "n3"), ("n0", "far")])
    hops = [n for name, n in sizes if name == "paths"]
    assert len(hops) <= 5 and max(hops) <= 2


def test_paths_longer_than_a_walk_between_tables(spark):
    n = 2 * routing.STEPS + 3
    rows = [(f"s{k}", False, f"n{k}", f"n{k + 1}", 1.0) for k in range(n)]
    edges = spark.createDataFrame(rows, EDGES)
    found = routing.paths_to(edges, spark.createDataFrame([("n0", f"n{n}"), ("n2", "n4")], "source string, target string")).collect()
    _check(found, edges.collect(), [("n0", f"n{n}"), ("n2", "n4")])


def test_g2_paths_to_targets(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest table has ten roads
    edges = routing.directed_edges(spark_view(spark, sf_dir, "road_segments")).collect()
    far = {}
    rows = catalog.QUERIES["g2_paths_to_targets"](spark, sf_dir).collect()
    assert len(rows) >= 3
    for r in rows:
        far.setdefault(r["source"], dijkstra(edges, r["source"]))
        assert abs(r["distance"] - far[r["source"]][r["target"]]) < 1e-5
        assert len(r["segments"].split()) == r["hops"]


def _plain_choice(trip, pickup, dropoff, far):
    seed = int.from_bytes(hashlib.sha256(str(trip["trip_id"]).encode()).digest()[:8], "big")
    if not pickup or not dropoff:
        return None
    a, b = seed % len(pickup), seed // len(pickup) % len(dropoff)
    best = None
    for s in (pickup[a:] + pickup[:a])[:20]:
        for t in (dropoff[b:] + dropoff[:b])[:20]:
            if s == t or t not in far[s]:
                continue
            off = (round(abs(far[s][t] - trip["length"]) / trip["length"], 9), s, t)
            best = off if best is None else min(best, off)
            if off[0] <= 0.15:
                return s, t
    return best and best[1:]


@pytest.mark.parametrize("name", ["given", "made"])
def test_g4_accepts_the_first_route_that_is_near_enough(spark, sf_dir, name):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    read = lambda v: spark_view(spark, sf_dir, v)
    if name == "given":
        edges = routing.directed_edges(read("road_segments")).collect()
        trips = [r.asDict() for r in reference_catalog.zones.valid_trips(read("trips")).selectExpr("trip_id", "pickup_zone", "dropoff_zone", "miles * 1609.344 AS length").collect()]
        nodes = [(r["location_id"], r["node"]) for r in reference_catalog._nodes(read).collect()]
        found = catalog.QUERIES["g4_accepted_routes"](spark, sf_dir).collect()
    else:
        rng = random.Random(2)
        rows = [(f"s{k}", False, f"n{rng.randrange(30)}", f"n{rng.randrange(30)}", rng.uniform(1, 9)) for k in range(120)]
        edges = spark.createDataFrame(rows, EDGES).collect()
        nodes = [(k % 4, f"n{k}") for k in range(30)]
        trips = [{"trip_id": k, "pickup_zone": k % 5, "dropoff_zone": k * 3 % 4, "length": 3.0 + k % 20} for k in range(200)]
        ends = spark.createDataFrame(nodes, "location_id int, node string")
        pairs = spark.createDataFrame([(a, b) for _, a in nodes for _, b in nodes], "source string, target string")
        found = profiles.accepted_routes(spark.createDataFrame(trips), ends, routing.paths_to(spark.createDataFrame(edges, EDGES), pairs)).collect()
    far = {n: dijkstra(edges, n) for _, n in nodes}
    of = {}
    for zone, n in sorted(nodes):
        of.setdefault(zone, []).append(n)
    told = {r["trip_id"]: r for r in found}
    assert len(told) == len(found) == len(trips)
    for t in trips:
        want = _plain_choice(t, of.get(t["pickup_zone"], []), of.get(t["dropoff_zone"], []), far)
        r = told[t["trip_id"]]
        assert (r["start_node"], r["end_node"]) == (want or (None, None)), (t, want)
        assert (r["skip_reason"] is None) == bool(want)
    assert name == "given" or {r["accepted"] for r in found} == {True, False}


def test_g4_templates_have_contiguous_routes(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    edges = {(e["source"], e["segment_id"], e["reverse"]): e["target"] for e in routing.directed_edges(spark_view(spark, sf_dir, "road_segments")).collect()}
    rows = catalog.QUERIES["g4_route_templates"](spark, sf_dir).collect()
    routed = [r for r in rows if r["skip_reason"] is None]
    assert routed
    for r in routed:
        at = r["start_node"]
        for s, v in zip(r["route_segment_ids"].split(), r["route_reverse_flags"], strict=True):
            at = edges[at, s, v == "1"]
        assert at == r["end_node"]
