"""Shortest paths against Dijkstra in plain Python."""

import heapq

from smoothway.operators import routing
from smoothway.plans import catalog
from smoothway.plans.adapters import spark_view


def dijkstra(edges, source):
    far, queue = {source: 0.0}, [(0.0, source)]
    while queue:
        d, at = heapq.heappop(queue)
        if d > far[at]:
            continue
        for e in edges:
            if e["source"] == at and d + e["length"] < far.get(e["target"], float("inf")):
                far[e["target"]] = d + e["length"]
                heapq.heappush(queue, (far[e["target"]], e["target"]))
    return far


def check(found, edges):
    nodes = {e[k] for e in edges for k in ("source", "target")}
    length = {}
    for e in edges:
        length[e["source"], e["target"], e["segment_id"], e["reverse"]] = e["length"]
    last = {(r["source"], r["target"]): (r["previous"], r["segment_id"], r["reverse"]) for r in found}
    far = {(s, t): d for s in nodes for t, d in dijkstra(edges, s).items()}
    assert {(r["source"], r["target"]) for r in found} == set(far) and len(found) == len(far)
    for r in found:
        assert abs(r["distance"] - far[r["source"], r["target"]]) < 1e-5
        at, total = r["source"], 0.0
        for segment, reverse in routing.path(last, r["source"], r["target"]):
            to, way = next((t, n) for (s, t, g, v), n in length.items() if (s, g, v) == (at, segment, reverse))
            at, total = to, total + way
        assert at == r["target"] and abs(total - r["distance"]) < 1e-5


def test_g2_from_all_sources_with_paths(spark, sf_dir):
    edges = routing.directed_edges(spark_view(spark, sf_dir, "road_segments")).collect()
    check(catalog.QUERIES["g2_shortest_paths"](spark, sf_dir).collect(), edges)


def test_paths_of_many_edges_with_detours(spark):
    rows = [(f"s{k}", False, f"n{k}", f"n{k + 1}", 1.0) for k in range(9)] + [("far", True, "n0", "n9", 100.0), ("twin", False, "n3", "n4", 0.5), ("back", False, "n9", "n0", 0.0)]
    edges = spark.createDataFrame(rows, "segment_id string, reverse boolean, source string, target string, length double")
    nodes = edges.selectExpr("source AS node").distinct()
    check(routing.shortest_paths(edges, nodes).collect(), edges.collect())
