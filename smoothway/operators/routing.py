"""Directed road graphs: edges, shortest paths, routes to targets, contiguity of routes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smoothway.sources.scratch import discard, written

#: Steps of a walk back along paths between two written tables.
STEPS = 8


def directed_edges(roads: DataFrame) -> DataFrame:
    """Edges with their length: W along the road, A against it, T both ways."""
    length = F.sqrt(F.pow(F.col("x1") - F.col("x0"), 2) + F.pow(F.col("y1") - F.col("y0"), 2))
    ways = F.when(F.col("traffic_direction") == "W", F.array(F.lit(False))).when(F.col("traffic_direction") == "A", F.array(F.lit(True))).otherwise(F.array(F.lit(False), F.lit(True)))
    each = roads.select("segment_id", "from_node", "to_node", length.alias("length"), F.explode(ways).alias("reverse"))
    return each.select("segment_id", "reverse", F.when(F.col("reverse"), F.col("to_node")).otherwise(F.col("from_node")).alias("source"), F.when(F.col("reverse"), F.col("from_node")).otherwise(F.col("to_node")).alias("target"), "length")


def shortest_paths(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """Shortest path from each source node to each node it reaches, by its length and last edge.

    Rows (source, target, distance, previous, segment_id, reverse): the last edge comes from the node
    previous, whose own row has the edge before it, so path() can follow it back; a source's own row
    has no edge. Bellman-Ford over tables: each round extends the paths that became shorter by one
    edge and keeps the least; it ends when nothing changed. Lengths must not be negative. Each round
    is a written table, so a lost executor costs one round at most.
    """
    best_edge = edges.groupBy("source", "target").agg(F.min(F.struct("length", "segment_id", "reverse")).alias("_edge"))
    hop = best_edge.select(F.col("source").alias("_at"), F.col("target").alias("_to"), "_edge")
    kinds = {f.name: f.dataType for f in edges.schema}
    none = lambda name: F.lit(None).cast(kinds[name])
    last = F.struct(none("source").alias("previous"), none("segment_id").alias("segment_id"), none("reverse").alias("reverse"))
    best = sources.select(F.col("node").alias("source"), F.col("node").alias("target"), F.lit(0.0).alias("distance"), last.alias("last")).distinct()
    best = written(best.withColumn("_new", F.lit(True)), "paths")
    while True:
        step = F.struct(F.round(F.col("distance") + F.col("_edge.length"), 9).alias("distance"), F.col("_at").alias("previous"), F.col("_edge.segment_id").alias("segment_id"), F.col("_edge.reverse").alias("reverse"))
        reached = best.filter("_new").join(hop, F.col("target") == F.col("_at")).groupBy("source", F.col("_to").alias("target")).agg(F.min(step).alias("_s"))
        better = F.coalesce(F.col("_s").isNotNull() & (F.col("distance").isNull() | (F.col("_s.distance") < F.col("distance"))), F.lit(False))
        merged = best.drop("_new").join(reached, ["source", "target"], "full").withColumn("_new", better)
        merged = merged.select("source", "target", F.when(F.col("_new"), F.col("_s.distance")).otherwise(F.col("distance")).alias("distance"), F.when(F.col("_new"), F.struct("_s.previous", "_s.segment_id", "_s.reverse")).otherwise(F.col("last")).alias("last"), "_new")
        best, before = written(merged, "paths"), best
        discard(before)
        if best.filter("_new").isEmpty():
            return best.select("source", "target", "distance", "last.*")


def paths_to(edges: DataFrame, asked: DataFrame) -> DataFrame:
    """Shortest paths for the asked pairs (source, target): distance, hops and the path's edges in order.

    Rows (source, target, distance, hops, segments: array<struct<segment_id, reverse>>); a pair without a
    path has no row, one of a node with itself has no edges. Of equally long paths the one counts whose
    last edge has the least (node before it, segment, direction).

    Each hop extends only the nodes that the hop before has improved, and writes only what it improves in
    turn. A source has a bound, the distance of its farthest target as known so far: nothing at or beyond
    it can shorten a path to any of its targets, so the search of a source ends once all are settled,
    however large the graph. Lengths must not be negative. A lost executor costs a hop at most.
    """
    hop = edges.groupBy(F.col("source").alias("previous"), F.col("target").alias("_to")).agg(F.min(F.struct("length", "segment_id", "reverse")).alias("_e"))
    hop = written(hop, "hops")
    asked = written(asked.select("source", "target").distinct(), "asked")
    none = hop.select(F.lit(0.0).alias("distance"), "previous", F.col("_e.segment_id"), F.col("_e.reverse")).schema
    start = asked.select("source", F.col("source").alias("node"), F.lit(0.0).alias("distance"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in none.fields[1:]]).distinct()
    deltas = [written(start, "paths")]
    while True:
        # what each hop improved; the last row of a node is its best, as distances only fall
        known = reduce(DataFrame.unionByName, deltas).groupBy("source", "node").agg(F.min("distance").alias("_least"))
        reached = asked.join(known, (asked["source"] == known["source"]) & (asked["target"] == known["node"]), "left")
        bound = reached.groupBy(asked["source"]).agg(F.when(F.count_if(F.col("_least").isNull()) == 0, F.max("_least")).alias("_bound"))
        step = deltas[-1].select("source", F.col("node").alias("previous"), "distance").join(hop, "previous")
        far = F.round(F.col("distance") + F.col("_e.length"), 9).alias("distance")
        best = step.select("source", F.col("_to").alias("node"), F.struct(far, "previous", "_e.segment_id", "_e.reverse").alias("_s")).groupBy("source", "node").agg(F.min("_s").alias("_s"))
        fresh = best.join(bound, "source").filter(F.col("_bound").isNull() | (F.col("_s.distance") < F.col("_bound")))
        fresh = fresh.join(known, ["source", "node"], "left").filter(F.col("_least").isNull() | (F.col("_s.distance") < F.col("_least")))
        delta = written(fresh.select("source", "node", "_s.*"), "paths")
        if delta.isEmpty():
            discard(delta)
            break
        deltas.append(delta)
    last = reduce(DataFrame.unionByName, [d.withColumn("hops", F.lit(k)) for k, d in enumerate(deltas)]).groupBy("source", "node").agg(F.min_by(F.struct("distance", "hops"), F.struct("distance", "hops")).alias("_b"))
    ends = asked.join(last, (asked["source"] == last["source"]) & (asked["target"] == last["node"]))
    found = ends.select(asked["source"], "target", "_b.distance", "_b.hops", F.col("target").alias("at"), F.array().cast("array<struct<segment_id: string, reverse: boolean>>").alias("segments"))
    found = written(found, "walks")
    for k in range(len(deltas) - 1, 0, -1):
        # a node's best row of k edges lies in the k-th table, and that of the node before it in the table before
        edge = deltas[k].select("source", F.col("node").alias("at"), "previous", F.struct("segment_id", "reverse").alias("_edge")).withColumn("_k", F.lit(k))
        due = F.col("hops") - F.size("segments")
        met = found.withColumn("_k", due).join(edge, ["source", "at", "_k"], "left")
        found = met.select("source", "target", "distance", "hops", F.coalesce("previous", "at").alias("at"), F.when(F.col("_edge").isNull(), F.col("segments")).otherwise(F.concat(F.array("_edge"), "segments")).alias("segments"))
        if k % STEPS == 1:
            found = written(found, "walks")
    found = written(found.drop("at"), "routes")
    discard(*deltas, hop, asked)
    return found


def path(found: dict[tuple[str, str], tuple[str, str, bool]], source: str, target: str) -> list[tuple[str, bool]]:
    """The edges (segment_id, reverse) from source to target, from (source, target) -> last edge."""
    out = []
    while target != source:
        previous, segment, reverse = found[source, target]
        out.append((segment, reverse))
        target = previous
    return out[::-1]


def contiguous(routes: DataFrame, edges: DataFrame) -> DataFrame:
    """Whether each route's segments follow one another: an end of one is the start of the next."""
    ends = edges.groupBy("segment_id").agg(F.array_sort(F.collect_set("source")).alias("starts"), F.array_sort(F.collect_set("target")).alias("stops"))
    placed = routes.join(ends, "segment_id", "left")
    before = F.lag("stops").over(Window.partitionBy("route_id").orderBy("position", "segment_id"))
    gap = before.isNotNull() & ~F.coalesce(F.arrays_overlap(before, "starts"), F.lit(False))
    return placed.withColumn("_gap", gap).groupBy("route_id").agg((F.count_if("_gap") == 0).alias("contiguous"), F.count_if("_gap").alias("gaps"))
