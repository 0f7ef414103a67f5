"""Spatial joins on a grid of cells: map matching, zones, pavement. Coordinates are metres."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RADIUS_M, DISTANCE_WEIGHT, HEADING_WEIGHT, STREET_RADIUS_M = 30.0, 0.7, 0.3, 39.0
#: Bytes of roads or zones, copied to their cells, that are broadcast at most. 170,000 roads of three legs
#: make some 3 million rows of 64 bytes.
MOST_BROADCAST = 256 << 20


def bearing(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Degrees from north, clockwise, in [0, 360)."""
    return F.pmod(F.degrees(F.atan2(x1 - x0, y1 - y0)), F.lit(360.0))


def heading_difference(a: Column, b: Column) -> Column:
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def segment_distance(x: Column, y: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Distance of a point to a line between two points."""
    dx, dy = x1 - x0, y1 - y0
    t = F.coalesce(F.try_divide((x - x0) * dx + (y - y0) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return F.sqrt(F.pow(x - (x0 + t * dx), 2) + F.pow(y - (y0 + t * dy), 2))


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("int")


def _covering(df: DataFrame, left: Column, bottom: Column, right: Column, top: Column, size: float) -> DataFrame:
    """A row for each grid cell that a box touches."""
    xs = F.explode(F.sequence(_cell(left, size), _cell(right, size))).alias("_cx")
    ys = F.explode(F.sequence(_cell(bottom, size), _cell(top, size))).alias("_cy")
    return df.select("*", xs).select("*", ys)


def _bytes(df: DataFrame) -> int:
    """About how many bytes the rows of a table take."""
    each = F.lit(32)
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        each = each + F.coalesce({"string": F.octet_length(f.name), "binary": F.octet_length(f.name), "array": 32 * F.size(f.name)}.get(kind, F.lit(8)), F.lit(0))
    return df.agg(F.sum(each.cast("long"))).first()[0] or 0


def in_grid(points: DataFrame, wide: DataFrame, size: float, test: Column, most_bytes: int = MOST_BROADCAST) -> DataFrame:
    """Points joined (left) to rows that cover cells, where the test holds: an equality join on cells.

    Up to most_bytes of the covering rows are broadcast, so the points aren't moved and no cell is too
    full; beyond that both sides are dealt by cell. The rows that come out are the same.
    """
    here = points.withColumns({"_px": _cell(F.col("x"), size), "_py": _cell(F.col("y"), size)})
    few = _bytes(wide) <= most_bytes
    on = (F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy")) & test
    return here.join(F.broadcast(wide) if few else wide.hint("merge"), on, "left").drop("_px", "_py", "_cx", "_cy")


def candidates(points: DataFrame, roads: DataFrame, radius: float = RADIUS_M, **options) -> DataFrame:
    """Points with each road within the radius; a point without any stays once, with nulls, and so does
    one without coordinates.

    Roads are copied to the cells their widened box touches and a point lies in one cell, so a pair
    comes out once.
    """
    size = max(radius, 50.0)
    wide = _covering(roads, F.least("x0", "x1") - radius, F.least("y0", "y1") - radius, F.greatest("x0", "x1") + radius, F.greatest("y0", "y1") + radius, size)
    distance = segment_distance(F.col("x"), F.col("y"), F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    return in_grid(points, wide, size, distance <= radius, **options).withColumn("distance_m", F.when(F.col("segment_id").isNotNull(), distance))


def match_scores(df: DataFrame, radius: float = RADIUS_M) -> DataFrame:
    """Score each candidate by distance and, where the sensor has one, by heading."""
    forward = bearing(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    back = F.pmod(forward + 180.0, F.lit(360.0))
    heading = F.col("heading")
    two_way = F.least(heading_difference(heading, forward), heading_difference(heading, back))
    diff = F.when(F.col("traffic_direction") == "W", heading_difference(heading, forward)).when(F.col("traffic_direction") == "A", heading_difference(heading, back)).otherwise(two_way)
    near = F.greatest(F.lit(0.0), 1 - F.col("distance_m") / radius)
    straight = F.greatest(F.lit(0.0), 1 - diff / 180.0)
    score = F.when(F.col("heading").isNull(), near).otherwise(DISTANCE_WEIGHT * near + HEADING_WEIGHT * straight)
    return df.withColumn("heading_diff_deg", diff).withColumn("match_score", F.when(F.col("segment_id").isNotNull(), score))


def best_match(df: DataFrame, *by: str) -> DataFrame:
    """The best candidate of each event and how many there were; by names the columns that tell events apart
    (event_id). Candidates are compared before they are dealt, so only one an event is moved from each task."""
    by = by or ("event_id",)
    # falling, nulls last: no score is a null that goes behind, and of numbers the negative rises
    falling = F.round("match_score", 9)
    order = [falling.isNull(), -falling]
    for c in (F.round("distance_m", 9), F.round("heading_diff_deg", 9), F.col("segment_id")):
        order += [c.isNull(), c]
    rest = [c for c in df.columns if c not in by]
    ranked = F.struct(*[c.alias(f"_{k}") for k, c in enumerate(order)], *rest)
    best = df.groupBy(*by).agg(F.min(ranked).alias("_best"), F.count("segment_id").alias("candidate_count"))
    return best.select(*[F.col(c) if c in by else F.col("_best")[c].alias(c) for c in df.columns], "candidate_count")


def parts(df: DataFrame) -> int:
    """Tasks for few rows that make many: by their own size they would be put into one."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def places(points: DataFrame, *by: str) -> DataFrame:
    """The distinct values of by, dealt to many tasks."""
    return points.select(*by).distinct().repartition(parts(points), *by)


def once_a_place(points: DataFrame, find: Callable[[DataFrame], DataFrame], *by: str) -> DataFrame:
    """Points joined to what find makes of the distinct values of by: events at one place are looked for once.

    find keeps these columns and each of their values, null too. The work then grows with places and not with
    events, but for the rows that come out.
    """
    found = find(places(points, *by)).withColumnsRenamed({c: f"_at_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in by]
    return points.join(found, same).drop(*[f"_at_{c}" for c in by])


def match(points: DataFrame, roads: DataFrame, radius: float = RADIUS_M, **options) -> DataFrame:
    """The best road of each point by distance and heading; points alike in both are matched once."""
    at = ("x", "y", "heading")
    return once_a_place(points, lambda p: best_match(match_scores(candidates(p, roads, radius, **options), radius), *at), *at)


def match_quarantine(matched: DataFrame, raw: DataFrame, run: str) -> DataFrame:
    """Events without a road, with what was tried as JSON (nulls written out) and their raw record.

    raw (event_id, raw_record) may repeat events. It is cut down to the failed ones before anything
    else, and joined as Spark sees fit: failed events may be many.
    """
    tried = F.struct(F.lit("distance+heading").alias("match_method"), F.col("distance_m").alias("map_match_distance_m"), F.col("heading_diff_deg").alias("map_match_heading_diff_deg"), F.col("match_score").alias("map_match_score"), "candidate_count")
    failed = matched.filter("segment_id is null").select("event_id", "trip_id", "event_us", F.lit("MAP_MATCH_FAILED").alias("reject_reason"), F.to_json(tried, {"ignoreNullFields": "false"}).alias("reject_detail"), F.lit(run).alias("_run_id"))
    records = raw.join(failed.select("event_id"), "event_id", "left_semi").groupBy("event_id").agg(F.min("raw_record").alias("raw_record"))
    return failed.join(records, "event_id", "left")


def _first_zone(points: DataFrame, wide: DataFrame, size: float, test: Column) -> DataFrame:
    """Each point once, repeated ones too, with the least location_id among the rows that cover it."""
    keyed = points.withColumn("_row", F.monotonically_increasing_id())
    first = [F.first(c).alias(c) for c in points.columns]
    return in_grid(keyed, wide, size, test).groupBy("_row").agg(*first, F.min("location_id").alias("location_id")).drop("_row")


def in_zones(points: DataFrame, zones: DataFrame, size: float = 500.0) -> DataFrame:
    """Points with the first zone (box, edges included) that covers them, or null."""
    wide = _covering(zones, F.col("x0"), F.col("y0"), F.col("x0") + F.col("width"), F.col("y0") + F.col("height"), size).select("_cx", "_cy", F.col("location_id"), F.col("x0").alias("_x0"), F.col("y0").alias("_y0"), (F.col("x0") + F.col("width")).alias("_x1"), (F.col("y0") + F.col("height")).alias("_y1"))
    return _first_zone(points, wide, size, F.col("x").between(F.col("_x0"), F.col("_x1")) & F.col("y").between(F.col("_y0"), F.col("_y1")))


def inside_polygon(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point is in a closed ring (array of struct<x,y>); points on the edge are inside."""
    pairs = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    ax, ay, bx, by = (lambda s: s["a"]["x"]), (lambda s: s["a"]["y"]), (lambda s: s["b"]["x"]), (lambda s: s["b"]["y"])
    on_edge = F.exists(pairs, lambda s: ((bx(s) - ax(s)) * (y - ay(s)) == (by(s) - ay(s)) * (x - ax(s))) & x.between(F.least(ax(s), bx(s)), F.greatest(ax(s), bx(s))) & y.between(F.least(ay(s), by(s)), F.greatest(ay(s), by(s))))
    crossings = F.size(F.filter(pairs, lambda s: ((ay(s) > y) != (by(s) > y)) & (x < (bx(s) - ax(s)) * F.try_divide(y - ay(s), by(s) - ay(s)) + ax(s))))
    return on_edge | (crossings % 2 == 1)


def ring_box(ring: str) -> list[Column]:
    """Left, bottom, right and top of a ring."""
    side = lambda f, c: f(F.transform(ring, lambda p: p[c]))
    return [side(F.array_min, "x"), side(F.array_min, "y"), side(F.array_max, "x"), side(F.array_max, "y")]


def in_polygons(points: DataFrame, zones: DataFrame, size: float = 500.0) -> DataFrame:
    """Points with the first zone whose ring (edges included) covers them, or null."""
    wide = _covering(zones, *ring_box("ring"), size).select("_cx", "_cy", "location_id", F.col("ring").alias("_ring"))
    return _first_zone(points, wide, size, inside_polygon(F.col("x"), F.col("y"), F.col("_ring")))


def street_key(street: Column) -> Column:
    """Upper case without all but letters and digits."""
    return F.regexp_replace(F.upper(street), "[^A-Z0-9]", "")


def pavement(roads: DataFrame, ratings: DataFrame, as_of: int | None, radius: float = STREET_RADIUS_M, size: float | None = None, places: int = 6, legs: DataFrame | None = None) -> DataFrame:
    """Roads with the nearest rating of the same street within the radius, inspected up to as_of or at no
    known time; all ratings without as_of. Of equally near ratings (to some places) the latest counts, then
    an unknown one, then the higher one.

    The join is by street and grid cell, so a long street costs what lies near, not all its pairs. size is
    the side of a cell in the unit of the coordinates, which may be metres or degrees. legs (segment_id, street,
    x0, y0, x1, y1) are the straight pieces of the roads, where these aren't straight themselves.
    """
    size = size or max(radius, 50.0)
    some = F.lit(True) if as_of is None else F.col("inspected").isNull() | (F.col("inspected") <= as_of)
    # ratings of a street at one place are equally near all roads: the one that counts there is chosen before they meet any
    age, low = F.coalesce(-F.col("inspected"), F.lit(0)).alias("_age"), (-F.col("rating")).alias("_low")
    r = ratings.filter(some).select(street_key(F.col("street")).alias("_key"), F.col("x").alias("_x"), F.col("y").alias("_y"), age, low, "rating").distinct()
    r = r.groupBy("_key", "_x", "_y").agg(F.min(F.struct("_age", "_low", "rating")).alias("_first"))
    r = r.select("_key", "_x", "_y", "_first.*", _cell(F.col("_x"), size).alias("_px"), _cell(F.col("_y"), size).alias("_py"))
    pieces = (roads if legs is None else legs).select("segment_id", street_key(F.col("street")).alias("_street"), "x0", "y0", "x1", "y1")
    wide = _covering(pieces, F.least("x0", "x1") - radius, F.least("y0", "y1") - radius, F.greatest("x0", "x1") + radius, F.greatest("y0", "y1") + radius, size)
    far = segment_distance(F.col("_x"), F.col("_y"), F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    n = parts(roads)  # such rows take few bytes in a shuffle and many in a task
    wide, r = wide.repartition(n, "_street", "_cx", "_cy"), r.repartition(n, "_key", "_px", "_py")
    met = wide.join(r, (F.col("_street") == F.col("_key")) & (F.col("_cx") == F.col("_px")) & (F.col("_cy") == F.col("_py"))).withColumn("_far", far).filter(F.col("_far") <= radius)
    best = met.repartition(n, "segment_id").groupBy("segment_id").agg(F.min_by("rating", F.struct(F.round("_far", places), "_age", "_low")).alias("pavement_rating"))
    found = roads.select("segment_id").repartition(n, "segment_id").join(best, "segment_id", "left")
    return found.select("segment_id", "pavement_rating", pavement_class(F.col("pavement_rating")).alias("pavement_condition"))


def pavement_class(rating: Column) -> Column:
    return F.when(rating >= 8, "Good").when(rating >= 6, "Fair").when(rating.isNotNull(), "Poor")
