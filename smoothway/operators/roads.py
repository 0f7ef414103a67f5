"""Road reference data: filters, validation, representatives, shapes, speed humps."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smoothway.operators.spatial import STREET_RADIUS_M, in_polygons, parts, segment_distance, street_key
from smoothway.operators.zones import representative

# Kinds of features, status, roadways and directions that vehicles use; metres in a foot.
FEATURE_TYPES, STATUS, ROADWAYS, DIRECTIONS = ("0", "6", "A", "C"), "2", ("1", "2", "3", "4", "8", "9", "10", "13"), ("T", "W", "A")
FOOT_M = 0.3048
DATE_FORMATS = ("M/d/yyyy h:mm:ss a", "M/d/yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd")


def text_or_null(c: Column) -> Column:
    """Without blanks around; null if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def number(c: Column) -> Column:
    """A number written with commas or blanks; null if it is none."""
    return F.replace(text_or_null(c.cast("string")), F.lit(","), F.lit("")).try_cast("double")


def whole_number(c: Column) -> Column:
    return number(c).cast("int")


def source_date(c: Column) -> Column:
    """A date in the first of the known formats that fits; null if none does."""
    text = F.regexp_replace(text_or_null(c), r"\.000$", "")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in DATE_FORMATS])


def first_property(properties: Column, *names: str) -> Column:
    """The first of the named entries of a map that is there, in any case of letters."""
    lowered = F.transform_keys(properties, lambda k, _: F.lower(k))
    return F.coalesce(*[F.try_element_at(lowered, F.lit(n.lower())) for n in names])


def vehicle_roads(features: DataFrame) -> DataFrame:
    """Features that vehicles drive on."""
    return features.filter(F.col("feature_type").isin(*FEATURE_TYPES) & (F.col("status") == STATUS) & F.trim("rw_type").isin(*ROADWAYS) & F.col("traffic").isin(*DIRECTIONS))


def typed_roads(features: DataFrame) -> DataFrame:
    """Plain columns of road features: trimmed names, metres, dates."""
    return features.select(
        text_or_null(F.col("segment_id")).alias("segment_id"),
        "object_id",
        text_or_null(F.col("street")).alias("street"),
        F.col("traffic").alias("traffic_direction"),
        (number(F.col("length_ft")) * FOOT_M).alias("length_m"),
        source_date(F.col("built")).alias("built"),
        "parts",
    )


def road_violations(roads: DataFrame) -> DataFrame:
    """Add the broken rules of each row: columns that must be there, length above 0, one part, one row an id."""
    again = F.count("*").over(Window.partitionBy("segment_id")) > 1
    rules = {
        "segment_id_null": F.col("segment_id").isNull(),
        "street_null": F.col("street").isNull(),
        "length_not_positive": F.coalesce(F.col("length_m") <= 0, F.lit(True)),
        "several_parts": F.col("parts") > 1,
        "duplicate_id": again & F.col("segment_id").isNotNull(),
    }
    return roads.withColumn("broken", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()])))


def with_shapes(roads: DataFrame, shapes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Roads with their shape by id, and a report of the ids that only one side has."""
    both = roads.join(shapes, F.col("segment_id") == F.col("shape_id"), "full")
    side = F.when(F.col("shape_id").isNull(), "road").when(F.col("segment_id").isNull(), "shape")
    report = both.select(F.coalesce("segment_id", "shape_id").alias("id"), side.alias("only")).filter("only is not null")
    return both.filter("segment_id is not null and shape_id is not null").drop("shape_id"), report


def line_distance(x: Column, y: Column, line: Column) -> Column:
    """Distance of a point to a line of any number of points (array of struct<x,y>, two at least)."""
    legs = F.zip_with(F.slice(line, 1, F.size(line) - 1), F.slice(line, 2, F.size(line) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.array_min(F.transform(legs, lambda s: segment_distance(x, y, s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"])))


def leg_lengths(line: Column) -> Column:
    return F.zip_with(F.slice(line, 1, F.size(line) - 1), F.slice(line, 2, F.size(line) - 1), lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"]))


def line_length(line: Column) -> Column:
    return F.aggregate(leg_lengths(line), F.lit(0.0), lambda total, leg: total + leg)


def point_along(line: Column, share: float) -> tuple[Column, Column]:
    """The point at a share (0 to 1) of a line's length; null for a line of fewer than two points."""
    lengths = leg_lengths(line)
    target = F.aggregate(lengths, F.lit(0.0), lambda s, v: s + v) * share
    # walks the legs: what is left to go, and the number of the leg in which it ends
    start = F.struct(target.alias("rest"), F.lit(0).alias("leg"), F.lit(False).alias("done"))

    def step(acc: Column, v: Column) -> Column:
        here = acc["done"] | (acc["rest"] <= v)
        return F.struct(F.when(here, acc["rest"]).otherwise(acc["rest"] - v).alias("rest"), F.when(here, acc["leg"]).otherwise(acc["leg"] + 1).alias("leg"), here.alias("done"))

    at = F.aggregate(lengths, start, step)
    leg = F.least(at["leg"], F.size(line) - 2)
    a, b = F.get(line, leg), F.get(line, leg + 1)
    t = F.coalesce(F.try_divide(at["rest"], F.get(lengths, leg)), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return a["x"] + t * (b["x"] - a["x"]), a["y"] + t * (b["y"] - a["y"])


def one_line(parts: Column) -> Column:
    """The line of a geometry given as its parts; null unless it has one part, of two points or more that
    aren't all the same, with finite coordinates. Parts aren't joined, as their direction isn't known."""
    line = F.get(parts, F.lit(0))
    finite = F.forall(line, lambda p: F.coalesce(F.abs(p["x"]) + F.abs(p["y"]) < float("inf"), F.lit(False)))
    moves = F.exists(line, lambda p: (p["x"] != line[0]["x"]) | (p["y"] != line[0]["y"]))
    return F.when((F.size(parts) == 1) & (F.size(line) > 1) & finite & moves, line)


def projected(longitude: Column, latitude: Column) -> tuple[Column, Column]:
    """Metres of the state plane of Long Island (Lambert conformal conic, two parallels, GRS80)."""
    # The ellipsoid, parallels, origin and offset of EPSG:32118.
    axis, flat = 6_378_137.0, 1 / 298.257222101
    lat1, lat2, lat0, lon0, east, north = (40 + 40 / 60, 41 + 2 / 60, 40 + 10 / 60, -74.0, 300_000.0, 0.0)
    e = math.sqrt(2 * flat - flat * flat)
    m = lambda a: math.cos(math.radians(a)) / math.sqrt(1 - (e * math.sin(math.radians(a))) ** 2)
    t = lambda a: math.tan(math.pi / 4 - math.radians(a) / 2) / ((1 - e * math.sin(math.radians(a))) / (1 + e * math.sin(math.radians(a)))) ** (e / 2)
    n = (math.log(m(lat1)) - math.log(m(lat2))) / (math.log(t(lat1)) - math.log(t(lat2)))
    scale = axis * m(lat1) / (n * t(lat1) ** n)
    sine = e * F.sin(F.radians(latitude))
    slope = F.tan(F.lit(math.pi / 4) - F.radians(latitude) / 2) / F.pow((1 - sine) / (1 + sine), F.lit(e / 2))
    radius, turn = scale * F.pow(slope, F.lit(n)), n * F.radians(longitude - lon0)
    return east + radius * F.sin(turn), north + scale * t(lat0) ** n - radius * F.cos(turn)


def speed_humps(roads: DataFrame, humps: DataFrame, as_of: int, radius: float = STREET_RADIUS_M, size: float | None = None, places: int = 6, legs: DataFrame | None = None) -> DataFrame:
    """Roads with the humps of their street for which they are the nearest road within the radius,
    installed up to as_of or at no known time: how many, and where along the road, as sorted shares.

    The join is by street and grid cell, whose side size is in the unit of the coordinates. Of equally near
    roads (to some places) the least id has the hump. legs are the straight pieces of roads that aren't straight.
    """
    size = size or max(radius, 50.0)
    cell = lambda v: F.floor(v / size).cast("int")
    known = humps.filter(F.col("installed").isNull() | (F.col("installed") <= as_of)).select("hump_id", street_key(F.col("street")).alias("_key"), F.col("x").alias("_x"), F.col("y").alias("_y"), "humps")
    # humps of a street at one place have the same nearest road
    spots = known.select("_key", "_x", "_y").distinct().select("*", cell(F.col("_x")).alias("_px"), cell(F.col("_y")).alias("_py"))
    span = lambda a, b: F.explode(F.sequence(cell(F.least(a, b) - radius), cell(F.greatest(a, b) + radius)))
    pieces = (roads if legs is None else legs).select("segment_id", street_key(F.col("street")).alias("_street"), "x0", "y0", "x1", "y1")
    wide = pieces.select("*", span("x0", "x1").alias("_cx")).select("*", span("y0", "y1").alias("_cy"))
    far = segment_distance(F.col("_x"), F.col("_y"), F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    n = parts(known)  # such rows take few bytes in a shuffle and many in a task
    wide, spots = wide.repartition(n, "_street", "_cx", "_cy"), spots.repartition(n, "_key", "_px", "_py")
    met = wide.join(spots, (F.col("_street") == F.col("_key")) & (F.col("_cx") == F.col("_px")) & (F.col("_cy") == F.col("_py"))).withColumn("_far", F.round(far, places)).filter(F.col("_far") <= radius)
    at = met.repartition(n, "_key", "_x", "_y").groupBy("_key", "_x", "_y").agg(F.min(F.struct("_far", "segment_id")).alias("_near"))
    nearest = known.repartition(n, "_key", "_x", "_y").join(at, ["_key", "_x", "_y"]).repartition(n, "hump_id").groupBy("hump_id").agg(F.min("_near").alias("_near"), F.first("humps").alias("humps"))
    count = F.greatest(F.col("humps"), F.lit(0))
    # a road's records of as many humps have the same shares, so they are counted first
    alike = nearest.select("_near.segment_id", count.alias("_humps")).groupBy("segment_id", "_humps").agg(F.count("*").alias("_n"))
    shares = lambda n: F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: i / (n + 1))).otherwise(F.array().cast("array<double>"))
    each = F.transform(F.collect_list(F.struct("_humps", "_n")), lambda a: F.flatten(F.array_repeat(shares(a["_humps"]), a["_n"].cast("int"))))
    summed = alike.repartition(n, "segment_id").groupBy("segment_id").agg(F.sum(F.col("_humps") * F.col("_n")).cast("int").alias("hump_count"), F.array_sort(F.flatten(each)).alias("hump_fractions"))
    found = roads.select("segment_id").repartition(n, "segment_id").join(summed, "segment_id", "left")
    return found.select("segment_id", F.coalesce("hump_count", F.lit(0)).alias("hump_count"), F.coalesce("hump_fractions", F.array().cast("array<double>")).alias("hump_fractions"))


def build_roads(features: DataFrame, shapes: DataFrame, zones: DataFrame) -> DataFrame:
    """The road table from raw features, shapes and zone rings: filtered, one row an id, with shape and
    zone; rows that break a rule are left out."""
    typed = typed_roads(representative(vehicle_roads(features), "segment_id", "object_id"))
    sound = road_violations(typed).filter("size(broken) = 0").drop("broken", "parts", "object_id")
    shaped, _ = with_shapes(sound, shapes)
    x, y = point_along(F.col("line"), 0.5)
    placed = in_polygons(shaped.select("segment_id", x.alias("x"), y.alias("y")), zones).select("segment_id", "location_id")
    return shaped.join(placed, "segment_id")
