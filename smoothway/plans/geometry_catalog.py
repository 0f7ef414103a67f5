"""Queries on bent roads, routes with targets, and polygons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smoothway.operators import polygons, polylines, roads, spatial
from smoothway.plans.adapters import oracle
from smoothway.plans.registry import query, rounded

# --- bent roads ------------------------------------------------------------------------------------


def bent(read) -> DataFrame:
    p = lambda k: F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"))
    rows = read("bent_roads").withColumn("line", F.slice(F.array(*map(p, range(4))), F.lit(1), F.col("n_points")))
    return rows.drop(*[f"{c}{k}" for c in "xy" for k in range(4)], "n_points")


def _leg(a: int, b: int, before: str) -> str:
    return f"SELECT segment_id, street, traffic_direction, n_points, {a} AS leg, x{a} AS ax, y{a} AS ay, x{b} AS qx, y{b} AS qy, {before} AS off, x0, y0, CASE n_points WHEN 2 THEN x1 WHEN 3 THEN x2 ELSE x3 END AS ex, CASE n_points WHEN 2 THEN y1 WHEN 3 THEN y2 ELSE y3 END AS ey FROM bent_roads WHERE n_points > {b}"


_L01, _L12 = "sqrt(power(x1 - x0, 2) + power(y1 - y0, 2))", "sqrt(power(x2 - x1, 2) + power(y2 - y1, 2))"
LEGS = f"legs AS ({_leg(0, 1, '0')} UNION ALL {_leg(1, 2, _L01)} UNION ALL {_leg(2, 3, f'{_L01} + {_L12}')})"
_T = "greatest(0, least(1, (({p}.x - ax) * (qx - ax) + ({p}.y - ay) * (qy - ay)) / ((qx - ax) * (qx - ax) + (qy - ay) * (qy - ay))))"
_FAR = "sqrt(power({p}.x - (ax + tt * (qx - ax)), 2) + power({p}.y - (ay + tt * (qy - ay)), 2))"
_NEAR = f"""met AS (SELECT e.event_id, e.x, e.y, e.heading, l.*, {_T.format(p='e')} AS tt FROM sensor_events e JOIN legs l ON e.x BETWEEN least(ax, qx) - 30 AND greatest(ax, qx) + 30 AND e.y BETWEEN least(ay, qy) - 30 AND greatest(ay, qy) + 30),
 far AS (SELECT *, {_FAR.format(p='met')} AS distance_m FROM met), near AS (SELECT *, off + tt * sqrt(power(qx - ax, 2) + power(qy - ay, 2)) AS along_m FROM (SELECT *, row_number() OVER (PARTITION BY event_id, segment_id ORDER BY round(distance_m, 6), leg) AS rn FROM far WHERE distance_m <= 30) WHERE rn = 1)"""
_FWD = "((degrees(atan2(ex - x0, ey - y0)) + 360) % 360)"
_HD = lambda a: f"abs((({a}) - heading + 180 + 720) % 360 - 180)"
_BEST = f"""angled AS (SELECT *, CASE traffic_direction WHEN 'W' THEN {_HD(_FWD)} WHEN 'A' THEN {_HD(f'(({_FWD} + 180) % 360)')} ELSE least({_HD(_FWD)}, {_HD(f'(({_FWD} + 180) % 360)')}) END AS diff FROM near),
 valued AS (SELECT *, CASE WHEN heading IS NULL THEN 1 - distance_m / 30 ELSE 0.7 * (1 - distance_m / 30) + 0.3 * (1 - diff / 180) END AS match_score FROM angled),
 best AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY round(match_score, 9) DESC, round(distance_m, 9), round(diff, 9), segment_id) AS place, count(*) OVER (PARTITION BY event_id) AS candidate_count FROM valued)"""


@query("j1_polyline_candidates", oracle(["sensor_events", "bent_roads"], "SELECT e.event_id, segment_id, leg, round(distance_m, 6) AS distance_m, round(along_m, 4) AS along_m FROM sensor_events e LEFT JOIN near USING (event_id)", LEGS, _NEAR))
def _(read):
    def at(places: DataFrame) -> DataFrame:
        found = polylines.candidates(places, bent(read).select("segment_id", "line"), key=("x", "y"))
        return found.select("x", "y", "segment_id", "leg", F.round("distance_m", 6).alias("distance_m"), F.round("along_m", 4).alias("along_m"))

    found = spatial.once_a_place(read("sensor_events").select("event_id", "x", "y"), at, "x", "y")
    return found.select("event_id", "segment_id", "leg", "distance_m", "along_m")


@query("j3_polyline_matching", oracle(["sensor_events", "bent_roads"], "SELECT e.event_id, b.segment_id, b.leg, round(b.match_score, 6) AS match_score, round(b.along_m, 4) AS along_m, coalesce(b.candidate_count, 0) AS candidate_count FROM sensor_events e LEFT JOIN best b ON b.event_id = e.event_id AND b.place = 1", LEGS, _NEAR, _BEST))
def _(read):
    found = polylines.match(read("sensor_events"), bent(read).select("segment_id", "traffic_direction", "line"))
    return found.select("event_id", "segment_id", "leg", F.round("match_score", 6).alias("match_score"), F.round("along_m", 4).alias("along_m"), "candidate_count")


_KEY = "regexp_replace(upper({}.street), '[^A-Z0-9]', '', 'g')"


@query("j11_polyline_pavement", oracle(["bent_roads", "pavement"], f"""SELECT segment_id, rating AS pavement_rating, CASE WHEN rating >= 8 THEN 'Good' WHEN rating >= 6 THEN 'Fair' WHEN rating IS NOT NULL THEN 'Poor' END AS pavement_condition FROM bent_roads LEFT JOIN (SELECT segment_id, rating FROM
 (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY round({_FAR.format(p='q')}, 6), inspected DESC NULLS LAST, rating DESC) AS rn FROM (SELECT l.*, p.x, p.y, p.inspected, p.rating, {_T.format(p='p')} AS tt FROM legs l JOIN pavement p ON {_KEY.format('l')} = {_KEY.format('p')} WHERE p.inspected IS NULL OR p.inspected <= 20250600) q WHERE {_FAR.format(p='q')} <= 39) WHERE rn = 1) USING (segment_id)""", LEGS))  # fmt: skip
def _(read):
    return polylines.pavement(bent(read), read("pavement"), 20250600)


_HUMPS = f"""near AS (SELECT hump_id, humps, segment_id, round({_FAR.format(p='q')}, 6) AS far FROM (SELECT l.*, h.x, h.y, h.hump_id, h.humps, {_T.format(p='h')} AS tt FROM legs l JOIN humps h ON {_KEY.format('l')} = {_KEY.format('h')} WHERE h.installed IS NULL OR h.installed <= 20250700) q),
 nearest AS (SELECT hump_id, humps, segment_id FROM (SELECT *, row_number() OVER (PARTITION BY hump_id ORDER BY far, segment_id) AS rn FROM near WHERE far <= 39) WHERE rn = 1)"""


@query("j12_polyline_humps", oracle(["bent_roads", "humps"], "SELECT r.segment_id, CAST(coalesce(sum(humps), 0) AS INT) AS hump_count, coalesce(round(sum(humps / 2.0), 6), 0) AS shares FROM bent_roads r LEFT JOIN nearest n USING (segment_id) GROUP BY 1", LEGS, _HUMPS))
def _(read):
    found = polylines.speed_humps(bent(read), read("humps"), 20250700)
    return found.select("segment_id", "hump_count", F.round(F.aggregate("hump_fractions", F.lit(0.0), lambda a, x: a + x), 6).alias("shares"))


@query("m7_single_lines", oracle(["bent_roads"], """SELECT segment_id, CASE WHEN k = 0 THEN 'parts' WHEN k = 1 THEN 'point' WHEN k = 2 THEN 'empty' WHEN k = 3 THEN 'infinite' ELSE 'line' END AS state FROM (SELECT segment_id, CAST(substr(segment_id, 2) AS INT) % 7 AS k FROM bent_roads)"""))
def _(read):
    """Roads of which some are given in two parts, as one point again and again, without points, or with an infinite one."""
    k = F.substring("segment_id", 2, 9).cast("int") % 7
    rows = bent(read).withColumn("k", k)
    nowhere = F.transform("line", lambda p: F.struct((p["x"] + float("inf")).alias("x"), p["y"].alias("y")))
    same = F.transform("line", lambda p: F.element_at("line", 1))
    parts = F.when(F.col("k") == 0, F.array("line", "line")).when(F.col("k") == 1, F.array(same)).when(F.col("k") == 2, F.array(F.slice("line", 1, 0))).when(F.col("k") == 3, F.array(nowhere)).otherwise(F.array("line"))
    names = F.when(F.col("k") > 3, F.lit("line")).otherwise(F.element_at(F.array(*map(F.lit, ("parts", "point", "empty", "infinite"))), F.least("k", F.lit(3)) + 1))
    made = rows.select("segment_id", roads.one_line(parts).isNotNull().alias("sound"), names.alias("asked"))
    # a line where one was asked for and none where not; any other outcome shows as such
    return made.select("segment_id", F.when(F.col("sound") == (F.col("asked") == "line"), F.col("asked")).otherwise("wrong").alias("state"))


# --- polygons --------------------------------------------------------------------------------------


def _ring(*points: tuple[str, str]):
    p = lambda x, y: F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y"))
    return F.array(*[p(x, y) for x, y in (*points, points[0])])


def corners(read) -> DataFrame:
    """Zones without their upper right corner: the lower half and the left of the upper half of each box."""
    half, up = "x0 + floor(width / 2)", "y0 + floor(height / 2)"
    ring = _ring(("x0", "y0"), ("x0 + width", "y0"), ("x0 + width", up), (half, up), (half, "y0 + height"), ("x0", "y0 + height"))
    return read("zones").select("location_id", "borough", ring.alias("ring"))


def _boxes(rows: DataFrame, width: str, height: str) -> DataFrame:
    return rows.withColumn("ring", _ring(("x0", "y0"), (f"x0 + {width}", "y0"), (f"x0 + {width}", f"y0 + {height}"), ("x0", f"y0 + {height}")))


PARTS = """parts AS (SELECT location_id, x0 AS l, y0 AS b, x0 + width AS r, y0 + floor(height / 2) AS t FROM zones UNION ALL SELECT location_id, x0, y0 + floor(height / 2), x0 + floor(width / 2), y0 + height FROM zones),
 sizes AS (SELECT location_id, sum((r - l) * (t - b)) AS whole FROM parts GROUP BY 1)"""


@query("j22_polygon_shares", oracle(["zones", "road_segments"], """SELECT id, location_id, round(sum((least(x1, r) - greatest(x0, l)) * (least(y1, t) - greatest(y0, b))) / any_value((x1 - x0) * (y1 - y0)), 6) AS share FROM (SELECT segment_id AS id, x0, y0, x1, y1 FROM road_segments) JOIN parts ON least(x1, r) > greatest(x0, l) AND least(y1, t) > greatest(y0, b) GROUP BY 1, 2""", PARTS))
def _(read):
    """Shares of the boxes of roads in zones that aren't convex."""
    one = _boxes(read("road_segments").withColumnRenamed("segment_id", "id"), "(x1 - x0)", "(y1 - y0)").select("id", "ring")
    found = polygons.overlaid(one, corners(read).select("location_id", "ring"))
    return found.select("id", "location_id", F.round("share", 6).alias("share"))


@query("j30_park_areas", oracle(["zones", "pavement"], """SELECT location_id, round(coalesce(n, 0), 6) AS park_area, round(coalesce(n, 0) / whole, 6) AS park_area_ratio FROM sizes LEFT JOIN (SELECT location_id, CAST(count(DISTINCT (i, j)) AS DOUBLE) AS n FROM
 (SELECT DISTINCT i, j FROM (SELECT y, x, h, unnest(range(CAST(x AS BIGINT), CAST(x AS BIGINT) + w)) AS i FROM (SELECT x, y, CAST(20 + rating AS BIGINT) AS w, CAST(12 + rating AS BIGINT) AS h FROM pavement)), LATERAL (SELECT unnest(range(CAST(y AS BIGINT), CAST(y AS BIGINT) + h)) AS j)) JOIN parts ON i >= l AND i < r AND j >= b AND j < t GROUP BY 1) USING (location_id)""", PARTS))  # fmt: skip
def _(read):
    """Parks are boxes about rated points, many of which overlap; the SQL counts unit squares."""
    parks = _boxes(read("pavement").selectExpr("x AS x0", "y AS y0", "20 + rating AS w", "12 + rating AS h"), "w", "h").select("ring")
    return rounded(polygons.covered_areas(corners(read).select("location_id", "ring"), parks))


def _tiles(read) -> DataFrame:
    """Zones as tiles that adjoin."""
    at = read("zones").selectExpr("location_id", "borough", "CAST((location_id % 5) * 400 AS DOUBLE) AS x0", "CAST(location_id div 5 * 300 AS DOUBLE) AS y0")
    return _boxes(at, "400", "300").select("location_id", "borough", "ring")


TILES = """tiles AS (SELECT location_id, borough, location_id % 5 AS c, location_id // 5 AS r FROM zones), sides AS (SELECT t.borough, CASE WHEN d.dc = 0 THEN 400.0 ELSE 300.0 END AS len, n.borough AS other FROM tiles t CROSS JOIN (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(dc, dr) LEFT JOIN tiles n ON n.c = t.c + d.dc AND n.r = t.r + d.dr)"""


@query("a31_borough_outlines", oracle(["zones"], "SELECT borough, round(any_value(area), 6) AS area, round(CAST(sum(len) FILTER (other IS DISTINCT FROM borough) AS DOUBLE), 6) AS outline FROM sides JOIN (SELECT borough, CAST(count(*) * 120000.0 AS DOUBLE) AS area FROM tiles GROUP BY 1) USING (borough) GROUP BY 1", TILES))
def _(read):
    """Area and length of each borough's outlines; holes count less than nothing in the first."""
    found = polygons.dissolved(_tiles(read), "borough").withColumn("len", roads.line_length(F.col("ring")))
    return rounded(found.groupBy("borough").agg(F.sum("area").alias("area"), F.sum("len").alias("outline")))


@query("j25_adjacent_polygons", oracle(["zones"], "SELECT a.location_id AS a, b.location_id AS b FROM tiles a JOIN tiles b ON a.location_id < b.location_id AND abs(a.c - b.c) <= 1 AND abs(a.r - b.r) <= 1", TILES))
def _(read):
    return polygons.adjacent(_tiles(read))


@query("g6_regions")
def _(read):
    return polygons.regions(corners(read).select("location_id", "ring"), 8)


@query("g7_snapped_points", oracle(["zones"], f"""SELECT region, round(mx, 6) AS x, round(CASE WHEN region % 2 = 0 THEN my ELSE my END, 6) AS y, false AS snapped FROM (SELECT location_id % 5 AS region, avg(200 + 400 * (location_id % 5)) AS mx, avg(150 + 300 * (location_id // 5)) AS my FROM zones GROUP BY 1)"""))
def _(read):
    """Columns of tiles: their mean point lies in the middle one."""
    of = read("zones").selectExpr("location_id", "location_id % 5 AS region")
    x, y = polygons.inner_point(F.col("ring"))
    return rounded(polygons.region_points(_tiles(read).select("location_id", "ring", x.alias("x"), y.alias("y")), of))


@query("g8_inner_points", oracle(["zones"], "SELECT location_id, borough, round(whole, 6) AS area, round(x0 + floor(width / 2) / 2, 6) AS x, round(y0 + (floor(height / 2) + height) / 2, 6) AS y FROM zones JOIN sizes USING (location_id)", PARTS))
def _(read):
    """The level line of such a zone runs half way between its middle, where it has corners, and its top."""
    return rounded(polygons.zone_master(corners(read)).drop("ring"))
