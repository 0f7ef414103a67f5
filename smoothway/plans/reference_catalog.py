"""Queries on reference data, guards and audits, zone profiles, regions and routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smoothway.functions import quality as q
from smoothway.operators import audits, profiles, roads, routing, serving, spatial, weather, zones
from smoothway.plans.adapters import BASE_US, HOUR_US, oracle
from smoothway.plans.registry import query, rounded
from smoothway.sources import scans

# --- road reference --------------------------------------------------------------------------------

USED = """used AS (SELECT * FROM road_features WHERE feature_type IN ('0', '6', 'A', 'C') AND status = '2' AND rw_type IN ('1', '2', '3', '4', '8', '9', '10', '13') AND traffic IN ('T', 'W', 'A'))"""
TYPED = """typed AS (SELECT nullif(trim(segment_id), '') AS segment_id, object_id, nullif(trim(street), '') AS street, traffic AS traffic_direction, TRY_CAST(replace(nullif(trim(length_ft), ''), ',', '') AS DOUBLE) * 0.3048 AS length_m,
 CASE WHEN built = 'unknown' THEN NULL ELSE DATE '2024-03-15' END AS built, parts FROM {source})"""
BROKEN = """broken AS (SELECT segment_id, object_id, concat_ws(',', CASE WHEN segment_id IS NULL THEN 'segment_id_null' END, CASE WHEN street IS NULL THEN 'street_null' END, CASE WHEN coalesce(length_m <= 0, true) THEN 'length_not_positive' END, CASE WHEN parts > 1 THEN 'several_parts' END,
 CASE WHEN segment_id IS NOT NULL AND count(*) OVER (PARTITION BY segment_id) > 1 THEN 'duplicate_id' END) AS broken FROM typed)"""
FIRST = "firsts AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY object_id) AS rn FROM used WHERE trim(segment_id) <> '') WHERE rn = 1)"


@query("f11_vehicle_roads", oracle(["road_features"], "SELECT object_id, segment_id FROM used", USED))
def _(read):
    return roads.vehicle_roads(read("road_features")).select("object_id", "segment_id")


@query("w10_representatives", oracle(["road_features"], "SELECT segment_id, object_id FROM firsts", USED, FIRST))
def _(read):
    return zones.representative(roads.vehicle_roads(read("road_features")), "segment_id", "object_id").select("segment_id", "object_id")


@query("m21_typed_roads", oracle(["road_features"], "SELECT object_id, segment_id, street, round(length_m, 6) AS length_m, built FROM typed", TYPED.format(source="road_features")))
def _(read):
    return rounded(roads.typed_roads(read("road_features")).select("object_id", "segment_id", "street", "length_m", "built"))


@query("f12_road_violations", oracle(["road_features"], "SELECT object_id, broken FROM broken WHERE broken <> ''", TYPED.format(source="road_features"), BROKEN))
def _(read):
    found = roads.road_violations(roads.typed_roads(read("road_features")))
    return found.filter("size(broken) > 0").select("object_id", F.array_join("broken", ",").alias("broken"))


def _shapes(read) -> DataFrame:
    p = lambda k: F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"))
    return read("road_shapes").select("shape_id", F.array(p(0), p(1), p(2)).alias("line"))


@query("j9_shape_report", oracle(["road_segments", "road_shapes"], "SELECT coalesce(segment_id, shape_id) AS id, CASE WHEN shape_id IS NULL THEN 'road' ELSE 'shape' END AS only FROM road_segments FULL JOIN road_shapes ON segment_id = shape_id WHERE segment_id IS NULL OR shape_id IS NULL"))
def _(read):
    return roads.with_shapes(read("road_segments").select("segment_id"), _shapes(read))[1]


_LEG = "sqrt(power(p.x - (x{a} + t{a} * (x{b} - x{a})), 2) + power(p.y - (y{a} + t{a} * (y{b} - y{a})), 2))"
_T = "greatest(0, least(1, ((p.x - x{a}) * (x{b} - x{a}) + (p.y - y{a}) * (y{b} - y{a})) / ((x{b} - x{a}) * (x{b} - x{a}) + (y{b} - y{a}) * (y{b} - y{a}))))"


@query("m5_line_distance", oracle(["road_shapes", "pavement"], f"""SELECT shape_id, round(min(least({_LEG.format(a=0, b=1)}, {_LEG.format(a=1, b=2)})), 6) AS nearest, round(any_value(sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) + sqrt(power(x2 - x1, 2) + power(y2 - y1, 2))), 6) AS length
 FROM (SELECT s.*, p.x AS px, p.y AS py, struct_pack(x := p.x, y := p.y) AS p, {_T.format(a=0, b=1)} AS t0, {_T.format(a=1, b=2)} AS t1 FROM road_shapes s JOIN pavement p ON p.x >= s.x0 - 60 AND p.x <= s.x0 + 150 AND p.y >= s.y0 - 85 AND p.y <= s.y0 + 90) GROUP BY 1"""))  # fmt: skip
def _(read):
    """The nearest rated point in a box around each bent line, by cells; a place that was rated often counts once."""
    shapes = _shapes(read).withColumns({"a": F.element_at("line", 1)["x"], "b": F.element_at("line", 1)["y"], "length": roads.line_length(F.col("line"))})
    wide = spatial._covering(shapes, F.col("a") - 60, F.col("b") - 85, F.col("a") + 150, F.col("b") + 90, 100.0)
    inside = F.col("x").between(F.col("a") - 60, F.col("a") + 150) & F.col("y").between(F.col("b") - 85, F.col("b") + 90)
    met = spatial.in_grid(spatial.places(read("pavement"), "x", "y"), wide, 100.0, inside).filter("shape_id is not null")
    far = roads.line_distance(F.col("x"), F.col("y"), F.col("line"))
    return rounded(met.groupBy("shape_id").agg(F.min(far).alias("nearest"), F.first("length").alias("length")))


HUMPS = """near AS (SELECT hump_id, humps, segment_id, round(sqrt(power(hx - (x0 + t * (x1 - x0)), 2) + power(hy - (y0 + t * (y1 - y0)), 2)), 6) AS far FROM (SELECT h.hump_id, h.humps, h.x AS hx, h.y AS hy, r.segment_id, r.x0, r.y0, r.x1, r.y1, greatest(0, least(1, ((h.x - x0) * (x1 - x0) + (h.y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS t
 FROM humps h JOIN road_segments r ON regexp_replace(upper(r.street), '[^A-Z0-9]', '', 'g') = regexp_replace(upper(h.street), '[^A-Z0-9]', '', 'g') WHERE h.installed IS NULL OR h.installed <= 20250700)),
 nearest AS (SELECT hump_id, humps, segment_id FROM (SELECT *, row_number() OVER (PARTITION BY hump_id ORDER BY far, segment_id) AS rn FROM near WHERE far <= 39) WHERE rn = 1)"""


@query("j12_speed_humps", oracle(["humps", "road_segments"], "SELECT r.segment_id, CAST(coalesce(sum(humps), 0) AS INT) AS hump_count, coalesce(round(sum(humps / 2.0), 6), 0) AS shares FROM road_segments r LEFT JOIN nearest n USING (segment_id) GROUP BY 1", HUMPS))
def _(read):
    """The shares of n humps add up to n / 2."""
    found = roads.speed_humps(read("road_segments"), read("humps"), 20250700)
    total = F.aggregate("hump_fractions", F.lit(0.0), lambda a, x: a + x)
    return found.select("segment_id", "hump_count", F.round(total, 6).alias("shares"))


_RINGS = """measured AS (SELECT *, sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) AS one, sqrt(power(x2 - x1, 2) + power(y2 - y1, 2)) AS two FROM road_shapes),
 placed AS (SELECT *, CASE WHEN one >= two THEN x0 + (one + two) / 2 / one * (x1 - x0) ELSE x1 + (two - one) / 2 / two * (x2 - x1) END AS mx, CASE WHEN one >= two THEN y0 + (one + two) / 2 / one * (y1 - y0) ELSE y1 + (two - one) / 2 / two * (y2 - y1) END AS my FROM measured)"""


def _rings(read) -> DataFrame:
    at = lambda dx, dy: F.struct((F.col("x0") + dx * F.col("width")).alias("x"), (F.col("y0") + dy * F.col("height")).alias("y"))
    return read("zones").select("location_id", F.array(at(0.0, 0.0), at(1.0, 0.0), at(1.0, 1.0), at(0.0, 1.0), at(0.0, 0.0)).alias("ring"))


@query("a38_road_build", oracle(["road_features", "road_shapes", "zones"], """SELECT t.segment_id, street, traffic_direction, round(length_m, 6) AS length_m, min(z.location_id) AS location_id FROM typed t JOIN broken b USING (segment_id) JOIN placed p ON t.segment_id = p.shape_id
 LEFT JOIN zones z ON mx BETWEEN z.x0 AND z.x0 + z.width AND my BETWEEN z.y0 AND z.y0 + z.height WHERE b.broken = '' GROUP BY 1, 2, 3, 4""", USED, FIRST, TYPED.format(source="firsts"), BROKEN, _RINGS))  # fmt: skip
def _(read):
    made = roads.build_roads(read("road_features"), _shapes(read), _rings(read))
    return rounded(made.select("segment_id", "street", "traffic_direction", "length_m", "location_id"))


@query("j21_points_in_zones", oracle(["pavement", "zones"], "SELECT location_id, count(*) AS points FROM (SELECT p.x, p.y, p.street, (SELECT min(z.location_id) FROM zones z WHERE p.x BETWEEN z.x0 AND z.x0 + z.width AND p.y BETWEEN z.y0 AND z.y0 + z.height) AS location_id FROM pavement p) GROUP BY 1"))
def _(read):
    return spatial.in_polygons(read("pavement").select("x", "y"), _rings(read)).groupBy("location_id").agg(F.count("*").alias("points"))


# --- cleansing and map matching --------------------------------------------------------------------

@query("f1_time_window", oracle(["raw_records"], "SELECT count(*) AS rows FROM raw_records WHERE ingested >= 300 AND ingested < 900"))
def _(read):
    """Records without a readable time of their own go by their arrival; the end is open."""
    rows = read("raw_records").withColumn("arrived", F.timestamp_micros(F.lit(BASE_US) + F.col("ingested") * 1_000_000))
    at = F.unix_micros(F.coalesce(F.try_to_timestamp(F.get_json_object("value", "$.event_time")), F.col("arrived")))
    return rows.filter((at >= BASE_US + 300_000_000) & (at < BASE_US + 900_000_000)).agg(F.count("*").alias("rows"))


@query("f4_exclusive_bounds", oracle(["sensor_events"], "SELECT event_id, concat_ws(', ', CASE WHEN speed_mps < 1 OR speed_mps >= 17 THEN concat('speed_mps=', speed_mps) END, CASE WHEN heading >= 348 THEN concat('heading=', heading) END) AS detail FROM sensor_events WHERE speed_mps < 1 OR speed_mps >= 17 OR heading >= 348"))
def _(read):
    bad = q.out_of_range({"speed_mps": (1.0, 17.0, True), "heading": (None, 348.0, True)})
    return read("sensor_events").withColumn("_bad", bad).filter("size(_bad) > 0").select("event_id", F.concat_ws(", ", "_bad").alias("detail"))


def _unmatched(read) -> DataFrame:
    found = spatial.match(read("sensor_events"), read("road_segments").select("segment_id", "x0", "y0", "x1", "y1", "traffic_direction"))
    raw = read("sensor_events").select("event_id", F.concat(F.lit("record "), F.col("event_id").cast("string")).alias("raw_record"))
    return spatial.match_quarantine(found, raw.unionByName(raw), "run-1")


@query("f9_match_quarantine", oracle(["sensor_events", "road_segments"], """SELECT event_id, trip_id, 'MAP_MATCH_FAILED' AS reject_reason, concat('record ', event_id) AS raw_record, true AS nulls_written FROM sensor_events e WHERE NOT EXISTS (SELECT 1 FROM road_segments r WHERE e.x BETWEEN r.x0 - 30 AND r.x1 + 30 AND e.y BETWEEN r.y0 - 30 AND r.y1 + 30
 AND sqrt(power(e.x - (r.x0 + greatest(0, least(1, ((e.x - r.x0) * (r.x1 - r.x0) + (e.y - r.y0) * (r.y1 - r.y0)) / ((r.x1 - r.x0) * (r.x1 - r.x0) + (r.y1 - r.y0) * (r.y1 - r.y0)))) * (r.x1 - r.x0)), 2) + power(e.y - (r.y0 + greatest(0, least(1, ((e.x - r.x0) * (r.x1 - r.x0) + (e.y - r.y0) * (r.y1 - r.y0)) / ((r.x1 - r.x0) * (r.x1 - r.x0) + (r.y1 - r.y0) * (r.y1 - r.y0)))) * (r.y1 - r.y0)), 2)) <= 30)"""))  # fmt: skip
def _(read):
    """Raw records are joined to the failed events only, and repeated ones count once."""
    return _unmatched(read).select("event_id", "trip_id", "reject_reason", "raw_record", F.contains("reject_detail", F.lit('"map_match_score":null')).alias("nulls_written"))


@query("u1_quarantine_union", oracle(["sensor_events"], "SELECT reject_reason, count(*) AS rows FROM (SELECT CASE WHEN speed_mps >= 17 THEN 'OUT_OF_RANGE' WHEN heading IS NULL THEN 'MISSING_REQUIRED_FIELD' END AS reject_reason FROM sensor_events) WHERE reject_reason IS NOT NULL GROUP BY 1"))
def _(read):
    """Streams of rejected rows with other columns in another order make one."""
    rows = read("sensor_events")
    one = rows.filter("speed_mps >= 17").select("event_id", F.lit("OUT_OF_RANGE").alias("reject_reason"), "speed_mps")
    two = rows.filter("speed_mps < 17 and heading is null").select(F.lit("MISSING_REQUIRED_FIELD").alias("reject_reason"), "event_id")
    return scans.together([one, two]).groupBy("reject_reason").agg(F.count("*").alias("rows"))


# --- guards and audits -----------------------------------------------------------------------------

NOW_US = BASE_US + 30 * HOUR_US


@query("f20_at_rest_audit", oracle(["sensor_events"], f"SELECT round(({NOW_US} - max(event_us)) / 1e6, 6) AS age_seconds, count(*) FILTER (vehicle_profile_id > 3) AS orphan_profiles, false AS passed FROM sensor_events"))
def _(read):
    known = read("sensor_events").filter("vehicle_profile_id <= 3").select("vehicle_profile_id")
    return rounded(audits.freshness_and_orphans(read("sensor_events"), known, NOW_US, "event_us"))


@query("f21_match_rates", oracle(["zone_weather"], "SELECT 'temperature_2m' AS name, round(count(temperature_2m) / count(*), 6) AS rate, count(temperature_2m) / count(*) >= 0.95 AS passed FROM zone_weather UNION ALL SELECT 'visibility', round(count(visibility) / count(*), 6), count(visibility) / count(*) >= 0.5 FROM zone_weather"))
def _(read):
    return rounded(audits.match_rates(read("zone_weather"), {"temperature_2m": 0.95, "visibility": 0.5}))


@query("f23_environment_guard", oracle(["pavement"], "SELECT CAST(0 AS BIGINT) AS empty, (SELECT count(*) FROM (SELECT street FROM pavement GROUP BY 1 HAVING count(*) > 1)) AS repeated_ids, count(*) FILTER (rating - 2 <= 0) AS ratings_out_of_range FROM pavement"))
def _(read):
    return audits.environment_guard(read("pavement").withColumn("rating", F.col("rating") - 2), "street", "rating")


@query("f24_reference_guard", oracle(["road_features"], "SELECT CAST(0 AS BIGINT) AS empty, count(DISTINCT built) - 1 AS further_dates, count(*) FILTER (trim(segment_id) = '') AS no_id, count(*) FILTER (length_ft = '') AS no_shape FROM road_features"))
def _(read):
    rows = read("road_features").withColumns({"segment_id": F.nullif(F.trim("segment_id"), F.lit("")), "length_ft": F.nullif("length_ft", F.lit(""))})
    return audits.reference_guard(rows, "segment_id", "built", "length_ft")


@query("f25_staging_guard", oracle(["hourly_scores"], "SELECT CAST(sum(n - 1) AS BIGINT) AS repeated_rows, CAST(sum(odd) AS BIGINT) AS not_finite FROM (SELECT count(*) AS n, count(*) FILTER (trip_count = 0) AS odd FROM hourly_scores GROUP BY segment_id, vehicle_profile_id, period_us)"))
def _(read):
    """Scores of hours without trips are made infinite."""
    rows = read("hourly_scores").withColumn("vertical_score", F.when(F.col("trip_count") == 0, F.lit(float("inf"))).otherwise(F.col("vertical_score")))
    return audits.staging_guard(rows, ["segment_id", "vehicle_profile_id", "period_us"], ["vertical_score", "lateral_score"])


@query("f26_universe_guard", oracle(["hourly_scores", "road_segments"], "SELECT count(*) FILTER (vehicle_profile_id = 4) AS reserved, count(*) FILTER (segment_id NOT IN (SELECT segment_id FROM road_segments)) AS unknown FROM hourly_scores"))
def _(read):
    rows = read("hourly_scores").withColumn("vehicle_profile_id", F.col("vehicle_profile_id") % 4)
    return audits.universe_guard(rows, read("road_segments"))


@query("f10_single_hour_guard", oracle(["hourly_signals"], "SELECT count(*) FILTER (hour_us <> (SELECT min(hour_us) FROM hourly_signals)) AS others FROM hourly_signals"))
def _(read):
    return audits.single_value_guard(read("hourly_signals"), "hour_us")


@query("a5_one_scan_validation", oracle(["hourly_scores"], "SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT 1 FROM hourly_scores GROUP BY segment_id, period_us HAVING count(*) > 1)) AS repeated_keys, count(*) FILTER (lateral_score < 50) AS lateral, count(*) FILTER (trip_count > 6) AS trips FROM hourly_scores"))
def _(read):
    return audits.one_scan_validation(read("hourly_scores"), ["segment_id", "period_us"], {"lateral": F.col("lateral_score") >= 50, "trips": F.col("trip_count") <= 6})


@query("f27_partition_gate", oracle(["hourly_scores"], "SELECT count(*) AS rows, count(*) FILTER (NOT vertical_score <= 90) AS vertical, count(*) FILTER (NOT trip_count >= 0) AS trips, false AS passed FROM hourly_scores WHERE vehicle_profile_id = 2"))
def _(read):
    return audits.gate(read("hourly_scores").filter("vehicle_profile_id = 2"), {"vertical": F.col("vertical_score") <= 90, "trips": F.col("trip_count") >= 0})


@query("f28_snapshot_gate", oracle(["road_segments"], "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS direction, count(*) > 0 AS passed FROM road_segments"))
def _(read):
    return audits.gate(read("road_segments").select("traffic_direction"), {"direction": F.col("traffic_direction").isin("W", "A", "T")})


@query("a13_snapshot_audit", oracle(["builds"], "SELECT count(*) AS rows, count(*) FILTER (month <> 4) AS mismatched FROM builds"))
def _(read):
    return audits.snapshot_audit(read("builds"), "month", 4)


@query("f19_split_quarantine_rate", oracle(["sensor_events"], "SELECT round(count(*) FILTER (event_id % 40 = 0) / count(*), 6) AS cleansing, round(count(*) FILTER (event_id % 50 = 7) / count(*), 6) AS map_matching, (count(*) FILTER (event_id % 40 = 0) + count(*) FILTER (event_id % 50 = 7)) / count(*) <= 0.1 AS passed FROM sensor_events"))
def _(read):
    reason = F.when(F.col("event_id") % 40 == 0, "OUT_OF_RANGE").when(F.col("event_id") % 50 == 7, "MAP_MATCH_FAILED")
    return rounded(audits.quarantine_rates(read("sensor_events").withColumn("reject_reason", reason)))


@query("f29_request_limits", oracle(["routes"], "SELECT request, concat_ws(',', CASE WHEN count(DISTINCT route_id) > 10 THEN 'routes' END, CASE WHEN count(DISTINCT segment_id) > 300 THEN 'segments' END, CASE WHEN count(*) > 1000 THEN 'batch' END) AS broken FROM (SELECT *, CASE WHEN route_id % 50 < 5 THEN route_id % 50 ELSE 100 + route_id END AS request FROM routes) GROUP BY 1"))
def _(read):
    request = F.when(F.col("route_id") % 50 < 5, F.col("route_id") % 50).otherwise(100 + F.col("route_id"))
    return audits.request_violations(read("routes").withColumn("request", request)).select("request", F.array_join("broken", ",").alias("broken"))


@query("f31_missing_groups", oracle(["zone_weather"], "SELECT 'air' AS source, location_id FROM zone_weather WHERE temperature_2m IS NULL AND visibility IS NULL UNION ALL SELECT 'sight', location_id FROM zone_weather WHERE visibility IS NULL"))
def _(read):
    return audits.missing_groups(read("zone_weather"), "location_id", {"air": ["temperature_2m", "visibility"], "sight": ["visibility"]})


@query("u4_unknown_zones", oracle(["trips", "zones"], "SELECT DISTINCT dropoff_zone AS location_id FROM trips WHERE dropoff_zone NOT IN (SELECT location_id FROM zones)"))
def _(read):
    return audits.only_in(read("trips").select(F.col("dropoff_zone").alias("location_id")), read("zones"), "location_id")


@query("a32_quality_counts", oracle(["road_features"], "SELECT count(*) AS roads, count(*) FILTER (length_ft <> '') AS measured, count(*) FILTER (trim(street) <> '') AS named FROM road_features"))
def _(read):
    return audits.preparation_counts(read("road_features"), measured=F.col("length_ft") != "", named=F.trim("street") != "")


# --- weather and serving ---------------------------------------------------------------------------

def _regions(read) -> DataFrame:
    return read("zones").select("location_id", (F.col("location_id") % 6).alias("region"))


@query("j16_region_fan_out", oracle(["zones"], "SELECT location_id, location_id % 6 AS region, CASE WHEN location_id % 6 = 4 THEN 'failed' WHEN location_id % 6 = 5 THEN 'no reading' ELSE 'ok' END AS state, CASE WHEN location_id % 6 < 4 THEN CAST(location_id % 6 * 2.5 AS DOUBLE) END AS temperature FROM zones"))
def _(read):
    """A region's reading goes to each of its zones; a failed one with its reason, a missing one as such."""
    spark = read("zones").sparkSession
    readings = spark.createDataFrame([(r, "failed" if r == 4 else None, None if r == 4 else r * 2.5) for r in range(5)], "region long, error string, temperature double")
    return weather.fan_out(_regions(read).withColumn("region", F.col("region").cast("long")), readings).select("location_id", F.col("region").cast("int").alias("region"), "state", "temperature")


@query("j15_zone_targets", oracle(["hourly_scores", "zone_weather"], "SELECT DISTINCT segment_id, CAST(CAST(substr(segment_id, 2) AS INT) % 30 AS INT) AS location_id FROM hourly_scores WHERE CAST(substr(segment_id, 2) AS INT) % 30 IN (SELECT location_id FROM zone_weather WHERE wind_gusts_10m >= 15)"))
def _(read):
    at = read("hourly_scores").select("segment_id", (F.substring("segment_id", 2, 9).cast("int") % 30).alias("location_id"))
    return weather.zone_targets(at, read("zone_weather").filter("wind_gusts_10m >= 15"))


@query("u5_latest_rows", oracle(["hourly_scores"], "SELECT segment_id, period_us, count(*) AS rows FROM hourly_scores h WHERE period_us = (SELECT max(period_us) FROM hourly_scores g WHERE g.segment_id = h.segment_id) GROUP BY 1, 2"))
def _(read):
    return serving.latest_only(read("hourly_scores"), ["segment_id"], "period_us").groupBy("segment_id", "period_us").agg(F.count("*").alias("rows"))


@query("r10_changed_only", oracle(["zone_weather", "road_segments"], "SELECT segment_id, CAST(CAST(substr(segment_id, 2) AS INT) % 25 AS INT) AS location_id, true AS again FROM road_segments WHERE CAST(substr(segment_id, 2) AS INT) % 25 IN (SELECT location_id FROM zone_weather WHERE location_id % 4 = 1)"))
def _(read):
    """Only segments of zones whose signature changed are worked on again."""
    new = read("zone_weather").select("location_id", weather.signature(weather.conditions()).alias("impact_signature"))
    old = new.withColumn("impact_signature", F.when(F.col("location_id") % 4 == 1, F.lit("other")).otherwise(F.col("impact_signature")))
    at = read("road_segments").select("segment_id", (F.substring("segment_id", 2, 9).cast("int") % 25).alias("location_id"))
    return weather.zone_targets(at, weather.changed_zones(old, new)).withColumn("again", F.lit(True))


@query("f15_signature_grammar", oracle(["zone_weather"], "SELECT location_id, CASE location_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'ice,rain' ELSE NULL END AS conditions FROM zone_weather"))
def _(read):
    told = F.when(F.col("location_id") % 5 == 0, "v1|clear").when(F.col("location_id") % 5 == 1, "v1|ice,rain").when(F.col("location_id") % 5 == 2, "v1|rain,ice").when(F.col("location_id") % 5 == 3, "v0|rain").otherwise("v1|hail")
    return read("zone_weather").select("location_id", F.array_join(weather.parse_signature(told), ",").alias("conditions"))


@query("m16_quarter_hours", oracle(["trips"], "SELECT trip_id, request_us % 900000000 = 0 AS on_quarter FROM trips"))
def _(read):
    return read("trips").select("trip_id", weather.on_quarter(F.timestamp_micros("request_us")).alias("on_quarter"))


@query("m37_versions", oracle(["hourly_scores"], "SELECT scoring_version, scoring_version <> '1.2.0' AS sound, count(*) AS rows FROM hourly_scores GROUP BY 1, 2"))
def _(read):
    version = F.when(F.col("scoring_version") == "1.2.0", "1.02.0").otherwise(F.col("scoring_version"))
    return read("hourly_scores").groupBy("scoring_version", serving.is_version(version).alias("sound")).agg(F.count("*").alias("rows"))


@query("m40_filled_periods", oracle(["hourly_scores"], f"SELECT segment_id, CASE WHEN max(trip_count) >= 7 THEN min(period_us) ELSE {BASE_US - 168 * HOUR_US} END AS first_us, {BASE_US} AS as_of_us FROM hourly_scores GROUP BY 1"))
def _(read):
    seen = read("hourly_scores").groupBy("segment_id").agg(F.min("period_us").alias("first_us"), F.max("trip_count").alias("_t"))
    partly = seen.withColumn("first_us", F.when(F.col("_t") >= 7, F.col("first_us"))).drop("_t")
    return serving.with_window(partly, BASE_US - 168 * HOUR_US, BASE_US)


@query("a26_percentiles", oracle(["trips"], "SELECT month, round_even(quantile_cont(miles, 0.5), 1) AS p50, round_even(quantile_cont(miles, 0.95), 1) AS p95 FROM trips WHERE miles IS NOT NULL GROUP BY 1"))
def _(read):
    return serving.percentiles(read("trips"), "month", "miles", {"p50": 0.5, "p95": 0.95}, 1)


# --- zone profiles ---------------------------------------------------------------------------------

@query("m22_snake_case", oracle(["zones"], "SELECT location_id AS location_id, borough AS borough_name_x FROM zones"))
def _(read):
    return profiles.snake_case(read("zones").select(F.col("location_id").alias("Location ID"), F.col("borough").alias(" Borough (Name)/X ")))


@query("m23_block_codes", oracle(["blocks"], "SELECT lpad(CAST(state AS VARCHAR), 2, '0') || lpad(CAST(county AS VARCHAR), 3, '0') || lpad(CAST(tract AS VARCHAR), 6, '0') AS code, CASE WHEN population >= 0 THEN population END AS population, CASE WHEN men IS NOT NULL OR women IS NOT NULL THEN coalesce(men, 0) + coalesce(women, 0) END AS seniors FROM blocks"))
def _(read):
    return read("blocks").select(profiles.block_code(F.col("state"), F.col("county"), F.col("tract")).alias("code"), profiles.without_sentinels(F.col("population")).alias("population"), profiles.sum_of_known(F.col("men"), F.col("women")).alias("seniors"))


@query("a22_block_features", oracle(["blocks"], """SELECT location_id, round(population, 6) AS population, round(homes, 6) AS households, CASE WHEN population <> 0 THEN round(seniors / population, 6) END AS senior_ratio, CASE WHEN told <> 0 THEN round(income / told, 6) END AS income FROM (SELECT location_id, sum(CASE WHEN population >= 0 THEN population END * share) AS population, sum(households * share) AS homes,
 sum(CASE WHEN men IS NOT NULL OR women IS NOT NULL THEN coalesce(men, 0) + coalesce(women, 0) END * share) AS seniors, sum(CASE WHEN households * share > 0 THEN income * (households * share) END) AS income, sum(CASE WHEN income IS NOT NULL AND households * share > 0 THEN households * share END) AS told FROM blocks GROUP BY 1)"""))  # fmt: skip
def _(read):
    return rounded(profiles.block_features(read("blocks")))


@query("m24_map_categories", oracle(["facilities"], """SELECT category, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN shop <> '' THEN 'shop' END, CASE WHEN amenity IN ('restaurant', 'cafe') THEN 'restaurant' END, CASE WHEN amenity IN ('bar', 'pub', 'nightclub') THEN 'nightlife' END, CASE WHEN tourism = 'hotel' THEN 'hotel' END, CASE WHEN tourism = 'museum' THEN 'museum' END, CASE WHEN tourism = 'attraction' THEN 'attraction' END], lambda x: x IS NOT NULL)) AS category FROM facilities) GROUP BY 1"""))
def _(read):
    return read("facilities").select(F.explode(profiles.map_categories()).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


@query("m25_keyword_categories", oracle(["facilities"], "SELECT 'education' AS category, count(*) AS n FROM facilities WHERE regexp_matches(lower(kind), 'school|day care') UNION ALL SELECT 'culture', count(*) FROM facilities WHERE regexp_matches(lower(kind), 'museum')"))
def _(read):
    found = zones.keyword_categories(F.col("kind"), {"education": "school|day care", "culture": "museum"})
    return read("facilities").select(F.explode(found).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


@query("m43_coordinates", oracle(["facilities"], "SELECT facility_id, TRY_CAST(coalesce(latitude, inner_latitude) AS DOUBLE) AS latitude FROM facilities"))
def _(read):
    rows = read("facilities").withColumn("location", F.struct(F.col("inner_latitude").alias("latitude")))
    return rows.select("facility_id", profiles.coordinate(F.col("latitude"), F.col("location.latitude")).alias("latitude"))


BEDS = "beds_of AS (SELECT facility_id, CAST(sum(measure) AS BIGINT) AS beds FROM beds WHERE lower(attribute) = 'bed' AND lower(sub_type) = 'permanent' GROUP BY 1)"


@query("a24_beds", oracle(["beds"], "SELECT facility_id, beds FROM beds_of", BEDS))
def _(read):
    return profiles.bed_totals(read("beds"))


@query("j31_hospital_beds", oracle(["facilities", "beds"], "SELECT facility_id, coalesce(beds, 0) AS beds FROM facilities LEFT JOIN beds_of USING (facility_id) WHERE lower(trim(kind)) = 'hospital'", BEDS))
def _(read):
    return profiles.hospitals(read("facilities"), profiles.bed_totals(read("beds"))).select("facility_id", "beds")


@query("j33_blocks_by_code", oracle(["blocks"], "SELECT location_id, CAST(sum(jobs) AS BIGINT) AS jobs FROM (SELECT lpad(CAST(tract AS VARCHAR), 6, '0') AS code, tract % 10 AS jobs FROM blocks) JOIN (SELECT lpad(CAST(tract AS VARCHAR), 6, '0') AS code, location_id FROM blocks WHERE tract % 4 <> 0) USING (code) GROUP BY 1"))
def _(read):
    code = F.lpad(F.col("tract").cast("string"), 6, "0")
    rows = read("blocks").select(code.alias("code"), (F.col("tract") % 10).alias("jobs"))
    walk = read("blocks").filter("tract % 4 <> 0").select(code.alias("code"), "location_id")
    return profiles.by_code(rows, walk, "code").groupBy("location_id").agg(F.sum("jobs").cast("long").alias("jobs"))


@query("j23_merged_profiles", oracle(["zones", "zone_weather", "zone_numbers"], "SELECT z.location_id, w.rain, n.business_score FROM zones z LEFT JOIN zone_weather w USING (location_id) LEFT JOIN (SELECT * FROM zone_numbers WHERE location_id % 2 = 0) n ON n.location_id = z.location_id"))
def _(read):
    made, _ = profiles.merged(read("zones").select("location_id"), "location_id", read("zone_weather").select("location_id", "rain"), read("zone_numbers").filter("location_id % 2 = 0").select("location_id", "business_score"))
    return made


@query("j23_repeated_keys", oracle(["facilities", "zones"], "SELECT CAST(0 AS INT) AS source, location_id FROM facilities GROUP BY 2 HAVING count(*) > 1"))
def _(read):
    return profiles.merged(read("zones").select("location_id"), "location_id", read("facilities").select("location_id"), read("zone_weather").select("location_id", "rain"))[1]


@query("a21_ratios", oracle(["facilities"], "SELECT location_id, CASE WHEN count(amenity) <> 0 THEN round(count(tourism) / count(amenity), 6) END AS ratio FROM facilities GROUP BY 1"))
def _(read):
    summed = read("facilities").groupBy("location_id").agg(F.count("tourism").alias("a"), F.count("amenity").alias("b"))
    return rounded(summed.select("location_id", zones.safe_ratio(F.col("a"), F.col("b")).alias("ratio")))


#: Rules of zone tags: quantiles of the whole column, least values, one of several, and top categories.
TAGS = {
    "luxury": {"quantiles": {"residential_score": 0.6}, "least": {"income_norm": 0.75}},
    "business": {"quantiles": {"business_score": 0.75}, "any_least": (["income_norm", "jobs_norm"], 0.4), "top": ["business_score"]},
    "tourism": {"quantiles": {"tourism_score": 0.7}, "top": ["tourism_score", "residential_score"]},
}
_SCORES = ["residential_score", "business_score", "tourism_score"]


@query("t4_zone_tags", oracle(["zone_numbers"], """SELECT location_id, coalesce(CASE WHEN best = -1e30 THEN NULL WHEN l = best THEN 'luxury' WHEN b = best THEN 'business' ELSE 'tourism' END, top1) AS tag FROM (SELECT *, greatest(l, b, t) AS best FROM (SELECT location_id, top1,
 CASE WHEN residential_score >= q1 AND coalesce(income_norm, 0) >= 0.75 THEN greatest(residential_score, coalesce(income_norm, -1e29)) ELSE -1e30 END AS l, CASE WHEN business_score >= q2 AND greatest(coalesce(income_norm, 0), jobs_norm) >= 0.4 AND list_contains(top2, 'business_score') THEN business_score ELSE -1e30 END AS b,
 CASE WHEN tourism_score >= q3 AND (list_contains(top2, 'tourism_score') OR list_contains(top2, 'residential_score')) THEN tourism_score ELSE -1e30 END AS t FROM zone_numbers JOIN (SELECT location_id, list_slice(list(name ORDER BY v DESC, name), 1, 2) AS top2, list(name ORDER BY v DESC, name)[1] AS top1 FROM (SELECT location_id, 'residential_score' AS name, residential_score AS v FROM zone_numbers UNION ALL SELECT location_id, 'business_score', business_score FROM zone_numbers UNION ALL SELECT location_id, 'tourism_score', tourism_score FROM zone_numbers WHERE tourism_score IS NOT NULL) GROUP BY 1) USING (location_id)
 CROSS JOIN (SELECT quantile_cont(residential_score, 0.6) AS q1, quantile_cont(business_score, 0.75) AS q2, quantile_cont(tourism_score, 0.7) AS q3 FROM zone_numbers)))"""))  # fmt: skip
def _(read):
    rows = read("zone_numbers").withColumns({c: F.col(c).cast("double") for c in ("income_norm", "jobs_norm")})
    return profiles.tags(rows, TAGS, zones.top_categories(_SCORES), F.get(zones.top_categories(_SCORES, 1), F.lit(0)))


@query("j25_adjacent_zones", oracle(["zones"], "SELECT a.location_id AS a, b.location_id AS b FROM zones a JOIN zones b ON a.location_id < b.location_id AND a.x0 <= b.x0 + b.width AND b.x0 <= a.x0 + a.width AND a.y0 <= b.y0 + b.height AND b.y0 <= a.y0 + a.height"))
def _(read):
    return profiles.adjacent(read("zones"))


@query("j22_area_shares", oracle(["zones", "road_segments"], "SELECT segment_id AS id, location_id, round((least(x1, zx1) - greatest(r.x0, zx0)) * (least(y1, zy1) - greatest(r.y0, zy0)) / ((x1 - r.x0) * (y1 - r.y0)), 6) AS share FROM road_segments r, (SELECT location_id, x0 AS zx0, y0 AS zy0, x0 + width AS zx1, y0 + height AS zy1 FROM zones) z WHERE least(x1, zx1) > greatest(r.x0, zx0) AND least(y1, zy1) > greatest(r.y0, zy0)"))
def _(read):
    boxes = read("zones").select("location_id", "x0", "y0", (F.col("x0") + F.col("width")).alias("x1"), (F.col("y0") + F.col("height")).alias("y1"))
    return rounded(profiles.overlaid(read("road_segments").select(F.col("segment_id").alias("id"), "x0", "y0", "x1", "y1"), boxes))


@query("j20_boroughs", oracle(["zones", "road_segments"], "SELECT borough, count(*) AS segments, min(segment_id) AS first, max(segment_id) AS last FROM (SELECT segment_id, CAST(substr(segment_id, 2) AS INT) % 30 AS location_id FROM road_segments) JOIN zones USING (location_id) WHERE borough <> 'b3' GROUP BY 1"))
def _(read):
    at = read("road_segments").select("segment_id", (F.substring("segment_id", 2, 9).cast("int") % 30).alias("location_id"))
    return profiles.boroughs(at, read("zones"), ["b3"])


def _nodes(read) -> DataFrame:
    """Ends of roads, both of each, in the first zone that covers them."""
    at = lambda node, k: read("road_segments").select(F.col(node).alias("node"), F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"))
    ends = at("from_node", 0).unionByName(at("to_node", 1)).groupBy("node").agg(F.min(F.struct("x", "y")).alias("p"))
    return spatial.in_zones(ends.select("node", "p.x", "p.y"), read("zones")).filter("location_id is not null")


def _centres(read) -> DataFrame:
    return read("zones").select("location_id", (F.col("x0") + F.col("width") / 2).alias("cx"), (F.col("y0") + F.col("height") / 2).alias("cy"))


NODES = """ends AS (SELECT node, min(x) AS x, arg_min(y, (x, y)) AS y FROM (SELECT from_node AS node, x0 AS x, y0 AS y FROM road_segments UNION ALL SELECT to_node, x1, y1 FROM road_segments) GROUP BY 1), nodes AS (SELECT node, e.x, e.y, min(location_id) AS location_id FROM ends e JOIN zones z ON e.x BETWEEN z.x0 AND z.x0 + z.width AND e.y BETWEEN z.y0 AND z.y0 + z.height GROUP BY 1, 2, 3),
 firsts AS (SELECT * FROM (SELECT n.*, row_number() OVER (PARTITION BY location_id ORDER BY round(sqrt(power(n.x - (z.x0 + z.width / 2), 2) + power(n.y - (z.y0 + z.height / 2), 2)), 6), node) AS rn FROM nodes n JOIN zones z USING (location_id)) WHERE rn = 1),
 seconds AS (SELECT * FROM (SELECT n.location_id, n.node, row_number() OVER (PARTITION BY n.location_id ORDER BY round(sqrt(power(n.x - f.x, 2) + power(n.y - f.y, 2)), 6) DESC, n.node DESC) AS rn FROM nodes n JOIN firsts f USING (location_id) WHERE n.node <> f.node) WHERE rn = 1)"""


@query("g3_zone_anchors", oracle(["road_segments", "zones"], "SELECT f.location_id, f.node AS first, s.node AS second FROM firsts f LEFT JOIN seconds s USING (location_id)", NODES))
def _(read):
    return profiles.anchors(_nodes(read), _centres(read))


def _routes(read) -> DataFrame:
    """A route for each pair of zones that trips join, by the shortest paths between the anchors of these pairs."""
    both = profiles.anchors(_nodes(read), _centres(read))
    ends = both.select("location_id", F.explode(F.array_compact(F.array("first", "second"))).alias("node"))
    asked = zones.od_statistics(zones.valid_trips(read("trips"))).select("pickup_zone", "dropoff_zone", (F.col("median_miles") * 1609.344).alias("length"))
    return profiles.chosen_routes(asked, ends, _between(read, asked, ends))


def _between(read, asked: DataFrame, ends: DataFrame) -> DataFrame:
    """Paths from the nodes of a pickup zone to those of the zones that trips join it to."""
    side = lambda zone, node: ends.select(F.col("location_id").alias(zone), F.col("node").alias(node))
    pairs = asked.join(side("pickup_zone", "source"), "pickup_zone").join(side("dropoff_zone", "target"), "dropoff_zone")
    return routing.paths_to(routing.directed_edges(read("road_segments")), pairs.select("source", "target"))


@query("g2_paths_to_targets")
def _(read):
    """From the anchors of each pickup zone to those of the zones that its trips go to."""
    both = profiles.anchors(_nodes(read), _centres(read))
    ends = both.select("location_id", F.explode(F.array_compact(F.array("first", "second"))).alias("node"))
    found = _between(read, zones.od_statistics(zones.valid_trips(read("trips"))), ends)
    return found.select("source", "target", F.round("distance", 6).alias("distance"), "hops", F.array_join(F.transform("segments", lambda s: F.concat(s["segment_id"], F.when(s["reverse"], "-").otherwise("+"))), " ").alias("segments"))


@query("g4_accepted_routes")
def _(read):
    """A route for each trip, accepted as soon as one is within 15 % of the trip's length."""
    trips = zones.valid_trips(read("trips")).select("trip_id", "pickup_zone", "dropoff_zone", (F.col("miles") * 1609.344).alias("length"))
    nodes = _nodes(read).select("location_id", "node")
    return profiles.accepted_routes(trips, nodes, _between(read, trips.select("pickup_zone", "dropoff_zone").distinct(), nodes))


@query("g4_route_templates")
def _(read):
    """The chosen route of each pair of zones with its edges."""
    both = profiles.anchors(_nodes(read), _centres(read))
    ends = both.select("location_id", F.explode(F.array_compact(F.array("first", "second"))).alias("node"))
    asked = zones.od_statistics(zones.valid_trips(read("trips"))).select("pickup_zone", "dropoff_zone", (F.col("median_miles") * 1609.344).alias("length"))
    paths = _between(read, asked, ends)
    chosen = profiles.chosen_routes(asked, ends, paths)
    edges = paths.select(F.col("source").alias("start_node"), F.col("target").alias("end_node"), "segments")
    found = chosen.join(edges, ["start_node", "end_node"], "left")
    return found.select("pickup_zone", "dropoff_zone", "start_node", "end_node", "skip_reason", F.array_join("segments.segment_id", " ").alias("route_segment_ids"), F.array_join(F.transform("segments.reverse", lambda r: r.cast("int").cast("string")), "").alias("route_reverse_flags"))


@query("g4_chosen_routes")
def _(read):
    return _routes(read)


@query("a34_route_summary")
def _(read):
    return profiles.route_summary(_routes(read), zones.valid_trips(read("trips")))


@query("g7_region_points", oracle(["zones"], "SELECT location_id % 6 AS region, round(avg(x0 + width / 2), 6) AS x, round(avg(y0 + height / 2), 6) AS y FROM zones GROUP BY 1"))
def _(read):
    at = _centres(read).withColumn("region", F.col("location_id") % 6)
    return rounded(at.groupBy("region").agg(F.avg("cx").alias("x"), F.avg("cy").alias("y")))


@query("g8_zone_master", oracle(["zones"], "SELECT location_id, borough, round(x0 + width / 2, 6) AS x, round(y0 + height / 2, 6) AS y, round(width * height, 6) AS area FROM zones"))
def _(read):
    master = read("zones").select("location_id", "borough", (F.col("width") * F.col("height")).alias("area")).join(_centres(read).withColumnsRenamed({"cx": "x", "cy": "y"}), "location_id")
    return rounded(master)


@query("t7_newest_build", oracle(["builds"], "SELECT build_id, month FROM builds WHERE month <= 17 ORDER BY month DESC, day DESC, written DESC LIMIT 1"))
def _(read):
    return profiles.newest_build(read("builds"), 17).select("build_id", "month")


@query("t8_capped_list", oracle(["road_segments"], "SELECT segment_id, (SELECT count(*) FROM road_segments) > 15 AS truncated FROM road_segments ORDER BY street, segment_id LIMIT 15"))
def _(read):
    return profiles.capped(read("road_segments").select("segment_id", "street"), 15, [F.asc("street"), F.asc("segment_id")]).select("segment_id", "truncated")


@query("a35_vehicle_shares", oracle(["sensor_events", "shares"], "SELECT vehicle_profile_id, configured, coalesce(round(n / (SELECT count(*) FROM sensor_events), 6), 0) AS observed FROM shares LEFT JOIN (SELECT vehicle_profile_id, count(*) AS n FROM sensor_events GROUP BY 1) USING (vehicle_profile_id)"))
def _(read):
    return rounded(profiles.assigned_shares(read("sensor_events"), read("shares")))


@query("j27_trips_with_routes", oracle(["trips", "zones"], "SELECT state, count(*) AS trips FROM (SELECT CASE WHEN z.location_id IS NULL THEN 'missing' WHEN dropoff_zone % 5 = 0 THEN 'skipped' ELSE 'routed' END AS state FROM trips t LEFT JOIN zones z ON t.dropoff_zone = z.location_id) GROUP BY 1"))
def _(read):
    """A trip of a pair without a template is an error; one whose template was skipped carries the reason."""
    skipped = F.when(F.col("location_id") % 5 == 0, "NO_DIRECTED_ROUTE")
    ends = read("zones").select(F.col("location_id").alias("dropoff_zone"), skipped.alias("skip_reason"))
    pairs = read("trips").select("pickup_zone", "dropoff_zone").distinct().join(ends, "dropoff_zone")
    return profiles.with_templates(read("trips"), pairs).groupBy("state").agg(F.count("*").alias("trips"))


@query("m28_trip_ids", oracle(["trips"], "SELECT trip_id, substr(sha256(concat_ws('|', request_us, pickup_zone, dropoff_zone)), 1, 24) AS stable_id FROM trips"))
def _(read):
    return read("trips").select("trip_id", F.substring(F.sha2(F.concat_ws("|", "request_us", "pickup_zone", "dropoff_zone"), 256), 1, 24).alias("stable_id"))


@query("m29_kept_shares", oracle(["trips"], "SELECT trip_id, (('0x' || substr(sha256('s' || trip_id), 1, 13))::BIGINT) / 4503599627370496.0 < 0.25 AS kept FROM trips"))
def _(read):
    return read("trips").select("trip_id", (zones.stable_share(F.col("trip_id").cast("string"), "s") < 0.25).alias("kept"))


@query("a29_output_counts", oracle(["zones", "trips"], "SELECT 'trips' AS name, count(*) AS rows FROM trips UNION ALL SELECT 'zones', count(*) FROM zones"))
def _(read):
    return audits.output_counts({"zones": read("zones"), "trips": read("trips")})


@query("m18_lenient_values", oracle(["road_features"], "SELECT object_id, TRY_CAST(replace(nullif(trim(length_ft), ''), ',', '') AS DOUBLE) AS feet, CASE WHEN built = 'unknown' THEN NULL ELSE DATE '2024-03-15' END AS built FROM road_features"))
def _(read):
    return read("road_features").select("object_id", roads.number(F.col("length_ft")).alias("feet"), roads.source_date(F.col("built")).alias("built"))


@query("m19_first_property", oracle(["road_features"], "SELECT object_id, CASE WHEN object_id % 3 = 2 THEN NULL ELSE street END AS street FROM road_features"))
def _(read):
    """Of OnStreetName and street, in any case of letters, the first that is there."""
    name = F.when(F.col("object_id") % 3 == 0, F.create_map(F.lit("ONSTREETNAME"), "street")).when(F.col("object_id") % 3 == 1, F.create_map(F.lit("Street"), "street")).otherwise(F.create_map(F.lit("other"), "street"))
    return read("road_features").select("object_id", roads.first_property(name, "onstreetname", "street").alias("street"))


_SINE = "sqrt(2 * f - f * f) * sin(radians({a}))"
_M = f"cos(radians({{a}})) / sqrt(1 - power({_SINE}, 2))"
_T0 = f"tan(pi() / 4 - radians({{a}}) / 2) / power((1 - {_SINE}) / (1 + {_SINE}), sqrt(2 * f - f * f) / 2)"
_PLANE = [
    "globe AS (SELECT CAST(6378137 AS DOUBLE) AS axis, 1 / CAST(298.257222101 AS DOUBLE) AS f, CAST(40 AS DOUBLE) + CAST(40 AS DOUBLE) / 60 AS lat1, CAST(41 AS DOUBLE) + CAST(2 AS DOUBLE) / 60 AS lat2, CAST(40 AS DOUBLE) + CAST(10 AS DOUBLE) / 60 AS lat0)",
    f"cone AS (SELECT *, (ln({_M.format(a='lat1')}) - ln({_M.format(a='lat2')})) / (ln({_T0.format(a='lat1')}) - ln({_T0.format(a='lat2')})) AS n FROM globe)",
    f"scaled AS (SELECT *, axis * ({_M.format(a='lat1')}) / (n * power({_T0.format(a='lat1')}, n)) AS scale FROM cone)",
    "spots AS (SELECT shape_id, CAST(-74 AS DOUBLE) + x0 / 4000 - 0.2 AS lon, CAST(40 AS DOUBLE) + y0 / 2000 + 0.4 AS lat FROM road_shapes)",
    f"polar AS (SELECT shape_id, n * radians(lon + 74) AS turn, scale * power({_T0.format(a='lat')}, n) AS radius, scale * power({_T0.format(a='lat0')}, n) AS far FROM spots, scaled)",
]


@query("m6_projection", oracle(["road_shapes"], "SELECT shape_id, round(300000 + radius * sin(turn), 3) AS east, round(far - radius * cos(turn), 3) AS north FROM polar", *_PLANE))
def _(read):
    """Degrees to metres of the state plane."""
    x, y = roads.projected(F.lit(-74.0) + F.col("x0") / 4000 - 0.2, F.lit(40.0) + F.col("y0") / 2000 + 0.4)
    return read("road_shapes").select("shape_id", F.round(x, 3).alias("east"), F.round(y, 3).alias("north"))
