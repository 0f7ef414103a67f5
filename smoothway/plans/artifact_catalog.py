"""Queries on artifacts, file formats, records with a time of their own, stream progress and output rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smoothway.operators import audits, polygons, roads, serving, zones
from smoothway.plans.adapters import BASE_US, HOUR_US, oracle
from smoothway.plans.geometry_catalog import PARTS, bent, corners
from smoothway.plans.registry import query, rounded
from smoothway.sources import artifacts, publish, scans, shapefile
from smoothway.sources.scratch import fresh_path
from smoothway.streaming import progress, raw

# --- artifacts -------------------------------------------------------------------------------------


def _wkt(line: str):
    return F.concat(F.lit("LINESTRING ("), F.array_join(F.transform(line, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "), F.lit(")"))


def _runtime(read) -> DataFrame:
    """Runtime rows, of which every seventh has a line that isn't one and every eleventh a hump beyond the road's end."""
    number = F.substring("segment_id", 2, 9).cast("int")
    broken = F.when(number % 14 == 7, F.lit("LINESTRING (1 2, x 3)")).when(number % 14 == 0, F.lit("POINT (1 2)")).otherwise(_wkt("line"))
    humps = F.when(number % 11 == 0, "[0.5, 1.5]").when(number % 4 == 0, "[]").otherwise("[0.25, 7.5e-1]")
    return bent(read).select("segment_id", "traffic_direction", broken.alias("geometry_wkt"), humps.alias("hump_fractions_json"), F.lit("2026-01-05").alias("road_snapshot_date"))


@query("s7_segment_universe", oracle(["bent_roads"], "SELECT DISTINCT segment_id FROM bent_roads"))
def _(read):
    """Two builds are published; the pointer leads to the second, which has all segments."""
    rows = read("bent_roads").select("segment_id", "n_points")
    root = fresh_path(rows.sparkSession, "environment")
    artifacts.publish_artifacts(root, {artifacts.ROLE: rows.limit(1)}, "2026-01-04")
    artifacts.publish_artifacts(root, {artifacts.ROLE: rows, "other": rows.limit(2)}, "2026-01-05")
    return artifacts.segment_universe(rows.sparkSession, root)


_OK = "CAST(substr(segment_id, 2) AS INT) % 7 <> 0 AND CAST(substr(segment_id, 2) AS INT) % 11 <> 0"


@query("s21_runtime_environment", oracle(["bent_roads"], f"""SELECT segment_id, n_points AS points, round(sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) + CASE WHEN n_points > 2 THEN sqrt(power(x2 - x1, 2) + power(y2 - y1, 2)) ELSE 0 END + CASE WHEN n_points > 3 THEN sqrt(power(x3 - x2, 2) + power(y3 - y2, 2)) ELSE 0 END, 6) AS length_m,
 CASE WHEN CAST(substr(segment_id, 2) AS INT) % 4 = 0 THEN CAST(0 AS DOUBLE) ELSE 1 END AS humps FROM bent_roads WHERE {_OK}"""))  # fmt: skip
def _(read):
    rows = _runtime(read)
    root = fresh_path(rows.sparkSession, "environment")
    artifacts.publish_artifacts(root, {"road_environment": rows}, "2026-01-05")
    found = artifacts.runtime_roads(artifacts.read_artifact(rows.sparkSession, root, "road_environment"))
    humps = F.aggregate("hump_fractions", F.lit(0.0), lambda a, v: a + v)
    return found.select("segment_id", F.size("line").alias("points"), F.round(roads.line_length(F.col("line")), 6).alias("length_m"), humps.alias("humps"))


@query("s21_runtime_violations", oracle(["bent_roads"], "SELECT CAST(0 AS BIGINT) AS empty, CAST(1 AS BIGINT) AS further_dates, count(*) FILTER (CAST(substr(segment_id, 2) AS INT) % 7 = 0) AS broken_lines, count(*) FILTER (CAST(substr(segment_id, 2) AS INT) % 11 = 0) AS broken_humps, count(*) - count(DISTINCT segment_id) AS repeated_ids FROM (SELECT segment_id FROM bent_roads UNION ALL SELECT segment_id FROM bent_roads WHERE n_points = 4)"))
def _(read):
    """Some roads come again, with another snapshot date."""
    rows = _runtime(read)
    four = bent(read).filter(F.size("line") == 4).select("segment_id")
    again = rows.join(four, "segment_id").withColumn("road_snapshot_date", F.lit("2026-01-06"))
    return artifacts.runtime_violations(rows.unionByName(again))


@query("s19_region_map", oracle(["zones"], "SELECT location_id, location_id % 6 AS region FROM zones"))
def _(read):
    """Two columns of a wide table, through its manifest."""
    rows = read("zones").withColumn("region", F.col("location_id") % 6)
    root = fresh_path(rows.sparkSession, "regions")
    artifacts.publish_artifacts(root, {"zone_region_map": rows}, "2026-01-05")
    return artifacts.read_artifact(rows.sparkSession, root, "zone_region_map", ["location_id", "region"])


# --- file formats ----------------------------------------------------------------------------------


@query("k14_feature_collection", oracle(["bent_roads"], "SELECT segment_id, n_points AS points, round(x0, 6) AS x FROM bent_roads"))
def _(read):
    """One gzipped collection, read as one."""
    rows = bent(read)
    path = fresh_path(rows.sparkSession, "collection") + ".json.gz"
    lines = rows.select("segment_id", F.col("line")).select("segment_id", "line")
    made = scans.feature_lines(lines, "line", ["segment_id"])
    keyed = made.withColumn("key", F.get_json_object("value", "$.properties.segment_id"))
    scans.write_collection(keyed, path, ["key"])
    found = scans.features(rows.sparkSession, path)
    line = scans.line(F.col("coordinates"))
    return found.select(F.try_element_at("properties", F.lit("segment_id")).alias("segment_id"), F.size(line).alias("points"), F.element_at(line, 1)["x"].alias("x"))


_PRJ = 'PROJCS["NAD_1983_StatePlane_New_York_Long_Island_FIPS_3104_Feet",GEOGCS["GCS",UNIT["Degree",0.0174532925199433]],PROJECTION["Lambert_Conformal_Conic"],UNIT["Foot_US",0.3048006096012192]]'


@query("s10_zipped_zones", oracle(["zones"], "SELECT location_id, 2 AS rings, round(whole * power(0.3048006096012192, 2), 4) AS area FROM sizes", PARTS))
def _(read):
    """Zones go out as a zipped shapefile in feet, each with a second ring, and come back in metres."""
    rows = corners(read).orderBy("location_id").select("location_id", "ring").limit(shapefile.MOST_PACKED).collect()
    spark = read("zones").sparkSession
    path = fresh_path(spark, "zones") + ".zip"
    made = [({"OBJECTID": str(k), "LocationID": str(r["location_id"])}, [[(p["x"], p["y"]) for p in r["ring"]], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]]) for k, r in enumerate(rows)]
    publish.put_bytes(spark, path, shapefile.packed(made, _PRJ))
    found = shapefile.taxi_zones(spark, path)
    return found.select("location_id", F.size("rings").alias("rings"), F.round(F.abs(polygons.signed_area(F.col("rings")[0])), 4).alias("area"))


@query("s13_json", oracle(["facilities"], "SELECT location_id, count(*) AS n, count(kind) AS kinds FROM facilities GROUP BY 1"))
def _(read):
    rows = read("facilities").select("facility_id", "location_id", "kind")
    path = fresh_path(rows.sparkSession, "json")
    rows.write.json(path)
    found = rows.sparkSession.read.schema("facility_id string, location_id int, kind string").json(path)
    return found.groupBy("location_id").agg(F.count("*").alias("n"), F.count("kind").alias("kinds"))


# --- records with a time of their own --------------------------------------------------------------

_MINUTE = "CASE WHEN event_id % 5 = 0 THEN arrived_min ELSE minute END"


def _timed(read) -> DataFrame:
    return read("timed_records").select("event_id", "value", F.timestamp_micros(F.lit(BASE_US) + F.col("arrived_min").cast("long") * 60_000_000).alias("timestamp"))


@query("f1_event_window", oracle(["timed_records"], f"SELECT event_id FROM timed_records WHERE {_MINUTE} >= 30 AND {_MINUTE} < 90"))
def _(read):
    """Most records have a time of their own, some an unreadable one, some no JSON."""
    return raw.in_window(_timed(read), BASE_US + 1_800_000_000, BASE_US + 5_400_000_000).select("event_id")


@query("r2_event_hours", oracle(["timed_records"], f"SELECT {_MINUTE} // 60 AS hour, count(*) AS rows, count(*) FILTER (arrived_min // 60 > {_MINUTE} // 60) AS late FROM timed_records GROUP BY 1"))
def _(read):
    """The stream puts records in the hour of their event, late ones too (R7), whatever hour they came in."""
    rows = _timed(read).drop("event_id")
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "timed")
    rows.repartition(3).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    raw.into_hours(stream, f"{path}/out", f"{path}/state", files=2).awaitTermination()
    found = spark.read.parquet(f"{path}/out")
    arrived = F.floor((F.unix_micros("timestamp") - BASE_US) / HOUR_US)
    hour = F.col("hour").cast("long")
    return found.groupBy(hour.alias("hour")).agg(F.count("*").alias("rows"), F.count_if(arrived > hour).alias("late"))


@query("r4_progress_rows", oracle(["timed_records"], f"SELECT CAST(3 AS BIGINT) AS batches, count(*) AS rows, CAST(10000 - 60 * max(arrived_min) AS DOUBLE) AS least_lag, CAST(1 AS BIGINT) AS started, CAST(1 AS BIGINT) AS ended FROM timed_records"))
def _(read):
    """Three batches of one file each, and what a listener wrote of them."""
    rows = _timed(read).drop("event_id")
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "progress")
    rows.repartition(3).write.parquet(f"{path}/in")
    listener = progress.ProgressTable(spark, f"{path}/figures", clock=lambda: BASE_US / 1e6 + 10_000)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        run = raw.observed(stream, "timestamp").writeStream.format("noop").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
        run.awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    found = listener.flush().filter(F.col("query") == str(run.id))
    return found.agg(F.count_if(F.col("rows") > 0).alias("batches"), F.sum("rows").alias("rows"), F.round(F.min("event_lag_s"), 3).alias("least_lag"), F.count_if(F.col("state") == "started").alias("started"), F.count_if(F.col("state") == "ended").alias("ended"))


@query("k11_json_lines", oracle(["timed_records"], "SELECT value, arrived_min FROM timed_records"))
def _(read):
    """Three batches are published as lines; a second run publishes nothing anew."""
    rows = _timed(read).select("value", F.lit(None).cast("string").alias("none"), "timestamp")
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "lines")
    rows.repartition(3).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    for _ in range(2):
        raw.into_lines(stream, f"{path}/out", f"{path}/state").awaitTermination()
    found = spark.read.schema("value string, none string, timestamp timestamp").json(f"{path}/out")
    return found.select("value", ((F.unix_micros("timestamp") - BASE_US) / 60_000_000).cast("int").alias("arrived_min"))


# --- rules of outputs ------------------------------------------------------------------------------


@query("f30_score_output", oracle(["zone_numbers"], "SELECT count(*) FILTER (n > 1) AS repeated, CAST(sum(a) AS BIGINT) AS residential_score, CAST(sum(b) AS BIGINT) AS tourism_score FROM (SELECT location_id % 24, count(*) AS n, count(*) FILTER (residential_score > 90) AS a, count(*) FILTER (tourism_score > 90 OR tourism_score < 9) AS b FROM zone_numbers GROUP BY 1)"))
def _(read):
    """Scores of which some are made too great or less than 0, and two zones one."""
    rows = read("zone_numbers").select((F.col("location_id") % 24).alias("location_id"), (F.col("residential_score") / 90).alias("residential_score"), ((F.col("tourism_score") - 9) / 81).alias("tourism_score"))
    return audits.score_output(rows, ["residential_score", "tourism_score"])


@query("f30_profile_output", oracle(["zone_numbers"], """SELECT CAST((SELECT count(*) FROM zone_numbers WHERE location_id % 12 = 5) AS BIGINT) AS null_zones, CAST(1 AS BIGINT) AS repeated, CAST(1 AS BIGINT) AS unknown, CAST((SELECT count(*) FROM zone_numbers WHERE location_id % 12 = 5 OR location_id = 0) AS BIGINT) AS missing,
 CAST((SELECT count(*) FROM zone_numbers WHERE residential_score < 20) AS BIGINT) AS below_zero, CAST((SELECT count(*) FROM zone_numbers WHERE income_norm > 0.8) AS BIGINT) AS warned_ratios"""))  # fmt: skip
def _(read):
    """Some zones are null, zone 0 comes as the unknown 900, zone 1 comes twice."""
    rows = read("zone_numbers").withColumn("location_id", F.when(F.col("location_id") % 12 == 5, None).when(F.col("location_id") == 0, 900).otherwise(F.col("location_id")))
    made = rows.select("location_id", (F.col("residential_score") - 20).alias("jobs_count"), (F.col("income_norm") / 0.8).alias("income_ratio"))
    twice = made.filter("location_id = 1").withColumns({"jobs_count": F.lit(1.0), "income_ratio": F.lit(0.5)})
    return audits.profile_output(made.unionByName(twice), read("zones"))


@query("f30_region_output", oracle(["zones"], "SELECT CAST(1 AS BIGINT) AS mapped_twice, CAST(1 AS BIGINT) AS unmapped, CAST(1 AS BIGINT) AS unknown_zones, CAST(0 AS BIGINT) AS wrong_number, CAST(0 AS BIGINT) AS odd_ids, CAST(1 AS BIGINT) AS no_zones, CAST(1 AS BIGINT) AS no_shape, CAST(count(DISTINCT location_id % 5) FILTER (location_id % 5 = 2) AS BIGINT) AS points_outside, CAST(0 AS BIGINT) AS repeated_ids FROM zones"))
def _(read):
    """Six regions of zones by their number: the sixth has neither zones nor a shape, the third has its point far
    off; zone 3 is mapped twice, zone 7 not at all, and zone 77 isn't one."""
    of = read("zones").select("location_id", (F.col("location_id") % 5 + 1).alias("region"))
    x, y = polygons.inner_point(F.col("ring"))
    points = polygons.region_points(corners(read).select("location_id", "ring", x.alias("x"), y.alias("y")), of)
    rings = corners(read).join(of, "location_id").groupBy("region").agg(F.collect_list("ring").alias("rings"))
    made = points.join(rings, "region").select("region", "rings", F.when(F.col("region") == 3, -1e6).otherwise(F.col("x")).alias("x"), "y")
    spark = made.sparkSession
    sixth = made.limit(1).select(F.lit(6).alias("region"), F.array().cast(made.schema["rings"].dataType).alias("rings"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    mapping = of.filter("location_id <> 7").unionByName(of.filter("location_id = 3")).unionByName(spark.createDataFrame([(77, 1)], "location_id int, region int"))
    return audits.region_output(made.unionByName(sixth), mapping, read("zones"), 6)


@query("f30_master_output", oracle(["zones"], "SELECT count(*) FILTER (location_id % 10 = 1) AS null_zones, count(*) FILTER (location_id % 10 = 2) - 1 AS no_shape, count(*) FILTER (location_id % 10 = 2) AS odd_points, count(*) FILTER (location_id % 10 = 3) AS outside, CAST(1 AS BIGINT) AS repeated FROM zones"))
def _(read):
    """Some ids are null, some shapes missing (zone 2's may be), some points far off, and zone 4 comes twice."""
    each = lambda n: F.col("location_id") % 10 == n
    rows = polygons.zone_master(corners(read))
    made = rows.select(F.when(each(1), None).otherwise(F.col("location_id")).alias("location_id"), F.when(~each(2), F.col("ring")).alias("ring"), F.when(each(3), -9.0).otherwise(F.col("x")).alias("x"), "y")
    return audits.master_output(made.unionByName(made.filter("location_id = 4")), [2])


# --- small rules -----------------------------------------------------------------------------------


@query("m28_stable_trip_ids", oracle(["trips"], "SELECT trip_id, substr(sha256(concat_ws('|', 'v1', trip_id, strftime(make_timestamp(request_us), '%Y-%m-%dT%H:%M:%S'), strftime(make_timestamp(pickup_us), '%Y-%m-%dT%H:%M:%S'), strftime(make_timestamp(dropoff_us), '%Y-%m-%dT%H:%M:%S'), pickup_zone, dropoff_zone, format('{:.17g}', miles / 7))), 1, 24) AS stable_id FROM trips WHERE miles IS NOT NULL"))
def _(read):
    """Lengths whose 17 digits aren't the shortest ones."""
    rows = read("trips").filter("miles is not null").withColumn("miles", F.col("miles") / 7)
    rows = rows.withColumns({c: F.timestamp_micros(f"{c}_us") for c in ("request", "pickup", "dropoff")})
    return rows.select("trip_id", zones.stable_trip_id("v1", "trip_id", ["request", "pickup", "dropoff"], ["pickup_zone", "dropoff_zone"], "miles").alias("stable_id"))


@query("m37_run_ids", oracle(["hourly_scores"], "SELECT scoring_version, scoring_version <> '1.2.0' AS sound, count(*) AS rows FROM hourly_scores GROUP BY 1, 2"))
def _(read):
    run = F.concat(F.lit("run-7:a+b_"), F.col("scoring_version"), F.when(F.col("scoring_version") == "1.2.0", "/..").otherwise(""))
    return read("hourly_scores").groupBy("scoring_version", serving.is_run_id(run).alias("sound")).agg(F.count("*").alias("rows"))


@query("u3_hours_together", oracle(["hour_events"], f"SELECT (event_us - {BASE_US}) // {HOUR_US} AS hour, count(*) AS rows FROM hour_events WHERE (event_us - {BASE_US}) // {HOUR_US} IN (0, 2, 3) GROUP BY 1"))
def _(read):
    """Frames of several hours, one with its columns in another order and one more of them, make one."""
    rows = read("hour_events").withColumn("hour", F.floor((F.col("event_us") - BASE_US) / HOUR_US))
    frames = [rows.filter("hour = 0").select("hour", "speed_mps", "event_us", "event_id"), rows.filter("hour = 2").withColumn("note", F.lit("late")), rows.filter("hour = 3")]
    return scans.together(frames).groupBy("hour").agg(F.count("*").alias("rows"))


# --- guards: the other answer ----------------------------------------------------------------------


@query("f20_fresh_table", oracle(["sensor_events"], "SELECT CAST(3600 AS DOUBLE) AS age_seconds, CAST(0 AS BIGINT) AS orphan_profiles, count(*) > 0 AS passed FROM sensor_events"))
def _(read):
    """An hour after the newest event, with all profiles known."""
    rows = read("sensor_events")
    now = rows.agg(F.max("event_us")).first()[0] + HOUR_US
    return rounded(audits.freshness_and_orphans(rows, rows.select("vehicle_profile_id"), now, "event_us"))


@query("f23_no_environment", oracle(["pavement"], "SELECT CAST(count(*) = 0 AS BIGINT) AS empty, CAST(0 AS BIGINT) AS repeated_ids, CAST(0 AS BIGINT) AS ratings_out_of_range FROM pavement WHERE rating > 90"))
def _(read):
    return audits.environment_guard(read("pavement").filter("rating > 90"), "street", "rating")


@query("f24_no_reference", oracle(["road_features"], "SELECT CAST(count(*) = 0 AS BIGINT) AS empty, CAST(0 AS BIGINT) AS further_dates, count(*) AS no_id, count(*) AS no_shape FROM road_features WHERE object_id < 0"))
def _(read):
    return audits.reference_guard(read("road_features").filter("object_id < 0"), "segment_id", "built", "length_ft")


@query("f27_sound_partition", oracle(["hourly_scores"], "SELECT count(*) AS rows, count(*) FILTER (NOT vertical_score <= 100) AS vertical, count(*) FILTER (NOT vertical_score <= 100) = 0 AND count(*) > 0 AS passed FROM hourly_scores WHERE vehicle_profile_id = 3"))
def _(read):
    return audits.gate(read("hourly_scores").filter("vehicle_profile_id = 3"), {"vertical": F.col("vertical_score") <= 100})


@query("f28_broken_snapshot", oracle(["road_segments"], "SELECT count(*) AS rows, count(*) FILTER (traffic_direction = 'T') AS direction, count(*) FILTER (traffic_direction = 'T') = 0 AS passed FROM road_segments"))
def _(read):
    """Two-way roads come with a direction that there isn't."""
    way = F.nullif("traffic_direction", F.lit("T"))
    return audits.gate(read("road_segments").select(way.alias("traffic_direction")), {"direction": F.col("traffic_direction").isin("W", "A", "T")})


_FOOT = "greatest(0, least(1, ((hx - x0) * (x1 - x0) + (hy - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))))"
_DEGREES = f"""near AS (SELECT hump_id, humps, segment_id, round(sqrt(power(hx - (x0 + t * (x1 - x0)), 2) + power(hy - (y0 + t * (y1 - y0)), 2)) / 100000, 10) AS far FROM (SELECT *, {_FOOT} AS t FROM (SELECT h.hump_id, h.humps, h.x AS hx, h.y AS hy, r.segment_id, r.x0, r.y0, r.x1, r.y1
 FROM humps h JOIN road_segments r ON regexp_replace(upper(r.street), '[^A-Z0-9]', '', 'g') = regexp_replace(upper(h.street), '[^A-Z0-9]', '', 'g')))),
 nearest AS (SELECT hump_id, humps, segment_id FROM (SELECT *, row_number() OVER (PARTITION BY hump_id ORDER BY far, segment_id) AS rn FROM near WHERE far <= {{radius}}) WHERE rn = 1)"""


@query("j32_degree_humps", oracle(["humps", "road_segments"], "SELECT r.segment_id, CAST(coalesce(sum(humps), 0) AS INT) AS hump_count FROM road_segments r LEFT JOIN nearest n USING (segment_id) GROUP BY 1", _DEGREES.format(radius=0.00035)))
def _(read):
    """All humps, whenever installed, by degrees."""
    degrees = lambda df, *names: df.withColumns({c: F.col(c) / 100_000 for c in names})
    humps = degrees(read("humps"), "x", "y").withColumn("installed", F.lit(None).cast("int"))
    found = roads.speed_humps(degrees(read("road_segments"), "x0", "y0", "x1", "y1"), humps, 0, 0.00035, size=0.0005, places=10)
    return found.select("segment_id", "hump_count")
