"""Queries that write tables and read them again: partitions, snapshots, compaction, streams, readers."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smoothway.operators import audits
from smoothway.plans.adapters import BASE_US, HOUR_US, oracle
from smoothway.plans.registry import query
from smoothway.sources import partitions, publish, scans
from smoothway.sources.scratch import fresh_path
from smoothway.streaming import raw

EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_us", T.LongType()), T.StructField("speed_mps", T.DoubleType())])
#: Hours of the events since the first, as the SQL has it; 2026-01-05 00:00 is a fixed value.
SINCE = f"((event_us - {BASE_US}) // {HOUR_US})"
FROM_US, TO_US = BASE_US + HOUR_US // 2, BASE_US + HOUR_US + HOUR_US // 4


def _events(read) -> DataFrame:
    return partitions.with_hours(read("hour_events").select("event_id", "event_us", "speed_mps").withColumn("_at", F.timestamp_micros("event_us")), "_at").drop("_at")


def _table(read) -> tuple[DataFrame, str]:
    """Events as a table cut by hour, in two files or more an hour."""
    rows = _events(read)
    path = fresh_path(rows.sparkSession, "events")
    rows.repartition(3).write.partitionBy(partitions.DATE, partitions.HOUR).parquet(path)
    return rows, path


def _text(us: int) -> str:
    return datetime.fromtimestamp(us / 1e6, UTC).strftime("%Y-%m-%d %H:%M:%S")


@query("s3_hour_partition", oracle(["hour_events"], f"SELECT count(*) AS rows, count(*) FILTER ({SINCE} = 0) AS first_hour, CAST(0 AS BIGINT) AS absent FROM hour_events"))
def _(read):
    rows, path = _table(read)
    spark = rows.sparkSession
    count = lambda df, n: df.agg(F.count("*").alias(n))
    first, absent = scans.hour(spark, path, EVENT, "2026-01-05", "00"), scans.hour(spark, path + "-none", EVENT, "2026-01-05", "00")
    return count(rows, "rows").crossJoin(count(first, "first_hour")).crossJoin(count(absent, "absent"))


@query("s6_pruned_window", oracle(["hour_events"], f"SELECT event_id FROM hour_events WHERE event_us >= {FROM_US} AND event_us < {TO_US}"))
def _(read):
    rows, path = _table(read)
    return scans.window(rows.sparkSession, path, EVENT, F.timestamp_micros("event_us"), _text(FROM_US), _text(TO_US)).select("event_id")


@query("k2_replace_partition", oracle(["hour_events"], f"SELECT event_id, CASE WHEN {SINCE} = 0 THEN speed_mps + 100 ELSE speed_mps END AS speed_mps FROM hour_events WHERE {SINCE} <> 0 OR event_id % 3 <> 0"))
def _(read):
    """The first hour is replaced by other rows; others stay."""
    rows, path = _table(read)
    hour = partitions.with_hours(rows.filter((F.col("event_us") < BASE_US + HOUR_US) & (F.col("event_id") % 3 != 0)).withColumn("speed_mps", F.col("speed_mps") + 100).withColumn("_at", F.timestamp_micros("event_us")), "_at").drop("_at")
    publish.replace_partitions(hour, path, may_be_empty=False)
    return partitions.read_hours(rows.sparkSession, path, EVENT, "2026-01-01 00", "2027-01-01 00").select("event_id", "speed_mps")


@query("k3_empty_partition", oracle(["hour_events"], f"SELECT count(*) AS rows FROM hour_events WHERE {SINCE} <> 0"))
def _(read):
    """An empty result deletes the hour that it stands for."""
    rows, path = _table(read)
    publish.replace_partitions(rows.filter("false"), path, only=[{partitions.DATE: "2026-01-05", partitions.HOUR: "00"}])
    return partitions.read_hours(rows.sparkSession, path, EVENT, "2026-01-01 00", "2027-01-01 00").agg(F.count("*").alias("rows"))


@query("k4_snapshot", oracle(["road_segments"], "SELECT segment_id, x0 + 1 AS x0 FROM road_segments"))
def _(read):
    """Two versions are written; the pointer says the second."""
    roads = read("road_segments").select("segment_id", "x0")
    root = fresh_path(roads.sparkSession, "snapshots")
    publish.write_snapshot(roads, root, as_of="2026-01-05")
    publish.write_snapshot(roads.withColumn("x0", F.col("x0") + 1), root, as_of="2026-01-06")
    return publish.active_snapshot(roads.sparkSession, root).select("segment_id", "x0")


@query("s24_manifest", oracle(["road_segments"], "SELECT count(*) AS rows, '2026-01-06' AS as_of FROM road_segments"))
def _(read):
    roads = read("road_segments").select("segment_id", "x0")
    root = fresh_path(roads.sparkSession, "snapshots")
    publish.write_snapshot(roads, root, as_of="2026-01-06")
    found = publish.active_manifest(roads.sparkSession, root)
    return roads.sparkSession.createDataFrame([(found["rows"], found["as_of"])], "rows long, as_of string")


@query("k12_compaction", oracle(["hour_events"], f"SELECT {SINCE} AS hour, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids, CAST(1 AS BIGINT) AS files FROM hour_events GROUP BY 1"))
def _(read):
    rows, path = _table(read)
    spark = rows.sparkSession
    publish.compact(spark, path)
    found = spark.read.parquet(path)
    hour = F.floor((F.col("event_us") - BASE_US) / HOUR_US)
    return found.groupBy(hour.alias("hour")).agg(F.count("*").alias("rows"), F.sum("event_id").alias("ids"), F.count_distinct("_metadata.file_path").alias("files"))


@query("s22_file_statistics", oracle(["hour_events"], f"SELECT {SINCE} AS hour, CAST(3 AS BIGINT) AS files, true AS sound FROM hour_events GROUP BY 1 HAVING count(*) >= 100"))
def _(read):
    """Hours of a hundred rows or more are in all three files."""
    rows, path = _table(read)
    table = rows.sparkSession.read.parquet(path)
    hour = F.floor((F.col("event_us") - BASE_US) / HOUR_US)
    many = table.groupBy(partitions.DATE, partitions.HOUR).agg(F.count("*").alias("rows"), F.min(hour).alias("at")).filter("rows >= 100")
    told = publish.file_statistics(table, partitions.DATE, partitions.HOUR).join(many, [partitions.DATE, partitions.HOUR])
    sound = (F.col("bytes") >= F.col("files") * F.col("least_bytes")) & (F.col("most_bytes") >= F.col("mean_bytes")) & (F.col("least_bytes") > 0)
    return told.select(F.col("at").alias("hour"), "files", sound.alias("sound"))


@query("k10_sorted_files", oracle(["trips"], "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS overlapping FROM trips"))
def _(read):
    """Files are ordered among themselves: the least of each isn't below the greatest of the one before."""
    trips = read("trips").select("trip_id", "request_us")
    path = fresh_path(trips.sparkSession, "sorted")
    publish.write_sorted(trips, path, ["request_us", "trip_id"], 400)
    files = trips.sparkSession.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("request_us").alias("lo"), F.max("request_us").alias("hi"), F.count("*").alias("n"))
    before = F.max("hi").over(Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))  # a row for each file
    return files.withColumn("_b", before).agg(F.sum("n").alias("rows"), F.count_if(F.col("lo") < F.col("_b")).alias("overlapping"))


@query("s11_numbered_trips", oracle(["trips"], "SELECT trip_id, trip_id AS twin FROM trips"))
def _(read):
    """A file and a place in it name one row, on every reading."""
    trips = read("trips").select("trip_id")
    path = fresh_path(trips.sparkSession, "numbered")
    trips.write.parquet(path)
    once, again = (scans.numbered_rows(trips.sparkSession, path) for _ in range(2))
    return once.join(again.withColumnRenamed("trip_id", "twin"), ["file", "file_row"]).select("trip_id", "twin")


START, CYCLE = BASE_US + 40 * HOUR_US, 24 * HOUR_US


@query("s12_rotated_trips", oracle(["trips"], f"SELECT trip_id, request_us < {START} AS wrapped, CASE WHEN request_us < {START} THEN request_us + {CYCLE} ELSE request_us END AS request_us FROM trips"))
def _(read):
    return scans.rotated(read("trips"), "request_us", START, CYCLE, ["request_us", "pickup_us", "dropoff_us"]).select("trip_id", "wrapped", "request_us")


@query("m34_weekday_anchor", oracle(["trips"], """SELECT trip_id, CASE WHEN len(same) > 0 THEN same[least((day(wall) - 1) // 7, len(same) - 1) + 1] END AS anchor FROM (SELECT *, [d FOR d IN days IF dayofweek(d) = dayofweek(wall)] AS same FROM
 (SELECT trip_id, DATE '2026-01-01' + CAST(trip_id % 400 AS INT) AS wall, [DATE '2026-03-04' + CAST(k AS INT) FOR k IN range(CASE WHEN trip_id % 9 = 0 THEN 4 ELSE 31 END)] AS days FROM trips))"""))
def _(read):
    """Days that stand for a wall day, in a cycle of 31 days and in one of 4, which lacks some weekdays."""
    wall = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("trip_id") % 400).cast("int"))
    first = F.lit("2026-03-04").cast("date")
    last = F.date_add(first, F.when(F.col("trip_id") % 9 == 0, 3).otherwise(30))
    return read("trips").select("trip_id", scans.weekday_anchor(wall, first, last).alias("anchor"))


@query("s9_geojson_round_trip", oracle(["road_shapes"], "SELECT shape_id, CAST(3 AS INT) AS points, round(x0, 6) AS x, round(y2, 6) AS y FROM road_shapes"))
def _(read):
    """Lines go out as features, a line each, and come back by the collection reader and the line reader."""
    p = lambda k: F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"))
    shapes = read("road_shapes").select("shape_id", F.array(p(0), p(1), p(2)).alias("line"))
    spark = shapes.sparkSession
    path = fresh_path(spark, "geojson")
    scans.write_features(scans.feature_lines(shapes, "line", ["shape_id"]), path + "-lines")
    each = spark.read.text(path + "-lines")
    whole = each.withColumn("value", F.concat(F.lit('{"type": "FeatureCollection", "features": ['), "value", F.lit("]}")))
    whole.write.text(path)
    found = scans.features(spark, path, lines=True)
    line = scans.line(F.col("coordinates"))
    return found.select(F.try_element_at("properties", F.lit("shape_id")).alias("shape_id"), line.alias("line")).select("shape_id", F.size("line").alias("points"), F.element_at("line", 1)["x"].alias("x"), F.element_at("line", -1)["y"].alias("y"))


@query("s13_csv", oracle(["facilities"], "SELECT location_id, count(*) AS n, count(kind) AS kinds FROM facilities GROUP BY 1"))
def _(read):
    rows = read("facilities").select("facility_id", "location_id", "kind")
    path = fresh_path(rows.sparkSession, "csv")
    rows.write.csv(path, header=True)
    return scans.csv(rows.sparkSession, path, "facility_id string, location_id int, kind string").groupBy("location_id").agg(F.count("*").alias("n"), F.count("kind").alias("kinds"))


@query("s18_zone_of_segments", oracle(["road_segments"], "SELECT segment_id, CAST(CAST(substr(segment_id, 2) AS INT) % 30 AS INT) AS location_id FROM road_segments WHERE CAST(substr(segment_id, 2) AS INT) % 4 <> 0 AND CAST(substr(segment_id, 2) AS INT) % 5 <> 0"))
def _(read):
    number = F.substring("segment_id", 2, 9).cast("int")
    table = read("road_segments").select("segment_id", F.when(number % 4 != 0, number % 30).alias("location_id"), F.when(number % 5 == 0, "2025-12-01").otherwise("2026-01-01").alias("snapshot_date"))
    return scans.zone_of_segments(table, "2026-01-01")


@query("s20_map_roads", oracle(["road_features"], "SELECT CASE WHEN trim(segment_id) = '' THEN 'blank_id' WHEN n > 1 THEN 'repeated_id' WHEN length_ft = '' THEN 'no_shape' ELSE 'sound' END AS why, count(*) AS rows FROM (SELECT *, count(*) OVER (PARTITION BY segment_id) AS n FROM road_features) GROUP BY 1"))
def _(read):
    sound, odd = scans.map_roads(read("road_features").withColumn("shape", F.nullif("length_ft", F.lit(""))), "segment_id", "shape")
    return odd.unionByName(sound.agg(F.lit("sound").alias("why"), F.count("*").alias("rows")))


@query("s8_profiles", oracle(["sensor_events"], "SELECT DISTINCT vehicle_profile_id FROM sensor_events WHERE vehicle_profile_id <> 3"))
def _(read):
    return scans.known_profiles(read("sensor_events"), 3)


@query("s15_row_counts", oracle(["trips", "road_segments"], "SELECT 'trips' AS name, count(*) AS rows FROM trips UNION ALL SELECT 'roads', count(*) FROM road_segments"))
def _(read):
    return audits.output_counts({"trips": read("trips"), "roads": read("road_segments")})


@query("k15_table_copy", oracle(["zones"], "SELECT location_id, borough FROM zones"))
def _(read):
    zones = read("zones")
    path = fresh_path(zones.sparkSession, "zones")
    zones.write.parquet(path)
    return zones.sparkSession.read.schema(zones.schema).parquet(path).select("location_id", "borough")


# --- streams: a folder of files is the source, and all of it is read -----------------------------------

def _streamed(read) -> tuple[DataFrame, str]:
    rows = read("raw_records").select("value", F.timestamp_micros(F.lit(BASE_US) + F.col("ingested") * 1_000_000).alias("timestamp"))
    path = fresh_path(rows.sparkSession, "stream")
    rows.repartition(4).write.parquet(f"{path}/in")
    return rows.sparkSession.readStream.schema(rows.schema).parquet(f"{path}/in"), path


@query("r1_raw_stream", oracle(["raw_records"], "SELECT ingested // 3600 AS hour, count(*) AS rows FROM raw_records GROUP BY 1"))
def _(read):
    """Envelopes without a time of their own go by their arrival; a second run adds nothing."""
    stream, path = _streamed(read)
    for _ in range(2):
        raw.into_hours(stream, f"{path}/out", f"{path}/state", files=2).awaitTermination()
    found = stream.sparkSession.read.parquet(f"{path}/out")
    hour = F.floor((F.unix_micros("timestamp") - BASE_US) / HOUR_US)
    return found.groupBy(hour.alias("hour")).agg(F.count("*").alias("rows"))


@query("r3_observed_batches", oracle(["raw_records"], "SELECT count(*) AS rows, max(ingested) AS latest FROM raw_records"))
def _(read):
    stream, path = _streamed(read)
    run = raw.observed(stream, "timestamp").writeStream.format("noop").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    seen = [p["observedMetrics"]["events"] for p in run.recentProgress if p["numInputRows"]]
    told = stream.sparkSession.createDataFrame([(int(s["rows"]), str(s["latest"])) for s in seen], "rows long, latest string")
    latest = F.max((F.unix_micros(F.col("latest").cast("timestamp")) - BASE_US) / 1_000_000)
    return told.agg(F.sum("rows").alias("rows"), latest.cast("long").alias("latest"))


@query("m41_enriched", oracle(["raw_records"], "SELECT count(*) AS rows, count(*) FILTER (json_valid(value)) AS sound, CAST(sum(CASE WHEN json_valid(value) THEN CAST(value->>'$.trip_seq' AS BIGINT) END) AS BIGINT) AS seqs FROM raw_records"))
def _(read):
    """Sound records gain the time they came and lose fields that the schema lacks; others stay."""
    schema = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("trip_seq", T.LongType())])
    rows = read("raw_records").withColumn("timestamp", F.timestamp_micros(F.lit(BASE_US) + F.col("ingested")))
    made = raw.enriched(rows, schema)
    sound = F.get_json_object("value", "$._ingested_at").isNotNull() & F.get_json_object("value", "$.speed_mps").isNull()
    return made.agg(F.count("*").alias("rows"), F.count_if(sound).alias("sound"), F.sum(F.get_json_object("value", "$.trip_seq").cast("long")).alias("seqs"))


@query("s2_decoded", oracle(["raw_records"], "SELECT CAST(hour AS VARCHAR) AS key, count(*) AS n, count(DISTINCT value) AS texts FROM raw_records GROUP BY 1"))
def _(read):
    rows = read("raw_records").select(F.col("hour").cast("string").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    return raw.decoded(rows).groupBy("key").agg(F.count("*").alias("n"), F.count_distinct("value").alias("texts"))

