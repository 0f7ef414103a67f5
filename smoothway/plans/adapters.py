"""Views of the given tables in the shapes of the ride-quality domain.

The given tables hold no vehicle sensors, roads or weather, so each view derives its columns from
ids and numbers by arithmetic. The same text is the Spark projection and, as a common table
expression, the oracle's: only the time functions differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Microseconds of 2026-01-05 00:00 UTC, a fixed value.
BASE_US = 1_767_571_200_000_000
HOUR_US = 3_600_000_000

#: name -> (table, columns). @div is whole division.
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "sensor_events": ("events", {
        "event_id": "event_id",
        "trip_id": "concat('t', CAST(event_id @div 40 AS VARCHAR(20)))",
        "trip_seq": "event_id % 40",
        "vehicle_profile_id": "CAST(1 + user_id % 5 AS INT)",
        "event_us": f"CAST({BASE_US} AS BIGINT) + event_id * 100000 + CASE WHEN event_id % 23 = 0 THEN 700000 ELSE 0 END",
        "accel_x": "CAST(CASE WHEN event_id % 97 = 0 THEN NULL WHEN (event_id @div 5) % 6 = 0 THEN 3.5 WHEN (event_id @div 5) % 6 = 2 THEN -3.25 ELSE 0.5 END AS DOUBLE)",
        "steering_angle": "CAST(CASE WHEN event_id % 89 = 0 THEN NULL WHEN (event_id @div 4) % 5 < 2 THEN 12.5 * (event_id % 4) ELSE -10.5 * (event_id % 3) END AS DOUBLE)",
        "speed_mps": "CAST(event_id % 18 AS DOUBLE)",
        "x": "CAST((event_id * 37) % 2000 AS DOUBLE)",
        "y": "CAST((event_id * 53) % 1500 AS DOUBLE)",
        "heading": "CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST((event_id * 29) % 360 AS DOUBLE) END",
    }),
    "hour_events": ("events", {
        "event_id": "event_id",
        "event_us": f"CAST({BASE_US} AS BIGINT) + event_id % 5 * {HOUR_US} + event_id * 7919000 % {HOUR_US}",
        "speed_mps": "CAST(event_id % 18 AS DOUBLE)",
    }),
    "raw_records": ("events", {
        "value": "CASE WHEN event_id % 41 = 0 THEN '{\"event_id\": \"broken' WHEN event_id % 43 = 0 THEN concat('{\"event_id\": \"e', CAST(event_id AS VARCHAR(20)), '\", \"speed_mps\": 3.5}') "
        "ELSE concat('{\"event_id\": \"e', CAST(event_id - event_id % 7 % 2 AS VARCHAR(20)), '\", \"trip_id\": \"t', CAST(user_id AS VARCHAR(20)), '\", \"trip_seq\": ', CAST(event_id AS VARCHAR(20)), ', \"speed_mps\": ', CAST(CASE WHEN event_id % 47 = 0 THEN 75 ELSE event_id % 50 END AS VARCHAR(20)), '.5, \"accel_z\": ', CAST(event_id % 60 - 29 AS VARCHAR(20)), '.25}') END",
        "ingested": "event_id * 3 % 1000 + event_id",
        "hour": "event_id @div 1000",
    }),
    "timed_records": ("events", {
        "event_id": "event_id",
        "minute": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id * 7 % 180 AS INT) END",
        "arrived_min": "CAST(event_id * 11 % 180 AS INT)",
        "value": "CASE WHEN event_id % 35 = 0 THEN '{\"event_id\": \"broken' WHEN event_id % 5 = 0 THEN concat('{\"event_id\": ', CAST(event_id AS VARCHAR(20)), ', \"event_time\": \"soon\"}') "
        "ELSE concat('{\"event_id\": ', CAST(event_id AS VARCHAR(20)), ', \"event_time\": \"2026-01-05T', lpad(CAST(event_id * 7 % 180 @div 60 AS VARCHAR(20)), 2, '0'), ':', lpad(CAST(event_id * 7 % 180 % 60 AS VARCHAR(20)), 2, '0'), ':00Z\"}') END",
    }),
    "hourly_signals": ("lineitem", {
        "segment_id": "concat('s', CAST(l_suppkey % 400 AS VARCHAR(20)))",
        "vehicle_profile_id": "CAST(1 + l_partkey % 5 AS INT)",
        "hour_us": f"CAST({BASE_US} AS BIGINT) + (l_orderkey % 24) * {HOUR_US}",
        "trip_id": "l_orderkey",
        "speed": "l_quantity / 3.0",
        "accel_x": "(l_discount - 0.05) * 20",
        "accel_y": "(l_tax - 0.04) * 12",
        "accel_z": "CASE WHEN l_linenumber = 7 THEN NULL ELSE (l_quantity - 25) / 100.0 END",
        "jerk_x": "(l_discount - 0.03) * 30",
        "jerk_y": "(l_tax - 0.02) * 90",
        "jerk_z": "(l_quantity - 20) / 8.0",
        "steering_rate": "(l_quantity - 25) * 3.0",
        "steering_vibration": "l_tax * 2",
        "hard_accel": "l_discount >= 0.1",
        "hard_brake": "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_tax >= 0.08 END",
        "sharp_steer": "l_quantity >= 49",
        "steer_reversal": "l_returnflag = 'R'",
    }),
    "hourly_scores": ("lineitem", {
        "segment_id": "concat('s', CAST(l_suppkey % 300 AS VARCHAR(20)))",
        "vehicle_profile_id": "CAST(1 + l_partkey % 4 AS INT)",
        "period_us": f"CAST({BASE_US} AS BIGINT) - (l_orderkey % 200) * {HOUR_US}",
        "scoring_version": "CASE l_linenumber % 3 WHEN 0 THEN '1.0.0' WHEN 1 THEN '1.2.0' ELSE '1.10.0' END",
        "vertical_score": "CAST(l_quantity * 2 AS DOUBLE)",
        "longitudinal_score": "100 - l_discount * 400",
        "lateral_score": "100 - l_tax * 700",
        "trip_count": "CAST(l_orderkey % 8 AS BIGINT)",
        "sample_count": "CAST(l_orderkey % 8 * 30 AS BIGINT)",
    }),
    "road_segments": ("supplier", {
        "segment_id": "concat('s', CAST(s_suppkey AS VARCHAR(20)))",
        "x0": "CAST((s_suppkey * 61) % 2000 AS DOUBLE)",
        "y0": "CAST((s_suppkey * 97) % 1500 AS DOUBLE)",
        "x1": "CAST((s_suppkey * 61) % 2000 + 40 + s_suppkey % 90 AS DOUBLE)",
        "y1": "CAST((s_suppkey * 97) % 1500 + 10 + s_suppkey % 70 AS DOUBLE)",
        "traffic_direction": "CASE s_suppkey % 3 WHEN 0 THEN 'W' WHEN 1 THEN 'A' ELSE 'T' END",
        "street": "concat(' Main-', CAST(s_suppkey % 25 AS VARCHAR(20)), ' st. ')",
        "from_node": "concat('n', CAST(s_suppkey % 40 AS VARCHAR(20)))",
        "to_node": "concat('n', CAST((s_suppkey * 7 + 3) % 40 AS VARCHAR(20)))",
    }),
    "pavement": ("part", {
        "street": "concat('MAIN ', CAST(p_partkey % 30 AS VARCHAR(20)), ' ST')",
        "x": "CAST((p_partkey * 31) % 2000 AS DOUBLE)",
        "y": "CAST((p_partkey * 17) % 1500 AS DOUBLE)",
        "inspected": "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(20250000 + p_partkey % 900 AS INT) END",
        "rating": "CAST(1 + p_size % 10 AS DOUBLE)",
    }),
    "zones": ("nation", {
        "location_id": "n_nationkey",
        "x0": "CAST((n_nationkey % 5) * 400 AS DOUBLE)",
        "y0": "CAST(CAST(floor(n_nationkey / 5.0) AS INT) * 300 AS DOUBLE)",
        "width": "CAST(380 + n_nationkey AS DOUBLE)",
        "height": "CAST(290 AS DOUBLE)",
        "borough": "concat('b', CAST(n_regionkey AS VARCHAR(20)))",
    }),
    "zone_weather": ("nation", {
        "location_id": "n_nationkey",
        "temperature_2m": "CASE WHEN n_nationkey % 9 = 4 THEN NULL ELSE CAST(n_nationkey % 7 - 2 AS DOUBLE) END",
        "precipitation": "CAST((n_nationkey % 4) * 0.1 AS DOUBLE)",
        "rain": "CAST((n_nationkey % 5) * 0.05 AS DOUBLE)",
        "snowfall": "CAST(CASE WHEN n_nationkey % 6 = 5 THEN 0.06 ELSE 0.0 END AS DOUBLE)",
        "visibility": "CASE WHEN n_nationkey % 8 = 7 THEN NULL ELSE CAST(600 + n_nationkey * 200 AS DOUBLE) END",
        "wind_gusts_10m": "CAST(n_nationkey % 20 AS DOUBLE)",
        "weather_code": "CASE n_nationkey % 10 WHEN 1 THEN 45 WHEN 2 THEN 61 WHEN 3 THEN 73 WHEN 6 THEN 66 ELSE 0 END",
        "freshness_seconds": "n_nationkey * 90 - 100",
    }),
    "trips": ("orders", {
        "trip_id": "o_orderkey",
        "pickup_zone": "CAST(o_custkey % 25 AS INT)",
        "dropoff_zone": "CAST((o_orderkey * 3) % 27 AS INT)",
        "request_us": f"CAST({BASE_US} AS BIGINT) + (o_orderkey % 5000) * 17000000",
        "pickup_us": f"CAST({BASE_US} AS BIGINT) + (o_orderkey % 5000) * 17000000 + (o_orderkey % 600) * 1000000",
        "dropoff_us": f"CAST({BASE_US} AS BIGINT) + (o_orderkey % 5000) * 17000000 + (o_orderkey % 600) * 1000000 + (o_orderkey % 97 - 1) * 60000000",
        "miles": "CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE round(o_totalprice / 20000.0, 2) END",
        "month": "CAST(o_orderkey % 3 AS INT)",
    }),
    "routes": ("lineitem", {
        "route_id": "l_orderkey",
        "position": "l_linenumber",
        "segment_id": "concat('s', CAST(l_suppkey % 300 AS VARCHAR(20)))",
    }),
    "road_features": ("supplier", {
        "segment_id": "CASE WHEN s_suppkey % 17 = 0 THEN '  ' ELSE concat('s', CAST(s_suppkey @div 2 AS VARCHAR(20))) END",
        "object_id": "s_suppkey * 7919 % 100003",
        "feature_type": "CASE s_suppkey % 7 WHEN 0 THEN '0' WHEN 1 THEN '6' WHEN 2 THEN 'A' WHEN 3 THEN 'C' WHEN 4 THEN '5' ELSE '0' END",
        "status": "CASE WHEN s_suppkey % 13 = 0 THEN '9' ELSE '2' END",
        "rw_type": "CAST(1 + s_suppkey % 14 AS VARCHAR(20))",
        "traffic": "CASE s_suppkey % 5 WHEN 0 THEN 'W' WHEN 1 THEN 'A' WHEN 3 THEN 'P' ELSE 'T' END",
        "street": "CASE WHEN s_suppkey % 19 = 0 THEN ' ' ELSE concat(' Main-', CAST(s_suppkey % 25 AS VARCHAR(20)), ' st. ') END",
        "length_ft": "CASE WHEN s_suppkey % 11 = 0 THEN '' WHEN s_suppkey % 7 = 0 THEN '1,250.5' WHEN s_suppkey % 23 = 0 THEN 'n/a' ELSE CAST(s_suppkey % 90 AS VARCHAR(20)) END",
        "built": "CASE s_suppkey % 4 WHEN 0 THEN '03/15/2024' WHEN 1 THEN '2024-03-15T00:00:00' WHEN 2 THEN 'unknown' ELSE '2024-03-15' END",
        "parts": "CAST(CASE WHEN s_suppkey % 29 = 0 THEN 2 ELSE 1 END AS INT)",
    }),
    "road_shapes": ("supplier", {
        "shape_id": "CASE WHEN s_suppkey % 31 = 0 THEN concat('z', CAST(s_suppkey AS VARCHAR(20))) ELSE concat('s', CAST(s_suppkey AS VARCHAR(20))) END",
        "x0": "CAST((s_suppkey * 61) % 2000 AS DOUBLE)",
        "y0": "CAST((s_suppkey * 97) % 1500 AS DOUBLE)",
        "x1": "CAST((s_suppkey * 61) % 2000 + 40 AS DOUBLE)",
        "y1": "CAST((s_suppkey * 97) % 1500 - 25 AS DOUBLE)",
        "x2": "CAST((s_suppkey * 61) % 2000 + 90 AS DOUBLE)",
        "y2": "CAST((s_suppkey * 97) % 1500 + 30 AS DOUBLE)",
    }),
    "bent_roads": ("supplier", {
        "segment_id": "concat('s', CAST(s_suppkey AS VARCHAR(20)))",
        "street": "concat(' Main-', CAST(s_suppkey % 25 AS VARCHAR(20)), ' st. ')",
        "traffic_direction": "CASE s_suppkey % 3 WHEN 0 THEN 'W' WHEN 1 THEN 'A' ELSE 'T' END",
        "from_node": "concat('n', CAST(s_suppkey % 40 AS VARCHAR(20)))",
        "to_node": "concat('n', CAST((s_suppkey * 7 + 3) % 40 AS VARCHAR(20)))",
        "n_points": "CAST(2 + s_suppkey % 3 AS INT)",
        "x0": "CAST((s_suppkey * 61) % 2000 AS DOUBLE)",
        "y0": "CAST((s_suppkey * 97) % 1500 AS DOUBLE)",
        "x1": "CAST((s_suppkey * 61) % 2000 + 40 + s_suppkey % 30 AS DOUBLE)",
        "y1": "CAST((s_suppkey * 97) % 1500 + 25 - s_suppkey % 40 AS DOUBLE)",
        "x2": "CAST((s_suppkey * 61) % 2000 + 60 - s_suppkey % 20 AS DOUBLE)",
        "y2": "CAST((s_suppkey * 97) % 1500 + 55 - s_suppkey % 20 AS DOUBLE)",
        "x3": "CAST((s_suppkey * 61) % 2000 + 95 + s_suppkey % 17 AS DOUBLE)",
        "y3": "CAST((s_suppkey * 97) % 1500 + 10 + s_suppkey % 23 AS DOUBLE)",
    }),
    "humps": ("part", {
        "hump_id": "p_partkey",
        "street": "concat('MAIN ', CAST(p_partkey % 30 AS VARCHAR(20)), ' ST')",
        "x": "CAST((p_partkey * 43) % 2000 AS DOUBLE)",
        "y": "CAST((p_partkey * 29) % 1500 AS DOUBLE)",
        "installed": "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(20250000 + p_partkey % 900 AS INT) END",
        "humps": "CAST(p_size % 4 AS INT)",
    }),
    "facilities": ("customer", {
        "facility_id": "CAST(c_custkey AS VARCHAR(20))",
        "location_id": "CAST(c_custkey % 27 AS INT)",
        "kind": "CASE c_custkey % 6 WHEN 0 THEN 'Hospital' WHEN 1 THEN 'Hospital Extension Clinic' WHEN 2 THEN 'Public School' WHEN 3 THEN 'Day Care' WHEN 4 THEN 'Museum and Cafe' ELSE NULL END",
        "latitude": "CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 15 = 1 THEN 'north' ELSE CAST(40 + c_custkey % 9 AS VARCHAR(20)) END",
        "inner_latitude": "CASE WHEN c_custkey % 16 = 0 THEN NULL ELSE CAST(30 + c_custkey % 9 AS VARCHAR(20)) END",
        "shop": "CASE WHEN c_custkey % 4 = 0 THEN 'yes' ELSE '' END",
        "amenity": "CASE c_custkey % 7 WHEN 0 THEN 'restaurant' WHEN 1 THEN 'cafe' WHEN 2 THEN 'bar' WHEN 3 THEN 'nightclub' WHEN 4 THEN 'bench' ELSE NULL END",
        "tourism": "CASE c_custkey % 9 WHEN 0 THEN 'hotel' WHEN 1 THEN 'museum' WHEN 2 THEN 'attraction' ELSE NULL END",
    }),
    "beds": ("orders", {
        "facility_id": "CAST(o_custkey AS VARCHAR(20))",
        "attribute": "CASE WHEN o_orderkey % 3 = 0 THEN 'Bed' WHEN o_orderkey % 3 = 1 THEN 'bed' ELSE 'Service' END",
        "sub_type": "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'Permanent' ELSE 'Temporary' END",
        "measure": "CAST(o_orderkey % 40 AS BIGINT)",
    }),
    "blocks": ("customer", {
        "state": "CAST(c_custkey % 3 + 34 AS INT)",
        "county": "CAST(c_custkey % 7 AS INT)",
        "tract": "CAST(c_custkey AS INT)",
        "location_id": "CAST(c_custkey % 25 AS INT)",
        "share": "CAST((1 + c_custkey % 4) / 4.0 AS DOUBLE)",
        "population": "CASE WHEN c_custkey % 10 = 0 THEN -666666666 ELSE CAST(c_custkey % 500 AS BIGINT) END",
        "households": "CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE CAST(c_custkey % 200 AS BIGINT) END",
        "income": "CASE WHEN c_custkey % 14 = 0 THEN NULL ELSE CAST(20000 + c_custkey * 37 % 90000 AS BIGINT) END",
        "men": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 60 AS BIGINT) END",
        "women": "CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE CAST(c_custkey % 70 AS BIGINT) END",
    }),
    "zone_numbers": ("nation", {
        "location_id": "CAST(n_nationkey AS INT)",
        "residential_score": "CAST((n_nationkey * 37) % 101 AS DOUBLE)",
        "business_score": "CAST((n_nationkey * 53) % 97 AS DOUBLE)",
        "tourism_score": "CASE WHEN n_nationkey % 6 = 1 THEN NULL ELSE CAST((n_nationkey * 29) % 89 AS DOUBLE) END",
        "income_norm": "CASE WHEN n_nationkey % 11 = 2 THEN NULL ELSE ((n_nationkey * 7) % 25) / 25.0 END",
        "jobs_norm": "((n_nationkey * 11) % 25) / 25.0",
    }),
    "builds": ("orders", {
        "build_id": "o_orderkey",
        "month": "CAST(o_orderkey % 30 AS INT)",
        "day": "CAST(1 + o_orderkey % 28 AS INT)",
        "written": "o_orderkey * 7 % 10007",
    }),
    "shares": ("region", {"vehicle_profile_id": "CAST(1 + r_regionkey AS INT)", "configured": "CAST(0.2 AS DOUBLE)"}),
}


def _spark_text(expression: str) -> str:
    """An expression of a view for Spark. Its round takes the shortest decimal digits of a number, the oracle's the
    number times 100 (0.145 is 14.499...), so two places are rounded as whole numbers."""
    expression = re.sub(r"\bround\(([^(),]+), 2\)", r"round((\1) * 100) / 100", expression)
    return expression.replace("@div", "div").replace("AS VARCHAR(20)", "AS STRING")


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = VIEWS[name]
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return source.selectExpr(*[f"{_spark_text(e)} AS {c}" for c, e in columns.items()])


def oracle_view(name: str) -> str:
    """The view as a common table expression."""
    table, columns = VIEWS[name]
    listed = ", ".join(f"{e.replace('@div', '//').replace('AS VARCHAR(20)', 'AS VARCHAR')} AS {c}" for c, e in columns.items())
    return f"{name} AS (SELECT {listed} FROM {table})"


def oracle(views: list[str], rest: str, *steps: str) -> str:
    """An oracle: the views, further common table expressions, and the query."""
    return "WITH " + ", ".join([*map(oracle_view, views), *steps]) + " " + rest
