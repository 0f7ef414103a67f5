"""Helpers that no query calls."""

import hashlib

from pyspark.sql import functions as F

from smoothway.operators import spatial, weather, zones
from smoothway.plans import catalog
from smoothway.plans.adapters import spark_view
from smoothway.streaming import raw


def test_inside_polygon(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]
    points = {(1.0, 1.0): True, (2.0, 3.0): False, (2.0, 1.0): True, (4.0, 2.0): True, (5.0, 1.0): False, (3.5, 3.0): True}
    df = spark.createDataFrame([(x, y, ring) for x, y in points], "x double, y double, ring array<struct<x: double, y: double>>")
    found = df.select("x", "y", spatial.inside_polygon(F.col("x"), F.col("y"), F.col("ring")).alias("inside")).collect()
    assert {(r["x"], r["y"]): r["inside"] for r in found} == points


def test_parse_signature(spark):
    told = {"v1|clear": [], "v1|ice,rain": ["ice", "rain"], "v1|rain,ice": None, "v1|rain,rain": None, "v2|rain": None, "v1|hail": None}
    df = spark.createDataFrame([(t,) for t in told], "t string")
    assert {r["t"]: r["p"] for r in df.select("t", weather.parse_signature(F.col("t")).alias("p")).collect()} == told


def test_categories_representatives_and_shares(spark):
    df = spark.createDataFrame([("Ab", 2), ("Ab", 1), (" ", 0), (None, 5)], "k string, n long")
    assert [tuple(r) for r in zones.representative(df, "k", "n").collect()] == [("Ab", 1)]
    names = df.select("n", zones.keyword_categories(F.col("k"), {"a": "a", "b": "^b"}).alias("c")).collect()
    assert {r["n"]: r["c"] for r in names} == {2: ["a"], 1: ["a"], 0: [], 5: []}
    share = df.filter("n = 1").select(zones.stable_share(F.col("k"), "s").alias("s")).first()["s"]
    assert share == int(hashlib.sha256(b"sAb").hexdigest()[:13], 16) / (1 << 52)


def test_windowed_counts(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2026-01-05 00:10:00', 'a'), (TIMESTAMP '2026-01-05 00:50:00', 'a'), (TIMESTAMP '2026-01-05 01:10:00', 'a') AS v(t, k)")
    assert sorted(r["n"] for r in raw.windowed_counts(df, "t", ["k"]).collect()) == [1, 2]


def test_j10_midpoints_in_polygons(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest table has few roads
    areas = sorted(spark_view(spark, sf_dir, "zones").collect(), key=lambda z: z["location_id"])
    want = {}
    for r in spark_view(spark, sf_dir, "road_segments").collect():
        at = [(z["location_id"], ((r["x0"] + r["x1"]) / 2 - z["x0"]) / z["width"], ((r["y0"] + r["y1"]) / 2 - z["y0"]) / z["height"]) for z in areas]
        want[r["segment_id"]] = next((i for i, u, v in at if 0 <= u <= 1 and 0 <= v <= 1 and u + v <= 1.5), None)
    assert {r["segment_id"]: r["location_id"] for r in catalog.QUERIES["j10_midpoint_polygons"](spark, sf_dir).collect()} == want
