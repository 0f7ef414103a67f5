"""Artifacts that aren't what their manifest says, odd well-known text, shapefiles, collections, pointers."""

import gzip
import json
import os
import struct

import pytest
from pyspark.sql import functions as F

from smoothway.operators import profiles, roads
from smoothway.sources import artifacts, publish, scans, shapefile
from smoothway.sources.scratch import fresh_path


def _published(spark):
    root = fresh_path(spark, "artifacts")
    table = spark.createDataFrame([(f"s{k}", k) for k in range(50)], "segment_id string, n int").repartition(3)
    artifacts.publish_artifacts(root, {artifacts.ROLE: table}, "2026-01-05")
    return root, table


def _edit(spark, root, change):
    uri = json.loads(publish.read_text(spark, f"{root}/active.json"))["manifest_uri"]
    manifest = json.loads(publish.read_text(spark, uri))
    change(manifest)
    publish.put_text(spark, uri, json.dumps(manifest))


def test_an_artifact_is_read_with_the_asked_columns(spark):
    root, table = _published(spark)
    assert artifacts.read_artifact(spark, root, columns=["n"]).columns == ["n"]
    assert sorted(r[0] for r in artifacts.segment_universe(spark, root).collect()) == sorted(r[0] for r in table.collect())
    with pytest.raises(ValueError, match="lacks depth"):
        artifacts.read_artifact(spark, root, columns=["n", "depth"])
    with pytest.raises(ValueError, match="no artifact maps"):
        artifacts.read_artifact(spark, root, "maps")


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda m: m["artifacts"][0].update(checksum="1"), "isn't what its manifest says"),
        (lambda m: m["artifacts"][0].update(rows=49), "isn't what its manifest says"),
        (lambda m: m.update(snapshot_date="2026-01-06"), "isn't of the date"),
        (lambda m: m["artifacts"][0].update(uri=""), "no artifact"),
        (lambda m: m.update(artifacts=[]), "no artifact"),
    ],
)
def test_what_a_manifest_does_not_vouch_for_is_refused(spark, change, message):
    root, _ = _published(spark)
    _edit(spark, root, change)
    with pytest.raises(ValueError, match=message):
        artifacts.read_artifact(spark, root)


def test_a_pointer_without_a_manifest_is_refused(spark):
    root, _ = _published(spark)
    publish.put_text(spark, f"{root}/active.json", "{}")
    with pytest.raises(ValueError, match="names no manifest"):
        artifacts.segment_universe(spark, root)


def test_checksums_hold_rows_in_any_order(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, [1.5])]
    sums = {artifacts.checksum(spark.createDataFrame(r, "a int, b string, c array<double>").repartition(n)) for r, n in ((rows, 1), (rows[::-1], 3))}
    assert len(sums) == 1
    others = [rows[:2], [(1, None, None), *rows[1:]], [(1, "a", [1.5]), (1, "a", None), (2, None, None)]]
    assert not sums & {artifacts.checksum(spark.createDataFrame(r, "a int, b string, c array<double>")) for r in others}
    assert artifacts.checksum(spark.createDataFrame([], "a int")) == "0"


def test_well_known_text(spark):
    rows = [("LINESTRING (1 2, -3.5 4e1)", 2), ("linestring(1 2,3 4,5 6)", 3), ("LINESTRING EMPTY", None), ("LINESTRING (1 2, x 4)", None), ("LINESTRING (1 2 3, 4 5 6)", None), ("POINT (1 2)", None), ("", None), (None, None), ("LINESTRING (1 2, 3 4) x", None)]
    found = spark.createDataFrame(rows, "t string, n int").select("n", artifacts.wkt_points(F.col("t")).alias("p")).collect()
    assert [None if r["p"] is None else len(r["p"]) for r in found] == [r["n"] for r in found]
    assert [tuple(p) for p in found[0]["p"]] == [(1.0, 2.0), (-3.5, 40.0)]
    ring = spark.createDataFrame([("POLYGON ((0 0, 1 0, 1 1, 0 0))",), ("POLYGON ((0 0, 1 0), (2 2, 3 3))",)], "t string").select(artifacts.wkt_points(F.col("t"), "POLYGON").alias("p")).collect()
    assert len(ring[0]["p"]) == 4 and ring[1]["p"] is None


def test_hump_lists(spark):
    rows = [("[]", []), ("[0, 1, 0.5]", [0.0, 1.0, 0.5]), ("[1.01]", None), ("[-0.1]", None), ('["0.5"]', None), ("[0.5", None), ("{}", None), ("[null]", None), ("", None), (None, None)]
    found = spark.createDataFrame([(t,) for t, _ in rows], "t string").select(artifacts.hump_shares(F.col("t")).alias("h")).collect()
    assert [r["h"] for r in found] == [h for _, h in rows]


def test_readers_of_a_pointer_find_the_old_or_the_new(spark):
    root = fresh_path(spark, "pointer")
    for k in range(3):
        publish.put_text(spark, f"{root}/active.json", str(k))
        assert publish.read_text(spark, f"{root}/active.json") == str(k)
    folder = root.removeprefix("file://")
    assert [n for n in os.listdir(folder) if not n.startswith(".")] == ["active.json"]


def test_a_snapshot_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(40).mapInPandas(count, "id long")
    publish.write_snapshot(df, fresh_path(spark, "once"))
    assert seen.value == 40


# --- shapefiles ------------------------------------------------------------------------------------

SQUARE = [(980_000.0, 200_000.0), (981_000.0, 200_000.0), (981_000.0, 201_000.0), (980_000.0, 200_000.0)]
FEET = 'PROJCS["x",GEOGCS["g",UNIT["Degree",0.017]],UNIT["Foot_US",0.3048006096012192]]'


def _zip(spark, content):
    path = fresh_path(spark, "shape") + ".zip"
    publish.put_bytes(spark, path, content)
    return path


def test_zipped_shapefiles_come_back(spark):
    rows = [({"LocationID": "4", "zone": "Ä b"}, [SQUARE, SQUARE[::-1]]), ({"LocationID": "7", "zone": ""}, None)]
    path = _zip(spark, shapefile.packed(rows, FEET))
    found = shapefile.shapes(spark, path).orderBy("record").collect()
    assert [(r["record"], r["fields"]["zone"], r["rings"] and [[tuple(p) for p in ring] for ring in r["rings"]]) for r in found] == [(0, "Ä b", [SQUARE, SQUARE[::-1]]), (1, "", None)]
    metres = {r["location_id"]: r["rings"] for r in shapefile.taxi_zones(spark, path).collect()}
    assert metres[4][0][0]["x"] == pytest.approx(980_000 * 0.3048006096012192)
    assert metres[7] is None


def test_degrees_are_projected(spark):
    path = _zip(spark, shapefile.packed([({"locationid": "1"}, [[(-74.0, 40.7), (-73.9, 40.7), (-73.9, 40.8), (-74.0, 40.7)]])], 'GEOGCS["WGS84",UNIT["Degree",0.0174]]'))
    x, y = spark.range(1).select(*roads.projected(F.lit(-74.0), F.lit(40.7))).first()
    point = shapefile.taxi_zones(spark, path).first()["rings"][0][0]
    assert (point["x"], point["y"]) == pytest.approx((x, y))


def test_odd_shapefiles(spark):
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("readme.txt", "no shapes")
    with pytest.raises(Exception, match="has no .shp"):
        shapefile.shapes(spark, _zip(spark, out.getvalue())).collect()
    with pytest.raises(ValueError, match="has no zones"):
        shapefile.taxi_zones(spark, _zip(spark, shapefile.packed([], FEET)))
    with pytest.raises(ValueError, match="is no polygon"):
        list(shapefile._shapes(bytes(100) + struct.pack(">ii", 1, 2) + struct.pack("<i", 3)))


# --- one collection --------------------------------------------------------------------------------


@pytest.mark.parametrize("n, parts", [(0, 2), (1, 3), (200, 5)])
def test_a_collection_is_one_gzipped_document(spark, n, parts):
    rows = spark.createDataFrame([(f"s{k:03d}", [(k + 0.123456789, 2.0), (k + 1.0, 3.0)]) for k in range(n)], "id string, line array<struct<x: double, y: double>>")
    made = scans.feature_lines(rows, "line", ["id"]).withColumn("id", F.get_json_object("value", "$.properties.id"))
    path = fresh_path(spark, "collection") + ".json.gz"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        scans.write_collection(made.repartition(parts), path, ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    told = json.loads(gzip.open(path.removeprefix("file://")).read())
    assert told["type"] == "FeatureCollection"
    assert [f["properties"]["id"] for f in told["features"]] == [f"s{k:03d}" for k in range(n)]
    if n:
        assert told["features"][0]["geometry"]["coordinates"][0] == [0.123457, 2.0]
    assert scans.features(spark, path).count() == n


def test_dates_with_a_fraction_and_crosswalks_with_a_repeated_code(spark):
    dates = spark.createDataFrame([("2024-03-15T00:00:00.000",), ("2024-03-15T00:00:00",), ("03/15/2024",), ("never",)], "t string").select(roads.source_date(F.col("t")).alias("d")).collect()
    assert [str(r["d"]) for r in dates] == ["2024-03-15"] * 3 + ["None"]
    walk = spark.createDataFrame([("1", 1), ("1", 2)], "code string, location_id int")
    with pytest.raises(ValueError, match="repeats codes, as 1"):
        profiles.by_code(walk.select("code"), walk, "code")
