"""Readers: GeoJSON, CSV, trips with a stable row, rotated trips, snapshots with guards."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smoothway.sources.partitions import read_hours

FEATURES = "features array<struct<properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>"
POINTS = {"Point": "array<double>", "LineString": "array<array<double>>", "Polygon": "array<array<array<double>>>"}


def features(spark: SparkSession, path: str, geometry: bool = True, lines: bool = False) -> DataFrame:
    """A row for each feature of GeoJSON collections: properties, and the geometry's kind and coordinates as text.

    A file is one collection, or each of its lines is one.
    """
    read = spark.read.schema(FEATURES).json(path, multiLine=not lines).select(F.explode("features").alias("f"))
    shape = [F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates")] if geometry else []
    return read.select("f.properties", *shape)


def line(coordinates: Column) -> Column:
    """Coordinates of a line string as an array of struct<x,y>."""
    return F.transform(F.from_json(coordinates, POINTS["LineString"]), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def feature_lines(df: DataFrame, shape: str, properties: list[str], places: int = 6) -> DataFrame:
    """A text row for each feature of a line (array of struct<x,y>), coordinates to some places."""
    points = F.transform(shape, lambda p: F.array(F.round(p["x"], places), F.round(p["y"], places)))
    geometry = F.struct(F.lit("LineString").alias("type"), points.alias("coordinates"))
    made = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))
    return df.select(F.to_json(made, {"ignoreNullFields": "false"}).alias("value"))


def write_features(df: DataFrame, path: str) -> None:
    """Feature rows as gzipped text, a feature a line, so any number of tasks can write and read them."""
    df.write.option("compression", "gzip").text(path)


def write_collection(df: DataFrame, path: str, order: list[str]) -> int:
    """Feature rows (value, from feature_lines, with the columns of order) as one gzipped FeatureCollection.

    Tasks write their share as gzip members, a feature a line, in ranges of the order; a member for the head,
    for the comma between two parts and for the tail make one document of them. The parts are joined by
    the file system where it can, else copied one after another, in pieces. Returns the number of parts.
    """
    spark = df.sparkSession
    parts = f"{path}.parts-{uuid.uuid4().hex}"

    def commas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            rows = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([v if first and not k else "," + v for k, v in enumerate(rows)], pa.string())], names=["value"])
            first = first and not rows

    df.repartitionByRange(*order).sortWithinPartitions(*order).select("value").mapInArrow(commas, "value string").write.option("compression", "gzip").text(parts)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(conf)
    listed = sorted((s.getPath() for s in fs.listStatus(at(parts)) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    empty = gzip.compress(b"")
    whole = [p for p in listed if fs.getFileStatus(p).getLen() > len(empty)]  # a part without rows is an empty member

    def member(name: str, text: str):
        place = at(f"{parts}/{name}")
        out = fs.create(place, True)
        out.write(bytearray(gzip.compress(text.encode(), mtime=0)))
        out.close()
        return place

    pieces = [member("_head", '{"type":"FeatureCollection","features":[\n')]
    for k, p in enumerate(whole):
        pieces += [p] if not k else [member(f"_comma-{k}", ","), p]
    pieces.append(member("_tail", "]}\n"))
    joined = pieces[0]
    try:
        rest = spark.sparkContext._gateway.new_array(at, len(pieces) - 1)
        for k, p in enumerate(pieces[1:]):
            rest[k] = p
        fs.concat(joined, rest)
    except Exception as e:  # most stores can't; any other fault shows again in the copy
        if "UnsupportedOperation" not in f"{type(e).__name__} {e}":
            raise
        joined = at(f"{parts}/_whole")
        out = fs.create(joined, True)
        for p in pieces:
            source = fs.open(p)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            source.close()
        out.close()
    fs.delete(at(path), False)
    if not fs.rename(joined, at(path)):
        raise OSError(f"{path} couldn't be put in place")
    fs.delete(at(parts), True)
    return len(whole)


def json_rows(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Rows of a JSON file that is one list of objects, or has one a line; what doesn't fit is null."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="PERMISSIVE")


def together(frames: list[DataFrame]) -> DataFrame:
    """Frames of several hours as one, by the names of their columns; what a frame lacks is null."""
    if not frames:
        raise ValueError("no frames")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, mode="PERMISSIVE")


def hour(spark: SparkSession, path: str, schema: T.StructType, date: str, at: str) -> DataFrame:
    """One hour of a table by its folder; one that isn't there has no rows."""
    return read_hours(spark, path, schema, f"{date} {at}", f"{date} {int(at) + 1:02d}")


def window(spark: SparkSession, path: str, schema: T.StructType, time: Column, first: str, end: str) -> DataFrame:
    """Rows whose time is in [first, end), two UTC times as text: folders are pruned by date and hour, then rows by time."""
    last = f"{end[:10]} {int(end[11:13]) + 1:02d}"  # the hour that end lies in may have rows before it
    within = (time >= F.lit(first).cast("timestamp")) & (time < F.lit(end).cast("timestamp"))
    return read_hours(spark, path, schema, first, last).filter(within)


def numbered_rows(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with the file of each row and its place in it, which stay as long as the file does."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("file_row"))


def rotated(trips: DataFrame, time: str, start: int, cycle: int, times: list[str]) -> DataFrame:
    """Rows from start on, then those before it, these moved on by a cycle: wrapped says which.

    Both bounds reach the scan, where the statistics of row groups skip what isn't needed.
    """
    moved = trips.filter(F.col(time) < start).withColumns({c: F.col(c) + cycle for c in times}).withColumn("wrapped", F.lit(True))
    return trips.filter(F.col(time) >= start).withColumn("wrapped", F.lit(False)).unionByName(moved)


def weekday_anchor(wall: Column, first: Column, last: Column) -> Column:
    """The day from first to last that stands for a wall day: of the same weekday, and as many weeks into
    the days as the wall day is into its month, or the last of that weekday; null if there is none."""
    start = F.date_add(first, F.pmod(F.weekday(wall) - F.weekday(first), F.lit(7)))
    weeks = F.least(F.floor((F.day(wall) - 1) / 7), F.floor(F.date_diff(last, start) / 7)).cast("int")
    return F.when(start <= last, F.date_add(start, 7 * weeks))


def zone_of_segments(table: DataFrame, date: str) -> DataFrame:
    """Segments of one snapshot with their zone; rows of another date or without a zone are left out."""
    return table.filter((F.col("snapshot_date") == date) & F.col("location_id").isNotNull()).select("segment_id", "location_id")


def map_roads(roads: DataFrame, key: str, shape: str) -> tuple[DataFrame, DataFrame]:
    """Roads that can be drawn, and counts of those that can't: a blank or repeated id, or no shape."""
    again = roads.groupBy(key).agg(F.count("*").alias("_n"))
    marked = roads.join(again, key, "left").withColumn("_why", F.when(F.length(F.trim(F.coalesce(key, F.lit("")))) == 0, "blank_id").when(F.col("_n") > 1, "repeated_id").when(F.col(shape).isNull(), "no_shape"))
    return marked.filter("_why is null").drop("_why", "_n"), marked.filter("_why is not null").groupBy(F.col("_why").alias("why")).agg(F.count("*").alias("rows"))


def known_profiles(table: DataFrame, sentinel: int = 0) -> DataFrame:
    return table.select("vehicle_profile_id").distinct().filter(F.col("vehicle_profile_id") != sentinel).orderBy("vehicle_profile_id")

