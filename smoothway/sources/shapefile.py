"""Zipped shapefiles of polygons: binary files in, a row for each record out."""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smoothway.operators.roads import projected

#: Kinds of shapes that are polygons: plain, with heights, with measures. Fixed values of the format.
POLYGONS = {5, 15, 25}
SHAPES = "file string, record int, fields map<string,string>, rings array<array<struct<x: double, y: double>>>, prj string"
#: Zones that are written as one file, by the driver.
MOST_PACKED = 10_000
RINGS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def _shapes(shp: bytes) -> Iterator[list[list[tuple[float, float]]] | None]:
    """The rings of each record; None for a record without a shape. Other kinds of shapes raise."""
    at = 100
    while at + 8 <= len(shp):
        length = struct.unpack(">i", shp[at + 4 : at + 8])[0] * 2
        body, at = shp[at + 8 : at + 8 + length], at + 8 + length
        kind = struct.unpack("<i", body[:4])[0]
        if kind == 0:
            yield None
            continue
        if kind not in POLYGONS:
            raise ValueError(f"a shape of kind {kind} is no polygon")
        parts, points = struct.unpack("<ii", body[36:44])
        starts = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), points]
        xy = struct.unpack(f"<{2 * points}d", body[44 + 4 * parts : 44 + 4 * parts + 16 * points])
        yield [[(xy[2 * k], xy[2 * k + 1]) for k in range(a, b)] for a, b in zip(starts[:-1], starts[1:], strict=True)]


def _fields(dbf: bytes) -> Iterator[dict[str, str] | None]:
    """The fields of each record as text, without blanks around; None for a deleted record."""
    count, head, size = struct.unpack("<ihh", dbf[4:12])
    columns, at = [], 32
    while dbf[at] != 0x0D:
        columns.append((dbf[at : at + 11].split(b"\0")[0].decode("latin-1"), dbf[at + 16]))
        at += 32
    for k in range(count):
        row = dbf[head + k * size : head + (k + 1) * size]
        place, found = 1, {}
        for name, width in columns:
            found[name] = row[place : place + width].decode("utf-8", "replace").strip(" \0")
            place += width
        yield None if row[:1] == b"*" else found


def shapes(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the shapefiles in zip archives: file, record, fields, rings, prj.

    An archive is read whole in one task, many side by side. prj is the text of its coordinate system. A
    record without a shape has null rings; deleted records are left out; an archive without a .shp raises.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    names = {n.lower(): n for n in archive.namelist()}
                    stem = next((n[:-4] for n in names if n.endswith(".shp")), None)
                    if stem is None:
                        raise ValueError(f"{path} has no .shp")
                    read = lambda end: archive.read(names[stem + end]) if stem + end in names else b""  # noqa: B023, E731
                    rows = [(k, f, r) for k, (r, f) in enumerate(zip(_shapes(read(".shp")), _fields(read(".dbf")), strict=True)) if f is not None]
                    prj = read(".prj").decode("utf-8", "replace")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(rows), pa.string()),
                        pa.array([k for k, _, _ in rows], pa.int32()),
                        pa.array([list(f.items()) for _, f, _ in rows], pa.map_(pa.string(), pa.string())),
                        pa.array([r and [[{"x": x, "y": y} for x, y in ring] for ring in r] for _, _, r in rows], RINGS),
                        pa.array([prj] * len(rows), pa.string()),
                    ],
                    names=["file", "record", "fields", "rings", "prj"],
                )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parse, SHAPES)


def unit_metres(prj: Column) -> Column:
    """Metres in a unit of a projected coordinate system's text: its last UNIT; null if it isn't projected."""
    return F.when(prj.rlike("^\\s*PROJCS"), F.element_at(F.regexp_extract_all(prj, F.lit(r'UNIT\s*\[\s*"[^"]*"\s*,\s*([0-9.eE+-]+)'), 1), -1).cast("double"))


def in_metres(rings: Column, prj: Column) -> Column:
    """Rings in metres of the state plane of Long Island: from that plane in another unit, or from degrees."""
    unit = unit_metres(prj)

    def moved(p: Column) -> Column:
        x, y = projected(p["x"], p["y"])
        return F.struct(F.when(unit.isNotNull(), p["x"] * unit).otherwise(x).alias("x"), F.when(unit.isNotNull(), p["y"] * unit).otherwise(y).alias("y"))

    return F.transform(rings, lambda r: F.transform(r, moved))


def taxi_zones(spark: SparkSession, path: str, field: str = "locationid") -> DataFrame:
    """Zones of zipped shapefiles: (location_id, rings) in metres; no zones at all are an error."""
    found = shapes(spark, path)
    named = F.try_element_at(F.transform_keys("fields", lambda k, _: F.lower(k)), F.lit(field))
    out = found.select(named.cast("double").cast("int").alias("location_id"), in_metres(F.col("rings"), F.col("prj")).alias("rings"))
    if out.isEmpty():
        raise ValueError(f"{path} has no zones")
    return out


def packed(rows: list[tuple[dict[str, str], list[list[tuple[float, float]]] | None]], prj: str) -> bytes:
    """A zipped shapefile of a few polygons, as for a fixture or an export of zones."""
    records = b""
    for k, (_, rings) in enumerate(rows, 1):
        if rings is None:
            body = struct.pack("<i", 0)
        else:
            points = [p for r in rings for p in r]
            xs, ys = zip(*points, strict=True)
            starts = [sum(map(len, rings[:i])) for i in range(len(rings))]
            body = struct.pack("<i4dii", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        records += struct.pack(">ii", k, len(body) // 2) + body
    head = struct.pack(">i5ii", 9994, 0, 0, 0, 0, 0, 50 + len(records) // 2) + struct.pack("<ii8d", 1000, 5, *[0.0] * 8)
    names = list(rows[0][0]) if rows else []
    width = {n: max([1, *[len(f[n].encode()) for f, _ in rows]]) for n in names}
    columns = b"".join(struct.pack("<11sc4xBB14x", n.encode(), b"C", width[n], 0) for n in names)
    table = b"".join(b" " + b"".join(f[n].encode().ljust(width[n]) for n in names) for f, _ in rows)
    dbf = struct.pack("<4Bihh20x", 3, 126, 1, 5, len(rows), 33 + 32 * len(names), 1 + sum(width.values())) + columns + b"\r" + table
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for end, content in ((".shp", head + records), (".dbf", dbf), (".prj", prj.encode())):
            archive.writestr(f"zones/taxi_zones{end}", content)
    return out.getvalue()
