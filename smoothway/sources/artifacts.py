"""Versioned artifacts behind a pointer, and the runtime road environment that is read through it.

`active.json` names a manifest; the manifest names artifacts by their role, each with its place, rows,
snapshot date and checksum. Nothing is read that its manifest doesn't vouch for.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smoothway.sources.publish import put_text, read_text

POINTER, ROLE = "active.json", "enriched_segment_reference"
#: What a number looks like in well-known text.
NUMBER = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"


def checksum(table: DataFrame) -> str:
    """A sum over hashes of all rows: the same for the same rows in any order and number of files."""
    total = table.agg(F.sum(F.xxhash64(*[F.coalesce(F.to_json(F.struct(c)), F.lit("")) for c in sorted(table.columns)]).cast("decimal(38,0)"))).first()[0]
    return str(total or 0)


def publish_artifacts(root: str, tables: dict[str, DataFrame], snapshot_date: str) -> str:
    """Write tables (by role) as a build of its own under the snapshot date, read them back, and point to them."""
    spark = next(iter(tables.values())).sparkSession
    build, listed = uuid.uuid4().hex, []
    for role, table in tables.items():
        uri = f"{root}/reference_date={snapshot_date}/build_id={build}/{role}"
        table.write.mode("error").parquet(uri)
        back = spark.read.schema(table.schema).parquet(uri)
        listed.append({"role": role, "uri": uri, "rows": back.count(), "checksum": checksum(back)})
    manifest = f"{root}/reference_date={snapshot_date}/build_id={build}/manifest.json"
    put_text(spark, manifest, json.dumps({"snapshot_date": snapshot_date, "artifacts": listed}, sort_keys=True))
    put_text(spark, f"{root}/{POINTER}", json.dumps({"manifest_uri": manifest}))
    return manifest


def resolve(spark: SparkSession, root: str, role: str = ROLE) -> dict:
    """The manifest's entry for a role, by way of the pointer; ValueError where any link is missing."""
    manifest_uri = json.loads(read_text(spark, f"{root}/{POINTER}")).get("manifest_uri")
    if not manifest_uri:
        raise ValueError(f"{root}/{POINTER} names no manifest")
    manifest = json.loads(read_text(spark, manifest_uri))
    found = next((a for a in manifest.get("artifacts", ()) if a.get("role") == role), None)
    if not found or not found.get("uri"):
        raise ValueError(f"{manifest_uri} has no artifact {role} with a place")
    return found | {"snapshot_date": manifest.get("snapshot_date")}


def read_artifact(spark: SparkSession, root: str, role: str = ROLE, columns: list[str] | None = None, verified: bool = True) -> DataFrame:
    """The artifact of a role, only the named columns.

    Its path must carry the manifest's snapshot date, and it must have the rows and, if verified, the
    checksum that the manifest says (one pass over all columns).
    """
    found = resolve(spark, root, role)
    if f"/reference_date={found['snapshot_date']}/" not in found["uri"]:
        raise ValueError(f"the path of {role} isn't of the date {found['snapshot_date']}")
    table = spark.read.parquet(found["uri"])
    missing = sorted(set(columns or ()) - set(table.columns))
    if missing:
        raise ValueError(f"{role} lacks {', '.join(missing)}")
    if verified and (table.count() != found["rows"] or checksum(table) != found["checksum"]):
        raise ValueError(f"{role} isn't what its manifest says")
    return table.select(*columns) if columns else table


def segment_universe(spark: SparkSession, root: str) -> DataFrame:
    """All segment ids of the active environment."""
    return read_artifact(spark, root, ROLE, ["segment_id"]).distinct()


def wkt_points(text: Column, kind: str = "LINESTRING") -> Column:
    """The points of a line string, or of the one ring of a polygon, in well-known text; null for anything else."""
    pair = rf"\s*{NUMBER}\s+{NUMBER}\s*"
    inner = rf"\(({pair}(?:,{pair})*)\)"
    whole = rf"^\s*{kind}\s*{inner if kind == 'LINESTRING' else rf'[(]\s*{inner}\s*[)]'}\s*$"
    body = F.regexp_extract(F.upper(text), whole, 1)
    points = F.transform(F.split(body, ","), lambda p: F.split(F.trim(p), r"\s+"))
    return F.when(body != "", F.transform(points, lambda p: F.struct(F.get(p, F.lit(0)).cast("double").alias("x"), F.get(p, F.lit(1)).cast("double").alias("y"))))


def hump_shares(text: Column) -> Column:
    """A JSON list of shares from 0 to 1 as numbers; null if it is anything else."""
    values = F.from_json(text, "array<double>", {"mode": "PERMISSIVE"})
    sound = text.rlike(rf"^\s*\[\s*(?:{NUMBER}\s*(?:,\s*{NUMBER}\s*)*)?\]\s*$") & F.forall(values, lambda v: v.between(0, 1))
    return F.when(F.coalesce(sound, F.lit(False)), values)


def runtime_violations(roads: DataFrame) -> DataFrame:
    """What a runtime environment must not have, in one row of counts."""
    again = roads.groupBy("segment_id").agg(F.count("*").alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated_ids"))
    line = wkt_points(F.col("geometry_wkt"))
    bad = roads.agg(
        (F.count("*") == 0).cast("long").alias("empty"),
        F.greatest(F.count_distinct("road_snapshot_date") - 1, F.lit(0)).alias("further_dates"),
        F.count_if(F.coalesce(F.size(line) < 2, F.lit(True)) | line.isNull()).alias("broken_lines"),
        F.count_if(hump_shares(F.col("hump_fractions_json")).isNull()).alias("broken_humps"),
    )
    return bad.crossJoin(again)  # a row each


def runtime_roads(roads: DataFrame) -> DataFrame:
    """Runtime rows with their line and humps read; rows that runtime_violations counts are left out."""
    read = roads.withColumns({"line": wkt_points(F.col("geometry_wkt")), "hump_fractions": hump_shares(F.col("hump_fractions_json"))})
    return read.filter((F.size("line") > 1) & F.col("hump_fractions").isNotNull()).drop("geometry_wkt", "hump_fractions_json")
