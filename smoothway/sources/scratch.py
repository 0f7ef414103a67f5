"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; without it, on one machine, one in the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = spark.conf.get("spark.sql.warehouse.dir") + "/_smoothway"
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no table has yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet and read it back: lineage ends there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.written_at = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete written tables from which all that is needed has been written in turn."""
    for table in tables:
        spark = table.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(table.written_at)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
