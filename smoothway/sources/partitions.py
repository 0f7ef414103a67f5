"""Tables cut into hours: pruned reads, writes that replace whole hours, compaction."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE, HOUR = "event_date", "hour"


def with_hours(df: DataFrame, time: str) -> DataFrame:
    """Add the partition columns of a UTC time: date as yyyy-MM-dd, hour as two digits."""
    return df.withColumns({DATE: F.date_format(time, "yyyy-MM-dd"), HOUR: F.date_format(time, "HH")})


def read_hours(spark: SparkSession, path: str, schema: T.StructType, first: str, end: str) -> DataFrame:
    """Rows of [first, end), two times as text, UTC, on whole hours; only their partitions are listed in the scan.

    schema is that of the rows without the partition columns. A table that isn't there has no rows.
    """
    whole = T.StructType([*schema.fields, T.StructField(DATE, T.StringType()), T.StructField(HOUR, T.StringType())])
    try:
        found = spark.read.schema(whole).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)
    at = F.concat_ws(" ", DATE, HOUR)
    within = (F.col(DATE) >= first[:10]) & (F.col(DATE) <= end[:10])
    return found.filter(within & (at >= first[:13].replace("T", " ")) & (at < end[:13].replace("T", " ")))


def replace_hours(df: DataFrame, path: str, may_be_empty: bool = True) -> None:
    """Write df so that each hour in it replaces that hour of the table; other hours stay.

    Spark stages the files and moves them when all tasks have ended, so a lost executor leaves the
    table as it was. An empty df replaces nothing; it is an error if it may not be empty.
    """
    if not may_be_empty and df.isEmpty():
        raise ValueError("no rows to write")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE, HOUR).parquet(path)
