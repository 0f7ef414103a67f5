"""The raw event stream: envelopes of JSON text into hour partitions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from smoothway.sources.partitions import DATE, HOUR, with_hours


def envelopes(stream: DataFrame, time_field: str = "event_time") -> DataFrame:
    """value as text, its arrival time, and the hour of the event.

    stream has value (binary or text) and timestamp. A value that isn't JSON, or has no time that can
    be read, goes by its arrival, so no row is lost.
    """
    value = F.col("value").cast("string")
    told = F.try_to_timestamp(F.get_json_object(value, f"$.{time_field}"))
    rows = stream.select(value.alias("value"), "timestamp", F.coalesce(told, F.col("timestamp")).alias("_at"))
    return with_hours(rows, "_at").drop("_at")


def decoded(stream: DataFrame) -> DataFrame:
    """Key and value as text, with where and when they came."""
    return stream.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


def enriched(stream: DataFrame, schema: T.StructType, ingested: str = "timestamp", into: str = "_ingested_at") -> DataFrame:
    """Sound JSON is written anew with the fields of the schema and the time it came; all else stays word for word."""
    value = F.col("value").cast("string")
    fields = F.from_json(value, schema)
    whole = F.struct(*[fields[f.name].alias(f.name) for f in schema.fields], F.col(ingested).alias(into))
    return stream.withColumn("value", F.when(F.try_parse_json(value).isNotNull(), F.to_json(whole, {"ignoreNullFields": "false"})).otherwise(value))


def observed(stream: DataFrame, time: str, name: str = "events") -> DataFrame:
    """Each batch reports its rows and its latest event, to listeners and in the query's progress."""
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), F.max(time).alias("latest"))


def progress_figures(progress: dict, now_s: float, name: str = "events") -> dict[str, float | None]:
    """Figures of one batch from its progress: rows, rates, milliseconds, and lags in seconds and offsets."""
    seen = progress.get("observedMetrics", {}).get(name, {})
    offsets = [(s.get("endOffset"), s.get("latestOffset")) for s in progress.get("sources", [])]
    latest = seen.get("latest")
    if isinstance(latest, str):  # a time, as progress writes it
        latest = datetime.fromisoformat(latest).timestamp()
    total = lambda x: sum(map(total, x.values())) if isinstance(x, dict) else int(x)
    known = [(a, b) for a, b in offsets if isinstance(a, dict) and isinstance(b, dict)]
    return {
        "rows": progress.get("numInputRows"),
        "rows_per_second": progress.get("processedRowsPerSecond"),
        "batch_ms": progress.get("durationMs", {}).get("triggerExecution"),
        "event_lag_s": now_s - latest if latest is not None else None,
        "offset_lag": sum(total(b) - total(a) for a, b in known) if known else None,
        "end_offset": sum(total(a) for a, _ in known) if known else None,
    }


def source_options(least: int | None = None, most: int | None = None, delay: str | None = None) -> dict[str, str]:
    """Options that bound a batch of an offset source; the least needs the delay after which it is waived."""
    if (least is None) != (delay is None):
        raise ValueError("the least number of offsets and the delay go together")
    named = {"minOffsetsPerTrigger": least, "maxOffsetsPerTrigger": most, "maxTriggerDelay": delay}
    return {k: str(v) for k, v in named.items() if v}


def in_window(rows: DataFrame, first_us: int, end_us: int, arrived: str = "timestamp", time_field: str = "event_time") -> DataFrame:
    """Envelopes whose event lies in [first, end), microseconds; one without a readable time goes by its arrival."""
    told = F.try_to_timestamp(F.get_json_object(F.col("value").cast("string"), f"$.{time_field}"))
    at = F.unix_micros(F.coalesce(told, F.col(arrived)))
    return rows.filter((at >= first_us) & (at < end_us))


def windowed_counts(stream: DataFrame, time: str, keys: list[str], window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by window and keys; rows that come later than the watermark allows are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("window"), *keys).agg(F.count("*").alias("n"))


def into_hours(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, files: int | None = None) -> StreamingQuery:
    """Append envelopes to the table at path, cut by hour; the checkpoint makes each file count once.

    files bounds the files of an hour that a batch writes: its rows are dealt to so many tasks at most, other
    hours to other tasks. Late rows go to the hour of their event, which readers filter by time again.
    """
    rows = envelopes(stream)
    if files:
        rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), DATE, HOUR, F.pmod(F.xxhash64("value", "timestamp"), F.lit(files)))
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy(DATE, HOUR).outputMode("append").trigger(**(trigger or {"availableNow": True})).start(path)


def into_lines(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Publish each batch as JSON lines in a folder of its own, so that a batch that runs again replaces itself.

    Null fields are written out, as consumers expect all of them.
    """

    def publish(batch: DataFrame, number: int) -> None:
        batch.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
