from pyspark.sql import functions as F

from smoothway.sources import partitions
from smoothway.streaming import raw


def test_an_hour_is_replaced_and_others_stay(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    rows = spark.createDataFrame([(1, "2026-01-05 03:10:00"), (2, "2026-01-05 04:10:00"), (3, "2026-01-06 00:00:00")], "id long, t string").withColumn("t", F.to_timestamp("t"))
    partitions.replace_hours(partitions.with_hours(rows, "t"), path)
    partitions.replace_hours(partitions.with_hours(rows.filter("id = 2").withColumn("id", F.lit(20).cast("long")), "t"), path)
    ids = lambda a, b: sorted(r["id"] for r in partitions.read_hours(spark, path, rows.schema, a, b).collect())
    assert ids("2026-01-05 03", "2026-01-05 05") == [1, 20]
    assert ids("2026-01-05 04", "2026-01-06 01") == [3, 20]
    assert partitions.read_hours(spark, path + "-none", rows.schema, "2026-01-05 00", "2026-01-06 00").count() == 0


def test_a_stream_loses_no_row(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ['{"event_time": "2026-01-05T03:10:00Z"}', "broken", '{"event_time": null}']
    spark.createDataFrame([(v, "2026-01-07 08:00:00") for v in lines], "value string, t string").selectExpr("value", "to_timestamp(t) AS timestamp").write.mode("append").parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("value string, timestamp timestamp").parquet(f"file://{tmp_path}/in")
    raw.into_hours(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/state").awaitTermination(120)
    found = spark.read.option("basePath", f"file://{tmp_path}/out").schema("value string, event_date string, hour string").parquet(f"file://{tmp_path}/out")
    assert sorted((r["event_date"], r["hour"]) for r in found.collect()) == [("2026-01-05", "03"), ("2026-01-07", "08"), ("2026-01-07", "08")]
