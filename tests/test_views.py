"""Views of rows that the small tables lack, in Spark and in the oracle."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from smoothway.operators import profiles
from smoothway.plans import catalog
from smoothway.plans.adapters import spark_view
from tests.compare import assert_same


def test_miles_are_rounded_as_in_the_sql(spark, duck, tmp_path):
    """0.145 and such are a little less than they look, so times 100 they lie below a half."""
    rows = duck.execute("SELECT * REPLACE (o_orderkey * 53 + 1 AS o_orderkey, CAST(o_orderkey * 100 AS DOUBLE) AS o_totalprice) FROM orders").to_arrow_table()
    pq.write_table(rows, tmp_path / "orders.parquet")
    assert spark_view(spark, str(tmp_path), "trips").filter("trip_id = 53 * 29 + 1").first()["miles"] == 0.14
    inner = duck.cursor()
    inner.execute(f"CREATE TEMP VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet')")
    for name in ("m28_stable_trip_ids", "f13_valid_trips"):
        assert_same(catalog.QUERIES[name](spark, str(tmp_path)), inner, catalog.ORACLES[name])


def test_of_builds_written_at_the_same_time_the_first_is_used(spark, duck, tmp_path):
    """Month, day and time of writing repeat each 4,202,940 keys; of such builds the SQL finds the first row, which has the least id."""
    rows = duck.execute("SELECT * REPLACE (o_orderkey + 4202940 * n AS o_orderkey) FROM orders, range(3) r(n) ORDER BY o_orderkey").to_arrow_table()
    pq.write_table(rows, tmp_path / "orders.parquet")
    inner = duck.cursor()
    inner.execute(f"CREATE TEMP VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet')")
    assert_same(catalog.QUERIES["t7_newest_build"](spark, str(tmp_path)), inner, catalog.ORACLES["t7_newest_build"])
    builds = spark_view(spark, str(tmp_path), "builds")
    last = spark.createDataFrame(builds.orderBy(F.desc("build_id")).collect(), builds.schema).coalesce(1)  # the least id comes last
    assert profiles.newest_build(last, 17).first() == profiles.newest_build(builds, 17).first()
    assert profiles.newest_build(last, 17).first()["build_id"] < 4202940
