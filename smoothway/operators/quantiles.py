"""Exact quantiles of columns of any length: no task ever holds a column, or all rows of one value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smoothway.sources.scratch import written


def exact_quantiles(rows: DataFrame, shares: tuple[float, ...], key: str = "name", amount: str = "amount") -> DataFrame:
    """Quantiles of each key's amounts, with linear interpolation between neighbours: (key, share, quantile).

    Nulls don't count; a key without amounts has no row. Equal amounts are counted in the tasks before they
    are dealt, so a frequent value is one row. Values are then dealt by ranges, counted range by range, and
    each order statistic is looked up in the one range that holds it.
    """
    counted = rows.select(F.col(key).alias("k"), F.col(amount).cast("double").alias("v")).filter("v is not null").groupBy("k", "v").agg(F.count("*").alias("n"))
    dealt = written(counted.repartitionByRange("k", "v").withColumn("part", F.spark_partition_id()), "values")
    parts = dealt.groupBy("k", "part").agg(F.sum("n").alias("held"))  # a row for each range of a key
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumns({"before": F.coalesce(F.sum("held").over(before), F.lit(0)), "total": F.sum("held").over(Window.partitionBy("k"))})
    asked = placed.select("k", "total").distinct().withColumn("share", F.explode(F.array(*map(F.lit, shares)))).withColumn("place", F.col("share") * (F.col("total") - 1))
    ranks = asked.select("k", "share", "place", F.explode(F.array(F.floor("place"), F.ceil("place"))).alias("rank")).distinct()
    # which range holds a rank, and only then which value: the ranges that hold none aren't sorted
    due = ranks.join(placed, "k").filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("held"))).select("k", "share", "place", "rank", "part", "before")
    some = dealt.join(due.select("k", "part", "before").distinct(), ["k", "part"])
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("k", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranged = some.withColumn("upto", upto).select("k", "part", "v", "upto", (F.col("upto") - F.col("n")).alias("from"))
    met = due.join(ranged, ["k", "part"]).filter((F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("upto")))
    ends = met.groupBy("k", "share").agg(F.min_by("v", "rank").alias("low"), F.max_by("v", "rank").alias("high"), F.first("place").alias("place"))
    value = F.col("low") + (F.col("high") - F.col("low")) * (F.col("place") - F.floor("place"))
    return ends.select(F.col("k").alias(key), "share", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(value).alias("quantile"))
