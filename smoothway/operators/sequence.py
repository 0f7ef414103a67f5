"""Sequences inside a trip: steering rates and reversals, driving episodes. One shuffle by trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def trip() -> WindowSpec:
    """Rows of a trip in order."""
    return Window.partitionBy("trip_id").orderBy("trip_seq", "event_us", "event_id")


def steering_rate(df: DataFrame, max_gap_s: float = 0.5) -> DataFrame:
    """Change of the steering angle per second; null over a gap, out of order or where an angle is null."""
    seconds = (F.col("event_us") - F.lag("event_us").over(trip())) / F.lit(1e6)
    rate = (F.col("steering_angle") - F.lag("steering_angle").over(trip())) / seconds
    return df.withColumn("_s", seconds).withColumn("steering_rate", F.when((F.col("_s") > 0) & (F.col("_s") <= max_gap_s), rate)).drop("_s")


def steering_reversal(df: DataFrame, deadband: float = 10.0) -> DataFrame:
    """Whether the rate's sign differs from the last one outside the deadband, gaps apart."""
    sign = F.when(F.abs("steering_rate") > deadband, F.signum("steering_rate"))
    marked = df.withColumn("_run", F.sum(F.col("steering_rate").isNull().cast("int")).over(trip().rowsBetween(Window.unboundedPreceding, 0))).withColumn("_sign", sign)
    run = Window.partitionBy("trip_id", "_run").orderBy("trip_seq", "event_us", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last("_sign", ignorenulls=True).over(run)
    return marked.withColumn("steering_reversal", F.coalesce(F.col("_sign") != last, F.lit(False))).drop("_run", "_sign")


def episodes(df: DataFrame, conditions: dict[str, tuple[Column, float]], max_gap_s: float = 0.5) -> DataFrame:
    """For each name: whether a run of rows that fulfil its condition starts here and lasts long enough.

    A run ends where the condition flips or the gap to the row before is not in (0, max_gap_s].
    """
    gap = F.col("event_us") - F.lag("event_us").over(trip())
    broken = F.coalesce((gap <= 0) | (gap > int(max_gap_s * 1e6)), F.lit(True))
    out = df.withColumn("_broken", broken).withColumns({f"_is_{n}": F.coalesce(c, F.lit(False)) for n, (c, _) in conditions.items()})
    out = out.withColumns({f"_new_{n}": F.col("_broken") | (F.col(f"_is_{n}") != F.lag(f"_is_{n}").over(trip())) for n in conditions})
    out = out.withColumns({f"_run_{n}": F.sum(F.col(f"_new_{n}").cast("int")).over(trip().rowsBetween(Window.unboundedPreceding, 0)) for n in conditions})
    for n, (_, least) in conditions.items():
        run = Window.partitionBy("trip_id", f"_run_{n}")
        lasts = F.max("event_us").over(run) - F.min("event_us").over(run)
        out = out.withColumn(n, F.col(f"_is_{n}") & F.col(f"_new_{n}") & (lasts >= int(least * 1e6)))
    return out.drop("_broken", *[f"{p}{n}" for n in conditions for p in ("_is_", "_new_", "_run_")])


def driving_features(df: DataFrame) -> DataFrame:
    """Rates, reversals and the three kinds of episodes with their fixed thresholds."""
    with_rate = steering_reversal(steering_rate(df))
    return episodes(
        with_rate,
        {
            "hard_accel": (F.col("accel_x") >= 3.0, 0.3),
            "hard_brake": (F.col("accel_x") <= -3.0, 0.3),
            "sharp_steer": (F.abs("steering_rate") >= 100.0, 0.3),
        },
    )


def gaps_between(df: DataFrame, key: str, order_by: list[str], start: str, end: str) -> DataFrame:
    """Time between the end of a row and the start of the next of the same key."""
    order = Window.partitionBy(key).orderBy(*order_by)
    return df.withColumn("wait", F.lead(start).over(order) - F.col(end))


def out_of_order(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Keys in which a value falls below the one before it."""
    step = F.col(value) < F.lag(value).over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_fell", step).groupBy(key).agg(F.count_if("_fell").alias("falls")).filter("falls > 0")
