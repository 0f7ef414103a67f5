"""Hourly segment features and comfort scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smoothway.operators.quantiles import exact_quantiles

KEYS = ("hour_us", "segment_id", "vehicle_profile_id")
RMS = ("accel_x", "accel_y", "accel_z", "jerk_x", "jerk_y", "jerk_z", "steering_rate", "steering_vibration")
P95 = ("accel_x", "accel_y", "accel_z", "jerk_x", "jerk_y", "jerk_z")
FLAGS = ("hard_accel", "hard_brake", "sharp_steer", "steer_reversal")

# Comfortable and uncomfortable ends of each feature, feature weights of each
# direction, least weight of present features, and the anchors' scale by upper speed.
ANCHORS = {
    "rms_accel_x": (0.0, 1.45), "rms_accel_y": (0.07, 1.1), "rms_accel_z": (0.14, 0.34),
    "p95_abs_accel_x": (0.0, 2.67), "p95_abs_accel_y": (0.35, 2.5), "p95_abs_accel_z": (0.23, 0.57),
    "rms_jerk_x": (0.0, 2.25), "rms_jerk_y": (0.47, 11.4), "rms_jerk_z": (1.08, 3.58),
    "p95_abs_jerk_x": (0.0, 3.15), "p95_abs_jerk_y": (1.5, 18.0), "p95_abs_jerk_z": (1.97, 6.39),
    "hard_brake_rate": (0.0, 1.0), "hard_accel_rate": (0.0, 1.0), "sharp_steer_rate": (0.0, 1.0),
    "steer_reversal_rate": (0.5, 2.0), "rms_steering_rate": (2.0, 86.0), "rms_steering_vibration": (0.08, 0.2),
}
DIRECTIONS = {
    "vertical_score": {"rms_accel_z": 0.35, "p95_abs_accel_z": 0.2, "rms_jerk_z": 0.2, "p95_abs_jerk_z": 0.15, "rms_steering_vibration": 0.1},
    "longitudinal_score": {"rms_accel_x": 0.25, "p95_abs_accel_x": 0.15, "rms_jerk_x": 0.2, "p95_abs_jerk_x": 0.15, "hard_brake_rate": 0.15, "hard_accel_rate": 0.1},
    "lateral_score": {"rms_accel_y": 0.25, "p95_abs_accel_y": 0.15, "rms_jerk_y": 0.15, "p95_abs_jerk_y": 0.1, "sharp_steer_rate": 0.15, "rms_steering_rate": 0.15, "steer_reversal_rate": 0.05},
}
LEAST_WEIGHT = 0.8
SPEED_SCALES = ((5.0, 0.9), (10.0, 1.0), (None, 1.1))


def statistics() -> list[Column]:
    """Mean speed, root mean squares, and 95th percentiles of absolute values."""
    rms = [F.sqrt(F.avg(F.col(c) * F.col(c))).alias(f"rms_{c}") for c in RMS]
    p95 = [F.percentile_approx(F.abs(c), 0.95, 10_000).alias(f"p95_abs_{c}") for c in P95]
    return [F.avg("speed").alias("mean_speed"), *rms, *p95]


def counts() -> list[Column]:
    """True flags (null counts as false) and samples."""
    return [*[F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(f"{c}_count") for c in FLAGS], F.count("*").alias("sample_count")]


def features(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """All statistics and counts of an hour, segment and profile, and its distinct trips.

    One scan and one shuffle: what a task sends for a key are sums, sketches and the set of its trips, of
    which a segment has no more than pass it in an hour.
    """
    return df.groupBy(*keys).agg(*statistics(), *counts(), F.size(F.collect_set("trip_id")).cast("long").alias("trip_count"))


def canonical(df: DataFrame, version: str, run: str, at_us: int) -> DataFrame:
    """The stored form of hourly features: the hour as its start and end, plain types, and where a row
    comes from (version of the features, run, time of processing in microseconds)."""
    start = F.timestamp_micros("hour_us")
    figures = ["mean_speed", *[f"rms_{c}" for c in RMS], *[f"p95_abs_{c}" for c in P95]]
    whole = [*[f"{c}_count" for c in FLAGS], "sample_count", "trip_count"]
    return df.select(
        F.col("segment_id").cast("string").alias("segment_id"),
        F.col("vehicle_profile_id").cast("int").alias("vehicle_profile_id"),
        start.alias("data_period_start"),
        (start + F.expr("INTERVAL 1 HOUR")).alias("data_period_end"),
        *[F.col(c).cast("double").alias(c) for c in figures],
        *[F.col(c).cast("long").alias(c) for c in whole],
        F.lit(version).alias("feature_version"),
        F.lit(run).alias("_run_id"),
        F.timestamp_micros(F.lit(at_us)).alias("processed_at"),
    )


def event_rates(df: DataFrame) -> DataFrame:
    """Events per trip; null without trips."""
    return df.withColumns({f"{c}_rate": F.when(F.col("trip_count") > 0, F.col(f"{c}_count") / F.col("trip_count")) for c in FLAGS})


def anchor_scale(speed: Column) -> Column:
    scale = F.lit(SPEED_SCALES[-1][1])
    for upper, value in reversed(SPEED_SCALES[:-1]):
        scale = F.when(speed < upper, value).otherwise(scale)
    return F.when(speed.isNotNull(), scale)


def direction_score(weights: dict[str, float]) -> Column:
    """100 * (1 - weighted mean penalty) over the features that are there; null below the least weight."""
    scale = F.col("_scale")
    penalties, present = F.lit(0.0), F.lit(0.0)
    for name, weight in weights.items():
        low, high = ANCHORS[name]
        ratio = (F.col(name) - low * scale) / ((high - low) * scale)
        penalty = F.when(F.col(name).isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), ratio)))
        penalties = penalties + F.coalesce(penalty * weight, F.lit(0.0))
        present = present + F.when(penalty.isNotNull(), F.lit(weight)).otherwise(0.0)
    return F.when(F.round(present, 9) >= LEAST_WEIGHT, F.round(100 * (1 - penalties / present), 6))


def scores(df: DataFrame) -> DataFrame:
    """Directional scores and why a row has none: the input is invalid, or too few features are there."""
    rated = event_rates(df).withColumn("_scale", anchor_scale(F.col("mean_speed")))
    scored = rated.withColumns({d: direction_score(w) for d, w in DIRECTIONS.items()})
    valid = F.coalesce((F.col("trip_count") > 0) & (F.col("sample_count") > 0) & (F.col("mean_speed") >= 0), F.lit(False))
    whole = F.coalesce(F.col("vertical_score") + F.col("longitudinal_score") + F.col("lateral_score"), F.lit(-1.0)) >= 0
    reason = F.when(~valid, "INVALID_SCORING_INPUT").when(~whole, "INSUFFICIENT_SCORING_FEATURES")
    return scored.withColumn("reject_reason", reason).drop("_scale")


def audit(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows, distinct keys, scored and rejected rows in one action."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count_distinct(F.struct(*key)).alias("keys"),
        F.count_if(F.col("reject_reason").isNull()).alias("scored"),
        F.count_if(F.col("reject_reason") == "INVALID_SCORING_INPUT").alias("invalid"),
        F.count_if(F.col("reject_reason") == "INSUFFICIENT_SCORING_FEATURES").alias("insufficient"),
    )


def distributions(df: DataFrame, names: list[str]) -> DataFrame:
    """Count, mean, least, greatest and exact quantiles of each named column, a row each; no task holds a column."""
    shares = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95)
    pairs = ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in names)
    long = df.selectExpr(f"stack({len(names)}, {pairs}) AS (name, amount)")
    plain = long.groupBy("name").agg(F.count("amount").alias("n"), F.avg("amount").alias("mean"), F.min("amount").alias("least"), F.max("amount").alias("greatest"))
    found = exact_quantiles(long, shares).groupBy("name").agg(*[F.max(F.when(F.col("share") == q, F.col("quantile"))).alias(f"q{round(q * 100)}") for q in shares])
    return plain.join(found, "name", "left")
