"""Answers for single segments, batches and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smoothway.operators.quantiles import exact_quantiles

# Share of the worst segments of a route, and the mix of mean and worst mean.
WORST_SHARE, MEAN_WEIGHT, WORST_WEIGHT = 0.25, 0.7, 0.3


def lookup(requested: DataFrame, current: DataFrame, standard: DataFrame) -> DataFrame:
    """Scores of the requested segments: the current one, else the standard one, and which it is."""
    c = current.select("segment_id", F.col("comfort_score").alias("_current"))
    s = standard.select("segment_id", F.col("comfort_score").alias("_standard"))
    both = requested.join(c, "segment_id", "left").join(s, "segment_id", "left")
    source = F.when(F.col("_current").isNotNull(), "current").when(F.col("_standard").isNotNull(), "standard")
    return both.select("segment_id", F.coalesce("_current", "_standard").alias("comfort_score"), source.alias("source"))


def not_found(requested: DataFrame, known: DataFrame) -> DataFrame:
    return requested.join(known, "segment_id", "left_anti").select("segment_id").distinct()


def profile_or_any(requested: DataFrame, active: DataFrame) -> DataFrame:
    """The requested profile if it is active, else profile 0."""
    known = active.select(F.col("vehicle_profile_id").alias("_known")).distinct()
    found = requested.join(known, F.col("vehicle_profile_id") == F.col("_known"), "left")
    return found.select("*", F.coalesce("_known", F.lit(0)).alias("resolved_profile_id")).drop("_known")


def route_scores(routes: DataFrame, scores: DataFrame) -> DataFrame:
    """Mean, mean of the worst quarter (one segment at least) and their mix, to two places.

    A segment counts each time that a route takes it. Routes with a segment that has no score are
    left out.
    """
    joined = routes.join(scores.select("segment_id", "comfort_score"), "segment_id", "left")
    order = Window.partitionBy("route_id").orderBy(F.asc_nulls_last("comfort_score"), "position")
    ranked = joined.withColumns({"_rank": F.row_number().over(order), "_n": F.count("*").over(Window.partitionBy("route_id"))})
    worst = F.greatest(F.lit(1), F.ceil(F.col("_n") * WORST_SHARE))
    made = ranked.groupBy("route_id").agg(
        F.count("*").alias("segments"),
        F.count("comfort_score").alias("_scored"),
        F.avg("comfort_score").alias("_mean"),
        F.avg(F.when(F.col("_rank") <= worst, F.col("comfort_score"))).alias("_worst"),
    )
    kept = made.filter(F.col("segments") == F.col("_scored"))
    return kept.select("route_id", "segments", F.round("_mean", 2).alias("mean_score"), F.round("_worst", 2).alias("worst_score"), F.round(MEAN_WEIGHT * F.col("_mean") + WORST_WEIGHT * F.col("_worst"), 2).alias("score"))


def ranked(scored: DataFrame, group: str) -> DataFrame:
    """Routes of a request by score, the first recommended; ties keep the order of ids."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("score"), "route_id"))
    return scored.withColumn("rank", rank).withColumn("recommended", F.col("rank") == 1)


def in_order_once(df: DataFrame, key: str, item: str, position: str) -> DataFrame:
    """Items of each key once, at their first position; ties go by the items themselves."""
    first = df.groupBy(key, item).agg(F.min(position).alias("_first"))
    return first.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy("_first", item))).drop("_first")


def colour(score: Column) -> Column:
    return F.when(score.isNull(), "gray").when(score >= 80, "green").when(score >= 60, "yellow").otherwise("red")


def latest_only(df: DataFrame, key: list[str], time: str) -> DataFrame:
    """Rows of the latest time of their key; all of them if several have it."""
    latest = df.groupBy(*key).agg(F.max(time).alias("_latest"))
    return df.join(latest, key).filter(F.col(time) == F.col("_latest")).drop("_latest")


def is_version(text: Column) -> Column:
    """Whether a text is three numbers without leading zeros, with dots between."""
    return text.rlike(r"^(0|[1-9][0-9]*)(\.(0|[1-9][0-9]*)){2}$")


def is_run_id(text: Column) -> Column:
    """Whether a text may be part of a path: letters, digits and _ . : + - alone."""
    return text.rlike(r"^[A-Za-z0-9_.:+-]+\z")


def with_window(df: DataFrame, first_us: int, as_of_us: int) -> DataFrame:
    """The batch's window where a row has no period of its own, and the time that it holds for."""
    return df.withColumns({"first_us": F.coalesce("first_us", F.lit(first_us)), "as_of_us": F.lit(as_of_us)})


def percentiles(df: DataFrame, key: str, value: str, shares: dict[str, float], places: int) -> DataFrame:
    """Exact percentiles between neighbours, rounded half to even; no task holds all values of a key."""
    found = exact_quantiles(df, tuple(shares.values()), key, value)
    return found.groupBy(key).agg(*[F.bround(F.max(F.when(F.col("share") == p, F.col("quantile"))), places).alias(n) for n, p in shares.items()])
