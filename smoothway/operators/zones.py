"""Zone profiles, origin-destination priorities and trip sampling."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOUR_US = 3_600_000_000


def valid_trips(df: DataFrame) -> DataFrame:
    """Trips with all fields, request <= pickup < drop-off and finite miles above 0."""
    whole = F.lit(True)
    for c in ("trip_id", "pickup_zone", "dropoff_zone", "request_us", "pickup_us", "dropoff_us", "miles"):
        whole = whole & F.col(c).isNotNull()
    finite = ~F.isnan("miles") & (F.col("miles") < float("inf"))
    return df.filter(whole & (F.col("request_us") <= F.col("pickup_us")) & (F.col("pickup_us") < F.col("dropoff_us")) & (F.col("miles") > 0) & finite)


def od_counts(trips: DataFrame) -> DataFrame:
    """Trips of each pair of zones over months, with the months in which there were some."""
    monthly = trips.groupBy("month", "pickup_zone", "dropoff_zone").agg(F.count("*").alias("n"))
    return monthly.groupBy("pickup_zone", "dropoff_zone").agg(F.sum("n").alias("trips"), F.count("*").alias("months"))


def od_statistics(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_zone", "dropoff_zone").agg(F.count("*").alias("trips"), F.median("miles").alias("median_miles"))


def percent_rank_average(df: DataFrame, column: str, into: str, positive_only: bool = False, pieces: int = 32) -> DataFrame:
    """Rank as a share of the ranked rows, ties at their mean rank; zeros stay 0 where asked for.

    Ranks come from counts of equal values. These are cut into ranges of values, summed up inside
    each, and shifted by the sums of the ranges before, so no task holds all distinct values.
    """
    ranked = df.filter(F.col(column) > 0) if positive_only else df.filter(F.col(column).isNotNull())
    counts = ranked.groupBy(F.col(column).alias("_v")).agg(F.count("*").alias("_n"))
    cuts = F.broadcast(counts.agg(F.percentile_approx("_v", [k / pieces for k in range(1, pieces)], 20 * pieces).alias("_cuts")))  # one row
    piece = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_v"))), F.lit(0))
    cut = counts.crossJoin(cuts).withColumn("_piece", piece).drop("_cuts")
    sums = cut.groupBy("_piece").agg(F.sum("_n").alias("_in"))  # at most as many rows as pieces
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = F.broadcast(sums.select("_piece", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_shift"), F.sum("_in").over(Window.partitionBy()).alias("_all")))
    running = Window.partitionBy("_piece").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranks = cut.join(shifts, "_piece").select("_v", ((F.col("_shift") + F.sum("_n").over(running) - (F.col("_n") - 1) / 2) / F.col("_all")).alias("_rank"))
    joined = df.join(ranks, F.col(column) == F.col("_v"), "left")
    value = F.when(F.col(column) == 0, F.lit(0.0)).otherwise(F.col("_rank")) if positive_only else F.col("_rank")
    return joined.withColumn(into, value).drop("_v", "_rank")


def priorities(od: DataFrame, relevance: DataFrame) -> DataFrame:
    """Demand rank times the mean relevance of both zones; pairs with an unknown zone are left out."""
    r = relevance.select("location_id", "relevance")
    joined = od.join(r.withColumnsRenamed({"location_id": "pickup_zone", "relevance": "_from"}), "pickup_zone").join(r.withColumnsRenamed({"location_id": "dropoff_zone", "relevance": "_to"}), "dropoff_zone")
    demand = percent_rank_average(joined, "trips", "demand")
    return demand.withColumn("priority", F.col("demand") * (F.col("_from") + F.col("_to")) / 2).drop("_from", "_to")


def top(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first n rows in an order, numbered from 1."""
    best = df.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def hours_touched(trips: DataFrame) -> DataFrame:
    """A row for each hour that a trip overlaps, with the overlap in seconds."""
    first, last = F.floor(F.col("pickup_us") / HOUR_US), F.floor((F.col("dropoff_us") - 1) / HOUR_US)
    each = trips.select("*", F.explode(F.sequence(first, last)).alias("hour"))
    begin, end = F.greatest(F.col("pickup_us"), F.col("hour") * HOUR_US), F.least(F.col("dropoff_us"), (F.col("hour") + 1) * HOUR_US)
    return each.withColumn("seconds", (end - begin) / F.lit(1e6))


def expected_events(trips: DataFrame, hertz: int = 10) -> DataFrame:
    """Events that each hour's trips would send: seconds times hertz, and one to close each trip."""
    each = hours_touched(trips)
    closing = (F.floor((F.col("dropoff_us") - 1) / HOUR_US) == F.col("hour")).cast("long")
    return each.groupBy("hour").agg(F.sum(F.floor(F.col("seconds") * hertz).cast("long") + closing).alias("events"))


def sampling_plan(events: DataFrame, target: int) -> DataFrame:
    """Share of trips to keep by hour: the target over the mean hour, less where an hour has more."""
    base = F.least(F.lit(1.0), F.lit(float(target)) / F.avg("events").over(Window.partitionBy(F.lit(1))))
    return events.withColumn("keep", F.least(base, F.lit(float(target)) / F.col("events"))).withColumn("expected", F.col("keep") * F.col("events"))


def keep_probability(trips: DataFrame, plan: DataFrame) -> DataFrame:
    """The least share of the hours that a trip touches."""
    return hours_touched(trips).join(plan.select("hour", "keep"), "hour").groupBy("trip_id").agg(F.min("keep").alias("probability"))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is 0 or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def category_pivot(df: DataFrame, key: str, category: str, names: list[str], all_keys: DataFrame) -> DataFrame:
    """Counts of each named category by key, 0 where there is none, for all keys."""
    counted = df.groupBy(key).pivot(category, names).agg(F.count(F.lit(1)))
    return all_keys.join(counted, key, "left").fillna(0, names)


def weighted_score(weights: dict[str, float], least: float = 0.7) -> Column:
    """Weighted mean of the columns that are there; null if they weigh less than the given share."""
    present, total = F.lit(0.0), F.lit(0.0)
    for c, w in weights.items():
        present = present + F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(0.0)
        total = total + F.coalesce(F.col(c) * w, F.lit(0.0))
    return F.when(F.round(present / sum(weights.values()), 9) >= least, F.try_divide(total, present))


def top_categories(columns: list[str], n: int = 2) -> Column:
    """Names of the n greatest columns of a row, ties by name; nulls don't count."""
    pairs = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct((-F.col(c)).alias("v"), F.lit(c).alias("name"))) for c in columns]))
    return F.transform(F.slice(F.array_sort(pairs), 1, n), lambda p: p["name"])


def keyword_categories(text: Column, patterns: dict[str, str]) -> Column:
    """Names of all patterns found in a text, in lower case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(n)) for n, p in patterns.items()]))


def representative(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the least order value of each key; blank keys are dropped."""
    kept = df.filter(F.length(F.trim(key)) > 0)
    return kept.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("_rank = 1").drop("_rank")


def stable_share(key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on the key and salt only."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(salt), key), 256), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def interval_join(inner: DataFrame, outer: DataFrame, at: str, start: str, end: str, size: int) -> DataFrame:
    """Rows of inner with the outer interval [start, end] that holds them, by buckets of a size."""
    wide = outer.select("*", F.explode(F.sequence(F.floor(F.col(start) / size), F.floor(F.col(end) / size))).alias("_b"))
    here = inner.withColumn("_a", F.floor(F.col(at) / size))
    return here.join(wide, (F.col("_a") == F.col("_b")) & (F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end)), "left").drop("_a", "_b")


def concurrency(df: DataFrame, start: str, end: str, bucket: int) -> DataFrame:
    """Work in each bucket of time: how much of the intervals lies in it."""
    each = df.filter(F.col(end) > F.col(start)).select("*", F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor((F.col(end) - 1) / bucket))).alias("bucket"))
    overlap = F.least(F.col(end), (F.col("bucket") + 1) * bucket) - F.greatest(F.col(start), F.col("bucket") * bucket)
    return each.groupBy("bucket").agg(F.sum(overlap).alias("busy"), F.count("*").alias("tasks"))


@F.pandas_udf(T.StringType())
def digits17(values: pd.Series) -> pd.Series:
    """A number in 17 significant digits, without trailing zeros, as C's %.17g writes it."""
    return values.map(lambda v: None if v != v else format(v, ".17g"))


def iso_time(time: Column) -> Column:
    """A time as 2026-01-05T12:00:00, with six places of a second only where it has a fraction."""
    fraction = F.unix_micros(time) % 1_000_000
    return F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction == 0, "").otherwise(F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))))


def stable_trip_id(version: str, row: str, times: list[str], zones: list[str], miles: str) -> Column:
    """The first 24 hexadecimal digits of a hash over what makes a trip: its reader's version, its row in the
    file, its times, its zones and its length."""
    parts = [F.lit(version), F.col(row).cast("string"), *map(iso_time, map(F.col, times)), *[F.col(z).cast("string") for z in zones], digits17(F.col(miles))]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 24)
