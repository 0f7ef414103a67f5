"""Guards and audits: each is one row of counts, or the rows that break a rule, never a failed job.

Where a caller must stop, `refuse` turns the counts into an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smoothway.operators.polygons import nearest_on_ring
from smoothway.operators.spatial import inside_polygon

# Seconds that a table may be old, share of quarantined rows, and limits of a request.
MOST_AGE_S, MOST_QUARANTINED = 10_800, 0.1
MOST_ROUTES, MOST_SEGMENTS, MOST_BATCH = 10, 300, 1_000
RESERVED_PROFILE = 0


def count_where(**rules: Column) -> list[Column]:
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()]


def refuse(counts: DataFrame, *allowed: str) -> None:
    """Raise if any count but the allowed ones isn't 0; counts is one row."""
    bad = {k: v for k, v in counts.first().asDict().items() if k not in allowed and v}
    if bad:
        raise ValueError(f"broken: {bad}")


def freshness_and_orphans(table: DataFrame, profiles: DataFrame, now_us: int, time: str) -> DataFrame:
    """Age of the newest row in seconds, and rows whose profile is unknown."""
    orphans = table.join(F.broadcast(profiles.select("vehicle_profile_id").distinct()), "vehicle_profile_id", "left_anti").agg(F.count("*").alias("orphan_profiles"))
    age = table.agg(((F.lit(now_us) - F.max(time)) / 1e6).alias("age_seconds"))
    return age.crossJoin(orphans).withColumn("passed", F.coalesce((F.col("age_seconds") <= MOST_AGE_S) & (F.col("orphan_profiles") == 0), F.lit(False)))


def match_rates(table: DataFrame, columns: dict[str, float]) -> DataFrame:
    """Of each named column the share of rows that have it, and whether that reaches its least share."""
    one = table.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`, CAST({least} AS DOUBLE)" for c, least in columns.items())
    return one.selectExpr(f"stack({len(columns)}, {pairs}) AS (name, rate, least)").select("name", "rate", F.coalesce(F.col("rate") >= F.col("least"), F.lit(False)).alias("passed"))


def environment_guard(table: DataFrame, key: str, rating: str) -> DataFrame:
    """Rows, ids that occur more than once, ratings outside (0, 10]."""
    each = table.groupBy(key).agg(F.count("*").alias("_n"), F.count_if((F.col(rating) <= 0) | (F.col(rating) > 10)).alias("_bad"))
    return each.agg((F.coalesce(F.sum("_n"), F.lit(0)) == 0).cast("long").alias("empty"), F.count_if(F.col("_n") > 1).alias("repeated_ids"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("ratings_out_of_range"))


def reference_guard(roads: DataFrame, key: str, date: str, shape: str) -> DataFrame:
    """Whether there are rows, of one snapshot date, each with an id and a shape."""
    return roads.agg((F.count("*") == 0).cast("long").alias("empty"), F.greatest(F.count_distinct(date) - 1, F.lit(0)).alias("further_dates"), *count_where(no_id=F.col(key).isNull(), no_shape=F.col(shape).isNull()))


def staging_guard(table: DataFrame, key: list[str], scores: list[str]) -> DataFrame:
    """Rows of repeated keys and scores that are no finite number."""
    odd = F.lit(False)
    for c in scores:
        odd = odd | F.isnan(c) | (F.abs(c) == float("inf"))
    each = table.groupBy(*key).agg(F.count("*").alias("_n"), F.count_if(F.coalesce(odd, F.lit(False))).alias("_odd"))
    return each.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated_rows"), F.coalesce(F.sum("_odd"), F.lit(0)).alias("not_finite"))


def universe_guard(hours: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows of the reserved profile, and rows of segments that the universe doesn't have."""
    reserved = hours.agg(*count_where(reserved=F.col("vehicle_profile_id") == RESERVED_PROFILE))
    unknown = hours.join(segments.select("segment_id").distinct(), "segment_id", "left_anti").agg(F.count("*").alias("unknown"))
    return reserved.crossJoin(unknown)


def single_value_guard(table: DataFrame, column: str) -> DataFrame:
    """Rows that haven't the least value of a column, as where one hour or snapshot date is allowed."""
    least = F.broadcast(table.agg(F.min(column).alias("_least")))  # one row
    return table.crossJoin(least).agg(F.count_if(~F.col(column).eqNullSafe(F.col("_least"))).alias("others"))


def one_scan_validation(table: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """Rows, repeated keys, and rows that break each rule (a null condition doesn't)."""
    each = table.groupBy(*key).agg(F.count("*").alias("_n"), *[F.count_if(~c).alias(n) for n, c in rules.items()])
    return each.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(F.col("_n") > 1).alias("repeated_keys"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in rules])


def gate(table: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Whether a partition or snapshot may be used: it has rows and none breaks a rule."""
    counted = table.agg(F.count("*").alias("rows"), *[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    broken = sum((F.col(n) for n in rules), F.lit(0))
    return counted.withColumn("passed", (F.col("rows") > 0) & (broken == 0))


def snapshot_audit(table: DataFrame, column: str, value) -> DataFrame:
    """Rows, and rows of another as-of."""
    return table.agg(F.count("*").alias("rows"), F.count_if(~F.col(column).eqNullSafe(F.lit(value))).alias("mismatched"))


def quarantine_rates(table: DataFrame, reason: str = "reject_reason", apart: str = "MAP_MATCH_FAILED") -> DataFrame:
    """Shares of rows that cleansing and map matching rejected, and whether their sum may pass."""
    share = lambda c: F.coalesce(F.try_divide(F.count_if(F.coalesce(c, F.lit(False))).cast("double"), F.count("*")), F.lit(0.0))
    found = table.agg(share(F.col(reason).isNotNull() & (F.col(reason) != apart)).alias("cleansing"), share(F.col(reason) == apart).alias("map_matching"))
    return found.withColumn("passed", F.col("cleansing") + F.col("map_matching") <= MOST_QUARANTINED)


def request_violations(routes: DataFrame) -> DataFrame:
    """Rules that each request breaks: its routes (rows request, route_id, segment_id) and their segments."""
    routed = routes.groupBy("request").agg(F.count_distinct("route_id").alias("routes"), F.count_distinct("segment_id").alias("segments"), F.count("*").alias("rows"))
    rules = {"routes": F.col("routes") > MOST_ROUTES, "segments": F.col("segments") > MOST_SEGMENTS, "batch": F.col("rows") > MOST_BATCH}
    return routed.select("request", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()])).alias("broken"))


def output_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each named table, by a scan of no columns."""
    each = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows") for n, df in tables.items()]
    out = each[0]
    for df in each[1:]:
        out = out.unionByName(df)
    return out


def only_in(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Distinct keys that the other table doesn't have."""
    return one.select(key).distinct().join(other.select(key).distinct(), key, "left_anti")


def missing_groups(table: DataFrame, key: str, groups: dict[str, list[str]]) -> DataFrame:
    """For each group of columns the keys in which all of them are null."""
    none = lambda cs: F.coalesce(*[F.col(c).cast("string") for c in cs]).isNull()
    named = F.array_compact(F.array(*[F.when(none(cs), F.lit(n)) for n, cs in groups.items()]))
    return table.select(F.explode(named).alias("source"), key)


def ranked_output(table: DataFrame, key: list[str], scores: list[str], rank: str, positive: str, excluded: list[int]) -> DataFrame:
    """What breaks the rules of a ranked table, in one row: keys that are repeated, null or excluded, scores
    outside 0 to 1 (an unknown score breaks nothing), counts that aren't above 0, and whether the ranks are
    1 to the number of rows."""
    outside = lambda c: F.coalesce(~F.col(c).between(0, 1), F.lit(False))
    some = lambda cs: reduce(lambda a, b: a | b, cs)
    return table.agg(
        F.count("*").alias("rows"),
        (F.count("*") - F.count_distinct(F.struct(*key))).alias("repeated"),
        *count_where(null_keys=some([F.col(k).isNull() for k in key]), excluded=some([F.coalesce(F.col(k).isin(*excluded), F.lit(False)) for k in key]), outside=some([outside(c) for c in scores]), not_positive=~F.coalesce(F.col(positive) > 0, F.lit(False))),
        F.coalesce((F.min(rank) == 1) & (F.max(rank) == F.count("*")) & (F.count_distinct(rank) == F.count("*")), F.count("*") == 0).alias("ranks_whole"),
    )


def score_output(table: DataFrame, scores: list[str]) -> DataFrame:
    """What breaks the rules of zone scores: repeated zones, and scores outside 0 to 1 (an unknown one breaks nothing)."""
    each = table.groupBy("location_id").agg(F.count("*").alias("_n"), *[F.count_if(F.coalesce(~F.col(c).between(0, 1), F.lit(False))).alias(c) for c in scores])
    return each.agg(F.count_if(F.col("_n") > 1).alias("repeated"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in scores])


def profile_output(table: DataFrame, zones: DataFrame) -> DataFrame:
    """What breaks the rules of zone profiles: null and repeated zones, zones that only one side has, counts,
    densities, jobs and areas below 0, and shares outside 0 to 1 (a millionth more is rounding), which only warn."""
    named = lambda *ends: [c for c in table.columns if any(e in c for e in ends)]
    some = lambda cs: reduce(lambda a, b: a | b, cs, F.lit(False))
    below = some([F.coalesce(F.col(c).cast("double") < 0, F.lit(False)) for c in named("_count", "_density", "_jobs", "_area_km2")])
    wide = some([F.coalesce(~F.col(c).between(0, 1.000001), F.lit(False)) for c in table.columns if c.endswith("_ratio")])
    own = table.groupBy("location_id").agg(F.count("*").alias("_n"), F.count_if(below).alias("_below"), F.count_if(wide).alias("_wide"))
    both = own.withColumn("_own", F.lit(True)).join(zones.select("location_id").distinct().withColumn("_known", F.lit(True)), "location_id", "full")
    return both.agg(
        F.coalesce(F.sum(F.when(F.col("location_id").isNull() & F.col("_own"), F.col("_n"))), F.lit(0)).alias("null_zones"),
        *count_where(repeated=(F.col("_n") > 1) & F.col("location_id").isNotNull(), unknown=F.col("_known").isNull() & F.col("location_id").isNotNull(), missing=F.col("_own").isNull()),
        F.coalesce(F.sum("_below"), F.lit(0)).alias("below_zero"),
        F.coalesce(F.sum("_wide"), F.lit(0)).alias("warned_ratios"),
    )


def region_output(regions: DataFrame, mapping: DataFrame, zones: DataFrame, count: int) -> DataFrame:
    """What breaks the rules of regions (region, ring list, x, y) and of the zones' mapping to them: zones that
    are mapped twice, not at all, or unknown; ids other than 1 to count; regions without zones or a shape; and
    regions whose point lies in none of their rings by more than a centimetre."""
    mapped = mapping.groupBy("location_id").agg(F.count("*").alias("_n"))
    sides = mapped.withColumn("_own", F.lit(True)).join(zones.select("location_id").distinct().withColumn("_known", F.lit(True)), "location_id", "full")
    one = sides.agg(*count_where(mapped_twice=F.col("_n") > 1, unmapped=F.col("_own").isNull(), unknown_zones=F.col("_known").isNull()))
    near = lambda r: inside_polygon(F.col("x"), F.col("y"), r) | (nearest_on_ring(F.col("x"), F.col("y"), r)["far"] <= 0.01)
    used = mapping.select("region").distinct().withColumn("_used", F.lit(True))
    listed = regions.join(used, "region", "left")
    two = listed.agg(
        F.abs(F.count("*") - count).alias("wrong_number"),
        *count_where(odd_ids=~F.col("region").between(1, count), no_zones=F.col("_used").isNull(), no_shape=F.coalesce(F.size("rings"), F.lit(0)) < 1, points_outside=~F.coalesce(F.exists("rings", near), F.lit(False)) & (F.size("rings") > 0)),
        (F.count("*") - F.count_distinct("region")).alias("repeated_ids"),
    )
    return one.crossJoin(two)  # a row each


def master_output(table: DataFrame, without_shape: list[int]) -> DataFrame:
    """What breaks the rules of a zone master (location_id, ring, x, y): null and repeated zones, missing shapes
    other than those allowed, points that aren't there just where a shape is, and points outside their shape."""
    has = F.col("ring").isNotNull()
    outside = ~F.coalesce(inside_polygon(F.col("x"), F.col("y"), F.col("ring")), F.lit(False))
    bad = count_where(no_shape=~has & ~F.coalesce(F.col("location_id").isin(*without_shape), F.lit(False)), odd_points=has != F.col("x").isNotNull(), outside=has & F.col("x").isNotNull() & outside)
    plain = table.agg(*count_where(null_zones=F.col("location_id").isNull()), *bad)
    again = table.filter("location_id is not null").groupBy("location_id").agg(F.count("*").alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("repeated"))
    return plain.crossJoin(again)  # a row each


def preparation_counts(roads: DataFrame, **present: Column) -> DataFrame:
    """Roads, and how many of them have each of the named things."""
    return roads.agg(F.count("*").alias("roads"), *count_where(**present))
