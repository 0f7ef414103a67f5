"""Weather: conditions, deductions, current scores and their quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weather codes, thresholds and deductions of the rules.
RAIN_CODES = (51, 53, 55, 56, 57, 61, 63, 65, 66, 67, 80, 81, 82, 95, 96, 99)
SNOW_CODES = (71, 73, 75, 77, 85, 86)
FREEZING_CODES = (56, 57, 66, 67)
FOG_CODES = (45, 48)
RAIN_PER_HOUR, SNOW_PER_HOUR, FREEZING_C, GUST, LOW_VISIBILITY = 0.5, 0.2, 0.5, 15.0, 1000.0
SNOW_VERTICAL, RAIN_LONGITUDINAL, ICE_LONGITUDINAL, SNOW_LONGITUDINAL, WIND_LATERAL, VISIBILITY_FINAL = 5.0, 6.0, 18.0, 10.0, 6.0, 4.0
RULES_VERSION = "v1"


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def conditions() -> Column:
    """Sorted names of the conditions of a 15-minute reading; amounts count four times an hour."""
    code = F.col("weather_code")
    rain = (4 * F.greatest(_zero("rain"), _zero("precipitation")) >= RAIN_PER_HOUR) | F.coalesce(code.isin(*RAIN_CODES), F.lit(False))
    snow = (4 * _zero("snowfall") >= SNOW_PER_HOUR) | F.coalesce(code.isin(*SNOW_CODES), F.lit(False))
    cold = F.coalesce(F.col("temperature_2m") <= FREEZING_C, F.lit(False))
    ice = F.coalesce(code.isin(*FREEZING_CODES), F.lit(False)) | (cold & (rain | snow))
    wind = _zero("wind_gusts_10m") >= GUST
    dim = F.coalesce(code.isin(*FOG_CODES), F.lit(False)) | F.coalesce(F.col("visibility") <= LOW_VISIBILITY, F.lit(False))
    named = {"rain": rain, "ice": ice, "snow": snow, "wind": wind, "low_visibility": dim}
    return F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in named.items()])))


def signature(found: Column) -> Column:
    """version|conditions, or version|clear."""
    return F.concat(F.lit(f"{RULES_VERSION}|"), F.when(F.size(found) == 0, "clear").otherwise(F.array_join(found, ",")))


def parse_signature(text: Column) -> Column:
    """The conditions of a signature; null for another version or unknown, repeated or unsorted names."""
    parts = F.split(F.substring_index(text, "|", -1), ",")
    known = F.forall(parts, lambda p: p.isin("rain", "ice", "snow", "wind", "low_visibility"))
    sound = text.startswith(f"{RULES_VERSION}|") & known & (F.array_sort(F.array_distinct(parts)) == parts)
    return F.when(text == f"{RULES_VERSION}|clear", F.array().cast("array<string>")).when(sound, parts)


def deductions(found: Column) -> dict[str, Column]:
    has = lambda n: F.array_contains(found, n)
    some = lambda n, v: F.when(has(n), F.lit(v)).otherwise(0.0)
    return {
        "vertical": some("snow", SNOW_VERTICAL),
        "longitudinal": F.greatest(some("rain", RAIN_LONGITUDINAL), some("ice", ICE_LONGITUDINAL), some("snow", SNOW_LONGITUDINAL)),
        "lateral": some("wind", WIND_LATERAL),
        "final": some("low_visibility", VISIBILITY_FINAL),
    }


def clamp(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), value))


def current_scores(standard: DataFrame, segment_zones: DataFrame, weather: DataFrame) -> DataFrame:
    """Standard scores less what the latest weather of the segment's zone takes off.

    Segments without a zone are left out; zones without weather deduct nothing and have a null
    signature. weather must hold one row a zone; the dimension tables are joined as Spark sees fit.
    """
    known = weather.select("location_id", conditions().alias("conditions"), F.lit(True).alias("_known"))
    joined = standard.join(segment_zones.filter("location_id is not null"), "segment_id").join(known, "location_id", "left")
    found = F.coalesce("conditions", F.array().cast("array<string>"))
    joined = joined.withColumn("_found", found)
    off = deductions(F.col("_found"))
    vertical, longitudinal, lateral = (F.round(clamp(F.col(f"{d}_score") - off[d]), 6) for d in ("vertical", "longitudinal", "lateral"))
    rows = joined.select("segment_id", "vehicle_profile_id", "location_id", vertical.alias("vertical_score"), longitudinal.alias("longitudinal_score"), lateral.alias("lateral_score"), off["final"].alias("_final"), F.when(F.col("_known"), signature(F.col("_found"))).alias("impact_signature"))
    total = clamp(0.5 * F.col("vertical_score") + 0.3 * F.col("longitudinal_score") + 0.2 * F.col("lateral_score") - F.col("_final"))
    return rows.withColumn("comfort_score", F.round(total, 6)).drop("_final")


def weather_state() -> Column:
    """snow, rain, fog, high_wind or dry, the first that applies."""
    code = F.col("weather_code")
    is_in = lambda codes: F.coalesce(code.isin(*codes), F.lit(False))
    return (
        F.when((_zero("snowfall") > 0) | is_in(SNOW_CODES), "snow")
        .when((_zero("rain") > 0) | (_zero("precipitation") > 0) | is_in(RAIN_CODES), "rain")
        .when(is_in(FOG_CODES) | F.coalesce(F.col("visibility") < LOW_VISIBILITY, F.lit(False)), "fog")
        .when(_zero("wind_gusts_10m") >= GUST, "high_wind")
        .otherwise("dry")
    )


def violations() -> Column:
    """Names of all broken rules of a weather row, in order."""
    rules = {
        "temperature_2m": F.col("temperature_2m").between(-60, 60),
        "precipitation": F.col("precipitation") >= 0,
        "visibility": F.col("visibility") >= 0,
        "wind_gusts_10m": F.col("wind_gusts_10m").between(0, 120),
        "freshness_seconds": F.col("freshness_seconds").between(-60, 1800),
    }
    return F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))


def changed_zones(old: DataFrame, new: DataFrame) -> DataFrame:
    """Zones whose signature is not the one before (a null is a value of its own)."""
    both = old.select("location_id", F.col("impact_signature").alias("_old")).join(new.select("location_id", F.col("impact_signature").alias("_new")), "location_id", "full")
    return both.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select("location_id").distinct()


def unzoned(standard: DataFrame, zoned: DataFrame) -> DataFrame:
    """How many segments and rows the current scores skip, as the segment has no zone."""
    known = zoned.filter("location_id is not null").select("segment_id")
    return standard.join(known, "segment_id", "left_anti").agg(F.countDistinct("segment_id").alias("segments"), F.count("*").alias("rows"))


def score_quarantine(df: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Add the broken rules of current scores: their ranges, and that the parts make the whole.

    The identity isn't asked of rows with low visibility, whose whole has a deduction of its own.
    """
    parts = 0.5 * F.col("vertical_score") + 0.3 * F.col("longitudinal_score") + 0.2 * F.col("lateral_score")
    dim = F.coalesce(F.contains("impact_signature", F.lit("low_visibility")), F.lit(False))
    rules = {f"{c}_range": F.col(c).between(0, 100) for c in ("vertical_score", "longitudinal_score", "lateral_score", "comfort_score")}
    rules["identity"] = dim | (F.abs(parts - F.col("comfort_score")) <= tolerance)
    return df.withColumn("broken", F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()])))


def circuit_breaker(df: DataFrame, most: float = 0.25) -> DataFrame:
    """Whether a batch must stop: all rows or more than the given share are broken; not if there are none."""
    bad = F.count_if(F.size("broken") > 0)
    return df.agg(F.count("*").alias("rows"), bad.alias("quarantined")).withColumn("stop", (F.col("rows") > 0) & ((F.col("quarantined") == F.col("rows")) | (F.col("quarantined") > most * F.col("rows"))))


def fan_out(zones: DataFrame, readings: DataFrame, key: str = "region") -> DataFrame:
    """The reading of each zone's region: state ok, failed (with error), or no reading."""
    told = readings.withColumn("_told", F.lit(True))
    state = F.when(F.col("_told").isNull(), "no reading").when(F.col("error").isNotNull(), "failed").otherwise("ok")
    return zones.join(F.broadcast(told), key, "left").withColumn("state", state).drop("_told")


def zone_targets(segments: DataFrame, zones: DataFrame) -> DataFrame:
    """Distinct segments of the given zones."""
    return segments.select("segment_id", "location_id").join(zones.select("location_id"), "location_id", "left_semi").distinct().select("segment_id", "location_id")


def on_quarter(time: Column) -> Column:
    """Whether a time is a whole quarter of an hour."""
    return F.unix_micros(time) % 900_000_000 == 0
