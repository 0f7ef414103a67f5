"""All registered queries of the engine and their SQL oracles, by the operators that they apply."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smoothway.functions import quality as q
from smoothway.operators import audits, hourly, routing, sequence, serving, spatial, standard, weather, zones
from smoothway.plans import artifact_catalog, geometry_catalog, reference_catalog, storage_catalog  # noqa: F401  (their queries register themselves)
from smoothway.plans.adapters import BASE_US, HOUR_US, oracle
from smoothway.plans.registry import ORACLES, QUERIES, query, rounded

FLAGSHIP = "a3_hourly_segment_features"


# --- cleansing -------------------------------------------------------------------------------------

RAW_SCHEMA = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("trip_id", T.StringType()), T.StructField("trip_seq", T.LongType()), T.StructField("speed_mps", T.DoubleType()), T.StructField("accel_z", T.DoubleType())])
REQUIRED = ["event_id", "trip_id", "trip_seq", "speed_mps", "accel_z"]
RANGES = {"speed_mps": (0.0, 60.0), "accel_z": (-25.0, 30.0)}
PARSED = """parsed AS (SELECT value, ingested, hour, json_valid(value) AS sound,
 CASE WHEN json_valid(value) THEN value->>'$.event_id' END AS event_id, CASE WHEN json_valid(value) THEN value->>'$.trip_id' END AS trip_id,
 CASE WHEN json_valid(value) THEN CAST(value->>'$.trip_seq' AS BIGINT) END AS trip_seq,
 CASE WHEN json_valid(value) THEN CAST(value->>'$.speed_mps' AS DOUBLE) END AS speed_mps, CASE WHEN json_valid(value) THEN CAST(value->>'$.accel_z' AS DOUBLE) END AS accel_z FROM raw_records)"""
FIRST = """first AS (SELECT *, CASE WHEN NOT sound THEN 'MALFORMED_JSON' WHEN event_id IS NULL OR trip_id IS NULL OR trip_seq IS NULL OR speed_mps IS NULL OR accel_z IS NULL THEN 'MISSING_REQUIRED_FIELD'
 WHEN speed_mps > 60 OR speed_mps < 0 OR accel_z < -25 OR accel_z > 30 THEN 'OUT_OF_RANGE' END AS r FROM parsed)"""
CLASSED = """classed AS (SELECT *, CASE WHEN r IS NULL AND row_number() OVER (PARTITION BY r IS NULL, event_id ORDER BY ingested DESC, trip_seq DESC) > 1 THEN 'DUPLICATE_EVENT' ELSE r END AS reject_reason FROM first)"""


def classified(read) -> DataFrame:
    return q.classify(q.parse_envelope(read("raw_records"), RAW_SCHEMA), REQUIRED, RANGES, ["event_id"], ["ingested", "trip_seq"])


@query("s4_parse_envelope", oracle(["raw_records"], "SELECT sound, count(*) AS n, count(event_id) AS ids, CAST(sum(trip_seq) AS BIGINT) AS seqs FROM parsed GROUP BY 1", PARSED))
def _(read):
    parsed = q.parse_envelope(read("raw_records"), RAW_SCHEMA)
    sound = F.col("_corrupt").isNull()
    return parsed.groupBy(sound.alias("sound")).agg(F.count("*").alias("n"), F.count(F.when(sound, F.col("event_id"))).alias("ids"), F.sum(F.when(sound, F.col("trip_seq"))).alias("seqs"))


@query("f6_cleansing", oracle(["raw_records"], "SELECT reject_reason, count(*) AS n, CAST(sum(ingested) AS BIGINT) AS ingested FROM classed GROUP BY 1", PARSED, FIRST, CLASSED))
def _(read):
    return classified(read).groupBy("reject_reason").agg(F.count("*").alias("n"), F.sum("ingested").alias("ingested"))


@query("f8_processed_events", oracle(["raw_records"], "SELECT event_id, trip_id, trip_seq, speed_mps, accel_z FROM classed WHERE reject_reason IS NULL", PARSED, FIRST, CLASSED))
def _(read):
    return q.passed(classified(read)).select("event_id", "trip_id", "trip_seq", "speed_mps", "accel_z")


@query("f7_quarantine", oracle(["raw_records"], """SELECT value, reject_reason, CASE reject_reason WHEN 'OUT_OF_RANGE' THEN concat_ws(', ', CASE WHEN speed_mps < 0 OR speed_mps > 60 THEN 'speed_mps=' || speed_mps END, CASE WHEN accel_z < -25 OR accel_z > 30 THEN 'accel_z=' || accel_z END)
 WHEN 'MISSING_REQUIRED_FIELD' THEN concat_ws(', ', CASE WHEN event_id IS NULL THEN 'event_id' END, CASE WHEN trip_id IS NULL THEN 'trip_id' END, CASE WHEN trip_seq IS NULL THEN 'trip_seq' END, CASE WHEN speed_mps IS NULL THEN 'speed_mps' END, CASE WHEN accel_z IS NULL THEN 'accel_z' END) END AS reject_detail
 FROM classed WHERE reject_reason IS NOT NULL""", PARSED, FIRST, CLASSED))  # fmt: skip
def _(read):
    return q.quarantined(classified(read)).select("value", "reject_reason", "reject_detail")


@query("f19_quarantine_rate", oracle(["raw_records"], "SELECT count(*) FILTER (reject_reason IS NULL) AS accepted, count(*) FILTER (reject_reason IS NOT NULL) AS rejected, round(count(*) FILTER (reject_reason IS NOT NULL) / count(*), 6) AS rate FROM classed", PARSED, FIRST, CLASSED))
def _(read):
    return rounded(q.rates(classified(read)))


@query("f16_expectations", oracle(["zone_weather"], """SELECT rule, CAST(broken AS BIGINT) AS broken, rows, broken = 0 AS success FROM (SELECT 'temperature' AS rule, count(*) FILTER (temperature_2m IS NULL) AS broken, count(*) AS rows FROM zone_weather
 UNION ALL SELECT 'gusts', count(*) FILTER (NOT wind_gusts_10m < 15), count(*) FROM zone_weather UNION ALL SELECT 'rain', count(*) FILTER (rain < 0), count(*) FROM zone_weather)"""))  # fmt: skip
def _(read):
    return q.expectations(read("zone_weather"), {"temperature": F.col("temperature_2m").isNotNull(), "gusts": F.col("wind_gusts_10m") < 15, "rain": F.col("rain") >= 0})


@query("a20_duplicate_keys", oracle(["trips"], "SELECT pickup_zone, dropoff_zone, month, count(*) AS rows FROM trips GROUP BY ALL HAVING count(*) > 1"))
def _(read):
    return q.duplicate_keys(read("trips"), ["pickup_zone", "dropoff_zone", "month"])


@query("a19_distinct_values", oracle(["road_segments"], "SELECT 'traffic_direction' AS name, traffic_direction AS item, count(*) AS rows FROM road_segments GROUP BY 2 UNION ALL SELECT 'street', street, count(*) FROM road_segments GROUP BY 2"))
def _(read):
    return q.distinct_profile(read("road_segments"), ["traffic_direction", "street"])


# --- sequences -------------------------------------------------------------------------------------

RATED = """rated AS (SELECT *, CASE WHEN s > 0 AND s <= 0.5 THEN d / s END AS steering_rate FROM (SELECT *, (event_us - lag(event_us) OVER t) / 1e6 AS s, steering_angle - lag(steering_angle) OVER t AS d FROM sensor_events WINDOW t AS (PARTITION BY trip_id ORDER BY trip_seq, event_us, event_id)))"""
REVERSED = """turned AS (SELECT *, CASE WHEN abs(steering_rate) > 10 THEN sign(steering_rate) END AS sg, sum(CASE WHEN steering_rate IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY trip_id ORDER BY trip_seq, event_us, event_id ROWS UNBOUNDED PRECEDING) AS run FROM rated),
 reversed AS (SELECT *, coalesce(sg <> last_value(sg IGNORE NULLS) OVER (PARTITION BY trip_id, run ORDER BY trip_seq, event_us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS steering_reversal FROM turned)"""


def _episode_sql(name: str, condition: str, source: str) -> str:
    t = "PARTITION BY trip_id ORDER BY trip_seq, event_us, event_id"
    return f"""{name}_1 AS (SELECT *, coalesce({condition}, false) AS c, event_us - lag(event_us) OVER ({t}) AS gap FROM {source}),
 {name}_2 AS (SELECT *, coalesce(gap <= 0 OR gap > 500000, true) OR c <> lag(c) OVER ({t}) AS fresh FROM {name}_1),
 {name}_3 AS (SELECT *, sum(CAST(fresh AS INT)) OVER ({t} ROWS UNBOUNDED PRECEDING) AS run_no FROM {name}_2),
 {name}_t AS (SELECT * EXCLUDE (c, gap, fresh, run_no), c AND fresh AND max(event_us) OVER (PARTITION BY trip_id, run_no) - min(event_us) OVER (PARTITION BY trip_id, run_no) >= 300000 AS {name} FROM {name}_3)"""


@query("w3_steering_rate", oracle(["sensor_events"], "SELECT event_id, round(steering_rate, 6) AS steering_rate FROM rated", RATED))
def _(read):
    return rounded(sequence.steering_rate(read("sensor_events")).select("event_id", "steering_rate"))


@query("w4_steering_reversal", oracle(["sensor_events"], "SELECT event_id, steering_reversal FROM reversed", RATED, REVERSED))
def _(read):
    return sequence.steering_reversal(sequence.steering_rate(read("sensor_events"))).select("event_id", "steering_reversal")


@query("w7_driving_features", oracle(["sensor_events"], "SELECT event_id, round(steering_rate, 6) AS steering_rate, steering_reversal, hard_accel, hard_brake, sharp_steer FROM sharp_steer_t", RATED, REVERSED, _episode_sql("hard_accel", "accel_x >= 3.0", "reversed"), _episode_sql("hard_brake", "accel_x <= -3.0", "hard_accel_t"), _episode_sql("sharp_steer", "abs(steering_rate) >= 100", "hard_brake_t")))
def _(read):
    return rounded(sequence.driving_features(read("sensor_events")).select("event_id", "steering_rate", "steering_reversal", "hard_accel", "hard_brake", "sharp_steer"))


@query("w6_episode_counts", oracle(["sensor_events"], "SELECT trip_id, count(*) FILTER (hard_accel) AS accels, count(*) FILTER (hard_brake) AS brakes FROM hard_brake_t GROUP BY 1", _episode_sql("hard_accel", "accel_x >= 3.0", "sensor_events"), _episode_sql("hard_brake", "accel_x <= -3.0", "hard_accel_t")))
def _(read):
    found = sequence.episodes(read("sensor_events"), {"hard_accel": (F.col("accel_x") >= 3.0, 0.3), "hard_brake": (F.col("accel_x") <= -3.0, 0.3)})
    return found.groupBy("trip_id").agg(F.count_if("hard_accel").alias("accels"), F.count_if("hard_brake").alias("brakes"))


@query("w13_task_gaps", oracle(["trips"], "SELECT trip_id, lead(request_us) OVER (PARTITION BY pickup_zone ORDER BY request_us, trip_id) - dropoff_us AS wait FROM trips"))
def _(read):
    return sequence.gaps_between(read("trips"), "pickup_zone", ["request_us", "trip_id"], "request_us", "dropoff_us").select("trip_id", "wait")


@query("w15_order_check", oracle(["trips"], "SELECT pickup_zone, count(*) FILTER (fell) AS falls FROM (SELECT pickup_zone, request_us < lag(request_us) OVER (PARTITION BY pickup_zone ORDER BY trip_id) AS fell FROM trips) GROUP BY 1 HAVING count(*) FILTER (fell) > 0"))
def _(read):
    return sequence.out_of_order(read("trips"), "pickup_zone", ["trip_id"], "request_us")


# --- hourly features and scores --------------------------------------------------------------------

_RMS = ", ".join(f"round(sqrt(avg({c} * {c})), 6) AS rms_{c}" for c in hourly.RMS)
_P95 = ", ".join(f"round(quantile_disc(abs({c}), 0.95), 6) AS p95_abs_{c}" for c in hourly.P95)
_CNT = ", ".join(f"count(*) FILTER ({c}) AS {c}_count" for c in hourly.FLAGS)
FEATURES = f"features AS (SELECT hour_us, segment_id, vehicle_profile_id, round(avg(speed), 6) AS mean_speed, {_RMS}, {_P95}, {_CNT}, count(*) AS sample_count, count(DISTINCT trip_id) AS trip_count FROM hourly_signals GROUP BY 1, 2, 3)"


def hourly_features(read) -> DataFrame:
    return rounded(hourly.features(read("hourly_signals")))


@query("a3_hourly_segment_features", oracle(["hourly_signals"], "SELECT * FROM features", FEATURES))
def _(read):
    return hourly_features(read)


@query("a4_canonical_features", oracle(["hourly_signals"], f"SELECT CAST(hour_us AS BIGINT) AS start_us, CAST(hour_us + {HOUR_US} AS BIGINT) AS end_us, {BASE_US} AS processed_us, segment_id, vehicle_profile_id, mean_speed, p95_abs_accel_z, CAST(sample_count AS BIGINT) AS sample_count, CAST(trip_count AS BIGINT) AS trip_count, 'v1' AS feature_version, 'run-1' AS _run_id FROM features", FEATURES))
def _(read):
    stored = hourly.canonical(hourly_features(read), "v1", "run-1", BASE_US)
    micros = {"start_us": "data_period_start", "end_us": "data_period_end", "processed_us": "processed_at"}
    return stored.select(*[F.unix_micros(c).alias(n) for n, c in micros.items()], "segment_id", "vehicle_profile_id", "mean_speed", "p95_abs_accel_z", "sample_count", "trip_count", "feature_version", "_run_id")


def _score_sql() -> str:
    rates = ", ".join(f"CASE WHEN trip_count > 0 THEN {c}_count / trip_count END AS {c}_rate" for c in hourly.FLAGS)
    parts = []
    for d, weights in hourly.DIRECTIONS.items():
        pen = " + ".join(f"coalesce({w} * greatest(0.0, least(1.0, CASE WHEN {n} IS NULL THEN NULL ELSE ({n} - {hourly.ANCHORS[n][0]} * sc) / (({hourly.ANCHORS[n][1]} - {hourly.ANCHORS[n][0]}) * sc) END)) * CASE WHEN {n} IS NULL THEN NULL ELSE 1 END, 0)" for n, w in weights.items())
        here = " + ".join(f"CASE WHEN {n} IS NULL THEN 0 ELSE {w} END" for n, w in weights.items())
        parts.append(f"CASE WHEN round(CAST({here} AS DOUBLE), 9) >= 0.8 THEN round(100 * (1 - ({pen}) / CAST({here} AS DOUBLE)), 6) END AS {d}")
    return f"rated AS (SELECT *, {rates}, CASE WHEN mean_speed < 5 THEN CAST(0.9 AS DOUBLE) WHEN mean_speed < 10 THEN 1.0 ELSE 1.1 END AS sc FROM features), scored AS (SELECT hour_us, segment_id, vehicle_profile_id, sample_count, trip_count, {', '.join(parts)} FROM rated), reasoned AS (SELECT *, CASE WHEN vertical_score IS NULL OR longitudinal_score IS NULL OR lateral_score IS NULL THEN 'INSUFFICIENT_SCORING_FEATURES' END AS reject_reason FROM scored)"


@query("m8_hourly_scores", oracle(["hourly_signals"], "SELECT hour_us, segment_id, vehicle_profile_id, vertical_score, longitudinal_score, lateral_score, reject_reason FROM reasoned", FEATURES, _score_sql()))
def _(read):
    return rounded(hourly.scores(hourly_features(read)).select("hour_us", "segment_id", "vehicle_profile_id", "vertical_score", "longitudinal_score", "lateral_score", "reject_reason"), 6)


@query("a6_scoring_audit", oracle(["hourly_signals"], """SELECT count(*) AS rows, count(DISTINCT (hour_us, vehicle_profile_id)) AS keys, count(*) FILTER (why IS NULL) AS scored, count(*) FILTER (why = 'INVALID_SCORING_INPUT') AS invalid, count(*) FILTER (why = 'INSUFFICIENT_SCORING_FEATURES') AS insufficient
 FROM (SELECT *, CASE WHEN sample_count <= 2 THEN 'INVALID_SCORING_INPUT' ELSE reject_reason END AS why FROM reasoned)""", FEATURES, _score_sql()))
def _(read):
    """Features of two samples or fewer are made invalid, as none is by itself."""
    found = hourly_features(read).withColumn("trip_count", F.when(F.col("sample_count") <= 2, 0).otherwise(F.col("trip_count")))
    return hourly.audit(hourly.scores(found), ["hour_us", "vehicle_profile_id"])


_DIST = [f"SELECT '{n}' AS name, count({n}) AS n, round(avg({n}), 6) AS mean, round(min({n}), 6) AS least, round(max({n}), 6) AS greatest, " + ", ".join(f"round(quantile_cont({n}, {p}), 6) AS q{round(100 * p)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9, 0.95)) + " FROM hourly_signals" for n in ("accel_z", "jerk_y", "speed")]


@query("a14_distributions", oracle(["hourly_signals"], " UNION ALL ".join(_DIST)))
def _(read):
    return rounded(hourly.distributions(read("hourly_signals"), ["accel_z", "jerk_y", "speed"]))


# --- standard scores -------------------------------------------------------------------------------

AS_OF = BASE_US
WINDOWED = f"windowed AS (SELECT * FROM hourly_scores WHERE period_us >= {AS_OF - 168 * HOUR_US} AND period_us < {AS_OF})"
LATEST = """latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY segment_id, vehicle_profile_id, period_us ORDER BY CASE scoring_version WHEN '1.10.0' THEN 3 WHEN '1.2.0' THEN 2 ELSE 1 END DESC, scoring_version, vertical_score, longitudinal_score, lateral_score, trip_count, sample_count) AS rn FROM windowed) WHERE rn = 1)"""


def week(read) -> DataFrame:
    return standard.latest_version(standard.in_window(read("hourly_scores"), AS_OF), ["segment_id", "vehicle_profile_id", "period_us"])


@query("s6_window_scan", oracle(["hourly_scores"], "SELECT segment_id, count(*) AS n, min(period_us) AS first_us, max(period_us) AS last_us FROM windowed GROUP BY 1", WINDOWED))
def _(read):
    return standard.in_window(read("hourly_scores"), AS_OF).groupBy("segment_id").agg(F.count("*").alias("n"), F.min("period_us").alias("first_us"), F.max("period_us").alias("last_us"))


@query("w8_latest_version", oracle(["hourly_scores"], "SELECT segment_id, vehicle_profile_id, period_us, scoring_version, round(vertical_score, 6) AS vertical_score, trip_count FROM latest", WINDOWED, LATEST))
def _(read):
    return rounded(week(read).select("segment_id", "vehicle_profile_id", "period_us", "scoring_version", "vertical_score", "trip_count"))


_D = standard.DIRECTIONS
POOLED = f"pooled AS (SELECT segment_id, period_us, {', '.join(f'sum(trip_count * {d}) / nullif(sum(trip_count), 0) AS {d}' for d in _D)}, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM latest GROUP BY 1, 2)"
MU = ", ".join(f"sum(weight * {d}) / sum(weight) AS mean_{d}" for d in _D)
OBS = ", ".join(f"sum(weight * {d}) / sum(weight) AS o_{d}" for d in _D)
EVIDENCE = "least(1.0, trip_count / 5.0) AS weight"
STANDARD = f"""each AS (SELECT *, CAST({EVIDENCE.removesuffix(' AS weight')} AS DOUBLE) AS weight FROM latest WHERE trip_count > 0), whole AS (SELECT *, CAST({EVIDENCE.removesuffix(' AS weight')} AS DOUBLE) AS weight FROM pooled WHERE trip_count > 0),
 segments AS (SELECT DISTINCT segment_id FROM hourly_scores UNION SELECT 'never'), mu0 AS (SELECT {MU} FROM whole), mup AS (SELECT vehicle_profile_id, {MU} FROM each GROUP BY 1),
 filled AS (SELECT p AS vehicle_profile_id, {', '.join(f'coalesce(mup.mean_{d}, mu0.mean_{d}) AS mean_{d}' for d in _D)} FROM (SELECT unnest([1, 2, 3, 4, 9]) AS p) LEFT JOIN mup ON p = mup.vehicle_profile_id CROSS JOIN mu0),
 obs AS (SELECT segment_id, vehicle_profile_id, {OBS}, sum(weight) AS ev, CAST(sum(trip_count) AS BIGINT) AS trips, min(period_us) AS first_us, max(period_us) AS last_us FROM each GROUP BY 1, 2),
 obs0 AS (SELECT segment_id, {OBS}, sum(weight) AS ev, CAST(sum(trip_count) AS BIGINT) AS trips, min(period_us) AS first_us, max(period_us) AS last_us FROM whole GROUP BY 1),
 rows AS (SELECT s.segment_id, f.vehicle_profile_id, {', '.join(f'o_{d}, mean_{d}' for d in _D)}, ev, trips, first_us, last_us FROM segments s CROSS JOIN filled f LEFT JOIN obs o ON o.segment_id = s.segment_id AND o.vehicle_profile_id = f.vehicle_profile_id
 UNION ALL SELECT s.segment_id, 0, {', '.join(f'o_{d}, mean_{d}' for d in _D)}, ev, trips, first_us, last_us FROM segments s CROSS JOIN mu0 LEFT JOIN obs0 o ON o.segment_id = s.segment_id),
 shrunk AS (SELECT segment_id, CAST(vehicle_profile_id AS INT) AS vehicle_profile_id, {', '.join(f'(coalesce(ev, 0) * coalesce(o_{d}, 0) + 10.0 * mean_{d}) / (coalesce(ev, 0) + 10.0) AS {d}' for d in _D)}, coalesce(ev, 0) AS ev, coalesce(trips, 0) AS trips, first_us, last_us FROM rows),
 standard AS (SELECT segment_id, vehicle_profile_id, {', '.join(f'round({d}, 6) AS {d}' for d in _D)}, round(0.5 * vertical_score + 0.3 * longitudinal_score + 0.2 * lateral_score, 6) AS comfort_score, round(ev / (ev + 10.0), 6) AS confidence, round(ev, 6) AS evidence, trips, first_us, last_us FROM shrunk)"""


def standard_table(read) -> DataFrame:
    segments = read("hourly_scores").select("segment_id").distinct()
    never = segments.sparkSession.createDataFrame([("never",)], "segment_id string")
    return standard.standard_scores(week(read), segments.unionByName(never), [1, 2, 3, 4, 9])


@query("a7_pooled_profiles", oracle(["hourly_scores"], f"SELECT segment_id, period_us, {', '.join(f'round({d}, 6) AS {d}' for d in _D)}, trip_count FROM pooled", WINDOWED, LATEST, POOLED))
def _(read):
    return rounded(standard.pool_profiles(week(read)).drop("sample_count"))


@query("a12_standard_scores", oracle(["hourly_scores"], "SELECT segment_id, vehicle_profile_id, round(vertical_score, 7) AS vertical_score, round(longitudinal_score, 7) AS longitudinal_score, round(lateral_score, 7) AS lateral_score, round(comfort_score, 7) AS comfort_score, round(confidence, 7) AS confidence, round(evidence, 7) AS evidence, trips, first_us, last_us FROM standard", WINDOWED, LATEST, POOLED, STANDARD))
def _(read):
    return rounded(standard_table(read), 7)


_SIDES = """old AS (SELECT segment_id, max(vertical_score) AS score FROM hourly_scores WHERE vehicle_profile_id <= 2 AND trip_count < 5 AND segment_id <> 's7' GROUP BY 1), new AS (SELECT segment_id, min(vertical_score) AS score FROM hourly_scores WHERE sample_count > 200 AND segment_id <> 's9' GROUP BY 1)"""


def _sides(read) -> tuple[DataFrame, DataFrame]:
    scores = read("hourly_scores")
    old = scores.filter("vehicle_profile_id <= 2 and trip_count < 5 and segment_id <> 's7'").groupBy("segment_id").agg(F.max("vertical_score").alias("score"))
    return old, scores.filter("sample_count > 200 and segment_id <> 's9'").groupBy("segment_id").agg(F.min("vertical_score").alias("score"))


@query("k6_merge_counts", oracle(["hourly_scores"], "SELECT CASE WHEN old.segment_id IS NULL THEN 'inserted' WHEN new.segment_id IS NULL THEN 'kept' ELSE 'updated' END AS state, count(*) AS n FROM old FULL JOIN new USING (segment_id) GROUP BY 1", _SIDES))
def _(read):
    return standard.merge(*_sides(read), ["segment_id"]).groupBy("state").agg(F.count("*").alias("n"))


@query("k6_merged_rows", oracle(["hourly_scores"], "SELECT segment_id, round(coalesce(new.score, old.score), 6) AS score, CASE WHEN old.segment_id IS NULL THEN 'inserted' WHEN new.segment_id IS NULL THEN 'kept' ELSE 'updated' END AS state FROM old FULL JOIN new USING (segment_id)", _SIDES))
def _(read):
    return rounded(standard.merge(*_sides(read), ["segment_id"]))


@query("k8_newest_by_time", oracle(["hourly_scores"], """SELECT segment_id, coalesce(CASE WHEN n.period_us >= o.period_us THEN n.period_us END, o.period_us, n.period_us) AS period_us, CASE WHEN o.segment_id IS NULL OR n.period_us >= o.period_us THEN 'new' ELSE 'old' END AS side
 FROM (SELECT segment_id, max(period_us) AS period_us FROM hourly_scores WHERE vehicle_profile_id <= 2 GROUP BY 1) o FULL JOIN (SELECT segment_id, max(period_us) AS period_us FROM hourly_scores WHERE vehicle_profile_id > 2 GROUP BY 1
 UNION ALL SELECT segment_id, max(period_us) FROM hourly_scores WHERE vehicle_profile_id <= 2 AND segment_id < 's2' AND segment_id NOT IN (SELECT segment_id FROM hourly_scores WHERE vehicle_profile_id > 2) GROUP BY 1) n USING (segment_id)"""))  # fmt: skip
def _(read):
    """Old rows that are later, new rows that are, and ties, in which the new row counts."""
    scores = read("hourly_scores")
    top = lambda df, side: df.groupBy("segment_id").agg(F.max("period_us").alias("period_us")).withColumn("side", F.lit(side))
    old, new = scores.filter("vehicle_profile_id <= 2"), scores.filter("vehicle_profile_id > 2")
    tied = old.filter("segment_id < 's2'").join(new.select("segment_id").distinct(), "segment_id", "left_anti")
    return standard.newest(top(old, "old"), top(new, "new").unionByName(top(tied, "new")), ["segment_id"], "period_us")


# --- weather and current scores --------------------------------------------------------------------

def _in(codes) -> str:
    return ", ".join(map(str, codes))


COND = f"""named AS (SELECT *, coalesce(4 * greatest(coalesce(rain, 0), coalesce(precipitation, 0)) >= 0.5 OR weather_code IN ({_in(weather.RAIN_CODES)}), false) AS c_rain, coalesce(4 * coalesce(snowfall, 0) >= 0.2 OR weather_code IN ({_in(weather.SNOW_CODES)}), false) AS c_snow,
 coalesce(wind_gusts_10m >= 15, false) AS c_wind, coalesce(weather_code IN ({_in(weather.FOG_CODES)}), false) OR coalesce(visibility <= 1000, false) AS c_dim FROM zone_weather),
 iced AS (SELECT *, coalesce(weather_code IN ({_in(weather.FREEZING_CODES)}), false) OR (coalesce(temperature_2m <= 0.5, false) AND (c_rain OR c_snow)) AS c_ice FROM named),
 signed AS (SELECT *, concat('v1|', CASE WHEN c_rain OR c_snow OR c_wind OR c_dim OR c_ice THEN concat_ws(',', CASE WHEN c_ice THEN 'ice' END, CASE WHEN c_dim THEN 'low_visibility' END, CASE WHEN c_rain THEN 'rain' END, CASE WHEN c_snow THEN 'snow' END, CASE WHEN c_wind THEN 'wind' END) ELSE 'clear' END) AS impact_signature FROM iced)"""


@query("m12_weather_signature", oracle(["zone_weather"], "SELECT location_id, impact_signature FROM signed", COND))
def _(read):
    return read("zone_weather").select("location_id", weather.signature(weather.conditions()).alias("impact_signature"))


@query("m13_weather_deductions", oracle(["zone_weather"], "SELECT location_id, CASE WHEN c_snow THEN CAST(5 AS DOUBLE) ELSE 0 END AS vertical, greatest(CASE WHEN c_rain THEN CAST(6 AS DOUBLE) ELSE 0 END, CASE WHEN c_ice THEN 18 ELSE 0 END, CASE WHEN c_snow THEN 10 ELSE 0 END) AS longitudinal, CASE WHEN c_wind THEN CAST(6 AS DOUBLE) ELSE 0 END AS lateral, CASE WHEN c_dim THEN CAST(4 AS DOUBLE) ELSE 0 END AS final FROM iced", COND))
def _(read):
    found = read("zone_weather").withColumn("c", weather.conditions())
    return found.select("location_id", *[c.alias(n) for n, c in weather.deductions(F.col("c")).items()])


@query("m15_weather_state", oracle(["zone_weather"], f"SELECT location_id, CASE WHEN coalesce(snowfall, 0) > 0 OR weather_code IN ({_in(weather.SNOW_CODES)}) THEN 'snow' WHEN coalesce(rain, 0) > 0 OR coalesce(precipitation, 0) > 0 OR weather_code IN ({_in(weather.RAIN_CODES)}) THEN 'rain' WHEN weather_code IN (45, 48) OR coalesce(visibility < 1000, false) THEN 'fog' WHEN wind_gusts_10m >= 15 THEN 'high_wind' ELSE 'dry' END AS state FROM zone_weather"))
def _(read):
    return read("zone_weather").select("location_id", weather.weather_state().alias("state"))


@query("f15_weather_violations", oracle(["zone_weather"], "SELECT location_id, concat_ws(',', CASE WHEN temperature_2m IS NULL THEN 'temperature_2m' END, CASE WHEN visibility IS NULL THEN 'visibility' END, CASE WHEN NOT freshness_seconds BETWEEN -60 AND 1800 THEN 'freshness_seconds' END) AS broken FROM zone_weather"))
def _(read):
    return read("zone_weather").select("location_id", F.array_join(weather.violations(), ",").alias("broken"))


CURRENT = """zoned AS (SELECT DISTINCT segment_id, CAST(CAST(substr(segment_id, 2) AS INT) % 30 AS INT) AS location_id FROM hourly_scores),
 adjusted AS (SELECT t.segment_id, t.vehicle_profile_id, z.location_id, round(greatest(0, least(100, vertical_score - CASE WHEN c_snow THEN 5 ELSE 0 END)), 6) AS vertical_score,
 round(greatest(0, least(100, longitudinal_score - greatest(CASE WHEN c_rain THEN 6 ELSE 0 END, CASE WHEN c_ice THEN 18 ELSE 0 END, CASE WHEN c_snow THEN 10 ELSE 0 END))), 6) AS longitudinal_score, round(greatest(0, least(100, lateral_score - CASE WHEN c_wind THEN 6 ELSE 0 END)), 6) AS lateral_score,
 CASE WHEN c_dim THEN 4 ELSE 0 END AS final, impact_signature FROM standard t JOIN zoned z ON z.segment_id = t.segment_id LEFT JOIN signed w ON w.location_id = z.location_id),
 current AS (SELECT * EXCLUDE (final), round(greatest(0, least(100, 0.5 * vertical_score + 0.3 * longitudinal_score + 0.2 * lateral_score - final)), 6) AS comfort_score FROM adjusted)"""
_STEPS = (WINDOWED, LATEST, POOLED, STANDARD, COND, CURRENT)


def round_text(value: str, places: int = 2) -> str:
    """SQL that rounds a number half up, as its decimal text reads."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(30, 16)), {places}) AS DOUBLE)"


def segment_zones(read) -> DataFrame:
    number = F.substring("segment_id", 2, 9).try_cast("int")
    return read("hourly_scores").select("segment_id").distinct().withColumn("location_id", number % 30)


def current_table(read) -> DataFrame:
    return weather.current_scores(standard_table(read), segment_zones(read), read("zone_weather"))


@query("j13_current_scores", oracle(["hourly_scores", "zone_weather"], f"SELECT segment_id, vehicle_profile_id, location_id, {', '.join(f'{round_text(c, 4)} AS {c}' for c in ('vertical_score', 'longitudinal_score', 'lateral_score', 'comfort_score'))}, impact_signature FROM current", *_STEPS))
def _(read):
    return rounded(current_table(read), 4)


@query("j13_unzoned_segments")
def _(read):
    return weather.unzoned(standard_table(read), segment_zones(read))


@query("j14_changed_zones", oracle(["zone_weather"], "SELECT location_id FROM signed WHERE impact_signature <> 'v1|clear' AND location_id % 3 <> 0 UNION SELECT location_id FROM signed WHERE location_id % 3 = 0", COND))
def _(read):
    new = read("zone_weather").select("location_id", weather.signature(weather.conditions()).alias("impact_signature"))
    old = new.filter("location_id % 3 <> 0").withColumn("impact_signature", F.lit("v1|clear"))
    return weather.changed_zones(old, new)


_BROKEN = """hurt AS (SELECT segment_id, vehicle_profile_id, impact_signature, longitudinal_score, CASE WHEN location_id = 3 THEN NULL ELSE vertical_score END AS vertical_score, CASE WHEN location_id = 5 THEN lateral_score + 101 ELSE lateral_score END AS lateral_score, CASE WHEN location_id IN (7, 12) THEN comfort_score + 0.5 ELSE comfort_score END AS comfort_score FROM current),
 judged AS (SELECT segment_id, vehicle_profile_id, concat_ws(',', CASE WHEN NOT coalesce(vertical_score BETWEEN 0 AND 100, false) THEN 'vertical_score_range' END, CASE WHEN NOT coalesce(longitudinal_score BETWEEN 0 AND 100, false) THEN 'longitudinal_score_range' END, CASE WHEN NOT coalesce(lateral_score BETWEEN 0 AND 100, false) THEN 'lateral_score_range' END, CASE WHEN NOT coalesce(comfort_score BETWEEN 0 AND 100, false) THEN 'comfort_score_range' END,
 CASE WHEN NOT coalesce(impact_signature LIKE '%low_visibility%', false) AND NOT coalesce(abs(0.5 * vertical_score + 0.3 * longitudinal_score + 0.2 * lateral_score - comfort_score) <= 0.01, false) THEN 'identity' END) AS broken FROM hurt)"""


def judged_table(read) -> DataFrame:
    """Current scores, some of them hurt, with the rules that each breaks."""
    now, at = current_table(read), F.col("location_id")
    hurt = {"vertical_score": F.when(at != 3, F.col("vertical_score")), "lateral_score": F.col("lateral_score") + F.when(at == 5, 101).otherwise(0), "comfort_score": F.col("comfort_score") + F.when(at.isin(7, 12), 0.5).otherwise(0)}
    return weather.score_quarantine(now.withColumns(hurt))


@query("f17_current_quarantine", oracle(["hourly_scores", "zone_weather"], "SELECT segment_id, vehicle_profile_id, broken FROM judged WHERE broken <> ''", *_STEPS, _BROKEN))
def _(read):
    return judged_table(read).filter("size(broken) > 0").select("segment_id", "vehicle_profile_id", F.array_join("broken", ",").alias("broken"))


@query("f18_circuit_breaker", oracle(["hourly_scores", "zone_weather"], """SELECT 'all' AS batch, count(*) AS rows, count(*) FILTER (broken <> '') AS quarantined, count(*) FILTER (broken <> '') > 0.25 * count(*) AS stop FROM judged
 UNION ALL SELECT 'broken', count(*) FILTER (broken <> ''), count(*) FILTER (broken <> ''), true FROM judged UNION ALL SELECT 'none', 0, 0, false""", *_STEPS, _BROKEN))
def _(read):
    found = judged_table(read)
    batches = {"all": found, "broken": found.filter("size(broken) > 0"), "none": found.filter("false")}
    each = [weather.circuit_breaker(df).select(F.lit(n).alias("batch"), "rows", "quarantined", "stop") for n, df in batches.items()]
    return each[0].unionByName(each[1]).unionByName(each[2])


# --- serving ---------------------------------------------------------------------------------------

@query("a30_route_scores", oracle(["hourly_scores", "routes"], f"""SELECT route_id, segments, {round_text('m')} AS mean_score, {round_text('w')} AS worst_score, {round_text('0.7 * m + 0.3 * w')} AS score FROM (SELECT route_id, count(*) AS segments, count(comfort_score) AS k, avg(comfort_score) AS m, avg(comfort_score) FILTER (rn <= greatest(1, ceil(n * 0.25))) AS w FROM
 (SELECT r.route_id, comfort_score, row_number() OVER (PARTITION BY r.route_id ORDER BY comfort_score NULLS LAST, position) AS rn, count(*) OVER (PARTITION BY r.route_id) AS n FROM routes r LEFT JOIN (SELECT segment_id, floor(max(vertical_score)) AS comfort_score FROM hourly_scores WHERE vehicle_profile_id = 1 GROUP BY 1) s USING (segment_id)) GROUP BY 1) WHERE segments = k"""))  # fmt: skip
def _(read):
    scores = read("hourly_scores").filter("vehicle_profile_id = 1").groupBy("segment_id").agg(F.floor(F.max("vertical_score")).cast("double").alias("comfort_score"))
    return serving.route_scores(read("routes"), scores)


@query("t2_ranked_routes", oracle(["routes"], "SELECT route_id, request, rank, rank = 1 AS recommended FROM (SELECT route_id, route_id % 100 AS request, row_number() OVER (PARTITION BY route_id % 100 ORDER BY count(*) DESC, route_id) AS rank FROM routes GROUP BY 1)"))
def _(read):
    scored = read("routes").groupBy("route_id").agg(F.count("*").alias("score")).withColumn("request", F.col("route_id") % 100)
    return serving.ranked(scored, "request").select("route_id", "request", F.col("rank").cast("long").alias("rank"), "recommended")


@query("j17_lookup", oracle(["hourly_scores", "road_segments"], "SELECT r.segment_id, coalesce(c.v, s.v) AS comfort_score, CASE WHEN c.v IS NOT NULL THEN 'current' WHEN s.v IS NOT NULL THEN 'standard' END AS source FROM road_segments r LEFT JOIN (SELECT segment_id, max(vertical_score) AS v FROM hourly_scores WHERE trip_count = 7 AND lateral_score < 60 GROUP BY 1) c USING (segment_id) LEFT JOIN (SELECT segment_id, min(vertical_score) AS v FROM hourly_scores WHERE longitudinal_score < 70 GROUP BY 1) s USING (segment_id)"))
def _(read):
    scores = read("hourly_scores")
    current = scores.filter("trip_count = 7 and lateral_score < 60").groupBy("segment_id").agg(F.max("vertical_score").alias("comfort_score"))
    base = scores.filter("longitudinal_score < 70").groupBy("segment_id").agg(F.min("vertical_score").alias("comfort_score"))
    return serving.lookup(read("road_segments").select("segment_id"), current, base)


@query("u6_not_found", oracle(["routes", "road_segments"], "SELECT DISTINCT segment_id FROM routes WHERE segment_id NOT IN (SELECT segment_id FROM road_segments WHERE traffic_direction <> 'A')"))
def _(read):
    return serving.not_found(read("routes"), read("road_segments").filter("traffic_direction <> 'A'"))


@query("j18_profile_or_any", oracle(["hourly_signals", "hourly_scores"], "SELECT DISTINCT vehicle_profile_id, CASE WHEN vehicle_profile_id IN (SELECT vehicle_profile_id FROM hourly_scores) THEN vehicle_profile_id ELSE 0 END AS resolved_profile_id FROM hourly_signals"))
def _(read):
    return serving.profile_or_any(read("hourly_signals").select("vehicle_profile_id").distinct(), read("hourly_scores"))


@query("t5_in_order_once", oracle(["routes"], "SELECT route_id, segment_id, row_number() OVER (PARTITION BY route_id ORDER BY min(position), segment_id) AS nth FROM routes GROUP BY 1, 2"))
def _(read):
    return serving.in_order_once(read("routes"), "route_id", "segment_id", "position").withColumn("nth", F.col("nth").cast("long"))


@query("m36_colours", oracle(["hourly_scores", "road_segments"], "SELECT colour, count(*) AS n FROM (SELECT CASE WHEN v IS NULL THEN 'gray' WHEN v >= 80 THEN 'green' WHEN v >= 60 THEN 'yellow' ELSE 'red' END AS colour FROM road_segments LEFT JOIN (SELECT segment_id, avg(CAST(vertical_score AS INT)) AS v FROM hourly_scores WHERE lateral_score < 50 GROUP BY 1) USING (segment_id)) GROUP BY 1"))
def _(read):
    scores = read("hourly_scores").filter("lateral_score < 50").groupBy("segment_id").agg(F.avg(F.col("vertical_score").cast("int")).alias("v"))
    joined = read("road_segments").join(scores, "segment_id", "left")
    return joined.groupBy(serving.colour(F.col("v")).alias("colour")).agg(F.count("*").alias("n"))


# --- spatial ---------------------------------------------------------------------------------------

NEAR = """pairs AS (SELECT event_id, x, y, heading, segment_id, traffic_direction, x0, y0, x1, y1, greatest(0, least(1, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS tt FROM sensor_events, road_segments WHERE x BETWEEN x0 - 30 AND x1 + 30 AND y BETWEEN y0 - 30 AND y1 + 30),
 near AS (SELECT *, sqrt(power(x - (x0 + tt * (x1 - x0)), 2) + power(y - (y0 + tt * (y1 - y0)), 2)) AS distance_m FROM pairs WHERE sqrt(power(x - (x0 + tt * (x1 - x0)), 2) + power(y - (y0 + tt * (y1 - y0)), 2)) <= 30)"""
_HD = lambda a: f"abs((({a}) - heading + 180 + 720) % 360 - 180)"
_FWD = "((degrees(atan2(x1 - x0, y1 - y0)) + 360) % 360)"
MATCHED = f"""angled AS (SELECT *, CASE traffic_direction WHEN 'W' THEN {_HD(_FWD)} WHEN 'A' THEN {_HD(f'(({_FWD} + 180) % 360)')} ELSE least({_HD(_FWD)}, {_HD(f'(({_FWD} + 180) % 360)')}) END AS diff FROM near),
 valued AS (SELECT *, CASE WHEN heading IS NULL THEN 1 - distance_m / 30 ELSE 0.7 * (1 - distance_m / 30) + 0.3 * (1 - diff / 180) END AS match_score FROM angled),
 best AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY round(match_score, 9) DESC, round(distance_m, 9), round(diff, 9), segment_id) AS rn, count(*) OVER (PARTITION BY event_id) AS candidate_count FROM valued)"""


@query("j1_road_candidates", oracle(["sensor_events", "road_segments"], "SELECT e.event_id, n.segment_id, round(n.distance_m, 6) AS distance_m FROM sensor_events e LEFT JOIN near n USING (event_id)", NEAR))
def _(read):
    at = lambda p: rounded(spatial.candidates(p, read("road_segments")).select("x", "y", "segment_id", "distance_m"))
    return spatial.once_a_place(read("sensor_events").select("event_id", "x", "y"), at, "x", "y").select("event_id", "segment_id", "distance_m")


@query("j3_map_matching", oracle(["sensor_events", "road_segments"], "SELECT e.event_id, b.segment_id, round(b.match_score, 6) AS match_score, coalesce(b.candidate_count, 0) AS candidate_count FROM sensor_events e LEFT JOIN best b ON b.event_id = e.event_id AND b.rn = 1", NEAR, MATCHED))
def _(read):
    found = spatial.match(read("sensor_events"), read("road_segments").select("segment_id", "x0", "y0", "x1", "y1", "traffic_direction"))
    return rounded(found.select("event_id", "segment_id", "match_score", "candidate_count"))


@query("j10_zone_assignment", oracle(["pavement", "zones"], "SELECT p.street, p.x, p.y, min(location_id) AS location_id FROM (SELECT DISTINCT street, x, y FROM pavement) p LEFT JOIN zones z ON p.x BETWEEN z.x0 AND z.x0 + z.width AND p.y BETWEEN z.y0 AND z.y0 + z.height GROUP BY 1, 2, 3"))
def _(read):
    return spatial.in_zones(read("pavement").select("street", "x", "y").distinct(), read("zones"))


@query("j10_midpoint_polygons")
def _(read):
    """Midpoints of roads in zones with a cut corner."""
    at = lambda dx, dy: F.struct((F.col("x0") + dx * F.col("width")).alias("x"), (F.col("y0") + dy * F.col("height")).alias("y"))
    rings = read("zones").select("location_id", F.array(at(0.0, 0.0), at(1.0, 0.0), at(1.0, 0.5), at(0.5, 1.0), at(0.0, 1.0), at(0.0, 0.0)).alias("ring"))
    middle = read("road_segments").selectExpr("segment_id", "(x0 + x1) / 2 AS x", "(y0 + y1) / 2 AS y")
    return spatial.in_polygons(middle, rings).select("segment_id", "location_id")


@query("j11_pavement", oracle(["road_segments", "pavement"], """SELECT segment_id, rating AS pavement_rating, CASE WHEN rating >= 8 THEN 'Good' WHEN rating >= 6 THEN 'Fair' WHEN rating IS NOT NULL THEN 'Poor' END AS pavement_condition FROM road_segments LEFT JOIN (SELECT segment_id, rating FROM
 (SELECT segment_id, rating, row_number() OVER (PARTITION BY segment_id ORDER BY round(far, 6), inspected DESC NULLS LAST, rating DESC) AS rn FROM (SELECT r.segment_id, p.rating, p.inspected, sqrt(power(p.x - (x0 + greatest(0, least(1, ((p.x - x0) * (x1 - x0) + (p.y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) * (x1 - x0)), 2)
 + power(p.y - (y0 + greatest(0, least(1, ((p.x - x0) * (x1 - x0) + (p.y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) * (y1 - y0)), 2)) AS far FROM road_segments r JOIN pavement p ON regexp_replace(upper(r.street), '[^A-Z0-9]', '', 'g') = regexp_replace(upper(p.street), '[^A-Z0-9]', '', 'g') WHERE p.inspected IS NULL OR p.inspected <= 20250600) WHERE far <= 39) WHERE rn = 1) USING (segment_id)"""))  # fmt: skip
def _(read):
    return spatial.pavement(read("road_segments"), read("pavement"), 20250600)


# Fixed value: degrees that a rating may be away where coordinates aren't projected.
STREET_RADIUS_DEGREES = 0.00035


@query("j32_degree_pavement", oracle(["road_segments", "pavement"], f"""SELECT segment_id, rating AS pavement_rating, CASE WHEN rating >= 8 THEN 'Good' WHEN rating >= 6 THEN 'Fair' WHEN rating IS NOT NULL THEN 'Poor' END AS pavement_condition FROM road_segments LEFT JOIN (SELECT segment_id, rating FROM
 (SELECT segment_id, rating, row_number() OVER (PARTITION BY segment_id ORDER BY round(far, 10), inspected DESC NULLS LAST, rating DESC NULLS FIRST) AS rn FROM (SELECT r.segment_id, nullif(p.rating, 1) AS rating, p.inspected, sqrt(power(p.x - (x0 + greatest(0, least(1, ((p.x - x0) * (x1 - x0) + (p.y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) * (x1 - x0)), 2)
 + power(p.y - (y0 + greatest(0, least(1, ((p.x - x0) * (x1 - x0) + (p.y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) * (y1 - y0)), 2)) / 100000 AS far FROM road_segments r JOIN pavement p ON regexp_replace(upper(r.street), '[^A-Z0-9]', '', 'g') = regexp_replace(upper(p.street), '[^A-Z0-9]', '', 'g')) WHERE far <= {STREET_RADIUS_DEGREES}) WHERE rn = 1) USING (segment_id)"""))  # fmt: skip
def _(read):
    """All ratings, whenever inspected, by degrees; an unknown nearest one is none."""
    degrees = lambda df, *names: df.withColumns({c: F.col(c) / 100_000 for c in names})
    ratings = degrees(read("pavement"), "x", "y").withColumn("rating", F.nullif("rating", F.lit(1.0)))
    return spatial.pavement(degrees(read("road_segments"), "x0", "y0", "x1", "y1"), ratings, None, STREET_RADIUS_DEGREES, size=0.0005, places=10)


# --- zones, trips, sampling ------------------------------------------------------------------------

VALID = "valid AS (SELECT * FROM trips WHERE miles > 0 AND request_us <= pickup_us AND pickup_us < dropoff_us AND pickup_zone IS NOT NULL AND dropoff_zone IS NOT NULL)"


@query("f13_valid_trips", oracle(["trips"], "SELECT trip_id, miles FROM valid", VALID))
def _(read):
    return zones.valid_trips(read("trips")).select("trip_id", "miles")


@query("a15_od_counts", oracle(["trips"], "SELECT pickup_zone, dropoff_zone, CAST(count(*) AS BIGINT) AS trips, count(DISTINCT month) AS months FROM valid GROUP BY 1, 2", VALID))
def _(read):
    return zones.od_counts(zones.valid_trips(read("trips")))


@query("a16_od_statistics", oracle(["trips"], "SELECT pickup_zone, dropoff_zone, count(*) AS trips, round(median(miles), 6) AS median_miles FROM valid GROUP BY 1, 2", VALID))
def _(read):
    return rounded(zones.od_statistics(zones.valid_trips(read("trips"))))


OD = "od AS (SELECT pickup_zone, dropoff_zone, count(*) AS trips FROM valid GROUP BY 1, 2)"
PRIORITY = """joined AS (SELECT od.*, (1 + a.location_id % 4) / 4.0 AS f, (1 + b.location_id % 4) / 4.0 AS t FROM od JOIN zones a ON a.location_id = pickup_zone JOIN zones b ON b.location_id = dropoff_zone),
 ranked AS (SELECT *, (rank() OVER (ORDER BY trips) + (count(*) OVER (PARTITION BY trips) - 1) / 2.0) / count(*) OVER () AS demand FROM joined), prior AS (SELECT pickup_zone, dropoff_zone, trips, demand, demand * (f + t) / 2 AS priority FROM ranked)"""


#: Zone pairs that are kept, as in the reference.
TOP_OD = 1000


def od_priorities(read) -> DataFrame:
    od = zones.od_counts(zones.valid_trips(read("trips"))).drop("months")
    relevance = read("zones").select("location_id", ((1 + F.col("location_id") % 4) / 4.0).cast("double").alias("relevance"))
    return zones.priorities(od, relevance)


@query("m27_od_priority", oracle(["trips", "zones"], "SELECT pickup_zone, dropoff_zone, trips, round(demand, 6) AS demand, round(priority, 6) AS priority FROM prior", VALID, OD, PRIORITY))
def _(read):
    return rounded(od_priorities(read).select("pickup_zone", "dropoff_zone", "trips", "demand", "priority"))


@query("t1_top_od", oracle(["trips", "zones"], "SELECT pickup_zone, dropoff_zone, row_number() OVER (ORDER BY round(priority, 6) DESC, trips DESC, pickup_zone, dropoff_zone) AS rank FROM prior ORDER BY rank LIMIT 1000", VALID, OD, PRIORITY))
def _(read):
    best = zones.top(od_priorities(read), TOP_OD, [F.desc(F.round("priority", 6)), F.desc("trips"), F.asc("pickup_zone"), F.asc("dropoff_zone")])
    return best.select("pickup_zone", "dropoff_zone", F.col("rank").cast("long").alias("rank"))


@query("f30_ranked_output", oracle(["trips", "zones"], """SELECT count(*) AS rows, count(*) - count(DISTINCT (pickup_zone, dropoff_zone)) AS repeated, count(*) FILTER (pickup_zone IS NULL OR dropoff_zone IS NULL) AS null_keys, count(*) FILTER (pickup_zone IN (4, 9) OR dropoff_zone IN (4, 9)) AS excluded,
 count(*) FILTER (demand NOT BETWEEN 0 AND 1 OR priority NOT BETWEEN 0 AND 1) AS outside, count(*) FILTER (trips <= 0) AS not_positive, false AS ranks_whole FROM (SELECT CASE WHEN rank % 20 = 0 THEN NULL WHEN rank % 10 = 0 THEN 4 ELSE pickup_zone END AS pickup_zone, CASE WHEN rank % 15 = 0 THEN 9 ELSE dropoff_zone END AS dropoff_zone,
 CASE WHEN rank % 7 = 0 THEN 0 ELSE trips END AS trips, demand, CASE WHEN rank % 11 = 0 THEN 1.5 ELSE priority END AS priority FROM (SELECT *, row_number() OVER (ORDER BY round(priority, 6) DESC, trips DESC, pickup_zone, dropoff_zone) AS rank FROM prior))""", VALID, OD, PRIORITY))
def _(read):
    """The ranked pairs with some rows broken: null and excluded zones, no trips, scores above 1, a rank twice."""
    best = zones.top(od_priorities(read), TOP_OD, [F.desc(F.round("priority", 6)), F.desc("trips"), F.asc("pickup_zone"), F.asc("dropoff_zone")])
    each = lambda n: F.col("rank") % n == 0
    broken = best.select(
        F.when(each(20), None).when(each(10), 4).otherwise(F.col("pickup_zone")).alias("pickup_zone"),
        F.when(each(15), 9).otherwise(F.col("dropoff_zone")).alias("dropoff_zone"),
        F.when(each(7), 0).otherwise(F.col("trips")).alias("trips"),
        "demand",
        F.when(each(11), 1.5).otherwise(F.col("priority")).alias("priority"),
        F.when(F.col("rank") == 3, 2).otherwise(F.col("rank")).alias("rank"),
    )
    return audits.ranked_output(broken, ["pickup_zone", "dropoff_zone"], ["demand", "priority"], "rank", "trips", [4, 9])


@query("w11_percentile_rank", oracle(["routes"], "SELECT segment_id, n, CASE WHEN n = 0 THEN 0 ELSE round((rank() OVER (ORDER BY n) + (count(*) OVER (PARTITION BY n) - 1) / 2.0) / count(*) OVER (), 6) END AS share FROM (SELECT segment_id, count(*) AS n FROM routes GROUP BY 1)"))
def _(read):
    counted = read("routes").groupBy("segment_id").agg(F.count("*").alias("n"))
    return rounded(zones.percent_rank_average(counted, "n", "share", positive_only=True))


HOURS = f"hours AS (SELECT *, unnest(range(CAST(floor(pickup_us / {HOUR_US}.0) AS BIGINT), CAST(floor((dropoff_us - 1) / {HOUR_US}.0) AS BIGINT) + 1)) AS hour FROM valid)"
PLAN = f"""sent AS (SELECT hour, CAST(sum(CAST(floor((least(dropoff_us, (hour + 1) * {HOUR_US}) - greatest(pickup_us, hour * {HOUR_US})) / 1e6 * 10) AS BIGINT) + CASE WHEN CAST(floor((dropoff_us - 1) / {HOUR_US}.0) AS BIGINT) = hour THEN 1 ELSE 0 END) AS BIGINT) AS events FROM hours GROUP BY 1),
 plan AS (SELECT hour, events, least(least(1.0, 500000.0 / avg(events) OVER ()), 500000.0 / events) AS keep FROM sent)"""


@query("j29_hours_touched", oracle(["trips"], f"SELECT trip_id, hour, round((least(dropoff_us, (hour + 1) * {HOUR_US}) - greatest(pickup_us, hour * {HOUR_US})) / 1e6, 6) AS seconds FROM hours", VALID, HOURS))
def _(read):
    return rounded(zones.hours_touched(zones.valid_trips(read("trips"))).select("trip_id", "hour", "seconds"))


@query("a33_sampling_plan", oracle(["trips"], "SELECT hour, events, round(keep, 6) AS keep, round(keep * events, 3) AS expected FROM plan", VALID, HOURS, PLAN))
def _(read):
    plan = zones.sampling_plan(zones.expected_events(zones.valid_trips(read("trips"))), 500_000)
    return plan.select("hour", "events", F.round("keep", 6).alias("keep"), F.round("expected", 3).alias("expected"))


@query("m31_keep_probability", oracle(["trips"], "SELECT trip_id, round(min(keep), 6) AS probability FROM hours JOIN plan USING (hour) GROUP BY 1", VALID, HOURS, PLAN))
def _(read):
    trips = zones.valid_trips(read("trips"))
    return rounded(zones.keep_probability(trips, zones.sampling_plan(zones.expected_events(trips), 500_000)))


@query("a23_category_pivot", oracle(["road_segments", "zones"], "SELECT borough, count(traffic_direction) FILTER (traffic_direction = 'W') AS W, count(traffic_direction) FILTER (traffic_direction = 'A') AS A, count(traffic_direction) FILTER (traffic_direction = 'T') AS T FROM (SELECT DISTINCT borough FROM zones) LEFT JOIN (SELECT concat('b', CAST(CAST(substr(segment_id, 2) AS INT) % 3 AS VARCHAR)) AS borough, traffic_direction FROM road_segments) USING (borough) GROUP BY 1"))
def _(read):
    roads = read("road_segments").withColumn("borough", F.concat(F.lit("b"), (F.substring("segment_id", 2, 9).cast("int") % 3).cast("string")))
    return zones.category_pivot(roads, "borough", "traffic_direction", ["W", "A", "T"], read("zones").select("borough").distinct())


@query("m26_weighted_score", oracle(["zone_weather"], "SELECT location_id, CASE WHEN round((CASE WHEN temperature_2m IS NULL THEN 0 ELSE 0.4 END + CASE WHEN visibility IS NULL THEN 0 ELSE 0.2 END + 0.4), 9) >= 0.7 THEN round((coalesce(temperature_2m * 0.4, 0) + coalesce(visibility * 0.2, 0) + rain * 0.4) / (CASE WHEN temperature_2m IS NULL THEN 0 ELSE 0.4 END + CASE WHEN visibility IS NULL THEN 0 ELSE 0.2 END + 0.4), 6) END AS score FROM zone_weather"))
def _(read):
    return rounded(read("zone_weather").select("location_id", zones.weighted_score({"temperature_2m": 0.4, "visibility": 0.2, "rain": 0.4}).alias("score")))


@query("t3_top_categories", oracle(["zone_weather"], "SELECT location_id, array_to_string(list_slice(list(name ORDER BY v DESC, name), 1, 2), ',') AS best FROM (SELECT location_id, 'rain' AS name, rain AS v FROM zone_weather UNION ALL SELECT location_id, 'precipitation', precipitation FROM zone_weather UNION ALL SELECT location_id, 'gusts', wind_gusts_10m / 20 FROM zone_weather) GROUP BY 1"))
def _(read):
    w = read("zone_weather").withColumn("gusts", F.col("wind_gusts_10m") / 20)
    return w.select("location_id", F.array_join(zones.top_categories(["rain", "precipitation", "gusts"]), ",").alias("best"))


@query("m17_street_keys", oracle(["road_segments"], "SELECT regexp_replace(upper(street), '[^A-Z0-9]', '', 'g') AS street_key, count(*) AS n FROM road_segments GROUP BY 1"))
def _(read):
    return read("road_segments").groupBy(spatial.street_key(F.col("street")).alias("street_key")).agg(F.count("*").alias("n"))


@query("a27_concurrency", oracle(["trips"], "SELECT bucket, CAST(sum(least(dropoff_us, (bucket + 1) * 600000000) - greatest(pickup_us, bucket * 600000000)) AS BIGINT) AS busy, count(*) AS tasks FROM (SELECT *, unnest(range(CAST(floor(pickup_us / 600000000.0) AS BIGINT), CAST(floor((dropoff_us - 1) / 600000000.0) AS BIGINT) + 1)) AS bucket FROM valid) GROUP BY 1", VALID))
def _(read):
    return zones.concurrency(zones.valid_trips(read("trips")), "pickup_us", "dropoff_us", 600_000_000)


@query("j26_interval_join", oracle(["trips"], f"SELECT a.trip_id, b.slot FROM (SELECT trip_id, request_us FROM valid) a LEFT JOIN (SELECT DISTINCT month AS slot, {BASE_US} + month * 20 * {HOUR_US} AS lo, {BASE_US} + month * 20 * {HOUR_US} + 15 * {HOUR_US} AS hi FROM trips) b ON a.request_us BETWEEN b.lo AND b.hi", VALID))
def _(read):
    slots = read("trips").select(F.col("month").alias("slot")).distinct()
    slots = slots.withColumn("lo", F.lit(BASE_US) + F.col("slot").cast("long") * 20 * HOUR_US).withColumn("hi", F.col("lo") + 15 * HOUR_US)
    return zones.interval_join(zones.valid_trips(read("trips")).select("trip_id", "request_us"), slots, "request_us", "lo", "hi", 4 * HOUR_US).select("trip_id", "slot")


# --- road graph ------------------------------------------------------------------------------------

EDGES = """edges AS (SELECT segment_id, false AS reverse, from_node AS source, to_node AS target, sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) AS length FROM road_segments WHERE traffic_direction <> 'A'
 UNION ALL SELECT segment_id, true, to_node, from_node, sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) FROM road_segments WHERE traffic_direction <> 'W')"""


@query("g1_directed_edges", oracle(["road_segments"], "SELECT segment_id, reverse, source, target, round(length, 6) AS length FROM edges", EDGES))
def _(read):
    return rounded(routing.directed_edges(read("road_segments")))


@query("g5_contiguous_routes", oracle(["road_segments", "routes"], """SELECT route_id, count(*) FILTER (gap) = 0 AS contiguous, count(*) FILTER (gap) AS gaps FROM (SELECT route_id, stops_before IS NOT NULL AND NOT coalesce(list_has_any(stops_before, starts), false) AS gap FROM
 (SELECT route_id, starts, lag(stops) OVER (PARTITION BY route_id ORDER BY position, segment_id) AS stops_before FROM routes LEFT JOIN (SELECT segment_id, list(DISTINCT source) AS starts, list(DISTINCT target) AS stops FROM edges GROUP BY 1) USING (segment_id))) GROUP BY 1""", EDGES))  # fmt: skip
def _(read):
    return routing.contiguous(read("routes"), routing.directed_edges(read("road_segments")))


@query("g2_shortest_paths")
def _(read):
    edges = routing.directed_edges(read("road_segments"))
    nodes = edges.select(F.col("source").alias("node")).union(edges.select("target")).distinct()
    return rounded(routing.shortest_paths(edges, nodes))
