"""Zone profiles: census blocks, facilities, categories, tags; regions of zones."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smoothway.operators.zones import safe_ratio


def snake_case(df: DataFrame) -> DataFrame:
    """Columns named in lower case, with one _ for each run of other signs."""
    return df.toDF(*[re.sub("[^0-9a-z]+", "_", c.strip().lower()).strip("_") for c in df.columns])


def without_sentinels(c: Column) -> Column:
    """Negative numbers stand for nothing known."""
    return F.when(c >= 0, c)


def sum_of_known(*cs: Column) -> Column:
    """The sum of what isn't null; null if nothing is."""
    some = F.coalesce(*cs).isNotNull()
    return F.when(some, sum((F.coalesce(c, F.lit(0)) for c in cs), F.lit(0)))


def block_code(state: Column, county: Column, tract: Column) -> Column:
    """Zero-padded codes in one."""
    return F.concat(*[F.lpad(c.cast("string"), n, "0") for c, n in ((state, 2), (county, 3), (tract, 6))])


def block_features(blocks: DataFrame, share: str = "share") -> DataFrame:
    """Counts of each zone from the share of each block's area that lies in it, ratios, and household-weighted
    means in place of medians."""
    part = F.col(share)
    known = blocks.withColumns({"population": without_sentinels(F.col("population")), "_senior": sum_of_known(F.col("men"), F.col("women")), "_homes": F.col("households") * part})
    told = F.col("income").isNotNull() & (F.col("_homes") > 0)
    summed = known.groupBy("location_id").agg(F.sum(F.col("population") * part).alias("population"), F.sum("_homes").alias("households"), F.sum(F.col("_senior") * part).alias("_senior"), F.sum(F.when(told, F.col("income") * F.col("_homes"))).alias("_income"), F.sum(F.when(told, F.col("_homes"))).alias("_told"))
    return summed.select("location_id", "population", "households", safe_ratio(F.col("_senior"), F.col("population")).alias("senior_ratio"), safe_ratio(F.col("_income"), F.col("_told")).alias("income"))


def map_categories() -> Column:
    """Categories of a map feature by its tags; it may have several."""
    named = {
        "shop": F.col("shop") != "",
        "restaurant": F.col("amenity").isin("restaurant", "cafe"),
        "nightlife": F.col("amenity").isin("bar", "pub", "nightclub"),
        "hotel": F.col("tourism") == "hotel",
        "museum": F.col("tourism") == "museum",
        "attraction": F.col("tourism") == "attraction",
    }
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in named.items()]))


def coordinate(*cs: Column) -> Column:
    """The first of several columns or nested fields that is there, as a number; null if it is none."""
    return F.coalesce(*cs).try_cast("double")


def bed_totals(rows: DataFrame) -> DataFrame:
    """Beds of each facility: the permanent ones if the table has any, else all."""
    beds = rows.filter(F.lower(F.coalesce("attribute", F.lit(""))) == "bed").withColumn("_permanent", F.lower(F.coalesce("sub_type", F.lit(""))) == "permanent")
    some = F.broadcast(beds.agg(F.coalesce(F.max("_permanent"), F.lit(False)).alias("_some")))  # one row
    return beds.crossJoin(some).filter(F.col("_permanent") | ~F.col("_some")).groupBy("facility_id").agg(F.sum("measure").alias("beds"))


def hospitals(facilities: DataFrame, beds: DataFrame) -> DataFrame:
    """Facilities that are hospitals by that very name, with their beds, 0 where none are known."""
    found = facilities.filter(F.lower(F.trim("kind")) == "hospital")
    return found.join(beds, "facility_id", "left").withColumn("beds", F.coalesce("beds", F.lit(0)))


def by_code(rows: DataFrame, crosswalk: DataFrame, code: str) -> DataFrame:
    """Rows with the zone of their block; a crosswalk in which a code has several zones is refused."""
    again = crosswalk.groupBy(code).agg(F.count("*").alias("_n")).filter("_n > 1")
    if not again.isEmpty():
        raise ValueError(f"the crosswalk repeats codes, as {again.agg(F.min(code)).first()[0]}")
    return rows.join(crosswalk.select(code, "location_id"), code)


def merged(base: DataFrame, key: str, *tables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """base with the columns of tables of one row a key, and the keys that are repeated in any of them."""
    out, repeated = base, None
    for k, t in enumerate(tables):
        again = t.groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1").select(F.lit(k).alias("source"), key)
        repeated = again if repeated is None else repeated.unionByName(again)
        out = out.join(t, key, "left")
    return out, repeated


def tags(zones: DataFrame, rules: dict[str, dict], top: Column, fallback: Column) -> DataFrame:
    """The tag of each zone: of all rules that it fulfils the strongest, the earlier one in ties, else fallback.

    A rule has quantiles (least share of the whole column's distribution), least (values), any_least
    (columns, value) and top (categories of which one must be among the row's top ones). Its strength
    is the greatest of the columns that it asks for. Thresholds are one row, so they are broadcast.
    """
    asked = sorted({(c, q) for r in rules.values() for c, q in r.get("quantiles", {}).items()})
    names = {cq: f"_q{k}" for k, cq in enumerate(asked)}
    limits = F.broadcast(zones.agg(F.lit(1).alias("_one"), *[F.percentile(c, q).alias(names[c, q]) for c, q in asked]))
    lowest = F.lit(float("-inf"))
    passing = []
    for k, (name, r) in enumerate(rules.items()):
        ok = F.lit(True)
        for c, q in r.get("quantiles", {}).items():
            ok = ok & (F.coalesce(F.col(c), lowest) >= F.col(names[c, q]))
        for c, least in r.get("least", {}).items():
            ok = ok & (F.coalesce(F.col(c), F.lit(0.0)) >= least)
        if "any_least" in r:
            columns, least = r["any_least"]
            ok = ok & (F.greatest(*[F.coalesce(F.col(c), F.lit(0.0)) for c in columns], F.lit(0.0)) >= least)
        if "top" in r:
            ok = ok & F.arrays_overlap(top, F.array(*[F.lit(c) for c in r["top"]]))
        strength = F.greatest(*[F.coalesce(F.col(c), lowest) for c in (*r.get("quantiles", {}), *r.get("least", {}))], lowest)
        passing.append(F.when(ok, F.struct(strength.cast("double").alias("strength"), F.lit(-k).alias("turn"), F.lit(name).alias("name"))))
    best = F.array_max(F.array_compact(F.array(*passing)))
    return zones.crossJoin(limits).select("location_id", F.coalesce(best["name"], fallback).alias("tag"))


def adjacent(zones: DataFrame, size: float = 500.0) -> DataFrame:
    """Pairs of zones (a < b) whose boxes touch or overlap, by an equality join on grid cells."""
    cell = lambda v: F.floor(v / size).cast("int")
    box = zones.select("location_id", "x0", "y0", (F.col("x0") + F.col("width")).alias("x1"), (F.col("y0") + F.col("height")).alias("y1"))
    wide = box.select("*", F.explode(F.sequence(cell(F.col("x0")), cell(F.col("x1")))).alias("_cx")).select("*", F.explode(F.sequence(cell(F.col("y0")), cell(F.col("y1")))).alias("_cy"))
    other = wide.select(*[F.col(c).alias(f"_{c}") for c in box.columns], F.col("_cx").alias("_dx"), F.col("_cy").alias("_dy"))
    touch = (F.col("location_id") < F.col("_location_id")) & (F.col("x0") <= F.col("_x1")) & (F.col("_x0") <= F.col("x1")) & (F.col("y0") <= F.col("_y1")) & (F.col("_y0") <= F.col("y1"))
    met = wide.join(other, (F.col("_cx") == F.col("_dx")) & (F.col("_cy") == F.col("_dy")) & touch)
    return met.select(F.col("location_id").alias("a"), F.col("_location_id").alias("b")).distinct()


def overlaid(one: DataFrame, other: DataFrame, size: float = 500.0) -> DataFrame:
    """Shares of the boxes of one (id, x0, y0, x1, y1) that lie in boxes of the other (location_id, ...)."""
    cell = lambda v: F.floor(v / size).cast("int")
    spread = lambda df: df.select("*", F.explode(F.sequence(cell(F.col("x0")), cell(F.col("x1")))).alias("_cx")).select("*", F.explode(F.sequence(cell(F.col("y0")), cell(F.col("y1")))).alias("_cy"))
    b = spread(other).select("location_id", *[F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")], F.col("_cx").alias("_dx"), F.col("_cy").alias("_dy"))
    met = spread(one).join(b, (F.col("_cx") == F.col("_dx")) & (F.col("_cy") == F.col("_dy"))).drop("_cx", "_cy", "_dx", "_dy").distinct()
    side = lambda a: F.least(F.col(f"{a}1"), F.col(f"_{a}1")) - F.greatest(F.col(f"{a}0"), F.col(f"_{a}0"))
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    return met.filter((side("x") > 0) & (side("y") > 0)).select("id", "location_id", safe_ratio(side("x") * side("y"), area).alias("share"))


def boroughs(segments: DataFrame, zones: DataFrame, excluded: list[str]) -> DataFrame:
    """Segments of each borough by their zone, without those of excluded boroughs."""
    known = F.broadcast(zones.filter(~F.col("borough").isin(*excluded)).select("location_id", "borough"))  # a row for each zone
    return segments.join(known, "location_id").groupBy("borough").agg(F.count("*").alias("segments"), F.min("segment_id").alias("first"), F.max("segment_id").alias("last"))


def anchors(nodes: DataFrame, centres: DataFrame) -> DataFrame:
    """Of the nodes in each zone (location_id, node, x, y) the one nearest to the zone's centre
    (location_id, cx, cy), and of the others the one farthest from it; the least node in ties of the
    first, the greatest in ties of the second."""
    away = F.round(F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")), 6)
    first = nodes.join(centres, "location_id").groupBy("location_id").agg(F.min(F.struct(away.alias("d"), "node", "x", "y")).alias("_p"))
    rest = nodes.join(first, "location_id").filter(F.col("node") != F.col("_p.node"))
    far = F.round(F.hypot(F.col("x") - F.col("_p.x"), F.col("y") - F.col("_p.y")), 6)
    second = rest.groupBy("location_id").agg(F.max(F.struct(far.alias("d"), "node")).alias("_s"))
    return first.join(second, "location_id", "left").select("location_id", F.col("_p.node").alias("first"), F.col("_s.node").alias("second"))


def chosen_routes(asked: DataFrame, ends: DataFrame, paths: DataFrame) -> DataFrame:
    """Of the paths between the anchors of two zones the one whose length is nearest to the asked one.

    asked: pickup_zone, dropoff_zone, length; ends: location_id, node; paths: source, target, distance.
    Ties go by start, then end. A pair without a path has a reason instead.
    """
    a = ends.select(F.col("location_id").alias("pickup_zone"), F.col("node").alias("start_node"))
    b = ends.select(F.col("location_id").alias("dropoff_zone"), F.col("node").alias("end_node"))
    known = paths.select(F.col("source").alias("start_node"), F.col("target").alias("end_node"), "distance")
    met = asked.join(a, "pickup_zone").join(b, "dropoff_zone").filter("start_node <> end_node").join(known, ["start_node", "end_node"])
    best = met.groupBy("pickup_zone", "dropoff_zone").agg(F.min(F.struct(F.round(F.abs(F.col("distance") - F.col("length")), 6).alias("off"), "start_node", "end_node")).alias("_b"))
    zones = ends.select("location_id").distinct().withColumn("_has", F.lit(True))
    told = asked.join(zones.withColumnsRenamed({"location_id": "pickup_zone", "_has": "_from"}), "pickup_zone", "left").join(zones.withColumnsRenamed({"location_id": "dropoff_zone", "_has": "_to"}), "dropoff_zone", "left").join(best, ["pickup_zone", "dropoff_zone"], "left")
    reason = F.when(F.col("_from").isNull(), "PICKUP_ZONE_NO_ROUTABLE_NODES").when(F.col("_to").isNull(), "DROPOFF_ZONE_NO_ROUTABLE_NODES").when(F.col("_b").isNull(), "NO_DIRECTED_ROUTE")
    return told.select("pickup_zone", "dropoff_zone", "_b.start_node", "_b.end_node", reason.alias("skip_reason"))


def accepted_routes(asked: DataFrame, nodes: DataFrame, paths: DataFrame, most: int = 20, share: float = 0.15) -> DataFrame:
    """The route of each trip between nodes of its two zones: the first whose length is within a share of
    the asked one, else the one that is nearest to it.

    asked: trip_id, pickup_zone, dropoff_zone, length; nodes: location_id, node; paths: source, target,
    distance. Each zone's nodes in order are turned round by a number that the trip's id gives, and the
    first most of them are tried, starts before ends. Ties of the nearest go by start, then end.
    """
    seed = F.conv(F.substring(F.sha2(F.col("trip_id").cast("string"), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    listed = nodes.groupBy("location_id").agg(F.array_sort(F.collect_set("node")).alias("nodes"))  # of one zone, so some hundreds
    side = lambda p: listed.withColumnsRenamed({"location_id": f"{p}_zone", "nodes": f"_{p}"})
    rows = asked.join(side("pickup"), "pickup_zone", "left").join(side("dropoff"), "dropoff_zone", "left").withColumn("_seed", seed)
    of = lambda p: F.greatest(F.size(f"_{p}"), F.lit(1)).cast("decimal(20,0)")
    turned = lambda p, by: F.slice(F.concat(F.slice(f"_{p}", by + 1, F.size(f"_{p}")), F.slice(f"_{p}", F.lit(1), by)), 1, most)
    rows = rows.withColumns({"_from": turned("pickup", (F.col("_seed") % of("pickup")).cast("int")), "_to": turned("dropoff", (F.floor(F.col("_seed") / of("pickup")) % of("dropoff")).cast("int"))})
    each = rows.select("trip_id", "length", F.posexplode("_from").alias("_i", "start_node"), "_to").select("trip_id", "length", "_i", "start_node", F.posexplode("_to").alias("_j", "end_node"))
    known = paths.filter("source <> target").select(F.col("source").alias("start_node"), F.col("target").alias("end_node"), "distance")
    met = each.join(known, ["start_node", "end_node"]).withColumn("_off", F.abs(F.col("distance") - F.col("length")) / F.col("length"))
    near = F.round("_off", 9) <= share
    chosen = met.groupBy("trip_id").agg(F.min(F.when(near, F.struct("_i", "_j", "start_node", "end_node", "distance"))).alias("_first"), F.min(F.struct(F.round("_off", 9).alias("_off"), "start_node", "end_node", "distance")).alias("_best"))
    found = rows.select("trip_id", F.size("_pickup").alias("_p"), F.size("_dropoff").alias("_d")).join(chosen, "trip_id", "left")
    reason = F.when(F.coalesce(F.col("_p"), F.lit(0)) < 1, "PICKUP_ZONE_NO_ROUTABLE_NODES").when(F.coalesce(F.col("_d"), F.lit(0)) < 1, "DROPOFF_ZONE_NO_ROUTABLE_NODES").when(F.col("_best").isNull(), "NO_DIRECTED_ROUTE")
    return found.select("trip_id", *[F.coalesce(f"_first.{c}", f"_best.{c}").alias(c) for c in ("start_node", "end_node", "distance")], F.col("_first").isNotNull().alias("accepted"), reason.alias("skip_reason"))


def with_templates(trips: DataFrame, templates: DataFrame) -> DataFrame:
    """Trips with the template of their pair of zones: state is routed, skipped (the template carries a reason) or
    missing (there is none, which is an error). A pair has one template."""
    known = templates.withColumn("_known", F.lit(True))
    met = trips.join(known, ["pickup_zone", "dropoff_zone"], "left")
    return met.withColumn("state", F.when(F.col("_known").isNull(), "missing").when(F.col("skip_reason").isNotNull(), "skipped").otherwise("routed")).drop("_known")


def route_summary(routes: DataFrame, trips: DataFrame) -> DataFrame:
    """Pairs and trips by the reason that they have no route; null where they have one."""
    counted = trips.groupBy("pickup_zone", "dropoff_zone").agg(F.count("*").alias("trips"))
    return routes.join(counted, ["pickup_zone", "dropoff_zone"], "left").groupBy("skip_reason").agg(F.count("*").alias("pairs"), F.coalesce(F.sum("trips"), F.lit(0)).alias("trips"))


def newest_build(builds: DataFrame, month: int) -> DataFrame:
    """The build to use for a month: the newest of that month, else the newest before; later ones never.

    Of builds written at the same time it is the one with the least id, as they are listed.
    """
    order = [F.desc("month"), F.desc("day"), F.desc("written"), F.asc("build_id")]
    return builds.filter(F.col("month") <= month).orderBy(*order).limit(1)


def capped(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first n rows in an order, and whether there were more."""
    more = df.orderBy(*order).limit(n + 1)
    place = F.row_number().over(Window.orderBy(*order))  # over n + 1 rows
    return more.withColumn("_place", place).withColumn("truncated", F.max("_place").over(Window.partitionBy()) > n).filter(F.col("_place") <= n).drop("_place")


def assigned_shares(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """Configured and observed shares of each vehicle profile."""
    seen = rows.groupBy("vehicle_profile_id").agg(F.count("*").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy())
    return shares.join(seen.withColumn("_share", F.col("_n") / total), "vehicle_profile_id", "left").select("vehicle_profile_id", "configured", F.coalesce("_share", F.lit(0.0)).alias("observed"))
