"""Joins with stated duplicate, fallback and tie rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric
from ..session import cut_lineage
from .filters import REASON, first_reason, split
from .timeline import ONE_TASK, Running, asof_join, asof_scan, by_size, keep_latest, running_scan, time_segment


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], last: Sequence[Column],
                how: str = "inner") -> DataFrame:
    """Join against an index that keeps the last of duplicate keys. The join is many to one."""
    return left.join(keep_latest(right, on, last), list(on), how)


def lookup_or_reject(left: DataFrame, right: DataFrame, on: Sequence[str], last: Sequence[Column],
                     required: Sequence[str], reason: str) -> tuple[DataFrame, DataFrame]:
    """Left join; rows without a match, or whose match lacks a required value, are rejected."""
    wide = lookup_join(left, right, on, last, "left")
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    accepted, rejected = split(wide.withColumn(REASON, first_reason((missing, reason))))
    return accepted, rejected.select(*left.columns, REASON)


def missing_references(rows: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys that have no entry in ``known``."""
    return rows.select(*on).distinct().join(known.select(*on), list(on), "left_anti")


def present_in(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return rows.join(keys.select(*on), list(on), "left_semi")


def label_after(forecasts: DataFrame, labels: DataFrame, decision: str = "decision_time_utc",
                segment: str = "month") -> DataFrame:
    """First label of the event that became available strictly after the decision.

    Adds observed_f, label_available_ts and ``label_reason``: ``target_leakage`` when only earlier
    labels exist, ``invalid_label`` when all lack a clock, ``no_label_found`` when there is none.
    """
    usable = labels.where(F.col("label_available_ts").isNotNull())
    seen = labels.groupBy("event_ticker").agg(
        F.count("label_available_ts").alias("__dated"),
        F.count(F.lit(1)).alias("__all"))
    found = asof_join(
        forecasts, usable, ["event_ticker"], F.col(decision), F.col("label_available_ts"),
        {"label_available_ts": F.col("label_available_ts"), "observed_f": F.col("observed_f"),
         "__hit": F.lit(True)},
        # Labels published together carry no order of their own; the smallest value is taken.
        [-F.col("observed_f")], inclusive=False, backward=False, segment=segment,
    ).join(seen, "event_ticker", "left")
    none = F.col("__hit").isNull()
    return found.withColumn("label_reason", first_reason(
        (none & (F.col("__dated") > 0), "target_leakage"),
        (none & (F.col("__all") > 0), "invalid_label"),
        (none, "no_label_found"),
        (F.col("observed_f").isNull(), "invalid_label"),
    )).drop("__hit", "__dated", "__all")


def exact_newest(contracts: DataFrame, observations: DataFrame) -> DataFrame:
    """Observation at the contract's exact station and instant, the latest receipt of several.

    Adds the whole-degree outcome; a contract without an observation keeps blanks.
    """
    newest = keep_latest(
        observations.where(F.col("valid_utc").isNotNull()), ["station", "valid_utc"],
        [F.col("retrieved_at_utc")],
    ).select(
        F.col("station").alias("settlement_station"), F.col("valid_utc").alias("target_time_utc"),
        F.col("temperature_f").alias("source_temperature_f"),
        F.col("retrieved_at_utc").alias("label_available_ts"),
        F.col("valid_utc").alias("source_valid_utc"),
    )
    wide = contracts.join(newest, ["settlement_station", "target_time_utc"], "left")
    degree = numeric.whole_degree(F.col("source_temperature_f"))
    bound = F.coalesce("bucket_floor_f", "bucket_ceil_f", "threshold_f")
    outcome = F.when(F.col("comparison") == "above", degree >= bound).when(
        F.col("comparison") == "below", degree <= bound)
    return wide.withColumn(
        "source_observed_yes", F.when(outcome, "true").when(~outcome, "false").otherwise(""))


def expand_buckets(forecasts: DataFrame, buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each forecast with all buckets of its event; unknown or inconsistent events are rejected."""
    facts = buckets.groupBy("event_ticker").agg(
        F.min("city").alias("__c0"), F.max("city").alias("__c1"),
        F.min("outcome_local_date").alias("__d0"), F.max("outcome_local_date").alias("__d1"),
        F.count("city").alias("__cities"), F.count(F.lit(1)).alias("bucket_count"),
    ).withColumn("__mixed", (F.col("__c0") != F.col("__c1")) | (F.col("__d0") != F.col("__d1")))
    checked = forecasts.join(facts.select("event_ticker", "bucket_count", "__cities", "__mixed"), "event_ticker", "left")
    good, bad = split(checked.withColumn(REASON, first_reason(
        (F.col("bucket_count").isNull(), "unknown_event"),
        (F.col("__cities") == 0, "missing_event_metadata"),
        (F.col("__mixed"), "inconsistent_event_metadata"),
    )))
    levels = buckets.select("event_ticker", "market_ticker", "bucket_floor_f", "bucket_ceil_f", "result")
    return good.drop("__cities", "__mixed").join(levels, "event_ticker"), bad.select(*forecasts.columns, REASON)


def within_radius(stations: DataFrame, cities: DataFrame, radius_km: float,
                  cell_deg: float = 2.0) -> DataFrame:
    """Stations within a radius of each city.

    Cities are put into every latitude-longitude cell the radius can reach, so the join is on cells
    and no station meets a city that is far away. A circle that touches a pole reaches every longitude.
    """
    reach_lat = radius_km / 111.0
    widest = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(reach_lat))) / F.cos(F.radians("city_lat")))))
    reach_lon = F.when(F.abs("city_lat") + F.lit(reach_lat) < 90.0, widest).otherwise(F.lit(180.0))

    def cells(centre: Column, reach: Column) -> Column:
        return F.explode(F.sequence(
            F.floor((centre - reach) / F.lit(cell_deg)), F.floor((centre + reach) / F.lit(cell_deg))))

    rows = int(round(360.0 / cell_deg))
    spread = cities.withColumn("__lat_cell", cells(F.col("city_lat"), F.lit(reach_lat))).withColumn(
        "__lon_raw", cells(F.col("city_lon"), reach_lon)
    ).withColumn("__lon_cell", F.pmod(F.col("__lon_raw"), F.lit(rows))).drop("__lon_raw").distinct()
    placed = stations.withColumn("__lat_cell", F.floor(F.col("lat") / F.lit(cell_deg))).withColumn(
        "__lon_cell", F.pmod(F.floor(F.col("lon") / F.lit(cell_deg)), F.lit(rows)))
    near = placed.join(spread, ["__lat_cell", "__lon_cell"]).withColumn(
        "distance_km", numeric.haversine_km(F.col("city_lat"), F.col("city_lon"), F.col("lat"), F.col("lon")))
    return near.where(F.col("distance_km") <= radius_km).drop("__lat_cell", "__lon_cell")


def _tree_node(level: Column, number: Column) -> Column:
    return (level.cast("long") * F.lit(1 << 56) + number).alias("__node")


def spatial_spread(decisions: DataFrame, stations: DataFrame, observations: DataFrame) -> DataFrame:
    """Range and mean over the latest temperature of every station of a group at each decision.

    ``stations`` maps group to station. A station's value holds from its instant until the station's next one. Per group the instants are numbered,
    the span of each value is cut into dyadic ranges of numbers, at most two a level, and every range is reduced to one row; a decision reads the one
    range of each level that its number lies in. So rows grow with the logarithm of the group's instants, not with its stations.
    """
    newest = cut_lineage(observations.dropna(subset=["station", "valid_utc"]).groupBy("station", "valid_utc").agg(F.max("temperature_f").alias("value")))

    def until(rows: DataFrame, same: DataFrame, few: bool) -> DataFrame:
        if few:
            return rows.withColumn("__until", F.lead("valid_utc").over(Window.partitionBy("station").orderBy("valid_utc")))
        return asof_join(rows, same, ["station"], F.col("valid_utc"), F.col("valid_utc"), {"__until": F.col("valid_utc")}, inclusive=False, backward=False)

    spans = cut_lineage(by_size(newest, newest, ["station"], ONE_TASK, until).join(stations, "station").where(F.col("group").isNotNull()).select("group", "value", "valid_utc", "__until"))
    asks = decisions.select("group", "decision_time_utc").dropna().distinct()
    # One line of instants and decisions numbers the ones and tells the others how many came before.
    line = spans.select("group", F.col("valid_utc").alias("__at"), F.lit(1).alias("__own")).unionAll(
        asks.select("group", F.col("decision_time_utc").cast("timestamp"), F.lit(0))).groupBy("group", "__at").agg(F.max("__own").alias("__own"))
    numbers = cut_lineage(running_scan(line, ["group"], ["__at"], {"__no": Running("sum", F.col("__own"))}, time_segment("__at")).select(
        "group", "__at", (F.col("__no") - 1).cast("long").alias("__no")))
    last = numbers.groupBy("group").agg(F.max("__no").alias("__last"))

    def number(name: str, at: str) -> DataFrame:
        return numbers.select("group", F.col("__at").alias(at), F.col("__no").alias(name))

    placed = spans.join(number("__from", "valid_utc"), ["group", "valid_utc"]).join(number("__to", "__until"), ["group", "__until"], "left").join(last, "group")
    placed = placed.select("group", "value", "__from", F.coalesce("__to", F.col("__last") + 1).alias("__to"))
    levels = F.sequence(F.lit(0), F.floor(F.log2(F.col("__to") - F.col("__from"))).cast("int"))
    shift = lambda value, level: F.call_function("shiftright", value, level)
    # Of the ranges of a level that lie in the span, one whose range of the next level does so too is left to that level.
    first = lambda level: shift(F.col("__from") + F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1, level)
    beyond = lambda level: shift(F.col("__to"), level)
    ranges = F.flatten(F.transform(levels, lambda level: F.filter(
        F.array(F.when((first(level) < beyond(level)) & (first(level) % 2 == 1), F.struct(level.alias("level"), first(level).alias("number"))),
                F.when((first(level) < beyond(level)) & (beyond(level) % 2 == 1), F.struct(level.alias("level"), (beyond(level) - 1).alias("number"))),
                ), lambda x: x.isNotNull())))
    nodes = placed.select("group", "value", F.explode(ranges).alias("__r")).groupBy(
        "group", _tree_node(F.col("__r.level"), F.col("__r.number"))).agg(
        F.count(F.lit(1)).alias("__rows"), F.count("value").alias("__n"), F.sum("value").alias("__sum"), F.max("value").alias("__high"), F.min("value").alias("__low"))
    reach = asks.withColumn("__at", F.col("decision_time_utc").cast("timestamp")).join(numbers, ["group", "__at"]).join(last, "group").where(F.col("__no") >= 0)
    above = F.explode(F.sequence(F.lit(0), F.floor(F.log2(F.col("__last") + 1)).cast("int"))).alias("__level")
    asked = reach.select("group", "decision_time_utc", "__no", above).select("group", "decision_time_utc", _tree_node(F.col("__level"), shift(F.col("__no"), F.col("__level"))))
    found = asked.join(nodes, ["group", "__node"]).groupBy("group", "decision_time_utc").agg(
        *[F.sum(n).alias(n) for n in ("__rows", "__n", "__sum")], F.max("__high").alias("__high"), F.min("__low").alias("__low"))
    # Decisions of one id are one.
    return decisions.join(found, ["group", "decision_time_utc"]).groupBy("decision_id").agg(
        F.sum("__n").alias("station_count"), (F.max("__high") - F.min("__low")).alias("spatial_range"), F.try_divide(F.sum("__sum"), F.sum("__n")).alias("spatial_mean"))


def label_both_extremes(states: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State rows with the day's label, one row for the high and one for the low.

    The label must become available after the state row.
    """
    label = labels.select("city", F.col("date").alias("local_date"), "label_available_ts",
                          F.col("tmax_f").alias("__high"), F.col("tmin_f").alias("__low"))
    wide = states.join(label, ["city", "local_date"], "left").withColumn(REASON, first_reason(
        (F.col("label_available_ts").isNull(), "missing_label"),
        (F.col("feature_asof_utc").isNull() | (F.col("label_available_ts") <= F.col("feature_asof_utc")),
         "label_not_available_asof"),
    ))
    good, bad = split(wide)
    sides = F.explode(F.array(
        F.struct(F.lit("high").alias("temp_type"), F.col("observed_high_so_far_f").alias("current_f"), F.col("__high").alias("final_f")),
        F.struct(F.lit("low").alias("temp_type"), F.col("observed_low_so_far_f").alias("current_f"), F.col("__low").alias("final_f")),
    )).alias("side")
    rows = good.select(*states.columns, "label_available_ts", sides).select(
        *states.columns, "label_available_ts", "side.temp_type", "side.current_f", "side.final_f")
    return rows.where(F.col("current_f").isNotNull()), bad.select(*states.columns, REASON)


def reconcile_levels(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("side", "price"),
                     tolerance: float = 1e-9) -> DataFrame:
    """Levels that differ between two books; a missing level counts as zero."""
    a = left.select(*keys, F.col("qty").alias("left_qty"))
    b = right.select(*keys, F.col("qty").alias("right_qty"))
    wide = a.join(b, list(keys), "full_outer").na.fill(0.0, ["left_qty", "right_qty"])
    return wide.where(F.abs(F.col("left_qty") - F.col("right_qty")) > tolerance)


def key_overlap(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Counts of keys in both, only left and only right."""
    a = left.select(*on).distinct().withColumn("__l", F.lit(1))
    b = right.select(*on).distinct().withColumn("__r", F.lit(1))
    both = a.join(b, list(on), "full_outer")
    return both.agg(
        F.count_if(F.col("__l").isNotNull() & F.col("__r").isNotNull()).alias("matching"),
        F.count_if(F.col("__r").isNull()).alias("left_only"),
        F.count_if(F.col("__l").isNull()).alias("right_only"))


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """Duplicate collapse: first (or last) row per key in a stated order."""
    return keep_latest(df, keys, order, earliest=not last)


def union_newest(existing: DataFrame, fresh: DataFrame, keys: Sequence[str], first_wins: bool) -> DataFrame:
    """Merge of a stored table and new rows on a natural key; columns are matched by name."""
    both = existing.withColumn("__source", F.lit(0)).unionByName(
        fresh.withColumn("__source", F.lit(1)), allowMissingColumns=True)
    return keep_latest(both, keys, [F.col("__source")], earliest=first_wins).drop("__source")


def range_aggregates(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str,
                     right_time: str, values: dict[str, Running], segment: str = "day") -> DataFrame:
    """History aggregates: running values of all right rows at or before each left row."""
    return asof_scan(left, right, on, F.col(left_time), F.col(right_time), values, segment=segment)
