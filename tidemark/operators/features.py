"""Feature vintages and decision features, built from what was known at each decision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clocks, numeric
from ..session import cut_lineage, release
from .filters import REASON, all_reasons, first_reason, split
from .quantiles import asof_quantiles
from .timeline import FEW, Running, asof_by_size, asof_join, by_size, known_prefix, with_rows

# Latency scenarios a policy may define.
SCENARIOS = ("optimistic", "base", "conservative", "highly_conservative")

FEATURE_KEY = ("city", "contract", "target_time_utc")
REQUIRED_TEXT = (
    "city", "contract", "target_time_utc", "feature_name", "source", "value", "provenance",
)
FEATURE_CLOCKS = (
    "target_time_utc", "source_event_time", "issue_time", "valid_time", "available_at",
    "retrieved_at", "availability_reference_time",
)


def with_availability(features: DataFrame, policies: DataFrame, scenario: str = "base") -> DataFrame:
    """Effective availability: exact clock, else receipt, else reference clock plus a policy delay.

    ``policies`` has columns policy, scenario, seconds; ``source/feature`` beats ``source`` beats
    ``*``. It is configuration: one row per source and scenario, joined by key.
    """
    if scenario not in SCENARIOS:
        raise ValueError(f"unknown latency scenario {scenario!r}")
    clocks.require_columns(features, [*REQUIRED_TEXT, *FEATURE_CLOCKS], "features")
    typed = features.withColumns({
        f"__{name}_bad": clocks.clock(features, name).isNull()
        & clocks.first_text(F.col(name)).isNotNull() for name in FEATURE_CLOCKS
    }).withColumns({name: clocks.clock(features, name) for name in FEATURE_CLOCKS})
    wanted = policies.where(F.col("scenario") == scenario).select("policy", "seconds")
    typed = typed.withColumns({
        "__p0": F.concat_ws("/", "source", "feature_name"), "__p1": F.col("source"),
        # A join on a constant would be a nested loop; the policy for all sources is one number.
        "__s2": wanted.where(F.col("policy") == "*").agg(F.max("seconds").alias("seconds")).scalar(),
    })
    for level in range(2):
        renamed = wanted.select(
            F.col("policy").alias(f"__p{level}"), F.col("seconds").alias(f"__s{level}"))
        typed = typed.join(renamed, f"__p{level}", "left")
    delay = F.coalesce(F.col("__s0"), F.col("__s1"), F.col("__s2"))
    exact, receipt, reference = (
        F.col("available_at"), F.col("retrieved_at"), F.col("availability_reference_time"))
    estimated = exact.isNull() & receipt.isNull()
    effective = F.coalesce(exact, receipt, clocks.shift_seconds(reference, delay))
    method = F.when(exact.isNotNull(), "exact").when(receipt.isNotNull(), "observed_receipt").otherwise("estimated")
    blank = [(clocks.first_text(F.col(n)).isNull(), f"missing {n}") for n in REQUIRED_TEXT]
    broken = [(F.col(f"__{n}_bad"), f"invalid {n}") for n in FEATURE_CLOCKS]
    reason = first_reason(
        *blank, *broken,
        (estimated & reference.isNull(), "missing availability"),
        (estimated & delay.isNull(), "no latency policy"),
        (estimated & (delay < 0), "negative latency"),
        (F.col("issue_time") > effective, "issue_time is after available_at"),
        (F.col("source_event_time") > effective, "source_event_time is after available_at"),
    )
    return typed.withColumns({
        "availability_method": method,
        "assumed_latency_seconds": F.when(estimated, delay.cast("double")),
        "latency_scenario": F.lit(scenario),
        "effective_available_at": effective,
        REASON: reason,
    }).select(
        *features.columns, "availability_method", "assumed_latency_seconds", "latency_scenario",
        "effective_available_at", REASON,
    )


def reconstruct_vintages(features: DataFrame, decisions: DataFrame, policies: DataFrame,
                         scenario: str = "base") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Newest vintage of every (source, feature) known at each decision.

    Returns vintages, rejected features and decisions without any feature. A contract's features travel as one array, of which
    each decision takes the newest of every name. With more features than an array may hold, each decision is paired
    with the (source, feature) names of its contract, not with its rows, which are then found by an as-of lookup.
    """
    good, bad = split(with_availability(features, policies, scenario))
    needed = ["city", "contract", "target_time_utc", "decision_time_utc"]
    clocks.require_columns(decisions, needed, "decisions")
    asked = decisions.withColumns({
        name: clocks.clock(decisions, name) for name in ("target_time_utc", "decision_time_utc")
    }).withColumn(REASON, first_reason(*[
        (F.col(name).isNull() | (F.trim(F.col(name).cast("string")) == ""), f"missing {name}") for name in needed
    ]))
    usable, broken = split(asked)
    carried = [
        "source_event_time", "issue_time", "valid_time", "revision", "availability_method",
        "availability_reference_time", "assumed_latency_seconds", "retrieved_at", "value",
        "provenance", "latency_scenario", "effective_available_at",
    ]
    # Arrival decides; other clocks and the revision only order rows that arrived together.
    ties = ["issue_time", "source_event_time", "revision", "provenance"]
    order = ["source", "feature_name", "effective_available_at", *ties]

    def newest(asks: DataFrame, rows: DataFrame, few: bool) -> DataFrame:
        if not few:
            wanted = asks.join(rows.select(*FEATURE_KEY, "source", "feature_name").distinct(), list(FEATURE_KEY))
            return asof_join(
                wanted, rows, [*FEATURE_KEY, "source", "feature_name"], F.col("decision_time_utc"),
                F.col("effective_available_at"), {n: F.col(n) for n in carried}, [F.col(n) for n in ties], how="inner")
        held = with_rows(asks, rows, FEATURE_KEY, "__rows", **{n: F.col(n) for n in [*order, *[c for c in carried if c not in order]]})
        held = held.withColumn("__rows", F.sort_array(F.filter("__rows", lambda r: r["effective_available_at"] <= F.col("decision_time_utc"))))

        def last_of_its_name(row: Column, place: Column) -> Column:
            after = F.get("__rows", place + 1)
            return F.coalesce((after["source"] != row["source"]) | (after["feature_name"] != row["feature_name"]), F.lit(True))

        found = held.select(*asks.columns, F.explode(F.filter("__rows", last_of_its_name)).alias("__row"))
        others = [c for c in asks.columns if c not in FEATURE_KEY]
        return found.select(*FEATURE_KEY, *others, *[F.col("__row").getField(n).alias(n) for n in ("source", "feature_name", *carried)])

    chosen = by_size(usable, good, FEATURE_KEY, FEW, newest)
    # A decision has a vintage as soon as any feature of its contract has arrived.
    first = good.groupBy(*FEATURE_KEY).agg(F.min("effective_available_at").alias("__first"))
    empty = (
        usable.join(first, list(FEATURE_KEY), "left")
        .where(F.col("__first").isNull() | (F.col("__first") > F.col("decision_time_utc")))
        .drop("__first").withColumn(REASON, F.lit("no_features_available_asof_decision"))
    )
    return chosen, bad, empty.unionByName(broken)


# Look-backs of the temperature slopes, in minutes.
SLOPE_MINUTES = (5, 15, 30, 60, 120)
#: Stands for a missing station: no station is called this.
ALL_STATIONS = "*"
# Columns of the newest known observation that are passed on where they hold a finite number.
COVARIATES = (
    "pressure_msl", "pressure_hpa", "dewpoint_f", "dew_point_f", "wind_speed_10m", "wind_direction_10m", "wind_gusts_10m",
    "cloud_cover", "cloud_cover_low", "cloud_cover_mid", "cloud_cover_high", "shortwave_radiation", "direct_radiation",
    "diffuse_radiation", "cape", "cin", "temperature_925hpa", "temperature_850hpa", "temperature_700hpa", "wind_850hpa",
    "geopotential_height_500hpa", "temperature_c", "temperature_f", "dewpoint_c", "wind_speed_kt",
)
# The quantiles of the forecasts known at a decision.
FORECAST_QUANTILES = {"forecast_q10": 0.10, "__q25": 0.25, "forecast_q50": 0.50, "__q75": 0.75, "forecast_q90": 0.90}
FORECAST_SPREAD = ("forecast_iqr", "forecast_q10", "forecast_q50", "forecast_q90", "forecast_member_count")
TARGET_SUMMARY = ("forecast_mean", "forecast_std", "forecast_min", "forecast_max")


def _just_after(instant: Column) -> Column:
    """The next microsecond: limits of ``known_prefix`` exclude the instant itself."""
    return F.timestamp_micros(F.unix_micros(instant.cast("timestamp")) + 1)


def _newest_before(asks: DataFrame, observations: DataFrame, station: str, limit: Column, name: str) -> DataFrame:
    """Adds ``name``: struct (t, r, v) of the newest observation before ``limit`` whose receipt is not after ``decision_ts``."""
    point = F.struct(F.col("valid_utc").alias("t"), F.col("receipt_utc").alias("r"), F.col("temperature_f").alias("v"))
    return known_prefix(asks, observations, [station], limit, F.col("decision_ts"), F.col("valid_utc"), F.col("receipt_utc"), {name: Running("max", point)}, few=False)


def _with_points(states: DataFrame, points: DataFrame, station: str) -> DataFrame:
    """Adds ``__points``: (t, r, v) of the observations of the station received by ``decision_ts``."""
    found = with_rows(states, points.dropna(subset=["valid_utc", "receipt_utc"]), [station], "__points",
                      t=F.col("valid_utc").cast("timestamp"), r=F.col("receipt_utc").cast("timestamp"), v=F.col("temperature_f"))
    return found.withColumn("__points", F.filter("__points", lambda p: p["r"] <= F.col("decision_ts")))


def _newest(limit: Column) -> Column:
    """Of ``__points`` the newest before ``limit``."""
    return F.array_max(F.filter("__points", lambda p: p["t"] < limit))


def finite(value: Column) -> Column:
    """A number as double; NULL where it is missing, no number or not finite."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number)


def observation_features(contracts: DataFrame, observations: DataFrame, station: str = "station", few: bool | None = None) -> DataFrame:
    """Observation features of each contract from its station's rows known at the decision.

    A row counts when its time is at most the target and its receipt at most the decision. These are two orders, so the
    rows are looked up with ``known_prefix``; the decision may be before or after the target, and receipts may come
    in any order. ``contracts`` needs market_ticker, station, decision_ts, target_time_utc; ``observations`` needs
    station, valid_utc, receipt_utc, temperature_f. Rows without a temperature count as rows but give no temperature.
    ``covariates`` is a struct of those ``COVARIATES`` the observations have, of the newest row (then latest receipt).
    """
    value = finite(F.col("temperature_f"))
    point = F.struct(F.col("valid_utc").alias("t"), F.col("receipt_utc").alias("r"), value.alias("v"))
    # A contract's own columns may be named like a covariate, so these travel in one struct.
    there = [finite(F.col(c)).alias(c) for c in COVARIATES if c in observations.columns]
    row = F.struct(F.col("valid_utc").alias("t"), F.col("receipt_utc").alias("r"), F.struct(*there).alias("covariates"))
    state = known_prefix(
        contracts, observations, [station], _just_after(F.col("target_time_utc")), F.col("decision_ts"),
        F.col("valid_utc"), F.col("receipt_utc"), {
            "observation_count": Running("sum", F.lit(1)),
            "__values": Running("sum", F.when(value.isNotNull(), 1)),
            "running_max_temperature": Running("max", value),
            "running_min_temperature": Running("min", value),
            "temperature_sum": Running("sum", value),
            "latest": Running("max", F.when(value.isNotNull(), point)),
            "__row": Running("max", row),
        }, few=few)
    return state.withColumns({
        "temperature_latest": F.col("latest.v"), "latest_valid_utc": F.col("latest.t"), "covariates": F.col("__row.covariates"),
        "temperature_range": F.col("running_max_temperature") - F.col("running_min_temperature"),
        "spatial_temperature_gradient_mean": F.when(F.col("__values") >= 2, F.col("temperature_sum") / F.col("__values")),
        "spatial_temperature_gradient_range": F.when(
            F.col("__values") >= 2, F.col("running_max_temperature") - F.col("running_min_temperature")),
    }).drop("latest", "temperature_sum", "__values", "__row")


def _id_number(parts: Sequence[Column]) -> Column:
    """The first 32 bits of the MD5 of an identity; missing parts are empty."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def observation_lineage(contracts: DataFrame, observations: DataFrame, station: str = "station", few: bool | None = None) -> DataFrame:
    """Adds ``observation_ids`` (distinct identities used) and ``observation_digest`` (sum of their numbers).

    The identity of a row is its source station (``source_station``, else the station), time and ``raw_sha256``. A decision uses its station's
    whole history, so lists of identities would grow with the square of the input; the count and the sum tell two sets of
    inputs apart at the cost of one more lookup. An identity counts from its first receipt.
    """
    source = F.col("source_station") if "source_station" in observations.columns else F.col(station)
    first = observations.groupBy(station, source.alias("__source"), "valid_utc", "raw_sha256").agg(F.min("receipt_utc").alias("receipt_utc"))
    out = known_prefix(
        contracts, first, [station], _just_after(F.col("target_time_utc")), F.col("decision_ts"), F.col("valid_utc"), F.col("receipt_utc"), {
            "observation_ids": Running("sum", F.lit(1)),
            "observation_digest": Running("sum", _id_number([F.col("__source"), F.unix_micros("valid_utc"), F.col("raw_sha256")]))}, few=few)
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(0)).cast("long") for n in ("observation_ids", "observation_digest")})


def _instants(contracts: DataFrame) -> DataFrame:
    """What contracts ask of the forecasts: those that agree in it are answered once."""
    return contracts.select("target_time_utc", "decision_ts").dropna().distinct()


def run_lineage(contracts: DataFrame, forecasts: DataFrame, asks: DataFrame | None = None) -> DataFrame:
    """Adds ``source_run_ids`` and ``source_run_digest`` of the runs behind the forecasts of a contract's target.

    A run is named by model, city, initialization_time_utc and sha256, as far as the forecasts have them; one without an
    initialisation has no name. It counts from its first receipt. See ``observation_lineage`` for why there is no list. ``asks``: the
    instants of the contracts, if they are at hand.
    """
    names = [c for c in ("model", "city", "initialization_time_utc", "sha256") if c in forecasts.columns]
    parts = [F.unix_micros(F.col(c).cast("timestamp")) if c == "initialization_time_utc" else F.col(c) for c in names]
    first = forecasts.where(F.col("initialization_time_utc").isNotNull()).groupBy("target_time_utc", *names).agg(
        F.min("source_receipt_time").alias("source_receipt_time"))
    found = asof_by_size(_instants(contracts) if asks is None else asks, first, ["target_time_utc"], F.col("decision_ts"), F.col("source_receipt_time"), {
        "source_run_ids": Running("sum", F.lit(1)), "source_run_digest": Running("sum", _id_number(parts))})
    out = contracts.join(found, ["target_time_utc", "decision_ts"], "left").select(*contracts.columns, "source_run_ids", "source_run_digest")
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(0)).cast("long") for n in ("source_run_ids", "source_run_digest")})


def slope_features(states: DataFrame, observations: DataFrame, station: str = "station",
                   minutes: Sequence[int] = SLOPE_MINUTES, few: bool | None = None) -> DataFrame:
    """Slopes back from the latest known observation: its value less the value k minutes before, over k.

    The earlier value, too, must have been received by the decision.
    """
    points = observations.where(F.col("temperature_f").isNotNull())
    if few is None:
        return by_size(states, points, [station], FEW, lambda l, r, some: slope_features(l, r, station, minutes, some))
    if few:
        found = _with_points(states, points, station)
        back = {k: _just_after(F.col("latest_valid_utc") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(k))) for k in minutes}
        return found.select(*states.columns, *[
            ((F.col("temperature_latest") - _newest(at).getField("v")) / k).alias(f"temperature_slope_{k}m") for k, at in back.items()])
    states = cut_lineage(states)
    asks = states.where(F.col("latest_valid_utc").isNotNull()).select(
        station, "decision_ts", "latest_valid_utc", F.explode(F.array(*[F.lit(k) for k in minutes])).alias("__k")).distinct()
    at = F.col("latest_valid_utc") - F.make_dt_interval(F.lit(0), F.lit(0), F.col("__k"))
    found = _newest_before(asks, points, station, _just_after(at), "__prior")
    wide = found.groupBy(station, "decision_ts", "latest_valid_utc").agg(*[
        F.max(F.when(F.col("__k") == k, F.col("__prior.v"))).alias(f"__prior_{k}") for k in minutes])
    out = states.join(wide, [station, "decision_ts", "latest_valid_utc"], "left")
    return out.select(*states.columns, *[
        ((F.col("temperature_latest") - F.col(f"__prior_{k}")) / k).alias(f"temperature_slope_{k}m") for k in minutes])


def acceleration_feature(states: DataFrame, observations: DataFrame, station: str = "station", few: bool | None = None) -> DataFrame:
    """Second difference of the last three observed instants known at the decision, NULL where there are fewer."""
    points = observations.where(F.col("temperature_f").isNotNull())
    if few is None:
        return by_size(states, points, [station], FEW, lambda l, r, some: acceleration_feature(l, r, station, some))
    if few:
        found = _with_points(states, points, station).withColumn("__one", _newest(F.col("latest_valid_utc"))).withColumn("__two", _newest(F.col("__one.t")))
        return found.select(*states.columns, (F.col("temperature_latest") - 2 * F.col("__one.v") + F.col("__two.v")).alias("temperature_slope_acceleration"))
    states = cut_lineage(states)
    asks = states.where(F.col("latest_valid_utc").isNotNull()).select(station, "decision_ts", "latest_valid_utc").distinct()
    one = cut_lineage(_newest_before(asks, points, station, F.col("latest_valid_utc"), "__one").where(F.col("__one").isNotNull()))
    two = _newest_before(one, points, station, F.col("__one.t"), "__two")
    found = two.select(station, "decision_ts", "latest_valid_utc", F.col("__one.v").alias("__v1"), F.col("__two.v").alias("__v2"))
    out = states.join(found, [station, "decision_ts", "latest_valid_utc"], "left")
    return out.select(*states.columns, (F.col("temperature_latest") - 2 * F.col("__v1") + F.col("__v2")).alias("temperature_slope_acceleration"))


def forecast_counts(contracts: DataFrame, forecasts: DataFrame, asks: DataFrame | None = None) -> DataFrame:
    """Count and moments of the forecasts that are about a contract's target and arrived by its decision.

    ``forecast_count`` counts rows, ``forecast_member_count`` those with a finite value. ``asks``: the instants of the contracts, if they are at hand.
    """
    value = finite(F.col("value"))
    found = asof_by_size(
        _instants(contracts) if asks is None else asks, forecasts, ["target_time_utc"], F.col("decision_ts"), F.col("source_receipt_time"), {
            "__rows": Running("sum", F.lit(1)), "__n": Running("sum", F.when(value.isNotNull(), 1)), "__sum": Running("sum", value),
            "__square": Running("sum", value * value), "forecast_min": Running("min", value), "forecast_max": Running("max", value),
        })
    mean = F.col("__sum") / F.col("__n")
    spread = F.sqrt(F.greatest(F.col("__square") / F.col("__n") - mean * mean, F.lit(0.0)))
    return contracts.join(found, ["target_time_utc", "decision_ts"], "left").select(
        *contracts.columns, "forecast_min", "forecast_max", mean.alias("forecast_mean"),
        F.when(F.col("forecast_min") == F.col("forecast_max"), 0.0).when(F.col("__n") > 0, spread).alias("forecast_std"),
        F.coalesce(F.col("__rows"), F.lit(0)).cast("long").alias("forecast_count"), F.col("__n").cast("long").alias("forecast_member_count"))


def forecast_spread(contracts: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Quantiles of the finite values behind ``forecast_counts``; contracts that ask for the same target at the same instant are answered once."""
    states = _instants(contracts.where(F.col("forecast_member_count") > 0))
    items = forecasts.select("target_time_utc", "source_receipt_time", finite(F.col("value")).alias("__value"))
    found = asof_quantiles(states, items, ["target_time_utc"], "decision_ts", "source_receipt_time", "__value", FORECAST_QUANTILES)
    return contracts.join(found.drop("group_rows"), ["target_time_utc", "decision_ts"], "left").withColumn("forecast_iqr", F.col("__q75") - F.col("__q25")).drop("__q25", "__q75")


def forecast_summary(contracts: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Spread and quantiles of the forecasts that are about a contract's target and arrived by its decision."""
    out = forecast_spread(cut_lineage(forecast_counts(contracts, forecasts)), forecasts)
    return out.select(*contracts.columns, "forecast_min", "forecast_max", "forecast_mean", "forecast_std", "forecast_count", *FORECAST_SPREAD)


def decision_features(contracts: DataFrame, observations: DataFrame, forecasts: DataFrame,
                      version: str = "pit-v1") -> tuple[DataFrame, DataFrame]:
    """Accepted decision rows with a JSON payload, and rejected ones with one of six reasons.

    A contract without a station takes the rows of all stations; one with a station never takes another's. Contracts
    with ``latitude`` and ``longitude`` also get the sun's geometry at the target. Observations with ``raw_sha256`` and forecasts
    with ``initialization_time_utc`` also give counts and digests of the identities behind a row.
    """
    clocks.require_columns(
        contracts, ["market_ticker", "station", "decision_ts", "target_time_utc"], "contracts")
    named = F.nullif(F.trim(F.col("station").cast("string")), F.lit(""))
    contracts = contracts.withColumn("__given", F.col("station")).withColumn("station", F.coalesce(named, F.lit(ALL_STATIONS)))
    asked = contracts.select("station").distinct()
    # Only stations that some contract asks for, and the pool of all of them only if one has none.
    pool = observations.withColumn("station", F.col("station").cast("string")).withColumn("source_station", F.col("station"))
    observations = cut_lineage(pool.unionByName(pool.withColumn("station", F.lit(ALL_STATIONS))).join(asked, "station", "left_semi"))
    checked = contracts.withColumn("__bad", F.coalesce(
        F.col("market_ticker").isNull() | F.col("decision_ts").isNull() | F.col("target_time_utc").isNull(), F.lit(True)))
    first_obs = observations.groupBy("station").agg(
        F.min("valid_utc").alias("__first_valid"), F.count(F.lit(1)).alias("__station_rows"))
    fc_any = forecasts.groupBy("target_time_utc").agg(F.count(F.lit(1)).alias("__target_rows"))
    base = cut_lineage(checked.join(first_obs, "station", "left").join(fc_any, "target_time_utc", "left"))

    def observed(asks: DataFrame, rows: DataFrame, few: bool) -> DataFrame:
        found = slope_features(observation_features(asks, rows, few=few), rows, few=few)
        found = acceleration_feature(found, rows, few=few)
        return observation_lineage(found, rows, few=few) if "raw_sha256" in observations.columns else found

    instants = _instants(base)
    out = forecast_counts(by_size(base, observations, ["station"], FEW, observed), forecasts, instants)
    out = cut_lineage(run_lineage(out, forecasts, instants) if "initialization_time_utc" in forecasts.columns else out)
    release(base, observations)
    has_obs = F.coalesce(F.col("observation_count"), F.lit(0)) > 0
    has_fc = F.col("forecast_count") > 0
    late_obs = F.coalesce(F.col("__first_valid") <= F.col("target_time_utc"), F.lit(False))
    late_fc = F.coalesce(F.col("__target_rows") > 0, F.lit(False))
    none = ~has_obs & ~has_fc
    reason = first_reason(
        (F.col("__bad"), "invalid_decision_or_target"),
        (none & F.col("__station_rows").isNull() & (F.col("station") != ALL_STATIONS), "missing_exact_settlement_station_observations"),
        (none & late_obs & late_fc, "late_observations_and_forecasts"),
        (none & late_obs, "late_observations"), (none & late_fc, "late_forecasts"),
        (none, "missing_observations_and_forecasts"),
    )
    out = out.withColumns({
        REASON: reason,
        "horizon_minutes": F.bround(clocks.age_minutes(F.col("target_time_utc"), F.col("decision_ts"))),
        "feature_version": F.lit(version),
        "forecast_minus_observed_latest": F.col("forecast_mean") - F.col("temperature_latest"),
        "observation_count": F.coalesce(F.col("observation_count"), F.lit(0)).cast("long"),
    })
    sun = []
    if {"latitude", "longitude"} <= set(contracts.columns):
        geometry = numeric.solar_position(F.col("target_time_utc"), F.col("latitude"), F.col("longitude"))
        out, sun = out.withColumns(geometry), list(geometry)
    payload = sorted([
        *sun, "spatial_temperature_gradient_range", "temperature_slope_acceleration", "observation_count", "running_max_temperature", "running_min_temperature",
        "temperature_latest", "temperature_range", "spatial_temperature_gradient_mean",
        "forecast_count", "forecast_mean", "forecast_std", "forecast_min", "forecast_max", *FORECAST_SPREAD,
        "forecast_minus_observed_latest", *[f"temperature_slope_{k}m" for k in SLOPE_MINUTES],
    ])
    covariates = [F.col("covariates").getField(c).alias(c) for c in COVARIATES if c in observations.columns]
    fields = sorted([(c, F.col(c)) for c in payload] + list(zip([c for c in COVARIATES if c in observations.columns], covariates)), key=lambda f: f[0])

    def finished(rows: DataFrame) -> DataFrame:
        return rows.withColumn("features_json", F.to_json(F.struct(*[c for _, c in fields]))).withColumn("station", F.col("__given")).drop(
            "__bad", "__first_valid", "__station_rows", "__target_rows", "__given", "covariates")

    # Quantiles are searched for when the rows are read; few rejected rows have forecasts, so of these only the targets that do are read.
    good, bad = split(out)
    targets = bad.where(F.col("forecast_member_count") > 0).select("target_time_utc").distinct()
    return finished(forecast_spread(good, forecasts)), finished(forecast_spread(bad, forecasts.join(targets, "target_time_utc", "left_semi")))


def ensemble_features(members: DataFrame, keys: Sequence[str], thresholds: Sequence[float],
                      order: Sequence[Column]) -> DataFrame:
    """Mean, spread, quantiles and exceedance shares over the members of each run and valid time.

    The last value per member wins. A group is one ensemble at one time, so it stays small.
    """
    rank = F.struct(*order)
    single = members.where(F.col("variable") == "temperature_2m").groupBy(*keys, "member_id").agg(
        F.max_by(F.col("value"), rank).alias("value"))
    value = F.col("value")
    quantiles = {"p10": 0.10, "p25": 0.25, "median": 0.50, "p75": 0.75, "p90": 0.90}
    return single.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("member_count"), F.avg(value).alias("ensemble_mean"),
        F.stddev_pop(value).alias("ensemble_spread"),
        *[F.percentile(value, F.lit(q)).alias(n) for n, q in quantiles.items()],
        *[F.avg((value >= F.lit(float(k))).cast("double")).alias(f"prob_ge_{k:g}") for k in thresholds],
    )


def ensemble_point_summary(members: DataFrame, keys: Sequence[str], quantiles: dict[str, float],
                           thresholds: Sequence[float]) -> DataFrame:
    """Nearest-rank quantiles and fixed exceedance shares per point."""
    value = F.col("value")
    ranks = [
        F.expr(f"percentile_disc({q}) within group (order by value)").alias(n) for n, q in quantiles.items()
    ]
    return members.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("member_count"), *ranks,
        *[F.avg((value >= F.lit(float(k))).cast("double")).alias(f"prob_ge_{k:g}") for k in thresholds],
    )


def threshold_edges(features: DataFrame, markets: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Market against ensemble share: the share columns become rows keyed by threshold, then an equi join."""
    stacked = F.explode(F.array(*[
        F.struct(F.lit(float(k)).alias("threshold"), F.col(f"prob_ge_{k:g}").alias("p")) for k in thresholds
    ])).alias("s")
    rows = features.select(
        F.lower("city").alias("city"), "forecast_run_time", "valid_time", stacked
    ).select("city", "forecast_run_time", "valid_time", "s.threshold", F.col("s.p").alias("gefs_probability"))
    priced = markets.where(F.col("market_probability").isNotNull() & F.col("threshold").isNotNull())
    return priced.withColumn("city", F.lower("city")).join(rows, ["city", "threshold"]).withColumn(
        "edge", F.col("gefs_probability") - F.col("market_probability"))


def admit(contracts: DataFrame, labels: DataFrame, features: DataFrame,
          feature_rejections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contracts with a settled label and point-in-time features; others with all reason codes in order.

    All inputs are unique on market_ticker.
    """
    label = labels.select("market_ticker", "kalshi_result", "label_available_ts", "source_valid_utc", "source_temperature_f", F.lit(True).alias("__label"))
    feature = features.select("market_ticker", F.col("decision_ts").alias("__feature_decision"), "features_json", F.lit(True).alias("__feature"))
    refused = feature_rejections.select("market_ticker", F.col("reason").alias("__refused"))
    wide = contracts.join(label, "market_ticker", "left").join(feature, "market_ticker", "left").join(refused, "market_ticker", "left")
    decision = F.coalesce(F.col("__feature_decision"), F.col("decision_ts"))
    available, valid, target = F.col("label_available_ts"), F.col("source_valid_utc"), F.col("target_time_utc")
    method = F.coalesce(F.col("settlement_station_method"), F.lit(""))
    exact = F.coalesce(valid == target, F.lit(False))
    codes = all_reasons(
        (F.col("__feature").isNull(), F.coalesce(F.col("__refused"), F.lit("no_valid_pit_features"))),
        (clocks.first_text(F.col("kalshi_result")).isNull(), "missing_settled_binary_label"),
        (available.isNull(), "missing_label_availability"),
        (available.isNotNull() & decision.isNull(), "invalid_decision_clock"),
        (~exact, "invalid_exact_settlement_time"),
        (exact & (available < target), "label_available_before_target"),
        (method.contains("unverified") | method.isin("", "unresolved"), "unverified_settlement_station"),
    )
    wide = wide.withColumn("__codes", codes).withColumn("__decision", decision)
    accepted = wide.where(F.size("__codes") == 0).drop(
        "__codes", "__label", "__feature", "__refused", "__feature_decision", "decision_ts"
    ).withColumnRenamed("__decision", "decision_ts")
    rejected = wide.where(F.size("__codes") > 0).select(
        "market_ticker", F.element_at("__codes", 1).alias(REASON), F.array_join("__codes", ";").alias("reason_codes"))
    return accepted, rejected
