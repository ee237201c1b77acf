"""Forecast builders and post-processors. Folds are one more grouping key, never a driver loop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clocks, numeric
from ..session import cut_lineage
from .aggregates import LEVELS, by_level, grouping_levels, regression
from .filters import REASON, first_reason, split
from .joins import expand_buckets, label_both_extremes
from .quantiles import asof_medians, interpolated_quantiles
from .state import bucket_gaps
from .timeline import Running, asof_by_size, asof_join, keep_latest, known_latest, known_prefix, overlap_chunks, row_numbers

MIN_TRAINING = 5
MIN_SIGMA = 0.01
Z90 = 1.2816


def label_sides(labels: DataFrame) -> DataFrame:
    """Daily labels as one row per extreme with a finite value and a known publication clock."""
    sides = F.explode(F.array(
        F.struct(F.lit("high").alias("t"), clocks.finite(F.col("tmax_f")).alias("v")),
        F.struct(F.lit("low").alias("t"), clocks.finite(F.col("tmin_f")).alias("v")))).alias("side")
    return labels.select("city", "date", "label_available_ts", sides).select(
        "city", "date", "label_available_ts", F.col("side.t").alias("temp_type"), F.col("side.v").alias("value")
    ).where(F.col("value").isNotNull() & F.col("label_available_ts").isNotNull() & F.col("date").isNotNull())


def _checked_schedule(schedule: DataFrame) -> tuple[DataFrame, DataFrame]:
    clocks.require_columns(
        schedule, ["event_ticker", "decision_time_utc", "city", "temp_type", "outcome_local_date", "lead_hours"], "schedule")
    bad = (
        F.col("city").isNull() | ~F.coalesce(F.col("temp_type").isin("high", "low"), F.lit(False))
        | F.col("decision_time_utc").isNull() | F.col("outcome_local_date").isNull())
    return split(schedule.withColumn(REASON, first_reason((bad, "invalid_schedule"))))


def _forecast_columns(df: DataFrame, name: str, version: str) -> DataFrame:
    return df.withColumns({
        "forecast_issue_time": F.col("decision_time_utc"), "source_receipt_time": F.col("decision_time_utc"),
        "model_name": F.lit(name), "model_version": F.lit(version)})


def climatology(schedule: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean and population spread of the same month's earlier labels published by the decision."""
    usable, bad = _checked_schedule(schedule)
    asks = usable.withColumn("__month", F.month("outcome_local_date"))
    facts = label_sides(labels).withColumn("__month", F.month("date"))
    v = F.col("value")
    out = known_prefix(
        asks, facts, ["city", "temp_type", "__month"], F.col("outcome_local_date"), F.col("decision_time_utc"),
        F.col("date"), F.col("label_available_ts"), {
            "training_rows": Running("sum", F.lit(1)), "__sum": Running("sum", v), "__square": Running("sum", v * v),
            "__min": Running("min", v), "__max": Running("max", v),
        })
    mean = F.col("__sum") / F.col("training_rows")
    spread = F.sqrt(F.greatest(F.col("__square") / F.col("training_rows") - mean * mean, F.lit(0.0)))
    out = out.withColumns({
        "mean_f": mean, "stddev_f": F.when(F.col("__max") > F.col("__min"), spread),
        REASON: first_reason((F.col("training_rows").isNull(), "no_prior_available_labels")),
    }).drop("__sum", "__square", "__min", "__max", "__month")
    good, empty = split(out)
    good = good.withColumn("training_rows", F.col("training_rows").cast("long"))
    return _forecast_columns(good, "climatology", "monthly_v1"), bad.unionByName(empty.select(*schedule.columns, REASON))


def persistence(schedule: DataFrame, labels: DataFrame, window: int = 30) -> tuple[DataFrame, DataFrame]:
    """Last published earlier label, with the sample spread of the last ``window`` of them."""
    usable, bad = _checked_schedule(schedule)
    keep = max(1, window)
    keys = ["city", "temp_type"]
    point = F.struct("date", "label_available_ts", "value")
    out = known_latest(
        usable, label_sides(labels), keys, F.col("outcome_local_date"), F.col("decision_time_utc"), F.col("date"),
        F.col("label_available_ts"), point, keep, "__last")
    recent = F.transform(F.coalesce("__last", F.array().cast(out.schema["__last"].dataType)), lambda s: s["value"])
    out = out.withColumn("__recent", recent).withColumn("training_rows", F.size("__recent").cast("long"))
    mean = F.aggregate("__recent", F.lit(0.0), lambda a, x: a + x) / F.col("training_rows")
    out = out.withColumn("__mean", mean)
    square = F.aggregate(
        F.transform("__recent", lambda x: (x - F.col("__mean")) * (x - F.col("__mean"))), F.lit(0.0), lambda a, x: a + x)
    out = out.withColumn("stddev_f", F.when(
        F.col("training_rows") > 1, F.nullif(F.sqrt(square / (F.col("training_rows") - 1)), F.lit(0.0)))
    ).withColumn("mean_f", F.try_element_at("__recent", F.lit(-1))).withColumn(
        REASON, first_reason((F.col("training_rows") == 0, "no_prior_available_label"))
    ).drop("__last", "__recent", "__mean")
    good, empty = split(out)
    return (_forecast_columns(good, "persistence", f"last_value_v1_window{window}"),
            bad.unionByName(empty.select(*schedule.columns, REASON)))


def nowcast(states: DataFrame, labels: DataFrame, min_training: int = 10) -> tuple[DataFrame, DataFrame]:
    """Running extreme plus the median residual of all residuals published before the state.

    A residual is released when its day's label is published. Between two releases the pool of a key
    does not change, so its statistics are computed once per release and looked up by every state.
    ``states`` needs city, local_date, local_hour, feature_asof_utc and the extremes so far.
    """
    rows, _ = label_both_extremes(states, labels)
    items = rows.withColumn("residual", F.col("final_f") - F.col("current_f")).select(
        "city", "temp_type", "local_hour", "label_available_ts", "residual")
    r = F.col("residual")
    out = cut_lineage(rows)
    for level, keys in (("hour", ["city", "temp_type", "local_hour"]), ("day", ["city", "temp_type"])):
        out = cut_lineage(asof_by_size(out, items, keys, F.col("feature_asof_utc"), F.col("label_available_ts"), {
            f"__n_{level}": Running("sum", F.lit(1)), f"__s_{level}": Running("sum", r), f"__q_{level}": Running("sum", r * r),
            f"__lo_{level}": Running("min", r), f"__hi_{level}": Running("max", r),
            f"__release_{level}": Running("max", F.col("label_available_ts"))}, segment="day"))
    narrow = F.coalesce(F.col("__n_hour") >= min_training, F.lit(False))
    broad = F.coalesce(F.col("__n_day") >= min_training, F.lit(False))

    def of(name: str) -> Column:
        return F.when(narrow, F.col(f"__{name}_hour")).when(broad, F.col(f"__{name}_day"))

    count, mean = of("n"), of("s") / of("n")
    spread = F.when(of("hi") > of("lo"), F.sqrt(F.greatest(of("q") / of("n") - mean * mean, F.lit(0.0)))).otherwise(0.0)
    # Pool -1 is the whole day, the fallback of the hour pools.
    out = out.withColumns({
        "__pool": F.when(narrow, F.col("local_hour")).otherwise(F.lit(-1)), "__release": of("release"), "__count": count,
        "__spread": spread})
    out = out.drop(*[f"__{n}_{level}" for n in ("n", "s", "q", "lo", "hi", "release") for level in ("hour", "day")])
    pooled = items.withColumn("__pool", F.explode(F.array(F.col("local_hour"), F.lit(-1))))
    key = ["city", "temp_type", "__pool"]
    states_at = out.where(F.col("__release").isNotNull()).select(*key, "__release").distinct()
    medians = asof_medians(cut_lineage(states_at), pooled, key, "__release", "label_available_ts", "residual")
    out = out.join(medians.select(*key, "__release", "median"), [*key, "__release"], "left")
    count, center, spread = F.col("__count"), F.col("median"), F.col("__spread")
    day_gap = F.datediff("local_date", F.to_date("feature_asof_utc")) * F.lit(24.0)
    out = out.withColumns({
        "mean_f": F.col("current_f") + center, "stddev_f": F.greatest(spread, F.lit(0.25)),
        "training_rows": count.cast("long"),
        "lead_hours": F.greatest(F.lit(0.0), day_gap + F.lit(12.0) - F.hour("feature_asof_utc")),
        "event_ticker": F.concat_ws(
            "-", F.lit("NOWCAST"), "city", F.col("local_date").cast("string"), "temp_type",
            F.date_format("feature_asof_utc", "yyyyMMdd'T'HHmmss'Z'")),
        REASON: first_reason((count.isNull(), "insufficient_prior_residuals")),
    }).withColumn("decision_time_utc", F.col("feature_asof_utc")).withColumn("outcome_local_date", F.col("local_date"))
    extra = [c for c in out.columns if c.startswith("__") or c == "median"]
    good, bad = split(out.drop(*extra))
    return (_forecast_columns(good, "observation_nowcast", "running_extrema_residual_v1"),
            bad.select("city", "local_date", "temp_type", "feature_asof_utc", REASON))


def daily_ensemble(members: DataFrame, offset_hours: Column, temp_types: Sequence[str] = ("high", "low")) -> tuple[DataFrame, DataFrame]:
    """Mean and spread over members of each member's extreme inside the standard-time day.

    A forecast received after its day began is dropped; a receipt before the issue is rejected.
    """
    usable = members.where(
        (F.col("variable") == "temperature_2m") & F.col("value").isNotNull() & F.col("valid_time").isNotNull()
        & F.col("forecast_run_time").isNotNull() & F.col("retrieved_at").isNotNull())
    day = clocks.standard_day(F.col("valid_time"), offset_hours)
    placed = usable.withColumn("outcome_local_date", day).withColumn(
        "window_start_utc", clocks.standard_window_start(day, offset_hours))
    keys = ["city", "model", "forecast_run_time", "retrieved_at", "outcome_local_date", "window_start_utc"]
    single = placed.groupBy(*keys, "member_id").agg(F.max("value").alias("high"), F.min("value").alias("low"))
    sides = F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col(t).alias("v")) for t in temp_types])).alias("side")
    stacked = single.select(*keys, sides).select(*keys, F.col("side.t").alias("temp_type"), F.col("side.v").alias("v"))
    out = stacked.groupBy(*keys, "temp_type").agg(
        F.count("v").alias("member_count"), F.avg("v").alias("mean_f"),
        F.when((F.count("v") > 1) & (F.max("v") > F.min("v")), F.stddev_pop("v")).alias("stddev_f"))
    out = out.withColumns({
        "lead_hours": (F.unix_micros("window_start_utc") - F.unix_micros("forecast_run_time")) / F.lit(3.6e9),
        "decision_time_utc": F.col("retrieved_at"),
        "event_ticker": F.concat(F.lit("research_"), "city", F.lit("_"), F.col("outcome_local_date").cast("string")),
        REASON: first_reason(
            (F.col("retrieved_at") < F.col("forecast_run_time"), "receipt_precedes_issue"),
            (F.col("window_start_utc") <= F.col("retrieved_at"), "window_already_started")),
    })
    return split(out)


def bucket_probabilities(forecasts: DataFrame, buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Normal mass of every whole-degree bucket of the event, half a degree beyond its bounds.

    The event's buckets must be a partition with two open tails; then the masses sum to one because
    neighbouring bounds cancel. Late or unknown forecasts, bad spreads and broken partitions are
    rejected with a reason.
    """
    checks = bucket_gaps(buckets)
    whole = buckets.groupBy("event_ticker").agg(F.count_if(
        (F.col("bucket_floor_f") != F.floor("bucket_floor_f")) | (F.col("bucket_ceil_f") != F.floor("bucket_ceil_f"))
        | (F.col("bucket_floor_f") > F.col("bucket_ceil_f"))).alias("__broken"))
    sound = checks.join(whole, "event_ticker").select("event_ticker", (
        (F.col("unparsed") + F.col("duplicate_tickers") + F.col("overlaps") + F.col("gaps") + F.col("__broken") == 0)
        & (F.col("open_low") == 1) & (F.col("open_high") == 1)).alias("__sound"))
    timely = clocks.available_asof(F.col("forecast_issue_time"), F.col("source_receipt_time"), F.col("decision_time_utc"))
    marked = forecasts.join(sound, "event_ticker", "left").withColumn(REASON, first_reason(
        (~timely, "late_or_missing_clock"),
        (clocks.finite(F.col("mean_f")).isNull() | clocks.finite(F.col("stddev_f")).isNull() | (F.col("stddev_f") <= 0), "invalid_distribution"),
        (F.col("__sound").isNotNull() & ~F.col("__sound"), "invalid_partition"),
    )).drop("__sound")
    good, bad = split(marked)
    wide, unknown = expand_buckets(good, buckets)

    def mass(bound: Column, half: float, at_open: float) -> Column:
        value = numeric.gaussian_cdf(bound + F.lit(half), F.col("mean_f"), F.col("stddev_f"))
        return F.when(bound.isNull(), F.lit(at_open)).otherwise(value)

    low = mass(F.col("bucket_floor_f"), -0.5, 0.0)
    high = mass(F.col("bucket_ceil_f"), 0.5, 1.0)
    rows = wide.withColumn("bucket_probability", F.greatest(F.lit(0.0), high - low)).drop("bucket_count")
    return rows, bad.select(*forecasts.columns, REASON).unionByName(unknown.select(*forecasts.columns, REASON))


# ---------------------------------------------------------------- post-processors

def with_level_keys(forecasts: DataFrame) -> DataFrame:
    return forecasts.withColumns({
        "lead_bucket": clocks.lead_bucket(F.col("lead_hours")), "month": F.date_format("outcome_local_date", "MM")})


def training_rows(forecasts: DataFrame, labels: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Forecasts with their event's label, restricted to labels published by the fit clock.

    The fit clock is ``as_of`` (then the target day must also be earlier) or else each row's own
    decision. The last dated finite label of an event counts.
    """
    usable = labels.where(F.col("label_available_ts").isNotNull() & clocks.finite(F.col("observed_f")).isNotNull())
    label = keep_latest(usable.select("event_ticker", "label_available_ts", "observed_f"), ["event_ticker"],
                        [F.col("label_available_ts"), F.col("observed_f")])
    rows = with_level_keys(forecasts).join(label, "event_ticker").where(
        F.col("decision_time_utc").isNotNull() & clocks.finite(F.col("mean_f")).isNotNull())
    gate = F.col("decision_time_utc") if as_of is None else as_of
    rows = rows.where(F.col("label_available_ts") <= gate)
    return rows if as_of is None else rows.where(F.col("outcome_local_date") < F.to_date(as_of))


def apply_levels(rows: DataFrame, fitted: DataFrame, values: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Give each row the values of the narrowest fitted level that has its key."""
    out = rows
    payload = F.struct(*values)
    for i, level in enumerate(LEVELS):
        keys = [*extra, *level]
        part = fitted.where(F.col("level") == i).select(*keys, payload.alias(f"__fit{i}"))
        out = out.join(part, keys, "left")
    best = F.coalesce(*[F.col(f"__fit{i}") for i in range(len(LEVELS))])
    out = out.withColumn("__fit", best).drop(*[f"__fit{i}" for i in range(len(LEVELS))])
    return out.select(*rows.columns, *[F.col(f"__fit.{v}").alias(v) for v in values])


def fit_bias(train: DataFrame, min_training: int = MIN_TRAINING, extra: Sequence[str] = ()) -> DataFrame:
    return grouping_levels(train, {"bias_f": "avg(observed_f - mean_f)"}, min_training, extra)


def apply_bias(forecasts: DataFrame, fitted: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    out = apply_levels(with_level_keys(forecasts), fitted, ["bias_f", "n"], extra)
    return out.withColumns({
        "bias_f": F.coalesce("bias_f", F.lit(0.0)), "bias_training_rows": F.coalesce("n", F.lit(0)),
        "mean_f": F.col("mean_f") + F.coalesce("bias_f", F.lit(0.0)),
        "model_version": F.concat("model_version", F.lit("+station_bias_v1"))}).drop("n")


def fit_emos(train: DataFrame, min_training: int = MIN_TRAINING, extra: Sequence[str] = ()) -> DataFrame:
    rows = train.where(clocks.finite(F.col("stddev_f")) > 0)
    line = regression("mean_f", "observed_f")
    line["sigma_mean"] = "avg(stddev_f)"
    fitted = grouping_levels(rows, line, min_training, extra)
    scale = F.greatest(F.col("residual_rms") / F.col("sigma_mean"), F.lit(MIN_SIGMA))
    return fitted.withColumn("spread_scale", scale).drop("residual_rms", "sigma_mean")


def apply_emos(forecasts: DataFrame, fitted: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    out = apply_levels(with_level_keys(forecasts), fitted, ["intercept", "slope", "spread_scale", "n"], extra)
    out = out.withColumns({
        "emos_intercept": F.coalesce("intercept", F.lit(0.0)), "emos_slope": F.coalesce("slope", F.lit(1.0)),
        "emos_spread_scale": F.coalesce("spread_scale", F.lit(1.0)), "emos_training_rows": F.coalesce("n", F.lit(0))})
    return out.withColumns({
        "mean_f": F.when(F.col("stddev_f").isNull(), F.col("mean_f")).otherwise(
            F.col("emos_intercept") + F.col("emos_slope") * F.col("mean_f")),
        "stddev_f": F.when(F.col("stddev_f").isNotNull(), F.greatest(F.col("stddev_f") * F.col("emos_spread_scale"), F.lit(MIN_SIGMA))),
        "model_version": F.concat("model_version", F.lit("+emos_v1"))}).drop("intercept", "slope", "spread_scale", "n")


def fit_quantiles(train: DataFrame, min_training: int = MIN_TRAINING, extra: Sequence[str] = ()) -> DataFrame:
    """Residual p10, p50 and p90 per level; the widest levels hold most rows, so ranks are found in slots."""
    rows = by_level(train.select(*extra, *LEVELS[0], (F.col("observed_f") - F.col("mean_f")).alias("residual")))
    # NULL marks an ignored column; a text key keeps it joinable inside the rank scan.
    names = LEVELS[0]
    rows = rows.withColumn("__key", F.to_json(F.struct(*names)))
    keys = rows.select("level", "__key", *names).distinct()
    found = interpolated_quantiles(rows, [*extra, "level", "__key"], "residual", {"q10": 0.1, "q50": 0.5, "q90": 0.9})
    return found.where(F.col("group_rows") >= min_training).join(keys, ["level", "__key"]).drop("__key").withColumnRenamed("group_rows", "n")


def apply_quantiles(forecasts: DataFrame, fitted: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    out = apply_levels(with_level_keys(forecasts), fitted, ["q10", "q50", "q90", "n"], extra)
    zero = F.lit(0.0)
    q10, q50, q90 = (F.coalesce(c, zero) for c in ("q10", "q50", "q90"))
    return out.withColumns({
        "p10_f": F.col("mean_f") + q10, "p50_f": F.col("mean_f") + q50, "p90_f": F.col("mean_f") + q90,
        "stddev_f": F.greatest((q90 - q10) / F.lit(2 * Z90), F.lit(MIN_SIGMA)),
        "quantile_training_rows": F.coalesce("n", F.lit(0)),
        "model_version": F.concat("model_version", F.lit("+quantile_v1")),
    }).withColumn("mean_f", F.col("p50_f")).drop("q10", "q50", "q90", "n")


POSTPROCESSORS = {
    "bias": (fit_bias, apply_bias), "emos": (fit_emos, apply_emos), "quantile": (fit_quantiles, apply_quantiles),
}


def fit_weights(train: DataFrame, min_training: int = 3, extra: Sequence[str] = ()) -> DataFrame:
    """Inverse mean-absolute-error weight per model, summing to one (per fold)."""
    scores = train.where(clocks.first_text(F.col("model_name")).isNotNull()).groupBy(*extra, "model_name").agg(
        F.avg(F.abs(F.col("observed_f") - F.col("mean_f"))).alias("mae"), F.count(F.lit(1)).alias("n")
    ).where(F.col("n") >= min_training).withColumn("__w", F.lit(1.0) / F.greatest("mae", F.lit(1e-6)))
    keys = list(extra) or ["__all"]
    scores = scores if extra else scores.withColumn("__all", F.lit(0))
    total = scores.groupBy(*keys).agg(F.sum("__w").alias("__t"), F.count(F.lit(1)).alias("models"))
    wide = scores.join(total, keys)
    return wide.select(*extra, "model_name", (F.col("__w") / F.col("__t")).alias("weight"), "models")


def apply_blend(forecasts: DataFrame, weights: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Mixture mean and variance per event over the models that have a weight."""
    rows = forecasts.join(weights.select(*extra, "model_name", "weight"), [*extra, "model_name"]).where(
        clocks.finite(F.col("mean_f")).isNotNull())
    w, m, s = F.col("weight"), F.col("mean_f"), F.coalesce("stddev_f", F.lit(0.0))
    first = F.min_by(
        F.struct("city", "temp_type", "outcome_local_date", "decision_time_utc", "forecast_issue_time", "source_receipt_time", "lead_hours"),
        F.struct("model_name", "lead_hours"))
    out = rows.groupBy(*extra, "event_ticker").agg(
        F.sum(w).alias("__w"), F.sum(w * m).alias("__m"), F.sum(w * (s * s + m * m)).alias("__q"),
        F.count(F.lit(1)).alias("blend_member_count"), first.alias("__first"),
        F.array_join(F.array_sort(F.collect_set("model_name")), ";").alias("member_models"))
    mean = F.col("__m") / F.col("__w")
    variance = F.greatest(F.col("__q") / F.col("__w") - mean * mean, F.lit(0.0))
    return out.select(
        *extra, "event_ticker", "__first.*", mean.alias("mean_f"),
        F.greatest(F.sqrt(variance), F.lit(MIN_SIGMA)).alias("stddev_f"), "blend_member_count", "member_models",
        F.lit("convex_blend").alias("model_name"), F.lit("inverse_mae_v1").alias("model_version"))


# ---------------------------------------------------------------- contract probabilities

def persistence_probability(rows: DataFrame, known_contracts: DataFrame, sigma_f: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """Probability that the latest temperature plus normal noise lands above or below the threshold.

    ``features_json`` carries temperature_f, or temperature_c which is converted.
    """
    doc = F.col("features_json")
    fahrenheit = clocks.to_number(F.get_json_object(doc, "$.temperature_f"))
    celsius = clocks.to_number(F.get_json_object(doc, "$.temperature_c"))
    latest = F.coalesce(fahrenheit, celsius * 9 / 5 + 32)
    side = F.lower(F.trim(F.col("comparison")))
    contract = known_contracts.select("market_ticker", F.lit(True).alias("__known")).distinct()
    # One column per step, so that the JSON is read once and not once per use.
    staged = rows.withColumn("__z", (F.col("threshold_f") - latest) / F.lit(sigma_f)).withColumn(
        "__below", numeric.norm_cdf(F.col("__z")))
    p = F.when(side == "above", F.lit(1.0) - F.col("__below")).when(side == "below", F.col("__below"))
    marked = staged.join(contract, "market_ticker", "left").withColumn(
        "prediction", F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
    ).withColumn(REASON, first_reason(
        (F.col("__known").isNull(), "missing_contract_terms"),
        (F.coalesce(F.col("settlement_station_method"), F.lit("")).contains("unverified"), "unverified_settlement_station"),
        (p.isNull() | clocks.first_text(F.col("source_run_ids")).isNull()
         | clocks.first_text(F.col("observation_ids")).isNull(), "missing_baseline_provenance"),
    )).drop("__z", "__below").drop("__known")
    return split(marked)


def quote_edges(markets: DataFrame, quotes: DataFrame, forecasts: DataFrame, fee_rate: float = 0.0,
                slippage_cents: float = 0.0, segment: str = "month") -> tuple[DataFrame, DataFrame]:
    """Contract probability and net YES and NO edge against the latest quote.

    The decision is the latest quote receipt; the forecast is the newest one of the market's city,
    type and day received by then. Market columns: market_ticker, city, temp_type, target_date,
    strike_type, floor_strike, cap_strike, product_key, rules_primary.
    """
    if fee_rate < 0 or slippage_cents < 0:
        raise ValueError("fee_rate and slippage_cents must be non-negative")
    quote_fields = ("bid_cents", "ask_cents", "spread_cents", "top_depth")
    latest = keep_latest(
        quotes.where(F.col("received_ts").isNotNull()).select("market_ticker", "received_ts", *quote_fields),
        ["market_ticker"], [F.col("received_ts")]).withColumnRenamed("received_ts", "decision_ts")
    wide = markets.join(latest, "market_ticker", "left")
    usable = forecasts.where(F.col("source_receipt_time").isNotNull() & (F.col("stddev_f") > 0)).withColumnRenamed(
        "outcome_local_date", "target_date")
    wide = asof_join(wide, usable, ["city", "temp_type", "target_date"], F.col("decision_ts"), F.col("source_receipt_time"),
                     {"mean_f": F.col("mean_f"), "stddev_f": F.col("stddev_f"), "forecast_receipt_ts": F.col("source_receipt_time")},
                     [F.col("mean_f")], segment=segment)
    threshold = F.coalesce("floor_strike", "cap_strike")
    strike = F.lower(F.coalesce("strike_type", F.lit("")))

    def cdf(x: Column) -> Column:
        return numeric.gaussian_cdf(x, F.col("mean_f"), F.col("stddev_f"))

    between = (strike == "between") & F.col("cap_strike").isNotNull()
    wide = wide.withColumns({
        "__upper": F.when(strike == "less", threshold - 0.5).when(between, F.col("cap_strike") + 0.5),
        "__lower": F.when(strike == "greater", threshold + 0.5).when(between, threshold - 0.5),
    }).withColumn("__below", cdf(F.col("__upper"))).withColumn("__under", cdf(F.col("__lower")))
    supported = F.col("__upper").isNotNull() | F.col("__lower").isNotNull()
    p = F.when(supported & F.col("mean_f").isNotNull(),
               F.coalesce("__below", F.lit(1.0)) - F.coalesce("__under", F.lit(0.0)))
    bad_quote = F.lit(False)
    for name in quote_fields:
        bad_quote = bad_quote | clocks.finite(F.col(name)).isNull()
    wide = wide.withColumns({"threshold_f": threshold, "probability": p}).drop("__upper", "__lower", "__below", "__under").withColumn(REASON, first_reason(
        (F.col("decision_ts").isNull(), "missing_quote_receipt"),
        (~F.coalesce(F.col("rules_primary").contains(F.col("product_key")), F.lit(False)), "settlement_rule_station_mismatch"),
        (F.col("target_date").isNull() | threshold.isNull(), "invalid_target_or_threshold"),
        (F.col("mean_f").isNull(), "missing_forecast_asof_quote"),
        (F.col("probability").isNull(), "unsupported_strike_semantics"),
        (bad_quote, "missing_executable_quote_fields")))
    ask, no_ask = F.col("ask_cents") / 100.0, (F.lit(100.0) - F.col("bid_cents")) / 100.0
    edges = {"yes_gross_edge_at_ask": F.col("probability") - ask}
    for name, times in (("conservative", 2.0), ("base", 1.0), ("optimistic", 0.0)):
        slip = F.lit(slippage_cents * times / 100.0)
        edges[f"yes_net_edge_{name}"] = F.col("probability") - (ask + slip) * F.lit(1.0 + fee_rate)
        edges[f"no_net_edge_{name}"] = F.lit(1.0) - F.col("probability") - (no_ask + slip) * F.lit(1.0 + fee_rate)
    good, bad = split(wide.withColumns(edges))
    return good, bad.select("market_ticker", REASON)


def cloud_adjusted(states: DataFrame, labels: DataFrame, max_age_minutes: float = 180.0,
                   pull: float = 0.10) -> tuple[DataFrame, DataFrame]:
    """Both extremes pulled a tenth of the way to the satellite temperature, by the clear-sky share."""
    label = labels.select("city", F.col("date").alias("local_date"), "label_available_ts",
                          F.col("tmax_f").alias("__high"), F.col("tmin_f").alias("__low"))
    wide = states.join(label, ["city", "local_date"], "left")
    clear, ir = F.col("dqf_clear_fraction"), clocks.finite(F.col("ir_brightness_temperature_k_mean"))
    wide = wide.withColumn(REASON, first_reason(
        (F.col("label_available_ts").isNull(), "missing_label"),
        (F.col("cloud_time_utc") > F.col("valid_utc"), "cloud_after_observation"),
        (~F.coalesce(F.col("cloud_age_minutes").between(0.0, max_age_minutes), F.lit(False)), "cloud_stale"),
        (~F.coalesce(clear.between(0.0, 1.0), F.lit(False)) | ir.isNull(), "invalid_cloud_value"),
        (F.col("label_available_ts") <= F.col("valid_utc"), "label_available_before_decision")))
    good, bad = split(wide)
    sides = F.explode(F.array(
        F.struct(F.lit("high").alias("kind"), F.col("observed_high_so_far_f").alias("b"), F.col("__high").alias("target")),
        F.struct(F.lit("low").alias("kind"), F.col("observed_low_so_far_f").alias("b"), F.col("__low").alias("target")))).alias("side")
    rows = good.select("*", sides).withColumns({
        "kind": F.col("side.kind"), "baseline_f": F.col("side.b"), "target_f": F.col("side.target")})
    infrared_f = (F.col("ir_brightness_temperature_k_mean") - 273.15) * 9 / 5 + 32
    rows = rows.withColumn("goes_augmented_f", F.col("baseline_f") + F.lit(pull) * clear * (infrared_f - F.col("baseline_f")))
    return rows.withColumns({
        "baseline_abs_error_f": F.abs(F.col("baseline_f") - F.col("target_f")),
        "goes_abs_error_f": F.abs(F.col("goes_augmented_f") - F.col("target_f"))}).drop("side", "__high", "__low"), bad.select(*states.columns, REASON)


def market_schedule(markets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per series and event: earliest opening, date from the ticker, lead hours from noon to noon."""
    target = clocks.ticker_date(F.col("event_ticker"))
    marked = markets.withColumn("outcome_local_date", target).withColumn(REASON, first_reason(
        (F.col("open_time").isNull(), "invalid_open_time"), (F.col("outcome_local_date").isNull(), "invalid_event_date")))
    good, bad = split(marked)
    rows = good.groupBy("series_ticker", "event_ticker").agg(
        F.min("open_time").alias("decision_time_utc"), F.min("outcome_local_date").alias("outcome_local_date"))
    lead = F.datediff("outcome_local_date", F.to_date("decision_time_utc")) * F.lit(24.0)
    return rows.withColumn("lead_hours", F.greatest(F.lit(0.0), lead)), bad
