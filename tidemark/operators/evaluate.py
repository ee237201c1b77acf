"""Scoring, folds, scenarios and settlement checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clocks, numeric
from ..session import cut_lineage
from . import models
from .filters import REASON, first_reason, inside_bucket, split
from .joins import label_after
from .timeline import asof_join

SKILL_KEYS = ("model_name", "model_version", "city", "temp_type", "lead_hours", "target_month")
SKILL_REASONS = ("missing_timestamp", "target_leakage", "no_label_found", "invalid_value", "invalid_label")


def forecast_skill(forecasts: DataFrame, labels: DataFrame, segment: str = "month") -> tuple[DataFrame, DataFrame]:
    """Scored forecasts (error and CRPS) and rejections with the five-way taxonomy."""
    mean, sigma, lead = clocks.finite(F.col("mean_f")), F.col("stddev_f"), clocks.finite(F.col("lead_hours"))
    timely = clocks.available_asof(F.col("forecast_issue_time"), F.col("source_receipt_time"), F.col("decision_time_utc"))
    bad_sigma = sigma.isNotNull() & (clocks.finite(sigma).isNull() | (sigma <= 0))
    checked = forecasts.withColumn(REASON, first_reason(
        (~timely, "missing_timestamp"),
        (F.col("city").isNull() | ~F.coalesce(F.col("temp_type").isin("high", "low"), F.lit(False)), "invalid_value"),
        (F.col("outcome_local_date").isNull() | lead.isNull() | mean.isNull() | bad_sigma, "invalid_value")))
    usable, bad = split(checked)
    found = label_after(usable, labels, segment=segment)
    good, unmatched = split(found.withColumnRenamed("label_reason", REASON))
    good = good.withColumns({
        "target_month": F.date_format("outcome_local_date", "yyyy-MM"),
        "abs_error_f": F.abs(F.col("mean_f") - F.col("observed_f")),
        "crps_f": numeric.gaussian_crps(F.col("mean_f"), F.col("observed_f"), sigma)})
    return good, bad.unionByName(unmatched.select(*forecasts.columns, REASON))


def skill_summary(good: DataFrame, bad: DataFrame, keys: Sequence[str] = SKILL_KEYS) -> DataFrame:
    """MAE and CRPS per group with the model's rejection counts; models with only rejects get a zero row."""
    scores = good.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("eligible_predictions"), F.avg("abs_error_f").alias("mae_f"),
        F.count("crps_f").alias("crps_predictions"), F.avg("crps_f").alias("crps_f"))
    refused = bad.groupBy("model_name", "model_version").agg(*[
        F.count_if(F.col(REASON) == r).alias(f"rejected_{r}") for r in SKILL_REASONS])
    out = scores.join(refused, ["model_name", "model_version"], "full_outer")
    counts = ["eligible_predictions", "crps_predictions", *[f"rejected_{r}" for r in SKILL_REASONS]]
    return out.na.fill(0, counts)


def bucket_skill(probabilities: DataFrame, labels: DataFrame, segment: str = "month") -> tuple[DataFrame, DataFrame]:
    """Multiclass Brier and log loss per event and model, then per model group; incoherent sets are rejected.

    ``labels`` needs event_ticker, label_available_ts, settled_market_ticker. Events are folded with
    plain aggregates, so an event with many copies of a bucket does not collect anywhere.
    """
    probabilities = cut_lineage(probabilities)
    p = clocks.finite(F.col("bucket_probability"))
    unit = ["event_ticker", "model_name", "model_version", "city", "temp_type"]
    timely = clocks.available_asof(F.col("forecast_issue_time"), F.col("source_receipt_time"), F.col("decision_time_utc"))
    sets = probabilities.groupBy(*unit).agg(
        F.min("decision_time_utc").alias("decision_time_utc"), F.max("decision_time_utc").alias("__last"),
        F.count_if(F.col("decision_time_utc").isNull()).alias("__undated"), F.count_if(p.isNull() | ~p.between(0.0, 1.0)).alias("__bad"),
        F.count_if(~timely).alias("__late"), F.sum(p).alias("total"), F.sum(p * p).alias("__square"))
    broken = (
        (F.col("__undated") > 0) | (F.col("decision_time_utc") != F.col("__last")) | (F.col("__bad") > 0)
        | (F.abs(F.col("total") - 1.0) > 1e-6) | (F.col("__late") > 0))
    checked = sets.withColumn(REASON, first_reason(
        (F.col("event_ticker").isNull() | (F.col("event_ticker") == ""), "missing_event"), (F.coalesce(broken, F.lit(True)), "invalid_partition")))
    good, bad = split(checked)
    settled = labels.select("event_ticker", "label_available_ts", F.lit(0.0).alias("observed_f"), "settled_market_ticker")
    found = asof_join(
        good, settled.where(F.col("label_available_ts").isNotNull()), ["event_ticker"], F.col("decision_time_utc"), F.col("label_available_ts"),
        {"settled": F.coalesce("settled_market_ticker", F.lit(""))}, [F.col("settled_market_ticker")], inclusive=False, backward=False, segment=segment)
    truth = probabilities.groupBy(*unit, "market_ticker").agg(F.max("bucket_probability").alias("truth")).withColumnRenamed("market_ticker", "settled")
    scored = found.join(truth, [*unit, "settled"], "left").withColumn(REASON, first_reason(
        (F.col("settled").isNull(), "no_label_after_decision"), (F.col("truth").isNull(), "label_not_in_partition")))
    fine, missed = split(cut_lineage(scored))
    # Sum of (p - y)^2 over the set, with y = 1 at the settled bucket only.
    fine = fine.withColumns({
        "brier": F.col("__square") - 2 * F.col("truth") + 1.0, "log_loss": -F.log(F.greatest("truth", F.lit(1e-15)))})
    rejects = bad.select(*unit, REASON).unionByName(missed.select(*unit, REASON))
    keys = ["model_name", "model_version", "city", "temp_type"]
    refused = rejects.groupBy("model_name").agg(F.count(F.lit(1)).alias("rejected_events"))
    summary = fine.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"), F.avg("brier").alias("brier"), F.avg("log_loss").alias("log_loss"), F.avg("total").alias("probability_sum"))
    return summary.join(refused, "model_name", "left").na.fill(0, ["rejected_events"]), rejects


def reliability_bins(df: DataFrame, probability: str, outcome: str, bins: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """Mean forecast and event rate per probability bin; bins without rows are there too."""
    p, y = F.col(probability), F.col(outcome)
    usable = df.where(p.between(0.0, 1.0) & y.isin(0, 1))
    index = F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int")
    facts = usable.groupBy(*keys, index.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.avg(p).alias("mean_probability"), F.avg(y.cast("double")).alias("event_rate"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if keys:
        grid = df.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = grid.join(facts, [*keys, "bin"], "left").na.fill(0, ["count"])
    return out.withColumns({"lower": F.col("bin") / F.lit(float(bins)), "upper": (F.col("bin") + 1) / F.lit(float(bins))})


def binary_metrics(df: DataFrame, fold: str = "oos_fold") -> DataFrame:
    """Brier, log loss, calibration and executable edge per out-of-sample fold and overall (fold NULL).

    Rows need predicted_probability, outcome (0/1), yes_ask, fee, slippage and the three clocks
    quote_available_ts, decision_ts, target_time_utc, model_fit_end_ts; a row that breaks a clock
    rule is not scored but counted.
    """
    p, y = F.col("predicted_probability"), F.col("outcome").cast("double")
    reason = first_reason(
        (F.col("quote_available_ts").isNull() | F.col("decision_ts").isNull() | F.col("target_time_utc").isNull(), "invalid_clock"),
        ((F.col("target_time_utc") <= F.col("decision_ts")) | (F.col("quote_available_ts") > F.col("decision_ts")), "late_quote_clock"),
        (clocks.finite(p).isNull() | ~p.between(0.0, 1.0) | ~F.coalesce(F.col("outcome").isin(0, 1), F.lit(False)), "invalid_prediction"),
        (F.col("model_fit_end_ts").isNull() | (F.col("model_fit_end_ts") > F.col("decision_ts")), "model_not_fit_by_decision"))
    ok = reason.isNull()
    cost = F.coalesce("fee", F.lit(0.0)) + F.coalesce("slippage", F.lit(0.0))
    signal = ok & (p > F.col("yes_ask") + cost)
    gain = F.when(signal, y - F.col("yes_ask") - cost)
    marked = df.withColumns({
        "__ok": ok, "__p": F.when(ok, p), "__y": F.when(ok, y), "__gain": gain,
        "__bin": F.least(F.floor(p * 10), F.lit(9)).cast("int")})
    hit = F.when(F.col("__y") == 1.0, F.col("__p")).otherwise(1.0 - F.col("__p"))
    loss = F.when(F.col("__ok"), -F.log(F.greatest(hit, F.lit(1e-15))))
    # One pass per (fold, bin) and the total over folds; both levels then fold over bins.
    cells = marked.groupingSets([[F.col(fold), F.col("__bin")], [F.col("__bin")]], fold, "__bin").agg(
        F.grouping(fold).alias("overall"), F.count(F.lit(1)).alias("__all"), F.count_if("__ok").alias("__n"), F.sum("__p").alias("__sp"),
        F.sum("__y").alias("__sy"), F.sum((F.col("__p") - F.col("__y")) * (F.col("__p") - F.col("__y"))).alias("__sb"),
        F.sum(loss).alias("__sl"), F.count("__gain").alias("__signals"), F.sum("__gain").alias("__pnl"))
    n = F.sum("__n")
    bin_error = F.abs(F.col("__sp") - F.col("__sy")) / F.nullif(F.col("__n"), F.lit(0))
    return cells.groupBy("overall", fold).agg(
        n.alias("rows"), (F.sum("__all") - n).alias("rejected"), (F.sum("__sb") / n).alias("brier_score"), (F.sum("__sl") / n).alias("log_loss"),
        (F.sum("__sp") / n).alias("mean_predicted_probability"), (F.sum("__sy") / n).alias("observed_rate"),
        F.abs(F.sum("__sp") / n - F.sum("__sy") / n).alias("calibration_abs_error"), F.max(bin_error).alias("max_bin_calibration_error"),
        F.sum("__signals").alias("signals"), (F.sum("__pnl") / F.nullif(F.sum("__signals"), F.lit(0))).alias("realized_edge"),
        F.coalesce(F.sum("__pnl"), F.lit(0.0)).alias("net_pnl"))


def walk_forward_folds(df: DataFrame, date: str = "outcome_local_date", train_days: int = 90, test_days: int = 14,
                       step_days: int | None = None, embargo_days: int = 0) -> DataFrame:
    """Membership of each date in each fold: (fold, date, role, window bounds). One row per date and fold.

    Windows move by ``step_days``; a fold counts when both of its sides have dates, and kept folds
    are numbered from 0. The size follows the calendar, so callers join it by date.
    """
    if train_days <= 0 or test_days <= 0 or embargo_days < 0 or (step_days is not None and step_days <= 0):
        raise ValueError("train_days, test_days and step_days must be positive, embargo_days not negative")
    step = step_days or test_days
    dates = df.where(F.col(date).isNotNull()).select(F.col(date).alias("date")).distinct()
    span = dates.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    reach = train_days + embargo_days + test_days - 1
    # The last fold is the first whose test end reaches the last date.
    count = F.greatest(F.ceil((F.datediff("last", "first") - reach) / F.lit(float(step))), F.lit(0))
    starts = span.where(F.col("first").isNotNull()).select("first", F.explode(F.sequence(F.lit(0), count.cast("int"))).alias("raw_fold"))
    days = starts.select(
        "raw_fold", F.date_add("first", F.col("raw_fold") * step).alias("train_start"))
    days = days.withColumn("train_end", F.date_add("train_start", train_days - 1)).withColumn(
        "test_start", F.date_add("train_end", 1 + embargo_days)).withColumn("test_end", F.date_add("test_start", test_days - 1))
    roles = F.explode(F.array(
        F.struct(F.lit("train").alias("role"), F.sequence("train_start", "train_end").alias("days")),
        F.struct(F.lit("test").alias("role"), F.sequence("test_start", "test_end").alias("days")))).alias("side")
    cells = days.select("*", roles).select(
        "raw_fold", "train_start", "train_end", "test_start", "test_end", "side.role", F.explode("side.days").alias("date"))
    member = cells.join(dates, "date")
    both = member.groupBy("raw_fold").agg(F.countDistinct("role").alias("__r")).where(F.col("__r") == 2)
    # Folds are few (calendar days over step), so one ordered pass numbers them.
    numbered = both.select("raw_fold", (F.row_number().over(Window.orderBy("raw_fold")) - 1).alias("fold"))
    return member.join(numbered, "raw_fold").drop("raw_fold")


def rolling_plan(df: DataFrame, date: str, train_days: int = 365, calibration_days: int = 30, test_days: int = 30,
                 embargo_days: int = 0) -> DataFrame:
    """Train, calibration and test windows by position over the distinct dates, with a status row when there are none."""
    dates = df.where(F.col(date).isNotNull()).select(F.col(date).alias("date")).distinct()
    # Distinct dates follow the calendar, so numbering them in one ordered pass stays small.
    numbered = dates.select("date", (F.row_number().over(Window.orderBy("date")) - 1).alias("i"))
    need = train_days + calibration_days + test_days + embargo_days
    total = dates.agg(F.count(F.lit(1)).alias("unique_target_dates"))
    ends = total.where(F.col("unique_target_dates") >= need).select(
        "unique_target_dates", F.explode(F.sequence(F.lit(need).cast("long"), F.col("unique_target_dates"), F.lit(test_days).cast("long"))).alias("test_end_i"))
    plan = ends.withColumn("test_start_i", F.col("test_end_i") - test_days).withColumn(
        "calibration_start_i", F.col("test_start_i") - embargo_days - calibration_days).withColumn(
        "train_end_i", F.col("calibration_start_i") - embargo_days).withColumn(
        "train_start_i", F.greatest(F.lit(0), F.col("train_end_i") - train_days)
    ).where((F.col("train_end_i") > F.col("train_start_i")) & (F.col("calibration_start_i") >= 0))
    plan = plan.withColumn("fold", ((F.col("test_end_i") - need) / test_days).cast("long"))
    for name, index in (
        ("train_start", F.col("train_start_i")), ("train_end", F.col("train_end_i") - 1),
        ("calibration_start", F.col("calibration_start_i")), ("calibration_end", F.col("test_start_i") - embargo_days - 1),
        ("test_start", F.col("test_start_i")), ("test_end", F.col("test_end_i") - 1),
    ):
        day = numbered.select(F.col("i").alias("__i"), F.col("date").alias(name))
        plan = plan.withColumn("__i", index).join(day, "__i", "left").drop("__i")
    status = total.withColumns({
        "status": F.when(F.col("unique_target_dates") == 0, "data_missing").when(F.col("unique_target_dates") < need, "insufficient_history").otherwise("ready"),
        "required_target_dates": F.lit(need).cast("long")})
    windows = [c for c in plan.columns if c.endswith(("_start", "_end"))]
    return status.join(plan.select("unique_target_dates", "fold", *windows), "unique_target_dates", "left")


FOLD_FIELDS = ("fold", "train_start", "train_end", "test_start", "test_end")


def _fold_scores(good: DataFrame) -> DataFrame:
    return good.groupBy(*FOLD_FIELDS, "model_name", "model_version", "city", "temp_type", "lead_hours").agg(
        F.count(F.lit(1)).alias("eligible_predictions"), F.avg("abs_error_f").alias("mae_f"),
        F.count("crps_f").alias("crps_predictions"), F.avg("crps_f").alias("crps_f"))


def walk_forward_skill(forecasts: DataFrame, labels: DataFrame, train_days: int = 365, test_days: int = 30,
                       embargo_days: int = 0) -> DataFrame:
    """Skill of the forecasts as they are, by fold of their target date."""
    good, _ = forecast_skill(forecasts, labels)
    folds = walk_forward_folds(forecasts, train_days=train_days, test_days=test_days, embargo_days=embargo_days)
    test = folds.where(F.col("role") == "test").select(*FOLD_FIELDS, F.col("date").alias("outcome_local_date"))
    return _fold_scores(good.join(test, "outcome_local_date"))


def _fold_parts(forecasts: DataFrame, folds: DataFrame) -> tuple[DataFrame, DataFrame]:
    member = folds.select(*FOLD_FIELDS, "role", F.col("date").alias("outcome_local_date"))
    train = forecasts.join(member.where(F.col("role") == "train").drop("role"), "outcome_local_date")
    test = forecasts.join(member.where(F.col("role") == "test").drop("role"), "outcome_local_date")
    return train, test


def walk_forward_postprocessor(forecasts: DataFrame, labels: DataFrame, method: str, train_days: int = 365,
                               test_days: int = 30, embargo_days: int = 0) -> DataFrame:
    """Fit on each fold's train side as of its first test decision, correct the test side, score it."""
    fit, apply = models.POSTPROCESSORS[method]
    folds = cut_lineage(walk_forward_folds(
        forecasts, train_days=train_days, test_days=test_days, embargo_days=embargo_days))
    train, test = _fold_parts(forecasts, folds)
    gate = test.groupBy("fold").agg(F.min("decision_time_utc").alias("__as_of"))
    rows = cut_lineage(models.training_rows(train.join(gate, "fold"), labels, F.col("__as_of")))
    corrected = cut_lineage(apply(test, cut_lineage(fit(rows, extra=["fold"])), ["fold"]))
    good, _ = forecast_skill(corrected, labels)
    return _fold_scores(good)


def walk_forward_blend(forecasts: DataFrame, labels: DataFrame, train_days: int = 365, test_days: int = 30) -> DataFrame:
    """Skill of the inverse-error blend per fold; a fold needs at least two weighted models."""
    folds = cut_lineage(walk_forward_folds(forecasts, train_days=train_days, test_days=test_days))
    train, test = _fold_parts(forecasts, folds)
    as_of = F.col("test_start").cast("timestamp")
    weights = models.fit_weights(models.training_rows(train, labels, as_of), extra=["fold"]).where(F.col("models") >= 2)
    weights = cut_lineage(weights)
    blended = cut_lineage(models.apply_blend(test, weights, ["fold"]))
    good, bad = forecast_skill(blended, labels)
    scores = good.groupBy("fold").agg(
        F.count(F.lit(1)).alias("eligible_predictions"), F.avg("abs_error_f").alias("mae_f"), F.avg("crps_f").alias("crps_f"))
    refused = bad.groupBy("fold").agg(F.count(F.lit(1)).alias("rejected_predictions"))
    names = weights.groupBy("fold").agg(
        F.array_join(F.array_sort(F.collect_list("model_name")), ";").alias("member_models"))
    bounds = folds.select(*FOLD_FIELDS).distinct()
    return bounds.join(scores, "fold").join(refused, "fold", "left").join(names, "fold").na.fill(0, ["rejected_predictions"])


def nowcast_errors(states: DataFrame, labels: DataFrame) -> DataFrame:
    """Mean error of the extremes so far by city and local hour, with the city's rejected counts."""
    label = labels.select("city", F.col("date").alias("local_date"), "label_available_ts", F.col("tmax_f").alias("__high"), F.col("tmin_f").alias("__low"))
    wide = states.join(label, ["city", "local_date"], "left").withColumn(REASON, first_reason(
        (F.col("label_available_ts").isNull(), "missing_label"),
        (F.col("feature_asof_utc").isNull() | (F.col("label_available_ts") <= F.col("feature_asof_utc")), "label_not_available_asof"),
        (F.col("local_hour").isNull(), "invalid_local_hour")))
    good, bad = split(wide)
    known = good.where(F.col("observed_high_so_far_f").isNotNull() & F.col("observed_low_so_far_f").isNotNull())
    scores = known.groupBy("city", "local_hour").agg(
        F.count(F.lit(1)).alias("eligible_rows"),
        F.avg(F.abs(F.col("observed_high_so_far_f") - F.col("__high"))).alias("mae_high_f"),
        F.avg(F.abs(F.col("observed_low_so_far_f") - F.col("__low"))).alias("mae_low_f"))
    refused = bad.groupBy("city").agg(
        F.count_if(F.col(REASON) == "missing_label").alias("rejected_missing_label"),
        F.count_if(F.col(REASON) == "label_not_available_asof").alias("rejected_leakage"))
    return scores.join(refused, "city", "left").na.fill(0, ["rejected_missing_label", "rejected_leakage"])


def skill_rollup(summary: DataFrame) -> DataFrame:
    """Monthly skill rows folded with their counts as weights."""
    n, c = F.col("eligible_predictions"), F.col("crps_predictions")
    keys = ["model_name", "model_version", "city", "temp_type", "lead_hours"]
    return summary.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("target_months"), F.sum(n).alias("eligible_predictions"),
        (F.sum(F.coalesce("mae_f", F.lit(0.0)) * n) / F.nullif(F.sum(n), F.lit(0))).alias("weighted_mae_f"),
        F.sum(c).alias("crps_predictions"),
        (F.sum(F.coalesce("crps_f", F.lit(0.0)) * c) / F.nullif(F.sum(c), F.lit(0))).alias("weighted_crps_f"),
        *[F.sum(f"rejected_{r}").alias(f"rejected_{r}") for r in SKILL_REASONS])


# The stress scenarios.
DELAYS = (2, 5, 10, 20)
OUTAGES = (5, 15, 30, 60)
BIASES = (-0.05, -0.03, -0.02, -0.01, 0.01, 0.02, 0.03, 0.05)
DISTANCES = (0.25, 0.5, 1.0, 2.0)


def robustness(rows: DataFrame) -> DataFrame:
    """Brier and log loss of every scenario in one pass: rows are folded into all scenarios at once.

    Columns: prediction, outcome (0/1), decision_time_utc, source_receipt_time, nwp_receipt_time,
    observation_age_minutes, threshold_distance_f, spread, volume, quote_jump.
    """
    def late(receipt: str, minutes: int) -> Column:
        return F.unix_micros(receipt) + F.lit(minutes * 60_000_000) <= F.unix_micros("decision_time_utc")

    def number(name: str) -> Column:
        return clocks.finite(F.col(name))

    cases: list[tuple[str, Column, float]] = [("baseline", F.lit(True), 0.0)]
    for m in DELAYS:
        cases.append((f"feed_delay_{m}m", late("source_receipt_time", m), 0.0))
        cases.append((f"nwp_late_{m}m", late("nwp_receipt_time", m), 0.0))
    cases += [(f"observation_outage_{m}m", number("observation_age_minutes") >= m, 0.0) for m in OUTAGES]
    cases += [(f"calibration_bias_{b:+.2f}", F.lit(True), b) for b in BIASES]
    cases += [(f"threshold_within_{d:g}f", F.abs(number("threshold_distance_f")) <= d, 0.0) for d in DISTANCES]
    cases += [("wide_spread", number("spread") >= 0.05, 0.0), ("low_volume", number("volume") <= 10, 0.0),
              ("quote_jump", F.abs(number("quote_jump")) >= 0.10, 0.0)]
    p = clocks.finite(F.col("prediction"))
    p = F.when(p.between(0.0, 1.0), p)
    y = F.when(F.col("outcome").isin(0, 1), F.col("outcome").cast("double"))
    scenario = F.explode(F.array(*[
        F.struct(F.lit(name).alias("scenario"), F.coalesce(keep, F.lit(False)).alias("keep"), F.lit(bias).alias("bias"))
        for name, keep, bias in cases])).alias("s")
    wide = rows.select(p.alias("p"), y.alias("y"), scenario).select("p", "y", "s.*")
    scored = F.col("keep") & F.col("p").isNotNull() & F.col("y").isNotNull()
    q = F.least(F.lit(1 - 1e-12), F.greatest(F.lit(1e-12), F.col("p") + F.col("bias")))
    wide = wide.withColumn("q", F.when(scored, q))
    return wide.groupBy("scenario").agg(
        F.count_if("keep").alias("rows"), F.count_if(~F.col("keep")).alias("filtered_out"), F.count("q").alias("scored"),
        F.count_if(F.col("keep") & F.col("q").isNull()).alias("rejected"),
        F.avg((F.col("q") - F.col("y")) * (F.col("q") - F.col("y"))).alias("brier"),
        F.avg(-(F.col("y") * F.log("q") + (1 - F.col("y")) * F.log(1 - F.col("q")))).alias("log_loss"))


def settlement_check(markets: DataFrame, labels: DataFrame, edge: float = 0.15) -> DataFrame:
    """Does the label, exact or rounded half to even, reproduce the settled result? Per city."""
    label = labels.select("city", F.col("date").alias("outcome_local_date"), "tmax_f", "tmin_f")
    rows = markets.where(F.col("status") == "finalized").join(label, ["city", "outcome_local_date"], "left")
    v = F.when(F.col("temp_type") == "high", F.col("tmax_f")).otherwise(F.col("tmin_f"))
    lo, hi, yes = F.col("bucket_floor_f"), F.col("bucket_ceil_f"), F.col("result") == "yes"
    rows = rows.withColumns({
        "__v": v, "__exact": inside_bucket(v, lo, hi) == yes, "__rounded": inside_bucket(F.bround(v), lo, hi) == yes,
        "__near": F.coalesce(F.abs(v - lo) < edge, F.lit(False)) | F.coalesce(F.abs(v - hi) < edge, F.lit(False))})
    known = F.col("__v").isNotNull()
    return rows.groupBy("city").agg(
        F.count_if(known).alias("checked"), F.count_if(known & F.col("__exact")).alias("exact_ok"),
        F.count_if(known & F.col("__rounded")).alias("rounded_ok"), F.count_if(known & F.col("__near")).alias("boundary_close"),
        F.count_if(known & ~F.col("__exact") & F.col("__near")).alias("mismatch_boundary"), F.count_if(~known).alias("label_missing"))


def cross_source_match(reports: DataFrame, labels: DataFrame) -> DataFrame:
    """First report of each day against the rounded label, per city."""
    first = reports.groupBy("city", "climate_date").agg(
        F.min_by(F.struct("official_daily_high_f", "official_daily_low_f"),
                 F.struct("publication_time_utc", "official_daily_high_f", "official_daily_low_f")).alias("r"),
        F.count(F.lit(1)).alias("versions"))
    label = labels.select("city", F.col("date").alias("climate_date"), "tmax_f", "tmin_f")
    rows = first.join(label, ["city", "climate_date"])
    high = F.bround("tmax_f") == F.bround(F.col("r.official_daily_high_f"))
    low = F.bround("tmin_f") == F.bround(F.col("r.official_daily_low_f"))
    return rows.groupBy("city").agg(
        F.count(high).alias("high_compared"), F.count_if(high).alias("high_matched"), F.count(low).alias("low_compared"),
        F.count_if(low).alias("low_matched"), F.sum("versions").alias("product_versions"))


def issuance_slots(reports: DataFrame) -> DataFrame:
    """Earliest and latest clock time in the two daily issuance slots, per city."""
    hhmm = F.date_format("publication_time_utc", "HH:mm")
    return reports.withColumn("__t", hhmm).groupBy(
        "city", F.when(F.col("__t") < "04:00", "00xxZ").otherwise("08xxZ").alias("slot")
    ).agg(F.min("__t").alias("first"), F.max("__t").alias("last"), F.count(F.lit(1)).alias("products"))


def price_scenarios(edges: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows, positive candidates and mean, least and greatest net edge of each cost scenario."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(name).alias("scenario"), clocks.finite(F.col(column)).alias("v")) for name, column in columns.items()])).alias("s")
    v = F.col("s.v")
    return edges.select(cells).groupBy("s.scenario").agg(
        F.count(v).alias("rows"), F.count_if(v > 0).alias("positive_candidates"), F.avg(v).alias("mean_net_edge"),
        F.min(v).alias("min_net_edge"), F.max(v).alias("max_net_edge"))
