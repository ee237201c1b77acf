"""Quotes at decision, next-bar fills, sizing, resampling, ledgers and gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clocks
from ..session import cut_lineage
from .filters import REASON, first_reason, split
from .quantiles import floor_index_quantiles
from .timeline import Running, asof_join, running_scan, time_segment


def edges_at_decision(signals: DataFrame, candles: DataFrame, outcomes: DataFrame, min_edge: float = 0.0,
                      fee_rate: float = 0.0, slippage_reserve: float = 0.0, segment: str = "month") -> DataFrame:
    """YES and NO edge after costs against the last closed candle at or before each decision."""
    out = asof_join(
        signals, candles, ["market_ticker"], F.col("decision_time_utc"), F.col("end_period_ts"),
        {"candle_end": F.col("end_period_ts"), "yes_ask": F.col("yes_ask_close"),
         "yes_bid": F.coalesce(F.nullif("yes_bid_close", F.lit(0.0)), "yes_ask_close")}, segment=segment, how="inner")
    fair, ask, bid = F.col("bucket_probability"), F.col("yes_ask"), F.col("yes_bid")
    out = out.where((ask > 0) & (ask < 1)).join(outcomes, "market_ticker", "left")
    yes_cost = F.least(F.lit(1.0), ask + F.lit(slippage_reserve) + ask * F.lit(fee_rate))
    no_cost = F.greatest(F.lit(0.0), F.lit(1.0) - bid + F.lit(slippage_reserve) + (F.lit(1.0) - bid) * F.lit(fee_rate))
    return out.withColumns({
        "gross_edge": fair - ask, "yes_edge_after_cost": fair - yes_cost, "no_edge_after_cost": F.lit(1.0) - fair - no_cost,
        "triggered": F.greatest(fair - yes_cost, F.lit(1.0) - fair - no_cost) >= min_edge})


def edge_summary(edges: DataFrame, fee_rate: float = 0.0) -> DataFrame:
    won, settled = F.col("settled_yes") == "yes", F.col("settled_yes").isNotNull()
    payoff = F.when(settled, F.when(won, F.lit(1.0)).otherwise(F.lit(0.0)) - F.col("yes_ask") - F.col("yes_ask") * F.lit(fee_rate))
    return edges.agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if("triggered").alias("triggered_candidates"), F.count_if(settled).alias("settled_candidates"),
        F.avg(F.when(settled, won.cast("double"))).alias("hit_rate"), F.avg("gross_edge").alias("mean_gross_edge"),
        F.avg("yes_edge_after_cost").alias("mean_yes_edge_after_cost"), F.avg("no_edge_after_cost").alias("mean_no_edge_after_cost"),
        F.sum(payoff).alias("one_contract_net_payoff"))


def next_bar_fills(signals: DataFrame, candles: DataFrame, outcomes: DataFrame, fee_rate: float = 0.0,
                   slippage_rate: float = 0.0, segment: str = "month") -> DataFrame:
    """Signal on the last closed bar, fill on the next one, in three scenarios with the settled payoff."""
    rows = signals.where(F.col("bucket_probability").between(0.0, 1.0))
    prior = cut_lineage(asof_join(
        rows, candles, ["market_ticker"], F.col("decision_time_utc"), F.col("end_period_ts"),
        {"signal_candle_end": F.col("end_period_ts"), "ask": F.col("yes_ask_close"), "bid": F.coalesce("yes_bid_close", "yes_ask_close")},
        segment=segment, how="inner"))
    both = asof_join(
        prior, candles, ["market_ticker"], F.col("decision_time_utc"), F.col("end_period_ts"),
        {"execution_candle_end": F.col("end_period_ts"), "next_open": F.col("yes_ask_open"), "next_close": F.col("yes_ask_close"), "next_high": F.col("yes_ask_high")},
        inclusive=False, backward=False, segment=segment, how="inner")
    usable = F.lit(True)
    for name in ("ask", "next_open", "next_close", "next_high"):
        usable = usable & (F.col(name) > 0) & (F.col(name) < 1)
    both = both.where(usable).join(outcomes, "market_ticker", "left")
    spread = F.greatest(F.lit(0.0), F.col("ask") - F.col("bid"))
    cases = F.explode(F.array(
        F.struct(F.lit("conservative").alias("name"), F.col("next_high").alias("fill"), F.lit(0.0).alias("slip")),
        F.struct(F.lit("base").alias("name"), F.col("next_close").alias("fill"), (spread * F.lit(slippage_rate)).alias("slip")),
        F.struct(F.lit("optimistic").alias("name"), F.col("next_open").alias("fill"), F.lit(0.0).alias("slip")))).alias("case")
    out = both.select("*", cases).withColumns({
        "scenario": F.col("case.name"), "fill_price": F.least(F.lit(1.0), F.col("case.fill") + F.col("case.slip"))})
    fee = F.col("fill_price") * F.lit(fee_rate)
    win = F.when(F.col("settled_yes") == "yes", F.lit(1.0)).otherwise(F.lit(0.0))
    return out.withColumns({
        "fee": fee, "gross_edge": F.col("bucket_probability") - F.col("fill_price"),
        "no_side_executable_cost": F.lit(1.0) - F.col("bid"), "no_side_gross_edge": F.col("bid") - F.col("bucket_probability"),
        "one_contract_net_payoff": F.when(F.col("settled_yes").isNotNull(), win - F.col("fill_price") - fee)}).drop("case")


def fill_summary(fills: DataFrame, signals: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per scenario: payoff moments, per-trade Sharpe and Sortino, drawdown of summed profit, turnover, fill rate.

    The drawdown runs over trades in ``order``; their numbers come from a segmented scan by month.
    """
    paid = fills.where(F.col("one_contract_net_payoff").isNotNull())
    pay = F.col("one_contract_net_payoff")
    path = cut_lineage(running_scan(
        paid.select("scenario", "decision_time_utc", *[c for c in order if c != "decision_time_utc"], pay.alias("__pay")),
        ["scenario"], list(order), {"__level": Running("sum", F.col("__pay"))}, time_segment("decision_time_utc", "month")))
    peaks = running_scan(path, ["scenario"], list(order), {"__peak": Running("max", F.col("__level"))}, time_segment("decision_time_utc", "month"))
    falls = peaks.groupBy("scenario").agg(
        F.max(F.greatest(F.greatest("__peak", F.lit(0.0)) - F.col("__level"), F.lit(0.0))).alias("max_drawdown"))
    total = signals.agg(F.count(F.lit(1)).alias("__n")).scalar()
    down = F.least(F.lit(0.0), pay)
    spread, downside = F.coalesce(F.stddev_samp(pay), F.lit(0.0)), F.sqrt(F.avg(down * down))
    out = paid.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(pay).alias("net_payoff"), F.avg(pay).alias("mean_payoff"), spread.alias("std_payoff"),
        F.when(spread > 0, F.avg(pay) / spread).otherwise(0.0).alias("sharpe_per_trade"),
        F.when(downside > 0, F.avg(pay) / downside).otherwise(0.0).alias("sortino_per_trade"),
        F.count_if(pay > 0).alias("wins"), F.avg((pay > 0).cast("double")).alias("win_rate"), F.sum("fill_price").alias("turnover"))
    return out.join(falls, "scenario").withColumn("fill_rate", F.col("rows") / total)


def kelly(probability: Column, price: Column, bankroll: float, fraction: float = 0.25, max_loss_fraction: float = 0.01,
          max_allocation_fraction: float = 0.05, fee_rate: Column | float = 0.0) -> dict[str, Column]:
    """Capped fractional Kelly stake in whole contracts; NULL where the inputs are out of range."""
    fee = fee_rate if isinstance(fee_rate, Column) else F.lit(float(fee_rate))
    net = price * (F.lit(1.0) + fee)
    valid = (probability > 0) & (probability < 1) & (price > 0) & (price < 1) & (fee >= 0) & (net < 1)
    odds = (F.lit(1.0) - net) / net
    share = F.greatest(F.lit(0.0), (probability * odds - (F.lit(1.0) - probability)) / odds)
    stake = F.least(share * F.lit(bankroll * fraction), F.lit(bankroll * max_allocation_fraction))
    count = F.least(F.floor(stake / net), F.floor(F.lit(bankroll * max_loss_fraction) / net))
    return {
        "kelly_fraction": F.when(valid, share), "contracts": F.when(valid, count.cast("double")),
        "allocation_dollars": F.when(valid, count * net), "net_edge": F.when(valid, probability - net)}


def allocate_event(candidates: DataFrame, bankroll: float, max_loss_fraction: float = 0.01) -> DataFrame:
    """Scale the contracts of an event so that together they stay under one loss cap.

    The event total is an aggregate joined back, so an event of any size is fine.
    """
    cap = bankroll * max_loss_fraction
    fee = F.coalesce("fee_rate", F.lit(0.0))
    sized = candidates.withColumns(kelly(
        F.col("probability"), F.col("price"), bankroll, 1.0, max_loss_fraction, 1.0, fee))
    totals = sized.groupBy("event_ticker").agg(F.sum("allocation_dollars").alias("__total"))
    net = F.col("price") * (F.lit(1.0) + fee)
    over = F.col("__total") > F.lit(cap)
    scaled = F.floor(F.col("allocation_dollars") * F.lit(cap) / F.col("__total") / net)
    out = sized.join(totals, "event_ticker")
    out = out.withColumn("contracts", F.when(over, scaled.cast("double")).otherwise(F.col("contracts")))
    return out.withColumn("allocation_dollars", F.when(over, F.col("contracts") * net).otherwise(F.col("allocation_dollars"))).drop("__total")


def _block_start(sim: Column, block: Column, n: Column, seed: int) -> Column:
    """Where a block of a resample starts: an integer mix, the same on every run."""
    mixed = (sim * 7919 + block * 104729 + F.lit(seed) * 15485863 + 12345) * 69069 % 2147483647
    return mixed * 48271 % 2147483647 % n


def _draws(n: DataFrame, simulations: int, block: int, seed: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, sim, slot, t): circular moving blocks whose starts come from an integer mix, the same on every run.

    ``n`` has one row per series: its keys and its length ``n``.
    """
    starts = n.withColumn("sim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(simulations - 1).cast("long")))).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / block) - 1)))
    starts = starts.withColumn("start", _block_start(F.col("sim"), F.col("block"), F.col("n"), seed))
    slots = starts.withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(block - 1))))
    return slots.select(
        *keys, "sim", (F.col("block") * block + F.col("offset")).alias("slot"), ((F.col("start") + F.col("offset")) % F.col("n")).alias("t"), "n"
    ).where(F.col("slot") < F.col("n"))


def block_bootstrap(returns: DataFrame, simulations: int = 1000, block_size: int = 5, seed: int = 0, key: str = "strategy") -> DataFrame:
    """Terminal return and drawdown tails of every strategy's return series by moving-block resampling.

    ``returns`` has the key, t (0 upwards per key) and value, one row per period, so a path is as long as the calendar. A strategy's
    log returns travel as one array, which each resample reads in its own order: the periods of the paths are never rows.
    """
    periods = returns.where(F.col(key).isNotNull()).groupBy(key, "t").agg(F.sum(F.log1p("value")).alias("log"), F.count(F.lit(1)).alias("rows"))
    series = periods.groupBy(key).agg(F.sum("rows").alias("n"), F.max("t").alias("last"), F.sort_array(F.collect_list(F.struct("t", "log"))).alias("periods"))
    # Periods without a row are gaps: a draw of one changes nothing.
    whole = (F.col("last") == F.size("periods") - 1) & (F.col("periods")[0]["t"] == 0)
    at = F.map_from_entries(F.filter("periods", lambda p: p["t"].isNotNull()))
    logs = F.when(whole, F.transform("periods", lambda p: p["log"])).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda t: at[t.cast(returns.schema["t"].dataType)]))
    sims = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(simulations - 1).cast("long"))).alias("sim")
    paths = series.select(key, "n", logs.alias("logs")).select(key, "n", "logs", sims).repartition(key, "sim")

    def step(state: Column, slot: Column) -> Column:
        start = _block_start(F.col("sim"), F.floor(slot / block_size), F.col("n"), seed)
        log = F.get("logs", ((start + slot % block_size) % F.col("n")).cast("int"))
        level = F.coalesce(state["level"] + log, state["level"], log)
        peak = F.greatest(state["peak"], level, F.lit(0.0))
        return F.struct(level.alias("level"), peak.alias("peak"), F.greatest(state["drawdown"], F.lit(1.0) - F.exp(level - peak)).alias("drawdown"))

    none = F.lit(None).cast("double")
    walked = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), F.struct(none.alias("level"), none.alias("peak"), none.alias("drawdown")), step)
    sims = cut_lineage(paths.select(key, "sim", walked.alias("end")).select(
        key, "sim", (F.exp("end.level") - 1).alias("terminal"), F.col("end.drawdown").alias("drawdown")))
    terminal = floor_index_quantiles(sims, [key], "terminal", {"terminal_return_p05": 0.05, "terminal_return_median": 0.5})
    drop = floor_index_quantiles(sims, [key], "drawdown", {"max_drawdown_p95": 0.95}).drop("group_rows")
    loss = sims.groupBy(key).agg(F.avg((F.col("terminal") < 0).cast("double")).alias("probability_of_loss"))
    return terminal.join(drop, key).join(loss, key).withColumnRenamed("group_rows", "simulations")


def reality_check(returns: DataFrame, simulations: int = 2000, block_size: int = 5, seed: int = 0) -> DataFrame:
    """Best strategy by studentised mean and the share of resamples whose best reaches it.

    ``returns`` has strategy, t and value, equally long per strategy. All strategies share each draw.
    """
    def stat(value: Column) -> Column:
        spread = F.stddev_samp(value)
        return F.when(spread > 0, F.avg(value) / spread * F.sqrt(F.count(value))).when(
            F.avg(value) > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))

    observed = returns.groupBy("strategy").agg(stat(F.col("value")).alias("stat"), F.avg("value").alias("__mean"), F.count(F.lit(1)).alias("n"))
    centred = returns.join(observed.select("strategy", "__mean"), "strategy").select("strategy", "t", (F.col("value") - F.col("__mean")).alias("value"))
    n = observed.agg(F.max("n").alias("n"))
    resampled = _draws(n, simulations, block_size, seed).join(centred, "t").groupBy("sim", "strategy").agg(stat(F.col("value")).alias("s"))
    best = observed.agg(F.max_by("strategy", F.struct("stat", "strategy")).alias("best_strategy"), F.max("stat").alias("best_stat"), F.max("n").alias("observations"))
    peak = resampled.groupBy("sim").agg(F.max("s").alias("s"))
    bar = best.select("best_stat").scalar()
    counts = peak.agg(F.avg((F.col("s") >= bar).cast("double")).alias("p"), F.count(F.lit(1)).alias("simulations"))
    return best.withColumns({"p_value": counts.select("p").scalar(), "simulations": counts.select("simulations").scalar()})


LEDGER_FIELDS = ("record_id", "record_type", "market_ticker", "decision_ts", "scenario", "price", "fee", "settled_yes", "net_payoff", "manifest_path")
RECORD_TYPES = ("prediction", "would_have_order", "simulated_fill", "settlement")


def ledger_records(fills: DataFrame, manifest_path: str) -> DataFrame:
    """An order and a fill record per execution row, with ids made of market, scenario and bar."""
    base = F.concat_ws("|", F.col("market_ticker").cast("string"), "scenario", F.unix_seconds("execution_candle_end").cast("string"))
    none = F.lit(None).cast("double")
    records = F.explode(F.array(
        F.struct(F.concat(base, F.lit("|order")).alias("record_id"), F.lit("would_have_order").alias("record_type"), F.col("ask").alias("price"),
                 none.alias("fee"), F.lit(None).cast("string").alias("settled_yes"), none.alias("net_payoff")),
        F.struct(F.concat(base, F.lit("|fill")).alias("record_id"), F.lit("simulated_fill").alias("record_type"), F.col("fill_price").alias("price"),
                 F.col("fee").alias("fee"), F.col("settled_yes").alias("settled_yes"), F.col("one_contract_net_payoff").alias("net_payoff")))).alias("r")
    return fills.select("market_ticker", F.col("decision_time_utc").alias("decision_ts"), "scenario", records).select(
        "r.*", "market_ticker", "decision_ts", "scenario", F.lit(manifest_path).alias("manifest_path")).select(*LEDGER_FIELDS)


def append_ledger(existing: DataFrame, records: DataFrame, manifests: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid records with unseen ids, and the refused ones with a reason.

    ``incomplete``: no id or market; ``unknown_type``: no known record type; ``no_manifest``, ``manifest_unknown``: a trading record without a
    manifest, or with one that is not listed; ``repeated_id``: the id is in the ledger already or comes twice.
    """
    copies = records.groupBy("record_id").agg(F.count(F.lit(1)).alias("__n"))
    seen = existing.select("record_id").distinct().withColumn("__seen", F.lit(True))
    wide = records.join(copies, "record_id").join(seen, "record_id", "left")
    if manifests is not None:
        wide = wide.join(manifests.select("manifest_path").distinct().withColumn("__known", F.lit(True)), "manifest_path", "left")
    else:
        wide = wide.withColumn("__known", F.lit(True))
    trading = F.col("record_type").isin("prediction", "would_have_order", "simulated_fill")
    out = wide.withColumn(REASON, first_reason(
        (clocks.first_text(F.col("record_id")).isNull() | F.col("market_ticker").isNull(), "incomplete"),
        (~F.coalesce(F.col("record_type").isin(*RECORD_TYPES), F.lit(False)), "unknown_type"),
        (trading & clocks.first_text(F.col("manifest_path")).isNull(), "no_manifest"),
        (F.col("__known").isNull(), "manifest_unknown"),
        (F.col("__seen"), "repeated_id"), (F.col("__n") > 1, "repeated_id"),
    )).drop("__n", "__seen", "__known")
    return split(out.select(*records.columns, REASON))


# Default readiness limits.
READINESS_LIMITS = {
    "max_feed_age_seconds": 300.0, "max_model_run_age_seconds": 21600.0, "max_clock_drift_seconds": 2.0,
    "max_calibration_error": 0.10, "max_daily_drawdown": 0.05,
}


def readiness(snapshots: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Reason codes of each telemetry snapshot; anything missing fails.

    Map columns feed_age_seconds and model_run_age_seconds; scalars probability_consistent,
    clock_drift_seconds, orderbook_sequence_gap_resolved, settlement_rules_verified,
    calibration_error and daily_drawdown.
    """
    limit = {**READINESS_LIMITS, **(limits or {})}

    def stale(column: str, code: str, missing: str, bound: float) -> Column:
        values = F.map_values(F.col(column))
        empty = F.col(column).isNull() | (F.size(F.col(column)) <= 0)
        late = F.filter(values, lambda v: (v < 0) | (v > F.lit(bound)) | v.isNull())
        return F.when(empty, F.array(F.lit(missing))).otherwise(F.transform(late, lambda v: F.lit(code)))

    def flag(failed: Column, code: str) -> Column:
        return F.when(F.coalesce(failed, F.lit(True)), F.array(F.lit(code))).otherwise(F.array().cast("array<string>"))

    codes = F.concat(
        stale("feed_age_seconds", "stale_feed", "missing_feed_age", limit["max_feed_age_seconds"]),
        stale("model_run_age_seconds", "stale_model_run", "missing_model_run_age", limit["max_model_run_age_seconds"]),
        flag(~F.col("probability_consistent"), "probability_inconsistent"),
        flag(F.abs("clock_drift_seconds") > limit["max_clock_drift_seconds"], "clock_drift"),
        flag(~F.col("orderbook_sequence_gap_resolved"), "orderbook_gap"),
        flag(~F.col("settlement_rules_verified"), "rules_unverified"),
        flag(F.col("calibration_error") > limit["max_calibration_error"], "calibration_drift"),
        flag((F.col("daily_drawdown") < 0) | (F.col("daily_drawdown") > limit["max_daily_drawdown"]), "drawdown_limit"))
    return snapshots.withColumn("reason_codes", F.array_sort(codes)).withColumn("allow_trading", F.size("reason_codes") == 0)


# Evidence a deployment must show, in report order.
DEPLOYMENT_CHECKS = (
    "positive_oos_net_ev", "positive_test_windows", "brier_improvement", "reliability_error", "regime_independent",
    "probability_perturbation_robust", "slippage_robust", "fees_robust", "live_paper_matches_backtest",
    "outage_killswitch_tested", "contract_rules_verified",
)


def deployment_gate(snapshots: DataFrame, min_test_windows: int = 2, max_reliability_error: float = 0.05) -> DataFrame:
    """Failed checks of each snapshot, in report order; missing evidence fails."""
    passes = {
        "positive_test_windows": F.col("positive_test_windows") >= min_test_windows,
        "brier_improvement": F.col("brier_improvement") > 0,
        "reliability_error": F.col("reliability_error").between(0.0, max_reliability_error),
    }
    failed = F.filter(F.array(*[
        F.when(~F.coalesce(passes.get(name, F.col(name)), F.lit(False)), F.lit(name)) for name in DEPLOYMENT_CHECKS
    ]), lambda c: c.isNotNull())
    return snapshots.withColumn("failed_checks", failed).withColumn("pass", F.size("failed_checks") == 0)

