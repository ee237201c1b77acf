"""Point-in-time filters. Rows that fail get a ``reason`` instead of vanishing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clocks

REASON = "reason"


def first_reason(*rules: tuple[Column, str]) -> Column:
    """Reason of the first rule that holds, NULL when none does. A NULL rule does not hold."""
    chosen = F
    for failed, reason in rules:
        chosen = chosen.when(failed, F.lit(reason))
    return chosen.otherwise(F.lit(None).cast("string"))


def all_reasons(*rules: tuple[Column, Column | str]) -> Column:
    """All reasons that hold, in order and without repeats."""
    found = [F.when(failed, F.lit(r) if isinstance(r, str) else r) for failed, r in rules]
    return F.array_distinct(F.filter(F.array(*found), lambda r: r.isNotNull()))


def split(df: DataFrame, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    """Accepted rows (without the reason column) and rejected rows."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def mark_available(df: DataFrame, decision: Column, issue_fields: Sequence[str] = clocks.ISSUE_FIELDS,
                   receipt_fields: Sequence[str] = clocks.RECEIPT_FIELDS,
                   strict: bool = False) -> DataFrame:
    """Reason why a row could not be used at ``decision``; with ``strict`` a missing clock fails the job."""
    issue = clocks.first_clock(df, issue_fields)
    receipt = clocks.first_clock(df, receipt_fields)
    marked = df.withColumn(REASON, first_reason(
        (decision.isNull(), "missing_decision_clock"),
        (issue.isNull(), "missing_issue_clock"), (receipt.isNull(), "missing_receipt_clock"),
        (~clocks.available_asof(issue, receipt, decision), "after_decision"),
    ))
    if strict:
        fine = ~F.coalesce(F.col(REASON).startswith("missing"), F.lit(False))
        checked = F.assert_true(fine, F.concat(F.lit("point-in-time input: "), F.col(REASON)))
        marked = marked.where(checked.isNull())
    return marked


def known_forecasts(df: DataFrame, decision: Column, strict: bool = False) -> DataFrame:
    """Forecasts whose run was initialised and received by the decision; future valid times stay."""
    marked = mark_available(
        df, decision, ("initialization_time_utc", "forecast_issue_time"), clocks.RECEIPT_FIELDS, strict
    )
    return split(marked)[0]


def valid_forecasts(df: DataFrame, decision: Column, valid: str = "valid_time_utc",
                    strict: bool = False) -> DataFrame:
    """Known forecasts that are about a time no later than the decision."""
    return known_forecasts(df, decision, strict).where(clocks.clock(df, valid) <= decision)


def known_labels(df: DataFrame, instant: Column) -> DataFrame:
    return df.where(clocks.clock(df, "label_available_ts") <= instant)


def probability_reason(probability: Column, outcome: Column, price: Column | None = None) -> Column:
    """Domain of a scored row: finite probability in [0,1], binary outcome, price inside (0,1)."""
    value = clocks.finite(probability)
    rules = [
        (value.isNull(), "probability_not_finite"),
        (~value.between(0.0, 1.0), "probability_out_of_range"),
        (outcome.isNull() | ~outcome.isin(0, 1), "outcome_not_binary"),
    ]
    if price is not None:
        rules.append((price.isNull() | ~((price > 0) & (price < 1)), "price_not_inside_unit"))
    return first_reason(*rules)


def scope_reason(station: Column, targets: Sequence, *hard: tuple[Column, str]) -> Column:
    """Rows outside the allow-list are scoped out, which is counted apart from hard rejects."""
    outside = ~F.coalesce(station.isin(*targets), F.lit(False))
    return first_reason((outside, "non_target_station"), *hard)


def inside_bucket(value: Column, floor: Column, ceil: Column) -> Column:
    """Both bounds inclusive, a NULL bound is open."""
    return (floor.isNull() | (value >= floor)) & (ceil.isNull() | (value <= ceil))


def fresh(later: Column, earlier: Column, max_minutes: float) -> Column:
    return F.coalesce(clocks.age_minutes(later, earlier).between(0.0, max_minutes), F.lit(False))


def quote_prices(df: DataFrame, bid: str, ask: str, last: str) -> DataFrame:
    """Mid, implied probability (last trade, else mid) and spread."""
    mid = F.bround((F.col(bid) + F.col(ask)) / 2, 2)
    return df.withColumns({
        "mid_price": mid,
        "implied_probability": F.bround(F.coalesce(F.col(last), mid), 4),
        "spread": F.bround(F.col(ask) - F.col(bid), 4),
    })


def source_era(df: DataFrame, target: Column, transition: Column, actual: Column, before: str,
               after: str) -> DataFrame:
    """Expected settlement source by target time, and whether the stated one differs."""
    expected = F.when(F.coalesce(target >= transition, F.lit(False)), after).otherwise(before)
    return df.withColumns({
        "era": F.when(F.coalesce(target >= transition, F.lit(False)), "after").otherwise("before"),
        "expected_source": expected,
    }).withColumn(REASON, first_reason(
        (target.isNull(), "invalid_target"),
        (~F.coalesce(actual, F.lit("")).eqNullSafe(F.col("expected_source")), "settlement_source_mismatch"),
    ))


def daily_source_reason(df: DataFrame, target: Column, transition: Column, product: Column,
                        rules: Column, source: str) -> DataFrame:
    """Identity and wording checks of daily markets around a source change."""
    text = F.coalesce(rules, F.lit(""))
    return df.withColumn(REASON, first_reason(
        (product.isNull() | target.isNull(), "invalid_daily_market_identity"),
        (target < transition, "historical_source_metadata_not_retained"),
        (~text.contains(product), "settlement_product_mismatch"),
        (~text.contains(source), "settlement_source_mismatch"),
    ))
