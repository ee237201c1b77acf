"""Scans of clocks, filters and as-of lookups over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clocks
from ..operators import features, filters, timeline
from . import shapes
from .registry import query
from .shapes import q6, q6_sql, stamp, stamp_sql, with_views


def policies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(shapes.POLICIES, "policy string, scenario string, seconds double")


# One row per feature with its effective clock, as the check SQL sees it.
VINTAGE_SQL = ("vintage", """select *, case when available_at is not null then 'exact' when retrieved_at is not null then 'observed_receipt' else 'estimated' end as availability_method,
 coalesce(available_at, retrieved_at, availability_reference_time + to_seconds(case when source='error' then 120 when source='click' and feature_name='tmpf' then 60 when source='click' then 300 else 600 end)) as eff
 from feature_rows""")


@query("j06_feature_vintage", with_views(("feature_rows", "decisions"), f"""
 select city, contract, decision_id, source, feature_name, {stamp_sql('eff')} as available_at, availability_method, revision, {q6_sql('value_f')} as value_f from (
 select d.city, d.contract, d.event_id as decision_id, v.source, v.feature_name, v.eff, v.availability_method, v.revision, v.value_f,
  row_number() over (partition by d.event_id, v.source, v.feature_name order by v.eff desc, v.issue_time desc nulls last, v.source_event_time desc nulls last, v.revision desc, v.provenance desc) as rn
 from decisions d join vintage v on d.city=v.city and d.contract=v.contract and d.target_time_utc=v.target_time_utc
 where (v.issue_time is null or v.issue_time<=v.eff) and v.source_event_time<=v.eff and v.eff<=d.decision_time_utc) where rn=1""", VINTAGE_SQL))
def feature_vintage(spark: SparkSession, sf: str) -> DataFrame:
    chosen, _, _ = features.reconstruct_vintages(
        shapes.feature_rows(spark, sf), shapes.decisions(spark, sf), policies(spark))
    return chosen.select(
        "city", "contract", F.col("event_id").alias("decision_id"), "source", "feature_name",
        stamp(F.col("effective_available_at")).alias("available_at"), "availability_method",
        "revision", q6(F.col("value")).alias("value_f"),
    )


@query("m02_vintage_ledger", with_views(("feature_rows", "decisions"), """
 select 'feature' as kind, case when issue_time>eff then 'issue_time is after available_at' else 'source_event_time is after available_at' end as reason, count(*) as n
 from vintage where issue_time>eff or source_event_time>eff group by 1,2
 union all select 'decision', 'no_features_available_asof_decision', count(*) from decisions d left join
 (select city, contract, target_time_utc, min(eff) as first from vintage where (issue_time is null or issue_time<=eff) and source_event_time<=eff group by 1,2,3) f
 using (city, contract, target_time_utc) where f.first is null or f.first>d.decision_time_utc""", VINTAGE_SQL))
def vintage_ledger(spark: SparkSession, sf: str) -> DataFrame:
    _, bad, empty = features.reconstruct_vintages(
        shapes.feature_rows(spark, sf), shapes.decisions(spark, sf), policies(spark))
    first = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(F.lit("feature").alias("kind"), "reason", "n")
    second = empty.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(F.lit("decision").alias("kind"), "reason", "n")
    return first.unionByName(second)


@query("m02_latency_scenarios", with_views(("feature_rows",), f"""
 select source, feature_name, scenario, count(*) as n_rows, {q6_sql("avg(epoch_us(eff)-epoch_us(valid_time))/1e6", 3)} as mean_delay_s from (
 select v.*, s.scenario, case when available_at is not null then available_at when retrieved_at is not null then retrieved_at else availability_reference_time + to_seconds(
  case when s.scenario='conservative' then 1800 when source='error' then 120 when source='click' and feature_name='tmpf' then 60 when source='click' then 300 else 600 end) end as eff
 from feature_rows v, (values ('base'),('conservative')) s(scenario)) where (issue_time is null or issue_time<=eff) and source_event_time<=eff group by 1,2,3"""))
def latency_scenarios(spark: SparkSession, sf: str) -> DataFrame:
    rows = shapes.feature_rows(spark, sf)
    parts = []
    for scenario in ("base", "conservative"):
        good, _ = filters.split(features.with_availability(rows, policies(spark), scenario))
        parts.append(good)
    both = parts[0].unionByName(parts[1])
    delay = (F.unix_micros("effective_available_at") - F.unix_micros("valid_time"))
    return both.groupBy("source", "feature_name", F.col("latency_scenario").alias("scenario")).agg(
        F.count(F.lit(1)).alias("n_rows"), q6(F.avg(delay) / F.lit(1e6), 3).alias("mean_delay_s"))


@query("j05_asof_latest", with_views(("signals", "candles"), f"""
 select s.signal_id, {stamp_sql('c.end_period_ts')} as candle_end, {q6_sql('c.yes_ask_close')} as yes_ask
 from signals s asof join candles c on s.market_ticker=c.market_ticker and s.decision_time_utc>=c.end_period_ts"""))
def asof_latest(spark: SparkSession, sf: str) -> DataFrame:
    out = timeline.asof_join(
        shapes.signals(spark, sf), shapes.candles(spark, sf), ["market_ticker"],
        F.col("decision_time_utc"), F.col("end_period_ts"),
        {"candle_end": F.col("end_period_ts"), "yes_ask": F.col("yes_ask_close")},
        segment="month", how="inner",
    )
    return out.select("signal_id", stamp(F.col("candle_end")).alias("candle_end"), q6(F.col("yes_ask")).alias("yes_ask"))


@query("j07_next_row", with_views(("signals", "candles"), f"""
 select s.signal_id, {stamp_sql('c.end_period_ts')} as next_end, {q6_sql('c.yes_ask_open')} as next_open
 from signals s asof join candles c on s.market_ticker=c.market_ticker and s.decision_time_utc<c.end_period_ts"""))
def next_row(spark: SparkSession, sf: str) -> DataFrame:
    out = timeline.asof_join(
        shapes.signals(spark, sf), shapes.candles(spark, sf), ["market_ticker"],
        F.col("decision_time_utc"), F.col("end_period_ts"),
        {"next_end": F.col("end_period_ts"), "next_open": F.col("yes_ask_open")},
        inclusive=False, backward=False, segment="month", how="inner",
    )
    return out.select("signal_id", stamp(F.col("next_end")).alias("next_end"), q6(F.col("next_open")).alias("next_open"))
