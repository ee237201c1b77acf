"""Forecast builders, post-processors and evaluation over the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clocks, numeric
from ..operators import aggregates, calibration, evaluate, features, joins, models, state, timeline
from ..operators.timeline import Running
from . import shapes, state_queries
from .registry import query
from .shapes import minutes, q6, q6_sql, stamp, stamp_sql, table, with_views

def count_rows() -> Column:
    return F.count(F.lit(1))


def horner(coefficients, x: str) -> str:
    text = repr(float(coefficients[0])) + ("" if "e" in repr(float(coefficients[0])) else "e0")
    for c in coefficients[1:]:
        text = f"({text})*({x})+{c!r}" + ("" if "e" in repr(c) else "e0")
    return f"({text})"


def cdf_sql(x: str) -> str:
    """The normal CDF of ``functions.numeric`` as SQL text."""
    a = f"abs({x})"
    frac = f"({a}+0.65e0)"
    for step in ("4e0", "3e0", "2e0", "1e0"):
        frac = f"({a}+{step}/{frac})"
    near = f"exp(-({a})*({a})/2e0)*{horner(numeric.CDF_NUMERATOR, a)}/{horner(numeric.CDF_DENOMINATOR, a)}"
    far = f"exp(-({a})*({a})/2e0)/{frac}/{numeric.SQRT_TWO_PI!r}e0"
    upper = f"case when {a}<{numeric.CDF_TAIL_SWITCH!r}e0 then {near} else {far} end"
    return f"(case when ({x})>0 then 1e0-({upper}) else {upper} end)"


def crps_sql(mean: str, observed: str, sigma: str) -> str:
    z = f"(({observed}-{mean})/{sigma})"
    return f"({sigma}*({z}*(2e0*{cdf_sql(z)}-1e0)+2e0*exp(-{z}*{z}/2e0)/sqrt(2e0*pi())-1e0/sqrt(pi())))"


# ---------------------------------------------------------------- history forecasts

def late_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Daily labels of which some are published ten days late, out of order."""
    late = (F.col("station") + F.dayofyear("date")) % 11 == 0
    return shapes.labels_daily(spark, sf).withColumn("label_available_ts", F.when(
        late, clocks.shift_hours(F.col("label_available_ts"), F.lit(240))).otherwise(F.col("label_available_ts")))


LATE = ("late", """select station, city, date, temp_type, v, case when (station+dayofyear(date))%11=0 then av + interval 240 hour else av end as av from (
 select station, city, date, 'high' as temp_type, tmax_f as v, label_available_ts as av from labels_daily union all select station, city, date, 'low', tmin_f, label_available_ts from labels_daily)""")
SCHEDULE = ("sched", "select event_ticker, city, temp_type, outcome_local_date, outcome_local_date - interval 6 hour as d from label_events")


def schedule(spark: SparkSession, sf: str) -> DataFrame:
    base = shapes.label_events(spark, sf)
    return base.select(
        "event_ticker", "city", "temp_type", "outcome_local_date", F.lit(18.0).alias("lead_hours"),
        clocks.shift_hours(F.col("outcome_local_date").cast("timestamp"), F.lit(-6)).alias("decision_time_utc"))


@query("j10_prefix_history", with_views(("label_events",), f"""
 select event_ticker, count(*) as n, {q6_sql('sum(v)', 4)} as total, {q6_sql('max(v)')} as top from sched s join late l on s.city=l.city and s.temp_type=l.temp_type and l.date<s.outcome_local_date and l.av<=s.d group by 1""", LATE, SCHEDULE))
def prefix_history(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("value")
    out = timeline.known_prefix(
        schedule(spark, sf), models.label_sides(late_labels(spark, sf)), ["city", "temp_type"], F.col("outcome_local_date"),
        F.col("decision_time_utc"), F.col("date"), F.col("label_available_ts"),
        {"n": Running("sum", F.lit(1)), "total": Running("sum", v), "top": Running("max", v)}).where(F.col("n").isNotNull())
    return out.select("event_ticker", F.col("n").cast("long").alias("n"), q6(F.col("total"), 4).alias("total"), q6(F.col("top")).alias("top"))


@query("m04_climatology", with_views(("label_events",), f"""
 select event_ticker, count(*) as training_rows, {q6_sql('avg(v)', 4)} as mean_f, {q6_sql('coalesce(nullif(stddev_pop(v),0),-1)', 3)} as stddev_f from sched s join late l on s.city=l.city and s.temp_type=l.temp_type and l.date<s.outcome_local_date and month(l.date)=month(s.outcome_local_date) and l.av<=s.d group by 1""", LATE, SCHEDULE))
def climatology(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = models.climatology(schedule(spark, sf), late_labels(spark, sf))
    return good.select("event_ticker", "training_rows", q6(F.col("mean_f"), 4).alias("mean_f"), q6(F.coalesce("stddev_f", F.lit(-1.0)), 3).alias("stddev_f"))


@query("m04_climatology_rejections", with_views(("label_events",), """
 select 'no_prior_available_labels' as reason, s.temp_type, count(*) as n from sched s where not exists (select 1 from late l where s.city=l.city and s.temp_type=l.temp_type and l.date<s.outcome_local_date and month(l.date)=month(s.outcome_local_date) and l.av<=s.d) group by 1,2""", LATE, SCHEDULE))
def climatology_rejections(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = models.climatology(schedule(spark, sf), late_labels(spark, sf))
    return bad.groupBy("reason", "temp_type").agg(count_rows().alias("n"))


TRAILING = """, p as (select event_ticker, v, l.date, row_number() over (partition by event_ticker order by l.date desc) as rn from sched s join late l on s.city=l.city and s.temp_type=l.temp_type and l.date<s.outcome_local_date and l.av<=s.d)"""


@query("m05_persistence", with_views(("label_events",), f"""{TRAILING}
 select event_ticker, count(*) as training_rows, {q6_sql('max(v) filter (rn=1)')} as mean_f, {q6_sql('coalesce(nullif(stddev_samp(v),0),-1)', 4)} as stddev_f from p where rn<=5 group by 1""", LATE, SCHEDULE))
def persistence(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = models.persistence(schedule(spark, sf), late_labels(spark, sf), window=5)
    return good.select("event_ticker", "training_rows", q6(F.col("mean_f")).alias("mean_f"), q6(F.coalesce("stddev_f", F.lit(-1.0)), 4).alias("stddev_f"))


@query("w05_trailing_rows", with_views(("label_events",), f"""{TRAILING}
 select temp_type, training_rows, count(*) as events from (select s.event_ticker, s.temp_type, count(p.v) as training_rows from sched s left join p on p.event_ticker=s.event_ticker and p.rn<=3 group by 1,2) group by 1,2""", LATE, SCHEDULE))
def trailing_rows(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = models.persistence(schedule(spark, sf), late_labels(spark, sf), window=3)
    both = good.select("temp_type", "training_rows").unionByName(bad.select("temp_type", F.lit(0).cast("long").alias("training_rows")))
    return both.groupBy("temp_type", "training_rows").agg(count_rows().alias("events"))


STATES = ("states", f"""select *, cast(hour(valid_utc)//6 as int) as local_hour, max(tmpf) {state_queries.SO_FAR} as high, min(tmpf) {state_queries.SO_FAR} as low from obs""")
SIDES = ("sides", """select event_id, s.city, s.local_date, local_hour, valid_utc, t.temp_type, case when t.temp_type='high' then high else low end as cur, case when t.temp_type='high' then tmax_f else tmin_f end as fin, label_available_ts as av
 from states s join labels_daily l on s.city=l.city and s.local_date=l.date, (values ('high'),('low')) t(temp_type) where l.label_available_ts>valid_utc""")


def state_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = state.running_extremes(state_queries.observations(spark, sf))
    return rows.select("event_id", "city", "local_date", (F.hour("valid_utc") / 6).cast("int").alias("local_hour"),
                       F.col("valid_utc").alias("feature_asof_utc"), "observed_high_so_far_f", "observed_low_so_far_f")


@query("j17_label_split", with_views(("labels_daily",), f"select event_id, temp_type, {q6_sql('cur')} as current_f, {q6_sql('fin')} as final_f from sides", STATES, SIDES))
def label_split(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = joins.label_both_extremes(state_rows(spark, sf), shapes.labels_daily(spark, sf))
    return rows.select("event_id", "temp_type", q6(F.col("current_f")).alias("current_f"), q6(F.col("final_f")).alias("final_f"))


POOL = """, hourly as (select a.event_id, a.temp_type, count(*) as n, median(b.fin-b.cur) as m, stddev_pop(b.fin-b.cur) as s from sides a join sides b on a.city=b.city and a.temp_type=b.temp_type and a.local_hour=b.local_hour and b.av<=a.valid_utc group by 1,2),
 broad as (select a.event_id, a.temp_type, count(*) as n, median(b.fin-b.cur) as m, stddev_pop(b.fin-b.cur) as s from sides a join sides b on a.city=b.city and a.temp_type=b.temp_type and b.av<=a.valid_utc group by 1,2),
 pick as (select a.event_id, a.temp_type, a.cur, case when h.n>=8 then h.n when b.n>=8 then b.n end as n, case when h.n>=8 then h.m when b.n>=8 then b.m end as m, case when h.n>=8 then h.s when b.n>=8 then b.s end as s
 from sides a left join hourly h using (event_id, temp_type) left join broad b using (event_id, temp_type))"""


@query("m06_nowcast", with_views(("labels_daily",), f"""{POOL} select event_id, temp_type, n as training_rows, {q6_sql('cur+m', 4)} as mean_f, {q6_sql('greatest(s,0.25e0)', 3)} as stddev_f from pick where n is not null""", STATES, SIDES))
def nowcast(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = models.nowcast(state_rows(spark, sf), shapes.labels_daily(spark, sf), min_training=8)
    return good.select("event_id", "temp_type", "training_rows", q6(F.col("mean_f"), 4).alias("mean_f"), q6(F.col("stddev_f"), 3).alias("stddev_f"))


@query("w09_residual_release", with_views(("labels_daily",), f"""
 select a.event_id, a.temp_type, count(*) as n, {q6_sql('avg(b.fin-b.cur)', 4)} as mean_residual from sides a join sides b on a.city=b.city and a.temp_type=b.temp_type and b.av<=a.valid_utc group by 1,2""", STATES, SIDES))
def residual_release(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = joins.label_both_extremes(state_rows(spark, sf), shapes.labels_daily(spark, sf))
    items = rows.withColumn("residual", F.col("final_f") - F.col("current_f"))
    out = joins.range_aggregates(rows, items, ["city", "temp_type"], "feature_asof_utc", "label_available_ts",
                                 {"n": Running("sum", F.lit(1)), "s": Running("sum", F.col("residual"))}).where(F.col("n") > 0)
    return out.select("event_id", "temp_type", F.col("n").cast("long").alias("n"), q6(F.col("s") / F.col("n"), 4).alias("mean_residual"))


# ---------------------------------------------------------------- ensembles

OFFSET = "case city_no%5 when 0 then -5 when 1 then -8 when 2 then -6 when 3 then -7 else 0 end"


@query("m07_daily_ensemble", with_views(("members",), f"""
 , p as (select *, cast(valid_time + to_hours({OFFSET}) as date) as day, {OFFSET} as off from members),
 e as (select city, forecast_run_time, retrieved_at, day, off, member_id, max(value) as high, min(value) as low from p group by all),
 s as (select e.*, t.temp_type, case when t.temp_type='high' then high else low end as v from e, (values ('high'),('low')) t(temp_type))
 select city, {stamp_sql('forecast_run_time')} as run, cast(day as varchar) as day, temp_type, count(*) as member_count, {q6_sql('avg(v)', 4)} as mean_f, {q6_sql('coalesce(nullif(stddev_pop(v),0),-1)', 4)} as stddev_f, {q6_sql('(epoch_us(day - to_hours(off))-epoch_us(forecast_run_time))/3.6e9', 3)} as lead_hours
 from s where day - to_hours(off) > retrieved_at group by city, forecast_run_time, s.day, off, temp_type"""))
def daily_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    offset = shapes.pick(shapes.OFFSETS, F.col("city_no") % 5)
    good, _ = models.daily_ensemble(shapes.members(spark, sf), offset)
    return good.select(
        "city", stamp(F.col("forecast_run_time")).alias("run"), F.col("outcome_local_date").cast("string").alias("day"), "temp_type", "member_count",
        q6(F.col("mean_f"), 4).alias("mean_f"), q6(F.coalesce("stddev_f", F.lit(-1.0)), 4).alias("stddev_f"), q6(F.col("lead_hours"), 3).alias("lead_hours"))


THRESHOLDS = (20.0, 30.0, 40.0)
SINGLE = ("single", "select city, forecast_run_time, member_id, arg_max(value, row(valid_time, l_orderkey, l_partkey, l_suppkey, value)) as value from members group by 1,2,3")
def member_order() -> list[Column]:
    return [F.col(c) for c in ("valid_time", "l_orderkey", "l_partkey", "l_suppkey", "value")]


@query("m08_ensemble_features", with_views(("members",), f"""
 select city, {stamp_sql('forecast_run_time')} as run, count(*) as member_count, {q6_sql('avg(value)', 4)} as mean, {q6_sql('stddev_pop(value)', 4)} as spread, {q6_sql('quantile_cont(value,0.1)', 4)} as p10, {q6_sql('quantile_cont(value,0.5)', 4)} as median, {q6_sql('quantile_cont(value,0.9)', 4)} as p90,
 {', '.join(q6_sql(f'avg(case when value>={k}e0 then 1e0 else 0e0 end)', 5) + f' as prob_ge_{k:g}' for k in THRESHOLDS)} from single group by city, forecast_run_time""", SINGLE))
def ensemble_features(spark: SparkSession, sf: str) -> DataFrame:
    out = features.ensemble_features(shapes.members(spark, sf), ["city", "forecast_run_time"], THRESHOLDS, member_order())
    return out.select(
        "city", stamp(F.col("forecast_run_time")).alias("run"), "member_count", q6(F.col("ensemble_mean"), 4).alias("mean"), q6(F.col("ensemble_spread"), 4).alias("spread"),
        *[q6(F.col(c), 4).alias(c) for c in ("p10", "median", "p90")], *[q6(F.col(f"prob_ge_{k:g}"), 5).alias(f"prob_ge_{k:g}") for k in THRESHOLDS])


@query("m09_ensemble_point_summary", with_views(("members",), f"""
 select city, {stamp_sql('forecast_run_time')} as run, count(*) as member_count, quantile_disc(value,0.1) as p10, quantile_disc(value,0.5) as p50, quantile_disc(value,0.9) as p90, {q6_sql('avg(case when value>=30e0 then 1e0 else 0e0 end)', 5)} as prob_ge_30 from members group by city, forecast_run_time"""))
def ensemble_point_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = features.ensemble_point_summary(shapes.members(spark, sf), ["city", "forecast_run_time"], {"p10": 0.1, "p50": 0.5, "p90": 0.9}, (30.0,))
    return out.select("city", stamp(F.col("forecast_run_time")).alias("run"), "member_count", "p10", "p50", "p90", q6(F.col("prob_ge_30"), 5).alias("prob_ge_30"))


@query("j12_threshold_edges", with_views(("members",), f"""
 , mo as (select city, forecast_run_time as run, member_id, arg_max(value, row(valid_time, l_orderkey, l_partkey, l_suppkey, value)) as value from members group by 1,2,3),
 f as (select city, run, avg(case when value>=20e0 then 1e0 else 0e0 end) as p20, avg(case when value>=30e0 then 1e0 else 0e0 end) as p30, avg(case when value>=40e0 then 1e0 else 0e0 end) as p40 from mo group by 1,2),
 g as (select city, run, u.t, case u.t when 20 then p20 when 30 then p30 else p40 end as p from f, (values (20),(30),(40)) u(t)),
 mk as (select c_custkey, 'c' || (c_custkey%50) as city, 20+10*(c_custkey%4) as t, (c_custkey%97)/100e0 as price from customer)
 select c_custkey as market, count(*) as runs, {q6_sql('avg(p-price)')} as mean_edge, {q6_sql('max(p-price)')} as best_edge from mk join g using (city, t) group by 1"""))
def threshold_edges(spark: SparkSession, sf: str) -> DataFrame:
    f = features.ensemble_features(shapes.members(spark, sf), ["city", "forecast_run_time"], THRESHOLDS, member_order()).withColumn("valid_time", F.col("forecast_run_time"))
    k = F.col("c_custkey")
    markets = table(spark, sf, "customer").select(
        k.alias("market"), F.concat(F.lit("C"), (k % 50).cast("string")).alias("city"), (k % 4 * 10 + 20).cast("double").alias("threshold"),
        (k % 97 / F.lit(100.0)).alias("market_probability"))
    out = features.threshold_edges(f, markets, THRESHOLDS)
    return out.groupBy("market").agg(count_rows().alias("runs"), q6(F.avg("edge")).alias("mean_edge"), q6(F.max("edge")).alias("best_edge"))


# ---------------------------------------------------------------- bucket probabilities

PROBS = ("probs", f"""select f.event_ticker, f.model_name, f.model_version, f.city, f.temp_type, f.decision_time_utc, f.forecast_issue_time, f.source_receipt_time, b.market_ticker,
 greatest(0e0, (case when bucket_ceil_f is null then 1e0 else {cdf_sql('((bucket_ceil_f+0.5e0-mean_f)/stddev_f)')} end)-(case when bucket_floor_f is null then 0e0 else {cdf_sql('((bucket_floor_f-0.5e0-mean_f)/stddev_f)')} end)) as p
 from forecasts f join (select event_ticker, market_ticker, bucket_floor_f, bucket_ceil_f from buckets) b using (event_ticker)
 where forecast_issue_time<=decision_time_utc and source_receipt_time<=decision_time_utc and stddev_f>0""")


def probabilities(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = models.bucket_probabilities(shapes.forecasts(spark, sf), shapes.buckets(spark, sf))
    return rows


@query("m10_bucket_probabilities", with_views(("forecasts", "buckets"), f"select market_ticker, model_name, {q6_sql('p', 8)} as bucket_probability from probs", PROBS))
def bucket_probabilities(spark: SparkSession, sf: str) -> DataFrame:
    return probabilities(spark, sf).select("market_ticker", "model_name", q6(F.col("bucket_probability"), 8).alias("bucket_probability"))


@query("m10_bucket_rejections", with_views(("forecasts",), """
 select model_name, case when source_receipt_time is null or source_receipt_time>decision_time_utc then 'late_or_missing_clock' else 'invalid_distribution' end as reason, count(*) as n from forecasts
 where source_receipt_time is null or source_receipt_time>decision_time_utc or stddev_f is null group by 1,2"""))
def bucket_rejections(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = models.bucket_probabilities(shapes.forecasts(spark, sf), shapes.buckets(spark, sf))
    return bad.groupBy("model_name", "reason").agg(count_rows().alias("n"))


def settled_labels(spark: SparkSession, sf: str) -> DataFrame:
    b = shapes.buckets(spark, sf).where(F.col("result") == "yes").select("event_ticker", F.col("market_ticker").alias("settled_market_ticker"), "station", "outcome_local_date")
    odd = (F.col("station") + F.dayofyear("outcome_local_date")) % 29 == 0
    return b.select("event_ticker", F.when(odd, F.lit("elsewhere")).otherwise(F.col("settled_market_ticker")).alias("settled_market_ticker"),
                    clocks.label_available(F.col("outcome_local_date")).alias("label_available_ts"))


@query("e02_bucket_skill", with_views(("forecasts", "buckets"), f"""
 , st as (select event_ticker, case when (station+dayofyear(outcome_local_date))%29=0 then 'elsewhere' else market_ticker end as settled from buckets where result='yes'),
 ev as (select event_ticker, model_name, city, temp_type, sum(p) as total, sum(p*p) as sq, max(p) filter (market_ticker=st.settled) as truth from probs join st using (event_ticker) group by 1,2,3,4),
 rj as (select model_name, count(*) filter (truth is null) as rejected_events from ev group by 1)
 select e.model_name, city, temp_type, count(*) as events, {q6_sql('avg(sq-2*truth+1)', 5)} as brier, {q6_sql('avg(-ln(greatest(truth,1e-15)))', 4)} as log_loss, rejected_events from ev e join rj using (model_name) where truth is not null group by 1,2,3,rejected_events""", PROBS))
def bucket_skill(spark: SparkSession, sf: str) -> DataFrame:
    summary, _ = evaluate.bucket_skill(probabilities(spark, sf), settled_labels(spark, sf))
    return summary.select("model_name", "city", "temp_type", "events", q6(F.col("brier"), 5).alias("brier"), q6(F.col("log_loss"), 4).alias("log_loss"), "rejected_events")


# ---------------------------------------------------------------- post-processors

FIT_CLOCK = "timestamp '2024-01-22 00:00:00'"
def fit_clock_col() -> Column:
    return F.lit("2024-01-22 00:00:00").cast("timestamp")
LEVEL_COLS = aggregates.LEVELS
ZONED = ("zf", "select * exclude (city), 'z' || (station%5) as city, cast(round_even(lead_hours/6,0)*6 as int) as lead_bucket, strftime(outcome_local_date,'%m') as month from forecasts")
LAST_LABEL = ("lastlab", "select event_ticker, arg_max(row(label_available_ts, observed_f), row(label_available_ts, observed_f)) as r from event_labels where label_available_ts is not null and observed_f is not null group by 1")
TRAIN = ("train", f"select f.*, r[2] as observed_f from zf f join lastlab using (event_ticker) where r[1]<={FIT_CLOCK} and outcome_local_date<date '2024-01-22'")


def zoned_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    return shapes.forecasts(spark, sf).withColumn("city", F.concat(F.lit("z"), (F.col("station") % 5).cast("string")))


def train_rows(spark: SparkSession, sf: str) -> DataFrame:
    return models.training_rows(zoned_forecasts(spark, sf), shapes.event_labels(spark, sf), fit_clock_col())


def fit_ctes(columns: str, where: str = "true", source: str = "train", extra: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    out = []
    for i, level in enumerate(LEVEL_COLS):
        keys = ", ".join((*extra, *level))
        out.append((f"fit{i}", f"select {keys}, count(*) as n, {columns} from {source} where {where} group by {keys} having count(*)>=5"))
    return out


def fit_joins(rows: str, extra: tuple[str, ...] = ()) -> str:
    return rows + " f " + " ".join(f"left join fit{i} using ({', '.join((*extra, *level))})" for i, level in enumerate(LEVEL_COLS))


def best(column: str, default: str) -> str:
    return f"coalesce({', '.join(f'fit{i}.{column}' for i in range(4))}, {default})"


@query("m11_station_bias", with_views(("forecasts", "event_labels"), f"select event_ticker, model_name, {q6_sql('mean_f+' + best('b', '0e0'), 5)} as mean_f, {best('n', '0')} as bias_training_rows from {fit_joins('zf')}",
       ZONED, LAST_LABEL, TRAIN, *fit_ctes("avg(observed_f-mean_f) as b")))
def station_bias(spark: SparkSession, sf: str) -> DataFrame:
    out = models.apply_bias(zoned_forecasts(spark, sf), models.fit_bias(train_rows(spark, sf)))
    return out.select("event_ticker", "model_name", q6(F.col("mean_f"), 5).alias("mean_f"), "bias_training_rows")


EMOS_FIT = "case when var_pop(mean_f)*count(*)>1e-12 then covar_pop(mean_f,observed_f)/var_pop(mean_f) else 0e0 end as sl, avg(observed_f)-(case when var_pop(mean_f)*count(*)>1e-12 then covar_pop(mean_f,observed_f)/var_pop(mean_f) else 0e0 end)*avg(mean_f) as ic, greatest(sqrt(greatest(var_pop(observed_f)-pow(covar_pop(mean_f,observed_f),2)/var_pop(mean_f),0))/avg(stddev_f), 0.01e0) as sc"


@query("m12_emos", with_views(("forecasts", "event_labels"), f"select event_ticker, model_name, {q6_sql('case when stddev_f is null then mean_f else ' + best('ic', '0e0') + '+' + best('sl', '1e0') + '*mean_f end', 4)} as mean_f, {q6_sql('case when stddev_f is null then -1e0 else greatest(stddev_f*' + best('sc', '1e0') + ',0.01e0) end', 4)} as stddev_f from {fit_joins('zf')}",
       ZONED, LAST_LABEL, TRAIN, *fit_ctes(EMOS_FIT, "stddev_f>0")))
def emos(spark: SparkSession, sf: str) -> DataFrame:
    out = models.apply_emos(zoned_forecasts(spark, sf), models.fit_emos(train_rows(spark, sf)))
    return out.select("event_ticker", "model_name", q6(F.col("mean_f"), 4).alias("mean_f"), q6(F.expr("coalesce(if(stddev_f is null, -1.0D, stddev_f), -1.0D)"), 4).alias("stddev_f"))


@query("m13_residual_quantiles", with_views(("forecasts", "event_labels"), f"select event_ticker, model_name, {q6_sql('mean_f+' + best('q10', '0e0'), 5)} as p10_f, {q6_sql('mean_f+' + best('q50', '0e0'), 5)} as p50_f, {q6_sql('mean_f+' + best('q90', '0e0'), 5)} as p90_f from {fit_joins('zf')}",
       ZONED, LAST_LABEL, TRAIN, *fit_ctes("quantile_cont(observed_f-mean_f,0.1) as q10, quantile_cont(observed_f-mean_f,0.5) as q50, quantile_cont(observed_f-mean_f,0.9) as q90")))
def residual_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    out = models.apply_quantiles(zoned_forecasts(spark, sf), models.fit_quantiles(train_rows(spark, sf)))
    return out.select("event_ticker", "model_name", *[q6(F.col(c), 5).alias(c) for c in ("p10_f", "p50_f", "p90_f")])


WEIGHTS = ("weights", "select model_name, (1/greatest(mae,1e-6))/sum(1/greatest(mae,1e-6)) over () as w from (select model_name, avg(abs(observed_f-mean_f)) as mae from train group by 1 having count(*)>=3)")


@query("m14_convex_blend", with_views(("forecasts", "event_labels"), f"""
 , s as (select event_ticker, sum(w) as sw, sum(w*mean_f)/sum(w) as m, count(*) as k from zf join weights using (model_name) group by 1)
 select event_ticker, {q6_sql('any_value(m)', 5)} as mean_f, {q6_sql('greatest(sqrt(sum(w*(pow(coalesce(stddev_f,0),2)+pow(mean_f-m,2)))/any_value(sw)),0.01e0)', 4)} as stddev_f, any_value(k) as blend_member_count from zf join weights using (model_name) join s using (event_ticker) group by 1""", ZONED, LAST_LABEL, TRAIN, WEIGHTS))
def convex_blend(spark: SparkSession, sf: str) -> DataFrame:
    out = models.apply_blend(zoned_forecasts(spark, sf), models.fit_weights(train_rows(spark, sf)))
    return out.select("event_ticker", q6(F.col("mean_f"), 5).alias("mean_f"), q6(F.col("stddev_f"), 4).alias("stddev_f"), "blend_member_count")


def calibration_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A probability and an outcome that agrees with it more often than not, from every order."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(k.alias("id"), (k * 31 % 97 / F.lit(97.0)).alias("prediction"),
                    ((k * 31 % 97 + k * 17 % 61) > 78).cast("int").alias("outcome"))


BOUNDED_P = "least(1-1e-6, greatest(1e-6, prediction))"
CALIBRATION = f"""with recursive r as (select o_orderkey as id, (o_orderkey*31%97)/97e0 as prediction, case when o_orderkey*31%97+o_orderkey*17%61>78 then 1 else 0 end as outcome from orders),
 c as (select {BOUNDED_P} as p, outcome as y, count(*)::double as n, sum(outcome)::double as s from r group by 1,2)"""
# Forty plain Newton steps; the objective is convex, so the fit that halves its steps ends at the same parameters.
PLATT_SQL = f"""{CALIBRATION}, w(it,a,b) as (select 0, 1e0, 0e0 union all
 select it+1, a-(h11*g0-h01*g1)/(h00*h11-h01*h01), b-(h00*g1-h01*g0)/(h00*h11-h01*h01) from (
  select it, a, b, sum((q*n-s)*f)+1e-3*(a-1) as g0, sum(q*n-s)+1e-3*b as g1, sum(n*q*(1-q)*f*f)+1e-3 as h00, sum(n*q*(1-q)*f) as h01, sum(n*q*(1-q))+1e-3 as h11
  from (select it, a, b, n, s, ln(p/(1-p)) as f, 1/(1+exp(-(a*ln(p/(1-p))+b))) as q from w, c where it<40) group by it, a, b))
 select id, outcome, {q6_sql(f"1/(1+exp(-(greatest(0e0,a)*ln({BOUNDED_P}/(1-{BOUNDED_P}))+b)))", 5)} as calibrated from r, w where it=40"""
BETA_SQL = f"""{CALIBRATION}, w(it,a,b,d) as (select 0, 1e0, -1e0, 0e0 union all
 select it+1, a-(g1*(h22*h33-h23*h23)-h12*(g2*h33-h23*g3)+h13*(g2*h23-h22*g3))/det, b-(h11*(g2*h33-h23*g3)-g1*(h12*h33-h23*h13)+h13*(h12*g3-g2*h13))/det,
  d-(h11*(h22*g3-g2*h23)-h12*(h12*g3-g2*h13)+g1*(h12*h23-h22*h13))/det from (
  select *, h11*(h22*h33-h23*h23)-h12*(h12*h33-h23*h13)+h13*(h12*h23-h22*h13) as det from (
  select it, a, b, d, sum((q*n-s)*u)+1e-3*(a-1) as g1, sum((q*n-s)*v)+1e-3*(b+1) as g2, sum(q*n-s)+1e-3*d as g3, sum(k*u*u)+1e-3 as h11, sum(k*u*v) as h12, sum(k*u) as h13, sum(k*v*v)+1e-3 as h22, sum(k*v) as h23, sum(k)+1e-3 as h33
  from (select *, n*q*(1-q) as k from (select it, a, b, d, n, s, ln(p) as u, ln(1-p) as v, 1/(1+exp(-(a*ln(p)+b*ln(1-p)+d))) as q from w, c where it<40)) group by it, a, b, d)))
 select id, outcome, {q6_sql(f"1/(1+exp(-(greatest(0e0,a)*ln({BOUNDED_P})+least(0e0,b)*ln(1-{BOUNDED_P})+d)))", 5)} as calibrated from r, w where it=40"""
# The largest over all starts of the smallest mean over all ends; rows take the value of the first pair at their probability.
ISOTONIC_SQL = f"""{CALIBRATION}, t as (select *, row_number() over o as i, sum(n) over o as un, sum(s) over o as us from c window o as (order by p, y)),
 g as (select a.i as a, b.i as i, min((b.us-a.us+a.s)/(b.un-a.un+a.n)) over (partition by a.i order by b.i desc) as low from t a join t b on a.i<=b.i),
 v as (select i, max(low) as value from g group by i), f as (select p, min_by(value, t.i) as value from t join v on t.i=v.i group by p)
 select id, outcome, {q6_sql('value', 6)} as calibrated from r join f on f.p={BOUNDED_P}"""


@query("m15_platt_calibration", PLATT_SQL)
def platt(spark: SparkSession, sf: str) -> DataFrame:
    rows = calibration_rows(spark, sf)
    model = calibration.fit_platt(rows)
    return rows.select("id", "outcome", q6(calibration.apply_platt(F.col("prediction"), model), 5).alias("calibrated"))


@query("m15_beta_calibration", BETA_SQL)
def beta(spark: SparkSession, sf: str) -> DataFrame:
    rows = calibration_rows(spark, sf)
    model = calibration.fit_beta(rows)
    return rows.select("id", "outcome", q6(calibration.apply_beta(F.col("prediction"), model), 5).alias("calibrated"))


@query("m16_isotonic_calibration", ISOTONIC_SQL)
def isotonic(spark: SparkSession, sf: str) -> DataFrame:
    rows = calibration_rows(spark, sf)
    blocks = calibration.fit_isotonic(rows)
    return calibration.apply_isotonic(rows, blocks).select("id", "outcome", q6(F.col("calibrated"), 6).alias("calibrated"))


@query("m17_persistence_probability", with_views(("obs",), f"""
 , r as (select event_id, 40e0+event_id%30 as threshold, case when event_id%5=0 then tmpf*9/5+32 else tmpf end as latest, event_id%2=0 as above from obs where event_id%41<>0 and event_id%9<>0 and station%10<>3)
 select event_id as market_ticker, {q6_sql(f"case when above then 1e0-{cdf_sql('((threshold-latest)/2e0)')} else {cdf_sql('((threshold-latest)/2e0)')} end", 7)} as prediction from r"""))
def persistence_probability(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = models.persistence_probability(*probability_inputs(spark, sf))
    return good.select("market_ticker", q6(F.col("prediction"), 7).alias("prediction"))


@query("m17_probability_rejections", with_views(("obs",), """select case when station%10=3 then 'missing_contract_terms' when event_id%9=0 then 'unverified_settlement_station' else 'missing_baseline_provenance' end as reason, count(*) as n from obs where station%10=3 or event_id%9=0 or event_id%41=0 group by 1"""))
def probability_rejections(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = models.persistence_probability(*probability_inputs(spark, sf))
    return bad.groupBy("reason").agg(count_rows().alias("n"))


def probability_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = shapes.obs(spark, sf)
    k = F.col("event_id")
    name = F.when(k % 5 == 0, "temperature_c").otherwise("temperature_f")
    rows = o.select(
        k.alias("market_ticker"), (k % 30 + 40).cast("double").alias("threshold_f"), F.when(k % 2 == 0, "Above").otherwise("below ").alias("comparison"),
        F.concat(F.lit('{"'), name, F.lit('": '), F.col("tmpf").cast("string"), F.lit("}")).alias("features_json"),
        F.when(k % 9 == 0, "unverified_registry").otherwise("registry").alias("settlement_station_method"),
        F.when(k % 41 != 0, "run").alias("source_run_ids"), F.lit("obs").alias("observation_ids"))
    contracts = o.where(F.col("station") % 10 != 3).select(k.alias("market_ticker"))
    return rows, contracts


def quote_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    b = shapes.buckets(spark, sf)
    lo, hi = F.col("bucket_floor_f"), F.col("bucket_ceil_f")
    markets = b.select(
        "market_ticker", "city", "temp_type", F.col("outcome_local_date").alias("target_date"),
        F.when(lo.isNull(), "less").when(hi.isNull(), "greater").otherwise("between").alias("strike_type"), lo.alias("floor_strike"), hi.alias("cap_strike"),
        F.concat(F.lit("CLI"), (F.col("station") % 3).cast("string")).alias("product_key"),
        F.concat(F.lit("Rules CLI"), F.when(F.col("station") % 17 == 0, "X").otherwise((F.col("station") % 3).cast("string"))).alias("rules_primary"))
    slot = F.explode(F.array(F.lit(0), F.lit(1))).alias("slot")
    mark = F.col("station") + F.dayofyear("outcome_local_date")
    quotes = b.where(mark % 7 != 0).select("*", slot).withColumn("mark", mark).select(
        "market_ticker", clocks.shift_hours(F.col("outcome_local_date").cast("timestamp"), F.col("slot") * 3 - 10).alias("received_ts"),
        (F.col("mark") % 40 + 5 + F.col("slot")).cast("double").alias("bid_cents"), (F.col("mark") % 40 + 9 + F.col("slot")).cast("double").alias("ask_cents"),
        F.lit(4.0).alias("spread_cents"), F.when(F.col("mark") % 6 != 0, F.lit(12.0)).alias("top_depth"))
    return markets, quotes, shapes.forecasts(spark, sf)


QUOTE_EDGE = ("qe", f"""select market_ticker, station, city, temp_type, bucket_floor_f as lo, bucket_ceil_f as hi, outcome_local_date, (station+dayofyear(outcome_local_date)) as mark, outcome_local_date - interval 7 hour as dts from buckets""")
QUOTE_FC = ("qf", """select q.*, g.mean_f, g.stddev_f from qe q left join (select q.market_ticker, max(row(f.source_receipt_time, f.mean_f, f.stddev_f)) as r from qe q join forecasts f on f.city=q.city and f.temp_type=q.temp_type and f.outcome_local_date=q.outcome_local_date and f.source_receipt_time<=q.dts where f.stddev_f>0 group by 1) z using (market_ticker)
 left join lateral (select z.r[2] as mean_f, z.r[3] as stddev_f) g on true""")
QUOTE_REASON = "case when mark%7=0 then 'missing_quote_receipt' when station%17=0 then 'settlement_rule_station_mismatch' when mean_f is null then 'missing_forecast_asof_quote' when mark%6=0 then 'missing_executable_quote_fields' end"
QUOTE_P = f"(case when lo is null then {cdf_sql('((hi-0.5e0-mean_f)/stddev_f)')} when hi is null then 1e0-{cdf_sql('((lo+0.5e0-mean_f)/stddev_f)')} else {cdf_sql('((hi+0.5e0-mean_f)/stddev_f)')}-{cdf_sql('((lo-0.5e0-mean_f)/stddev_f)')} end)"


@query("m18_quote_edges", with_views(("forecasts", "buckets"), f"""
 select market_ticker, {q6_sql(QUOTE_P, 6)} as probability, {q6_sql(f'{QUOTE_P}-((mark%40+10)/100e0+0.01e0)*1.02e0', 6)} as yes_net_edge_base, {q6_sql(f'1e0-{QUOTE_P}-((100-(mark%40+6))/100e0+0.02e0)*1.02e0', 6)} as no_net_edge_conservative from qf where {QUOTE_REASON} is null""", QUOTE_EDGE, QUOTE_FC))
def quote_edges(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = models.quote_edges(*quote_inputs(spark, sf), fee_rate=0.02, slippage_cents=1.0)
    return good.select("market_ticker", *[q6(F.col(c), 6).alias(c) for c in ("probability", "yes_net_edge_base", "no_net_edge_conservative")])


@query("m18_quote_rejections", with_views(("forecasts", "buckets"), f"select {QUOTE_REASON} as reason, count(*) as n from qf where {QUOTE_REASON} is not null group by 1", QUOTE_EDGE, QUOTE_FC))
def quote_rejections(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = models.quote_edges(*quote_inputs(spark, sf), fee_rate=0.02, slippage_cents=1.0)
    return bad.groupBy("reason").agg(count_rows().alias("n"))


@query("m19_cloud_adjusted", with_views(("labels_daily",), f"""
 , cloud as (select station, valid_utc as ct, tmpf/10+250 as ir, event_id%101/100e0 as clear from obs where sky='error'),
 j as (select s.*, c.ct, c.ir, c.clear from states s asof join cloud c on s.station=c.station and s.valid_utc>=c.ct),
 r as (select j.event_id, t.kind, case when t.kind='high' then high else low end as base, case when t.kind='high' then tmax_f else tmin_f end as target, ir, clear from j join labels_daily l on j.city=l.city and j.local_date=l.date, (values ('high'),('low')) t(kind) where (epoch_us(valid_utc)-epoch_us(ct))/6e7<=1440 and l.label_available_ts>valid_utc)
 select event_id, kind, {q6_sql('base+0.1e0*clear*((ir-273.15e0)*9/5+32-base)', 5)} as goes_augmented_f, {q6_sql('abs(base-target)', 5)} as baseline_abs_error_f from r""", STATES))
def cloud_adjusted(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = models.cloud_adjusted(cloud_states(spark, sf), shapes.labels_daily(spark, sf), 1440.0)
    return good.select("event_id", "kind", q6(F.col("goes_augmented_f"), 5).alias("goes_augmented_f"), q6(F.col("baseline_abs_error_f"), 5).alias("baseline_abs_error_f"))


def cloud_states(spark: SparkSession, sf: str) -> DataFrame:
    from .asof_queries import timeline as tl
    from .relational_queries import cloud_rows

    rows = state.running_extremes(state_queries.observations(spark, sf))
    joined = tl.asof_join(rows, cloud_rows(spark, sf), ["station"], F.col("valid_utc"), F.col("cloud_time_utc"),
                          {"cloud_time_utc": F.col("cloud_time_utc"), "ir_brightness_temperature_k_mean": F.col("ir_k"), "dqf_clear_fraction": F.col("clear_fraction")}, segment="day", how="inner")
    return joined.withColumn("cloud_age_minutes", clocks.age_minutes(F.col("valid_utc"), F.col("cloud_time_utc")))


@query("m20_market_schedule", with_views(("buckets",), f"""
 select series_ticker, event_ticker, {stamp_sql('min(outcome_local_date - interval 20 hour + to_hours(cast(right(market_ticker,1) as int)))')} as decision, cast(outcome_local_date as varchar) as outcome_local_date, 24e0 as lead_hours from buckets group by series_ticker, event_ticker, buckets.outcome_local_date"""))
def market_schedule(spark: SparkSession, sf: str) -> DataFrame:
    b = shapes.buckets(spark, sf)
    opened = clocks.shift_hours(F.col("outcome_local_date").cast("timestamp"), F.substring(F.col("market_ticker"), -1, 1).cast("int") - 20)
    good, _ = models.market_schedule(b.select("series_ticker", "event_ticker", opened.alias("open_time")))
    return good.select("series_ticker", "event_ticker", stamp(F.col("decision_time_utc")).alias("decision"), F.col("outcome_local_date").cast("string").alias("outcome_local_date"), "lead_hours")


# ---------------------------------------------------------------- decision features and admission

def feature_contracts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    return shapes.obs(spark, sf).select(
        k.alias("market_ticker"), F.when(k % 50 == 0, F.col("station") + 100000).when(k % 997 == 3, F.lit(None)).otherwise(F.col("station")).alias("station"),
        minutes(F.col("valid_utc"), F.when(k % 7 == 0, -4320).otherwise(20)).alias("decision_ts"),
        clocks.shift_hours(F.date_trunc("hour", "valid_utc"), F.when(k % 11 == 0, -30).otherwise(2)).alias("target_time_utc"))


def target_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    return shapes.obs(spark, sf).select(
        clocks.shift_hours(F.date_trunc("hour", "valid_utc"), F.lit(2)).alias("target_time_utc"), F.col("valid_utc").alias("source_receipt_time"), F.col("dwpf").alias("value"))


CONTRACTS = ("ct", """select event_id as market_ticker, case when event_id%50=0 then station+100000 when event_id%997=3 then null else station end as station, valid_utc + to_minutes(case when event_id%7=0 then -4320 else 20 end) as dts, date_trunc('hour', valid_utc) + to_hours(case when event_id%11=0 then -30 else 2 end) as target from obs""")
CONTRACT_OBS = ("co", "select market_ticker, count(*) as n, max(tmpf) as mx, min(tmpf) as mn, avg(tmpf) as av, max(row(valid_utc, receipt_utc, tmpf))[3] as latest from ct join late_rows o on (o.station=ct.station or ct.station is null) and o.receipt_utc<=dts and o.valid_utc<=target group by 1")
CONTRACT_FC = ("cf", "select market_ticker, count(*) as n, avg(o.dwpf) as av, stddev_pop(o.dwpf) as sd, min(o.dwpf) as mn, max(o.dwpf) as mx from ct join obs o on date_trunc('hour', o.valid_utc) + interval 2 hour=ct.target and o.valid_utc<=dts group by 1")


@query("m03_decision_features", with_views(("obs",), f"""
 select market_ticker, coalesce(co.n,0) as observation_count, {q6_sql('coalesce(co.mx,-999)')} as running_max, {q6_sql('coalesce(co.latest,-999)')} as latest, {q6_sql('coalesce(case when co.n>=2 then co.av end,-999)', 4)} as spatial_mean,
 coalesce(cf.n,0) as forecast_count, {q6_sql('coalesce(cf.av,-999)', 4)} as forecast_mean, {q6_sql('coalesce(cf.sd,-999)', 4)} as forecast_std from ct left join co using (market_ticker) left join cf using (market_ticker) where co.n>0 or cf.n>0""", state_queries.LATE_ROWS, CONTRACTS, CONTRACT_OBS, CONTRACT_FC))
def decision_features(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = features.decision_features(feature_contracts(spark, sf), state_queries.temperature_rows(spark, sf), target_forecasts(spark, sf))
    none = F.lit(-999.0)
    return good.select(
        "market_ticker", "observation_count", q6(F.coalesce("running_max_temperature", none)).alias("running_max"), q6(F.coalesce("temperature_latest", none)).alias("latest"),
        q6(F.coalesce("spatial_temperature_gradient_mean", none), 4).alias("spatial_mean"), "forecast_count",
        q6(F.coalesce("forecast_mean", none), 4).alias("forecast_mean"), q6(F.coalesce("forecast_std", none), 4).alias("forecast_std"))


HEX = "('0x' || substr(md5({0}), 1, 8))::bigint"
TRACED_OBS = ("traced_obs", f"""select station, valid_utc, receipt_utc + to_minutes(case when event_id%13=0 then 4320 else 0 end) as receipt_utc, sknt, case when event_id%5>0 then drct end as drct, tmpf,
 {HEX.format("station || ':' || epoch_us(valid_utc) || ':' || (event_id%1000)")} as id from obs""")
TRACED_FC = ("traced_fc", f"""select date_trunc('hour', valid_utc) + interval 2 hour as target, valid_utc as receipt, case when event_id%6>0 then dwpf end as value,
 case when event_id%7>0 then {HEX.format("sky || ':' || 'c' || (station%3) || ':' || epoch_us(date_trunc('day', valid_utc)) || ':' || (case when event_id%4>0 then 'h' else '' end)")} end as id from obs""")


@query("m03_decision_payload", with_views(("obs",), f"""
 , o as (select market_ticker, count(*) as n, max(row(valid_utc, receipt_utc, drct, tmpf, sknt)) as latest, count(distinct id) as ids, sum(distinct id) as digest
  from ct join traced_obs o on (o.station=ct.station or ct.station is null) and o.receipt_utc<=dts and o.valid_utc<=ct.target group by 1),
 f as (select market_ticker, count(*) as n, count(value) as members, quantile_cont(value, 0.1) as q10, quantile_cont(value, 0.5) as q50, quantile_cont(value, 0.9) as q90, quantile_cont(value, 0.75)-quantile_cont(value, 0.25) as iqr,
  count(distinct id) as ids, coalesce(sum(distinct id), 0) as digest from ct join traced_fc f on f.target=ct.target and receipt<=dts group by 1)
 select market_ticker, coalesce(f.n,0) as forecast_count, coalesce(members,0) as members, {q6_sql('coalesce(q10,-999)', 5)} as q10, {q6_sql('coalesce(q50,-999)', 5)} as q50, {q6_sql('coalesce(q90,-999)', 5)} as q90, {q6_sql('coalesce(iqr,-999)', 5)} as iqr,
 coalesce(latest[3],-1) as wind_direction, coalesce(latest[5],-1) as wind_speed, coalesce(o.ids,0) as observation_ids, coalesce(o.digest,0)::bigint as observation_digest, coalesce(f.ids,0) as source_run_ids, coalesce(f.digest,0)::bigint as source_run_digest
 from ct left join o using (market_ticker) left join f using (market_ticker) where o.n>0 or f.n>0""", CONTRACTS, TRACED_OBS, TRACED_FC))
def decision_payload(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    seen = shapes.obs(spark, sf).select(
        "station", "valid_utc", minutes(F.col("receipt_utc"), F.when(k % 13 == 0, 4320).otherwise(0)).alias("receipt_utc"), F.col("tmpf").alias("temperature_f"),
        F.col("sknt").alias("wind_speed_kt"), F.when(k % 5 > 0, F.col("drct")).alias("wind_direction_10m"), (k % 1000).cast("string").alias("raw_sha256"))
    ahead = shapes.obs(spark, sf).select(
        clocks.shift_hours(F.date_trunc("hour", "valid_utc"), F.lit(2)).alias("target_time_utc"), F.col("valid_utc").alias("source_receipt_time"), F.when(k % 6 > 0, F.col("dwpf")).alias("value"),
        F.col("sky").alias("model"), F.concat(F.lit("c"), (F.col("station") % 3).cast("string")).alias("city"),
        F.when(k % 7 > 0, F.date_trunc("day", "valid_utc")).alias("initialization_time_utc"), F.when(k % 4 > 0, "h").alias("sha256"))
    good, _ = features.decision_features(feature_contracts(spark, sf), seen, ahead)
    none = F.lit(-999.0)

    def read(name: str, otherwise: Column) -> Column:
        return F.coalesce(F.get_json_object("features_json", f"$.{name}").cast("double"), otherwise)

    return good.select(
        "market_ticker", "forecast_count", read("forecast_member_count", F.lit(0.0)).cast("long").alias("members"),
        *[q6(read(f"forecast_{n}", none), 5).alias(n) for n in ("q10", "q50", "q90", "iqr")],
        read("wind_direction_10m", F.lit(-1.0)).alias("wind_direction"), read("wind_speed_kt", F.lit(-1.0)).alias("wind_speed"),
        "observation_ids", "observation_digest", "source_run_ids", "source_run_digest")


@query("j19_decision_join_reasons", with_views(("obs",), """
 , s as (select station, min(valid_utc) as first from obs group by 1 union all select null, min(valid_utc) from obs),
 tf as (select distinct date_trunc('hour', valid_utc) + interval 2 hour as t from obs)
 select case when s.first is null then 'missing_exact_settlement_station_observations' when s.first<=target and tf.t is not null then 'late_observations_and_forecasts'
  when s.first<=target then 'late_observations' when tf.t is not null then 'late_forecasts' else 'missing_observations_and_forecasts' end as reason, count(*) as n
 from ct left join co using (market_ticker) left join cf using (market_ticker) left join s on s.station is not distinct from ct.station left join tf on tf.t=ct.target where co.n is null and cf.n is null group by 1""", state_queries.LATE_ROWS, CONTRACTS, CONTRACT_OBS, CONTRACT_FC))
def decision_join_reasons(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = features.decision_features(feature_contracts(spark, sf), state_queries.temperature_rows(spark, sf), target_forecasts(spark, sf))
    return bad.groupBy("reason").agg(count_rows().alias("n"))


def admission_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    target = clocks.shift_hours(F.col("o_orderdate"), F.lit(24))
    contracts = o.select(k.alias("market_ticker"), target.alias("target_time_utc"), F.col("o_orderdate").alias("decision_ts"),
                         F.when(k % 13 == 0, "unresolved").when(k % 17 == 0, "unverified_x").otherwise("registry").alias("settlement_station_method"))
    labels = o.where(k % 5 != 0).select(
        k.alias("market_ticker"), F.when(k % 7 != 0, "yes").alias("kalshi_result"),
        F.when(k % 11 == 0, F.lit(None)).when(k % 3 == 0, clocks.shift_hours(target, F.lit(-1))).otherwise(clocks.shift_hours(target, F.lit(1))).cast("timestamp").alias("label_available_ts"),
        F.when(k % 19 != 0, target).alias("source_valid_utc"), F.col("o_totalprice").alias("source_temperature_f"))
    feats = o.where(k % 4 != 0).select(k.alias("market_ticker"), F.col("o_orderdate").alias("decision_ts"), F.lit("{}").alias("features_json"))
    refused = o.where(k % 8 == 0).select(k.alias("market_ticker"), F.lit("late_source").alias("reason"))
    return contracts, labels, feats, refused


ADMIT = """select k, list_filter([case when k%4=0 then (case when k%8=0 then 'late_source' else 'no_valid_pit_features' end) end, case when k%5=0 or k%7=0 then 'missing_settled_binary_label' end, case when k%5=0 or k%11=0 then 'missing_label_availability' end,
 case when k%5=0 or k%19=0 then 'invalid_exact_settlement_time' end, case when k%5<>0 and k%11<>0 and k%19<>0 and k%3=0 then 'label_available_before_target' end, case when k%13=0 or k%17=0 then 'unverified_settlement_station' end], lambda x: x is not null) as codes from (select o_orderkey as k from orders)"""


@query("j18_admission", f"with a as ({ADMIT}) select coalesce(codes[1], 'accepted') as reason, array_to_string(codes, ';') as reason_codes, count(*) as n from a group by 1,2")
def admission(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = features.admit(*admission_inputs(spark, sf))
    both = good.select(F.lit("accepted").alias("reason"), F.lit("").alias("reason_codes")).unionByName(bad.select("reason", "reason_codes"))
    return both.groupBy("reason", "reason_codes").agg(count_rows().alias("n"))


# ---------------------------------------------------------------- evaluation

SCORED = ("scored", f"""select f.*, a.observed_f, abs(mean_f-a.observed_f) as ae, case when stddev_f>0 then {crps_sql('mean_f', 'a.observed_f', 'stddev_f')} end as crps,
 case when not coalesce(forecast_issue_time<=decision_time_utc and source_receipt_time<=decision_time_utc, false) then 'missing_timestamp' when a.hit is null and s.dated>0 then 'target_leakage' when a.hit is null and s.n>0 then 'invalid_label' when a.hit is null then 'no_label_found' when a.observed_f is null then 'invalid_label' end as reason
 from forecasts f left join (select event_ticker, count(label_available_ts) as dated, count(*) as n from event_labels group by 1) s using (event_ticker)
 left join (select event_ticker, true as hit, arg_min(row(observed_f), label_available_ts)[1] as observed_f from event_labels where label_available_ts is not null group by 1) a using (event_ticker)""")


@query("e01_forecast_skill", with_views(("forecasts", "event_labels"), f"""
 select event_ticker, model_name, {q6_sql('ae', 5)} as abs_error_f, {q6_sql('coalesce(crps,-1)', 5)} as crps_f from scored where reason is null""", SCORED))
def forecast_skill(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = evaluate.forecast_skill(shapes.forecasts(spark, sf), shapes.event_labels(spark, sf))
    return good.select("event_ticker", "model_name", q6(F.col("abs_error_f"), 5).alias("abs_error_f"), q6(F.coalesce("crps_f", F.lit(-1.0)), 5).alias("crps_f"))


SUMMARY = ("summ", """select model_name, city, temp_type, lead_hours, strftime(outcome_local_date,'%Y-%m') as target_month, count(*) as n, avg(ae) as mae, count(crps) as cn, avg(crps) as crps from scored where reason is null group by 1,2,3,4,5""")


@query("a21_skill_summary", with_views(("forecasts", "event_labels"), f"""
 , r as (select model_name, count(*) filter (reason='missing_timestamp') as mt, count(*) filter (reason='invalid_label') as il from scored where reason is not null group by 1)
 select model_name, city, temp_type, target_month, n as eligible_predictions, {q6_sql('mae', 4)} as mae_f, cn as crps_predictions, {q6_sql('coalesce(crps,-1)', 4)} as crps_f, mt as rejected_missing_timestamp, il as rejected_invalid_label from summ join r using (model_name)""", SCORED, SUMMARY))
def skill_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.skill_summary(*evaluate.forecast_skill(shapes.forecasts(spark, sf), shapes.event_labels(spark, sf)))
    return out.select("model_name", "city", "temp_type", "target_month", "eligible_predictions", q6(F.col("mae_f"), 4).alias("mae_f"), "crps_predictions",
                      q6(F.coalesce("crps_f", F.lit(-1.0)), 4).alias("crps_f"), "rejected_missing_timestamp", "rejected_invalid_label")


def edge_rows(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        (k * 31 % 97 / F.lit(97.0)).alias("predicted_probability"), (F.col("o_custkey") % 2).cast("int").alias("outcome"),
        ((k % 90 + 5) / F.lit(100.0)).alias("yes_ask"), F.lit(0.01).alias("fee"), F.lit(0.005).alias("slippage"),
        F.col("o_orderdate").alias("quote_available_ts"), clocks.shift_hours(F.col("o_orderdate"), k % 5 - 1).alias("decision_ts"),
        clocks.shift_hours(F.col("o_orderdate"), F.lit(24)).alias("target_time_utc"), clocks.shift_hours(F.col("o_orderdate"), F.lit(-240)).alias("model_fit_end_ts"),
        F.year("o_orderdate").cast("string").alias("oos_fold"))


EDGE = ("er", "select (o_orderkey*31%97)/97e0 as p, cast(o_custkey%2 as double) as y, (o_orderkey%90+5)/100e0 as ask, cast(year(o_orderdate) as varchar) as fold, o_orderkey%5>=1 as ok from orders")
EDGE_METRICS = f"""count(*) filter (ok) as rows, count(*) filter (not ok) as rejected, {q6_sql('avg((p-y)*(p-y)) filter (ok)', 5)} as brier_score, {q6_sql('avg(-ln(greatest(case when y=1 then p else 1-p end,1e-15))) filter (ok)', 4)} as log_loss,
 count(*) filter (ok and p>ask+0.015e0) as signals, {q6_sql('coalesce(sum(y-ask-0.015e0) filter (ok and p>ask+0.015e0),0)', 4)} as net_pnl"""


@query("e03_binary_metrics", f"""with er as ({EDGE[1]}),
 b as (select fold, least(floor(p*10),9) as bin, abs(avg(p)-avg(y)) as err from er where ok group by 1,2 union all select 'all', least(floor(p*10),9), abs(avg(p)-avg(y)) from er where ok group by 2),
 mx as (select fold, max(err) as err from b group by 1)
 select m.*, {q6_sql('mx.err', 5)} as max_bin_calibration_error from (select fold, {EDGE_METRICS} from er group by 1 union all select 'all', {EDGE_METRICS} from er) m join mx using (fold)""")
def binary_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.binary_metrics(edge_rows(spark, sf))
    return out.select(
        F.coalesce("oos_fold", F.lit("all")).alias("fold"), "rows", "rejected", q6(F.col("brier_score"), 5).alias("brier_score"), q6(F.col("log_loss"), 4).alias("log_loss"),
        "signals", q6(F.col("net_pnl"), 4).alias("net_pnl"), q6(F.col("max_bin_calibration_error"), 5).alias("max_bin_calibration_error"))


@query("e04_reliability_bins", f"""with r as (select least(floor(p*12),11) as bin, p, y from (select (o_orderkey*31%97)/200e0 as p, o_custkey%2 as y from orders))
 select cast(g.bin as int) as bin, count(r.p) as count, {q6_sql('coalesce(avg(r.p),-1)', 5)} as mean_probability, {q6_sql('coalesce(avg(r.y),-1)', 5)} as event_rate from range(12) g(bin) left join r on r.bin=g.bin group by 1""")
def reliability_bins(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select((F.col("o_orderkey") * 31 % 97 / F.lit(200.0)).alias("p"), (F.col("o_custkey") % 2).alias("y"))
    out = evaluate.reliability_bins(rows, "p", "y", 12)
    return out.select("bin", "count", q6(F.coalesce("mean_probability", F.lit(-1.0)), 5).alias("mean_probability"), q6(F.coalesce("event_rate", F.lit(-1.0)), 5).alias("event_rate"))


def folds_sql(source: str, date: str, train: int, test: int, embargo: int) -> str:
    return f"""dt as (select distinct cast({date} as date) as d from {source}), sp as (select min(d) as a, max(d) as b from dt),
 rf as (select i, a + cast(i*{test} as int) as ts from sp, range(cast(greatest(ceil((b-a-{train + embargo + test - 1})/{test}e0),0) as bigint)+1) g(i)),
 wf as (select i, ts as train_start, ts+{train - 1} as train_end, ts+{train + embargo} as test_start, ts+{train + embargo + test - 1} as test_end from rf),
 kept as (select wf.*, row_number() over (order by i)-1 as fold from wf where exists (select 1 from dt where d between train_start and train_end) and exists (select 1 from dt where d between test_start and test_end))"""


@query("e05_walk_forward_folds", f"""with {folds_sql('orders', 'o_orderdate', 365, 60, 3)}
 select fold, cast(train_start as varchar) as train_start, cast(test_end as varchar) as test_end, count(*) filter (d between train_start and train_end) as train_dates, count(*) filter (d between test_start and test_end) as test_dates from kept join dt on d between train_start and test_end group by fold, kept.train_start, kept.test_end""")
def walk_forward_folds(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("outcome_local_date"))
    member = evaluate.walk_forward_folds(rows, train_days=365, test_days=60, embargo_days=3)
    return member.groupBy(F.col("fold").cast("long").alias("fold"), "train_start", "test_end").agg(
        F.count_if(F.col("role") == "train").alias("train_dates"), F.count_if(F.col("role") == "test").alias("test_dates")
    ).withColumns({c: F.col(c).cast("string") for c in ("train_start", "test_end")})


@query("e06_rolling_plan", """with d as (select d, row_number() over (order by d)-1 as i, count(*) over () as n from (select distinct cast(o_orderdate as date) as d from orders)),
 e as (select distinct n, g.x as te from d, range(430, 100000, 30) g(x) where g.x<=n)
 select 'ready' as status, (te-430)//30 as fold, cast((select d from d where i=te-30-5-30-5-365) as varchar) as train_start, cast((select d from d where i=te-30-5-30-5-1) as varchar) as train_end, cast((select d from d where i=te-30-5-30) as varchar) as calibration_start, cast((select d from d where i=te-30) as varchar) as test_start, cast((select d from d where i=te-1) as varchar) as test_end from e where te-30-5-30-5-365>=0
 union all select 'ready', (te-430)//30, cast((select d from d where i=0) as varchar), cast((select d from d where i=te-30-5-30-5-1) as varchar), cast((select d from d where i=te-30-5-30) as varchar), cast((select d from d where i=te-30) as varchar), cast((select d from d where i=te-1) as varchar) from e where te-30-5-30-5-365<0""")
def rolling_plan(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.rolling_plan(table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate")), "day", 365, 30, 30, 5)
    return out.select("status", "fold", *[F.col(c).cast("string").alias(c) for c in ("train_start", "train_end", "calibration_start", "test_start", "test_end")])


TEST_FOLDS = folds_sql("forecasts", "outcome_local_date", 10, 5, 0)


@query("e07_walk_forward_skill", with_views(("forecasts", "event_labels"), f""", {TEST_FOLDS}
 select fold, model_name, 'z' || (station%5) as city, temp_type, count(*) as eligible_predictions, {q6_sql('avg(ae)', 4)} as mae_f, count(crps) as crps_predictions from scored join kept on outcome_local_date between test_start and test_end where reason is null group by 1,2,3,4""", SCORED))
def walk_forward_skill(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.walk_forward_skill(zoned_forecasts(spark, sf), shapes.event_labels(spark, sf), 10, 5)
    return out.select(F.col("fold").cast("long").alias("fold"), "model_name", "city", "temp_type", "eligible_predictions", q6(F.col("mae_f"), 4).alias("mae_f"), "crps_predictions")


FOLD_TRAIN = ("ftrain", """select f.*, r[2] as observed_f, k.fold from zf f join kept k on f.outcome_local_date between k.train_start and k.train_end join lastlab using (event_ticker)
 join (select k.fold, min(decision_time_utc) as gate from zf join kept k on outcome_local_date between test_start and test_end group by 1) g on g.fold=k.fold where r[1]<=gate and f.outcome_local_date<cast(gate as date)""")


def fold_ctes() -> list[tuple[str, str]]:
    parts = TEST_FOLDS.split("),\n ")
    out = []
    for part in TEST_FOLDS.replace("dt as (", "\0dt as (").replace(" sp as (", "\0sp as (").replace(" rf as (", "\0rf as (").replace(" wf as (", "\0wf as (").replace(" kept as (", "\0kept as (").split("\0"):
        part = part.strip().rstrip(",").strip()
        if part:
            name, body = part.split(" as (", 1)
            out.append((name, body[:-1]))
    del parts
    return out


def walk_sql(fit: str, mean: str, where: str = "true") -> str:
    tests = ("ft", "select f.*, k.fold, l.observed_f, l.reason from zf f join kept k on outcome_local_date between test_start and test_end join (select event_ticker, model_name, observed_f, reason from scored) l using (event_ticker, model_name)")
    return with_views(("forecasts", "event_labels"), f"""
 select fold, model_name, city, temp_type, count(*) as eligible_predictions, {q6_sql(f'avg(abs({mean}-observed_f))', 3)} as mae_f from {fit_joins('ft', ('fold',))} where reason is null group by 1,2,3,4""",
                      ZONED, LAST_LABEL, SCORED, *fold_ctes(), FOLD_TRAIN, tests, *fit_ctes(fit, where, "ftrain", ("fold",)))


def _walk(spark: SparkSession, sf: str, method: str) -> DataFrame:
    out = evaluate.walk_forward_postprocessor(zoned_forecasts(spark, sf), shapes.event_labels(spark, sf), method, 10, 5)
    return out.select(F.col("fold").cast("long").alias("fold"), "model_name", "city", "temp_type", "eligible_predictions", q6(F.col("mae_f"), 3).alias("mae_f"))


@query("e08_walk_forward_bias", walk_sql("avg(observed_f-mean_f) as b", f"(mean_f+{best('b', '0e0')})"))
def walk_forward_bias(spark: SparkSession, sf: str) -> DataFrame:
    return _walk(spark, sf, "bias")


@query("e08_walk_forward_quantile", walk_sql("quantile_cont(observed_f-mean_f,0.5) as q50", f"(mean_f+{best('q50', '0e0')})"))
def walk_forward_quantile(spark: SparkSession, sf: str) -> DataFrame:
    return _walk(spark, sf, "quantile")


@query("e08_walk_forward_emos", walk_sql(EMOS_FIT, f"(case when stddev_f is null then mean_f else {best('ic', '0e0')}+{best('sl', '1e0')}*mean_f end)", "stddev_f>0"))
def walk_forward_emos(spark: SparkSession, sf: str) -> DataFrame:
    return _walk(spark, sf, "emos")


@query("e09_walk_forward_blend", with_views(("forecasts", "event_labels"), f"""
 , tr as (select f.model_name, r[2] as observed_f, mean_f, k.fold from zf f join kept k on f.outcome_local_date between k.train_start and k.train_end join lastlab using (event_ticker) where r[1]<=k.test_start and f.outcome_local_date<k.test_start),
 w0 as (select fold, model_name, 1/greatest(avg(abs(observed_f-mean_f)),1e-6) as w from tr group by 1,2 having count(*)>=3),
 w as (select * from (select *, count(*) over (partition by fold) as k from w0) where k>=2),
 bl as (select k.fold, event_ticker, sum(w*mean_f)/sum(w) as m, arg_min(row(decision_time_utc, forecast_issue_time, source_receipt_time), zf.model_name) as c from zf join kept k on outcome_local_date between test_start and test_end join w on w.fold=k.fold and w.model_name=zf.model_name group by 1,2),
 lab as (select event_ticker, arg_min(row(observed_f), label_available_ts)[1] as observed_f from event_labels where label_available_ts is not null group by 1)
 select fold, count(*) filter (coalesce(c[3]<=c[1],false) and observed_f is not null) as eligible_predictions, count(*) filter (not (coalesce(c[3]<=c[1],false) and observed_f is not null)) as rejected_predictions, {q6_sql('avg(abs(m-observed_f)) filter (coalesce(c[3]<=c[1],false) and observed_f is not null)', 3)} as mae_f
 from bl left join lab using (event_ticker) group by 1""", ZONED, LAST_LABEL, *fold_ctes()))
def walk_forward_blend(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.walk_forward_blend(zoned_forecasts(spark, sf), shapes.event_labels(spark, sf), 10, 5)
    return out.select(F.col("fold").cast("long").alias("fold"), "eligible_predictions", "rejected_predictions", q6(F.col("mae_f"), 3).alias("mae_f"))


@query("e10_nowcast_errors", with_views(("labels_daily",), f"""
 , g as (select station%10 as part, local_hour, abs(high-tmax_f) as eh, abs(low-tmin_f) as el, label_available_ts>valid_utc as ok from states s join labels_daily l on s.city=l.city and s.local_date=l.date)
 select s.city, local_hour, count(*) as eligible_rows, {q6_sql('avg(abs(high-tmax_f))', 4)} as mae_high_f, {q6_sql('avg(abs(low-tmin_f))', 4)} as mae_low_f from states s join labels_daily l on s.city=l.city and s.local_date=l.date where label_available_ts>valid_utc group by 1,2""", STATES))
def nowcast_errors(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.nowcast_errors(state_rows(spark, sf), shapes.labels_daily(spark, sf))
    return out.select("city", "local_hour", "eligible_rows", q6(F.col("mae_high_f"), 4).alias("mae_high_f"), q6(F.col("mae_low_f"), 4).alias("mae_low_f"))


@query("e11_skill_rollup", with_views(("forecasts", "event_labels"), f"""
 select model_name, city, temp_type, count(*) as target_months, sum(n)::bigint as eligible_predictions, {q6_sql('sum(mae*n)/sum(n)', 4)} as weighted_mae_f, {q6_sql('coalesce(sum(crps*cn)/nullif(sum(cn),0),-1)', 4)} as weighted_crps_f from summ group by 1,2,3""", SCORED, SUMMARY))
def skill_rollup(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.skill_rollup(evaluate.skill_summary(*evaluate.forecast_skill(shapes.forecasts(spark, sf), shapes.event_labels(spark, sf))))
    return out.select("model_name", "city", "temp_type", "target_months", "eligible_predictions", q6(F.col("weighted_mae_f"), 4).alias("weighted_mae_f"), q6(F.coalesce("weighted_crps_f", F.lit(-1.0)), 4).alias("weighted_crps_f"))


def stress_rows(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    at = clocks.shift_hours(F.col("o_orderdate"), F.lit(1))
    return table(spark, sf, "orders").select(
        (k * 31 % 97 / F.lit(97.0)).alias("prediction"), F.when(k % 11 != 0, F.col("o_custkey") % 2).cast("int").alias("outcome"), at.alias("decision_time_utc"),
        minutes(at, -(k % 25)).alias("source_receipt_time"), minutes(at, -(k % 13)).alias("nwp_receipt_time"), (k % 70).cast("double").alias("observation_age_minutes"),
        (k % 50 / F.lit(16.0) - F.lit(1.5)).alias("threshold_distance_f"), (k % 10 / F.lit(64.0)).alias("spread"), (k % 30).cast("double").alias("volume"), (k % 16 / F.lit(64.0) - F.lit(0.125)).alias("quote_jump"))


def _stress_sql() -> str:
    cases = [("baseline", "true", "0e0")]
    for m in (2, 5, 10, 20):
        cases += [(f"feed_delay_{m}m", f"k%25>={m}", "0e0"), (f"nwp_late_{m}m", f"k%13>={m}", "0e0")]
    cases += [(f"observation_outage_{m}m", f"k%70>={m}", "0e0") for m in (5, 15, 30, 60)]
    cases += [(f"calibration_bias_{b:+.2f}", "true", f"{b}e0") for b in evaluate.BIASES]
    cases += [(f"threshold_within_{d:g}f", f"abs(k%50/16e0-1.5e0)<={d}", "0e0") for d in evaluate.DISTANCES]
    cases += [("wide_spread", "k%10/64e0>=0.05e0", "0e0"), ("low_volume", "k%30<=10", "0e0"), ("quote_jump", "abs(k%16/64e0-0.125e0)>=0.1e0", "0e0")]
    parts = [f"""select '{n}' as scenario, count(*) filter ({w}) as rows, count(*) filter (not ({w})) as filtered_out, count(y) filter ({w}) as scored, count(*) filter ({w} and y is null) as rejected,
 {q6_sql(f'avg(pow(greatest(1e-12,least(1-1e-12,p+{b}))-y,2)) filter ({w})', 5)} as brier, {q6_sql(f'avg(-(y*ln(greatest(1e-12,least(1-1e-12,p+{b})))+(1-y)*ln(1-greatest(1e-12,least(1-1e-12,p+{b}))))) filter ({w})', 4)} as log_loss from s""" for n, w, b in cases]
    return "with s as (select o_orderkey as k, (o_orderkey*31%97)/97e0 as p, case when o_orderkey%11<>0 then cast(o_custkey%2 as double) end as y from orders) " + " union all ".join(parts)


@query("e12_robustness", _stress_sql())
def robustness(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.robustness(stress_rows(spark, sf))
    return out.select("scenario", "rows", "filtered_out", "scored", "rejected", q6(F.col("brier"), 5).alias("brier"), q6(F.col("log_loss"), 4).alias("log_loss"))


@query("e13_settlement_check", with_views(("buckets", "label_events"), """
 , r as (select b.city, observed_f as v, bucket_floor_f as lo, bucket_ceil_f as hi, result='yes' as y from buckets b join (select event_ticker, observed_f from label_events) using (event_ticker))
 select city, count(*) as checked, count(*) filter (((lo is null or v>=lo) and (hi is null or v<=hi))=y) as exact_ok, count(*) filter (((lo is null or round_even(v,0)>=lo) and (hi is null or round_even(v,0)<=hi))=y) as rounded_ok,
 count(*) filter (coalesce(abs(v-lo)<0.15e0,false) or coalesce(abs(v-hi)<0.15e0,false)) as boundary_close, count(*) filter (((lo is null or v>=lo) and (hi is null or v<=hi))<>y and (coalesce(abs(v-lo)<0.15e0,false) or coalesce(abs(v-hi)<0.15e0,false))) as mismatch_boundary, 0::bigint as label_missing from r group by 1"""))
def settlement_check(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.settlement_check(shapes.buckets(spark, sf), shapes.labels_daily(spark, sf))


def climate_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Two issuances per station day; the first is off by one on some days."""
    base = shapes.labels_daily(spark, sf).withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    off = F.when((F.col("v") == 0) & ((F.col("station") + F.dayofyear("date")) % 9 == 0), 1).otherwise(0)
    return base.select("city", F.col("date").alias("climate_date"), clocks.shift_hours(F.col("date").cast("timestamp"), F.col("v") * 8 + 24).alias("publication_time_utc"),
                       (F.bround("tmax_f") + off).alias("official_daily_high_f"), F.bround("tmin_f").alias("official_daily_low_f"))


@query("e14_cross_source_match", with_views(("labels_daily",), """
 select city, count(*) as high_compared, count(*) filter ((station+dayofyear(date))%9<>0) as high_matched, count(*) as low_compared, count(*) as low_matched, count(*)*2 as product_versions from labels_daily group by 1"""))
def cross_source_match(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.cross_source_match(climate_reports(spark, sf), shapes.labels_daily(spark, sf))


@query("e14_issuance_slots", with_views(("labels_daily",), "select city, s.slot, s.t as first, s.t as last, count(*) as products from labels_daily, (values ('00xxZ','00:00'),('08xxZ','08:00')) s(slot,t) group by all"))
def issuance_slots(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.issuance_slots(climate_reports(spark, sf))
