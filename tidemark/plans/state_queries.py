"""Windows and running state over the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clocks
from ..operators import joins, state, timeline
from . import shapes
from .registry import query
from .shapes import q6, q6_sql, stamp, stamp_sql, table, with_views

DAY = "partition by station, local_date order by epoch_us(valid_utc)"
SO_FAR = f"over ({DAY} rows unbounded preceding)"


def lag_sql(column: str, minutes: int) -> str:
    return f"last_value({column}) over ({DAY} range between unbounded preceding and {minutes * 60000000} preceding)"


def observations(spark: SparkSession, sf: str) -> DataFrame:
    return state.one_per_instant(shapes.obs(spark, sf), [F.col("event_id")])


@query("w01_running_extremes", with_views(("obs",), f"""
 select event_id, {q6_sql(f'max(tmpf) {SO_FAR}')} as high_so_far, {q6_sql(f'min(tmpf) {SO_FAR}')} as low_so_far,
 {q6_sql(f"(epoch_us(valid_utc) - arg_max(epoch_us(valid_utc), row(tmpf, -epoch_us(valid_utc))) {SO_FAR})/6e7", 3)} as since_high,
 {q6_sql(f"(epoch_us(valid_utc) - arg_min(epoch_us(valid_utc), row(tmpf, epoch_us(valid_utc))) {SO_FAR})/6e7", 3)} as since_low from obs"""))
def running_extremes(spark: SparkSession, sf: str) -> DataFrame:
    out = state.running_extremes(observations(spark, sf))
    return out.select(
        "event_id", q6(F.col("observed_high_so_far_f")).alias("high_so_far"), q6(F.col("observed_low_so_far_f")).alias("low_so_far"),
        q6(F.col("minutes_since_daily_high"), 3).alias("since_high"), q6(F.col("minutes_since_daily_low"), 3).alias("since_low"))


@query("w02_lagged_values", with_views(("obs",), f"select event_id, {lag_sql('tmpf', 30)} as tmpf_30m, {lag_sql('tmpf', 360)} as tmpf_6h, {lag_sql('sky', 60)} as sky_60m from obs"))
def lagged_values(spark: SparkSession, sf: str) -> DataFrame:
    return observations(spark, sf).select(
        "event_id", state.value_before("tmpf", 30).alias("tmpf_30m"), state.value_before("tmpf", 360).alias("tmpf_6h"),
        state.value_before("sky", 60).alias("sky_60m"))


CHANGES = f"""select event_id, {q6_sql(f"tmpf-{lag_sql('tmpf', 5)}", 4)} as d5, {q6_sql(f"tmpf-{lag_sql('tmpf', 15)}", 4)} as d15,
 {q6_sql(f"tmpf-{lag_sql('tmpf', 30)}", 4)} as d30, {q6_sql(f"tmpf-{lag_sql('tmpf', 60)}", 4)} as d60,
 {q6_sql(f"dwpf-{lag_sql('dwpf', 60)}", 4)} as dew60, {q6_sql(f"sknt-{lag_sql('sknt', 60)}", 4)} as wind60, {q6_sql(f"drct-{lag_sql('drct', 60)}", 4)} as dir60,
 case when {lag_sql('sky', 60)} is not null then cast(sky<>{lag_sql('sky', 60)} as int) else -1 end as cloud60,
 {q6_sql(f"round_even(((tmpf-{lag_sql('tmpf', 30)})-(tmpf-{lag_sql('tmpf', 60)}))/30, 5)", 5)} as accel from obs"""


@query("w03_recent_changes", with_views(("obs",), CHANGES))
def recent_changes(spark: SparkSession, sf: str) -> DataFrame:
    out = state.recent_changes(observations(spark, sf))
    names = {"d5": "temperature_change_5m_f", "d15": "temperature_change_15m_f", "d30": "temperature_change_30m_f", "d60": "temperature_change_60m_f",
             "dew60": "dewpoint_change_60m_f", "wind60": "wind_speed_change_60m_kt", "dir60": "wind_direction_change_60_deg"}
    return out.select(
        "event_id", *[q6(F.col(c), 4).alias(n) for n, c in names.items()], F.coalesce("cloud_change_60m", F.lit(-1)).alias("cloud60"),
        q6(F.col("recent_temperature_acceleration_f_per_min2"), 5).alias("accel"))


@query("m01_intraday_state", with_views(("obs",), f"""
 , z as (select *, case station%5 when 0 then 'America/New_York' when 1 then 'America/Los_Angeles' when 2 then 'America/Chicago' when 3 then 'America/Phoenix' else 'UTC' end as zone, 2*pi()/365*(dayofyear(local_date)-1) as g,
  radians(25.0e0+station%20) as lat, cast(-120+station%50 as double) as lon from obs),
 s as (select *, 229.18e0*(0.000075e0+0.001868e0*cos(g)-0.032077e0*sin(g)-0.014615e0*cos(2*g)-0.040849e0*sin(2*g)) as eq,
  0.006918e0-0.399912e0*cos(g)+0.070257e0*sin(g)-0.006758e0*cos(2*g)+0.000907e0*sin(2*g)-0.002697e0*cos(3*g)+0.00148e0*sin(3*g) as dec from z),
 h as (select *, degrees(acos(cos(radians(90.833e0))/(cos(lat)*cos(dec))-tan(lat)*tan(dec))) as ha, (epoch_us(valid_utc)-epoch_us(cast(local_date as timestamp)))/6e7 as minute from s)
 select event_id, {q6_sql(f'max(tmpf) {SO_FAR}')} as high_so_far, {q6_sql(f'min(tmpf) {SO_FAR}')} as low_so_far, {q6_sql(f"tmpf-{lag_sql('tmpf', 60)}", 4)} as d60,
 cast(hour((valid_utc at time zone 'UTC') at time zone zone) as int) as local_hour, cast(dayofyear(local_date) as int) as day_of_year,
 {q6_sql('minute-(720-4*lon-eq-4*ha)', 2)} as since_sunrise, {q6_sql('(720-4*lon-eq+4*ha)-minute', 2)} as until_sunset from h"""))
def intraday_state(spark: SparkSession, sf: str) -> DataFrame:
    zone = shapes.pick(shapes.ZONES, F.col("station") % 5)
    out = state.intraday_state(
        shapes.obs(spark, sf), [F.col("event_id")], (F.col("station") % 20 + 25).cast("double"),
        (F.col("station") % 50 - 120).cast("double"), zone)
    return out.select(
        "event_id", q6(F.col("observed_high_so_far_f")).alias("high_so_far"), q6(F.col("observed_low_so_far_f")).alias("low_so_far"),
        q6(F.col("temperature_change_60m_f"), 4).alias("d60"), "local_hour", "day_of_year",
        q6(F.col("minutes_since_sunrise"), 2).alias("since_sunrise"), q6(F.col("minutes_until_sunset"), 2).alias("until_sunset"))


@query("w06_sequence_windows", with_views(("obs", "labels_daily"), f"""
 , n as (select city, local_date, valid_utc, tmpf, row_number() over w as rn, lag(valid_utc,2) over w as start, greatest(epoch_us(valid_utc)-epoch_us(lag(valid_utc) over w), epoch_us(lag(valid_utc) over w)-epoch_us(lag(valid_utc,2) over w))/6e7 as gap,
  '[[' || cast(lag(tmpf,2) over w as varchar) || '],[' || cast(lag(tmpf) over w as varchar) || '],[' || cast(tmpf as varchar) || ']]' as seq from obs window w as (partition by city, local_date order by valid_utc))
 select city, t.temp_type, {stamp_sql('valid_utc')} as decision, {stamp_sql('start')} as window_start, seq as sequence_json, case when t.temp_type='high' then tmax_f else tmin_f end as observed_f
 from n join labels_daily l using (city) , (values ('high'),('low')) t(temp_type) where l.date=n.local_date and rn>=3 and (rn-3)%2=0 and l.label_available_ts>valid_utc and gap<=480"""))
def sequence_windows(spark: SparkSession, sf: str) -> DataFrame:
    rows = observations(spark, sf).withColumn("feature_asof_utc", F.col("valid_utc"))
    out, _ = state.sequence_windows(rows, shapes.labels_daily(spark, sf), ["tmpf"], window=3, stride=2, max_gap_minutes=480.0)
    return out.select("city", "temp_type", stamp(F.col("decision_time_utc")).alias("decision"), stamp(F.col("window_start_utc")).alias("window_start"), "sequence_json", "observed_f")


@query("w07_duplicate_collapse", "select l_orderkey, l_linenumber, min(l_shipdate)::date::varchar as first_ship from lineitem group by 1,2")
def duplicate_collapse(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    out = joins.first_by_key(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate")])
    return out.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").cast("string").alias("first_ship"))


@query("w08_canonical_rows", """
 with r as (select l_orderkey as station, l_linenumber as valid_utc, l_partkey, case when l_discount>0.05 then l_discount end as f1, case when l_tax>0.04 then l_tax end as f2, l_returnflag || l_suppkey as raw, l_partkey*1000000+l_suppkey*100+cast(l_quantity as bigint) as ordinal from lineitem),
 s as (select *, (f1 is not null)::int + (f2 is not null)::int as score, sha256(raw) as sha from r)
 select station, valid_utc, ordinal, score, case when row_number() over (partition by station, valid_utc order by score desc, sha desc, ordinal)=1 then 'retained' else 'superseded' end as decision from s""")
def canonical_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("station"), F.col("l_linenumber").alias("valid_utc"), F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("f1"),
        F.when(F.col("l_tax") > 0.04, F.col("l_tax")).alias("f2"), F.concat("l_returnflag", F.col("l_suppkey").cast("string")).alias("raw"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 100 + F.col("l_quantity").cast("long")).alias("ordinal"))
    _, ledger = state.canonical_rows(rows, ["f1", "f2"], "raw", "ordinal")
    return ledger.select("station", "valid_utc", "ordinal", "score", "decision")


SEQ = "over (partition by sid order by received_ts, event_id)"


@query("w10_sequence_health", with_views(("book",), f"""
 select sid, count(*) as frames, count(*) filter (seq>p+1) as gaps, count(*) filter (seq<=p) as resets, count(*) filter (seq<=m) as stale, count(*) filter (seq>m+1) as accepted_gaps from (
 select sid, seq, lag(seq) {SEQ} as p, max(seq) over (partition by sid order by received_ts, event_id rows between unbounded preceding and 1 preceding) as m from book) group by 1"""))
def sequence_health(spark: SparkSession, sf: str) -> DataFrame:
    out = state.sequence_health(shapes.book_messages(spark, sf))
    return out.groupBy("sid").agg(
        F.count(F.lit(1)).alias("frames"), F.count_if("gap").alias("gaps"), F.count_if("reset").alias("resets"),
        F.count_if("stale").alias("stale"), F.count_if("accepted_gap").alias("accepted_gaps"))


@query("w11_latest_session", "select user_id, count(*) as n from events where ts::date=(select max(ts::date) from events) group by 1")
def latest_session(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("connection_epoch", F.to_date("ts"))
    return state.latest_session(rows).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("w12_drawdown", with_views(("returns",), f"""
 , c as (select strategy, t, sum(ln(1+value)) over (partition by strategy order by t) as lv, sum(value) over (partition by strategy order by t) as av from returns),
 p as (select *, greatest(max(lv) over (partition by strategy order by t), 0) as lp, greatest(max(av) over (partition by strategy order by t), 0) as ap from c)
 select strategy, {q6_sql('max(1-exp(lv-lp))', 6)} as equity_drawdown, {q6_sql('max(ap-av)', 6)} as profit_drawdown, count(*) as observations from p group by 1"""))
def drawdown(spark: SparkSession, sf: str) -> DataFrame:
    r = shapes.returns(spark, sf)
    a = state.drawdown(r, ["strategy"], "t", "value").withColumnRenamed("max_drawdown", "equity_drawdown")
    b = state.drawdown(r, ["strategy"], "t", "value", additive=True).select("strategy", F.col("max_drawdown").alias("profit_drawdown"))
    return a.join(b, "strategy").select("strategy", q6(F.col("equity_drawdown")).alias("equity_drawdown"), q6(F.col("profit_drawdown")).alias("profit_drawdown"), "observations")


@query("w13_bucket_gaps", """
 with b as (select l_orderkey as event_ticker, l_linenumber as market_ticker, max(floor(l_quantity/5)) as f, max(floor(l_quantity/5))+max(l_linenumber%3) as c, count(*) as n from lineitem group by 1,2),
 m as (select *, last_value(c ignore nulls) over (partition by event_ticker order by f, c, market_ticker rows between unbounded preceding and 1 preceding) as p from b)
 select event_ticker, count(*) as markets, sum(n-1)::bigint as duplicate_tickers, count(*) filter (f<=p) as overlaps, count(*) filter (f>p+1) as gaps from m group by 1""")
def bucket_gaps(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    both = li.groupBy(F.col("l_orderkey").alias("event_ticker"), F.col("l_linenumber").alias("market_ticker")).agg(
        F.max(F.floor(F.col("l_quantity") / 5)).alias("bucket_floor_f"))
    rows = li.select(F.col("l_orderkey").alias("event_ticker"), F.col("l_linenumber").alias("market_ticker")).join(both, ["event_ticker", "market_ticker"]).withColumn(
        "bucket_ceil_f", F.col("bucket_floor_f") + F.col("market_ticker") % 3)
    return state.bucket_gaps(rows).select("event_ticker", "markets", "duplicate_tickers", "overlaps", "gaps")


@query("w14_state_monotone", with_views(("obs",), f"""
 , s as (select *, max(tmpf) {SO_FAR} as mx, min(tmpf) {SO_FAR} as mn from obs), f as (select *, mx - case when event_id%17=0 then 5e0 else 0e0 end as hi, mn + case when event_id%19=0 then 3e0 else 0e0 end as lo from s),
 p as (select *, lag(hi) over ({DAY}) as ph, lag(lo) over ({DAY}) as pl from f)
 select station, count(*) as rows, count(distinct local_date) as station_days, count(*) filter (abs(hi-mx)>1e-6) as high_mismatch, count(*) filter (abs(lo-mn)>1e-6) as low_mismatch,
  count(*) filter (hi+1e-6<ph) as high_not_monotone, count(*) filter (lo-1e-6>pl) as low_not_monotone from p group by 1"""))
def state_monotone(spark: SparkSession, sf: str) -> DataFrame:
    """States with faults put in: every seventeenth high is too low, every nineteenth low too high."""
    k = F.col("event_id")
    states = state.running_extremes(observations(spark, sf))
    return state.check_state(states.withColumns({
        "observed_high_so_far_f": F.col("observed_high_so_far_f") - F.when(k % 17 == 0, 5.0).otherwise(0.0),
        "observed_low_so_far_f": F.col("observed_low_so_far_f") + F.when(k % 19 == 0, 3.0).otherwise(0.0)}))


@query("w15_first_last_revision", f"select o_custkey, count(*) as revisions, arg_min(o_totalprice, row(o_orderdate, o_totalprice)) as first_value, arg_max(o_totalprice, row(o_orderdate, o_totalprice)) as last_value from orders group by 1")
def first_last_revision(spark: SparkSession, sf: str) -> DataFrame:
    out = state.first_last_revision(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", ["o_totalprice"])
    return out.select("o_custkey", "revisions", F.col("first.o_totalprice").alias("first_value"), F.col("last.o_totalprice").alias("last_value"))


@query("w16_first_receipt", f"""
 with f as (select l_orderkey, l_partkey, l_linenumber, min(l_shipdate) as first, count(*) as n from lineitem group by 1,2,3)
 select l_orderkey, arg_min(l_partkey, row(first, l_partkey, l_linenumber)) as l_partkey, {stamp_sql('min(first)')} as first_receipt, count(*)>1 as conflict, sum(n)::bigint as receipts from f group by 1""")
def first_receipt(spark: SparkSession, sf: str) -> DataFrame:
    out = state.first_receipt(table(spark, sf, "lineitem"), "l_orderkey", "l_shipdate", ["l_partkey", "l_linenumber"])
    return out.select("l_orderkey", "l_partkey", stamp(F.col("l_shipdate")).alias("first_receipt"), "conflict", "receipts")


def slope_contracts(spark: SparkSession, sf: str) -> DataFrame:
    o = shapes.obs(spark, sf)
    return o.select(
        F.col("event_id").alias("market_ticker"), "station", shapes.minutes(F.col("valid_utc"), F.lit(20)).alias("decision_ts"),
        clocks.shift_hours(F.date_trunc("hour", "valid_utc"), F.when(F.col("event_id") % 9 == 0, -30).otherwise(2)).alias("target_time_utc"))


def temperature_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every thirteenth reading arrives three days late."""
    late = F.when(F.col("event_id") % 13 == 0, 4320).otherwise(0)
    return shapes.obs(spark, sf).select("station", "valid_utc", shapes.minutes(F.col("receipt_utc"), late).alias("receipt_utc"), F.col("tmpf").alias("temperature_f"))


#: The same readings for the checks, and what the contracts of this query ask of them.
LATE_ROWS = ("late_rows", "select station, valid_utc, receipt_utc + to_minutes(case when event_id%13=0 then 4320 else 0 end) as receipt_utc, tmpf from obs")
SLOPE_ASKS = ("asks", """select event_id as market_ticker, station, valid_utc + interval 20 minute as dts,
 date_trunc('hour', valid_utc) + to_hours(case when event_id%9=0 then -30 else 2 end) as target from obs""")


def slope_prior_sql(minutes: int) -> str:
    return f"select market_ticker, max(row(o.valid_utc, o.receipt_utc, o.tmpf))[3] as v from l join late_rows o on o.station=l.station and o.receipt_utc<=l.dts and o.valid_utc<=l.lt - interval {minutes} minute group by 1"


@query("w04_slopes_at_decision", with_views(("obs",), f"""
 , l as (select market_ticker, c.station, dts, max(row(o.valid_utc, o.receipt_utc, o.tmpf))[1] as lt, max(row(o.valid_utc, o.receipt_utc, o.tmpf))[3] as lv
   from asks c join late_rows o on o.station=c.station and o.receipt_utc<=c.dts and o.valid_utc<=c.target group by 1,2,3),
 a as ({slope_prior_sql(60)}), b as ({slope_prior_sql(120)}),
 p as (select market_ticker, o.valid_utc as t, o.tmpf as v, row_number() over (partition by market_ticker order by o.valid_utc desc, o.receipt_utc desc) as rn
   from l join (select station, valid_utc, max(row(receipt_utc, tmpf))[1] as receipt_utc, max(row(receipt_utc, tmpf))[2] as tmpf from late_rows group by 1,2) o on o.station=l.station and o.receipt_utc<=l.dts and o.valid_utc<l.lt)
 select l.market_ticker, lv as temperature_latest, {q6_sql('(lv-a.v)/60')} as slope_60m, {q6_sql('(lv-b.v)/120')} as slope_120m,
  {q6_sql('lv - 2*p1.v + p2.v', 4)} as acceleration
 from l left join a using (market_ticker) left join b using (market_ticker) left join p p1 on p1.market_ticker=l.market_ticker and p1.rn=1 left join p p2 on p2.market_ticker=l.market_ticker and p2.rn=2""",
 LATE_ROWS, SLOPE_ASKS))
def slopes_at_decision(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import features

    points = temperature_rows(spark, sf)
    seen = features.observation_features(slope_contracts(spark, sf), points)
    out = features.slope_features(seen, points, minutes=(60, 120)).where(F.col("temperature_latest").isNotNull())
    out = features.acceleration_feature(out, points)
    return out.select("market_ticker", "temperature_latest", q6(F.col("temperature_slope_60m")).alias("slope_60m"), q6(F.col("temperature_slope_120m")).alias("slope_120m"),
                      q6(F.col("temperature_slope_acceleration"), 4).alias("acceleration"))
