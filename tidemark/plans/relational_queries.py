"""Filters, joins, aggregates, sorts and set operations over the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clocks, numeric
from ..operators import aggregates, filters, joins, quality, quantiles, timeline
from ..operators.timeline import Running
from . import shapes
from .registry import query
from .shapes import q6, q6_sql, stamp, stamp_sql, table, with_views

def count_rows() -> Column:
    return F.count(F.lit(1))


# ---------------------------------------------------------------- filters

@query("p01_available_asof", with_views(("forecasts",), """
 select model_name, temp_type, case when source_receipt_time is null then 'missing_receipt_clock'
  when forecast_issue_time>decision_time_utc or source_receipt_time>decision_time_utc then 'after_decision' else 'admitted' end as reason, count(*) as n
 from forecasts group by 1,2,3"""))
def available_asof(spark: SparkSession, sf: str) -> DataFrame:
    marked = filters.mark_available(shapes.forecasts(spark, sf), F.col("decision_time_utc"))
    return marked.groupBy("model_name", "temp_type", F.coalesce("reason", F.lit("admitted")).alias("reason")).agg(count_rows().alias("n"))


AS_OF = "timestamp '2024-01-15 00:00:00'"
def as_of_col() -> Column:
    return F.lit("2024-01-15 00:00:00").cast("timestamp")


@query("p02_known_forecasts", with_views(("forecasts",), f"""
 select event_ticker, model_name, {stamp_sql('source_receipt_time')} as receipt from forecasts
 where forecast_issue_time<={AS_OF} and source_receipt_time<={AS_OF}"""))
def known_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    out = filters.known_forecasts(shapes.forecasts(spark, sf), as_of_col())
    return out.select("event_ticker", "model_name", stamp(F.col("source_receipt_time")).alias("receipt"))


@query("p03_valid_forecasts", with_views(("forecasts",), f"""
 select event_ticker, model_name from forecasts where forecast_issue_time<={AS_OF} and source_receipt_time<={AS_OF} and outcome_local_date<={AS_OF}"""))
def valid_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    out = filters.valid_forecasts(shapes.forecasts(spark, sf), as_of_col(), "outcome_local_date")
    return out.select("event_ticker", "model_name")


@query("p04_known_labels", with_views(("labels_daily",), f"""
 select station, cast(date as varchar) as date, {q6_sql('tmax_f')} as tmax_f from labels_daily where label_available_ts<={AS_OF}"""))
def known_labels(spark: SparkSession, sf: str) -> DataFrame:
    out = filters.known_labels(shapes.labels_daily(spark, sf), as_of_col())
    return out.select("station", F.col("date").cast("string").alias("date"), q6(F.col("tmax_f")).alias("tmax_f"))


@query("p05_first_present", """
 select event_id, coalesce(nullif(trim(case when event_id%3=0 then ' ' else event_type end),''), nullif(props,''), '') as first_text,
 coalesce(try_cast(case when event_id%2=0 then event_type end as double), value) as first_number from events""")
def first_present(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    blanked = F.when(F.col("event_id") % 3 == 0, F.lit(" ")).otherwise(F.col("event_type"))
    return e.select(
        "event_id", F.coalesce(clocks.first_text(blanked, F.col("props")), F.lit("")).alias("first_text"),
        clocks.first_number(F.when(F.col("event_id") % 2 == 0, F.col("event_type")), F.col("value")).alias("first_number"))


@query("p07_value_domain", """
 select case when p>1 then 'probability_out_of_range' when y not in (0,1) then 'outcome_not_binary' when not (price>0 and price<1) then 'price_not_inside_unit' else 'valid' end as reason, count(*) as n
 from (select (o_orderkey%110)/100e0 as p, o_custkey%3 as y, (o_orderkey%7)/6e0 as price from orders) group by 1""")
def value_domain(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 110 / F.lit(100.0)).alias("p"), (F.col("o_custkey") % 3).alias("y"),
        (F.col("o_orderkey") % 7 / F.lit(6.0)).alias("price"))
    reason = filters.probability_reason(F.col("p"), F.col("y"), F.col("price"))
    return o.groupBy(F.coalesce(reason, F.lit("valid")).alias("reason")).agg(count_rows().alias("n"))


@query("p08_scope_filter", """
 select case when n_name not in ('NATION_1','NATION_3','NATION_5') then 'non_target_station' when c_acctbal<0 then 'missing_value' else 'accepted' end as reason, count(*) as n
 from customer join nation on c_nationkey=n_nationkey group by 1""")
def scope_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    reason = filters.scope_reason(F.col("n_name"), ("NATION_1", "NATION_3", "NATION_5"), (F.col("c_acctbal") < 0, "missing_value"))
    return rows.groupBy(F.coalesce(reason, F.lit("accepted")).alias("reason")).agg(count_rows().alias("n"))


@query("p09_settlement_window", with_views(("obs",), f"""
 select station, cast(cast(valid_utc + to_hours(case station%5 when 0 then -5 when 1 then -8 when 2 then -6 when 3 then -7 else 0 end) as date) as varchar) as outcome_local_date,
 count(*) as observation_count, {q6_sql('max(tmpf)')} as tmax_f, {stamp_sql('arg_max(valid_utc, row(tmpf, valid_utc))')} as tmax_utc,
 {q6_sql('min(tmpf)')} as tmin_f, {stamp_sql('arg_min(valid_utc, row(tmpf, valid_utc))')} as tmin_utc from obs group by 1,2"""))
def settlement_window(spark: SparkSession, sf: str) -> DataFrame:
    offset = shapes.pick(shapes.OFFSETS, F.col("station") % 5)
    rows = shapes.obs(spark, sf).withColumn("outcome_local_date", clocks.standard_day(F.col("valid_utc"), offset))
    out = aggregates.extremes(rows, ["station", "outcome_local_date"], "tmpf", "valid_utc")
    return out.select(
        "station", F.col("outcome_local_date").cast("string").alias("outcome_local_date"), "observation_count",
        q6(F.col("tmax_f")).alias("tmax_f"), stamp(F.col("tmax_utc")).alias("tmax_utc"),
        q6(F.col("tmin_f")).alias("tmin_f"), stamp(F.col("tmin_utc")).alias("tmin_utc"))


@query("p10_bucket_membership", with_views(("buckets", "label_events"), """
 select market_ticker, (bucket_floor_f is null or observed_f>=bucket_floor_f) and (bucket_ceil_f is null or observed_f<=bucket_ceil_f) as exact_inside,
 (bucket_floor_f is null or round_even(observed_f,0)>=bucket_floor_f) and (bucket_ceil_f is null or round_even(observed_f,0)<=bucket_ceil_f) as rounded_inside
 from buckets join label_events using (event_ticker)"""))
def bucket_membership(spark: SparkSession, sf: str) -> DataFrame:
    rows = shapes.buckets(spark, sf).join(shapes.label_events(spark, sf).select("event_ticker", "observed_f"), "event_ticker")
    v, lo, hi = F.col("observed_f"), F.col("bucket_floor_f"), F.col("bucket_ceil_f")
    return rows.select(
        "market_ticker", filters.inside_bucket(v, lo, hi).alias("exact_inside"),
        filters.inside_bucket(F.bround(v), lo, hi).alias("rounded_inside"))


def cloud_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every error observation doubles as a satellite pass over its station."""
    o = shapes.obs(spark, sf).where(F.col("sky") == "error")
    return o.select(
        "station", F.col("valid_utc").alias("cloud_time_utc"), (F.col("tmpf") / 10 + 250).alias("ir_k"),
        (F.col("event_id") % 101 / F.lit(100.0)).alias("clear_fraction"), F.col("event_id").alias("cloud_id"))


CLOUD = ("cloud", "select station, valid_utc as cloud_time_utc, tmpf/10+250 as ir_k, event_id%101/100e0 as clear_fraction, event_id as cloud_id from obs where sky='error'")


@query("p11_age_gate", with_views(("obs",), f"""
 select o.event_id, c.cloud_id, {q6_sql('(epoch_us(o.valid_utc)-epoch_us(c.cloud_time_utc))/6e7')} as age_minutes
 from obs o asof join cloud c on o.station=c.station and o.valid_utc>=c.cloud_time_utc where (epoch_us(o.valid_utc)-epoch_us(c.cloud_time_utc))/6e7<=4320""", CLOUD))
def age_gate(spark: SparkSession, sf: str) -> DataFrame:
    joined = timeline.asof_join(
        shapes.obs(spark, sf), cloud_rows(spark, sf), ["station"], F.col("valid_utc"), F.col("cloud_time_utc"),
        {"cloud_time_utc": F.col("cloud_time_utc"), "cloud_id": F.col("cloud_id")}, segment="day", how="inner")
    fresh = joined.where(filters.fresh(F.col("valid_utc"), F.col("cloud_time_utc"), 4320.0))
    return fresh.select("event_id", "cloud_id", q6(clocks.age_minutes(F.col("valid_utc"), F.col("cloud_time_utc"))).alias("age_minutes"))


@query("p12_derived_prices", """
 select o_orderkey, round_even((bid+ask)/2, 2) as mid_price, round_even(coalesce(last, round_even((bid+ask)/2,2)), 4) as implied_probability, round_even(ask-bid, 4) as spread from (
 select o_orderkey, (o_orderkey%50)/100e0 as bid, (o_orderkey%50+2+2*(o_orderkey%3))/100e0 as ask, case when o_orderkey%3=0 then (o_orderkey%97)/97e0 end as last from orders)""")
def derived_prices(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", (k % 50 / F.lit(100.0)).alias("bid"), ((k % 50 + 2 + k % 3 * 2) / F.lit(100.0)).alias("ask"),
        F.when(k % 3 == 0, k % 97 / F.lit(97.0)).alias("last"))
    return filters.quote_prices(rows, "bid", "ask", "last").select("o_orderkey", "mid_price", "implied_probability", "spread")


@query("p13_source_era", """
 select case when o_orderdate>=timestamp '1997-06-01' then 'after' else 'before' end as era,
 case when (case when o_orderdate>=timestamp '1997-06-01' then 'O' else 'F' end)<>o_orderstatus then 'settlement_source_mismatch' else 'match' end as reason, count(*) as n
 from orders group by 1,2""")
def source_era(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.source_era(
        table(spark, sf, "orders"), F.col("o_orderdate"), F.lit("1997-06-01").cast("timestamp"), F.col("o_orderstatus"), "F", "O")
    return rows.groupBy("era", F.coalesce("reason", F.lit("match")).alias("reason")).agg(count_rows().alias("n"))


# ---------------------------------------------------------------- joins

@query("j01_composite_hash_join", """
 with r as (select l_orderkey, l_linenumber, max(row(l_shipdate, l_partkey, l_suppkey, l_quantity)) as best, arg_max(l_quantity, row(l_shipdate, l_partkey, l_suppkey, l_quantity)) as qty from lineitem group by 1,2)
 select o_orderkey, l_linenumber, qty from orders join r on o_orderkey=l_orderkey""")
def composite_hash_join(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", F.col("l_quantity").alias("qty"))
    last = timeline.keep_latest(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey"), F.col("qty")])
    o = table(spark, sf, "orders").select("o_orderkey")
    return o.join(last, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "l_linenumber", "qty")


@query("j02_left_with_fallback", with_views(("forecasts", "event_labels"), """
 , last as (select event_ticker, arg_max(observed_f, row(label_available_ts, observed_f)) as observed_f, max(label_available_ts) as av from event_labels where label_available_ts is not null group by 1)
 select case when l.observed_f is null then 'missing_proxy_label' else 'accepted' end as reason, model_name, count(*) as n from forecasts left join last l using (event_ticker) group by 1,2"""))
def left_with_fallback(spark: SparkSession, sf: str) -> DataFrame:
    labels = shapes.event_labels(spark, sf).where(F.col("label_available_ts").isNotNull())
    good, bad = joins.lookup_or_reject(
        shapes.forecasts(spark, sf), labels, ["event_ticker"], [F.col("label_available_ts"), F.col("observed_f")], ["observed_f"], "missing_proxy_label")
    both = good.select("model_name", F.lit("accepted").alias("reason")).unionByName(bad.select("model_name", "reason"))
    return both.groupBy("reason", "model_name").agg(count_rows().alias("n"))


@query("j03_missing_references", with_views(("candles", "outcomes"), "select distinct market_ticker from candles where market_ticker not in (select market_ticker from outcomes)"))
def missing_references(spark: SparkSession, sf: str) -> DataFrame:
    return joins.missing_references(shapes.candles(spark, sf), shapes.outcomes(spark, sf), ["market_ticker"])


@query("j04_key_membership", with_views(("candles", "outcomes"), "select market_ticker, count(*) as n from candles where market_ticker in (select market_ticker from outcomes) group by 1"))
def key_membership(spark: SparkSession, sf: str) -> DataFrame:
    kept = joins.present_in(shapes.candles(spark, sf), shapes.outcomes(spark, sf), ["market_ticker"])
    return kept.groupBy("market_ticker").agg(count_rows().alias("n"))


@query("j08_label_after_decision", with_views(("forecasts", "event_labels"), """
 select model_name, reason, count(*) as n, floor(sum(observed_f)*1e4+0.4993e0)/1e4 as total from (
 select f.model_name, f.event_ticker, case when a.hit is null and s.dated>0 then 'target_leakage' when a.hit is null and s.n>0 then 'invalid_label' when a.hit is null then 'no_label_found' when a.observed_f is null then 'invalid_label' else 'scored' end as reason, a.observed_f
 from forecasts f left join (select event_ticker, count(label_available_ts) as dated, count(*) as n from event_labels group by 1) s using (event_ticker)
 left join (select event_ticker, model_name, true as hit, arg_min(row(v.observed_f), v.label_available_ts)[1] as observed_f from forecasts g join event_labels v using (event_ticker) where v.label_available_ts>g.decision_time_utc group by 1,2) a using (event_ticker, model_name)) group by 1,2"""))
def label_after_decision(spark: SparkSession, sf: str) -> DataFrame:
    out = joins.label_after(shapes.forecasts(spark, sf), shapes.event_labels(spark, sf))
    return out.groupBy("model_name", F.coalesce("label_reason", F.lit("scored")).alias("reason")).agg(
        count_rows().alias("n"), q6(F.sum("observed_f"), 4).alias("total"))


def portal_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly contracts on the exact instants of whole-hour observations, plus hours without one."""
    o = shapes.obs(spark, sf).withColumn("hour_utc", F.date_trunc("hour", "valid_utc"))
    k = F.col("event_id")
    return o.select(
        k.alias("market_ticker"), F.col("station").alias("settlement_station"),
        clocks.shift_hours(F.col("hour_utc"), F.when(k % 3 == 0, 1).otherwise(0)).alias("target_time_utc"),
        F.when(k % 2 == 0, F.lit(50.0)).alias("bucket_floor_f"), F.when(k % 2 == 1, F.lit(40.0)).alias("bucket_ceil_f"),
        F.lit(None).cast("double").alias("threshold_f"), F.when(k % 2 == 0, "above").otherwise("below").alias("comparison"))


def portal_observations(spark: SparkSession, sf: str) -> DataFrame:
    o = shapes.obs(spark, sf)
    return o.select("station", F.date_trunc("hour", "valid_utc").alias("valid_utc"), F.col("tmpf").alias("temperature_f"),
                    F.col("receipt_utc").alias("retrieved_at_utc"))


@query("j09_exact_time_newest", with_views(("obs",), """
 , p as (select station, date_trunc('hour', valid_utc) as v, arg_max(tmpf, row(receipt_utc, tmpf)) as t from obs group by 1,2),
 c as (select event_id as market_ticker, station, date_trunc('hour', valid_utc) + to_hours(case when event_id%3=0 then 1 else 0 end) as target, event_id%2=0 as above from obs)
 select market_ticker, t as source_temperature_f, case when t is null then '' when above and floor(t+0.5e0)>=50 then 'true' when not above and floor(t+0.5e0)<=40 then 'true' else 'false' end as source_observed_yes
 from c left join p on c.station=p.station and c.target=p.v"""))
def exact_time_newest(spark: SparkSession, sf: str) -> DataFrame:
    out = joins.exact_newest(portal_contracts(spark, sf), portal_observations(spark, sf))
    return out.select("market_ticker", "source_temperature_f", "source_observed_yes")


@query("j11_bucket_expansion", with_views(("forecasts", "buckets"), """
 select model_name, temp_type, b.bucket_floor_f, b.bucket_ceil_f, count(*) as n from forecasts join (select event_ticker, bucket_floor_f, bucket_ceil_f from buckets) b using (event_ticker) group by 1,2,3,4"""))
def bucket_expansion(spark: SparkSession, sf: str) -> DataFrame:
    wide, _ = joins.expand_buckets(shapes.forecasts(spark, sf), shapes.buckets(spark, sf))
    return wide.groupBy("model_name", "temp_type", "bucket_floor_f", "bucket_ceil_f").agg(count_rows().alias("n"))


GRID = ("select {key} as id, -60 + ({key}*37)%120 + ({key}%7)/10e0 as lat, -180 + ({key}*53)%360 + ({key}%11)/10e0 as lon from {table}")


@query("j13_distance_join", f"""
 with s as ({GRID.format(key='s_suppkey', table='supplier')}), c as ({GRID.format(key='c_custkey', table='customer')}),
 d as (select s.id as city_id, c.id as station_id, 2*6371.0088e0*asin(sqrt(pow(sin(radians(c.lat-s.lat)/2),2)+cos(radians(s.lat))*cos(radians(c.lat))*pow(sin(radians(c.lon-s.lon)/2),2))) as km from s, c)
 select city_id, station_id, {q6_sql('km', 4)} as distance_km from d where km<=300""")
def distance_join(spark: SparkSession, sf: str) -> DataFrame:
    def grid(name: str, key: str, lat: str, lon: str, ident: str) -> DataFrame:
        k = F.col(key)
        return table(spark, sf, name).select(
            k.alias(ident), (k * 37 % 120 - 60 + k % 7 / F.lit(10.0)).alias(lat), (k * 53 % 360 - 180 + k % 11 / F.lit(10.0)).alias(lon))

    near = joins.within_radius(
        grid("customer", "c_custkey", "lat", "lon", "station_id"), grid("supplier", "s_suppkey", "city_lat", "city_lon", "city_id"), 300.0)
    return near.select("city_id", "station_id", q6(F.col("distance_km"), 4).alias("distance_km"))


@query("j14_spatial_neighbours", with_views(("obs",), f"""
 , d as (select event_id as decision_id, station%30 as grp, valid_utc + interval 5 minute as dt from obs),
 st as (select distinct station, station%30 as grp from obs),
 x as (select decision_id, st.station, d.dt from d join st using (grp))
 select decision_id, count(*) as station_count, {q6_sql('max(o.tmpf)-min(o.tmpf)')} as spatial_range, {q6_sql('avg(o.tmpf)', 4)} as spatial_mean
 from x asof join obs o on x.station=o.station and x.dt>=o.valid_utc group by 1"""))
def spatial_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    o = shapes.obs(spark, sf)
    d = o.select(F.col("event_id").alias("decision_id"), (F.col("station") % 30).alias("group"), shapes.minutes(F.col("valid_utc"), F.lit(5)).alias("decision_time_utc"))
    stations = o.select("station", (F.col("station") % 30).alias("group")).distinct()
    out = joins.spatial_spread(d, stations, o.select("station", "valid_utc", F.col("tmpf").alias("temperature_f")))
    return out.select("decision_id", "station_count", q6(F.col("spatial_range")).alias("spatial_range"), q6(F.col("spatial_mean"), 4).alias("spatial_mean"))


@query("j15_event_metadata_lookup", """
 select o_orderkey, c_custkey, n_name, r_name, coalesce(l.items, 0) as items from orders left join customer on o_custkey=c_custkey left join nation on c_nationkey=n_nationkey left join region on n_regionkey=r_regionkey
 left join (select l_orderkey, count(*) as items from lineitem group by 1) l on l_orderkey=o_orderkey""")
def event_metadata_lookup(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(count_rows().alias("items"))
    return (
        table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select("o_orderkey", "c_custkey", "n_name", "r_name", F.coalesce("items", F.lit(0)).cast("long").alias("items")))


@query("j16_table_reconciliation", """
 with a as (select l_returnflag as side, l_linenumber as price, sum(l_quantity) as q from lineitem where l_linestatus='O' group by 1,2),
 b as (select l_returnflag as side, l_linenumber as price, sum(l_quantity) as q from lineitem where l_linestatus='F' group by 1,2)
 select coalesce(a.side,b.side) as side, coalesce(a.price,b.price) as price, coalesce(a.q,0) as left_qty, coalesce(b.q,0) as right_qty from a full join b on a.side=b.side and a.price=b.price where abs(coalesce(a.q,0)-coalesce(b.q,0))>1e-9""")
def table_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")

    def levels(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("l_returnflag").alias("side"), F.col("l_linenumber").alias("price")).agg(F.sum("l_quantity").alias("qty"))

    return joins.reconcile_levels(
        levels(li.where(F.col("l_linestatus") == "O")), levels(li.where(F.col("l_linestatus") == "F")))


# ---------------------------------------------------------------- aggregates

@query("a01_group_moments", with_views(("obs",), f"select station, month(valid_utc) as month, count(*) as n, {q6_sql('avg(tmpf)', 5)} as mean, {q6_sql('case when count(*)>1 then nullif(stddev_pop(tmpf),0) end', 5)} as spread_pop from obs group by 1,2"))
def group_moments(spark: SparkSession, sf: str) -> DataFrame:
    rows = shapes.obs(spark, sf).withColumn("month", F.month("valid_utc").cast("long"))
    out = aggregates.moments(rows, ["station", "month"], F.col("tmpf"))
    return out.select("station", "month", "n", q6(F.col("mean"), 5).alias("mean"), q6(F.col("spread_pop"), 5).alias("spread_pop"))


@query("a02_sample_spread", f"select l_returnflag, l_linestatus, {q6_sql('stddev_samp(l_extendedprice)', 3)} as spread_samp from lineitem group by 1,2")
def sample_spread(spark: SparkSession, sf: str) -> DataFrame:
    out = aggregates.moments(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], F.col("l_extendedprice"))
    return out.select("l_returnflag", "l_linestatus", q6(F.col("spread_samp"), 3).alias("spread_samp"))


def _quantile_sql(fn: str) -> str:
    cols = ", ".join(f"{q6_sql(f'{fn}(l_extendedprice, {q})', 4)} as {n}" for n, q in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)))
    return f"select l_returnflag, count(*) as group_rows, {cols} from lineitem group by 1"


PROBS = {"p10": 0.1, "p50": 0.5, "p90": 0.9}


def _quantile_frame(spark, sf, build) -> DataFrame:
    out = build(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", PROBS)
    return out.select("l_returnflag", "group_rows", *[q6(F.col(n), 4).alias(n) for n in PROBS])


@query("a03_interpolated_quantiles", _quantile_sql("quantile_cont"))
def interpolated_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return _quantile_frame(spark, sf, quantiles.interpolated_quantiles)


@query("a04_nearest_rank_quantiles", _quantile_sql("quantile_disc"))
def nearest_rank_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return _quantile_frame(spark, sf, quantiles.nearest_rank_quantiles)


@query("a05_floor_index_quantiles", "with r as (select l_returnflag, l_extendedprice as v, row_number() over (partition by l_returnflag order by l_extendedprice) as rn, count(*) over (partition by l_returnflag) as n from lineitem) select l_returnflag, n as group_rows, "
       + ", ".join(f"{q6_sql(f'max(case when rn=floor({q}e0*(n-1))+1 then v end)', 4)} as {name}" for name, q in PROBS.items()) + " from r group by 1,2")
def floor_index_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return _quantile_frame(spark, sf, quantiles.floor_index_quantiles)


@query("a06_median", f"select event_type, {q6_sql('median(value)', 5)} as median from events group by 1")
def median(spark: SparkSession, sf: str) -> DataFrame:
    out = quantiles.interpolated_quantiles(table(spark, sf, "events"), ["event_type"], "value", {"median": 0.5})
    return out.select("event_type", q6(F.col("median"), 5).alias("median"))


@query("a07_exceedance", f"select user_id, {q6_sql('avg(case when value>=20 then 1e0 else 0e0 end)', 5)} as prob_ge_20, {q6_sql('avg(case when value>=60 then 1e0 else 0e0 end)', 5)} as prob_ge_60 from events group by 1")
def exceedance(spark: SparkSession, sf: str) -> DataFrame:
    out = aggregates.exceedance(table(spark, sf, "events"), ["user_id"], F.col("value"), (20.0, 60.0))
    return out.select("user_id", *[q6(F.col(c), 5).alias(c) for c in ("prob_ge_20", "prob_ge_60")])


@query("a08_extreme_times", with_views(("obs",), f"""
 select station, cast(local_date as varchar) as local_date, {q6_sql('max(tmpf)')} as tmax_f, {stamp_sql('arg_max(valid_utc, row(tmpf, -epoch_us(valid_utc)))')} as tmax_utc,
 {q6_sql('min(tmpf)')} as tmin_f, {stamp_sql('arg_min(valid_utc, row(tmpf, valid_utc))')} as tmin_utc from obs group by station, obs.local_date"""))
def extreme_times(spark: SparkSession, sf: str) -> DataFrame:
    out = aggregates.extremes(shapes.obs(spark, sf), ["station", "local_date"], "tmpf", "valid_utc", "first_seen")
    return out.select(
        "station", F.col("local_date").cast("string").alias("local_date"), q6(F.col("tmax_f")).alias("tmax_f"), stamp(F.col("tmax_utc")).alias("tmax_utc"),
        q6(F.col("tmin_f")).alias("tmin_f"), stamp(F.col("tmin_utc")).alias("tmin_utc"))


@query("a09_daily_completeness", with_views(("obs",), f"""
 select station, cast(local_date as varchar) as local_date, count(*) as obs_count, count(*) filter (event_id%9=0) as missing_count, {stamp_sql('min(valid_utc)')} as first_obs_utc, {stamp_sql('max(valid_utc)')} as last_obs_utc, count(*)>=4 as is_complete from obs group by station, obs.local_date"""))
def daily_completeness(spark: SparkSession, sf: str) -> DataFrame:
    rows = shapes.obs(spark, sf).withColumn("tmpf", F.when(F.col("event_id") % 9 != 0, F.col("tmpf")))
    out = aggregates.daily_completeness(rows, ["station", "local_date"], "tmpf", "valid_utc", 4)
    return out.select("station", F.col("local_date").cast("string").alias("local_date"), "obs_count", "missing_count",
                      stamp(F.col("first_obs_utc")).alias("first_obs_utc"), stamp(F.col("last_obs_utc")).alias("last_obs_utc"), "is_complete")


@query("a10_pivot_elements", with_views(("label_events",), f"""
 select station, cast(outcome_local_date as varchar) as date, {q6_sql("max(observed_f) filter (temp_type='high')")} as tmax_value_f, {q6_sql("max(observed_f) filter (temp_type='low')")} as tmin_value_f,
 max('q' || (station%4)) filter (temp_type='high') as tmax_flag, max('q' || (station%4)) filter (temp_type='low') as tmin_flag from label_events group by station, label_events.outcome_local_date"""))
def pivot_elements(spark: SparkSession, sf: str) -> DataFrame:
    rows = shapes.label_events(spark, sf).select(
        "station", F.col("outcome_local_date").alias("date"), F.when(F.col("temp_type") == "high", "TMAX").otherwise("TMIN").alias("element"),
        F.col("observed_f").alias("value_f"), F.concat(F.lit("q"), (F.col("station") % 4).cast("string")).alias("flag"))
    out = aggregates.pivot_elements(rows, ["station", "date"], ("TMAX", "TMIN"), ("value_f", "flag"))
    return out.select("station", F.col("date").cast("string").alias("date"), q6(F.col("tmax_value_f")).alias("tmax_value_f"), q6(F.col("tmin_value_f")).alias("tmin_value_f"), "tmax_flag", "tmin_flag")


WIND = """select station, valid_utc, case event_id%3 when 0 then 'wind_u_10m' when 1 then 'wind_v_10m' else 'gust' end as variable, sknt as value, date_trunc('day', valid_utc) as day from obs"""


@query("a11_wind_components", with_views(("obs",), f"""
 , w as ({WIND}), p as (select station, day, max(value) filter (variable='wind_u_10m') as u, max(value) filter (variable='wind_v_10m') as v from w group by 1,2)
 select station, {stamp_sql('day')} as day, {q6_sql('sqrt(u*u+v*v)', 5)} as value from p where u is not null and v is not null"""))
def wind_components(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id") % 3
    rows = shapes.obs(spark, sf).select(
        "station", F.date_trunc("day", "valid_utc").alias("day"), F.when(k == 0, "wind_u_10m").when(k == 1, "wind_v_10m").otherwise("gust").alias("variable"), F.col("sknt").alias("value"))
    out = aggregates.add_wind_speed(rows, ["station", "day"]).where(F.col("variable") == "wind_speed_10m")
    return out.select("station", stamp(F.col("day")).alias("day"), q6(F.col("value"), 5).alias("value"))


@query("a12_joined_sets", with_views(("obs",), "select station, array_to_string(list_sort(list(distinct sky)), '|') as skies from obs group by 1"))
def joined_sets(spark: SparkSession, sf: str) -> DataFrame:
    return shapes.obs(spark, sf).groupBy("station").agg(aggregates.joined_set(F.col("sky")).alias("skies"))


FIT = ("fit", """select f.*, l.observed_f, cast(round_even(lead_hours/6,0)*6 as int) as lead_bucket, strftime(f.outcome_local_date,'%m') as month, 'z' || (f.station%5) as zone from forecasts f join label_events l using (event_ticker)""")


def fit_rows(spark: SparkSession, sf: str) -> DataFrame:
    f = shapes.forecasts(spark, sf)
    l = shapes.label_events(spark, sf).select("event_ticker", "observed_f")
    return f.join(l, "event_ticker").withColumns({
        "lead_bucket": clocks.lead_bucket(F.col("lead_hours")), "month": F.date_format("outcome_local_date", "MM"),
        "city": F.concat(F.lit("z"), (F.col("station") % 5).cast("string"))})


@query("a13_fallback_levels", with_views(("forecasts", "label_events"), f"""
 select level, city, coalesce(model_name,'*') as model_name, temp_type, coalesce(lead_bucket,-1) as lead_bucket, coalesce(month,'*') as month, count(*) as n, {q6_sql('avg(observed_f-mean_f)', 5)} as residual_mean from (
 select case when grouping(model_name)=1 then 3 when grouping(lead_bucket)=1 then 2 when grouping(month)=1 then 1 else 0 end as level, zone as city, model_name, temp_type, lead_bucket, month, 0 as one from fit group by grouping sets ((zone,model_name,temp_type,lead_bucket,month),(zone,model_name,temp_type,lead_bucket),(zone,model_name,temp_type),(zone,temp_type))) g
 join lateral (select observed_f, mean_f from fit x where x.zone=g.city and x.temp_type=g.temp_type and (g.level>2 or x.model_name=g.model_name) and (g.level>1 or x.lead_bucket=g.lead_bucket) and (g.level>0 or x.month=g.month)) on true group by 1,2,3,4,5,6 having count(*)>=5""", FIT))
def fallback_levels(spark: SparkSession, sf: str) -> DataFrame:
    out = aggregates.grouping_levels(fit_rows(spark, sf), {"residual_mean": "avg(observed_f - mean_f)"}, 5)
    return out.select("level", "city", F.coalesce("model_name", F.lit("*")).alias("model_name"), "temp_type", F.coalesce("lead_bucket", F.lit(-1)).alias("lead_bucket"),
                      F.coalesce("month", F.lit("*")).alias("month"), "n", q6(F.col("residual_mean"), 5).alias("residual_mean"))


@query("a14_group_regression", with_views(("forecasts", "label_events"), f"""
 select zone as city, model_name, count(*) as n, {q6_sql('regr_slope(observed_f, mean_f)', 5)} as slope, {q6_sql('regr_intercept(observed_f, mean_f)', 5)} as intercept,
 {q6_sql('sqrt(var_pop(observed_f)-2*regr_slope(observed_f,mean_f)*covar_pop(observed_f,mean_f)+pow(regr_slope(observed_f,mean_f),2)*var_pop(mean_f))', 5)} as residual_rms from fit group by 1,2""", FIT))
def group_regression(spark: SparkSession, sf: str) -> DataFrame:
    line = aggregates.regression("mean_f", "observed_f")
    out = fit_rows(spark, sf).groupBy("city", "model_name").agg(count_rows().alias("n"), *[F.expr(sql).alias(n) for n, sql in line.items()])
    return out.select("city", "model_name", "n", *[q6(F.col(n), 5).alias(n) for n in line])


@query("a15_weighted_means", f"select l_returnflag, {q6_sql('sum(l_extendedprice*l_quantity)/nullif(sum(l_quantity),0)', 4)} as weighted from lineitem group by 1")
def weighted_means(spark: SparkSession, sf: str) -> DataFrame:
    out = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(aggregates.weighted_mean(F.col("l_extendedprice"), F.col("l_quantity")).alias("weighted"))
    return out.select("l_returnflag", q6(F.col("weighted"), 4).alias("weighted"))


@query("a16_category_counts", "select user_id%10 as part, coalesce(nullif(case when event_id%4=0 then '' else event_type end,''),'missing') as category, count(*) as n from events group by 1,2")
def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select((F.col("user_id") % 10).alias("part"), F.when(F.col("event_id") % 4 == 0, "").otherwise(F.col("event_type")).alias("kind"))
    return aggregates.category_counts(rows, ["part"], "kind")


@query("a17_group_ranges", """select o_custkey, cast(min(o_orderdate)::date as varchar) as first_date, cast(max(o_orderdate)::date as varchar) as last_date, count(distinct o_orderdate) as dates, count(*) filter (o_orderstatus='F') as resolved, count(*) filter (o_orderstatus<>'F') as unresolved, array_to_string(list_sort(list(distinct o_orderpriority)),'|') as sources from orders group by 1""")
def group_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).cast("string").alias("first_date"), F.to_date(F.max("o_orderdate")).cast("string").alias("last_date"),
        F.countDistinct("o_orderdate").alias("dates"), F.count_if(F.col("o_orderstatus") == "F").alias("resolved"),
        F.count_if(F.col("o_orderstatus") != "F").alias("unresolved"), aggregates.joined_set(F.col("o_orderpriority")).alias("sources"))


@query("a18_deviation_summary", with_views(("labels_daily",), f"""
 select station%10 as part, count(*) as n, {q6_sql('avg(tmax_f-tmin_f)', 4)} as mean_diff, {q6_sql('max(abs(tmax_f-tmin_f))', 4)} as max_abs, {q6_sql('avg(case when abs(tmax_f-tmin_f)<=1 then 1e0 else 0e0 end)', 5)} as share_within, cast(arg_max(date, row(abs(tmax_f-tmin_f), date)) as varchar) as worst_day from labels_daily group by 1"""))
def deviation_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = shapes.labels_daily(spark, sf).withColumn("part", F.col("station") % 10)
    out = aggregates.deviation(rows, ["part"], "tmax_f", "tmin_f", "date")
    return out.select("part", "n", q6(F.col("mean_diff"), 4).alias("mean_diff"), q6(F.col("max_abs"), 4).alias("max_abs"), q6(F.col("share_within"), 5).alias("share_within"), F.col("worst_day").cast("string").alias("worst_day"))


@query("a19_status_counters", with_views(("forecasts",), """
 select count(*) as rows, count(*) filter (t='') as missing, count(*) filter (t='soon') as invalid, count(*) filter (t not in ('','soon') and source_receipt_time>timestamp '2024-01-15') as after_as_of, false as pass
 from (select *, case when source_receipt_time is null then '' when station%50=0 then 'soon' else 'x' end as t from forecasts)"""))
def status_counters(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("source_receipt_time").isNull(), "").when(F.col("station") % 50 == 0, "soon").otherwise(clocks.render_utc(F.col("source_receipt_time")))
    rows = shapes.forecasts(spark, sf).withColumn("clock_text", text)
    return aggregates.clock_status(rows, F.col("clock_text"), clocks.parse_utc(F.col("clock_text")), as_of_col())


@query("a20_conflicting_runs", "select l_orderkey, l_linenumber, sum(n)::bigint as repeats, count(*) as identities from (select l_orderkey, l_linenumber, l_shipdate, l_partkey, count(*) as n from lineitem group by 1,2,3,4) group by 1,2 having sum(n)>1")
def conflicting_runs(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.conflicting_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])


@query("a20_forecast_runs", """with r as (select l_suppkey%3 as model, l_partkey%20 as city, date_trunc('day', l_shipdate) as init, l_quantity as lead, l_partkey%101=0 or l_orderkey%17=0 as off, l_orderkey%29=0 as early, l_linestatus as sha from lineitem),
 k as (select model, city, init, lead, count(*) as n, count(distinct sha)>1 as conflict from r group by 1,2,3,4) select (select count(*) from r) as rows, count(*) as unique_run_keys, sum(n-1)::bigint as duplicate_run_keys, count(*) filter (conflict) as conflicting_run_keys,
 (select count(*) filter (off) from r) as valid_ne_init_plus_lead, (select count(*) filter (early) from r) as ingested_before_initialization from k""")
def forecast_runs(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem").withColumn("init", F.date_trunc("day", F.col("l_shipdate").cast("timestamp")))
    order, lead = F.col("l_orderkey"), F.col("l_quantity")

    def later(hours: Column) -> Column:
        return F.timestamp_micros(F.unix_micros("init") + (hours * F.lit(3.6e9)).cast("long"))

    return quality.forecast_run_audit(line.select(
        (F.col("l_suppkey") % 3).alias("model"), (F.col("l_partkey") % 20).alias("city"), F.col("init").alias("initialization_time"), lead.alias("lead_hours"),
        F.when(F.col("l_partkey") % 101 != 0, later(F.when(order % 17 == 0, lead + 1).otherwise(lead))).alias("valid_time"),
        later(F.when(order % 29 == 0, F.lit(-1)).otherwise(F.lit(3))).alias("ingested_at"), F.col("l_linestatus").alias("sha256")))


# ---------------------------------------------------------------- sorts and sets

@query("t01_total_sort", "select o_custkey, o_orderkey from orders order by o_custkey, o_orderdate, o_orderkey")
def total_sort(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").orderBy("o_custkey", "o_orderdate", "o_orderkey")
    return o.select("o_custkey", "o_orderkey")


@query("t02_top_groups", "select o_orderkey from (select *, dense_rank() over (partition by o_custkey order by o_orderdate desc) as r from orders) where r<=3")
def top_groups(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.top_groups(table(spark, sf, "orders"), "o_custkey", "o_orderdate", 3).select("o_orderkey")


@query("t03_first_examples", with_views(("buckets",), "select bucket_floor_f, bucket_ceil_f, market_ticker from (select *, row_number() over (partition by bucket_floor_f, bucket_ceil_f order by market_ticker) as rn from buckets) where rn=1 order by market_ticker limit 3"))
def first_examples(spark: SparkSession, sf: str) -> DataFrame:
    rows = shapes.buckets(spark, sf).select("bucket_floor_f", "bucket_ceil_f", "market_ticker")
    return aggregates.first_distinct(rows, ["bucket_floor_f", "bucket_ceil_f"], [F.col("market_ticker")], 3)


@query("t04_paging", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey offset 40 limit 25")
def paging(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.page(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 40, 25)


@query("t05_earliest_per_group", f"select o_custkey, arg_min(o_orderkey, row(o_orderdate, o_orderkey)) as o_orderkey, {stamp_sql('min(o_orderdate)')} as first_open from orders group by 1")
def earliest_per_group(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    out = joins.first_by_key(rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return out.select("o_custkey", "o_orderkey", stamp(F.col("o_orderdate")).alias("first_open"))


@query("u01_union_by_name", "select ticker, min(price) as price from (select cast(o_custkey as varchar) as ticker, o_totalprice as price from orders where o_orderstatus='O' union all select 'id' || o_orderkey, o_totalprice from orders where o_orderstatus<>'O') group by 1")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    a = o.where(F.col("o_orderstatus") == "O").select(F.col("o_custkey").cast("string").alias("ticker"), F.col("o_totalprice").alias("price"))
    b = o.where(F.col("o_orderstatus") != "O").select(F.concat(F.lit("id"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_totalprice").alias("price"))
    both = a.unionByName(b, allowMissingColumns=True).withColumn("ticker", F.coalesce("ticker", "id")).drop("id")
    return joins.first_by_key(both, ["ticker"], [F.col("price")])


@query("u02_key_overlap", "with a as (select distinct l_partkey as k from lineitem where l_returnflag='A'), b as (select distinct l_partkey as k from lineitem where l_returnflag<>'A') select count(*) filter (a.k is not null and b.k is not null) as matching, count(*) filter (b.k is null) as left_only, count(*) filter (a.k is null) as right_only from a full join b on a.k=b.k")
def key_overlap(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return joins.key_overlap(li.where(F.col("l_returnflag") == "A"), li.where(F.col("l_returnflag") != "A"), ["l_partkey"])


@query("u03_required_minus_observed", """
 select o_orderkey, n as line from orders, unnest(range(1, 8)) t(n) where not exists (select 1 from lineitem where l_orderkey=o_orderkey and l_linenumber=n)""")
def required_minus_observed(spark: SparkSession, sf: str) -> DataFrame:
    """Of the lines one to seven of every order, those that are not there."""
    required = table(spark, sf, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(7).cast("long"))).alias("line"))
    seen = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("long").alias("line"))
    return required.join(seen, ["o_orderkey", "line"], "left_anti")


@query("u04_pending_keys", "select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def pending_keys(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")
