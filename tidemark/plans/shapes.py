"""Domain views over the supplied tables.

Each view exists twice, as a DataFrame and as the same SELECT in the check SQL; both read whole
tables. Instants are session-UTC timestamps; decimals are written so that both engines see doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clocks
from ..operators import timeline

# Civil zones and standard offsets given to stations by station number modulo five.
ZONES = ("America/New_York", "America/Los_Angeles", "America/Chicago", "America/Phoenix", "UTC")
OFFSETS = (-5, -8, -6, -7, 0)
CITY_NAMES = ("nyc", "la", "austin", "phx", "lv")

# The five whole-degree buckets of each event.
BUCKETS = ((None, 49.0), (50.0, 99.0), (100.0, 149.0), (150.0, 199.0), (200.0, None))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    for field in df.schema.fields:
        if field.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp"))
    return df


def pick(options, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def stamp(instant: Column) -> Column:
    """Fixed-width text of an instant, equal in both engines."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def stamp_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def q6(value: Column, digits: int = 6) -> Column:
    """Round at the edge of a report. The cut lies off the grid of exact ties, where engines differ."""
    scale = F.lit(float(10 ** digits))
    return F.floor(value.cast("double") * scale + F.lit(0.4993)) / scale


def q6_sql(expr: str, digits: int = 6) -> str:
    return f"floor(cast({expr} as double)*1e{digits}+0.4993e0)/1e{digits}"


def minutes(instant: Column, count: Column) -> Column:
    return instant + F.make_dt_interval(F.lit(0), F.lit(0), count.cast("int"))


# ---------------------------------------------------------------- observations and labels

def obs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        "event_id", F.col("user_id").alias("station"),
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("city"),
        F.col("ts").alias("valid_utc"),
        minutes(F.col("ts"), F.col("event_id") % 11).alias("receipt_utc"),
        F.col("value").alias("tmpf"), (F.col("value") * F.lit(0.6)).alias("dwpf"),
        ((F.col("event_id") * 37) % 360).cast("double").alias("drct"),
        ((F.col("event_id") * 7) % 40).cast("double").alias("sknt"),
        F.col("event_type").alias("sky"), F.col("props").alias("raw"),
        F.to_date("ts").alias("local_date"),
    )


OBS = """select event_id, user_id as station, 'c' || user_id as city, ts as valid_utc,
 ts + to_minutes(cast(event_id % 11 as int)) as receipt_utc, value as tmpf, value*0.6e0 as dwpf,
 cast((event_id*37)%360 as double) as drct, cast((event_id*7)%40 as double) as sknt,
 event_type as sky, props as raw, cast(ts as date) as local_date from events"""


def labels_daily(spark: SparkSession, sf: str) -> DataFrame:
    return (
        obs(spark, sf).groupBy("station", "city", F.col("local_date").alias("date"))
        .agg(F.max("tmpf").alias("tmax_f"), F.min("tmpf").alias("tmin_f"))
        .withColumn("label_available_ts", clocks.label_available(F.col("date")))
    )


LABELS_DAILY = """select station, city, local_date as date, max(tmpf) as tmax_f, min(tmpf) as tmin_f,
 local_date + interval 36 hour as label_available_ts from obs group by all"""


def event_ticker(station: Column, day: Column, temp_type: Column) -> Column:
    side = F.upper(F.substring(temp_type, 1, 1))
    return F.concat(
        F.lit("KX"), side, station.cast("string"), F.lit("-"),
        F.upper(F.date_format(day, "yyMMMdd")),
    )


TICKER = "'KX' || upper(substr(temp_type,1,1)) || station || '-' || upper(strftime(date, '%y%b%d'))"


def label_events(spark: SparkSession, sf: str) -> DataFrame:
    """One row per event: both extremes of every station day, with the final value."""
    sides = F.explode(F.array(
        F.struct(F.lit("high").alias("temp_type"), F.col("tmax_f").alias("observed_f")),
        F.struct(F.lit("low").alias("temp_type"), F.col("tmin_f").alias("observed_f")),
    )).alias("side")
    wide = labels_daily(spark, sf).select("station", "city", "date", "label_available_ts", sides)
    return wide.select(
        "station", "city", F.col("date").alias("outcome_local_date"), F.col("side.temp_type"),
        event_ticker(F.col("station"), F.col("date"), F.col("side.temp_type")).alias("event_ticker"),
        "label_available_ts", F.col("side.observed_f"),
    )


LABEL_EVENTS = f"""select station, city, date as outcome_local_date, temp_type, {TICKER} as event_ticker,
 label_available_ts, observed_f from (
 select station, city, date, label_available_ts, 'high' as temp_type, tmax_f as observed_f from labels_daily
 union all select station, city, date, label_available_ts, 'low', tmin_f from labels_daily)"""


def event_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels by event: some are revised a day later, some lack their clock, some lack a value."""
    base = label_events(spark, sf)
    mark = F.col("station") + F.dayofyear("outcome_local_date")
    first = base.select(
        "event_ticker",
        F.when(mark % 19 != 0, F.col("label_available_ts")).alias("label_available_ts"),
        F.when(mark % 23 != 0, F.col("observed_f")).alias("observed_f"),
    )
    revised = base.where(mark % 5 == 0).select(
        "event_ticker", minutes(F.col("label_available_ts"), F.lit(1440)).alias("label_available_ts"),
        (F.col("observed_f") + 1).alias("observed_f"),
    )
    return first.unionByName(revised)


EVENT_LABELS = """select event_ticker,
 case when (station+dayofyear(outcome_local_date))%19<>0 then label_available_ts end as label_available_ts,
 case when (station+dayofyear(outcome_local_date))%23<>0 then observed_f end as observed_f from label_events
 union all select event_ticker, label_available_ts + interval 1440 minute, observed_f+1 from label_events
 where (station+dayofyear(outcome_local_date))%5=0"""


# ---------------------------------------------------------------- forecasts and buckets

def forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Three models per event; some receipts are late or missing, some spreads are missing."""
    base = label_events(spark, sf).withColumn(
        "m", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    ).withColumn("doy", F.dayofyear("outcome_local_date"))
    issue = clocks.shift_hours(F.col("outcome_local_date").cast("timestamp"), F.lit(-12))
    bias = (F.col("station") * 7 + F.col("doy") * 3 + F.col("m") * 5) % 11 - 5
    mark = F.col("station") * 31 + F.col("doy") + F.col("m")
    return base.select(
        "event_ticker", "city", "station", "temp_type", "outcome_local_date",
        F.concat(F.lit("m"), F.col("m").cast("string")).alias("model_name"),
        F.lit("v1").alias("model_version"), (F.col("m") * 6 + 18).cast("double").alias("lead_hours"),
        clocks.shift_hours(F.col("outcome_local_date").cast("timestamp"), F.lit(-6)).alias("decision_time_utc"),
        issue.alias("forecast_issue_time"),
        F.when(mark % 17 == 0, F.lit(None)).when(mark % 13 == 0, minutes(issue, F.lit(720)))
        .otherwise(minutes(issue, F.lit(5))).cast("timestamp").alias("source_receipt_time"),
        (F.col("observed_f") + bias).alias("mean_f"),
        F.when(mark % 7 != 0, (F.col("m") + 2).cast("double")).alias("stddev_f"),
    )


FORECASTS = """select event_ticker, city, station, temp_type, outcome_local_date, 'm' || m as model_name,
 'v1' as model_version, cast(m*6+18 as double) as lead_hours,
 outcome_local_date - interval 6 hour as decision_time_utc,
 outcome_local_date - interval 12 hour as forecast_issue_time,
 case when (station*31+dayofyear(outcome_local_date)+m)%17=0 then null
  when (station*31+dayofyear(outcome_local_date)+m)%13=0 then outcome_local_date - interval 12 hour + interval 720 minute
  else outcome_local_date - interval 12 hour + interval 5 minute end as source_receipt_time,
 observed_f + ((station*7+dayofyear(outcome_local_date)*3+m*5)%11-5) as mean_f,
 case when (station*31+dayofyear(outcome_local_date)+m)%7<>0 then cast(m+2 as double) end as stddev_f
 from label_events, (values (0),(1),(2)) models(m)"""


def buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Five whole-degree buckets per event, settled by the rounded label."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(lo).cast("double").alias("lo"),
                 F.lit(hi).cast("double").alias("hi"))
        for k, (lo, hi) in enumerate(BUCKETS)
    ])).alias("b")
    wide = label_events(spark, sf).select("*", rows)
    value = F.bround("observed_f")
    inside = (F.col("b.lo").isNull() | (value >= F.col("b.lo"))) & (
        F.col("b.hi").isNull() | (value <= F.col("b.hi")))
    return wide.select(
        "event_ticker", F.concat("event_ticker", F.lit("-B"), F.col("b.k").cast("string")).alias("market_ticker"),
        F.concat(F.lit("KX"), F.upper(F.substring("temp_type", 1, 1)), F.col("station").cast("string")).alias("series_ticker"),
        "station", "city", "temp_type", "outcome_local_date",
        F.col("b.lo").alias("bucket_floor_f"), F.col("b.hi").alias("bucket_ceil_f"),
        F.lit("finalized").alias("status"), F.when(inside, "yes").otherwise("no").alias("result"),
    )


BUCKETS_SQL = """select event_ticker, event_ticker || '-B' || k as market_ticker,
 'KX' || upper(substr(temp_type,1,1)) || station as series_ticker, station, city, temp_type, outcome_local_date,
 lo as bucket_floor_f, hi as bucket_ceil_f, 'finalized' as status,
 case when (lo is null or round_even(observed_f,0)>=lo) and (hi is null or round_even(observed_f,0)<=hi)
  then 'yes' else 'no' end as result
 from label_events, (values (0,cast(null as double),49e0),(1,50e0,99e0),(2,100e0,149e0),(3,150e0,199e0),(4,200e0,null)) b(k,lo,hi)"""


# ---------------------------------------------------------------- feature vintages

def decisions(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    made = minutes(F.col("ts"), F.lit(5))
    return e.select(
        "event_id", F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("city"),
        F.concat(F.lit("K"), (F.col("user_id") % 7).cast("string")).alias("contract"),
        F.date_add(F.to_date(made), 1).cast("timestamp").alias("target_time_utc"),
        made.alias("decision_time_utc"),
    )


DECISIONS = """select event_id, 'c' || user_id as city, 'K' || (user_id%7) as contract,
 cast(cast(ts + interval 5 minute as date) + 1 as timestamp) as target_time_utc, ts + interval 5 minute as decision_time_utc from events"""


def feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Observations as feature rows: a third each with an exact clock, a receipt, or only a reference."""
    o = obs(spark, sf)
    kind = F.col("event_id") % 3
    pairs = F.explode(F.array(
        F.struct(F.lit("tmpf").alias("name"), F.col("tmpf").alias("v")),
        F.struct(F.lit("dwpf").alias("name"), F.col("dwpf").alias("v")),
    )).alias("f")
    wide = o.select("*", pairs)
    return wide.select(
        "city", F.concat(F.lit("K"), (F.col("station") % 7).cast("string")).alias("contract"),
        F.date_add("local_date", 1).cast("timestamp").alias("target_time_utc"),
        F.col("f.name").alias("feature_name"), F.col("sky").alias("source"),
        F.col("valid_utc").alias("source_event_time"),
        F.when(F.col("event_id") % 23 == 0, minutes(F.col("receipt_utc"), F.lit(30)))
        .when(F.col("event_id") % 4 != 0, minutes(F.col("valid_utc"), F.lit(-10))).alias("issue_time"),
        F.col("valid_utc").alias("valid_time"),
        F.col("event_id").cast("string").alias("revision"),
        F.when(kind == 0, F.col("receipt_utc")).alias("available_at"),
        F.when(kind == 2, F.col("valid_utc")).alias("availability_reference_time"),
        F.when(kind == 1, F.col("receipt_utc")).alias("retrieved_at"),
        F.col("f.v").cast("string").alias("value"),
        F.concat(F.lit("raw/"), F.col("event_id").cast("string")).alias("provenance"),
    )


FEATURE_ROWS = """select city, 'K' || (station%7) as contract, cast(local_date + 1 as timestamp) as target_time_utc,
 f.name as feature_name, sky as source, valid_utc as source_event_time,
 case when event_id%23=0 then receipt_utc + interval 30 minute when event_id%4<>0 then valid_utc - interval 10 minute end as issue_time,
 valid_utc as valid_time, cast(event_id as varchar) as revision,
 case when event_id%3=0 then receipt_utc end as available_at,
 case when event_id%3=2 then valid_utc end as availability_reference_time,
 case when event_id%3=1 then receipt_utc end as retrieved_at,
 case when f.name='tmpf' then tmpf else dwpf end as value_f, 'raw/' || event_id as provenance
 from obs, (values ('tmpf'),('dwpf')) f(name)"""

# Seconds of assumed latency; ``view`` has no policy of its own and falls to ``*``.
POLICIES = (
    ("error", "base", 120.0), ("click/tmpf", "base", 60.0), ("click", "base", 300.0),
    ("*", "base", 600.0), ("*", "conservative", 1800.0),
)


# ---------------------------------------------------------------- ensemble members

def members(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    c = F.col("l_suppkey") % 50
    run = F.date_sub(F.to_date("l_shipdate"), 2).cast("timestamp")
    return li.select(
        F.concat(F.lit("c"), c.cast("string")).alias("city"), c.alias("city_no"),
        F.lit("gefs").alias("model"), run.alias("forecast_run_time"),
        clocks.shift_hours(F.col("l_shipdate"), F.col("l_orderkey") % 30).alias("valid_time"),
        F.concat(F.lit("m"), F.col("l_linenumber").cast("string")).alias("member_id"),
        F.lit("temperature_2m").alias("variable"),
        (F.col("l_quantity") + F.col("l_tax") * 100).alias("value"),
        minutes(run, c * 40).alias("retrieved_at"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    )


MEMBERS = """select 'c' || (l_suppkey%50) as city, l_suppkey%50 as city_no, 'gefs' as model,
 cast(cast(l_shipdate as date) - 2 as timestamp) as forecast_run_time,
 l_shipdate + to_hours(cast(l_orderkey%30 as int)) as valid_time, 'm' || l_linenumber as member_id,
 'temperature_2m' as variable, l_quantity + l_tax*100 as value,
 cast(cast(l_shipdate as date) - 2 as timestamp) + to_minutes(cast((l_suppkey%50)*40 as int)) as retrieved_at,
 l_orderkey, l_partkey, l_suppkey, l_linenumber from lineitem"""


# ---------------------------------------------------------------- market data

def candles(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    ask = F.lit(0.05) + (F.col("o_orderkey") % 90) / F.lit(100.0)
    rows = o.select(
        F.col("o_custkey").alias("market_ticker"), F.col("o_orderdate").alias("end_period_ts"),
        (ask - F.lit(0.02)).alias("yes_bid_close"), ask.alias("yes_ask_close"),
        (ask + F.lit(0.01)).alias("yes_ask_open"), (ask + F.lit(0.03)).alias("yes_ask_high"),
        "o_orderkey",
    )
    return timeline.keep_latest(rows, ["market_ticker", "end_period_ts"], [F.col("o_orderkey")])


CANDLES = """select market_ticker, end_period_ts, ask-0.02e0 as yes_bid_close, ask as yes_ask_close,
 ask+0.01e0 as yes_ask_open, ask+0.03e0 as yes_ask_high, o_orderkey from (
 select o_custkey as market_ticker, o_orderdate as end_period_ts, max(o_orderkey) as o_orderkey,
 0.05e0 + (max(o_orderkey)%90)/100e0 as ask from orders group by 1,2)"""


def signals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("signal_id"), F.col("o_custkey").alias("market_ticker"),
        clocks.shift_hours(F.col("o_orderdate"), F.lit(12)).alias("decision_time_utc"),
        ((F.col("o_orderkey") * 31 % 97) / F.lit(100.0)).alias("bucket_probability"),
    )


SIGNALS = """select o_orderkey as signal_id, o_custkey as market_ticker, o_orderdate + interval 12 hour as decision_time_utc,
 (o_orderkey*31%97)/100e0 as bucket_probability from orders"""


def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Two thirds of the markets have settled."""
    c = table(spark, sf, "customer")
    return c.where(F.col("c_custkey") % 3 != 2).select(
        F.col("c_custkey").alias("market_ticker"),
        F.when(F.col("c_custkey") % 3 == 0, "yes").otherwise("no").alias("settled_yes"),
    )


OUTCOMES = """select c_custkey as market_ticker, case when c_custkey%3=0 then 'yes' else 'no' end as settled_yes
 from customer where c_custkey%3<>2"""


def book_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Order-book frames: three subscriptions, lost frames, a stale repeat now and then."""
    e = table(spark, sf, "events").select(
        "event_id", F.col("ts").alias("received_ts"), F.col("user_id").alias("market_ticker"),
        (F.col("user_id") % 3).alias("sid"), F.lit(1).alias("connection_epoch"),
        (F.when(F.col("event_id") % 101 == 0, 2).otherwise(1)).alias("step"),
    )
    numbered = timeline.running_scan(
        e, ["sid"], ["received_ts", "event_id"], {"n": timeline.Running("sum", F.col("step"))},
        timeline.time_segment("received_ts"),
    )
    return numbered.select(
        "event_id", "received_ts", "market_ticker", "sid", "connection_epoch",
        (F.col("n") - F.when(F.col("event_id") % 67 == 0, 2).otherwise(0)).cast("long").alias("seq"),
        F.when(F.col("event_id") % 5 == 0, "orderbook_snapshot").otherwise("orderbook_delta").alias("type"),
        F.when(F.col("event_id") % 2 == 0, "yes").otherwise("no").alias("side"),
        (F.col("event_id") % 4 + 40).cast("int").alias("price"),
        (F.col("event_id") * 13 % 9 - 4).cast("double").alias("delta"),
        F.array(
            F.struct((F.col("event_id") % 4 + 40).cast("int").alias("price"), (F.col("event_id") % 7 + 1).cast("double").alias("qty")),
            F.struct(F.lit(39).alias("price"), (F.col("event_id") % 5).cast("double").alias("qty")),
        ).alias("yes"),
        F.array(
            F.struct((F.col("event_id") % 3 + 50).cast("int").alias("price"), (F.col("event_id") % 6 + 1).cast("double").alias("qty")),
        ).alias("no"),
    )


BOOK = """select event_id, ts as received_ts, user_id as market_ticker, user_id%3 as sid, 1 as connection_epoch,
 cast(sum(case when event_id%101=0 then 2 else 1 end) over (partition by user_id%3 order by ts, event_id rows unbounded preceding)
  - case when event_id%67=0 then 2 else 0 end as bigint) as seq,
 case when event_id%5=0 then 'orderbook_snapshot' else 'orderbook_delta' end as type,
 case when event_id%2=0 then 'yes' else 'no' end as side, cast(event_id%4+40 as int) as price,
 cast(event_id*13%9-4 as double) as delta from events"""


def returns(spark: SparkSession, sf: str) -> DataFrame:
    """Daily mean returns of three strategies, each numbered from 0 over its own days."""
    daily = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("strategy"), F.to_date("l_shipdate").alias("day")).agg(
        F.avg((F.col("l_discount") - F.lit(0.05)) / 10).alias("value"))
    numbered = timeline.row_numbers(daily, ["strategy"], ["day"], F.trunc("day", "year"), "position")
    return numbered.select((F.col("position") - 1).alias("t"), "day", "strategy", "value")


RETURNS = """select row_number() over (partition by strategy order by day)-1 as t, day, strategy, value from (
 select l_returnflag as strategy, cast(l_shipdate as date) as day, avg((l_discount-0.05e0)/10) as value from lineitem group by 1,2)"""


def common_returns(spark: SparkSession, sf: str) -> DataFrame:
    """The same on the days that all three traded, as a comparison of strategies needs them."""
    daily = returns(spark, sf)
    shared = daily.groupBy("day").agg(F.count(F.lit(1)).alias("n")).where("n = 3").select("day")
    numbered = timeline.row_numbers(daily.join(shared, "day").drop("t"), ["strategy"], ["day"], F.trunc("day", "year"), "position")
    return numbered.select((F.col("position") - 1).alias("t"), "strategy", "value")


COMMON_RETURNS = """select row_number() over (partition by strategy order by day)-1 as t, strategy, value from (
 select *, count(*) over (partition by day) as n from returns) where n=3"""


VIEWS = {
    "obs": (OBS, ()),
    "labels_daily": (LABELS_DAILY, ("obs",)),
    "label_events": (LABEL_EVENTS, ("labels_daily",)),
    "event_labels": (EVENT_LABELS, ("label_events",)),
    "forecasts": (FORECASTS, ("label_events",)),
    "buckets": (BUCKETS_SQL, ("label_events",)),
    "decisions": (DECISIONS, ()),
    "feature_rows": (FEATURE_ROWS, ("obs",)),
    "members": (MEMBERS, ()),
    "candles": (CANDLES, ()),
    "signals": (SIGNALS, ()),
    "outcomes": (OUTCOMES, ()),
    "book": (BOOK, ()),
    "returns": (RETURNS, ()),
    "common_returns": (COMMON_RETURNS, ("returns",)),
}


def with_views(names: tuple[str, ...], body: str, *extra: tuple[str, str]) -> str:
    """Check SQL: the needed views as common table expressions before ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for parent in VIEWS[name][1]:
            visit(parent)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{name} as ({VIEWS[name][0]})" for name in ordered]
    parts += [f"{name} as ({sql})" for name, sql in extra]
    body = body.strip()
    if body.startswith(","):
        return f"with {', '.join(parts)} {body}"
    return f"with {', '.join(parts)} {body}" if parts else body
