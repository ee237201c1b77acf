"""Source and function queries. Archives are derived from the supplied tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clocks, encode, numeric, text
from ..operators import units
from ..session import ensure_checkpoint_dir
from ..sources import json_products, tables, text_products
from . import shapes
from .model_queries import cdf_sql, crps_sql
from .registry import query
from .shapes import q6, q6_sql, stamp, stamp_sql, table, with_views

def count_rows() -> Column:
    return F.count(F.lit(1))


def folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/archive-{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- scans and sinks

@query("s01_s16_csv_round_trip", "select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, cast(o_custkey as varchar) as o_custkey from orders")
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "csv")
    tables.write_csv(table(spark, sf, "orders"), path, ["o_orderkey", "o_custkey", "o_orderstatus"])
    return tables.read_csv(spark, path, ["o_orderkey", "o_custkey", "o_orderstatus"])


@query("s02_pruned_parquet_counts", "select l_returnflag as variable, count(*) as rows from lineitem group by 1")
def pruned_parquet_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_parquet_fields(spark, f"{sf}/lineitem.parquet", "l_returnflag").withColumnRenamed("l_returnflag", "variable")


def frame_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Capture lines of three kinds: message object, raw text, bare record; some are broken."""
    e = table(spark, sf, "events")
    k = F.col("event_id")
    body = F.to_json(F.struct(
        F.when(k % 5 == 0, "orderbook_snapshot").otherwise("orderbook_delta").alias("type"), (F.col("user_id") % 3).alias("sid"), k.alias("seq"),
        F.struct(F.col("user_id").cast("string").alias("market_ticker"), F.lit("yes").alias("side"), F.lit("40").alias("price"), F.col("value").cast("string").alias("delta"),
                 F.unix_millis("ts").alias("ts_ms")).alias("msg")))
    received = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    line = (
        F.when(k % 97 == 0, F.lit("{broken")).when(k % 3 == 0, F.concat(F.lit('{"connection_epoch":1,"received_at":"'), received, F.lit('","message":'), body, F.lit("}")))
        .when(k % 3 == 1, F.to_json(F.struct(F.lit(1).alias("connection_epoch"), received.alias("received_at"), body.alias("raw_json")))).otherwise(body))
    return e.select("event_id", line.alias("value"))


@query("s03_jsonl_unwrap", "select case when event_id%97=0 then '' else case when event_id%5=0 then 'orderbook_snapshot' else 'orderbook_delta' end end as type, event_id%97<>0 as valid, count(*) as n from events group by 1,2")
def jsonl_unwrap(spark: SparkSession, sf: str) -> DataFrame:
    out = json_products.unwrap_messages(frame_lines(spark, sf))
    return out.groupBy(F.coalesce("message.type", F.lit("")).alias("type"), "valid").agg(count_rows().alias("n"))


@query("s04_nested_markets", """select o_custkey::varchar as event_ticker, o_orderkey::varchar as market_ticker, round_even((o_orderkey%50/100e0+(o_orderkey%50+2+2*(o_orderkey%3))/100e0)/2,2) as mid_price, 'S' || o_custkey%9 as series_title from orders""")
def nested_markets(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    m = F.struct(k.cast("string").alias("ticker"), (k % 50 / F.lit(100.0)).cast("string").alias("yes_bid_dollars"), ((k % 50 + 2 + k % 3 * 2) / F.lit(100.0)).cast("string").alias("yes_ask_dollars"))
    # An event nests its own markets; the archive is written as one JSON document per event.
    docs = o.groupBy("o_custkey").agg(F.to_json(F.struct(
        F.first(F.col("o_custkey").cast("string")).alias("event_ticker"), F.concat(F.lit("K"), F.first(F.col("o_custkey") % 9).cast("string")).alias("series_ticker"), F.collect_list(m).alias("markets"))).alias("value"))
    path = folder(spark, "events")
    docs.select("value").write.text(path)
    events = spark.read.schema(json_products.EVENT).json(path)
    series = spark.createDataFrame([(f"K{i}", f"S{i}", ["a", "b"]) for i in range(9)], "ticker string, title string, tags array<string>")
    return json_products.flatten_events(events, series).select("event_ticker", "market_ticker", "mid_price", "series_title")


@query("s05_pipe_observations", with_views(("obs",), f"select station::varchar as station, {q6_sql('case when event_id%13<>0 then tmpf*9/5+32 end', 2)} as temperature_f, case when event_id%13=0 then 'missing_temperature' else 'accepted' end as reason from obs"))
def pipe_observations(spark: SparkSession, sf: str) -> DataFrame:
    rows = shapes.obs(spark, sf).select(
        F.col("station").cast("string").alias("STATION"), F.lit("x").alias("Station_name"), clocks.render_utc(F.col("valid_utc")).alias("DATE"), F.lit("1").alias("LATITUDE"), F.lit("2").alias("LONGITUDE"), F.lit("3").alias("ELEVATION"),
        F.when(F.col("event_id") % 13 == 0, "M").otherwise(F.col("tmpf").cast("string")).alias("temperature"), F.col("dwpf").cast("string").alias("dew_point_temperature"))
    path = folder(spark, "pipe")
    rows.write.option("sep", "|").option("header", True).csv(path)
    good, bad = text_products.pipe_observations(tables.read_csv(spark, path, rows.columns, sep="|"))
    both = good.select("station", "temperature_f", F.lit("accepted").alias("reason")).unionByName(bad.select("station", "temperature_f", "reason"))
    return both.select("station", q6(F.col("temperature_f"), 2).alias("temperature_f"), "reason")


@query("s06_monthly_records", with_views(("labels_daily",), f"select 'US' || lpad(station::varchar,9,'0') as station_id, cast(date as varchar) as date, {q6_sql('round_even(tmax_f,0)/10', 4)} as value_c from labels_daily"))
def monthly_records(spark: SparkSession, sf: str) -> DataFrame:
    l = shapes.labels_daily(spark, sf).withColumn("month", F.date_format("date", "yyyyMM"))
    cell = F.rpad(F.lpad(F.bround("tmax_f").cast("int").cast("string"), 5, " "), 8, " ")
    days = l.groupBy("station", "month").agg(F.map_from_entries(F.collect_list(F.struct(F.day("date").alias("d"), cell.alias("c")))).alias("m"))
    cells = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(31)), lambda d: F.coalesce(F.try_element_at("m", d), F.lit("-9999   "))), "")
    lines = days.select(F.concat(F.lit("US"), F.lpad(F.col("station").cast("string"), 9, "0"), "month", F.lit("TMAX"), cells).alias("value"))
    out = text_products.monthly_records(lines)
    return out.select("station_id", F.col("date").cast("string").alias("date"), q6(F.col("value_c"), 4).alias("value_c"))


@query("s07_whitespace_tables", "select 'S' || s_suppkey as station_id, s_nationkey+0.5e0 as lat, -(s_nationkey+0.25e0) as lon, 'NAME ' || s_suppkey as name from supplier")
def whitespace_tables(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    lines = s.select(F.concat_ws("  ", F.concat(F.lit("S"), "s_suppkey"), (F.col("s_nationkey") + 0.5).cast("string"), (-(F.col("s_nationkey") + 0.25)).cast("string"), F.lit("12.0"), F.lit("AZ"), F.concat(F.lit("NAME "), "s_suppkey")).alias("value"))
    return text_products.station_lines(lines).select("station_id", "lat", "lon", "name")


@query("s08_station_bulletins", with_views(("obs",), f"""select event_id, {stamp_sql("valid_utc")} as valid, f.field, case when f.field='TMP' then cast(event_id%90 as double) else cast(event_id%40 as double) end as value from (
 select event_id, date_trunc('hour', valid_utc) + to_hours(h.h) as valid_utc from obs, (values (1),(2)) h(h)), (values ('TMP'),('DPT')) f(field)"""))
def station_bulletins(spark: SparkSession, sf: str) -> DataFrame:
    o = shapes.obs(spark, sf)
    hour = F.hour("valid_utc")

    def two(n: int):
        return F.lpad(((hour + n) % 24).cast("string"), 2, "0")

    body = F.concat(
        F.lit("KAAA GFS LAMP GUIDANCE "), F.date_format("valid_utc", "M/dd/yyyy HH"), F.lit("00 UTC\n UTC "), two(1), F.lit(" "), two(2),
        F.lit("\n TMP "), (F.col("event_id") % 90).cast("string"), F.lit(" "), (F.col("event_id") % 90).cast("string"),
        F.lit("\n DPT "), (F.col("event_id") % 40).cast("string"), F.lit(" "), (F.col("event_id") % 40).cast("string"))
    named = o.select(F.col("event_id").cast("string").alias("file_name"), body.alias("text"))
    return text_products.station_bulletins(named).select(
        F.col("file_name").cast("long").alias("event_id"), stamp(F.col("valid_time_utc")).alias("valid"), "field", "value")


@query("s09_climate_products", with_views(("labels_daily",), f"select city, cast(date as varchar) as climate_date, cast(round_even(tmax_f,0) as int) as high, case when station%4=0 then -999 else cast(round_even(tmin_f,0) as int) end as low, {stamp_sql('date + interval 26 hour')} as published from labels_daily"))
def climate_products(spark: SparkSession, sf: str) -> DataFrame:
    l = shapes.labels_daily(spark, sf)
    low = F.when(F.col("station") % 4 == 0, "MM").otherwise(F.bround("tmin_f").cast("int").cast("string"))
    body = F.concat(F.lit("CLIMATE REPORT\n...SUMMARY FOR "), F.upper(F.date_format("date", "MMMM d yyyy")), F.lit("...\nTEMPERATURE (F)\n  MAXIMUM   "), F.bround("tmax_f").cast("int").cast("string"), F.lit("   1234 PM\n  MINIMUM   "), low, F.lit("\n"))
    name = F.concat(F.lit("CLI_"), F.date_format(clocks.shift_hours(F.col("date").cast("timestamp"), F.lit(26)), "yyyyMMddHHmm"), F.lit(".txt"))
    out = text_products.climate_products(l.select("city", name.alias("file_name"), body.alias("text")))
    return out.select("city", F.col("climate_date").cast("string").alias("climate_date"), F.col("official_daily_high_f").alias("high"), F.coalesce("official_daily_low_f", F.lit(-999)).alias("low"), stamp(F.col("publication_time_utc")).alias("published"))


METAR_SQL = """select station, date_trunc('minute', valid_utc) as v, arg_min(row(case when event_id%10=0 then null else tmpf end, event_id), event_id) as r from obs group by 1,2"""


@query("s10_metar_rows", with_views(("obs",), f"""select station::varchar as station, {stamp_sql('v')} as valid_utc, cast(cast((v at time zone 'UTC') at time zone 'America/Phoenix' as date) as varchar) as local_date, {q6_sql('coalesce(r[1],-999)')} as tmpf, (case when r[2]%2=0 then 1 else -1 end)*(r[2]%300)/10e0 as remark_temp from ({METAR_SQL})"""))
def metar_rows(spark: SparkSession, sf: str) -> DataFrame:
    o = shapes.obs(spark, sf)
    k = F.col("event_id")
    group = F.concat(F.when(k % 2 == 0, "0").otherwise("1"), F.lpad((k % 300).cast("string"), 3, "0"))
    rows = o.select(
        "event_id", F.col("station").cast("string").alias("station"), F.date_format("valid_utc", "yyyy-MM-dd HH:mm").alias("valid"), F.when(k % 10 == 0, "M").otherwise(F.col("tmpf").cast("string")).alias("tmpf"),
        F.concat(F.lit("KPHX 010000Z RMK AO2 T"), group, group).alias("metar"))
    out = text_products.metar_rows(rows, "America/Phoenix", [F.col("event_id")])
    return out.select("station", stamp(F.col("valid_utc")).alias("valid_utc"), F.col("local_date").cast("string").alias("local_date"), q6(F.coalesce("tmpf", F.lit(-999.0))).alias("tmpf"), F.col("remark_temp_tenths_c").alias("remark_temp"))


@query("s11_member_arrays", "select o_orderkey as id, m.member_id, case when m.i=1 then cast(o_custkey as double) else cast(o_custkey+1 as double) end as value from orders, (values ('member01',1),('member02',2)) m(member_id,i)")
def member_arrays(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    c = F.col("o_custkey")
    doc = F.concat(F.lit('{"hourly":{"time":["2024-01-01T00:00","2024-01-01T01:00"],"temperature_2m_member01":['), c, F.lit(',null],"temperature_2m_member02":['), c + 1, F.lit(",null]}}"))
    return json_products.member_arrays(o.select(F.col("o_orderkey").alias("id"), doc.alias("payload")), ["temperature_2m"]).select("id", "member_id", "value")


@query("s12_station_history", "select s_suppkey as station, r.record_type, case when r.record_type='identifier' then 'N' || s_nationkey else '' end as identifier from supplier, (values ('identifier'),('relocation'),('update')) r(record_type)")
def station_history(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    doc = F.concat(F.lit('{"stationCollection":{"stations":[{"identifiers":[{"idType":"X","id":"N'), "s_nationkey", F.lit('","date":{"beginDate":"2001"}}],"relocations":[{"date":"2002","relocation":"moved"}],"updates":[{"updateSource":"U","effectiveDate":"2003","description":"d"}]}]}}'))
    return json_products.station_history(s.select(F.col("s_suppkey").alias("station"), doc.alias("payload"))).select("station", "record_type", "identifier")


@query("s13_epoch_series", with_views(("obs",), f"select event_id, {stamp_sql('make_timestamp((epoch_us(valid_utc)//1000)*1000)')} as ts, tmpf as value_f from obs"))
def epoch_series(spark: SparkSession, sf: str) -> DataFrame:
    o = shapes.obs(spark, sf)
    doc = F.concat(F.lit('{"city":"c","timeseries":[{"t":"'), F.unix_millis("valid_utc").cast("string"), F.lit('","v":"'), F.col("tmpf").cast("string"), F.lit('"},{"t":"x","v":"1"}]}'))
    return json_products.epoch_series(o.select("event_id", doc.alias("payload"))).select("event_id", stamp(F.col("timestamp_utc")).alias("ts"), "value_f")


@query("s14_hourly_contracts", "select 'E' || o_orderkey || '-T' || (o_orderkey%90) || '.5' as market_ticker, o_orderkey%90+0.5e0 as threshold_f, case when o_orderkey%2=0 then 'above' else 'below' end as comparison, case when o_orderkey%2=0 then cast(o_orderkey%90+1 as double) else -1e0 end as bucket_floor_f, 'KNYC' as settlement_station from orders")
def hourly_contracts(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    up = k % 2 == 0
    markets = o.select(
        F.concat(F.lit("HOURLY-"), F.col("o_custkey").cast("string")).alias("event_ticker"), F.concat(F.lit("E"), k, F.lit("-T"), k % 90, F.lit(".5")).alias("ticker"),
        F.concat(F.lit("Will it be "), F.when(up, "above").otherwise("below"), F.lit(" x?")).alias("title"), F.concat(k % 90 + 1, F.lit("° or "), F.when(up, "above").otherwise("below")).alias("yes_sub_title"),
        F.lit("").alias("subtitle"), F.lit("").alias("series_ticker"), F.lit("active").alias("status"), F.lit("").alias("result"))
    events = table(spark, sf, "customer").select(
        F.concat(F.lit("HOURLY-"), F.col("c_custkey").cast("string")).alias("event_ticker"), F.lit("2026-09-10T07:00:00Z").alias("strike_date"), F.lit("").alias("sub_title"),
        F.array().cast("array<struct<name:string,url:string>>").alias("settlement_sources"), F.array(F.struct(F.lit("A").alias("name"), F.lit("B").alias("url"))).alias("series_sources"),
        F.lit("u").alias("contract_terms_url"), F.lit("v").alias("contract_url"), F.lit("w").alias("last_updated_ts"))
    out = json_products.hourly_contracts(markets, events, {"HOURLY": "KNYC"})
    return out.select("market_ticker", "threshold_f", "comparison", F.coalesce("bucket_floor_f", F.lit(-1.0)).alias("bucket_floor_f"), "settlement_station")


@query("s15_archived_payloads", "select o_custkey as id, o_orderkey::varchar as ticker, o_totalprice::varchar as price from orders")
def archived_payloads(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    doc = F.to_json(F.struct(F.array(F.struct(F.col("o_orderkey").cast("string").alias("ticker"), F.col("o_totalprice").cast("string").alias("price"))).alias("markets")))
    return json_products.archived_payloads(o.select(F.col("o_custkey").alias("id"), doc.alias("payload")), "$.markets", "ticker:string,price:string").select("id", "ticker", "price")


@query("s17_parquet_append", "select l_orderkey, l_linenumber, min(q) as q from (select l_orderkey, l_linenumber, min(l_quantity) as q from lineitem where l_returnflag='A' group by 1,2 union all select l_orderkey, l_linenumber, 1000+min(l_quantity) from lineitem where l_returnflag<>'A' group by 1,2) group by 1,2")
def parquet_append(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    old = li.where(F.col("l_returnflag") == "A").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("q"))
    new = li.where(F.col("l_returnflag") != "A").groupBy("l_orderkey", "l_linenumber").agg((F.min("l_quantity") + 1000).alias("q"))
    return tables.append_deduplicated(old, new, ["l_orderkey", "l_linenumber"])


@query("s18_twin_output", "select case when o_orderstatus='P' then 'rejected' else 'accepted' end as side, count(*) as n from orders group by 1")
def twin_output(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("reason", F.when(F.col("o_orderstatus") == "P", "pending"))
    a, b = folder(spark, "accepted"), folder(spark, "rejected")
    tables.write_twin(o, "reason", a, b)
    both = spark.read.parquet(a).select(F.lit("accepted").alias("side")).unionByName(spark.read.parquet(b).select(F.lit("rejected").alias("side")))
    return both.groupBy("side").agg(count_rows().alias("n"))


@query("s19_keyed_store", "select o_custkey, coalesce(arg_max(nullif(case when o_orderkey%3=0 then '' else o_orderpriority end,''), o_orderkey) filter (o_orderkey=m), '-') as priority from (select *, max(o_orderkey) over (partition by o_custkey) as m from orders) group by 1")
def keyed_store(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("priority"))
    path = folder(spark, "store")
    tables.save_keyed(o, path, ["o_custkey"], [F.col("o_orderkey")])
    return spark.read.parquet(path).select("o_custkey", F.coalesce("priority", F.lit("-")).alias("priority"))


@query("s20_incremental_merge", "select text_sha, min(doc_id) as doc_id from (select sha256(text) as text_sha, doc_id from documents) group by 1")
def incremental_merge(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(F.sha2("text", 256).alias("text_sha"), "doc_id")
    single = d.groupBy("text_sha").agg(F.min("doc_id").alias("doc_id"))
    return tables.merge_rows(single, d.withColumn("doc_id", F.col("doc_id") + 1000000000), ["text_sha"], first_wins=True)


@query("s21_glob_union", "select event_type as file_part, count(*) as n from events group by 1")
def glob_union(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "glob")
    table(spark, sf, "events").select("event_id", "event_type").write.partitionBy("event_type").option("header", True).csv(path)
    out = tables.read_csv_glob(spark, f"{path}/*/*.csv", ["event_id"], r"event_type=([a-z]+)/")
    return out.groupBy("file_part").agg(count_rows().alias("n"))


@query("s22_model_runs", "select substr(sha256(provider || '|' || model || '|' || init || '|' || raw),1,32) as run_id, min(provider) as provider from (select 'GFS' as provider, 'm' || o_custkey%5 as model, strftime(o_orderdate,'%Y-%m-%d') as init, 'raw/' || o_orderstatus as raw from orders union all select 'LAMP', 'm' || o_custkey%5, strftime(o_orderdate,'%Y-%m-%d'), 'raw/' || o_orderpriority from orders) group by 1")
def model_runs(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")

    def manifest(raw: str) -> DataFrame:
        return o.select(F.concat(F.lit("m"), (F.col("o_custkey") % 5).cast("string")).alias("model"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("initialization_time_utc"),
                        F.concat(F.lit("raw/"), raw).alias("raw_path"), F.lit("h").alias("sha256"), F.col("o_orderdate").alias("retrieved_at"))

    return tables.model_runs([("GFS", manifest("o_orderstatus")), ("LAMP", manifest("o_orderpriority"))]).select("run_id", "provider")


@query("s23_table_counts", "select 'orders' as table_name, count(*) as rows, count(distinct o_custkey) as keys from orders union all select 'lineitem', count(*), count(distinct (l_orderkey, l_linenumber)) from lineitem")
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table_counts({"orders": (table(spark, sf, "orders"), ["o_custkey"]), "lineitem": (table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])})


# ---------------------------------------------------------------- functions

ZONE_SQL = "case station%5 when 0 then 'America/New_York' when 1 then 'America/Los_Angeles' when 2 then 'America/Chicago' when 3 then 'America/Phoenix' else 'UTC' end"


@query("f01_number_parse", "select event_id, case when event_id%6=0 then -1e0 when event_id%6=1 then -1e0 else value end as v from events")
def number_parse(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    raw = F.when(k % 6 == 0, "M").when(k % 6 == 1, "12abc").otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    return table(spark, sf, "events").select("event_id", F.coalesce(clocks.to_number(raw), F.lit(-1.0)).alias("v"))


@query("f02_iso_parse", f"select event_id, case when event_id%5=0 then 'bad' when event_id%5=1 then {stamp_sql('ts - interval 2 hour')} else {stamp_sql('ts')} end as parsed from events")
def iso_parse(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    raw = F.when(k % 5 == 0, "soon").when(k % 5 == 1, F.concat(base, F.lit("+02:00"))).when(k % 5 == 2, base).otherwise(F.concat(base, F.lit("Z")))
    return table(spark, sf, "events").select("event_id", F.coalesce(stamp(clocks.parse_utc(raw)), F.lit("bad")).alias("parsed"))


@query("f03_civil_clock", with_views(("obs",), f"select event_id, cast(cast((valid_utc at time zone 'UTC') at time zone {ZONE_SQL} as date) as varchar) as local_date, cast(hour((valid_utc at time zone 'UTC') at time zone {ZONE_SQL}) as int) as local_hour from obs"))
def civil_clock(spark: SparkSession, sf: str) -> DataFrame:
    zone = shapes.pick(shapes.ZONES, F.col("station") % 5)
    return shapes.obs(spark, sf).select("event_id", clocks.local_date(F.col("valid_utc"), zone).cast("string").alias("local_date"), clocks.local_hour(F.col("valid_utc"), zone).alias("local_hour"))


@query("f04_standard_window", f"select o_orderkey, {stamp_sql('cast(o_orderdate as date) + to_hours(cast(7+o_orderkey%2 as int))')} as window_start from orders")
def standard_window(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", stamp(clocks.standard_window_start(F.to_date("o_orderdate"), -(F.col("o_orderkey") % 2 + 7))).alias("window_start"))


@query("f05_ticker_date", "select o_orderkey, case when o_orderkey%7=0 then 'none' when year(o_orderdate)<2000 then cast(cast(o_orderdate as date) + interval 100 year as date)::varchar else cast(o_orderdate as date)::varchar end as d from orders")
def ticker_date(spark: SparkSession, sf: str) -> DataFrame:
    tick = F.when(F.col("o_orderkey") % 7 == 0, "KX-26XXX10").otherwise(F.concat(F.lit("KX-"), F.upper(F.date_format("o_orderdate", "yyMMMdd"))))
    return table(spark, sf, "orders").select("o_orderkey", F.coalesce(clocks.ticker_date(tick).cast("string"), F.lit("none")).alias("d"))


@query("f06_bucket_text", "select o_orderkey, case o_orderkey%4 when 0 then cast(o_orderkey%90 as double) when 1 then -1e0 when 2 then cast(o_orderkey%90 as double) else -1e0 end as lo, case o_orderkey%4 when 0 then cast(o_orderkey%90+1 as double) when 1 then cast(o_orderkey%90 as double) when 2 then -1e0 else cast(o_orderkey%90 as double) end as hi from orders")
def bucket_text(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    n = (k % 90).cast("string")
    sub = F.when(k % 4 == 0, F.concat(n, F.lit("° to "), (k % 90 + 1).cast("string"), F.lit("°"))).when(k % 4 == 1, F.concat(n, F.lit("° or below"))).when(k % 4 == 2, F.concat(n, F.lit("° or above")))
    b = text.bucket_bounds(sub, F.concat(F.lit("Low below "), n))
    return table(spark, sf, "orders").select("o_orderkey", F.coalesce(b["floor"], F.lit(-1.0)).alias("lo"), F.coalesce(b["ceil"], F.lit(-1.0)).alias("hi"))


@query("f07_notice_instant", f"select o_orderkey, {stamp_sql('''((cast(cast(o_orderdate as date) as timestamp) + to_hours(cast(13+o_orderkey%5 as int))) at time zone 'America/New_York') at time zone 'UTC' ''')} as effective from orders")
def notice_instant(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    notice = F.concat(F.lit("Effective Friday, "), F.date_format("o_orderdate", "MMMM d"), F.lit("th, for the "), (k % 5 + 1).cast("string"), F.lit("pm-6pm ET market"))
    return table(spark, sf, "orders").select("o_orderkey", stamp(text.notice_instant(notice, F.year("o_orderdate"))).alias("effective"))


@query("f08_metar_remarks", "select event_id, (case when event_id%2=1 then -1 else 1 end)*(event_id%400)/10e0 as temp_c, cast(event_id%10 as int) as code, (event_id%200)/10e0 as change from events")
def metar_remarks(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    raw = F.concat(F.lit("KPHX 1234Z RMK AO2 T"), (k % 2).cast("string"), F.lpad((k % 400).cast("string"), 3, "0"), F.lit("0100 5"), (k % 10).cast("string"), F.lpad((k % 200).cast("string"), 3, "0"))
    r = text.metar_remarks(raw)
    return table(spark, sf, "events").select("event_id", r["remark_temp_tenths_c"].alias("temp_c"), r["remark_pressure_tendency_code"].alias("code"), r["remark_pressure_change_tenths_hpa"].alias("change"))


@query("f09_source_literal", "select c_custkey, case when c_custkey%2=0 then 'N' || c_nationkey else 'plain' end as name, case when c_custkey%2=0 then 'http://x/' || c_custkey else '' end as url from customer")
def source_literal(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("{'name': 'N"), "c_nationkey", F.lit("', 'url': 'http://x/"), "c_custkey", F.lit("'}"))).otherwise("plain")
    s = text.source_name_url(raw)
    return table(spark, sf, "customer").select("c_custkey", s["name"].alias("name"), s["url"].alias("url"))


# Factor and offset by variable code.
UNITS = (("2t", 1.8, -459.67), ("10u", 2.2369362920544, 0.0), ("prmsl", 0.01, 0.0), ("cape", 1.0, 0.0))


@query("f10_unit_conversion", f"select l_orderkey, l_linenumber, count(*) as n, {q6_sql('sum(case l_linenumber%4 when 0 then (l_extendedprice-273.15e0)*9/5+32 when 1 then l_extendedprice*2.2369362920544e0 when 2 then l_extendedprice/100 else l_extendedprice end)', 2)} as total from lineitem group by 1,2")
def unit_conversion(spark: SparkSession, sf: str) -> DataFrame:
    units = spark.createDataFrame(UNITS, "code string, scale double, shift double")
    li = table(spark, sf, "lineitem").withColumn("code", shapes.pick([u[0] for u in UNITS], F.col("l_linenumber") % 4))
    return li.join(F.broadcast(units), "code").groupBy("l_orderkey", "l_linenumber").agg(count_rows().alias("n"), q6(F.sum(F.col("l_extendedprice") * F.col("scale") + F.col("shift")), 2).alias("total"))


POINT_CODES = ["2t", "10u", "10v", "u", "v", "t", "gh", "zz"]


@query("f10_point_variables", f"""with r as (select l_suppkey as k, date_trunc('month', l_shipdate) as m, ['2t','10u','10v','u','v','t','gh','zz'][l_partkey%8+1] as code, [0,500,700,850][l_linenumber%4+1] as level, l_extendedprice as x from lineitem),
 d as (select k, m, case when code='2t' then 'temperature_2m' when code in ('10u','10v') then 'wind_' || code[3] || '_10m' when code in ('u','v') then 'wind_' || code || case when level=850 then '_850hpa' else '_pressure_level' end
  when code='gh' then 'geopotential_height_' || case when level=500 then '500hpa' else 'pressure_level' end else 'temperature_' || case when level in (700,850,925) then level || 'hpa' else 'pressure_level' end end as variable,
  case when code in ('2t','t') then 'F' when code='gh' then 'gpm' else 'mph' end as unit, case when code in ('2t','t') then (x-273.15e0)*9/5+32 when code='gh' then x else x*2.2369362920544e0 end as value from r where code<>'zz'),
 p as (select max(value) filter (variable='wind_u_10m') as u, max(value) filter (variable='wind_v_10m') as v, max(value) filter (variable='wind_u_850hpa') as u8, max(value) filter (variable='wind_v_850hpa') as v8 from d group by k, m),
 a as (select variable, unit, value from d union all select 'wind_speed_10m', 'mph', sqrt(u*u+v*v) from p where u is not null and v is not null union all select 'wind_850hpa', 'mph', sqrt(u8*u8+v8*v8) from p where u8 is not null and v8 is not null)
 select variable, unit, count(*) as n, {q6_sql('avg(value)', 3)} as mean from a group by 1,2""")
def point_variables(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("k"), F.date_trunc("month", "l_shipdate").alias("m"), shapes.pick(POINT_CODES, F.col("l_partkey") % 8).alias("code"),
        shapes.pick(["0", "500", "700", "850"], F.col("l_linenumber") % 4).cast("int").alias("level"), F.col("l_extendedprice").alias("value"))
    out = units.add_speeds(units.point_variables(points), ["k", "m"])
    return out.groupBy("variable", "unit").agg(count_rows().alias("n"), q6(F.avg("value"), 3).alias("mean"))


@query("f11_whole_degree", "select event_id, cast(case when value-50>=0 then floor(value-50+0.5e0) else ceil(value-50-0.5e0) end as bigint) as degree from events")
def whole_degree(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", numeric.whole_degree(F.col("value") - 50).alias("degree"))


@query("f12_normal_cdf", f"select event_id, {q6_sql(cdf_sql('((value-40e0)/15e0)'), 9)} as p from events")
def normal_cdf(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", q6(numeric.gaussian_cdf(F.col("value"), F.lit(40.0), F.lit(15.0)), 9).alias("p"))


#: The normal CDF by its power series, independent of the library's rational form.
SERIES_CDF = """0.5e0 + sign(z)*exp(-z*z/2)/sqrt(2*pi())*list_sum(list_transform(range(0, 70), lambda k: exp((2*k+1)*ln(abs(z)) - (lgamma(2*k+2) - k*ln(2) - lgamma(k+1)))))"""


@query("f12_normal_quantile", f"""
 with recursive b as (select (k+1)/1000e0 as p, -4e0 as lo, 4.1e0 as hi, 0 as i from range(999) t(k)
  union all select p, case when f<p then z else lo end, case when f<p then hi else z end, i+1 from (select *, {SERIES_CDF} as f from (select *, (lo+hi)/2 as z from b where i<48)))
 select o_orderkey, {q6_sql('(lo+hi)/2', 7)} as z from orders join b on p=(o_orderkey%999+1)/1000e0 where i=48""")
def normal_quantile(spark: SparkSession, sf: str) -> DataFrame:
    p = (F.col("o_orderkey") % 999 + 1) / F.lit(1000.0)
    return table(spark, sf, "orders").select("o_orderkey", q6(numeric.norm_quantile(p), 7).alias("z"))


PHOENIX = (33.4278, -112.0036)


@query("f14_solar_day", f"""
 with d as (select distinct cast(o_orderdate as date) as d from orders), g as (select d, (dayofyear(d)-1)*2*pi()/365 as g from d),
 s as (select d, 229.18*(0.000075+0.001868*cos(g)-0.032077*sin(g)-0.014615*cos(2*g)-0.040849*sin(2*g)) as eq,
  0.006918-0.399912*cos(g)+0.070257*sin(g)-0.006758*cos(2*g)+0.000907*sin(2*g)-0.002697*cos(3*g)+0.00148*sin(3*g) as dec from g),
 h as (select d, 720-4*({PHOENIX[1]})-eq as noon, degrees(acos(cos(radians(90.833))/(cos(radians({PHOENIX[0]}))*cos(dec))-tan(radians({PHOENIX[0]}))*tan(dec))) as ha from s)
 select d::varchar as day, {q6_sql('noon', 4)} as noon, {q6_sql('noon-4*ha', 4)} as sunrise, {q6_sql('noon+4*ha', 4)} as sunset, {q6_sql('8*ha', 4)} as daylength from h""")
def solar_day(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    sun = numeric.solar_day(F.col("d"), F.lit(PHOENIX[0]), F.lit(PHOENIX[1]))
    return days.select(F.col("d").cast("string").alias("day"), q6(sun["noon_min"], 4).alias("noon"), q6(sun["sunrise_min"], 4).alias("sunrise"),
                       q6(sun["sunset_min"], 4).alias("sunset"), q6(sun["daylength_min"], 4).alias("daylength"))


@query("f15_solar_position", f"select event_id, {q6_sql('degrees(asin(sin(radians(33e0))*sin(radians(23.44e0)*sin(radians((dayofyear(ts)+284)*360e0/365e0)))+cos(radians(33e0))*cos(radians(23.44e0)*sin(radians((dayofyear(ts)+284)*360e0/365e0)))*cos(radians(15*(hour(ts)+minute(ts)/60e0+second(ts)/3600e0-112e0/15e0-12)))))', 5)} as elevation from events")
def solar_position(spark: SparkSession, sf: str) -> DataFrame:
    s = numeric.solar_position(F.col("ts"), F.lit(33.0), F.lit(-112.0))
    return table(spark, sf, "events").select("event_id", q6(s["solar_elevation_deg"], 5).alias("elevation"))


@query("f17_scan_angles", f"""
 with p as (select c_custkey, radians(c_custkey%60-30e0) as phi, radians((c_custkey%50-150e0)-(-137e0)) as d, 6378137e0 as a, 6356752.31414e0 as b from customer),
 r as (select *, a*b/sqrt(b*b*cos(phi)*cos(phi)+a*a*sin(phi)*sin(phi)) as r, 35786023e0+a as h from p)
 select c_custkey, {q6_sql('atan((r*cos(phi)*sin(d))/(h-r*cos(phi)*cos(d)))', 9)} as x, {q6_sql('atan(r*sin(phi)/sqrt(pow(h-r*cos(phi)*cos(d),2)+pow(r*cos(phi)*sin(d),2)))', 9)} as y from r""")
def scan_angles(spark: SparkSession, sf: str) -> DataFrame:
    x, y = numeric.scan_angles((F.col("c_custkey") % 60 - 30).cast("double"), (F.col("c_custkey") % 50 - 150).cast("double"), -137.0, 6378137.0, 6356752.31414, 35786023.0)
    return table(spark, sf, "customer").select("c_custkey", q6(x, 9).alias("x"), q6(y, 9).alias("y"))


@query("f18_lead_bucket", "select o_orderkey, cast(round_even((o_orderkey%100)/6e0,0)*6 as int) as bucket, strftime(o_orderdate,'%m') as month from orders")
def lead_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", clocks.lead_bucket((F.col("o_orderkey") % 100).cast("double")).alias("bucket"), F.date_format("o_orderdate", "MM").alias("month"))


@query("f19_content_key", """select o_orderkey, substr(sha256('{"k":' || o_orderkey || ',"s":"' || o_orderstatus || '"}'),1,16) as key from orders""")
def content_key(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    return o.select("o_orderkey", encode.content_key(encode.canonical_json(["s", "k"])).alias("key"))


@query("f20_split_ids", """select o_orderkey, array_to_string(list_filter([case when o_orderkey%2=0 then 'a' end, o_orderkey::varchar, case when o_orderkey%3=0 then 'c d' end, case when o_orderkey%5=0 then o_orderstatus end], lambda x: x is not null), '/') as ids from orders""")
def split_ids(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    raw = F.concat(F.when(k % 2 == 0, F.lit(" a;")).otherwise(" ,"), k.cast("string"), F.lit(" ,|, "), F.when(k % 3 == 0, F.lit("c d ; ")).otherwise(""),
                   F.when(k % 5 == 0, F.concat(F.lit("|"), F.col("o_orderstatus"))).otherwise(";;"))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(encode.split_ids(raw), "/").alias("ids"))


@query("f21_exchange_time", f"select event_id, case when event_id%4=3 then 'none' else {stamp_sql('make_timestamp(case when event_id%4=1 then (epoch_us(ts)//1000000)*1000000 else (epoch_us(ts)//1000)*1000 end)')} end as t from events")
def exchange_time(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    t = clocks.exchange_instant(
        F.when(k % 4 == 0, F.unix_millis("ts")).cast("double"), F.when(k % 4 == 1, F.unix_seconds("ts")).when(k % 4 == 2, F.unix_millis("ts")).cast("double"), F.when(k % 4 == 3, F.lit("never")))
    return table(spark, sf, "events").select("event_id", F.coalesce(stamp(t), F.lit("none")).alias("t"))


@query("f22_price_cents", "select o_orderkey, cast(o_orderkey%100 as int) as cents from orders")
def price_cents(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    raw = F.when(k % 2 == 0, F.format_string("0.%02d", (k % 100).cast("int"))).otherwise((k % 100).cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", numeric.price_cents(raw).alias("cents"))


@query("f23_city_alias", "select c_custkey, case c_custkey%4 when 0 then 'nyc' when 1 then 'la' when 2 then 'phx' else '' end as city from customer")
def city_alias(spark: SparkSession, sf: str) -> DataFrame:
    raw = shapes.pick([" New_York", "los angeles", "PHX", "mars"], F.col("c_custkey") % 4)
    return table(spark, sf, "customer").select("c_custkey", F.coalesce(text.city_key(raw), F.lit("")).alias("city"))


@query("f24_season_cycle", f"select o_orderkey, {q6_sql('sin(2*pi()*dayofyear(o_orderdate)/365.25e0)', 6)} as s, {q6_sql('cos(2*pi()*dayofyear(o_orderdate)/365.25e0)', 6)} as c from orders")
def season_cycle(spark: SparkSession, sf: str) -> DataFrame:
    s, c = numeric.season_cycle(F.col("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", q6(s, 6).alias("s"), q6(c, 6).alias("c"))


@query("f25_series_type", "select c_custkey, c_custkey%4<3 and c_custkey%2=0 as temperature, case c_custkey%4 when 0 then 'hourly' when 1 then 'high' when 2 then 'low' else '' end as kind from customer")
def series_type(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    ticker = shapes.pick(["KXTEMPNY", "KXHIGHNY", "KXLOWTNY", "KXRAIN"], k % 4)
    climate = text.is_temperature_series(F.when(k % 2 == 0, "Climate and Weather").otherwise("x"), F.array(F.lit("y")), F.lit("t"), ticker)
    return table(spark, sf, "customer").select("c_custkey", climate.alias("temperature"), text.series_type(ticker).alias("kind"))


@query("f13_gaussian_crps", f"select event_id, {q6_sql(crps_sql('40e0', 'value', '15e0'), 7)} as crps from events")
def gaussian_crps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", q6(numeric.gaussian_crps(F.lit(40.0), F.col("value"), F.lit(15.0)), 7).alias("crps"))


@query("f16_great_circle", f"select c_custkey, {q6_sql('2*6371.0088e0*asin(sqrt(pow(sin(radians(33.5e0-(c_custkey%60))/2),2)+cos(radians(c_custkey%60))*cos(radians(33.5e0))*pow(sin(radians(-112.0e0-(c_custkey%90))/2),2)))', 4)} as km from customer")
def great_circle(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select("c_custkey", q6(numeric.haversine_km(k % 60, k % 90, F.lit(33.5), F.lit(-112.0)), 4).alias("km"))
