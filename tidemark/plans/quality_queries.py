"""Quality gates and streaming jobs over the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clocks
from ..operators import quality
from ..streaming import jobs
from . import shapes
from .registry import query
from .shapes import q6, q6_sql, stamp, stamp_sql, table, with_views
from .source_queries import folder, frame_lines

def count_rows() -> Column:
    return F.count(F.lit(1))
def as_of() -> Column:
    return F.lit("2024-01-20 00:00:00").cast("timestamp")


@query("q01_gate_suite", with_views(("forecasts", "labels_daily"), """
 , c as (select count(*) as rows, count(*) filter (source_receipt_time is null) as missing, count(*) filter (source_receipt_time>timestamp '2024-01-20') as late from forecasts), d as (select count(*) - count(distinct (station, date)) as dup from labels_daily)
 select 'forecast_receipts' as "check", m.metric, case m.metric when 'rows' then rows when 'missing' then missing when 'invalid' then 0 when 'after_as_of' then late else case when missing+late=0 then 1 else 0 end end::double as value from c, (values ('rows'),('missing'),('invalid'),('after_as_of'),('pass')) m(metric)
 union all select 'label_keys', m.metric, case m.metric when 'duplicates' then dup else case when dup=0 then 1 else 0 end end::double from d, (values ('duplicates'),('pass')) m(metric)"""))
def gate_suite(spark: SparkSession, sf: str) -> DataFrame:
    f = shapes.forecasts(spark, sf)
    return quality.gate_suite({
        "forecast_receipts": quality.timestamp_gate(f, F.col("source_receipt_time"), F.col("source_receipt_time"), as_of()),
        "label_keys": quality.duplicate_gate(shapes.labels_daily(spark, sf), ["station", "date"])})


@query("q02_range_checks", "select v.n as variable, count(*) as rows, count(*) filter (not (v.known and l_quantity*8 between v.lo and v.hi)) as invalid from lineitem join (values (0,'temperature_2m',180e0,350e0,true),(1,'cloud_cover',0e0,100e0,true),(2,'mystery',0e0,0e0,false)) v(i,n,lo,hi,known) on l_orderkey%3=v.i group by 1")
def range_checks(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(shapes.pick(["temperature_2m", "cloud_cover", "mystery"], F.col("l_orderkey") % 3).alias("variable"), (F.col("l_quantity") * 8).alias("value"))
    return quality.range_gate(rows)


@query("q03_file_manifest", "select count(*) filter (doc_id%10<>0) as rows, 0::bigint as missing_file, count(*) filter (doc_id%10=0) as unindexed_file, count(*) filter (doc_id%10<>0 and doc_id%7=0) as hash_mismatch, count(*) filter (doc_id%10<>0 and doc_id%13=0) as future_receipt from documents")
def file_manifest(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").withColumn("path", F.concat(F.lit("doc/"), F.col("doc_id").cast("string")))
    files = d.select("path", F.sha2("text", 256).alias("sha256"), F.length("text").alias("bytes"))
    k = F.col("doc_id")
    manifest = d.where(k % 10 != 0).select(
        "path", F.when(k % 7 == 0, "stale").otherwise(F.sha2("text", 256)).alias("sha256"), F.length("text").alias("bytes"),
        F.when(k % 13 == 0, F.lit("2030-01-01")).otherwise("2020-01-01").cast("timestamp").alias("retrieved_at"))
    return quality.file_gate(manifest, files, as_of()).select("rows", "missing_file", "unindexed_file", "hash_mismatch", "future_receipt")


@query("q04_quarantine_coverage", "select count(*) as empty_payload, count(*) filter (doc_id%3<>0) as unquarantined_empty from documents where doc_id not in (select doc_id from labels)")
def quarantine_coverage(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("doc_id").cast("string").alias("raw_path")
    d = table(spark, sf, "documents").select("doc_id", path, F.sha2("text", 256).alias("sha256"))
    values = table(spark, sf, "labels").select(path)
    listed = d.where(F.col("doc_id") % 3 == 0).select("raw_path", "sha256", F.lit("empty").alias("reason"), F.lit("true").alias("reviewed"))
    return quality.quarantine_gate(d, values, listed)


@query("q05_contract_labels", "select count(*) as rows, count(*) filter (o_orderkey%9=0 or o_orderkey%8=0) as invalid_rows, count(*) filter (o_orderdate>timestamp '1998-01-01') as future_receipts from orders")
def contract_labels(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        k.alias("market_ticker"), F.col("o_orderdate").alias("target_time_utc"), F.col("o_orderdate").alias("retrieved_at_utc"), F.when(k % 9 != 0, "h").otherwise("").alias("rules_hash"),
        F.when(k % 8 != 0, "above").otherwise("beside").alias("comparison"))
    return quality.contract_gate(rows, F.lit("1998-01-01").cast("timestamp"))


@query("q05_label_consistency", "select count(*) as matched, count(*) filter (o_orderkey%6=0) as time_mismatch, count(*) filter (o_orderkey%10=0) as received_before_valid, count(*) filter (o_orderkey%7=0) as no_outcome, count(*) filter (o_orderkey%7=0 or (o_custkey+o_orderkey)%2=1) as result_mismatch from orders")
def label_consistency(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    t = F.col("o_orderdate")
    rows = table(spark, sf, "orders").select(
        t.alias("target_time_utc"), F.when(k % 6 == 0, clocks.shift_hours(t, F.lit(1))).otherwise(t).alias("source_valid_utc"),
        F.when(k % 10 == 0, clocks.shift_hours(t, F.lit(-3))).otherwise(clocks.shift_hours(t, F.lit(3))).alias("label_available_ts"),
        F.when(k % 7 == 0, "").when(k % 2 == 0, "true").otherwise("false").alias("source_observed_yes"), F.when(F.col("o_custkey") % 2 == 0, "yes").otherwise("no").alias("kalshi_result"))
    return quality.label_gate(rows)


@query("q06_manifest_validation", """with m as (select o_orderkey as k, o_custkey as c, list_filter([case when o_orderkey%10=0 then 'no_rules_hash' end, case when o_orderkey%14=0 then 'prediction_range' end, case when o_orderkey%11=0 then 'commit_form' end,
 case when o_orderkey%10=0 then 'rules_differ' end, case when o_custkey%3=0 then 'unindexed_source_run_id' end, case when o_custkey%3=1 and o_custkey%2=0 then 'late_source_run_id' end], lambda x: x is not null) as e from orders) select array_to_string(e,';') as errors, count(*) as n from m group by 1""")
def manifest_validation(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders")
    late = clocks.shift_hours(F.lit("1990-01-01").cast("timestamp"), F.lit(0))
    manifests = o.select(
        k.alias("manifest_id"), F.lit("2000-01-01").cast("timestamp").alias("decision_ts"), F.lit("v").alias("feature_version"), F.lit("v").alias("model_version"), F.lit("none").alias("calibrator_version"),
        F.array(F.concat(F.lit("run"), F.col("o_custkey").cast("string"))).alias("source_run_ids"), F.array(F.lit("o1")).alias("observation_ids"), F.when(k % 10 != 0, "r").otherwise("").alias("rules_hash"),
        F.when(k % 11 == 0, "zzz").otherwise("HEAD").alias("code_commit"), F.when(k % 14 == 0, 1.5).otherwise(0.5).alias("prediction"), k.alias("market_ticker"), F.col("o_orderdate").alias("target_time_utc"))
    contracts = o.select(k.alias("market_ticker"), F.lit("r").alias("rules_hash"), F.col("o_orderdate").alias("target_time_utc"))
    c = F.col("c_custkey")
    runs = table(spark, sf, "customer").where(c % 3 != 0).select(
        F.concat(F.lit("run"), c.cast("string")).alias("id"), F.when((c % 3 == 1) & (c % 2 == 0), F.lit("2030-01-01").cast("timestamp")).otherwise(late).alias("receipt_time"))
    seen = o.agg(F.min("o_orderdate").alias("receipt_time")).select(F.lit("o1").alias("id"), "receipt_time")
    out = quality.validate_manifests(manifests, contracts, runs, seen)
    return out.groupBy(F.array_join("errors", ";").alias("errors")).agg(count_rows().alias("n"))


@query("q06_manifest_names", """with m as (select o_orderkey as k, substr(sha256('{"c":' || o_custkey || ',"s":"' || o_orderstatus || '"}'),1,16) as key from orders)
 select count(*) as rows, count(*) filter (k%13=0) as name_mismatch, count(*)-count(distinct key) as duplicate_manifests from m""")
def manifest_names(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"))
    key = quality.manifest_key(["c", "s"])
    return quality.manifest_name_gate(m.withColumn("name", F.when(F.col("o_orderkey") % 13 == 0, F.lit("stale")).otherwise(key)), ["c", "s"], "name")


@query("q07_provenance_indexes", with_views(("obs",), "select 'observation' as kind, case when station%4=0 then 'non_target_station' else 'missing_raw_path' end as reason, count(*) as n from obs where station%4=0 or event_id%21=0 group by 1,2 union all select 'source', 'missing_raw_sha256', count(*) from lineitem where l_partkey%17=0"))
def provenance_indexes(spark: SparkSession, sf: str) -> DataFrame:
    o = shapes.obs(spark, sf)
    obs = o.select(F.when(F.col("station") % 4 == 0, "far").otherwise("near").alias("station"), "valid_utc", F.col("receipt_utc").alias("receipt"), F.when(F.col("event_id") % 21 != 0, "p").alias("raw_path"), F.col("event_id").cast("string").alias("raw_sha256"))
    li = table(spark, sf, "lineitem")
    fc = li.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").alias("source_run_id"), F.col("l_shipdate").alias("receipt"), F.lit("i").alias("initialization"), F.lit("p").alias("raw_path"),
                   F.when(F.col("l_partkey") % 17 != 0, "h").alias("raw_sha256"))
    _, _, bad = quality.provenance_indexes(fc, obs, ["near"])
    return bad.groupBy("kind", "reason").agg(count_rows().alias("n"))


@query("q08_label_sanity", with_views(("labels_daily",), f"""
 , l as (select city, date, case when station%4=1 and day(date)%3=0 then tmin_f-1 else tmax_f end as tmax_f, tmin_f from labels_daily union all select city, date, null, tmin_f from labels_daily where day(date)%5=0)
 select city, count(*) as rows, count(distinct date) as unique_dates, count(*)-count(distinct date) as duplicate_dates, cast(min(date) as varchar) as first_date, {q6_sql('max(tmax_f)')} as tmax_top,
  count(*) filter (tmax_f<tmin_f) as tmax_lt_tmin, count(*) filter (tmax_f is null) as missing_tmax from l group by 1"""))
def label_sanity(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with faults put in: crossed extremes, second rows of a day, missing highs."""
    good = shapes.labels_daily(spark, sf)
    crossed = (F.col("station") % 4 == 1) & (F.dayofmonth("date") % 3 == 0)
    bad = good.withColumn("tmax_f", F.when(crossed, F.col("tmin_f") - 1).otherwise(F.col("tmax_f")))
    second = good.where(F.dayofmonth("date") % 5 == 0).withColumn("tmax_f", F.lit(None).cast("double"))
    out = quality.label_sanity(bad.unionByName(second))
    return out.select("city", "rows", "unique_dates", "duplicate_dates", F.col("first_date").cast("string").alias("first_date"), q6(F.col("tmax_top")).alias("tmax_top"), "tmax_lt_tmin", "missing_tmax")


@query("q08_observation_sanity", with_views(("obs",), f"select station, count(*) as obs, {q6_sql('count(*)*1e0/count(distinct local_date)', 4)} as obs_per_day, count(*) filter (cast((valid_utc at time zone 'UTC') at time zone 'America/Phoenix' as date)<>local_date) as local_date_mismatch from obs group by 1"))
def observation_sanity(spark: SparkSession, sf: str) -> DataFrame:
    out = quality.observation_sanity(shapes.obs(spark, sf), "America/Phoenix")
    return out.select("station", "obs", q6(F.col("obs_per_day"), 4).alias("obs_per_day"), "local_date_mismatch")


@query("q09_city_readiness", with_views(("obs",), "select city, count(*) as market_rows, count(*) as exact_open_time_matches, count(*) filter (event_id%11=0) as pre_decision_receipts, case when count(*) filter (event_id%11=0)>0 then 'eligible' else 'missing_event_terms_or_pre_decision_alignment' end as reason from obs group by 1"))
def city_readiness(spark: SparkSession, sf: str) -> DataFrame:
    o = shapes.obs(spark, sf)
    markets = o.select("city", "station", F.col("valid_utc").alias("open_time"), F.col("valid_utc").alias("target_time_utc"), F.lit("s").alias("settlement_source_name"))
    seen = o.select("station", "valid_utc", F.col("receipt_utc").alias("retrieved_at_utc"))
    return quality.city_readiness(markets, seen).select("city", "market_rows", "exact_open_time_matches", "pre_decision_receipts", "reason")


@query("q10_completeness", "select 'm' || (p_partkey%3) as model, 3::bigint as required_fields, 2::bigint as observed_fields, 'F9' as missing_fields from part group by 1")
def completeness(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(F.concat(F.lit("m"), (F.col("p_partkey") % 3).cast("string")).alias("model"), F.concat(F.lit("F"), (F.col("p_size") % 5).cast("string")).alias("field"))
    need = p.select("model").distinct().withColumn("field", F.explode(F.array(F.lit("F0"), F.lit("F1"), F.lit("F9"))))
    return quality.completeness(p, need)


@query("q10_completeness_by_brand", """with need as (select distinct p_brand as model, 'F' || i as field from part, range(1,51) r(i)), have as (select distinct p_brand as model, 'F' || p_size as field from part)
 select n.model, count(*) as required_fields, count(h.field) as observed_fields, coalesce(string_agg(case when h.field is null then n.field end, '|' order by n.field), '') as missing_fields from need n left join have h on n.model=h.model and n.field=h.field group by 1""")
def completeness_by_brand(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(F.col("p_brand").alias("model"), F.concat(F.lit("F"), F.col("p_size").cast("string")).alias("field"))
    need = p.select("model").distinct().withColumn("field", F.explode(F.transform(F.sequence(F.lit(1), F.lit(50)), lambda i: F.concat(F.lit("F"), i.cast("string")))))
    return quality.completeness(p, need)


@query("q11_example_join", with_views(("labels_daily", "buckets"), """
 , b as (select city, outcome_local_date as date, array_to_string(list_slice(list_sort(list(market_ticker)),1,3),'|') as tickers from buckets where temp_type='high' group by 1,2), r as (select *, row_number() over (partition by city order by date desc) as rn from labels_daily)
 select r.city, cast(r.date as varchar) as date, tickers from r left join b on r.city=b.city and r.date=b.date where rn<=12"""))
def example_join(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.aggregates import top_groups

    days = top_groups(shapes.labels_daily(spark, sf), "city", "date", 12)
    # An event has five markets, so the list per day is short.
    b = shapes.buckets(spark, sf).where(F.col("temp_type") == "high").groupBy("city", F.col("outcome_local_date").alias("date")).agg(
        F.array_join(F.slice(F.array_sort(F.collect_list("market_ticker")), 1, 3), "|").alias("tickers"))
    return days.join(b, ["city", "date"], "left").select("city", F.col("date").cast("string").alias("date"), "tickers")


@query("q12_quote_audit", "select count(*) as rows, count(*) filter (o_orderkey%12=0) as non_finite, (select count(*) from orders) as expected_rows, false as pass from orders")
def quote_audit(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 12 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)).alias("bid"), F.lit(2.0).alias("ask"))
    return quality.quote_audit(o, ["bid", "ask"], table(spark, sf, "orders").agg(count_rows().alias("expected_rows")))


@query("q12_quote_audit_cases", """with a as (select 'finite' as quotes, count(*) as rows, 0::bigint as non_finite, (select sum(n)::bigint from (select count(*) as n from lineitem group by l_orderkey)) as expected_rows from lineitem
 union all select 'untaxed', count(*), count(*) filter (l_tax=0), (select count(*) from lineitem) from lineitem union all select 'short', count(*), 0, (select count(*) from orders) from lineitem) select *, rows=expected_rows and non_finite=0 as pass from a""")
def quote_audit_cases(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem")
    quotes = line.select(F.col("l_extendedprice").alias("bid"), F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("ask"))
    per_order = line.groupBy("l_orderkey").agg(count_rows().alias("n")).agg(F.sum("n").alias("expected_rows"))
    cases = {
        "finite": (["bid"], per_order), "untaxed": (["bid", "ask"], line.agg(count_rows().alias("expected_rows"))),
        "short": (["bid"], table(spark, sf, "orders").agg(count_rows().alias("expected_rows")))}
    out = None
    for name, (fields, expected) in cases.items():
        audit = quality.quote_audit(quotes, fields, expected).withColumn("quotes", F.lit(name))
        out = audit if out is None else out.unionByName(audit)
    return out


# ---------------------------------------------------------------- streams

def _lines_dir(spark: SparkSession, sf: str) -> str:
    path = folder(spark, "frames")
    frame_lines(spark, sf).select("value").write.text(path)
    return path


@query("r01_raw_append", "select case when event_id%97=0 then 'unknown' when event_id%5=0 then 'orderbook_snapshot' else 'orderbook_delta' end as message_type, event_id%97<>0 as valid, count(*) as n from events group by 1,2")
def raw_append(spark: SparkSession, sf: str) -> DataFrame:
    frames = jobs.raw_frames(jobs.read_frames(spark, _lines_dir(spark, sf)))
    out = folder(spark, "bronze")
    jobs.append_table(frames.select("value", "valid", "message_type", "frame_sha"), out, folder(spark, "offsets")).awaitTermination()
    return spark.read.parquet(out).groupBy("message_type", "valid").agg(count_rows().alias("n"))


@query("r02_duplicate_frames", "select count(*) as n from (select event_id from events where event_id%97<>0 union all select -1 where exists (select 1 from events where event_id%97=0))")
def duplicate_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Every line twice, in many files; broken lines share one text and so one hash."""
    path = _lines_dir(spark, sf)
    frame_lines(spark, sf).select("value").write.mode("append").text(path)
    out = folder(spark, "distinct")
    jobs.append_distinct(jobs.raw_frames(jobs.read_frames(spark, path, 2)).select("frame_sha", "value"), out, folder(spark, "offsets"))
    return spark.read.parquet(out).agg(count_rows().alias("n"))


def _followed_books(spark: SparkSession, sf: str) -> str:
    """Frames dealt over files without regard to order, two files a batch."""
    frames = shapes.book_messages(spark, sf)
    path, out = folder(spark, "book"), folder(spark, "followed")
    frames.repartition(4, "event_id").write.parquet(path)
    jobs.follow_books(spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 2).parquet(path), out, folder(spark, "offsets"))
    return out


SEQ_SQL = """, h as (select *, max(seq) over (partition by connection_epoch, sid order by received_ts, event_id rows between unbounded preceding and 1 preceding) as pm from book)"""


@query("r03_sequence_events", with_views(("book",), f"{SEQ_SQL} select sid, case when coalesce(seq<=pm,false) then 'stale' when coalesce(seq>pm+1,false) then 'gap' else 'applied' end as event, count(*) as n from h group by 1,2"))
def sequence_events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{_followed_books(spark, sf)}/health").groupBy("sid", "event").agg(count_rows().alias("n"))


@query("r04_live_books", with_views(("book",), f"""{SEQ_SQL}, a as (select *, coalesce(seq>pm+1,false) as gap, type='orderbook_snapshot' as snap, row_number() over (order by received_ts, event_id) as pos from h where not coalesce(seq<=pm,false)),
 g as (select *, max(case when gap then pos end) over (partition by connection_epoch order by pos) as lg, max(case when snap then pos end) over (partition by connection_epoch, market_ticker order by pos) as ls, min(pos) over (partition by connection_epoch, market_ticker order by pos) as fp from a)
 select sid, count(*) as accepted, count(*) filter (coalesce(lg>=fp,false) and not coalesce(ls>=lg,false)) as quarantined from g group by 1"""))
def live_books(spark: SparkSession, sf: str) -> DataFrame:
    kept = spark.read.parquet(f"{_followed_books(spark, sf)}/books")
    return kept.groupBy("sid").agg(count_rows().alias("accepted"), F.count_if("quarantined").alias("quarantined"))


@query("r05_late_data_view", with_views(("feature_rows",), "select source, count(*) as n from feature_rows where source_event_time<=timestamp '2024-01-10' and coalesce(available_at, retrieved_at)<=timestamp '2024-01-10' group by 1"))
def late_data_view(spark: SparkSession, sf: str) -> DataFrame:
    rows = shapes.feature_rows(spark, sf).withColumn("receipt", F.coalesce("available_at", "retrieved_at"))
    return jobs.asof_view(rows, F.lit("2024-01-10 00:00:00").cast("timestamp"), "source_event_time", "receipt").groupBy("source").agg(count_rows().alias("n"))


@query("r06_type_routing", "select case when event_id%97=0 then 'unknown' when event_id%5=0 then 'orderbook_snapshot' else 'orderbook_delta' end as message_type, count(*) as n from events group by 1")
def type_routing(spark: SparkSession, sf: str) -> DataFrame:
    frames = jobs.raw_frames(jobs.read_frames(spark, _lines_dir(spark, sf))).select("value", "message_type")
    out = folder(spark, "routed")
    jobs.append_table(frames, out, folder(spark, "offsets"), ["message_type"]).awaitTermination()
    return spark.read.parquet(out).groupBy("message_type").agg(count_rows().alias("n"))


@query("r07_incremental_ledger", "select count(*) as n, count(distinct o_custkey) as ids from (select distinct o_custkey from orders)")
def incremental_ledger(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("record_id"), F.lit("x").alias("body"))
    path, out = folder(spark, "records"), folder(spark, "ledger")
    rows.repartition(4).write.parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)
    jobs.ingest_new(stream, out, folder(spark, "offsets"))
    return spark.read.parquet(out).agg(count_rows().alias("n"), F.countDistinct("record_id").alias("ids"))


@query("r08_snapshot_upsert", f"select o_custkey as k, {stamp_sql('min(o_orderdate)')} as receipt from orders group by 1")
def snapshot_upsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("receipt"))
    path, out = folder(spark, "snapshots"), folder(spark, "upserted")
    rows.repartition(4).write.parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)
    jobs.upsert(stream, out, folder(spark, "offsets"), ["k"], F.col("receipt"), newest=False)
    return jobs.latest_version(spark, out).select("k", stamp(F.col("receipt")).alias("receipt"))

