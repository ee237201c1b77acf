"""Nested JSON archives as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clocks, encode, text
from ..operators.filters import quote_prices

ENVELOPE = "message string, raw_json string, connection_epoch int, received_at string, parse_error string, receive_latency_ms double"
BOOK_MESSAGE = (
    "type string, sid bigint, seq bigint, msg struct<market_ticker:string, side:string, price:string, delta:string, "
    "price_dollars:string, delta_fp:string, yes:array<array<string>>, no:array<array<string>>, "
    "yes_dollars_fp:array<array<string>>, no_dollars_fp:array<array<string>>>"
)


def unwrap_messages(lines: DataFrame) -> DataFrame:
    """Envelope lines to messages: the message object, else the decoded raw text, else the record itself.

    A line that is no JSON object has ``valid`` false and is kept.
    """
    line = F.col("value")
    envelope = F.from_json(line, ENVELOPE)
    inner = F.get_json_object(line, "$.message")
    raw = envelope["raw_json"]
    body = F.coalesce(
        F.when(F.trim(inner).startswith("{"), inner), F.when(F.get_json_object(raw, "$").startswith("{"), raw),
        F.when(F.get_json_object(line, "$.type").isNotNull(), line))
    return lines.select(
        *lines.columns, envelope["connection_epoch"].alias("connection_epoch"), clocks.parse_utc(envelope["received_at"]).alias("received_at"),
        envelope["parse_error"].alias("parse_error"), envelope["receive_latency_ms"].alias("receive_latency_ms"),
        body.alias("message_json"), F.from_json(body, BOOK_MESSAGE).alias("message"),
        F.coalesce(F.get_json_object(line, "$").startswith("{") & body.isNotNull(), F.lit(False)).alias("valid"))


MARKET = (
    "ticker string, title string, subtitle string, yes_sub_title string, status string, strike_type string, "
    "last_price_dollars string, yes_bid_dollars string, yes_ask_dollars string, volume_fp string, open_interest_fp string, "
    "open_time string, close_time string, result string, floor_strike string, cap_strike string, rules_primary string"
)
EVENT = (
    f"event_ticker string, series_ticker string, title string, sub_title string, category string, strike_date string, "
    f"settlement_sources array<struct<name:string, url:string>>, markets array<struct<{MARKET.replace(' string', ':string')}>>"
)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT).option("multiLine", True).json(path)


def flatten_events(events: DataFrame, series: DataFrame | None = None) -> DataFrame:
    """One row per nested market with its event's fields, prices and, where given, its series' title and tags."""
    sources = F.array_join(F.transform("settlement_sources", lambda s: s["name"]), "|")
    rows = events.select(
        "event_ticker", "series_ticker", F.col("title").alias("event_title"), F.col("sub_title").alias("event_sub_title"),
        F.col("category").alias("event_category"), "strike_date", sources.alias("settlement_sources"), F.explode("markets").alias("m"))
    prices = ("last_price_dollars", "yes_bid_dollars", "yes_ask_dollars", "volume_fp", "open_interest_fp", "floor_strike", "cap_strike")
    rows = rows.select(
        *[c for c in rows.columns if c != "m"], F.col("m.ticker").alias("market_ticker"),
        *[F.col(f"m.{c}").alias(c) for c in ("yes_sub_title", "status", "strike_type", "open_time", "close_time", "result", "rules_primary")],
        F.col("m.title").alias("market_title"), *[clocks.to_number(F.col(f"m.{c}")).alias(c) for c in prices])
    rows = quote_prices(rows, "yes_bid_dollars", "yes_ask_dollars", "last_price_dollars")
    if series is None:
        return rows
    meta = series.select(F.col("ticker").alias("series_ticker"), F.col("title").alias("series_title"), F.array_join("tags", "|").alias("series_tags"))
    return rows.join(meta, "series_ticker", "left")


def member_arrays(payloads: DataFrame, variables: Sequence[str], json_column: str = "payload") -> DataFrame:
    """``variable_memberNN`` arrays beside ``time`` as long rows; null values are skipped.

    ``payloads`` keeps its other columns (city, model, retrieval time).
    """
    kept = [c for c in payloads.columns if c != json_column]
    hourly = F.from_json(F.get_json_object(json_column, "$.hourly"), "map<string, array<string>>")
    wide = payloads.select(*kept, hourly.alias("h")).withColumn("__time", F.try_element_at("h", F.lit("time")))
    series = wide.select(*kept, "__time", F.explode("h").alias("name", "values"))
    pattern = "^(" + "|".join(variables) + r")_(member.*)$"
    series = series.where(F.col("name").rlike(pattern))
    points = series.select(
        *kept, F.regexp_extract("name", pattern, 1).alias("variable"), F.regexp_extract("name", pattern, 2).alias("member_id"),
        F.explode(F.arrays_zip(F.col("__time").alias("t"), F.col("values").alias("v"))).alias("p"))
    stamp = F.when(F.length("p.t") == 16, F.concat(F.col("p.t"), F.lit(":00Z"))).otherwise(F.col("p.t"))
    out = points.select(
        *kept, F.when(F.col("variable") == "convective_inhibition", "cin").otherwise(F.col("variable")).alias("variable"), "member_id",
        clocks.parse_utc(stamp).alias("valid_time"), F.col("p.v").try_cast("double").alias("value"))
    return out.where(F.col("value").isNotNull() & F.col("valid_time").isNotNull())


_DATED = "date struct<beginDate:string, endDate:string>".replace("date struct", "date:struct")
STATION_HISTORY = (
    f"stationCollection struct<stations:array<struct<identifiers:array<struct<idType:string,id:string,{_DATED}>>, "
    f"relocations:array<struct<date:string,relocation:string>>, remarks:array<struct<type:string,remark:string,{_DATED}>>, "
    f"location:struct<latitudes:array<struct<latitude_dec:string,precision:string,{_DATED}>>, longitudes:array<struct<longitude_dec:string,precision:string,{_DATED}>>, "
    f"elevations:array<struct<elevationMeters:string,precision:string,{_DATED}>>, descriptions:array<struct<description:string,precision:string,{_DATED}>>>, "
    f"platforms:array<struct<platform:string,{_DATED}>>, updates:array<struct<updateSource:string,nativeId:string,effectiveDate:string,description:string>>>>>"
)


def station_history(payloads: DataFrame, json_column: str = "payload") -> DataFrame:
    """Identifiers, moves, remarks, location facets, platforms and updates of a station as one long table."""
    kept = [c for c in payloads.columns if c != json_column]
    station = F.get(F.from_json(json_column, STATION_HISTORY)["stationCollection"]["stations"], F.lit(0))
    base = payloads.select(*kept, station.alias("s"))
    none = F.lit("")

    def facet(path: str, kind: str, id_type: str | None, identifier: str | None, begin: str, end: str | None, detail: str | None) -> DataFrame:
        rows = base.select(*kept, F.explode(f"s.{path}").alias("x"))

        def field(name: str | None) -> Column:
            return F.coalesce(F.col(f"x.{name}"), none) if name else none

        return rows.select(*kept, F.lit(kind).alias("record_type"), field(id_type).alias("id_type"), field(identifier).alias("identifier"),
                           field(begin).alias("begin_date"), field(end).alias("end_date"), field(detail).alias("detail"))

    b, e = "date.beginDate", "date.endDate"
    parts = [
        facet("identifiers", "identifier", "idType", "id", b, e, None), facet("relocations", "relocation", None, None, "date", None, "relocation"),
        facet("remarks", "remark", "type", None, b, e, "remark"), facet("location.descriptions", "location_description", "precision", None, b, e, "description"),
        facet("location.latitudes", "latitude", "precision", None, b, e, "latitude_dec"), facet("location.longitudes", "longitude", "precision", None, b, e, "longitude_dec"),
        facet("location.elevations", "elevation", "precision", None, b, e, "elevationMeters"), facet("platforms", "platform", "platform", None, b, e, None),
        facet("updates", "update", "updateSource", "nativeId", "effectiveDate", None, "description")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def epoch_series(payloads: DataFrame, json_column: str = "payload") -> DataFrame:
    """``{t, v}`` points with epoch milliseconds; points without a time or value are skipped."""
    kept = [c for c in payloads.columns if c != json_column]
    schema = "city string, config_version string, timeseries array<struct<t:string, v:string, status:string, contributors:string>>"
    rows = payloads.select(*kept, F.from_json(json_column, schema).alias("j")).select(*kept, F.col("j.city").alias("payload_city"), F.explode("j.timeseries").alias("p"))
    out = rows.select(*kept, "payload_city", F.timestamp_millis(F.col("p.t").try_cast("long")).alias("timestamp_utc"), F.col("p.v").try_cast("double").alias("value_f"),
                      F.coalesce("p.status", F.lit("")).alias("status"))
    return out.where(F.col("timestamp_utc").isNotNull() & F.col("value_f").isNotNull())


def hourly_contracts(markets: DataFrame, events: DataFrame, stations: dict[str, str]) -> DataFrame:
    """Contract terms of hourly markets: threshold, side, bucket bounds, source, station and rules hash.

    ``events`` has event_ticker, strike_date, sub_title, settlement_sources (array of name, url) and
    the series fields contract_terms_url, contract_url, last_updated_ts and series_sources.
    """
    wide = markets.join(events, "event_ticker", "left")
    own = F.when(F.size("settlement_sources") > 0, F.col("settlement_sources")).otherwise(F.col("series_sources"))
    wide = wide.withColumn("__sources", own)
    threshold = text.hourly_threshold(F.col("ticker"), F.coalesce("title", F.lit("")))
    bounds = text.hourly_bounds(F.coalesce(F.nullif("yes_sub_title", F.lit("")), "subtitle", F.lit("")))
    series = F.coalesce(F.nullif("series_ticker", F.lit("")), F.split_part("event_ticker", F.lit("-"), F.lit(1)))
    lookup = F.create_map(*[F.lit(x) for pair in stations.items() for x in pair])
    material = F.to_json(F.struct("contract_terms_url", "contract_url", "last_updated_ts", F.col("__sources").alias("settlement_sources")))
    return wide.select(
        "event_ticker", F.col("ticker").alias("market_ticker"), series.alias("series_ticker"), clocks.parse_utc(F.col("strike_date")).alias("target_time_utc"),
        F.col("sub_title").alias("target_local_text"), threshold["threshold"].alias("threshold_f"), threshold["comparison"].alias("comparison"),
        bounds["floor"].alias("bucket_floor_f"), bounds["ceil"].alias("bucket_ceil_f"), "status", "result",
        F.get("__sources", F.lit(0))["name"].alias("settlement_source_name"), F.try_element_at(lookup, series).alias("settlement_station"),
        F.when(F.try_element_at(lookup, series).isNotNull(), "registry").otherwise("unresolved").alias("settlement_station_method"),
        encode.text_sha256(material).alias("rules_hash"))


def archived_payloads(payloads: DataFrame, array_path: str, schema: str, json_column: str = "payload") -> DataFrame:
    """Records of an archived API response: one row per array element, with receipt and payload hash.

    Serves event, market, observation, quote and candle archives; ``schema`` is the element's DDL.
    """
    kept = [c for c in payloads.columns if c != json_column]
    rows = F.from_json(F.get_json_object(json_column, array_path), f"array<struct<{schema}>>")
    return payloads.select(*kept, encode.text_sha256(F.col(json_column)).alias("raw_sha256"), F.explode(rows).alias("r")).select(*kept, "raw_sha256", "r.*")
