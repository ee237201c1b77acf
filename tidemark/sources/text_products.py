"""Fixed-width, whitespace and bulletin texts as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clocks, text
from ..operators.filters import REASON, first_reason, split
from ..operators.timeline import Running, keep_latest, running_scan

CELL = 8


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("raw_path"))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its whole text and name."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("text"), F.col("_metadata.file_name").alias("file_name"), F.sha2("value", 256).alias("raw_sha256"))


def pipe_observations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Station rows of a pipe-separated file, Celsius to Fahrenheit; rows without time or temperature are rejected."""
    clocks.require_columns(rows, ["STATION", "Station_name", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "temperature", "dew_point_temperature"], "observations")

    def fahrenheit(name: str) -> Column:
        raw = F.trim(F.col(name))
        celsius = F.when(~raw.isin("", "MM", "M", "NA") & raw.rlike(clocks.NUMBER_PATTERN), raw.try_cast("double"))
        return F.bround(celsius * 9 / 5 + 32, 3)

    out = rows.select(
        F.col("STATION").alias("station"), F.col("Station_name").alias("station_name"), clocks.parse_utc(F.col("DATE")).alias("valid_utc"),
        F.col("LATITUDE").alias("latitude"), F.col("LONGITUDE").alias("longitude"), F.col("ELEVATION").alias("elevation_m"),
        fahrenheit("temperature").alias("temperature_f"), fahrenheit("dew_point_temperature").alias("dewpoint_f"),
        *[c for c in rows.columns if c in ("raw_path", "sha256", "source_receipt_time")])
    return split(out.withColumn(REASON, first_reason(
        (F.col("valid_utc").isNull(), "invalid_time"), (F.col("temperature_f").isNull(), "missing_temperature"))))


def monthly_records(lines: DataFrame, elements: Sequence[str] = ("TMAX", "TMIN")) -> DataFrame:
    """Daily values of fixed-width month records: 11 id, 4 year, 2 month, 4 element, then 31 cells of 8."""
    v = F.col("value")
    head = lines.where(F.length(F.trim(v)) >= 21).select(
        F.trim(F.substring(v, 1, 11)).alias("station_id"), F.substring(v, 12, 4).try_cast("int").alias("year"),
        F.substring(v, 16, 2).try_cast("int").alias("month"), F.trim(F.substring(v, 18, 4)).alias("element"), v.alias("__line"),
    ).where(F.col("element").isin(*elements))
    days = head.withColumn("__d", F.explode(F.sequence(F.lit(0), F.lit(30)))).where(
        F.col("__d") < F.day(F.last_day(F.make_date("year", "month", F.lit(1)))))
    cell = F.col("__line").substr(F.lit(22) + F.col("__d") * CELL, F.lit(CELL))
    out = days.withColumn("__cell", cell).where(F.length("__cell") == CELL)
    raw = F.trim(F.substring("__cell", 1, 5))
    celsius = F.when(~raw.isin("", "-9999"), raw.try_cast("double") / 10)
    day = F.make_date("year", "month", F.col("__d") + 1)
    return out.select(
        "station_id", "element", day.alias("date"), celsius.alias("value_c"), F.bround(celsius * 9 / 5 + 32, 2).alias("value_f"),
        F.trim(F.substring("__cell", 6, 1)).alias("mflag"), F.trim(F.substring("__cell", 7, 1)).alias("qflag"),
        F.trim(F.substring("__cell", 8, 1)).alias("sflag"), clocks.label_available(day).alias("label_available_ts"),
    ).where(F.col("value_c").isNotNull())


def station_lines(lines: DataFrame) -> DataFrame:
    """Station list: id, latitude, longitude, elevation, state, name; short or broken lines are skipped."""
    p = F.split(F.trim("value"), r"\s+")
    out = lines.where(F.size(p) >= 6).select(
        F.get(p, F.lit(0)).alias("station_id"), F.get(p, F.lit(1)).try_cast("double").alias("lat"), F.get(p, F.lit(2)).try_cast("double").alias("lon"),
        F.get(p, F.lit(3)).try_cast("double").alias("elevation_m"), F.get(p, F.lit(4)).alias("state"),
        F.array_join(F.slice(p, F.lit(6), F.size(p)), " ").alias("name"))
    return out.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("elevation_m").isNotNull())


def inventory_lines(lines: DataFrame, elements: Sequence[str] = ("TMAX", "TMIN")) -> DataFrame:
    """Station inventory: a map of element to (first year, last year). Elements are few, so the map is small."""
    p = F.split(F.trim("value"), r"\s+")
    rows = lines.where(F.size(p) == 6).select(
        F.get(p, F.lit(0)).alias("station_id"), F.get(p, F.lit(3)).alias("element"), F.get(p, F.lit(4)).try_cast("int").alias("first"), F.get(p, F.lit(5)).try_cast("int").alias("last"))
    rows = rows.where(F.col("element").isin(*elements))
    single = rows.groupBy("station_id", "element").agg(F.max(F.struct("first", "last")).alias("years"))
    return single.groupBy("station_id").agg(F.map_from_entries(F.collect_list(F.struct("element", "years"))).alias("years"))


def index_lines(lines: DataFrame) -> DataFrame:
    """Seasonal climate index: season, year, mean and anomaly."""
    p = F.split(F.trim("value"), r"\s+")
    out = lines.where((F.size(p) == 4) & (F.get(p, F.lit(0)) != "SEAS")).select(
        F.get(p, F.lit(0)).alias("season"), F.get(p, F.lit(1)).try_cast("int").alias("year"), F.get(p, F.lit(2)).try_cast("double").alias("mean_c"), F.get(p, F.lit(3)).try_cast("double").alias("anomaly_c"))
    return out.where(F.col("year").isNotNull() & F.col("mean_c").isNotNull() & F.col("anomaly_c").isNotNull())


BULLETIN_HEADER = r"^\s*([A-Z0-9]{4})\s+.*?(\d{1,2}/\d{1,2}/\d{4})\s+(\d{4})\s+UTC"


def station_bulletins(texts: DataFrame, doc: str = "file_name") -> DataFrame:
    """Bulletin blocks as (station, cycle, valid time, field, value) rows.

    The header and hour lines apply to the lines below them; they are carried down by a running scan
    over line numbers, so that a long bulletin is spread over tasks.
    """
    lines = texts.select(doc, F.posexplode(F.split("text", "\r?\n")).alias("line_no", "line"))
    header = F.col("line").rlike(BULLETIN_HEADER)
    parts = F.filter(F.split(F.trim("line"), r"\s+"), lambda x: x != "")
    marked = lines.withColumns({"__header": F.when(header, F.struct("line_no", "line")), "__parts": parts})
    marked = marked.withColumn("__hours", F.when(F.get("__parts", F.lit(0)) == "UTC", F.struct("line_no", F.col("__parts").alias("p"))))
    carried = running_scan(marked, [doc], ["line_no"], {
        "h": Running("last", F.col("__header")), "u": Running("last", F.col("__hours"))}, F.floor(F.col("line_no") / 1024))
    usable = carried.where(
        ~header & F.col("h").isNotNull() & (F.col("u.line_no") > F.col("h.line_no")) & (F.size("__parts") >= 2)
        & ~F.get("__parts", F.lit(0)).isin("UTC", "1", "2"))
    head = F.col("h.line")
    day, hhmm = F.regexp_extract(head, BULLETIN_HEADER, 2), F.regexp_extract(head, BULLETIN_HEADER, 3)
    cycle = F.try_to_timestamp(F.concat(day, F.lit(" "), hhmm), F.lit("M/d/yyyy HHmm"))
    width = F.least(F.size("u.p") - 1, F.size("__parts") - 1)
    rows = usable.withColumn("__cycle", cycle).withColumn("i", F.explode(F.sequence(F.lit(1), width)))
    hour = F.get("u.p", F.col("i")).try_cast("int")
    valid = clocks.shift_hours(F.col("__cycle"), hour - F.hour("__cycle"))
    valid = F.when(valid < F.col("__cycle"), clocks.shift_hours(valid, F.lit(24))).otherwise(valid)
    value = F.get("__parts", F.col("i"))
    return rows.select(
        doc, F.regexp_extract(head, BULLETIN_HEADER, 1).alias("station"), F.col("__cycle").alias("initialization_time_utc"), valid.alias("valid_time_utc"),
        F.get("__parts", F.lit(0)).alias("field"), value.alias("value_text"), clocks.to_number(value).alias("value"))


def climate_products(texts: DataFrame, use_name_date: bool = False) -> DataFrame:
    """Daily climate report texts, every issuance kept; publication time comes from the file name."""
    digits = F.regexp_extract("file_name", r"_(\d{12})(?:\d{2})?\.txt$", 1)
    published = F.try_to_timestamp(digits, F.lit("yyyyMMddHHmm"))
    named = F.regexp_extract("text", r"SUMMARY FOR ([A-Z]+ \d{1,2} \d{4})", 1)
    day = F.to_date(F.try_to_timestamp(F.initcap(named), F.lit("MMMM d yyyy")))
    if use_name_date:
        day = F.coalesce(day, F.to_date(published))

    def reading(label: str) -> Column:
        return F.regexp_extract("text", r"(?m)^\s*" + label + r"\s+(-?\d+|MM)\b", 1).try_cast("int")

    out = texts.select(
        *[c for c in texts.columns if c != "text"], day.alias("climate_date"), reading("MAXIMUM").alias("official_daily_high_f"),
        reading("MINIMUM").alias("official_daily_low_f"), published.alias("publication_time_utc"), published.alias("revision_timestamp_utc"))
    return out.where(F.col("climate_date").isNotNull() & (F.col("official_daily_high_f").isNotNull() | F.col("official_daily_low_f").isNotNull()))


NUMERIC_FIELDS = ("tmpf", "dwpf", "relh", "drct", "sknt", "gust", "p01i", "alti", "mslp", "vsby", "skyl1", "skyl2", "skyl3", "skyl4")


def metar_rows(rows: DataFrame, zone: Column | str, order: Sequence[Column]) -> DataFrame:
    """Normalised METAR rows: UTC time, civil local date, numbers with missing tokens, remark groups; first row per key."""
    valid = F.try_to_timestamp(F.trim("valid"), F.lit("yyyy-MM-dd HH:mm"))
    numbers = {n: clocks.to_number(F.col(n)) for n in NUMERIC_FIELDS if n in rows.columns}
    raw = F.trim(F.coalesce("metar", F.lit("")))
    out = rows.where((F.trim("station") != "") & valid.isNotNull()).withColumns({
        **numbers, "station": F.trim("station"), "valid_utc": valid, "raw_metar": raw, "local_date": clocks.local_date(valid, zone),
        **text.metar_remarks(raw)}).drop("valid", "metar")
    return keep_latest(out, ["station", "valid_utc"], list(order), earliest=True)
