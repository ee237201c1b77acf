"""Clocks, dates and point-in-time predicates as Columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that stands for "no value" in the archives.
MISSING_TOKENS = ("", "M", "T", "null", "NA", "None", "-9999")

# Month abbreviations in contract tickers.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

# Column names that may carry an issue or a receipt clock, in order of preference.
ISSUE_FIELDS = (
    "forecast_issue_time", "initialization_time_utc", "issue_time_utc", "publication_time_utc",
)
RECEIPT_FIELDS = (
    "source_receipt_time", "receipt_time_utc", "retrieved_at", "ingested_at_utc", "ingested_at",
)

ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def require_columns(df: DataFrame, names: Sequence[str], label: str) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{label} lacks required columns: {missing}")


def to_number(value: Column) -> Column:
    """Number from text; missing tokens, booleans and junk become NULL."""
    text = F.trim(value.cast("string"))
    usable = ~text.isin(*MISSING_TOKENS) & text.rlike(NUMBER_PATTERN)
    return F.when(usable, text.try_cast("double"))


def finite(value: Column) -> Column:
    """NULL for NaN and infinities."""
    number = value.cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def parse_utc(value: Column) -> Column:
    """ISO-8601 text to an instant; text without an offset is UTC, junk is NULL."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(ISO_PATTERN), text.try_cast("timestamp"))


def clock(df: DataFrame, name: str) -> Column:
    """Column ``name`` as an instant, whatever it is stored as."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.col(name)
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp")
    return parse_utc(F.col(name))


def first_clock(df: DataFrame, names: Sequence[str]) -> Column:
    """First parseable clock among those of ``names`` that the table has."""
    present = [clock(df, name) for name in names if name in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("timestamp")


def render_utc(instant: Column) -> Column:
    """Canonical text ending in Z, with microseconds only where there are some."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    parts = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.unix_micros(instant) % 1_000_000 == 0, whole).otherwise(parts)


def local_date(instant: Column, zone: Column | str) -> Column:
    """Civil date in an IANA zone, daylight saving included."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def local_hour(instant: Column, zone: Column | str) -> Column:
    return F.hour(F.from_utc_timestamp(instant, zone))


def shift_hours(instant: Column, hours: Column) -> Column:
    return instant + F.make_dt_interval(F.lit(0), hours.cast("int"))


def shift_seconds(instant: Column, seconds: Column) -> Column:
    return F.timestamp_micros(
        F.unix_micros(instant) + F.round(seconds * F.lit(1_000_000.0)).cast("long")
    )


def standard_day(instant: Column, utc_offset_hours: Column) -> Column:
    """Settlement day: the 24 h day in fixed standard time that holds the instant."""
    return F.to_date(shift_hours(instant, utc_offset_hours))


def standard_window_start(day: Column, utc_offset_hours: Column) -> Column:
    return shift_hours(day.cast("timestamp"), -utc_offset_hours)


def january_offset_hours(day: Column, zone: Column | str) -> Column:
    """UTC offset the zone has on 1 January of the day's year, the standard-time offset."""
    noon = shift_hours(F.trunc(day, "year").cast("timestamp"), F.lit(12))
    micros = F.unix_micros(F.from_utc_timestamp(noon, zone)) - F.unix_micros(noon)
    return (micros / F.lit(3.6e9)).cast("int")


def label_available(day: Column, hours: int = 36) -> Column:
    """A daily label is taken as published this many hours after its day starts."""
    return shift_hours(day.cast("timestamp"), F.lit(hours))


def age_minutes(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(6.0e7)


def first_text(*values: Column) -> Column:
    """First value that is not blank after trimming, else NULL."""
    return F.coalesce(*[F.nullif(F.trim(v.cast("string")), F.lit("")) for v in values])


def first_number(*values: Column) -> Column:
    """First value that parses to a finite number, else NULL."""
    return F.coalesce(*[finite(to_number(v)) for v in values])


def available_asof(issue: Column, receipt: Column, decision: Column) -> Column:
    """True only where both clocks are known and not after the decision; never NULL."""
    return F.coalesce((issue <= decision) & (receipt <= decision), F.lit(False))


def ticker_date(ticker: Column) -> Column:
    """Date in a ticker such as ``…-26SEP10``; a later ``-`` part is allowed, junk gives NULL."""
    pattern = r"-(\d{2})([A-Z]{3})(\d{2})(?:$|-)"
    month = F.array_position(
        F.array(*[F.lit(m) for m in MONTHS]), F.regexp_extract(ticker, pattern, 2)
    )
    text = F.concat(
        F.lit("20"), F.regexp_extract(ticker, pattern, 1), F.lit("-"),
        F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.regexp_extract(ticker, pattern, 3),
    )
    return F.when(ticker.rlike(pattern) & (month > 0), text.try_cast("date"))


def lead_bucket(lead_hours: Column) -> Column:
    """Lead time to the nearest six hours, halves to even."""
    return (F.bround(lead_hours / F.lit(6.0)) * 6).cast("int")


def exchange_instant(ts_ms: Column, ts_number: Column, ts_text: Column) -> Column:
    """Exchange time from ``ts_ms``, a numeric ``ts`` (seconds below 1e10, else ms) or ISO text."""
    number_ms = F.when(ts_number < F.lit(1e10), ts_number * 1000).otherwise(ts_number)
    return F.coalesce(
        F.timestamp_millis(ts_ms.cast("long")),
        F.timestamp_millis(number_ms.cast("long")),
        parse_utc(ts_text),
    )
