"""Running state of a station's day, sequence checks, canonical rows and sequence windows.

Windows over (station, local date) are safe because rows are first collapsed to one per reported
instant: a station's day then holds at most one row per minute or second of 24 hours, however many
copies arrived. Histories longer than a day go through ``timeline``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clocks, encode, numeric
from .filters import REASON, first_reason, split
from .timeline import Running, keep_latest, overlap_chunks, running_scan, time_segment

MINUTE = 60_000_000
LAGS = (5, 15, 30, 60)


def one_per_instant(obs: DataFrame, order: Sequence[Column], keys: Sequence[str] = ("station", "valid_utc")) -> DataFrame:
    return keep_latest(obs, list(keys), order, earliest=True)


def _day_window() -> Window:
    return Window.partitionBy("station", "local_date").orderBy(F.unix_micros("valid_utc"))


def running_extremes(obs: DataFrame, ties: str = "first") -> DataFrame:
    """Highest and lowest temperature so far in the local day, and minutes since each.

    ``ties="first"`` keeps the first time of a tied high, ``"latest"`` takes the newest; a tied low
    always keeps the first. Input: one row per station and instant.
    """
    upto = _day_window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.unix_micros("valid_utc")
    temp = F.col("tmpf")
    high_tie = -at if ties == "first" else at
    high = F.max(F.when(temp.isNotNull(), F.struct(temp.alias("v"), high_tie.alias("k")))).over(upto)
    low = F.min(F.when(temp.isNotNull(), F.struct(temp.alias("v"), at.alias("k")))).over(upto)
    out = obs.withColumn("__high", high).withColumn("__low", low)
    high_at = -F.col("__high.k") if ties == "first" else F.col("__high.k")
    return out.withColumns({
        "observed_high_so_far_f": F.col("__high.v"), "observed_low_so_far_f": F.col("__low.v"),
        "minutes_since_daily_high": (at - high_at) / F.lit(6.0e7),
        "minutes_since_daily_low": (at - F.col("__low.k")) / F.lit(6.0e7),
    }).drop("__high", "__low")


def value_before(column: str, minutes: int) -> Column:
    """Value in the last row at or before this many minutes ago; a NULL there stays NULL."""
    frame = _day_window().rangeBetween(Window.unboundedPreceding, -minutes * MINUTE)
    return F.last(F.col(column)).over(frame)


def recent_changes(obs: DataFrame) -> DataFrame:
    """Changes of temperature over four look-backs and of dew point, wind and sky over an hour."""
    def change(column: str, minutes: int) -> Column:
        return F.bround(F.col(column) - value_before(column, minutes), 3)

    out = obs.withColumns({
        **{f"temperature_change_{k}m_f": change("tmpf", k) for k in LAGS},
        "dewpoint_change_60m_f": change("dwpf", 60),
        "wind_speed_change_60m_kt": change("sknt", 60),
        # The plain difference, without wrapping at north.
        "wind_direction_change_60_deg": change("drct", 60),
        "__sky": value_before("sky", 60),
    })
    acceleration = (F.col("temperature_change_30m_f") - F.col("temperature_change_60m_f")) / 30
    return out.withColumns({
        "recent_temperature_acceleration_f_per_min2": F.bround(acceleration, 5),
        "cloud_change_60m": F.when(
            F.nullif(F.col("__sky"), F.lit("")).isNotNull(),
            (F.trim(F.coalesce("sky", F.lit(""))) != F.col("__sky")).cast("int")),
    }).drop("__sky")


def intraday_state(obs: DataFrame, order: Sequence[Column], lat: Column | None = None,
                   lon: Column | None = None, zone: Column | str | None = None,
                   ties: str = "first") -> DataFrame:
    """The state table: extremes so far, recent changes, sun clocks, local hour and day of year.

    All window columns share one partitioning and order, so the plan has one shuffle after the
    collapse of copies.
    """
    rows = recent_changes(running_extremes(one_per_instant(obs, order), ties))
    extra = {
        "best_estimated_official_high_so_far_f": F.col("observed_high_so_far_f"),
        "best_estimated_official_low_so_far_f": F.col("observed_low_so_far_f"),
        "feature_asof_utc": F.col("valid_utc"),
    }
    zone = zone if zone is not None else "UTC"
    extra["local_hour"] = clocks.local_hour(F.col("valid_utc"), zone)
    extra["day_of_year"] = F.dayofyear("local_date")
    if lat is not None and lon is not None:
        sun = numeric.solar_day(F.col("local_date"), lat, lon)
        rise = numeric.minutes_after_midnight(F.col("local_date"), sun["sunrise_min"])
        fall = numeric.minutes_after_midnight(F.col("local_date"), sun["sunset_min"])
        extra["minutes_since_sunrise"] = clocks.age_minutes(F.col("valid_utc"), rise)
        extra["minutes_until_sunset"] = clocks.age_minutes(fall, F.col("valid_utc"))
    return rows.withColumns(extra)


def check_state(states: DataFrame) -> DataFrame:
    """Recompute the running extremes of stored states and count what does not agree or go one way."""
    upto = _day_window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w = _day_window()
    eps = F.lit(1e-6)
    high, low = F.col("observed_high_so_far_f"), F.col("observed_low_so_far_f")
    marked = states.withColumns({
        "__mx": F.max("tmpf").over(upto), "__mn": F.min("tmpf").over(upto),
        "__ph": F.last(high, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "__pl": F.last(low, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
    })
    return marked.groupBy("station").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("local_date").alias("station_days"),
        F.count_if(F.abs(high - F.col("__mx")) > eps).alias("high_mismatch"),
        F.count_if(F.abs(low - F.col("__mn")) > eps).alias("low_mismatch"),
        F.count_if(high + eps < F.col("__ph")).alias("high_not_monotone"),
        F.count_if(low - eps > F.col("__pl")).alias("low_not_monotone"))


def canonical_rows(obs: DataFrame, fields: Sequence[str], raw: str, ordinal: str) -> tuple[DataFrame, DataFrame]:
    """Best row per (station, valid_utc): most populated fields, then the hash of the raw text.

    Returns the winners and a ledger that marks every row retained or superseded. ``ordinal`` tells
    exact copies apart; the smallest is kept.
    """
    def populated(name: str) -> Column:
        text = F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))
        return (~text.isin("", "M", "NA", "null")).cast("int")

    scored = obs.withColumn("score", sum((populated(f) for f in fields), F.lit(0))).withColumn(
        "row_sha256", encode.text_sha256(F.coalesce(F.col(raw), F.lit(""))))
    rank = [F.col("score"), F.col("row_sha256"), -F.col(ordinal)]
    winners = keep_latest(scored, ["station", "valid_utc"], rank)
    chosen = winners.select("station", "valid_utc", F.col(ordinal).alias("__best"))
    ledger = scored.join(chosen, ["station", "valid_utc"]).select(
        "station", "valid_utc", ordinal, "row_sha256", "score",
        F.when(F.col(ordinal) == F.col("__best"), "retained").otherwise("superseded").alias("decision"))
    return winners.drop("score", "row_sha256"), ledger


def sequence_windows(states: DataFrame, labels: DataFrame, features: Sequence[str], window: int = 12,
                     stride: int = 1, max_gap_minutes: float | None = None,
                     chunk: int = 512) -> tuple[DataFrame, DataFrame]:
    """Fixed-length windows of a city's day with the day's label, for both extremes.

    Rows are numbered per day and spread over overlapping chunks, so that a window of ``window``
    rows never needs the whole day in one place.
    """
    label = labels.select("city", F.col("date").alias("local_date"), "label_available_ts", "tmax_f", "tmin_f")
    keyed = states.where(F.col("city").isNotNull() & F.col("local_date").isNotNull() & F.col("feature_asof_utc").isNotNull())
    numbered = running_scan(
        keyed.select("city", "local_date", "feature_asof_utc", *features), ["city", "local_date"],
        ["feature_asof_utc", *features], {"row_no": Running("sum", F.lit(1))}, time_segment("feature_asof_utc"))
    joined = numbered.join(label, ["city", "local_date"], "left")
    unlabelled = joined.where(F.col("label_available_ts").isNull()).select("city", "local_date").distinct().withColumn(
        REASON, F.lit("missing_label"))
    spread = overlap_chunks(joined.where(F.col("label_available_ts").isNotNull()), "row_no", max(chunk, window), window - 1)
    inside = Window.partitionBy("city", "local_date", "chunk").orderBy("row_no")
    last_rows = inside.rowsBetween(-(window - 1), Window.currentRow)
    gap = clocks.age_minutes(F.col("feature_asof_utc"), F.lag("feature_asof_utc").over(inside))
    spread = spread.withColumn("__gap", gap)
    vector = F.array(*[F.col(f).cast("double") for f in features])
    framed = spread.withColumns({
        "sequence": F.collect_list(vector).over(last_rows),
        "window_start_utc": F.first("feature_asof_utc").over(last_rows),
        "__gap": F.max("__gap").over(inside.rowsBetween(-(window - 2), Window.currentRow)),
    }).where(F.col("own") & (F.col("row_no") >= window) & ((F.col("row_no") - window) % max(1, stride) == 0))
    rules = [(F.col("label_available_ts") <= F.col("feature_asof_utc"), "label_not_available_asof")]
    if max_gap_minutes is not None:
        rules.append((F.col("__gap") > max_gap_minutes, "sequence_gap"))
    good, bad = split(framed.withColumn(REASON, first_reason(*rules)))
    sides = F.explode(F.array(
        F.struct(F.lit("high").alias("t"), F.col("tmax_f").alias("v")),
        F.struct(F.lit("low").alias("t"), F.col("tmin_f").alias("v")))).alias("side")
    rows = good.select("*", sides).select(
        "city", "local_date", F.col("side.t").alias("temp_type"), F.col("feature_asof_utc").alias("decision_time_utc"),
        "label_available_ts", F.col("side.v").alias("observed_f"), "window_start_utc",
        F.lit(window).alias("window_rows"), F.to_json("sequence").alias("sequence_json"))
    return rows, bad.select("city", "local_date", REASON).unionByName(unlabelled)


def sequence_health(messages: DataFrame, keys: Sequence[str] = ("connection_epoch", "sid")) -> DataFrame:
    """Per frame: the previous frame's seq and the highest before it, and gap, reset and stale flags."""
    out = running_scan(messages, keys, ["received_ts", "event_id"], {
        "prior_seq": Running("last", F.col("seq"), exclusive=True),
        "prior_max": Running("max", F.col("seq"), exclusive=True),
    }, time_segment("received_ts"))
    return out.withColumns({
        "gap": F.coalesce(F.col("seq") > F.col("prior_seq") + 1, F.lit(False)),
        "reset": F.coalesce(F.col("seq") <= F.col("prior_seq"), F.lit(False)),
        "stale": F.coalesce(F.col("seq") <= F.col("prior_max"), F.lit(False)),
        "accepted_gap": F.coalesce(F.col("seq") > F.col("prior_max") + 1, F.lit(False)),
    })


def latest_session(messages: DataFrame) -> DataFrame:
    """Rows of the newest connection epoch."""
    newest = messages.select(F.max("connection_epoch")).scalar()
    return messages.where(F.col("connection_epoch") == newest)


def drawdown(returns: DataFrame, keys: Sequence[str], order: str, value: str, additive: bool = False,
             segment: int = 4096) -> DataFrame:
    """Largest fall from a peak: of multiplied equity, or of summed profit with ``additive``."""
    step = F.col(value) if additive else F.log1p(F.col(value))
    part = F.floor(F.col(order) / segment)
    path = running_scan(returns, keys, [order], {"__level": Running("sum", step)}, part)
    path = running_scan(path, keys, [order], {"__peak": Running("max", F.col("__level"))}, part)
    peak = F.greatest(F.col("__peak"), F.lit(0.0))
    fall = peak - F.col("__level") if additive else F.lit(1.0) - F.exp(F.col("__level") - peak)
    return path.groupBy(*keys).agg(
        F.max(F.greatest(fall, F.lit(0.0))).alias("max_drawdown"), F.count(F.lit(1)).alias("observations"))


def bucket_gaps(buckets: DataFrame) -> DataFrame:
    """Overlaps, gaps over one degree, unparsed bounds and duplicate tickers per event."""
    copies = buckets.groupBy("event_ticker", "market_ticker").agg(
        F.count(F.lit(1)).alias("__n"), F.max("bucket_floor_f").alias("floor"), F.max("bucket_ceil_f").alias("ceil"))
    order = Window.partitionBy("event_ticker").orderBy(
        F.col("floor").asc_nulls_first(), F.col("ceil").asc_nulls_last(), "market_ticker")
    known = F.col("floor").isNotNull() | F.col("ceil").isNotNull()
    before = F.last(F.when(known, F.col("ceil")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = copies.withColumn("__before", before)
    return marked.groupBy("event_ticker").agg(
        F.count(F.lit(1)).alias("markets"), F.count_if(~known).alias("unparsed"),
        F.sum(F.col("__n") - 1).alias("duplicate_tickers"),
        F.count_if(F.col("floor") <= F.col("__before")).alias("overlaps"),
        F.count_if(F.col("floor") > F.col("__before") + 1).alias("gaps"),
        F.count_if(F.col("floor").isNull() & known).alias("open_low"),
        F.count_if(F.col("ceil").isNull() & known).alias("open_high"))


def first_last_revision(rows: DataFrame, keys: Sequence[str], clock: str, columns: Sequence[str]) -> DataFrame:
    """Earliest and latest revision of each day side by side, with the number of revisions."""
    row = F.struct(*[F.col(c) for c in columns])
    rank = F.struct(F.col(clock), row)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("revisions"),
        F.min_by(row, rank).alias("first"), F.max_by(row, rank).alias("last"))


def first_receipt(rows: DataFrame, identity: str, receipt: str, fields: Sequence[str]) -> DataFrame:
    """Earliest receipt per immutable id; ``conflict`` marks ids whose identity fields differ."""
    facts = rows.groupBy(identity, *fields).agg(F.min(receipt).alias("__first"), F.count(F.lit(1)).alias("__n"))
    keep = F.struct(*fields)
    return facts.groupBy(identity).agg(
        F.min("__first").alias(receipt), F.min_by(keep, F.struct("__first", keep)).alias("__kept"),
        (F.count(F.lit(1)) > 1).alias("conflict"), F.sum("__n").cast("long").alias("receipts"),
    ).select(identity, receipt, *[F.col(f"__kept.{f}").alias(f) for f in fields], "conflict", "receipts")
