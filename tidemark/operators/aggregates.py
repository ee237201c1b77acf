"""Grouped summaries. All are built from aggregates that combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .timeline import keep_latest

LEVELS = (
    ("city", "model_name", "temp_type", "lead_bucket", "month"),
    ("city", "model_name", "temp_type", "lead_bucket"),
    ("city", "model_name", "temp_type"),
    ("city", "temp_type"),
)


def moments(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Count, mean, population spread (NULL for one row or no spread) and sample spread."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        F.when(F.count(value) > 1, F.nullif(F.stddev_pop(value), F.lit(0.0))).alias("spread_pop"),
        F.when(F.count(value) > 1, F.stddev_samp(value)).alias("spread_samp"),
    )


def exceedance(df: DataFrame, keys: Sequence[str], value: Column, thresholds: Sequence[float]) -> DataFrame:
    return df.groupBy(*keys).agg(*[
        F.avg((value >= F.lit(float(k))).cast("double")).alias(f"prob_ge_{k:g}") for k in thresholds])


def extremes(df: DataFrame, keys: Sequence[str], value: str, instant: str, ties: str = "latest_high") -> DataFrame:
    """Highest and lowest value with their instants.

    ``latest_high``: a tied high takes the latest instant, a tied low the earliest.
    ``first_seen``: both take the earliest.
    """
    v, t = F.col(value), F.col(instant)
    back = -F.unix_micros(t)
    high_rank = F.struct(v, t) if ties == "latest_high" else F.struct(v, back)
    known = v.isNotNull()
    return df.groupBy(*keys).agg(
        F.count(v).alias("observation_count"),
        F.max(v).alias("tmax_f"), F.max_by(t, F.when(known, high_rank)).alias("tmax_utc"),
        F.min(v).alias("tmin_f"), F.min_by(t, F.when(known, F.struct(v, t))).alias("tmin_utc"),
    )


def daily_completeness(df: DataFrame, keys: Sequence[str], value: str, instant: str, complete_at: int = 18) -> DataFrame:
    """Observation and missing counts, first and last time, and a completeness flag per day."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("obs_count"), F.count_if(F.col(value).isNull()).alias("missing_count"),
        F.min(instant).alias("first_obs_utc"), F.max(instant).alias("last_obs_utc"),
        (F.count(F.lit(1)) >= complete_at).alias("is_complete"),
    )


def pivot_elements(df: DataFrame, keys: Sequence[str], elements: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key with the columns of each element side by side; the last row per element wins."""
    row = F.struct(*columns)
    aggregates = []
    for element in elements:
        hit = F.col("element") == element
        best = F.max_by(row, F.when(hit, row))
        aggregates += [best.getField(c).alias(f"{element.lower()}_{c}") for c in columns]
    return df.groupBy(*keys).agg(*aggregates)


def add_wind_speed(df: DataFrame, keys: Sequence[str], u: str = "wind_u_10m", v: str = "wind_v_10m",
                   speed: str = "wind_speed_10m") -> DataFrame:
    """Add a speed row to each group that has both components and no speed of its own."""
    def of(name: str) -> Column:
        return F.max(F.when(F.col("variable") == name, F.col("value")))

    parts = df.groupBy(*keys).agg(of(u).alias("__u"), of(v).alias("__v"), of(speed).alias("__s"))
    made = parts.where(F.col("__s").isNull() & F.col("__u").isNotNull() & F.col("__v").isNotNull()).select(
        *keys, F.lit(speed).alias("variable"), F.hypot("__u", "__v").alias("value"))
    return df.select(*keys, "variable", "value").unionByName(made)


def joined_set(value: Column, separator: str = "|") -> Column:
    """Sorted distinct values as one text."""
    return F.array_join(F.array_sort(F.collect_set(value)), separator)


def by_level(df: DataFrame) -> DataFrame:
    """Rows repeated for the four fallback levels, with the columns a level ignores set to NULL.

    ``level`` is 0 for the narrowest. This is the expansion a GROUPING SETS clause performs.
    """
    names = LEVELS[0]
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("level"), *[
            (F.col(n) if n in level else F.lit(None).cast(df.schema[n].dataType)).alias(n) for n in names])
        for i, level in enumerate(LEVELS)
    ])).alias("__k")
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, rows).select(*rest, "__k.*")


def grouping_levels(df: DataFrame, aggregates: dict[str, str], min_rows: int, extra: Sequence[str] = ()) -> DataFrame:
    """Aggregates at the four fallback levels in one pass (GROUPING SETS), kept from ``min_rows`` up.

    ``aggregates`` maps output names to SQL aggregate expressions; ``extra`` keys are in every level.
    """
    names = [*extra, *LEVELS[0]]
    groups = [[F.col(c) for c in (*extra, *level)] for level in LEVELS]
    grouped = df.groupingSets(groups, *names)
    level = F
    for i, columns in enumerate(LEVELS):
        bits = sum(1 << (len(names) - 1 - p) for p, n in enumerate(names) if n not in (*extra, *columns))
        level = level.when(F.col("__gid") == bits, F.lit(i))
    out = grouped.agg(
        F.grouping_id(*names).alias("__gid"), F.count(F.lit(1)).alias("n"),
        *[F.expr(sql).alias(name) for name, sql in aggregates.items()])
    return out.where(F.col("n") >= min_rows).withColumn("level", level).drop("__gid")


def regression(x: str, y: str) -> dict[str, str]:
    """Aggregate SQL of a least-squares line: slope 0 when x hardly varies, and the RMS residual."""
    sxx = f"(var_pop({x}) * count({x}))"
    slope = f"if({sxx} > 1e-12D, covar_pop({x}, {y}) / var_pop({x}), 0.0D)"
    # Residual mean square from the centred sums: Syy - 2bSxy + b2Sxx.
    rss = f"greatest(var_pop({y}) - 2 * {slope} * covar_pop({x}, {y}) + {slope} * {slope} * var_pop({x}), 0.0D)"
    return {
        "slope": slope, "intercept": f"avg({y}) - {slope} * avg({x})", "residual_rms": f"sqrt({rss})",
    }


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.nullif(F.sum(weight).cast("double"), F.lit(0.0))


def category_counts(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    label = F.coalesce(F.nullif(F.trim(F.col(column).cast("string")), F.lit("")), F.lit("missing"))
    return df.groupBy(*keys, label.alias("category")).agg(F.count(F.lit(1)).alias("n"))


def deviation(df: DataFrame, keys: Sequence[str], left: str, right: str, day: str, within: float = 1.0) -> DataFrame:
    """Mean, mean absolute and largest difference, share within a bound, and the worst day."""
    diff = F.col(left) - F.col(right)
    return df.groupBy(*keys).agg(
        F.count(diff).alias("n"), F.avg(diff).alias("mean_diff"), F.avg(F.abs(diff)).alias("mae"),
        F.max(F.abs(diff)).alias("max_abs"), F.avg((F.abs(diff) <= within).cast("double")).alias("share_within"),
        F.max_by(F.col(day), F.struct(F.abs(diff), F.col(day))).alias("worst_day"),
    )


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows beyond the first of each key, counted in two steps so that no key is hot."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def clock_status(df: DataFrame, raw: Column, parsed: Column, as_of: Column) -> DataFrame:
    """Missing, invalid and future clocks in one status row."""
    blank = raw.isNull() | (F.trim(raw.cast("string")) == "")
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(blank).alias("missing"),
        F.count_if(~blank & parsed.isNull()).alias("invalid"),
        F.count_if(parsed > as_of).alias("after_as_of"),
    ).withColumn("pass", (F.col("missing") + F.col("invalid") + F.col("after_as_of")) == 0)


def conflicting_keys(df: DataFrame, keys: Sequence[str], identity: Sequence[str]) -> DataFrame:
    """Keys seen more than once, with the number of different identities behind them."""
    distinct = df.groupBy(*keys, *identity).agg(F.count(F.lit(1)).alias("__n"))
    return distinct.groupBy(*keys).agg(
        F.sum("__n").cast("long").alias("repeats"), F.count(F.lit(1)).alias("identities")
    ).where(F.col("repeats") > 1)


def top_groups(df: DataFrame, series: str, event: str, count: int) -> DataFrame:
    """All rows of the ``count`` greatest events of each series."""
    events = df.select(series, event).distinct()
    # A row_number bound lets Spark cut each series to ``count`` events before the shuffle.
    newest = Window.partitionBy(series).orderBy(F.col(event).desc())
    kept = events.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= count)
    return df.join(kept.drop("__rank"), [series, event], "left_semi")


def first_distinct(df: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int) -> DataFrame:
    """First row of each distinct key, then the first ``count`` keys in the given order."""
    firsts = keep_latest(df, keys, order, earliest=True)
    return firsts.orderBy(*order).limit(count)


def page(df: DataFrame, order: Sequence[Column], skip: int, count: int) -> DataFrame:
    return df.orderBy(*order).offset(skip).limit(count)
