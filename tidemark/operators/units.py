"""Decoded grid points to named variables in report units, with wind speeds from components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Variable by code, its report unit, and the factor and offset that lead there.
VARIABLES = (
    ("2t", "temperature_2m", "F", 1.8, -459.67),
    ("2d", "dewpoint_2m", "F", 1.8, -459.67),
    ("10si", "wind_speed_10m", "mph", 2.2369362920544, 0.0),
    ("10wdir", "wind_direction_10m", "degree", 1.0, 0.0),
    ("10u", "wind_u_10m", "mph", 2.2369362920544, 0.0),
    ("10v", "wind_v_10m", "mph", 2.2369362920544, 0.0),
    ("tcc", "cloud_cover", "fraction", 1.0, 0.0),
    ("tp", "total_precipitation", "m", 1.0, 0.0),
    ("gust", "wind_gusts_10m", "mph", 2.2369362920544, 0.0),
    ("10fg", "wind_gusts_10m", "mph", 2.2369362920544, 0.0),
    ("prmsl", "pressure_msl", "hPa", 0.01, 0.0),
    ("pres", "pressure_surface", "hPa", 0.01, 0.0),
    ("sp", "pressure_surface", "hPa", 0.01, 0.0),
    ("dswrf", "shortwave_radiation", "W/m2", 1.0, 0.0),
    ("sdswrf", "shortwave_radiation", "W/m2", 1.0, 0.0),
    ("cape", "cape", "J/kg", 1.0, 0.0),
    ("cin", "cin", "J/kg", 1.0, 0.0),
    ("hgt", "geopotential_height_500hpa", "gpm", 1.0, 0.0),
    ("gh", "geopotential_height_pressure_level", "gpm", 1.0, 0.0),
    ("t", "temperature_pressure_level", "F", 1.8, -459.67),
    ("u", "wind_u_pressure_level", "mph", 2.2369362920544, 0.0),
    ("v", "wind_v_pressure_level", "mph", 2.2369362920544, 0.0),
)
# Names at single pressure levels, by code and level.
LEVELS = {
    ("t", 700): "temperature_700hpa", ("t", 850): "temperature_850hpa", ("t", 925): "temperature_925hpa",
    ("gh", 500): "geopotential_height_500hpa", ("u", 850): "wind_u_850hpa", ("v", 850): "wind_v_850hpa",
}
# Speeds made from two components.
SPEEDS = (("wind_u_10m", "wind_v_10m", "wind_speed_10m"), ("wind_u_850hpa", "wind_v_850hpa", "wind_850hpa"))


def _lookup(rows: dict[str, Column], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[c for k, v in rows.items() for c in (F.lit(k), v)]), key)


def point_variables(points: DataFrame) -> DataFrame:
    """Adds ``variable`` and ``unit`` to (code, level, value) rows and converts ``value``; unknown codes are left out.

    A missing level is the surface, a missing value stays missing.
    """
    spec = {code: F.struct(F.lit(name).alias("name"), F.lit(unit).alias("unit"), F.lit(scale).alias("scale"), F.lit(shift).alias("shift"))
            for code, name, unit, scale, shift in VARIABLES}
    own = _lookup({f"{code}@{level}": F.lit(name) for (code, level), name in LEVELS.items()}, F.concat_ws("@", "code", F.coalesce("level", F.lit(0))))
    known = points.where(F.col("code").isin(*spec)).withColumn("__spec", _lookup(spec, F.col("code")))
    return known.withColumns({
        "variable": F.coalesce(own, F.col("__spec.name")), "unit": F.col("__spec.unit"),
        "value": F.col("value").cast("double") * F.col("__spec.scale") + F.col("__spec.shift")}).drop("__spec")


def add_speeds(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(``keys``, variable, unit, value) and a speed row where a group has both components but not the speed.

    Of several rows of one variable in a group the largest value counts. One grouping serves all speeds.
    """
    names = {name for speed in SPEEDS for name in speed}
    wide = rows.where(F.col("variable").isin(*sorted(names))).groupBy(*keys).agg(
        *[F.max(F.when(F.col("variable") == name, F.col("value"))).alias(f"__{name}") for name in sorted(names)])
    made = [F.when(F.col(f"__{speed}").isNull(), F.struct(F.lit(speed).alias("variable"), F.hypot(f"__{u}", f"__{v}").alias("value"))) for u, v, speed in SPEEDS]
    speeds = wide.select(*keys, F.explode(F.array(*made)).alias("__made")).where(F.col("__made.value").isNotNull())
    return rows.select(*keys, "variable", "unit", "value").unionByName(
        speeds.select(*keys, "__made.variable", F.lit("mph").alias("unit"), "__made.value"))
