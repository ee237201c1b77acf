"""Parsers for contract, bulletin and remark text, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clocks import MONTHS

NUMBER = r"(-?\d+(?:\.\d+)?)"

# Spellings of the covered cities.
CITY_ALIASES = {
    "nyc": "nyc", "new_york": "nyc", "la": "la", "los_angeles": "la", "los angeles": "la",
    "austin": "austin", "phx": "phx", "lv": "lv",
}

# What identifies a temperature series in the catalogue.
CLIMATE_CATEGORY = "Climate and Weather"
SERIES_PREFIXES = {"KXTEMP": "hourly", "KXHIGH": "high", "KXLOWT": "low"}


def group(text: Column, pattern: str, index: int = 1) -> Column:
    """Regex group, NULL when the pattern does not match or the group is empty."""
    return F.nullif(F.regexp_extract(text, pattern, index), F.lit(""))


def city_key(value: Column, aliases: dict[str, str] = CITY_ALIASES) -> Column:
    """City by alias, NULL when unknown."""
    pairs = [F.lit(item) for pair in aliases.items() for item in pair]
    return F.element_at(F.create_map(*pairs), F.lower(F.trim(value)))


def _once(value: Column, build) -> Column:
    """``build(value)`` with the value computed once: lambdas would compute it anew at every use."""
    return F.get(F.transform(F.array(value), build), F.lit(0))


def _tokens(text: Column) -> Column:
    """Numbers and side words of a contract text in order, lower case; signs only where no digit stands before."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?<![\d.])-?\d+(?:\.\d+)?|\b(?:to|below|less|above|more)\b"), F.lit(0))


def _readings(text: Column) -> Column:
    """Every way a text can be read as bounds: structs (rank, at, floor, ceil), best first.

    Ranks: 0 ``a to b``, 1 ``b or below``, 2 ``a or above``, 3 ``below b``, 4 ``above a``; ``less`` and ``more`` mean the same.
    """

    def read(tokens: Column, at: Column) -> Column:
        word = [F.get(tokens, at + i) for i in range(3)]
        number = [w.try_cast("double") for w in word]
        under = [w.isin("below", "less") for w in word]
        over = [w.isin("above", "more") for w in word]
        none = F.lit(None).cast("double")
        first, second = number[0].isNotNull(), number[1].isNotNull()

        def reading(rank: int, floor: Column, ceil: Column) -> Column:
            return F.struct(F.lit(rank).alias("rank"), at.alias("at"), floor.alias("floor"), ceil.alias("ceil"))

        return (F.when(first & (word[1] == "to") & number[2].isNotNull(), reading(0, number[0], number[2]))
                .when(first & under[1], reading(1, none, number[0])).when(first & over[1], reading(2, number[0], none))
                .when(under[0] & second, reading(3, none, number[1])).when(over[0] & second, reading(4, number[1], none)))

    def every(tokens: Column) -> Column:
        places = F.filter(F.sequence(F.lit(-1), F.size(tokens) - 1), lambda i: i >= 0)
        return F.array_sort(F.filter(F.transform(places, lambda at: read(tokens, at)), lambda r: r.isNotNull()))

    return _once(_tokens(text), every)


def bucket_bounds(subtitle: Column, title: Column) -> Column:
    """Struct (floor, ceil, label) of a daily bucket.

    A subtitle counts if it has a degree sign and opens with a number; else the title is read.
    """
    sub, text = F.trim(F.coalesce(subtitle, F.lit(""))), F.coalesce(title, F.lit(""))
    opening = F.get(F.filter(_readings(sub), lambda r: (r["rank"] <= 2) & (r["at"] == 0)), F.lit(0))
    best = F.coalesce(F.when(sub.rlike(r"^[\d.].*°"), opening), F.get(_readings(text), F.lit(0)))
    label = F.when(sub != "", sub).otherwise(text)
    return F.struct(best["floor"].alias("floor"), best["ceil"].alias("ceil"), label.alias("label"))


def hourly_bounds(text: Column) -> Column:
    """Struct (floor, ceil) of an hourly bucket subtitle, which has its number before the side."""
    best = F.get(F.filter(_readings(text), lambda r: r["rank"] <= 2), F.lit(0))
    return F.struct(best["floor"].alias("floor"), best["ceil"].alias("ceil"))


def hourly_threshold(ticker: Column, title: Column) -> Column:
    """Struct (threshold, comparison): value behind the ticker's last ``-T``, else behind the title's side word."""
    said = F.get(F.filter(_readings(title), lambda r: r["rank"] >= 3), F.lit(0))
    suffix = F.when(F.contains(ticker, F.lit("-T")), F.substring_index(ticker, "-T", -1).try_cast("double"))
    sides = _tokens(title)
    side = F.when(F.array_contains(sides, "above"), "above").when(F.array_contains(sides, "below"), "below")
    return F.struct(F.coalesce(suffix, said["floor"], said["ceil"]).alias("threshold"), side.alias("comparison"))


def notice_instant(notice: Column, year: Column) -> Column:
    """Instant at which a source-change notice takes effect: its month and day, and the start of its hour range, Eastern time.

    The notice is read as words, numbers and colons: ``effective [weekday] month day ... for the hour[:minute] am|pm ... et``.
    """
    months = F.array(*[F.lit(m.lower()) for m in MONTHS])

    def read(words: Column) -> Column:
        def word(at: Column) -> Column:
            return F.get(words, at)

        def month_at(at: Column) -> Column:
            return F.array_position(months, F.substring(word(at), 1, 3))

        start = F.array_position(words, "effective").cast("int")  # the place behind the word, counted from 0
        at = F.when(month_at(start) > 0, start).when(month_at(start + 1) > 0, start + 1)
        day = F.when(start > 0, F.make_date(year.cast("int"), F.nullif(month_at(at), F.lit(0)).cast("int"), word(at + 1).try_cast("int")))
        places = F.filter(F.sequence(F.lit(-1), F.size(words) - 1), lambda i: i >= 0)
        clock = F.get(F.filter(places, lambda i: (word(i) == "for") & (word(i + 1) == "the") & word(i + 2).try_cast("int").isNotNull()), F.lit(0)) + 2
        split = F.coalesce(word(clock + 1) == ":", F.lit(False))
        half = F.when(split, word(clock + 3)).otherwise(word(clock + 1))
        hour = word(clock).try_cast("int") % 12 + F.when(half == "pm", 12).when(half == "am", 0)
        minute = F.when(split, word(clock + 2).try_cast("int")).otherwise(0)
        local = F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + hour * 3600 + minute * 60)
        return F.when(F.array_contains(words, "et"), F.to_utc_timestamp(local, "America/New_York"))

    return _once(F.regexp_extract_all(F.lower(notice), F.lit(r"[a-z]+|\d+|:"), F.lit(0)), read)


# The groups of the public METAR remark code (T, 1, 2, 4 and 5 groups) in ``metar_remarks``.
def _tenths(digits: Column) -> Column:
    sign = F.when(F.substring(digits, 1, 1) == "1", -1).otherwise(1)
    return sign * F.substring(digits, 2, 3).try_cast("int") / F.lit(10.0)


def metar_remarks(raw: Column) -> dict[str, Column]:
    """Remark groups after RMK: exact temperatures, 6 h and 24 h extremes, pressure tendency."""
    at = F.instr(raw, " RMK ")
    remarks = F.when(at > 0, raw.substr(at + F.lit(5), F.length(raw)))
    exact = r"\bT([01]\d{3})([01]\d{3})\b"
    day = r"\b4([01]\d{3})([01]\d{3})\b"
    tendency = r"\b5(\d)(\d{3})\b"
    return {
        "remark_temp_tenths_c": _tenths(group(remarks, exact, 1)),
        "remark_dewpoint_tenths_c": _tenths(group(remarks, exact, 2)),
        "remark_6h_max_tenths_c": _tenths(group(remarks, r"\b1([01]\d{3})\b", 1)),
        "remark_6h_min_tenths_c": _tenths(group(remarks, r"\b2([01]\d{3})\b", 1)),
        "remark_24h_max_tenths_c": _tenths(group(remarks, day, 1)),
        "remark_24h_min_tenths_c": _tenths(group(remarks, day, 2)),
        "remark_pressure_tendency_code": group(remarks, tendency, 1).try_cast("int"),
        "remark_pressure_change_tenths_hpa":
            group(remarks, tendency, 2).try_cast("int") / F.lit(10.0),
    }


def source_name_url(value: Column) -> Column:
    """Struct (name, url) from a dict literal such as ``{'name': 'A', 'url': 'B'}``, else the text."""
    is_dict = F.trim(value).rlike(r"^\{.*\}$")
    quoted = r"""['"]%s['"]\s*:\s*['"]([^'"]*)['"]"""
    name = F.when(is_dict, F.regexp_extract(value, quoted % "name", 1)).otherwise(
        F.coalesce(value, F.lit(""))
    )
    url = F.when(is_dict, F.regexp_extract(value, quoted % "url", 1)).otherwise(F.lit(""))
    return F.struct(name.alias("name"), url.alias("url"))


def is_temperature_series(category: Column, categories: Column, title: Column, ticker: Column) -> Column:
    climate = (category == CLIMATE_CATEGORY) | F.coalesce(
        F.array_contains(categories, CLIMATE_CATEGORY), F.lit(False)
    )
    named = F.lower(title).contains("temperature")
    for prefix in SERIES_PREFIXES:
        named = named | ticker.startswith(prefix)
    return F.coalesce(climate & named, F.lit(False))


def series_type(ticker: Column) -> Column:
    kind = F
    for prefix, name in SERIES_PREFIXES.items():
        kind = kind.when(ticker.startswith(prefix), name)
    return kind.otherwise("")
