"""Running state and as-of lookups that survive a hot key.

A plain window over ``partitionBy(key).orderBy(time)`` puts the whole history of one key into one
task. Here every key's timeline is cut into time segments. A window runs inside each segment, each
segment is reduced to one summary row, a second window runs over the summaries (one row per key and
segment, so its size follows the calendar and not the data), and what was known before a segment is
carried into it by a join on (key, segment). Results equal those of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows of a key that an array may hold, and rows of a key that one task may order; keys with more are cut into segments or ranges.
FEW, ONE_TASK = 1024, 1 << 18

SEGMENT = "__segment"
INSTANT = "__instant"
WANTED = "__wanted"


@dataclass(frozen=True)
class Running:
    """One running value. ``kind`` is ``sum``, ``max``, ``min`` or ``last`` (NULLs are skipped).

    For ``last``, ``tie`` ranks rows of the same key and instant; the greatest wins.
    """

    kind: str
    value: Column
    tie: Sequence[Column] = field(default_factory=tuple)
    exclusive: bool = False


def _windowed(kind: str, value: Column) -> Column:
    if kind == "last":
        return F.last(value, ignorenulls=True)
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](value)


def _combined(kind: str, carried: Column, local: Column) -> Column:
    if kind == "last":
        return F.coalesce(local, carried)
    if kind == "sum":
        return F.coalesce(carried + local, carried, local)
    return F.greatest(carried, local) if kind == "max" else F.least(carried, local)


def _carry(summary: DataFrame, keys: Sequence[str], kinds: Mapping[str, str],
           ascending: bool = True) -> DataFrame:
    """What each segment inherits: the running combination of all earlier segments' summaries."""
    order = F.col(SEGMENT).asc() if ascending else F.col(SEGMENT).desc()
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(
        *keys, SEGMENT,
        *[_windowed(kind, F.col(name)).over(before).alias(f"__carry_{name}")
          for name, kind in kinds.items()],
    )


def running_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 values: Mapping[str, Running], segment: Column) -> DataFrame:
    """Add running values over (``keys``, ``order``). ``segment`` must not decrease along ``order``.

    ``keys`` must not be NULL and ``order`` must be total within a key.
    """
    raw = {name: f"__value_{name}" for name in values}
    base = df.select("*", segment.alias(SEGMENT),
                     *[spec.value.alias(raw[name]) for name, spec in values.items()])
    inside = Window.partitionBy(*keys, SEGMENT).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = base.select(
        *df.columns, SEGMENT,
        *[_windowed(spec.kind, F.col(raw[name])).over(before if spec.exclusive else upto)
          .alias(f"__local_{name}") for name, spec in values.items()],
    )
    rank = F.struct(*order)

    def reduced(name: str, spec: Running) -> Column:
        value = F.col(raw[name])
        if spec.kind == "last":
            return F.max_by(value, F.when(value.isNotNull(), rank)).alias(name)
        return _windowed(spec.kind, value).alias(name)

    summary = base.groupBy(*keys, SEGMENT).agg(*[reduced(n, s) for n, s in values.items()])
    carried = _carry(summary, keys, {name: spec.kind for name, spec in values.items()})
    joined = local.join(carried, [*keys, SEGMENT], "left")
    return joined.select(
        *df.columns,
        *[_combined(spec.kind, F.col(f"__carry_{name}"), F.col(f"__local_{name}")).alias(name)
          for name, spec in values.items()],
    )


def time_segment(name: str, unit: str = "hour") -> Column:
    return F.date_trunc(unit, F.col(name))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Column,
                name: str) -> DataFrame:
    """Row number per key, 1 upwards."""
    out = running_scan(df, keys, order, {name: Running("sum", F.lit(1))}, segment)
    return out.withColumn(name, F.col(name).cast("long"))


def asof_scan(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: Column,
              right_time: Column, values: Mapping[str, Running], *, inclusive: bool = True,
              backward: bool = True, segment: str = "hour") -> DataFrame:
    """For each left row, running values over the right rows of its key up to its instant.

    ``backward`` looks at right rows at or before the left instant, otherwise at or after it;
    ``inclusive=False`` makes that strict. Both sides are first reduced to one row per key and
    instant, with map-side combining, so copies of one instant never pile up in a window. Left rows
    without a usable key or instant keep NULL values.
    """
    keys = list(on)
    kinds = {name: spec.kind for name, spec in values.items()}
    marks = left.select(*keys, left_time.alias(INSTANT), F.lit(True).alias(WANTED))
    facts = right.select(
        *keys, right_time.alias(INSTANT),
        *[spec.value.alias(name) for name, spec in values.items()],
        *[F.struct(F.lit(0), *spec.tie).alias(f"__tie_{name}")
          for name, spec in values.items() if spec.kind == "last"],
    )
    merged = marks.unionByName(facts, allowMissingColumns=True)
    for name in [*keys, INSTANT]:
        merged = merged.where(F.col(name).isNotNull())

    def collapsed(name: str) -> Column:
        if kinds[name] == "last":
            return F.max_by(
                F.col(name), F.when(F.col(name).isNotNull(), F.col(f"__tie_{name}"))
            ).alias(name)
        return _windowed(kinds[name], F.col(name)).alias(name)

    line = (
        merged.groupBy(*keys, INSTANT)
        .agg(F.max(WANTED).alias(WANTED), *[collapsed(name) for name in kinds])
        .withColumn(SEGMENT, F.date_trunc(segment, F.col(INSTANT)))
    )
    order = F.col(INSTANT).asc() if backward else F.col(INSTANT).desc()
    frame = Window.partitionBy(*keys, SEGMENT).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1
    )
    local = line.select(
        *keys, INSTANT, SEGMENT, WANTED,
        *[_windowed(kind, F.col(name)).over(frame).alias(f"__local_{name}")
          for name, kind in kinds.items()],
    ).where(F.col(WANTED))
    nearest = F.max_by if backward else F.min_by

    def reduced(name: str) -> Column:
        if kinds[name] == "last":
            return nearest(F.col(name), F.when(F.col(name).isNotNull(), F.col(INSTANT))).alias(name)
        return _windowed(kinds[name], F.col(name)).alias(name)

    summary = line.groupBy(*keys, SEGMENT).agg(
        F.max(WANTED).alias(WANTED), *[reduced(name) for name in kinds]
    )
    carried = _carry(summary, keys, kinds, ascending=backward)
    answers = local.join(carried, [*keys, SEGMENT], "left").select(
        *[F.col(key).alias(f"__on_{key}") for key in keys], INSTANT,
        *[_combined(kind, F.col(f"__carry_{name}"), F.col(f"__local_{name}")).alias(name)
          for name, kind in kinds.items()],
    )
    asked = left.withColumn("__asked", left_time)
    match = F.col("__asked") == F.col(INSTANT)
    for key in keys:
        match = match & (F.col(key) == F.col(f"__on_{key}"))
    return asked.join(answers, match, "left").select(*left.columns, *kinds)


def by_size(left: DataFrame, right: DataFrame, on: Sequence[str], limit: int, build: Callable[[DataFrame, DataFrame, bool], DataFrame],
            both: bool = False) -> DataFrame:
    """``build(left, right, few)`` once for the keys with at most ``limit`` rows and once for the others, if there are any.

    The rows of ``right`` count, with ``both`` those of both sides. Rows without a key go with the few.
    """
    keys = list(on)
    rows = right.select(*keys).unionAll(left.select(*keys)) if both else right.select(*keys)
    large = cut_lineage(rows.dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit).select(*keys))
    if large.isEmpty():
        return build(left, right, True)
    # Each part reads it, and the parts of later steps would read it through all earlier ones.
    left = left if hasattr(left, "tidemark_folder") else cut_lineage(left)
    parts = [build(left.join(large, keys, how), right.join(large, keys, how), how == "left_anti") for how in ("left_anti", "left_semi")]
    return parts[0].unionByName(parts[1])


def with_rows(left: DataFrame, right: DataFrame, on: Sequence[str], name: str, **fields: Column) -> DataFrame:
    """``left`` with all right rows of its key as array ``name`` of structs; rows without a key take no part."""
    keys = list(on)
    arrays = right.select(*keys, F.struct(*[value.alias(n) for n, value in fields.items()]).alias(name)).dropna(subset=keys).groupBy(*keys).agg(
        F.collect_list(name).alias(name))
    return left.join(arrays, keys, "left").select(*left.columns, name)


def _asof_window(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: Column, right_time: Column,
                 values: Mapping[str, Running], inclusive: bool) -> DataFrame:
    """``asof_scan``, backward and without ``last``, by one window over each key."""
    keys = list(on)
    asked = left.select(*left.columns, left_time.alias(INSTANT), F.lit(inclusive).alias(SEGMENT), F.lit(True).alias(WANTED))
    facts = right.select(*keys, right_time.alias(INSTANT), F.lit(not inclusive).alias(SEGMENT), *[spec.value.alias(f"__value_{name}") for name, spec in values.items()])
    facts = facts.dropna(subset=[*keys, INSTANT])
    upto = Window.partitionBy(*keys).orderBy(INSTANT, SEGMENT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = asked.unionByName(facts, allowMissingColumns=True)
    usable = F.col(INSTANT).isNotNull()
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    return line.select(*line.columns, *[F.when(usable, _windowed(spec.kind, F.col(f"__value_{name}")).over(upto)).alias(name) for name, spec in values.items()]).where(
        F.col(WANTED)).select(*left.columns, *values)


def asof_by_size(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: Column, right_time: Column,
                 values: Mapping[str, Running], *, inclusive: bool = True, segment: str = "hour") -> DataFrame:
    """``asof_scan`` backward, without ``last``: keys that one task can order are shuffled once, the others are cut into segments."""
    def build(asks: DataFrame, facts: DataFrame, few: bool) -> DataFrame:
        if few:
            return _asof_window(asks, facts, on, left_time, right_time, values, inclusive)
        return asof_scan(asks, facts, on, left_time, right_time, values, inclusive=inclusive, segment=segment)

    return by_size(left, right, on, ONE_TASK, build, both=True)


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: Column,
              right_time: Column, columns: Mapping[str, Column], tie: Sequence[Column] = (), *,
              inclusive: bool = True, backward: bool = True, segment: str = "hour",
              how: str = "left") -> DataFrame:
    """Nearest right row per left row: latest at or before, or (``backward=False``) earliest after.

    ``columns`` maps output names to right-hand expressions. ``how="inner"`` drops unmatched rows.
    """
    payload = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    out = asof_scan(
        left, right, on, left_time, right_time, {"__row": Running("last", payload, tie)},
        inclusive=inclusive, backward=backward, segment=segment,
    )
    if how == "inner":
        out = out.where(F.col("__row").isNotNull())
    return out.select(*left.columns, *[F.col("__row").getField(n).alias(n) for n in columns])


def keep_latest(df: DataFrame, keys: Sequence[str], rank: Sequence[Column],
                earliest: bool = False) -> DataFrame:
    """One whole row per key: the greatest (or smallest) rank. Combines map-side, so copies are cheap."""
    row = F.struct(*df.columns)
    pick = F.min_by if earliest else F.max_by
    # The whole row closes the ranking, so equal ranks still give one fixed winner.
    best = df.groupBy(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).agg(
        pick(row, F.struct(*rank, row)).alias("__best")
    )
    return best.select("__best.*")


def overlap_chunks(df: DataFrame, number: str, size: int, back: int) -> DataFrame:
    """Spread rows over chunks of ``size`` row numbers; each chunk also gets ``back`` earlier rows.

    A window over (key, ``chunk``) then sees every row's last ``back`` predecessors. ``own`` marks
    the rows a chunk answers for; the others are only context.
    """
    if back > size:
        raise ValueError("chunk size must cover the look-back")
    home = F.floor((F.col(number) - 1) / size)
    ahead = F.floor((F.col(number) - 1 + back) / size)
    spread = F.when(ahead > home, F.array(home, ahead)).otherwise(F.array(home))
    return df.withColumn("chunk", F.explode(spread)).withColumn("own", F.col("chunk") == home)


SLOT = "__slot"


def _dyadic(left: DataFrame, right: DataFrame, keys: Sequence[str], axis: Column, clock: Column, right_axis: Column,
            right_clock: Column, payload: Mapping[str, Column], segment: str) -> tuple[DataFrame, DataFrame]:
    """Asks and facts spread over dyadic ranges of receipts, so that the second clock becomes one more key.

    Per key the distinct receipts are numbered from 0. A fact of number x lies in the range ``x >> level`` of each level; what an ask may use,
    the first r receipts, is the union of one range for every bit set in r. Those ranges all have even numbers and end within
    the receipts there are, so a fact is copied into about half of the levels and an ask into as many ranges as r has bits.
    Returns asks (keys, __axis, __clock, slot) and facts (keys, __a, slot, payload).
    """
    facts = right.select(*keys, right_axis.cast("timestamp").alias("__a"), right_clock.cast("timestamp").alias("__c"),
                         *[value.alias(name) for name, value in payload.items()])
    for name in [*keys, "__a", "__c"]:
        facts = facts.where(F.col(name).isNotNull())
    asks = left.select(*keys, axis.alias("__axis"), clock.alias("__clock")).distinct()
    # One line of receipts and asking instants numbers the ones and tells the others how many came before.
    clocks = asks.select(*keys, F.col("__clock").cast("timestamp").alias("__c")).dropna()
    line = facts.select(*keys, "__c", F.lit(1).alias("__own")).unionAll(clocks.select(*keys, "__c", F.lit(0))).groupBy(*keys, "__c").agg(F.max("__own").alias("__own"))
    numbered = running_scan(line, keys, ["__c"], {"__x": Running("sum", F.col("__own"))}, F.date_trunc(segment, F.col("__c"))).withColumn("__x", F.col("__x").cast("long"))
    there = numbered.groupBy(*keys).agg(F.max("__x").alias("__there"))
    reach = asks.withColumn("__c", F.col("__clock").cast("timestamp")).join(numbered.select(*keys, "__c", F.col("__x").alias("__reach")), [*keys, "__c"])

    def slot(level: Column, number: Column) -> Column:
        return (level.cast("long") * F.lit(1 << 56) + number).alias(SLOT)

    levels = F.sequence(F.lit(0), F.floor(F.log2(F.col("__reach"))).cast("int"))
    wanted = F.filter(levels, lambda n: F.call_function("shiftright", F.col("__reach"), n) % 2 == 1)
    asked = (reach.where(F.col("__reach") > 0).select(*asks.columns, "__reach", F.explode(wanted).alias("__level"))
             .select(*asks.columns, slot(F.col("__level"), F.call_function("shiftright", F.col("__reach"), F.col("__level")) - 1)))

    placed = facts.join(numbered.drop("__own"), [*keys, "__c"]).join(there, keys)
    all_levels = F.sequence(F.lit(0), F.floor(F.log2(F.col("__there"))).cast("int"))
    number = lambda n: F.call_function("shiftright", F.col("__x") - 1, n)
    kept = F.filter(all_levels, lambda n: (number(n) % 2 == 0) & (F.call_function("shiftleft", number(n) + 1, n) <= F.col("__there")))
    spread = (placed.select(*keys, "__a", "__x", *payload, F.explode(kept).alias("__level"))
              .select(*keys, "__a", slot(F.col("__level"), number(F.col("__level"))), *payload))
    return asked, spread


def _rejoined(left: DataFrame, answers: DataFrame, keys: Sequence[str], axis: Column, clock: Column, names: Sequence[str]) -> DataFrame:
    """``left`` with the answer of its (keys, axis, clock)."""
    renamed = answers.select(*[F.col(key).alias(f"__on_{key}") for key in keys], "__axis", "__clock", *names)
    asked = left.withColumn("__ask_axis", axis).withColumn("__ask_clock", clock)
    match = (F.col("__ask_axis") == F.col("__axis")) & (F.col("__ask_clock") == F.col("__clock"))
    for key in keys:
        match = match & (F.col(key) == F.col(f"__on_{key}"))
    return asked.join(renamed, match, "left").select(*left.columns, *names)


def _met(facts: DataFrame, points: DataFrame, keys: Sequence[str], name: str, strict: bool) -> DataFrame:
    """``facts`` with ``name`` moved on to the first of the key's ``points`` that is not before it (``strict``: that is after it); without such a point a fact is dropped."""
    line = facts.withColumn(WANTED, F.lit(True)).unionByName(
        points.select(*keys, F.col("__point").alias(name), F.col("__point")).dropna().distinct(), allowMissingColumns=True).withColumn(SEGMENT, F.date_trunc("hour", F.col(name)))
    # Backwards in time; of one instant the points come first, or last where they must be later than the fact.
    order = [F.col(name).desc(), F.col("__point").asc_nulls_first() if strict else F.col("__point").asc_nulls_last()]
    seen = Window.partitionBy(*keys, SEGMENT).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summary = line.groupBy(*keys, SEGMENT).agg(F.min("__point").alias("__point"))
    later = _carry(summary, keys, {"__point": "last"}, ascending=False)
    local = line.withColumn("__point", F.min("__point").over(seen)).where(F.col(WANTED))
    point = F.coalesce("__point", "__carry___point")
    moved = local.join(later, [*keys, SEGMENT], "left").withColumn(name, point).where(F.col(name).isNotNull())
    return moved.select(*facts.columns)


def _merged(left: DataFrame, facts: DataFrame, keys: Sequence[str], axis: Column, clock: Column, kinds: Mapping[str, str]) -> DataFrame:
    """Facts that no ask of their key tells apart become one: both clocks move on to the next ones asked for.

    A key with few asks thus keeps few facts, however many it has.
    """
    asks = left.select(*keys, axis.cast("timestamp").alias("__axis"), clock.cast("timestamp").alias("__clock")).dropna()
    combined = [_windowed(kind, F.col(name)).alias(name) for name, kind in kinds.items()]
    facts = _met(facts, asks.select(*keys, F.col("__clock").alias("__point")), keys, "__c", False)
    facts = _met(facts, asks.select(*keys, F.col("__axis").alias("__point")), keys, "__a", True)
    # Just before the limit, which excludes itself.
    return facts.groupBy(*keys, F.timestamp_micros(F.unix_micros("__a") - 1).alias("__a"), "__c").agg(*combined)


def known_prefix(left: DataFrame, right: DataFrame, on: Sequence[str], axis: Column, clock: Column,
                 right_axis: Column, right_clock: Column, values: Mapping[str, Running], *, segment: str = "year",
                 few: bool | None = None) -> DataFrame:
    """Running values over right rows that are both before an axis limit and already published.

    A right row counts when ``right_axis < axis`` and ``right_clock <= clock``: two orders at once,
    which one scan cannot follow. The rows of a key with at most ``FEW`` of them travel as one array, of which each left row takes those it may use, so both sides are
    shuffled once. Of larger keys, rows that no ask tells apart are merged, and receipts are cut into dyadic ranges (``_dyadic``); within a
    range every row has been received, so one
    as-of lookup along the axis answers it, and the answers of an ask's ranges are merged. Rows are copied
    log-many times whatever the order in which they were received; nothing is laid out by the calendar.
    Of rows of one axis point, ``last`` takes the greatest ``tie``, then the greatest value. ``few`` tells that all keys are of the one or the other kind.
    """
    keys = list(on)
    if few is None:
        return by_size(left, right, keys, FEW, lambda asks, facts, some: known_prefix(
            asks, facts, keys, axis, clock, right_axis, right_clock, values, segment=segment, few=some))
    kinds = {name: "max" if spec.kind == "last" else spec.kind for name, spec in values.items()}
    payload = {}
    for name, spec in values.items():
        ranked = F.struct(right_axis.cast("timestamp").alias("a"), *[t.alias(f"t{i}") for i, t in enumerate(spec.tie)], spec.value.alias("v"))
        payload[name] = F.when(spec.value.isNotNull(), ranked) if spec.kind == "last" else spec.value

    def read(name: str, found: Column) -> Column:
        return (found.getField("v") if values[name].kind == "last" else found).alias(name)

    facts = right.select(*keys, right_axis.cast("timestamp").alias("__a"), right_clock.cast("timestamp").alias("__c"), *[value.alias(name) for name, value in payload.items()])
    facts = facts.dropna(subset=[*keys, "__a", "__c"])
    if few:
        sums = facts.select(*[F.sum(name).alias(name) for name, kind in kinds.items() if kind == "sum"]).schema
        asked = left.withColumns({"__axis": axis.cast("timestamp"), "__clock": clock.cast("timestamp")})
        held = with_rows(asked, facts, keys, "__rows", **{name: F.col(name) for name in ("__a", "__c", *values)})
        held = held.withColumn("__rows", F.filter("__rows", lambda x: (x["__a"] < F.col("__axis")) & (x["__c"] <= F.col("__clock"))))

        def folded(name: str, kind: str) -> Column:
            items = F.transform("__rows", lambda x: x[name].cast(sums[name].dataType) if kind == "sum" else x[name])
            if kind == "sum":
                return F.aggregate(items, F.lit(None).cast(sums[name].dataType), lambda a, x: F.coalesce(a + x, a, x))
            return F.array_max(items) if kind == "max" else F.array_min(items)

        return held.select(*left.columns, *[read(name, folded(name, kind)) for name, kind in kinds.items()])
    # Read from several branches below, which would each repeat the plan of both moves.
    facts = cut_lineage(_merged(left, facts, keys, axis, clock, kinds))
    asked, facts = _dyadic(left, facts, keys, axis, clock, F.col("__a"), F.col("__c"), {name: F.col(name) for name in values}, segment)
    found = asof_scan(asked, facts, [*keys, SLOT], F.col("__axis").cast("timestamp"), F.col("__a"),
                      {name: Running(kind, F.col(name)) for name, kind in kinds.items()}, inclusive=False, segment=segment)
    answers = found.groupBy(*keys, "__axis", "__clock").agg(*[_windowed(kind, F.col(name)).alias(name) for name, kind in kinds.items()])
    answers = answers.select(*keys, "__axis", "__clock", *[read(name, F.col(name)) for name in values])
    return _rejoined(left, cut_lineage(answers), keys, axis, clock, list(values))


def known_latest(left: DataFrame, right: DataFrame, on: Sequence[str], axis: Column, clock: Column, right_axis: Column,
                 right_clock: Column, item: Column, keep: int, name: str, *, segment: str = "year") -> DataFrame:
    """The last ``keep`` items, in order, of the right rows that ``known_prefix`` would count, as array ``name`` (NULL without any).

    Items are ordered by themselves, so their first field must be the right axis. In every range each row carries the items up to it, at most
    ``keep`` of them; an ask merges one such list per range.
    """
    keys = list(on)
    asked, facts = _dyadic(left, right, keys, axis, clock, right_axis, right_clock, {"__item": item}, segment)
    inner = [*keys, SLOT]
    numbered = row_numbers(facts, inner, ["__item"], F.date_trunc(segment, F.col("__a")), "__no")
    spread = overlap_chunks(numbered, "__no", max(512, keep), keep - 1)
    trailing = Window.partitionBy(*inner, "chunk").orderBy("__no").rowsBetween(-(keep - 1), Window.currentRow)
    listed = spread.withColumn("__list", F.collect_list("__item").over(trailing)).where("own")
    found = asof_scan(asked, listed, inner, F.col("__axis").cast("timestamp"), F.col("__a"),
                      {"__list": Running("last", F.col("__list"), [F.col("__no")])}, inclusive=False, segment=segment)
    whole = F.array_sort(F.flatten(F.collect_list("__list")))
    answers = found.groupBy(*keys, "__axis", "__clock").agg(whole.alias("__all")).select(
        *keys, "__axis", "__clock", F.slice("__all", F.greatest(F.size("__all") - (keep - 1), F.lit(1)), keep).alias(name))
    return _rejoined(left, answers, keys, axis, clock, [name])
