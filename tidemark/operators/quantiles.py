"""Exact order statistics of groups of any size.

``percentile`` keeps all distinct values of a group in one task. Here equal values are counted first; the wanted ranks
of all groups are then found together by descending over the order-preserving bits of the values, sixteen at a time.
A level counts the children of the nodes that hold a wanted rank, so no window has more than 65,536 rows, however many
values a group has and wherever they lie.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .timeline import ONE_TASK, Running, asof_scan, by_size, row_numbers

DIGIT_BITS = 16


def ordered_bits(value: Column) -> Column:
    """The 64 bits of a double as a long whose unsigned order is the order of the doubles, NaN last; 0.0 and -0.0 are equal."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("long")
    return F.when(value.isNull(), F.lit(None)).when(bits >= 0, bits.bitwiseXOR(F.lit(-(1 << 63)))).otherwise(F.bitwise_not(bits))


def _descend(counts: DataFrame, asked: DataFrame | None, keys: Sequence[str], ranks: dict[str, Column], shift: int) -> DataFrame:
    """One level: the children of the nodes asked for (None: the whole group) that hold wanted ranks.

    ``asked`` and the result have a node, the ranks wanted inside it as (name, rank) and the size of the group.
    """
    child = F.shiftrightunsigned("__bits", shift)
    if asked is None:
        part = counts.withColumns({"__node": F.lit(0).cast("long"), "__asked": F.lit(None), "group_rows": F.lit(None)})
    else:
        named = asked.select(*[F.col(k).alias(f"__key_{k}") for k in keys], "__node", "__asked", "group_rows")
        same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
        # Not every group need be small enough to broadcast: the choice is Spark's, and skewed nodes are split by it.
        part = counts.withColumn("__own", F.shiftrightunsigned("__bits", shift + DIGIT_BITS)).join(
            named, [*same, F.col("__own") == F.col("__node")])
    counted = part.groupBy(*keys, "__node", child.alias("__child")).agg(
        F.sum("__n").alias("__n"), F.max("__v").alias("__v"), F.first("__asked").alias("__asked"), F.first("group_rows").alias("group_rows"))
    node = Window.partitionBy(*keys, "__node")
    upto = F.sum("__n").over(node.orderBy("__child").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = counted.withColumn("__upto", upto)
    if asked is None:
        wanted = F.array(*[F.struct(F.lit(n).alias("name"), r.cast("long").alias("rank")) for n, r in ranks.items()])
        counted = counted.withColumn("group_rows", F.sum("__n").over(node)).withColumn("__asked", wanted)
    before = F.col("__upto") - F.col("__n")
    inside = F.transform(
        F.filter("__asked", lambda a: (a["rank"] > before) & (a["rank"] <= F.col("__upto"))),
        lambda a: F.struct(a["name"].alias("name"), (a["rank"] - before).alias("rank")))
    held = counted.select(*keys, F.col("__child").alias("__node"), inside.alias("__asked"), "group_rows", "__v")
    return held.where(F.size("__asked") > 0)


def order_statistics(df: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """Values, as doubles, at 1-based ranks. Each rank is a Column over ``group_rows``; one row per group.

    NULL values take no part, NaN is the largest value, a rank outside the group has no value, and NULL is a key like
    any other. A group without values has no row.
    """
    values = df.where(F.col(value).isNotNull()).select(*keys, (F.col(value).cast("double") + F.lit(0.0)).alias("__v"))
    counts = values.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"))
    counts = cut_lineage(counts.withColumn("__bits", ordered_bits(F.col("__v"))))
    # A first node is never empty of ranks where only the size of the group is wanted.
    wanted = {"__size": F.lit(1), **ranks}
    found = None
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        found = _descend(counts, found, keys, wanted, shift)
    picks = [F.max(F.when(F.exists("__asked", lambda a: a["name"] == name), F.col("__v"))).alias(name) for name in ranks]
    return found.groupBy(*keys).agg(F.max("group_rows").alias("group_rows"), *picks)


def interpolated_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                           quantiles: dict[str, float]) -> DataFrame:
    """Linear interpolation at position (n-1)·q, the ``percentile`` rule."""
    ranks = {}
    for name, q in quantiles.items():
        position = (F.col("group_rows") - 1) * F.lit(float(q))
        ranks[f"__lo_{name}"] = F.floor(position) + 1
        ranks[f"__hi_{name}"] = F.ceil(position) + 1
    found = order_statistics(df, keys, value, ranks)
    out = []
    for name, q in quantiles.items():
        position = (F.col("group_rows") - 1) * F.lit(float(q))
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return found.select(*keys, "group_rows", *out)


def nearest_rank_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                           quantiles: dict[str, float]) -> DataFrame:
    """Value at index ceil(q·n)-1."""
    ranks = {
        name: F.greatest(F.ceil(F.col("group_rows") * F.lit(float(q))), F.lit(1))
        for name, q in quantiles.items()
    }
    return order_statistics(df, keys, value, ranks)


def floor_index_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                          quantiles: dict[str, float]) -> DataFrame:
    """Value at index int(q·(n-1))."""
    ranks = {
        name: F.floor((F.col("group_rows") - 1) * F.lit(float(q))) + 1
        for name, q in quantiles.items()
    }
    return order_statistics(df, keys, value, ranks)


def prefix_ranks(values: np.ndarray, sizes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The ``ranks``-th smallest (from 1) of the first ``sizes`` values; NaN outside of them.

    The values' places in order are split bit by bit, the highest first, each time with the zeros in front (a wavelet matrix). How many zeros a prefix
    has tells the bit of the place looked for, so all prefixes are searched together in as many steps as a place has bits.
    """
    inside = (ranks >= 1) & (ranks <= sizes)
    order = np.argsort(values, kind="stable")
    places = np.empty(len(values), np.int64)
    places[order] = np.arange(len(values))
    low, high, left, found = (np.zeros(int(inside.sum()), np.int64) for _ in range(4))
    high += sizes[inside]
    left += ranks[inside] - 1
    for bit in range(max(len(values) - 1, 1).bit_length() - 1, -1, -1):
        ones = (places >> bit & 1).astype(bool)
        zeros = np.concatenate(([0], np.cumsum(~ones)))
        from_low, to_high = zeros[low], zeros[high]
        up = left >= to_high - from_low
        left -= np.where(up, to_high - from_low, 0)
        found += up.astype(np.int64) << bit
        low, high = np.where(up, zeros[-1] + low - from_low, from_low), np.where(up, zeros[-1] + high - to_high, to_high)
        places = np.concatenate((places[~ones], places[ones]))
    out = np.full(len(ranks), np.nan)
    out[inside] = values[order[found]]
    return out


def _ranked(states: DataFrame, items: DataFrame, on: Sequence[str], state_time: str, item_time: str, number: Column, ranks: dict[str, Column]) -> DataFrame:
    """``asof_order_statistics`` of keys that fit a task: states and items come together once, in order of time."""
    keys = list(on)
    asked = states.select(*keys, state_time, F.col(state_time).cast("timestamp").alias("__at"), F.lit(0).alias("__item"))
    facts = items.select(*keys, F.col(item_time).cast("timestamp").alias("__at"), F.lit(1).alias("__item"), number.alias("__v")).where(
        F.col("__v").isNotNull() & ~F.isnan("__v"))
    line = asked.unionByName(facts, allowMissingColumns=True).dropna(subset=[*keys, "__at"])
    # Of one instant the items come first, so a state's rows before it are its pool.
    upto = Window.partitionBy(*keys).orderBy("__at", F.desc("__item")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = line.withColumn("group_rows", F.sum("__item").over(upto))
    line = line.select(*keys, state_time, "group_rows", F.col("__item") == 1, "__v", *[r.cast("long").alias(name) for name, r in ranks.items()]).toDF(
        *keys, state_time, "group_rows", "__item", "__v", *ranks)
    head = line.select(*keys, state_time, "group_rows")
    kind = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in head.schema)}, {', '.join(f'`{name}` double' for name in ranks)}"

    names = list(ranks)

    def search(group: pa.Table) -> pa.Table:
        item = group.column("__item").to_numpy()
        pool = group.filter(pa.array(item))
        values = pool.column("__v").to_numpy()[np.argsort(pool.column("group_rows").to_numpy(), kind="stable")]
        wanted = group.filter(pa.array(~item))
        wanted = wanted.filter(pa.array(wanted.column("group_rows").to_numpy() > 0))
        sizes = wanted.column("group_rows").to_numpy()
        found = wanted.select([*keys, state_time, "group_rows"])
        for name in names:
            rank = wanted.column(name).to_pandas().fillna(0).to_numpy(np.int64)
            values_at = prefix_ranks(values, sizes, rank)
            found = found.append_column(name, pa.array(values_at, pa.float64(), mask=np.isnan(values_at)))
        return found

    return line.groupBy(*keys).applyInArrow(search, kind)


def asof_order_statistics(states: DataFrame, items: DataFrame, on: Sequence[str], state_time: str, item_time: str,
                          value: str, ranks: dict[str, Column], *, digit: int = 16, segment: str = "day", few: bool | None = None) -> DataFrame:
    """Values at 1-based ranks among all items of the key released at or before each state's instant.

    ``states`` is distinct on (``on``, ``state_time``); each rank is a Column over ``group_rows``, the size of the pool by then.
    The distinct values of a key are numbered in order; the wanted ranks are then found digit by digit over these
    numbers. One as-of lookup a level returns how many items of each child of the node found so far had been released, as ``digit``
    running counts, so a wanted rank is one ask a level. Values may be of any size and as close as doubles can be.
    NULL and NaN values and items without a release take no part; a state without items has no row; a rank outside the pool is NULL.
    Keys with at most ``ONE_TASK`` states and items are shuffled once and searched in one task each (``prefix_ranks``).
    """
    number = F.col(value).cast("double") + F.lit(0.0)
    if few is None:
        there = items.where(number.isNotNull() & ~F.isnan(number) & F.col(item_time).isNotNull())
        return by_size(states, there, on, ONE_TASK, lambda l, r, some: asof_order_statistics(
            l, r, on, state_time, item_time, value, ranks, digit=digit, segment=segment, few=some), both=True)
    if few:
        return _ranked(states, items, on, state_time, item_time, number, ranks)
    facts = items.where(number.isNotNull() & ~F.isnan(number) & F.col(item_time).isNotNull()).groupBy(
        *on, item_time, number.alias("__v")).agg(F.count(F.lit(1)).alias("__w"))
    numbered = cut_lineage(row_numbers(
        facts.select(*on, "__v").distinct(), on, ["__v"], F.floor(F.signum("__v") * F.log2(1 + F.abs("__v")) * 64), "__number"))
    facts = cut_lineage(facts.join(numbered, [*on, "__v"]).select(*on, item_time, "__w", (F.col("__number") - 1).alias("__grid")))
    largest = numbered.agg(F.max("__number")).first()[0] or 1
    levels = 1
    while digit ** levels < largest:
        levels += 1
    totals = asof_scan(
        states.select(*on, state_time), facts, on, F.col(state_time), F.col(item_time),
        {"group_rows": Running("sum", F.col("__w"))}, segment=segment).where(F.col("group_rows") > 0)
    asked = F.explode(F.array_distinct(F.array(*[r.cast("long") for r in ranks.values()]))).alias("__place")
    want = totals.select(*on, state_time, "group_rows", asked).where(F.col("__place").between(1, F.col("group_rows"))).withColumns(
        {"__rank": F.col("__place"), "__node": F.lit(0).cast("long")})
    unit = [*on, state_time, "group_rows", "__place"]
    for level in range(levels):
        below = digit ** (levels - level - 1)
        child = F.floor(F.col("__grid") / below) % digit
        tree = facts.withColumn("__node", F.floor(F.col("__grid") / (below * digit)))
        seen = asof_scan(cut_lineage(want), tree, [*on, "__node"], F.col(state_time), F.col(item_time), {
            f"__c{i}": Running("sum", F.when(child == i, F.col("__w"))) for i in range(digit)}, segment=segment)
        counts = F.array(*[F.coalesce(F.col(f"__c{i}"), F.lit(0).cast("long")) for i in range(digit)])

        def step(a: Column, n: Column) -> Column:
            over = a["before"] + n >= F.col("__rank")
            return F.when(a["found"], a).otherwise(F.struct(
                F.when(over, a["before"]).otherwise(a["before"] + n).alias("before"),
                F.when(over, a["child"]).otherwise(a["child"] + 1).alias("child"), over.alias("found")))

        start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(0).alias("child"), F.lit(False).alias("found"))
        want = seen.withColumn("__hit", F.aggregate(counts, start, step)).select(
            *unit, (F.col("__rank") - F.col("__hit.before")).alias("__rank"), (F.col("__node") * digit + F.col("__hit.child")).alias("__node"))
    exact = want.join(numbered.withColumn("__node", F.col("__number") - 1), [*on, "__node"])
    picks = [F.max(F.when(F.col("__place") == r.cast("long"), F.col("__v"))).alias(name) for name, r in ranks.items()]
    return exact.groupBy(*on, state_time).agg(F.max("group_rows").alias("group_rows"), *picks)


def asof_quantiles(states: DataFrame, items: DataFrame, on: Sequence[str], state_time: str, item_time: str,
                   value: str, quantiles: dict[str, float], *, segment: str = "day") -> DataFrame:
    """Linear interpolation at position (n-1)·q over the items released at or before each state's instant."""
    ranks = {}
    for name, q in quantiles.items():
        position = (F.col("group_rows") - 1) * F.lit(float(q))
        ranks[f"__lo_{name}"] = F.floor(position) + 1
        ranks[f"__hi_{name}"] = F.ceil(position) + 1
    found = asof_order_statistics(states, items, on, state_time, item_time, value, ranks, segment=segment)
    out = []
    for name, q in quantiles.items():
        position = (F.col("group_rows") - 1) * F.lit(float(q))
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        # Equal ends are taken as they are, so that infinities give no NaN.
        out.append(F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position))).alias(name))
    return found.select(*on, state_time, "group_rows", *out)


def asof_medians(states: DataFrame, items: DataFrame, on: Sequence[str], state_time: str,
                 item_time: str, value: str, *, segment: str = "day") -> DataFrame:
    """Median of all items of the key released at or before each state's instant, see ``asof_order_statistics``."""
    size = F.col("group_rows")
    found = asof_order_statistics(states, items, on, state_time, item_time, value, {
        "__lo": F.floor((size + 1) / 2), "__hi": F.floor(size / 2) + 1}, segment=segment)
    return found.select(*on, state_time, size.alias("item_count"), ((F.col("__lo") + F.col("__hi")) / 2).alias("median"))
