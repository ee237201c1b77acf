"""Probability calibration. Rows are first counted by distinct probability, and every pass reads the counts."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, release

EPS = 1e-6
CLAMP = 35.0
LIMIT = 20.0


def _counts(rows: DataFrame, probability: str, outcome: str) -> DataFrame:
    p, y = F.col(probability).cast("double"), F.col(outcome).cast("double")
    usable = rows.where(p.between(0.0, 1.0) & y.isin(0.0, 1.0))
    bounded = F.least(F.lit(1 - EPS), F.greatest(F.lit(EPS), p))
    return usable.groupBy(bounded.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("yes"))


def _sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _clamped(z: Column) -> Column:
    return F.greatest(F.lit(-CLAMP), F.least(F.lit(CLAMP), z))


def _solve(matrix: list[list[float]], vector: list[float]) -> list[float] | None:
    """Small dense system by elimination with row pivoting; None when it is singular."""
    size = len(vector)
    rows = [[*matrix[i], vector[i]] for i in range(size)]
    for col in range(size):
        best = max(range(col, size), key=lambda r: abs(rows[r][col]))
        if abs(rows[best][col]) < 1e-12:
            return None
        rows[col], rows[best] = rows[best], rows[col]
        rows[col] = [v / rows[col][col] for v in rows[col]]
        for r in range(size):
            if r != col and rows[r][col]:
                factor = rows[r][col]
                rows[r] = [a - factor * b for a, b in zip(rows[r], rows[col])]
    return [row[size] for row in rows]


def _newton(counts: DataFrame, features: list[Column], start: list[float], ridge: float, passes: int = 100) -> list[float]:
    """Ridge towards ``start``; each pass is one distributed aggregate of gradient and curvature.

    The step is halved until the objective does not rise; all halvings are tried in one aggregate.
    """
    size = len(features)

    def score(params: list[float]) -> Column:
        return _clamped(sum((f * F.lit(v) for f, v in zip(features, params)), F.lit(0.0)))

    def loss(params: list[float]) -> Column:
        z = score(params)
        return F.sum(F.col("n") * F.log1p(F.exp(-z)) + (F.col("n") - F.col("yes")) * z)

    def penalty(params: list[float]) -> float:
        return 0.5 * ridge * sum((v - s) ** 2 for v, s in zip(params, start))

    params = list(start)
    current = counts.agg(loss(params)).first()[0] + penalty(params)
    for _ in range(passes):
        q = _sigmoid(score(params))
        weight = F.col("n") * q * (F.lit(1.0) - q)
        slots = [F.sum((q * F.col("n") - F.col("yes")) * f) for f in features]
        slots += [F.sum(weight * features[i] * features[j]) for i in range(size) for j in range(i, size)]
        got = list(counts.agg(*slots).first())
        gradient = [got[i] + ridge * (params[i] - start[i]) for i in range(size)]
        curvature = [[0.0] * size for _ in range(size)]
        upper = iter(got[size:])
        for i in range(size):
            for j in range(i, size):
                curvature[i][j] = curvature[j][i] = next(upper)
            curvature[i][i] += ridge
        step = _solve(curvature, gradient)
        if step is None:
            break
        sizes = [0.5 ** k for k in range(20)]
        tried = [[max(-LIMIT, min(LIMIT, v - s * d)) for v, d in zip(params, step)] for s in sizes]
        losses = list(counts.agg(*[loss(t) for t in tried]).first())
        accepted = next((k for k, t in enumerate(tried) if losses[k] + penalty(t) <= current + 1e-12), None)
        if accepted is None:
            break
        params, current = tried[accepted], losses[accepted] + penalty(tried[accepted])
        if max(abs(sizes[accepted] * d) for d in step) < 1e-8:
            break
    return params


def _fit(rows: DataFrame, probability: str, outcome: str, features: list[Column], start: list[float], ridge: float,
         least: int) -> tuple[list[float], int, bool]:
    counts = _counts(rows, probability, outcome).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if total < least:
            return start, total, True
        return _newton(counts, features, start, ridge), total, False
    finally:
        counts.unpersist()


def fit_platt(rows: DataFrame, probability: str = "prediction", outcome: str = "outcome", ridge: float = 1e-3) -> dict:
    """``sigmoid(a * logit(p) + b)`` with a non-negative slope."""
    logit = F.log(F.col("p") / (F.lit(1.0) - F.col("p")))
    (a, b), n, fallback = _fit(rows, probability, outcome, [logit, F.lit(1.0)], [1.0, 0.0], ridge, 2)
    return {"method": "platt", "a": max(0.0, a), "b": b, "training_rows": n, "fallback": fallback}


def fit_beta(rows: DataFrame, probability: str = "prediction", outcome: str = "outcome", ridge: float = 1e-3) -> dict:
    """``sigmoid(a * log p + b * log(1-p) + c)``, monotone in p."""
    features = [F.log("p"), F.log(F.lit(1.0) - F.col("p")), F.lit(1.0)]
    (a, b, c), n, fallback = _fit(rows, probability, outcome, features, [1.0, -1.0, 0.0], ridge, 3)
    return {"method": "beta", "a": max(0.0, a), "b": min(0.0, b), "c": c, "training_rows": n, "fallback": fallback}


def _bounded(p: Column) -> Column:
    return F.least(F.lit(1 - EPS), F.greatest(F.lit(EPS), p))


def apply_platt(p: Column, model: dict) -> Column:
    p = _bounded(p)
    return _sigmoid(_clamped(F.log(p / (F.lit(1.0) - p)) * F.lit(model["a"]) + F.lit(model["b"])))


def apply_beta(p: Column, model: dict) -> Column:
    p = _bounded(p)
    z = F.log(p) * F.lit(model["a"]) + F.log(F.lit(1.0) - p) * F.lit(model["b"]) + F.lit(model["c"])
    return _sigmoid(_clamped(z))


def _pool(pairs):
    """Merge neighbouring blocks (low, high, sum, weight) until their means rise strictly."""
    blocks: list[list[float]] = []
    for low, high, total, weight in pairs:
        blocks.append([low, high, total, weight])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            low2, high2, total2, weight2 = blocks.pop()
            blocks[-1][1], blocks[-1][2], blocks[-1][3] = high2, blocks[-1][2] + total2, blocks[-1][3] + weight2
    return blocks


def _pool_batches(batches):
    import pandas as pd

    pairs = []
    for frame in batches:
        pairs = _pool([*pairs, *frame[["low", "high", "total", "weight"]].itertuples(index=False, name=None)])
    yield pd.DataFrame(pairs, columns=["low", "high", "total", "weight"])


BLOCK_SCHEMA = "low double, high double, total double, weight double"
#: Blocks that one task pools; a few bytes each.
TASK_BLOCKS = 200_000


def _block_order() -> list[Column]:
    # Means order blocks that share a bound, as outcomes ordered the rows they come from.
    return [F.col("low"), F.col("high"), F.col("total") / F.col("weight")]


def _pool_ranges(blocks: DataFrame, ranges: int) -> tuple[DataFrame, int, bool]:
    """Blocks pooled within so many ranges, their number, and whether a block's mean is not above that of the one before."""
    def ranged(df: DataFrame) -> DataFrame:
        dealt = df.repartition(1) if ranges == 1 else df.repartitionByRange(ranges, *_block_order())
        return dealt.sortWithinPartitions(*_block_order())

    pooled = cut_lineage(ranged(blocks).mapInPandas(_pool_batches, BLOCK_SCHEMA))
    number = pooled.count()
    if ranges == 1:
        return pooled, number, False
    # Inside a range no mean falls, so only neighbours at the ends of ranges, two blocks a range, have to be looked at.
    # A range is one written file, or several that follow each other.
    block = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_block_order())], "total", "weight")
    ends = pooled.groupBy(F.input_file_name()).agg(F.min(block).alias("first"), F.max(block).alias("last"))
    order = Window.orderBy("first")
    earlier = F.lag("last").over(order)
    fall = earlier["total"] * F.col("first.weight") >= F.col("first.total") * earlier["weight"]
    return pooled, number, ends.select(fall.alias("fall")).where("fall").count() > 0


def fit_isotonic(rows: DataFrame, probability: str = "prediction", outcome: str = "outcome", task_blocks: int = TASK_BLOCKS) -> DataFrame:
    """Blocks (low, high, value) of the rising step function closest to the outcomes.

    Distinct (p, outcome) pairs are counted and each range of p pools its own. Blocks may be pooled in any order with
    one result, so the survivors are dealt into ranges anew, with other bounds, until no mean falls from one range to the
    next. No task pools more than about ``task_blocks`` blocks; where no more survive, one task ends the work.
    """
    p, y = F.col(probability).cast("double"), F.col(outcome).cast("double")
    usable = rows.where(p.between(0.0, 1.0) & y.isin(0.0, 1.0))
    pairs = usable.groupBy(_bounded(p).alias("low"), y.alias("__y")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    pairs = pairs.select("low", F.col("low").alias("high"), (F.col("__y") * F.col("weight")).alias("total"), "weight", "__y")
    ranged = pairs.repartitionByRange("low", "__y").sortWithinPartitions("low", "__y").select("low", "high", "total", "weight")
    blocks = cut_lineage(ranged.mapInPandas(_pool_batches, BLOCK_SCHEMA))
    number, falls, turn = blocks.count(), True, 0
    while falls:
        ranges = 1 if number <= task_blocks else -(-number // task_blocks) + 1 + turn % 2
        pooled, number, falls = _pool_ranges(blocks, ranges)
        release(blocks)
        blocks, turn = pooled, turn + 1
    return blocks.select("low", "high", (F.col("total") / F.col("weight")).alias("value"))


def apply_isotonic(rows: DataFrame, blocks: DataFrame, probability: str = "prediction", output: str = "calibrated") -> DataFrame:
    """Value of the first block whose upper bound is not below p; beyond the last block, its value.

    Blocks are a step function over p, so each row's block is an as-of lookup over slots of p.
    """
    slots = 1 << 12
    ordered = blocks.groupBy("high").agg(F.min_by("value", "low").alias("value"))
    # Each slot of p gets the blocks whose upper bound lies in it, and the first block beyond it.
    spark = rows.sparkSession
    grid = spark.range(slots + 1).select(F.col("id").cast("int").alias("__slot"))
    placed = ordered.withColumn("__slot", F.least(F.floor(F.col("high") * slots), F.lit(slots)).cast("int"))
    own = placed.groupBy("__slot").agg(F.array_sort(F.collect_list(F.struct("high", "value"))).alias("__own"))
    after = Window.orderBy("__slot").rowsBetween(1, Window.unboundedFollowing)
    upto = Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = grid.join(own, "__slot", "left").withColumn(
        "__next", F.first(F.get("__own", F.lit(0)), ignorenulls=True).over(after)
    ).withColumn("__last", F.last(F.try_element_at("__own", F.lit(-1)), ignorenulls=True).over(upto))
    p = F.col(probability).cast("double")
    slot = F.greatest(F.lit(0), F.least(F.floor(p * slots), F.lit(slots))).cast("int")
    wide = rows.withColumn("__slot", slot).join(table, "__slot", "left")
    inside = F.get(F.filter("__own", lambda b: b["high"] >= p), F.lit(0))
    value = F.coalesce(inside["value"], F.col("__next.value"), F.col("__last.value"), p)
    return wide.withColumn(output, value).drop("__slot", "__own", "__next", "__last")


def log_loss(rows: DataFrame, probability: str, outcome: str) -> float:
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col(probability)))
    y = F.col(outcome)
    got = rows.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p)))).first()[0]
    return math.nan if got is None else got
