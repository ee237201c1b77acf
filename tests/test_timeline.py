"""Segmented scans must equal brute force, with hot keys, ties, gaps and copies."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles, timeline
from tidemark.operators.timeline import Running

START = dt.datetime(2026, 1, 1)


def rows(seed, n, hot=0.4):
    rng = random.Random(seed)
    return [("hot" if rng.random() < hot else f"k{rng.randrange(4)}", START + dt.timedelta(minutes=rng.randrange(4000)), rng.randrange(100) / 4) for _ in range(n)]


@pytest.mark.parametrize("inclusive,backward", [(True, True), (False, True), (False, False), (True, False)])
def test_asof_scan_equals_brute_force(spark, inclusive, backward):
    left, right = rows(1, 300), rows(2, 400)
    l = spark.createDataFrame([(i, k, t) for i, (k, t, _) in enumerate(left)], "id int, k string, t timestamp")
    r = spark.createDataFrame(right, "k string, u timestamp, v double")
    got = timeline.asof_scan(l, r, ["k"], F.col("t"), F.col("u"), {
        "n": Running("sum", F.lit(1)), "hi": Running("max", F.col("v")), "near": Running("last", F.col("v"), [F.col("v")])},
        inclusive=inclusive, backward=backward).collect()
    assert len(got) == len(left)
    for row in got:
        k, t, _ = left[row.id]
        def ok(u):
            return (u <= t if inclusive else u < t) if backward else (u >= t if inclusive else u > t)
        seen = [(u, v) for kk, u, v in right if kk == k and ok(u)]
        assert (row.n or 0) == len(seen)
        assert row.hi == (max(v for _, v in seen) if seen else None)
        if seen:
            edge = (max if backward else min)(u for u, _ in seen)
            assert row.near == max(v for u, v in seen if u == edge)


def test_running_scan_equals_plain_window(spark):
    from pyspark.sql import Window

    df = spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(rows(3, 500))], "k string, t timestamp, i int, v double")
    out = timeline.running_scan(df, ["k"], ["t", "i"], {
        "s": Running("sum", F.col("v")), "m": Running("max", F.col("v"), exclusive=True), "p": Running("last", F.col("v"), exclusive=True)}, timeline.time_segment("t"))
    w = Window.partitionBy("k").orderBy("t", "i")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    wrong = out.withColumns({
        "s2": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), "m2": F.max("v").over(before), "p2": F.last("v").over(before)}).where(
        (F.abs(F.col("s") - F.col("s2")) > 1e-9) | ~F.col("m").eqNullSafe(F.col("m2")) | ~F.col("p").eqNullSafe(F.col("p2")))
    assert wrong.count() == 0


def test_known_prefix_with_late_clocks(spark):
    rng = random.Random(5)
    day0 = dt.date(2025, 11, 1)
    labels = [(f"c{i % 2}", day0 + dt.timedelta(days=i // 2), START - dt.timedelta(days=61 - i // 2) + dt.timedelta(days=rng.choice([2, 2, 2, 30])), float(i)) for i in range(120)]
    asks = [(i, f"c{i % 2}", day0 + dt.timedelta(days=rng.randrange(70)), START + dt.timedelta(days=rng.randrange(-60, 20))) for i in range(80)]
    l = spark.createDataFrame(asks, "id int, c string, target date, decision timestamp")
    r = spark.createDataFrame(labels, "c string, day date, av timestamp, v double")
    got = timeline.known_prefix(l, r, ["c"], F.col("target"), F.col("decision"), F.col("day"), F.col("av"), {
        "n": Running("sum", F.lit(1)), "s": Running("sum", F.col("v"))}).collect()
    for row in got:
        _, c, target, decision = asks[row.id]
        seen = [v for cc, d, av, v in labels if cc == c and d < target and av <= decision]
        assert ((row.n or 0), row.s or 0) == (len(seen), sum(seen))


def test_two_clocks_with_one_late_receipt_for_all(spark):
    """Receipts in order, against the order, and all labels received on one late date."""
    rng = random.Random(6)
    day0 = dt.date(2025, 1, 1)
    for received in (lambda i: i, lambda i: 400 - i, lambda i: 500, lambda i: rng.randrange(0, 500, 7)):
        labels = [("ab"[i % 2], day0 + dt.timedelta(days=i // 3), START + dt.timedelta(days=received(i)), float(rng.randrange(50))) for i in range(150)]
        labels += [("a", None, START, 1.0), ("a", day0, None, 1.0), (None, day0, START, 1.0)]
        asks = [(i, rng.choice(["a", "b", "c", None]), rng.choice([None] + [day0 + dt.timedelta(days=d) for d in range(60)]),
                 START + dt.timedelta(days=rng.randrange(-5, 520))) for i in range(60)]
        l = spark.createDataFrame(asks, "id int, c string, target date, decision timestamp")
        r = spark.createDataFrame(labels, "c string, day date, av timestamp, v double")
        got = timeline.known_prefix(l, r, ["c"], F.col("target"), F.col("decision"), F.col("day"), F.col("av"), {
            "n": Running("sum", F.lit(1)), "low": Running("min", F.col("v")), "newest": Running("last", F.col("v"), [F.col("av")])})
        got = timeline.known_latest(got, r, ["c"], F.col("target"), F.col("decision"), F.col("day"), F.col("av"), F.struct("day", "av", "v"), 4, "tail").collect()
        assert len(got) == 60
        for row in got:
            _, c, target, decision = asks[row.id]
            seen = sorted((d, av, v) for cc, d, av, v in labels if c and cc == c and d and av and target and d < target and av <= decision)
            assert (row.n or 0) == len(seen)
            assert row.low == min((v for *_, v in seen), default=None) and row.newest == (seen[-1][2] if seen else None)
            assert [tuple(x) for x in row.tail or []] == seen[-4:]


def test_facts_are_copied_log_many_times(spark):
    """Whatever the dates and receipts are, a row is copied into about half of the levels and an ask into as many ranges as it has bits."""
    r = spark.range(1000).select(F.lit("k").alias("c"), F.timestamp_seconds(F.col("id") * 86400 * 300).alias("a"), F.timestamp_seconds(-F.col("id")).alias("b"))
    l = r.select("c", "a", F.timestamp_seconds(F.lit(0)).alias("b"))
    asked, facts = timeline._dyadic(l, r, ["c"], F.col("a"), F.col("b"), F.col("a"), F.col("b"), {}, "year")
    assert facts.count() <= 6 * 1000 and asked.count() == 6 * 1000  # 1,000 has six bits


def test_quantiles_and_asof_medians(spark):
    data = rows(7, 400)
    df = spark.createDataFrame([(k, v) for k, _, v in data], "k string, v double")
    got = {r.k: r for r in quantiles.interpolated_quantiles(df, ["k"], "v", {"q": 0.3}).collect()}
    want = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("v", F.lit(0.3)).alias("q")).collect()}
    assert {k: round(r.q, 9) for k, r in got.items()} == {k: round(q, 9) for k, q in want.items()}
    items = spark.createDataFrame(data, "k string, u timestamp, v double")
    states = spark.createDataFrame([(k, START + dt.timedelta(minutes=m)) for k in ("hot", "k1") for m in (50, 900, 3999)], "k string, t timestamp")
    import statistics
    for row in quantiles.asof_medians(states, items, ["k"], "t", "u", "v").collect():
        assert row.median == statistics.median([v for k, u, v in data if k == row.k and u <= row.t])


def test_order_statistics_descend_over_bits(spark):
    """One far value, infinities, both zeros, ties, NULL keys and values: the ranks are those of the sorted values."""
    rng = random.Random(5)
    data = [("near", rng.random()) for _ in range(500)] + [("near", 1e12), ("near", None)]
    data += [("wide", rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300)) for _ in range(200)]
    data += [("wide", v) for v in (float("inf"), float("-inf"), 0.0, -0.0, 5e-324, -5e-324)]
    data += [(None, v) for v in (2.0, 2.0, 1.0)] + [("one", -7.5), ("empty", None)]
    df = spark.createDataFrame(data, "k string, v double")
    ranks = {"low": F.lit(1), "third": F.floor(F.col("group_rows") / 3) + 1, "high": F.col("group_rows"), "beyond": F.col("group_rows") + 1}
    got = {r.k: r for r in quantiles.order_statistics(df, ["k"], "v", ranks).collect()}
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        values.sort()
        n = len(values)
        assert (got[k].group_rows, got[k].low, got[k].third, got[k].high, got[k].beyond) == (n, values[0], values[n // 3], values[-1], None)
    bare = quantiles.order_statistics(df, ["k"], "v", {}).collect()
    assert {r.k: r.group_rows for r in bare} == {k: len(v) for k, v in groups.items()}
    assert quantiles.interpolated_quantiles(df.limit(0), ["k"], "v", {"q": 0.5}).count() == 0


def test_ordered_bits_follow_the_order_of_doubles(spark):
    values = [float("-inf"), -1e12, -1.0, -5e-324, 0.0, 5e-324, 0.1, 1.0, 1e12, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    bits = [r.b % (1 << 64) for r in df.select(quantiles.ordered_bits(F.col("v")).alias("b")).collect()]
    assert bits == sorted(bits) and len(set(bits)) == len(bits)


def test_overlap_chunks_keep_every_row_once(spark):
    df = spark.range(1, 101).select(F.col("id").alias("n"))
    out = timeline.overlap_chunks(df, "n", 10, 3)
    assert out.where("own").count() == 100
    # Ten chunk ends, the last one included, each hand three rows on.
    assert out.where("not own").count() == 30


@pytest.mark.parametrize("few", [4, 40])
def test_two_clocks_of_large_and_small_keys(spark, monkeypatch, few):
    """Keys with more rows than an array may hold give the same answers as small ones."""
    monkeypatch.setattr(timeline, "FEW", few)
    rng = random.Random(8)
    facts = [(rng.choice(["a", "a", "b", "c", "d", None]), START + dt.timedelta(hours=rng.randrange(200)), START + dt.timedelta(hours=rng.randrange(300)), rng.choice([None, float(rng.randrange(40))])) for _ in range(150)]
    asks = [(i, rng.choice(["a", "b", "e", None]), rng.choice([None, START + dt.timedelta(hours=rng.randrange(220))]), START + dt.timedelta(hours=rng.randrange(320))) for i in range(50)]
    l = spark.createDataFrame(asks, "id int, c string, target timestamp, decision timestamp")
    r = spark.createDataFrame(facts, "c string, t timestamp, av timestamp, v double")
    got = timeline.known_prefix(l, r, ["c"], F.col("target"), F.col("decision"), F.col("t"), F.col("av"), {
        "n": Running("sum", F.lit(1)), "s": Running("sum", F.col("v")), "low": Running("min", F.col("v")), "top": Running("max", F.struct("t", "av", "v")),
        "newest": Running("last", F.col("v"), [F.col("av")])}).collect()
    assert len(got) == 50
    for row in got:
        _, c, target, decision = asks[row.id]
        seen = [(t, av, v) for k, t, av, v in facts if c and k == c and target and t < target and av <= decision]
        values = [v for *_, v in seen if v is not None]
        assert ((row.n or 0), row.s, row.low) == (len(seen), sum(values) if values else None, min(values, default=None))
        assert (tuple(row.top) if seen else row.top) == (max(seen, key=lambda x: (x[0], x[1], -1 if x[2] is None else x[2])) if seen else None)
        assert row.newest == max(((t, av, v) for t, av, v in seen if v is not None), default=(None,))[-1]


def exchanges(df):
    """Shuffles in the plan as it is made before it runs."""
    return df._jdf.queryExecution().sparkPlan().toString().count("Exchange") + df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_two_clocks_of_small_keys_shuffle_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = spark.range(4000).select((F.col("id") % 100).alias("k"), F.timestamp_seconds(F.col("id")).alias("t"), F.timestamp_seconds(F.col("id") + 5).alias("av"))
        l = r.select("k", F.col("t").alias("target"), F.col("av").alias("decision"))
        got = timeline.known_prefix(l, r, ["k"], F.col("target"), F.col("decision"), F.col("t"), F.col("av"), {"n": Running("sum", F.lit(1))})
        assert exchanges(got) == 2
        assert got.agg(F.sum("n")).first()[0] == sum(k * 100 for k in range(40))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_that_no_ask_tells_apart_are_merged(spark):
    facts = spark.range(20000).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("__a"), F.timestamp_seconds(F.col("id") * 60 + 300).alias("__c"), F.lit(1).alias("n"))
    asks = spark.createDataFrame([("k", START.replace(year=1970) + dt.timedelta(hours=h), START.replace(year=1970) + dt.timedelta(hours=h)) for h in (0, 20, 300)], "k string, target timestamp, decision timestamp")
    merged = timeline._merged(asks, facts, ["k"], F.col("target"), F.col("decision"), {"n": "sum"})
    # All that the last ask may use, of at most nine pairs of limits.
    assert merged.count() <= 9 and merged.agg(F.sum("n")).first()[0] == 300 * 60 - 5 + 1


@pytest.mark.parametrize("rows_of_a_task", [20, 1 << 18])
def test_order_statistics_of_small_and_large_pools(spark, monkeypatch, rows_of_a_task):
    monkeypatch.setattr(quantiles, "ONE_TASK", rows_of_a_task)
    rng = random.Random(9)
    items = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, START + dt.timedelta(minutes=rng.randrange(60))]), rng.choice([None, float("nan"), float("inf"), -0.0] + [float(rng.randrange(30)) for _ in range(9)])) for _ in range(120)]
    states = [(k, START + dt.timedelta(minutes=m)) for k in ("a", "b", "c") for m in (-1, 3, 20, 59)]
    found = quantiles.asof_order_statistics(spark.createDataFrame(states, "k string, t timestamp"), spark.createDataFrame(items, "k string, u timestamp, v double"), ["k"], "t", "u", "v", {
        "low": F.lit(1), "third": F.floor(F.col("group_rows") / 3) + 1, "beyond": F.col("group_rows") + 1})
    got = {(r.k, r.t): r for r in found.collect()}
    pools = {(k, t): sorted(v for kk, u, v in items if kk == k and u and u <= t and v is not None and v == v) for k, t in states}
    assert set(got) == {x for x, pool in pools.items() if pool}
    for x, r in got.items():
        pool = pools[x]
        assert (r.group_rows, r.low, r.third, r.beyond) == (len(pool), pool[0], pool[len(pool) // 3], None)


def test_small_pools_are_shuffled_once(spark):
    states = spark.range(500).select((F.col("id") % 7).alias("k"), F.timestamp_seconds("id").alias("t"))
    items = states.select("k", F.col("t").alias("u"), F.rand(1).alias("v"))
    found = quantiles.asof_medians(states, items, ["k"], "t", "u", "v")
    assert exchanges(found) == 1 and found.count() == 500
    counted = timeline.asof_by_size(states, items, ["k"], F.col("t"), F.col("u"), {"n": Running("sum", F.lit(1))}, inclusive=False)
    assert exchanges(counted) == 1 and counted.agg(F.sum(F.coalesce("n", F.lit(0)))).first()[0] == sum(i // 7 for i in range(500))
