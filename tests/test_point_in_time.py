"""What a decision must not know yet, and what a lookup must not lose."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from pyspark.sql import functions as F

from tidemark.operators import features, joins, quantiles

from .conftest import ts

OBS = "station string, valid_utc timestamp, receipt_utc timestamp, temperature_f double"
ASKS = "market_ticker string, station string, decision_ts timestamp, target_time_utc timestamp"


def rows(spark):
    return spark.createDataFrame([
        ("a", ts("2026-07-01T09:00Z"), ts("2026-07-01T09:05Z"), 10.0), ("a", ts("2026-07-01T10:00Z"), ts("2026-07-01T20:00Z"), 99.0),
        ("a", ts("2026-07-01T12:00Z"), ts("2026-07-01T12:05Z"), 20.0), ("b", ts("2026-07-01T11:00Z"), ts("2026-07-01T11:05Z"), 50.0)], OBS)


def test_slopes_leave_out_late_receipts(spark):
    asks = spark.createDataFrame([("m", "a", ts("2026-07-01T12:30Z"), ts("2026-07-01T15:00Z")), ("late", "a", ts("2026-07-01T21:00Z"), ts("2026-07-01T15:00Z"))], ASKS)
    states = features.observation_features(asks, rows(spark))
    out = features.acceleration_feature(features.slope_features(states, rows(spark), minutes=(60,)), rows(spark))
    got = {r["market_ticker"]: r for r in out.collect()}
    assert got["m"]["observation_count"] == 2 and abs(got["m"]["temperature_slope_60m"] - 10 / 60) < 1e-12
    assert got["m"]["temperature_slope_acceleration"] is None
    assert got["late"]["observation_count"] == 3 and abs(got["late"]["temperature_slope_60m"] + 79 / 60) < 1e-12
    assert got["late"]["temperature_slope_acceleration"] == 20 - 2 * 99 + 10


def test_decision_after_the_target_sees_nothing_past_it(spark):
    asks = spark.createDataFrame([("m", "a", ts("2026-07-01T12:30Z"), ts("2026-07-01T11:00Z"))], ASKS)
    row = features.observation_features(asks, rows(spark)).first()
    assert row["observation_count"] == 1 and row["temperature_latest"] == 10.0


def test_blank_station_takes_all_and_a_named_one_only_its_own(spark):
    at, target = ts("2026-07-01T12:30Z"), ts("2026-07-01T12:00Z")
    asks = spark.createDataFrame([("all", None, at, target), ("blank", " ", at, target), ("own", "b", at, target), ("none", "c", at, target)], ASKS)
    forecasts = spark.createDataFrame([], "target_time_utc timestamp, source_receipt_time timestamp, value double")
    good, bad = features.decision_features(asks, rows(spark), forecasts)
    counts = {r["market_ticker"]: json.loads(r["features_json"])["observation_count"] for r in good.collect()}
    assert counts == {"all": 3, "blank": 3, "own": 1}
    assert [(r["market_ticker"], r["reason"]) for r in bad.collect()] == [("none", "missing_exact_settlement_station_observations")]


def test_radius_reaches_over_the_pole(spark):
    stations = spark.createDataFrame([("near", 88.0, 170.0), ("far", 80.0, 0.0), ("south", -89.9, 10.0)], "id string, lat double, lon double")
    cities = spark.createDataFrame([("n", 88.0, -100.0), ("s", -89.0, -170.0)], "city string, city_lat double, city_lon double")
    got = {(r["city"], r["id"]) for r in joins.within_radius(stations, cities, 500.0).select("city", "id").collect()}
    assert got == {("n", "near"), ("s", "south")}


def test_medians_of_a_growing_pool_are_exact(spark):
    values = [1.001, 1.002, 1.004, 1500.5, -2000.25, 1.001, 7e8]
    items = spark.createDataFrame([("k", ts(f"2026-07-0{i + 1}T00:00Z"), v) for i, v in enumerate(values)], "key string, at timestamp, value double")
    states = spark.createDataFrame([("k", ts(f"2026-07-0{i + 1}T12:00Z")) for i in range(7)], "key string, at timestamp")
    got = {r["at"].day: r for r in quantiles.asof_medians(states, items, ["key"], "at", "at", "value").collect()}
    import statistics
    name = [c for c in got[1].asDict() if "median" in c][0]
    assert {d: r[name] for d, r in got.items()} == {i + 1: statistics.median(values[:i + 1]) for i in range(7)}


def test_decision_payload_carries_quantiles_covariates_and_lineage(spark):
    at, target = ts("2026-07-01T12:30Z"), ts("2026-07-01T14:00Z")
    # A column of the contracts may be called like a covariate; the last ask is too early for any forecast.
    asks = spark.createDataFrame([("m", "a", at, target, "x"), ("early", "a", ts("2026-07-01T11:30Z"), target, "y")], ASKS + ", cape string")
    observations = spark.createDataFrame(
        [("a", ts("2026-07-01T11:00Z"), ts("2026-07-01T11:01Z"), 70.0, "5", "s1"), ("a", ts("2026-07-01T11:00Z"), ts("2026-07-01T11:09Z"), 70.0, "5", "s1"),
         ("a", ts("2026-07-01T12:00Z"), ts("2026-07-01T12:01Z"), None, "7.5", "s2"), ("a", ts("2026-07-01T12:10Z"), ts("2026-07-01T12:11Z"), 74.0, "NaN", "s3"),
         ("a", ts("2026-07-01T12:20Z"), ts("2026-07-01T12:50Z"), 99.0, "9", "late")],
        "station string, valid_utc timestamp, receipt_utc timestamp, temperature_f double, cape string, raw_sha256 string")
    values = [3.0, 1.0, None, 8.0, float("nan"), 2.0, 1e12]
    run = ts("2026-07-01T06:00Z")
    forecasts = spark.createDataFrame(
        [(target, ts(f"2026-07-01T12:0{i}Z"), v, "gfs", run if i != 1 else None) for i, v in enumerate(values)] + [(target, ts("2026-07-01T12:31Z"), 5.0, "gfs", ts("2026-07-01T12:00Z"))],
        "target_time_utc timestamp, source_receipt_time timestamp, value double, model string, initialization_time_utc timestamp")
    good, bad = features.decision_features(asks, observations, forecasts)
    rows_of = {r["market_ticker"]: r for r in good.collect()}
    row, early = rows_of["m"], json.loads(rows_of["early"]["features_json"])
    got = json.loads(row["features_json"])
    import numpy
    held = [v for v in values if v is not None and v == v]
    for name, q in (("q10", 0.1), ("q50", 0.5), ("q90", 0.9)):
        assert got[f"forecast_{name}"] == pytest.approx(numpy.quantile(held, q))
    assert got["forecast_iqr"] == pytest.approx(numpy.quantile(held, 0.75) - numpy.quantile(held, 0.25))
    assert (got["forecast_count"], got["forecast_member_count"], got["observation_count"]) == (7, 5, 4)
    # The newest row has no finite cape, the row before it is not asked.
    assert "cape" not in got and got["temperature_f"] == got["temperature_latest"] == 74.0 and row["cape"] == "x"
    assert (row["observation_ids"], row["source_run_ids"]) == (3, 1) and row["observation_digest"] > 0 and bad.count() == 0
    assert early["cape"] == 5.0 and early["forecast_count"] == 0 and "forecast_q50" not in early and "forecast_member_count" not in early


def test_quantiles_of_a_growing_pool(spark):
    import random

    import numpy
    rng = random.Random(3)
    start = ts("2026-07-01T00:00Z")
    data = [("hot", start + dt.timedelta(minutes=rng.randrange(5000)), rng.choice([0.0, -0.0, 1.5, rng.random(), -1e9 * rng.random(), 1e300])) for _ in range(300)]
    items = spark.createDataFrame(data + [("hot", None, 1.0), ("hot", start, None), ("hot", start, float("nan"))], "k string, u timestamp, v double")
    asks = [start + dt.timedelta(minutes=m) for m in (-5, 0, 40, 2500, 9000)]
    states = spark.createDataFrame([(k, a) for a in asks for k in ("hot", "none")], "k string, t timestamp")
    found = {r.t: r for r in quantiles.asof_quantiles(states, items, ["k"], "t", "u", "v", {"a": 0.0, "b": 0.37, "c": 1.0}).collect()}
    for a in asks:
        known = [v for _, u, v in data if u <= a]
        assert (a in {t.replace(tzinfo=a.tzinfo) for t in found}) == bool(known)
    for t, r in found.items():
        known = [v for _, u, v in data if u <= t.replace(tzinfo=start.tzinfo)]
        assert r.group_rows == len(known)
        assert [r.a, r.b, r.c] == pytest.approx([numpy.quantile(known, q) for q in (0.0, 0.37, 1.0)])


def test_spatial_spread_equals_brute_force_without_pairs(spark, monkeypatch):
    """Two groups, missing values, copies of an instant, a station of two groups; no row for each station of a decision's group is looked up."""
    import random

    rng, start = random.Random(4), ts("2026-07-01T00:00Z")
    at = lambda n: start + dt.timedelta(minutes=rng.randrange(n))
    stations = [("g", s) for s in range(30)] + [("h", s) for s in (3, 40)] + [(None, 1), ("h", None)]
    seen = [(rng.choice([*range(31), 40, None]), at(600), rng.choice([None, *range(50)])) for _ in range(300)] + [(1, None, 9.0)]
    seen = [(s, t, None if v is None else float(v)) for s, t, v in seen]
    asks = [(i // 2 if i < 6 else i, rng.choice(["g", "g", "h", "x", None]), rng.choice([None, at(640), at(640), at(640)])) for i in range(120)]
    real = joins.asof_join

    def bounded(left, *args, **kwargs):
        assert left.count() <= len(seen) + len(asks)
        return real(left, *args, **kwargs)

    monkeypatch.setattr(joins, "asof_join", bounded)
    got = {r["decision_id"]: r for r in joins.spatial_spread(
        spark.createDataFrame(asks, "decision_id int, group string, decision_time_utc timestamp"), spark.createDataFrame(stations, "group string, station int"),
        spark.createDataFrame(seen, "station int, valid_utc timestamp, temperature_f double")).collect()}
    want = {}
    for i, group, when in asks:
        for g, s in stations:
            known = [(t, -1e9 if v is None else v) for k, t, v in seen if s is not None and k == s and t and when and t <= when]
            if g and g == group and known:
                want.setdefault(i, []).append(max(known)[1])
    assert set(got) == set(want)
    for i, latest in want.items():
        values = [v for v in latest if v > -1e9]
        assert (got[i]["station_count"], got[i]["spatial_range"]) == (len(values), max(values) - min(values) if values else None)
        assert got[i]["spatial_mean"] == (pytest.approx(sum(values) / len(values)) if values else None)


@pytest.mark.parametrize("few", [3, 1024])
def test_newest_vintages_of_small_and_large_contracts(spark, monkeypatch, few):
    import random

    from .test_timeline import exchanges

    monkeypatch.setattr(features, "FEW", few)
    rng, start, target = random.Random(2), ts("2026-07-01T00:00Z"), ts("2026-07-02T00:00Z")
    at = lambda: start + dt.timedelta(minutes=rng.randrange(100))
    rows = [(rng.choice("abc"), "K", target, rng.choice("uv"), rng.choice("xy"), rng.choice([None, start]), str(i), at(), str(i), "p") for i in range(60)]
    rows += [(*r[:6], r[6] + "b", r[7], "later", "p") for r in rows[:10]]
    asks = [(i, rng.choice("abcd"), "K", target, at()) for i in range(40)]
    f = spark.createDataFrame(rows, "city string, contract string, target_time_utc timestamp, source string, feature_name string, issue_time timestamp, revision string, available_at timestamp, value string, provenance string").selectExpr(
        "*", "cast(null as timestamp) source_event_time", "cast(null as timestamp) valid_time", "cast(null as timestamp) retrieved_at", "cast(null as timestamp) availability_reference_time")
    d = spark.createDataFrame(asks, "id int, city string, contract string, target_time_utc timestamp, decision_time_utc timestamp")
    chosen, _, empty = features.reconstruct_vintages(f, d, spark.createDataFrame([("*", "base", 60.0)], "policy string, scenario string, seconds double"))
    if few > 60:
        assert exchanges(chosen) <= 6  # four of them for the joins with the policies
    want, none = {}, set()
    for i, city, _, _, when in asks:
        known = [r for r in rows if r[0] == city and r[7] <= when]
        none |= set() if known else {i}
        for r in known:
            key = (i, r[3], r[4])
            want[key] = max(want.get(key, r), r, key=lambda x: (x[7], x[5] is not None, x[6]))
    assert {(r["id"], r["source"], r["feature_name"]): r["revision"] for r in chosen.collect()} == {k: r[6] for k, r in want.items()}
    assert {r["id"] for r in empty.collect()} == none
