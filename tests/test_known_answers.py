"""Cases with stated answers."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import ts
from tidemark.operators import book, calibration, evaluate, features, joins, market, models, quality, state, units

FEATURES = ("city string, contract string, target_time_utc string, feature_name string, source string, source_event_time string, issue_time string, "
            "valid_time string, revision string, available_at string, availability_reference_time string, retrieved_at string, value string, provenance string")


def feature(**change):
    row = {"city": "phx", "contract": "T108", "target_time_utc": "2026-09-14T07:00:00Z", "feature_name": "temperature_f", "source": "p", "source_event_time": "2026-09-13T11:45:00Z",
           "issue_time": None, "valid_time": "2026-09-13T11:45:00Z", "revision": "1", "available_at": "2026-09-13T11:50:00Z", "availability_reference_time": None,
           "retrieved_at": None, "value": "100.0", "provenance": "raw#1"} | change
    return tuple(row.values())


def vintages(spark, rows, decisions, scenario="base"):
    f = spark.createDataFrame(rows, FEATURES)
    d = spark.createDataFrame([("phx", c, "2026-09-14T07:00:00Z", t) for c, t in decisions], "city string, contract string, target_time_utc string, decision_time_utc string")
    p = spark.createDataFrame([("p", "base", 180.0), ("p", "conservative", 600.0), ("*", "base", -5.0)], "policy string, scenario string, seconds double")
    return features.reconstruct_vintages(f, d, p, scenario)


def test_revision_visible_at_each_decision(spark):
    rows = [feature(), feature(revision="2", available_at="2026-09-13T12:01:00Z")]
    chosen, bad, empty = vintages(spark, rows, [("T108", "2026-09-13T11:55:00Z"), ("T108", "2026-09-13T12:05:00Z"), ("T108", "2026-09-13T11:50:00Z"), ("T108", "2026-09-13T11:49:59Z"), ("other", "2026-09-13T12:05:00Z")])
    assert sorted(r.revision for r in chosen.collect()) == ["1", "1", "2"]
    assert bad.count() == 0 and empty.count() == 2


def test_latency_and_rejections(spark):
    lone = {"available_at": None, "availability_reference_time": "2026-09-13T11:45:00Z"}
    rows = [feature(**lone), feature(available_at=None), feature(source="q", **lone), feature(issue_time="2026-09-13T12:00:00Z"), feature(value=" ")]
    chosen, bad, _ = vintages(spark, rows, [("T108", "2026-09-13T11:48:00Z")])
    assert chosen.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["issue_time is after available_at", "missing availability", "missing value", "negative latency"]
    assert vintages(spark, rows, [("T108", "2026-09-13T11:48:00Z")], "conservative")[0].count() == 0


def test_earliest_future_label_and_taxonomy(spark):
    cols = "event_ticker string, city string, temp_type string, outcome_local_date date, model_name string, model_version string, lead_hours double, decision_time_utc timestamp, forecast_issue_time timestamp, source_receipt_time timestamp, mean_f double, stddev_f double"
    at = ts("2026-06-30T18:00Z")
    def row(event, receipt=ts("2026-06-30T12:05Z"), mean=100.0):
        return (event, "phx", "high", dt.date(2026, 7, 1), "m", "1", 18.0, at, ts("2026-06-30T12:00Z"), receipt, mean, 2.0)
    f = spark.createDataFrame([row("A"), row("B"), row("C"), row("D", ts("2026-07-01T00:00Z")), row("E", mean=float("nan"))], cols)
    labels = spark.createDataFrame([("A", ts("2026-07-03T08:00Z"), 103.0), ("A", ts("2026-07-02T08:00Z"), 101.0), ("B", ts("2026-06-01T00:00Z"), 5.0)], "event_ticker string, label_available_ts timestamp, observed_f double")
    good, bad = evaluate.forecast_skill(f, labels)
    assert [(r.event_ticker, r.observed_f) for r in good.collect()] == [("A", 101.0)]
    assert {r.event_ticker: r.reason for r in bad.collect()} == {"B": "target_leakage", "C": "no_label_found", "D": "missing_timestamp", "E": "invalid_value"}


LABELS = "city string, date date, tmax_f double, tmin_f double, label_available_ts timestamp"
SCHEDULE = "event_ticker string, decision_time_utc timestamp, city string, temp_type string, outcome_local_date date, lead_hours double"


def test_climatology_and_persistence(spark):
    labels = spark.createDataFrame([
        ("nyc", dt.date(2025, 7, 1), 80.0, 60.0, ts("2025-07-02T12:00Z")), ("nyc", dt.date(2025, 7, 2), 90.0, 60.0, ts("2025-07-03T12:00Z")),
        ("nyc", dt.date(2026, 7, 10), 999.0, 60.0, ts("2026-07-01T00:00Z")), ("nyc", dt.date(2026, 6, 1), 40.0, 60.0, ts("2026-06-02T12:00Z"))], LABELS)
    s = spark.createDataFrame([("E", ts("2026-07-09T00:00Z"), "nyc", "high", dt.date(2026, 7, 10), 18.0), ("X", ts("2026-07-09T00:00Z"), None, "high", dt.date(2026, 7, 10), 18.0)], SCHEDULE)
    good, bad = models.climatology(s, labels)
    assert [(r.mean_f, r.training_rows, r.stddev_f) for r in good.collect()] == [(85.0, 2, 5.0)]
    assert [r.reason for r in bad.collect()] == ["invalid_schedule"]
    two = spark.createDataFrame([("nyc", dt.date(2026, 7, 1), 80.0, 60.0, ts("2026-07-02T12:00Z")), ("nyc", dt.date(2026, 7, 2), 90.0, 60.0, ts("2026-07-20T12:00Z"))], LABELS)
    good, _ = models.persistence(s, two)
    assert [(r.mean_f, r.training_rows, r.stddev_f) for r in good.collect()] == [(80.0, 1, None)]


def test_sequence_windows_and_gap(spark):
    base = ts("2026-07-01T00:00Z")
    s = spark.createDataFrame([("phx", dt.date(2026, 7, 1), base + dt.timedelta(hours=h), float(h)) for h in range(4)], "city string, local_date date, feature_asof_utc timestamp, tmpf double")
    labels = spark.createDataFrame([("phx", dt.date(2026, 7, 1), 90.0, 55.0, ts("2026-07-02T12:00Z"))], LABELS)
    good, bad = state.sequence_windows(s, labels, ["tmpf"], window=3)
    assert good.count() == 4 and bad.count() == 0
    good, bad = state.sequence_windows(s, labels, ["tmpf"], window=3, max_gap_minutes=30)
    assert good.count() == 0 and {r.reason for r in bad.collect()} == {"sequence_gap"}


def test_nowcast_errors(spark):
    at = ts("2026-07-01T20:00Z")
    s = spark.createDataFrame([("phx", dt.date(2026, 7, 1), 13, at, 80.0, 60.0), ("phx", dt.date(2026, 7, 1), 13, ts("2026-07-03T00:00Z"), 80.0, 60.0)], "city string, local_date date, local_hour int, feature_asof_utc timestamp, observed_high_so_far_f double, observed_low_so_far_f double")
    labels = spark.createDataFrame([("phx", dt.date(2026, 7, 1), 90.0, 55.0, ts("2026-07-02T12:00Z"))], LABELS)
    row = evaluate.nowcast_errors(s, labels).first()
    assert (row.mae_high_f, row.mae_low_f, row.rejected_leakage) == (10.0, 5.0, 1)


def test_bucket_partition_and_skill(spark):
    b = "event_ticker string, market_ticker string, city string, temp_type string, outcome_local_date date, bucket_floor_f double, bucket_ceil_f double, result string"
    day = dt.date(2026, 7, 1)
    rows = [("E", "L", "phx", "high", day, None, 100.0, ""), ("E", "M", "phx", "high", day, 101.0, 103.0, ""), ("E", "H", "phx", "high", day, 104.0, None, ""),
            ("G", "GL", "phx", "high", day, None, 100.0, ""), ("G", "GH", "phx", "high", day, 103.0, None, "")]
    f = spark.createDataFrame([(e, "phx", "high", day, "m", "1", ts("2026-06-30T18:00Z"), ts("2026-06-30T12:00Z"), ts("2026-06-30T12:05Z"), 101.0, 2.0) for e in ("E", "G", "U")],
                              "event_ticker string, city string, temp_type string, outcome_local_date date, model_name string, model_version string, decision_time_utc timestamp, forecast_issue_time timestamp, source_receipt_time timestamp, mean_f double, stddev_f double")
    good, bad = models.bucket_probabilities(f, spark.createDataFrame(rows, b))
    assert abs(good.agg(F.sum("bucket_probability")).first()[0] - 1.0) < 1e-12
    assert {r.event_ticker: r.reason for r in bad.collect()} == {"G": "invalid_partition", "U": "unknown_event"}
    p = good.where("event_ticker = 'E' and market_ticker in ('L', 'M')").withColumn("bucket_probability", F.when(F.col("market_ticker") == "L", 0.25).otherwise(0.75))
    label = spark.createDataFrame([("E", ts("2026-07-02T08:00Z"), "M")], "event_ticker string, label_available_ts timestamp, settled_market_ticker string")
    row = evaluate.bucket_skill(p, label)[0].first()
    assert abs(row.brier - 0.125) < 1e-12 and abs(row.log_loss - 0.287682072452) < 1e-9


FRAME = "connection_epoch int, sid long, event_id long, received_ts timestamp, market_ticker string, seq long, type string, side string, price int, delta double, yes array<struct<price:int,qty:double>>, no array<struct<price:int,qty:double>>"


def frames(spark, *items):
    out = []
    for i, (ticker, seq, kind, *rest) in enumerate(items):
        snap = kind == "snap"
        side, price, delta = (None, None, None) if snap else rest
        yes, no = rest if snap else (None, None)
        out.append((1, 7, i, ts("2026-07-01T00:00Z") + dt.timedelta(minutes=i), ticker, seq, "orderbook_snapshot" if snap else "orderbook_delta", side, price, delta, yes, no))
    return spark.createDataFrame(out, FRAME)


def test_book_gap_quarantine_and_heal(spark):
    m = frames(spark, ("A", 1, "snap", [(40, 1.0)], []), ("A", 2, "delta", "yes", 40, 2.0), ("B", 3, "snap", [(50, 1.0)], []), ("A", 5, "delta", "yes", 40, 5.0),
               ("A", 6, "snap", [(41, 4.0)], []), ("A", 7, "delta", "yes", 41, -9.0), ("A", 8, "delta", "yes", 41, 2.0), ("B", 9, "delta", "yes", 50, 7.0), ("C", 10, "delta", "no", 30, 2.0))
    seq = book.sequence_books(m)
    assert {(r.market_ticker, r.seq) for r in seq.where("quarantined").collect()} == {("A", 5), ("B", 9)}
    live = {(r.market_ticker, r.side, r.price): r.qty for r in book.current_levels(book.level_history(seq)).collect()}
    assert live == {("A", "yes", 41): 2.0, ("B", "yes", 50): 1.0, ("C", "no", 30): 2.0}


def test_top_of_book_and_depth(spark):
    m = frames(spark, ("A", 1, "snap", [(40, 3.0)], [(55, 1.0), (50, 4.0)]))
    levels = book.current_levels(book.level_history(book.sequence_books(m)))
    row = book.top_of_book(levels).first()
    assert (row.best_yes_bid_cents, row.best_yes_ask_cents, row.spread_cents, row.imbalance) == (40.0, 45.0, 5.0, 0.5)
    fill = book.walk_depth(levels, 3.0, 0.1).first()
    assert fill.filled == 3.0 and abs(fill.gross_cost - (0.45 + 2 * 0.5)) < 1e-12


def test_book_features_after_every_frame(spark):
    rng = random.Random(11)
    items, seq = [("E", 1, "snap", [(0, 2.0), (99, 1.0)], [(49, 1.0), (50, 2.0)]), ("E", 2, "delta", "no", 50, -5.0), ("E", 3, "delta", "yes", 99, -1.0),
                  ("E", 4, "snap", [(30, 1.0), (30, 2.0)], []), ("E", 6, "delta", "yes", 31, 4.0), ("E", 6, "delta", "yes", 98, 9.0), ("E", 7, "snap", [], [])], 7
    for _ in range(150):
        seq += rng.choice([1] * 9 + [2])
        side = rng.choice(["yes", "no"])
        items.append((rng.choice("XY"), seq, "delta", side, rng.choice([0, 1, 48, 49, 50, 51, 98, 99]), float(rng.randrange(-4, 5))) if rng.random() < 0.9
                     else (rng.choice("XY"), seq, "snap", [(rng.randrange(100), 2.0)], [(p, 1.0) for p in rng.sample(range(100), 3)]))
    sequenced = book.sequence_books(frames(spark, *items))
    closes = spark.createDataFrame([("E", ts("2026-07-01T01:00Z")), ("X", None)], "market_ticker string, close_ts timestamp")
    for through in (True, False):
        got = {r.event_id: r for r in book.book_features(sequenced, closes, through).collect()}
        held, gaps, last, tainted = {}, 0, None, set()
        for i, (ticker, number, kind, *rest) in enumerate(items):
            if last is not None and number <= last:
                assert i not in got
                continue
            ladders = held.setdefault(ticker, {"yes": {}, "no": {}})
            if last is not None and number > last + 1:
                gaps += 1
                tainted |= set(held)
            last = number
            if kind == "snap":
                tainted.discard(ticker)
                for side, listed in zip(("yes", "no"), rest):
                    ladders[side] = {p: sum(q for x, q in listed if x == p) for p, _ in listed}
            elif through or ticker not in tainted:
                side, price, change = rest
                ladders[side][price] = ladders[side].get(price, 0.0) + change
                if ladders[side][price] <= 0:
                    del ladders[side][price]
            r, yes, no = got[i], ladders["yes"], ladders["no"]
            bid, ask = (max(yes) if yes else None), (100 - max(no) if no else None)
            up, down = yes.get(bid, 0.0), (no[100 - ask] if no else 0.0)
            assert (r.best_yes_bid_cents, r.best_yes_ask_cents, r.top_depth, r.sequence_gaps) == (bid, ask, up + down, gaps), (i, through)
            assert r.quarantined == (ticker in tainted) and r.spread_cents == (ask - bid if yes and no else None)
            assert r.imbalance == ((up - down) / (up + down) if up + down else None)
            assert r.minutes_to_close == (60.0 - i if ticker == "E" else None)
    bad = frames(spark, ("A", 1, "snap", [(100, 1.0)], []))
    with pytest.raises(Exception, match="not a whole cent"):
        book.book_features(book.sequence_books(bad)).collect()


def test_fills_at_decisions_walk_the_ladder_of_their_time(spark):
    items = [("A", 1, "snap", [(40, 3.0)], [(55, 1.0), (50, 4.0), (50, 1.0), (3, 9.0)]), ("A", 2, "delta", "no", 55, -1.0), ("A", 3, "delta", "no", 60, 2.0),
             ("A", 5, "delta", "no", 70, 8.0), ("A", 6, "snap", [], [(10, 1.0)]), ("A", 7, "snap", [(1, 1.0)], [])]
    sequenced = book.sequence_books(frames(spark, *items))
    start = ts("2026-07-01T00:00Z")
    asks = [("before", "A", -1, 5.0), ("first", "A", 0, 7.0), ("gone", "A", 1, 7.0), ("better", "A", 2, 4.0), ("same", "A", 2, 100.0), ("tainted", "A", 3, 4.0),
            ("healed", "A", 4, 4.0), ("empty", "A", 5, 4.0), ("none", "A", 2, None), ("negative", "A", 2, -3.0), ("other", "Z", 2, 1.0), ("unknown", None, 2, 1.0)]
    # Columns of the decisions may be called like those of the books.
    decisions = spark.createDataFrame(
        [(i, t, start + dt.timedelta(minutes=m, seconds=1), q, "x") for i, t, m, q in asks], "decision_id string, market_ticker string, decision_ts timestamp, quantity double, side string")
    got = {r.decision_id: r for r in book.fills_at(decisions, sequenced, 0.1).collect()}
    best = [(60, 2.0), (50, 5.0), (3, 9.0)]
    ladders = {"first": [(55, 1.0), (50, 5.0), (3, 9.0)], "gone": best[1:], "better": best, "same": best, "tainted": best, "healed": [(10, 1.0)], "none": best, "negative": best}
    assert set(got) == {a[0] for a in asks}
    for i, _, _, quantity in asks:
        left, cost, fills = max(quantity or 0.0, 0.0), 0.0, 0
        for price, held in ladders.get(i, []):
            taken = min(left, held)
            left, cost, fills = left - taken, cost + taken * (100 - price) / 100, fills + (taken > 0)
        row = got[i]
        assert (row.remaining, row.fills) == (left, fills) and abs(row.gross_cost - cost) < 1e-12 and abs(row.total_cost - 1.1 * cost) < 1e-12, i
        assert row.filled + row.remaining == max(quantity or 0.0, 0.0)
        assert row.quarantined == (None if i in ("before", "other", "unknown") else i == "tainted")
    # Applied through the gap, the tainted ask meets the eight at 70.
    assert {r.decision_id: r.fills for r in book.fills_at(decisions, sequenced, 0.1, True).collect()}["tainted"] == 1


def test_next_bar_separation(spark):
    c = spark.createDataFrame([("M", ts("2026-01-01T00:00Z"), .48, None, None, .50), ("M", ts("2026-01-01T00:02Z"), None, .55, .70, .60)], "market_ticker string, end_period_ts timestamp, yes_bid_close double, yes_ask_open double, yes_ask_high double, yes_ask_close double")
    s = spark.createDataFrame([("M", ts("2026-01-01T00:01Z"), .8)], "market_ticker string, decision_time_utc timestamp, bucket_probability double")
    o = spark.createDataFrame([("M", "yes")], "market_ticker string, settled_yes string")
    got = {r.scenario: round(r.fill_price, 9) for r in market.next_bar_fills(s, c, o).collect()}
    assert got == {"conservative": .70, "base": .60, "optimistic": .55}


def test_kelly_caps(spark):
    df = spark.createDataFrame([(.8, .4), (.3, .4)], "p double, q double").withColumns(market.kelly(F.col("p"), F.col("q"), 1000.0))
    a, b = df.collect()
    assert a.allocation_dollars <= 10 and b.contracts == 0


def test_admission_codes(spark):
    t = ts("2026-09-14T07:00Z")
    contracts = spark.createDataFrame([("A", t, t, "registry"), ("B", t, t, "registry")], "market_ticker string, target_time_utc timestamp, decision_ts timestamp, settlement_station_method string")
    labels = spark.createDataFrame([("A", "yes", ts("2026-09-14T06:00Z"), t, 74.0), ("B", "yes", None, None, 74.0)], "market_ticker string, kalshi_result string, label_available_ts timestamp, source_valid_utc timestamp, source_temperature_f double")
    f = spark.createDataFrame([("A", t, "{}")], "market_ticker string, decision_ts timestamp, features_json string")
    refused = spark.createDataFrame([("B", "late_source")], "market_ticker string, reason string")
    _, bad = features.admit(contracts, labels, f, refused)
    assert {r.market_ticker: r.reason_codes for r in bad.collect()} == {"A": "label_available_before_target", "B": "late_source;missing_label_availability;invalid_exact_settlement_time"}


def test_exact_time_label(spark):
    t = ts("2026-09-14T07:00Z")
    c = spark.createDataFrame([("A", "KNYC", t, 74.0, None, None, "above"), ("B", "KNYC", ts("2026-09-14T08:00Z"), 74.0, None, None, "above")], "market_ticker string, settlement_station string, target_time_utc timestamp, bucket_floor_f double, bucket_ceil_f double, threshold_f double, comparison string")
    o = spark.createDataFrame([("KNYC", t, 70.0, ts("2026-09-14T07:05Z")), ("KNYC", t, 73.9, ts("2026-09-14T07:10Z"))], "station string, valid_utc timestamp, temperature_f double, retrieved_at_utc timestamp")
    assert {r.market_ticker: r.source_observed_yes for r in joins.exact_newest(c, o).collect()} == {"A": "true", "B": ""}


def test_calibration_is_monotone_and_helps(spark):
    rows = spark.createDataFrame([(i / 40, int((i * 7 % 40) / 40 < (i / 40) ** 2)) for i in range(1, 40)], "prediction double, outcome int")
    platt = calibration.fit_platt(rows)
    scored = rows.withColumn("c", calibration.apply_platt(F.col("prediction"), platt))
    assert platt["a"] >= 0 and calibration.log_loss(scored, "c", "outcome") <= calibration.log_loss(rows, "prediction", "outcome") + 1e-9
    few = calibration.fit_beta(rows.limit(2))
    assert few["fallback"] and few["a"] == 1.0
    values = [r.calibrated for r in calibration.apply_isotonic(rows, calibration.fit_isotonic(rows)).orderBy("prediction").collect()]
    assert values == sorted(values) and all(math.isfinite(v) for v in values)


def test_forecast_runs_and_manifest_names(spark):
    t = ts("2026-01-01T00:00Z")
    hour = dt.timedelta(hours=1)
    rows = [("m", "NYC", t, t + 6 * hour, 6.0, t + hour, "a"), ("m", "NYC", t, t + 6 * hour, 6.0, t + hour, "a"),
            ("m", "LA", t, t + 7 * hour, 6.0, t - hour, "a"), ("m", "LA", t, t + 6 * hour, 6.0, t, "b"), (None, None, t, None, None, None, None),
            (None, None, t, t, None, None, None), (None, None, None, t, 1.0, t, None)]
    schema = "model string, city string, initialization_time timestamp, valid_time timestamp, lead_hours double, ingested_at timestamp, sha256 string"
    got = quality.forecast_run_audit(spark.createDataFrame(rows, schema)).first()
    assert tuple(got) == (7, 4, 3, 1, 3, 1)
    assert tuple(quality.forecast_run_audit(spark.createDataFrame([], schema)).first()) == (0,) * 6
    m = spark.createDataFrame([("x", 1, "a"), (None, 1, "b"), ("y", 1, "a"), ("z", None, None)], "name string, c int, s string")
    m = m.withColumn("name", F.when(F.col("name").isin("y", "z"), quality.manifest_key(["s", "c"])).otherwise(F.col("name")))
    assert tuple(quality.manifest_name_gate(m, ["c", "s"], "name").first()) == (4, 2, 1)
    assert tuple(quality.manifest_name_gate(m.limit(0), ["c", "s"], "name").first()) == (0, 0, 0)


def test_isotonic_blocks_do_not_depend_on_the_size_of_tasks(spark):
    """Falling, rising and level stretches with ties, against pooling in one list."""
    rng = random.Random(3)
    data = [(rng.randrange(1, 200) / 200, int(rng.random() < (0.5 + 0.4 * math.sin(i)))) for i in range(300)]
    data += [(0.3, 0)] * 20 + [(0.3, 1)] * 20 + [(None, 1), (0.5, None), (1.5, 1), (math.nan, 0)]
    counts = {}
    for p, y in data:
        if p is not None and y is not None and 0 <= p <= 1:
            counts[p, y] = counts.get((p, y), 0) + 1
    want = []
    for (p, y), n in sorted(counts.items()):
        want.append([p, p, float(y * n), float(n)])
        while len(want) > 1 and want[-2][2] / want[-2][3] >= want[-1][2] / want[-1][3]:
            low, high, total, weight = want.pop()
            want[-1] = [want[-1][0], high, want[-1][2] + total, want[-1][3] + weight]
    rows = spark.createDataFrame(data, "prediction double, outcome int")
    for task_blocks in (4, 10_000):
        got = sorted(tuple(r) for r in calibration.fit_isotonic(rows, task_blocks=task_blocks).collect())
        assert got == sorted((low, high, total / weight) for low, high, total, weight in want)
    assert calibration.fit_isotonic(rows.limit(0)).count() == 0


def test_point_variables_and_speeds(spark):
    rows = [("a", "2t", None, 273.15), ("a", "t", 850, 273.15), ("a", "t", 300, None), ("a", "gh", 500, 5.0), ("a", "hgt", 0, 6.0), ("a", "sp", 0, 101325.0),
            ("a", "10u", 10, 3.0), ("a", "10v", 10, 4.0), ("b", "10u", 10, 3.0), ("b", "10v", 10, 4.0), ("b", "10si", 10, 9.0),
            ("c", "u", 850, 6.0), ("c", "v", 850, 8.0), ("c", "v", 700, 1.0), (None, "10u", 10, 3.0), ("a", "zz", 0, 1.0), ("a", None, 0, 1.0)]
    df = units.point_variables(spark.createDataFrame(rows, "k string, code string, level int, value double"))
    got = sorted((r.k or "", r.variable, r.unit, r.value if r.value is None else round(r.value, 6)) for r in units.add_speeds(df, ["k"]).collect())
    mph = 2.2369362920544
    want = [("a", "temperature_2m", "F", 32.0), ("a", "temperature_850hpa", "F", 32.0), ("a", "temperature_pressure_level", "F", None),
            ("a", "geopotential_height_500hpa", "gpm", 5.0), ("a", "geopotential_height_500hpa", "gpm", 6.0), ("a", "pressure_surface", "hPa", 1013.25),
            ("a", "wind_u_10m", "mph", 3 * mph), ("a", "wind_v_10m", "mph", 4 * mph), ("a", "wind_speed_10m", "mph", 5 * mph),
            ("b", "wind_u_10m", "mph", 3 * mph), ("b", "wind_v_10m", "mph", 4 * mph), ("b", "wind_speed_10m", "mph", 9 * mph),
            ("c", "wind_u_850hpa", "mph", 6 * mph), ("c", "wind_v_850hpa", "mph", 8 * mph), ("c", "wind_v_pressure_level", "mph", mph),
            ("c", "wind_850hpa", "mph", 10 * mph), ("", "wind_u_10m", "mph", 3 * mph)]
    assert got == sorted((k, n, u, v if v is None else round(v, 6)) for k, n, u, v in want)


def test_robustness_delays(spark):
    base = ts("2026-01-01T00:00Z")
    cols = "prediction double, outcome int, decision_time_utc timestamp, source_receipt_time timestamp, nwp_receipt_time timestamp, observation_age_minutes double, threshold_distance_f double, spread double, volume double, quote_jump double"
    rows = spark.createDataFrame([(.8, 1, base + dt.timedelta(minutes=10), base, base, 3.0, .2, .06, 5.0, .2), (.8, 1, base + dt.timedelta(minutes=1), base, base, 3.0, .2, .06, 5.0, .2)], cols)
    got = {r.scenario: r.rows for r in evaluate.robustness(rows).collect()}
    assert got["feed_delay_2m"] == 1 and got["feed_delay_20m"] == 0 and got["wide_spread"] == 2


def test_bootstrap_equals_brute_force_and_gathers_no_path_on_the_driver(spark):
    import math
    import random

    from tidemark.operators import market

    rng, sims, block = random.Random(3), 1500, 5
    series = {"a": [rng.gauss(0, 0.02) for _ in range(123)], "b": [rng.gauss(0.001, 0.01) for _ in range(200)], "c": [0.1, None]}
    rows = [(k, t, v) for k, values in series.items() for t, v in enumerate(values)] + [(None, 0, 1.0)]
    spark.conf.set("spark.sql.maxBroadcastTableSize", "8m")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        got = {r["strategy"]: r for r in market.block_bootstrap(spark.createDataFrame(rows, "strategy string, t long, value double"), sims, block).collect()}
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert set(got) == set(series)
    for key, values in series.items():
        n, ends, falls = len(values), [], []
        for sim in range(sims):
            level, peak, fall, any_row = 0.0, 0.0, 0.0, False
            for slot in range(n):
                start = (sim * 7919 + slot // block * 104729 + 12345) * 69069 % 2147483647 * 48271 % 2147483647 % n
                value = values[(start + slot % block) % n]
                if value is not None:
                    any_row = True
                    level += math.log1p(value)
                    peak = max(peak, level)
                    fall = max(fall, 1 - math.exp(level - peak))
            if any_row:
                ends.append(math.exp(level) - 1)
                falls.append(fall)
        ends.sort()
        falls.sort()
        m = len(ends)
        assert got[key]["simulations"] == m
        assert got[key]["terminal_return_p05"] == pytest.approx(ends[int(0.05 * (m - 1))]) and got[key]["terminal_return_median"] == pytest.approx(ends[int(0.5 * (m - 1))])
        assert got[key]["max_drawdown_p95"] == pytest.approx(falls[int(0.95 * (m - 1))]) and got[key]["probability_of_loss"] == pytest.approx(sum(e < 0 for e in ends) / m)
