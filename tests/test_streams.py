"""Streams over directories: no frame is lost, order of files does not matter, replays change nothing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.streaming import jobs

START = dt.datetime(2026, 7, 1)


def files(spark, rows, schema, path, parts):
    spark.createDataFrame(rows, schema).repartition(parts).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_late_and_clockless_frames_are_kept_once(spark, tmp_path):
    schema = "frame_sha string, received_at timestamp"
    rows = [("aa1", START), ("aa2", START + dt.timedelta(days=2)), ("bb3", START - dt.timedelta(days=2)), ("cc4", None)]
    for extra in ([], [("dd5", None), ("aa1", None)]):
        stream = files(spark, rows + rows + extra, schema, f"{tmp_path}/in", 3)
        jobs.append_distinct(stream, f"{tmp_path}/out", f"{tmp_path}/offsets")
    assert sorted(r["frame_sha"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["aa1", "aa2", "bb3", "cc4", "dd5"]


def test_books_do_not_depend_on_the_order_of_files(spark, tmp_path):
    schema = ("event_id long, received_ts timestamp, market_ticker string, sid long, connection_epoch int, seq long, type string, side string, price int, delta double, "
              "yes array<struct<price:int,qty:double>>, no array<struct<price:int,qty:double>>")
    rows, seq = [], 0
    for i in range(60):
        seq += 2 if i in (20, 41) else 1
        snap = i % 15 == 0
        rows.append((i, START + dt.timedelta(minutes=i), "A" if i % 2 else "B", 1, 1 if i < 50 else 2, seq - (3 if i == 33 else 0), "orderbook_snapshot" if snap else "orderbook_delta",
                     "yes", 40, 1.0, [(40, 2.0)] if snap else [], []))
    seen = []
    for name, ordered in (("forward", rows), ("back", rows[::-1]), ("mixed", rows[1::2] + rows[::2])):
        for start in range(0, 60, 20):
            stream = files(spark, ordered[start:start + 20], schema, f"{tmp_path}/{name}", 2)
            jobs.follow_books(stream, f"{tmp_path}/{name}-out", f"{tmp_path}/{name}-offsets")
        health = spark.read.parquet(f"{tmp_path}/{name}-out/health").select("event_id", "event").orderBy("event_id").collect()
        books = spark.read.parquet(f"{tmp_path}/{name}-out/books").select("event_id", "quarantined").orderBy("event_id").collect()
        seen.append((health, books))
    assert seen[0] == seen[1] == seen[2]
    events = {r["event_id"]: r["event"] for r in seen[0][0]}
    assert len(events) == 60 and [i for i, e in events.items() if e == "gap"] == [20, 34, 41] and [i for i, e in events.items() if e == "stale"] == [33]


def test_upsert_survives_a_lost_checkpoint(spark, tmp_path):
    schema = "k long, receipt timestamp, body string"
    rows = [(i % 30, START + dt.timedelta(hours=i), f"b{i}") for i in range(90)]
    stream = files(spark, rows, schema, f"{tmp_path}/in", 3)
    for offsets in ("first", "lost"):
        jobs.upsert(stream, f"{tmp_path}/out", f"{tmp_path}/{offsets}", ["k"], F.col("receipt"), newest=True)
    got = {r["k"]: r["body"] for r in jobs.latest_version(spark, f"{tmp_path}/out").collect()}
    assert got == {i: f"b{60 + i}" for i in range(30)}


def test_ledger_takes_each_id_once(spark, tmp_path):
    schema = "record_id string, body string"
    stream = files(spark, [(f"r{i % 25}", "x") for i in range(100)], schema, f"{tmp_path}/in", 4)
    for offsets in ("first", "lost"):
        jobs.ingest_new(stream, f"{tmp_path}/out", f"{tmp_path}/{offsets}")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 25


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    from tidemark import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
