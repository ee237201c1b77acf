import datetime as dt
import gzip
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, archive, url_filter

from . import samples
from .test_dedup import table


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


ENTRIES = [("block", "host", "a.example.com", "add", at(2)), ("block", "host", "a.example.com", "remove", at(5)), ("block", "host", "a.example.com", "add", at(5)),
           ("block", "host", "a.example.com", "add", at(8)), ("block", "domain", "example.com", "add", at(10)), ("block", "domain", "example.com", "remove", at(20)),
           ("allow", "prefix", "b.example.com/en/x", "add", at(12)), ("block", "host", "b.example.com", None, at(1)), ("block", None, "q", "add", at(1)),
           ("block", "host", "tie.net", "add", at(1)), ("allow", "domain", "tie.net", "add", at(1))]
URLS = [(1, "http://a.example.com/p", at(1)), (1, "http://a.example.com/p", at(1)), (2, "HTTP://user@A.Example.com:80?q", at(2)), (3, "http://a.example.com", at(6)), (4, "http://a.example.com", at(9)),
        (5, "https://b.example.com/en/x/y?z#w", at(13)), (6, "https://b.example.com/en/xx", at(13)), (7, "https://b.example.com/en/x", at(11)),
        (8, "https://badexample.com/", at(13)), (9, "https://example.com/", at(20)), (10, None, at(3)), (11, "no url", at(3)), (None, "http://tie.net", at(3)), (12, "http://tie.net", None),
        (13, "http://a.example.com/" + "s/" * 5000, at(6))]


def brute_verdict(url, when):
    import re
    m = re.match(r"[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)", url or "")
    if not m or when is None:
        return 0, False, ""
    host = re.sub(r":[0-9]*$", "", re.sub(r"^.*@", "", m[1])).lower()
    parts = [p for p in m[2].split("/") if p]
    active = []
    for rule in {e[:3] for e in ENTRIES if all(e)}:
        steps = sorted((e[4], e[3]) for e in ENTRIES if all(e) and e[:3] == rule and e[4] <= when)
        name, kind, pattern = rule
        fits = {"host": host == pattern, "domain": host == pattern or host.endswith("." + pattern),
                "prefix": "/".join([host, *parts]).startswith(pattern + "/") or "/".join([host, *parts]) == pattern}[kind]
        if steps and steps[-1][1] == "add" and fits:
            active.append((len(pattern), name == "allow", kind, pattern))
    if not active:
        return 0, False, ""
    best = max(active)
    return len(active), not best[1], f"{'allow' if best[1] else 'block'}:{best[2]}:{best[3]}"


def test_captures_are_judged_at_their_time(spark):
    captures = spark.createDataFrame([(*u, 7, "x") for u in URLS], "page_id long, url string, fetched_at timestamp, host int, kind string")
    entries = spark.createDataFrame(ENTRIES, "list_name string, kind string, pattern string, action string, dated timestamp")
    for days in (1, 32):
        got = url_filter.judge_captures(captures, entries, bucket_days=days).collect()
        want = sorted((repr(i), repr(u), *brute_verdict(u, w)) for i, u, w in set(URLS))
        assert sorted((repr(r["page_id"]), repr(r["url"]), r["n_active"], r["blocked"], r["rule"]) for r in got) == want
    assert url_filter.judge_captures(captures.limit(0), entries).count() == 0
    assert url_filter.judge_captures(captures, entries.limit(0)).where("blocked").count() == 0


def test_intervals_run_over_months(spark):
    steps = [("block", "host", "h", "add" if i % 2 == 0 else "remove", dt.datetime(2024, 1 + i, 3)) for i in range(6)]
    entries = spark.createDataFrame(steps, "list_name string, kind string, pattern string, action string, dated timestamp")
    got = sorted((r["valid_from"].month, r["valid_to"].month) for r in url_filter.list_intervals(entries).collect())
    assert got == [(1, 2), (3, 4), (5, 6)]


LONG = "<p>" + "längerer Text\r\n\r\nWARC/1.1\r\n" * 3000
PAGES = [(5, "http://x/1", LONG), (3, "http://x/2", LONG), (3, "http://x/2", LONG), (9, "http://x/ 3\n", LONG), (None, "http://x/4", LONG), (7, None, "short"), (8, "http://x/5", "short"),
         (10, "", None), (11, "http://x/6", ""), (12, "http://x/7", "é" * 50), (13, "http://x/8", "é" * 50), (14, "http://x/9", "é" * 49), (15, "http://x/9", "é" * 49)]


def through_archives(spark, pages):
    arcs, warcs = archive.scratch(spark, "arc"), archive.scratch(spark, "warc")
    archive.write_arc(archive.http_captures(pages, F.lit("2024-02-03 04:05:06").cast("timestamp")), arcs)
    archive.write_warc(archive.to_warc(spark, arcs), warcs)
    return archive.warc_records(spark, warcs)


def test_pages_come_back_through_arc_and_warc(spark):
    pages = spark.createDataFrame([(*p, 1, "x", b"y") for p in PAGES], "page_id long, url string, html string, id int, block string, payload binary").repartition(3)
    rows = through_archives(spark, pages).collect()
    pages_back = [r for r in rows if r["record_type"] != "warcinfo"]
    assert len(pages_back) == len(PAGES) and len({r["record_id"] for r in rows}) == len(rows)
    assert any(r["record_type"] == "warcinfo" for r in rows)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted((repr(r["id"]), r["payload_bytes"], r["payload_sha256"]) for r in pages_back) == sorted((repr(i), len((t or "").encode()), sha(t)) for i, _, t in PAGES)
    kinds = {}
    for r in pages_back:
        kinds.setdefault(r["id"], set()).add(r["record_type"])
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() in {t or "" for i, _, t in PAGES if i == r["id"]}
        assert r["date"] == "2024-02-03T04:05:06Z"
    assert kinds == {5: {"revisit"}, 3: {"response"}, 9: {"revisit"}, None: {"revisit"}, 7: {"response"}, 8: {"response"}, 10: {"response"}, 11: {"response"},
                     12: {"response"}, 13: {"revisit"}, 14: {"response"}, 15: {"response"}}
    by_record = {r["record_id"]: r["id"] for r in pages_back}
    assert {r["id"]: by_record[r["refers_to_id"]] for r in pages_back if r["refers_to_id"]} == {5: 3, 9: 3, None: 3, 13: 12}
    assert {r["url"] for r in pages_back} >= {"urn:page:7", "urn:page:10", "http://x/%203%0A".replace("%0A", "%20")}


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert through_archives(spark, pages).where("record_type <> 'warcinfo'").count() == 0


def test_arc_versions_and_faults():
    one = b"filedesc://a 0.0.0.0 19960101000000 text/plain 76\n1 0 org\nURL IP-address Archive-date Content-type Archive-length\n" 
    block = b"1 0 org\nURL IP-address Archive-date Content-type Archive-length\n"
    one = b"filedesc://a 0.0.0.0 19960101000000 text/plain %d\n" % len(block) + block + b"\nhttp://a/ 1.2.3.4 19970101000000 text/html 5\na\nb\nc\n"
    assert [b for _, _, b in archive.parse_arc(one)] == [block, b"a\nb\nc"]
    assert [b for _, _, b in archive.parse_arc(archive.inflate(gzip.compress(one[:90]) + gzip.compress(one[90:])))] == [block, b"a\nb\nc"]
    for broken in (one[:-3], one.replace(b"text/html 5", b"text/html 200 - - 5"), b"what is this\n", one[60:]):
        with pytest.raises(ValueError):
            list(archive.parse_arc(broken))
    with pytest.raises(ValueError):
        archive.inflate(gzip.compress(one)[:-12])
    with pytest.raises(ValueError):
        list(archive.parse_warc(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))


def vectors(seed=1, n=900, width=12):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in rng.standard_normal(width)]) for i in range(n)]
    rows += [(n + i, [1.0] * width) for i in range(300)]  # one vector many times
    rows += [(5000, None), (5050, [0.0] * width), (5100, [math.nan] + [1.0] * (width - 1)), (5150, [math.inf] + [0.0] * (width - 1)), (5200, [1.0]), (None, [1.0] * width),
             (5250, []), (100, rows[100][1]), (6000, [1e-200] * width), (6050, [1e200] + [0.0] * (width - 1))]
    return rows + [(7000, [None] + [1.0] * (width - 1))]


def brute_nearest(rows, k=5):
    usable = {i: np.array(v) for i, v in rows if i is not None and v and len(v) == 12 and None not in v and np.isfinite(v).all() and any(v)}
    ids = np.array(sorted(usable))
    matrix = np.stack([usable[i] / np.abs(usable[i]).max() for i in ids])
    unit = matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    out = {}
    for q in ids[ids % 50 == 0]:
        score = unit @ unit[np.searchsorted(ids, q)]
        score[ids == q] = -9
        out[int(q)] = ids[np.lexsort((ids, -np.round(score, 12)))[:k]].tolist()
    return out


def test_nearest_recall_ties_and_exclusions(spark):
    rows = vectors()
    frame = spark.createDataFrame([(i, v, 3, 1) for i, v in rows], "vec_id long, embedding array<double>, id int, list int")
    got = {}
    for r in ann.nearest(frame, F.col("id") % 50 == 0, settings=ann.Settings(chunk_rows=64, query_rows=7, block=5)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute_nearest(rows)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & set(want[q])) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert all(len(v) == 5 and len({i for i, _ in v}) == 5 and q not in {i for i, _ in v} for q, v in got.items())
    assert [i for i, _ in got[950]] == [900, 901, 902, 903, 904] and all(a[1] >= b[1] for v in got.values() for a, b in zip(v, v[1:]))


def test_queries_are_sent_in_blocks_of_bounded_size(spark):
    """Every query visits most lists; the pairs of queries and lists must not be gathered on the driver to be broadcast."""
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(2000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "256k")
    try:
        got = ann.nearest(frame, F.col("id") % 2 == 0, settings=ann.Settings(query_rows=300)).collect()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert len(got) == 5 * 1000 and {r["query_id"] for r in got} == set(range(0, 2000, 2))
    first, vectors = {r["query_id"]: r["vec_id"] for r in got if r["rank"] == 1}, dict(rows)

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5

    some = range(0, 200, 10)
    assert sum(first[q] == max((i for i in vectors if i != q), key=lambda i: cosine(vectors[i], vectors[q])) for q in some) >= 0.8 * len(some)


def test_few_and_no_vectors(spark):
    kind = "vec_id long, embedding array<double>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])], kind)
    got = [tuple(r) for r in ann.nearest(three, F.col("id") % 50 == 0).orderBy("rank").collect()]
    assert [(q, k, i, round(s, 9)) for q, k, i, s in got] == [(0, 1, 1, round(0.5 ** 0.5, 9)), (0, 2, 2, -1.0)]
    assert ann.nearest(three.limit(0), F.col("id") % 50 == 0).count() == 0
    assert ann.nearest(spark.createDataFrame([(0, [1.0])], kind), F.col("id") % 50 == 0).count() == 0


def test_pipeline_stages_on_messy_documents(spark, tmp_path):
    import corpus_pipeline

    rng_text = [(1000 + i, f"the river ran by house number {i} and people of the town went to market") for i in range(30)]
    junk = [(2000 + i, f"BUY$$$ NOW!!! ### {i} %%% click&&& here***") for i in range(30)]
    bench = "seven wizards box quietly near old mills today and tomorrow while rain falls over the hills"
    extra = [(3000, "they said " + bench), (3001, "my token = 'abcdef0123456789' stays here"), (3000, "they said " + bench)]
    docs = table(spark, samples.messy() + rng_text + junk + extra)
    folder = str(tmp_path)
    spark.createDataFrame([(i, int(i < 2000), 0) for i, _ in rng_text + junk], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, bench), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{folder}/out{number}"
        stage(spark, docs, folder).write.parquet(out)
        after = spark.read.parquet(out)
        if name != "tokens":
            assert after.columns == docs.columns and after.schema.simpleString() == docs.schema.simpleString()
        docs = after
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    quality, near, clean, secret, tokens = kept
    assert not quality & {i for i, _ in junk} and {i for i, _ in rng_text} <= quality
    assert near <= quality and clean == near - {3000} and secret == tokens == clean
    texts = {r["doc_id"]: r["decoded"] for r in docs.collect()}
    assert texts[3001] == "my [secret]' stays here"
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    for name, stage in corpus_pipeline.STAGES:
        empty = table(spark, samples.messy()).limit(0)
        assert stage(spark, empty, folder).count() == 0
