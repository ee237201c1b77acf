import random

from pyspark.sql import functions as F

from tidemark.llm import license_queries, licenses

from . import samples

PHRASES = license_queries.PHRASES


def brute(text, templates, threshold=0.8, phrases=PHRASES):
    """(n_words, places, blocks) of one text, every block against every template."""
    words = samples.bench_words(text)
    places = [(label, i) for i in range(len(words)) for said, label in phrases.items() if words[i:i + len(said.split())] == said.split()]
    blocks = []
    for number, (label, body) in enumerate(templates):
        theirs = samples.bench_words(body)
        size = 1
        while size < len(theirs):
            size *= 2
        for start in range(0, len(words), size) if theirs else ():
            shared = len(set(words[start:start + 2 * size]) & set(theirs))
            if shared / len(set(theirs)) >= threshold - 1e-9:
                blocks.append((start, number, label, shared, shared / len(set(theirs))))
    return len(words), places, sorted(blocks)


def _pairs():
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choice(["the", "of", "license", "software", "and", "mit", "any", "zebra", "oak", "under", "is"]) for _ in range(n))
    pairs = samples.messy(words=1500)
    for number, (_, body) in enumerate(licenses.TEMPLATES):
        said = body.split()
        worn = [w for i, w in enumerate(said) if i % 7]
        pairs += [(100 + number, prose(rng.randint(0, 50)) + "\n" + body.upper() + "\n" + prose(30)), (200 + number, prose(9) + " " + " ".join(worn) + " " + prose(40))]
    pairs += [(300, "cc-by cc by CC_BY cc by"), (301, "All rights reserved all\nRIGHTS reserved."), (302, "GENERAL Public License " * 3), (None, "all rights reserved"),
              (None, "all rights reserved"), (300, "cc-by cc by CC_BY cc by"), (300, "other text under one id"), (303, prose(3000))]
    return pairs


def _check(spark, pairs, templates, threshold=0.8):
    docs = spark.createDataFrame(samples.rows_of(pairs), samples.DOCS).withColumn("digest", F.lit("clash")).withColumn("places", F.lit(1)).withColumn("cuts", F.lit(1))
    got = sorted((str(r["doc_id"]), r["n_words"], sorted((p["label"], p["start"]) for p in r["places"]), [tuple(b) for b in r["blocks"]])
                 for r in licenses.license_matches(docs, PHRASES, templates, threshold).collect())
    expected = []
    for key, text in pairs:
        n, places, blocks = brute(text, templates, threshold)
        expected.append((str(key), n, sorted(places), blocks))
    assert got == sorted(expected)
    return got


def test_matches_equal_all_pairs(spark):
    found = _check(spark, _pairs(), licenses.TEMPLATES)
    assert sum(len(row[3]) for row in found) >= 2 * len(licenses.TEMPLATES)
    _check(spark, _pairs(), [("a", "the of license software and"), ("b", "the the the oak"), ("none", " .,- "), ("c", "zebra")], threshold=0.5)


def test_empty_lists_and_tables(spark):
    docs = spark.createDataFrame(samples.rows_of(samples.messy(words=300)), samples.DOCS)
    assert all(not r["blocks"] for r in licenses.license_matches(docs, PHRASES, []).collect())
    assert all(not r["places"] for r in licenses.license_matches(docs, {}, licenses.TEMPLATES).collect())
    assert licenses.license_matches(docs.limit(0), PHRASES).count() == 0


def test_query_columns(spark, tmp_path):
    pairs = _pairs()
    spark.createDataFrame(samples.rows_of(pairs), samples.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in license_queries.op12_licenses(spark, str(tmp_path)).collect()), key=str)
    expected = []
    for key, text in pairs:
        n, places, blocks = brute(text, licenses.TEMPLATES)
        base, starts = {p[0] for p in places}, [p[1] for p in places]
        score = 1.0 if places else max((b[4] for b in blocks), default=0.0)
        expected.append((key, n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                         ",".join(sorted(base | {b[2] for b in blocks})), score))
    assert got == sorted(expected, key=str)
