import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import run_queries, runs

from . import samples


def brute_lyndon(word):
    """The longest Lyndon word at i ends where the next smaller suffix starts."""
    return [next((j for j in range(i + 1, len(word)) if word[j:] < word[i:]), len(word)) - i for i in range(len(word))]


def brute_runs(word, exponent=4, shortest=6):
    found = set()
    for period in range(1, len(word) // 2 + 1):
        i = 0
        while i + period < len(word):
            start = i
            while i + period < len(word) and word[i] == word[i + period]:
                i += 1
            length = i + period - start
            if length >= max(shortest, exponent * period) and not any(
                    all(word[start + k] == word[start + k + d] for k in range(length - d)) for d in range(1, period)):
                found.add((start, length, period))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(key, words):
    h = zlib.crc32(str(key).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def kept(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_lyndon_arrays_and_runs_match_brute_force():
    rng = random.Random(1)
    for _ in range(600):
        letters = rng.randint(1, 4)
        word = [rng.randint(1, letters) for _ in range(rng.randint(0, 50))]
        if rng.random() < 0.5:
            root, at = [rng.randint(1, letters) for _ in range(rng.randint(1, 6))], rng.randint(0, len(word))
            word = word[:at] + (root * 12)[:rng.randint(1, 40)] + word[at:]
        ids = np.array(word, np.int64)
        assert runs.lyndon_array(word) == brute_lyndon(word)
        assert sorted(runs.runs_of(ids)) == sorted(brute_runs(word))
        assert sorted(runs.runs_of(ids, 2, 2)) == sorted(brute_runs(word, 2, 2))
        said = [b"w%d" % w for w in word]
        assert runs.runs_of_texts([said, [], [b"w1"], said]) == [brute_runs(word), [], [], brute_runs(word)]


def test_a_long_text_of_one_root():
    words = [b"%d" % (i % 3000) for i in range(30_000)]
    assert runs.runs_of_texts([words]) == [[(0, 30_000, 3000)]]
    assert runs.collapsed(words, [(0, 30_000, 3000)]).split() == words[:3000]


def _pairs():
    rng = random.Random(2)
    pairs = samples.messy(words=1500) + [(30, "a b a b a b a b"), (31, "x\tx\nx x x"), (32, "x x x x x x y y y y y y y"), (None, "z " * 9), (None, None)]
    return pairs + [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 80)))) for i in range(100, 160)]


def test_periodic_runs_match_brute_force(spark):
    pairs = _pairs()
    docs = spark.createDataFrame(samples.rows_of(pairs), samples.DOCS)
    docs = docs.withColumn("runs", F.lit("clash")).withColumn("n_words", F.lit("clash")).withColumn("collapsed", F.lit("clash"))
    got = sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(docs).collect())
    expected = []
    for key, text in pairs:
        words = samples.re.findall(r"[^\x20\x09-\x0D]+", text or "")
        found = brute_runs(words)
        expected.append((str(key), len(words), found, kept(words, found)))
    assert got == sorted(expected)
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_query_plants_and_digests(spark, tmp_path):
    pairs = _pairs()
    spark.createDataFrame(samples.rows_of(pairs), samples.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in run_queries.op11_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    expected, changed = [], 0
    for key, text in pairs:
        said = samples.re.findall(r"[^\x20\x09-\x0D]+", text or "")
        words = said if key is None else planted(key, said)
        changed += words != said
        found = brute_runs(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{a},{n},{p}\n" for a, n, p in found)
        longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        expected.append((key, len(found), *longest, samples.sha(lines), samples.sha(kept(words, found))))
    assert got == sorted(expected, key=str)
    assert changed > 3


@pytest.mark.parametrize("size", [1, 2, 5])
def test_short_texts_hold_no_run(size):
    assert runs.runs_of_texts([[b"a"] * size]) == [[]]
