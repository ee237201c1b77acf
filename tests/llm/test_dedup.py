import random

from pyspark.sql import functions as F

import numpy as np
import pandas as pd

from tidemark.llm import components, shingles, simhash, substrings
from tidemark.llm.common import among, bitmap, without_rows
from tidemark.llm.components import connected_components

from . import samples


def table(spark, pairs):
    return spark.createDataFrame(samples.rows_of(pairs), samples.DOCS)


def test_simhash_matches_brute_force(spark):
    pairs = samples.messy()
    got = simhash.near_duplicates(table(spark, pairs)).collect()
    assert len(got) == len(pairs)
    prints = {i: samples.fingerprint(t) for i, t in pairs if i is not None}
    expected = samples.components(sorted(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4)
    for row in got:
        if row["doc_id"] is None:
            assert row["component"] is None
        else:
            assert row["fp"] % (1 << 64) == prints[row["doc_id"]]
            assert row["component"] == expected[row["doc_id"]]
    assert expected[2] == expected[3] == 1 and expected[13] == 12 and expected[5] == expected[7] == 4


def test_links_survive_many_leaves_and_blocks(spark):
    """A dense cluster, chains and noise through deep trees and small blocks."""
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, dtype=np.int64)
    dense = {int(centre ^ (1 << int(a)) ^ (1 << int(b))) for a, b in rng.integers(0, 63, (150, 2))}
    chain, step = [], int(rng.integers(0, 1 << 63, dtype=np.int64))
    for i in range(12):
        chain.append(step)
        step ^= 0b1111 << (4 * i)
    prints = sorted(dense | set(chain) | {int(x) for x in rng.integers(0, 1 << 63, 500, dtype=np.int64)})
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "id long, fp long")
    links = simhash.near_links(frame, 4, leaf_rows=16, block_rows=40)
    assert all(bin(prints[r["a"]] ^ prints[r["b"]]).count("1") < 64 for r in links.collect())
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    expected = samples.components(range(len(prints)), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4)
    assert {n: got.get(n, n) for n in range(len(prints))} == expected


def test_components_of_a_chain_and_no_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 90, 90: 90}
    assert connected_components(links.limit(0)).count() == 0


def test_components_of_stars_take_one_round(spark, monkeypatch):
    """Every round is many jobs, whose plans and tasks the driver remembers: none is run to see that nothing changes."""
    written = []
    monkeypatch.setattr(components, "cut_lineage", lambda frame, cut=components.cut_lineage: written.append(1) or cut(frame))
    links = spark.createDataFrame([(5, 1), (1, 9), (5, 1), (20, 30), (30, 20), (4, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert got == {1: 1, 5: 1, 9: 1, 20: 20, 30: 20} and len(written) == 2
    stars = lambda *rows: components._stars(spark.createDataFrame(rows, "u long, v long"))
    assert stars((2, 1), (3, 1), (7, 5)) and not stars((2, 1), (3, 2)) and not stars((3, 1), (3, 2))


def test_a_bitmap_of_repeated_values_by_their_number(spark):
    values = np.arange(5000, dtype=np.int64) * 7919
    bits = bitmap(spark.createDataFrame([(int(v),) for v in values for _ in range(3)], "row long"), "row", 5000)
    assert among(bits, values).all() and len(bits) == 1 << 15  # 32 bits for each of 5,000, rounded up


def test_keep_one_keeps_columns_and_rows_without_a_key(spark):
    docs = table(spark, samples.messy())
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=lambda v: (v is None, v))
    assert {1, 4, 12, None} <= set(ids) and not {2, 3, 5, 7, 13} & set(ids)


def test_substrings_match_brute_force(spark):
    pairs = samples.messy()
    got = substrings.remove_repeats(table(spark, pairs)).collect()
    expected = samples.without_repeats(pairs)
    assert len(got) == len(pairs)
    for row in got:
        if row["doc_id"] is None:
            assert row["n_removed"] == 0 and row["n_words"] == 300
        else:
            assert (row["n_words"], row["n_removed"], row["kept"]) == expected[row["doc_id"]]
    assert expected[9][1] == 90 and expected[16][1] == 400 and expected[7][1] == 300 and expected[5][1] == 0


def test_substrings_with_a_full_sketch_and_parts(spark, monkeypatch):
    """A sketch far too small marks nearly all windows, and parts cut the texts; the result stays the same."""
    monkeypatch.setattr(substrings, "LEAST_CELLS", 1 << 15)
    monkeypatch.setattr(substrings, "MOST_CELLS", 1 << 15)
    pairs = samples.messy(seed=9, words=2500)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.remove_repeats(table(spark, pairs)).collect() if r["doc_id"] is not None}
    assert got == samples.without_repeats(pairs)


def test_sliding_minimum():
    values = np.random.default_rng(0).integers(0, 100, 97).astype(np.uint64)
    for width in (1, 5, 43, 97):
        assert substrings._sliding_min(values, width).tolist() == [int(values[i:i + width].min()) for i in range(97 - width + 1)]


def test_empty_tables(spark):
    docs = table(spark, samples.messy()).limit(0)
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0
    assert substrings.remove_repeats(docs).count() == 0


def test_vantage_bounds_lose_no_neighbour():
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 1 << 63, 3000, dtype=np.int64).view(np.uint64)
    tree = simhash.VantageTree.grow(fps, 22, 21, 6, 1)
    near = fps ^ np.uint64(1 << 30)
    row, leaf = tree.visits(fps, 1)
    homes = tree.homes(near)
    seen = set(zip(row.tolist(), leaf.tolist()))
    assert all((i, int(h)) in seen for i, h in enumerate(homes))
    assert len(seen) < 3000 * 64 / 2


def test_near_duplicate_stage_by_whole_shingle_sets(spark, monkeypatch):
    """Edited copies around the threshold, a group of copies behind one passage, against all pairs."""
    import corpus_pipeline

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    pairs, passage = [], [word() for _ in range(40)]
    for base in range(12):
        words = [word() for _ in range(200)]
        for copy in range(4):  # up to eight words apart from the base: similarities from 0.6 to 1
            edited = list(words)
            for at in rng.sample(range(200), 2 * copy + base % 3):
                edited[at] = word()
            pairs.append((len(pairs), " ".join(edited)))
    for other in range(90):  # mostly the passage, at all distances from each other
        own = [word() for _ in range(other % 7)]
        pairs.append((len(pairs), " ".join(passage + own if other % 2 else own + passage)))
    pairs += [(900, "same"), (901, "SAME"), (None, "same"), (902, None), (903, "")]
    sets = {i: samples.shingles(t) for i, t in pairs if i is not None}
    near = lambda a, b: sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) > 0
    first = samples.components(sorted(sets), near)
    expected = {i for i in first if first[i] == i} | {None}
    assert 2 * len(expected) < len(pairs) and any(first[i] == i for i in range(48) if i % 4)
    monkeypatch.setattr(shingles, "STARS", 1)
    kept = corpus_pipeline.near_duplicate_stage(spark, table(spark, pairs), "")
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == expected
    prints = {i: samples.fingerprint(t) for i, t in pairs if i is not None}
    assert any(near(a, b) and bin(prints[a] ^ prints[b]).count("1") > 4 for a in range(48) for b in range(a))


def crowd(rng, rows=240, size=90):
    """Sets around one base, at all distances from each other."""
    base, sets = rng.integers(0, 1 << 62, size).tolist(), []
    for _ in range(rows):
        changed = set(rng.choice(size, rng.integers(0, 16), replace=False).tolist())
        sets.append(np.unique(np.array([rng.integers(0, 1 << 62) if i in changed else h for i, h in enumerate(base)], np.uint64) >> np.uint64(16)))
    return sets


def test_blocks_of_a_frequent_shingle_report_no_pairs():
    sets = crowd(np.random.default_rng(8))
    n = len(sets)
    packed = [np.ascontiguousarray(s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes() for s in sets]
    rows = pd.DataFrame({"shingle": 1, "p": 0, "q": 0, "own": 0, "node": range(n), "part": range(n), "n": [s.size for s in sets], "place": 0,
                         "parity": [shingles.parity(s) for s in sets], "shingles": packed})
    near = lambda a, b: shingles._near(sets[a], sets[b])
    pairs = sum(near(a, b) for a in range(n) for b in range(a))
    expected = samples.components(list(range(n)), near)
    met = shingles._meet(rows.drop(columns="shingles"))
    assert len(met) <= n < pairs
    links = shingles._tie(met.merge(rows[["node", "shingles"]], on="node"))
    assert len(links) == n - len(set(expected.values())) and all(near(a, b) for a, b in zip(links["a"], links["b"]))
    linked = {frozenset(x) for x in zip(links["a"].tolist(), links["b"].tolist())}
    assert samples.components(list(range(n)), lambda a, b: frozenset((a, b)) in linked) == expected
    # Two blocks meet only each other, and equal parts not at all.
    halves = rows.assign(own=rows["node"] % 2, q=1)
    links = shingles._tie(halves)
    assert len(links) and all(a % 2 != b % 2 for a, b in zip(links["a"], links["b"]))
    assert shingles._meet(rows.drop(columns="shingles").assign(part=7)).empty


def test_near_duplicates_of_frequent_shingles_in_blocks(spark, monkeypatch):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base, pairs = [word() for _ in range(150)], []
    for i in range(60):
        edited = base[: rng.randrange(115, 151)]
        for at in rng.sample(range(len(edited)), rng.randrange(4)):
            edited[at] = word()
        pairs.append((i, " ".join(edited)))
    sets = {i: samples.shingles(t) for i, t in pairs}
    first = samples.components(sorted(sets), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    for name, value in (("SMALL", 3), ("BLOCK_ROWS", 16), ("STARS", 0)):
        monkeypatch.setattr(shingles, name, value)
    kept = shingles.keep_one(table(spark, pairs))
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i in first if first[i] == i}


def test_rows_go_by_key_and_text(spark):
    """Rows of one key with other texts stay, null keys and texts are told apart, repeated rows go together."""
    pairs = [(1, "a"), (1, "b"), (1, "a"), (None, "a"), (None, None), (2, None), (2, "a"), (3, "")]
    docs = table(spark, pairs)
    gone = docs.where("text = 'a' and (doc_id = 1 or doc_id is null) or doc_id = 3").select("doc_id", F.xxhash64(F.col("text").cast("binary")).alias("digest"))
    kept = without_rows(docs, gone)
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(repr, [(1, "b"), (None, None), (2, None), (2, "a")]))
    assert kept.columns == docs.columns
