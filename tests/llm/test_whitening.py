import numpy as np
import pytest

from tidemark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, id string, n string, whitened string"


def _frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 0, "a", "b", "c", "d") for i, v in zip(ids, vectors)], SCHEMA)


def brute(vectors, scale=1024, offset=100_000):
    """Integers, exact sums, covariance by 128-bit floats."""
    x = np.floor(np.array(vectors, np.float32).astype(np.float64) * scale).astype(np.int64).astype(object) + offset
    n, sums = len(x), x.sum(axis=0)
    off = n * x - sums
    cov = (off.T.dot(off) / (n ** 3)).astype(np.float64)
    return n, off, cov


@pytest.mark.parametrize("low, high, dtype", [(-5000, 5000, np.int64), (-(1 << 61), 1 << 61, np.int64), (7, 8, np.int64)])
def test_popcounts_give_exact_products(low, high, dtype):
    x = np.random.default_rng(0).integers(low, high, (333, 7), dtype=dtype)
    x[:, 3] = 11
    sums, cross = whitening.block_moments(x)
    exact = x.astype(object)
    assert (sums == exact.sum(axis=0)).all() and (cross == exact.T.dot(exact)).all()


def test_whitening_matches_dense_algebra(spark):
    rng = np.random.default_rng(3)
    mixed = (rng.normal(size=(500, 12)) * np.linspace(0.2, 2, 12)) @ rng.normal(size=(12, 12))
    vectors = [[float(c) for c in v] for v in mixed]
    bad = [None, [], [1.0, None] + [0.0] * 10, [float("nan")] + [0.0] * 11, [float("inf")] + [0.0] * 11, [1.0, 2.0]]
    ids = list(range(497)) + [5, 5, None] + [900 + i for i in range(len(bad))]
    got = whitening.whiten(_frame(spark, vectors + bad, ids).repartition(7)).collect()
    n, off, cov = brute(vectors)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(got) == 500 * 8 and {r["n"] for r in got} == {500}
    deviations = sorted((str(i), int((o * o).sum())) for i, o in zip(ids, off))
    assert sorted((str(r["vec_id"]), r["deviation"]) for r in got if r["component"] == 1) == deviations
    assert all(int(r["deviation_exact"]) == r["deviation"] for r in got)
    for c in range(8):
        mine = {r["vec_id"]: r for r in got if r["component"] == c + 1}
        dense = (off / n).astype(np.float64) @ axes[:, c] / np.sqrt(values[c])
        some = [i for i in range(497) if i != 5]
        signs = {round(mine[i]["whitened"] / dense[i], 8) for i in some}
        assert signs in ({1.0}, {-1.0})
        assert mine[0]["explained"] == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
    assert got[0]["identity_error"] < 1e-9


def test_rows_and_partitions_do_not_change_the_moments(spark):
    vectors = [[float(c) for c in v] for v in np.random.default_rng(5).normal(size=(300, 5))]
    usable, width = whitening.finite_vectors(_frame(spark, vectors))
    one, many = (whitening.moments(usable.repartition(p), width) for p in (1, 40))
    assert one.n == many.n and one.sums == many.sums and (one.centred == many.centred).all()


def test_empty_equal_dependent_and_huge_vectors(spark):
    assert whitening.whiten(_frame(spark, [])).count() == 0
    assert whitening.whiten(_frame(spark, [None, [float("nan")]])).count() == 0
    equal = whitening.whiten(_frame(spark, [[1.0, 2.0, 3.0]] * 4)).collect()
    assert len(equal) == 12 and {(r["whitened"], r["deviation"], r["explained"], r["identity_error"]) for r in equal} == {(None, 0, None, None)}
    tied = whitening.whiten(_frame(spark, [[float(i), 2.0 * i, 0.5] for i in range(9)])).collect()
    assert len(tied) == 27 and all((r["whitened"] is None) == (r["component"] > 1) for r in tied)
    assert tied[0]["identity_error"] < 1e-9
    huge = whitening.whiten(_frame(spark, [[3e38, 1.0], [-3e38, 2.0], [1.0, 4.0]])).collect()
    assert len(huge) == 6 and all((r["deviation"] is None) == (r["vec_id"] < 2) for r in huge)
    assert all(np.isfinite(r["whitened"]) for r in huge if r["component"] == 1)
