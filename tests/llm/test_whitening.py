"""Whitening against numpy on the whole matrix."""

import numpy as np
import pytest

from kestrel.llm import whitening as W


def whole(vectors, most=8):
    """(deviation, whitened up to sign, explained) by plain linear algebra."""
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    above = n * x - s
    c = above / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return (above ** 2).sum(axis=1), c @ u / np.sqrt(e), e / np.trace(v)


def table(rows):
    """vec_id -> rows by component."""
    out = {}
    for r in rows:
        out.setdefault(r.vec_id, []).append(r)
    return {k: sorted(v, key=lambda r: r.component) for k, v in out.items()}


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(5)
    mix = r.normal(size=(12, 12)) * np.linspace(2.0, 0.1, 12)
    return (r.normal(size=(2500, 12)) @ mix).astype(np.float32).tolist()


def test_against_numpy(spark, vectors):
    odd = [(-1, None), (-2, []), (-3, [float("nan")] * 12), (-4, [None] + [1.0] * 11), (-5, [float("inf")] * 12),
           (-6, [1e300] * 12)]
    rows = [(i, v) for i, v in enumerate(vectors)]
    d = spark.createDataFrame([(*x, 1, 2.0) for x in rows + odd],
                              "vec_id long, embedding array<double>, index int, n double").repartition(5)
    got = table(W.whiten(d).collect())
    deviation, white, explained = whole(vectors)
    assert set(got) == set(range(len(vectors)))
    y = np.array([[c.whitened for c in got[i]] for i in range(len(vectors))])
    assert np.abs(y * np.sign((y * white).sum(axis=0)) - white).max() < 1e-9
    for i in (0, 7, 2499):
        assert [c.component for c in got[i]] == list(range(1, 9))
        assert all(c.deviation == deviation[i] and c.n == len(vectors) for c in got[i])
        assert np.allclose([c.explained for c in got[i]], explained, rtol=1e-9)
        assert all(0 <= c.identity_error < 1e-9 for c in got[i])


def test_rows_are_indexed_without_gaps(spark):
    d = W.stored(spark.range(1000, numPartitions=7).where("id % 3 <> 0"), "t")
    got = W.indexed(d).collect()
    assert sorted(r["index"] for r in got) == list(range(len(got))) and len({r.id for r in got}) == len(got)


def test_scatter_in_parts(spark, vectors, monkeypatch):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "index long, v array<double>")
    monkeypatch.setattr(W, "BLOCK_ROWS", 100)
    monkeypatch.setattr(W, "PART_BYTES", 20_000)
    m = W.block_matrix(rows, "index", "v", len(vectors), 12)
    assert m.numRowBlocks == 25
    a = np.array(vectors, dtype=np.float64)
    assert np.allclose(W.scatter(m), a.T @ a, rtol=1e-12)


def test_few_components_and_lengths(spark):
    """Equal vectors, a space of three numbers, a single vector, repeated rows."""
    r = np.random.default_rng(1)
    three = [[float(a), float(b), float(a + b)] for a, b in r.integers(-5, 5, size=(40, 2))]   # rank 2
    rows = [(i, v) for i, v in enumerate(three)] + [(0, three[0])] + [(100, [1.0] * 5), (101, [1.0] * 5), (None, [2.0])]
    got = table(W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    assert len(got[0]) == 6 and len(got[1]) == 3 and len(got[100]) == 5 and len(got[None]) == 1
    assert all(c.whitened is None and c.deviation == 0 and c.identity_error == 0 for c in got[100] + got[None])
    assert [c.whitened is None for c in got[1]] == [False, False, True] and got[1][0].identity_error < 1e-9
    assert got[1][0].n == 41 and abs(sum(c.explained for c in got[1]) - 1) < 1e-9
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert W.whiten(none).collect() == [] and W.whiten(none).dtypes == W.whiten(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>")).dtypes
