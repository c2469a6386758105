"""Whitening against numpy's eigendecomposition."""

import numpy as np
import pytest

from conftest import SF_SMALL
from intervalflow.llm import queries, whitening


@pytest.mark.parametrize("dim,wanted", [(64, 32), (200, 16), (5, 32), (1, 4)])
def test_jacobi_davidson_reaches_double_precision(dim, wanted):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(400, dim)) * np.linspace(0.1, 3, dim)
    c = x.T @ x / 400
    values, vectors, residual = whitening.jacobi_davidson(lambda b: c @ b, dim, wanted)
    want = np.linalg.eigvalsh(c)[::-1][:min(dim, wanted)]
    assert residual <= whitening.TOLERANCE * 100 and np.allclose(values, want, rtol=1e-11)
    assert np.abs(c @ vectors - vectors * values).max() < 1e-11 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-12


def test_minres_solves(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(12, 12))
    a, b = a + a.T, rng.normal(size=(12, 3))
    b[:, 2] = 0
    t = whitening.minres(lambda v: a @ v, b, 12)
    assert np.abs(a @ t - b).max() < 1e-8 and not t[:, 2].any()


def test_query_matches_numpy(spark):
    got = queries.op12_embedding_whitening(spark, SF_SMALL).toPandas()
    import pyarrow.parquet as pq
    t = pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pydict()
    keep = [(i, v) for i, v in zip(t["vec_id"], t["embedding"]) if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in keep])
    n, sums = len(x), x.sum(axis=0)
    c = (x - sums / n)
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    z = c @ u / np.sqrt(e)
    assert len(got) == 32 * n and set(got.n) == {n} and got.identity_error.max() < 1e-10
    dev = {i: sum(int(n * a - s) ** 2 for a, s in zip(row, sums.tolist())) for (i, _), row in zip(keep, x.tolist())}
    assert all(dev[i] == d for i, d in zip(got.vec_id, got.deviation))
    at = {i: k for k, (i, _) in enumerate(keep)}
    want = z[[at[i] for i in got.vec_id], got.component - 1]
    for k in range(1, 33):
        mine = (got.component == k).to_numpy()
        a, b = got.whitened.to_numpy()[mine], want[mine]
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-7
        assert np.allclose(got.explained.to_numpy()[mine], e[k - 1] / np.trace(v), rtol=1e-9)


def test_edge_tables(spark):
    schema = "vec_id long, embedding array<float>, id string, x int, whitened int"
    rows = [(1, [1.0, 2.0, 0.5], "a", 1, 1), (None, [0.0, 1.0, 0.0], "b", 1, 1), (1, [1.0, 2.0, 0.5], "a", 1, 1), (4, None, "c", 1, 1), (5, [1.0, None, 2.0], "d", 1, 1),
            (6, [float("nan"), 1.0, 1.0], "e", 1, 1), (7, [float("inf"), 1.0, 1.0], "e", 1, 1), (8, [], "f", 1, 1), (9, [5.0, -3.0, 2.0], "g", 1, 1)]
    out, model = whitening.whiten(spark.createDataFrame(rows, schema))
    got = out.collect()
    assert model.n == 4 and len(model.values) == 2 and sorted(str(r.id) for r in got) == ["1", "1", "9", "None"]      # two directions vary
    assert model.identity_error < 1e-9 and all(len(r.whitened) == 2 for r in got)
    out, model = whitening.whiten(spark.createDataFrame(rows[:1], schema))
    assert [(r.deviation, r.whitened) for r in out.collect()] == [(0, [])] and len(model.values) == 0
    out, model = whitening.whiten(spark.createDataFrame([], schema))
    assert model is None and out.count() == 0
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>"))


def test_deviations_beyond_64_bits(spark):
    rows = spark.createDataFrame([(1, [10**6 + 10**6, 10**6]), (2, [10**6 - 10**6, 10**6])], "id long, x array<long>")
    big = whitening.Whitening(10**9, np.array([10**15, 10**15]), np.array([1.0]), np.array([[1.0], [0.0]]), np.array([1.0]), 0.0, 0.0)
    assert {r.id: int(r.deviation) for r in whitening.transform(rows, big).collect()} == {1: 10**30, 2: 10**30}
