"""Rank-one spectra and whitening against numpy's decomposition of the whole covariance."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm.eigen import add_rows, combine, rank_one, secular_roots
from stratus.llm.whitening import whiten, whitened_rows

SCHEMA = "vec_id long, embedding array<float>, whitened string, deviation string"


def test_secular_roots_interlace():
    rng = np.random.default_rng(0)
    for k in (1, 2, 3, 20, 64):
        d = np.sort(rng.uniform(-5, 100, k))
        w = rng.lognormal(0, 6, k)  # weights over many orders of magnitude
        t, gap = secular_roots(d, w)
        assert np.all(t >= d) and np.all(t[:-1] <= d[1:]) and t[-1] <= d[-1] + w.sum() * (1 + 1e-12)
        assert np.allclose(np.sort(np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(w), np.sqrt(w)))), t, rtol=1e-9, atol=1e-9)
        assert gap.shape == (k, k)


@pytest.mark.parametrize("kind", ["plain", "repeated", "low rank", "zero rows", "one large"])
def test_rank_one_updates(kind):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 12)) * rng.uniform(0.1, 30, 12)
    if kind == "repeated":
        x = np.repeat(np.round(x[:8] / 20), 10, axis=0)
    if kind == "low rank":
        x = rng.normal(size=(80, 3)) @ rng.normal(size=(3, 12))
    if kind == "zero rows":
        x[::2] = 0
    if kind == "one large":
        x[5] *= 1e8
    one = np.zeros(12), np.eye(12)
    for v in x:
        one = rank_one(*one, v)
    for lam, u in (one, add_rows(np.zeros(12), np.eye(12), x)):
        scale = np.abs(x.T @ x).max()
        assert np.abs((u * lam) @ u.T - x.T @ x).max() < 1e-12 * scale
        assert np.abs(u.T @ u - np.eye(12)).max() < 1e-12


def test_combine_is_the_whole():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(90, 7)) + 5

    def state(rows):
        return (len(rows), rows.mean(0), *add_rows(np.zeros(7), np.eye(7), rows - rows.mean(0)))

    n, mean, lam, u = combine(combine(state(x[:10]), state(x[10:70])), state(x[70:]))
    c = x - x.mean(0)
    assert n == 90 and np.allclose(mean, x.mean(0)) and np.allclose((u * lam) @ u.T, c.T @ c)
    assert combine(state(x), (0, np.zeros(7), np.zeros(7), np.eye(7)))[0] == 90


def _vectors(n=700, dim=20, seed=3):
    rng = np.random.default_rng(seed)
    v = (rng.normal(size=(n, dim)) * np.linspace(0.3, 2, dim)).astype(np.float32)
    return np.r_[v, v[:50], np.repeat(v[:1], 400, axis=0)]  # repeated rows, one of them a third of all


def _brute(v, k):
    x = np.floor(64 * v.astype(np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = (fit * n - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    return n, ((x * n - s) ** 2).sum(1), ((x * n - s) / n) @ u[:, :k] / np.sqrt(e[:k]), e / e.sum()


@pytest.mark.parametrize("parts", [1, 40])  # 40: partial spectra are combined in several steps
def test_against_numpy(spark, parts):
    v = _vectors()
    bad = [(9000, None), (9001, []), (9002, [None] * 20), (9003, [float("nan")] + [0.0] * 19), (9004, [float("inf")] * 20), (9005, [1.0] * 3)]
    rows = [(i, x.tolist(), "a", "b") for i, x in enumerate(v)] + [(i, x, "a", "b") for i, x in bad]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = whitened_rows(df, components=16).orderBy("vec_id", "component").toPandas()
    n, dev, white, share = _brute(v, 16)
    assert len(got) == 16 * len(v) and set(got.n) == {n}
    z = got.whitened.to_numpy().reshape(-1, 16)
    assert np.abs(z * np.sign((z * white).sum(0)) - white).max() < 1e-9
    assert (got.deviation.to_numpy()[::16] == dev).all()
    assert np.allclose(got.explained.to_numpy()[:16], share[:16], rtol=1e-10)
    assert 0 <= got.identity_error.iloc[0] < 1e-10
    out, _ = whiten(df)
    assert out.count() == len(rows) and out.where("whitened IS NULL").count() == len(bad)
    assert dict(out.dtypes)["deviation"] == "bigint"


def test_degenerate_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitened_rows(empty).count() == 0 and whiten(empty)[1]["n"] == 0
    assert whitened_rows(spark.createDataFrame([(1, None, "", "")], SCHEMA)).count() == 0
    one = whitened_rows(spark.createDataFrame([(1, [1.0, 2.0], "", ""), (2, [1.0, 2.0], "", "")], SCHEMA)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, None, None)] * 4
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], "", "") for i in range(30)], SCHEMA)
    got = whitened_rows(line).orderBy("vec_id", "component").collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got)  # only one direction varies
    huge = spark.createDataFrame([(1, [1e30, 0.0]), (2, [1e16, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    rows = {r.vec_id: r for r in whiten(huge)[0].collect()}
    assert rows[1].whitened is None and rows[2].whitened is not None  # beyond a long, and within it
    assert rows[2].deviation is None  # its square exceeds a long


def test_dimension_of_most(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], "", "") for i in range(5)] + [(9, [1.0, 2.0, 3.0], "", "")], SCHEMA)
    out, model = whiten(df)
    assert model["dim"] == 2 and out.where("vec_id = 9 AND whitened IS NULL").count() == 1
    assert out.where(F.col("vec_id") < 9).where("size(whitened) = 2").count() == 5
