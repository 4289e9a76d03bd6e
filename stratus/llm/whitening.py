"""Whitening of embeddings by incremental eigendecomposition.

Every partition of the distinct vectors keeps a spectrum: rank-one updates, each
solved through the secular equation with deflation. Partial spectra are combined
sixteen at a time by further rank-one updates, and a distributed Rayleigh-Ritz
step over all vectors gives the components their full precision. What travels is
one small matrix for each partition; vectors never leave their partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .eigen import add_rows, combine
from .frames import Scratch, down_to_one, free_name, text_columns, with_results

BLOCK = 512
_LIMIT = float(1 << 62)
_LOW = np.int64((1 << 32) - 1)


def quantised(vectors: pa.Array, scale: float, offset: int, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(x, valid): ``floor(scale * c) + offset`` of the valid rows, and which rows are valid.

    A row is valid if it is not null, has ``dim`` entries (any number but none if
    not given, then rows are returned flat) and all of them are finite numbers
    whose result fits a long.
    """
    vectors = vectors.cast(pa.large_list(pa.float64()))
    size = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
    flat = pa.compute.fill_null(vectors.values, float("nan")).to_numpy(zero_copy_only=False)
    base = vectors.offsets.to_numpy()
    with np.errstate(invalid="ignore", over="ignore"):
        y = np.floor(scale * flat)
        good = np.isfinite(y) & (np.abs(y) < _LIMIT)
    bad = np.r_[0, np.cumsum(~good)]
    valid = (bad[base[1:]] == bad[base[:-1]]) & (size > 0 if dim is None else size == dim)
    valid &= ~np.asarray(vectors.is_null())
    at = np.repeat(base[:-1][valid] - np.r_[0, np.cumsum(size[valid])[:-1]], size[valid]) + np.arange(size[valid].sum())
    x = y[at].astype(np.int64) + offset
    return (x if dim is None else x.reshape(-1, dim)), valid


def _distinct_batches(batches: Iterator[pa.RecordBatch], scale: float, offset: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, valid = quantised(batch.column(0), scale, offset)
        size = pa.compute.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False)[valid].astype(np.int64)
        ends = np.r_[0, np.cumsum(size)] * 8
        body = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(x.tobytes())])
        yield pa.RecordBatch.from_arrays([body.cast(pa.binary()), pa.array(size.astype(np.int32))], names=["x", "dim"])


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, dim)
        for at in range(0, len(x), BLOCK):
            yield x[at : at + BLOCK]


_STATE = "part long, n long, high array<long>, low array<long>, mean array<double>, lam array<double>, u array<double>"


def _spectrum(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """One row for the partition: count, exact sums in two halves, and the spectrum about its mean."""
    state = (0, np.zeros(dim), np.zeros(dim), np.eye(dim))
    high, low = np.zeros(dim, np.int64), np.zeros(dim, np.int64)
    for x in _blocks(batches, dim):
        high += (x >> 32).sum(0)
        low += (x & _LOW).sum(0)
        first = x[0]
        near = (x - first).astype(np.float64)  # exact before it is centred
        mean = near.mean(0)
        lam, u = np.zeros(dim), np.eye(dim)
        if state[0]:  # the block's rows update the spectrum at hand, then the shift of the mean does
            m, old, lam, u = state
        lam, u = add_rows(lam, u, near - mean)
        if state[0]:
            k = len(x)
            apart = first + mean - old
            lam, u = add_rows(lam, u, (apart * np.sqrt(m * k / (m + k)))[None])
            state = (m + k, old + apart * (k / (m + k)), lam, u)
        else:
            state = (len(x), first + mean, lam, u)
    if state[0]:
        yield _state_row(TaskContext.get().partitionId(), state, high, low)


def _state_row(part: int, state: tuple, high: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    n, mean, lam, u = state
    cols = [[part], [n], [high.tolist()], [low.tolist()], [mean.tolist()], [lam.tolist()], [u.ravel().tolist()]]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.list_(pa.float64())] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["part", "n", "high", "low", "mean", "lam", "u"])


def _as_state(row: dict) -> tuple:
    lam = np.array(row["lam"])
    return row["n"], np.array(row["mean"]), lam, np.array(row["u"]).reshape(len(lam), len(lam))


def _combine_group(key: tuple, table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])  # in one order, whoever sent first
    state = _as_state(rows[0])
    for row in rows[1:]:
        state = combine(state, _as_state(row))
    high = np.sum([np.array(r["high"], np.int64) for r in rows], axis=0)
    low = np.sum([np.array(r["low"], np.int64) for r in rows], axis=0)
    high, low = high + (low >> 32), low & _LOW
    return pa.Table.from_batches([_state_row(key[0].as_py(), state, high, low)])


def _scatter(batches: Iterator[pa.RecordBatch], dim: int, centre: np.ndarray, rest: np.ndarray, basis: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The partition's sum of y y' for y the centred vectors in the basis."""
    total = np.zeros((basis.shape[1],) * 2)
    for x in _blocks(batches, dim):
        y = ((x - centre) - rest) @ basis
        total += y.T @ y
    yield pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()]), pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["part", "sums"]
    )


def _add_group(key: tuple, table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    sums = np.sum([r["sums"] for r in rows], axis=0)
    return pa.table({"part": [key[0].as_py()], "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})


RESULTS: list[tuple[str, T.DataType]] = [("whitened", T.ArrayType(T.DoubleType())), ("deviation", T.LongType())]


def _project(batch: pa.RecordBatch, name: str, scale: float, offset: int, model: dict) -> dict[str, object]:
    vectors = batch.column(batch.schema.get_field_index(name))
    x, valid = quantised(vectors, scale, offset, model["dim"])
    y = ((x - model["centre"]) - model["rest"] / model["n"]) @ model["basis"]
    count, k = len(valid), model["basis"].shape[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        z = y / np.sqrt(model["values"])
    bad = np.tile(~(model["values"] > 0), len(x))
    ends = np.r_[0, np.cumsum(valid)] * k
    whitened = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(z.ravel(), mask=bad), mask=pa.array(~valid))
    apart = x - model["centre"]
    if len(x) and ((float(np.abs(apart).max()) + 1) * model["n"]) ** 2 * model["dim"] >= _LIMIT:
        apart = apart.astype(object)  # whole numbers of any size
    apart = apart * model["n"] - model["rest"]
    sums = (apart * apart).sum(1)
    fits = np.array(sums < 1 << 63, bool)
    deviation = np.zeros(count, np.int64)
    deviation[valid] = np.where(fits, sums, 0)
    seen = valid.copy()
    seen[valid] = fits
    return {"whitened": whitened, "deviation": pa.array(deviation, mask=~seen)}


def whiten(df: DataFrame, vector: str = "embedding", components: int = 16, scale: float = 64.0, offset: int = 1_000_000) -> tuple[DataFrame, dict]:
    """(``df`` with ``whitened`` and ``deviation``, the fitted model).

    Entries c become ``x = floor(scale * c) + offset``. The fit takes each
    distinct x vector once: n vectors, sums S, covariance with divisor n. A row's
    ``whitened`` holds ``(x - S/n) . u / sqrt(e)`` for the first ``components``
    unit eigenvectors u by falling eigenvalue e; ``deviation`` is the exact sum
    of ``(n x - S)^2`` over the dimensions, null where that exceeds a long. Rows
    whose vector is null, empty, of another length than most distinct vectors
    have (ties: the shorter), or holds a null, a non-finite entry or one whose x
    exceeds a long take no part: both columns are null. A component without
    variance (eigenvalue below rounding) is null. The model holds ``n``,
    ``dim``, ``values`` (eigenvalues), ``explained`` (their shares of the trace)
    and ``identity_error``, the largest entry of the whitened covariance less
    the identity, measured over all distinct vectors; without any vector n is 0
    and the rest None. Input columns named like an added one are replaced.
    """
    scratch = Scratch(df.sparkSession)
    vectors = text_columns(df, vector)
    made = vectors.mapInArrow(partial(_distinct_batches, scale=scale, offset=offset), "x binary, dim int").distinct()
    made = scratch.store(made, compression="zstd")
    dims = made.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not dims:
        nulls = df.drop(*[n for n, _ in RESULTS]).withColumns({n: F.lit(None).cast(t) for n, t in RESULTS})
        return nulls, {"n": 0, "dim": 0, "values": None, "explained": None, "identity_error": None}
    dim = dims[0]["dim"]
    fit = made.where(F.col("dim") == dim).select("x")
    state = down_to_one(fit.mapInArrow(partial(_spectrum, dim=dim), _STATE), scratch, _combine_group, _STATE)
    n = state["n"]
    sums = [h * (1 << 32) + low for h, low in zip(state["high"], state["low"])]
    centre = np.array([s // n for s in sums], np.int64)  # S/n = centre + rest/n, all whole numbers
    rest = np.array([s % n for s in sums], np.int64)
    basis, _ = np.linalg.qr(np.array(state["u"]).reshape(dim, dim))

    def scatter(of: np.ndarray) -> np.ndarray:
        run = partial(_scatter, dim=dim, centre=centre, rest=rest / n, basis=of)
        got = down_to_one(fit.mapInArrow(run, "part long, sums array<double>"), scratch, _add_group, "part long, sums array<double>")
        return np.array(got["sums"]).reshape(of.shape[1], of.shape[1]) / n

    values, inner = np.linalg.eigh(scatter(basis))  # Rayleigh-Ritz: all vectors seen in the basis of the updates
    order = np.argsort(-values, kind="stable")
    values, basis = values[order], basis @ inner[:, order]
    trace = float(values.sum())
    values = np.where(values > dim * np.finfo(float).eps * max(trace, 0.0), values, 0.0)[:components]
    basis = basis[:, :components]
    own = scatter(basis)
    live = np.flatnonzero(values > 0)
    root = np.sqrt(values[live])
    error = float(np.abs(own[np.ix_(live, live)] / np.outer(root, root) - np.eye(len(live))).max()) if len(live) else None
    scratch.drop_all(but=[])
    explained = [float(v) / trace if trace > 0 else None for v in values]
    model = {"n": n, "dim": dim, "values": values, "explained": explained, "identity_error": error}
    inside = {"centre": centre, "rest": rest, "basis": basis, **model}
    return with_results(df, RESULTS, partial(_project, name=vector, scale=scale, offset=offset, model=inside)), model


def whitened_rows(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """A row for each row and component of :func:`whiten`, with the model's figures."""
    out, model = whiten(text_columns(df, *dict.fromkeys((key, vector))), vector, components)
    explained = F.array(*[F.lit(x).cast("double") for x in model["explained"] or []])
    at, value = free_name(out, "pos"), free_name(out, "value")
    rows = out.where("whitened IS NOT NULL").select(F.col(f"`{key}`"), "deviation", F.posexplode("whitened").alias(at, value))
    return rows.select(
        F.col(f"`{key}`"),
        (F.col(at) + 1).alias("component"),
        F.lit(model["n"]).cast("long").alias("n"),
        "deviation",
        F.col(value).alias("whitened"),
        F.get(explained, F.col(at)).alias("explained") if model["explained"] else F.lit(None).cast("double").alias("explained"),
        F.lit(model["identity_error"]).cast("double").alias("identity_error"),
    )
