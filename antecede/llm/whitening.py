"""Whitening of embeddings by principal components, found with contour integrals.

Three passes over the vectors gather sums, the covariance (centred before multiplying) and, at the
end, the covariance of the whitened values; each task gives back one number per pair of dimensions,
which Spark adds up. Only the covariance, ``dims`` by ``dims``, reaches the driver; so dims, not
rows, bound what it holds. No row is shuffled.

The leading eigenvalues are found by slicing the spectrum: the inertia of ``V - s I`` (signs of the
pivots of a symmetric factorisation) counts the eigenvalues beyond ``s``, and intervals are halved
until each holds a few. In an interval, the projector onto its eigenvectors is the integral of
``(z I - V)^-1`` around a circle through its ends; a quadrature of it, one complex solve per node,
filters a random block, and Rayleigh-Ritz extracts the pairs (FEAST). That is repeated until
residuals vanish and the pairs inside are as many as the inertia says; otherwise with a larger
block, in the end of all dimensions, so none is missed.

An entry ``c`` counts as ``floor(scale * c) + shift``, a whole number, so that sums and squared
deviations are exact.

Defined results: rows whose vector is null, or holds a null, non-finite or (scaled) more than
64-bit entry, are left out, as are vectors of another length than the most frequent one (of equally
frequent ones the greatest; empty vectors never count). Directions without variance have no
component, so fewer than ``components`` may come out, and none for a single vector or equal ones.
Repeated rows and null ids are rows of their own; an empty table gives an empty result; other
columns do not take part. Eigenvalues that are equal leave their components open, up to rotation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
_NODES = 8  # in the upper half plane
_PER_SLICE = 4
_TINY = float(np.finfo(float).eps)
_PIVOT = (1 + 17**0.5) / 8


# Eigenpairs of a symmetric matrix


def count_below(v: np.ndarray, at: float) -> int:
    """Number of eigenvalues below ``at``: by Sylvester's law, the negative pivots of a symmetric
    factorisation of ``v - at * I``, with complete pivoting in blocks of one or two."""
    a, n, below = v - at * np.eye(len(v)), len(v), 0
    while n:
        a = a[:n, :n]
        diagonal = np.abs(np.diagonal(a))
        i = int(diagonal.argmax())
        beside = np.abs(a - np.diag(np.diagonal(a)))
        r, s = divmod(int(beside.argmax()), n)
        if diagonal[i] == 0 and beside[r, s] == 0:
            break
        pivots = [i] if diagonal[i] >= _PIVOT * beside[r, s] else [r, s]
        order = [k for k in range(n) if k not in pivots] + pivots
        a, n = a[np.ix_(order, order)], n - len(pivots)
        block, border = a[n:, n:], a[:n, n:]
        below += int(block[0, 0] < 0) if len(pivots) == 1 else 1  # a block of two has one of each sign
        a[:n, :n] -= border @ np.linalg.solve(block, border.T)
    return below


def slices(v: np.ndarray, most: int, floor: float) -> list[tuple[float, float, int]]:
    """Intervals above ``floor`` that hold the ``most`` greatest eigenvalues, and how many each has."""
    d, top = len(v), float(np.abs(v).sum(1).max()) * (1 + 1e-9)
    out, open_ = [], [(floor, top, d - count_below(v, floor), 0)]
    while open_:
        low, high, above_low, above_high = open_.pop()
        n = above_low - above_high
        if n == 0 or above_high >= most:
            continue
        if n <= _PER_SLICE or high - low <= 64 * _TINY * top:
            out.append((low, high, n))
            continue
        middle = low + (high - low) * 0.5003  # round numbers are likelier to be eigenvalues
        above = d - count_below(v, middle)
        open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return out


def _filtered(v: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """The block after the quadrature of the resolvent's contour integral around [low, high]."""
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for k in range(_NODES):
        turn = np.exp(1j * np.pi * (k + 0.5) / _NODES)
        # The nodes below the real axis give the conjugate: twice the real part.
        out += (radius * turn * np.linalg.solve((centre + radius * turn) * np.eye(len(v)) - v, block)).real / _NODES
    return out


def _ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``v`` within the block's span."""
    q = np.linalg.qr(block)[0]
    values, vectors = np.linalg.eigh(q.T @ v @ q)
    return values, q @ vectors


def interval_pairs(v: np.ndarray, low: float, high: float, count: int, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs in an interval."""
    d, size, random = len(v), 2 * count + 8, np.random.default_rng(7)
    bound = 1e-14 * len(v) ** 0.5 * np.linalg.norm(v)
    while True:
        size = min(size, d)
        block = random.standard_normal((d, size))
        for _ in range(rounds):
            # A block of all dimensions spans every eigenvector as it is.
            values, vectors = _ritz(v, block if size == d else _filtered(v, low, high, block))
            inside = (values > low) & (values <= high)
            rest = np.linalg.norm(v @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0)
            if (inside.sum() == count and rest.max(initial=0) <= bound) or size == d:
                break
            block = vectors
        if inside.sum() == count and (rest.max(initial=0) <= bound or size == d):
            return values[inside], vectors[:, inside]
        if size == d:
            # An eigenvalue on the very end of the interval: the nearest ones are meant.
            near = np.sort(np.argsort(np.maximum(low - values, values - high), kind="stable")[:count])
            return values[near], vectors[:, near]
        size *= 2


def leading_pairs(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest eigenvalues that are not zero (up to rounding), falling, and their unit
    eigenvectors as columns, the largest entry of each positive."""
    floor = 16 * len(v) * _TINY * float(np.abs(v).sum(1).max(initial=0))
    found = [interval_pairs(v, *s) for s in slices(v, most, floor)] if floor > 0 else []
    if not found:
        return np.zeros(0), np.zeros((len(v), 0))
    # Once more over all of them: vectors from neighbouring intervals become orthogonal.
    values, vectors = _ritz(v, np.concatenate([x for _, x in found], 1))
    by = np.argsort(-values)[:most]
    values, vectors = values[by], vectors[:, by]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(by))])
    return values, vectors * sign


# Passes over the vectors


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``n`` vectors, the sum of each dimension, components as columns (already
    divided by the root of their eigenvalue), share of variance of each, and the largest entry of
    the whitened values' covariance minus the identity."""

    n: int
    sums: tuple[int, ...]
    projection: np.ndarray
    explained: np.ndarray
    identity_error: float
    scale: int = SCALE
    shift: int = SHIFT


def _entries(vectors: pa.Array, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose vectors count, their lengths, and all their entries as whole numbers."""
    lengths = np.where(vectors.is_null().to_numpy(zero_copy_only=False), 0, vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null is NaN
    with np.errstate(over="ignore", invalid="ignore"):
        steps = np.floor(flat * scale)
        bad = ~(np.abs(steps) <= 2.0**63 - 2.0**20)
    row = np.repeat(np.arange(len(lengths)), lengths)
    good = (np.bincount(row, bad, len(lengths)) == 0) & (lengths > 0)
    return np.flatnonzero(good), lengths[good].astype(np.int64), steps[good[row]].astype(np.int64) + shift


def _matrix(vectors: pa.Array, dims: int, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose vectors count and have this length, and their entries."""
    rows, lengths, x = _entries(vectors, scale, shift)
    same = lengths == dims
    return rows[same], x[np.repeat(same, lengths)].reshape(-1, dims)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n * x - sums``, exactly."""
    most = int(np.abs(x).max(initial=0)) + 1
    if n * most + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _squares(t: np.ndarray) -> pa.Array:
    """Sum of squares of each row, exactly."""
    most = int(np.abs(t).max(initial=0))
    exact = pa.decimal128(38, 0)
    if t.dtype != object and most * most * t.shape[1] < 1 << 62:
        return pa.array(np.einsum("ij,ij->i", t, t)).cast(exact)
    t = t.astype(object)
    totals = (t * t).sum(1)
    # Whole numbers beyond 38 digits have no place in a decimal.
    return pa.array([int(v) if v < 10**38 else None for v in totals], exact)


def _gathered(df: DataFrame, vector_col: str, gather: Callable[[pa.Array, dict], None], into: Callable[[dict], Iterator[tuple]], schema: str) -> DataFrame:
    """One small table per task: ``gather`` adds up each batch, ``into`` gives the rows."""
    names = [f.split()[0] for f in schema.split(", ")]
    types = {"long": pa.int64(), "double": pa.float64(), "decimal(38,0)": pa.decimal128(38, 0)}
    arrow = [types[f.split()[1]] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            gather(batch.column(0), totals)
        rows = list(into(totals))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)], names)

    return df.select(vector_col).mapInArrow(run, schema)


def _sums(df: DataFrame, vector_col: str, scale: int, shift: int) -> tuple[int, tuple[int, ...]]:
    """Number of vectors of the most frequent length, and their sum in each dimension."""

    def gather(vectors: pa.Array, totals: dict) -> None:
        _, lengths, x = _entries(vectors, scale, shift)
        for dims in np.unique(lengths).tolist():
            some = x[np.repeat(lengths == dims, lengths)].reshape(-1, dims)
            # In halves, so that no sum of a batch is beyond 64 bits.
            high, low = (some >> 32).sum(0).tolist(), (some & 0xFFFFFFFF).sum(0).tolist()
            n, sums = totals.get(dims, (0, [0] * dims))
            totals[dims] = n + len(some), [s + (h << 32) + w for s, h, w in zip(sums, high, low, strict=True)]

    def into(totals: dict) -> Iterator[tuple]:
        return ((dims, k, n, s) for dims, (n, sums) in totals.items() for k, s in enumerate(sums))

    parts = _gathered(df, vector_col, gather, into, "dims long, place long, n long, total decimal(38,0)")
    added = parts.groupBy("dims", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    most = added.where("place = 0").orderBy(F.desc("n"), F.desc("dims")).limit(1)
    rows = added.join(F.broadcast(most.select("dims")), "dims").orderBy("place").collect()  # dims rows
    return (rows[0]["n"], tuple(int(r["total"]) for r in rows)) if rows else (0, ())


def _products(df: DataFrame, vector_col: str, made: Callable[[pa.Array], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of the outer products of ``made`` with itself."""
    upper = np.triu_indices(size)

    def gather(vectors: pa.Array, totals: dict) -> None:
        rows = made(vectors)
        totals["sum"] = totals.get("sum", 0) + rows.T @ rows

    def into(totals: dict) -> Iterator[tuple]:
        if totals:
            yield from zip(upper[0].tolist(), upper[1].tolist(), totals["sum"][upper].tolist(), strict=True)

    parts = _gathered(df, vector_col, gather, into, "i long, j long, part double")
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("part").alias("part")).collect():  # size * (size + 1) / 2 rows
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["part"]
    return out


def fit(df: DataFrame, vector_col: str = "embedding", components: int = 8, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Fit to all vectors; None if there are none."""
    n, sums = _sums(df, vector_col, scale, shift)
    if not n:
        return None
    dims = len(sums)

    def centred(vectors: pa.Array) -> np.ndarray:
        return (_deviations(_matrix(vectors, dims, scale, shift)[1], n, sums) / n).astype(float)

    v = _products(df, vector_col, centred, dims) / n
    values, vectors = leading_pairs(v, components)
    projection = vectors / np.sqrt(values)

    def whitened(vectors: pa.Array) -> np.ndarray:
        rows = centred(vectors) @ projection
        return np.concatenate([rows, np.ones((len(rows), 1))], 1)  # the last: to get means

    k = len(values)
    error = 0.0
    if k:
        products = _products(df, vector_col, whitened, k + 1) / n
        error = float(np.abs(products[:k, :k] - np.outer(products[k, :k], products[k, :k]) - np.eye(k)).max())
    return Whitening(n, sums, projection, values / np.trace(v) if k else values, error, scale, shift)


_OUT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(df: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and component: its id, ``component`` (from 1 on), ``n``, ``deviation``
    (exact sum of squares of ``n * x - sum``; null beyond 38 digits), ``whitened``, ``explained``,
    ``identity_error``."""
    id_type = df.schema[id_col].dataType.simpleString()
    chosen = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.projection.shape[1] if model else 0
        for batch in batches if k else ():
            at, x = _matrix(batch["vector"], len(model.sums), model.scale, model.shift)
            t = _deviations(x, model.n, model.sums)
            values = (t / model.n).astype(float) @ model.projection
            many = pa.array(np.repeat(np.arange(len(at)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(pa.array(at)).take(many),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(many), model.n)),
                    _squares(t).take(many),
                    pa.array(values.ravel()),
                    pa.array(np.tile(model.explained, len(at))),
                    pa.array(np.full(len(many), model.identity_error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return chosen.mapInArrow(rows, f"id {id_type}, {_OUT}").withColumnRenamed("id", id_col)
