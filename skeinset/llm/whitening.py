"""Whitening of vectors by the leading eigenvectors of their covariance, by Chebyshev-filtered subspace iteration.

The covariance matrix ``V`` is never formed. A pass over the centred rows ``X`` gives ``V Q = X'XQ/n`` for a
block ``Q`` of a few columns: a task adds up its rows' part, one row of ``d * m`` numbers. Two passes estimate the
ends of the spectrum. Then a Chebyshev polynomial of ``V``, by its three-term recurrence with one pass a degree,
keeps the unwanted interval small and lets what lies above it grow; QR and Rayleigh-Ritz turn the block into
estimates. This goes on until the residual of each wanted pair proves its vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinset.llm.common import bounded_batches, hold, keep, release

GUARD = 16  # columns of the block beyond those that are wanted
DEGREE = 8
CYCLES = 200
ANGLE = 1e-12
STRIP = 1 << 12
_LONG = 1 << 63


def quantised(vector: str, scale: float = 256.0):
    """The vector's entries as longs ``floor(scale * c)``, little-endian bytes. Null for a null or empty vector
    and for one with an entry that is null or not finite; an error for an entry beyond a long."""

    @F.arrow_udf("binary")
    def long_bytes(vectors: pa.Array) -> pa.Array:
        hold("whitening", int)
        size = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        c = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
        ends = np.cumsum(size)
        good = np.isfinite(c)
        x = np.floor(scale * np.where(good, c, 0.0))
        if len(x) and np.abs(x).max() >= float(_LONG):
            raise ValueError("an entry is beyond a long")
        wrong = np.concatenate([[0], np.cumsum(~good)])
        whole = (size > 0) & (wrong[ends] == wrong[ends - size])
        raw = x.astype("<i8").tobytes()
        return pa.array([raw[8 * (b - s) : 8 * b] if w else None for b, s, w in zip(ends.tolist(), size.tolist(), whole)], pa.binary())

    return long_bytes(F.col(vector).cast("array<double>"))


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows as one row each, in the narrowest integers that hold them."""
    for batch in batches:
        if batch.num_rows:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8")
            width = next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= x.min() and x.max() <= np.iinfo(t).max)
            yield pa.RecordBatch.from_pydict({"kind": [width], "data": [x.astype(width).tobytes()]})


def _strips(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist()):
        x = np.frombuffer(data, kind).reshape(-1, d)
        for i in range(0, len(x), STRIP):
            yield x[i : i + STRIP]


def _summed(blocks: DataFrame, d: int, size: int, of_rows: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of what ``of_rows`` gives for a strip of them, ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, met = np.zeros(size), False
        for batch in batches:
            for x in _strips(batch, d):
                total += of_rows(x.astype(float)).ravel()
                met = True
        if met:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["part"])

    parts = blocks.mapInArrow(run, "part array<double>").select(F.posexplode("part").alias("pos", "part"))
    rows = parts.groupBy("pos").agg(F.sum("part").alias("total")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["pos"]] = r["total"]
    return out


@dataclass
class Whitening:
    """``values`` and the columns of ``vectors`` are the leading eigenpairs; ``residuals`` bound their errors."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residuals: np.ndarray
    identity_error: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def usable(self) -> np.ndarray:
        """Which components have a variance that is more than rounding."""
        return self.values > 1e-13 * max(float(self.values.max(initial=0.0)), 0.0) * len(self.sums)


def _counted(blocks: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows, and exact sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, high, low = 0, [0] * d, [0] * d
        for batch in batches:
            for x in _strips(batch, d):
                x = x.astype(np.int64)
                rows += len(x)
                high = [t + int(v) for t, v in zip(high, (x >> 32).sum(axis=0))]
                low = [t + int(v) for t, v in zip(low, (x & 0xFFFFFFFF).sum(axis=0))]
        if rows:
            sums = [str((h << 32) + v) for h, v in zip(high, low)]
            yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64()), "sums": [sums]})

    parts = blocks.mapInArrow(run, "rows bigint, sums array<string>").select("rows", F.posexplode("sums").alias("pos", "part"))
    got = parts.groupBy("pos").agg(F.sum("rows").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    sums = {r["pos"]: int(r["total"]) for r in got}
    return got[0]["n"], [sums[i] for i in range(d)]


def leading_pairs(
    apply: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, guard: int = GUARD, degree: int = DEGREE, seed: int = 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, vectors and residuals of the ``wanted`` leading eigenpairs of a symmetric matrix without negative
    values, of which only ``apply(Q) = V Q`` is known.

    Done when each residual is within ``ANGLE`` of the distance to the next value, so that the vector is
    right to that angle, or as small as rounding lets it be. An error if it is not after ``CYCLES`` filters.
    """
    m = min(d, wanted + guard)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, m)))
    vq = apply(q)
    low = 0.0
    if m < d:  # a second block widens the basis, and shows both ends of the spectrum
        more = vq - q @ (q.T @ vq)
        more, _ = np.linalg.qr(more - q @ (q.T @ more))
        more = more[:, : d - m]
        q, vq = np.hstack([q, more]), np.hstack([vq, apply(more)])
    floor_of = 1e-14 * np.sqrt(d)
    for cycle in range(CYCLES):
        theta, u = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        theta, u = theta[::-1], u[:, ::-1]
        x, vx = q @ u, vq @ u
        residuals = np.linalg.norm(vx - x * theta, axis=0)
        apart = np.abs(theta[:, None] - theta[None, :]) + np.where(np.eye(len(theta)), np.inf, 0)
        top = max(float(theta[0]), 0.0)
        enough = np.maximum(ANGLE * apart.min(axis=1), floor_of * top)[:wanted]
        if m == d or (residuals[:wanted] <= enough).all():
            return theta[:wanted], x[:, :wanted], residuals[:wanted]
        if cycle == 0:
            low = max(0.0, float(theta[-1] - residuals[-1]))
            cut = float(theta[m]) if len(theta) > m else float(theta[-1])
            x, vx = x[:, :m], vx[:, :m]
        else:
            cut = float(theta[-1])
        half, middle = max((cut - low) / 2, 1e-12 * top), (cut + low) / 2
        first = rate = half / (max(top, cut + 1e-12 * top) - middle)
        before, now = x, (vx - middle * x) * (first / half)
        for _ in range(degree - 1):
            after = 1 / (2 / first - rate)
            before, now = now, 2 * (apply(now) - middle * now) * (after / half) - rate * after * before
            rate = after
        q, _ = np.linalg.qr(now)
        vq = apply(q)
    raise RuntimeError(f"eigenvectors not certified after {CYCLES} filters: residuals {residuals[:wanted]}")


def fit(rows: DataFrame, components: int = 4, guard: int = GUARD, degree: int = DEGREE) -> Whitening | None:
    """A whitening from the distinct vectors of ``rows``, whose column ``x`` holds them as ``quantised`` gives them.

    None if there are none; an error if they differ in length.
    """
    sizes = rows.agg(F.min(F.octet_length("x")).alias("low"), F.max(F.octet_length("x")).alias("high")).head()
    if sizes["low"] is None:
        return None
    if sizes["low"] != sizes["high"]:
        raise ValueError("vectors differ in their number of entries")
    d = sizes["low"] // 8
    distinct = rows.filter("x is not null").select("x").distinct()
    blocks = keep(distinct.mapInArrow(_blocked, "kind string, data binary"), "vectors")
    n, sums = _counted(blocks, d)
    mean = np.array([s / n for s in sums])
    passes = 0

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def product(x: np.ndarray) -> np.ndarray:
            x -= mean
            return x.T @ (x @ q)

        return _summed(blocks, d, q.size, product).reshape(q.shape) / n

    def squares(x: np.ndarray) -> np.ndarray:
        return ((x - mean) ** 2).sum(keepdims=True)

    trace = float(_summed(blocks, d, 1, squares)[0]) / n
    wanted = min(components, d)
    values, vectors, residuals = leading_pairs(apply, d, wanted, guard, degree)
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)] < 0, -1.0, 1.0)
    found = Whitening(n, sums, np.maximum(values, 0.0), vectors, trace, residuals, 0.0, passes)
    use = found.usable
    k = int(use.sum())
    if k:
        across = vectors[:, use] / np.sqrt(values[use])

        def moments(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ across
            return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

        got = _summed(blocks, d, k + k * k, moments) / n
        covariance = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
        found.identity_error = float(np.abs(covariance - np.eye(k)).max())
    release(blocks)
    return found


_OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(
    df: DataFrame, id_cols: Sequence[str], vector: str, components: int = 4, scale: float = 256.0, guard: int = GUARD
) -> DataFrame:
    """``id_cols, component, n, deviation, whitened, explained, identity_error`` for each row with a whole vector
    and each of the leading ``components`` (as many as there are dimensions, if those are fewer).

    Rows whose vector is null, empty, or holds a null or an entry that is not finite are dropped; ids may be null
    or repeat. Equal vectors count once in the fit. A component without variance (all rows equal, too few of
    them) has ``whitened`` null, ``explained`` 0 if there is no variance at all, and no part in ``identity_error``.
    A ``deviation`` beyond a long is an error. No rows give none.
    """
    rows = keep(bounded_batches(df).select(*id_cols, quantised(vector, scale).alias("x")), "rows").filter("x is not null")
    found = fit(rows, components, guard)
    ids = [f"`{c}`" for c in id_cols]
    if found is None:
        return rows.limit(0).selectExpr(*ids, *[f"cast(null as {t}) as {n}" for n, t in (c.split() for c in _OUT.split(", "))])
    n, sums, mean, d, use = found.n, found.sums, found.mean, len(found.sums), found.usable
    across = found.vectors / np.sqrt(np.where(use, found.values, 1.0))
    longest = max(map(abs, sums))

    @F.arrow_udf("struct<deviation: bigint, whitened: array<double>>")
    def projected(vectors: pa.Array) -> pa.Array:
        x = np.frombuffer(b"".join(vectors.to_pylist()), "<i8").reshape(-1, d)
        most = n * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))) + longest
        if most * most * d < _LONG:
            gap = n * x - np.array(sums, dtype=np.int64)
            deviation = (gap * gap).sum(axis=1).tolist()
        else:
            deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
        whitened = [[v if u else None for v, u in zip(row, use)] for row in ((x - mean) @ across).tolist()]
        out = [pa.array(deviation, pa.int64()), pa.array(whitened, pa.list_(pa.float64()))]
        return pa.StructArray.from_arrays(out, names=["deviation", "whitened"])

    explained = F.array(*[F.lit(float(v / found.trace) if found.trace > 0 else 0.0) for v in found.values])
    made = rows.select(*id_cols, projected("x").alias("__p"))
    listed = made.select(*id_cols, F.col("__p.deviation").alias("deviation"), F.posexplode("__p.whitened").alias("__at", "whitened"))
    return listed.select(
        *id_cols,
        (F.col("__at") + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, (F.col("__at") + 1).cast("int")).alias("explained"),
        F.lit(found.identity_error).alias("identity_error"),
    )
