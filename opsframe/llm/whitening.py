"""Whitening of embeddings by a refined eigendecomposition of their covariance.

Entries are quantised to integers ``x = floor(64 c) + 1000000``. Every task
sums the count, the sums and the Gram matrix of its rows in exact integers
(shifted by the constant, which no centred figure sees); partial sums are added
in a tree of DataFrame stages, ``FAN_IN`` rows a task, until one row of size
``d x d`` reaches the driver. The covariance ``V = (n G - S S^T) / n^2`` is
thereby exact.

Method: mixed-precision refinement. Eigenvectors of ``V`` come from a float32
solver; Ogita-Aishima iterations correct them with matrix products in extended
precision (``numpy.longdouble``): ``R = I - X^T X``, ``T = X^T A X``,
``l_i = t_ii / (1 - r_ii)``, ``E_ij = (t_ij + l_j r_ij) / (l_j - l_i)`` for
separated pairs and ``r_ij / 2`` inside a cluster, ``X <- X + X E``. Eigenvalues
closer than the iteration's bound form clusters; each cluster is solved apart
on its projected matrix ``X_c^T A X_c`` and rotated, and the next iteration
refines the result.

Rows are whitened in Arrow batches inside tasks: ``(x - S/n) w_k / sqrt(e_k)``.
The identity error is measured on the whitened rows themselves, by the same
partial sums.

Defined results: a row whose vector is null or holds a null, NaN or infinite
entry is dropped; vectors of unequal length fail the query; components are
those with an eigenvalue above ``RANK_TOLERANCE`` times the trace, at most
``COMPONENTS`` (none for fewer than two distinct vectors, hence no rows);
repeated rows count as often as they occur and tied eigenvalues get any
orthonormal basis of their space; an empty table gives no rows; other columns
are not read, so their names cannot clash. ``deviation`` is exact while it
fits a long (the query fails otherwise).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import stored

# Fixed values of the contract.
SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
# Partial sums added by one task of the tree.
FAN_IN = 64
# Eigenvalues at most this share of the trace are taken as zero.
RANK_TOLERANCE = 1e-12
ITERATIONS = 6

SUMS = "n long, s array<long>, g array<long>"
FLOAT_SUMS = "n long, s array<double>, g array<double>"
WIDE = "vec_id long, deviation long, whitened array<double>"


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a 2-d array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if rows == 0:
        return np.zeros((0, 0))
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths != lengths[0]).any():
        raise ValueError("vectors of unequal length")
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(rows, int(lengths[0]))


def quantised(c: np.ndarray) -> np.ndarray:
    """``floor(64 c)`` as integers; the offset is added where it shows."""
    return np.floor(SCALE * c.astype(np.float64)).astype(np.int64)


def _sums_of(batches, field: str, exact: bool):
    kind = np.int64 if exact else np.float64
    n, s, g = 0, None, None
    for batch in batches:
        y = _matrix(batch.column(field))
        if not len(y):
            continue
        y = quantised(y) if exact else y.astype(np.float64)
        if s is None:
            s = np.zeros(y.shape[1], kind)
            g = np.zeros((y.shape[1], y.shape[1]), kind)
        n += len(y)
        s += y.sum(axis=0)
        g += y.T @ y
    if n:
        yield pa.RecordBatch.from_pydict(
            {"n": [n], "s": [s.tolist()], "g": [g.ravel().tolist()]}
        )


def _added(batches, exact: bool):
    n, s, g = 0, None, None
    for batch in batches:
        for row in batch.to_pylist():
            kind = object if exact else np.float64
            rs, rg = np.array(row["s"], kind), np.array(row["g"], kind)
            n += row["n"]
            s = rs if s is None else s + rs
            g = rg if g is None else g + rg
    if n:
        yield pa.RecordBatch.from_pydict(
            {"n": [n], "s": [[int(v) if exact else v for v in s]],
             "g": [[int(v) if exact else v for v in g]]}
        )


def total(rows: DataFrame, field: str, exact: bool):
    """Count, sums and Gram matrix of an array column, added in a tree.

    Returns ``(n, s, g)`` as Python integers (``exact``) or floats, or
    ``None`` for no rows.
    """
    schema = SUMS if exact else FLOAT_SUMS
    parts = rows.select(field).mapInArrow(
        lambda it: _sums_of(it, field, exact), schema
    )
    width = parts.rdd.getNumPartitions()
    while width > 1:
        width = math.ceil(width / FAN_IN)
        parts = parts.repartition(width).mapInArrow(
            lambda it: _added(it, exact), schema
        )
    row = parts.first()
    if row is None:
        return None
    d = len(row["s"])
    kind = object if exact else np.float64
    g = np.array(row["g"], kind).reshape(d, d)
    return row["n"], np.array(row["s"], kind), g


def _norm(m: np.ndarray) -> np.longdouble:
    """Frobenius norm, a bound on the spectral norm."""
    return np.sqrt((m * m).sum())


def refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of symmetric ``a`` from approximate
    eigenvectors ``x``, by Ogita-Aishima iterations in extended precision
    with sub-solves of clustered eigenvalues."""
    a = a.astype(np.longdouble)
    x = x.astype(np.longdouble)
    eye = np.eye(len(a), dtype=np.longdouble)
    size = _norm(a)
    lam = np.diag(x.T @ a @ x)
    for _ in range(ITERATIONS):
        r = eye - x.T @ x
        t = x.T @ a @ x
        t = (t + t.T) / 2
        lam = np.diag(t) / (1 - np.diag(r))
        bound = 2 * (_norm(t - np.diag(lam)) + size * _norm(r))
        gap = lam[None, :] - lam[:, None]
        apart = np.abs(gap) > bound
        e = np.where(
            apart,
            (t + lam[None, :] * r) / np.where(apart, gap, 1),
            r / 2,
        )
        x = x + x @ e
        for cluster in _clusters(lam, bound):
            sub = x[:, cluster]
            small = sub.T @ a @ sub
            # Shifted by the cluster's mean in extended precision, so that a
            # double solver sees the spread inside the cluster at full
            # relative precision.
            shift = np.trace(small) / len(cluster)
            small = small - shift * np.eye(len(cluster), dtype=np.longdouble)
            small = ((small + small.T) / 2).astype(np.float64)
            _, rot = np.linalg.eigh(small)
            x[:, cluster] = sub @ rot.astype(np.longdouble)
        if np.abs(e[apart]).max(initial=0) < 1e-30:
            break
    lam = np.diag(x.T @ a @ x) / np.diag(x.T @ x)
    x = x / np.sqrt((x * x).sum(axis=0))
    order = np.argsort(-lam.astype(np.float64), kind="stable")
    return lam[order], x[:, order]


def _clusters(lam: np.ndarray, bound) -> list[list[int]]:
    """Groups of indices of eigenvalues within ``bound`` of a neighbour."""
    order = np.argsort(lam.astype(np.float64))
    groups, current = [], [int(order[0])]
    for prev, nxt in zip(order, order[1:]):
        if abs(lam[nxt] - lam[prev]) <= bound:
            current.append(int(nxt))
        else:
            groups.append(current)
            current = [int(nxt)]
    groups.append(current)
    return [sorted(g) for g in groups if len(g) > 1]


def components(n: int, s: np.ndarray, g: np.ndarray, most: int | None = None):
    """Eigenvalues, unit eigenvectors and trace of the exact covariance,
    from integer sums; the leading components only."""
    scaled = n * g - np.outer(s, s)  # n^2 V, exact integers
    a = np.array(scaled.tolist(), dtype=np.longdouble)
    top = float(np.abs(a).max()) or 1.0
    _, start = np.linalg.eigh((a / top).astype(np.float32))
    lam, vec = refined(a, start.astype(np.float64))
    lam = lam / (np.longdouble(n) * n)
    trace = np.longdouble(sum(scaled[i, i] for i in range(len(a)))) / (
        np.longdouble(n) * n
    )
    keep = [i for i in range(len(lam)) if lam[i] > RANK_TOLERANCE * trace]
    keep = keep[: COMPONENTS if most is None else most]
    return lam[keep], vec[:, keep], trace


def _whitened(batches, n: int, s: np.ndarray, w: np.ndarray):
    mean = s.astype(np.float64) / n
    si = s.astype(np.int64)
    for batch in batches:
        y = _matrix(batch.column("embedding"))
        if not len(y):
            continue
        y = quantised(y)
        dev = n * y - si
        if int(np.abs(dev).max()) ** 2 * y.shape[1] < 2**62:
            deviation = (dev * dev).sum(axis=1).tolist()
        else:
            deviation = [sum(int(v) ** 2 for v in r) for r in dev]
        out = (y - mean) @ w
        yield pa.RecordBatch.from_pydict(
            {
                "vec_id": batch.column("vec_id"),
                "deviation": pa.array(deviation, pa.int64()),
                "whitened": [list(r) for r in out],
            }
        )


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding"):
    """Whitened coordinates of every clean row on the leading components.

    Returns ``vec_id, component, n, deviation, whitened, explained,
    identity_error``.
    """
    spark = vectors.sparkSession
    inf = float("inf")
    clean = vectors.select(
        F.col(key).alias("vec_id"), F.col(column).alias("embedding")
    ).where(
        F.col("embedding").isNotNull()
        & F.forall(
            "embedding",
            lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != inf),
        )
    )
    clean = stored(clean, "whiten-input")
    found = total(clean, "embedding", exact=True)
    empty = spark.createDataFrame(
        [],
        "vec_id long, component int, n long, deviation long, whitened double,"
        " explained double, identity_error double",
    )
    if found is None:
        return empty
    n, s, g = found
    lam, vec, trace = components(n, s, g)
    if not len(lam):
        return empty
    w = (vec / np.sqrt(lam)[None, :]).astype(np.float64)
    wide = stored(
        clean.mapInArrow(lambda it: _whitened(it, n, s, w), WIDE), "whitened"
    )
    m, ws, wg = total(wide, "whitened", exact=False)
    cov = (wg - np.outer(ws, ws) / m) / m
    error = float(np.abs(cov - np.eye(len(cov))).max())
    explained = F.array(*[F.lit(float(v / trace)) for v in lam])
    return wide.select(
        "vec_id",
        "deviation",
        F.posexplode("whitened").alias("at", "whitened"),
    ).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
