"""Embedding whitening by a weighted multiplicity covariance.

Vectors are quantised to integers, x = floor(scale * c). Equal x vectors are grouped
(partial counts before the shuffle, so a vector that a third of all rows share is one
row of each task); a group weighs one in the fit, or its count. Sums are exact
integers; the covariance is a weighted GEMM of centred blocks, one partial d x d
matrix a task. Only d sums and one d x d matrix reach the driver, whatever the number
of rows. Each distinct vector is whitened once and joined back to its rows; the join
stands on both shuffles, so Spark splits the partition of a hot vector.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries
are dropped; of the rest only vectors of the most frequent length take part (ties: the
longer); a null id stays a null id; repeated rows each get their result; columns other
than the two named are not looked at; no row, or no variance at all, gives an empty
result; directions without variance (below 1e-12 of the trace) are no components, so
there may be fewer than asked for; equal eigenvalues leave their directions open, any
orthonormal pair of them is right; signs make the entry of largest size positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import keyed_join, stored

SCALE, COMPONENTS = 256, 4
BLOCK = 8192  # vectors multiplied at once

KIND = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def usable(vector: str) -> Column:
    """A vector with at least one entry, all of them finite numbers."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def matrix(col: pa.Array, kind=np.float64) -> np.ndarray:
    """List column of equal lengths as a matrix (one row for each list)."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("weight").to_numpy(zero_copy_only=False)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact weighted sum of every dimension, one set of rows a task."""
    total, count = None, 0
    for batch in batches:
        if batch.num_rows:
            w = _weights(batch).astype(np.int64)
            part = (matrix(batch.column("x"), np.int64) * w[:, None]).sum(axis=0)
            total, count = part if total is None else total + part, count + int(w.sum())
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total), pa.array(np.full(len(total), count))], ["i", "s", "n"])


def _products(mean: np.ndarray):
    """Partial weighted products of centred vectors, one d x d matrix a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), len(mean)))
        seen = False
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                centred = matrix(part.column("x")) - mean
                total += centred.T @ (centred * _weights(part)[:, None])
                seen = True
        if seen:
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(mean) + 1) * len(mean), pa.int32()), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(mean))), rows], ["i", "row"])

    return run


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n * x - S) ** 2, exact; beyond 64 bits in Python integers."""
    spread = max(int(np.abs(x).max(initial=0)), 1) * n + max(map(abs, sums), default=0)
    if spread * spread * len(sums) < 1 << 63:
        return pa.array(((n * x - np.asarray(sums, np.int64)) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
    return pa.array([sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()], pa.decimal128(38, 0))


def _project(mean: np.ndarray, axes: np.ndarray, n: int, sums: list[int]):
    """Whitened coordinates and deviation of each distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                white = (matrix(part.column("x")) - mean) @ axes
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(white) + 1) * axes.shape[1], pa.int32()), pa.array(white.ravel()))
                arrays = [part.column("h"), part.column("x"), part.column("weight"), lists, _deviation(matrix(part.column("x"), np.int64), n, sums)]
                yield pa.RecordBatch.from_arrays(arrays, ["h", "x", "weight", "white", "deviation"])

    return run


def principal(cov: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns) with variance, at most ``most``."""
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    keep = [i for i in np.argsort(-values, kind="stable")[:most] if values[i] > 1e-12 * max(np.trace(cov), 0)]
    axes = vectors[:, keep]
    big = np.abs(axes).argmax(axis=0) if axes.size else []
    return values[keep], axes * np.where(axes[big, range(len(keep))] < 0, -1.0, 1.0)


def whiten(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, weigh_copies: bool = False
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row.

    ``weigh_copies`` fits on all rows (each distinct vector weighs its count); by
    default each distinct vector weighs one.
    """
    spark = rows.sparkSession
    plain = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(usable("v"))
    x = F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    plain = plain.select("vec_id", x.alias("x")).withColumn("h", F.xxhash64("x"))
    groups = stored(plain.groupBy("h", "x").agg(F.count(F.lit(1)).alias("copies")), "whiten-distinct")
    lengths = groups.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    none = spark.createDataFrame([], KIND)
    if not lengths:
        return none
    dims = lengths[0]["d"]
    groups = groups.where(F.size("x") == dims).select("h", "x", (F.col("copies") if weigh_copies else F.lit(1).cast("long")).alias("weight"))
    # one row for each dimension
    got = groups.select("x", "weight").mapInArrow(_sums, "i long, s long, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("i").collect()
    n, sums = int(got[0]["n"]), [int(r["s"]) for r in got]
    mean = np.array([s / n for s in sums])
    parts = groups.select("x", "weight").mapInArrow(_products(mean), "i long, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    cov = np.zeros((dims, dims))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # dims x dims numbers
        cov[r["i"], r["j"]] = r["v"] / n
    values, axes = principal(cov, components)
    if not len(values):
        return none
    table = stored(
        groups.mapInArrow(_project(mean, axes / np.sqrt(values), n, sums), "h long, x array<long>, weight long, white array<double>, deviation decimal(38,0)"),
        "whiten-whitened",
    )
    explained = F.array(*[F.lit(float(e / np.trace(cov))) for e in values])
    out = keyed_join(plain, table.select("h", "x", "white", "deviation"), ["h", "x"])
    out = out.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(_identity_error(table, len(values))).alias("identity_error"),
    )


def _identity_error(table: DataFrame, k: int) -> float:
    """Largest entry of the whitened vectors' weighted covariance minus the identity (k x k numbers reach the driver)."""
    w = F.col("weight").cast("double")
    white = [F.col("white")[i] for i in range(k)]
    means = [F.sum(w * c) / F.sum(w) for c in white]
    pairs = [F.sum(w * white[i] * white[j]) / F.sum(w) - means[i] * means[j] for i in range(k) for j in range(k)]
    got = np.array(table.agg(*[p.alias(f"p{i}") for i, p in enumerate(pairs)]).first(), dtype=float).reshape(k, k)
    return float(np.abs(got - np.eye(k)).max())
