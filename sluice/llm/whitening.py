"""Whitening of embeddings by shifted CholeskyQR.

Each entry ``c`` becomes the integer ``floor(scale * c) + shift``. The rows,
centred, are a tall matrix ``X``. A Gram pass sums ``Q'Q`` over all rows (a
partial sum for each task, added up by entry in Spark), the driver takes its
Cholesky factor, and the next pass reads ``Q`` anew as ``X`` through the
triangular solves of the factors so far. The first factor is that of the Gram
matrix plus a small shift, which keeps it positive for nearly dependent
columns; passes go on until ``Q'Q`` is the identity. The product ``R`` of the
factors (``X = QR``) has the singular values of ``X``, and its singular value
decomposition gives components and variances without ever squaring the
condition of ``X``.

Rows are centred exactly: ``(n * x - S) / n`` with integers ``n * x - S``.
The driver and the closures hold the column sums and ``d * d`` numbers only
(``d`` entries a vector).

Defined cases: a row whose vector is null, holds null or non-finite entries (or
ones beyond 2^46 in size, whose integers a double does not hold), or has not the
commonest length (the longest of those) has no part and no result. Components
whose deviation is under 1e-10 of the first one's do not exist (constant or
dependent dimensions, fewer rows than dimensions), so a table of equal rows, a
single row or an empty table gives no rows. Equal rows and repeated ids count
each by itself. A sum of squares beyond a long is null. Further columns don't
matter.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import scratch_path

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
MAX_PASSES = 8
ORTHOGONAL = 1e-13              # times the dimension: Q'Q this near the identity ends the passes
TOLERANCE = 1e-10               # of the first component's deviation
LARGEST = 2.0 ** 46
BLOCK = 4096                    # rows handled at once


class Fit(NamedTuple):
    n: int
    sums: np.ndarray            # int64 by dimension
    factors: list[np.ndarray]   # upper triangular, the first applied first
    vectors: np.ndarray         # d x k, unit columns
    variances: np.ndarray       # k, falling
    explained: np.ndarray       # k


def integers(rows: DataFrame, vector: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``row`` (the input row without its vector) and ``x`` (array of long) of
    the rows that take part."""
    others = [F.col(f"`{c}`") for c in rows.columns if c != vector] or [F.lit(None).cast("string").alias("none")]
    v = F.col(f"`{vector}`").cast("array<double>")
    unusable = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    whole = rows.filter(v.isNotNull() & ~unusable).select(F.struct(*others).alias("row"), v.alias("v"))
    sizes = whole.groupBy(F.size("v").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = common[0]["size"] if common else 0
    return whole.filter(F.size("v") == size).select(
        "row", F.transform("v", lambda c: F.floor(c * scale) + F.lit(shift).cast("long")).alias("x"))


def blocks(batches, column: str = "x"):
    """Matrices of at most ``BLOCK`` rows, with the batch slices they belong to."""
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK):
            part = batch.slice(a, BLOCK)
            x = part.column(part.schema.get_field_index(column))
            flat = x.flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(len(part), -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def solve(a: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``a`` times the inverse of an upper triangular factor, by substitution."""
    out = np.empty_like(a)
    for j in range(a.shape[1]):
        out[:, j] = (a[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def entry_sums(x: DataFrame, matrix_of, shape: tuple[int, int]) -> np.ndarray:
    """Sum over all rows of the matrix that ``matrix_of`` gives for a block of
    them: each task adds up its own, Spark the tasks' entries."""
    def run(batches):
        total = None
        for _, block in blocks(batches):
            part = matrix_of(block)
            total = part if total is None else total + part
        if total is not None:
            kind = pa.int64() if total.dtype == np.int64 else pa.float64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size)), pa.array(total.ravel(), kind)], ["entry", "value"])

    kind = "long" if np.issubdtype(matrix_of(np.ones((1, shape[1]), np.int64)).dtype, np.integer) else "double"
    found = (x.select("x").mapInArrow(run, f"entry long, value {kind}")
             .groupBy("entry").agg(F.sum("value").alias("value")).collect())      # d * d rows at most
    out = np.zeros(shape[0] * shape[1], np.int64 if kind == "long" else np.float64)
    for r in found:
        out[r["entry"]] = r["value"]
    return out.reshape(shape)


def gram(x: DataFrame, n: int, sums: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``Q'Q`` over all rows, ``Q`` being the centred rows after the solves."""
    def part(block):
        q = centred(block, n, sums)
        for factor in factors:
            q = solve(q, factor)
        return q.T @ q
    d = len(sums)
    total = entry_sums(x, part, (d, d))
    return (total + total.T) / 2


def factor_of(matrix: np.ndarray, shifted: bool) -> np.ndarray:
    """Upper Cholesky factor, of the matrix plus a shift where asked for or
    needed (raised until the factor exists)."""
    d = len(matrix)
    unit = 100 * d * np.finfo(float).eps * np.linalg.norm(matrix, 2)
    shift = unit if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(matrix + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(unit, 10 * shift)


def fit(x: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Fit on all rows of ``x`` (a written table); None if nothing varies."""
    found = x.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
    n, d = found["n"], found["d"] or 0
    if not n or not d:
        return None
    sums = entry_sums(x, lambda block: block.sum(axis=0, dtype=np.int64), (1, d))[0]
    factors, r = [], np.eye(d)
    for turn in range(MAX_PASSES):
        q_gram = gram(x, n, sums, factors)
        if not turn and not np.any(q_gram):
            return None
        if turn and np.max(np.abs(q_gram - np.eye(d))) < ORTHOGONAL * d:
            break
        factors.append(factor_of(q_gram, shifted=not turn))
        r = factors[-1] @ r
    _, deviations, rows = np.linalg.svd(r)
    variances = deviations ** 2 / n
    kept = min(components, int(np.sum(deviations > TOLERANCE * deviations[0])))
    return Fit(n, sums, factors, rows[:kept].T.copy(), variances[:kept], variances[:kept] / variances.sum())


def projected(block: np.ndarray, fitted: Fit) -> np.ndarray:
    return centred(block, fitted.n, fitted.sums) @ fitted.vectors / np.sqrt(fitted.variances)


def identity_error(x: DataFrame, fitted: Fit) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the
    identity. Their mean is the projected mean of exactly centred rows: zero."""
    k = len(fitted.variances)

    def part(block):
        w = projected(block, fitted)
        return np.pad(w.T @ w, ((0, 0), (0, block.shape[1] - k)))
    total = entry_sums(x, part, (k, len(fitted.sums)))[:, :k]
    return float(np.max(np.abs(total / fitted.n - np.eye(k))))


def squares(block: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum of the squares of ``n * x - S`` of each row, exactly."""
    away = n * block - sums
    if block.size and block.shape[1] * float(np.max(np.abs(away), initial=0)) ** 2 >= 2.0 ** 62:
        exact = (away.astype(object) ** 2).sum(axis=1)
        return pa.array([int(v) if v < 2 ** 63 else None for v in exact], pa.int64())
    return pa.array((away ** 2).sum(axis=1))


def whiten(rows: DataFrame, vector: str, components: int = COMPONENTS, scale: int = SCALE,
           shift: int = SHIFT) -> DataFrame:
    """``row, whitened`` (an array, by component), ``deviation, n, explained``
    (an array) and ``identity_error`` of the rows that take part."""
    spark = rows.sparkSession
    path = scratch_path(spark, "whitening")
    integers(rows, vector, scale, shift).write.parquet(path)
    x = spark.read.parquet(path)
    fields = "whitened array<double>, deviation long, n long, explained array<double>, identity_error double"
    schema = T.StructType([x.schema["row"], *T._parse_datatype_string(fields).fields])
    fitted = fit(x, components)
    if fitted is None:
        return spark.createDataFrame([], schema)
    error = identity_error(x, fitted)
    k = len(fitted.variances)

    def run(batches):
        for part, block in blocks(batches):
            m = len(block)
            w = projected(block, fitted)
            ends = pa.array(np.arange(m + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.ListArray.from_arrays(ends, pa.array(w.ravel())),
                 squares(block, fitted.n, fitted.sums), pa.array(np.full(m, fitted.n)),
                 pa.ListArray.from_arrays(ends, pa.array(np.tile(fitted.explained, m))),
                 pa.array(np.full(m, error))], schema.names)

    return x.mapInArrow(run, schema)


def op12_shifted_cholesky_qr(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    each = whiten(rows, "embedding").select("row", "n", "deviation", "identity_error", "explained",
                                            F.posexplode("whitened").alias("place", "whitened"))
    return each.select(F.col("row.vec_id").alias("vec_id"), (F.col("place") + 1).cast("int").alias("component"), "n",
                       "deviation", "whitened", F.get("explained", F.col("place")).alias("explained"), "identity_error")
