"""Whitening of embeddings by shifted Cholesky QR.

Entries become whole numbers, so sums and centring are exact. A Gram pass adds up R^-T X'X R^-1 of the centred rows X
over all tasks; the Cholesky factor of that small matrix (shifted, so that it always exists) is one more triangular
factor, by which the next pass solves. After a few passes the rows solved by all factors are orthonormal, and the
product of the factors is the R of X = QR without X'X ever being relied upon. The singular vectors of R are the
components, the squares of its singular values over n their variances. Only matrices of the dimension's size, whatever
the number of rows, reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
#: Entries from this size on do not fit 64 * c in a long; they count as not finite.
HUGE = 2.0**55
PASSES, ORTHONORMAL = 8, 1e-13
#: A component whose standard deviation is below this share of the largest has no variance but rounding.
NO_VARIANCE = 1e-11
_SAFE = 2**62


def _whole(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows kept (their places in the batch) and their entries as whole numbers."""
    column = batch.column("vector")
    starts = column.offsets.to_numpy(zero_copy_only=False)[: len(column) + 1].astype(np.int64)
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (np.diff(starts) == size))
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    entries = flat[starts[rows][:, None] + np.arange(size)] if len(rows) else np.empty((0, size))
    with np.errstate(invalid="ignore"):
        kept = (np.abs(entries) < HUGE).all(axis=1)
    return rows[kept], np.floor(SCALE * entries[kept]).astype(np.int64) + OFFSET


def _apart(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S exactly: longs where they are sure to fit, else Python's whole numbers."""
    most = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums))
    if most < _SAFE:
        return n * x - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _deviations(apart: np.ndarray) -> pa.Array:
    size = apart.shape[1]
    if apart.dtype != object and int(np.abs(apart).max(initial=0)) ** 2 * size < _SAFE:
        return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(sum(int(v) ** 2 for v in row)) for row in apart], pa.decimal128(38, 0))


def _solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular factor, column by column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _sums(vectors: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of rows kept and their exact sum in each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for batch in batches:
            _, x = _whole(batch, size)
            n += len(x)
            high, low = (x >> 31).sum(axis=0), (x & (2**31 - 1)).sum(axis=0)
            sums = [s + (int(h) << 31) + int(w) for s, h, w in zip(sums, high, low, strict=True)]
        values = pa.array([Decimal(v) for v in [n, *sums]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()), values], ["i", "v"])

    total = dict(vectors.mapInArrow(run, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v")).collect())
    return int(total.get(-1, 0)), [int(total.get(i, 0)) for i in range(size)]


def _gram(vectors: DataFrame, size: int, rows_of: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of r r', with r the ``width`` numbers that rows_of makes of a row's whole numbers."""
    at = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((width, width))
        for batch in batches:
            _, x = _whole(batch, size)
            r = rows_of(x)
            sums += r.T @ r
        columns = [pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(sums[at])]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "v"])

    cells = vectors.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((width, width))
    for i, j, v in cells:
        out[i, j] = out[j, i] = v
    return out


def shifted_factor(gram: np.ndarray, always: bool) -> np.ndarray:
    """The upper Cholesky factor of a Gram matrix, shifted by a rounding's worth of its trace where needed or asked."""
    shift = 1e-13 * np.trace(gram) if always else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(shift * 10, 1e-14 * np.trace(gram))


def _unsettled(gram: np.ndarray) -> float:
    """How far the eigenvalues of a Gram matrix are from 1, or from 0 in directions without variance."""
    values = np.linalg.eigvalsh(gram)
    return float(np.minimum(np.abs(values - 1), np.abs(values)).max(initial=0))


def _r_factor(vectors: DataFrame, size: int, n: int, sums: list[int]) -> np.ndarray:
    """The R of the QR factorisation of all centred rows."""
    factors: list[np.ndarray] = []

    def solved(x: np.ndarray) -> np.ndarray:
        rows = (_apart(x, n, sums) / n).astype(np.float64)
        for factor in factors:
            rows = _solved(rows, factor)
        return rows

    for step in range(PASSES):
        gram = _gram(vectors, size, solved, size)
        if not np.trace(gram):
            return np.zeros((size, size))
        factors.append(shifted_factor(gram, always=step == 0))
        if step and _unsettled(gram) < ORTHONORMAL * size:
            break
    product = np.eye(size)
    for factor in factors:
        product = factor @ product
    return product


def components(vectors: DataFrame, size: int) -> tuple[int, list[int], np.ndarray, np.ndarray]:
    """Rows, sums, variances (falling) and unit components (as rows) of a table with one column ``vector``."""
    n, sums = _sums(vectors, size)
    if not n:
        return 0, sums, np.zeros(size), np.eye(size)
    _, deviations, axes = np.linalg.svd(_r_factor(vectors, size, n, sums))
    deviations = np.where(deviations > NO_VARIANCE * deviations[0], deviations, 0.0)
    return n, sums, deviations**2 / n, axes


def dimension(vectors: DataFrame) -> int:
    """The most frequent number of entries, the larger one of a tie; 0 without any vector."""
    sizes = vectors.where("vector IS NOT NULL").groupBy(F.size("vector").alias("size")).count().where("size > 0")
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return most["size"] if most else 0


def whitened(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 32) -> DataFrame:
    """One row per kept row and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    An entry c counts as x = floor(64 c) + 1000000. Rows whose vector is null, holds a null, an entry that is not finite
    or one of 2^55 or more in size, or has another number of entries than most vectors (the larger number of a tie), are
    dropped. n is the number of rows kept, S the sum of their x; deviation is the sum over dimensions of (n x - S)^2,
    exact, as decimal(38,0). whitened is x - S/n projected on the component, over the root of its variance; explained
    is the component's share of all variance; identity_error is the largest entry, over all rows, of the covariance of
    the whitened rows minus the identity. Components without variance (fewer different rows than dimensions, or a
    dimension that depends on others) come last, with whitened null, explained 0, and are left out of identity_error;
    so are all if every row is the same. Repeated rows and ids count each on their own; a null id stays null. An empty
    table gives no rows. Other columns are not looked at.
    """
    own = table.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    vectors, kind = own.select("vector"), own.schema["id"].dataType.simpleString()
    size = dimension(vectors)
    n, sums, variances, axes = components(vectors, size) if size else (0, [0], np.zeros(1), np.eye(1))
    width, total = min(most, size), float(variances.sum())
    used = int(np.count_nonzero(variances[:width]))
    projection = axes[:used].T / np.sqrt(variances[:used])

    def projected(apart: np.ndarray) -> np.ndarray:
        return (apart / n).astype(np.float64) @ projection

    error = 0.0
    if used:
        gram = _gram(vectors, size, lambda x: projected(_apart(x, n, sums)), used)
        error = float(np.abs(gram / n - np.eye(used)).max())
    explained = variances[:width] / total if total else np.zeros(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                rows, x = _whole(part, size)
                apart = _apart(x, n, sums)
                values = np.full((len(rows), width), np.nan)
                values[:, :used] = projected(apart)
                again = pa.array(np.repeat(np.arange(len(rows)), width))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(rows)).take(again),
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(rows) * width, n, np.int64)),
                        _deviations(apart).take(again),
                        pa.array(values.ravel(), from_pandas=True),
                        pa.array(np.tile(explained, len(rows))),
                        pa.array(np.full(len(rows) * width, error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return own.mapInArrow(run, schema).withColumnRenamed("id", id_col)
