"""Embedding whitening by a bit-sliced scatter matrix.

An entry c becomes the integer floor(1024 * c) + 100000.  All statistics are exact
integers until the one eigendecomposition:

1. Each task shifts its block of integers by the block's least value in every
   dimension, packs each bit plane of a dimension across the rows into 64-bit
   words, and gets the cross-products of two dimensions as popcounts of the ANDed
   planes weighted by powers of two.  The shift is undone in whole numbers.
2. Sums and cross-products of all blocks are added up as decimals: one row for a
   dimension or a pair of dimensions and task, whatever the rows are.
3. The driver has one number for each pair of dimensions.  It centres them as
   integers, n * sum(xy) - sum(x) * sum(y), and takes the eigenvectors.
4. A pass over the rows projects them; another sums the products of what it gives,
   for the error that is reported.

Cases: vectors that are null, empty, or hold null or non-finite entries are left
out, and so are those with an entry beyond +-LARGEST, whose integer has no exact
long, and those whose length is not the most frequent one (of equally frequent
lengths the larger).  Repeated rows count each time; null ids are kept.  A
component without variance (eigenvalue at most 1e-12 of the trace, as for fewer
rows than dimensions or equal rows) has a null ``whitened`` and stays out of
``identity_error``, which is null without any other.  A deviation beyond a long is
null.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000
#: Largest absolute entry: its integer stays below 2^41.
LARGEST = 1 << 30
#: Rows packed at once, and bytes of one step of ANDed words.
BLOCK_ROWS, STEP_BYTES = 1 << 15, 8 << 20
FLAT = 1e-12
_LONG = (1 << 63) - 1


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > F.lit(float(LARGEST))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def vectors_of(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the usable rows of the most frequent length."""
    thin = rows.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    usable = thin.where(_usable(F.col("vector")))
    size = F.size("vector").alias("size")
    common = usable.groupBy(size).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()  # one row
    return usable.where(F.size("vector") == (common[0]["size"] if common else 0))


def integers(column: pa.Array) -> np.ndarray:
    """The rows' integers, one row of the matrix each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(column), -1) + OFFSET


# ---------------------------------------------------------------------------
# Scatter
# ---------------------------------------------------------------------------


def _planes(shifted: np.ndarray) -> np.ndarray:
    """[bit, dimension, word]: bit planes of non-negative integers, packed across the rows."""
    rows, dims = shifted.shape
    bits = max(1, int(shifted.max()).bit_length())
    words = -(-rows // 64)
    out = np.zeros((bits, dims, words * 8), np.uint8)
    for b in range(bits):
        packed = np.packbits(((shifted >> b) & 1).astype(np.uint8), axis=0)
        out[b, :, : len(packed)] = packed.T
    return out.view(np.uint64)


def bit_sliced_products(shifted: np.ndarray) -> np.ndarray:
    """Exact sums of products of each two columns, as Python integers."""
    planes = _planes(shifted)
    bits, dims, words = planes.shape
    by_weight = np.zeros((2 * bits - 1, dims, dims), np.int64)
    step = max(1, STEP_BYTES // (8 * words * dims))
    for a in range(bits):
        for b in range(a, bits):
            for at in range(0, dims, step):
                both = planes[a, at : at + step, None, :] & planes[b, None, :, :]
                counts = np.bitwise_count(both).sum(axis=2, dtype=np.int64)
                by_weight[a + b, at : at + step] += counts
                if a != b:
                    by_weight[a + b, :, at : at + step] += counts.T
    total = np.zeros((dims, dims), object)
    for weight, counts in enumerate(by_weight):
        total += counts.astype(object) << weight
    return total


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(i, j, total) of a task's rows: counts at (-1, -1), sums at (-1, j), products at i <= j."""
    rows, sums, products = 0, 0, 0

    def add(x: np.ndarray) -> None:
        nonlocal rows, sums, products
        least = x.min(axis=0)
        shifted = x - least
        n, least, over = len(x), least.astype(object), shifted.sum(axis=0).astype(object)
        cross = np.outer(least, over)
        rows, sums = rows + n, sums + over + n * least
        products = products + bit_sliced_products(shifted) + cross + cross.T + n * np.outer(least, least)

    held: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            held.append(integers(batch.column("vector")))
        if sum(map(len, held)) >= BLOCK_ROWS:
            add(np.concatenate(held))
            held = []
    if held:
        add(np.concatenate(held))
    if rows:
        i, j = np.triu_indices(len(sums))
        index = np.arange(len(sums))
        first = np.r_[-1, np.full(len(index), -1), i].astype(np.int32)
        second = np.r_[-1, index, j].astype(np.int32)
        total = pa.array([rows, *sums, *products[i, j]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), total], names=["i", "j", "total"])


def scatter(vectors: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Rows, sums and cross-products of all vectors, exact; their size follows the dimensions alone."""
    parts = vectors.select("vector").mapInArrow(_scatter, "i int, j int, total decimal(38,0)")
    totals = parts.groupBy("i", "j").agg(F.sum("total").alias("total")).toArrow()
    first, second = totals.column("i").to_numpy(), totals.column("j").to_numpy()
    value = [int(x) for x in totals.column("total").to_pylist()]
    dims = int(second.max()) + 1 if len(second) else 0
    rows, sums, products = 0, [0] * dims, np.zeros((dims, dims), object)
    for a, b, v in zip(first.tolist(), second.tolist(), value):
        if b < 0:
            rows = v
        elif a < 0:
            sums[b] = v
        else:
            products[a, b] = products[b, a] = v
    return rows, sums, products


# ---------------------------------------------------------------------------
# Components
# ---------------------------------------------------------------------------


@dataclass
class Whitening:
    """n, sums, and by component: eigenvalue, share of the trace and unit vector (column)."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    explained: np.ndarray
    vectors: np.ndarray

    def sound(self) -> np.ndarray:
        return self.explained > FLAT


def fit(vectors: DataFrame, most: int = 8) -> Whitening | None:
    """The ``most`` components of largest variance; None without rows."""
    n, sums, products = scatter(vectors)
    if not n:
        return None
    s = np.array(sums, object)
    centred = n * products - np.outer(s, s)  # n^2 times the covariance, whole numbers
    square = n * n
    covariance = np.array([[int(v) / square for v in row] for row in centred])
    value, vector = np.linalg.eigh(covariance)
    value, vector = value[::-1][:most], vector[:, ::-1][:, :most]
    trace = int(np.trace(centred)) / square
    share = value / trace if trace else np.zeros(len(value))
    return Whitening(n, sums, np.maximum(value, 0.0), np.maximum(share, 0.0), vector)


def _project(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n * x - sums, exact (longs, or Python integers where longs might not hold them), and the whitened rows."""
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * model.n + max(map(abs, model.sums))
    exact = x if largest < 1 << 62 else x.astype(object)
    off = model.n * exact - np.array(model.sums, exact.dtype)
    scale = np.where(model.sound(), model.n * np.sqrt(model.eigenvalues), np.nan)
    return off, (off.astype(np.float64) @ model.vectors) / scale


def _deviations(off: np.ndarray) -> list[int | None]:
    if off.dtype != object and off.shape[1] * int(np.abs(off).max(initial=0)) ** 2 <= _LONG:
        return (off * off).sum(axis=1).tolist()
    total = (off.astype(object) ** 2).sum(axis=1)
    return [int(v) if v <= _LONG else None for v in total]


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened rows' covariance less the identity, summed over the rows."""
    sound = np.flatnonzero(model.sound())

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sound) + 1, len(sound)))
        for batch in batches:
            if batch.num_rows:
                white = _project(model, integers(batch.column("vector")))[1][:, sound]
                total[:-1] += white.T @ white
                total[-1] += white.sum(axis=0)
        if total.any():
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())], names=["i", "j", "total"]
            )

    if not len(sound):
        return None
    sums = np.zeros((len(sound) + 1, len(sound)))
    parts = vectors.select("vector").mapInArrow(products, "i int, j int, total double")
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():  # components squared
        sums[r["i"], r["j"]] = r["total"]
    mean = sums[-1] / model.n
    return float(np.abs(sums[:-1] / model.n - np.outer(mean, mean) - np.eye(len(sound))).max())


_ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", most: int = 8) -> DataFrame:
    """A row of _ROWS for each usable vector and each of its components."""
    vectors = vectors_of(rows, id_column, vector_column)
    model = fit(vectors, most)
    if model is None:
        return rows.sparkSession.createDataFrame([], _ROWS)
    error = identity_error(vectors, model)
    names = [c.split()[0] for c in _ROWS.split(", ")]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(model.explained)
        for batch in batches:
            if not batch.num_rows:
                continue
            off, white = _project(model, integers(batch.column("vector")))
            size = len(white) * count
            deviation = pa.array(_deviations(off), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(np.repeat(np.arange(len(white)), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(white))),
                    pa.array(np.full(size, model.n)),
                    deviation.take(pa.array(np.repeat(np.arange(len(white)), count))),
                    pa.array(white.ravel(), from_pandas=True),
                    pa.array(np.tile(model.explained, len(white))),
                    pa.array([error] * size, pa.float64()),
                ],
                names=names,
            )

    return vectors.select(F.col("id").cast("long").alias("id"), "vector").mapInArrow(project, _ROWS)
