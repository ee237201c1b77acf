"""Whitening of embeddings from exact second moments, counted on bit slices.

Every entry c becomes the integer x = floor(scale * c) + offset. Within a block of rows each dimension is shifted by its
smallest value there, and bit b of all shifted values of a dimension is packed, row after row, into 64-bit words: a
bit plane. The cross-product of two dimensions is the sum over their planes of 2^(a+b) times the number of ones in the AND of the two
planes, and the sum of a dimension the weighted number of ones of its planes; the shifts are put back as integers. So sums and
cross-products are exact, whatever the order of rows and however they are partitioned. They leave a task as 32-bit limbs, which
Spark adds up; the driver gets one row per pair of dimensions and limb, a number that follows the width of the vectors alone.
There n * cross - sum * sum is formed in integers, so the covariance is centred before anything is rounded, and ``eigh`` gives the components.

Defined results: rows whose vector is null, empty, holds null or non-finite entries, or is not of the most frequent length (the longer
one on a tie) are dropped; repeated and null keys keep their rows; entries of which scale * c leaves +-2^62 are taken as that bound; a component
whose eigenvalue is not above rounding (one vector, equal vectors, dimensions that depend on each other) has a null ``whitened`` and does not count
in ``identity_error`` (null, if that holds for all); a ``deviation`` beyond a long is null, ``deviation_exact`` keeps up to 38 digits;
``explained`` is null where all vectors are equal. Without rows the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1 << 62


@dataclass(frozen=True)
class Moments:
    """Rows, sums and n * cross-product - sum * sum of each pair of dimensions, all exact integers."""

    n: int
    sums: list[int]
    centred: np.ndarray


def finite_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """(id, vec) of the rows that take part, and their length."""
    found = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vec")).where(
        F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    length = found.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    width = length["n"] if length else 0
    return found.where(F.size("vec") == width), width


def integers(rows: np.ndarray, scale: int, offset: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        scaled = np.floor(rows * float(scale))
    return np.clip(scaled, -float(LIMIT), float(LIMIT)).astype(np.int64) + offset


def bit_planes(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes of non-negative (dimension, row) values as 64-bit words, with the dimension and the bit of each."""
    width, rows = columns.shape
    top = columns.max(axis=1)
    kept, dims, bits = [], [], []
    for bit in range(int(top.max()).bit_length()):
        which = np.flatnonzero(top >> np.uint64(bit))
        ones = ((columns[which] >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        kept.append(np.packbits(np.pad(ones, ((0, 0), (0, -rows % 64))), axis=1).view(np.uint64))
        dims.append(which)
        bits.append(np.full(which.size, bit))
    if not kept:
        return np.zeros((0, 1), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(kept), np.concatenate(dims), np.concatenate(bits)


def block_moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and cross-products of the columns of ``x`` (rows, dimensions) as Python integers, from popcounts."""
    rows, width = x.shape
    low = x.min(axis=0)
    planes, dims, bits = bit_planes((x.T.astype(np.int64) - low[:, None]).view(np.uint64))
    # Small values fit in machine words; wide ones are added up as Python integers.
    kind = np.int64 if 2 * int(bits.max(initial=0) + 1) + rows.bit_length() < 62 else object
    weight = np.array([1 << int(b) for b in bits], kind)
    sums, cross = np.zeros(width, kind), np.zeros((width, width), kind)
    ones = np.bitwise_count(planes).sum(axis=1, dtype=np.int64).astype(kind)
    np.add.at(sums, dims, ones * weight)
    for p in range(len(planes)):
        shared = np.bitwise_count(planes[p] & planes).sum(axis=1, dtype=np.int64).astype(kind)
        np.add.at(cross[dims[p]], dims, shared * weight * weight[p])
    sums, cross, low = sums.astype(object), cross.astype(object), low.astype(object)
    cross = cross + np.outer(low, sums) + np.outer(sums, low) + rows * np.outer(low, low)
    return sums + rows * low, cross


def _matrices(batches: Iterator[pa.RecordBatch], width: int, cells: int = 1 << 19) -> Iterator[np.ndarray]:
    """The vectors of column ``vec``, as matrices of a bounded number of rows."""
    size, held, count = max(64, min(8192, cells // width)), [], 0
    for batch in batches:
        rows = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        for at in range(0, len(rows), size):
            held.append(rows[at:at + size])
            count += len(held[-1])
            if count >= size:
                yield np.concatenate(held)
                held, count = [], 0
    if count:
        yield np.concatenate(held)


def moments(usable: DataFrame, width: int, scale: int = 1024, offset: int = 100_000) -> Moments:
    """The exact moments of all vectors of ``usable``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(width, object), np.zeros((width, width), object)
        for rows in _matrices(batches, width):
            more, products = block_moments(integers(rows, scale, offset))
            n, sums, cross = n + len(rows), sums + more, cross + products
        if n:
            # Row -1 holds the sums and, at -1, the number of rows.
            cells = [(-1, -1, n)] + [(-1, i, sums[i]) for i in range(width)] + [(i, j, cross[i, j]) for i in range(width) for j in range(i, width)]
            limbs = [(i, j, k, value >> 32 * k & 0xFFFFFFFF if k < 4 else value >> 128) for i, j, value in cells for k in range(5)]
            kept = [c for c in limbs if c[3] or c[2] == 0]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*kept)], schema=pa.schema(
                [("i", pa.int32()), ("j", pa.int32()), ("limb", pa.int32()), ("part", pa.int64())]))

    found = usable.select("vec").mapInArrow(partial, "i int, j int, limb int, part long").groupBy("i", "j", "limb").agg(F.sum("part").alias("part")).collect()
    total: dict[tuple[int, int], int] = {}
    for row in found:
        total[row["i"], row["j"]] = total.get((row["i"], row["j"]), 0) + (row["part"] << 32 * row["limb"])
    n = total.get((-1, -1), 0)
    sums = [total.get((-1, i), 0) for i in range(width)]
    centred = np.zeros((width, width), object)
    for i in range(width):
        for j in range(i, width):
            centred[i, j] = centred[j, i] = n * total.get((i, j), 0) - sums[i] * sums[j]
    return Moments(n, sums, centred)


@dataclass(frozen=True)
class Whitener:
    """``axes`` (component, dimension) over the root of the eigenvalue, zero where there is none; ``explained`` shares."""

    n: int
    sums: list[int]
    axes: np.ndarray
    real: list[bool]
    explained: list[float | None]
    scale: int
    offset: int

    def deviations(self, rows: np.ndarray) -> np.ndarray:
        """n * x - sum, exact."""
        x = integers(rows, self.scale, self.offset)
        if self.n * (LIMIT if not x.size else max(1, int(np.abs(x).max()))) < 1 << 61 and max(map(abs, self.sums)) < 1 << 61:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(np.float64) @ self.axes.T


def fit(usable: DataFrame, width: int, components: int = 8, scale: int = 1024, offset: int = 100_000) -> Whitener | None:
    """Components by falling eigenvalue of the covariance of all vectors, divisor n; None without rows."""
    if not width:
        return None
    found = moments(usable, width, scale, offset)
    # Integers of any size over n^2, each rounded once.
    square = found.n * found.n
    covariance = np.array([[c / square for c in line] for line in found.centred], np.float64)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    trace = sum(int(found.centred[i, i]) for i in range(width)) / square
    real = [bool(v > width * np.finfo(np.float64).eps * max(values[0], 0.0)) for v in values]
    roots = np.array([np.sqrt(v) if ok else np.inf for v, ok in zip(values, real)])
    shares = [max(float(v), 0.0) / trace if trace else None for v in values]
    return Whitener(found.n, found.sums, (vectors / roots).T, real, shares, scale, offset)


def identity_error(usable: DataFrame, width: int, model: Whitener) -> float | None:
    """The largest entry of the covariance of the whitened vectors minus the identity, measured over all of them."""
    real = np.flatnonzero(model.real)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, cross = np.zeros(real.size), np.zeros((real.size, real.size))
        for rows in _matrices(batches, width):
            y = model.whitened(model.deviations(rows))[:, real]
            sums, cross = sums + y.sum(axis=0), cross + y.T @ y
        cells = [(-1, i, sums[i]) for i in range(real.size)] + [(i, j, cross[i, j]) for i in range(real.size) for j in range(real.size)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*cells)], schema=pa.schema([("i", pa.int32()), ("j", pa.int32()), ("part", pa.float64())]))

    if not real.size:
        return None
    # x - mean is exact before the projection, so the values are centred; the mean that rounding leaves is taken off as well.
    found = {(r["i"], r["j"]): r["part"] / model.n for r in usable.select("vec").mapInArrow(partial, "i int, j int, part double")
             .groupBy("i", "j").agg(F.sum("part").alias("part")).collect()}
    return max(abs(found[i, j] - found[-1, i] * found[-1, j] - (i == j)) for i in range(real.size) for j in range(real.size))


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, deviation_exact, whitened, explained, identity_error) per vector and component."""
    kind = vectors.schema[key].dataType.simpleString()
    usable, width = finite_vectors(vectors, key, vector)
    model = fit(usable, width, components, scale, offset)
    schema = f"id {kind}, n long, deviation long, deviation_exact decimal(38,0), whitened array<double>"
    if model is None:
        rows = vectors.sparkSession.createDataFrame([], schema)
        error, real, explained = None, [], []
    else:
        error, real, explained = identity_error(usable, width, model), model.real, model.explained

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                off = model.deviations(parts)
                y = model.whitened(off)
                # As Python integers: the sum of squares may leave a long.
                squares = [sum(v * v for v in line) for line in off.tolist()]
                ends = np.arange(len(parts) + 1, dtype=np.int32) * y.shape[1]
                yield pa.RecordBatch.from_arrays([
                    batch.column("id"), pa.array([model.n] * len(parts), pa.int64()), pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()),
                    pa.array([s if s < 10 ** 38 else None for s in squares], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(y.ravel()))], ["id", "n", "deviation", "deviation_exact", "whitened"])

        rows = usable.mapInArrow(scored, schema)
    known = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.lit(ok).alias("real"), F.lit(share).cast("double").alias("explained"))
                      for i, (ok, share) in enumerate(zip(real, explained))]) if real else F.array().cast("array<struct<component:int,real:boolean,explained:double>>")
    each = rows.withColumn("c", F.explode(known))
    return each.select(
        F.col("id").alias(key), F.col("c.component").alias("component"), "n", "deviation", "deviation_exact",
        F.when(F.col("c.real"), F.get("whitened", F.col("c.component") - 1)).alias("whitened"), F.col("c.explained").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
