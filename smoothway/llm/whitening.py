"""Embedding whitening from an exact integer scatter matrix.

Vectors become whole numbers; their sums and cross-products are added up without rounding, however
large. Only the finished n XtX - SSt is turned into floating point, for the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smoothway.llm.store import fields, spare, written

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Sums travel between tasks in limbs of so many bits, so that a column of longs adds up 2**33 of them.
LIMB = 30
#: Eigenvalues below this share of the largest are those of dimensions that don't vary.
LEAST = 1e-12


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    return F.coalesce(F.size(vector) > 0, F.lit(False)) & F.coalesce(F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False))), F.lit(False))


def whole(column: pa.Array, size: int) -> np.ndarray:
    """Rows of whole numbers: longs, or Python's own where an entry is beyond 2**52."""
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size) * SCALE
    if np.abs(c).max(initial=0) < 2.0**52:
        return np.floor(c).astype(np.int64) + OFFSET
    return np.array([[int(v) + OFFSET for v in row] for row in np.floor(c)], dtype=object)


def products(x: np.ndarray) -> np.ndarray:
    """x'x without rounding: by floating point where no sum reaches 2**53, else by longs, else by Python's integers."""
    most = int(np.abs(x).max(initial=0)) ** 2 * len(x)
    if most < 1 << 53:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64)
    if most < 1 << 63:
        y = x.astype(np.int64)
        return y.T @ y
    y = x.astype(object)
    return y.T @ y


@dataclass
class Scatter:
    """Exact sums of n vectors after a shift: total (of each dimension) and cross (of each two)."""

    n: int
    shift: list[int]
    total: list[int]
    cross: np.ndarray

    def centred(self) -> np.ndarray:
        """n XtX - SSt in whole numbers; no shift changes it."""
        total = np.array(self.total, dtype=object)
        return self.n * self.cross - np.outer(total, total)

    def covariance(self) -> np.ndarray:
        """The covariance with divisor n; each entry is rounded once."""
        return np.array([[v / self.n**2 for v in row] for row in self.centred()], dtype=np.float64)

    def components(self, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Eigenvalues, unit eigenvectors (as columns) and shares of the trace of the first components.

        The largest entry of an eigenvector is positive. Dimensions that don't vary give no component.
        """
        v = self.covariance()
        e, q = np.linalg.eigh(v)
        e, q = e[::-1][:count], q[:, ::-1][:, :count]
        kept = e > LEAST * max(e.max(initial=0), 0)
        e, q = e[kept], q[:, kept]
        q = q * np.sign(q[np.abs(q).argmax(axis=0), np.arange(q.shape[1])])
        return e, q, e / np.trace(v) if len(e) else e


def scatter(vectors: DataFrame, vector: str, size: int, shift: list[int]) -> Scatter:
    """Exact sums over all rows, each a vector of size finite entries.

    A task adds up its rows and sends limbs of its sums; Spark adds these by cell. The driver sees
    about size**2 / 2 sums, whatever the number of rows.
    """
    left, right = np.triu_indices(size)
    cells = len(left) + size + 1

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype=object)
        away = np.array(shift, dtype=object)
        for batch in batches:
            x = whole(batch.column(0), size)
            x = x - (away if x.dtype == object or max(map(abs, shift), default=0) >= 1 << 61 else away.astype(np.int64))
            total += np.concatenate([products(x)[left, right].astype(object), x.sum(axis=0, dtype=object), np.array([len(x)], dtype=object)])
        cell, limb, value = [], [], []
        for k, v in enumerate(total):
            sign, rest, at = (-1 if v < 0 else 1), abs(int(v)), 0
            while rest:
                cell.append(k)
                limb.append(at)
                value.append(sign * (rest & ((1 << LIMB) - 1)))
                rest, at = rest >> LIMB, at + 1
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())], names=["cell", "limb", "value"])

    found = [0] * cells
    told = vectors.select(vector).mapInArrow(summed, "cell int, limb int, value long").groupBy("cell", "limb").agg(F.sum("value").alias("value")).toPandas()
    for k, at, v in zip(told["cell"].tolist(), told["limb"].tolist(), told["value"].tolist(), strict=True):
        found[k] += v << (LIMB * at)
    cross = np.zeros((size, size), dtype=object)
    cross[left, right] = cross[right, left] = found[: len(left)]
    return Scatter(found[-1], shift, found[len(left) : -1], cross)


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: key, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty or holds null or non-finite entries are dropped, and so are
    vectors of another length than most have (of equally many lengths, the longest stays). Repeated
    rows and null keys are rows as any other. A dimension that doesn't vary adds no component, so a
    single vector, or copies of one, give no rows, as an empty table does; other columns are not
    looked at. deviation, the exact sum over dimensions of (n x - S)**2, has up to 38 digits and is null beyond.
    """
    schema = fields("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double", **{key: table.schema[key].dataType})
    spark = table.sparkSession
    rows = table.select(F.col(key).alias("key"), F.col(vector).alias("vector")).filter(usable(F.col("vector")))
    most = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"), F.first("vector").alias("one")).orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return spark.createDataFrame([], schema)
    size = most["size"]
    rows = rows.filter(F.size("vector") == size)
    shift = [int(v) for v in whole(pa.array([most["one"]], pa.list_(pa.float64())), size)[0]]  # close to all other rows
    sums = scatter(rows, "vector", size, shift)
    n, total = sums.n, np.array(sums.total, dtype=object)
    e, q, shares = sums.components(components)
    if not len(e):
        return spark.createDataFrame([], schema)
    scale = q / np.sqrt(e)
    away = np.array(shift, dtype=object)
    widest = max(map(abs, [*shift, *total]))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(batch.column(1), size)
            quick = x.dtype != object and max(widest, n * (int(np.abs(x).max(initial=0)) + max(map(abs, shift)))) < 1 << 62
            d = n * (x - away.astype(np.int64)) - total.astype(np.int64) if quick else n * (x.astype(object) - away) - total
            far = int(np.abs(d).max(initial=0))
            far = (d * d).sum(axis=1) if quick and far * far * size < 1 << 63 else (d.astype(object) ** 2).sum(axis=1)
            z = (d / n).astype(np.float64) @ scale
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([str(v) for v in far], pa.string()), pa.array(list(z), pa.list_(pa.float64()))], names=["key", "deviation", "z"])

    kinds = fields("deviation string, z array<double>", key=table.schema[key].dataType)
    done = written(rows.mapInArrow(projected, kinds), "whitened")
    k = len(e)
    means = done.agg(*[(F.sum(F.col("z")[i]) / n).alias(f"m{i}") for i in range(k)]).first()
    centred = lambda i: F.col("z")[i] - F.lit(means[i])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    second = done.agg(*[(F.sum(centred(i) * centred(j)) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(second[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    share = F.array(*[F.lit(float(s)) for s in shares])
    # names of the job's own can't clash with the key's
    (at, value) = spare(table.select(key), "component", "value")
    each = done.select(F.col("key").alias(key), "deviation", F.posexplode("z").alias(at, value))
    return each.select(
        F.col(key),
        (F.col(at) + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        F.col("deviation").try_cast("decimal(38,0)").alias("deviation"),
        F.col(value).alias("whitened"),
        F.get(share, F.col(at)).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
