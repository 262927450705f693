"""Embedding whitening from the covariance of distinct vectors, weighted by how often they occur.

1. Identical vectors are grouped. Their number of copies, or one, is the weight of the fit.
2. Sums per dimension are exact. Each task centres its distinct vectors, in whole numbers as long
   as they fit, and multiplies them: one weighted product of d x d numbers for each task. Spark
   adds the products up by row.
3. The driver gets d x d numbers and finds their eigenvectors.
4. Each distinct vector is whitened once and joined back to its rows. Vectors with more than a
   thousandth of all rows, a thousand at most, are broadcast; no other key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefetch.llm.common import settle, ship_package

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Entries are cut off at this size once they are scaled, so that they are whole numbers in a long.
MOST = 10**15
#: A vector is hot if it has more than this part of all rows; so there are fewer than this many.
HOT_PART = 1_000


def quantized(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """Each entry as a whole number: floor(scale * entry) + shift. Beyond ``MOST`` it is cut off."""

    def whole(entry: Column) -> Column:
        scaled = F.floor(F.greatest(F.least(entry.cast("double") * scale, F.lit(float(MOST))), F.lit(float(-MOST))))
        return scaled.cast("long") + shift

    return F.transform(vector, whole)


def usable(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite."""

    def finite(entry: Column) -> Column:
        value = entry.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))

    return F.coalesce(F.size(vector) > 0, F.lit(False)) & F.coalesce(F.forall(vector, finite), F.lit(False))


@dataclass(frozen=True)
class Whitening:
    """rows: weight of the fit; sums: per dimension, exact; values, vectors: of the components, by falling value.

    Only components with variance are kept: an eigenvalue that is rounding of the largest is none.
    """

    rows: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x`` less the mean, as doubles."""
        return _deviations(x, self.rows, self.sums).astype(np.float64) / self.rows

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def explained(self) -> list[float]:
        return (self.values / self.trace).tolist()


def _deviations(x: np.ndarray, rows: int, sums: tuple[int, ...]) -> np.ndarray:
    """rows * x - sums, exact: 64-bit numbers if they suffice, else Python's."""
    most = int(np.abs(x).max(initial=0))
    if rows * most + max(map(abs, sums), default=0) < 1 << 62:
        return rows * x - np.asarray(sums, np.int64)
    return rows * x.astype(object) - np.asarray(sums, object)


def _squares(deviations: np.ndarray) -> list[int]:
    """The sum of squares of each row, exact."""
    most = int(np.abs(deviations).max(initial=0))
    if deviations.dtype != object and most * most * deviations.shape[1] < 1 << 62:
        return (deviations * deviations).sum(1).tolist()
    return [sum(v * v for v in row) for row in deviations.tolist()]


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _products(prepare):
    """Sums the weighted products of a task's vectors; one row for each row of the matrix."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                vectors, weights = prepare(_matrix(batch.column(0))), batch.column(1).to_numpy()
                made = (vectors * weights[:, None]).T @ vectors
                total = made if total is None else total + made
        if total is not None:
            rows = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), total.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), rows], ["i", "products"])

    return products


def _add(table: pa.Table) -> pa.Table:
    total = _matrix(table.column("products").combine_chunks()).sum(0)
    return pa.table({"i": table.column("i").slice(0, 1), "products": pa.array([total.tolist()], pa.list_(pa.float64()))})


def _gram(vectors: DataFrame, prepare) -> np.ndarray:
    """The sum of weighted products over rows of (vector, weight). The driver gets the sum only."""
    partial = vectors.mapInArrow(_products(prepare), "i int, products array<double>")
    rows = partial.groupBy("i").applyInArrow(_add, "i int, products array<double>").toArrow()
    total = _matrix(rows.column("products").combine_chunks())[np.argsort(rows.column("i").to_numpy())]
    return (total + total.T) / 2


def distinct_vectors(vectors: DataFrame, weights: str = "copies") -> DataFrame:
    """x, copies and weight of each distinct ``x``. Weights are the copies, or one for each vector."""
    if weights not in ("copies", "one"):
        raise ValueError(f"weights must be 'copies' or 'one', not {weights!r}")
    grouped = vectors.groupBy("x").agg(F.count("*").alias("copies"))
    return grouped.withColumn("weight", F.col("copies") if weights == "copies" else F.lit(1).cast("long"))


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of written distinct vectors; None without any. Vectors of two lengths are refused."""
    ship_package(distinct.sparkSession)
    sums = (
        distinct.select("weight", F.posexplode("x").alias("i", "v"))
        .groupBy("i")
        .agg(F.sum(F.col("v").cast("decimal(38,0)") * F.col("weight")).alias("s"), F.sum("weight").alias("n"))
        .orderBy("i")
        .collect()
    )
    if not sums:
        return None
    rows = sums[0].n
    if any(r.n != rows for r in sums):
        raise ValueError("the vectors differ in length")
    exact = tuple(int(r.s) for r in sums)
    start = Whitening(rows, exact, 0.0, np.empty(0), np.empty((len(exact), 0)))
    covariance = _gram(distinct.select("x", "weight"), start.centred) / rows
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    real = values > max(values[0], 0.0) * len(exact) * np.finfo(float).eps * 4
    return Whitening(rows, exact, float(np.trace(covariance)), values[real], np.ascontiguousarray(vectors[:, real]))


def _whiten(model: Whitening):
    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                made = pa.array(list(model.whiten(x)), pa.list_(pa.float64()))
                squares = _squares(_deviations(x, model.rows, model.sums))
                deviations = pa.array([Decimal(s) if s < 10**38 else None for s in squares], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([*batch.columns, deviations, made], [*batch.schema.names, "deviation", "whitened"])

    return whiten


def whiten(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    weights: str = "copies",
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """Whitened vectors: ``key``, n, deviation, whitened and explained (arrays by component) and identity_error.

    Rows whose vector is null, empty, or holds an entry that is null or not finite are left out.
    Every other row gives one, also rows with equal or null keys. n is the weight of the fit,
    deviation the exact sum of (n * x - sums)^2 (null beyond 38 digits), identity_error the largest absolute
    entry of the whitened vectors' covariance less the identity. Components without variance are
    left out, so equal vectors give empty arrays and an identity_error of 0. No vectors give no
    rows. Other columns play no part.
    """
    spark = rows.sparkSession
    ship_package(spark)
    vectors = rows.where(usable(F.col(vector))).select(
        F.col(key).alias(key), quantized(F.col(vector), scale, shift).alias("x")
    )
    distinct = settle(distinct_vectors(vectors, weights), "distinct")
    model = fit(distinct, components)
    made = f"{key} {rows.schema[key].dataType.simpleString()}, n long, deviation decimal(38,0), "
    if model is None:
        return spark.createDataFrame([], made + "whitened array<double>, explained array<double>, identity_error double")
    whitened = settle(
        distinct.select("x", "copies", "weight").mapInArrow(
            _whiten(model), "x array<long>, copies long, weight long, deviation decimal(38,0), whitened array<double>"
        ),
        "whitened",
    )
    error = 0.0
    if len(model.values):
        # The last row and column are sums, so the covariance is centred here too.
        total = _gram(whitened.select("whitened", "weight"), _with_ones) / model.rows
        means = total[-1, :-1]
        error = float(np.abs(total[:-1, :-1] - np.outer(means, means) - np.eye(len(means))).max())

    total = whitened.agg(F.sum("copies")).first()[0]
    hot = F.col("copies") * HOT_PART > total
    narrow = ["x", "deviation", "whitened"]
    few = F.broadcast(whitened.where(hot).select(*narrow))
    of_hot = vectors.join(few, "x")
    of_others = vectors.join(F.broadcast(whitened.where(hot).select("x")), "x", "left_anti").join(
        whitened.where(~hot).select(*narrow), "x"
    )
    return of_hot.unionByName(of_others).select(
        key,
        F.lit(model.rows).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(v) for v in model.explained()]).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _with_ones(vectors: np.ndarray) -> np.ndarray:
    return np.concatenate([vectors, np.ones((len(vectors), 1))], axis=1)


def digest(whitened: DataFrame) -> DataFrame:
    """A row for each vector and component, numbered from 1. A deviation beyond a long is null."""
    pairs = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "pair")
    return whitened.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error", pairs).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("pair.whitened").alias("whitened"),
        F.col("pair.explained").alias("explained"),
        "identity_error",
    )
