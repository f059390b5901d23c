"""Whitening of embeddings, fitted on distinct vectors weighted by their multiplicity.

Vectors become whole numbers, identical ones are grouped and counted, and everything after that
works on the distinct vectors: sums and the centred covariance (a weighted matrix product in
each task, added up over the tasks), the projection onto the unit eigenvectors of the covariance
and the division by the roots of their eigenvalues.  The results go back to the rows by a join on
the vector.  The weight of a distinct vector is its count, so the fit equals one over all rows, or
one, so copies do not pull the axes towards them.

A vector that many rows hold would put them all in one task of that join.  Vectors held by more
than a thousandth of the rows, of which there are at most a thousand, are therefore joined as a
broadcast of that size; all others meet their rows by a shuffle.

Every step is written to the shared folder, so a lost executor redoes its own part only.  The
driver holds, for each length of vectors, a covariance matrix and the axes kept, as any principal
component model does; neither grows with the rows.

Defined results
---------------
* rows whose vector is null, empty, or holds a null or non-finite component take no part.  A null
  id stays null.
* vectors of different lengths are whitened apart: each length has its own count, mean and axes.
* repeated rows: each gets its own result rows.
* components with an eigenvalue of no more than 1e-12 of the trace have no direction to whiten and
  are left out; identical vectors alone give no row.  Equal eigenvalues come in the order of the
  eigensolver.  Of the two signs of a component the one whose largest entry is positive is taken.
* ``deviation`` is exact at any size (decimal).
* further columns of the input are ignored; an empty table gives an empty result.
* very long vectors: a task holds one matrix of the squared length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import written

HOT_SHARE = 1000
ROWS_AT_ONCE = 4096
RANK_TOLERANCE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """A component c becomes floor(scale * c) + shift; ``weight`` is "count" or "one"."""

    scale: int = 1024
    shift: int = 100_000
    components: int = 8
    weight: str = "count"


def whole_vectors(table: DataFrame, cfg: Whitening = Whitening()) -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where((F.size("v") > 0) & F.forall("v", finite))
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * cfg.scale).cast("long") + F.lit(cfg.shift)).alias("x"))


def by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the vectors of each length in a batch, a bounded number at once."""
    vectors = batch.column(column)
    starts = vectors.offsets.to_numpy()
    values = vectors.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(starts)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        for i in range(0, len(rows), ROWS_AT_ONCE):
            part = rows[i:i + ROWS_AT_ONCE]
            yield part, values[starts[part][:, None] + np.arange(size)]


def totals(vectors: DataFrame, column: str, kind: str) -> dict[int, tuple[int, np.ndarray]]:
    """Per length the sum of the weights and the weighted sum of ``column``.

    ``kind`` is long (exact sums) or double.  A task gives one row for each length."""
    number = np.int64 if kind == "long" else np.float64

    def run(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for rows, matrix in by_length(batch, column):
                own = sums.setdefault(matrix.shape[1], [0, np.zeros(matrix.shape[1], number)])
                own[0] += int(weights[rows].sum())
                own[1] += weights[rows].astype(number) @ matrix.astype(number)
        if sums:
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array(list(sums), pa.int32()), "n": pa.array([n for n, _ in sums.values()], pa.int64()),
                "total": pa.array([t.tolist() for _, t in sums.values()], pa.list_(pa.from_numpy_dtype(number)))})
    parts = vectors.select(column, "weight").mapInArrow(run, f"dim int, n long, total array<{kind}>")
    entries = parts.select("dim", "n", F.posexplode("total"))
    found = entries.groupBy("dim", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("s")).groupBy("dim").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "s"))).alias("s"))
    return {r.dim: (r.n, np.array([e.s for e in r.s], number)) for r in found.collect()}


def covariances(vectors: DataFrame, column: str, kind: str) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per length (n, S, V): the sum of the weights, the weighted sum, and the covariance with divisor n.

    The mean is taken off before vectors are multiplied.  Each task adds up one matrix for each
    length; the rows of the matrices are then summed by Spark.
    """
    sums = totals(vectors, column, kind)
    means = {dim: s / n for dim, (n, s) in sums.items()}

    def run(batches):
        products: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for rows, matrix in by_length(batch, column):
                dim = matrix.shape[1]
                centred = matrix - means[dim]
                products[dim] = products.get(dim, 0.0) + (centred * weights[rows, None]).T @ centred
        for dim, product in products.items():
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([dim] * dim, pa.int32()), "line": pa.array(range(dim), pa.int32()),
                "product": pa.array(product.tolist(), pa.list_(pa.float64()))})
    parts = vectors.select(column, "weight").mapInArrow(run, "dim int, line int, product array<double>")
    lines = parts.select("dim", "line", F.posexplode("product")).groupBy("dim", "line", "pos").agg(F.sum("col").alias("s"))
    rows = lines.groupBy("dim", "line").agg(F.sort_array(F.collect_list(F.struct("pos", "s"))).alias("s")).collect()
    found = {dim: (n, s, np.zeros((dim, dim))) for dim, (n, s) in sums.items()}
    for r in rows:
        found[r.dim][2][r.line] = [e.s / sums[r.dim][0] for e in r.s]
    return found


@dataclass(frozen=True)
class Axes:
    """The fit for one length: n, S, the components as columns, their eigenvalues and the trace."""

    n: int
    total: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float

    @classmethod
    def of(cls, n: int, total: np.ndarray, covariance: np.ndarray, limit: int) -> Axes:
        covariance = (covariance + covariance.T) / 2
        values, components = np.linalg.eigh(covariance)
        trace = float(np.trace(covariance))
        kept = [i for i in reversed(range(len(values))) if values[i] > RANK_TOLERANCE * trace][:limit]
        components = components[:, kept]
        signs = np.sign(components[np.abs(components).argmax(0), np.arange(len(kept))])
        return cls(n, total, components * signs, values[kept], trace)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.total / self.n) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum of (n*x - S)^2 of each row of ``x``, exact."""
        widest = max(int(self.n) * int(abs(x).max()), int(abs(self.total).max())) * 2
        if widest ** 2 * x.shape[1] < 2 ** 63:
            off = x * self.n - self.total
            return (off * off).sum(1).tolist()
        if widest < 2 ** 63:
            off = (x * self.n - self.total).astype(object)
        else:
            off = x.astype(object) * int(self.n) - self.total.astype(object)
        return (off * off).sum(1).tolist()


def whitened_distinct(distinct: DataFrame, axes: dict[int, Axes]) -> DataFrame:
    """Adds ``whitened`` (one entry for each component) and ``deviation`` to the distinct vectors."""
    def run(batches):
        for batch in batches:
            white: list = [None] * batch.num_rows
            off: list = [None] * batch.num_rows
            for rows, x in by_length(batch, "x"):
                own = axes[x.shape[1]]
                for i, w, d in zip(rows.tolist(), own.whiten(x).tolist(), own.deviations(x), strict=True):
                    white[i], off[i] = w, Decimal(d)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(white, pa.list_(pa.float64())), pa.array(off, pa.decimal128(38, 0))],
                names=[*batch.schema.names, "whitened", "deviation"])
    return distinct.mapInArrow(run, "x array<long>, copies long, weight long, whitened array<double>, deviation decimal(38,0)")


def joined_back(rows: DataFrame, found: DataFrame, hot_share: int) -> DataFrame:
    """``rows`` (vec_id, x) with the columns that ``found`` has for each distinct x and its copies."""
    total = found.agg(F.sum("copies")).first()[0] or 0
    is_hot = F.col("copies") > F.lit(total // hot_share)
    hot, rest = found.where(is_hot), found.where(~is_hot)
    if hot.isEmpty():
        return rows.join(rest, "x")
    few = F.broadcast(hot)              # at most hot_share vectors
    return rows.join(few, "x").unionByName(rows.join(F.broadcast(hot.select("x")), "x", "left_anti").join(rest, "x"))


def whiten(table: DataFrame, cfg: Whitening = Whitening(), hot_share: int = HOT_SHARE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of ``table``
    (vec_id, embedding): a row for each vector and component."""
    if cfg.weight not in ("count", "one"):
        raise ValueError(f"weight is count or one, not {cfg.weight}")
    spark = table.sparkSession
    rows = written(whole_vectors(table, cfg), "whole-vectors")
    weight = F.col("copies") if cfg.weight == "count" else F.lit(1).cast("long")
    distinct = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")).select("x", "copies", weight.alias("weight"))
    distinct = written(distinct, "distinct-vectors")
    axes = {dim: Axes.of(*fit, cfg.components) for dim, fit in covariances(distinct, "x", "long").items()}
    found = written(whitened_distinct(distinct, axes), "whitened-vectors")

    # How far the whitened vectors are from uncorrelated ones of variance 1, measured on themselves.
    errors = {}
    for dim, own in axes.items():
        if len(own.values):
            fit = covariances(found.where(F.size("x") == dim), "whitened", "double")[len(own.values)]
            errors[dim] = float(np.abs(fit[2] - np.eye(len(own.values))).max())
    model = [(dim, i + 1, own.n, float(own.values[i] / own.trace), errors[dim]) for dim, own in axes.items() for i in range(len(own.values))]
    model = spark.createDataFrame(model, "dim int, component int, n long, explained double, identity_error double")
    out = joined_back(rows, found, hot_share).select("vec_id", F.size("x").alias("dim"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    out = out.withColumn("component", F.col("at") + 1).join(F.broadcast(model), ["dim", "component"])
    return out.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
