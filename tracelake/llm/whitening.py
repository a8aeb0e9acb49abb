"""Whitening of embeddings on the leading components of their covariance.

1. Entries become whole numbers ``x = floor(64 * c) + 1000000``.  One pass sums
   them, a second multiplies them around the rounded mean: both sums are of
   whole numbers and exact, so the covariance does not depend on the order of
   tasks, or on tasks that run again.
2. The eigenvectors come from ``feast.leading``: contour integration on
   intervals of the spectrum, with inertia counts that prove none was missed.
   Only the covariance (dimension by dimension) is on the driver.
3. A last pass projects every row; the covariance of what comes out is measured
   over all rows, not assumed.

Sums are made per task in numpy and added up by Spark, entry by entry; no task
holds more than one Arrow batch.  There is no shuffle of rows.

Defined results: rows whose vector is null, or holds a null, a NaN, an infinity
or an entry whose ``x`` does not fit 53 bits, are dropped; so are rows whose
vector is not as long as most (of equal counts, the longest), empty ones
included; repeated rows, equal or null ids are rows of their own; eigenvalues
at rounding level are no components, so a table of equal rows, or an empty one,
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm import feast

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
LIMIT = 2.0**53
EXACT_ROWS = 2048  # rows multiplied in one float product
EXACT_ENTRY = 1 << 20  # of whole numbers below this: the product is exact


@dataclass
class Whitening:
    n: int
    sums: list[int]  # exact, by dimension
    trace: float
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # columns: unit eigenvectors

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace


def id_vector(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    return table.select(
        table[id_col].cast("long").alias("vec_id"), table[vector_col].cast("array<double>").alias("vector")
    )


def whole(batch, d: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, x)`` of the rows of an Arrow batch that stay, for each
    length of vector, or for length ``d`` only."""
    lists = batch.column(1)
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(float)  # null entries: NaN
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(SCALE * values) + OFFSET
        bad = ~(np.abs(x) < LIMIT)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    keep = (lengths > 0) & (np.bincount(owner, bad, len(lengths)) == 0)
    for length in np.unique(lengths[keep]).tolist() if d is None else [d]:
        rows = keep & (lengths == length)
        if rows.any():
            yield np.flatnonzero(rows), x[rows[owner]].astype(np.int64).reshape(-1, length)


def exact_sum(partial: DataFrame) -> DataFrame:
    """Rows of partial sums (``length``, ``n``, ``sums``) added up, by entry."""
    entries = partial.select("length", "n", F.posexplode("sums").alias("pos", "value"))
    return entries.groupBy("length", "pos").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))


def _as_decimals(values) -> list[Decimal]:
    return [Decimal(int(v)) for v in values]


PARTIAL = "length long, n long, sums array<decimal(38,0)>"


def _partial(found: dict[int, tuple[int, np.ndarray]]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(found), pa.int64()),
            pa.array([n for n, _ in found.values()], pa.int64()),
            pa.array([_as_decimals(s) for _, s in found.values()], pa.list_(pa.decimal128(38, 0))),
        ],
        names=["length", "n", "sums"],
    )


def _sums(batches: Iterator) -> Iterator:
    """Per length of vector, the number of rows and the sums of their entries."""
    found: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for rows, x in whole(batch):
            n, old = found.get(x.shape[1], (0, 0))
            found[x.shape[1]] = n + len(rows), old + x.sum(axis=0).astype(object)
    if found:
        yield _partial(found)


def products(y: np.ndarray) -> np.ndarray:
    """The exact sum of the rows' outer products, as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for i in range(0, len(y), EXACT_ROWS):
        part = y[i : i + EXACT_ROWS]
        if np.abs(part).max() < EXACT_ENTRY:
            total += (part.T.astype(float) @ part.astype(float)).astype(np.int64)
        else:
            part = part.astype(object)
            total += part.T @ part
    return total


def fit(table: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening:
    """Mean, covariance and leading components over all rows that stay."""
    vectors = id_vector(table, id_col, vector_col)
    sums: dict[int, dict[int, int]] = {}
    counts: dict[int, int] = {}
    # one row per entry of each length of vector that occurs
    for r in exact_sum(vectors.mapInArrow(_sums, PARTIAL)).collect():
        sums.setdefault(r["length"], {})[r["pos"]] = int(r["value"])
        counts[r["length"]] = r["n"]
    if not counts:
        return Whitening(0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    d = max(counts, key=lambda length: (counts[length], length))
    n, total = counts[d], [sums[d][j] for j in range(d)]
    near = np.array([round(s / n) for s in total], np.int64)  # the mean, rounded
    upper = np.triu_indices(d)

    def multiply(batches: Iterator) -> Iterator:
        rows, held = 0, np.zeros((d, d), object)
        for batch in batches:
            for at, x in whole(batch, d):
                rows += len(at)
                held = held + products(x - near)
        if rows:
            yield _partial({d: (rows, held[upper])})

    # d * (d + 1) / 2 rows, whatever the number of vectors
    second = {r["pos"]: int(r["value"]) for r in exact_sum(vectors.mapInArrow(multiply, PARTIAL)).collect()}
    first = [s - n * int(m) for s, m in zip(total, near, strict=True)]
    covariance = np.zeros((d, d))
    for pos, (i, j) in enumerate(zip(*upper, strict=True)):
        covariance[i, j] = covariance[j, i] = (n * second[pos] - first[i] * first[j]) / (n * n)
    values, columns = feast.leading(covariance, k)
    return Whitening(n, total, float(np.trace(covariance)), values, columns)


def _projector(model: Whitening):
    """A function of ``x`` that gives ``n * x - sums`` (exact) and the whitened
    rows."""
    n = model.n
    near = [s // n for s in model.sums]
    first = [s - n * m for s, m in zip(model.sums, near, strict=True)]
    near_array = np.array(near, np.int64)
    weights = model.vectors / np.sqrt(model.values)

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = x - near_array
        small = n * (int(np.abs(y).max()) + 1) < 1 << 62
        t = n * y - np.array(first, np.int64) if small else n * y.astype(object) - np.array(first, object)
        return t, (t / n).astype(float) @ weights

    return project


def squares(t: np.ndarray) -> list[Decimal]:
    """The exact sum of squares of each row."""
    if t.dtype != object and (int(np.abs(t).max()) ** 2) * t.shape[1] < 1 << 63:
        return _as_decimals((t * t).sum(axis=1))
    t = t.astype(object)
    return _as_decimals((t * t).sum(axis=1))


def whiten(table: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``deviation`` (sum over dimensions of ``(n * x - sum)^2``,
    exact) and ``whitened`` (one number per component) of every row that stays."""
    d = len(model.sums)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        project = _projector(model)
        for batch in batches:
            for rows, x in whole(batch, d):
                t, w = project(x)
                offsets = pa.array(np.arange(len(rows) + 1) * w.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)),
                        pa.array(squares(t), pa.decimal128(38, 0)),
                        pa.ListArray.from_arrays(offsets, pa.array(w.ravel())),
                    ],
                    names=["vec_id", "deviation", "whitened"],
                )

    vectors = id_vector(table, id_col, vector_col)
    if not len(model.values):
        vectors = vectors.limit(0)
    return vectors.mapInArrow(run, "vec_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the
    identity, over all rows (of rows centred before; their own mean, at rounding
    level, is taken out)."""
    k = len(model.values)
    if not k:
        return 0.0

    def multiply(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held = np.zeros(k + k * k)
        for batch in batches:
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            held += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([held.tolist()], pa.list_(pa.float64()))], names=["sums"])

    parts = whitened.select("whitened").mapInArrow(multiply, "sums array<double>")
    added = parts.select(F.posexplode("sums").alias("pos", "value")).groupBy("pos").agg(F.sum("value").alias("value"))
    total = np.zeros(k + k * k)
    for r in added.collect():  # k + k * k rows
        total[r["pos"]] = r["value"]
    mean = total[:k] / model.n
    return float(np.abs(total[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def digest(whitened: DataFrame, model: Whitening, error: float) -> DataFrame:
    """One row per vector and component, with what the model says of it."""
    explained = F.array(*[F.lit(float(e)) for e in model.explained]) if len(model.values) else F.array().cast("array<double>")
    rows = whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "_value"))
    return rows.select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"), F.col("_value").alias("whitened"),
        explained[F.col("_at")].alias("explained"), F.lit(error).alias("identity_error"),
    )
