"""Whitening of embeddings by spectral divide and conquer over QDWH polar decompositions.

Vectors become integers x = floor(64 c) + 1000000. Two passes over the fit list, which is every usable
vector, give its sums and then its covariance, centred before multiplying; each task sends one matrix,
and these are summed by row number in Spark, so the driver gets one matrix of the dimension's size.

The polar factor of the covariance less a shift is the matrix's sign: its eigenvectors lie above or
below the shift, and (sign + 1) / 2 projects on the upper ones. QDWH finds it in a few iterations, with
weights that follow a bound of the smallest singular value. Bases of both subspaces split the covariance
into two smaller ones, which are split in turn until single components are left; a part that is a
multiple of the identity is split no further. The components, by falling variance, are
broadcast and every vector is projected on them.

Rows whose vector is NULL or empty or holds a NULL or non-finite entry are dropped, as are vectors of
another length than the commonest (of equally common ones the longest), which span another space. Repeated
rows count each; an empty table, and components without variance, give no rows. `deviation` is exact
and NULL where it does not fit 64 bits. Entries beyond 2^50 in size, which have no sensible place in whole numbers here, are held at
that bound. Other columns are not looked at, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, written

STEPS, ORIGIN = 64, 1_000_000
COMPONENTS = 32
LARGEST = float(1 << 50)
#: Partial matrices that one task adds up.
FAN_IN = 64
_EPS = np.finfo(float).eps


def qdwh_sign(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley steps of QR and then Cholesky form."""
    scale = np.linalg.norm(matrix, 2) if len(matrix) <= 32 else np.sqrt(np.linalg.norm(matrix, 1) * np.linalg.norm(matrix, np.inf))
    if not scale:
        return np.eye(len(matrix))
    x, size = matrix / scale, len(matrix)
    bound = 1 / max(1.0, np.linalg.cond(x, 1)) / np.sqrt(size)
    bound = min(1.0, max(float(bound), _EPS))
    for _ in range(12):
        d = np.cbrt(4 * (1 - bound**2) / bound**4) if bound < 1 else 0.0
        a = np.sqrt(1 + d) + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - bound**2) / (bound**2 * np.sqrt(1 + d))))
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        if c > 100:
            q, _r = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(size)]))
            after = b / c * x + (a - b / c) / np.sqrt(c) * q[:size] @ q[size:].T
        else:
            w = np.linalg.cholesky(np.eye(size) + c * x.T @ x)
            after = b / c * x + (a - b / c) * np.linalg.solve(w.T, np.linalg.solve(w, x.T)).T
        after = (after + after.T) / 2
        bound = min(1.0, bound * (a + b * bound**2) / (1 + c * bound**2))
        change, x = np.linalg.norm(after - x), after
        if abs(1 - bound) < 10 * _EPS and change < np.cbrt(10 * _EPS):
            break
    return x


def _range(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of its complement: its largest columns first, then one step of iteration."""
    left = projector.copy()
    chosen = []
    for _ in range(rank):
        norms = (left**2).sum(axis=0)
        k = int(norms.argmax())
        chosen.append(k)
        v = left[:, k] / np.sqrt(norms[k])
        left -= np.outer(v, v @ left)
    first, _r = np.linalg.qr(projector[:, chosen])
    first, _r = np.linalg.qr(projector @ first)
    whole, _r = np.linalg.qr(np.hstack([first, np.eye(len(projector))]))
    return first, whole[:, rank:]


def _shifts(matrix: np.ndarray) -> Iterator[float]:
    """Places to split at: the middle of the diagonal, the mean of the eigenvalues, then points around it."""
    diagonal = np.sort(np.diag(matrix))
    mean, spread = diagonal.mean(), np.linalg.norm(matrix - np.eye(len(matrix)) * diagonal.mean()) / np.sqrt(len(matrix))
    yield float(np.median(diagonal))
    for step in (0, 0.1, -0.1, 0.3, -0.3, 0.03, -0.03, 0.01, -0.01):
        yield float(mean + step * spread)


def spectral_split(matrix: np.ndarray, floor: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors (columns) of a symmetric matrix, by recursive splitting; in no order."""
    size = len(matrix)
    floor = 8 * _EPS * np.linalg.norm(matrix) if floor is None else floor
    mean = np.trace(matrix) / max(1, size)
    if size <= 1 or np.abs(matrix - mean * np.eye(size)).max() <= floor:
        return np.diag(matrix).copy(), np.eye(size)
    best = None
    for shift in _shifts(matrix):
        sign = qdwh_sign(matrix - shift * np.eye(size))
        projector = (sign + np.eye(size)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < size:
            continue
        upper, lower = _range(projector, rank)
        off = np.abs(upper.T @ matrix @ lower).max()
        if best is None or off < best[0]:
            best = off, upper, lower
        if off <= 4 * size * floor:
            break
    if best is None:
        return np.diag(matrix).copy(), np.eye(size)
    found = []
    for basis in best[1:]:
        part = basis.T @ matrix @ basis
        values, vectors = spectral_split((part + part.T) / 2, floor)
        found.append((values, basis @ vectors))
    return np.concatenate([f[0] for f in found]), np.hstack([f[1] for f in found])


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors with their largest entry positive; one refinement takes out what the splits have left."""
    _values, vectors = spectral_split(matrix)
    vectors, _r = np.linalg.qr(vectors)
    values = np.diag(vectors.T @ matrix @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    inner = vectors.T @ matrix @ vectors
    gap = values[None, :] - values[:, None]
    wide = np.abs(gap) > 1e3 * np.sqrt(_EPS) * max(1e-300, np.abs(values).max(initial=0.0))
    vectors = vectors @ (np.eye(len(values)) + np.where(wide, inner / np.where(wide, gap, 1.0), 0.0))
    vectors, _r = np.linalg.qr(vectors)
    values = np.diag(vectors.T @ matrix @ vectors).copy()
    largest = np.abs(vectors).argmax(axis=0) if len(values) else []
    return values, vectors * np.where(vectors[largest, np.arange(len(values))] < 0, -1.0, 1.0)


def whole_numbers(column: pa.Array, dimension: int) -> np.ndarray:
    """The vectors as rows of long integers."""
    entries = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), dimension)
    return np.floor(np.clip(STEPS * entries, -LARGEST, LARGEST)).astype(np.int64) + ORIGIN


def _sum_rows(rows: DataFrame) -> DataFrame:
    """(row, values) summed by row: of up to FAN_IN tasks at a time in two rounds, then of what is left, so that no task gets all of a row's parts."""
    kind = "row int, part long, values binary"

    def add(parts: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(v, dtype=np.float64) for v in parts["values"].to_pylist()], axis=0)
        return pa.table({"row": parts["row"].slice(0, 1), "part": parts["part"].slice(0, 1), "values": pa.array([total.tobytes()], type=pa.binary())})

    summed = rows
    for _ in range(2):
        summed = summed.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("row", "part").applyInArrow(add, kind)
    return summed.withColumn("part", F.lit(0).cast("long")).groupBy("row", "part").applyInArrow(add, kind)


def _matrix(rows: DataFrame, size: int) -> np.ndarray:
    """A matrix of the dimension's size on the driver."""
    total = np.zeros((size, size))
    for r in _sum_rows(rows).collect():
        total[r["row"]] = np.frombuffer(r["values"], dtype=np.float64)
    return total


def _partials(vectors: DataFrame, convert, width: int) -> DataFrame:
    """Each task's sum of outer products of `convert(batch)`, a row of it a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((width, width))
        for batch in batches:
            y = convert(batch.column(0))
            total += y.T @ y
        part = pa.array([TaskContext.get().partitionId()] * width, type=pa.int64())
        rows = pa.array([r.tobytes() for r in total], type=pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(range(width), type=pa.int32()), part, rows], names=["row", "part", "values"])

    return vectors.mapInArrow(run, "row int, part long, values binary")


@dataclass
class Whitening:
    """What every task needs: the fit list's size, its exact sums, and the components as rows over the root of their variance."""

    n: int
    sums: list[int]
    rows: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        """S / n, its whole part in exact arithmetic, so that the origin takes no figures away."""
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return ((x - whole) - rest) @ self.rows.T


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows that whitening keeps, with the vector as `_v`, of the commonest length."""
    entry = F.col(vector).cast("array<double>")
    fine = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return rows.where(fine).withColumn("_v", entry)


def deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Exact sums of (n x - S)^2; None beyond 64 bits."""
    largest = max(int(np.abs(x).max(initial=0)) * model.n, max(map(abs, model.sums), default=0)) if len(x) else 0
    if largest < 1 << 61:
        y = x * model.n - np.array(model.sums, dtype=np.int64)
        if int(np.abs(y).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
            return (y * y).sum(axis=1).tolist()
    exact = [sum((model.n * int(v) - s) ** 2 for v, s in zip(row, model.sums)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[Whitening | None, DataFrame]:
    """The whitening of all usable vectors, and the rows it holds for, written; None where there is no vector."""
    bounded_batches(rows.sparkSession)
    kept = written(usable(rows, vector), "vectors")
    lengths = kept.groupBy(F.size("_v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return None, kept
    d, n = lengths["d"], lengths["n"]
    kept = kept.where(F.size("_v") == d)
    vectors = kept.select("_v")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums of one batch fit 64 bits and are added up by Spark as decimals.
        for batch in batches:
            sums = whole_numbers(batch.column(0), d).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(range(d), type=pa.int32()), pa.array(sums)], names=["i", "s"])

    summed = vectors.mapInArrow(add, "i int, s bigint").groupBy("i").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s")).collect()
    sums = [int(r["s"]) for r in sorted(summed, key=lambda r: r["i"])]
    model = Whitening(n, sums, np.eye(d), np.ones(d), np.ones(d))
    covariance = _matrix(_partials(vectors, lambda c: model.whiten(whole_numbers(c, d)), d), d) / n
    values, found = eigen((covariance + covariance.T) / 2)
    total = float(np.trace(covariance))
    real = values > d * _EPS * max(0.0, values.max(initial=0.0))
    values, found = values[real][:components], found[:, real][:, :components]
    model = Whitening(n, sums, (found / np.sqrt(values)).T, values, values / total if total else values)
    if len(values):
        # The last column of ones gives the sums, so the whitened vectors are centred on their own mean.
        def with_ones(column: pa.Array) -> np.ndarray:
            w = model.whiten(whole_numbers(column, d))
            return np.hstack([w, np.ones((len(w), 1))])

        k = len(values)
        moments = _matrix(_partials(vectors, with_ones, k + 1), k + 1) / n
        inner = moments[:k, :k] - np.outer(moments[:k, k], moments[:k, k])
        model.identity_error = float(np.abs(inner - np.eye(k)).max())
    return model, kept


def whiten(rows: DataFrame, model: Whitening | None, key: str = "vec_id") -> DataFrame:
    """For rows of `fit`: a row for each component, with `deviation`, `whitened`, `explained` and `identity_error`."""
    kind = f"vec_id {dict(rows.dtypes)[key]}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    if model is None or not len(model.variances):
        return spark.createDataFrame([], kind)
    shared = spark.sparkContext.broadcast(model)
    d, k = len(model.sums), len(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            x, many = whole_numbers(batch.column(1), d), batch.num_rows
            each = pa.array(np.repeat(np.arange(many), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * k, own.n, dtype=np.int64)),
                    pa.array(deviations(x, own), type=pa.int64()).take(each),
                    pa.array(own.whiten(x).reshape(-1)),
                    pa.array(np.tile(own.explained, many)),
                    pa.array(np.full(many * k, own.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select(F.col(key).alias("vec_id"), "_v").mapInArrow(run, kind)


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit on all usable rows, then whiten them."""
    model, kept = fit(rows.select(F.col(key).alias("vec_id"), F.col(vector).alias("embedding")), components=components)
    return whiten(kept, model)
