"""Embedding whitening by QDWH spectral divide and conquer.

Vectors become integers, each different one enters the fit once, and their covariance is summed in
the tasks. That matrix has the size of a vector, squared, whatever the number of rows; its
components are found by spectral divide and conquer: the polar factor of the shifted covariance is
the sign of its eigenvalues, from which follows the projector on the subspace above the shift; the
matrix is rotated into that subspace and its complement, and both are split again until single
components are left. The polar factor comes from the dynamically weighted Halley iteration (QDWH),
with QR steps while the matrix is badly conditioned and Cholesky steps after. Mean and scaled
components are then broadcast, and every row is projected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilelake.llm.common import narrow
from tilelake.session import materialize

SCALE = 256
COMPONENTS = 4
WIDEST = 8192  # entries of a vector, so that a covariance takes 512 MB at most
EPS = np.finfo(float).eps
LARGEST = 2**53  # integers beyond this aren't exact as doubles


# -- polar decomposition and the spectral split ---------------------------------------------------


def polar(a: np.ndarray, smallest: float | None = None) -> np.ndarray:
    """The orthogonal polar factor of a square matrix, by QDWH iterations (six at most for doubles).

    ``smallest`` is a lower bound on the smallest singular value, as a share of the largest.
    """
    n = len(a)
    x = a / (np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf)) or 1.0)
    low = max(smallest or 1e-16, 1e-16)
    eye = np.eye(n)
    for _ in range(30):
        square = min(low, 1.0) ** 2
        d = np.cbrt(4 * (1 - square) / square**2)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack((np.sqrt(wc) * x, eye)))
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        else:
            half = np.linalg.cholesky(eye + wc * x.T @ x)
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(half.T, np.linalg.solve(half, x.T)).T
        low = min(low * (wa + wb * square) / (1 + wc * square), 1.0)
        if abs(1 - low) < 10 * EPS and np.linalg.norm(x - before) <= np.cbrt(5 * EPS):
            break
    return x


def _halves(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below the shift; None if it doesn't split cleanly."""
    n = len(a)
    sign = polar(a - shift * np.eye(n))
    projector = (sign + np.eye(n)) / 2
    above = round(float(np.trace(projector)))
    if not 0 < above < n:
        return None
    # The projector's range: its product with a random block, and once more for the last digits.
    start = np.random.default_rng(n).standard_normal((n, above))
    for _ in range(3):
        basis, _ = np.linalg.qr(projector @ start, mode="complete")
        upper, lower = basis[:, :above], basis[:, above:]
        if np.linalg.norm(lower.T @ a @ upper) <= 30 * EPS * n * np.linalg.norm(a):
            return upper, lower
        start = upper
    return None


def spectrum(a: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix; the first ``wanted`` of them.

    Subspaces that hold none of the wanted ones aren't split. Equal eigenvalues give some basis of
    their space. A vector's largest entry is positive.
    """
    n = len(a)
    wanted = n if wanted is None else min(wanted, n)
    scale = np.linalg.norm(a) or 1.0
    out: list[tuple[float, np.ndarray]] = []
    stack = [(np.eye(n), (a + a.T) / 2)]
    while stack and len(out) < wanted:
        basis, part = stack.pop()
        k = len(part)
        diagonal = np.diag(part)
        if np.linalg.norm(part - np.diag(diagonal)) <= EPS * scale:
            out += sorted(((float(v), basis[:, i]) for i, v in enumerate(diagonal)), key=lambda x: -x[0])
            continue
        middle, spread = float(np.mean(diagonal)), float(np.linalg.norm(part - np.mean(diagonal) * np.eye(k)))
        for shift in (float(np.median(diagonal)), middle, *(middle + f * spread / k for f in (0.1, -0.1, 0.3, -0.3, 0.7, -0.7, 1.3, -1.3))):
            if (halves := _halves(part, shift)) is not None:
                break
        else:
            raise ArithmeticError(f"no shift splits a subspace of {k} components")
        for half in halves[::-1]:  # the upper one comes next
            inner = half.T @ part @ half
            stack.append((basis @ half, (inner + inner.T) / 2))
    values, vectors = np.array([v for v, _ in out[:wanted]]), np.array([w for _, w in out[:wanted]]).T.reshape(n, -1)
    heads = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] if vectors.size else np.ones(0)
    return values, vectors * np.where(heads < 0, -1.0, 1.0)


# -- Spark: integers, fit list, covariance, projection ---------------------------------------------


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * entry) of each entry as a long; null if an entry is null, not finite, or too large."""
    scaled = F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("double"))
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) * scale < LARGEST))
    # The cast is reached by sound vectors only.
    return F.when(F.coalesce(sound, F.lit(False)), F.transform(scaled, lambda c: c.cast("long")))


def _matrix(batch: pa.RecordBatch, width: int, column: str = "x") -> np.ndarray:
    return batch.column(batch.schema.names.index(column)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summed(rows: DataFrame, width: int, centre: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Sum over the rows of the outer product of ``x - centre``, or of its product with ``weights``.

    Each task sums its own rows; the sums meet one matrix row at a time, dealt by its number, so
    what a task adds up is one row of the matrix from each task before it.
    """
    size = width if weights is None else weights.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            part = _matrix(batch, width) - centre
            part = part if weights is None else part @ weights
            total += part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    def join(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(_matrix(b, size, "row").sum(axis=0) for b in batches)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total], pa.list_(pa.float64()))], names=["i", "row"])

    summed = rows.select("x").mapInArrow(add, "i int, row array<double>").groupBy("i").applyInArrow(join, "i int, row array<double>")
    out = np.zeros((size, size))
    for r in summed.collect():  # the matrix: bounded by the vectors' width
        out[r.i] = r.row
    return out


def whiten(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows go whose vector is null, or holds a null, a non-finite entry, or one beyond 2^53 once scaled.
    So do vectors without entries, and, where lengths differ, all but the most frequent length (of
    equally frequent ones the longer). Repeated vectors count once in the fit and each get their rows; repeated and null ids
    stay as they are. Components without variance aren't returned: no rows at all if all vectors are
    alike, or if there are none. Equal eigenvalues share some basis of their space. Other
    columns are ignored. A vector of more than ``WIDEST`` entries, or a deviation that no long
    holds, raises.
    """
    spark = table.sparkSession
    rows = narrow(table, vec_id=id_col, vector=vector_col).select("vec_id", integers(F.col("vector"), scale).alias("x"))
    rows = rows.where(F.size("x") > 0)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = materialize(rows.select("x").distinct(), "fit-vectors")
    lengths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    width = lengths[0].width
    if width > WIDEST:
        raise ValueError(f"vectors of {width} entries; the covariance is made for up to {WIDEST}")
    fit = found.where(F.size("x") == width)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            part = _matrix(batch, width)
            n += len(part)
            # Parts of 512 rows of less than 2^53 each don't overflow; their sums are Python integers.
            total = total + sum((part[i:i + 512].sum(axis=0).astype(object) for i in range(0, len(part), 512)), np.zeros(width, object))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([[str(v) for v in total]], pa.list_(pa.string()))], names=["n", "s"])

    parts = fit.mapInArrow(sums, "n long, s array<string>")
    exact = parts.select("n", F.posexplode("s")).groupBy("pos").agg(F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    n, total = int(exact[0].n), [0] * width
    for r in exact:
        total[r.pos] = int(r.s)
    mean = np.array([t / n for t in total])
    covariance = _summed(fit, width, mean) / n
    values, vectors = spectrum(covariance, components)
    whole = float(np.trace(covariance))
    used = int(np.sum(values > width * EPS * max(whole, 0.0) * 4)) if len(values) else 0
    if not used:
        return spark.createDataFrame([], schema)
    values, weights = values[:used], vectors[:, :used] / np.sqrt(values[:used])
    error = float(np.abs(_summed(fit, width, mean, weights) / n - np.eye(used)).max())
    model = spark.sparkContext.broadcast((n, total, mean, weights, (values / whole).tolist(), error))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, mean, weights, explained, error = model.value
        most = max(map(abs, total))
        for batch in batches:
            x = _matrix(batch, width)
            m = len(x)
            if not m:
                continue
            reach = n * int(max(abs(int(x.min())), abs(int(x.max())))) + most
            if width * reach * reach < 2**63:
                off = n * x - np.array(total, np.int64)
                deviation = (off * off).sum(axis=1)
            else:
                deviation = [sum((n * int(v) - t) ** 2 for v, t in zip(row, total, strict=True)) for row in x.tolist()]
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), used)))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, used + 1, dtype=np.int32), m)), pa.array(np.full(m * used, n)),
                pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), used))), pa.array(((x - mean) @ weights).ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * used, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.size("x") == width).mapInArrow(project, schema)


def report(table: DataFrame) -> DataFrame:
    """The query's columns."""
    return whiten(table)
