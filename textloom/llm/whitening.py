"""Whitening of embeddings by the leading principal components, found by a matrix-free block Lanczos iteration.

The covariance matrix is never formed: a pass over the distinct vectors multiplies a block of directions by the centred data and by its
transpose, task by task, and only that product, of as many rows as a vector has entries, reaches the driver. Each new block is made
orthogonal to all before it, twice. Directions that lose their length on the way (the block broke down) are restarted at random. The
iteration ends when the residuals of the wanted eigenpairs are at rounding level, or when the blocks span the whole space.

Vectors are whole numbers, so counts, sums and deviations are exact. They are held less the rounded mean, which keeps centring exact too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save

#: An entry c becomes floor(STEPS * c) + OFFSET.
STEPS, OFFSET = 64, 1_000_000
#: Entries beyond this have no exact whole number, like those that aren't finite.
MOST = float(2**53) / STEPS
COMPONENTS = 16
#: Eigenvalues below this share of the largest one are rounding: such a component has no variance to be scaled to one.
FLAT = 1e-11
#: Residuals of eigenpairs, as a share of the largest eigenvalue, at which the iteration ends.
RESIDUAL = 1e-14
SEED = 12


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, x (an array of long) of the rows that have a vector of numbers; null vectors, null, infinite and other entries drop a row."""
    vector = F.col(vector_col).cast("array<double>")
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c) <= F.lit(MOST), F.lit(False)))
    kept = rows.filter(F.coalesce(fits & (F.size(vector) > 0), F.lit(False)))
    x = F.transform(vector, lambda c: F.floor(F.lit(float(STEPS)) * c).cast("bigint") + F.lit(OFFSET))
    return kept.select(F.col(id_col).alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of a list column as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _summed(fit: DataFrame, dims: int, shift: np.ndarray | None, mean: np.ndarray | None, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of fit of part(rows, centred), a matrix of the given shape.

    Each task sums up its own rows and hands on one row for each of the matrix's; these are summed by a shuffle, so that the driver gets
    one matrix, however many tasks there are.
    """

    def one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            if b.num_rows:
                total += part((_matrix(b.column(0), dims) - shift).astype(float) - mean)
        i, j = np.indices(shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "v"])

    out = np.zeros(shape)
    sums = fit.mapInArrow(one_task, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    for r in sums.collect():
        out[r.i, r.j] = r.v
    return out


def _orthonormal(block: np.ndarray, basis: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Columns that span what the block adds to the basis, orthogonal to it and to each other. What breaks down is drawn anew.

    At most as many columns come back as the space has left.
    """
    dims, found = len(basis), basis
    for k in range(min(block.shape[1], dims - basis.shape[1])):
        v = block[:, k]
        size = np.linalg.norm(v)
        for _ in range(5):
            v = v / size if size > 0 else v
            for _ in range(2):
                v = v - found @ (found.T @ v)
            if np.linalg.norm(v) > 1e-8:
                break
            v = draw.standard_normal(dims)
            size = np.linalg.norm(v)
        v = v / np.linalg.norm(v)
        v = v - found @ (found.T @ v)
        found = np.column_stack([found, v / np.linalg.norm(v)])
    return found[:, basis.shape[1] :]


def leading_eigenpairs(times: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, block: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns. times: the matrix times a block."""
    wanted, draw = min(wanted, dims), np.random.default_rng(seed)
    basis, images = np.empty((dims, 0)), np.empty((dims, 0))
    new = draw.standard_normal((dims, min(max(block, wanted), dims)))
    while True:
        new = _orthonormal(new, basis, draw)
        image = times(new)
        basis, images = np.column_stack([basis, new]), np.column_stack([images, image])
        small = basis.T @ images
        values, inner = np.linalg.eigh((small + small.T) / 2)
        values, inner = values[::-1][:wanted], inner[:, ::-1][:, :wanted]
        residual = np.linalg.norm(images @ inner - (basis @ inner) * values, axis=0)
        if basis.shape[1] == dims or residual.max() <= RESIDUAL * max(values[0], np.finfo(float).tiny):
            vectors = basis @ inner
            vectors = vectors / np.linalg.norm(vectors, axis=0)
            # Either sign is an eigenvector: the largest entry is made positive.
            return values, vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(wanted)] < 0, -1.0, 1.0)
        new = image


class Whitener:
    """What the driver holds of the fit: n, the sums S, and the components. Its size depends on the vectors' length alone."""

    def __init__(self, fit: DataFrame, dims: int, components: int):
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total = 0, np.zeros(dims, dtype=object)
            for b in batches:
                if b.num_rows:
                    n, near = n + b.num_rows, _matrix(b.column(0), dims) - OFFSET
                    fits = int(np.abs(near).max(initial=0)) * b.num_rows < 2**63
                    total += (near if fits else near.astype(object)).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, dims)), pa.array([str(int(s)) for s in (n, *total)])], ["i", "s"])

        exact = fit.mapInArrow(sums, "i bigint, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
        self.sums = {r.i: int(r.s) for r in exact}
        self.dims, self.n = dims, self.sums.pop(-1, 0)
        self.values, self.vectors, self.trace, self.error = np.empty(0), np.empty((dims, 0)), 0.0, 0.0
        if not self.n:
            return
        above = [self.sums[i] for i in range(dims)]  # of x less OFFSET
        middle = [round(s / self.n) for s in above]
        self.shift = np.array([m + OFFSET for m in middle], dtype=np.int64)
        self.rest = [s - self.n * m for s, m in zip(above, middle, strict=True)]  # S less n * shift, exact
        self.mean = np.array([r / self.n for r in self.rest])
        over = lambda shape, part: _summed(fit, dims, self.shift, self.mean, shape, part) / self.n
        self.trace = float(over((1, 1), lambda c: np.array([[(c * c).sum()]]))[0, 0])
        block = min(max(components, 1), dims)
        values, vectors = leading_eigenpairs(lambda q: over((dims, q.shape[1]), lambda c: c.T @ (c @ q)), dims, components, block)
        kept = values > FLAT * max(values[0], 0.0) if len(values) else np.empty(0, dtype=bool)
        self.values, self.vectors = values[kept], vectors[:, kept]
        k = len(self.values)
        if k:
            scaled = self.vectors / np.sqrt(self.values)
            second = over((k + 1, k), lambda c: np.vstack([(w := c @ scaled).T @ w, w.sum(axis=0, keepdims=True)]))
            self.error = float(np.abs(second[:k] - np.outer(second[k], second[k]) - np.eye(k)).max())

    def rows(self, x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """The deviation of each vector, null where it doesn't fit a long; and its whitened components."""
        near = x - self.shift
        whitened = (near.astype(float) - self.mean) @ (self.vectors / np.sqrt(self.values)) if len(self.values) else np.empty((len(x), 0))
        most = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if self.dims * most * most < 2**63:
            return ((self.n * near - np.array(self.rest, dtype=np.int64)) ** 2).sum(axis=1).tolist(), whitened
        exact = [sum((self.n * v - r) ** 2 for v, r in zip(row, self.rest, strict=True)) for row in near.tolist()]
        return [d if d < 2**63 else None for d in exact], whitened


OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows without a vector, or with an entry that is null, not finite or beyond MOST, are dropped; so are empty vectors and those of another
    length than the commonest (of equally common ones the longest), as they lie in another space. Rows that repeat come out as often. The fit
    counts each distinct vector once. Components without variance are left out: a single distinct vector gives no rows, nor does an empty
    table. A deviation that no long holds is null. Other columns aren't read.
    """
    vectors = whole_vectors(rows, id_col, vector_col)
    lengths = vectors.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    dims = usual[0].dims if usual else 0
    vectors = vectors.filter(F.size("x") == dims)
    fit = save(vectors.select("x").distinct(), "fit")
    w = Whitener(fit, dims, components)
    explained = w.values / w.trace if w.trace > 0 else w.values
    n, error, k = w.n, w.error, len(w.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows or not k:
                continue
            deviation, whitened = w.rows(_matrix(b.column(1), dims))
            each = np.repeat(np.arange(b.num_rows), k)
            size = len(each)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)), pa.array(np.full(size, n, dtype=np.int64)),
                    pa.array(deviation, pa.int64()).take(pa.array(each)), pa.array(whitened.ravel()), pa.array(np.tile(explained, b.num_rows)), pa.array(np.full(size, error)),
                ],
                [c.split()[0] for c in OUT.split(", ")],
            )

    return vectors.mapInArrow(project, OUT)
