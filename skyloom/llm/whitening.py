"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows of all different vectors are the matrix X. Each step takes one pass over them: the
tasks work out their part of the left vector ``u = X w``, of ``X' u``, of ``u' u`` and of the products of
``u`` with all earlier left vectors, and only these sums leave them. Left vectors are as long as the
table and stay there: each is X times a short vector, which the driver keeps, so the driver's part of the
work is as small as the vectors are wide. Both sides are reorthogonalised in full. The singular
values and vectors of the small bidiagonal matrix give deviations and components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.embeddings import usable_vectors
from skyloom.storage import discard, written

#: A run has converged when the residual of each wanted value is this small beside the largest.
CLOSE = 1e-14
#: The run that looks for values the first one missed.
ROUGH = 1e-7

_LOWEST, _HIGHEST = -(2.0**63), 2.0**63 - 1024


def whiten(
    vectors: DataFrame,
    components: int = 4,
    scale: float = 256.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of vectors.

    Every number ``c`` counts as ``x = floor(scale * c)``, a long (beyond its range the nearest long).
    The fit list holds each different vector once: ``n`` vectors with sums ``S``. Components are the
    unit eigenvectors of its covariance (divisor ``n``) by falling eigenvalue ``e``, with the largest
    entry positive. For each row and component: ``deviation`` is the sum of ``(n * x - S)^2``, exact,
    ``whitened`` the centred row's part along the component over ``sqrt(e)``, ``explained`` the share of
    ``e`` in the trace, ``identity_error`` the largest entry, unsigned, of the whitened fit list's
    covariance minus the identity.

    Left out are rows whose vector is null or empty or holds a null or a number that is not finite.
    Repeated rows come back each. Vectors of different lengths have fits of their own. Directions
    without spread, beyond rounding, are no components, so equal vectors give no rows, nor does an
    empty table. Other columns are left out.
    """
    spark = vectors.sparkSession
    chosen = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector")
    ).where("vector IS NOT NULL")
    whole = chosen.select("vector").mapInArrow(_numbers(scale), "width int, numbers binary")
    fit = written(whole.distinct(), "whitening-fit")
    fits = {}
    for width, n in sorted((r["width"], r["count"]) for r in fit.groupBy("width").count().collect()):
        fits[width] = _fitted(fit.where(F.col("width") == width).select("numbers"), width, n, components)
    discard(fit)
    fits = spark.sparkContext.broadcast(fits)
    return chosen.mapInArrow(
        _whitened(fits, scale),
        "vec_id long, component int, n long, deviation decimal(38,0), whitened double,"
        " explained double, identity_error double",
    )


@dataclass
class Fit:
    """Count and sums of the fit list, and its components."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def _whole(found: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * found), _LOWEST, _HIGHEST).astype("<i8")


def _numbers(scale: float) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found in usable_vectors(batch["vector"]):
                rows = [row.tobytes() for row in _whole(found, scale)]
                width = np.full(len(rows), found.shape[1], np.int32)
                yield pa.record_batch(
                    [pa.array(width), pa.array(rows, pa.binary())], ["width", "numbers"]
                )

    return read


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, width)


def spread(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: 64-bit numbers where they fit, Python's elsewhere."""
    largest = max(abs(int(rows.min())), abs(int(rows.max()))) if rows.size else 0
    if n * largest + max(map(abs, sums), default=0) < 2**63:
        return n * rows - np.array(sums, np.int64)
    return n * rows.astype(object) - np.array(sums, object)


def deviations(spreads: np.ndarray) -> list[int]:
    """Sums of squares of the rows, exact."""
    if spreads.dtype != object and spreads.size:
        largest = max(abs(int(spreads.min())), abs(int(spreads.max())))
        if largest**2 * spreads.shape[1] < 2**63:
            return (spreads * spreads).sum(axis=1).tolist()
    return [sum(int(x) ** 2 for x in row) for row in spreads.tolist()]


def _fitted(fit: DataFrame, width: int, n: int, components: int) -> Fit:
    sums = _sums(fit, width)

    def added(part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all rows of what ``part`` makes of some centred rows."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                if batch.num_rows:
                    rows = spread(_matrix(batch["numbers"], width), n, sums)
                    total = total + part((rows / n).astype(float))
            if not np.isscalar(total):
                places = pa.array(np.arange(len(total), dtype=np.int32))
                yield pa.record_batch([places, pa.array(total)], ["place", "value"])

        found = fit.mapInArrow(work, "place int, value double")
        found = found.groupBy("place").agg(F.sum("value").alias("value")).collect()
        return np.array([r["value"] for r in sorted(found)])

    trace = float(added(lambda x: np.array([(x * x).sum()]))[0])
    none = np.zeros((0, width))
    if not trace > 0:
        return Fit(n, sums, none, none[:, 0], none[:, 0], 0.0)
    found = leading(added, width, components)
    floor = width * np.finfo(float).eps * max(value for value, _ in found)
    found = [(value, vector) for value, vector in found if value > floor]
    values = np.array([value for value, _ in found]) ** 2 / n
    vectors = np.array([v * np.sign(v[np.argmax(np.abs(v))]) for _, v in found])
    turn = vectors.T / np.sqrt(values)
    mean = added(lambda x: (x @ turn).sum(axis=0)) / n
    products = added(lambda x: ((x @ turn - mean).T @ (x @ turn - mean)).reshape(-1))
    error = np.abs(products.reshape(len(values), -1) / n - np.eye(len(values))).max()
    return Fit(n, sums, vectors, values, values * n / trace, float(error))


def _sums(fit: DataFrame, width: int) -> list[int]:
    """The exact sums of the dimensions."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch["numbers"], width)
                high, low = rows >> 32, rows & 0xFFFFFFFF
                for i, (h, l) in enumerate(zip(high.sum(axis=0), low.sum(axis=0))):
                    total[i] += (int(h) << 32) + int(l)
        places = pa.array(range(width), pa.int32())
        yield pa.record_batch([places, pa.array(total, pa.decimal128(38))], ["place", "value"])

    found = fit.mapInArrow(work, "place int, value decimal(38,0)")
    found = found.groupBy("place").agg(F.sum("value").alias("value")).collect()
    return [int(r["value"]) for r in sorted(found)]


def leading(added: Callable, width: int, count: int) -> list[tuple[float, np.ndarray]]:
    """The ``count`` largest singular values and right vectors of the rows that ``added`` runs over.

    One starting vector meets every value but not its multiples, so another run, orthogonal to all
    vectors found, looks for a value as large as the least of them; runs go on until one finds none.
    """
    found: list[tuple[float, np.ndarray]] = []
    while len(found) < width:
        fixed = np.array([v for _, v in found]).reshape(-1, width)
        wanted = min(count, width - len(found))
        checking = len(found) >= count
        run = _Run(added, fixed, width, len(found))
        triples = run.until(1 if checking else wanted, ROUGH if checking else CLOSE)
        if checking and triples[0][0] < found[count - 1][0] * (1 - 1e-9):
            break
        if checking and triples[0][0] <= width * np.finfo(float).eps * found[0][0]:
            break
        if checking:  # a value that was missed: find it to the full
            triples = run.until(1, CLOSE)
        found = sorted(found + triples[:wanted], key=lambda t: -t[0])
        if run.exhausted and len(fixed) == 0 and run.steps == width:
            break
    return found[:count]


class _Run:
    """Bidiagonalisation from one starting vector, orthogonal to the ``fixed`` right vectors."""

    def __init__(self, added: Callable, fixed: np.ndarray, width: int, seed: int):
        self.added, self.fixed, self.width = added, fixed, width
        self.rights: list[np.ndarray] = []  # right vectors, orthonormal
        self.makers: list[np.ndarray] = []  # left vectors are the rows times these
        self.pulled: list[np.ndarray] = []  # the transposed rows times the left vectors
        self.alphas: list[float] = []
        self.betas: list[float] = []
        self.exhausted = False
        self.steps = 0
        self._random = np.random.default_rng(1 + seed)
        self.next = self._orthogonal(self._random.standard_normal(width))

    def _orthogonal(self, vector: np.ndarray) -> np.ndarray:
        basis = np.vstack([self.fixed, *self.rights]) if self.rights else self.fixed
        for _ in range(2):
            vector = vector - basis.T @ (basis @ vector)
        length = np.linalg.norm(vector)
        return vector / length if length > 0 else vector

    def until(self, wanted: int, close: float) -> list[tuple[float, np.ndarray]]:
        """Steps until the ``wanted`` largest values stand."""
        while True:
            if self.rights:
                values, vectors, rest = self._values()
                enough = len(values) >= wanted
                if self.exhausted or enough and (rest[:wanted] <= close * values[0]).all():
                    return list(zip(values[:wanted].tolist(), vectors[:wanted]))
            self._step()

    def _step(self) -> None:
        maker = self.next.copy()
        if self.betas:
            maker = maker - self.betas[-1] * self.makers[-1]
        earlier = np.array(self.makers).reshape(-1, self.width)
        for _ in range(3):  # until nothing of the earlier left vectors is in the new one
            maker, size, pulled, overlap = self._product(maker, earlier)
            if not len(overlap) or np.abs(overlap).max() <= 1e-13 * max(size, 1e-300):
                break
            maker = maker - overlap @ earlier
        self.rights.append(self.next)
        self.steps += 1
        largest = max([*self.alphas, size, 1e-300])
        if size <= 1e-14 * largest:  # the rows have nothing along this vector
            self.alphas.append(0.0)
            self.betas.append(0.0)
            self.makers.append(np.zeros(self.width))
            self.pulled.append(np.zeros(self.width))
        else:
            self.alphas.append(size)
            self.makers.append(maker / size)
            self.pulled.append(pulled / size)
            following = self.pulled[-1] - size * self.next
            basis = np.vstack([self.fixed, *self.rights])
            for _ in range(2):
                following = following - basis.T @ (basis @ following)
            self.betas.append(float(np.linalg.norm(following)))
            self.next = following / self.betas[-1] if self.betas[-1] > 0 else following
        room = self.width - len(self.fixed) - len(self.rights)
        if room <= 0:
            self.exhausted = True
        elif self.betas[-1] <= 1e-14 * largest:  # go on with a vector that is not reached yet
            self.betas[-1] = 0.0
            self.next = self._orthogonal(self._random.standard_normal(self.width))

    def _product(self, maker: np.ndarray, earlier: np.ndarray):
        """Length of ``u = X maker``, ``X' u`` and the products of ``u`` with earlier left vectors."""
        turned = earlier.T

        def part(rows: np.ndarray) -> np.ndarray:
            left = rows @ maker
            return np.concatenate([[left @ left], left @ rows, left @ (rows @ turned)])

        sums = self.added(part)
        return maker, float(np.sqrt(sums[0])), sums[1 : 1 + self.width], sums[1 + self.width :]

    def _values(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values, right vectors and residuals of the bidiagonal matrix."""
        matrix = np.diag(self.alphas) + np.diag(self.betas[:-1], 1)
        left, values, right = np.linalg.svd(matrix)
        last = 0.0 if self.exhausted else self.betas[-1]
        vectors = right @ np.array(self.rights)
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        return values, vectors, np.abs(last * left[-1])


def _whitened(fits, scale: float) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, found in usable_vectors(batch["vector"]):
                fit = fits.value[found.shape[1]]
                count = len(fit.values)
                if not count or not len(places):
                    continue
                spreads = spread(_whole(found, scale), fit.n, fit.sums)
                turned = (spreads / fit.n).astype(float) @ fit.vectors.T / np.sqrt(fit.values)
                every = len(places) * count
                yield pa.record_batch(
                    [
                        batch["vec_id"].take(pa.array(np.repeat(places, count))),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(places))),
                        pa.array(np.full(every, fit.n)),
                        pa.array(deviations(spreads), pa.decimal128(38)).take(
                            pa.array(np.repeat(np.arange(len(places)), count))
                        ),
                        pa.array(turned.reshape(-1)),
                        pa.array(np.tile(fit.explained, len(places))),
                        pa.array(np.full(every, fit.identity_error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained",
                     "identity_error"],
                )

    return rows
