"""Whitening of embeddings: a distributed covariance, float32 eigenvectors, refinement in higher precision."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemill.llm.batches import bound_batches
from vintagemill.session import materialise

COMPONENTS = 16
#: A vector's entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000

_ROUNDS = 40
#: Components with less than this share of the trace are rounding, not variance.
_FLAT = 1e-13


def whole_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, x: vectors as whole numbers; those that are NULL, empty or hold NULL or non-finite entries are left out."""
    sound = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = table.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    rows = rows.where(F.col("c").isNotNull() & (F.size("c") > 0) & sound)
    return rows.select("vec_id", F.transform("c", lambda c: F.floor(c * SCALE).cast("long") + SHIFT).alias("x"))


def refine(a: np.ndarray, x: np.ndarray, rounds: int = _ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the symmetric ``a`` from approximate eigenvectors ``x``.

    Each round is Ogita and Aishima's correction by matrix products: with R = I - x'x and
    S = x'ax, pairs of separated eigenvalues take (S_ij + l_j R_ij) / (l_j - l_i), the
    others R_ij / 2, which only makes them orthogonal.  Eigenvalues closer than the
    error bound form clusters; within each the small matrix of ``a`` less the cluster's
    mean, in the span of its vectors, is solved by itself and the vectors are turned
    to its eigenvectors.  All is done in the precision of ``a``; rounds end when the
    correction no longer shrinks, and the vectors are made orthogonal once more.
    """
    eye, last = np.eye(len(a), dtype=a.dtype), np.inf
    x = x.astype(a.dtype)
    norm = np.abs(a).sum(1).max()
    tiny = np.finfo(a.dtype).eps
    values = np.diagonal(x.T @ a @ x).copy()
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        values = np.diagonal(s) / (1 - np.diagonal(r))
        bound = 2 * (np.linalg.norm((s - np.diag(np.diagonal(s))).astype(float)) + float(norm) * np.linalg.norm(r.astype(float)))
        order = np.argsort(values)
        cuts = np.flatnonzero(np.diff(values[order]) > bound) + 1
        turned = False
        for members in np.split(order, cuts):
            if len(members) > 1 and bound > 16 * tiny * norm:
                turned |= _solve_cluster(a, x, members)
        if turned:
            r = eye - x.T @ x
            s = x.T @ (a @ x)
            values = np.diagonal(s) / (1 - np.diagonal(r))
        gap = values[None, :] - values[:, None]
        # within a turned cluster what is left of S is small against most gaps; only smaller ones are not told apart
        rest = np.abs(s + values[None, :] * r)
        apart = np.abs(gap) > np.maximum(4 * rest, 16 * tiny * norm)
        step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        np.fill_diagonal(step, np.diagonal(r) / 2)
        x = x + x @ step
        size = float(np.abs(step).max())
        if size < 4 * tiny or size >= last and size < 1e-3:
            break
        last = size
    for _ in range(2):  # turns within nearly equal eigenvalues leave second-order errors
        x = x + x @ (eye - x.T @ x) / 2
    r = eye - x.T @ x
    values = np.diagonal(x.T @ (a @ x)) / (1 - np.diagonal(r))
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _solve_cluster(a: np.ndarray, x: np.ndarray, members: np.ndarray) -> bool:
    """Turns the vectors of one cluster to the eigenvectors of the shifted matrix in their span."""
    own = x[:, members]
    own = own @ (np.eye(len(members), dtype=a.dtype) * 1.5 - own.T @ own / 2)
    centre = np.diagonal(own.T @ a @ own).mean()
    small = own.T @ (a @ own - centre * own)
    small = (small + small.T) / 2
    size = float(np.abs(small).max())
    if not size:
        return False
    x[:, members] = own @ np.linalg.eigh((small / size).astype(np.float64))[1].astype(a.dtype)
    return True


def eigen(covariance: np.ndarray, precision: type = np.longdouble) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues, falling, and unit eigenvectors: found in float32, refined in ``precision``.

    A vector's entry of largest size is positive.
    """
    scale = float(np.abs(covariance).max()) or 1.0
    a = covariance.astype(precision) / precision(scale)
    start = np.linalg.eigh(a.astype(np.float32))[1]
    values, vectors = refine(a, start)
    vectors = vectors / np.sqrt((vectors * vectors).sum(0))
    largest = np.abs(vectors).argmax(0)
    vectors = vectors * np.where(vectors[largest, np.arange(len(a))] < 0, -1, 1)
    return (values * precision(scale)).astype(np.float64), vectors.astype(np.float64)


@dataclass(frozen=True)
class Whitening:
    """What is fitted: number and sums of the distinct vectors, components and how well they whiten."""

    n: int
    sums: np.ndarray  # exact, as Python integers
    directions: np.ndarray  # one column a component, each divided by the root of its eigenvalue
    explained: np.ndarray
    identity_error: float

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums of (n * x - S) squared."""
        d = x.astype(object) * self.n - self.sums if self._may_overflow(x) else x * self.n - self.sums.astype(np.int64)
        return (d * d).sum(1).tolist()

    def _may_overflow(self, x: np.ndarray) -> bool:
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))), max(map(abs, self.sums.tolist()), default=0) // max(self.n, 1) + 1)
        spread = max((abs(int(v) * self.n - s) for ends in (x.max(0, initial=0), x.min(0, initial=0)) for v, s in zip(ends, self.sums.tolist())), default=0)
        return most * self.n >= 1 << 62 or max(spread, 1) ** 2 * max(self.width, 1) >= 1 << 62


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n in doubles, the whole part of the mean taken off before anything is rounded."""
    whole = np.array([s // n for s in sums.tolist()], np.int64)
    part = np.array([s % n / n for s in sums.tolist()])
    return (x - whole) - part


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.concatenate(column.tolist()).reshape(-1, width) if len(column) else np.zeros((0, width), np.int64)


def _covariance(rows: DataFrame, width: int, values) -> np.ndarray:
    """Covariance (divisor n) of ``values(x)`` over all rows, each part centred before it is multiplied.

    A task leaves its count, mean and centred products; parts are merged with the
    products of their means about the overall mean, which Spark sums.
    """
    bound_batches(rows.sparkSession)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, mean, products = 0, None, None
        for batch in batches:
            if len(batch):
                own = values(_matrix(batch["x"], width))
                own_mean = own.mean(0)
                d = own - own_mean
                if not n:
                    n, mean, products = len(own), own_mean, d.T @ d
                    continue
                gap, total = own_mean - mean, n + len(own)
                products += d.T @ d + np.outer(gap, gap) * (n * len(own) / total)
                n, mean = total, mean + gap * (len(own) / total)
        if n:
            k = len(mean)
            yield pd.DataFrame({"i": np.arange(k), "n": n, "mean": mean, "means": [mean] * k, "products": list(products)})

    parts = materialise(rows.select("x").mapInPandas(partial, "i int, n long, mean double, means array<double>, products array<double>"), "moments")
    n, overall = parts.where("i = 0").agg(F.sum("n"), F.sum(F.col("n") * F.lit(1.0))).first()
    means = {r["i"]: r["m"] for r in parts.groupBy("i").agg((F.sum(F.col("n") * F.col("mean")) / F.lit(overall)).alias("m")).collect()}
    k = len(means)
    mean = [means[i] for i in range(k)]
    at = F.element_at(F.array(*map(F.lit, mean)), F.col("i") + 1)
    entries = parts.select("i", "n", (F.col("mean") - at).alias("gap"), F.posexplode(F.arrays_zip("means", "products")).alias("j", "e"))
    other = F.element_at(F.array(*map(F.lit, mean)), F.col("j") + 1)
    # one row an entry of a matrix with as many rows as a vector has entries
    cells = entries.groupBy("i", "j").agg(F.sum(F.col("e.products") + F.col("n") * F.col("gap") * (F.col("e.means") - other)).alias("v")).collect()
    out = np.zeros((k, k))
    for r in cells:
        out[r["i"], r["j"]] = r["v"] / n
    return (out + out.T) / 2


def fit(vectors: DataFrame, components: int = COMPONENTS, precision: type = np.longdouble) -> Whitening | None:
    """Fits on each distinct vector of ``x`` once; None for an empty table.

    Driver memory and time depend on the vectors' width alone: its square and its cube.
    Components without variance are left out, so equal vectors alone have none.
    """
    distinct = materialise(vectors.select("x").distinct(), "distinct-vectors")
    widths = [r[0] for r in distinct.select(F.size("x")).distinct().limit(2).collect()]
    if not widths:
        return None
    if len(widths) > 1:
        raise ValueError("vectors differ in length")
    n = distinct.count()
    per_entry = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    sums = np.array([int(r["s"]) for r in sorted(per_entry.collect(), key=lambda r: r["i"])], object)
    covariance = _covariance(distinct, widths[0], lambda x: _centred(x, n, sums))
    values, directions = eigen(covariance, precision)
    trace = float(np.trace(covariance))
    k = int((values[:components] > _FLAT * trace).sum())
    if not k:
        return Whitening(n, sums, np.zeros((widths[0], 0)), np.zeros(0), 0.0)
    scaled = directions[:, :k] / np.sqrt(values[:k])
    seen = _covariance(distinct, widths[0], lambda x: _centred(x, n, sums) @ scaled)
    return Whitening(n, sums, scaled, values[:k] / trace, float(np.abs(seen - np.eye(k)).max()))


def transform(vectors: DataFrame, fitted: Whitening) -> DataFrame:
    """vec_id, deviation (decimal), whitened (one entry a component) of every row of ``whole_vectors``."""
    bound_batches(vectors.sparkSession)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _matrix(batch["x"], fitted.width)
                yield pd.DataFrame({
                    "vec_id": batch["vec_id"].astype("Int64"), "deviation": [str(v) for v in fitted.deviations(x)],
                    "whitened": list(fitted.centred(x) @ fitted.directions)})

    rows = vectors.select("vec_id", "x").mapInPandas(project, "vec_id long, deviation string, whitened array<double>")
    return rows.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    Vectors that are NULL, empty or hold NULL or non-finite entries have no rows; vectors
    of different lengths are an error.  Repeated rows each have rows of their own but
    count once in the fit; so do equal vectors of different ids; a NULL id stays.  An empty table, and one in
    which no vector differs, gives an empty table.  Other columns are not looked at.
    """
    vectors = whole_vectors(table, key, vector)
    fitted = fit(vectors, components)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if fitted is None or not len(fitted.explained):
        return table.sparkSession.createDataFrame([], schema)
    rows = transform(vectors, fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.element_at(F.array(*[F.lit(float(e)) for e in fitted.explained]), F.col("at") + 1)
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(fitted.identity_error).alias("identity_error"))
