"""Platt scaling: fit, apply, before/after quality."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemill import session
from vintagemill.functions import numeric
from vintagemill.operators import ranking


class NotConverged(RuntimeError):
    """The two coefficients did not settle."""


@dataclass(frozen=True)
class PlattScaler:
    a: float
    b: float

    def transform(self, df: DataFrame, score: str, out: str = "pd_cal") -> DataFrame:
        return df.withColumn(out, numeric.platt(score, self.a, self.b))


def _point(counts: DataFrame, a: float, b: float) -> tuple[float, tuple[float, float], tuple[float, float, float]]:
    """Log-likelihood, gradient and (negative) curvature at one coefficient pair: one job, six sums."""
    x, n, pos = F.col("x"), F.col("n"), F.col("pos")
    z = numeric.clip(F.lit(a) + F.lit(b) * x, -numeric.LOGIT_BOUND, numeric.LOGIT_BOUND)
    p = 1 / (1 + F.exp(-z))
    gap, weight = pos - n * p, n * p * (1 - p)
    row = counts.agg(
        F.sum(pos * F.log(p) + (n - pos) * F.log(1 - p)).alias("ll"),
        F.sum(gap).alias("g0"), F.sum(gap * x).alias("g1"),
        F.sum(weight).alias("h00"), F.sum(weight * x).alias("h01"), F.sum(weight * x * x).alias("h11"),
    ).first()
    return row["ll"], (row["g0"], row["g1"]), (row["h00"], row["h01"], row["h11"])


def _newton_step(gradient: tuple[float, float], curvature: tuple[float, float, float]) -> tuple[float, float]:
    (g0, g1), (h00, h01, h11) = gradient, curvature
    det = h00 * h11 - h01 * h01
    if abs(det) <= 1e-12 * max(h00 * h11, 1e-300):
        h00, h11 = h00 + 1e-4, h11 + 1e-4
        det = h00 * h11 - h01 * h01
    return (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det


def fit_platt(df: DataFrame, score: str, label: str, max_iter: int = 200, tol: float = 1e-6) -> PlattScaler:
    """Logistic fit of the label on the logit of the score.

    Rows are reduced to (logit, rows, bads) once; every Newton step is then one
    small aggregation.  A step that lowers the likelihood is halved.
    """
    y = F.col(label).cast("int")
    counts = (
        df.select(numeric.to_double(score).alias("_p"), y.alias("_y"))
        .filter(F.col("_p").isNotNull() & F.col("_y").isNotNull())
        .groupBy(numeric.logit("_p").alias("x"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("pos"))
    )
    counts = session.materialise(counts, "platt")
    a, b = 0.0, 1.0
    ll, gradient, curvature = _point(counts, a, b)
    if ll is None:
        raise ValueError("no scored and labelled rows to calibrate on")
    for _ in range(max_iter):
        da, db = _newton_step(gradient, curvature)
        scale = 1.0
        while True:
            trial = _point(counts, a + scale * da, b + scale * db)
            if trial[0] >= ll - 1e-12 * abs(ll) or scale < 1e-6:
                break
            scale /= 2
        moved = scale * math.hypot(da, db)
        a, b = a + scale * da, b + scale * db
        ll, gradient, curvature = trial
        if moved < tol:
            return PlattScaler(a, b)
    raise NotConverged(f"calibration did not converge in {max_iter} steps (a={a}, b={b})")


def calibration_effect(df: DataFrame, score: str, label: str, scaler: PlattScaler) -> DataFrame:
    """(stage, n, brier, auc) before and after scaling."""
    both = scaler.transform(df, score, "after").withColumn("before", numeric.clip_probability(score))
    block = ranking.evaluate_models(both, ["before", "after"], label)
    return block.select(F.col("model").alias("stage"), "n", "brier", "auc")
