"""Slice stability and KPI history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintagemill.functions import dates, numeric

# Metric columns and the KPI each one feeds.
KPI_COLUMNS = {
    "auc_roc": "auc", "auc": "auc", "ks": "ks", "approve_rate": "approve_rate", "bad_rate": "bad_rate",
    "brier": "brier", "ece": "calibration", "calibration": "calibration",
}


def stability_table(
    slices: DataFrame, rising: Sequence[str] = ("ks", "auc"), falling: Sequence[str] = ("bad_rate",),
    by: Sequence[str] = (),
) -> DataFrame:
    """Slice metrics scaled to [0, 1] so that 1 is good; equal values give 0 (1 if falling).

    Works on report tables: one row per slice value, at most a few hundred.
    """
    whole = W.partitionBy(*by)
    new = {}
    for m in [*rising, *falling]:
        low, high = F.min(m).over(whole), F.max(m).over(whole)
        scaled = F.when(high == low, F.lit(0.0)).otherwise((F.col(m) - low) / (high - low))
        new[f"{m}_norm"] = scaled if m in rising else 1 - scaled
    return slices.withColumns(new)


def kpi_history(report: DataFrame, date: str, kpis: Mapping[str, str] = KPI_COLUMNS) -> DataFrame:
    """(metric, date, value) of every KPI column present; undated rows and gaps are dropped."""
    present = {c: k for c, k in kpis.items() if c in report.columns}
    if not present:
        raise ValueError("no KPI columns found")
    # A later column of the same KPI replaces an earlier one.
    source = {k: c for c, k in present.items()}
    dated = report.select(
        dates.parse_vintage(date).alias("date"), *[numeric.to_double(c).alias(k) for k, c in source.items()]
    ).filter(F.col("date").isNotNull())
    return dated.unpivot(["date"], list(source), "metric", "value").filter(F.col("value").isNotNull())


def rolling_mean(history: DataFrame, window: int = 3, by: Sequence[str] = ("metric",), date: str = "date") -> DataFrame:
    """Trailing mean over up to ``window`` points of each series."""
    trailing = W.partitionBy(*by).orderBy(date).rowsBetween(-(window - 1), 0)
    return history.withColumn("smoothed", F.avg("value").over(trailing))
