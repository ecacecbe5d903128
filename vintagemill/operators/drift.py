"""Stability index, calibration tables and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintagemill import session
from vintagemill.functions import bins
from vintagemill.operators import ordered

# Monitored features, and the share that stands in for an empty bin.
DRIFT_FEATURES = ["fico", "ltv", "cltv", "dti", "orig_rate", "orig_upb"]
EMPTY_SHARE = 1e-6


def decile_edges(df: DataFrame, columns: Sequence[str], parts: int = 10) -> dict[str, list[float]]:
    """Exact quantile edges per column, repeated edges included: (parts + 1) doubles each."""
    shares = [i * (1.0 / parts) for i in range(parts)] + [1.0]
    edges: dict[str, list[float]] = {c: [] for c in columns}
    for row in ordered.exact_quantiles(df, columns, shares).orderBy("feature", "q").collect():
        edges[row["feature"]].append(row["value"])
    return edges


def stability_index(
    base: DataFrame, compare: DataFrame, features: Sequence[str] = tuple(DRIFT_FEATURES), parts: int = 10
) -> DataFrame:
    """(feature, psi) of ``compare`` against ``base``, largest first.

    Bins are the base deciles, left-closed, the last one closed.  Values outside
    the base range are in no bin; shares are of the binned rows.  A feature without base
    values has no bins and a NULL index.  The base's columns are written once.
    """
    base = session.materialise(base.select(*features), "drift-base")
    edges = decile_edges(base, features, parts)
    empty = [f for f in features if not edges[f]]
    if len(empty) == len(features):
        return base.sparkSession.createDataFrame([(f, None) for f in sorted(empty)], "feature string, psi double")

    def placed(df: DataFrame, side: str) -> DataFrame:
        entries = F.array(*[
            F.struct(F.lit(f).alias("feature"), bins.left_closed_bin(f, edges[f]).alias("bin"))
            for f in features if edges[f]
        ])
        is_base = F.lit(1 if side == "base" else 0)
        return df.select(F.inline(entries)).select("feature", "bin", is_base.alias("is_base"))

    rows = placed(base, "base").unionByName(placed(compare, "compare")).filter(F.col("bin").isNotNull())
    counts = rows.groupBy("feature", "bin").agg(
        F.sum("is_base").alias("base"), F.sum(1 - F.col("is_base")).alias("cmp"))
    # One small row per feature: totals, then the sum over its at most `parts` bins.
    per_feature = counts.groupBy("feature").agg(
        F.sum("base").alias("base_all"),
        F.sum("cmp").alias("cmp_all"),
        F.collect_list(F.struct(F.col("base"), F.col("cmp"))).alias("cells"),
    )
    share_of = lambda n, total: F.greatest(F.try_divide(n.cast("double"), total.cast("double")), F.lit(EMPTY_SHARE))

    def term(cell):
        b, c = share_of(cell["base"], F.col("base_all")), share_of(cell["cmp"], F.col("cmp_all"))
        return (b - c) * F.log(b / c)

    psi = F.aggregate(F.transform("cells", term), F.lit(0.0), lambda total, x: total + x)
    found = per_feature.select("feature", psi.alias("psi"))
    if empty:
        names = F.explode(F.array(*map(F.lit, empty))).alias("feature")
        found = found.unionByName(base.sparkSession.range(1).select(names, F.lit(None).cast("double").alias("psi")))
    return found.orderBy(F.desc_nulls_last("psi"), "feature")


def quantile_bins(df: DataFrame, column: str, parts: int = 10) -> list[float]:
    """Distinct edges of equal-count bins."""
    return sorted(set(decile_edges(df, [column], parts)[column]))


def with_quantile_bin(df: DataFrame, column: str, parts: int = 10, out: str = "bin") -> DataFrame:
    """Right-closed equal-count bin; merged edges shorten the list."""
    edges = quantile_bins(df, column, parts)
    if len(edges) < 2:
        return df.withColumn(out, F.lit(None).cast("int"))
    return df.withColumn(out, bins.right_closed_bin(column, edges))


def calibration_table(df: DataFrame, score: str, label: str, parts: int = 10) -> DataFrame:
    """Mean predicted against observed rate per score decile; both columns are written once."""
    df = session.materialise(df.select(score, label), "scores")
    return _reliability(with_quantile_bin(df, score, parts), score, label)


def uniform_calibration_table(df: DataFrame, score: str, label: str, parts: int = 20) -> DataFrame:
    """The same over bins of equal width; empty bins are left out."""
    return _reliability(df.withColumn("bin", bins.uniform_bin(score, parts)), score, label)


def _reliability(binned: DataFrame, score: str, label: str) -> DataFrame:
    return binned.filter(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("predicted"),
        F.avg(F.col(label).cast("int")).alias("observed"),
    ).orderBy("bin")


def histograms(df: DataFrame, features: Sequence[str] = tuple(DRIFT_FEATURES), parts: int = 60) -> DataFrame:
    """(feature, bin, low, high, n) with equal-width bins over each feature's range.

    Two passes: ranges first (two numbers per feature), then counts.  A constant
    feature gets a unit-wide range around its value.
    """
    row = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in features for n, f in (("lo", F.min), ("hi", F.max))]).first()
    ranges = {}
    for c in features:
        low, high = row[f"lo_{c}"], row[f"hi_{c}"]
        if low is not None:
            ranges[c] = (low - 0.5, high + 0.5) if low == high else (low, high)
    step = {c: (high - low) / parts for c, (low, high) in ranges.items()}
    inner = {c: [low + i * step[c] for i in range(1, parts)] for c, (low, _) in ranges.items()}
    placed = ordered.with_buckets(df.select(*ranges), inner)
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("feature"), F.col(f"bucket_{c}").alias("bin"), F.lit(low).alias("_low"),
            F.lit(step[c]).alias("_step"),
        )
        for c, (low, _) in ranges.items()
    ])
    counts = placed.select(F.inline(entries)).filter(F.col("bin") >= 0).groupBy("feature", "bin", "_low", "_step").agg(
        F.count(F.lit(1)).alias("n"))
    return counts.select(
        "feature", "bin", (F.col("_low") + F.col("bin") * F.col("_step")).alias("low"),
        (F.col("_low") + (F.col("bin") + 1) * F.col("_step")).alias("high"), "n")


def monotonicity_check(df: DataFrame, feature: str, score: str, direction: int, parts: int = 10) -> DataFrame:
    """Mean score per feature decile, flagging steps against the expected direction; both columns are written once."""
    df = session.materialise(df.select(*{feature, score}), "scores")
    means = with_quantile_bin(df, feature, parts).filter(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"))
    step = F.col("mean_score") - F.lag("mean_score").over(W.orderBy("bin"))
    against = F.coalesce(step * F.lit(direction) < 0, F.lit(False))
    return means.select(F.lit(feature).alias("feature"), "bin", "n", "mean_score", against.alias("violates"))
