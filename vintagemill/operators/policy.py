"""Approval policy: threshold curves, threshold choice, policy metrics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintagemill import session
from vintagemill.functions import numeric
from vintagemill.functions.numeric import approves, ratio
from vintagemill.operators import ordered, ranking

# Default threshold grid, shares and quantiles shown for a new cohort.
DEFAULT_GRID = (0.01, 0.251, 0.005)
COHORT_QUANTILES = [0, 0.001, 0.01, 0.05, 0.10, 0.20, 0.50, 0.80, 0.90, 0.95, 0.99, 1.0]
COHORT_THRESHOLDS = [0.002, 0.005, 0.010, 0.020, 0.030, 0.050, 0.100]


def arange(start: float, stop: float, step: float) -> list[float]:
    """Evenly spaced doubles, each computed from its position (no accumulated error)."""
    delta = (start + step) - start
    return [start + i * delta for i in range(math.ceil((stop - start) / step))]


def parse_grid(spec: str | None = None) -> list[float]:
    """``None`` for the default grid, ``"start:stop:step"`` or ``"t1,t2,..."``."""
    if not spec:
        return arange(*DEFAULT_GRID)
    if ":" in spec:
        start, stop, step = map(float, spec.split(":"))
        return arange(start, stop + 1e-12, step)
    return [float(t) for t in spec.split(",")]


def grid_table(spark: SparkSession, thresholds: Sequence[float]) -> DataFrame:
    """(position, threshold), one row per grid entry."""
    values = F.array(*[F.lit(float(t)) for t in thresholds])
    return spark.range(1).select(F.posexplode(values).alias("position", "threshold"))


def threshold_counts(df: DataFrame, score: str, label: str, thresholds: Sequence[float]) -> DataFrame:
    """Counts on either side of every threshold from one pass over the rows.

    Each row is placed once between two thresholds; the rest is arithmetic on a
    table no longer than the grid.  Columns: position, threshold, the totals
    ``n_all``/``pos_all``, and for rows below and exactly at the threshold the
    count, the bads and the sum of scores.  Rows without a score count as not
    approved and not flagged.
    """
    steps = sorted(set(float(t) for t in thresholds))
    slim = df.select(numeric.to_double(score).alias("p"), F.coalesce(F.col(label).cast("int"), F.lit(0)).alias("y"))
    placed = ordered.with_buckets(slim, {"p": steps}).withColumnRenamed("bucket_p", "step")
    edge = F.try_element_at(F.array(*[F.lit(t) for t in steps]), F.when(F.col("step") > 0, F.col("step")))
    at_edge = F.coalesce(F.col("p") == edge, F.lit(False))
    sums = placed.groupBy("step").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("y").alias("pos"),
        F.sum("p").alias("p_sum"),
        F.count_if(at_edge).alias("n_at"),
        F.sum(F.when(at_edge, F.col("y")).otherwise(0)).alias("pos_at"),
        F.sum(F.when(at_edge, F.col("p")).otherwise(0.0)).alias("p_at"),
    )
    # Step 0 lies below every threshold; step -1 holds rows without a score.
    grid = grid_table(df.sparkSession, steps).select((F.col("position") + 1).alias("step"), "threshold")
    spine = grid.unionByName(df.sparkSession.range(-1, 1).select(
        F.col("id").cast("int").alias("step"), F.lit(None).cast("double").alias("threshold")))
    filled = spine.join(F.broadcast(sums), "step", "left").na.fill(0, ["n", "pos", "p_sum", "n_at", "pos_at", "p_at"])
    below = W.orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    scored = F.col("step") >= 0
    everything = W.orderBy("step").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    result = filled.select(
        "step",
        "threshold",
        F.sum(F.when(scored, F.col("n")).otherwise(0)).over(below).alias("n_below"),
        F.sum(F.when(scored, F.col("pos")).otherwise(0)).over(below).alias("pos_below"),
        F.sum(F.when(scored, F.col("p_sum")).otherwise(0.0)).over(below).alias("p_below"),
        "n_at",
        "pos_at",
        "p_at",
        F.sum(F.when(~scored, F.col("n")).otherwise(0)).over(everything).alias("n_unscored"),
        F.sum(F.when(~scored, F.col("pos")).otherwise(0)).over(everything).alias("pos_unscored"),
        F.sum("n").over(everything).alias("n_all"),
        F.sum("pos").over(everything).alias("pos_all"),
    ).filter(F.col("step") > 0).drop("step")
    return grid_table(df.sparkSession, thresholds).join(F.broadcast(result), "threshold")


def policy_curve(
    df: DataFrame,
    score: str = "pd_cal",
    label: str = "y_true",
    thresholds: Sequence[float] | None = None,
    with_global_ks: bool = False,
) -> DataFrame:
    """Threshold table: confusion counts, precision, recall, F1, KS, approval.

    A score equal to the threshold is both approved (``<=``) and flagged bad
    (``>=``).  ``ks`` is taken at the threshold; ``approved_mean_pd`` is the mean
    predicted, ``approved_bad_rate`` the observed rate of the approved rows.
    """
    counts = threshold_counts(df, score, label, thresholds or parse_grid())
    fn = F.col("pos_below") + F.col("pos_unscored")
    tp = F.col("pos_all") - fn
    tn = F.col("n_below") + F.col("n_unscored") - fn
    fp = F.col("n_all") - F.col("pos_all") - tn
    table = counts.select("*", tp.alias("tp"), fp.alias("fp"), tn.alias("tn"), fn.alias("fn"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision, recall = ratio(tp, tp + fp, 0.0), ratio(tp, tp + fn, 0.0)
    approved = F.col("n_below") + F.col("n_at")
    curve = table.select(
        "threshold",
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(2 * precision * recall, precision + recall, 0.0).alias("f1"),
        numeric.ks_from_counts(tp, fp, tn, fn).alias("ks"),
        ratio(approved, F.col("n_all")).alias("approve_rate"),
        ratio(F.col("pos_below") + F.col("pos_at"), approved).alias("approved_bad_rate"),
        ratio(F.col("p_below") + F.col("p_at"), approved).alias("approved_mean_pd"),
        "tp",
        "fp",
        "tn",
        "fn",
    )
    if with_global_ks:
        overall = ranking.evaluate(df, score, label, metrics=["ks"]).scalar()
        curve = curve.withColumn("ks_global", overall)
    return curve.orderBy("threshold")


def quantile_policy_curve(df: DataFrame, score: str, label: str, points: int = 101) -> DataFrame:
    """Curve over score quantiles, approving strictly below the threshold.

    The two columns are written once: the quantiles and the counts read them from there.
    """
    df = session.materialise(df.select(score, label), "scores")
    shares = [i * (1.0 / (points - 1)) for i in range(points - 1)] + [1.0]
    thresholds = ordered.quantile_values(df, score, shares)
    counts = threshold_counts(df, score, label, thresholds)
    return counts.select(
        "position",
        "threshold",
        ratio(F.col("n_below"), F.col("n_all")).alias("approval_rate"),
        ratio(F.col("pos_below"), F.col("n_below")).alias("bad_rate_in_approved"),
        ratio(F.col("pos_all") - F.col("pos_below"), F.col("pos_all")).alias("captured_defaults_share"),
    ).orderBy("position")


def with_curve_ks(curve: DataFrame) -> DataFrame:
    """KS per threshold from stored counts, for curves without a usable ``ks`` column."""
    return curve.withColumn("ks", numeric.ks_from_counts(*[F.col(c) for c in ("tp", "fp", "tn", "fn")]))


def best_threshold(curve: DataFrame, metric: str = "f1") -> DataFrame:
    """Grid row with the highest metric; the lowest threshold wins a tie."""
    return curve.orderBy(F.desc_nulls_last(metric), F.asc("threshold")).limit(1)


def nearest_row(curve: DataFrame, t: float) -> DataFrame:
    """Snapshot of the grid row closest to ``t``."""
    return curve.orderBy(F.abs(F.col("threshold") - F.lit(float(t))), "threshold").limit(1)


def near_threshold(curve: DataFrame, t: float, span: float = 0.06, digits: int = 6) -> DataFrame:
    """Grid rows within half a span of ``t``, numbers rounded."""
    low, high = t - span / 2, t + span / 2
    kept = curve.filter(F.col("threshold").isNotNull() & F.col("threshold").between(low, high))
    doubles = [f.name for f in curve.schema if f.dataType.typeName() == "double"]
    return kept.withColumns({c: F.round(c, digits) for c in doubles})


def curve_long(curve: DataFrame, metrics: Sequence[str] = ("recall", "precision", "f1", "ks")) -> DataFrame:
    """(threshold, metric, value) without missing values."""
    long = curve.unpivot(["threshold"], list(metrics), "metric", "value")
    return long.filter(F.col("value").isNotNull()).orderBy("metric", "threshold")


def threshold_for_approval(df: DataFrame, score: str, target: float) -> DataFrame:
    """Threshold that approves the target share, with the share it really approves.

    One row: threshold, target_approve_rate, actual_approve_rate, prob.
    """
    chosen = ordered.quantile_values(df, score, [target])
    if not chosen:
        raise ValueError(f"no scores in {score!r}")
    t = chosen[0]
    approved = F.avg(approves(score, t).cast("int"))
    return df.agg(
        F.lit(t).alias("threshold"),
        F.lit(float(target)).alias("target_approve_rate"),
        approved.alias("actual_approve_rate"),
        F.lit(score).alias("prob"),
    )


def threshold_shares(df: DataFrame, score: str, thresholds: Sequence[float] = tuple(COHORT_THRESHOLDS)) -> DataFrame:
    """Share of rows at or under each fixed threshold, in one pass."""
    shares = df.agg(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.avg(approves(score, t).cast("int")).alias("share"))
        for t in thresholds
    ]).alias("s"))
    return shares.select(F.inline("s"))


def score_quantiles(df: DataFrame, score: str, probabilities: Sequence[float] = tuple(COHORT_QUANTILES)) -> DataFrame:
    return ordered.exact_quantiles(df, [score], probabilities).select("q", "value")


def approved_outcome(df: DataFrame, score: str, t: float) -> DataFrame:
    """Approve rate, and the bad rate the scores themselves expect among the approved."""
    ok = approves(score, t)
    return df.agg(
        F.avg(ok.cast("int")).alias("approve_rate"),
        F.avg(F.when(ok, F.col(score))).alias("expected_bad_rate_on_approved"),
    )


def policy_aggregates(score: str, label: str, t: float, strict: bool = False, empty: float | None = None) -> list[Column]:
    """Aggregates of an approval rule; ``empty`` replaces NULL when nobody is approved."""
    ok = approves(score, t, strict)
    bad = F.col(label).cast("int")
    observed = F.avg(F.when(ok, bad))
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(ok.cast("int")).alias("approve_rate"),
        F.count_if(ok).alias("approved"),
        (observed if empty is None else F.coalesce(observed, F.lit(empty))).alias("approved_bad_rate"),
        F.avg(bad).alias("overall_bad_rate"),
    ]


def policy_by_slice(
    df: DataFrame, slices: Sequence[str], score: str, label: str, t: float, strict: bool = False,
    empty: float | None = None,
) -> DataFrame:
    """Policy metrics of every value of every slice column; NULL is a value of its own."""
    entries = F.array(*[F.struct(F.lit(s).alias("slice"), F.col(s).cast("string").alias("value")) for s in slices])
    long = df.select(score, label, F.inline(entries))
    return long.groupBy("slice", "value").agg(*policy_aggregates(score, label, t, strict, empty))


def in_largest_groups(df: DataFrame, key: str, k: int = 20) -> DataFrame:
    """Rows whose ``key`` is among the ``k`` most frequent."""
    top = df.filter(F.col(key).isNotNull()).groupBy(key).count().orderBy(F.desc("count"), key).limit(k)
    return df.join(F.broadcast(top.select(key)), key, "left_semi")


def backtest(
    df: DataFrame, score: str, t: float, label: str | None = None, vintage: str | None = "vintage_q"
) -> DataFrame:
    """Approval and observed bad rates per vintage, or in one row without a vintage.

    Labels are optional; the bad rate of an empty approved set is NULL.
    """
    keys = [vintage] if vintage else []
    ok = approves(score, t)
    columns = [F.count(F.lit(1)).alias("n"), F.avg(ok.cast("int")).alias("approve_rate")]
    if label:
        bad = F.col(label).cast("int")
        columns += [
            F.avg(F.when(ok, bad)).alias("approved_bad_rate"), F.avg(bad).alias("overall_bad_rate")
        ]
    return df.groupBy(*keys).agg(*columns)


def approved_share(df: DataFrame, slices: Sequence[str], score: str, t: float, one_at_a_time: bool = False) -> DataFrame:
    """Approve rate per combination of all slice columns, NULL kept.

    ``one_at_a_time`` takes each column on its own (grouping sets); without slice
    columns there is a single GLOBAL row.
    """
    measures = [F.avg(approves(score, t).cast("int")).alias("approve_rate"), F.count(F.lit(1)).alias("n")]
    if not slices:
        return df.agg(*measures).select(F.lit("GLOBAL").alias("slice"), "approve_rate", "n")
    if one_at_a_time:
        columns = [F.col(s) for s in slices]
        sets = df.groupingSets([[c] for c in columns], *columns)
        return sets.agg(F.grouping_id(*slices).alias("grouping"), *measures)
    return df.groupBy(*slices).agg(*measures)


def decisions(df: DataFrame, score: str, t: float, keep: Sequence[str]) -> DataFrame:
    """Per-row decision table: the kept columns that exist, ``pd`` and the decision."""
    present = [c for c in keep if c in df.columns and c != score]
    return df.select(*present, F.col(score).alias("pd"), approves(score, t).cast("int").alias("decision_at_t"))
