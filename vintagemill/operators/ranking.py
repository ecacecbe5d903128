"""Tie-exact ranking metrics: AUC, average precision, KS, Brier, log loss.

Scores are first reduced to one row per (group, score) with good and bad counts,
so ties are one row and hot scores never travel as single rows.  Everything else
is running totals over that table.  Rows with a NULL or NaN score or label, and
rows of a NULL group, take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagemill.functions import numeric
from vintagemill.operators import ordered


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """(by..., prefix28, score, pos, neg): one row per distinct score.

    ``count`` names a column that says how many rows a row stands for.
    """
    by = list(by)
    rows = F.lit(1) if count is None else F.col(count)
    slim = df.select(
        *by, numeric.to_double(score).alias("score"), F.col(label).cast("int").alias("_y"), rows.alias("_n")
    )
    slim = ordered.keep_known(slim, [*by, "score", "_y"])
    counts = slim.groupBy(*by, "score").agg(
        F.sum(F.col("_y") * F.col("_n")).alias("pos"), F.sum((1 - F.col("_y")) * F.col("_n")).alias("neg"))
    # No score is NULL here. Said so, no join on the prefix tests for it, which would work it out for every row of the input.
    prefix = F.coalesce("prefix28", F.lit(0)).alias("prefix28")
    return ordered.with_prefixes(counts, "score", 28).select(*by, prefix, "score", "pos", "neg")


def ranking_table(df: DataFrame, score: str, label: str, by: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """Score counts plus running and total counts per class."""
    return ordered.running_totals(score_counts(df, score, label, by, count), "score", ["pos", "neg"], by)


def _share(part: Column, whole: Column) -> Column:
    return numeric.ratio(part, whole)


def _from_top(measure: str) -> Column:
    """Rows of a class at this score or above."""
    return F.col(f"all_{measure}") - F.col(f"run_{measure}") + F.col(measure)


def metric_columns(two_sided_ks: bool = True) -> dict[str, Column]:
    """Aggregates over a ranking table."""
    pos, neg = F.col("pos"), F.col("neg")
    total_pos, total_neg = F.max("all_pos"), F.max("all_neg")
    both = (total_pos > 0) & (total_neg > 0)
    lift = _share(F.col("run_neg"), F.col("all_neg")) - _share(F.col("run_pos"), F.col("all_pos"))
    pairs = F.sum(pos.cast("double") * (F.col("run_neg") - neg + neg / 2))
    precision = _share(_from_top("pos"), _from_top("pos") + _from_top("neg"))
    gap = F.max(F.abs(lift)) if two_sided_ks else F.greatest(F.max(lift), F.lit(0.0))
    clipped = numeric.clip_probability("score")
    squares = F.sum(pos * F.pow(1 - F.col("score"), 2) + neg * F.pow(F.col("score"), 2))
    losses = F.sum(-(pos * F.log(clipped) + neg * F.log(1 - clipped)))
    n = F.sum(pos + neg)
    return {
        "n": n,
        "positives": F.sum(pos),
        "bad_rate": _share(F.sum(pos), n),
        "auc": F.when(both, pairs / (total_pos.cast("double") * total_neg.cast("double"))),
        "pr_auc": F.when(both, F.sum(_share(pos, F.col("all_pos")) * precision)),
        "ks": F.when(both, gap),
        "brier": squares / n,
        "rmse": F.sqrt(squares / n),
        "logloss": F.when(both, losses / n),
    }


def evaluate(
    df: DataFrame,
    score: str = "y_pred",
    label: str = "y_true",
    by: Sequence[str] = (),
    two_sided_ks: bool = True,
    metrics: Sequence[str] | None = None,
    count: str | None = None,
) -> DataFrame:
    """One row of metrics per group; ranking metrics are NULL where a class is missing.

    ``count`` names a column that says how many rows a row stands for.
    """
    table = ranking_table(df, score, label, by, count)
    available = metric_columns(two_sided_ks)
    return table.groupBy(*by).agg(*[available[m].alias(m) for m in metrics or available])


def evaluate_models(df: DataFrame, scores: Sequence[str], label: str = "y_true", by: Sequence[str] = ()) -> DataFrame:
    """The evaluation block of several score columns side by side, in one job."""
    entries = F.array(*[F.struct(F.lit(s).alias("model"), F.col(s).cast("double").alias("_score")) for s in scores])
    long = df.select(*by, label, F.inline(entries))
    return evaluate(long, "_score", label, [*by, "model"])


def evaluate_slices(
    df: DataFrame, slices: Sequence[str], score: str = "y_pred", label: str = "y_true"
) -> DataFrame:
    """Metrics of every value of every slice column, in one job: (slice, value, ...)."""
    entries = F.array(*[F.struct(F.lit(s).alias("slice"), F.col(s).cast("string").alias("value")) for s in slices])
    long = df.select(F.col(score), F.col(label), F.inline(entries)).filter(F.col("value").isNotNull())
    wanted = ["n", "bad_rate", "auc", "pr_auc", "ks"]
    return evaluate(long, score, label, ["slice", "value"], two_sided_ks=False, metrics=wanted)


def probability_errors(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Brier score, its root and log loss straight from the rows: no ordering needed."""
    y, p = F.col(label).cast("int"), F.col(score).cast("double")
    clipped = numeric.clip_probability(score)
    loss = F.avg(-(y * F.log(clipped) + (1 - y) * F.log(1 - clipped)))
    both = F.min(y) != F.max(y)
    brier = F.avg(F.pow(y - p, 2))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        brier.alias("brier"),
        F.sqrt(brier).alias("rmse"),
        F.when(both, loss).alias("logloss"),
    )


def roc_points(df: DataFrame, score: str = "y_pred", label: str = "y_true") -> DataFrame:
    """(score, tpr, fpr) per distinct score, treating this score and above as bad."""
    table = ranking_table(df, score, label)
    return table.select(
        "score",
        _share(_from_top("pos"), F.col("all_pos")).alias("tpr"),
        _share(_from_top("neg"), F.col("all_neg")).alias("fpr"),
    )


def precision_recall_points(df: DataFrame, score: str = "y_pred", label: str = "y_true") -> DataFrame:
    table = ranking_table(df, score, label)
    return table.select(
        "score",
        _share(_from_top("pos"), _from_top("pos") + _from_top("neg")).alias("precision"),
        _share(_from_top("pos"), F.col("all_pos")).alias("recall"),
    )


def cumulative_shares(df: DataFrame, score: str = "y_pred", label: str = "y_true") -> DataFrame:
    """Running share of each class by ascending score."""
    table = ranking_table(df, score, label)
    return table.select(
        "score",
        _share(F.col("run_pos"), F.col("all_pos")).alias("cum_pos"),
        _share(F.col("run_neg"), F.col("all_neg")).alias("cum_neg"),
    )
