"""Volume and bad-rate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintagemill.functions import bins
from vintagemill.schemas import LABEL


def bad_share(label: str = LABEL) -> Column:
    """Share of bad rows; a missing label counts as good, no rows give NULL."""
    return F.avg(F.coalesce(F.col(label).cast("int"), F.lit(0)))


def volume_and_bad_rate(df: DataFrame, by: Sequence[str] = (), label: str = LABEL) -> DataFrame:
    """``n`` and ``bad_rate``, overall or per group (NULL is a group)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), bad_share(label).alias("bad_rate"))


def by_vintage(df: DataFrame, label: str = LABEL) -> DataFrame:
    return volume_and_bad_rate(df, ["vintage_q"], label).orderBy("vintage_q")


def largest_groups(df: DataFrame, key: str, k: int, label: str = LABEL) -> DataFrame:
    """Top ``k`` groups by volume, ties broken by the key."""
    return volume_and_bad_rate(df, [key], label).orderBy(F.desc("n"), F.asc_nulls_last(key)).limit(k)


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group; every task keeps only its own ``k`` before they meet."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def by_pair(df: DataFrame, first: str, second: str, label: str = LABEL) -> DataFrame:
    return volume_and_bad_rate(df, [first, second], label).orderBy(F.desc("n"), first, second)


def by_labelled_bin(df: DataFrame, feature: str, compat: bool = False, label: str = LABEL) -> DataFrame:
    edges, labels = bins.LABELLED_BINS[feature]
    binned = df.select(bins.labelled_bins(feature, edges, labels, compat).alias("bin"), label)
    return volume_and_bad_rate(binned, ["bin"], label).orderBy("bin")


def by_interval(
    df: DataFrame, feature: str, edges: Sequence[float] | None = None, label: str = LABEL
) -> DataFrame:
    """Right-closed intervals; rows outside the edges have no interval and are left out."""
    edges = edges or bins.INTERVAL_EDGES[feature]
    binned = df.select(
        bins.right_closed_bin(feature, edges).alias("position"),
        bins.interval_label(feature, edges).alias("interval"),
        label,
    ).filter(F.col("position").isNotNull())
    return volume_and_bad_rate(binned, ["position", "interval"], label).orderBy("position")


def split_sizes(df: DataFrame, split: str = "split", label: str = LABEL) -> DataFrame:
    bad = F.count_if(F.col(label).cast("int") == 1)
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), bad.alias("positives"), bad_share(label).alias("positive_rate")
    )
