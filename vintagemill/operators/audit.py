"""Dataset audit and column profiles, each in one pass over the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagemill.operators import ordered
from vintagemill.operators.summaries import bad_share, top_per_group
from vintagemill.schemas import AUDIT_RULES, CATEGORY_COLUMNS, LABEL


def audit_header(df: DataFrame, key: str = "loan_id", label: str = LABEL, approximate: bool = False) -> DataFrame:
    """Row, key and label counts and date ranges in one row.

    ``approximate`` swaps the exact distinct count (a shuffle of all keys) for a
    sketch.
    """
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    dates = {"fp": "first_payment_date", "vint": "vintage_q", "last": "last_perf_month"}
    ranges = [f(c).alias(f"{name}_{short}") for short, c in dates.items() for name, f in (("min", F.min), ("max", F.max))]
    header = df.agg(
        F.count(F.lit(1)).alias("rows"),
        distinct.alias("unique_keys"),
        *ranges,
        bad_share(label).alias("bad_rate"),
        F.count_if(F.col(label).isNull()).alias("label_nulls"),
    )
    return header.withColumn("duplicates", F.col("rows") - F.col("unique_keys"))


def _entries(names_to_counts: Mapping[str, Column], key: str, value: str) -> Column:
    return F.array(*[F.struct(F.lit(n).alias(key), c.alias(value)) for n, c in names_to_counts.items()]).alias("e")


def missing_values(df: DataFrame) -> DataFrame:
    """(col, nulls, miss_rate) of every column."""
    nulls = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    profile = df.agg(F.count(F.lit(1)).alias("_rows"), _entries(nulls, "col", "nulls"))
    return (
        profile.select(F.greatest(F.col("_rows"), F.lit(1)).alias("_rows"), F.inline("e"))
        .select("col", "nulls", (F.col("nulls") / F.col("_rows")).alias("miss_rate"))
        .orderBy(F.desc("miss_rate"), "col")
    )


def most_missing(df: DataFrame, k: int = 12) -> DataFrame:
    """Columns with missing values, as a percentage with two digits."""
    gaps = missing_values(df).filter(F.col("nulls") > 0).limit(k)
    return gaps.select(F.col("col").alias("feature"), F.round(F.col("miss_rate") * 100, 2).alias("missing_pct"))


def out_of_range(c: str, low: float, high: float) -> Column:
    value = F.col(c)
    return value.isNull() | (value < low) | (value > high)


def outlier_flags(df: DataFrame, rules: Mapping[str, tuple[float, float]] = AUDIT_RULES) -> DataFrame:
    """(feature, count_flagged): values outside the plausible range or missing."""
    flags = {c: F.count_if(out_of_range(c, *rules[c])) for c in rules if c in df.columns}
    return df.agg(_entries(flags, "feature", "count_flagged")).select(F.inline("e")).orderBy(
        F.desc("count_flagged"), "feature")


def top_values(df: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS, k: int = 10) -> DataFrame:
    """(col, val, n, rank): most frequent values per column, NULL among them.

    Rows are counted per (column, value) before ranking.
    """
    present = [c for c in columns if c in df.columns]
    entries = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in present])
    counts = df.select(F.inline(entries)).groupBy("col", "val").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counts, ["col"], [F.desc("n"), F.asc_nulls_last("val")], k)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, mean, median, min, max, std) of the numeric columns."""
    columns = list(columns or numeric_columns(df))
    moments = df.agg(F.array(*[
        F.struct(
            F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"), F.stddev(c).alias("std"),
        )
        for c in columns
    ]).alias("e")).select(F.inline("e"))
    return moments.join(ordered.medians(df, columns), "feature", "left")


def detect_roles(df: DataFrame, exact: bool = False) -> DataFrame:
    """Which column looks like the label and which like a probability, from content.

    One row per candidate: (role, column, rank).  A label holds only 0 and 1.  A
    probability is a floating-point column with more than 98% of its values in
    [0, 1] and more than ten distinct ones; suggestive names rank first, then the
    number of distinct values.
    """
    numbers = [f for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    count = F.count_distinct if exact else F.approx_count_distinct
    stats = []
    for f in numbers:
        value = F.col(f.name).cast("double")
        fractional = isinstance(f.dataType, (T.FloatType, T.DoubleType))
        stats.append(F.struct(
            F.lit(f.name).alias("column"),
            (F.count_if(value.isNotNull() & ~value.isin(0.0, 1.0)) == 0).alias("binary"),
            (F.avg(value.between(0, 1).cast("int")) if fractional else F.lit(None).cast("double")).alias("inside"),
            (count(value) if fractional else F.lit(0).cast("bigint")).alias("distinct"),
            F.count(value).alias("present"),
        ))
    profile = df.agg(F.array(*stats).alias("e")).select(F.posexplode("e").alias("position", "s")).select("position", "s.*")
    named = F.when(F.lower("column").rlike("pred|prob|pd|p_"), 0).otherwise(1)
    labels = profile.filter(F.col("binary") & (F.col("present") > 0)).select(
        F.lit("label").alias("role"), "column",
        F.row_number().over(W.orderBy("position")).alias("rank"))
    scores = profile.filter((F.col("inside") > 0.98) & (F.col("distinct") > 10)).select(
        F.lit("probability").alias("role"), "column",
        F.row_number().over(W.orderBy(named, F.desc("distinct"), "position")).alias("rank"))
    return labels.unionByName(scores)
