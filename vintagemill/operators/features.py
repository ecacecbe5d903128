"""Model features: cleaning, derived columns, splits, target-mean encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagemill import session
from vintagemill.functions import dates, numeric
from vintagemill.operators import columns, joins, ordered
from vintagemill.schemas import CLIP_RANGES, LABEL

# Split bounds (first year, last year), smoothing and encoded columns.
SPLIT_YEARS = {"train": (None, 2019), "valid": (2020, 2020), "test": (2021, 2022), "recent": (2023, None)}
SMOOTHING = 100.0
ENCODED = ("state", "channel", "purpose")
COERCED = ("fico", "dti", "ltv", "cltv", "orig_rate")


def coerce_numbers(df: DataFrame, names: Sequence[str] = COERCED) -> DataFrame:
    return df.withColumns({c: numeric.to_double(c) for c in names if c in df.columns})


def clip_features(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]] = CLIP_RANGES, null_out_of_range: bool = False
) -> DataFrame:
    """Bound features to their range; ``null_out_of_range`` drops sentinels instead."""

    def bounded(c: str, low: float, high: float) -> Column:
        if null_out_of_range:
            return F.when(F.col(c).between(low, high), F.col(c))
        return numeric.clip(c, float(low), float(high))

    return df.withColumns({c: bounded(c, *r) for c, r in ranges.items() if c in df.columns})


def derive(df: DataFrame) -> DataFrame:
    """Gap, hinge and interaction features of the columns at hand."""
    have = set(df.columns)
    new: dict[str, Column] = {}
    gap = F.lit(850.0) - F.col("fico") if "fico" in have else None
    if gap is not None:
        new["fico_gap"] = gap
    if "ltv" in have:
        new["ltv_80"] = numeric.excess_over("ltv", 80)
        new["ltv_90"] = numeric.excess_over("ltv", 90)
    if "dti" in have:
        new["dti_43"] = numeric.excess_over("dti", 43)
    if gap is not None and "ltv" in have:
        new["int_fico_gap_x_ltv"] = gap * F.col("ltv")
    if {"dti", "ltv"} <= have:
        new["int_dti_x_ltv"] = F.col("dti") * F.col("ltv")
    return df.withColumns(new)


def split_of(year: Column, years: Mapping[str, tuple[int | None, int | None]] = SPLIT_YEARS) -> Column:
    """Name of the first split whose years hold the given year; NULL in none."""
    chain = F
    for name, (first, last) in years.items():
        inside = F.lit(True)
        if first is not None:
            inside = inside & (year >= first)
        if last is not None:
            inside = inside & (year <= last)
        chain = chain.when(year.isNotNull() & inside, F.lit(name))
    return chain.otherwise(F.lit(None))


def with_split(
    df: DataFrame, years: Mapping[str, tuple[int | None, int | None]] = SPLIT_YEARS, vintage: str = "vintage_q"
) -> DataFrame:
    """Adds ``split``, from a vintage that is a date or text such as ``2019Q4``."""
    dated = isinstance(df.schema[vintage].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    year = F.year(vintage) if dated else dates.vintage_year(vintage)
    return df.withColumn("split", split_of(year, years))


def group_medians(df: DataFrame, value: str, by: str) -> DataFrame:
    """(by, median), written once because both the size check and the join use it."""
    table = ordered.medians(df, [value], [by]).select(by, "median")
    return session.materialise(table, "medians")


def spread_to_group(
    df: DataFrame, value: str = "orig_rate", by: str = "vintage_q", out: str = "rate_spread_vintage",
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Value minus its group median.

    Medians come from all rows of ``df``, or only from ``fit_on`` (for instance
    the training split) when given; groups unseen there get NULL.
    """
    medians = group_medians(fit_on if fit_on is not None else df, value, by)
    joined = joins.lookup_join(df, medians, [by], "group medians")
    return joined.withColumn(out, F.col(value) - F.col("median")).drop("median")


def feature_medians(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, median) of the training split."""
    return ordered.medians(df, names)


def median_values(df: DataFrame, names: Sequence[str]) -> dict[str, float]:
    """The same as a mapping: one number per model feature."""
    return {r["feature"]: r["median"] for r in feature_medians(df, names).collect()}


@dataclass
class TargetMeans:
    """Fitted encoder: smoothed label mean per category of each column."""

    table: DataFrame  # feature, category, encoded
    global_mean: float
    columns: tuple[str, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``<column>_te``; unseen and missing categories take the global mean."""
        for c in self.columns:
            mapping = self.table.filter(F.col("feature") == c).select(F.col("category").alias(c), "encoded")
            joined = joins.lookup_join(df, mapping, [c], f"{c} encoding")
            df = joined.withColumn(f"{c}_te", F.coalesce("encoded", F.lit(self.global_mean))).drop("encoded")
        return df


def fit_target_means(
    train: DataFrame, names: Sequence[str] = ENCODED, label: str = LABEL, smoothing: float = SMOOTHING
) -> TargetMeans:
    """Fit all encoders in one pass over the training rows."""
    present = tuple(c for c in names if c in train.columns)
    y = F.col(label).cast("int")
    overall = train.agg(F.avg(y).alias("m")).first()["m"]
    if overall is None:
        raise ValueError("no labelled training rows")
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in present])
    rows = train.select(y.alias("_y"), F.inline(entries)).filter(F.col("category").isNotNull())
    sums = rows.groupBy("feature", "category").agg(F.sum("_y").alias("bads"), F.count("_y").alias("n"))
    encoded = (F.col("bads") + F.lit(overall * smoothing)) / (F.col("n") + F.lit(smoothing))
    return TargetMeans(
        session.materialise(sums.select("feature", "category", encoded.alias("encoded")), "target-means"),
        overall,
        present,
    )


def build_features(
    abt: DataFrame, years: Mapping[str, tuple[int | None, int | None]] = SPLIT_YEARS, label: str = LABEL,
    null_out_of_range: bool = False,
) -> DataFrame:
    """Feature table with a ``split`` column.

    Loan key and slice columns travel along so that later joins have a key.
    """
    joins.require_columns(abt, [label, "vintage_q"], "abt")
    df = clip_features(coerce_numbers(abt), null_out_of_range=null_out_of_range)
    df = spread_to_group(df) if "orig_rate" in df.columns else df
    df = with_split(derive(df), years).filter(F.col("split").isNotNull())
    encoders = fit_target_means(df.filter(F.col("split") == "train"), label=label)
    df = encoders.transform(df)
    carried = [c for c in ("loan_id", "split", "vintage_q", *ENCODED, label) if c in df.columns]
    return df.select(*carried, *columns.numeric_features(df))
