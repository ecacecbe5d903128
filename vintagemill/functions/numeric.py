"""Casting, clipping, ratios and probability transforms."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagemill.functions.dates import as_column, looks_like_a_number, parse_int

# Probability floor before a logit, and the bound on its argument.
PROB_FLOOR = 1e-6
LOGIT_BOUND = 30.0


def to_double(c: Column | str) -> Column:
    """Number or NULL: unparseable text and NaN both become NULL.

    The argument is referenced once, so stacked calls do not multiply a costly
    expression (a model prediction, say) when the optimizer inlines them.
    """
    return F.nanvl(as_column(c).try_cast("double"), F.lit(None).cast("double"))


def with_order_image(df: DataFrame, value: str, outs: Mapping[str, int]) -> DataFrame:
    """Adds the upper bits, as many as ``outs`` says, of a long that orders as the doubles of ``value`` do.

    The long is the bits of the number's size, with its sign; equal numbers have the same.  NULL
    stays NULL; the column must not hold NaN (see :func:`to_double`).  Exponent and
    fraction come from exact scalings by powers of two, and the exponent's estimate is
    mended where the logarithm was rounded across a power.  Steps are projections of
    their own, so that none is worked out twice.
    """
    size, power, part = F.abs(value), F.col("_power"), F.col("_part")
    estimate = F.greatest(F.lit(-1022), F.least(F.lit(1023), F.coalesce(F.floor(F.log2(size)), F.lit(-1022))))
    high, low = part >= 2, (part < 1) & (power > -1022)
    fraction = F.when(high, part / 2).when(low, part * 2).otherwise(part)
    steps = power + 1022 + F.when(high, 1).when(low, -1).otherwise(0)
    bits = F.when(size == float("inf"), F.lit(2047 << 52)).otherwise(steps * F.lit(1 << 52) + (fraction * 2.0**52).cast("bigint"))
    image = F.when(F.col(value) < 0, -bits).when(F.col(value).isNotNull(), bits)
    names = df.columns
    scaled = df.select(*names, estimate.cast("bigint").alias("_power")).select(*names, "_power", (size / F.pow(F.lit(2.0), power)).alias("_part"))
    return scaled.select(*names, image.alias("_image")).select(
        *names, *[(F.shiftright("_image", 64 - n).cast("int") if n <= 32 else F.shiftright("_image", 64 - n)).alias(c) for c, n in outs.items()])


def parse_double(c: Column | str) -> Column:
    """Number in a text column, else NULL (see :func:`parse_int` for the guard)."""
    text = F.trim(as_column(c))
    return F.when(looks_like_a_number(text), text.try_cast("double"))


def delinquency_number(status: Column | str, bad_codes: Iterable[str] = (), bad_at: int = 3) -> Column:
    """Months delinquent; letter codes are -1, unless listed in ``bad_codes``."""
    text = as_column(status)
    number = F.coalesce(parse_int(text), F.lit(-1))
    codes = list(bad_codes)
    return F.when(text.isin(codes), F.lit(bad_at)).otherwise(number) if codes else number


def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value on either side; NULL stays NULL (greatest/least skip NULL)."""
    value = as_column(c)
    bounded = value
    if low is not None:
        bounded = F.greatest(F.lit(low), bounded)
    if high is not None:
        bounded = F.least(F.lit(high), bounded)
    return F.when(value.isNotNull(), bounded)


def excess_over(c: Column | str, knot: float) -> Column:
    """Hinge feature ``max(c - knot, 0)``."""
    return clip(as_column(c) - F.lit(float(knot)), low=0.0)


def ratio(top: Column, bottom: Column, default: float | None = None) -> Column:
    """``top / bottom``; a zero denominator gives ``default`` (NULL if not set)."""
    quotient = F.try_divide(top.cast("double"), bottom.cast("double"))
    return quotient if default is None else F.coalesce(quotient, F.lit(default))


def clip_probability(c: Column | str) -> Column:
    return clip(as_column(c).cast("double"), PROB_FLOOR, 1 - PROB_FLOOR)


def logit(c: Column | str) -> Column:
    p = clip_probability(c)
    return F.log(p / (1 - p))


def sigmoid(z: Column, bound: float | None = LOGIT_BOUND) -> Column:
    z = clip(z, -bound, bound) if bound is not None else z
    return 1 / (1 + F.exp(-z))


def platt(c: Column | str, a: float | Column | None, b: float | Column | None, mode: str = "logit") -> Column:
    """Calibrated probability; identity when no scaler is given.

    ``mode="linear"`` applies the line to the probability itself, unbounded.
    """
    if a is None or b is None:
        return as_column(c)
    a, b = (x if isinstance(x, Column) else F.lit(float(x)) for x in (a, b))
    if mode == "linear":
        return sigmoid(a + b * clip_probability(c), bound=None)
    if mode != "logit":
        raise ValueError(f"unknown calibration mode {mode!r}")
    return sigmoid(a + b * logit(c))


def ks_from_counts(tp: Column, fp: Column, tn: Column, fn: Column) -> Column:
    """``tpr - fpr`` bounded to [0, 1]; 0 when a class is empty."""
    gap = ratio(tp, tp + fn) - ratio(fp, fp + tn)
    return F.coalesce(clip(gap, 0.0, 1.0), F.lit(0.0))


def approves(score: Column | str, threshold: float | Column, strict: bool = False) -> Column:
    """Low score is good: approve at or under the threshold (under, if strict)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    verdict = as_column(score) < t if strict else as_column(score) <= t
    return F.coalesce(verdict, F.lit(False))
