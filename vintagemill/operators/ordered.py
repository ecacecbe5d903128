"""Global order without a global sort: radix prefixes, running totals, exact quantiles.

A window over an unpartitioned order would move every row into one task.  Here a
number has a 64-bit image that orders as it does; its upper 16 or 28 bits are its
bucket.  Totals of buckets are few, so running totals across them are cheap, and inside a
bucket a normal window finishes the job.  Buckets depend on the value alone: no pass over the data looks for edges,
a group whose values lie in a narrow band is spread as well as any other, and recomputed tasks
always agree.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintagemill import session
from vintagemill.functions import numeric

# Rows of one 16-bit prefix that one task may put in order.
IN_ORDER = 2_000_000


def keep_known(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL.

    One plain condition per column: a joint condition over many columns makes the
    optimizer derive every combination of them through later renames.
    """
    for c in names:
        df = df.filter(F.col(c).isNotNull())
    return df


def with_prefixes(df: DataFrame, value: str, *bits: int) -> DataFrame:
    """Adds ``prefix<n>``, the upper bits of the image of a column of doubles, for each number of bits."""
    return numeric.with_order_image(df, value, {f"prefix{n}": n for n in bits})


def with_buckets(df: DataFrame, edges: Mapping[str, Sequence[float]], prefix: str = "bucket_") -> DataFrame:
    """Adds ``<prefix><column>``: how many edges lie at or below the value; -1 for NULL and NaN."""
    cut = [c for c in edges if len(edges[c])]
    out = {c: f"{prefix}{c}" for c in edges}
    df = df.withColumns({f"_cut_{c}": numeric.to_double(c) for c in cut})
    if cut:
        df = Bucketizer(
            inputCols=[f"_cut_{c}" for c in cut],
            outputCols=[out[c] for c in cut],
            splitsArray=[[float("-inf"), *edges[c], float("inf")] for c in cut],
            handleInvalid="keep",
        ).transform(df)
    numbers = {out[c]: F.coalesce(F.col(out[c]).cast("int"), F.lit(-1)) for c in cut}
    numbers |= {out[c]: F.when(numeric.to_double(c).isNull(), -1).otherwise(0) for c in edges if c not in cut}
    return df.withColumns(numbers).drop(*[f"_cut_{c}" for c in cut])


def running_totals(counts: DataFrame, order: str, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Adds ``run_<m>`` (inclusive running total in ascending ``order``) and ``all_<m>``.

    Expects one row per (``by``, ``order``) with its ``prefix28`` and no NULL group.  A window spans
    the 28-bit prefixes of a group, which are 65,536 to a power of two at most, or the values of one of them.
    """
    by = list(by)
    across = W.partitionBy(*by).orderBy("prefix28").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    offsets = counts.groupBy(*by, "prefix28").agg(*[F.sum(m).alias(m) for m in measures]).select(
        *by, "prefix28",
        *[F.coalesce(F.sum(m).over(across), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(m).over(whole).alias(f"all_{m}") for m in measures])
    inside = W.partitionBy(*by, "prefix28").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    runs = {f"run_{m}": F.col(f"_off_{m}") + F.sum(m).over(inside) for m in measures}
    return counts.join(offsets, [*by, "prefix28"]).withColumns(runs).drop("prefix28", *[f"_off_{m}" for m in measures])


def _matched(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on key columns of both; ``other``'s own are dropped.

    For a plain equality the optimizer puts a test for NULL on each key below everything
    that works the key out, and so works all that out twice; the code of the scan then
    grows beyond what the JVM compiles, and every row is interpreted.
    """
    renamed = other.withColumnsRenamed({c: f"_of_{c}" for c in keys})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys]
    return df.join(renamed, reduce(and_, same), how).drop(*[f"_of_{c}" for c in keys])


def _holding(counts: DataFrame, wanted: DataFrame, group: Sequence[str], part: str) -> DataFrame:
    """Parts of the counted ones that hold a wanted rank of their group, with the ranks counted from their start."""
    upto = W.partitionBy(*group).orderBy(part).rowsBetween(W.unboundedPreceding, 0)
    placed = counts.withColumn("_upto", F.sum("n").over(upto)).withColumn("_from", F.col("_upto") - F.col("n"))
    met = _matched(placed, wanted, group).filter((F.col("high") >= F.col("_from")) & (F.col("low") < F.col("_upto")))
    ranks = [(F.col(c) - F.col("_from")).alias(c) for c in ("low", "high")]
    return met.select(*group, part, "n", "q", *ranks, "share")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (),
) -> DataFrame:
    """Exact quantiles with linear interpolation: (by..., feature, q, value).

    The input is evaluated twice.  Counts of all columns' 16-bit prefixes, in one
    aggregation, tell which few hold the wanted ranks; only their values are counted one
    by one.  Where such a prefix has more than ``IN_ORDER`` rows, only its 28-bit prefixes
    that are hit are put in order.  NULL and NaN values, and NULL groups, are left out.
    """
    by, spark = list(by), df.sparkSession
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), (numeric.to_double(c) + F.lit(0.0)).alias("value")) for c in columns])  # no negative zero
    long = with_prefixes(keep_known(df, by).select(*by, F.inline(entries)).filter(F.col("value").isNotNull()), "value", 16, 28)
    group, outer = [*by, "feature"], [*by, "feature", "prefix16"]
    counts = long.groupBy(*outer).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(W.partitionBy(*group))
    ranked = counts.withColumn("_total", total).select(
        *outer, "n", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("q"),
        ((F.col("_total") - 1) * F.col("q")).alias("_at"))
    ranked = ranked.select(*group, "q", F.floor("_at").alias("low"), F.ceil("_at").alias("high"), (F.col("_at") - F.floor("_at")).alias("share"))
    wanted = _holding(counts, ranked.distinct(), group, "prefix16")
    if by:
        wanted = session.materialise(wanted, "ranks")
        rows, most = wanted.agg(F.count(F.lit(1)), F.max("n")).first()
    else:  # at most two rows for each column and quantile
        found = wanted.collect()
        wanted = spark.createDataFrame(found, wanted.schema)
        rows, most = len(found), max((r["n"] for r in found), default=0)
    ranks, holders = wanted.drop("n"), wanted.select(*outer).distinct()
    each_value = [*outer, "prefix28", "value"]
    if session.may_broadcast(rows, holders.schema):
        # The usual case: drop all other prefixes during the scan.
        held = _matched(long, F.broadcast(holders), outer, "left_semi")
        values = held.groupBy(*each_value).agg(F.count(F.lit(1)).alias("n"))
    else:
        # Very many groups: combine equal values before anything is shuffled.
        values = long.groupBy(*each_value).agg(F.count(F.lit(1)).alias("n"))
        values = _matched(values, holders, outer, "left_semi")
    if (most or 0) <= IN_ORDER:
        found = _holding(values.drop("prefix28"), ranks, outer, "value")
    else:
        inner = [*outer, "prefix28"]
        values = session.materialise(values, "values")
        fine = _holding(values.groupBy(*inner).agg(F.sum("n").alias("n")), ranks, outer, "prefix28").drop("n")
        found = _holding(values.join(fine.select(*inner).distinct(), inner, "left_semi"), fine, inner, "value")
    # the two ranks are neighbours: they hit one value, or two next to each other, be it in different prefixes
    ends = found.groupBy(*group, "q").agg(F.min("value").alias("a"), F.max("value").alias("b"), F.max("share").alias("share"))
    return ends.select(*group, "q", (F.col("a") + (F.col("b") - F.col("a")) * F.col("share")).alias("value"))


def quantile_values(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float]:
    """The quantiles of one column as driver values: bounded by the list asked for."""
    found = {r["q"]: r["value"] for r in exact_quantiles(df, [column], probabilities).collect()}
    return [found[float(p)] for p in probabilities] if found else []


def medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, median)."""
    return exact_quantiles(df, columns, [0.5], by).drop("q").withColumnRenamed("value", "median")
