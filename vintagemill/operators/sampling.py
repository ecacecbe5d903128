"""Exact-size samples that do not depend on partitioning, engine or run.

Rows are ordered by the MD5 of ``key:seed``.  Rows that share a key stand next to each
other, in the order of a hash of the whole row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintagemill import session
from vintagemill.operators import joins, ordered

# Hex digits of the hash that are counted: first 65,536 parts, then the cut parts in 65,536 again where they are large.
_PREFIXES = (4, 8)


def sample_order(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def sample_rows(df: DataFrame, k: int, key: str = "loan_id", seed: int = 13) -> DataFrame:
    """Exactly ``min(k, rows)`` rows."""
    return first_by_budget(df, F.lit(k), key, seed)


def first_by_budget(
    df: DataFrame, budget: Column, key: str, seed: int, by: Sequence[str] = ()
) -> DataFrame:
    """The first ``budget`` rows per ``by`` group in sample order; NULL is a group like any other.

    ``budget`` may be a literal or any expression that is constant within a
    group.  Hash, key and group are written once, and all counting reads them from there:
    rows are counted per hash prefix, which tells the one prefix per group that the budget
    cuts through, and its rows are ranked.  A second evaluation of the input keeps what
    lies before the row found.  Only where the budget cuts through the rows of one
    repeated key are these ranked by themselves.
    """
    by = list(by)
    groups = [f"_by{i}" for i in range(len(by))]
    # a struct of the value alone is never NULL, so groups compare as equal
    hashed = df.withColumns({
        **{g: F.struct(F.col(c).alias("v")) for g, c in zip(groups, by)}, "_budget": budget.cast("bigint"),
        "_place": F.struct(sample_order(key, seed).alias("hash"), F.col(key).alias("key"))})
    narrow = session.materialise(hashed.select(*groups, "_place", "_budget"), "sample-order")
    cut = narrow
    for digits in _PREFIXES:
        prefix = F.substring("_place.hash", 1, digits)
        running = W.partitionBy(*groups).orderBy("_prefix").rowsBetween(W.unboundedPreceding, 0)
        counted = cut.groupBy(*groups, prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"), F.max("_budget").alias("_left"))
        counted = counted.withColumn("_upto", F.sum("_n").over(running))
        # the part that holds the last row of the budget, and what is left for it
        ends = counted.filter((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_n") < F.col("_left")))
        # at most one short row per group
        taken = session.materialise(ends.select(*groups, "_prefix", "_n", (F.col("_left") - (F.col("_upto") - F.col("_n"))).alias("_rest")), "prefixes")
        cut = narrow.drop("_budget").withColumn("_prefix", prefix).join(F.broadcast(taken) if not by else taken, [*groups, "_prefix"])
        cut = cut.withColumn("_budget", F.col("_rest")).drop("_prefix", "_rest", "_n")
        if (taken.agg(F.max("_n")).first()[0] or 0) <= ordered.IN_ORDER:
            break
    inside = W.partitionBy(*groups).orderBy("_place")
    last = cut.withColumn("_rank", F.row_number().over(inside)).groupBy(*groups, "_place").agg(
        F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_same"), F.max("_budget").alias("_rest"))
    last = last.filter((F.col("_first") <= F.col("_rest")) & (F.col("_rest") < F.col("_first") + F.col("_same")))
    last = last.select(*groups, F.col("_place").alias("_last"), "_same", (F.col("_rest") - F.col("_first") + 1).alias("_keep"))
    last = session.materialise(last, "cutoffs")
    excess = bool(last.filter("_keep < _same").limit(1).count())
    # groups without a cutoff are within their budget
    if groups:
        kept = hashed.join(last, groups, "left")
    else:
        kept = hashed.withColumns({c: last.select(c).scalar() for c in ("_last", "_keep")})
    kept = kept.filter(F.col("_budget") > 0)
    if not excess:
        return kept.filter(F.coalesce(F.col("_place") <= F.col("_last"), F.lit(True))).select(*df.columns)
    before = kept.filter(F.coalesce(F.col("_place") < F.col("_last"), F.lit(True)))
    plain = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    rank = F.row_number().over(W.partitionBy(*groups).orderBy(F.xxhash64(*plain)))
    tied = kept.filter(F.col("_place") == F.col("_last")).withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_keep"))
    return before.select(*df.columns).unionByName(tied.select(*df.columns))


def downsample_negatives(
    df: DataFrame, label: str, ratio: float, key: str = "loan_id", seed: int = 42, by: Sequence[str] = ()
) -> DataFrame:
    """All positives, and at most ``int(ratio * max(1, positives))`` negatives, per group.

    Rows without a label are left out.  A ratio of 0 keeps everything.  NULL is a group.
    """
    if ratio <= 0:
        return df
    by = list(by)
    is_bad = F.col(label).cast("int") == 1
    take = F.floor(F.lit(float(ratio)) * F.greatest(F.lit(1), F.col("_pos"))).cast("bigint")
    positives = df.filter(is_bad)
    bads = df.groupBy(*by).agg(F.count_if(is_bad).alias("_pos"))
    negatives = df.filter(~is_bad)
    if by:
        # One short row per group; a struct of the value alone is never NULL, so groups compare as equal.
        same = {f"_g{i}": F.struct(F.col(c).alias("v")) for i, c in enumerate(by)}
        bads = session.materialise(bads.withColumns(same).select(*same, "_pos"), "bads")
        negatives = joins.lookup_join(negatives.withColumns(same), bads, list(same), "positives").drop(*same)
    else:
        negatives = negatives.withColumn("_pos", bads.scalar())
    kept = first_by_budget(negatives, take, key, seed, by)
    return positives.unionByName(kept.select(*df.columns))


def approximate_rate(df: DataFrame, rate: float, key: str = "loan_id", seed: int = 13) -> DataFrame:
    """About ``rate`` of the rows in one pass and without a shuffle, for when size need not be exact."""
    # Eight hex digits are 32 bits; keep the hashes below the wanted share of that range.
    position = F.conv(F.substring(sample_order(key, seed), 1, 8), 16, 10).cast("bigint")
    return df.filter(position < F.lit(int(rate * 2**32)))
