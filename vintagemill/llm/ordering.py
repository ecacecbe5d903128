"""The row that follows each row in a total order, without a sort in one task."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_buckets(df: DataFrame, key: str, name: str, per_partition: int = 4) -> DataFrame:
    """Adds an integer bucket that rises with ``key``; NULL keys get bucket -1.

    The edges are approximate quantiles, a few per shuffle partition; each row finds its
    bucket by counting the edges up to its key, first among every s-th of s * s edges,
    then among the s from there.  Equal keys share a bucket whatever the edges are.
    """
    n = max(1, per_partition * shuffle_partitions(df))
    shares = [i / n for i in range(1, n)]
    edges = df.agg(F.percentile_approx(F.col(key), shares, 10 * n).alias("e")).first()["e"] if shares else None
    edges = sorted(set(edges or []))
    if not edges:
        return df.withColumn(name, F.when(F.col(key).isNull(), -1).otherwise(0))
    s = math.isqrt(len(edges) - 1) + 1
    chunks = [edges[i: i + s] for i in range(0, len(edges), s)]

    def up_to_key(edges: Column) -> Column:
        return F.size(F.filter(edges, lambda e: e <= F.col(key)))

    chunk = up_to_key(F.array(*[F.lit(c[0]) for c in chunks])) - 1
    nested = F.array(*[F.array(*map(F.lit, c)) for c in chunks])
    df = df.withColumn(name, chunk)
    place = F.col(name) * s + up_to_key(F.get(nested, F.col(name)))
    return df.withColumn(name, F.when(F.col(key).isNull(), -1).when(F.col(name) < 0, 0).otherwise(place))


def with_next(df: DataFrame, key: str, tie: list[str], carry: dict[str, str],
              derive: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Adds columns of the next row in descending ``key`` order; after the last row comes the first.

    ``carry`` maps a column to the name its next value gets; ``derive`` may add such columns,
    row by row, before the rows are shuffled.  NULL keys come last; equal
    keys are ordered by ``tie`` ascending.  A single row is its own next row.

    Rows are shuffled once, by range bucket.  The first row of each bucket visits the
    bucket before it as a guest, so that its last row finds its successor there; guests
    are as many as there are buckets.
    """
    bucket, guest = "_bucket", "_guest"
    rows = range_buckets(df, key, bucket)
    order = [F.col(key).desc_nulls_last(), *[F.col(c).asc() for c in tie]]
    tops = rows.groupBy(bucket).agg(F.max(key).alias("_top"))
    # the bucket before, in descending order; the order of buckets is a short list
    before = Window.orderBy(F.col(bucket).desc())
    tops = tops.select(bucket, "_top", F.coalesce(F.lag(bucket).over(before), F.min(bucket).over(Window.partitionBy())).alias("_host"))
    tops = tops.select(F.col(bucket).alias("_b"), "_top", "_host")
    heads = rows.join(F.broadcast(tops), (F.col(bucket) == F.col("_b")) & F.col(key).eqNullSafe(F.col("_top")))
    heads = heads.withColumn("_rank", F.row_number().over(Window.partitionBy("_b").orderBy(*order))).where("_rank = 1")
    guests = heads.withColumn(bucket, F.col("_host")).withColumn(guest, F.lit(1))
    everyone = derive(rows.withColumn(guest, F.lit(0)).unionByName(guests.select(*df.columns, bucket, guest)))
    follow = Window.partitionBy(bucket).orderBy(F.col(guest), *order)
    everyone = everyone.select("*", *[F.lead(c).over(follow).alias(to) for c, to in carry.items()])
    return everyone.where(F.col(guest) == 0).drop(bucket, guest)
