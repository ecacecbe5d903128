"""Parquet datasets and CSV reports."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_dataset(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """Parquet scan; columns and filter reach the file reader."""
    df = spark.read.parquet(path)
    df = df.filter(where) if where is not None else df
    return df.select(*columns) if columns else df


def read_union(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several datasets appended by column name, from an explicit list.

    A wildcard is not taken: it would also match samples and splits that lie
    beside the datasets.
    """
    if not paths:
        raise ValueError("no datasets to combine")
    union = spark.read.parquet(paths[0])
    for path in paths[1:]:
        union = union.unionByName(spark.read.parquet(path), allowMissingColumns=True)
    return union


def write_dataset(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists"
) -> None:
    """Parquet sink.

    With partition columns, rows are rebalanced on them: small vintages are
    gathered into few files, while a vintage that holds a third of the data is
    split over many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


@contextmanager
def open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Writes by partition columns inside hold up to ``most`` files open in a task.

    Spark otherwise sorts a task's rows by these columns, all its rows at once in memory.
    The files have the same rows.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def clean_names(names: Sequence[str]) -> list[str]:
    return [re.sub(r"\s+", "_", n.strip().lower()) for n in names]


def read_report(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; names are stripped, lowered and joined by underscores.

    With a schema, columns are found by name, wherever they stand, and cast; a value
    that does not fit is NULL, a column that is not there is an error.
    """
    df = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).csv(path)
    df = df.toDF(*clean_names(df.columns))
    if schema is None:
        return df
    missing = [n for n in schema.names if n not in df.columns]
    if missing:
        raise ValueError(f"{path} has no columns {missing}")
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def read_optional_report(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Like :func:`read_report`, but a missing file is None: the feature is skipped."""
    try:
        return read_report(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_report(df: DataFrame, path: str, single_file: bool = True, mode: str = "errorifexists") -> None:
    """CSV sink.  ``single_file`` is for report tables of at most a few hundred rows."""
    (df.coalesce(1) if single_file else df).write.mode(mode).option("header", True).csv(path)
