"""One-row JSON documents: policy choice and its versions, scaler, medians, metrics."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagemill.schemas import POLICY_SCHEMA


def write_document(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a one-row table as one JSON document; any other number of rows is an error."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"a document is one row, not {'none' if not rows else 'several'}")
    df.sparkSession.createDataFrame(rows, df.schema).coalesce(1).write.mode(mode).json(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def map_document(pairs: DataFrame, key: str, value: str, name: str = "entries") -> DataFrame:
    """Key/value rows (one per feature) as a single map-typed row."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key), F.col(value))))
    return pairs.agg(F.map_from_entries(entries).alias(name))


def policy_record(spark: SparkSession, values: Mapping[str, object]) -> DataFrame:
    unknown = set(values) - set(POLICY_SCHEMA.names)
    if unknown:
        raise ValueError(f"not policy fields: {sorted(unknown)}")
    fields = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in POLICY_SCHEMA]
    return spark.range(1).select(*fields)


def update_policy(record: DataFrame, changes: Mapping[str, object]) -> DataFrame:
    """Stored record with the given (non-None) fields replaced."""
    unknown = set(changes) - set(POLICY_SCHEMA.names)
    if unknown:
        raise ValueError(f"not policy fields: {sorted(unknown)}")
    return record.select(*[
        F.coalesce(F.lit(changes.get(f.name)).cast(f.dataType), F.col(f.name)).alias(f.name)
        for f in POLICY_SCHEMA
    ])


def latest_policy(history: DataFrame, at: str = "updated_at") -> DataFrame:
    """Newest row of an append-only policy history."""
    fields = F.struct(*[F.col(n) for n in POLICY_SCHEMA.names])
    return history.agg(F.max_by(fields, F.col(at)).alias("r")).select("r.*")


_VERSION = re.compile(r"^policy-(\d+)\.json$")


def _folder(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _version_path(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/policy-{version:06d}.json"


def policy_versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the stored records, ascending; a folder that does not exist has none."""
    path, files = _folder(spark, folder)
    names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
    return sorted(int(m[1]) for m in map(_VERSION.match, names) if m)


def read_policy(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The record of this number, or the last one.

    A record without content is an error: its writer is still at work, or was lost and
    the file must be removed by hand.
    """
    number = version or max(policy_versions(spark, folder), default=None)
    if number is None:
        raise FileNotFoundError(f"no policy record in {folder}")
    record = read_document(spark, _version_path(folder, number), POLICY_SCHEMA)
    if record.isEmpty():
        raise ValueError(f"policy record {number} in {folder} has no content")
    return record


def append_policy(spark: SparkSession, folder: str, changes: Mapping[str, object], base: int | None = None) -> int:
    """Stores the record with these (non-None) changes under the next number, and returns that.

    ``base`` is the number the changes were worked out from, the last one if not given, 0
    for a first record.  Files are created, never overwritten, so of two writers with one
    base the second fails, as far as the store creates files exclusively; earlier records stay.
    """
    known = policy_versions(spark, folder)
    start = max(known, default=0) if base is None else base
    if start != max(known, default=0):
        raise FileExistsError(f"policy record {start} in {folder} is not the last one any more")
    if start:
        record = update_policy(read_policy(spark, folder, start), changes)
    else:
        record = policy_record(spark, changes)
    text = json.dumps({k: v for k, v in record.first().asDict().items() if v is not None})
    path, files = _folder(spark, _version_path(folder, start + 1))
    try:
        out = files.create(path, False)
    except Py4JJavaError as error:
        if files.exists(path):
            raise FileExistsError(f"policy record {start + 1} in {folder} was written by another") from error
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return start + 1
