"""Session-level helpers: the shared scratch folder and written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Tables up to this size are broadcast; beyond it they are shuffled.
BROADCAST_BYTES = 16 << 20
# What a value is taken to need: text and nested values have no width of their own.
_WIDE_VALUE = 128

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, laptops) may fall back to a temp folder;
    on a cluster an unset folder is an error because a machine-local path would
    be lost together with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="vintagemill-")
    return _local_folders[context.applicationId]


def may_broadcast(rows: int, schema: T.StructType) -> bool:
    """Whether so many rows of this schema are small enough to broadcast."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
    width = sum(8 if isinstance(f.dataType, fixed) else _WIDE_VALUE for f in schema)
    return rows * width <= BROADCAST_BYTES


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/vintagemill/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts lineage for results that several later jobs share, survives the loss of
    executors, and gives the optimizer real file sizes to choose joins by.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
