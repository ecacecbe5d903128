"""Arrow batches of bounded bytes for operators whose rows may be very long texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_BYTES = 32 << 20
BATCH_ROWS = 2_000


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's batch limits to ours, if they are higher; results do not depend on them."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        now = spark.conf.get(key).rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
