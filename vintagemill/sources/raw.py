"""Headerless raw files: discovery, scan, layout profile, named projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagemill.functions import dates, numeric
from vintagemill.schemas import (
    ACQ_COLUMNS,
    ACQ_POSITIONS,
    DOUBLE_COLUMNS,
    INT_COLUMNS,
    PERF_POSITIONS,
    raw_schema,
)

RAW_GLOB = "*.{txt,csv}"
# Delimiters considered, first one wins a tie.
DELIMITERS = {"|": "pipe", ",": "comma", "\t": "tab"}


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", RAW_GLOB)
    return reader.text(paths if isinstance(paths, str) else list(paths))


def list_raw_files(spark: SparkSession, folder: str, years: Sequence[str] | None = None) -> list[str]:
    """Text and CSV files below ``folder``, sorted, from the file index alone.

    ``years`` keeps paths that contain one of the given strings.  An empty result
    is an error.
    """
    files = sorted(_lines(spark, folder).inputFiles())
    if years:
        wanted = [str(y).strip() for y in years]
        files = [f for f in files if any(y in f for y in wanted)]
    if not files:
        raise FileNotFoundError(f"no raw files under {folder} (years={years})")
    return files


def scan_folder(spark: SparkSession, folder: str, width: int, sep: str = "|", years: Sequence[str] | None = None) -> DataFrame:
    """All raw files below ``folder``, those of the given years only, as one scan; none is an error.

    Files are chosen by a condition on their path, so no list of them is built here.
    """
    df = read_headerless(spark, folder, width, sep)
    if years:
        path, chosen = F.col("_metadata.file_path"), F.lit(False)
        for year in years:
            chosen = chosen | path.contains(str(year).strip())
        df = df.filter(chosen)
    if df.isEmpty():
        raise FileNotFoundError(f"no raw rows under {folder} (years={years})")
    return df


def file_table(spark: SparkSession, folder: str, years: Sequence[str] | None = None) -> DataFrame:
    """One row per non-empty raw file: its path below ``folder`` and its line count."""
    lines = _lines(spark, list_raw_files(spark, folder, years))
    path = F.regexp_replace("path", "^.*?/" + folder.rstrip("/").rsplit("/", 1)[-1] + "/", "")
    return (
        lines.select(F.col("_metadata.file_path").alias("path"))
        .groupBy("path")
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .select(path.alias("file"), "n_lines")
    )


def read_headerless(spark: SparkSession, paths: str | Sequence[str], width: int, sep: str = "|") -> DataFrame:
    """One parallel scan over all files, every field as text, addressed ``_c<i>``.

    Short lines are padded with NULL; empty fields are NULL.
    """
    reader = (
        spark.read.schema(raw_schema(width))
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", RAW_GLOB)
        .option("header", False)
        .option("sep", sep)
        .option("enforceSchema", True)
    )
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def layout_profile(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Per file (full path): delimiter guess, field counts and whether a header seems present.

    The delimiter is the one that occurs most often on a line.  A header is a first line
    whose fields are all worded (letters, no digits) above lines of which some field has a digit;
    a file of one line has none.  The layout is read in one pass over the text.
    """
    counts = {name: F.length("value") - F.length(F.replace("value", F.lit(d))) for d, name in DELIMITERS.items()}
    lines = _lines(spark, paths).select(
        F.col("_metadata.file_path").alias("file"),
        # lines within a task are numbered by the order they are read in; a file's first line is in its split from 0.
        # One number, as rows are sorted to find the least of a struct
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("place"),
        *[c.alias(name) for name, c in counts.items()],
        F.col("value").rlike(r"^[^0-9]*[A-Za-z][^0-9]*$").alias("worded"),
        F.col("value").rlike("[0-9]").alias("numbered"),
    )
    profile = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_lines"),
        *[F.max(name).alias(f"max_{name}") for name in DELIMITERS.values()],
        *[F.min(name).alias(f"min_{name}") for name in DELIMITERS.values()],
        F.min_by("worded", "place").alias("first_worded"),
        F.count_if("numbered").alias("numbered_lines"),
    )
    top = F.greatest(*[F.col(f"max_{n}") for n in DELIMITERS.values()])

    def of_winner(prefix: str):
        chain = F
        for name in DELIMITERS.values():
            chain = chain.when(F.col(f"max_{name}") == top, F.col(f"{prefix}_{name}"))
        return chain.otherwise(F.lit(0))

    delimiter = F
    for name in DELIMITERS.values():
        delimiter = delimiter.when(F.col(f"max_{name}") == top, F.lit(name))
    return profile.select(
        "file",
        "n_lines",
        delimiter.otherwise(F.lit("pipe")).alias("delimiter"),
        (of_winner("min") + 1).alias("min_fields"),
        (of_winner("max") + 1).alias("max_fields"),
        (F.col("first_worded") & (F.col("numbered_lines") > 0)).alias("header_likely"),
    )


def project_acquisition(raw: DataFrame) -> DataFrame:
    """Positions to named, typed acquisition columns; bad numbers become NULL."""

    def column(name: str):
        if name == "orig_date":
            return F.lit(None).cast("date")
        field = F.col(f"_c{ACQ_POSITIONS[name]}")
        if name == "first_payment_date":
            return dates.parse_month(field)
        if name in INT_COLUMNS:
            return dates.parse_int(field)
        return numeric.parse_double(field) if name in DOUBLE_COLUMNS else field

    return raw.select(*[column(n).alias(n) for n in ACQ_COLUMNS])


def project_performance(raw: DataFrame) -> DataFrame:
    field = {name: F.col(f"_c{i}") for name, i in PERF_POSITIONS.items()}
    return raw.select(
        field["loan_id"].alias("loan_id"),
        dates.parse_month(field["report_month"]).alias("report_month"),
        field["dq_status"].alias("dq_status"),
    )
