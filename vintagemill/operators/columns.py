"""Column selection and conformance, decided on the schema alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagemill.functions import numeric
from vintagemill.schemas import LABEL

# Columns that never are model features.
NOT_FEATURES = (
    LABEL, "loan_id", "loanid", "first_payment_date", "first_90dpd", "orig_date", "orig_dt", "report_dt",
    "as_of_date", "snapshot_date", "issue_dt", "disbursement_date", "vintage_q", "window_end", "last_perf_month",
)


def numeric_features(df: DataFrame, drop: Sequence[str] = NOT_FEATURES) -> list[str]:
    """Numeric columns outside the drop list; booleans and dates are not numeric."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in drop]


def all_features(df: DataFrame, drop: Sequence[str] = NOT_FEATURES) -> list[str]:
    """Every column outside the drop list that is not a date or timestamp."""
    dated = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema if f.name not in drop and not isinstance(f.dataType, dated)]


def conform(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Features in model order as numbers; absent ones and bad values are NULL."""
    present = set(df.columns)
    kept = [k for k in keep if k in present and k not in features]
    numbers = [
        (numeric.to_double(f) if f in present else F.lit(None).cast("double")).alias(f) for f in features
    ]
    return df.select(*kept, *numbers)


def impute(df: DataFrame, features: Sequence[str], medians: Mapping[str, float | None], default: float = 0.0) -> DataFrame:
    """NULL features take the training median, or the default where there is none."""
    values = {f: medians.get(f) for f in features}
    return df.na.fill({f: float(default if v is None else v) for f, v in values.items()})
