"""Fixed layouts: raw file positions, dataset schemas, audit rules."""

from __future__ import annotations

from pyspark.sql import types as T

# Zero-based positions in the headerless acquisition file.
ACQ_POSITIONS = {
    "loan_id": 19,
    "fico": 0,
    "first_payment_date": 1,
    "orig_upb": 10,
    "orig_rate": 12,
    "ltv": 11,
    "cltv": 8,
    "dti": 9,
    "channel": 13,
    "purpose": 20,
    "occupancy": 7,
    "product": 15,
    "property_type": 17,
    "state": 16,
    "msa": 4,
    "loan_term": 21,
    "num_units": 6,
    "seller_name": 23,
    "servicer_name": 24,
    "first_time_buyer": 2,
}
ACQ_WIDTH = 1 + max(ACQ_POSITIONS.values())

# Positions in the headerless monthly performance file.
PERF_POSITIONS = {"loan_id": 0, "report_month": 1, "dq_status": 3}
PERF_WIDTH = 1 + max(PERF_POSITIONS.values())

INT_COLUMNS = ("fico", "msa", "loan_term", "num_units")
DOUBLE_COLUMNS = ("orig_upb", "orig_rate", "ltv", "cltv", "dti")
CATEGORY_COLUMNS = ("channel", "purpose", "occupancy", "product", "property_type", "state", "first_time_buyer")

LABEL = "default_within_24m"

ACQ_COLUMNS = [
    "loan_id", "fico", "first_payment_date", "orig_date", "orig_upb", "orig_rate", "ltv", "cltv", "dti",
    "channel", "purpose", "occupancy", "product", "property_type", "state", "msa", "loan_term",
    "num_units", "seller_name", "servicer_name", "first_time_buyer",
]
ABT_COLUMNS = [*ACQ_COLUMNS, "vintage_q", "window_end", "last_perf_month", "first_90dpd", LABEL]

# Plausible range per audited feature.
AUDIT_RULES = {
    "fico": (300, 850),
    "ltv": (0, 150),
    "cltv": (0, 200),
    "dti": (0, 80),
    "orig_rate": (0, 15),
    "orig_upb": (1, 2_000_000),
    "loan_term": (60, 480),
    "num_units": (1, 4),
}

# Clipping range per model feature.
CLIP_RANGES = {"dti": (0, 65), "ltv": (0, 120), "cltv": (0, 130), "fico": (300, 850)}

# Numeric inputs of the baseline models and the direction of risk.
MODEL_NUMERIC = ["fico", "orig_upb", "orig_rate", "ltv", "cltv", "dti", "loan_term", "num_units"]
MONOTONE_DIRECTIONS = {"fico": -1, "dti": 1, "ltv": 1, "cltv": 1, "orig_rate": 1}


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def raw_schema(width: int) -> T.StructType:
    """All-text schema of a headerless file; nothing is ever inferred."""
    return _struct({f"_c{i}": T.StringType() for i in range(width)})


def _abt_type(name: str) -> T.DataType:
    if name in INT_COLUMNS:
        return T.IntegerType()
    if name in DOUBLE_COLUMNS:
        return T.DoubleType()
    if name == LABEL:
        return T.BooleanType()
    dates = ("first_payment_date", "orig_date", "vintage_q", "window_end", "last_perf_month", "first_90dpd")
    return T.DateType() if name in dates else T.StringType()


ABT_SCHEMA = _struct({n: _abt_type(n) for n in ABT_COLUMNS})

# Macro files carry a header; months are written yyyy-MM.
UNEMPLOYMENT_SCHEMA = _struct({"date": T.StringType(), "state": T.StringType(), "unemp_rate": T.DoubleType()})
HPI_SCHEMA = _struct({"date": T.StringType(), "state": T.StringType(), "hpi_index": T.DoubleType()})
MORTGAGE_RATE_SCHEMA = _struct({"date": T.StringType(), "pmms_30y": T.DoubleType()})

PLATT_SCHEMA = _struct({"a": T.DoubleType(), "b": T.DoubleType()})
POLICY_SCHEMA = _struct({
    "threshold": T.DoubleType(),
    "metric": T.StringType(),
    "prob": T.StringType(),
    "approve_rate_recent": T.DoubleType(),
    "expected_bad_rate_on_approved": T.DoubleType(),
})
