"""Labelled loans: delinquency history, 24-month outcome, window censoring."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagemill.functions import dates, numeric
from vintagemill.schemas import LABEL

SERIOUS_DELINQUENCY = 3
WINDOW_MONTHS = 24


def with_delinquency(perf: DataFrame, bad_codes: Iterable[str] = ()) -> DataFrame:
    return perf.withColumn("dq_num", numeric.delinquency_number("dq_status", bad_codes))


def first_serious_delinquency(perf: DataFrame) -> DataFrame:
    """First month 90+ days late per loan that ever got there (needs ``dq_num``)."""
    late = perf.filter(F.col("dq_num") >= SERIOUS_DELINQUENCY)
    return late.groupBy("loan_id").agg(F.min("report_month").alias("first_90dpd"))


def last_report(perf: DataFrame) -> DataFrame:
    return perf.groupBy("loan_id").agg(F.max("report_month").alias("last_perf_month"))


def loan_history(perf: DataFrame, bad_codes: Iterable[str] = ()) -> DataFrame:
    """Last report and first serious delinquency in one aggregation pass."""
    dq = numeric.delinquency_number("dq_status", bad_codes)
    late_month = F.when(dq >= SERIOUS_DELINQUENCY, F.col("report_month"))
    return perf.groupBy("loan_id").agg(
        F.max("report_month").alias("last_perf_month"), F.min(late_month).alias("first_90dpd")
    )


def outcome_label(first_late: Column, window_end: Column) -> Column:
    """True when the first serious delinquency falls inside the window; never NULL."""
    return F.coalesce(first_late <= window_end, F.lit(False))


def with_window(loans: DataFrame) -> DataFrame:
    first = F.col("first_payment_date")
    return loans.withColumns({
        "vintage_q": dates.quarter_start(first),
        "window_end": F.add_months(first, WINDOW_MONTHS),
    })


def observed_full_window(loans: DataFrame, keep_early_bads: bool = False) -> DataFrame:
    """Loans still reporting at the end of their window.

    This also drops loans that defaulted and left early; ``keep_early_bads``
    retains those.
    """
    observed = F.col("last_perf_month") >= F.col("window_end")
    return loans.filter(observed | F.col(LABEL) if keep_early_bads else observed)


def label_loans(
    acq: DataFrame, perf: DataFrame, bad_codes: Iterable[str] = (), keep_early_bads: bool = False
) -> DataFrame:
    """One labelled row per loan.

    The monthly panel is reduced to one row per loan before it meets the loans.
    The join is inner because a loan without reports can never pass the window
    filter.
    """
    joined = with_window(acq).join(loan_history(perf, bad_codes), "loan_id")
    labelled = joined.withColumn(LABEL, outcome_label(F.col("first_90dpd"), F.col("window_end")))
    return observed_full_window(labelled, keep_early_bads)
