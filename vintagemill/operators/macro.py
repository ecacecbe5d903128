"""Macro series joined to loans by state and origination month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintagemill import session
from vintagemill.functions import dates
from vintagemill.operators import joins


def origination_month(df: DataFrame) -> DataFrame:
    """Adds ``orig_month`` (``yyyy-MM``).

    The choice of source is per dataset: the origination date if any row has one,
    otherwise the month before the first payment.
    """
    has_date = "orig_date" in df.columns and not df.filter(F.col("orig_date").isNotNull()).isEmpty()
    source = F.col("orig_date") if has_date else F.add_months("first_payment_date", -1)
    return df.withColumn("orig_month", dates.month_key(source))


def yearly_change(
    hpi: DataFrame, value: str = "hpi_index", date: str = "date", by: str = "state", calendar: bool = False,
    pad: bool = False, periods: int = 12, out: str = "hpi_12m_chg",
) -> DataFrame:
    """Relative change over 12 rows of each state's series.

    ``calendar`` looks up the same month one year earlier instead, which is right
    when months are missing.  ``pad`` carries the last known value over gaps first.
    """
    if calendar:
        earlier = hpi.select(by, F.add_months(date, periods).alias(date), F.col(value).alias("_past"))
        joined = hpi.join(earlier, [by, date], "left")
        return joined.withColumn(out, F.try_divide(F.col(value), F.col("_past")) - 1).drop("_past")
    series = W.partitionBy(by).orderBy(date)
    known: Column = F.col(value)
    if pad:
        filled = F.last(value, ignorenulls=True).over(series.rowsBetween(W.unboundedPreceding, 0))
        hpi = hpi.withColumn("_known", filled)
        known = F.col("_known")
    past = F.lag(known, periods).over(series)
    return hpi.withColumn(out, F.try_divide(known, past) - 1).drop("_known")


def with_macro(
    loans: DataFrame,
    unemployment: DataFrame | None = None,
    hpi: DataFrame | None = None,
    mortgage_rate: DataFrame | None = None,
) -> DataFrame:
    """Loans with unemployment, house prices and the market rate at origination.

    Every series is optional.  Each must have unique keys, so the join can never
    multiply loans.  Months may be written as months or as full dates.
    """
    df = origination_month(loans)
    month = dates.parse_month("date", ("yyyy-MM", "yyyy-MM-dd", "yyyyMM"))
    key = dates.month_key(month).alias("orig_month")
    if unemployment is not None:
        un = unemployment.select(key, "state", "unemp_rate")
        df = joins.lookup_join(df, un, ["state", "orig_month"], "unemployment")
    if hpi is not None:
        dated = hpi.withColumn("date", month)
        changed = yearly_change(dated).select(
            "state", dates.month_key("date").alias("orig_month"), "hpi_index", "hpi_12m_chg")
        df = joins.lookup_join(df, session.materialise(changed, "hpi"), ["state", "orig_month"], "hpi")
    if mortgage_rate is not None:
        rate = mortgage_rate.select(key, "pmms_30y")
        df = joins.lookup_join(df, rate, ["orig_month"], "mortgage_rate")
        df = df.withColumn("rate_spread", F.col("orig_rate") - F.col("pmms_30y"))
    return df


def months_present(df: DataFrame, date: str | None = "first_payment_date", vintage: str = "vintage_q") -> DataFrame:
    """Distinct ``yyyy-MM`` months of the data, sorted.

    Falls back from the date column to quarter starts, then to a fixed range.
    """
    if date and date in df.columns and not df.filter(F.col(date).isNotNull()).isEmpty():
        months = df.select(dates.month_key(date).alias("month"))
    elif vintage in df.columns:
        months = df.select(dates.month_key(dates.parse_vintage(vintage)).alias("month"))
    else:
        # The range covered when the data name no month.
        span = F.sequence(F.lit("2017-01-01").cast("date"), F.lit("2025-03-01").cast("date"), F.expr("interval 1 month"))
        months = df.sparkSession.range(1).select(F.explode(span).alias("d")).select(dates.month_key("d").alias("month"))
    return months.dropna().distinct().orderBy("month")


def states_present(df: DataFrame, state: str = "state") -> DataFrame:
    joins.require_columns(df, [state])
    return df.select(state).dropna().distinct().orderBy(state)


def macro_gaps(loans: DataFrame, macro: DataFrame, value: str) -> DataFrame:
    """(state, month) cells the loans could ask for that the series lacks or leaves empty."""
    months = months_present(loans).withColumnRenamed("month", "date")
    filled = macro.filter(F.col(value).isNotNull()).select("state", "date")
    return joins.missing_cells(filled, states_present(loans), months)
