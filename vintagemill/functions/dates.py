"""Month, quarter and vintage parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two month formats found in the raw files.
MONTH_FORMATS = ("yyyy-MM-dd", "yyyyMM")


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(c: Column | str) -> Column:
    """Whole number in a text column, else NULL; a decimal or exponent form is rounded half away from zero.

    A failed ``try_cast`` raises and catches an exception for its row, which costs
    many times the cast itself, so the form of the text decides which cast is tried.
    """
    text = F.trim(as_column(c))
    # up to nine digits always fit
    plain = F.when(text.rlike(r"^[+-]?[0-9]{1,9}$"), text.try_cast("int"))
    number = F.when(~text.rlike(r"^[+-]?[0-9]{1,9}$") & looks_like_a_number(text), F.round(text.try_cast("double")))
    fits = number.between(-(2.0**31), 2.0**31 - 1)
    return F.coalesce(plain, F.when(fits, number.try_cast("int")))


def looks_like_a_number(text: Column) -> Column:
    """Digits, perhaps with a sign, a point and an exponent."""
    return text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$")


def parse_date(c: Column | str, formats: tuple[str, ...] = MONTH_FORMATS) -> Column:
    """Date written as year, month and perhaps day, one or two digits each; NULL otherwise.

    Text is trimmed; a time of day after the date is allowed.  Dates are put together from
    digits, which is far cheaper than trying time formats row by row.
    """
    text = F.trim(as_column(c).cast("string"))
    options = {
        "yyyy-MM-dd": r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})([ T].*)?$",
        "yyyy-MM": r"^([0-9]{4})-([0-9]{1,2})()$",
        "yyyyMM": r"^([0-9]{4})([0-9]{2})()$",
    }

    def put_together(pattern: str) -> Column:
        year, month, day = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
        day = F.when(day == "", "1").otherwise(day)
        # a day the month does not have gives NULL
        return F.when(text.rlike(pattern), F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date"))

    return F.coalesce(*[put_together(options[f]) for f in formats])


def parse_month(c: Column | str, formats: tuple[str, ...] = MONTH_FORMATS) -> Column:
    """First day of the month written in ``c``; NULL when no format fits."""
    return F.trunc(parse_date(c, formats), "MM")


def quarter_start(c: Column | str) -> Column:
    return F.trunc(as_column(c), "quarter")


def month_key(c: Column | str) -> Column:
    """``yyyy-MM`` text key; NULL stays NULL."""
    return F.date_format(as_column(c), "yyyy-MM")


def parse_vintage(c: Column | str) -> Column:
    """Lenient vintage: full date (a time may follow), ``2021Q3``/``2021-Q3``, ``2021-07``/``2021/07``."""
    text = F.trim(as_column(c).cast("string"))
    full = parse_date(text, ("yyyy-MM-dd",))

    def first_of(pattern: str, month: Column) -> Column:
        year = parse_int(F.regexp_extract(text, pattern, 1))
        return F.when(text.rlike(pattern) & month.between(1, 12), F.make_date(year, month, F.lit(1)))

    quarter = r"(?i)^(\d{4})-?Q([1-4])"
    by_quarter = first_of(quarter, parse_int(F.regexp_extract(text, quarter, 2)) * 3 - 2)
    month = r"^(\d{4})[-/](\d{1,2})$"
    by_month = first_of(month, parse_int(F.regexp_extract(text, month, 2)))
    return F.coalesce(full, by_quarter, by_month)


def vintage_year(c: Column | str) -> Column:
    """Year of a vintage given as text: ``2019Q4``, ``2019-10``, ``2019-10-01``."""
    return parse_int(F.regexp_extract(as_column(c).cast("string"), r"^(\d{4})", 1))
