"""Display names to the codes used in the loan files."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from vintagemill.functions.dates import as_column

# Codes behind the names on an application.
STATE_CODES = {
    "California": "CA", "Texas": "TX", "Florida": "FL", "New York": "NY", "Illinois": "IL",
    "Ohio": "OH", "Georgia": "GA", "Pennsylvania": "PA", "New Jersey": "NJ", "Arizona": "AZ",
    "Virginia": "VA", "North Carolina": "NC", "Washington": "WA", "Colorado": "CO",
    "Tennessee": "TN", "Michigan": "MI", "Minnesota": "MN", "Indiana": "IN",
    "Massachusetts": "MA", "Maryland": "MD", "Other": "OT",
}
PURPOSE_CODES = {"Purchase": "P", "No cash-out refinance": "N", "Cash-out refinance": "C"}
CHANNEL_CODES = {"Retail": "R", "Correspondent": "C", "Broker": "B"}
OCCUPANCY_CODES = {"Primary residence": "P", "Second home": "S", "Investor": "I"}
PROPERTY_CODES = {"Single Family": "SF", "Condo/Coop": "CO", "Planned Unit Dev": "PU", "Manufactured": "MH"}

CODE_TABLES = {
    "state": STATE_CODES,
    "purpose": PURPOSE_CODES,
    "channel": CHANNEL_CODES,
    "occupancy": OCCUPANCY_CODES,
    "property_type": PROPERTY_CODES,
}


def code_of(c: Column | str, table: Mapping[str, str]) -> Column:
    """Code for a display name; NULL when the name is not in the table."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(pairs, as_column(c))


def one_hot(c: Column | str, prefix: str, codes: list[str]) -> list[Column]:
    """One 0/1 column ``<prefix>_<code>`` per code."""
    value = as_column(c)
    return [
        F.coalesce((value == code).cast("double"), F.lit(0.0)).alias(f"{prefix}_{code}") for code in codes
    ]
