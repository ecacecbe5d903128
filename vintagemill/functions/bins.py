"""Binning expressions.  Right-closed and left-closed bins are separate helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vintagemill.functions.dates import as_column

# Report bins (upper edges with labels) and interval edges.
LABELLED_BINS = {
    "fico": ([620, 660, 700, 740, 780], ["<=620", "621-660", "661-700", "701-740", "741-780", ">780"]),
    "ltv": ([60, 70, 80, 90, 97], ["<=60", "61-70", "71-80", "81-90", "91-97", ">97"]),
    "dti": ([30, 35, 40, 45, 50], ["<=30", "31-35", "36-40", "41-45", "46-50", ">50"]),
}
INTERVAL_EDGES = {
    "fico": [500, 580, 620, 660, 700, 740, 780, 850],
    "dti": [0, 20, 30, 36, 43, 50, 65, 1000],
    "ltv": [0, 60, 70, 80, 90, 97, 100, 500],
}


def _first_match(cases: Sequence[tuple[Column, object]], default: object = None) -> Column:
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default))


def labelled_bins(
    c: Column | str, edges: Sequence[float], labels: Sequence[str], compat: bool = False
) -> Column:
    """Label of the first edge that ``c`` does not exceed, last label beyond.

    NULL has no bin.  ``compat=True`` reproduces the published reports, whose
    last edge is never tested and where NULL falls into the last bin.
    """
    value = as_column(c)
    used = edges[:-1] if compat else edges
    binned = _first_match([(value <= e, lab) for e, lab in zip(used, labels)], labels[-1])
    return binned if compat else F.when(value.isNotNull(), binned)


def right_closed_bin(c: Column | str, edges: Sequence[float]) -> Column:
    """Index of the ``(a, b]`` interval; the first also holds its lower edge.

    Outside the edges, and for NULL, the result is NULL.
    """
    value = as_column(c)
    inside = _first_match([(value <= e, i) for i, e in enumerate(edges[1:])])
    return F.when(value >= edges[0], inside)


def interval_label(c: Column | str, edges: Sequence[float]) -> Column:
    """Interval text for :func:`right_closed_bin`, lowest edge shown 0.001 lower."""
    lows = [edges[0] - 0.001, *edges[1:-1]]
    names = [f"({float(lo):.10g}{'' if float(lo) % 1 else '.0'}, {float(hi)}]" for lo, hi in zip(lows, edges[1:])]
    index = right_closed_bin(c, edges)
    return _first_match([(index == i, name) for i, name in enumerate(names)])


def left_closed_bin(c: Column | str, edges: Sequence[float]) -> Column:
    """Index of the ``[a, b)`` interval, the last one closed; NULL outside.

    Repeated edges leave empty bins, so the bin count never changes.
    """
    value = as_column(c)
    last = len(edges) - 2
    cases = [(value >= edges[i], i) for i in range(last, -1, -1)]
    return F.when(value <= edges[-1], _first_match(cases))


def uniform_bin(c: Column | str, bins: int) -> Column:
    """Right-closed bin of equal width over [0, 1]."""
    value = as_column(c)
    step = 1.0 / bins
    cases = [(value <= i * step, i - 1) for i in range(1, bins)]
    return F.when(value.isNotNull(), _first_match(cases, bins - 1))
