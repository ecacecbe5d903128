"""Key-based joins with the checks they rely on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemill import session
from vintagemill.operators.ordered import keep_known


def require_columns(df: DataFrame, columns: Sequence[str], name: str = "table") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"[{name}] missing columns: {missing}")


def key_profile(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(distinct keys, most rows on one key); rows with a NULL key part are not counted."""
    counts = keep_known(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    return row["keys"], row["most"]


def require_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> int:
    """Number of keys; raises when a key occurs twice."""
    require_columns(df, keys, name)
    distinct, most = key_profile(df, keys)
    if most > 1:
        raise ValueError(f"[{name}] {list(keys)} is not unique: up to {most} rows per key")
    return distinct


def lookup_join(fact: DataFrame, lookup: DataFrame, keys: Sequence[str], name: str = "lookup") -> DataFrame:
    """Left join to a table with unique keys: the fact rows keep their number.

    The uniqueness check also counts the lookup.  A small one is broadcast; a
    large one goes through a shuffle join, where adaptive execution splits keys
    that hold too many fact rows.
    """
    keys = list(keys)
    require_columns(fact, keys, "fact")
    rows = require_unique(lookup, keys, name)
    if session.may_broadcast(rows, lookup.schema):
        lookup = F.broadcast(keep_known(lookup, keys))
    return fact.join(lookup, keys, "left")


def attach_slices(
    preds: DataFrame, loans: DataFrame, slices: Sequence[str], pred_key: str = "loan_id", loan_key: str = "loan_id"
) -> DataFrame:
    """Slice columns of the loans joined to the predictions on the loan key.

    Slice columns already in the predictions win; key names may differ.  A loan key that
    occurs twice is an error, as it would multiply predictions; a prediction without a
    loan has NULL slices.
    """
    require_columns(preds, [pred_key], "predictions")
    require_columns(loans, [loan_key], "loans")
    wanted = [c for c in slices if c in loans.columns and c not in preds.columns]
    meta = loans.select(F.col(loan_key).alias(pred_key), *wanted)
    return lookup_join(preds, meta, [pred_key], "loans")


def attach_slices_one_to_one(
    preds: DataFrame, loans: DataFrame, slices: Sequence[str], key: str = "loan_id"
) -> DataFrame:
    """Like :func:`attach_slices`, only where no slice column is present yet, and
    only when the key is unique on both sides."""
    if any(c in preds.columns for c in slices):
        return preds
    require_unique(preds, [key], "predictions")
    return attach_slices(preds, loans, slices, key, key)


def align_by_key(left: DataFrame, right: DataFrame, key: str = "loan_id") -> DataFrame:
    """Two tables about the same loans, side by side.

    Rows meet by key, never by position.  Columns present on both sides are taken
    from the left.  The right key must be unique, and every left row must have its
    partner: otherwise rows would vanish or multiply, which is an error.
    """
    require_columns(left, [key], "left")
    require_columns(right, [key], "right")
    extra = [c for c in right.columns if c not in left.columns]
    unmatched = left.join(right.select(key), key, "left_anti").count()
    if unmatched:
        raise ValueError(f"{unmatched} rows have no partner on {key!r}")
    return lookup_join(left, right.select(key, *extra), [key], "right")


def missing_cells(panel: DataFrame, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """Cells of the full grid of two key lists that the panel does not hold.

    The column keys (calendar months) are a short list, attached to every row key
    as an array and unfolded there.
    """
    column = columns.columns[0]
    keys = keep_known(columns, [column]).agg(F.collect_set(column)).scalar()
    grid = keep_known(rows, rows.columns).distinct().withColumn(column, F.explode(keys))
    return grid.join(panel, grid.columns, "left_anti")
