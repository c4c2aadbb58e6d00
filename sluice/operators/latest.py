"""Latest record per key and mandatory-field filtering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .._util import as_list, temp_name, to_col
from ..functions.checks import DataCheckClause
from .._util import quote


def latest_per_key(df: DataFrame, keys, order_by, tie_break=None) -> DataFrame:
    """Keep the newest row per key.

    Newest = largest ``order_by`` (one column or a list, each descending with NULLs last), then
    largest ``tie_break`` columns; without a tie break, rows tied on the order are picked
    arbitrarily. NULL keys form one group.

    Plan: ``row_number() = 1`` becomes a partial ``WindowGroupLimit`` before the shuffle and a
    final one after it, so each map task ships at most one row per key: a key holding a third of
    all rows shrinks to one row per task before it reaches a single reducer.
    """
    keys = [to_col(k) for k in as_list(keys)]
    orders = [to_col(c).desc_nulls_last() for c in as_list(order_by) + as_list(tie_break)]
    if not orders:
        raise ValueError("order_by is required")
    rn = temp_name(df, "rn")
    window = Window.partitionBy(*keys).orderBy(*orders)
    return df.withColumn(rn, F.row_number().over(window)).where(F.col(rn) == 1).drop(rn)


def deduplicate_df(df: DataFrame, partition_by_cols, order_by_cols, tie_break=None) -> DataFrame:
    """:func:`latest_per_key` under its short name."""
    return latest_per_key(df, partition_by_cols, order_by_cols, tie_break)


def not_null(*columns) -> Column:
    cols = [to_col(c) for c in columns]
    return reduce(lambda a, b: a & b, (c.isNotNull() for c in cols))


def require_fields(df: DataFrame, columns) -> DataFrame:
    """Rows where every column in ``columns`` is not NULL (the filter pushes to the scan for
    plain columns; applied after a dedup it stays above the window for non-key columns)."""
    return df.where(not_null(*as_list(columns)))


def required_field_checks(columns, messages=None) -> list[DataCheckClause]:
    """Row checks ``<col> IS NULL`` with messages, to report rows dropped by :func:`require_fields`."""
    columns = as_list(columns)
    if messages is None:
        messages = [f"{c} cannot be NULL" for c in columns]
    if isinstance(messages, dict):
        messages = [messages[c] for c in columns]
    return [DataCheckClause(f"{quote(c)} IS NULL", m) for c, m in zip(columns, messages)]
