"""Mapping enrichment: replace codes by mapped values through a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._util import qcol, resolve_names, temp_name


def map_column(
    df: DataFrame,
    mapping: DataFrame,
    column: str,
    key_col: str,
    value_col: str,
    *,
    unique_keys: bool = False,
) -> DataFrame:
    """``df.column`` replaced by ``mapping.value_col`` where ``df.column = mapping.key_col``.

    Left join, ``coalesce(mapped, original)``; unmapped and NULL codes keep their value. All other
    columns are kept in order and the mapped column is moved last. As with any left join, a code
    listed twice in the mapping duplicates the row; ``unique_keys=True`` raises instead.

    How the mapping is joined is left to the planner: it broadcasts a mapping whose size in bytes is
    known to be small, adaptive execution one whose measured size is, and otherwise splits a skewed
    partition of ``df``.
    """
    (column,) = resolve_names(df.columns, [column])
    key_col, value_col = resolve_names(mapping.columns, [key_col, value_col])
    src, cfg = temp_name(df, "src"), temp_name(df, "map")
    lookup = mapping.select(key_col, value_col)
    if unique_keys:
        dup = lookup.groupBy(key_col).count().where(F.col("count") > 1).limit(1).collect()
        if dup:
            raise ValueError(f"mapping key {dup[0][0]!r} occurs {dup[0][1]} times")
    others = [c for c in df.columns if c != column]
    return (
        df.alias(src)
        .join(lookup.alias(cfg), qcol(src, column) == qcol(cfg, key_col), "left")
        .select(
            *[qcol(src, c) for c in others],
            F.coalesce(qcol(cfg, value_col), qcol(src, column)).alias(column),
        )
    )
