"""Small helpers shared by the operators (names, column references, size checks)."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_list(value) -> list:
    """A single name/Column becomes a one-element list; None becomes []."""
    if value is None:
        return []
    if isinstance(value, (str, Column)):
        return [value]
    return list(value)


def to_col(value) -> Column:
    return value if isinstance(value, Column) else F.col(quote(value))


def quote(name: str) -> str:
    """Back-quote a plain column name so dots or spaces in it are not parsed."""
    if name.startswith("`") and name.endswith("`"):
        return name
    return "`" + name.replace("`", "``") + "`"


def qcol(alias: str, name: str) -> Column:
    """Column ``name`` of the frame aliased ``alias``."""
    return F.col(f"{quote(alias)}.{quote(name)}")


def temp_name(df_or_columns, base: str = "tmp") -> str:
    """A column name that cannot clash with the frame's columns."""
    columns = df_or_columns.columns if isinstance(df_or_columns, DataFrame) else df_or_columns
    taken = {c.lower() for c in columns}
    while True:
        name = f"__{base}_{uuid.uuid4().hex[:8]}"
        if name.lower() not in taken:
            return name


def same_names(a: Iterable[str], b: Iterable[str]) -> bool:
    return sorted(x.lower() for x in a) == sorted(x.lower() for x in b)


def resolve_names(columns: Sequence[str], wanted: Iterable[str]) -> list[str]:
    """Map names case-insensitively onto the frame's own spelling (Spark's default resolution)."""
    by_lower = {c.lower(): c for c in columns}
    out = []
    for w in wanted:
        if w.lower() not in by_lower:
            raise ValueError(f"column {w!r} not found among {list(columns)}")
        out.append(by_lower[w.lower()])
    return out
