"""Row-check operators: bad rows with reasons, good rows, per-check report.

All of them are row-local projections/filters (no shuffle) except the key-level good-row split,
which is one anti join against the distinct bad keys.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .._util import as_list, resolve_names, temp_name, to_col
from ..functions.checks import _inlinable, _plain, clauses_of, empty_messages, validate_checks
from ..functions.ordered_checks import OrderedChecks

FAIL_COLUMN = "fail_messages"
WIDE_CHECK_SET = 50


def _warn_if_wide(df: DataFrame, clauses) -> None:
    """Hundreds of checks make one whole-stage method too large for the JIT; say how to fix it."""
    if len(clauses) < WIDE_CHECK_SET:
        return
    limit = df.sparkSession.conf.get("spark.sql.codegen.hugeMethodLimit", "65535")
    if int(limit) > 8000:
        warnings.warn(
            f"{len(clauses)} checks: set spark.sql.codegen.hugeMethodLimit=8000 so that an oversized "
            "generated method falls back to split per-expression code instead of running interpreted",
            stacklevel=3,
        )


def apply_data_checks(df: DataFrame, cfg, *, column: str = FAIL_COLUMN, validate: bool = True) -> DataFrame:
    """Rows failing at least one check, with ``column`` = messages of the failed checks in order.

    Original columns are kept; an existing ``column`` is replaced. The disjunction of the checks
    is applied first as a filter, so simple checks reach the parquet scan as pushed filters and
    clean rows never pay for the message array. Eight or more checks that compare one expression with
    constants are judged together by a binary search (:class:`OrderedChecks`).
    """
    clauses = clauses_of(cfg)
    if validate:
        validate_checks(df, clauses)
    _warn_if_wide(df, clauses)
    if not clauses:
        return df.where(F.lit(False)).withColumn(column, empty_messages())
    checks = OrderedChecks(df, clauses)
    return checks.with_messages(df.where(checks.any_failed()), column)


bad_rows = apply_data_checks


def tag_rows(df: DataFrame, cfg, *, column: str = FAIL_COLUMN, validate: bool = True) -> DataFrame:
    """Every row with its (possibly empty) failure list: one pass that feeds both outputs."""
    clauses = clauses_of(cfg)
    if validate:
        validate_checks(df, clauses)
    return OrderedChecks(df, clauses).with_messages(df, column)


def good_rows(df: DataFrame, cfg, *, by: str = "row", key=None, validate: bool = True) -> DataFrame:
    """Rows to keep.

    ``by="row"``: rows on which no check is TRUE (a pure filter, no join).
    ``by="key"``: additionally drop every row whose key (NULL-safe, so a NULL key is a key too)
    also appears on a bad row: ``df LEFT ANTI JOIN (distinct bad keys) ON key <=> key``.
    """
    clauses = clauses_of(cfg)
    if validate:
        validate_checks(df, clauses)
    if not clauses:
        return df
    failed = OrderedChecks(df, clauses).any_failed()
    clean = ~F.coalesce(failed, F.lit(False))
    if by == "row":
        return df.where(clean)
    if by != "key":
        raise ValueError("by must be 'row' or 'key'")
    keys = resolve_names(df.columns, as_list(key))
    if not keys:
        raise ValueError("by='key' needs key columns")
    return drop_keys_of(df, df.where(failed), keys)


def drop_keys_of(df: DataFrame, bad: DataFrame, keys) -> DataFrame:
    """``df`` without the rows whose key also occurs in ``bad`` (NULL-safe key equality).

    The bad side is reduced to distinct keys (partial aggregation before its shuffle); only key
    columns are joined. Adaptive execution broadcasts them when their measured bytes are few, and
    otherwise splits a skewed left partition (one hot key).
    """
    keys = as_list(keys)
    renamed = [temp_name(df, f"bk{i}") for i in range(len(keys))]
    bad_keys = bad.select(*[to_col(k).alias(r) for k, r in zip(keys, renamed)]).distinct()
    cond = [to_col(k).eqNullSafe(F.col(r)) for k, r in zip(keys, renamed)]
    return df.join(bad_keys, cond, "left_anti")


def split_rows(df: DataFrame, cfg, *, by: str = "row", key=None, column: str = FAIL_COLUMN):
    """``(good, bad)`` as in the reference flow: bad rows with messages, good rows by row or key."""
    clauses = clauses_of(cfg)
    validate_checks(df, clauses)
    bad = apply_data_checks(df, clauses, column=column, validate=False)
    good = good_rows(df, clauses, by=by, key=key, validate=False)
    return good, bad


def check_report(df: DataFrame, cfg, *, validate: bool = True) -> DataFrame:
    """Failed-row count per check: ``check_no, message, failed_rows``.

    One global aggregation with one conditional count per check (partial per partition, so only
    one tiny row per task is shuffled), then unpivoted into one row per check.
    """
    clauses = clauses_of(cfg)
    if validate:
        validate_checks(df, clauses)
    if not clauses:
        return df.sparkSession.createDataFrame([], "check_no int, message string, failed_rows bigint")
    if all(_inlinable(c.sql) for c in clauses):
        counts = df.selectExpr(*[f"count_if({c.sql}) AS n{i}" for i, c in enumerate(clauses)])
    else:
        counts = df.select(*[F.count_if(F.expr(c.sql)).alias(f"n{i}") for i, c in enumerate(clauses)])
    if all(_plain(c.message) for c in clauses):
        rows = ", ".join(f"{i + 1}, '{c.message}', n{i}" for i, c in enumerate(clauses))
        return counts.selectExpr(f"stack({len(clauses)}, {rows}) AS (check_no, message, failed_rows)")
    per_check = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("check_no"),
                    F.lit(c.message).alias("message"),
                    F.col(f"n{i}").alias("failed_rows"),
                )
                for i, c in enumerate(clauses)
            ]
        )
    ).alias("r")
    return counts.select(per_check).select("r.*")


def observe_checks(df: DataFrame, cfg, *, validate: bool = True) -> tuple[DataFrame, Callable[[], list[tuple[int, str, int]]]]:
    """``df``, and a function that tells (check_no, message, failed_rows) once an action has run over it:
    the counts of :func:`check_report` as observed metrics of a job that runs anyway, without a scan of
    their own. The function waits for that action."""
    clauses = clauses_of(cfg)
    if validate:
        validate_checks(df, clauses)
    if not clauses:
        return df, lambda: []
    seen = Observation()
    observed = df.observe(seen, *[F.count_if(F.expr(c.sql)).alias(f"n{i}") for i, c in enumerate(clauses)])
    return observed, lambda: [(i, c.message, seen.get[f"n{i - 1}"]) for i, c in enumerate(clauses, 1)]
