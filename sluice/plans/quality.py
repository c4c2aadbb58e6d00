"""Row checks end to end: configuration → bad rows with reasons → good rows → both published."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.checks import clauses_of, validate_checks
from ..functions.ordered_checks import OrderedChecks
from .._util import as_list, resolve_names
from ..operators.checks import FAIL_COLUMN, apply_data_checks, drop_keys_of, good_rows, observe_checks
from ..sources.config import load_data_checks
from .gold import publish


def check_and_publish(
    df: DataFrame,
    cfg,
    *,
    good_path: str | None = None,
    bad_path: str | None = None,
    good_table: str | None = None,
    bad_table: str | None = None,
    by: str = "row",
    key=None,
    fmt: str = "parquet",
    report: Callable[[list[tuple[int, str, int]]], None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Publish the bad rows (with ``fail_messages``) and the good rows (by row or NULL-safe key). ``report``
    is called with (check_no, message, failed_rows) of each check, observed while the bad rows are written.

    Two scans of the input: one for the bad rows, with the checks' disjunction pushed to the scan
    where it can be, one for the good rows. The key-level split takes the bad keys from the
    published bad rows. Returns frames reading the published outputs.
    """
    clauses = clauses_of(cfg)
    validate_checks(df, clauses)
    spark: SparkSession = df.sparkSession
    read = (lambda t, p: spark.table(t) if t else spark.read.format(fmt).load(p))
    failed, counts = df, list
    if report is not None and clauses:
        failed, counts = observe_checks(df.where(OrderedChecks(df, clauses).any_failed()), clauses, validate=False)
    publish(apply_data_checks(failed, clauses, column=FAIL_COLUMN, validate=False), table=bad_table, path=bad_path, fmt=fmt)
    if report is not None:
        report(counts())
    if by == "key" and clauses:
        keys = resolve_names(df.columns, as_list(key))
        if not keys:
            raise ValueError("by='key' needs key columns")
        good = drop_keys_of(df, read(bad_table, bad_path), keys)
    else:
        good = good_rows(df, clauses, by=by, key=key, validate=False)
    publish(good, table=good_table, path=good_path, fmt=fmt)
    return read(good_table, good_path), read(bad_table, bad_path)


def check_table_from_config(
    spark: SparkSession,
    df: DataFrame,
    source_system: str,
    catalog: str,
    schema: str,
    table: str,
    *,
    config_root: str = "data_checks_cfg",
    **outputs,
) -> tuple[DataFrame, DataFrame]:
    """:func:`check_and_publish` with the checks of ``catalog.schema.table`` from the configuration."""
    cfg = load_data_checks(spark, source_system, catalog, schema, table, config_root=config_root)
    return check_and_publish(df, cfg, **outputs)
