"""Source table → latest per key → mandatory fields → mapping enrichment → publish (overwrite or merge)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .._util import as_list
from ..operators.checks import apply_data_checks
from ..operators.conform import map_column
from ..operators.latest import latest_per_key, require_fields, required_field_checks
from ..operators.merge import MergeTarget
from ..operators.buckets import Buckets, write_bucketed
from ..operators.publish import has_data, recover_table, replace_path, replace_table
from ..session import cut_lineage


def build_gold(
    src: DataFrame,
    mapping: DataFrame,
    *,
    key="id",
    order_by="effective_date",
    tie_break=None,
    required=("id", "name"),
    column: str = "city",
    map_key: str = "city_abb",
    map_value: str = "city",
) -> DataFrame:
    """Latest row per key, then rows with all ``required`` fields, then ``column`` mapped.

    The required-field filter runs after the dedup on purpose: when the newest version of a key
    lacks a required field, the key is dropped rather than falling back to an older version.
    """
    latest = latest_per_key(src, key, order_by, tie_break)
    return map_column(require_fields(latest, required), mapping, column, map_key, map_value)


def rejected_gold_rows(src: DataFrame, *, key="id", order_by="effective_date", tie_break=None, required=("id", "name"), messages=None) -> DataFrame:
    """The latest rows that :func:`build_gold` drops for missing fields, with ``fail_messages``."""
    latest = latest_per_key(src, key, order_by, tie_break)
    return apply_data_checks(latest, required_field_checks(list(required), messages))


def publish(
    df: DataFrame,
    *,
    table: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    on=None,
    partition_by=None,
    buckets: int | None = None,
) -> None:
    """Write ``df`` to a table or path.

    ``overwrite`` replaces the content: an existing target is written anew and switched in, so
    ``df`` may read the target itself;
    ``merge`` upserts by the key columns ``on`` (update all matched, insert all others).

    With ``buckets`` a new target is laid out by that many buckets of the columns ``on``, and later merges
    read and write only the buckets that hold a key of theirs; an existing target keeps its layout.
    """
    if (table is None) == (path is None):
        raise ValueError("give exactly one of table= or path=")
    if buckets and (partition_by or not on):
        raise ValueError("buckets= needs the key columns on= and no partition_by=")
    spark: SparkSession = df.sparkSession
    if table:
        recover_table(spark, table)
    layout = None if table else Buckets.of_path(spark, path)
    exists = spark.catalog.tableExists(table) if table else layout is not None or has_data(spark, path)
    if mode == "merge" and exists:
        # the merge reads its source twice (size and key multiplicity, then the merge itself):
        # materialise it once instead of running its whole lineage twice
        source = cut_lineage(df)
        target = MergeTarget.forName(spark, table) if table else MergeTarget.forPath(spark, path, fmt, partition_by)
        target.merge(source, on=as_list(on)).whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
        return
    if mode not in ("overwrite", "merge"):
        raise ValueError("mode must be 'overwrite' or 'merge'")
    if exists:
        # the frame may read its own target: write anew, then switch (one write either way)
        layout = Buckets.of_table(spark, table) if table else layout
        if layout:
            layout.replace(df, path, table)
        elif table:
            replace_table(df, table)
        else:
            replace_path(df, path, fmt, partition_by)
        return
    if buckets:
        write_bucketed(df, on, buckets, path=path, table=table, fmt=fmt)
        return
    writer = df.write.mode("overwrite").format(fmt)  # nothing to read there: plain write
    if partition_by:
        writer = writer.partitionBy(*as_list(partition_by))
    if table:
        writer.saveAsTable(table)
    else:
        writer.save(path)
