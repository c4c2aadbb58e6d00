"""The gold flow over a stream: newest row per key (state store) → mapping (static table, joined in
each micro-batch) → MERGE into the target path.

Batch semantics are kept exactly: when the newest row of a key lacks a required field the key must
disappear from gold, so the merge deletes it (``whenMatchedDelete``) instead of filtering the row
out and leaving an older version in place; such rows are never inserted.

With ``buckets`` the target is laid out by buckets of the key, and a micro-batch rewrites only those that
hold a key of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .._util import as_list, quote
from ..operators.conform import map_column
from ..operators.merge import MergeTarget
from ..operators.buckets import Buckets, write_bucketed
from ..operators.publish import has_data
from .checks import _trigger_kwargs, start_query
from .latest import latest_state, reused_batch


def upsert_gold_stream(
    stream: DataFrame,
    mapping: DataFrame,
    target_path: str,
    checkpoint_location: str,
    *,
    key="id",
    order_by="effective_date",
    tie_break=None,
    required=("id", "name"),
    column: str = "city",
    map_key: str = "city_abb",
    map_value: str = "city",
    trigger="availableNow",
    fmt: str = "parquet",
    state_partitions: int | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    keys = as_list(key)
    latest = latest_state(stream, keys, order_by, tie_break)
    missing = " OR ".join(f"src.{quote(c)} IS NULL" for c in as_list(required))

    @reused_batch
    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        enriched = map_column(batch, mapping, column, map_key, map_value)
        if not has_data(spark, target_path) and Buckets.of_path(spark, target_path) is None:
            first = enriched.alias("src").where(f"NOT ({missing})")
            if buckets:
                write_bucketed(first, keys, buckets, path=target_path, fmt=fmt)
            else:
                first.write.mode("overwrite").format(fmt).save(target_path)
            return
        target = MergeTarget.forPath(spark, target_path, fmt)
        (
            target.alias("trg")
            .merge(enriched.alias("src"), on=keys, source_alias="src")
            .whenMatchedDelete(condition=missing)
            .whenMatchedUpdateAll()
            .whenNotMatchedInsertAll(condition=f"NOT ({missing})")
            .execute(check_duplicates=False)  # one row per key by construction
        )

    writer = (
        latest.writeStream.outputMode("update")
        .foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**_trigger_kwargs(trigger))
    )
    return start_query(writer, stream.sparkSession, state_partitions)
