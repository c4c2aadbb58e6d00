"""Latest record per key over a stream.

``row_number`` is not allowed on streams, so the newest row is kept as a streaming aggregation:
``max(struct(order..., tie..., row))`` per key. Struct ordering compares field by field and puts
NULL below any value, which is "descending, NULLs last" as in the batch operator. The state store
holds one row per key (bounded by the key count, not by the stream length); map-side partial
aggregation runs before the state shuffle, so a hot key costs one row per task per batch.

With ``outputMode("update")`` each batch emits only the keys it changed; :func:`upsert_latest`
merges them into a target path (update all matched, insert the rest).

The state store grows with the keys ever seen. Where the target holds them all anyway,
``state="target"`` needs none: a micro-batch is reduced to its newest row per key and merged, and a row
of the target stays unless the batch has a newer one. No key ever expires, and a batch costs the buckets
it touches.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .._util import as_list, temp_name, to_col
from ..operators.merge import MergeTarget
from ..operators.buckets import Buckets, write_bucketed
from ..operators.publish import has_data
from .checks import _trigger_kwargs, start_query


def latest_state(stream: DataFrame, keys, order_by, tie_break=None) -> DataFrame:
    """Streaming (or batch) frame with the newest full row per key."""
    keys = as_list(keys)
    orders = _orders(order_by, tie_break)
    best = temp_name(stream, "best")
    sort_fields = [to_col(c).alias(f"o{i}") for i, c in enumerate(orders)]
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns]).alias("row")
    if "map<" in stream.schema.simpleString():  # maps have no order: by the sort fields alone
        newest = F.struct(F.max_by(row, F.struct(*sort_fields)).alias("row"))
    else:
        newest = F.max(F.struct(*sort_fields, row))
    return (
        stream.groupBy(*[to_col(k) for k in keys])
        .agg(newest.alias(best))
        .select(*[F.col(f"{best}.row.`{c}`").alias(c) for c in stream.columns])
    )


def _orders(order_by, tie_break) -> list:
    orders = as_list(order_by) + as_list(tie_break)
    if not orders:
        raise ValueError("order_by is required")
    return orders


def _newer(frame: DataFrame, orders: list, ours: str, theirs: str):
    """Whether a row of ``ours`` comes before the row of ``theirs`` in the order of :func:`latest_state`:
    by the order columns, NULL below any value, and then by the whole row."""
    columns = [frame.select(to_col(c)).columns[0] for c in orders]
    if "map<" not in frame.schema.simpleString():
        columns += frame.columns

    def row(alias):
        return F.struct(*[F.col(f"{alias}.`{c}`").alias(f"o{i}") for i, c in enumerate(columns)])

    return row(ours) > row(theirs)


def reused_batch(fn):
    """Run a ``foreachBatch`` function on the micro-batch persisted, because it acts on it more
    than once (size check, merge) and each action would otherwise re-run the batch's stateful plan.
    A lost cached block is recomputed from the batch's lineage."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fn(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def upsert_latest(
    stream: DataFrame,
    keys,
    order_by,
    target_path: str,
    checkpoint_location: str,
    *,
    tie_break=None,
    trigger="availableNow",
    fmt: str = "parquet",
    state_partitions: int | None = None,
    buckets: int | None = None,
    state: str = "store",
) -> StreamingQuery:
    """Keep ``target_path`` equal to the newest row per key of everything the stream has seen. With
    ``buckets`` the target is laid out by that many buckets of the keys (read it with
    :func:`~sluice.operators.read_bucketed`), and a micro-batch rewrites only those that hold a key of its own.
    ``state``: ``"store"`` (Spark's state store) or ``"target"`` (none; order columns are names then)."""
    if state not in ("store", "target"):
        raise ValueError("state must be 'store' or 'target'")
    keys, orders = as_list(keys), _orders(order_by, tie_break)
    latest = latest_state(stream, keys, order_by, tie_break) if state == "store" else stream

    @reused_batch
    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newer = None
        if state == "target":
            batch = latest_state(batch, keys, order_by, tie_break)
            newer = _newer(batch, orders, "src", "trg")
        if not has_data(spark, target_path) and Buckets.of_path(spark, target_path) is None:
            if buckets:
                write_bucketed(batch, keys, buckets, path=target_path, fmt=fmt)
                return
            batch.write.mode("overwrite").format(fmt).save(target_path)
            return
        target = MergeTarget.forPath(spark, target_path, fmt)
        # one row per key by construction (grouped), so no duplicate-match check is needed
        merge = target.alias("trg").merge(batch.alias("src"), on=keys, source_alias="src")
        merge.whenMatchedUpdateAll(condition=newer).whenNotMatchedInsertAll().execute(check_duplicates=False)

    writer = (
        latest.writeStream.outputMode("update" if state == "store" else "append")
        .foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**_trigger_kwargs(trigger))
    )
    return start_query(writer, stream.sparkSession, state_partitions)
