"""Row checks over a stream: every micro-batch is tagged in one pass and written once.

Each batch lands in ``<out>/batch_id=<n>/status=good|bad``. The batch directory is overwritten, so
a batch replayed after a failure (same id, same input) replaces its earlier partial output instead
of duplicating it: the sink is idempotent per batch id.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.checks import clauses_of, validate_checks
from ..functions.ordered_checks import OrderedChecks
from ..operators.checks import FAIL_COLUMN


def _trigger_kwargs(trigger) -> dict:
    if trigger is None or trigger == "availableNow":
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    if trigger == "continuous" or isinstance(trigger, dict) and "continuous" in trigger:
        raise ValueError("continuous triggers cannot call a function for each batch")
    if isinstance(trigger, dict):
        return trigger
    return {"processingTime": trigger}


_STARTING = threading.Lock()
#: state in RocksDB: bounded memory, and each batch uploads its changes instead of whole snapshots
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stream_session(spark, state_partitions: int | None = None, rocksdb: bool = False):
    """A session of its own for a stateful stream: a query keeps the settings of the session its stream was
    read in, so building the stream in this one leaves the caller's session as it is."""
    own = spark.newSession()
    if state_partitions is not None:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    for k, v in (ROCKSDB if rocksdb else {}).items():
        own.conf.set(k, v)
    return own


def start_query(writer, spark, state_partitions: int | None = None):
    """``writer.start()``; with ``state_partitions``, the query's shuffle/state partition count.

    A streaming query copies the session configuration when it starts and keeps its state partition
    count for its whole life (it is stored with the checkpoint), so the setting is applied only
    around ``start()`` and the session is left as it was; starts of this kind wait for each other. A
    session that other threads plan queries in should not be touched at all: build the stream in
    :func:`stream_session` and leave ``state_partitions`` out.
    """
    if state_partitions is None:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    with _STARTING:
        previous = spark.conf.get(key)
        spark.conf.set(key, str(state_partitions))
        try:
            return writer.start()
        finally:
            spark.conf.set(key, previous)


def stream_checks(
    stream: DataFrame,
    cfg,
    out_path: str,
    checkpoint_location: str,
    *,
    trigger="availableNow",
    column: str = FAIL_COLUMN,
    fmt: str = "parquet",
    query_name: str | None = None,
) -> StreamingQuery:
    clauses = clauses_of(cfg)
    validate_checks(stream, clauses)
    if taken := {"status", "batch_id"} & {c.lower() for c in stream.columns}:
        raise ValueError(f"columns {sorted(taken)} are the output's own folders; rename them in the stream")
    checks = OrderedChecks(stream, clauses)
    base = out_path.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        tagged = checks.with_messages(batch, column).withColumn(
            "status", F.when(F.size(column) > 0, F.lit("bad")).otherwise(F.lit("good"))
        )
        tagged.write.mode("overwrite").partitionBy("status").format(fmt).save(f"{base}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(**_trigger_kwargs(trigger)).start()


def read_checked(spark, out_path: str, status: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The rows written by :func:`stream_checks` (optionally only ``good`` or ``bad``)."""
    df = spark.read.format(fmt).load(out_path)
    return df if status is None else df.where(F.col("status") == status)
