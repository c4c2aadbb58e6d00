import os

import pytest
from sluice.operators import apply_data_checks, assert_frames_equal, latest_per_key
from sluice.streaming.checks import read_checked, stream_checks
from sluice.streaming.latest import latest_state, upsert_latest

from conftest import SF001


def _source(spark, tmp_dir, parts=4):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    src = f"{tmp_dir}/src"
    events.repartitionByRange(parts, "ts").write.parquet(src)
    return events, spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)


CHECKS = [("value > 90", "high"), ("event_type = 'error'", "error")]


def test_stream_checks_equal_batch_and_replay_is_idempotent(spark, tmp_dir):
    events, stream = _source(spark, tmp_dir)
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    q = stream_checks(stream, CHECKS, out, ckpt)
    q.awaitTermination()
    assert q.lastProgress is not None
    batches = read_checked(spark, out).select("batch_id").distinct().count()
    assert batches == 4
    bad = read_checked(spark, out, "bad").drop("status", "batch_id")
    assert_frames_equal(bad, apply_data_checks(events, CHECKS))
    assert read_checked(spark, out).count() == events.count()
    # restarting on the same checkpoint finds nothing new: no duplicates
    stream_checks(stream, CHECKS, out, ckpt).awaitTermination()
    assert read_checked(spark, out).count() == events.count()


def test_latest_state_equals_batch(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    assert_frames_equal(
        latest_state(events, "user_id", "ts", tie_break="event_id"),
        latest_per_key(events, "user_id", "ts", tie_break="event_id"),
    )


def test_latest_state_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, 3, "x"), (2, None, "only")], "k int, ts int, v string")
    got = {r["k"]: r["v"] for r in latest_state(df, "k", "ts").collect()}
    assert got == {1: "x", 2: "only"}


def test_upsert_latest_stream_equals_batch(spark, tmp_dir):
    events, stream = _source(spark, tmp_dir)
    target = f"{tmp_dir}/latest"
    upsert_latest(stream, "user_id", "ts", target, f"{tmp_dir}/ckpt2", tie_break="event_id").awaitTermination()
    assert_frames_equal(spark.read.parquet(target), latest_per_key(events, "user_id", "ts", tie_break="event_id"))


def test_micro_batch_persist_is_released(spark, tmp_dir):
    events, stream = _source(spark, tmp_dir, parts=2)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    upsert_latest(stream, "user_id", "ts", f"{tmp_dir}/t", f"{tmp_dir}/c", tie_break="event_id").awaitTermination()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_stopped_switch_loses_no_rows(spark, tmp_dir):
    """A stop between moving the old content aside and the new content in: the batch is repeated
    on the old content, never taken for the first one."""
    import os

    from sluice.operators.publish import has_data

    schema = "k int, ts int, v string"
    src, target, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/latest", f"{tmp_dir}/ckpt"
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], schema).write.parquet(src)

    def run():
        stream = spark.readStream.schema(schema).parquet(src)
        upsert_latest(stream, "k", "ts", target, ckpt).awaitTermination()

    run()
    spark.createDataFrame([(2, 2, "c")], schema).write.mode("append").parquet(src)
    os.rename(target, f"{tmp_dir}/_latest.prev-0123")
    run()
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [(1, 1, "a"), (2, 2, "c")]
    assert has_data(spark, target) and not [x for x in os.listdir(tmp_dir) if ".prev-" in x]


def test_triggers_and_clashing_names(spark, tmp_dir):
    events, stream = _source(spark, tmp_dir, parts=2)
    q = stream_checks(stream, CHECKS, f"{tmp_dir}/out1", f"{tmp_dir}/c1", trigger="1 second")
    q.processAllAvailable()
    q.stop()
    assert read_checked(spark, f"{tmp_dir}/out1").count() == events.count()
    stream_checks(stream, CHECKS, f"{tmp_dir}/out2", f"{tmp_dir}/c2", trigger="once").awaitTermination()
    assert read_checked(spark, f"{tmp_dir}/out2").count() > 0
    with pytest.raises(ValueError, match="continuous"):
        stream_checks(stream, CHECKS, f"{tmp_dir}/out3", f"{tmp_dir}/c3", trigger={"continuous": "1 second"})
    with pytest.raises(ValueError, match="status"):
        stream_checks(stream.withColumnRenamed("event_type", "status"), [("value > 90", "high")], f"{tmp_dir}/out4", f"{tmp_dir}/c4")


def test_latest_state_with_map_columns(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1, map('a', 1)), (1, 2, map('b', 2)), (2, 5, map('c', 3)) AS t(k, ts, m)")
    assert {r["k"]: r["m"] for r in latest_state(df, "k", "ts").collect()} == {1: {"b": 2}, 2: {"c": 3}}


@pytest.mark.parametrize("state", ["store", "target"])
@pytest.mark.parametrize("buckets", [None, 4])
def test_late_and_repeated_rows_do_not_replace_newer_ones(spark, tmp_dir, state, buckets):
    from sluice.operators import read_bucketed
    from sluice.streaming import upsert_latest

    schema = "k int, ts int, v string"
    src, target, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/latest", f"{tmp_dir}/ckpt"
    batches = [[(1, 5, "a"), (2, 1, "b"), (None, 1, "n")], [(1, 4, "late"), (2, None, "null"), (2, 1, "c"), (3, 1, "d")], [(1, 5, "a"), (None, 2, "m"), (3, 1, "cc"), (4, None, "e")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        upsert_latest(stream, "k", "ts", target, ckpt, state=state, buckets=buckets, state_partitions=2).awaitTermination()
    rows = read_bucketed(spark, target) if buckets else spark.read.parquet(target)
    got = sorted((tuple(r) for r in rows.collect()), key=str)
    # a null key is no key to a merge: its rows are inserted, one a batch
    assert [r for r in got if r[0] is not None] == [(1, 5, "a"), (2, 1, "c"), (3, 1, "d"), (4, None, "e")]
    assert {r for r in got if r[0] is None} == {(None, 1, "n"), (None, 2, "m")}
    assert os.path.exists(f"{ckpt}/state") == (state == "store")


def test_rocksdb_state_stays_small(spark, tmp_dir):
    """A stream of many rows and few keys: the state folder holds changes of keys, not rows."""
    from sluice.streaming import stream_session, upsert_latest

    src, target, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/latest", f"{tmp_dir}/ckpt"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for k in range(4):
        spark.range(k * 20_000, (k + 1) * 20_000).selectExpr("CAST(id % 50 AS int) AS k", "id AS ts", "repeat('x', 200) AS v").coalesce(1).write.mode("append").parquet(src)
    own = stream_session(spark, 2, rocksdb=True)
    stream = own.readStream.schema("k int, ts long, v string").option("maxFilesPerTrigger", 1).parquet(src)
    upsert_latest(stream, "k", "ts", target, ckpt).awaitTermination()
    assert spark.read.parquet(target).count() == 50 and spark.read.parquet(target).agg({"ts": "min"}).first()[0] == 79_950
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{ckpt}/state") for f in names]
    assert any(f.endswith(".changelog") for f in files)
    assert sum(map(os.path.getsize, files)) < 1_000_000  # the rows hold 16 MB


def test_observed_counts_equal_the_report(spark, tmp_dir):
    from sluice.operators import check_report, observe_checks
    from sluice.plans.quality import check_and_publish

    df = spark.createDataFrame([(k, None if k % 3 else "x") for k in range(20)], "id int, v string")
    checks = [("id > 10", "late"), ("v IS NULL", "missing"), ("id < 0", "never"), ("v = 'y'", "null most of the time")]
    want = [tuple(r) for r in check_report(df, checks).orderBy("check_no").collect()]
    observed, counts = observe_checks(df, checks)
    observed.write.parquet(f"{tmp_dir}/o")
    assert counts() == want
    for name, frame in (("full", df), ("none", df.where("id < 0")), ("clean", df.where("id = 3"))):
        told = []
        check_and_publish(frame, checks, good_path=f"{tmp_dir}/{name}/good", bad_path=f"{tmp_dir}/{name}/bad", report=told.extend)
        assert told == [tuple(r) for r in check_report(frame, checks).orderBy("check_no").collect()]
