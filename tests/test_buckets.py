"""Targets in buckets: a merge reads and writes only the buckets that hold a key of its source."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators import Buckets, MergeTarget, read_bucketed, write_bucketed
from sluice.operators.publish import recover
from sluice.plans.gold import publish

SCHEMA = "id long, v string"


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def content(df):
    return sorted((tuple(r) for r in df.select("id", "v").collect()), key=str)


def target(spark, tmp_dir, kind, rows, n=8):
    frame = spark.createDataFrame(rows, SCHEMA)
    if kind == "path":
        path = f"{tmp_dir}/t"
        write_bucketed(frame, "id", n, path=path)
        return lambda: MergeTarget.forPath(spark, path), lambda: read_bucketed(spark, path)
    name = f"bt_{os.path.basename(tmp_dir).replace('-', '_').lower()}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_bucketed(frame, "id", n, table=name, location=f"{tmp_dir}/t")
    return lambda: MergeTarget.forName(spark, name), lambda: spark.table(name)


@pytest.mark.parametrize("kind", ["path", "table"])
def test_one_key_rewrites_one_bucket(spark, tmp_dir, kind):
    merge_into, read = target(spark, tmp_dir, kind, [(k, "old") for k in range(200)])
    before = {k: v for k, v in files(tmp_dir).items()}
    assert len({os.path.dirname(f) for f in before}) == 8
    source = spark.createDataFrame([(17, "new")], SCHEMA)
    merge_into().alias("t").merge(source.alias("s"), "t.id = s.id").whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
    assert content(read()) == sorted([(k, "new" if k == 17 else "old") for k in range(200)], key=str)
    now = files(tmp_dir)
    live = {f.removeprefix("file://").removeprefix("file:") for f in read().inputFiles()}
    assert len({os.path.dirname(f) for f in live if f not in before}) == 1
    assert len({os.path.dirname(f) for f in live & set(before)}) == 7 and all(now[f] == before[f] for f in live & set(before))


@pytest.mark.parametrize("kind", ["path", "table"])
def test_clauses_null_keys_and_types(spark, tmp_dir, kind):
    merge_into, read = target(spark, tmp_dir, kind, [(k, "old") for k in range(20)] + [(None, "null")])
    # int keys in the source meet the long keys of the target
    source = spark.createDataFrame([(3, "del"), (4, "up"), (50, "ins"), (51, "skip"), (None, "null too")], "id int, v string")
    merge = merge_into().alias("t").merge(source.alias("s"), on="id")
    merge.whenMatchedDelete("s.v = 'del'").whenMatchedUpdate(set={"v": "concat(t.v, s.v)"}).whenNotMatchedInsertAll("s.v <> 'skip'").execute()
    want = [(k, "oldup" if k == 4 else "old") for k in range(20) if k != 3] + [(None, "null"), (50, "ins"), (None, "null too")]
    assert content(read()) == sorted(want, key=str)
    merge_into().merge(source.where("false"), on="id").whenNotMatchedInsertAll().execute()
    assert content(read()) == sorted(want, key=str)
    everything = spark.createDataFrame([(i, "x") for i, _ in want if i is not None], SCHEMA)
    merge_into().merge(everything, on="id").whenMatchedDelete().execute()
    assert content(read()) == sorted([(None, "null"), (None, "null too")], key=str)


@pytest.mark.parametrize("kind", ["path", "table"])
def test_a_row_that_would_leave_the_touched_buckets_changes_nothing(spark, tmp_dir, kind):
    merge_into, read = target(spark, tmp_dir, kind, [(k, "old") for k in range(50)])
    source = spark.createDataFrame([(1, "x")], SCHEMA)
    bucket = {r.id: r.b for r in spark.range(1000).select("id", F.pmod(F.hash("id"), F.lit(8)).alias("b")).collect()}
    other = next(k for k in range(100, 1000) if bucket[k] != bucket[1])
    with pytest.raises(ValueError, match="outside"):
        merge_into().alias("t").merge(source.alias("s"), on="id").whenMatchedUpdate(set={"id": str(other)}).execute()
    assert content(read()) == sorted([(k, "old") for k in range(50)], key=str)


@pytest.mark.parametrize("kind", ["path", "table"])
def test_a_merge_by_other_columns_rewrites_all_and_keeps_the_layout(spark, tmp_dir, kind):
    merge_into, read = target(spark, tmp_dir, kind, [(1, "a"), (2, "b")])
    source = spark.createDataFrame([(9, "a"), (5, "e")], SCHEMA)
    merge_into().merge(source, on="v").whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
    assert content(read()) == [(2, "b"), (5, "e"), (9, "a")]
    assert merge_into().layout.n == 8
    merge_into().merge(spark.createDataFrame([(2, "B")], SCHEMA), on="id").whenMatchedUpdateAll().execute()
    assert content(read()) == [(2, "B"), (5, "e"), (9, "a")]


def test_publish_with_buckets(spark, tmp_dir):
    path = f"{tmp_dir}/pub"
    publish(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), path=path, mode="merge", on="id", buckets=4)
    publish(spark.createDataFrame([(2, "B"), (3, "c")], SCHEMA), path=path, mode="merge", on="id")
    assert content(read_bucketed(spark, path)) == [(1, "a"), (2, "B"), (3, "c")]
    publish(read_bucketed(spark, path).where("id > 1"), path=path)
    assert content(read_bucketed(spark, path)) == [(2, "B"), (3, "c")] and Buckets.of_path(spark, path).n == 4
    publish(spark.createDataFrame([], SCHEMA), path=path)
    assert content(read_bucketed(spark, path)) == []
    publish(spark.createDataFrame([(7, "g")], SCHEMA), path=path, mode="merge", on="id")
    assert content(read_bucketed(spark, path)) == [(7, "g")]
    with pytest.raises(ValueError, match="buckets"):
        publish(spark.createDataFrame([(7, "g")], SCHEMA), path=path, buckets=4)
    with pytest.raises(ValueError, match="merge_bucket"):
        write_bucketed(spark.createDataFrame([(7, "g")], "id long, Merge_Bucket string"), "id", 4, path=f"{tmp_dir}/x")
    with pytest.raises(FileNotFoundError):
        read_bucketed(spark, f"{tmp_dir}/nowhere")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 12), st.sampled_from("abc")), max_size=5, unique_by=lambda r: r[0]), min_size=1, max_size=3))
def test_upserts_equal_a_dict(spark, tmp_path_factory, batches):
    path = f"{tmp_path_factory.mktemp('up')}/t"
    write_bucketed(spark.createDataFrame([], SCHEMA), "id", 3, path=path)
    model = {}
    for batch in batches:
        model.update(batch)
        MergeTarget.forPath(spark, path).merge(spark.createDataFrame(batch, SCHEMA), on="id").whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
    recover(spark, path)
    assert content(read_bucketed(spark, path)) == sorted(model.items(), key=str)


def test_joins_inside_the_source_are_not_the_merge_condition(spark):
    """A range join in the source is the source's own matter; a condition without keys is refused."""
    goods = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    ranges = spark.createDataFrame([(0, 1, "low"), (1, 5, "high")], "low long, high long, name string")
    source = goods.join(ranges, (F.col("id") > F.col("low")) & (F.col("id") <= F.col("high"))).select("id", F.col("name").alias("v"))
    for condition in ("t.id = s.id", "t.id = s.id AND s.v <> 'x'", "t.id + 1 = s.id + 1"):
        merge = MergeTarget.forFrame(goods).alias("t").merge(source.alias("s"), condition)
        assert content(merge.whenMatchedUpdateAll().result()) == [(1, "low"), (2, "high")]
    assert content(MergeTarget.forFrame(goods).merge(source, on="id").whenMatchedUpdateAll().result()) == [(1, "low"), (2, "high")]
    for condition in ("t.id > s.id", "t.id = 1", "true"):
        with pytest.raises(ValueError, match="equality"):
            MergeTarget.forFrame(goods).alias("t").merge(source.alias("s"), condition).whenMatchedUpdateAll().result()
