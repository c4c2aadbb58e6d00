import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from sluice.operators import (
    MergeConflictError,
    MergeTarget,
    assert_frames_equal,
    assert_schema_equal,
    frame_diff,
    schema_breaches,
)


def _frames(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "k int, s string, v int")
    s = spark.createDataFrame([(2, "B", 200), (3, "C", 5), (4, "D", 40)], "k int, s string, v int")
    return t, s


def test_upsert_delete_order_of_clauses(spark):
    t, s = _frames(spark)
    out = (
        MergeTarget.forFrame(t).alias("t").merge(s.alias("s"), on="k")
        .whenMatchedDelete(condition="s.v < 10")
        .whenMatchedUpdateAll(condition="s.v > 100")
        .whenNotMatchedInsertAll()
        .result()
    )
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 10), (2, "B", 200), (4, "D", 40)]


def test_update_set_and_insert_values(spark):
    t, s = _frames(spark)
    out = (
        MergeTarget.forFrame(t).alias("trg").merge(s.alias("src"), "trg.k = src.k")
        .whenMatchedUpdate(condition="src.v > 100", set={"v": "trg.v + src.v"})
        .whenMatchedUpdate(set={"s": "'other'"})
        .whenNotMatchedInsert(values={"k": "src.k", "s": "'new'"})
        .result()
    )
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 10), (2, "b", 220), (3, "other", 30), (4, "new", None)]
    assert out.schema == t.schema


def test_duplicate_source_match_raises(spark):
    t, _ = _frames(spark)
    s = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], "k int, s string, v int")
    with pytest.raises(MergeConflictError):
        MergeTarget.forFrame(t).merge(s, on="k").whenMatchedUpdateAll().result()
    with pytest.raises(MergeConflictError):
        MergeTarget.forFrame(t).alias("t").merge(s.alias("s"), "t.k = s.k").whenMatchedUpdateAll().result()
    # only inserts: duplicates that match are not an error, unmatched duplicates are inserted
    s2 = spark.createDataFrame([(9, "x", 1), (9, "y", 2)], "k int, s string, v int")
    assert MergeTarget.forFrame(t).merge(s2, on="k").whenNotMatchedInsertAll().result().count() == 5


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "t", 1)], "k int, s string, v int")
    s = spark.createDataFrame([(None, "s", 2)], "k int, s string, v int")
    out = MergeTarget.forFrame(t).merge(s, on="k").whenMatchedUpdateAll().whenNotMatchedInsertAll().result()
    assert sorted(r["s"] for r in out.collect()) == ["s", "t"]


def test_execute_publishes_path(spark, tmp_dir):
    t, s = _frames(spark)
    path = f"{tmp_dir}/target"
    t.write.parquet(path)
    MergeTarget.forPath(spark, path).alias("t").merge(s.alias("s"), on="k").whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a", 10), (2, "B", 200), (3, "C", 5), (4, "D", 40)]


keys = st.integers(0, 8)


@settings(max_examples=12, deadline=None)
@given(
    st.dictionaries(keys, st.integers(0, 100), max_size=8),
    st.dictionaries(keys, st.integers(0, 100), max_size=8),
)
def test_property_merge_matches_dict_model(spark, target, source):
    t = spark.createDataFrame(sorted(target.items()) or [], "k int, v int")
    s = spark.createDataFrame(sorted(source.items()) or [], "k int, v int")
    out = (
        MergeTarget.forFrame(t).alias("t").merge(s.alias("s"), on="k")
        .whenMatchedDelete(condition="s.v < 20")
        .whenMatchedUpdate(condition="s.v > 50", set={"v": "s.v + t.v"})
        .whenNotMatchedInsertAll(condition="s.v % 2 = 0")
        .result()
    )
    model = {}
    for k, v in target.items():
        if k in source:
            if source[k] < 20:
                continue
            model[k] = source[k] + v if source[k] > 50 else v
        else:
            model[k] = v
    for k, v in source.items():
        if k not in target and v % 2 == 0:
            model[k] = v
    assert dict((r["k"], r["v"]) for r in out.collect()) == model


def test_frame_diff_multiset(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "id int, s string")
    b = spark.createDataFrame([("x", 1), (None, 2), (None, 2), ("z", 3)], "s string, id int")
    got = sorted((r["id"], r["s"], r["_side"], r["_count"]) for r in frame_diff(a, b).collect())
    assert got == [(1, "x", "left_only", 2 - 1), (2, None, "right_only", 1), (3, "z", "right_only", 1)]
    assert_frames_equal(a, a.select("s", "id"))
    with pytest.raises(AssertionError):
        assert_frames_equal(a, b)


CONTRACT = StructType(
    [
        StructField("id", StringType(), False),
        StructField("name", StringType(), True),
        StructField("age", IntegerType(), True),
        StructField("country", StringType(), True),
    ]
)


def test_schema_breaches():
    same_nullable = StructType([StructField(f.name, f.dataType, True) for f in CONTRACT.fields])
    assert schema_breaches(same_nullable, CONTRACT) == []
    assert [b.kind for b in schema_breaches(same_nullable, CONTRACT, ignore_nullable=False)] == ["nullability"]
    extra = StructType(CONTRACT.fields + [StructField("city", StringType(), True)])
    assert [str(b) for b in schema_breaches(extra, CONTRACT)] == ["unexpected column city string"]
    wrong = StructType([CONTRACT.fields[0], CONTRACT.fields[1], StructField("age", LongType()), CONTRACT.fields[3]])
    assert [(b.kind, b.column) for b in schema_breaches(wrong, CONTRACT)] == [("type", "age")]
    swapped = StructType([CONTRACT.fields[1], CONTRACT.fields[0], CONTRACT.fields[2], CONTRACT.fields[3]])
    assert {b.kind for b in schema_breaches(swapped, CONTRACT)} == {"position"}
    assert schema_breaches(swapped, CONTRACT, check_order=False) == []
    with pytest.raises(AssertionError):
        assert_schema_equal(extra, CONTRACT)


def test_execute_keeps_path_partitioning(spark, tmp_dir):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, p string")
    path = f"{tmp_dir}/parted"
    t.write.partitionBy("p").parquet(path)
    s = spark.createDataFrame([(2, "B", "y"), (3, "c", "z")], "k int, v string, p string")
    MergeTarget.forPath(spark, path, partition_by="p").merge(s, on="k").whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
    import os

    assert sorted(d for d in os.listdir(path) if d.startswith("p=")) == ["p=x", "p=y", "p=z"]
    assert sorted((r["k"], r["v"], r["p"]) for r in spark.read.parquet(path).collect()) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "z")]


def test_one_match_under_the_whole_condition_is_no_conflict(spark):
    target = spark.createDataFrame([(1, "old"), (2, "keep")], "id int, v string")
    source = spark.createDataFrame([(1, "a", "U"), (1, "b", "X"), (3, "n", "U")], "id int, v string, op string")

    def merge(condition):
        return MergeTarget.forFrame(target).alias("t").merge(source.alias("s"), condition, on="id").whenMatchedUpdate(set={"v": "s.v"})

    assert sorted(tuple(r) for r in merge("s.op = 'U'").result().collect()) == [(1, "a"), (2, "keep")]
    with pytest.raises(MergeConflictError):
        merge("s.op IN ('U', 'X')").result()


def test_condition_of_equalities_alone_counts_as_keys(spark):
    target = spark.createDataFrame([(1, 1, "old"), (2, 1, "keep")], "a int, b int, v string")
    source = spark.createDataFrame([(1, 1, "new"), (2, 2, "added")], "a int, b int, v string")
    builder = MergeTarget.forFrame(target).alias("t").merge(source.alias("s"), "t.a = s.a AND s.b=t.b")
    assert builder._on == ["a", "b"] and builder._condition is None
    out = builder.whenMatchedUpdateAll().whenNotMatchedInsertAll().result()
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, "new"), (2, 1, "keep"), (2, 2, "added")]


def test_condition_without_equality_is_refused(spark):
    target = spark.createDataFrame([(1, "x")], "id int, v string")
    with pytest.raises(ValueError, match="equality"):
        MergeTarget.forFrame(target).alias("t").merge(target.alias("s"), "t.id < s.id").whenMatchedUpdateAll().result()


def test_frames_of_different_types_are_not_equal(spark):
    from sluice.operators.compare import frames_equal

    one = spark.createDataFrame([(1,)], "x int")
    for other in (spark.createDataFrame([(1,)], "x bigint"), spark.createDataFrame([("1",)], "x string")):
        assert not frames_equal(one, other)
        with pytest.raises(ValueError, match="types differ"):
            frame_diff(one, other)
        with pytest.raises(AssertionError, match="types differ"):
            assert_frames_equal(one, other)


def test_nested_nullability_is_compared_on_request():
    from pyspark.sql.types import ArrayType

    a = StructType([StructField("x", ArrayType(IntegerType(), False))])
    b = StructType([StructField("x", ArrayType(IntegerType(), True))])
    assert schema_breaches(a, b) == []
    assert [x.kind for x in schema_breaches(a, b, ignore_nullable=False)] == ["nullability"]


def test_external_table_stays_external(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS outside")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.option("path", f"{tmp_dir}/outside").saveAsTable("outside")
    src = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    MergeTarget.forName(spark, "outside").merge(src, on="id").whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
    assert sorted(tuple(r) for r in spark.table("outside").collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert spark.catalog.getTable("outside").tableType == "EXTERNAL"


def test_digest_diff_equals_the_whole_diff(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from sluice.operators import frame_diff, frame_diff_by_digest

    rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", None]), st.sampled_from([0.0, -0.0, 1.5, float("nan"), None])), max_size=8)

    @settings(max_examples=15, deadline=None)
    @given(rows, rows, st.sampled_from([1, 3, 64]))
    def check(left, right, buckets):
        a, b = (spark.createDataFrame(x, "k int, v string, d double") for x in (left, right))
        b = b.select("d", "k", "v")  # the order of columns is ignored

        def seen(df):
            return sorted(map(str, df.collect()))

        assert seen(frame_diff_by_digest(a, b, buckets)) == seen(frame_diff(a, b))

    check()


def test_digest_diff_shuffles_differing_buckets_only(spark, tmp_dir):
    from sluice.operators import frame_diff_by_digest
    from sluice.operators.compare import COUNT

    spark.range(100_000).selectExpr("id", "id % 7 AS v").write.parquet(f"{tmp_dir}/a")
    a = spark.read.parquet(f"{tmp_dir}/a")
    diff = frame_diff_by_digest(a, a.withColumn("v", F.when(F.col("id") == 5, 100).otherwise(F.col("v"))), buckets=1000)
    assert sorted(tuple(r)[:2] for r in diff.collect()) == [(5, 5), (5, 100)]
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert "pmod(xxhash64(" in plan  # the rows of two buckets at most pass the filter below the exchange
    assert frame_diff_by_digest(a, a).isEmpty() and COUNT in diff.columns
    with pytest.raises(ValueError, match="types"):
        frame_diff_by_digest(a, a.withColumn("v", F.col("v").cast("int")))
