"""Plan-shape tests: the scale properties the operators are built for, checked on physical plans."""

import os
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators import MergeTarget, apply_data_checks, frame_diff, latest_per_key
from sluice.sources.landing import LandingArea

from conftest import SF01


def physical(spark, df) -> str:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_checks_reach_the_parquet_scan(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    plan = physical(spark, apply_data_checks(li, [("l_quantity > 49", "q"), ("l_returnflag = 'R'", "r")]))
    assert "PushedFilters: [Or(GreaterThan(l_quantity,49.0),EqualTo(l_returnflag,R))]" in plan
    assert "Exchange" not in plan


def test_latest_ships_one_row_per_key_and_task(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    plan = physical(spark, latest_per_key(o, "o_custkey", "o_orderdate", "o_orderkey"))
    partial = plan.index("WindowGroupLimit") if "Partial" in plan else -1
    assert partial >= 0
    # the partial limit sits below (after, in the string) the exchange
    assert plan.index("Exchange") < plan.rindex("Partial")


def test_merge_hints_no_broadcast_and_shuffles_distinct_target_keys(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    target = o.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    source = o.where("o_orderdate >= '2001-01-01'").select(F.col("o_orderkey").alias("k"), (F.col("o_totalprice") + 1).alias("v"))
    out = MergeTarget.forFrame(target).alias("t").merge(source.alias("s"), "s.k = t.k").whenMatchedUpdateAll().whenNotMatchedInsertAll().result()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(spark, out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan and "NestedLoop" not in plan
    assert any("Exchange hashpartitioning(__tk" in line for line in plan.splitlines())  # the keys alone, distinct


def test_listing_reads_no_file_content(spark, tmp_dir):
    spark.range(10).coalesce(1).write.parquet(f"{tmp_dir}/object=o/year=2025/month=1/day=2/d")
    area = LandingArea(tmp_dir, "o", "parquet")
    files = area.files(spark)
    plan = physical(spark, files)
    assert "MapInArrow" in plan and "FileScan" not in plan  # folder rows, listed in tasks
    assert files.count() == 1
    plan = physical(spark, area._listed_by_spark(spark, None, False))
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


def test_json_lines_scan_prunes_files_before_start(spark, tmp_dir):
    for day in (1, 2, 3):
        d = f"{tmp_dir}/object=o/year=2025/month=1/day={day}/d"
        os.makedirs(d)
        with open(f"{d}/x.json", "w") as f:
            f.write('{"id": "1"}\n')
    lines = LandingArea(tmp_dir, "o", "json").lines(spark, (2025, 1, 3))
    found = []

    def walk(p):
        m = p.metrics()
        if m.contains("numFiles"):
            found.append(m.apply("numFiles").value())
        for i in range(p.children().size()):
            walk(p.children().apply(i))

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counted = lines.groupBy().count()
        assert counted.collect()[0][0] == 1
        walk(counted._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert found == [1]


rows = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=20)


@settings(max_examples=15, deadline=None)
@given(rows, rows)
def test_property_frame_diff_is_multiset_difference(spark, left, right):
    a = spark.createDataFrame(left, "x int, y string")
    b = spark.createDataFrame(right, "x int, y string")
    got = {(r["x"], r["y"], r["_side"]): r["_count"] for r in frame_diff(a, b).collect()}
    ca, cb = Counter(left), Counter(right)
    expected = {}
    for row in set(ca) | set(cb):
        d = ca[row] - cb[row]
        if d > 0:
            expected[(*row, "left_only")] = d
        elif d < 0:
            expected[(*row, "right_only")] = -d
    assert got == expected


def test_key_split_joins_distinct_keys_alone(spark):
    from sluice.operators import good_rows

    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    out = good_rows(li, [("l_quantity > 49.5", "q")], by="key", key="l_orderkey")
    plan = physical(spark, out)
    assert "LeftAnti" in plan and "NestedLoop" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan  # the side of the bad keys


def test_small_mapping_is_broadcast_without_exchange(spark):
    from sluice.operators import map_column

    c = spark.read.parquet(f"{SF01}/customer.parquet")
    n = spark.read.parquet(f"{SF01}/nation.parquet")
    plan = physical(spark, map_column(c, n, "c_nationkey", "n_nationkey", "n_regionkey"))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_frame_diff_is_one_pre_aggregated_exchange(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    plan = physical(spark, frame_diff(li, li.where("l_quantity > 10")))
    assert plan.count("Exchange hashpartitioning") == 1
    # the partial (map-side) aggregation sits below the exchange
    assert plan.index("Exchange hashpartitioning") < plan.rindex("HashAggregate")
