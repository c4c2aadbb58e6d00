"""Hot keys: one key holds a third of all rows. Broadcasts are disabled and AQE's skew thresholds
lowered so the shuffle-join / skew-split paths run, and results must stay whole and exact."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import MergeTarget, good_rows, latest_per_key, map_column
from sluice.operators.compare import frame_diff

N = 30_000


@pytest.fixture()
def skewed(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    # key 0 holds a third of the rows, the rest are spread over 1000 keys
    df = spark.range(N).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        (F.col("id") % 97).alias("v"),
    )
    yield df
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_key_latest(spark, skewed):
    out = latest_per_key(skewed, "k", "id")
    assert out.count() == 1001
    assert out.where("k = 0").collect()[0]["id"] == max(i for i in range(N) if i % 3 == 0)


def test_hot_key_good_rows_by_key(spark, skewed):
    out = good_rows(skewed, [("v = 96 AND k <> 0", "bad")], by="key", key="k")
    bad_keys = {(i % 1000) + 1 for i in range(N) if i % 3 != 0 and i % 97 == 96}
    expected = sum(1 for i in range(N) if (0 if i % 3 == 0 else i % 1000 + 1) not in bad_keys)
    assert out.count() == expected


def test_hot_key_mapping(spark, skewed):
    mapping = spark.range(0, 1001, 2).select(F.col("id").alias("code"), (F.col("id") * 10).alias("label"))
    out = map_column(skewed, mapping, "k", "code", "label")
    assert out.count() == N
    assert out.where("k = 0").count() == N // 3


def test_hot_key_merge(spark, skewed):
    target = skewed.select("id", "k", "v")
    source = skewed.where("k = 0 AND id < 3000").select("id", "k", (F.col("v") + 1000).alias("v"))
    out = (
        MergeTarget.forFrame(target).alias("t").merge(source.alias("s"), on="id")
        .whenMatchedUpdateAll()
        .whenNotMatchedInsertAll()
        .result()
    )
    assert out.count() == N
    assert out.where("v >= 1000").count() == 1000


def test_hot_duplicate_rows_diff(spark, skewed):
    a = skewed.select("k")
    b = skewed.where("k <> 0 OR id % 2 = 0").select("k")
    rows = frame_diff(a, b).collect()
    assert [(r["k"], r["_side"], r["_count"]) for r in rows] == [(0, "left_only", N // 3 // 2)]
