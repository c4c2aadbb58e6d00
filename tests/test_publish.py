"""Publishing by pointer: tables keep what they are, a stop at any step leaves old or new content whole."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.operators import publish as pub
from sluice.plans.gold import publish

SCHEMA = "id long, v string, p string"
OLD = [(1, "a", "x"), (2, "b", "y"), (3, "c", "y")]
NEW = [(2, "B", "y"), (4, "d", "z"), (5, "e", None)]


class Stop(RuntimeError):
    """The driver dies here."""


def rows(spark, name):
    return sorted((tuple(r) for r in spark.table(name).select("id", "v", "p").collect()), key=str)


def make(spark, name, kind, fmt="parquet", where=None):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for r in spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect():
        spark.sql(f"DROP TABLE {r['tableName']}")
    writer = spark.createDataFrame(OLD, SCHEMA).write.format(fmt)
    if "partitioned" in kind:
        writer = writer.partitionBy("p")
    if "bucketed" in kind:
        writer = writer.bucketBy(3, "id").sortBy("id")
    if "external" in kind:
        writer = writer.option("path", where)
    writer.saveAsTable(name)


@pytest.mark.parametrize("kind", ["plain", "partitioned", "external", "partitioned external", "bucketed", "partitioned bucketed"])
@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_overwrite_keeps_what_the_table_is(spark, tmp_dir, kind, fmt):
    name = f"pub_{kind.replace(' ', '_')}_{fmt}"
    make(spark, name, kind, fmt, f"{tmp_dir}/ext")
    before = pub.table_detail(spark, name)
    publish(spark.createDataFrame(NEW, SCHEMA).select("p", "v", "id"), table=name)
    assert rows(spark, name) == sorted(NEW, key=str)
    after = pub.table_detail(spark, name)
    assert {k: after[k] for k in ("provider", "type", "partitions")} == {k: before[k] for k in ("provider", "type", "partitions")}
    if "bucketed" in kind:
        assert "`id`" in str([r for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r["col_name"] == "Bucket Columns"])
    if "partitioned" in kind:
        assert len(spark.sql(f"SHOW PARTITIONS {name}").collect()) == 3
    # the frame reads its own target; later inserts go on
    publish(spark.table(name).where("id > 2"), table=name)
    assert rows(spark, name) == sorted(NEW[1:], key=str)
    spark.createDataFrame([(9, "i", "x")], SCHEMA).select(*spark.table(name).columns).write.insertInto(name)
    assert rows(spark, name) == sorted([*NEW[1:], (9, "i", "x")], key=str)
    publish(spark.createDataFrame([], SCHEMA), table=name)
    assert rows(spark, name) == []
    spark.sql(f"DROP TABLE {name}")


def test_a_filter_of_a_partitioned_table_published_over_it(spark):
    make(spark, "pub_self", "partitioned")
    publish(spark.table("pub_self").where("id = 1"), table="pub_self")
    assert rows(spark, "pub_self") == [OLD[0]]


def test_replaced_content_stays_one_switch_long(spark):
    make(spark, "pub_versions", "partitioned")
    place = pub.table_detail(spark, "pub_versions")["location"].removeprefix("file:")
    parent, base = os.path.split(place)
    for k in range(4):
        publish(spark.createDataFrame([(k, "v", "x")], SCHEMA), table="pub_versions")
        assert rows(spark, "pub_versions") == [(k, "v", "x")]
    assert len([c for c in os.listdir(parent) if c.startswith(base)]) == 2


def test_other_columns_make_another_table(spark, tmp_dir):
    make(spark, "pub_cols", "plain")
    publish(spark.createDataFrame([(1, 2.5)], "id long, price double"), table="pub_cols")
    assert spark.table("pub_cols").columns == ["id", "price"] and spark.table("pub_cols").count() == 1
    for kind in ("partitioned", "external"):
        make(spark, "pub_cols2", kind, where=f"{tmp_dir}/other")
        with pytest.raises(ValueError, match="other columns"):
            publish(spark.createDataFrame([(1, 2.5)], "id long, price double"), table="pub_cols2")
        assert rows(spark, "pub_cols2") == OLD


@pytest.mark.parametrize("kind", ["plain", "partitioned", "partitioned external"])
def test_a_stop_at_any_step_leaves_one_content_whole(spark, tmp_dir, monkeypatch, kind):
    real_sql, real_point = type(spark).sql, pub._point
    seen = set()
    for step in range(12):
        name = f"pub_stop_{kind.replace(' ', '_')}_{step}"
        make(spark, name, kind, where=f"{tmp_dir}/s{step}")
        calls = 0

        def act(do):
            nonlocal calls
            calls += 1
            if calls > step:
                raise Stop
            return do()

        def sql(self, text, *a, **k):
            run = lambda: real_sql(self, text, *a, **k)
            return act(run) if text.startswith(("CREATE", "ALTER", "DROP")) else run()

        monkeypatch.setattr(type(spark), "sql", sql)
        monkeypatch.setattr(pub, "_point", lambda *a: act(lambda: real_point(*a)))
        try:
            publish(spark.createDataFrame(NEW, SCHEMA), table=name)
            done = True
        except Stop:
            done = False
        monkeypatch.undo()
        spark.catalog.refreshTable(name)
        found = rows(spark, name)
        assert found in (OLD, sorted(NEW, key=str)), (step, found)
        seen.add(found == OLD)
        # what follows works and leaves no staging table
        publish(spark.createDataFrame(NEW[:1], SCHEMA), table=name)
        assert rows(spark, name) == NEW[:1]
        assert not spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect()
        if done:
            break
    assert done and seen == {True, False}


def test_a_stop_while_columns_change_is_finished_or_undone(spark, monkeypatch):
    real_sql = type(spark).sql
    for step in range(4):
        name = f"pub_cols_{step}"
        make(spark, name, "plain")
        calls = 0

        def sql(self, text, *a, **k):
            nonlocal calls
            if text.startswith(("ALTER", "DROP")):
                calls += 1
                if calls > step:
                    raise Stop
            return real_sql(self, text, *a, **k)

        monkeypatch.setattr(type(spark), "sql", sql)
        try:
            publish(spark.createDataFrame([(1, 2.5)], "id long, price double"), table=name)
        except Stop:
            pass
        monkeypatch.undo()
        pub.recover_table(spark, name)
        assert spark.table(name).count() == (3 if "v" in spark.table(name).columns else 1)
        assert not spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect()


def test_some_partitions_are_replaced(spark):
    make(spark, "pub_some", "partitioned")
    files = {f for f in spark.table("pub_some").where("p = 'x'").inputFiles()}
    pub.replace_partitions(spark.table("pub_some").where("p = 'y' AND id = 3").withColumn("v", F.lit("C")), "pub_some", [{"p": "y"}])
    assert rows(spark, "pub_some") == [(1, "a", "x"), (3, "C", "y")]
    assert {f for f in spark.table("pub_some").where("p = 'x'").inputFiles()} == files
    with pytest.raises(ValueError, match="outside"):
        pub.replace_partitions(spark.createDataFrame(NEW, SCHEMA), "pub_some", [{"p": "y"}])
    assert rows(spark, "pub_some") == [(1, "a", "x"), (3, "C", "y")]
    pub.replace_partitions(spark.table("pub_some").where("false"), "pub_some", [{"p": "y"}, {"p": "new"}])
    assert rows(spark, "pub_some") == [(1, "a", "x")]
    # partitions lie in folders of several switches; none of them is purged
    for k in range(3):
        pub.replace_partitions(spark.createDataFrame([(k, "k", "q")], SCHEMA), "pub_some", [{"p": "q"}])
    assert rows(spark, "pub_some") == [(1, "a", "x"), (2, "k", "q")]


class StoppingFs:
    """A file system whose driver dies at the n-th change."""

    def __init__(self, fs, left):
        self._fs, self._left = fs, left

    def __getattr__(self, name):
        real = getattr(self._fs, name)
        if name not in ("rename", "delete", "mkdirs"):
            return real

        def call(*a):
            if not self._left[0]:
                raise Stop
            self._left[0] -= 1
            return real(*a)

        return call


@pytest.mark.parametrize("parts", [None, ["x", "y", "z"]])
def test_a_stop_of_a_path_switch_is_undone_or_done(spark, tmp_dir, monkeypatch, parts):
    real_fs = pub._fs
    new = [(2, "B", "y"), (4, "d", "z")]
    seen = set()
    for steps in range(20):
        path = f"{tmp_dir}/t{steps}/target"
        spark.createDataFrame(OLD, SCHEMA).write.partitionBy("p").parquet(path)
        left = [steps]

        def fs_of(s, p):
            fs, q = real_fs(s, p)
            return StoppingFs(fs, left), q

        monkeypatch.setattr(pub, "_fs", fs_of)
        frame = spark.createDataFrame(new, SCHEMA)
        try:
            if parts:
                pub.replace_path_parts(frame, path, "p", parts)
            else:
                pub.replace_path(frame, path, partition_by="p")
            done = True
        except Stop:
            done = False
        monkeypatch.undo()
        assert pub.has_data(spark, path)  # looks at the target and recovers
        found = sorted(tuple(r) for r in spark.read.parquet(path).select("id", "v", "p").collect())
        assert found in (OLD, new), (steps, found)
        seen.add(found == OLD)
        assert [c for c in os.listdir(f"{tmp_dir}/t{steps}") if not c.startswith(".")] == ["target"]
        if done:
            break
    assert done and seen == {True, False}
