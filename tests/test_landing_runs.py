"""Contract runs that stop half way, listing by tasks, NULL counts by statistics, nested contracts."""

import os

import pyarrow as pa
import pyarrow.orc as orc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sluice.operators import move_journal
from sluice.operators.compare import fits, schema_breaches
from sluice.operators.contract import contract_breaches, moved, planned_moves
from sluice.plans.landing import MoveError, apply_data_contract
from sluice.sources.landing import LandingArea

CONTRACT = StructType([StructField("id", StringType(), False), StructField("n", IntegerType(), True)])


def land(root, day, name, columns, month=3, **options):
    folder = f"{root}/object=meter/year=2024/month={month:02d}/day={day:02d}/batch"
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table(columns), f"{folder}/{name}.parquet", **options)
    return f"{folder}/{name}.parquet"


def good(root, day, name="good", **kw):
    return land(root, day, name, {"id": ["a", "b"], "n": pa.array([1, 2], pa.int32())}, **kw)


def bad(root, day, name="bad", **kw):
    return land(root, day, name, {"id": ["a"], "n": pa.array([1], pa.int32()), "more": [1.5]}, **kw)


def log_rows(spark, path):
    return sorted((os.path.basename(r.old_file_path), r.move_status) for r in spark.read.parquet(path).collect())


class Killed(RuntimeError):
    pass


@pytest.mark.parametrize("to_table", [False, True])
@pytest.mark.parametrize("where", ["before the note", "before the moves", "between moves and log", "half of the moves", "after the log"])
def test_a_killed_run_ends_with_a_complete_log(spark, tmp_dir, monkeypatch, where, to_table):
    area = LandingArea(tmp_dir, "meter", "parquet")
    good(tmp_dir, 1)
    files = [bad(tmp_dir, 2, f"bad{k}") for k in range(4)]
    table = f"moves_{abs(hash((where, to_table))) % 10**8}" if to_table else None
    log_path = None if to_table else f"{tmp_dir}/log"
    if to_table:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    real_note, real_finish = move_journal.write_text, move_journal.finish_run

    def killed_note(*a):
        raise Killed

    def killed_finish(s, a, run_id, again=False):
        if where == "before the moves":
            raise Killed
        intents = s.read.parquet(f"{move_journal._folder(a, run_id)}/intents")
        if where == "after the log":
            monkeypatch.setattr(move_journal, "_fs", lambda *x: (_ for _ in ()).throw(Killed()))
            real_finish(s, a, run_id)
        moved(intents.limit(2) if where == "half of the moves" else intents).collect()
        raise Killed

    from sluice.plans import landing

    monkeypatch.setattr(move_journal, "write_text", killed_note if where == "before the note" else real_note)
    monkeypatch.setattr(landing, "finish_run", killed_finish)
    with pytest.raises(Killed):
        apply_data_contract(spark, area, CONTRACT, log_path, log_table=table)
    monkeypatch.undo()
    assert len(move_journal.open_runs(spark, area)) == 1
    apply_data_contract(spark, area, CONTRACT, log_path, log_table=table)
    assert move_journal.open_runs(spark, area) == []
    found = spark.table(table) if to_table else spark.read.parquet(log_path)
    assert sorted((os.path.basename(r.old_file_path), r.move_status) for r in found.collect()) == [(f"bad{k}.parquet", "OK") for k in range(4)]
    for f in files:
        assert not os.path.exists(f) and os.path.exists(f.replace("object=meter", "object=meter_corrupted"))


def test_half_a_table_log_gets_the_rows_it_lacks(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS half_log")
    area = LandingArea(tmp_dir, "meter", "parquet")
    for k in range(3):
        bad(tmp_dir, 2, f"bad{k}")
    planned = planned_moves(area, contract_breaches(spark, area, CONTRACT))
    move_journal.note_moves(spark, area, planned, "r1", None, "half_log")
    part = spark.read.parquet(f"{move_journal._folder(area, 'r1')}/intents").where("old_file_path LIKE '%bad1%'")
    moved(part).withColumn("run_id", F.lit("r1")).write.saveAsTable("half_log")
    assert move_journal.finish_open_runs(spark, area) == ["r1"]
    assert sorted(os.path.basename(r.old_file_path) for r in spark.table("half_log").collect()) == [f"bad{k}.parquet" for k in range(3)]


def test_a_file_landed_anew_after_its_move_is_not_taken_for_the_old_one(spark, tmp_dir):
    area = LandingArea(tmp_dir, "meter", "parquet")
    path = bad(tmp_dir, 2, "x")
    planned = planned_moves(area, contract_breaches(spark, area, CONTRACT))
    move_journal.note_moves(spark, area, planned, "r1", f"{tmp_dir}/log", None)
    moved(spark.read.parquet(f"{move_journal._folder(area, 'r1')}/intents")).collect()  # then the driver dies
    good(tmp_dir, 2, "x")
    apply_data_contract(spark, area, CONTRACT, f"{tmp_dir}/log")
    assert os.path.exists(path) and log_rows(spark, f"{tmp_dir}/log") == [("x.parquet", "OK")]


def test_failed_moves_are_told_from_the_write(spark, tmp_dir):
    area = LandingArea(tmp_dir, "meter", "parquet")
    bad(tmp_dir, 2, "a")
    bad(tmp_dir, 3, "b")
    os.makedirs(f"{tmp_dir}/object=meter_corrupted/year=2024/month=03")
    open(f"{tmp_dir}/object=meter_corrupted/year=2024/month=03/day=02", "w").close()  # no folder can be made there
    with pytest.raises(MoveError, match="a.parquet"):
        apply_data_contract(spark, area, CONTRACT, f"{tmp_dir}/log")
    assert [s == "OK" for _, s in log_rows(spark, f"{tmp_dir}/log")] == [False, True]
    assert move_journal.open_runs(spark, area) == []


def test_runs_with_strays_do_not_race_with_their_moves(spark, tmp_dir):
    for k in range(5):
        root = f"{tmp_dir}/r{k}"
        area = LandingArea(root, "meter", "parquet")
        good(root, 1)
        for d in range(2, 8):
            bad(root, d, f"bad{d}")
        pq.write_table(pa.table({"id": ["s"]}), f"{root}/object=meter/stray.parquet")
        log = apply_data_contract(spark, area, CONTRACT, f"{root}/log").collect()
        assert sorted(r.move_status for r in log) == ["OK"] * 6 + ["STRAY"]


# ---------------------------------------------------------------- listing


def test_tasks_list_what_spark_lists(spark, tmp_dir):
    good(tmp_dir, 1)
    good(tmp_dir, 2, "with space & ü")
    good(tmp_dir, 30, month=1)
    base = f"{tmp_dir}/object=meter"
    for extra in ("stray.parquet", "year=2024/loose.parquet", "year=2024/month=03/loose.parquet", "other/deep/x.parquet", "other/year=2024/month=05/day=06/y.parquet",
                  "year=2024/month=03/day=01/_hidden/h.parquet", "year=2024/month=03/day=01/.h.parquet", "_tmp/t.parquet", "year=2024/month=03/day=01/note.txt", "year=24/z.parquet"):
        os.makedirs(os.path.dirname(f"{base}/{extra}"), exist_ok=True)
        pq.write_table(pa.table({"id": ["s"]}), f"{base}/{extra}")
    area = LandingArea(tmp_dir, "meter", "parquet")
    for start, strays in ((None, True), (None, False)):
        mine = area.files(spark, start, include_strays=strays)
        want = area._listed_by_spark(spark, start, True).where(area._in_scope(F.col("path"), start, strays))
        assert sorted((r.path, r.length) for r in mine.select("path", "length").collect()) == sorted((r.path, r.length) for r in want.collect())
        assert mine.where("modification_time IS NULL OR modification_time < current_timestamp() - INTERVAL 1 HOUR").count() == 0
    assert [os.path.basename(r.path) for r in area.files(spark, (2024, 3, 2)).collect()] == ["with space & ü.parquet"]
    assert {os.path.basename(r.path) for r in area.files(spark, (2024, 3, 2), include_strays=True).where("is_stray").collect()} == {
        "stray.parquet", "loose.parquet", "x.parquet", "z.parquet"}


def test_few_large_files_are_one_task(spark, tmp_dir):
    for k in range(12):
        folder = f"{tmp_dir}/object=meter/year=2024/month=03/day={k + 1:02d}/b"
        os.makedirs(folder)
        with open(f"{folder}/big.parquet", "wb") as f:
            f.truncate(300 << 20)  # sparse: no disk is used
    area = LandingArea(tmp_dir, "meter", "parquet")
    found = contract_breaches(spark, area, CONTRACT)
    assert found.rdd.getNumPartitions() == 1
    assert [r.reason.startswith("cannot read file") for r in found.collect()] == [True] * 12


# ---------------------------------------------------------------- NOT NULL


@pytest.mark.parametrize("statistics", [True, False])
def test_nulls_of_parquet_files(spark, tmp_dir, statistics):
    good(tmp_dir, 1, write_statistics=statistics)
    land(tmp_dir, 2, "nulls", {"id": ["a", None, None], "n": pa.array([None, 2, 3], pa.int32())}, write_statistics=statistics, row_group_size=2)
    area = LandingArea(tmp_dir, "meter", "parquet")
    assert contract_breaches(spark, area, CONTRACT).count() == 0
    (row,) = contract_breaches(spark, area, CONTRACT, check_nulls=True).collect()
    assert row.path.endswith("/nulls.parquet") and row.reason == "column id: 2 NULL values"


def test_nulls_of_nested_required_columns_and_other_formats(spark, tmp_dir):
    schema = StructType.fromDDL("s struct<x: int> not null")
    typed = pa.array([{"x": 1}, None], pa.struct([("x", pa.int32())]))
    land(tmp_dir, 1, "nested", {"s": typed})
    (row,) = contract_breaches(spark, LandingArea(tmp_dir, "meter", "parquet"), schema, check_nulls=True).collect()
    assert row.reason == "column s: 1 NULL values"
    folder = f"{tmp_dir}/object=meter/year=2024/month=03/day=01/batch"
    orc.write_table(pa.table({"id": ["a", None], "n": pa.array([1, 2], pa.int32())}), f"{folder}/o.orc")
    (row,) = contract_breaches(spark, LandingArea(tmp_dir, "meter", "orc"), CONTRACT, check_nulls=True).collect()
    assert row.reason == "column id: 1 NULL values"
    with open(f"{folder}/c.csv", "w") as f:
        f.write("id,n\na,1\n,2\n,x\n")
    (row,) = contract_breaches(spark, LandingArea(tmp_dir, "meter", "csv"), CONTRACT, check_nulls=True).collect()
    assert row.reason == "1 of 3 rows do not fit the contract; column id: 1 NULL values"
    with open(f"{folder}/j.json", "w") as f:
        f.write('{"id": null, "n": 1}\n{"n": 1}\n')
    (row,) = contract_breaches(spark, LandingArea(tmp_dir, "meter", "json"), CONTRACT, check_nulls=True).collect()
    assert row.reason == "column id: NULL or absent on 2 lines"


# ---------------------------------------------------------------- nested contracts


def told(actual, wanted, **kw):
    return [str(b) for b in schema_breaches(StructType.fromDDL(actual), StructType.fromDDL(wanted), **kw)]


def test_breaches_name_nested_fields(spark):
    wanted = "a struct<x: int, y: struct<z: string>>, b array<struct<k: string, v: bigint>>, c map<string, struct<n: int>>"
    assert told(wanted, wanted) == []
    assert told("a struct<x: bigint, y: struct<z: string, q: int>>, b array<struct<k: string, v: bigint>>, c map<string, struct<n: int>>", wanted) == [
        "type of a.x: expected int, got bigint", "unexpected column a.y.q int"]
    assert told("a struct<y: struct<z: string>, x: int>, b array<struct<k: int>>, c map<int, struct<n: string>>", wanted) == [
        "position of a.x: expected 0, got 1", "position of a.y: expected 1, got 0", "type of b[].k: expected string, got int", "missing column b[].v bigint",
        "type of c{key}: expected string, got int", "type of c{value}.n: expected int, got string"]
    assert told("a int, b array<int>, c map<string, struct<n: int>>", wanted) == [
        "type of a: expected struct<x:int,y:struct<z:string>>, got int", "type of b[]: expected struct<k:string,v:bigint>, got int"]
    assert told("a struct<x: int not null>", "a struct<x: int>") == []
    assert told("a struct<x: int not null>", "a struct<x: int>", ignore_nullable=False) == ["nullability of a.x: expected True, got False"]


@pytest.mark.parametrize("actual, wanted, fit", [
    ("tinyint", "bigint", True), ("int", "bigint", True), ("bigint", "int", False), ("int", "double", True), ("bigint", "double", False), ("float", "double", True),
    ("double", "float", False), ("decimal(10,2)", "decimal(12,2)", True), ("decimal(10,2)", "decimal(12,4)", True), ("decimal(10,2)", "decimal(12,6)", False),
    ("int", "decimal(12,2)", True), ("bigint", "decimal(12,2)", False), ("date", "timestamp_ntz", True), ("string", "int", False), ("int", "string", False), ("int", "int", True),
])
def test_widening(spark, actual, wanted, fit):
    a, w = (StructType.fromDDL(f"x {t}").fields[0].dataType for t in (actual, wanted))
    assert fits(a, w) == fit
    assert (told(f"s array<struct<x: {actual}>>", f"s array<struct<x: {wanted}>>", widen=True) == []) == fit


def test_a_widened_file_loads(spark, tmp_dir):
    land(tmp_dir, 1, "narrow", {"id": ["a"], "n": pa.array([7], pa.int16())})
    area = LandingArea(tmp_dir, "meter", "parquet")
    assert contract_breaches(spark, area, CONTRACT).count() == 1
    assert contract_breaches(spark, area, CONTRACT, widen=True).count() == 0
    assert [r.n for r in area.read(spark, CONTRACT).collect()] == [7]
