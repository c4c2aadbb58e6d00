import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.operators.contract import LOG_SCHEMA, contract_breaches, quarantine_files, write_move_log
from sluice.plans.landing import CUSTOMER_CONTRACT, MoveError, apply_data_contract, load_conforming
from sluice.sources.landing import LandingArea, detect_files

WITH_CITY = StructType(CUSTOMER_CONTRACT.fields + [StructField("city", StringType(), True)])


def make_drops(spark, root, fmt, days=range(1, 10), month=10, break_day=6):
    """One file of ten rows a day; the file of ``break_day`` has one column too many."""
    for day in days:
        n = F.col("id")
        extra = [F.lit("Lyon").alias("city")] if day == break_day else []
        rows = spark.range(day * 100, day * 100 + 10).select(
            n.cast("string").alias("id"), F.format_string("p-%d", n).alias("name"), (n % 60 + 5).cast("int").alias("age"), F.lit("France").alias("country"), *extra
        )
        folder = f"{root}/object=customer/year=2025/month={month:02d}/day={day:02d}/part-{uuid.uuid4().hex[:6]}"
        rows.coalesce(1).write.format(fmt).save(folder)


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_f8_only_day_six_breaks_and_is_moved(spark, tmp_dir, fmt):
    make_drops(spark, tmp_dir, fmt)
    area = LandingArea(tmp_dir, "customer", fmt)
    assert area.files(spark).count() == 9
    log = apply_data_contract(spark, area, CUSTOMER_CONTRACT, f"{tmp_dir}/_log", (2000, 1, 1))
    rows = log.collect()
    assert len(rows) == 1
    r = rows[0]
    assert "/day=06/" in r["old_file_path"] and "city" in r["corrupted_message"] and r["move_status"] == "OK"
    assert "/object=customer_corrupted/year=2025/month=10/day=06/" in r["new_file_path"]
    assert not os.path.exists(r["old_file_path"].removeprefix("file:"))
    assert os.path.exists(r["new_file_path"].removeprefix("file:"))
    assert log.schema.fieldNames() == LOG_SCHEMA.fieldNames()
    assert load_conforming(spark, area, CUSTOMER_CONTRACT).count() == 80
    # second run: nothing left to quarantine
    assert apply_data_contract(spark, area, CUSTOMER_CONTRACT, f"{tmp_dir}/_log").count() == 0


def test_start_date_compares_full_date(spark, tmp_dir):
    make_drops(spark, tmp_dir, "parquet", days=[5], month=1, break_day=0)
    make_drops(spark, tmp_dir, "parquet", days=[2], month=7, break_day=0)
    got = [r["path"] for r in detect_files(spark, tmp_dir, "customer", "parquet", 2025, 6, 1).collect()]
    assert len(got) == 1 and "/month=07/" in got[0]


def test_strays_reported_not_dropped(spark, tmp_dir):
    make_drops(spark, tmp_dir, "json", days=[1], break_day=0)
    with open(f"{tmp_dir}/object=customer/stray.json", "w") as f:
        f.write('{"id": "x"}\n')
    area = LandingArea(tmp_dir, "customer", "json")
    assert area.files(spark).count() == 1
    both = area.files(spark, include_strays=True).collect()
    assert sorted(r["is_stray"] for r in both) == [False, True]


def test_json_type_and_malformed_and_required(spark, tmp_dir):
    d = f"{tmp_dir}/object=customer/year=2025/month=10/day=01/x"
    os.makedirs(d)
    with open(f"{d}/a.json", "w") as f:
        f.write('{"id": "1", "name": "a", "age": 30, "country": "X"}\n')
        f.write('{"id": "2", "name": "b", "age": "old", "country": "X"}\n')
        f.write("{not json\n")
        f.write('{"name": "c", "age": 5}\n')
    with open(f"{d}/b.json", "w") as f:
        f.write('{"country": "Y", "age": 7, "name": "d", "id": "9"}\n')  # order does not matter for JSON
    area = LandingArea(tmp_dir, "customer", "json")
    out = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in contract_breaches(spark, area, CUSTOMER_CONTRACT).collect()}
    assert list(out) == ["a.json"]
    reason = out["a.json"]
    assert "1 malformed lines" in reason and "column age: 1 values do not fit int" in reason
    assert "column id" not in reason
    strict = contract_breaches(spark, area, CUSTOMER_CONTRACT, ignore_nullable=False).collect()
    assert "column id: NULL or absent on 1 lines" in strict[0]["reason"]


def test_unreadable_parquet_is_a_breach(spark, tmp_dir):
    d = f"{tmp_dir}/object=customer/year=2025/month=10/day=01/x"
    os.makedirs(d)
    with open(f"{d}/broken.parquet", "wb") as f:
        f.write(b"not a parquet file")
    area = LandingArea(tmp_dir, "customer", "parquet")
    rows = contract_breaches(spark, area, CUSTOMER_CONTRACT).collect()
    assert len(rows) == 1 and rows[0]["reason"].startswith("cannot read file")


def test_failed_move_is_logged_then_raised(spark, tmp_dir):
    make_drops(spark, tmp_dir, "parquet", days=[6])
    area = LandingArea(tmp_dir, "customer", "parquet")
    # a plain file where the quarantine directory must go makes the move fail
    os.makedirs(f"{tmp_dir}/object=customer_corrupted/year=2025/month=10")
    open(f"{tmp_dir}/object=customer_corrupted/year=2025/month=10/day=06", "w").close()
    with pytest.raises(MoveError):
        apply_data_contract(spark, area, CUSTOMER_CONTRACT, f"{tmp_dir}/_log")
    log = spark.read.parquet(f"{tmp_dir}/_log").collect()
    assert len(log) == 1 and log[0]["move_status"] != "OK" and log[0]["inserted_at"] is not None


def test_moves_are_idempotent_on_retry(spark, tmp_dir):
    make_drops(spark, tmp_dir, "parquet", days=[6])
    area = LandingArea(tmp_dir, "customer", "parquet")
    plan = spark.createDataFrame(
        [(r["path"], r["reason"]) for r in contract_breaches(spark, area, CUSTOMER_CONTRACT).collect()], "path string, reason string"
    )
    first = quarantine_files(area, plan).collect()
    again = quarantine_files(area, plan).collect()  # as a retried task would
    assert [r["move_status"] for r in first] == ["OK"] and [r["move_status"] for r in again] == ["OK"]


def test_log_written_once(spark, tmp_dir):
    make_drops(spark, tmp_dir, "parquet", days=[6])
    area = LandingArea(tmp_dir, "customer", "parquet")
    log = write_move_log(quarantine_files(area, contract_breaches(spark, area, CUSTOMER_CONTRACT)), f"{tmp_dir}/_log", "r1")
    assert log.count() == 1 and log.count() == 1


def test_json_reason_names_every_unexpected_key(spark, tmp_dir):
    d = f"{tmp_dir}/object=customer/year=2025/month=10/day=01/x"
    os.makedirs(d)
    with open(f"{d}/a.json", "w") as f:
        for i in range(50):
            f.write('{"id": "%d", "k%02d": 1}\n' % (i, i))
    area = LandingArea(tmp_dir, "customer", "json")
    (reason,) = [r["reason"] for r in contract_breaches(spark, area, CUSTOMER_CONTRACT).collect()]
    assert reason == "unexpected columns: " + ", ".join(f"k{i:02d}" for i in range(50))


def test_clean_first_run_and_strays(spark, tmp_dir):
    make_drops(spark, tmp_dir, "json", days=[1, 2], break_day=0)
    area = LandingArea(tmp_dir, "customer", "json")
    assert apply_data_contract(spark, area, CUSTOMER_CONTRACT, f"{tmp_dir}/_log").collect() == []
    with open(f"{tmp_dir}/object=customer/stray.json", "w") as f:
        f.write('{"id": "x"}\n')
    (row,) = apply_data_contract(spark, area, CUSTOMER_CONTRACT, f"{tmp_dir}/_log").collect()
    assert row["old_file_path"].endswith("/stray.json") and row["move_status"] == "STRAY" and row["new_file_path"] is None


def test_log_table_keeps_every_run(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS landing_moves")
    make_drops(spark, tmp_dir, "parquet", days=[5, 6])
    area = LandingArea(tmp_dir, "customer", "parquet")
    assert apply_data_contract(spark, area, CUSTOMER_CONTRACT, None, log_table="landing_moves").count() == 1
    assert apply_data_contract(spark, area, CUSTOMER_CONTRACT, None, log_table="landing_moves").count() == 0
    assert spark.table("landing_moves").count() == 1


@pytest.mark.parametrize("value, fits", [("25", True), ('"25"', False), ("25.7", False), ("null", True), ("99999999999", False), ("true", False), ("[1]", False), ("-0", True)])
def test_a_conforming_json_value_never_loads_as_null(spark, tmp_dir, value, fits):
    d = f"{tmp_dir}/object=customer/year=2025/month=10/day=01/x"
    os.makedirs(d)
    with open(f"{d}/a.json", "w") as f:
        f.write('{"id": "1", "name": "n", "age": %s, "country": "c"}\n' % value)
    area = LandingArea(tmp_dir, "customer", "json")
    assert contract_breaches(spark, area, CUSTOMER_CONTRACT).isEmpty() == fits
    loaded = load_conforming(spark, area, CUSTOMER_CONTRACT).collect()[0]["age"]
    assert (loaded is None) == (value == "null" or not fits)


def test_csv_options_serve_checks_and_load(spark, tmp_dir):
    d = f"{tmp_dir}/object=customer/year=2025/month=10/day=01/x"
    os.makedirs(d)
    with open(f"{d}/a.csv", "w", encoding="utf-8-sig") as f:
        f.write('id;name;age;country\n1;"a\nb";30;X\n2;"c;d";40;Y\n')
    area = LandingArea(tmp_dir, "customer", "csv", multiline=True, options=(("sep", ";"),))
    assert contract_breaches(spark, area, CUSTOMER_CONTRACT).collect() == []
    rows = load_conforming(spark, area, CUSTOMER_CONTRACT).orderBy("id").collect()
    assert [(r["id"], r["name"], r["age"]) for r in rows] == [("1", "a\nb", 30), ("2", "c;d", 40)]


def test_a_file_that_cannot_be_fetched_is_no_breach(spark, tmp_dir):
    from sluice.operators.contract import file_schema_breaches

    gone = spark.createDataFrame([(f"{tmp_dir}/gone.parquet",)], "path string")
    with pytest.raises(Exception, match="gone.parquet"):
        file_schema_breaches(gone, "parquet", CUSTOMER_CONTRACT).collect()


def test_missing_area_lists_nothing(spark, tmp_dir):
    area = LandingArea(tmp_dir, "nothing_here", "parquet")
    assert area.files(spark).count() == 0
    assert contract_breaches(spark, area, CUSTOMER_CONTRACT).count() == 0
    assert contract_breaches(spark, LandingArea(tmp_dir, "nothing_here", "json"), CUSTOMER_CONTRACT).count() == 0


def test_csv_header_contract(spark, tmp_dir):
    make_drops(spark, tmp_dir, "csv", days=[1, 6])
    # make_drops writes csv without a header; rewrite both drops with headers
    for day, with_city in ((2, False), (7, True)):
        rows = spark.createDataFrame([("1", "a", 20, "X", "c")], WITH_CITY) if with_city else spark.createDataFrame(
            [("1", "a", 20, "X")], CUSTOMER_CONTRACT
        )
        rows.coalesce(1).write.option("header", "true").csv(f"{tmp_dir}/object=customer/year=2025/month=10/day={day:02d}/h")
    area = LandingArea(tmp_dir, "customer", "csv")
    out = {r["path"].split("/day=")[1][:2]: r["reason"] for r in contract_breaches(spark, area, CUSTOMER_CONTRACT).collect()}
    assert set(out) == {"01", "06", "07"}  # headerless drops and the drop with an extra column
    assert "city" in out["07"]


def test_avro_rows_are_reported_unavailable(spark, tmp_dir):
    """Contracts read headers (tests/test_avro.py); rows need Spark's avro source."""
    with pytest.raises(NotImplementedError):
        load_conforming(spark, LandingArea(tmp_dir, "customer", "avro"), CUSTOMER_CONTRACT)
    with pytest.raises(NotImplementedError):
        contract_breaches(spark, LandingArea(tmp_dir, "customer", "avro"), CUSTOMER_CONTRACT, deep=True)


def test_start_date_narrows_the_listed_folders(spark, tmp_dir):
    for year, month, day in [(2023, 12, 31), (2024, 6, 1), (2025, 9, 30), (2025, 10, 2), (2025, 10, 3), (2025, 11, 1), (2026, 1, 1)]:
        d = f"{tmp_dir}/object=customer/year={year}/month={month:02d}/day={day:02d}/x"
        os.makedirs(d)
        with open(f"{d}/a.json", "w") as f:
            f.write('{"id": "1"}\n')
    area = LandingArea(tmp_dir, "customer", "json")
    roots = sorted(r.split("object=customer/")[1] for r in area.roots(spark, (2025, 10, 3)))
    assert roots == ["year=2025/month=10", "year=2025/month=11", "year=2026"]
    days = sorted((r["year"], r["month"], r["day"]) for r in area.files(spark, (2025, 10, 3)).collect())
    assert days == [(2025, 10, 3), (2025, 11, 1), (2026, 1, 1)]
    assert area.lines(spark, (2025, 10, 3)).count() == 3
    assert area.files(spark).count() == 7


def test_generated_drops_break_on_one_day(spark, tmp_dir):
    from sluice.plans.landing import generate_drops

    area = LandingArea(tmp_dir, "customer", "parquet")
    generate_drops(spark, area, seed=7)
    rows = area.read(spark, CUSTOMER_CONTRACT).collect()
    assert len(rows) == 90 and all(18 <= r["age"] <= 70 for r in rows)
    log = apply_data_contract(spark, area, CUSTOMER_CONTRACT, f"{tmp_dir}/_log")
    assert [r["old_file_path"].split("/day=")[1][:1] for r in log.collect()] == ["6"] * log.count()
    assert load_conforming(spark, area, CUSTOMER_CONTRACT).count() == 80


def test_read_with_nothing_in_scope(spark, tmp_dir):
    area = LandingArea(tmp_dir, "customer", "parquet")
    assert area.read(spark, CUSTOMER_CONTRACT).count() == 0
    make_drops(spark, tmp_dir, "parquet", days=[1])
    assert area.read(spark, CUSTOMER_CONTRACT, (2030, 1, 1)).count() == 0
    assert area.read(spark, CUSTOMER_CONTRACT, (2025, 10, 1)).count() == 10


def test_multiline_json_documents(spark, tmp_dir):
    d = f"{tmp_dir}/object=customer/year=2025/month=10/day=01/x"
    os.makedirs(d)
    with open(f"{d}/arr.json", "w") as f:  # an array document over several lines
        f.write('[\n  {"id": "1", "name": "a", "age": 30, "country": "X"},\n  {"id": "2", "age": "old", "city": "Y"}\n]\n')
    with open(f"{d}/obj.json", "w") as f:  # one pretty-printed object: conforming
        f.write('{\n  "id": "3",\n  "name": "b",\n  "age": 40\n}\n')
    with open(f"{d}/empty.json", "w") as f:
        f.write("[]\n")
    with open(f"{d}/bad.json", "w") as f:
        f.write('{"id": "4",\n')
    area = LandingArea(tmp_dir, "customer", "json", multiline=True)
    out = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in contract_breaches(spark, area, CUSTOMER_CONTRACT).collect()}
    assert set(out) == {"arr.json", "bad.json"}, out
    assert "column age: 1 values do not fit int" in out["arr.json"] and "unexpected columns: city" in out["arr.json"]
    assert out["bad.json"] == "1 malformed records"
    assert area.read(spark, CUSTOMER_CONTRACT).where("id = '3'").count() == 1


def test_csv_values_must_fit_the_contract(spark, tmp_dir):
    d = f"{tmp_dir}/object=customer/year=2025/month=10/day=01/x"
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as f:
        f.write("id,name,age,country\n1,a,30,X\n2,b,old,Y\n3,c,40,Z,extra\n")
    with open(f"{d}/b.csv", "w") as f:
        f.write("id,name,age,country\n4,d,50,W\n")
    area = LandingArea(tmp_dir, "customer", "csv")
    out = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in contract_breaches(spark, area, CUSTOMER_CONTRACT).collect()}
    assert out == {"a.csv": "2 of 3 rows do not fit the contract"}, out


def test_json_unexpected_keys_full_list(spark, tmp_dir):
    from sluice.operators.contract import json_unexpected_keys

    d = f"{tmp_dir}/object=customer/year=2025/month=10/day=01/x"
    os.makedirs(d)
    with open(f"{d}/a.json", "w") as f:
        for i in range(50):
            f.write('{"id": "%d", "k%02d": 1, "shared": 2}\n' % (i, i))
    area = LandingArea(tmp_dir, "customer", "json")
    rows = json_unexpected_keys(area.lines(spark), CUSTOMER_CONTRACT).collect()
    got = {r["key"]: r["records"] for r in rows}
    assert len(got) == 51 and got["shared"] == 50 and got["k49"] == 1
