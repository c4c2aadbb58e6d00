"""Landing → bronze under a schema contract.

detect (listing) → verify (per-file contract) → journal (what is to be moved, written down first) →
quarantine (moves on executors) → movement log → gate (raise if a move failed, after the log is written) →
conforming read of the remaining files with the contract schema. A run that stopped half way is finished
by the next one from its journal (:mod:`~sluice.operators.move_journal`).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators.contract import contract_breaches, planned_moves, planned_strays
from ..operators.move_journal import finish_open_runs, finish_run, note_moves
from ..sources.landing import LandingArea

# The customer contract of the landing demo (bronze layer schema).
CUSTOMER_CONTRACT = StructType(
    [
        StructField("id", StringType(), False),
        StructField("name", StringType(), True),
        StructField("age", IntegerType(), True),
        StructField("country", StringType(), True),
    ]
)


class MoveError(RuntimeError):
    """Some quarantine moves failed; the movement log holds the details."""


def apply_data_contract(
    spark: SparkSession,
    area: LandingArea,
    contract: StructType,
    log_path: str | None,
    start=None,
    *,
    ignore_nullable: bool = True,
    deep: bool = False,
    raise_on_failed_moves: bool = True,
    log_strays: bool = True,
    log_table: str | None = None,
    check_nulls: bool = False,
    widen: bool = False,
) -> DataFrame:
    """Verify the area's files from ``start`` on, quarantine breaching ones and return this run's
    movement log (``old_file_path, new_file_path, corrupted_message, inserted_at, move_status``), written
    to a path or, with ``log_table``, appended to a table. Files outside the date folders are logged as
    strays (``log_strays=False`` spares listing the folders before ``start``). One run at a time an area."""
    finish_open_runs(spark, area)
    breaches = contract_breaches(spark, area, contract, start, ignore_nullable=ignore_nullable, deep=deep, check_nulls=check_nulls, widen=widen)
    planned = planned_moves(area, breaches)
    if log_strays:
        planned = planned.unionByName(planned_strays(spark, area))
    run_id = uuid.uuid4().hex
    # nothing moves before all listing is done: what is written here is all that the moves read
    note_moves(spark, area, planned, run_id, log_path, log_table)
    log, failed = finish_run(spark, area, run_id)
    if raise_on_failed_moves and failed:
        raise MoveError(f"some files could not be moved, e.g. {failed}")
    return log


def write_customer_drops(
    customer: DataFrame,
    nation: DataFrame,
    area: LandingArea,
    *,
    year: int = 2025,
    month: int = 10,
    days: int = 9,
    break_day: int = 6,
) -> None:
    """Landing drops derived from ``customer``: customer ``k`` lands on day ``k % days + 1``;
    the ``break_day`` drop carries an extra ``city`` column, breaking the contract.

    ``id, name, age, country`` = custkey as text, name, ``18 + k % 53``, nation name.
    Written with ``partitionBy(year, month, day)`` so each task writes its own day directories;
    dynamic partition overwrite makes a re-run replace its days instead of adding copies.
    """
    nations = nation.select("n_nationkey", F.col("n_name").alias("country"), "n_regionkey")
    rows = customer.join(nations, customer["c_nationkey"] == nations["n_nationkey"], "left").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        (F.lit(18) + F.col("c_custkey") % 53).cast("int").alias("age"),
        "country",
        F.concat(F.lit("City "), F.col("n_regionkey").cast("string")).alias("city"),
        F.lit(year).alias("year"),
        F.lit(month).alias("month"),
        (F.col("c_custkey") % days + 1).cast("int").alias("day"),
    )
    keep = ["id", "name", "age", "country", "year", "month", "day"]
    writer_opts = dict(mode="overwrite", format=area.fmt, partitionBy=["year", "month", "day"])
    good = rows.where(F.col("day") != break_day).select(*keep)
    broken = rows.where(F.col("day") == break_day).select(*keep[:4], "city", *keep[4:])
    for part in (good, broken):
        part.write.options(**area.reader_options()).option("partitionOverwriteMode", "dynamic").save(area.object_dir, **writer_opts)


def load_conforming(spark: SparkSession, area: LandingArea, contract: StructType, start=None) -> DataFrame:
    """Rows of the files left after quarantine, read with the contract schema."""
    return area.read(spark, contract, start)


def generate_drops(
    spark: SparkSession,
    area: LandingArea,
    *,
    year: int = 2025,
    month: int = 10,
    days: int = 9,
    rows_per_day: int = 10,
    break_day: int = 6,
    seed: int = 0,
    names: list[str] | None = None,
    countries: list[str] | None = None,
    cities: list[str] | None = None,
) -> None:
    """Random landing drops for demos and tests: ``days`` drops of ``rows_per_day`` rows with a uuid
    ``id``, a name, an age 18–70 and a country drawn with seeded ``rand``; the ``break_day`` drop
    also carries a ``city`` column. Each drop gets its own ``drop=<id>`` folder below its day.
    """
    names = names or [f"name_{i}" for i in range(10)]
    countries = countries or [f"country_{i}" for i in range(10)]
    cities = cities or [f"city_{i}" for i in range(10)]

    def pick(values, s):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(F.rand(s) * len(values)) + 1).cast("int"))

    rows = spark.range(days * rows_per_day).select(
        F.expr("uuid()").alias("id"),
        pick(names, seed).alias("name"),
        (F.lit(18) + F.floor(F.rand(seed + 1) * 53)).cast("int").alias("age"),
        pick(countries, seed + 2).alias("country"),
        pick(cities, seed + 3).alias("city"),
        F.lit(year).alias("year"),
        F.lit(month).alias("month"),
        (F.col("id") % days + 1).cast("int").alias("day"),
    ).withColumn("drop", F.substring(F.sha2(F.concat_ws("/", F.lit(seed), "year", "month", "day"), 256), 1, 16))
    keep = ["id", "name", "age", "country", "year", "month", "day", "drop"]
    writer_opts = dict(mode="overwrite", format=area.fmt, partitionBy=["year", "month", "day", "drop"])
    good = rows.where(F.col("day") != break_day).select(*keep)
    broken = rows.where(F.col("day") == break_day).select(*keep[:4], "city", *keep[4:])
    for part in (good, broken):
        part.write.option("partitionOverwriteMode", "dynamic").save(area.object_dir, **writer_opts)
