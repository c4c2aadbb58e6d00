"""Journal of quarantine moves: what is to be moved is written down before anything moves.

One folder a run, ``<root>/_moves/object=<name>/run_id=<id>``: the intents (the log rows to be, without
outcome) and, once they are complete, ``noted.json``, which says where the log goes. Then the moves run
on the executors, their outcomes are written to the log, and the folder is deleted. A run that stopped
is finished by the next one over the area (or by :func:`finish_open_runs`): without the note nothing was
moved and the folder is dropped; with it the moves are repeated, which finds those that were done, and
the log gets the rows it lacks. So a log ends with one row for each intent, wherever the run stopped.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.landing import LandingArea
from .contract import LOG_SCHEMA, moved
from .publish import _fs, children, path_exists, read_text, write_text

NOTE = "noted.json"
#: outcomes that need no one's attention
SETTLED = ("OK", "STRAY")
_INTENT = "old_file_path string, new_file_path string, corrupted_message string, move_status string"


def journal_dir(area: LandingArea) -> str:
    return f"{area.root.rstrip('/')}/_moves/object={area.object_name}"


def _folder(area: LandingArea, run_id: str) -> str:
    return f"{journal_dir(area)}/run_id={run_id}"


def note_moves(spark: SparkSession, area: LandingArea, planned: DataFrame, run_id: str, log_path: str | None, log_table: str | None) -> None:
    """Write down what a run will move (``planned`` rows with a null move_status) or only log."""
    folder = _folder(area, run_id)
    planned.select("old_file_path", "new_file_path", "corrupted_message", "move_status").write.parquet(f"{folder}/intents")
    write_text(spark, f"{folder}/{NOTE}", json.dumps({"log_path": log_path, "log_table": log_table}))


def open_runs(spark: SparkSession, area: LandingArea) -> list[str]:
    """Runs whose folder is still there."""
    return sorted(c.removeprefix("run_id=") for c in children(spark, journal_dir(area)) if c.startswith("run_id="))


def finish_open_runs(spark: SparkSession, area: LandingArea) -> list[str]:
    """Finish or drop the runs that stopped; their ids."""
    runs = open_runs(spark, area)
    for run_id in runs:
        finish_run(spark, area, run_id, again=True)
    return runs


def finish_run(spark: SparkSession, area: LandingArea, run_id: str, again: bool = False) -> tuple[DataFrame | None, str | None]:
    """Move what a run noted and write its log: (the run's log rows, a failed move or None). The failures
    are observed on the write itself. ``again``: an earlier attempt may have moved and logged some."""
    folder = _folder(area, run_id)
    noted = read_text(spark, f"{folder}/{NOTE}")
    failed = None
    log = None
    if noted is not None:
        note = json.loads(noted)
        intents = spark.read.schema(_INTENT).parquet(f"{folder}/intents")
        name, own = note["log_table"], f"{(note['log_path'] or '').rstrip('/')}/run_id={run_id}"
        if name is not None and again and spark.catalog.tableExists(name):
            logged = spark.table(name).where(F.col("run_id") == run_id).select("old_file_path").distinct()
            intents = intents.join(logged, "old_file_path", "left_anti").select(intents.columns)
        if name is not None or not (again and path_exists(spark, f"{own}/_SUCCESS")):
            seen = Observation()
            is_failed = ~F.col("move_status").isin(*SETTLED)
            example = F.max(F.when(is_failed, F.concat("old_file_path", F.lit(": "), "move_status")))
            rows = moved(intents, again).observe(seen, F.count_if(is_failed).alias("failed"), example.alias("example"))
            if name is not None:
                rows.withColumn("run_id", F.lit(run_id)).write.mode("append").saveAsTable(name)
            else:  # the folder is this run's: a repeated write replaces it
                rows.write.mode("overwrite").parquet(own)
            failed = seen.get["example"] if seen.get["failed"] else None
        if name is not None:
            log = spark.table(name).where(F.col("run_id") == run_id).drop("run_id")
        else:
            log = spark.read.schema(LOG_SCHEMA).parquet(own)
    fs, p = _fs(spark, folder)
    fs.delete(p, True)
    return log, failed
