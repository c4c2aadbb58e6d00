"""Check configuration: JSON arrays of ``{catalog, schema, table, data_checks: [{sql, message}]}``."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import DataCheck, clauses_of

CONFIG_DDL = (
    "catalog string, schema string, table string, "
    "data_checks array<struct<sql: string, message: string>>"
)


def read_check_configs(spark: SparkSession, path: str) -> DataFrame:
    """All configurations under ``path`` (a file, a directory of ``*.json`` or a glob).

    The schema is given, so Spark does not infer it with an extra pass over the files.
    """
    if "://" not in path and not path.startswith("file:") and os.path.isdir(path):
        path = os.path.join(os.path.abspath(path), "*.json")
    return spark.read.schema(CONFIG_DDL).option("multiLine", "true").json(path)


def load_data_checks(
    spark: SparkSession,
    source_system: str,
    catalog: str,
    schema: str,
    table: str,
    *,
    config_root: str = "data_checks_cfg",
) -> DataCheck:
    """The one configuration of ``catalog.schema.table`` in ``<config_root>/<source_system>``.

    Zero or several matching entries raise; a NULL sql or message raises.
    """
    root = config_root
    if "://" not in root and not root.startswith("file:"):
        root = os.path.abspath(root)
    configs = read_check_configs(spark, f"{root}/{source_system}")
    rows = (
        configs.where((F.col("catalog") == catalog) & (F.col("schema") == schema) & (F.col("table") == table))
        .limit(2)
        .collect()
    )
    where = f"{catalog}.{schema}.{table} in {root}/{source_system}"
    if not rows:
        raise LookupError(f"no data check configuration for {where}")
    if len(rows) > 1:
        raise LookupError(f"several data check configurations for {where}")
    row = rows[0]
    return DataCheck(row["catalog"], row["schema"], row["table"], clauses_of(row["data_checks"] or []))
