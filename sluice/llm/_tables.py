"""Intermediate tables in the shared folder of ``spark.checkpoint.dir`` and reading of input tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_root


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder; nothing is created there yet."""
    return f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
