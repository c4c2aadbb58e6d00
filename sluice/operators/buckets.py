"""Targets laid out by buckets of their keys, so that a merge reads and writes only what it changes.

A bucketed target is partitioned by ``merge_bucket = pmod(hash(keys), n)``: one folder a bucket under a path,
one catalog partition a bucket in a table. A null key has a bucket like any other value. The layout is
noted where the target lies: in the hidden file ``_buckets.json`` of a path, in the properties of a table.
The number of buckets is fixed when the target is made; a bucket should hold some hundred MB, since a
changed key costs its bucket.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from .._util import as_list, quote, resolve_names
from .publish import path_exists, read_text, replace_table, write_path

BUCKET = "merge_bucket"
_NOTE = "_buckets.json"
_KEYS, _COUNT = "sluice.bucket.keys", "sluice.bucket.count"


@dataclass(frozen=True)
class Buckets:
    keys: tuple[str, ...]
    n: int
    schema: StructType  # of the rows, without the bucket
    fmt: str = "parquet"

    @classmethod
    def of_path(cls, spark: SparkSession, path: str) -> Buckets | None:
        """The layout noted at a path, if there is one."""
        noted = read_text(spark, f"{path.rstrip('/')}/{_NOTE}")
        if noted is None:
            return None
        note = json.loads(noted)
        return cls(tuple(note["keys"]), note["n"], StructType.fromJson(note["schema"]), note["fmt"])

    @classmethod
    def of_table(cls, spark: SparkSession, name: str) -> Buckets | None:
        """The layout noted in a table's properties, if there is one."""
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if _KEYS not in properties:
            return None
        schema = StructType([f for f in spark.table(name).schema.fields if f.name != BUCKET])
        return cls(tuple(json.loads(properties[_KEYS])), int(properties[_COUNT]), schema)

    def bucket(self, keys: list[Column]) -> Column:
        """The bucket of key values, which must have the target's types."""
        return F.pmod(F.hash(*keys), F.lit(self.n))

    def place(self, df: DataFrame) -> DataFrame:
        """``df`` (the target's columns) with each row's bucket, dealt by buckets so that each is written by
        few tasks; Spark splits a large bucket and joins small ones by their measured size."""
        keys = [F.col(quote(k)) for k in resolve_names(df.columns, self.keys)]
        return df.withColumn(BUCKET, self.bucket(keys)).hint("rebalance", F.col(BUCKET))

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """The rows of a path with their bucket; the schema is the noted one, so an empty target is readable."""
        schema = StructType([*self.schema.fields]).add(BUCKET, IntegerType())
        return spark.read.format(self.fmt).schema(schema).load(path)

    def replace(self, df: DataFrame, path: str | None, name: str | None) -> DataFrame:
        """Write ``df`` as the whole content of the target."""
        spark = df.sparkSession
        rows = self.place(df.select(*[F.col(quote(f.name)) for f in self.schema.fields]))
        if name is not None:
            return replace_table(rows, name).drop(BUCKET)
        note = json.dumps({"keys": list(self.keys), "n": self.n, "schema": self.schema.jsonValue(), "fmt": self.fmt})
        write_path(rows, path, self.fmt, BUCKET, files={_NOTE: note})
        return self.read(spark, path).drop(BUCKET)


def _nullable(schema: StructType) -> StructType:
    return StructType([type(f)(f.name, f.dataType, True) for f in schema.fields])


def write_bucketed(
    df: DataFrame, keys, n: int, *, path: str | None = None, table: str | None = None, fmt: str = "parquet", location: str | None = None
) -> DataFrame:
    """Make (or replace) a target of ``n`` buckets by ``keys`` at a path or as a table (external with a
    ``location``), and return its rows.

    Columns named ``merge_bucket`` are refused. An empty frame makes an empty target."""
    if (table is None) == (path is None):
        raise ValueError("give exactly one of table= or path=")
    if n < 1:
        raise ValueError("the number of buckets has to be positive")
    if BUCKET in [c.lower() for c in df.columns]:
        raise ValueError(f"the frame has a column {BUCKET}")
    spark = df.sparkSession
    layout = Buckets(tuple(resolve_names(df.columns, as_list(keys))), n, _nullable(df.schema), fmt)
    if path is not None:
        return layout.replace(df, path, None)
    if spark.catalog.tableExists(table):
        found = Buckets.of_table(spark, table)
        if found is None or (found.keys, found.n) != (layout.keys, layout.n):
            raise ValueError(f"{table} is there with another layout")
        return found.replace(df, None, table)
    writer = layout.place(df).write.format(fmt).partitionBy(BUCKET)
    (writer.option("path", location) if location else writer).saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_KEYS}' = '{json.dumps(list(layout.keys))}', '{_COUNT}' = '{n}')")
    return spark.table(table).drop(BUCKET)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a bucketed path target."""
    layout = Buckets.of_path(spark, path)
    if layout is None:
        raise FileNotFoundError(f"no bucketed target at {path}" if path_exists(spark, path) else f"no {path}")
    return layout.read(spark, path).drop(BUCKET)
