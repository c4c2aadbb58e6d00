"""Landing areas: ``<root>/object=<name>/year=YYYY/month=MM/day=DD/<drop>/<files>``.

The driver lists folder names only: years, months and days, from the start date on. The day folders
are rows of a DataFrame, and tasks list the files below them, so the number of files costs the driver
nothing. No file is opened. Whatever else lies in the area is listed too where it matters and reported as
strays instead of being dropped silently. On file systems that tasks cannot open, Spark's ``binaryFile`` source
lists instead (without ``content``). Reads use the same path predicate on ``_metadata.file_path``,
which Spark applies to the file index: files before the start date are never opened.

Spark's file index lists every file below its root paths before any filter applies, so with a start
date the roots of a read are narrowed first: to the ``year=`` folders and the ``month=`` folders of the
start year (a few dozen names).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.paths import (
    date_key,
    glob_for,
    path_date_key,
    path_day,
    path_month,
    path_year,
    quarantine_path,
)


FILES_SCHEMA = (
    "path string, year int, month int, day int, date_key int, length bigint, "
    "modification_time timestamp, is_stray boolean"
)


def _has_avro(spark: SparkSession) -> bool:
    try:
        spark.read.format("avro").schema("x int").load([])
    except Exception as e:
        return "AVRO" not in str(e).upper()
    return True


def _hidden(name: str) -> bool:
    """Names that Spark's file index leaves out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _lister(glob: str, rows: int = 10_000):
    """Files of (folder, below) rows, as Spark's file index would list them: hidden ones are left out."""

    def run(batches):
        import fnmatch
        from itertools import islice

        import pyarrow as pa
        import pyarrow.fs as pafs

        from ..operators.contract import _arrow_fs

        def listed():
            for batch in batches:
                for folder, below in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    files, base = _arrow_fs(folder)
                    for info in files.get_file_info(pafs.FileSelector(base, recursive=below, allow_not_found=True)):
                        parts = info.path[len(base.rstrip("/")) + 1 :].split("/")
                        if info.type == pafs.FileType.File and fnmatch.fnmatchcase(parts[-1], glob) and not any(map(_hidden, parts)):
                            yield f"{folder.rstrip('/')}/{'/'.join(parts)}", info.size, info.mtime

        found = listed()
        while part := list(islice(found, rows)):
            paths, sizes, times = zip(*part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(times, pa.timestamp("us", "UTC"))],
                ["path", "length", "modification_time"],
            )

    return run


@dataclass(frozen=True)
class LandingArea:
    root: str
    object_name: str
    fmt: str = "parquet"
    multiline: bool = False  # JSON documents over many lines; CSV records with quoted line feeds
    options: tuple = ()  # further reader options as (name, value) pairs, e.g. (("sep", ";"),)

    def reader_options(self) -> dict[str, str]:
        """The options every read of this area uses: the checks' and the load's."""
        out = {"header": "true"} if self.fmt.lower() == "csv" else {}
        if self.multiline and self.fmt.lower() in ("csv", "json"):
            out["multiLine"] = "true"
        return out | dict(self.options)

    @property
    def object_dir(self) -> str:
        return f"{self.root.rstrip('/')}/object={self.object_name}"

    def _in_scope(self, path: Column, start, include_strays: bool) -> Column:
        key = path_date_key(path)
        start = date_key(start)
        cond = F.lit(True) if start is None else key >= F.lit(start)
        return (cond | key.isNull()) if include_strays else (key.isNotNull() & cond)

    def exists(self, spark: SparkSession) -> bool:
        from ..operators.publish import path_exists

        return path_exists(spark, self.object_dir)

    def roots(self, spark: SparkSession, start=None, include_strays: bool = False) -> list[str]:
        """Folders to list: the object folder, or with a start date only the year folders after
        the start year and the month folders of the start year from the start month on."""
        start = date_key(start)
        if start is None or include_strays:
            return [self.object_dir]
        from ..operators.publish import _fs

        y0, m0 = start // 10000, start // 100 % 100
        fs, obj = _fs(spark, self.object_dir)
        out = []
        for year_dir in fs.listStatus(obj):
            ym = re.fullmatch(r"year=(\d{4})", year_dir.getPath().getName())
            if not (year_dir.isDirectory() and ym) or int(ym.group(1)) < y0:
                continue
            if int(ym.group(1)) > y0:
                out.append(year_dir.getPath().toString())
                continue
            for month_dir in fs.listStatus(year_dir.getPath()):
                mm = re.fullmatch(r"month=(\d{1,2})", month_dir.getPath().getName())
                if month_dir.isDirectory() and mm and int(mm.group(1)) >= m0:
                    out.append(month_dir.getPath().toString())
        return out

    def folders(self, spark: SparkSession, start=None, include_strays: bool = False) -> list[tuple[str, bool]]:
        """Folders to list, and whether with what lies below them: the day folders from ``start`` on, and,
        for strays or without a start, every other folder and the files beside them."""
        from ..operators.publish import _fs, _path

        first = date_key(start) or 0
        others = include_strays or start is None
        fs, obj = _fs(spark, self.object_dir)
        level, out = [(fs.makeQualified(obj), 0)], []
        for name, factor in (("year", 10000), ("month", 100), ("day", 1)):
            below = []
            for folder, key in level:
                loose = False
                for st in fs.listStatus(folder):
                    m = re.fullmatch(name + (r"=(\d{4})" if name == "year" else r"=(\d{1,2})"), st.getPath().getName())
                    if not st.isDirectory():
                        loose = True
                    elif m:
                        at = key + int(m.group(1)) * factor
                        if at >= first // factor * factor:
                            below.append((st.getPath(), at))
                    elif others and not _hidden(st.getPath().getName()):
                        out.append((st.getPath().toString(), True))
                if loose and others:
                    out.append((folder.toString(), False))
            level = below
        return out + [(folder.toString(), True) for folder, _ in level]

    def _listed_by_spark(self, spark: SparkSession, start, include_strays: bool) -> DataFrame:
        return (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", glob_for(self.fmt))
            .option("recursiveFileLookup", "true")
            .load(self.roots(spark, start, include_strays) or [self.object_dir])
            .select("path", "length", F.col("modificationTime").alias("modification_time"))
        )

    def files(self, spark: SparkSession, start=None, *, include_strays: bool = False) -> DataFrame:
        """One row per landing file of this format on or after ``start``:
        ``path, year, month, day, date_key, length, modification_time, is_stray``
        (empty when the object folder does not exist yet)."""
        if not self.exists(spark):
            return spark.createDataFrame([], FILES_SCHEMA)
        if re.match(r"^(/|(file|hdfs|s3|s3a|s3n|gs|gcs|abfs|abfss):)", self.root):
            folders = self.folders(spark, start, include_strays)
            if not folders:
                return spark.createDataFrame([], FILES_SCHEMA)
            rows = spark.createDataFrame(folders, "folder string, below boolean")
            tasks = min(len(folders), 4 * spark.sparkContext.defaultParallelism)
            listing = rows.repartition(tasks).mapInArrow(_lister(glob_for(self.fmt)), "path string, length bigint, modification_time timestamp")
        else:
            listing = self._listed_by_spark(spark, start, include_strays)
        p = F.col("path")
        return listing.where(self._in_scope(p, start, include_strays)).select(
            "path",
            path_year(p).alias("year"),
            path_month(p).alias("month"),
            path_day(p).alias("day"),
            path_date_key(p).alias("date_key"),
            "length",
            "modification_time",
            path_date_key(p).isNull().alias("is_stray"),
        )

    def lines(self, spark: SparkSession, start=None, *, include_strays: bool = False) -> DataFrame:
        """Text of the in-scope files: ``path, value``, one row per line (one per file for a
        ``multiline`` area); used by the JSON contract checks."""
        roots = self.roots(spark, start, include_strays) if self.exists(spark) else []
        if not roots:
            return spark.createDataFrame([], "path string, value string")
        text = (
            spark.read.option("pathGlobFilter", glob_for(self.fmt))
            .option("recursiveFileLookup", "true")
            .text(roots, wholetext=self.multiline)
        )
        path = F.col("_metadata.file_path")
        return text.where(self._in_scope(path, start, include_strays)).select(path.alias("path"), "value")

    def read(self, spark: SparkSession, schema: StructType | str | None = None, start=None) -> DataFrame:
        """The in-scope files' rows (read with ``schema`` when given) plus ``year, month, day``
        from the path; the date predicate prunes files through ``_metadata.file_path``."""
        if self.fmt.lower() == "avro" and not _has_avro(spark):
            raise NotImplementedError("reading avro rows needs the spark-avro data source on the class path; contracts don't")
        reader = spark.read.format(self.fmt).option("recursiveFileLookup", "true").option(
            "pathGlobFilter", glob_for(self.fmt)
        )
        reader = reader.options(**self.reader_options())
        if schema is not None:
            reader = reader.schema(schema)
        roots = self.roots(spark, start) if self.exists(spark) else []
        if not roots:
            if schema is None:
                raise FileNotFoundError(f"no {self.fmt} files in scope below {self.object_dir}")
            empty = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
            return spark.createDataFrame([], empty).select(
                "*", *[F.lit(None).cast("int").alias(c) for c in ("year", "month", "day")]
            )
        df = reader.load(roots)
        path = F.col("_metadata.file_path")
        return df.where(self._in_scope(path, start, False)).select(
            *df.columns,
            path_year(path).alias("year"),
            path_month(path).alias("month"),
            path_day(path).alias("day"),
        )

    def quarantine_path(self, path: Column) -> Column:
        return quarantine_path(path, self.object_name)


def detect_files(spark: SparkSession, root: str, obj_name: str, fmt: str, start_year, start_month, start_day) -> DataFrame:
    """Files of ``obj_name`` on or after the start date, as a DataFrame of paths (full-date
    comparison for every format)."""
    area = LandingArea(root, obj_name, fmt)
    return area.files(spark, (start_year, start_month, start_day)).select("path")
