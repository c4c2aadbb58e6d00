"""Schema contracts over landing files, quarantine moves and the movement log.

* Self-describing formats (parquet, orc): each task reads only the footers of its files with
  pyarrow (``mapInArrow`` over the file listing, one output row per file) and compares the schema
  Spark would see with the contract. ``deep=True`` also decodes every row group.
* JSON: no Python at all. One text scan of the in-scope files; per line ``try_parse_json``; per file
  one aggregation counting malformed lines, values that the loader would turn into NULL and lines
  missing a NOT NULL field, plus the set of keys the contract does not know. Field order is not
  part of a JSON contract.
* CSV: the header record against the contract's names, and one Spark CSV scan with the contract schema
  in PERMISSIVE mode counting, per file, the rows whose values do not fit it; both use the reader options
  of the landing area, as the load does.
* avro: each task reads the headers of its files (:mod:`~sluice.sources.avro_header`). Loading avro rows
  needs Spark's own avro source.
* Quarantine: the new path is computed as a Column; the move itself runs in executor tasks and is
  idempotent (source gone + target present = done), so a retried task is harmless.
"""

from __future__ import annotations

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from .._util import quote, temp_name
from ..session import cut_lineage
from ..sources.landing import LandingArea
from .compare import schema_breaches

# The task functions below are shipped by value, so executors need no installed copy of sluice.
cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])

BREACH_SCHEMA = "path string, reason string"
#: files whose footers or headers one task reads
FILES_PER_TASK = 256
MOVE_SCHEMA = "old_file_path string, new_file_path string, corrupted_message string, move_status string"

# The log's five columns, read by whoever watches the landing area.
LOG_SCHEMA = StructType(
    [
        StructField("old_file_path", StringType(), True),
        StructField("new_file_path", StringType(), True),
        StructField("corrupted_message", StringType(), True),
        StructField("inserted_at", TimestampType(), True),
        StructField("move_status", StringType(), True),
    ]
)


def _arrow_fs(path: str):
    """pyarrow filesystem + in-filesystem path for a Hadoop-style URI."""
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        local = "/" + path[len("file:"):].lstrip("/")
        return pafs.LocalFileSystem(), local
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    if path.startswith(("s3a://", "s3n://")):
        path = "s3://" + path.split("://", 1)[1]
    return pafs.FileSystem.from_uri(path)


def _footer_schema(path: str, fmt: str, deep: bool) -> StructType:
    """The schema Spark reads from one file (its stored Spark schema when present)."""
    from pyspark.sql.pandas.types import from_arrow_schema

    fs, local = _arrow_fs(path)
    if fmt == "parquet":
        import pyarrow.parquet as pq

        with fs.open_input_file(local) as fh:
            pf = pq.ParquetFile(fh)
            if deep:
                for _ in pf.iter_batches(batch_size=65536):
                    pass
            arrow_schema = pf.schema_arrow
            meta = pf.metadata.metadata or {}
        stored = meta.get(b"org.apache.spark.sql.parquet.row.metadata")
        if stored:
            return StructType.fromJson(json.loads(stored))
        return from_arrow_schema(arrow_schema, prefer_timestamp_ntz=True)
    if fmt == "orc":
        import pyarrow.orc as orc

        with fs.open_input_file(local) as fh:
            of = orc.ORCFile(fh)
            if deep:
                for i in range(of.nstripes):
                    of.read_stripe(i)
            return from_arrow_schema(of.schema, prefer_timestamp_ntz=True)
    if fmt == "avro":
        from ..sources.avro_header import avro_schema

        with fs.open_input_stream(local) as fh:
            return avro_schema(fh)
    raise ValueError(f"no footer reader for {fmt}")


def _null_counts(path: str, fmt: str, names: list[str]) -> dict[str, int]:
    """NULLs of top-level columns of one file. Parquet: from the statistics of its row groups, and only
    where a row group has none from the column itself; orc: from the columns."""
    fs, local = _arrow_fs(path)
    counts = dict.fromkeys(names, 0)
    with fs.open_input_file(local) as fh:
        if fmt == "parquet":
            import pyarrow.parquet as pq

            pf = pq.ParquetFile(fh)
            at = {pf.metadata.schema.column(j).path: j for j in range(pf.metadata.num_columns)}
            there = set(pf.schema_arrow.names)
            for name in [n for n in names if n in there]:
                for i in range(pf.metadata.num_row_groups):
                    found = pf.metadata.row_group(i).column(at[name]).statistics if name in at else None
                    if found is not None and found.has_null_count:
                        counts[name] += found.null_count
                    else:
                        counts[name] += pf.read_row_group(i, columns=[name]).column(name).null_count
        else:
            import pyarrow.orc as orc

            of = orc.ORCFile(fh)
            for name in [n for n in names if n in of.schema.names]:
                for i in range(of.nstripes):
                    counts[name] += of.read_stripe(i, columns=[name]).column(0).null_count
    return counts


def _csv_header(path: str, options: dict) -> list[str]:
    """The first record of a CSV file, read with the options the loader reads it with."""
    import csv
    import io

    fs, local = _arrow_fs(path)
    encoding = options.get("encoding", "utf-8")
    with fs.open_input_stream(local) as fh:
        text = io.TextIOWrapper(fh, encoding="utf-8-sig" if encoding.lower() in ("utf-8", "utf8") else encoding, newline="")
        found = csv.reader(text, delimiter=options.get("sep", ","), quotechar=options.get("quote", '"'))
        return [h.strip() for h in next(found, [])]


def _format_errors() -> tuple:
    """Errors that say the file is not what it should be; any other error fails the task."""
    import csv

    import pyarrow as pa

    from ..sources.avro_header import AvroHeaderError

    return (pa.ArrowInvalid, pa.ArrowNotImplementedError, UnicodeDecodeError, csv.Error, AvroHeaderError)


def _file_checker(fmt: str, contract_json: str, ignore_nullable: bool, check_order: bool, deep: bool, options: dict, check_nulls: bool, widen: bool):
    def run(batches):
        import pyarrow as pa

        contract = StructType.fromJson(json.loads(contract_json))
        names = [f.name for f in contract.fields]
        required = [f.name for f in contract.fields if not f.nullable] if check_nulls else []
        for batch in batches:
            paths = batch.column(0).to_pylist()
            reasons = []
            for p in paths:
                try:
                    if fmt == "csv":
                        header = _csv_header(p, options)
                        if header == names or (not check_order and sorted(header) == sorted(names)):
                            reasons.append(None)
                        else:
                            reasons.append(f"header {header} does not match contract columns {names}")
                        continue
                    found = schema_breaches(
                        _footer_schema(p, fmt, deep), contract, ignore_nullable=ignore_nullable, check_order=check_order, widen=widen
                    )
                    said = [str(b) for b in found]
                    if required:
                        said += [f"column {c}: {n} NULL values" for c, n in _null_counts(p, fmt, required).items() if n]
                    reasons.append("; ".join(said) or None)
                except _format_errors() as e:
                    reasons.append(f"cannot read file: {type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(reasons, pa.string())], names=["path", "reason"]
            )

    return run


def file_schema_breaches(
    files: DataFrame,
    fmt: str,
    contract: StructType,
    *,
    ignore_nullable: bool = True,
    check_order: bool = True,
    deep: bool = False,
    options: dict | None = None,
    check_nulls: bool = False,
    widen: bool = False,
) -> DataFrame:
    """``path, reason`` for each listed file of a self-describing format (or CSV) that breaks the
    contract. Runs as one ``mapInArrow`` over the listing's partitions: no driver loop, no per-file
    job, only footers (or the first CSV record) are read. A file that cannot be decoded is a breach;
    a file that cannot be fetched fails the task, so that a short outage quarantines nothing.
    ``check_nulls`` holds NOT NULL columns against the data (:func:`_null_counts`), whatever the footer
    declares; ``widen`` lets a file have a narrower type than the contract (see
    :func:`~sluice.operators.compare.fits`)."""
    checker = _file_checker(fmt, contract.json(), ignore_nullable, check_order, deep, dict(options or {}), check_nulls, widen)
    return files.select("path").mapInArrow(checker, BREACH_SCHEMA).where(F.col("reason").isNotNull())


def json_breaches(lines: DataFrame, contract: StructType, *, multiline: bool = False, ignore_nullable: bool = True) -> DataFrame:
    """``path, reason`` for JSON files breaking the contract (see module doc).

    Records are JSON lines, or with ``multiline`` the documents of whole files (an array document
    contributes one record per element). Each record is parsed once into a variant, from which its keys
    and the presence of every contract field come, and once with the contract schema by the loader's own
    rule (``from_json``): a present value that the loader would turn into NULL does not fit. NOT NULL
    fields are enforced only with ``ignore_nullable=False``, as in the other formats. One scan feeds one
    ``(path, unexpected key)`` aggregation that also carries the per-record counts (each record is
    counted once, in the group of its first unexpected key); it is checkpointed, and the per-file
    totals and the first unexpected keys are both read from it.
    """
    v = temp_name(lines, "v")
    nonblank = F.trim(F.col("value")) != ""
    doc = F.try_parse_json("value")
    if multiline:
        record = F.explode(F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.array(doc)))
    else:
        record = doc
    parsed = lines.select("path", "value", record.alias(v), nonblank.alias("nb"))
    loaded = temp_name(parsed, "loaded")
    nullable = StructType([StructField(f.name, f.dataType, True) for f in contract.fields])
    parsed = parsed.withColumn(loaded, F.from_json(F.to_json(v) if multiline else F.col("value"), nullable))
    keys = F.map_keys(F.try_variant_get(F.col(v), "$", "map<string,variant>"))
    unit = "records" if multiline else "lines"
    known = F.array(*[F.lit(f.name) for f in contract.fields])
    metrics = {
        "n_lines": F.col("nb"),
        "n_malformed": F.col("nb") & keys.isNull(),  # unparsable, or not a JSON object
    }
    parts = []
    for i, f in enumerate(contract.fields):
        jpath = "$['" + f.name.replace("\\", "\\\\").replace("'", "\\'") + "']"
        raw = F.try_variant_get(F.col(v), jpath, "variant")
        present = raw.isNotNull() & ~F.is_variant_null(raw)
        metrics[f"bad{i}"] = present & F.col(loaded).getField(f.name).isNull()
        parts.append(
            F.when(
                F.col(f"bad{i}") > 0,
                F.format_string(f"column {f.name}: %d values do not fit {f.dataType.simpleString()}", F.col(f"bad{i}")),
            )
        )
        if not f.nullable and not ignore_nullable:
            metrics[f"abs{i}"] = keys.isNotNull() & ~present
            parts.append(
                F.when(F.col(f"abs{i}") > 0, F.format_string(f"column {f.name}: NULL or absent on %d {unit}", F.col(f"abs{i}")))
            )
    extra_keys = F.array_except(keys, known)
    per_line = parsed.select(
        "path", *[c.alias(name) for name, c in metrics.items()], F.posexplode_outer(extra_keys).alias("pos", "key")
    )
    first_row_of_line = F.col("pos").isNull() | (F.col("pos") == 0)
    # one row per file and unexpected key; the record counts ride on each record's first one
    per_key = per_line.groupBy("path", "key").agg(*[F.count_if(first_row_of_line & F.col(name)).alias(name) for name in metrics])
    per_file = per_key.groupBy("path").agg(
        *[F.sum(name).alias(name) for name in metrics], F.array_sort(F.collect_list("key")).alias("extra")
    )
    reason = F.concat_ws(
        "; ",
        F.when(F.col("n_malformed") > 0, F.format_string(f"%d malformed {unit}", F.col("n_malformed"))),
        *parts,
        F.when(F.size("extra") > 0, F.concat(F.lit("unexpected columns: "), F.array_join("extra", ", "))),
    )
    return per_file.select("path", F.when(reason != "", reason).alias("reason")).where(F.col("reason").isNotNull())


def csv_value_breaches(spark: SparkSession, area: LandingArea, contract: StructType, start=None, *, check_nulls: bool = False) -> DataFrame:
    """``path, reason`` for CSV files with rows that do not fit the contract's types or width, and with
    ``check_nulls`` NULLs in NOT NULL columns."""
    roots = area.roots(spark, start) if area.exists(spark) else []
    if not roots:
        return spark.createDataFrame([], BREACH_SCHEMA)
    corrupt = temp_name([f.name for f in contract.fields], "corrupt")
    required = [f.name for f in contract.fields if not f.nullable] if check_nulls else []
    schema = StructType([StructField(f.name, f.dataType, True) for f in contract.fields] + [StructField(corrupt, StringType(), True)])
    rows = (
        spark.read.schema(schema)
        .options(**area.reader_options())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .csv(roots)
    )
    path = F.col("_metadata.file_path")
    per_file = (
        rows.where(area._in_scope(path, start, False))
        .groupBy(path.alias("path"))
        .agg(
            # The CSV parser converts only the columns a query reads (and refuses to read only the
            # corrupt-record column), so every contract column is referenced through an always-true
            # test the optimizer cannot fold: all values are then converted and checked.
            F.count_if(
                F.col(corrupt).isNotNull()
                & (
                    F.coalesce(F.length(F.concat_ws(",", *[F.col(f"`{f.name}`").cast("string") for f in contract.fields])), F.lit(0))
                    >= 0
                )
            ).alias("n_bad"),
            F.count("*").alias("n_rows"),
            *[F.count_if(F.col(corrupt).isNull() & F.col(quote(c)).isNull()).alias(f"n_null{i}") for i, c in enumerate(required)],
        )
    )
    said = [F.when(F.col("n_bad") > 0, F.format_string("%d of %d rows do not fit the contract", F.col("n_bad"), F.col("n_rows")))]
    said += [F.when(F.col(f"n_null{i}") > 0, F.format_string(f"column {c}: %d NULL values", F.col(f"n_null{i}"))) for i, c in enumerate(required)]
    return per_file.select("path", F.concat_ws("; ", *said).alias("reason")).where("reason <> ''")


def _combine(breaches: DataFrame) -> DataFrame:
    """One row per file with its reasons joined (at most one reason per check kind per file)."""
    return breaches.groupBy("path").agg(F.concat_ws("; ", F.array_sort(F.collect_list("reason"))).alias("reason"))


def json_unexpected_keys(lines: DataFrame, contract: StructType, *, multiline: bool = False) -> DataFrame:
    """Every key the contract does not know, per file: ``path, key, records`` (the full detail
    behind the count and the first keys named in :func:`json_breaches`' reasons)."""
    doc = F.try_parse_json("value")
    if multiline:
        doc = F.explode(F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.array(doc)))
    v = temp_name(lines, "v")
    keys = F.map_keys(F.try_variant_get(F.col(v), "$", "map<string,variant>"))
    known = F.array(*[F.lit(f.name) for f in contract.fields])
    return (
        lines.select("path", doc.alias(v))
        .select("path", F.explode(F.array_except(keys, known)).alias("key"))
        .groupBy("path", "key")
        .agg(F.count("*").alias("records"))
    )


def contract_breaches(
    spark: SparkSession,
    area: LandingArea,
    contract: StructType,
    start=None,
    *,
    ignore_nullable: bool = True,
    deep: bool = False,
    check_nulls: bool = False,
    widen: bool = False,
) -> DataFrame:
    """Breaching files of a landing area from ``start`` on: ``path, reason``. Files are dealt to tasks by
    their number, since a check reads a footer or a header whatever the size of the file. With
    ``check_nulls`` a NULL in a NOT NULL column is a breach, from file statistics where there are any;
    ``widen`` allows narrower types than the contract's in parquet and orc files."""
    fmt = area.fmt.lower()
    if fmt == "json":
        return json_breaches(area.lines(spark, start), contract, multiline=area.multiline, ignore_nullable=ignore_nullable and not check_nulls)
    if fmt == "avro" and (deep or check_nulls):
        raise NotImplementedError("avro contracts are checked by the files' headers; their records are not read")
    if fmt in ("parquet", "orc", "csv", "avro"):
        files = cut_lineage(area.files(spark, start).select("path"))
        files = files.repartition(max(1, -(-files.count() // FILES_PER_TASK)))
        found = file_schema_breaches(
            files, fmt, contract, ignore_nullable=ignore_nullable, deep=deep, options=area.reader_options(), check_nulls=check_nulls, widen=widen
        )
        if fmt == "csv":
            found = _combine(found.unionByName(csv_value_breaches(spark, area, contract, start, check_nulls=check_nulls)))
        return found
    raise ValueError(f"unsupported landing format {area.fmt!r}")


def _mover(again: bool = False):
    """Moves the files of (old, new, message) rows. ``again``: the rows may have been moved before, so a
    file that is at both places was moved and then landed anew; that one is the next run's matter."""

    def run(batches):
        yield from _move_rows(batches, again)

    return run


def _move_rows(batches, again):
    import pyarrow as pa
    import pyarrow.fs as pafs

    for batch in batches:
        olds, news, msgs = (batch.column(i).to_pylist() for i in range(3))
        status = []
        for old, new in zip(olds, news):
            fs = src = dst = None
            try:
                fs, src = _arrow_fs(old)
                _, dst = _arrow_fs(new)
                src_there = fs.get_file_info(src).type != pafs.FileType.NotFound
                dst_there = fs.get_file_info(dst).type != pafs.FileType.NotFound
                if dst_there and (again or not src_there):
                    status.append("OK")  # moved by an earlier attempt of this task
                    continue
                fs.create_dir(dst.rsplit("/", 1)[0], recursive=True)
                fs.move(src, dst)
                status.append("OK")
            except Exception as e:
                # a concurrent attempt of this task may have moved the file meanwhile
                try:
                    done = fs is not None and dst is not None and (
                        fs.get_file_info(src).type == pafs.FileType.NotFound
                        and fs.get_file_info(dst).type != pafs.FileType.NotFound
                    )
                except Exception:
                    done = False
                status.append("OK" if done else f"{type(e).__name__}: {e}")
        yield pa.RecordBatch.from_arrays(
            [pa.array(olds, pa.string()), pa.array(news, pa.string()), pa.array(msgs, pa.string()), pa.array(status, pa.string())],
            names=["old_file_path", "new_file_path", "corrupted_message", "move_status"],
        )


def quarantine_files(area: LandingArea, breaches: DataFrame) -> DataFrame:
    """Move each breaching file below ``object=<name>_corrupted/`` (same relative path).

    Lazy: the moves happen when the result is computed, so compute it exactly once (write it, as
    :func:`write_move_log` does). Returns the movement log rows with ``inserted_at``.
    """
    return moved(planned_moves(area, breaches))


def planned_moves(area: LandingArea, breaches: DataFrame) -> DataFrame:
    """Log rows to be, without an outcome: where each breaching file goes."""
    return breaches.select(
        F.col("path").alias("old_file_path"),
        area.quarantine_path(F.col("path")).alias("new_file_path"),
        F.col("reason").alias("corrupted_message"),
        F.lit(None).cast("string").alias("move_status"),
    )


def moved(planned: DataFrame, again: bool = False) -> DataFrame:
    """Log rows of the ``planned`` ones: those without a move_status are moved when this is computed."""
    todo = planned.where("move_status IS NULL").select("old_file_path", "new_file_path", "corrupted_message")
    rows = todo.mapInArrow(_mover(again), MOVE_SCHEMA).unionByName(planned.where("move_status IS NOT NULL"))
    return rows.select("old_file_path", "new_file_path", "corrupted_message", F.current_timestamp().alias("inserted_at"), "move_status")


def planned_strays(spark: SparkSession, area: LandingArea) -> DataFrame:
    """Log rows of files outside ``year=/month=/day=``: they belong to no day, so they are neither
    checked, moved nor loaded, but they are named (move status ``STRAY``)."""
    strays = area.files(spark, include_strays=True).where("is_stray")
    return strays.select(
        F.col("path").alias("old_file_path"), F.lit(None).cast("string").alias("new_file_path"),
        F.lit("outside year=/month=/day=, not loaded").alias("corrupted_message"), F.lit("STRAY").alias("move_status"),
    )


def write_move_log(log: DataFrame, log_path: str | None, run_id: str, *, table: str | None = None) -> DataFrame:
    """Append the log to a path or a catalog table (this single write triggers the moves) and read
    this run's rows back; a run without rows gives an empty frame."""
    spark = log.sparkSession
    tagged = log.withColumn("run_id", F.lit(run_id))
    if table is not None:
        tagged.write.mode("append").saveAsTable(table)
        return spark.table(table).where(F.col("run_id") == run_id).drop("run_id")
    own = f"{log_path.rstrip('/')}/run_id={run_id}"
    log.write.mode("overwrite").parquet(own)  # the folder is this run's: a repeated write replaces it
    return spark.read.schema(LOG_SCHEMA).parquet(own)
