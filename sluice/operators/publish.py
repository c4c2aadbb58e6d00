"""Replacing the content of a path or table that the new content may be computed from.

Spark cannot overwrite a location it is reading, so new content is always written once to a fresh
location, and the target is switched to it when it is complete. One writer per target is assumed;
whether the frame reads its target does not need to be known.

**Catalog tables** are switched by pointer: nothing is renamed or deleted. The new content goes to a
version folder beside the table's folder (``<folder>.v-<token>``) through a staging table created
``LIKE`` the table, so format, partitioning, bucketing and options stay. Then

* an unpartitioned table is pointed there by ``SET LOCATION``, one catalog change;
* a partitioned table's partitions are pointed there by one catalog call for all of them. Partitions that
  are new are registered before, and those that are gone dropped after it, both pointing to an empty
  folder, so that the call alone changes what the table holds. The same call switches some partitions only
  (:func:`replace_partitions`), which a merge into a bucketed table uses.

A stop at any step leaves the old or the new content whole. A version folder that was replaced stays for
readers that have begun; the next switch deletes it. The folder a managed table was made in goes at once,
since a table of that name could not be made again after a drop; an external table's is left to its owner.

**Paths** have no pointer: their readers look into the folder itself. The parts to be switched (the whole
target, or single partition folders) are named in a journal file beside the target, moved aside and
replaced by renames of the driver (metadata only on HDFS and local file systems, copies on object stores),
and the journal is deleted: that is the commit. :func:`recover` reads it and undoes a switch that stopped.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from .._util import as_list, quote


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none where it does not exist."""
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.java.lang.String(stream.readAllBytes(), "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete under its name or not there at all."""
    fs, p = _fs(spark, path)
    half = _path(spark, f"{path}.half")
    stream = fs.create(half, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(half, p):
        raise OSError(f"could not write {path}")


# ---------------------------------------------------------------- paths


def _beside(path: str) -> tuple[str, str]:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return parent, name


def _journal(path: str) -> str:
    parent, name = _beside(path)
    return f"{parent}/_{name}.switch"


def recover(spark: SparkSession, path: str) -> None:
    """Undo a switch of ``path`` that stopped before its commit: every part it had moved aside is moved
    back, so that whoever repeats the write starts from what was there before. Then what stopped writes
    have left beside the target is deleted."""
    parent, name = _beside(path)
    left = [c for c in children(spark, parent) if c.startswith((f"_{name}.next-", f"_{name}.prev-", f"_{name}.switch"))]
    if not left:
        return
    fs, base = _fs(spark, path.rstrip("/"))
    noted = read_text(spark, _journal(path))
    if noted:
        token, parts = (json.loads(noted)[k] for k in ("token", "parts"))
        for part in parts:
            old, now = _path(spark, f"{parent}/_{name}.prev-{token}{part}"), _path(spark, path.rstrip("/") + part)
            if fs.exists(old):
                if fs.exists(now):
                    fs.delete(now, True)
                if not fs.rename(old, now):
                    raise OSError(f"could not move {old.toString()} back")
            elif fs.exists(now) and not fs.exists(_path(spark, f"{parent}/_{name}.next-{token}{part}")) and not json.loads(noted)["had"][part]:
                fs.delete(now, True)  # there was nothing before
        fs.delete(_path(spark, _journal(path)), False)
    elif not fs.exists(base):  # moved aside by hand or by a version without journal: never taken for an empty target
        aside = [c for c in left if c.startswith(f"_{name}.prev-")]
        if len(aside) > 1:
            raise OSError(f"{path} is not there, and several contents lie beside it: {aside}")
        if aside and not fs.rename(_path(spark, f"{parent}/{aside[0]}"), base):
            raise OSError(f"could not move {aside[0]} back")
    for c in left:
        leftover = _path(spark, f"{parent}/{c}")
        if fs.exists(leftover):
            fs.delete(leftover, True)


def _switch(spark: SparkSession, path: str, token: str, parts: list[str]) -> None:
    """Put ``parts`` (``""`` for the whole, else ``/<folder>``) of the fresh content in place."""
    parent, name = _beside(path)
    base = path.rstrip("/")
    fs, target = _fs(spark, base)
    fresh, old = f"{parent}/_{name}.next-{token}", f"{parent}/_{name}.prev-{token}"
    had = {part: bool(fs.exists(_path(spark, base + part))) for part in parts}
    if parts != [""]:
        fs.mkdirs(_path(spark, old))
        fs.mkdirs(target)
    write_text(spark, _journal(path), json.dumps({"token": token, "parts": parts, "had": had}))
    for part in parts:
        now = _path(spark, base + part)
        if had[part] and not fs.rename(now, _path(spark, old + part)):
            raise OSError(f"could not move {now.toString()} aside")
        new = _path(spark, fresh + part)
        if fs.exists(new) and not fs.rename(new, now):
            raise OSError(f"could not move the new content into {now.toString()}")
    fs.delete(_path(spark, _journal(path)), False)  # the commit
    for leftover in (old, fresh):
        if fs.exists(_path(spark, leftover)):
            fs.delete(_path(spark, leftover), True)


def write_path(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, files: dict[str, str] | None = None) -> None:
    """Write ``df`` as the new content of ``path`` (which ``df`` may read), laid out by the
    ``partition_by`` columns if given; ``files`` are small hidden text files that belong to the content."""
    spark = df.sparkSession
    token = uuid.uuid4().hex[:12]
    base = path.rstrip("/")
    recover(spark, base)
    parent, name = _beside(base)
    # leading underscore: hidden from Spark readers of the parent folder while it exists
    fresh = f"{parent}/_{name}.next-{token}"
    writer = df.write.format(fmt).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*as_list(partition_by))
    writer.save(fresh)
    for file, text in (files or {}).items():
        write_text(spark, f"{fresh}/{file}", text)
    _switch(spark, base, token, [""])


def replace_path(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> DataFrame:
    """:func:`write_path`, and a frame reading the new content."""
    write_path(df, path, fmt, partition_by)
    return df.sparkSession.read.format(fmt).load(path.rstrip("/"))


def replace_path_parts(df: DataFrame, path: str, column: str, values: list, fmt: str = "parquet") -> None:
    """Replace the partition folders ``column=value`` of ``path`` by the rows of ``df`` (which may read
    them); other folders are not touched. A row with another value is an error, and nothing changes."""
    spark = df.sparkSession
    token = uuid.uuid4().hex[:12]
    base = path.rstrip("/")
    recover(spark, base)
    parent, name = _beside(base)
    fresh = f"{parent}/_{name}.next-{token}"
    df.write.format(fmt).mode("errorifexists").partitionBy(column).save(fresh)
    parts = [f"{column}={v}" for v in values]
    strange = [c for c in children(spark, fresh) if not c.startswith(("_", ".")) and c not in parts]
    if strange:
        raise ValueError(f"rows outside the parts to be replaced: {strange[:3]}")
    if parts:
        _switch(spark, base, token, [f"/{p}" for p in parts])


def has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and holds any entry Spark would read (not ``_``/``.`` hidden). A
    switch of the target that stopped half way is undone first: a target is never taken for new
    because its content was just being replaced."""
    recover(spark, path)
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    if not fs.getFileStatus(p).isDirectory():
        return True
    return any(not c.startswith(("_", ".")) for c in children(spark, path))


# ---------------------------------------------------------------- catalog tables

_VERSION = re.compile(r"\.v-[0-9a-f]{12}$")


def table_detail(spark: SparkSession, name: str) -> dict:
    """location, provider, type (MANAGED or EXTERNAL) and partition columns of a catalog table."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    info = dict(rows[next(i for i, r in enumerate(rows) if r[0] == "# Detailed Table Information") :])
    columns = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return {"location": info["Location"].rstrip("/"), "provider": info.get("Provider", "parquet"), "type": info["Type"], "partitions": columns}


def _catalog(spark: SparkSession, name: str):
    state = spark._jsparkSession.sessionState()
    return state.catalog(), state.sqlParser().parseTableIdentifier(name)


def _partitions(spark: SparkSession, name: str) -> dict[tuple, object]:
    """The catalog's partitions of a table by their values."""
    catalog, ident = _catalog(spark, name)
    jvm = spark.sparkContext._jvm
    found = catalog.listPartitions(ident, jvm.scala.Option.empty())
    out = {}
    for k in range(found.size()):
        spec = found.apply(k).spec()
        pairs = spec.toSeq()
        out[tuple(sorted((pairs.apply(i)._1(), pairs.apply(i)._2()) for i in range(pairs.size())))] = found.apply(k)
    return out


def _spec_sql(key: tuple) -> str:
    return "PARTITION (" + ", ".join(f"{quote(c)} = '" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for c, v in key) + ")"


def _point(spark: SparkSession, name: str, places: dict[tuple, str]) -> None:
    """One catalog call that points the given partitions of a table to other folders."""
    jvm = spark.sparkContext._jvm
    catalog, ident = _catalog(spark, name)
    parts = jvm.java.util.ArrayList()
    for key, part in _partitions(spark, name).items():
        if key in places:
            s = part.storage()
            where = jvm.scala.Option.apply(_path(spark, places[key]).toUri())
            storage = s.copy(where, *[getattr(s, f)() for f in _fields(s)[1:]])
            # without the statistics of the old content
            parts.add(part.copy(part.spec(), storage, part.parameters(), part.createTime(), part.lastAccessTime(), jvm.scala.Option.empty()))
    catalog.alterPartitions(ident, jvm.scala.jdk.javaapi.CollectionConverters.asScala(parts).toSeq())


def _fields(product) -> list[str]:
    names = product.productElementNames()
    out = []
    while names.hasNext():
        out.append(names.next())
    return out


def _staged(df: DataFrame, name: str, detail: dict) -> tuple[str, str]:
    """Write ``df`` to a new version folder; (staging table, folder)."""
    spark = df.sparkSession
    _forget_stopped(spark, name)
    token = uuid.uuid4().hex[:12]
    folder = f"{_VERSION.sub('', detail['location'])}.v-{token}"
    staging = f"{name}__next_{token}"
    spark.sql(f"CREATE TABLE {staging} LIKE {name} LOCATION '{folder}'")
    df.select(*[quote(c) for c in spark.table(name).columns]).write.insertInto(staging)
    return staging, folder


def _forget_stopped(spark: SparkSession, name: str) -> None:
    """Staging tables of writes that stopped: the table was not switched to them, or it was and they are not needed."""
    db, _, bare = name.rpartition(".")
    for r in spark.sql(f"SHOW TABLES {'IN ' + db if db else ''} LIKE '{bare.strip('`')}__next_*'").collect():
        spark.sql(f"DROP TABLE IF EXISTS {db + '.' if db else ''}{quote(r['tableName'])}")  # external: its folder stays


def _purge(spark: SparkSession, name: str, detail: dict, folder: str, replaced: list[str]) -> None:
    """Delete the table's folders in which no partition lies, other than the present one and version
    folders of the content that has just been ``replaced``."""
    parent, base = _beside(_VERSION.sub("", folder))
    marker = f"/{parent.rsplit('/', 1)[1]}/{base}"  # places may be written with another scheme or number of slashes

    def folders(places: list[str]) -> set[str]:
        return {base + p[p.index(marker) + len(marker) :].split("/")[0] for p in places if marker in p}

    live = [p.location().toString() for p in _partitions(spark, name).values()] if detail["partitions"] else []
    keep = folders([folder, *live]) | {c for c in folders([detail["location"], *replaced]) if _VERSION.search(c)}
    fs, _ = _fs(spark, parent)
    for c in children(spark, parent):
        if c not in keep and _VERSION.sub("", c) == base and (_VERSION.search(c) or detail["type"] == "MANAGED"):
            fs.delete(_path(spark, f"{parent}/{c}"), True)


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as the new content of catalog table ``name`` (which ``df`` may read). With the table's
    columns, in any order, the table stays what it is (format, partitioning, bucketing, properties, managed or external) and
    is switched by pointer. Other columns make another table; a partitioned or external one is refused then."""
    spark = df.sparkSession
    recover_table(spark, name)
    if not spark.catalog.tableExists(name):
        df.write.mode("errorifexists").saveAsTable(name)
        return spark.table(name)
    detail = table_detail(spark, name)
    if sorted(c.lower() for c in spark.table(name).columns) != sorted(c.lower() for c in df.columns):
        if detail["partitions"] or detail["type"] != "MANAGED":
            raise ValueError(f"{name} is partitioned or external and has other columns; drop it first")
        return _new_table(df, name)
    staging, folder = _staged(df, name, detail)
    replaced = []
    if detail["partitions"]:
        made = {k: p.location().toString() for k, p in _partitions(spark, staging).items()}
        old = _partitions(spark, name)
        replaced = [p.location().toString() for p in old.values()]
        _switch_partitions(spark, name, made, [*old], folder)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.sql(f"DROP TABLE {staging}")
    spark.catalog.refreshTable(name)
    _purge(spark, name, detail, folder, replaced)
    return spark.table(name)


def _switch_partitions(spark: SparkSession, name: str, made: dict[tuple, str], replaced: list[tuple], folder: str) -> None:
    """Point ``made`` partitions to their new folders and empty the other ``replaced`` ones, at once."""
    empty = f"{folder}/_empty"
    fs, _ = _fs(spark, folder)
    fs.mkdirs(_path(spark, empty))
    there = _partitions(spark, name)
    added = [k for k in made if k not in there]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"{_spec_sql(k)} LOCATION '{empty}'" for k in added))
    gone = [k for k in replaced if k not in made]
    _point(spark, name, {**dict.fromkeys(gone, empty), **made})
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(_spec_sql(k) for k in gone))


def replace_partitions(df: DataFrame, name: str, replaced: list[dict]) -> None:
    """Replace the given partitions (column to value) of a catalog table by the rows of ``df`` (which may
    read them) by one catalog call; the others are not touched. A row of another partition is an error,
    and nothing changes."""
    spark = df.sparkSession
    detail = table_detail(spark, name)
    keys = [tuple(sorted((c, str(v)) for c, v in r.items())) for r in replaced]
    staging, folder = _staged(df, name, detail)
    made = {k: p.location().toString() for k, p in _partitions(spark, staging).items()}
    strange = [k for k in made if k not in keys]
    old = {k: p.location().toString() for k, p in _partitions(spark, name).items() if k in keys}
    if not strange:
        _switch_partitions(spark, name, made, [*old], folder)
    spark.sql(f"DROP TABLE {staging}")
    spark.catalog.refreshTable(name)
    if not strange:
        _purge(spark, name, detail, folder, [*old.values()])
    else:
        raise ValueError(f"rows outside the partitions to be replaced: {strange[:3]}")


def _new_table(df: DataFrame, name: str) -> DataFrame:
    """An unpartitioned managed table of other columns: the new table is complete before the old one is
    renamed, and the old one is dropped last."""
    spark = df.sparkSession
    token = uuid.uuid4().hex[:12]
    df.write.mode("errorifexists").saveAsTable(f"{name}__new_{token}")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old_{token}")
    recover_table(spark, name)
    return spark.table(name)


def recover_table(spark: SparkSession, name: str) -> None:
    """Finish a change of columns that stopped: with the old table renamed, the new one is complete and
    takes its place; before that, it is dropped."""
    db, _, bare = name.rpartition(".")
    dot = db + "." if db else ""
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES {'IN ' + db if db else ''} LIKE '{bare.strip('`')}__*'").collect()]
    news = [t for t in found if re.search(r"__new_[0-9a-f]{12}$", t)]
    olds = [t for t in found if re.search(r"__old_[0-9a-f]{12}$", t)]
    for t in news:
        if t.replace("__new_", "__old_") in olds and not spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {dot}{quote(t)} RENAME TO {name}")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {dot}{quote(t)}")
    if spark.catalog.tableExists(name):
        for t in olds:
            spark.sql(f"DROP TABLE IF EXISTS {dot}{quote(t)}")
