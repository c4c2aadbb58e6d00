"""MERGE of a source frame into a target (table, path or frame) with ordered clauses.

Standard MERGE semantics: a target row matched by the condition takes the first ``whenMatched*``
clause whose condition is TRUE (NULL counts as FALSE); no applicable clause leaves it unchanged.
A source row with no matching target row is inserted by the first ``whenNotMatched*`` clause
whose condition is TRUE, else dropped. A target row matched by more than one source row is an
error when matched clauses exist.

How it runs (no full outer join, which Spark can neither broadcast nor split when skewed):

* changed target rows: ``target LEFT JOIN source ON cond`` then one ``CASE`` per column. Target is
  the streamed side, so a small source is broadcast (AQE, from measured size) and the target is
  never shuffled; when both are big, AQE splits a skewed target partition.
* inserted rows: ``source LEFT ANTI JOIN target``. With equality keys (``on=``) the target side is
  first reduced to its distinct keys (partial aggregation before the shuffle), so a hot key
  arrives as one row per map task.
* no side is broadcast by a hint: the planner and adaptive execution decide by bytes.
* a condition made of ``a.x = b.x`` terms alone is the same as ``on=``; a condition without any
  equality between the sides would compare all pairs and is refused.

Plain parquet has no in-place update, so publishing writes the result to a fresh place that is then
switched in (:mod:`.publish`): the whole target, or, where the target is laid out by buckets of its merge
keys (:mod:`.buckets`), only the buckets that hold a key of the source.
"""

from __future__ import annotations

import copy
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .._util import as_list, qcol, quote, resolve_names, temp_name
from .buckets import BUCKET, Buckets
from .publish import recover, recover_table, replace_partitions, replace_path, replace_path_parts, replace_table


@dataclass
class _Clause:
    kind: str  # update | update_all | delete | insert | insert_all
    condition: object = None
    assignments: dict = field(default_factory=dict)


class MergeConflictError(ValueError):
    """More than one source row matched the same target row."""


def _expr(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.expr(value)
    return F.lit(value)


def _frame_alias(df: DataFrame) -> str | None:
    """Alias given with ``df.alias(name)`` (classic sessions), else None."""
    try:
        plan = df._jdf.queryExecution().logical()
        if plan.nodeName() == "SubqueryAlias":
            return plan.alias()
    except Exception:
        pass
    return None


class MergeTarget:
    """Merge target. Create with :meth:`forName`, :meth:`forPath` or :meth:`forFrame`."""

    def __init__(
        self,
        df: DataFrame,
        name: str | None = None,
        path: str | None = None,
        fmt: str = "parquet",
        partition_by=None,
        layout: Buckets | None = None,
    ):
        self._df = df
        self.layout = layout
        self.name = name
        self.path = path
        self.format = fmt
        self.partition_by = partition_by
        self._alias = "target"

    @classmethod
    def forName(cls, spark: SparkSession, name: str) -> "MergeTarget":
        recover_table(spark, name)
        layout = Buckets.of_table(spark, name)
        df = spark.table(name)
        return cls(df.drop(BUCKET) if layout else df, name=name, layout=layout)

    @classmethod
    def forPath(cls, spark: SparkSession, path: str, fmt: str = "parquet", partition_by=None) -> "MergeTarget":
        """``partition_by``: the folder layout to keep when the merged content is written back; a layout
        by buckets is found by itself."""
        recover(spark, path)
        layout = Buckets.of_path(spark, path)
        if layout:
            return cls(layout.read(spark, path).drop(BUCKET), path=path, fmt=layout.fmt, layout=layout)
        return cls(spark.read.format(fmt).load(path), path=path, fmt=fmt, partition_by=partition_by)

    @classmethod
    def forFrame(cls, df: DataFrame) -> "MergeTarget":
        return cls(df)

    def alias(self, name: str) -> "MergeTarget":
        other = copy.copy(self)
        other._alias = name
        return other

    def toDF(self) -> DataFrame:
        return self._df

    def merge(
        self,
        source: DataFrame,
        condition=None,
        *,
        on=None,
        source_alias: str | None = None,
    ) -> "MergeBuilder":
        return MergeBuilder(self, source, condition, on, source_alias)


class MergeBuilder:
    def __init__(self, target: MergeTarget, source: DataFrame, condition, on, source_alias):
        if condition is None and not on:
            raise ValueError("merge needs a condition or equality keys (on=)")
        self._target = target
        self._source = source
        self._condition = condition
        self._on = as_list(on)
        self._source_alias = source_alias or _frame_alias(source) or "source"
        self._clauses: list[_Clause] = []
        names = None if self._on else self._equal_names()
        if names:
            self._on, self._condition = names, None

    def _equal_names(self) -> list[str] | None:
        """Column names of a text condition that is nothing but ``a.x = b.x`` terms joined by AND."""
        if not isinstance(self._condition, str):
            return None
        sides = {self._target._alias.lower(), self._source_alias.lower()}
        names = []
        for term in re.split(r"\s+and\s+", self._condition.strip(), flags=re.IGNORECASE):
            m = re.fullmatch(r"(\w+)\.(\w+)\s*=\s*(\w+)\.(\w+)", term.strip())
            if not m or {m[1].lower(), m[3].lower()} != sides or m[2].lower() != m[4].lower():
                return None
            names.append(m[2])
        return names

    # clause surface, in call order
    def whenMatchedUpdate(self, condition=None, set=None) -> "MergeBuilder":
        if not set:
            raise ValueError("whenMatchedUpdate needs set={column: expression}")
        self._clauses.append(_Clause("update", condition, dict(set)))
        return self

    def whenMatchedUpdateAll(self, condition=None) -> "MergeBuilder":
        self._clauses.append(_Clause("update_all", condition))
        return self

    def whenMatchedDelete(self, condition=None) -> "MergeBuilder":
        self._clauses.append(_Clause("delete", condition))
        return self

    def whenNotMatchedInsert(self, condition=None, values=None) -> "MergeBuilder":
        if not values:
            raise ValueError("whenNotMatchedInsert needs values={column: expression}")
        self._clauses.append(_Clause("insert", condition, dict(values)))
        return self

    def whenNotMatchedInsertAll(self, condition=None) -> "MergeBuilder":
        self._clauses.append(_Clause("insert_all", condition))
        return self

    # evaluation
    def _assignments(self, clause: _Clause, target_cols: list[str]) -> dict[str, Column]:
        ta, sa = self._target._alias, self._source_alias
        if clause.kind in ("update_all", "insert_all"):
            names = resolve_names(self._source.columns, target_cols)
            return {c: qcol(sa, n) for c, n in zip(target_cols, names)}
        out = {}
        for key, value in clause.assignments.items():
            bare = key.split(".", 1)[1] if key.split(".", 1)[0] in (ta, sa) and "." in key else key
            (col,) = resolve_names(target_cols, [bare])
            out[col] = _expr(value)
        return out

    def result(self, *, check_duplicates: bool = True) -> DataFrame:
        """The target's new content (lazy apart from the duplicate-match check)."""
        target = self._target._df
        ta, sa = self._target._alias, self._source_alias
        fields = target.schema.fields
        cols = [f.name for f in fields]
        flag = temp_name(list(target.columns) + list(self._source.columns), "src")
        t = target.alias(ta)
        s = self._source.withColumn(flag, F.lit(True)).alias(sa)

        conds = [qcol(ta, k) == qcol(sa, k) for k in self._on]
        if self._condition is not None:
            conds.append(_expr(self._condition))
        cond = reduce(lambda a, b: a & b, conds)

        matched_clauses = [c for c in self._clauses if c.kind in ("update", "update_all", "delete")]
        insert_clauses = [c for c in self._clauses if c.kind in ("insert", "insert_all")]
        max_multiplicity = None
        if not self._on and not self._has_equality(cond):
            raise ValueError("a merge condition needs an equality between target and source")
        if matched_clauses and check_duplicates and self._on:
            keys = resolve_names(self._source.columns, self._on)
            max_multiplicity = self._source.groupBy(*keys).count().agg(F.max("count")).collect()[0][0]

        if matched_clauses:
            if check_duplicates:
                self._check_single_match(target, cond, s, max_multiplicity)
            joined = t.join(s, cond, "left")
            matched = qcol(sa, flag).isNotNull()
            act = temp_name(list(target.columns) + [flag], "act")
            action = F.when(~matched, F.lit(0))
            for i, cl in enumerate(matched_clauses, start=1):
                c = F.lit(True) if cl.condition is None else F.coalesce(_expr(cl.condition), F.lit(False))
                action = action.when(c, F.lit(i))
            joined = joined.withColumn(act, action.otherwise(F.lit(0)))
            deletes = [i for i, cl in enumerate(matched_clauses, start=1) if cl.kind == "delete"]
            if deletes:
                joined = joined.where(~F.col(act).isin(deletes))
            per_clause = {
                i: self._assignments(cl, cols)
                for i, cl in enumerate(matched_clauses, start=1)
                if cl.kind != "delete"
            }
            out_cols = []
            for f in fields:
                value = None
                for i, assign in per_clause.items():
                    if f.name in assign:
                        e = assign[f.name].cast(f.dataType)
                        value = F.when(F.col(act) == i, e) if value is None else value.when(F.col(act) == i, e)
                keep = qcol(ta, f.name)
                out_cols.append((keep if value is None else value.otherwise(keep)).alias(f.name))
            changed = joined.select(*out_cols)
        else:
            changed = target.select(*cols)

        if not insert_clauses:
            return changed

        if self._on and self._condition is None:
            renamed = [temp_name(target, f"tk{i}") for i in range(len(self._on))]
            tkeys = target.select(*[F.col(k).alias(r) for k, r in zip(resolve_names(cols, self._on), renamed)])
            unmatched = s.join(tkeys.distinct(), [qcol(sa, k) == F.col(r) for k, r in zip(self._on, renamed)], "left_anti")
        else:
            unmatched = s.join(t, cond, "left_anti")
        unmatched = unmatched.alias(sa)
        ins = temp_name(list(target.columns) + [flag], "ins")
        action = None
        for i, cl in enumerate(insert_clauses, start=1):
            c = F.lit(True) if cl.condition is None else F.coalesce(_expr(cl.condition), F.lit(False))
            action = F.when(c, F.lit(i)) if action is None else action.when(c, F.lit(i))
        unmatched = unmatched.withColumn(ins, action.otherwise(F.lit(0))).where(F.col(ins) > 0)
        per_clause = {i: self._assignments(cl, cols) for i, cl in enumerate(insert_clauses, start=1)}
        out_cols = []
        for f in fields:
            value = None
            for i, assign in per_clause.items():
                e = assign[f.name] if f.name in assign else F.lit(None)
                value = F.when(F.col(ins) == i, e.cast(f.dataType)) if value is None else value.when(
                    F.col(ins) == i, e.cast(f.dataType)
                )
            out_cols.append(value.alias(f.name))
        inserted = unmatched.select(*out_cols)
        return changed.unionByName(inserted)

    def _has_equality(self, cond: Column) -> bool:
        """Whether Spark finds keys to join by in the condition. The join is planned over stand-ins of the
        two schemas, so that joins inside the source or target don't count."""

        def stand_in(df: DataFrame, alias: str) -> DataFrame:
            fields = [F.from_json(F.col("id").cast("string"), StructType([StructField(f.name, f.dataType)]))[f.name].alias(f.name) for f in df.schema.fields]
            return df.sparkSession.range(1).select(*fields).alias(alias)

        joined = stand_in(self._target._df, self._target._alias).join(stand_in(self._source, self._source_alias), cond)
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        return "NestedLoopJoin" not in plan and "CartesianProduct" not in plan

    def _check_single_match(self, target: DataFrame, cond: Column, s: DataFrame, max_multiplicity) -> None:
        """Raise when a target row has several matches under the whole condition. Target rows get an
        id by their place in the scan, so one matched twice shows as a repeated id; with equality
        keys only source rows whose key repeats can do that."""
        if self._on:
            if (max_multiplicity or 0) <= 1:
                return
            keys = resolve_names(self._source.columns, self._on)
            dups = self._source.groupBy(*keys).count().where(F.col("count") > 1).drop("count")
            renamed = [temp_name(target, f"dk{i}") for i in range(len(keys))]
            dups = dups.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)])
            s = s.join(dups, [qcol(self._source_alias, k) == F.col(r) for k, r in zip(keys, renamed)], "left_semi").alias(self._source_alias)
        rid = temp_name(list(target.columns) + list(self._source.columns), "rid")
        tagged = target.withColumn(rid, F.monotonically_increasing_id()).alias(self._target._alias)
        if not tagged.join(s, cond, "inner").groupBy(rid).count().where(F.col("count") > 1).isEmpty():
            raise MergeConflictError("several source rows match the same target row")

    def execute(self, *, check_duplicates: bool = True) -> DataFrame:
        """Compute the new content and publish it over the table/path (frames: just return it).

        ``check_duplicates=False`` skips the duplicate-match check when the source is unique on the
        merge keys by construction (e.g. the output of a ``groupBy`` on them).

        A target in buckets of columns that are all merge keys is merged bucket by bucket: only those that
        hold a key of the source are read, written and switched. A clause that moves a row to another
        bucket is an error there, and nothing changes."""
        tgt = self._target
        if tgt.layout and {k.lower() for k in tgt.layout.keys} <= {k.lower() for k in self._on}:
            return self._execute_buckets(check_duplicates)
        result = self.result(check_duplicates=check_duplicates)
        if tgt.name is None and tgt.path is None:
            return result
        if tgt.layout:
            return tgt.layout.replace(result, tgt.path, tgt.name)
        if tgt.path is not None:
            return replace_path(result, tgt.path, tgt.format, tgt.partition_by)
        return replace_table(result, tgt.name)

    def _execute_buckets(self, check_duplicates: bool) -> DataFrame:
        tgt, layout, spark = self._target, self._target.layout, self._source.sparkSession
        types = {f.name.lower(): f.dataType for f in tgt._df.schema.fields}
        names = resolve_names(self._source.columns, layout.keys)
        keys = [F.col(quote(n)).cast(types[k.lower()]) for n, k in zip(names, layout.keys)]
        # at most one row a bucket
        touched = [r[0] for r in self._source.select(layout.bucket(keys).alias(BUCKET)).distinct().collect()]
        whole = layout.read(spark, tgt.path) if tgt.path is not None else spark.table(tgt.name)
        part = copy.copy(tgt)
        part._df = whole.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        builder = copy.copy(self)
        builder._target = part
        result = layout.place(builder.result(check_duplicates=check_duplicates))
        if touched and tgt.path is not None:
            replace_path_parts(result, tgt.path, BUCKET, touched, layout.fmt)
        elif touched:
            replace_partitions(result, tgt.name, [{BUCKET: b} for b in touched])
        return layout.read(spark, tgt.path).drop(BUCKET) if tgt.path is not None else spark.table(tgt.name).drop(BUCKET)
