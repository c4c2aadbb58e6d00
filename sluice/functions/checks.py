"""Row-check configuration objects and the Column expressions built from them.

A check is a Spark SQL boolean expression that is TRUE when a row is *bad*, plus the message
to record. A check that evaluates to NULL counts as passed (three-valued logic), so
``x IS NULL`` and ``x = ''`` are separate checks.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


@dataclass(frozen=True)
class DataCheckClause:
    sql: str
    message: str


@dataclass
class DataCheck:
    catalog: str | None = None
    schema: str | None = None
    table: str | None = None
    data_checks: list[DataCheckClause] = field(default_factory=list)


def clauses_of(cfg) -> list[DataCheckClause]:
    """Normalise a check configuration into clauses.

    Accepts a ``DataCheck``, any object with a ``data_checks`` attribute (duck typing), a list of
    clause-like objects (``.sql``/``.message`` attributes, ``Row``s, dicts or ``(sql, message)``
    pairs). NULL sql or message is rejected: a NULL message would silently become a NULL array
    element.
    """
    items = getattr(cfg, "data_checks", cfg)
    if items is None:
        return []
    out = []
    for i, item in enumerate(items):
        if hasattr(item, "asDict"):  # pyspark Row (a tuple, but fields by name)
            sql, msg = item["sql"], item["message"]
        elif isinstance(item, dict):
            sql, msg = item.get("sql"), item.get("message")
        elif isinstance(item, (tuple, list)):
            sql, msg = item
        else:
            sql, msg = item.sql, item.message
        if sql is None or not str(sql).strip():
            raise ValueError(f"check #{i} has no SQL expression")
        if msg is None:
            raise ValueError(f"check #{i} ({sql!r}) has a NULL message")
        out.append(DataCheckClause(str(sql), str(msg)))
    return out


def empty_messages() -> Column:
    return F.array().cast("array<string>")


def check_condition(clause: DataCheckClause) -> Column:
    return F.expr(clause.sql)


_EMPTY_SQL = "cast(array() as array<string>)"
#: with this many checks, their code is kept out of whole-stage methods
WIDE_CHECK_SET = 50
#: An empty array of strings by a higher-order function. Whole-stage code generation leaves an operator that holds one
#: alone, so its other expressions are compiled into many small methods. In one whole-stage method, hundreds of
#: checks pass the 8000 bytes above which HotSpot doesn't compile but interprets, many times slower.
APART_SQL = f"filter({_EMPTY_SQL}, x -> true)"


def _plain(message: str) -> bool:
    """Messages that can be inlined in SQL text as ``'...'`` without any escaping."""
    return "'" not in message and "\\" not in message


def _inlinable(sql: str) -> bool:
    """Check SQL that can be embedded in a larger SQL text (a comment would swallow the rest)."""
    return "--" not in sql and "/*" not in sql and "\n" not in sql


def fail_messages(cfg) -> Column:
    """``array<string>`` of the messages of all checks that are TRUE, in configuration order.

    Built as ``concat(when(c1, [m1]) otherwise [], ...)``: plain expressions that stay inside
    whole-stage code generation (no lambda / higher-order function per row). The expression is
    handed to Spark as one SQL text (one call instead of several per check) unless a message
    needs quoting.
    """
    clauses = clauses_of(cfg)
    if not clauses:
        return empty_messages()
    if all(_plain(c.message) and _inlinable(c.sql) for c in clauses):
        parts = ", ".join(f"CASE WHEN ({c.sql}) THEN array('{c.message}') ELSE {_EMPTY_SQL} END" for c in clauses)
        return F.expr(f"concat({_apart_or_empty(clauses)}, {parts})")
    parts = [
        F.when(check_condition(c), F.array(F.lit(c.message))).otherwise(empty_messages())
        for c in clauses
    ]
    return F.concat(F.expr(_apart_or_empty(clauses)), *parts)


def _apart_or_empty(clauses) -> str:
    return APART_SQL if len(clauses) >= WIDE_CHECK_SET else _EMPTY_SQL


def any_failed(cfg) -> Column:
    """``c1 OR c2 OR ...``: TRUE exactly for rows with at least one failed check.

    NULL OR FALSE is NULL, which a filter drops, matching "NULL check = passed". As a filter this
    form reaches the parquet scan as pushed predicates for simple checks.
    """
    clauses = clauses_of(cfg)
    if not clauses:
        return F.lit(False)
    if all(_inlinable(c.sql) for c in clauses):
        failed = F.expr(" OR ".join(f"({c.sql})" for c in clauses))
    else:
        failed = reduce(lambda a, b: a | b, (check_condition(c) for c in clauses))
    return failed & F.expr(f"size({APART_SQL}) = 0") if len(clauses) >= WIDE_CHECK_SET else failed


def validate_checks(df: DataFrame, cfg) -> None:
    """Analyse every check against ``df`` (no job runs) and name the first faulty one."""
    clauses = clauses_of(cfg)
    if not clauses:
        return
    try:
        fields = df.select(*[check_condition(c).alias(f"c{i}") for i, c in enumerate(clauses)]).schema.fields
        bad = [i for i, f in enumerate(fields) if not isinstance(f.dataType, BooleanType)]
        if not bad:
            return
    except Exception:
        bad = None
    for i, c in enumerate(clauses):
        if bad is not None and i not in bad:
            continue
        try:
            dtype = df.select(check_condition(c)).schema.fields[0].dataType
        except Exception as e:  # analysis error: unknown column, bad syntax ...
            raise ValueError(f"check #{i} {c.sql!r} ({c.message!r}) cannot be analysed: {e}") from e
        if not isinstance(dtype, BooleanType):
            raise ValueError(f"check #{i} {c.sql!r} ({c.message!r}) is {dtype.simpleString()}, not boolean")
