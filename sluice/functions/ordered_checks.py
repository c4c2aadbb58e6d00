"""Hundreds of checks that compare one expression with constants, without one CASE term for each.

``price > 10``, ``price > 20``, ``price > 30`` … are ordered: where one is TRUE, all weaker ones are. Checks
of one expression and one direction form a ladder, weakest first, and the number of its failed checks is found
by a binary search over the checks' own SQL (so NULL, NaN and type coercion are Spark's). That number gives the
bits of the ladder's failed checks, and the weakest check stands for all of them in a filter. Every other check
(equalities, ranges, calls) sets its bit by its own term. Messages are looked up four bits at a time.
"""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._util import quote, temp_name
from .checks import _EMPTY_SQL, APART_SQL, WIDE_CHECK_SET, _inlinable, _plain, any_failed, clauses_of, fail_messages

#: a ladder of fewer checks than this is no faster than their own terms
LADDER_LEAST = 8
#: checks whose bits share one long
WORD = 60

_COMPARISON = re.compile(r"^([^<>=!]+)(<=|>=|<|>)([^<>=!]+)$")
_NUMBER = re.compile(r"^[\d\s.+\-*()]*\d[\d\s.+\-*()]*$")
_QUOTED = re.compile(r"^(DATE\s*)?'[^'\\]*'$", re.IGNORECASE)
_ARITHMETIC = re.compile(r"^[\w\s.+\-*/()]+$", re.ASCII)
_WORD = re.compile(r"(?<![\w.])[A-Za-z_]\w*(?!\s*[\w.(])", re.ASCII)


def _constant(text: str) -> bool:
    return bool(_NUMBER.match(text) or _QUOTED.match(text))


def _expression(text: str, columns: set[str]) -> bool:
    """Arithmetic on columns and numbers alone: no call, no keyword, nothing that differs between two uses."""
    if not _ARITHMETIC.match(text):
        return False
    words = _WORD.findall(text)
    rest = _WORD.sub(" ", text)
    return bool(words) and not re.search(r"[A-Za-z_]", rest) and all(w.lower() in columns for w in words)


def _parts(sql: str, columns: set[str]) -> tuple[str, str, str] | None:
    """(expression, operator, constant) of a comparison, the expression on the left."""
    found = _COMPARISON.match(sql.strip()) if _inlinable(sql) else None
    if not found:
        return None
    left, op, right = (x.strip() for x in found.groups())
    if _constant(left) and not _constant(right):
        left, op, right = right, {"<": ">", ">": "<", "<=": ">=", ">=": "<="}[op], left
    return (left, op, right) if _constant(right) and _expression(left, columns) else None


def _order_key(kind: T.DataType, value):
    """``value`` as something Python orders as Spark orders it against an expression of ``kind``; None where
    that is not certain."""
    number = isinstance(value, (int, Decimal)) and not isinstance(value, bool)
    if isinstance(kind, T.DoubleType):
        return float(value) if number or isinstance(value, float) else None
    if isinstance(kind, (T.IntegralType, T.DecimalType)) and number:
        exact = Decimal(value)
        whole, scale = (20, 0) if isinstance(kind, T.IntegralType) else (kind.precision - kind.scale, kind.scale)
        fraction = max(scale, -exact.as_tuple().exponent)
        return exact if abs(exact) < 10**18 and max(whole, 20) + fraction <= 38 else None
    if isinstance(kind, T.DateType):
        return value if type(value).__name__ == "date" else None
    if kind == T.StringType():
        return value.encode() if isinstance(value, str) else None
    return None


class OrderedChecks:
    """The checks of a configuration as ladders plus the rest, for rows of ``df``.

    ``with_messages()`` and ``any_failed()`` give what ``fail_messages`` and ``any_failed`` give. Without a ladder of
    ``least`` checks they are those. Building it runs no job: types come from analysis, constants are folded.
    """

    def __init__(self, df: DataFrame, cfg, *, least: int = LADDER_LEAST):
        self.clauses = clauses_of(cfg)
        self.ladders: list[list[int]] = []
        plain_names = len({c.lower() for c in df.columns}) == len(df.columns)
        if len(self.clauses) >= least and plain_names and all(_plain(c.message) and _inlinable(c.sql) for c in self.clauses):
            self.ladders = [x for x in self._ordered(df, self._groups(df, least)) if len(x) >= least]
        taken = {i for ladder in self.ladders for i in ladder}
        self.rest = [i for i in range(len(self.clauses)) if i not in taken]

    def _groups(self, df: DataFrame, least: int) -> dict[tuple[str, str], list[tuple[int, str, str]]]:
        columns = {c.lower() for c in df.columns}
        groups: dict[tuple[str, str], list[tuple[int, str, str]]] = {}
        for i, clause in enumerate(self.clauses):
            if parts := _parts(clause.sql, columns):
                left, op, constant = parts
                groups.setdefault((left, op[0]), []).append((i, op, constant))
        return {k: v for k, v in groups.items() if len(v) >= least}

    def _ordered(self, df: DataFrame, groups) -> list[list[int]]:
        if not groups:
            return []
        kinds = [f.dataType for f in df.selectExpr(*[f"({left}) AS e{n}" for n, (left, _) in enumerate(groups)]).schema]
        texts = list(dict.fromkeys(c for members in groups.values() for _, _, c in members))
        folded = df.sparkSession.sql("SELECT " + ", ".join(f"({c}) AS c{n}" for n, c in enumerate(texts))).first()
        values = dict(zip(texts, folded))
        out = []
        for kind, ((_, direction), members) in zip(kinds, groups.items()):
            keyed = [(_order_key(kind, values[c]), op, i) for i, op, c in members]
            keyed = [x for x in keyed if x[0] is not None]
            if direction == ">":  # the smaller the constant the weaker, >= weaker than >
                keyed.sort(key=lambda x: (x[0], x[1] == ">"))
            else:
                keyed.sort(key=lambda x: (x[0], x[1] == "<="), reverse=True)
            out.append([i for _, _, i in keyed])
        return out

    def _failed(self, ladder: list[int], low: int, high: int) -> str:
        """SQL of how many of the ladder's checks fail, known to lie in low..high."""
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return f"IF({self.clauses[ladder[middle]].sql}, {self._failed(ladder, middle + 1, high)}, {self._failed(ladder, low, middle)})"

    def _word(self, word: int, counts: list[str]) -> str:
        """SQL of the bits of checks ``word * WORD`` and on: a ladder's by its count, the rest by their terms."""
        low, parts = word * WORD, []
        for ladder, count in zip(self.ladders, counts):
            sets = [0]
            for i in ladder:
                sets.append(sets[-1] | (1 << i - low if low <= i < low + WORD else 0))
            if sets[-1]:
                parts.append(f"array({', '.join(f'{x}L' for x in sets)})[{count}]")
        parts += [f"IF({self.clauses[i].sql}, {1 << i - low}L, 0L)" for i in self.rest if low <= i < low + WORD]
        return " | ".join(parts)

    def _texts(self, low: int, word: str, shift: int) -> str:
        """SQL of the messages of the four checks from ``low`` on whose bits are set: one of sixteen arrays."""
        texts = [f"'{c.message}'" for c in self.clauses[low : low + 4]]
        sets = (", ".join(t for n, t in enumerate(texts) if bits >> n & 1) for bits in range(1 << len(texts)))
        arrays = ", ".join(f"array({x})" if x else _EMPTY_SQL for x in sets)
        return f"array({arrays})[cast(shiftright({word}, {shift}) & 15L as int)]"

    def with_messages(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with ``column``: the ``array<string>`` of the messages of all checks that are TRUE, in
        configuration order. Each projection names what the one before has made several times, so the optimizer
        keeps them apart: counts of the ladders, then words of bits, then messages of four bits at a time. In a wide
        set each of them holds ``APART_SQL``, which adds nothing, so that none becomes one huge method."""
        if not self.ladders:
            return df.withColumn(column, fail_messages(self.clauses))
        n_words = -(-len(self.clauses) // WORD)
        counts = [temp_name(df, f"failed{n}") for n in range(len(self.ladders))]
        words = [temp_name(df, f"word{n}") for n in range(n_words)]
        wide = len(self.clauses) >= WIDE_CHECK_SET
        none = f"size({APART_SQL})" if wide else ""
        counted = [f"{self._failed(x, 0, len(x))}{none and f' + {none}'} AS {c}" for x, c in zip(self.ladders, counts)]
        bits = [f"{self._word(n, counts)}{none and f' | {none}'} AS {w}" for n, w in enumerate(words)]
        texts = [APART_SQL] * wide
        texts += [self._texts(i, words[i // WORD], i % WORD) for i in range(0, len(self.clauses), 4)]
        out = df.selectExpr("*", *counted).selectExpr("*", *bits)
        made = f"concat({', '.join(texts)}) AS {quote(column)}"
        kept = [made if c.lower() == column.lower() else quote(c) for c in df.columns]
        return out.selectExpr(*kept, *([] if made in kept else [made]))

    def any_failed(self) -> Column:
        """TRUE exactly for rows with a failed check: the weakest check of each ladder, and the rest."""
        return any_failed([self.clauses[i] for i in sorted([x[0] for x in self.ladders] + self.rest)])
