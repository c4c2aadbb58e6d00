"""Ladders of ordered checks against the plain form: same rows, same messages, smaller plans."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.checks import any_failed, clauses_of, fail_messages
from sluice.functions.ordered_checks import OrderedChecks
from sluice.operators import apply_data_checks, good_rows, tag_rows

SCHEMA = "id long, d double, n int, b bigint, m decimal(12,2), day date, s string"
SPECIAL = [
    (1, math.nan, 3, 10**15, Decimal("1.50"), dt.date(2024, 2, 29), ""),
    (2, -0.0, -7, -5, Decimal("-0.01"), dt.date(1970, 1, 1), "é"),
    (3, 0.0, None, 0, None, None, None),
    (4, math.inf, 2**31 - 1, 7, Decimal("9999999999.99"), dt.date(2100, 1, 1), "zz"),
    (5, -math.inf, -(2**31), 2**63 - 1, Decimal("0.10"), dt.date(2024, 3, 1), "Z"),
    (6, 0.1, 0, -(2**63), Decimal("5.00"), dt.date(2023, 12, 31), "5"),
    (7, None, None, None, None, None, "a\nb"),
]


def plain(df, checks):
    return df.where(any_failed(checks)).withColumn("fail_messages", fail_messages(checks))


def rows(df):
    return sorted((r["id"], tuple(r["fail_messages"])) for r in df.select("id", "fail_messages").collect())


def ladders_of(df, sqls, **kw):
    return OrderedChecks(df, [(s, f"m{i}") for i, s in enumerate(sqls)], **kw).ladders


@pytest.fixture(scope="module")
def special(spark):
    return spark.createDataFrame(SPECIAL, SCHEMA).cache()


def test_every_type_and_direction(spark, special):
    constants = {
        "d": ["0", "-0.0", "0.1", "1 + 2", "-3.25", "100", "0.10", "2 * (3 - 1)"],
        "d * 2 - n": ["0", "1", "-1", "7.5", "3", "10", "-20", "4"],
        "n": ["0", "3", "2.5", "-7", "-7.0", "100", "2147483647", "-1"],
        "b": ["0", "10", "-5", "7", "6.999", "100000000000", "1", "2"],
        "m": ["0", "0.1", "0.10", "1.5", "5", "-0.005", "9999999999", "3"],
        "day": [f"DATE '{x}'" for x in ("2024-02-29", "1970-01-01", "2023-12-31", "2024-3-1", "2000-01-01", "2099-12-31", "2024-02-28", "2001-01-01")],
        "s": ["'a'", "'Z'", "''", "'é'", "'zzz'", "'5'", "'A'", "'10'"],
    }
    checks = [(f"{left} {op} {c}", f"{left} {op} {c}".replace("'", "")) for left, cs in constants.items() for op in ("<", "<=", ">", ">=") for c in cs]
    checks += [(f"{c} >= {left}", f"flipped {n}") for n, (left, cs) in enumerate(constants.items()) for c in cs[:4]]
    checks.insert(5, ("s IS NULL", "no s"))
    assert len(OrderedChecks(special, checks).ladders) == 14
    assert rows(apply_data_checks(special, checks)) == rows(plain(special, checks))
    assert rows(tag_rows(special, checks)) == rows(special.withColumn("fail_messages", fail_messages(checks)))
    bad = {i for i, _ in rows(plain(special, checks))}
    assert {r["id"] for r in good_rows(special, checks).collect()} == {r[0] for r in SPECIAL} - bad


def test_what_is_not_certain_keeps_its_own_term(special):
    def unordered(*sqls):
        assert ladders_of(special, sqls * 8) == []

    unordered("rand() > 0.5")
    unordered("abs(d) > 1")
    unordered("NOT d > 1")
    unordered("d > 1 AND n > 2")
    unordered("d > n")
    unordered("s > 5")
    unordered("day > '2024-01-01'")
    unordered("d = 1")
    unordered("cast(d as float) > 0.1")
    unordered("n > 1 -- small")
    unordered("m > 1e3")
    assert ladders_of(special, [f"D  >  {i}" for i in range(7)]) == []
    assert ladders_of(special, [f"D  >  {i}" for i in (3, 1, 2, 7, 6, 5, 4, 0)]) == [[7, 1, 2, 0, 6, 5, 4, 3]]
    floats = special.select(F.col("d").cast("float").alias("d"))
    assert ladders_of(floats, [f"d > 0.{i}" for i in range(9)]) == []


def test_columns_of_any_name_and_a_replaced_column(spark):
    df = spark.createDataFrame([(1, "x", 5.0, "old")], ["id", "a.b `c", "v", "fail_messages"])
    out = apply_data_checks(df, [(f"v > {i}", f"over {i}") for i in range(9)])
    assert out.columns == ["id", "a.b `c", "v", "fail_messages"]
    assert out.collect()[0]["fail_messages"] == [f"over {i}" for i in range(5)]
    twice = spark.createDataFrame([(1, 5.0)], "id int, v double").selectExpr("id", "v", "id AS ID")
    assert apply_data_checks(twice, [(f"v > {i}", f"over {i}") for i in range(9)]).collect()[0]["fail_messages"] == [f"over {i}" for i in range(5)]
    aliased = df.alias("t").transform(lambda d: apply_data_checks(d, [(f"v > {i}", f"m{i}") for i in range(9)]))
    assert aliased.select("t.id").collect()[0][0] == 1


def test_empty_frame(spark):
    df = spark.createDataFrame([], "id int, v double")
    assert apply_data_checks(df, [(f"v > {i}", f"m{i}") for i in range(9)]).collect() == []


def test_the_weakest_check_reaches_the_scan(spark):
    from tests.conftest import SF001

    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    checks = [(f"l_quantity > {(i * 7) % 60 + 20}", f"m{i}") for i in range(120)]
    plan = apply_data_checks(li, checks)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,20.0)]" in plan


_numbers = st.one_of(st.integers(-30, 30).map(str), st.decimals(-30, 30, places=2).map(str))
_checks = st.lists(st.tuples(st.sampled_from(["d", "n", "m", "d + n"]), st.sampled_from(["<", "<=", ">", ">=", "="]), _numbers), min_size=1, max_size=150)
_values = st.one_of(st.none(), st.integers(-30, 30))


@settings(max_examples=12, deadline=None)
@given(_checks, st.lists(st.tuples(_values, _values, _values), min_size=1, max_size=12))
def test_any_set_equals_the_plain_form(spark, checks, values):
    data = [(i, None if d is None else d / 4, n, None if m is None else Decimal(m) / 4) for i, (d, n, m) in enumerate(values)]
    df = spark.createDataFrame(data, "id int, d double, n int, m decimal(12,2)")
    clauses = clauses_of([(f"{left} {op} {c}", f"m{i}") for i, (left, op, c) in enumerate(checks)])
    ordered = OrderedChecks(df, clauses, least=2)
    assert rows(ordered.with_messages(df.where(ordered.any_failed()), "fail_messages")) == rows(plain(df, clauses))


def largest_method(df):
    """Bytes of the largest method that whole-stage code generation makes for ``df``."""
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max((stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())), default=0)


@pytest.mark.parametrize("checks", [
    [(f"{kind} {op} {(i * 37) % 200}", f"m{i}") for i in range(70) for kind, op in (("d", ">"), ("b", "<="), ("n + d", ">="), ("n", "="))],
    [(f"n = {i} OR s = 'x{i}'", f"m{i}") for i in range(300)],
])
def test_hundreds_of_checks_make_no_method_too_large_to_be_compiled(special, checks):
    df = special.sparkSession.createDataFrame(SPECIAL, SCHEMA)
    assert largest_method(df.where(F.expr(" OR ".join(f"({s})" for s, _ in checks * 2)))) > 8000
    for made in (apply_data_checks(df, checks), tag_rows(df, checks), good_rows(df, checks)):
        assert largest_method(made.select("id", *[F.array_join(c, "|") for c in made.columns if c == "fail_messages"])) <= 8000
    assert rows(apply_data_checks(special, checks)) == rows(plain(special, checks))
