"""Frame and schema equality.

``frame_diff`` is the distributed multiset difference (row order and column order ignored): one
``groupBy`` over all columns of the union with a signed count, so identical rows are pre-aggregated
in each task before the shuffle, and a difference is reported once with its multiplicity instead of
being replicated row by row. ``frame_diff_by_digest`` does the same for frames that are nearly equal and
shuffles only the rows of buckets whose digests differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StructType,
    TimestampNTZType,
)

from .._util import quote, resolve_names, same_names, temp_name

SIDE = "_side"
COUNT = "_count"
_SALT = 0x9E3779B9


def type_differences(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns of the same name whose types differ (nullability aside)."""
    other = {f.name.lower(): f for f in right.schema.fields}
    out = []
    for f in left.schema.fields:
        g = other.get(f.name.lower())
        if g is not None and _strip_nullability(f.dataType) != _strip_nullability(g.dataType):
            out.append(f"{f.name}: {f.dataType.simpleString()} vs {g.dataType.simpleString()}")
    return out


def frame_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs: the columns, ``_side`` ('left_only'/'right_only') and
    ``_count`` = how many more copies that side holds. Empty when the frames are equal as multisets
    (NULLs compare equal, like EXCEPT ALL). Frames of different types are refused, not coerced."""
    if not same_names(left.columns, right.columns):
        raise ValueError(f"column sets differ: {sorted(left.columns)} vs {sorted(right.columns)}")
    if differ := type_differences(left, right):
        raise ValueError(f"column types differ: {'; '.join(differ)}")
    cols = list(left.columns)
    right = right.select(*[F.col(quote(c)).alias(c) for c in resolve_names(right.columns, cols)])
    n = temp_name(cols, "n")
    both = left.select(*[quote(c) for c in cols], F.lit(1).alias(n)).unionByName(
        right.select(*[quote(c) for c in cols], F.lit(-1).alias(n))
    )
    net = both.groupBy(*[quote(c) for c in cols]).agg(F.sum(n).alias(n)).where(F.col(n) != 0)
    return net.select(
        *[quote(c) for c in cols],
        F.when(F.col(n) > 0, F.lit("left_only")).otherwise(F.lit("right_only")).alias(SIDE),
        F.abs(F.col(n)).alias(COUNT),
    )


def digests(df: DataFrame, buckets: int) -> DataFrame:
    """One row a bucket of rows (by their hash): bucket, rows, and two sums of independent 64-bit row hashes.
    The sums don't depend on the order of rows and count repeated ones."""
    cols = [F.col(quote(c)) for c in df.columns]
    hashed = df.select(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(_SALT), *cols).alias("b"))
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("a", "b")]
    return hashed.groupBy(F.pmod("a", F.lit(buckets).cast("long")).cast("int").alias("bucket")).agg(F.count("*").alias("n"), *wide)


def frame_diff_by_digest(left: DataFrame, right: DataFrame, buckets: int = 4096) -> DataFrame:
    """:func:`frame_diff` for frames that are nearly equal: the digests of both are compared first, and only
    rows of differing buckets are read again and shuffled. Both frames are read twice, so they should be
    tables or files; where most buckets differ, :func:`frame_diff` is the cheaper one. A differing bucket goes
    unseen only if two pairs of 64-bit hash sums agree by chance."""
    if not same_names(left.columns, right.columns):
        raise ValueError(f"column sets differ: {sorted(left.columns)} vs {sorted(right.columns)}")
    if differ := type_differences(left, right):
        raise ValueError(f"column types differ: {'; '.join(differ)}")
    cols = list(left.columns)
    right = right.select(*[F.col(quote(c)).alias(c) for c in resolve_names(right.columns, cols)])
    a, b = digests(left, buckets).alias("l"), digests(right, buckets).alias("r")
    same = F.col("l.n").eqNullSafe(F.col("r.n")) & F.col("l.a").eqNullSafe(F.col("r.a")) & F.col("l.b").eqNullSafe(F.col("r.b"))
    differing = a.join(b, "bucket", "full").where(~same).select("bucket")
    found = [r[0] for r in differing.collect()]  # at most one row a bucket
    where = F.pmod(F.xxhash64(*[F.col(quote(c)) for c in cols]), F.lit(buckets).cast("long")).cast("int").isin(found)
    return frame_diff(left.where(where), right.where(where))


def frames_equal(left: DataFrame, right: DataFrame) -> bool:
    return same_names(left.columns, right.columns) and not type_differences(left, right) and frame_diff(left, right).isEmpty()


def assert_frames_equal(actual: DataFrame, expected: DataFrame, *, show: int = 10) -> None:
    """Raise AssertionError listing (at most ``show``) differing rows."""
    if not same_names(actual.columns, expected.columns):
        raise AssertionError(f"column sets differ: {sorted(actual.columns)} vs {sorted(expected.columns)}")
    if differ := type_differences(actual, expected):
        raise AssertionError(f"column types differ (actual vs expected): {'; '.join(differ)}")
    sample = frame_diff(actual, expected).limit(show).collect()
    if sample:
        lines = "\n".join(str(r.asDict()) for r in sample)
        raise AssertionError(f"frames differ (left=actual, right=expected), first rows:\n{lines}")


@dataclass(frozen=True)
class SchemaBreach:
    kind: str  # missing | unexpected | type | position | nullability
    column: str
    expected: str | None = None
    actual: str | None = None

    def __str__(self) -> str:
        if self.kind == "missing":
            return f"missing column {self.column} {self.expected}"
        if self.kind == "unexpected":
            return f"unexpected column {self.column} {self.actual}"
        return f"{self.kind} of {self.column}: expected {self.expected}, got {self.actual}"


def _strip_nullability(dt):
    if isinstance(dt, StructType):
        return StructType([type(f)(f.name, _strip_nullability(f.dataType), True) for f in dt.fields])
    if isinstance(dt, ArrayType):
        return ArrayType(_strip_nullability(dt.elementType), True)
    if isinstance(dt, MapType):
        return MapType(_strip_nullability(dt.keyType), _strip_nullability(dt.valueType), True)
    return dt


#: narrower to wider whole numbers, with the decimal digits each holds
_WHOLE = ((ByteType, 3), (ShortType, 5), (IntegerType, 10), (LongType, 19))


def fits(actual: DataType, wanted: DataType) -> bool:
    """Whether every value of type ``actual`` is one of type ``wanted``: the same type, a narrower whole
    number, float for double, a whole number below bigint for double, a decimal with no more digits on either side
    of the point, a whole number for a decimal that holds its digits, date for timestamp_ntz."""
    if _strip_nullability(actual) == _strip_nullability(wanted):
        return True
    digits = {t: n for t, n in _WHOLE}
    order = [t for t, _ in _WHOLE]
    a, w = type(actual), type(wanted)
    if a in order:
        if w in order:
            return order.index(a) <= order.index(w)
        if w is DoubleType:
            return a is not LongType
        return w is DecimalType and wanted.precision - wanted.scale >= digits[a]
    if a is DecimalType and w is DecimalType:
        return wanted.scale >= actual.scale and wanted.precision - wanted.scale >= actual.precision - actual.scale
    return (a, w) in ((FloatType, DoubleType), (DateType, TimestampNTZType))


def schema_breaches(
    actual: StructType,
    contract: StructType,
    *,
    ignore_nullable: bool = True,
    check_order: bool = True,
    case_sensitive: bool = True,
    widen: bool = False,
) -> list[SchemaBreach]:
    """Differences between a schema and a contract: missing, unexpected, wrong type, wrong
    position and (unless ignored, the default as in PySpark's schema assertion) nullability.

    Structs, arrays and maps are compared inside, and a breach names the nested field by its path:
    ``a.b`` for a field, ``a[]`` for the elements of an array, ``a{key}`` and ``a{value}`` for a map.
    With ``widen`` a type that :func:`fits` the contract's is no breach."""
    return list(_struct_breaches(actual, contract, "", ignore_nullable, check_order, case_sensitive, widen))


def _struct_breaches(actual: StructType, contract: StructType, prefix: str, *how):
    ignore_nullable, check_order, case_sensitive, _ = how

    def key(name):
        return name if case_sensitive else name.lower()

    got = {key(f.name): (i, f) for i, f in enumerate(actual.fields)}
    want = {key(f.name): (i, f) for i, f in enumerate(contract.fields)}
    for k, (i, f) in want.items():
        path = prefix + f.name
        if k not in got:
            yield SchemaBreach("missing", path, expected=f.dataType.simpleString())
            continue
        j, g = got[k]
        inside = list(_type_breaches(g.dataType, f.dataType, path, *how))
        yield from inside
        if check_order and i != j:
            yield SchemaBreach("position", path, expected=str(i), actual=str(j))
        if not ignore_nullable and f.nullable != g.nullable:
            yield SchemaBreach("nullability", path, expected=str(f.nullable), actual=str(g.nullable))
    for k, (_, g) in got.items():
        if k not in want:
            yield SchemaBreach("unexpected", prefix + g.name, actual=g.dataType.simpleString())


def _type_breaches(actual: DataType, wanted: DataType, path: str, *how):
    ignore_nullable, _, _, widen = how
    if isinstance(actual, StructType) and isinstance(wanted, StructType):
        yield from _struct_breaches(actual, wanted, f"{path}.", *how)
    elif isinstance(actual, ArrayType) and isinstance(wanted, ArrayType):
        yield from _type_breaches(actual.elementType, wanted.elementType, f"{path}[]", *how)
        if not ignore_nullable and actual.containsNull != wanted.containsNull:
            yield SchemaBreach("nullability", f"{path}[]", expected=str(wanted.containsNull), actual=str(actual.containsNull))
    elif isinstance(actual, MapType) and isinstance(wanted, MapType):
        yield from _type_breaches(actual.keyType, wanted.keyType, f"{path}{{key}}", *how)
        yield from _type_breaches(actual.valueType, wanted.valueType, f"{path}{{value}}", *how)
        if not ignore_nullable and actual.valueContainsNull != wanted.valueContainsNull:
            yield SchemaBreach("nullability", f"{path}{{value}}", expected=str(wanted.valueContainsNull), actual=str(actual.valueContainsNull))
    elif actual.simpleString() != wanted.simpleString() and not (widen and fits(actual, wanted)):
        yield SchemaBreach("type", path, expected=wanted.simpleString(), actual=actual.simpleString())


def assert_schema_equal(actual: StructType, contract: StructType, **kw) -> None:
    breaches = schema_breaches(actual, contract, **kw)
    if breaches:
        raise AssertionError("; ".join(str(b) for b in breaches))
