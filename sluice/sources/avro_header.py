"""The schema of an avro file, from its header alone.

An avro container begins with four magic bytes and a map of metadata; the entry ``avro.schema`` is the
writer's schema as JSON. No record is read, and no avro library is needed. Types are mapped as Spark's
avro source maps them: a union with null is the nullable other type, enums and uuids are strings, fixed is
binary, int and long (or float and double) together are the wider one, and any other union is a struct of
``member0``, ``member1`` and so on.
"""

from __future__ import annotations

import json

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

MAGIC = b"Obj\x01"

# avro's primitive types and logical types by their names.
PRIMITIVES = {
    "null": NullType(), "boolean": BooleanType(), "int": IntegerType(), "long": LongType(), "float": FloatType(),
    "double": DoubleType(), "bytes": BinaryType(), "string": StringType(),
}
LOGICAL = {
    ("int", "date"): DateType(), ("long", "timestamp-millis"): TimestampType(), ("long", "timestamp-micros"): TimestampType(),
    ("long", "local-timestamp-millis"): TimestampNTZType(), ("long", "local-timestamp-micros"): TimestampNTZType(),
}


class AvroHeaderError(ValueError):
    """The file is no avro container, or its header is cut or malformed."""


def _exactly(stream, n: int) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise AvroHeaderError("the header is cut")
    return data


def _long(stream) -> int:
    """A whole number in zigzag variable-length coding."""
    value = shift = 0
    while True:
        (byte,) = _exactly(stream, 1)
        value |= (byte & 127) << shift
        if byte < 128:
            return (value >> 1) ^ -(value & 1)
        shift += 7
        if shift > 63:
            raise AvroHeaderError("a number of more than 64 bits")


def _sized(stream) -> bytes:
    n = _long(stream)
    if n < 0:
        raise AvroHeaderError("a negative length")
    return _exactly(stream, n)


def header(stream) -> dict[str, bytes]:
    """The metadata map of a container, read from its first bytes."""
    if stream.read(4) != MAGIC:
        raise AvroHeaderError("not an avro container")
    out = {}
    while n := _long(stream):
        if n < 0:  # a block that also tells its size in bytes
            n = -n
            _long(stream)
        for _ in range(n):
            key = _sized(stream).decode()
            out[key] = _sized(stream)
    return out


def avro_schema(stream) -> StructType:
    """The Spark schema of a container whose writer's schema is a record."""
    try:
        declared = json.loads(header(stream)["avro.schema"])
    except (KeyError, UnicodeDecodeError, json.JSONDecodeError) as e:
        raise AvroHeaderError(f"no readable schema: {e!r}") from e
    found, _ = spark_type(declared, {}, "")
    if not isinstance(found, StructType):
        raise AvroHeaderError("the schema is no record")
    return found


def spark_type(declared, named: dict, space: str) -> tuple[DataType, bool]:
    """Spark type and nullability of an avro type; ``named`` holds the types defined so far by full name."""
    if isinstance(declared, list):
        rest = [d for d in declared if d != "null"]
        nullable = len(rest) < len(declared)
        kinds = [spark_type(d, named, space)[0] for d in rest]
        if len(kinds) == 1:
            return kinds[0], nullable
        if kinds and all(isinstance(k, (IntegerType, LongType)) for k in kinds):
            return LongType(), nullable
        if kinds and all(isinstance(k, (FloatType, DoubleType)) for k in kinds):
            return DoubleType(), nullable
        return (StructType([StructField(f"member{i}", k, True) for i, k in enumerate(kinds)]) if kinds else NullType()), nullable
    if isinstance(declared, str):
        if declared in PRIMITIVES:
            return PRIMITIVES[declared], declared == "null"
        full = declared if "." in declared or not space else f"{space}.{declared}"
        if full not in named:
            raise AvroHeaderError(f"unknown type {declared!r}")
        if named[full] is None:
            raise AvroHeaderError(f"{declared!r} holds itself")
        return named[full], False
    kind = declared.get("type") if isinstance(declared, dict) else None
    if kind in ("record", "enum", "fixed"):
        name = declared["name"]
        own = name.rpartition(".")[0] or declared.get("namespace", space)
        full = name if "." in name or not own else f"{own}.{name}"
        named[full] = None
        if kind == "record":
            fields = [(f["name"], *spark_type(f["type"], named, own)) for f in declared["fields"]]
            named[full] = StructType([StructField(n, t, null) for n, t, null in fields])
        elif declared.get("logicalType") == "decimal":
            named[full] = DecimalType(declared["precision"], declared.get("scale", 0))
        else:
            named[full] = StringType() if kind == "enum" else BinaryType()
        return named[full], False
    if kind == "array":
        return ArrayType(*spark_type(declared["items"], named, space)), False
    if kind == "map":
        return MapType(StringType(), *spark_type(declared["values"], named, space)), False
    if kind == "bytes" and declared.get("logicalType") == "decimal":
        return DecimalType(declared["precision"], declared.get("scale", 0)), False
    if isinstance(kind, str) and (kind, declared.get("logicalType")) in LOGICAL:
        return LOGICAL[(kind, declared["logicalType"])], False
    if kind is None:
        raise AvroHeaderError(f"malformed type {declared!r}")
    return spark_type(kind, named, space)
