"""Avro contracts from the files' headers, on files written by an encoder of the test's own."""

import io
import json
import os

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql.types import StructType

from sluice.operators.contract import contract_breaches
from sluice.plans.landing import apply_data_contract
from sluice.sources.avro_header import AvroHeaderError, _long, avro_schema, header
from sluice.sources.landing import LandingArea


def zigzag(n):
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def sized(data):
    return zigzag(len(data)) + data


def container(schema, codec=b"null", sized_blocks=False, records=b""):
    entries = [(b"avro.schema", schema if isinstance(schema, bytes) else json.dumps(schema).encode()), (b"avro.codec", codec), (b"made.by", b"x" * 300)]
    body = b"".join(sized(k) + sized(v) for k, v in entries)
    block = zigzag(-len(entries)) + zigzag(len(body)) if sized_blocks else zigzag(len(entries))
    sync = bytes(range(16))
    return b"Obj\x01" + block + body + zigzag(0) + sync + (zigzag(1) + sized(records) + sync if records else b"")


def record(fields, **more):
    return {"type": "record", "name": "row", "fields": [{"name": n, "type": t} for n, t in fields], **more}


CUSTOMER = [("id", "string"), ("name", ["null", "string"]), ("age", ["int", "null"]), ("country", ["null", "string"])]


@given(st.integers(-(2**63), 2**63 - 1))
def test_whole_numbers(n):
    assert _long(io.BytesIO(zigzag(n))) == n


@pytest.mark.parametrize("sized_blocks", [False, True])
def test_header(sized_blocks):
    found = header(io.BytesIO(container(record([]), b"deflate", sized_blocks)))
    assert found["avro.codec"] == b"deflate" and len(found["made.by"]) == 300


@pytest.mark.parametrize("declared, wanted", [
    ("int", "int not null"), ("long", "bigint not null"), (["null", "double"], "double"), ("boolean", "boolean not null"), ("bytes", "binary not null"),
    ({"type": "int", "logicalType": "date"}, "date not null"), ({"type": "long", "logicalType": "timestamp-micros"}, "timestamp not null"),
    ({"type": "long", "logicalType": "local-timestamp-millis"}, "timestamp_ntz not null"), ({"type": "string", "logicalType": "uuid"}, "string not null"),
    ({"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 2}, "decimal(12,2) not null"),
    ({"type": "fixed", "name": "f", "size": 8, "logicalType": "decimal", "precision": 9}, "decimal(9,0) not null"),
    ({"type": "enum", "name": "e", "symbols": ["A"]}, "string not null"), ({"type": "fixed", "name": "f", "size": 3}, "binary not null"),
    ({"type": "array", "items": ["null", "int"]}, "array<int> not null"), ({"type": "map", "values": ["null", "long"]}, "map<string, bigint> not null"),
    (["int", "long"], "bigint not null"), (["float", "double", "null"], "double"), (["int", "string"], "struct<member0: int, member1: string> not null"),
    ({"type": "record", "name": "in", "fields": [{"name": "x", "type": ["null", "int"]}]}, "struct<x: int> not null"),
])
def test_types(spark, declared, wanted):
    found = avro_schema(io.BytesIO(container(record([("c", declared)]))))
    want = StructType.fromDDL(f"c {wanted}")
    assert found.simpleString() == want.simpleString() and found.fields[0].nullable == want.fields[0].nullable


def test_named_types_are_found_by_their_namespace(spark):
    place = {"type": "record", "name": "place", "namespace": "geo", "fields": [{"name": "x", "type": "int"}, {"name": "unit", "type": {"type": "enum", "name": "unit", "symbols": ["m"]}}]}
    found = avro_schema(io.BytesIO(container(record([("a", place), ("b", "geo.place"), ("u", "geo.unit")]))))
    assert found.simpleString() == "struct<a:struct<x:int,unit:string>,b:struct<x:int,unit:string>,u:string>"


@pytest.mark.parametrize("data", [
    b"", b"PAR1....", b"Obj\x01", container(record(CUSTOMER))[:60], container(b"{no json"), container("string"), container(record([("a", "unheard.of")])),
    container(record([("a", "row")])), b"Obj\x01" + b"\xff" * 11, container(record([("a", {"kind": 1})])),
])
def test_what_is_no_container_is_a_header_error(data):
    with pytest.raises(AvroHeaderError):
        avro_schema(io.BytesIO(data))


def test_contract_run_over_avro_files(spark, tmp_dir):
    def land(day, name, data):
        folder = f"{tmp_dir}/object=customer/year=2025/month=2/day={day}/b"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{name}.avro", "wb") as f:
            f.write(data)

    land(1, "good", container(record(CUSTOMER), records=b"\x02a" * 50))
    land(2, "more", container(record([*CUSTOMER, ("city", "string")])))
    land(2, "kind", container(record([*CUSTOMER[:2], ("age", "long"), CUSTOMER[3]])))
    land(3, "cut", container(record(CUSTOMER))[:40])
    land(3, "small", container(record([*CUSTOMER[:2], ("age", "int"), CUSTOMER[3]])))
    area = LandingArea(tmp_dir, "customer", "avro")
    contract = StructType.fromDDL("id string, name string, age int, country string")
    found = {r.path.rsplit("/", 1)[1]: r.reason for r in contract_breaches(spark, area, contract).collect()}
    assert found == {
        "more.avro": "unexpected column city string",
        "kind.avro": "type of age: expected int, got bigint",
        "cut.avro": "cannot read file: AvroHeaderError: the header is cut",
    }
    log = apply_data_contract(spark, area, contract, f"{tmp_dir}/log").collect()
    assert sorted(os.path.basename(r.new_file_path) for r in log) == sorted(found) and {r.move_status for r in log} == {"OK"}
    assert area.files(spark).count() == 2
