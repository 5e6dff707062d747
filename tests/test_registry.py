"""Registry frames, registry-driven Avro decode/encode, latest schemas."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicframe.operators import registry as reg
from topicframe.schema import ContractError

USER = {"type": "record", "name": "user", "fields": [
    {"name": "id", "type": "long"}, {"name": "first", "type": "string"}, {"name": "last", "type": "string"}]}


def _registry(spark):
    rows = [("t-key", 1, 11, json.dumps("string")), ("t-value", 1, 21, json.dumps(USER)),
            ("t-value", 2, 22, json.dumps({**USER, "fields": USER["fields"] + [{"name": "age", "type": ["null", "int"], "default": None}]}))]
    return spark.createDataFrame(rows, "subject string, version int, id int, schema string")


def _frame(sid, value):
    """A framed datum in Avro's JSON encoding."""
    return b"\x00" + sid.to_bytes(4, "big") + json.dumps(value).encode()


def test_frame_split(spark):
    df = spark.createDataFrame([(b"\x00\x00\x00\x01\xf4abc",), (b"\x00\xff\xff\xff\xfe",)], "value binary")
    rows = reg.split_registry_frame(df).collect()
    assert (rows[0].magic, rows[0].schema_id, bytes(rows[0].body)) == (0, 500, b"abc")
    assert rows[1].schema_id == -2 and bytes(rows[1].body) == b""


def test_latest_and_inferred_schema(spark):
    r = _registry(spark)
    latest = {x.subject: x.id for x in reg.latest_schemas(r).collect()}
    assert latest == {"t-key": 11, "t-value": 22}
    s = reg.infer_output_schema(r, "t", key_field="key", value_field="message")
    assert s["key"].dataType == T.StringType()
    assert s["message"].dataType.fieldNames() == ["id", "first", "last", "age"]
    assert reg.infer_output_schema(r, "t", value_field="message").fieldNames() == ["message"]


def test_registry_meta_fixture(spark):
    """Key and value both registry-framed; writer v1 read with v2 (age = null)."""
    people = [(0, 0, "a", 1, "samuel", "jackson"), (0, 1, "b", 2, "dwayne", "johnson"), (1, 0, "c", 3, "christopher", "walken")]
    rows = [(_frame(11, k), _frame(21, {"id": i, "first": f, "last": l}), p, o)
            for p, o, k, i, f, l in people]
    df = spark.createDataFrame(rows, "key binary, value binary, partition int, offset bigint")
    out = reg.decode_registry_avro(df, _registry(spark), "t", value_field="message", key_field="key", encoding="json")
    got = sorted((r.key, r.message.id, r.message.first, r.message.age, r.partition, r.offset) for r in out.collect())
    assert got == [("a", 1, "samuel", None, 0, 0), ("b", 2, "dwayne", None, 0, 1), ("c", 3, "christopher", None, 1, 0)]


def test_unframed_payload_fails(spark):
    df = spark.createDataFrame([(b"\x05\x00\x00\x00\x15xx", 0, 0)], "value binary, partition int, offset bigint")
    with pytest.raises(Exception, match="not registry framed"):
        reg.decode_registry_avro(df, _registry(spark), "t", "message", encoding="json").collect()
    other = spark.createDataFrame([(_frame(99, {"id": 1}),)], "value binary")
    with pytest.raises(Exception, match="99 is not a version"):
        reg.decode_registry_avro(other, _registry(spark), "t", "message", encoding="json").collect()


def test_binary_avro_needs_the_module(spark):
    df = spark.createDataFrame([(b"x",)], "value binary")
    with pytest.raises(ContractError, match="spark-avro"):
        reg.decode_avro(df, json.dumps(USER))
    with pytest.raises(ContractError, match="spark-avro"):
        reg.decode_registry_avro(df, _registry(spark), "t", "message")


def test_encode_then_decode_registry(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id bigint, first string, last string")
    df = df.select(F.struct("id", "first", "last", F.lit(None).cast("int").alias("age")).alias("message"))
    r = _registry(spark)
    framed = df.select(reg.encode_registry_avro(df, r, "t", "message", encoding="json").alias("value"))
    assert {bytes(x.value)[:5] for x in framed.collect()} == {b"\x00\x00\x00\x00\x16"}
    back = reg.decode_registry_avro(framed, r, "t", "message", encoding="json").select("message.*").collect()
    assert sorted((x.id, x.first, x.last) for x in back) == [(1, "a", "b"), (2, "c", "d")]
    nulls = spark.createDataFrame([(3, "e", None)], "id bigint, first string, last string")
    nulls = nulls.select(F.struct("id", "first", "last", F.lit(None).cast("int").alias("age")).alias("message"))
    with pytest.raises(Exception, match="non-nullable"):
        nulls.select(reg.encode_registry_avro(nulls, r, "t", "message", encoding="json")).collect()


def test_bare_avro_roundtrip_nested_types(spark):
    df = spark.createDataFrame([(1, [1, 2], {"k": 1.5}, ("x", 3))],
                               "id bigint, xs array<int>, m map<string,double>, s struct<a:string,b:int>")
    rec = df.select(F.struct(*df.columns).alias("r"))
    datums = rec.select(reg.encode_avro(rec, "r", "json").alias("value"))
    back = reg.decode_avro(datums, rec.schema["r"].dataType, encoding="json").collect()[0]
    assert (back.id, back.xs, back.m, back.s.a, back.s.b) == (1, [1, 2], {"k": 1.5}, "x", 3)


def test_non_record_field_refused(spark):
    df = spark.createDataFrame([("x",)], "message string")
    with pytest.raises(Exception, match="record"):
        reg.encode_registry_avro(df, _registry(spark), "t", "message")


def test_registry_meta_through_to_records(spark):
    from topicframe.operators import decode as dec

    rows = [(_frame(11, "a"), _frame(22, {"id": 1, "first": "samuel", "last": "jackson", "age": {"int": 7}}), 1, 0)]
    df = spark.createDataFrame(rows, "key binary, value binary, partition int, offset bigint")
    out = dec.to_records(df, None, registry=_registry(spark), topic="t", value_field="message", key_field="key",
                         time_field="time", partition_field="partition", offset_field="offset", batch_time=5, encoding="json")
    assert out.columns == ["time", "partition", "offset", "key", "message"]
    r = out.collect()[0]
    assert (r.time, r.partition, r.offset, r.key, r.message.first, r.message.age) == (5, 1, 0, "a", "samuel", 7)
