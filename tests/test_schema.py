"""Schema parsing, Avro mapping and the configuration contract (reference config tests)."""

import pytest
from pyspark.sql import types as T

from topicframe.schema import (
    DEFAULT_SCHEMA,
    ContractError,
    SinkConfig,
    SourceConfig,
    avro_to_spark,
    message_schema,
    parse_schema,
    spark_to_avro,
)

STRING_MSG = T.StructType([T.StructField("message", T.StringType())])


def _source(**kw):
    base = dict(brokers="hostname:9092", topic="topic-1", partitions="1", max_rate=1000, fmt="text", schema=None)
    base.update(kw)
    return SourceConfig(**base)


def _sink(**kw):
    base = dict(brokers="hostname:9092", topic="topic-1", fmt="csv")
    base.update(kw)
    return SinkConfig(**base)


@pytest.mark.parametrize("key,secret,failures", [(None, None, 0), ("k", "s", 0), ("k", None, 1), (None, "s", 1)])
def test_source_key_secret(key, secret, failures):
    cfg = _source(cluster_key=key, cluster_secret=secret)
    if failures:
        with pytest.raises(ContractError) as e:
            cfg.validate()
        assert len(e.value.failures) == failures
    else:
        assert cfg.validate() == DEFAULT_SCHEMA


@pytest.mark.parametrize("key,secret,failures", [(None, None, 0), ("k", "s", 0), ("k", None, 1), (None, "s", 1)])
def test_sink_key_secret(key, secret, failures):
    cfg = _sink(cluster_key=key, cluster_secret=secret)
    if failures:
        with pytest.raises(ContractError) as e:
            cfg.validate(STRING_MSG)
        assert len(e.value.failures) == failures
    else:
        assert cfg.validate(STRING_MSG) == STRING_MSG


def test_source_rules_collected_together():
    schema = "time string, key int, message binary"
    with pytest.raises(ContractError) as e:
        _source(brokers="host:port", partitions="1,x", initial_offsets="0:1,2:z", max_rate=-1, fmt=None,
                schema=schema, time_field="time", key_field="key", offset_field="nope").validate()
    text = " ".join(e.value.failures)
    for part in ("port", "partitions", "offset 'z'", "max rate", "time field", "key field", "offset field"):
        assert part in text
    with pytest.raises(ContractError, match="exactly one bytes"):
        _source(fmt=None, schema="message string").validate()
    assert _source(fmt=None, schema="message binary, k binary", key_field="k").validate()


def test_sink_rules():
    with pytest.raises(ContractError, match="csv or json"):
        _sink(fmt="xml").validate(STRING_MSG)
    with pytest.raises(ContractError, match="bytes"):
        _sink(fmt=None).validate(STRING_MSG)
    with pytest.raises(ContractError, match="exactly one field"):
        _sink(fmt=None, registry=object()).validate(T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]))


def test_parse_schema_forms(spark):
    js = '{"type":"record","name":"r","fields":[{"name":"id","type":"long"},{"name":"n","type":["null","string"]},' \
         '{"name":"tags","type":{"type":"array","items":"string"}},{"name":"d","type":{"type":"int","logicalType":"date"}},' \
         '{"name":"u","type":{"type":"record","name":"u","fields":[{"name":"x","type":"double"}]}}]}'
    s = parse_schema(js)
    assert s["id"].dataType == T.LongType() and not s["id"].nullable
    assert s["n"].nullable and s["tags"].dataType == T.ArrayType(T.StringType(), False)
    assert s["d"].dataType == T.DateType() and isinstance(s["u"].dataType, T.StructType)
    assert parse_schema("") == DEFAULT_SCHEMA
    assert parse_schema("string") == T.StructType([T.StructField("message", T.StringType())])
    assert parse_schema("a int, b string").fieldNames() == ["a", "b"]
    back, _ = avro_to_spark(spark_to_avro(s))
    assert back.fieldNames() == s.fieldNames()


def test_message_schema_split():
    s = parse_schema("a int, k string, b string")
    assert message_schema(s, "k", None).fieldNames() == ["a", "b"]
    with pytest.raises(ContractError):
        message_schema(parse_schema("k string"), "k")
