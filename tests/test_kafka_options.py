"""Kafka option builders (the connector jar is not loaded in tests)."""

import json

import pytest

from topicframe.schema import ContractError
from topicframe.sources.kafka import kafka_read_options, kafka_write_options


def test_read_options_assign_and_offsets():
    with pytest.warns(UserWarning, match=r"\[3\]"):
        o = kafka_read_options("h:9092", "t", partitions="0,2", initial_offsets="0:5,3:9", default_offset=-1,
                               spark_options={"minPartitions": 64}, streaming=True)
    assert o["minPartitions"] == "64"
    assert json.loads(o["assign"]) == {"t": [0, 2]}
    assert json.loads(o["startingOffsets"]) == {"t": {"0": 5, "2": -1}}  # 3 is outside the selection
    assert o["kafka.bootstrap.servers"] == "h:9092" and o["kafka.retry.backoff.ms"] == "500"


def test_saved_offsets_win_and_rate():
    o = kafka_read_options("h:9092", "t", initial_offsets="0:5", saved_offsets={0: 9, 1: 4},
                           max_rate=1000, partition_count=2, streaming=True)
    assert json.loads(o["startingOffsets"]) == {"t": {"0": 9, "1": 4}}
    assert o["maxOffsetsPerTrigger"] == "2000" and o["subscribe"] == "t"


def test_security_and_user_options():
    o = kafka_read_options("h:9092", "t", cluster_key="k", cluster_secret="s", kafka_options="fetch.max.bytes:100")
    assert o["kafka.security.protocol"] == "SASL_SSL" and 'username="k"' in o["kafka.sasl.jaas.config"]
    assert o["kafka.fetch.max.bytes"] == "100"
    with pytest.raises(ContractError):
        kafka_read_options("h:9092", "t", kafka_options={"enable.auto.commit": "true"})
    with pytest.raises(ContractError):
        kafka_read_options("h:9092", "t", partitions="x")


def test_write_options():
    o = kafka_write_options("h:9092", "t", is_async=True, compression="gzip")
    assert o["kafka.compression.type"] == "gzip" and o["kafka.acks"] == "1" and o["topic"] == "t"
    with pytest.raises(ContractError):
        kafka_write_options("h:9092", "t", compression="zstd")


def test_every_partition_is_named():
    o = kafka_read_options("h:9092", "t", initial_offsets="1:5", partition_count=3, default_offset=-1, streaming=True)
    assert json.loads(o["startingOffsets"]) == {"t": {"0": -1, "1": 5, "2": -1}}
    with pytest.raises(ContractError, match="partition_count"):
        kafka_read_options("h:9092", "t", initial_offsets="1:5", streaming=True)
    o = kafka_read_options("h:9092", "t", default_offset=7, partition_count=2, streaming=True)
    assert json.loads(o["startingOffsets"]) == {"t": {"0": 7, "1": 7}}


def test_saved_offsets_stay_inside_the_selection():
    with pytest.warns(UserWarning, match=r"saved offsets of partitions \[7\]"):
        o = kafka_read_options("h:9092", "t", partitions=[0, 1], saved_offsets={0: 3, 7: 9}, streaming=True)
    assert json.loads(o["startingOffsets"]) == {"t": {"0": 3, "1": -2}}  # missing ones start at the earliest


def test_bounded_reads_never_start_at_latest():
    o = kafka_read_options("h:9092", "t", partitions=[0, 1], initial_offsets="0:5", default_offset=-1)
    assert json.loads(o["startingOffsets"]) == {"t": {"0": 5, "1": -2}}
    assert kafka_read_options("h:9092", "t")["startingOffsets"] == "earliest"
    with pytest.raises(ContractError, match="latest"):
        kafka_read_options("h:9092", "t", partitions=[0], initial_offsets="0:-1")


def test_rate_is_per_partition_or_left_out():
    with pytest.warns(UserWarning, match="per partition"):
        assert "maxOffsetsPerTrigger" not in kafka_read_options("h:9092", "t", max_rate=1000, streaming=True)
    o = kafka_read_options("h:9092", "t", partitions="0,1,2", max_rate=1, batch_interval_s=0.1, streaming=True)
    assert o["maxOffsetsPerTrigger"] == "1"
    o = kafka_read_options("h:9092", "t", partitions="0,1,2", max_rate=10, batch_interval_s=2, streaming=True)
    assert o["maxOffsetsPerTrigger"] == "60"
