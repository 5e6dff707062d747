"""Edge rows the reference does not test (FIXTURES.md §3)."""

import zlib

import pytest

from tests.conftest import make_topic
from topicframe.operators import decode as dec
from topicframe.operators import encode as enc
from topicframe.operators import offsets as off
from topicframe.sources.topic_table import TopicTable


def test_csv_comma_damage_is_found(spark):
    # the csv encoder does not quote: a comma inside a field makes a long row
    df = spark.createDataFrame([(1, "plain", "x"), (2, "a,b", "y")], "id bigint, name string, tag string")
    msgs = enc.to_messages(df, "t", "csv")
    topic = msgs.select("key", "value", "topic", "partition", "timestamp")
    flagged = dec.split_malformed(topic, "csv", "id bigint, name string, tag string")
    assert sorted((r.id, r.malformed) for r in flagged.collect()) == [(1, False), (2, True)]
    # a quoted comma written by someone else decodes as one field
    quoted = make_topic(spark, [(0, 0, None, '3,"c,d",z')])
    assert dec.to_records(quoted, "id bigint, name string, tag string", "csv").first().name == "c,d"


def test_duplicate_offsets_ordered_by_checksum(spark):
    topic = make_topic(spark, [(0, 5, None, "bbb"), (0, 5, None, "aaa"), (0, 4, None, "zzz")])
    got = [r.value.decode() for r in off.order_messages(topic).orderBy("pos").collect()]
    dup = sorted(["aaa", "bbb"], key=lambda v: zlib.crc32(v.encode()))
    assert got == ["zzz"] + dup


def test_topic_table_refuses_unrouted_messages(spark, tmp_dir):
    df = spark.createDataFrame([(1, None)], "id bigint, p int")
    msgs = enc.to_messages(df, "t", "csv", partition_field="p")
    with pytest.raises(Exception, match="target partition"):
        TopicTable(spark, f"{tmp_dir}/t", "t").append(msgs)
    routed = enc.to_messages(df, "t", "csv", partition_field="p", num_partitions=3)
    table = TopicTable(spark, f"{tmp_dir}/t2", "t")
    table.append(routed)
    assert table.read().first().partition in (0, 1, 2)


def test_empty_second_batch_keeps_ledger(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", "t")
    first = enc.to_messages(spark.createDataFrame([(1, 0)], "id bigint, p int"), "t", "csv", partition_field="p")
    table.append(first)
    table.append(first.limit(0))
    assert [(r.partition, r.next_offset) for r in table.next_offsets().collect()] == [(0, 1)]
    assert table.versions() == [0, 1]
    assert table.read().count() == 1
