"""Offset operators (A3-A14, E13) on hand-made topics, edge rows included."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import make_topic
from topicframe.operators import offsets as off


@pytest.fixture()
def topic(spark):
    rows = [(0, o, "k", f"p0-{o}") for o in range(3, 8)]  # partition 0: 3..7
    rows += [(1, o, None, f"p1-{o}") for o in (0, 1, 5, 6)]  # offset gap in partition 1
    rows += [(2, 0, "x", None)]  # tombstone
    return make_topic(spark, rows)


def test_select_and_list_partitions(spark, topic):
    assert {r.partition for r in off.select_partitions(topic, [0, 2]).collect()} == {0, 2}
    assert off.select_partitions(topic, []).count() == topic.count()
    assert sorted(r.partition for r in off.list_partitions(topic).collect()) == [0, 1, 2]


def test_bounds(spark, topic):
    b = {r.partition: (r.earliest, r.latest) for r in off.partition_bounds(topic).collect()}
    assert b == {0: (3, 8), 1: (0, 7), 2: (0, 1)}


def test_start_offsets_saved_ledger_replaces_config(spark, topic):
    bounds = off.partition_bounds(topic)
    saved = spark.createDataFrame([(0, 5)], "partition int, next_offset bigint")
    got = {r.partition: r.start_offset for r in off.resolve_start_offsets(bounds, saved, {1: 1}, -1).collect()}
    assert got == {0: 5, 1: 0, 2: 0}  # partitions missing from the ledger start at earliest


def test_start_offsets_initial_and_sentinels(spark, topic):
    bounds = off.partition_bounds(topic)
    empty = spark.createDataFrame([], "partition int, next_offset bigint")
    starts = off.resolve_start_offsets(bounds, empty, {0: -2, 1: 5}, -1)
    r = {x.partition: (x.from_offset, x.until_offset) for x in off.resolve_sentinels(starts, bounds).collect()}
    assert r == {0: (3, 8), 1: (5, 7), 2: (1, 1)}


def test_sentinel_without_bounds_names_partition(spark, topic):
    bounds = off.partition_bounds(topic)
    starts = spark.createDataFrame([(0, -1), (9, -2)], "partition int, start_offset bigint")
    with pytest.raises(Exception, match="partition 9"):
        off.resolve_sentinels(starts, bounds).collect()


def test_slice_caps_and_estimate(spark, topic):
    ranges = spark.createDataFrame([(0, 4, 7), (1, 1, 7)], "partition int, from_offset bigint, until_offset bigint")
    got = sorted((r.partition, r.offset) for r in off.slice_offsets(topic, ranges).collect())
    assert got == [(0, 4), (0, 5), (0, 6), (1, 1), (1, 5), (1, 6)]
    capped = {r.partition: r.until_offset for r in off.cap_records(ranges, 2).collect()}
    assert capped == {0: 6, 1: 3}
    assert {r.until_offset for r in off.cap_records(ranges, -1).collect()} == {7}
    assert {r.partition: r.until_offset for r in off.cap_records(ranges, 100).collect()} == {0: 7, 1: 7}
    rate = {r.partition: r.until_offset for r in off.cap_rate(ranges, 1, 2).collect()}
    assert rate == {0: 6, 1: 3}
    assert off.cap_rate(ranges, 0).collect() == ranges.collect()
    est = {r.partition: r.est_bytes for r in off.estimate_read_bytes(ranges).collect()}
    assert est == {0: 3 * 1024, 1: 6 * 1024}


def test_order_and_sizes(spark, topic):
    pos = [(r.partition, r.offset, r.pos) for r in off.order_messages(topic).orderBy("pos").collect()]
    assert [p[2] for p in pos] == list(range(1, 11))
    assert [(p[0], p[1]) for p in pos] == sorted((p[0], p[1]) for p in pos)
    sizes = {r.partition: (r.n, r.bytes) for r in off.message_sizes(topic).collect()}
    assert sizes[0] == (5, 5 * 4) and sizes[2] == (1, 0)


def test_assign_offsets_continues_ledger(spark):
    msgs = spark.createDataFrame(
        [(0, b"a", b"1"), (0, b"b", b"2"), (1, b"c", b"3"), (1, b"d", b"4"), (1, b"e", b"5")],
        "partition int, key binary, value binary",
    ).withColumn("timestamp", F.current_timestamp())
    ledger = spark.createDataFrame([(1, 10)], "partition int, next_offset bigint")
    got = sorted((r.partition, r.offset, r.value) for r in off.assign_offsets(msgs, ledger, ["value"]).collect())
    assert got == [(0, 0, b"1"), (0, 1, b"2"), (1, 10, b"3"), (1, 11, b"4"), (1, 12, b"5")]


def test_bounds_with_known_empty_partitions(spark, topic):
    known = spark.createDataFrame([("t", 0, 8), ("t", 5, 12), ("t", 6, None)], "topic string, partition int, next_offset bigint")
    b = {r.partition: (r.topic, r.earliest, r.latest) for r in off.partition_bounds(topic, known).collect()}
    assert b[0] == ("t", 3, 8) and b[5] == ("t", 12, 12) and b[6] == ("t", None, None)
    plain = spark.createDataFrame([(7,)], "partition int")
    b2 = {r.partition: (r.earliest, r.latest) for r in off.partition_bounds(topic, plain).collect()}
    assert b2[7] == (0, 0) and b2[1] == (0, 7)


def test_kafka_ranges_become_options(spark):
    import json

    from topicframe.sources.kafka import kafka_range_options

    ranges = spark.createDataFrame([(0, 4, 7), (2, 0, 3)], "partition int, from_offset bigint, until_offset bigint")
    o = kafka_range_options({"brokers": "h:9092", "topic": "t"}, None, ranges)
    assert json.loads(o["assign"]) == {"t": [0, 2]}
    assert json.loads(o["startingOffsets"]) == {"t": {"0": 4, "2": 0}}
    assert json.loads(o["endingOffsets"]) == {"t": {"0": 7, "2": 3}}
    o2 = kafka_range_options({"brokers": "h:9092", "topic": "t"}, [2], {0: (1, 2), 2: (5, 9)})
    assert json.loads(o2["startingOffsets"]) == {"t": {"2": 5}}


def test_many_ranges_prefilter_and_join(spark):
    topic = make_topic(spark, [(p, o, None, f"{p}-{o}") for p in range(70) for o in range(4)])
    ranges = spark.createDataFrame([(p, 1, 3 if p % 2 else 2) for p in range(70)],
                                   "partition int, from_offset bigint, until_offset bigint")
    got = sorted((r.partition, r.offset) for r in off.slice_offsets(topic, ranges).collect())
    want = sorted((p, o) for p in range(70) for o in range(1, 3 if p % 2 else 2))
    assert got == want


def test_a_short_interval_never_stalls(spark):
    ranges = spark.createDataFrame([(0, 4, 9)], "partition int, from_offset bigint, until_offset bigint")
    assert off.cap_rate(ranges, 1, 0.5).first().until_offset == 5
    beyond = spark.createDataFrame([(0, 8, 5)], "partition int, from_offset bigint, until_offset bigint")
    assert off.cap_records(beyond, 3).first().until_offset == 8


def test_starts_carry_their_bounds_and_topics_stay_apart(spark, topic):
    bounds = off.partition_bounds(topic)
    saved = spark.createDataFrame([("t", 0, 5), ("u", 0, 1), ("u", 1, 2)], "topic string, partition int, next_offset bigint")
    starts = off.resolve_start_offsets(bounds, saved)
    assert {r.partition: r.start_offset for r in starts.collect()}[0] == 5
    assert starts.count() == bounds.count()  # another topic's rows multiply nothing
    only_other = off.resolve_start_offsets(bounds, saved.where("topic = 'u'"), default=-1)
    assert {r.start_offset for r in only_other.collect()} == {-1}
    plan = off.resolve_sentinels(starts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("Scan ExistingRDD") <= 3
