"""Ledger codec and store; the reference's batch sequence 3 → cap 2 → 5 → 6."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import make_topic
from topicframe.operators import ledger as led
from topicframe.streaming.incremental import run_incremental

PEOPLE = ["1,samuel,jackson", "2,dwayne,johnson", "3,christopher,walken",
          "4,donald,duck", "5,mickey,mouse", "6,michael,jackson"]


def test_json_roundtrip(spark):
    ledger = spark.createDataFrame([("t", 0, 3), ("t", 1, 7)], "topic string, partition int, next_offset bigint")
    js = led.ledger_to_json(ledger).collect()[0]
    assert js.ledger_json == '{"partitionOffsets":{"0":3,"1":7}}'
    back = led.ledger_from_json(led.ledger_to_json(ledger))
    assert sorted((r.partition, r.next_offset) for r in back.collect()) == [(0, 3), (1, 7)]


def test_upsert_keeps_untouched_partitions(spark):
    prev = spark.createDataFrame([(0, 5), (1, 7)], "partition int, next_offset bigint")
    ranges = spark.createDataFrame([(0, 5, 9), (2, 0, 4)], "partition int, from_offset bigint, until_offset bigint")
    got = sorted(tuple(r) for r in led.ledger_upsert(prev, ranges).collect())
    assert got == [(0, 9), (1, 7), (2, 4)]


def test_store_absent_bad_and_versions(spark, tmp_dir):
    store = led.LedgerStore(spark, f"{tmp_dir}/ledger")
    assert store.read().count() == 0
    l1 = spark.createDataFrame([("t", 0, 3)], "topic string, partition int, next_offset bigint")
    assert store.save(l1) == 0
    assert store.save(l1.withColumn("next_offset", F.lit(5).cast("bigint"))) == 1
    assert [r.next_offset for r in store.read().collect()] == [5]
    assert [r.next_offset for r in store.read(before=1).collect()] == [3]
    assert led.ledger_path("/d", "ns", "p") == "/d/ns.p.offsets.json"
    bad = led.LedgerStore(spark, f"{tmp_dir}/bad")
    spark.createDataFrame([("not json",)], "value string").write.text(f"{tmp_dir}/bad/v=0")
    with pytest.raises(Exception):
        bad.read().collect()


def test_batch_incremental_sequence(spark, tmp_dir):
    store = led.LedgerStore(spark, f"{tmp_dir}/ledger")
    seen = []

    def sink(df):
        seen.append(sorted(r.value.decode() for r in df.collect()))

    def next_offset():
        return [r.next_offset for r in store.read().collect()]

    topic = make_topic(spark, [(0, i, None, PEOPLE[i]) for i in range(3)])
    run_incremental(topic, store, sink)
    assert seen[-1] == PEOPLE[:3] and next_offset() == [3]
    topic = make_topic(spark, [(0, i, None, PEOPLE[i]) for i in range(6)])
    run_incremental(topic, store, sink, max_records=2)
    assert seen[-1] == PEOPLE[3:5] and next_offset() == [5]
    run_incremental(topic, store, sink)
    assert seen[-1] == ["6,michael,jackson"] and next_offset() == [6]
    run_incremental(topic, store, sink)  # nothing new
    assert seen[-1] == [] and next_offset() == [6]


def test_resume_from_ledger(spark):
    topic = make_topic(spark, [(0, i, None, "x") for i in range(5)] + [(1, i, None, "y") for i in range(2)])
    ledger = spark.createDataFrame([(0, 3)], "partition int, next_offset bigint")
    got = sorted((r.partition, r.offset) for r in led.resume_from_ledger(topic, ledger).collect())
    assert got == [(0, 3), (0, 4), (1, 0), (1, 1)]


def test_ledgers_of_two_topics(spark):
    ledger = spark.createDataFrame([("t", 0, 3), ("u", 0, 1)], "topic string, partition int, next_offset bigint")
    topic = make_topic(spark, [(0, i, None, "x") for i in range(5)])
    assert sorted(r.offset for r in led.resume_from_ledger(topic, ledger).collect()) == [3, 4]
    from topicframe.operators.offsets import assign_offsets

    assert sorted(r.offset for r in assign_offsets(topic.limit(2), ledger).collect()) == [3, 4]


def test_old_versions_are_pruned(spark, tmp_dir):
    store = led.LedgerStore(spark, f"{tmp_dir}/ledger")
    for k in range(led.KEPT_VERSIONS + 3):
        store.save(spark.createDataFrame([("t", 0, k)], "topic string, partition int, next_offset bigint"))
    assert len(store.versions()) == led.KEPT_VERSIONS
    assert store.read().first().next_offset == led.KEPT_VERSIONS + 2


def test_initial_offset_beyond_the_end_is_kept(spark, tmp_dir):
    store = led.LedgerStore(spark, f"{tmp_dir}/ledger")
    topic = make_topic(spark, [(0, i, None, str(i)) for i in range(10)])
    seen = []
    for part in (topic.where("offset < 5"), topic):
        run_incremental(part, store, lambda df: seen.append(sorted(r.offset for r in df.collect())), initial={0: 8})
    assert seen == [[], [8, 9]]
