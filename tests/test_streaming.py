"""Streaming: restart resumes (checkpoint), ledger start, sink round trip."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import make_topic
from topicframe.operators import decode as dec
from topicframe.operators import encode as enc
from topicframe.operators.ledger import LedgerStore
from topicframe.sources.topic_table import TopicTable
from topicframe.streaming import stream as st

USER = "id bigint, first string, last string"


def _out(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("id", "first", "last").collect())


def test_restart_reads_only_new_messages(spark, tmp_dir):
    src = TopicTable(spark, f"{tmp_dir}/src", topic="t")
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    src.put(make_topic(spark, [(0, 0, "a", "1,samuel,jackson")]))

    def run():
        recs = dec.to_records(st.read_topic_stream(spark, src.path), USER, "csv")
        st.run_stream(recs, st.batch_folder_sink(out), ckpt)

    run()
    assert _out(spark, out) == [(1, "samuel", "jackson")]
    src.put(make_topic(spark, [(1, 0, "b", "2,dwayne,johnson")]))
    run()
    batches = spark.read.parquet(out).groupBy("batch_id").count().collect()
    assert len(batches) == 2 and all(b["count"] == 1 for b in batches)
    run()  # nothing new: no third batch
    assert spark.read.parquet(out).count() == 2


def test_state_resume_from_ledger(spark, tmp_dir):
    src = TopicTable(spark, f"{tmp_dir}/src", topic="t")
    src.put(make_topic(spark, [(0, i, None, v) for i, v in
                               enumerate(["1,samuel,jackson", "2,dwayne,johnson", "3,christopher,walken"])]))
    store = LedgerStore(spark, f"{tmp_dir}/ledger")
    store.save(spark.createDataFrame([("t", 0, 1)], "topic string, partition int, next_offset bigint"))
    out = f"{tmp_dir}/out"
    stream = st.read_topic_stream(spark, src.path, ledger=store.read())
    st.run_stream(stream, st.ledger_tracking_sink(store, st.batch_folder_sink(out)), f"{tmp_dir}/ckpt")
    rows = dec.to_records(spark.read.parquet(out), USER, "csv").collect()
    assert sorted(r.id for r in rows) == [2, 3]
    assert [r.next_offset for r in store.read().collect()] == [3]


def test_stream_sink_roundtrip_and_idempotent_replay(spark, tmp_dir):
    src = TopicTable(spark, f"{tmp_dir}/src", topic="t")
    src.put(make_topic(spark, [(0, 0, "a", "1,samuel,jackson"), (0, 1, "b", "2,dwayne,johnson")]))
    dst = TopicTable(spark, f"{tmp_dir}/dst", topic="copy")
    recs = dec.to_records(st.read_topic_stream(spark, src.path), f"{USER}, k string, p int", "csv",
                          key_field="k", partition_field="p")
    msgs = enc.to_messages(recs.withColumn("p", F.lit(3)), "copy", "json", key_field="k", partition_field="p")
    st.write_topic_stream(msgs, dst, f"{tmp_dir}/ckpt")
    first = sorted((r.partition, r.offset, bytes(r.value)) for r in dst.read().collect())
    assert [(p, o) for p, o, _ in first] == [(3, 0), (3, 1)]
    assert first[0][2].startswith(b'{"id":')
    # a replay of batch 0 (after a failure) is known by its writer and does nothing
    files = {r._1 for r in spark.read.parquet(dst.data_path).select("_metadata.file_path").distinct().toDF("_1").collect()}
    replay = dst.read().select("topic", "partition", "timestamp", "key", "value")
    replay = spark.createDataFrame(replay.collect(), replay.schema)
    assert dst.append(replay, batch_id=0, writer=f"{tmp_dir}/ckpt") == 0
    assert sorted((r.partition, r.offset, bytes(r.value)) for r in dst.read().collect()) == first
    assert {r._1 for r in spark.read.parquet(dst.data_path).select("_metadata.file_path").distinct().toDF("_1").collect()} == files


def _messages(spark, texts, p=0):
    return spark.createDataFrame([("t", p, None, t.encode()) for t in texts], "topic string, partition int, key binary, value binary").coalesce(1)


def _stored(table):
    return [(r.offset, r.value.decode()) for r in table.read().orderBy("partition", "offset").collect()]


def test_writers_do_not_overwrite_one_another(spark, tmp_dir):
    dst = TopicTable(spark, f"{tmp_dir}/dst", topic="t")
    dst.append(_messages(spark, ["a", "b", "c"]))
    src = TopicTable(spark, f"{tmp_dir}/src", topic="t")
    src.append(_messages(spark, ["d"]))
    for k in (1, 2):  # the second checkpoint begins at batch 0 again
        st.write_topic_stream(st.read_topic_stream(spark, src.path), dst, f"{tmp_dir}/ckpt{k}")
    assert _stored(dst) == [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "d")]


def test_a_replay_is_not_delivered_twice_downstream(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    for batch in (0, 0, 1, 1, 0):
        table.append(_messages(spark, [f"m{batch}"]), batch_id=batch, writer="w")
        st.run_stream(st.read_topic_stream(spark, table.path), st.batch_folder_sink(out), ckpt)
    assert sorted(r.value.decode() for r in spark.read.parquet(out).collect()) == ["m0", "m1"]


def test_only_committed_batches_are_read(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    table.append(_messages(spark, ["a"]))
    # a crash before the commit: files are staged, the log does not have them
    _messages(spark, ["lost"]).withColumns({"offset": F.lit(9), "timestamp": F.current_timestamp(), "timestampType": F.lit(0)}).write.partitionBy("partition").parquet(f"{table.path}/_staged/lost")
    from topicframe.sources.topic import read_topic

    assert [r.value.decode() for r in read_topic(spark, table.path).collect()] == ["a"]
    table.append(_messages(spark, ["b"]))
    assert _stored(table) == [(0, "a"), (1, "b")]
    # a crash after the log entry: whoever reads the log next finishes the commit
    from topicframe.session import rename

    rename(spark, f"{table.data_path}/batch_id=1", f"{table.path}/_staged/{table.commits()[1].id}")
    table = TopicTable(spark, table.path, topic="t")
    assert _stored(table) == [(0, "a"), (1, "b")]
    table.append(_messages(spark, ["c"]))
    assert _stored(table) == [(0, "a"), (1, "b"), (2, "c")]


def test_send_order_is_kept(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    table.append(_messages(spark, ["z", "m", "a"]))
    assert _stored(table) == [(0, "z"), (1, "m"), (2, "a")]


def test_two_topics_in_one_table(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t")
    both = _messages(spark, ["a", "b"]).unionByName(_messages(spark, ["x"]).withColumn("topic", F.lit("u")))
    table.append(both)
    table.append(both)
    got = sorted((r.topic, r.offset) for r in table.read().collect())
    assert got == [("t", 0), ("t", 1), ("t", 2), ("t", 3), ("u", 0), ("u", 1)]


def test_a_stream_that_is_not_done_in_time_says_so(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    table.append(_messages(spark, ["a"]))

    def slow(batch, batch_id):
        import time

        time.sleep(8)

    with pytest.raises(TimeoutError):
        st.run_stream(st.read_topic_stream(spark, table.path), slow, f"{tmp_dir}/ckpt", timeout_s=2)


def test_files_cover_disjoint_offsets(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = make_topic(spark, [(i % 2, i // 2, None, f"v{i}") for i in range(4000)]).repartition(5)
        table.put(frame)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    per_file = table.spark.read.parquet(table.data_path).groupBy("partition", "_metadata.file_path").agg(F.min("offset").alias("a"), F.max("offset").alias("b")).collect()
    for p in (0, 1):
        ends = sorted((r.a, r.b) for r in per_file if r.partition == p)
        assert all(x[1] < y[0] for x, y in zip(ends, ends[1:]))


def test_read_time_is_one_value_per_micro_batch(spark, tmp_dir):
    src = TopicTable(spark, f"{tmp_dir}/src", topic="t")
    src.put(make_topic(spark, [(0, 0, None, "1,a,b"), (1, 0, None, "2,c,d")]), batch_id=0)
    src.put(make_topic(spark, [(0, 1, None, "3,e,f"), (1, 1, None, "4,g,h")]), batch_id=1)
    out = f"{tmp_dir}/out"
    stream = st.read_topic_stream(spark, src.path, max_files_per_trigger=2)
    recs = dec.to_records(stream, f"{USER}, t bigint", "csv", time_field="t")
    st.run_stream(recs, st.batch_folder_sink(out), f"{tmp_dir}/ckpt")
    per_batch = spark.read.parquet(out).groupBy("batch_id").agg(F.countDistinct("t").alias("n"), F.count("*").alias("rows"))
    rows = per_batch.collect()
    assert len(rows) == 2 and all(r.n == 1 and r.rows == 2 for r in rows)
