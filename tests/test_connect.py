"""The reference's end-to-end scenarios, driven by configuration objects."""

import json

import pytest

from tests.conftest import make_topic
from topicframe.connect import open_bounded, open_source, write_sink
from topicframe.operators.ledger import LedgerStore
from topicframe.schema import ContractError, SinkConfig, SourceConfig
from topicframe.sources.topic_table import TopicTable
from topicframe.streaming.stream import batch_folder_sink, run_stream

USER = '{"type":"record","name":"etlSchemaBody","fields":[{"name":"id","type":"long"},' \
       '{"name":"first","type":"string"},{"name":"last","type":"string"}'
PEOPLE = [(1, 0, "a", "1,samuel,jackson"), (0, 0, "b", "2,dwayne,johnson"), (0, 1, "c", "3,christopher,walken")]


def _cfg(**kw):
    base = dict(brokers="localhost:9092", topic="t", max_rate=1000)
    base.update(kw)
    return SourceConfig(**base)


def test_csv_with_metadata_streaming(spark, tmp_dir):
    src = TopicTable(spark, f"{tmp_dir}/src", "t")
    src.put(make_topic(spark, PEOPLE))
    schema = USER + ',{"name":"key","type":"bytes"},{"name":"time","type":"long"},' \
                    '{"name":"partition","type":"int"},{"name":"offset","type":"long"}]}'
    cfg = _cfg(fmt="csv", schema=schema, key_field="key", time_field="time",
               partition_field="partition", offset_field="offset", default_offset=-2)
    out = f"{tmp_dir}/out"
    run_stream(open_source(spark, cfg, src), batch_folder_sink(out), f"{tmp_dir}/ckpt")
    rows = spark.read.parquet(out).collect()
    assert sorted((r.id, r.first, bytes(r.key), r.partition, r.offset) for r in rows) == [
        (1, "samuel", b"a", 1, 0), (2, "dwayne", b"b", 0, 0), (3, "christopher", b"c", 0, 1)]
    assert all(r.time > 0 for r in rows)


def test_raw_bytes_bounded(spark):
    topic = make_topic(spark, [(p, o, k, f"payload_{i + 1}") for i, (p, o, k, _) in enumerate(PEOPLE)])
    cfg = _cfg(schema="message binary, key binary, partition int, offset bigint", key_field="key",
               partition_field="partition", offset_field="offset")
    rows = open_source(spark, cfg, topic, streaming=False).collect()
    assert sorted((bytes(r.message), bytes(r.key), r.partition, r.offset) for r in rows) == [
        (b"payload_1", b"a", 1, 0), (b"payload_2", b"b", 0, 0), (b"payload_3", b"c", 0, 1)]


def test_registry_value_only(spark):
    user = json.loads(USER + "]}")
    reg = spark.createDataFrame([("t-value", 1, 7, json.dumps(user))], "subject string, version int, id int, schema string")
    frames = [b"\x00\x00\x00\x00\x07" + json.dumps({"id": i, "first": f, "last": l}).encode()
              for i, f, l in [(1, "samuel", "jackson"), (2, "dwayne", "johnson")]]
    topic = make_topic(spark, [(0, i, None, v) for i, v in enumerate(frames)])
    cfg = _cfg(registry=reg, value_field="message", avro_encoding="json")
    rows = open_source(spark, cfg, topic, streaming=False).collect()
    assert sorted((r.message.id, r.message.last) for r in rows) == [(1, "jackson"), (2, "johnson")]


def test_bounded_runs_with_ledger_and_cap(spark, tmp_dir):
    store = LedgerStore(spark, f"{tmp_dir}/ledger")
    topic = make_topic(spark, [(0, i, None, f"{i + 1},n{i},m{i}") for i in range(6)])
    cfg = _cfg(fmt="csv", schema="id bigint, first string, last string", bounded=True, max_records=4)
    recs, commit = open_bounded(spark, cfg, topic, store)
    assert sorted(r.id for r in recs.collect()) == [1, 2, 3, 4]
    commit()
    recs, commit = open_bounded(spark, cfg, topic, store)
    assert sorted(r.id for r in recs.collect()) == [5, 6]
    commit()
    assert [r.next_offset for r in store.read().collect()] == [6]


def test_sink_csv_key_partition(spark, tmp_dir):
    rows = [(1, "samuel", "jackson", "a", 0), (2, "dwayne", "johnson", "b", 1), (3, "christopher", "walken", "c", 1)]
    df = spark.createDataFrame(rows, "id bigint, first string, last string, key string, partition int")
    cfg = SinkConfig(brokers="localhost:9092", topic="out", fmt="csv", key_field="key", partition_field="partition")
    table = TopicTable(spark, f"{tmp_dir}/out", "out")
    write_sink(df, cfg, table)
    got = sorted((r.partition, r.offset, bytes(r.key), bytes(r.value)) for r in table.read().collect())
    assert got == [(0, 0, b"a", b"1,samuel,jackson"), (1, 0, b"b", b"2,dwayne,johnson"),
                   (1, 1, b"c", b"3,christopher,walken")]


def test_sink_registry_roundtrip(spark, tmp_dir):
    user = json.loads(USER.replace("etlSchemaBody", "message") + "]}")
    reg = spark.createDataFrame([("out-value", 1, 9, json.dumps(user)), ("out-key", 1, 4, '"string"')],
                                "subject string, version int, id int, schema string")
    df = spark.createDataFrame([((1, "samuel", "jackson"), "a", 0)],
                               "message struct<id:bigint,first:string,last:string>, key string, partition int")
    cfg = SinkConfig(brokers="localhost:9092", topic="out", key_field="key", partition_field="partition", registry=reg,
                     avro_encoding="json")
    table = TopicTable(spark, f"{tmp_dir}/out", "out")
    write_sink(df, cfg, table)
    src = _cfg(topic="out", registry=reg, value_field="message", offset_field="offset", key_field="key",
               avro_encoding="json", schema="offset bigint, key string, message struct<id:bigint,first:string,last:string>")
    back = open_source(spark, src, table.read(), streaming=False).collect()
    assert [(r.offset, r.key, r.message.first) for r in back] == [(0, "a", "samuel")]
    assert bytes(table.read().select("key").first().key) == b'\x00\x00\x00\x00\x04"a"'
    assert bytes(table.read().select("value").first().value)[:5] == b"\x00\x00\x00\x00\x09"


def test_avro_and_grok_formats_from_config(spark):
    topic = make_topic(spark, [(0, 0, "k", json.dumps({"id": 4, "first": "donald", "last": "duck"}))])
    # declared non-null fields, as in the schema text: DDL-like nullable ones would be unions
    cfg = _cfg(fmt="avro", format_options={"encoding": "json"}, schema=USER + ',{"name":"offset","type":"long"}]}', offset_field="offset")
    r = open_source(spark, cfg, topic, streaming=False).first()
    assert (r.id, r.first, r.last, r.offset) == (4, "donald", "duck", 0)
    logs = make_topic(spark, [(0, 0, None, "GET /a 200")])
    g = _cfg(fmt="grok", schema="verb string, path string, status int",
             pattern="%{WORD:verb} %{NOTSPACE:path} %{INT:status}")
    r = open_source(spark, g, logs, streaming=False).first()
    assert (r.verb, r.path, r.status) == ("GET", "/a", 200)
    with pytest.raises(ContractError, match="pattern"):
        _cfg(fmt="grok", schema="verb string").validate()


def _ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def _csv(i):
    return f"{i},n{i},m{i}"


def _people(spark, offsets, p=0):
    return make_topic(spark, [(p, o, None, _csv(o)) for o in offsets])


DDL = "id bigint, first string, last string"


def test_streams_start_where_the_config_says(spark, tmp_dir):
    src = TopicTable(spark, f"{tmp_dir}/src", "t")
    src.put(_people(spark, range(3)).unionByName(_people(spark, range(3), 1)))
    for name, kw, want in [("initial", dict(initial_offsets="0:2", default_offset=-2), [0, 1, 2, 2]), ("earliest", dict(default_offset=-2), [0, 0, 1, 1, 2, 2])]:
        stream = open_source(spark, _cfg(fmt="csv", schema=DDL, **kw), src)
        run_stream(stream, batch_folder_sink(f"{tmp_dir}/{name}"), f"{tmp_dir}/ck-{name}")
        assert _ids(spark, f"{tmp_dir}/{name}") == want
    # latest: the end at the first start; what comes before a restart is read by it
    starts = LedgerStore(spark, f"{tmp_dir}/starts")

    def run():
        stream = open_source(spark, _cfg(fmt="csv", schema=DDL), src, starts=starts)
        run_stream(stream, batch_folder_sink(f"{tmp_dir}/latest"), f"{tmp_dir}/ck-latest")

    run()
    src.put(_people(spark, [3]))
    run()
    assert _ids(spark, f"{tmp_dir}/latest") == [3]


def test_saved_offsets_behind_the_configured_source(spark, tmp_dir):
    """Offsets saved beside the records, then a new stream (no checkpoint) from the ledger alone."""
    from topicframe.streaming.stream import ledger_tracking_sink

    src = TopicTable(spark, f"{tmp_dir}/src", "t")
    src.put(_people(spark, range(2)))
    store = LedgerStore(spark, f"{tmp_dir}/ledger")
    store.save(spark.createDataFrame([("t", 0, 1), ("other", 0, 50)], "topic string, partition int, next_offset bigint"))
    out = f"{tmp_dir}/out"
    for k in (1, 2):
        stream = open_source(spark, _cfg(fmt="csv", schema=DDL, default_offset=-2), src, ledger=store.read(), keep_position=True)
        run_stream(stream, ledger_tracking_sink(store, batch_folder_sink(f"{out}/{k}")), f"{tmp_dir}/ck{k}")
        assert {r.topic: r.next_offset for r in store.read().collect()} == {"t": 1 + k, "other": 50}
        src.put(_people(spark, [2]) if k == 1 else _people(spark, []))
    assert _ids(spark, f"{out}/1") == [1] and _ids(spark, f"{out}/2") == [2]
    assert spark.read.parquet(f"{out}/1").columns == ["id", "first", "last", "batch_id"]


def test_bounded_reads_begin_at_the_earliest(spark, tmp_dir):
    topic = _people(spark, range(3)).unionByName(_people(spark, range(3), 1))
    for kw, want in [({}, 6), (dict(initial_offsets="0:2"), 4), (dict(default_offset=1), 4)]:
        assert open_source(spark, _cfg(fmt="csv", schema=DDL, **kw), topic, streaming=False).count() == want


def test_bounded_kafka_run_needs_bounds(spark, tmp_dir):
    store = LedgerStore(spark, f"{tmp_dir}/ledger")
    with pytest.raises(ContractError, match="earliest and latest"):
        open_bounded(spark, _cfg(fmt="csv", schema=DDL, bounded=True), None, store)


def test_messages_without_a_partition_are_dealt_by_key(spark, tmp_dir):
    df = spark.createDataFrame([(i, f"k{i % 7}") for i in range(70)], "id bigint, key string")
    cfg = SinkConfig(brokers="localhost:9092", topic="out", fmt="csv", key_field="key")
    with pytest.raises(ContractError, match="num_partitions"):
        write_sink(df, cfg, f"{tmp_dir}/out")
    cfg.num_partitions = 3
    write_sink(df, cfg, f"{tmp_dir}/out")
    rows = TopicTable(spark, f"{tmp_dir}/out", "out").read().collect()
    assert len(rows) == 70 and len({(bytes(r.key), r.partition) for r in rows}) == 7
    assert {r.partition for r in rows} <= {0, 1, 2}


def test_metadata_fields_with_a_logical_type_are_refused():
    schema = USER + ',{"name":"p","type":{"type":"int","logicalType":"time-millis"}}]}'
    with pytest.raises(ContractError, match="must be an int"):
        _cfg(fmt="csv", schema=schema, partition_field="p").validate()
