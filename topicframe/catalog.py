"""

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the given tables (the events topic ``T`` and side frames derived from it).
``ORACLES`` holds the DuckDB SQL of the same result for each key that has
one. Builders that stream or write (round trips, incremental runs) do that
work when called, in fresh folders under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicframe.connect import open_source, write_sink
from topicframe.functions.columns import delimited
from topicframe.operators import decode as dec
from topicframe.operators import encode as enc
from topicframe.operators import ledger as led
from topicframe.operators import offsets as off
from topicframe.operators import registry as reg
from topicframe.schema import SinkConfig, SourceConfig
from topicframe.session import work_dir
from topicframe.sources.registry_table import EVENTS_SCHEMA_BASE_ID, registry_table
from topicframe.sources.events import (
    documents_topic_table,
    events_props_topic_table,
    events_topic,
    events_topic_table,
    pages_topic_table,
)
from topicframe.sources.topic import read_topic
from topicframe.sources.sink import write_topic
from topicframe.sources.topic_table import TopicTable
from topicframe.streaming import stream as st
from topicframe.streaming.incremental import run_incremental, run_into_table, run_paced

# The declared record schema of the events topic payload.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), True),
    ]
)
EVENT_COLS = EVENT_SCHEMA.fieldNames()
# Fixed values of the test set-up (FIXTURES.md): saved ledger, initial offsets, caps.
LEDGER_ROWS = {0: 5, 1: 7}
INITIAL_OFFSETS = {2: -2, 3: 10}
DEFAULT_OFFSET = -1
RATE, RATE_INTERVAL_S = 100, 2
RECORD_CAP = 3
PINNED_READ_MS = 1700000000000
INCREMENTAL_START, INCREMENTAL_CAP = 50, 50
PACED_RATE, PACED_INTERVAL_S = 1000, 2
PACED_AHEAD = 8  # its sink writes a folder of each run's own
SPLIT_BYTES = 64 << 10
FAR_OFFSET = 1_000_000
SYSLOG_YEAR = 2024

Builder = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf: str, payload: str = "csv") -> DataFrame:
    """The events topic (stored once per session, see ``sources.events``)."""
    return events_topic(spark, sf, payload)


def _records(t: DataFrame, **meta) -> DataFrame:
    """T's csv payload decoded into the event fields (+ requested metadata)."""
    fields = list(EVENT_SCHEMA.fields)
    extra = {
        "key_field": T.StructField(meta.get("key_field") or "", T.StringType(), True),
        "partition_field": T.StructField(meta.get("partition_field") or "", T.IntegerType(), True),
        "offset_field": T.StructField(meta.get("offset_field") or "", T.LongType(), True),
        "time_field": T.StructField(meta.get("time_field") or "", T.LongType(), True),
    }
    for k, f in extra.items():
        if meta.get(k):
            fields.append(f)
    return dec.to_records(t, T.StructType(fields), "csv", **meta)


def _ledger(spark: SparkSession) -> DataFrame:
    return off.offsets_frame(spark, LEDGER_ROWS, "next_offset")


def _bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds of the events topic from its table's log: no message is read."""
    return events_topic_table(spark, sf).bounds()


def _ranges(spark: SparkSession, sf: str) -> DataFrame:
    starts = off.resolve_start_offsets(_bounds(spark, sf), None, INITIAL_OFFSETS, DEFAULT_OFFSET)
    return off.resolve_sentinels(starts)


def _text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


# ------------------------------------------------------------------ scans (A)


def q_topic_scan(spark, sf):
    return _text(read_topic(spark, _t(spark, sf)), "key", "value").select("topic", "partition", "offset", "key", "value")


def q_select_partitions(spark, sf):
    return read_topic(spark, _t(spark, sf), partitions=[0, 2]).select("partition", "offset")


def q_list_partitions(spark, sf):
    return off.list_partitions(_t(spark, sf))


def q_earliest_offsets(spark, sf):
    return off.earliest_offsets(_bounds(spark, sf))


def q_latest_offsets(spark, sf):
    return off.latest_offsets(_bounds(spark, sf))


def q_resolve_start_offsets(spark, sf):
    starts = off.resolve_start_offsets(_bounds(spark, sf), _ledger(spark), INITIAL_OFFSETS, DEFAULT_OFFSET)
    return starts.select("partition", "start_offset")


def q_resolve_sentinels(spark, sf):
    return _ranges(spark, sf).select("partition", "from_offset")


def q_slice_offsets(spark, sf):
    table = events_topic_table(spark, sf)
    return _text(table.slice(_ranges(spark, sf)), "value").select("partition", "offset", "value")


def q_slice_uneven(spark, sf):
    """Partition 0 early, partition 1 a million offsets on: each has its own interval, and only files that hold one are read."""
    t = _t(spark, sf)
    far = t.withColumn("offset", F.when(F.col("partition") == 1, F.col("offset") + FAR_OFFSET).otherwise(F.col("offset")))
    table = TopicTable(spark, work_dir(spark, "uneven"), topic="events")
    table.put(far)
    ranges = spark.createDataFrame([(0, 10, 60), (1, FAR_OFFSET + 20, 2 * FAR_OFFSET)], "partition int, from_offset long, until_offset long")
    return _text(table.slice(ranges), "value").select("partition", "offset", "value")


def q_read_splits(spark, sf):
    """Web pages as a topic, cut into ranges of about 64 KiB: a hot partition is many splits."""
    return off.read_splits(pages_topic_table(spark, sf).read(), SPLIT_BYTES).select("partition", "split", "from_offset", "until_offset", "n", "bytes")


def q_running_bytes(spark, sf):
    return off.running_bytes(_t(spark, sf)).select("partition", "offset", "bytes", "running")


def q_rate_capped_ranges(spark, sf):
    r = off.cap_rate(_ranges(spark, sf), RATE, RATE_INTERVAL_S)
    return r.select("partition", "from_offset", "until_offset")


def q_record_capped_read(spark, sf):
    r = off.cap_records(_ranges(spark, sf), RECORD_CAP)
    return _text(read_topic(spark, events_topic_table(spark, sf), ranges=r), "value").select("partition", "offset", "value")


def q_estimate_read_bytes(spark, sf):
    return off.estimate_read_bytes(_ranges(spark, sf)).select("partition", "est_bytes")


def q_ordered_messages(spark, sf):
    light = _t(spark, sf).select("partition", "offset", F.crc32("value").alias("crc"))
    return off.order_messages(light).select("partition", "offset", "pos")


def q_bytes_by_partition(spark, sf):
    return off.message_sizes(_t(spark, sf))


# ------------------------------------------------------------------ projections (B)


def q_with_read_time(spark, sf):
    return dec.with_read_time(_t(spark, sf), "read_ms", PINNED_READ_MS).select("partition", "offset", "read_ms")


def q_with_key(spark, sf):
    return _records(_t(spark, sf), key_field="k", partition_field="partition", offset_field="offset").select(
        "k", "partition", "offset"
    )


def q_with_metadata(spark, sf):
    return _records(_t(spark, sf), partition_field="p", offset_field="o").select("p", "o")


def q_message_fields(spark, sf):
    schema = T.StructType(
        [T.StructField("k", T.StringType()), *EVENT_SCHEMA.fields, T.StructField("p", T.IntegerType()),
         T.StructField("o", T.LongType()), T.StructField("read_ms", T.LongType())]
    )
    msg = dec.message_schema(schema, "read_ms", "k", "p", "o")
    recs = dec.to_records(_t(spark, sf), schema, "csv", time_field="read_ms", key_field="k",
                          partition_field="p", offset_field="o")
    return recs.select(*msg.fieldNames())


def q_raw_payload(spark, sf):
    recs = dec.to_records(_t(spark, sf), "message binary", None)
    return recs.select(F.hex("message").alias("message"))


def q_nested_value(spark, sf):
    schema = T.StructType([T.StructField("message", EVENT_SCHEMA), T.StructField("offset", T.LongType())])
    recs = dec.to_records(_t(spark, sf), schema, "csv", offset_field="offset", value_field="message")
    return recs.select(F.to_json("message").alias("message"), "offset")


def q_topic_to_records(spark, sf):
    """Flagship: topic → typed records (text key, partition, offset, csv fields)."""
    return _records(_t(spark, sf), key_field="k", partition_field="partition", offset_field="offset").select(
        "k", "partition", "offset", *EVENT_COLS
    )


# ------------------------------------------------------------------ decoders (C)


def q_decode_tsv(spark, sf):
    return dec.to_records(_t(spark, sf, "tsv"), EVENT_SCHEMA, "tsv")


def q_decode_json(spark, sf):
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    recs = dec.to_records(_t(spark, sf, "json"), schema, "json")
    return recs.select("event_id", "user_id", "event_type", F.col("value").alias("amount"))


def q_decode_text(spark, sf):
    return dec.to_records(_t(spark, sf, "text"), None, "text")


def q_decode_clf(spark, sf):
    schema = "host string, ident string, authuser string, at timestamp, request string, status int, bytes bigint"
    recs = dec.to_records(_t(spark, sf, "clf"), schema, "clf")
    return recs.select("host", "authuser", "at", "request", "status", "bytes")


def q_decode_syslog(spark, sf):
    schema = "facility int, severity int, host string, app string, pid bigint, msg string"
    return dec.to_records(_t(spark, sf, "syslog"), schema, "syslog")


GROK_SYSLOG = r"<%{POSINT:priority}>%{SYSLOGTIMESTAMP:timestamp} %{IPORHOST:host} %{PROG:app}\[%{NONNEGINT:pid}\]: %{GREEDYDATA:msg}"


def q_decode_grok(spark, sf):
    schema = "priority int, host string, app string, pid bigint, msg string"
    return dec.to_records(_t(spark, sf, "syslog"), schema, "grok", pattern=GROK_SYSLOG)


def q_decode_syslog_time(spark, sf):
    """The line's time, which has no year, as a timestamp of a given year."""
    recs = dec.to_records(_t(spark, sf, "syslog"), "timestamp timestamp, host string, pid bigint", "syslog", options={"year": SYSLOG_YEAR})
    return recs.select(F.col("timestamp").alias("at"), "host", "pid")


def q_grok_malformed(spark, sf):
    """Every third line damaged: fields null and flagged, the others as they are."""
    t = _t(spark, sf, "syslog").select("value", F.regexp_extract(F.col("value").cast("string"), r"\[(\d+)\]", 1).cast("bigint").alias("event_id"))
    damaged = t.withColumn("value", F.when(F.col("event_id") % 3 == 0, F.lit("broken line").cast("binary")).otherwise(F.col("value")))
    return dec.split_malformed(damaged, "grok", "host string, pid bigint, msg string", flag="bad", pattern=GROK_SYSLOG).drop("value")


def q_malformed_rows(spark, sf):
    t = _t(spark, sf).withColumn("_f", dec.payload_struct("value", "csv", EVENT_SCHEMA))
    short = delimited(["_f.event_id", "_f.user_id", "_f.event_type"]).cast("binary")
    damaged = t.withColumn("value", F.when(F.col("_f.event_id") % 3 == 0, short).otherwise(F.col("value")))
    flagged = dec.split_malformed(damaged.select("value"), "csv", EVENT_SCHEMA, flag="bad")
    return flagged.groupBy("bad").agg(F.count(F.lit(1)).alias("n"))


def q_registry_frame(spark, sf):
    framed = reg.split_registry_frame(_t(spark, sf, "framed"))
    return framed.select("magic", "schema_id", F.col("body").cast("string").alias("body"))


def q_decode_avro(spark, sf):
    recs = _records(_t(spark, sf)).select(F.struct(*EVENT_COLS).alias("message"))
    datums = recs.select(reg.encode_avro(recs, "message", "json").alias("value"))
    return reg.decode_avro(datums, EVENT_SCHEMA, encoding="json").select(*EVENT_COLS)


def q_decode_registry_avro(spark, sf):
    registry = registry_table(spark, sf)
    recs = _records(_t(spark, sf), partition_field="partition", offset_field="offset")
    recs = recs.select("partition", "offset", F.struct(*EVENT_COLS).alias("message"),
                       (F.col("user_id") % 3 + EVENTS_SCHEMA_BASE_ID).cast("int").alias("sid"))
    framed = recs.select("partition", "offset",
                         reg.encode_registry_avro(recs, registry, "events", "message", "sid", "json").alias("value"))
    decoded = reg.decode_registry_avro(framed, registry, "events", "message", encoding="json")
    return decoded.select("message.*")


def q_events_props_json(spark, sf):
    """The events' JSON text ``props`` through a JSON payload: text inside text, escaped and back."""
    recs = dec.to_records(events_props_topic_table(spark, sf).read(), "event_id bigint, props string", "json")
    return recs.select("event_id", "props")


# Declared schema of the document payloads.
DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string"


def q_documents_json_roundtrip(spark, sf):
    """Whole documents through JSON (E5 → topic → C9): every text must come back
    byte for byte (checked by md5 and byte length)."""
    recs = dec.to_records(documents_topic_table(spark, sf).read(),
                          f"{DOCUMENT_SCHEMA}, o bigint, p int", "json", offset_field="o", partition_field="p")
    return recs.select("doc_id", "lang", F.md5("text").alias("text_md5"),
                       F.octet_length("text").cast("bigint").alias("text_bytes"))


def q_pages_bytes_by_partition(spark, sf):
    """Raw html pages as a topic (B6/C4): messages and payload bytes per partition."""
    return off.message_sizes(pages_topic_table(spark, sf).read())


# ------------------------------------------------------------------ registry (D)


def q_latest_schemas(spark, sf):
    return reg.latest_schemas(registry_table(spark, sf)).select("subject", "id")


def q_inferred_schema(spark, sf):
    """The record schema that the registry's latest versions give a topic."""
    registry = registry_table(spark, sf)
    first = registry.where("subject <> 'events-value'").agg(F.min("subject")).first()[0].removesuffix("-value")
    rows = [(topic, f.name, f.dataType.simpleString())
            for topic in ("events", first)
            for f in reg.infer_output_schema(registry, topic, None, "message")["message"].dataType.fields]
    return spark.createDataFrame(rows, "topic string, field string, type string")


# ------------------------------------------------------------------ encoders and sinks (E)


def _message_frame(t: DataFrame) -> DataFrame:
    """T → typed records with the message time kept → outbound csv frame, and the source offset as ``sent``."""
    recs = t.select(
        F.col("key").cast("string").alias("k"),
        F.col("partition").alias("p"),
        F.unix_millis("timestamp").alias("ts_ms"),
        "offset",
        dec.payload_struct("value", "csv", EVENT_SCHEMA).alias("r"),
    ).select("k", "p", "ts_ms", "offset", "r.*")
    return enc.to_messages(recs, "events_copy", "csv", key_field="k", partition_field="p", time_field="ts_ms", order_field="offset")


def _read_back(table: TopicTable) -> DataFrame:
    recs = dec.to_records(
        table.read(),
        T.StructType([*EVENT_SCHEMA.fields, T.StructField("partition", T.IntegerType()),
                      T.StructField("offset", T.LongType())]),
        "csv", partition_field="partition", offset_field="offset",
    )
    return recs.select("partition", "offset", *EVENT_COLS)


def q_write_topic_roundtrip(spark, sf):
    table = TopicTable(spark, work_dir(spark, "write-roundtrip"), topic="events_copy")
    write_topic(_message_frame(_t(spark, sf)), table, order_cols=[enc.ORDER])
    return _read_back(table)


def q_stream_write_roundtrip(spark, sf):
    source = events_topic_table(spark, sf)
    target = TopicTable(spark, work_dir(spark, "stream-dst"), topic="events_copy")
    stream = st.read_topic_stream(spark, source.path)
    st.write_topic_stream(_message_frame(stream), target, work_dir(spark, "stream-ckpt"), order_cols=[enc.ORDER])
    return _read_back(target)


def q_append_then_stream(spark, sf):
    """Half of T appended, the other half streamed (its batches start at 0), and a third
    stream with a checkpoint of its own: nothing overwrites what another writer stored."""
    source = events_topic_table(spark, sf)
    target = TopicTable(spark, work_dir(spark, "append-dst"), topic="events_copy")
    write_topic(_message_frame(_t(spark, sf).where("offset % 2 = 0")), target, order_cols=[enc.ORDER])
    for rest in (1, 3):
        half = st.read_topic_stream(spark, source.path).where(F.col("offset") % 4 == rest)
        st.write_topic_stream(_message_frame(half), target, work_dir(spark, "append-ckpt"), order_cols=[enc.ORDER])
    return _read_back(target).select("partition", *EVENT_COLS)


def q_encode_key(spark, sf):
    recs = _records(_t(spark, sf))
    msgs = enc.to_messages(recs, "out", "csv", key_field="user_id")
    return msgs.select(F.col("key").cast("string").alias("key_text"))


def q_encode_raw(spark, sf):
    recs = _records(_t(spark, sf)).select("event_type")
    return enc.to_messages(recs, "out").select(F.hex("value").alias("v"))


def q_encode_json(spark, sf):
    recs = _records(_t(spark, sf)).select("event_id", "user_id", "event_type", F.col("amount").alias("value"))
    return enc.to_messages(recs, "out", "json").select(F.col("value").cast("string").alias("v"))


def q_encode_csv(spark, sf):
    recs = _records(_t(spark, sf)).select(
        "event_id", "user_id",
        F.when(F.col("event_id") % 2 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
    )
    return enc.to_messages(recs, "out", "csv").select(F.col("value").cast("string").alias("v"))


def q_route_partition(spark, sf):
    recs = _records(_t(spark, sf)).withColumn("p", (F.col("user_id") % 4).cast("int"))
    msgs = enc.to_messages(recs, "out", "csv", partition_field="p", num_partitions=4)
    return msgs.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))


def q_route_default(spark, sf):
    """Messages without a partition are dealt by key: one partition a key."""
    recs = _records(_t(spark, sf), key_field="k")
    cfg = SinkConfig(brokers="localhost:9092", topic="routed", fmt="csv", key_field="k", num_partitions=3)
    table = TopicTable(spark, work_dir(spark, "routed"), topic="routed")
    write_sink(recs, cfg, table)
    return table.read().groupBy(F.col("key").cast("string").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("partition").alias("partitions")
    )


def q_message_time(spark, sf):
    t = _t(spark, sf)
    recs = t.select(F.unix_millis("timestamp").alias("ts_ms"), dec.payload_struct("value", "csv", EVENT_SCHEMA)
                    .getField("event_id").alias("event_id"))
    msgs = enc.to_messages(recs, "out", None, time_field="ts_ms")
    return msgs.select(F.unix_millis("timestamp").alias("ts_ms"), F.col("value").cast("string").alias("v"))


def q_assign_offsets(spark, sf):
    t = _t(spark, sf).drop("offset")
    t = t.withColumn("event_id", dec.payload_struct("value", "csv", EVENT_SCHEMA).getField("event_id"))
    out = off.assign_offsets(t, _ledger(spark), ["timestamp", "event_id"])
    return out.select("partition", "offset")


# ------------------------------------------------------------------ streaming and ledger (F)


def q_batch_ranges(spark, sf):
    return led.batch_ranges(_t(spark, sf))


def q_ledger_upsert(spark, sf):
    return led.ledger_upsert(_ledger(spark), led.batch_ranges(_t(spark, sf))).select("partition", "next_offset")


def q_resume_from_ledger(spark, sf):
    return led.resume_from_ledger(_t(spark, sf), _ledger(spark)).select("partition", "offset")


def q_ledger_json_roundtrip(spark, sf):
    ledger = led.ledger_upsert(None, led.batch_ranges(_t(spark, sf)))
    return led.ledger_from_json(led.ledger_to_json(ledger)).select("partition", "next_offset")


def q_stream_topic_scan(spark, sf):
    source = events_topic_table(spark, sf)
    out = work_dir(spark, "scan-out")
    st.run_stream(st.read_topic_stream(spark, source.path), st.batch_folder_sink(out), work_dir(spark, "scan-ckpt"))
    return _text(spark.read.parquet(out), "key", "value").select("topic", "partition", "offset", "key", "value")


def q_stream_resume(spark, sf):
    t = _t(spark, sf)
    cut = F.col("timestamp") < F.lit("2024-01-15 00:00:00").cast("timestamp")
    source = TopicTable(spark, work_dir(spark, "resume-src"), topic="events")
    out, ckpt = work_dir(spark, "resume-out"), work_dir(spark, "resume-ckpt")
    source.put(t.where(cut))
    st.run_stream(st.read_topic_stream(spark, source.path), st.batch_folder_sink(out), ckpt)
    source.put(t.where(~cut))
    st.run_stream(st.read_topic_stream(spark, source.path), st.batch_folder_sink(out), ckpt)
    return _text(spark.read.parquet(out), "key", "value").select("topic", "partition", "offset", "key", "value")


def q_stream_from_offsets(spark, sf):
    """A configured stream that starts at its initial offsets (-2 = earliest, 10), partitions without one at the end."""
    cfg = SourceConfig(brokers="localhost:9092", topic="events", fmt="csv", initial_offsets=INITIAL_OFFSETS, default_offset=DEFAULT_OFFSET,
                       schema=T.StructType([*EVENT_SCHEMA.fields, T.StructField("p", T.IntegerType()), T.StructField("o", T.LongType())]),
                       partition_field="p", offset_field="o")
    out = work_dir(spark, "from-out")
    stream = open_source(spark, cfg, events_topic_table(spark, sf), starts=led.LedgerStore(spark, work_dir(spark, "from-starts")))
    st.run_stream(stream, st.batch_folder_sink(out), work_dir(spark, "from-ckpt"))
    return spark.read.parquet(out).select("p", "o", "event_id")


def q_paced_stream(spark, sf):
    """The whole topic drained at an exact rate per partition: messages of each run and partition."""
    table = events_topic_table(spark, sf)
    out, store = work_dir(spark, "paced-out"), led.LedgerStore(spark, work_dir(spark, "paced-ledger"))
    run_paced(table, store, lambda b, run: b.select("partition", "offset").write.mode("overwrite").parquet(f"{out}/run={run}"),
              PACED_RATE, PACED_INTERVAL_S, wait=False, ahead=PACED_AHEAD)
    return spark.read.parquet(out).groupBy("run", "partition").agg(F.count(F.lit(1)).alias("n"))


def q_stream_dead_letters(spark, sf):
    """A stream with damaged messages: good records and dead letters of each micro-batch from one decode."""
    t = _t(spark, sf).withColumn("_f", dec.payload_struct("value", "csv", EVENT_SCHEMA))
    short = delimited(["_f.event_id", "_f.user_id", "_f.event_type"]).cast("binary")
    source = TopicTable(spark, work_dir(spark, "dead-src"), topic="events")
    source.put(t.withColumn("value", F.when(F.col("_f.event_id") % 3 == 0, short).otherwise(F.col("value"))))
    out = work_dir(spark, "dead-out")
    st.run_stream(st.read_topic_stream(spark, source).select("partition", "offset", "value"),
                  st.dead_letter_sink(out, "csv", EVENT_SCHEMA), work_dir(spark, "dead-ckpt"))
    found = spark.read.parquet(out).withColumn("bad", F.col("bad").cast("boolean"))
    good = [F.when(~F.col("bad"), F.col(c)).alias(c) for c in EVENT_COLS]
    return found.select("partition", "offset", "bad", *good, F.col("dead_letter").cast("string").alias("dead_letter"))


def q_incremental_into_table(spark, sf):
    """Two capped runs whose output and ledger are one commit of the target table."""
    target = TopicTable(spark, work_dir(spark, "into"), topic="events_copy")
    for _ in range(2):
        run_into_table(events_topic_table(spark, sf), target, "copier",
                       lambda b: b.select("partition", "key", "value", F.col("offset").alias("sent")), max_records=INCREMENTAL_CAP, order_cols=["sent"])
    return _text(target.read(), "value").select("partition", "offset", "value")


def q_resume_two_topics(spark, sf):
    """A ledger that remembers two topics resumes each at its own offsets."""
    t = _t(spark, sf)
    ledger = _ledger(spark).withColumn("topic", F.lit("events"))
    ledger = ledger.unionByName(ledger.withColumns({"topic": F.lit("other"), "next_offset": F.col("next_offset") + 4}))
    both = t.unionByName(t.withColumn("topic", F.lit("other")))
    return led.resume_from_ledger(both, ledger).select("topic", "partition", "offset")


def q_incremental_beyond_end(spark, sf):
    """Initial offsets beyond the end read nothing and stay remembered; the next run starts there."""
    table = events_topic_table(spark, sf)
    bounds = table.bounds().withColumn("latest", F.lit(5).cast("bigint"))  # the topic as it was with 5 messages a partition
    store = led.LedgerStore(spark, work_dir(spark, "beyond"))
    outs = [work_dir(spark, f"beyond{i}") for i in (1, 2)]
    for path, known in zip(outs, (bounds, table.bounds())):
        run_incremental(table, store, lambda b, p=path: b.write.mode("overwrite").parquet(p),
                        initial={p: 8 for p in range(4)}, bounds=known)
    return spark.read.parquet(*outs).select("partition", "offset")


def q_incremental_run_2(spark, sf):
    table = events_topic_table(spark, sf)
    bounds = table.bounds()
    store = led.LedgerStore(spark, work_dir(spark, "ledger"))
    store.save(bounds.select("topic", "partition", F.lit(INCREMENTAL_START).cast("bigint").alias("next_offset")))
    outs = [work_dir(spark, f"run{i}") for i in (1, 2)]
    for path in outs:
        run_incremental(table, store, lambda b, p=path: b.write.mode("overwrite").parquet(p), max_records=INCREMENTAL_CAP)
    return spark.read.parquet(outs[1]).select("partition", "offset")


BUILDERS: dict[str, Builder] = {
    "topic_to_records": q_topic_to_records,
    "topic_scan": q_topic_scan,
    "stream_topic_scan": q_stream_topic_scan,
    "stream_resume": q_stream_resume,
    "select_partitions": q_select_partitions,
    "list_partitions": q_list_partitions,
    "earliest_offsets": q_earliest_offsets,
    "latest_offsets": q_latest_offsets,
    "resolve_start_offsets": q_resolve_start_offsets,
    "resolve_sentinels": q_resolve_sentinels,
    "slice_offsets": q_slice_offsets,
    "slice_uneven": q_slice_uneven,
    "read_splits": q_read_splits,
    "running_bytes": q_running_bytes,
    "paced_stream": q_paced_stream,
    "stream_dead_letters": q_stream_dead_letters,
    "incremental_into_table": q_incremental_into_table,
    "rate_capped_ranges": q_rate_capped_ranges,
    "record_capped_read": q_record_capped_read,
    "estimate_read_bytes": q_estimate_read_bytes,
    "ordered_messages": q_ordered_messages,
    "bytes_by_partition": q_bytes_by_partition,
    "with_read_time": q_with_read_time,
    "with_key": q_with_key,
    "with_metadata": q_with_metadata,
    "message_fields": q_message_fields,
    "raw_payload": q_raw_payload,
    "nested_value": q_nested_value,
    "decode_csv": q_topic_to_records,
    "decode_tsv": q_decode_tsv,
    "decode_json": q_decode_json,
    "decode_text": q_decode_text,
    "decode_clf": q_decode_clf,
    "documents_json_roundtrip": q_documents_json_roundtrip,
    "pages_bytes_by_partition": q_pages_bytes_by_partition,
    "decode_syslog": q_decode_syslog,
    "decode_grok": q_decode_grok,
    "decode_syslog_time": q_decode_syslog_time,
    "grok_malformed": q_grok_malformed,
    "malformed_rows": q_malformed_rows,
    "registry_frame": q_registry_frame,
    "decode_avro": q_decode_avro,
    "decode_registry_avro": q_decode_registry_avro,
    "events_props_json": q_events_props_json,
    "inferred_schema": q_inferred_schema,
    "latest_schemas": q_latest_schemas,
    "write_topic_roundtrip": q_write_topic_roundtrip,
    "stream_write_roundtrip": q_stream_write_roundtrip,
    "append_then_stream": q_append_then_stream,
    "route_default": q_route_default,
    "stream_from_offsets": q_stream_from_offsets,
    "resume_two_topics": q_resume_two_topics,
    "incremental_beyond_end": q_incremental_beyond_end,
    "encode_key": q_encode_key,
    "encode_raw": q_encode_raw,
    "encode_json": q_encode_json,
    "encode_csv": q_encode_csv,
    "route_partition": q_route_partition,
    "message_time": q_message_time,
    "assign_offsets": q_assign_offsets,
    "batch_ranges": q_batch_ranges,
    "ledger_upsert": q_ledger_upsert,
    "resume_from_ledger": q_resume_from_ledger,
    "ledger_json_roundtrip": q_ledger_json_roundtrip,
    "incremental_run_2": q_incremental_run_2,
}

# ------------------------------------------------------------------ DuckDB oracles

_PREFIX = """with t as (select event_type as "key", concat(event_id,',',user_id,',',event_type,',',value) as "value",
 'events' as topic, cast(user_id % 4 as int) as "partition",
 row_number() over (partition by user_id % 4 order by ts, event_id) - 1 as "offset", ts as "timestamp",
 event_id, user_id, event_type, value as amount from events),
led(p, next_offset) as (values (0,5),(1,7)), ini(p, o) as (values (2,-2),(3,10)),
b as (select "partition" p, min("offset") lo, max("offset")+1 hi from t group by 1),
r as (select b.p, case coalesce(o,-1) when -2 then lo when -1 then hi else o end f, hi from b left join ini using (p))
"""

_ROUNDTRIP = 'select "partition", "offset", event_id, user_id, event_type, amount from t'

_BODIES = {
    "topic_scan": 'select topic, "partition", "offset", "key", "value" from t',
    "select_partitions": 'select "partition", "offset" from t where "partition" in (0,2)',
    "list_partitions": 'select distinct topic, "partition" from t',
    "earliest_offsets": 'select topic, "partition", min("offset") as earliest from t group by all',
    "latest_offsets": 'select topic, "partition", max("offset")+1 as latest from t group by all',
    "resolve_start_offsets": 'select p as "partition", coalesce(next_offset, lo) as start_offset from b left join led using (p)',
    "resolve_sentinels": 'select p as "partition", f as from_offset from r',
    "slice_offsets": 'select "partition", "offset", "value" from t join r on p = "partition" where "offset" >= f and "offset" < hi',
    "slice_uneven": """select "partition", "offset" + case when "partition" = 1 then 1000000 else 0 end as "offset", "value" from t
 where ("partition" = 0 and "offset" between 10 and 59) or ("partition" = 1 and "offset" >= 20)""",
    "read_splits": """select p as "partition", row_number() over (partition by p order by k) - 1 as split, f as from_offset,
 coalesce(lead(f) over (partition by p order by k), e) as until_offset, n, bytes from (
 select p, k, min(o) as f, max(o) + 1 as e, count(*) as n, cast(sum(size) as bigint) as bytes from (
 select p, o, size, cast(sum(size) over (partition by p order by o) - size as bigint) // 65536 as k from (
 select cast(page_id % 8 as int) as p, row_number() over (partition by page_id % 8 order by page_id) - 1 as o,
 coalesce(strlen(html), 0) as size from pages)) group by p, k)""",
    "running_bytes": """select "partition", "offset", cast(strlen("value") as bigint) as bytes,
 cast(sum(strlen("value")) over (partition by "partition" order by "offset") as bigint) as running from t""",
    "paced_stream": 'select cast("offset" // 2000 as int) as run, "partition", count(*) as n from t group by all',
    "stream_dead_letters": """select "partition", "offset", event_id % 3 = 0 as bad,
 case when event_id % 3 <> 0 then event_id end as event_id, case when event_id % 3 <> 0 then user_id end as user_id,
 case when event_id % 3 <> 0 then event_type end as event_type, case when event_id % 3 <> 0 then amount end as amount,
 case when event_id % 3 = 0 then concat(event_id,',',user_id,',',event_type) end as dead_letter from t""",
    "incremental_into_table": 'select "partition", "offset", "value" from t where "offset" < 100',
    "rate_capped_ranges": 'select p as "partition", f as from_offset, least(hi, f + 100*2) as until_offset from r',
    "record_capped_read": 'select "partition", "offset", "value" from t join r on p = "partition" where "offset" >= f and "offset" < least(hi, f+3)',
    "estimate_read_bytes": 'select p as "partition", (hi-f)*1024 as est_bytes from r',
    "ordered_messages": 'select "partition", "offset", row_number() over (order by "partition","offset") as pos from t',
    "bytes_by_partition": 'select "partition", count(*) as n, cast(sum(strlen("value")) as bigint) as bytes from t group by 1',
    "with_read_time": 'select "partition", "offset", cast(1700000000000 as bigint) as read_ms from t',
    "with_key": 'select "key" as k, "partition", "offset" from t',
    "with_metadata": 'select "partition" as p, "offset" as o from t',
    "message_fields": "select event_id, user_id, event_type, amount from t",
    "raw_payload": 'select hex("value") as message from t',
    "nested_value": 'select to_json(struct_pack(event_id := event_id, user_id := user_id, event_type := event_type, amount := amount))::varchar as message, "offset" from t',
    "topic_to_records": 'select "key" as k, "partition", "offset", event_id, user_id, event_type, amount from t',
    "decode_csv": 'select "key" as k, "partition", "offset", event_id, user_id, event_type, amount from t',
    "decode_tsv": "select event_id, user_id, event_type, amount from t",
    "decode_json": "select event_id, user_id, event_type, amount from t",
    "decode_text": "select event_type as message from t",
    "decode_clf": """select concat('127.0.0.', user_id % 250) as host, concat('u', user_id) as authuser,
 date_trunc('second', "timestamp") as at, concat('GET /', event_type, ' HTTP/1.0') as request, 200 as status,
 event_id as bytes from t""",
    "documents_json_roundtrip": """select doc_id, lang, md5(text) as text_md5,
 cast(strlen(text) as bigint) as text_bytes from documents""",
    "pages_bytes_by_partition": """select cast(page_id % 8 as int) as "partition", count(*) as n,
 cast(sum(coalesce(strlen(html), 0)) as bigint) as bytes from pages group by 1""",
    "decode_syslog": """select 4 as facility, 2 as severity, concat('h', user_id) as host, 'app' as app,
 event_id as pid, event_type as msg from t""",
    "decode_grok": """select 34 as priority, concat('h', user_id) as host, 'app' as app, event_id as pid,
 event_type as msg from t""",
    "decode_syslog_time": """select make_timestamp(2024, month("timestamp"), day("timestamp"), hour("timestamp"),
 minute("timestamp"), second("timestamp")) as at, concat('h', user_id) as host, event_id as pid from t""",
    "grok_malformed": """select event_id, case when event_id % 3 <> 0 then concat('h', user_id) end as host,
 case when event_id % 3 <> 0 then event_id end as pid, case when event_id % 3 <> 0 then event_type end as msg,
 event_id % 3 = 0 as bad from t""",
    "malformed_rows": "select event_id % 3 = 0 as bad, count(*) as n from t group by 1",
    "registry_frame": 'select 0 as magic, cast(500 + user_id % 3 as int) as schema_id, "value" as body from t',
    "decode_avro": "select event_id, user_id, event_type, amount from t",
    "decode_registry_avro": """select event_id, user_id, case when user_id % 3 >= 1 then event_type end as event_type,
 case when user_id % 3 = 2 then amount end as amount from t""",
    "events_props_json": "select event_id, props from events",
    "inferred_schema": """select * from (values ('events','event_id','bigint'),('events','user_id','bigint'),
 ('events','event_type','string'),('events','amount','double')) v(topic, field, type)
 union all select n_name as topic, f.field, f.type from nation,
 (values ('n_nationkey','int'),('n_name','string'),('n_regionkey','int')) f(field, type) where n_name = (select min(n_name) from nation)""",
    "append_then_stream": 'select "partition", event_id, user_id, event_type, amount from t',
    "route_default": 'select "key" as k, count(*) as n, 1 as partitions from t group by 1',
    "stream_from_offsets": 'select "partition" as p, "offset" as o, event_id from t join r on p = "partition" where "offset" >= f',
    "resume_two_topics": """select u.topic, "partition", "offset" from (select 'events' as topic, "partition", "offset", 0 as x from t
 union all select 'other' as topic, "partition", "offset", 4 as x from t) u left join led on p = "partition"
 where "offset" >= coalesce(next_offset + x, 0)""",
    "incremental_beyond_end": 'select "partition", "offset" from t where "offset" >= 8',
    "latest_schemas": """select concat(n_name,'-value') as subject, n_nationkey*10+3 as id from nation
 union all select 'events-value' as subject, 502 as id""",
    "write_topic_roundtrip": _ROUNDTRIP,
    "stream_write_roundtrip": _ROUNDTRIP,
    "encode_key": "select cast(user_id as varchar) as key_text from t",
    "encode_raw": "select hex(event_type) as v from t",
    "encode_json": "select to_json(struct_pack(event_id := event_id, user_id := user_id, event_type := event_type, value := amount))::varchar as v from t",
    "encode_csv": "select concat(event_id,',',user_id,',',case when event_id % 2 = 0 then '' else event_type end) as v from t",
    "route_partition": 'select cast(user_id % 4 as int) as "partition", count(*) as n from t group by 1',
    "message_time": 'select epoch_us("timestamp")//1000 as ts_ms, cast(event_id as varchar) as v from t',
    "assign_offsets": 'select "partition", "offset" + coalesce(next_offset,0) as "offset" from t left join led on p = "partition"',
    "batch_ranges": 'select topic, "partition", min("offset") as from_offset, max("offset")+1 as until_offset from t group by all',
    "ledger_upsert": 'select p as "partition", greatest(coalesce(next_offset,0), hi) as next_offset from b full join led using (p)',
    "resume_from_ledger": 'select "partition", "offset" from t left join led on p = "partition" where "offset" >= coalesce(next_offset,0)',
    "ledger_json_roundtrip": 'select "partition", max("offset")+1 as next_offset from t group by 1',
    "incremental_run_2": 'select "partition", "offset" from t where "offset" >= 100 and "offset" < 150',
    "stream_topic_scan": 'select topic, "partition", "offset", "key", "value" from t',
    "stream_resume": 'select topic, "partition", "offset", "key", "value" from t',
}

ORACLES: dict[str, str] = {k: _PREFIX + v for k, v in _BODIES.items()}
