"""Configuration-driven source and sink: what a user of the reference configures.

``open_source`` validates a :class:`~topicframe.schema.SourceConfig` and
returns typed records from a topic (Kafka, a stored topic table, or a topic
frame), streaming or bounded. ``open_bounded`` gives the next bounded run
from a ledger plus the call that saves the ledger after the output is
written. ``write_sink`` validates a :class:`~topicframe.schema.SinkConfig`
against the input schema and writes messages (batch or streaming).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicframe.operators.decode import to_records
from topicframe.operators.encode import encode_key, message_time, route
from topicframe.operators.ledger import LedgerStore, ledger_upsert
from topicframe.operators.offsets import EARLIEST, LATEST, select_partitions
from topicframe.operators.registry import encode_registry_avro, encode_registry_key
from topicframe.schema import ContractError, SinkConfig, SourceConfig, parse_initial_offsets, parse_partitions
from topicframe.sources.kafka import kafka_range_options
from topicframe.sources.sink import write_topic
from topicframe.sources.topic import read_topic
from topicframe.sources.topic_table import TopicTable
from topicframe.streaming.incremental import plan_ranges, read_ranges
from topicframe.streaming.stream import read_topic_stream, stream_start, write_topic_stream


def _kafka_source(cfg: SourceConfig, saved: dict[int, int] | None = None) -> dict:
    return {
        "brokers": cfg.brokers,
        "topic": cfg.topic,
        "partitions": cfg.partitions,
        "default_offset": cfg.default_offset if cfg.default_offset is not None else LATEST,
        "initial_offsets": cfg.initial_offsets,
        "saved_offsets": saved,
        "max_rate": cfg.max_rate,
        "partition_count": cfg.partition_count,
        "cluster_key": cfg.cluster_key,
        "cluster_secret": cfg.cluster_secret,
        "kafka_options": cfg.kafka_options,
    }


def _records(df: DataFrame, cfg: SourceConfig, schema, keep_position: bool = False) -> DataFrame:
    meta = dict(time_field=cfg.time_field, key_field=cfg.key_field, partition_field=cfg.partition_field,
                offset_field=cfg.offset_field, value_field=cfg.value_field, keep_position=keep_position)
    if cfg.registry is not None:
        declared = schema if cfg.value_field in schema.fieldNames() else None
        return to_records(df, declared, registry=cfg.registry, topic=cfg.topic, encoding=cfg.avro_encoding, **meta)
    return to_records(df, schema, cfg.fmt, pattern=cfg.pattern, options=dict(cfg.format_options), **meta)


def _of_topic(ledger: DataFrame, topic: str | None) -> DataFrame:
    """A ledger's rows of one topic (rows without a topic speak for any)."""
    if topic is None or "topic" not in ledger.columns:
        return ledger
    return ledger.where((F.col("topic") == topic) | F.col("topic").isNull())


def open_source(
    spark: SparkSession,
    cfg: SourceConfig,
    source: DataFrame | TopicTable | str | None = None,
    streaming: bool = True,
    ledger: DataFrame | None = None,
    starts: LedgerStore | None = None,
    keep_position: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Typed records of a topic (A1/A2 + B1-B9 + C*), after all config checks.

    ``source``: None = Kafka (from ``cfg.brokers``), a topic table (object or
    path) or a topic frame. Start offsets (A7) are the saved ones of
    ``ledger``, else the configured initial offsets, else the default
    (streaming: latest; bounded: earliest unless the config names one). For a stream over a topic table,
    ``starts`` remembers what they meant at its first start. A topic table
    takes the rate as files: ``max_files_per_trigger``. ``keep_position``
    adds ``_topic, _partition, _offset`` for ``ledger_tracking_sink``.
    """
    schema = cfg.validate()
    parts = parse_partitions(cfg.partitions, [])
    if source is None:
        saved = None
        if ledger is not None:
            saved = {int(r.partition): int(r.next_offset) for r in _of_topic(ledger, cfg.topic).collect()}
        opts = _kafka_source(cfg, saved)
        df = read_topic_stream(spark, opts) if streaming else read_topic(spark, opts)
        return _records(df, cfg, schema, keep_position)
    initial = parse_initial_offsets(cfg.initial_offsets, [])
    if isinstance(source, DataFrame):
        df, bounds = select_partitions(source, parts), None
    else:
        table = source if isinstance(source, TopicTable) else TopicTable(spark, source, cfg.topic)
        bounds = table.bounds()
        if streaming:
            default = LATEST if cfg.default_offset is None else cfg.default_offset
            if ledger is not None or starts is not None or initial or default != EARLIEST:
                begin = stream_start(table, initial, default, _of_topic(ledger, cfg.topic) if ledger is not None else None, starts)
            else:
                begin = None
            df = read_topic_stream(spark, table, parts, max_files_per_trigger, begin)
            return _records(df, cfg, schema, keep_position)
        df = table
    if not streaming:
        # the configured default -1 is the streaming one; a bounded read begins at the earliest
        default = EARLIEST if cfg.default_offset in (None, LATEST) else cfg.default_offset
        saved = _of_topic(ledger, cfg.topic) if ledger is not None else None
        df = read_ranges(df, plan_ranges(df, saved=saved, initial=initial, default=default, partitions=parts, bounds=bounds), parts)
    return _records(df, cfg, schema, keep_position)


def open_bounded(
    spark: SparkSession,
    cfg: SourceConfig,
    source: DataFrame | TopicTable | str | None,
    store: LedgerStore,
    bounds: DataFrame | None = None,
) -> tuple[DataFrame, Callable[[], None]]:
    """Next bounded run (F10): records from the saved offsets, at most
    ``cfg.max_records`` per partition, and ``commit()`` to call after the
    records were written (saves the new ledger).

    ``source`` None reads Kafka by the config; its range needs ``bounds``
    (``partition, earliest, latest``), which Kafka's client knows and Spark does not tell.
    """
    schema = cfg.validate()
    parts = parse_partitions(cfg.partitions, [])
    topic = source if isinstance(source, DataFrame) else None
    if source is None:
        if bounds is None:
            raise ContractError(["a bounded Kafka run needs the partitions' earliest and latest offsets"])
    elif topic is None:
        table = source if isinstance(source, TopicTable) else TopicTable(spark, source, cfg.topic)
        topic, bounds = table, table.bounds()
    previous = store.rows()
    ranges = plan_ranges(topic, saved=_of_topic(previous, cfg.topic), initial=parse_initial_offsets(cfg.initial_offsets, []),
                         default=EARLIEST, max_records=cfg.max_records, partitions=parts, bounds=bounds)
    if "topic" not in ranges.columns and cfg.topic:
        ranges = ranges.withColumn("topic", F.lit(cfg.topic))
    if topic is None:
        batch = spark.read.format("kafka").options(**kafka_range_options(_kafka_source(cfg), parts, ranges)).load()
    else:
        batch = read_ranges(topic, ranges, parts)
    records = _records(batch, cfg, schema)

    def commit() -> None:
        has_previous = previous.limit(1).count() > 0
        store.save(ledger_upsert(previous if has_previous else None, ranges))

    return records, commit


def sink_messages(df: DataFrame, cfg: SinkConfig) -> DataFrame:
    """Records → outbound frame per the sink config (E3-E10, E7 with a registry)."""
    msg_schema = cfg.validate(df.schema)
    fields = msg_schema.fieldNames()
    if cfg.registry is not None:
        value = encode_registry_avro(df, cfg.registry, cfg.topic, fields[0], encoding=cfg.avro_encoding)
        key = (encode_registry_key(df, cfg.registry, cfg.topic, cfg.key_field, cfg.avro_encoding) if cfg.key_field
               else encode_key(df, None))
        framed = df.select("*", key.alias("_tf_key"), value.alias("_tf_value"))
        return framed.select(
            F.lit(cfg.topic).alias("topic"),
            route(framed, cfg.partition_field, cfg.num_partitions).alias("partition"),
            message_time(cfg.time_field).alias("timestamp"),
            F.col("_tf_key").alias("key"),
            F.col("_tf_value").alias("value"),
        )
    from topicframe.operators.encode import to_messages

    return to_messages(df.select(*[c for c in df.columns if c in fields or c in
                                   (cfg.key_field, cfg.partition_field, cfg.time_field)]),
                       cfg.topic, cfg.fmt, cfg.key_field, cfg.partition_field, cfg.time_field, cfg.num_partitions)


def write_sink(
    df: DataFrame,
    cfg: SinkConfig,
    target: TopicTable | str | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery | int | None:
    """Write records to a topic per the sink config: Kafka when ``target`` is
    None, else a topic table. Streaming frames need ``checkpoint``.

    Kafka's own partitioner takes messages without a partition; a topic
    table deals them by key over ``cfg.num_partitions``, which it then needs.
    """
    if target is not None and not cfg.partition_field and not cfg.num_partitions:
        raise ContractError(["a topic table needs a partition field or num_partitions"])
    messages = sink_messages(df, cfg)
    kafka = None
    if target is None:
        kafka = {"brokers": cfg.brokers, "topic": cfg.topic, "is_async": cfg.is_async,
                 "compression": cfg.compression, "cluster_key": cfg.cluster_key,
                 "cluster_secret": cfg.cluster_secret, "kafka_options": cfg.kafka_options}
    dest = kafka if kafka is not None else (
        target if isinstance(target, TopicTable) else TopicTable(df.sparkSession, target, cfg.topic))
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming sink needs a checkpoint folder")
        return write_topic_stream(messages, dest, checkpoint)
    compression = None if cfg.compression == "none" else cfg.compression
    return write_topic(messages, dest, compression=compression if kafka is None else None)
