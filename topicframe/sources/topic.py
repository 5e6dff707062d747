"""The topic table: a partitioned, offset-addressed message log as a DataFrame.

The column set is exactly Spark's Kafka source schema, so a stored topic
table (parquet, partitioned by ``partition``) and ``format("kafka")`` are
interchangeable inputs for every operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicframe.functions.columns import delimited, int32_be
from topicframe.plans.numbering import number_rows

TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
    ]
)
TOPIC_COLUMNS = [f.name for f in TOPIC_SCHEMA.fields]

# Payload encodings of the events-derived test topic (see FIXTURES.md).
EVENT_FIELDS = ["event_id", "user_id", "event_type", "value"]
EVENTS_TOPIC = "events"
EVENTS_PARTITIONS = 4


def event_payload(kind: str) -> Column:
    """Payload of the event fields (event_id, user_id, event_type, value, ts) in one encoding."""
    ev = [F.col(c) for c in EVENT_FIELDS]
    if kind == "csv":
        return delimited(ev, ",")
    if kind == "tsv":
        return delimited(ev, "\t")
    if kind == "json":
        return F.to_json(F.struct(*ev), {"ignoreNullFields": "false"})
    if kind == "text":
        return F.col("event_type")
    if kind == "framed":
        schema_id = (F.col("user_id") % 3 + 500).cast("int")
        return F.concat(F.lit(b"\x00"), int32_be(schema_id), delimited(ev, ",").cast("binary"))
    if kind == "clf":
        return F.concat(
            F.lit("127.0.0."), (F.col("user_id") % 250).cast("string"),
            F.lit(" - u"), F.col("user_id").cast("string"),
            F.lit(" ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \"GET /"),
            F.col("event_type"), F.lit(" HTTP/1.0\" 200 "), F.col("event_id").cast("string"),
        )
    if kind == "syslog":
        return F.concat(
            F.lit("<34>"), F.date_format("ts", "MMM dd HH:mm:ss"),
            F.lit(" h"), F.col("user_id").cast("string"),
            F.lit(" app["), F.col("event_id").cast("string"), F.lit("]: "), F.col("event_type"),
        )
    raise ValueError(f"unknown payload kind {kind!r}")


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def topic_from_table(
    df: DataFrame,
    topic: str,
    key: Column,
    value: Column,
    partition: Column,
    order: list[str | Column],
) -> DataFrame:
    """Any table as a topic frame: messages numbered per partition in ``order``
    by the skew-proof numbering; rows that tie keep the order they are read in."""
    t = df.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        *[(F.col(c) if isinstance(c, str) else c).alias(f"_tf_o{i}") for i, c in enumerate(order)],
    )
    t = t.withColumn("timestamp", F.current_timestamp()).withColumn("timestampType", F.lit(1))
    t = number_rows(t, ["partition"], [f"_tf_o{i}" for i in range(len(order))], "offset")
    return t.select(*TOPIC_COLUMNS)


def topic_from_events(
    spark: SparkSession,
    sf_dir: str,
    payload: str = "csv",
) -> DataFrame:
    """The canonical test topic ``T`` derived from ``events``.

    key = event_type, value = payload of (event_id, user_id, event_type, value),
    partition = user_id % 4, offset = position in the partition ordered by
    (ts, event_id). Offsets are numbered with the skew-proof distributed plan.
    ``payload`` picks the encoding: csv, tsv, json, text, clf, syslog, framed
    (registry wire frame around the csv payload).
    """
    ev = events_table(spark, sf_dir)
    body = event_payload(payload).cast("binary")
    cols = [
        F.col("event_type").cast("binary").alias("key"),
        body.alias("value"),
        F.lit(EVENTS_TOPIC).alias("topic"),
        (F.col("user_id") % EVENTS_PARTITIONS).cast("int").alias("partition"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.col("ts").alias("_ts"),
        F.col("event_id").alias("_eid"),
    ]
    return number_rows(ev.select(*cols), ["partition"], ["_ts", "_eid"], "offset").select(*TOPIC_COLUMNS)


def read_topic(
    spark: SparkSession,
    source: DataFrame | str | dict,
    partitions: list[int] | None = None,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """Bounded topic scan (A2).

    ``source``: a topic DataFrame, a stored topic table or its folder (its
    committed batches), or a dict of Kafka options (``format("kafka")``,
    needs the connector jar).
    ``partitions`` selects partitions (A3, pushed to the scan / partition
    pruned); ``ranges`` (``partition, from_offset, until_offset``) slices
    ``[from, until)`` per partition (A9).
    """
    from topicframe.operators.offsets import select_partitions, slice_offsets

    if isinstance(source, DataFrame):
        df = source
    elif isinstance(source, dict):
        from topicframe.sources.kafka import kafka_range_options

        # Kafka takes offsets only through options: ranges become assign/starting/ending
        opts = kafka_range_options(source, partitions, ranges)
        return spark.read.format("kafka").options(**opts).load()
    else:
        from topicframe.sources.topic_table import TopicTable

        table = source if isinstance(source, TopicTable) else TopicTable(spark, source)
        if ranges is not None:  # only the files that hold them
            return select_partitions(table.slice(ranges), partitions)
        df = table.read()
    if partitions:
        df = select_partitions(df, partitions)
    if ranges is not None:
        df = slice_offsets(df, ranges)
    return df
