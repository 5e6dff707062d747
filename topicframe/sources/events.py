"""The events test topic, stored once per session and input.

``events_topic_table`` numbers the topic from ``events`` (skew-proof
distributed numbering) and stores it as a topic table in the shared
checkpoint folder; queries then read it like any stored topic, with
partition pruning and offset pushdown. Other payload encodings are
re-encodings of the stored topic's decoded fields: a projection, no
renumbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicframe.schema import to_ddl
from topicframe.session import path_exists, path_stamp, work_dir
from topicframe.sources.topic import EVENTS_TOPIC, event_payload, topic_from_events, topic_from_table
from topicframe.sources.topic_table import TopicTable

_STORED: dict[tuple, str] = {}

# Field names and types of the events payload (csv order).
EVENT_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
    ]
)


def _input_key(spark: SparkSession, sf_dir: str, name: str = EVENTS_TOPIC) -> tuple:
    folder = sf_dir.rstrip("/")
    return (spark.sparkContext.applicationId, folder, name, path_stamp(spark, f"{folder}/{name.split('-')[0]}.parquet"))


def _stored(spark: SparkSession, sf_dir: str, name: str, build) -> TopicTable:
    """The topic, built once for a session and a state of its input."""
    key = _input_key(spark, sf_dir, name)
    path = _STORED.get(key)
    table = TopicTable(spark, path, name) if path else None
    if table is None or not path_exists(spark, table.data_path):
        table = TopicTable(spark, work_dir(spark, f"{name}-topic"), name)
        table.put(build())
        _STORED[key] = table.path
    return table


def events_topic_table(spark: SparkSession, sf_dir: str) -> TopicTable:
    """The csv events topic as a stored topic table (built on first use)."""
    return _stored(spark, sf_dir, EVENTS_TOPIC, lambda: topic_from_events(spark, sf_dir))


# Partitions of the document and page topics (keyed by id, routed by id).
TEXT_TOPIC_PARTITIONS = 8


def documents_topic_table(spark: SparkSession, sf_dir: str) -> TopicTable:
    """``documents`` as a topic: key = doc_id, value = JSON of the whole row
    (long texts with quotes, newlines and non-ASCII), partition = doc_id % 8."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    value = F.to_json(F.struct("doc_id", "text", "lang", "source"), {"ignoreNullFields": "false"})
    return _stored(spark, sf_dir, "documents", lambda: topic_from_table(
        docs, "documents", F.col("doc_id").cast("string"), value,
        F.pmod(F.col("doc_id"), F.lit(TEXT_TOPIC_PARTITIONS)), ["doc_id"]))


def events_props_topic_table(spark: SparkSession, sf_dir: str) -> TopicTable:
    """``events`` as a topic of JSON rows with their ``props`` text (a JSON document inside JSON)."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    value = F.to_json(F.struct("event_id", "props"), {"ignoreNullFields": "false"})
    return _stored(spark, sf_dir, "events-props", lambda: topic_from_table(
        events, "events-props", F.col("event_type"), value, F.pmod(F.col("user_id"), F.lit(TEXT_TOPIC_PARTITIONS)),
        ["ts", "event_id"]))


def pages_topic_table(spark: SparkSession, sf_dir: str) -> TopicTable:
    """``pages`` as a topic: key = url, value = the raw html, partition = page_id % 8."""
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return _stored(spark, sf_dir, "pages", lambda: topic_from_table(
        pages, "pages", F.col("url"), F.col("html"),
        F.pmod(F.col("page_id"), F.lit(TEXT_TOPIC_PARTITIONS)), ["page_id"]))


def events_topic(spark: SparkSession, sf_dir: str, payload: str = "csv") -> DataFrame:
    """The events topic with the payload in ``payload`` encoding."""
    t = events_topic_table(spark, sf_dir).read()
    if payload == "csv":
        return t
    fields = F.from_csv(F.col("value").cast("string"), to_ddl(EVENT_PAYLOAD_SCHEMA), {"mode": "FAILFAST"})
    meta = [c for c in t.columns if c != "value"]
    rec = t.withColumn("_tf_f", fields).select(
        *meta, *[F.col(f"_tf_f.{n}").alias(n) for n in EVENT_PAYLOAD_SCHEMA.fieldNames()],
        F.col("timestamp").cast("timestamp_ntz").alias("ts"),
    )
    return rec.select(*meta, event_payload(payload).cast("binary").alias("value")).select(*t.columns)
