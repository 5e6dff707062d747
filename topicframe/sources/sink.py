"""Batch topic sink (E1): an outbound frame to a topic table or to Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame

from topicframe.operators.encode import EXPLICIT_TIME
from topicframe.schema import ContractError
from topicframe.sources.topic_table import TopicTable


def write_topic(
    messages: DataFrame,
    target: TopicTable | str | dict,
    batch_id: int | None = None,
    compression: str | None = None,
    order_cols: list | None = None,
    writer: str | None = None,
) -> int | None:
    """Write ``topic, partition, timestamp, key, value`` messages.

    * topic table (object or path): offsets are assigned per partition from
      the table's log, in ``order_cols`` or else send order; with a ``writer``
      the write is done once per ``batch_id``.
    * dict of Kafka options (``sources.kafka.kafka_write_options`` arguments):
      ``df.write.format("kafka")``. Spark's Kafka sink takes no message time,
      so a frame whose time came from a record field is refused.
    """
    if isinstance(target, dict):
        from topicframe.sources.kafka import kafka_write_options

        if "timestamp" in messages.columns and messages.schema["timestamp"].metadata.get(EXPLICIT_TIME):
            raise ContractError(["Spark's Kafka sink cannot set the message time; drop the time field"])
        cols = [c for c in ("topic", "partition", "key", "value", "headers") if c in messages.columns]
        messages.select(*cols).write.format("kafka").options(**kafka_write_options(**target)).save()
        return None
    table = target if isinstance(target, TopicTable) else TopicTable(messages.sparkSession, target)
    return table.append(messages, batch_id=batch_id, order_cols=order_cols, compression=compression, writer=writer)
