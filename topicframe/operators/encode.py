"""Encoders: typed rows → outbound messages.

The outbound frame has the columns Spark's Kafka sink consumes
(``topic, partition, key, value``) plus ``timestamp``. Everything is a
column expression; no per-row Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicframe.functions.columns import delimited, utf8_bytes
from topicframe.schema import ContractError

# Column-metadata flag: the message time came from a record field.
EXPLICIT_TIME = "topicframe.explicit_time"
# Column of an outbound frame that orders its messages (see ``order_field``).
ORDER = "sent"


def encode_key(df: DataFrame, field: str | None) -> Column:
    """Key bytes (E3): no field → null; null → null; bytes unchanged;
    string and every other type → UTF-8 of its text form."""
    if not field:
        return F.lit(None).cast("binary")
    dt = df.schema[field].dataType
    if isinstance(dt, T.BinaryType):
        return F.col(field)
    return utf8_bytes(field)


def encode_value(df: DataFrame, fields: Sequence[str], fmt: str | None = None) -> Column:
    """Value bytes over the message fields.

    * None (raw, E4): the first message field as is (bytes, or UTF-8 text).
    * ``json`` (E5): one JSON object; null fields are written as ``null``.
    * ``csv`` (E6): text forms joined by ``,``, null → empty, no quoting
      (a comma inside a field is not escaped, as in the reference).
    """
    if not fields:
        raise ContractError(["no message fields to encode"])
    f = (fmt or "").lower()
    if not f:
        first = fields[0]
        dt = df.schema[first].dataType
        return F.col(first) if isinstance(dt, T.BinaryType) else utf8_bytes(first)
    if f == "json":
        return F.to_json(F.struct(*[F.col(c) for c in fields]), {"ignoreNullFields": "false"}).cast("binary")
    if f == "csv":
        return delimited(list(fields), ",").cast("binary")
    if f == "tsv":
        return delimited(list(fields), "\t").cast("binary")
    raise ContractError([f"format {fmt!r} is not csv or json"])


def route(df: DataFrame, partition_field: str | None, num_partitions: int | None = None) -> Column:
    """Target partition (E8): the explicit field; when it is null (or absent)
    and ``num_partitions`` is known, a stable hash of the key (of the value
    for unkeyed rows). Without ``num_partitions`` null stays null and the
    Kafka sink's default partitioner decides."""
    explicit = F.col(partition_field).cast("int") if partition_field else F.lit(None).cast("int")
    if not num_partitions:
        return explicit
    n = F.lit(int(num_partitions))
    hashed = F.when(F.col("_tf_key").isNotNull(), F.pmod(F.hash("_tf_key"), n)).otherwise(
        F.pmod(F.xxhash64("_tf_value"), n)
    )
    return F.coalesce(explicit, hashed.cast("int"))


def message_time(time_field: str | None) -> Column:
    """Message timestamp (E9): a long epoch-ms field, or now when none is set."""
    if not time_field:
        return F.current_timestamp()
    return F.timestamp_millis(F.col(time_field).cast("bigint"))


def to_messages(
    df: DataFrame,
    topic: str,
    fmt: str | None = None,
    key_field: str | None = None,
    partition_field: str | None = None,
    time_field: str | None = None,
    num_partitions: int | None = None,
    order_field: str | None = None,
) -> DataFrame:
    """Typed rows → outbound frame ``topic, partition, timestamp, key, value``.

    Message fields are all fields except key, partition, time and order
    fields. ``order_field`` (a source position) is carried as column ``sent``,
    for a topic table to number by.
    """
    meta = {m for m in (key_field, partition_field, time_field, order_field) if m}
    fields = [c for c in df.columns if c not in meta]
    if not fields:
        raise ContractError(["input must contain at least one message field"])
    framed = df.select(
        *[F.col(c) for c in df.columns],
        encode_key(df, key_field).alias("_tf_key"),
        encode_value(df, fields, fmt).alias("_tf_value"),
    )
    return framed.select(
        F.lit(topic).alias("topic"),
        route(framed, partition_field, num_partitions).alias("partition"),
        message_time(time_field).alias("timestamp", metadata={EXPLICIT_TIME: bool(time_field)}),
        F.col("_tf_key").alias("key"),
        F.col("_tf_value").alias("value"),
        *([F.col(order_field).alias(ORDER)] if order_field else []),
    )
