"""Option builders for Spark's built-in Kafka source and sink.

The connector jar is not always on the class path (it is not in the test
container); these builders are plain dictionaries and are tested as such.
With the jar present, ``spark.read/readStream.format("kafka").options(**opts)``
and ``df.write/writeStream.format("kafka")`` use them directly.
"""

from __future__ import annotations

import json
import warnings

from topicframe.schema import ContractError, parse_initial_offsets, parse_partitions

# Client options the reference always sets on consumer and producer.
FIXED_CLIENT_OPTIONS = {
    "ssl.endpoint.identification.algorithm": "https",
    "retry.backoff.ms": "500",
    "request.timeout.ms": "20000",
}
# consumer/producer options Spark's Kafka connector owns.
SPARK_OWNED = (
    "auto.offset.reset",
    "enable.auto.commit",
    "key.deserializer",
    "value.deserializer",
    "key.serializer",
    "value.serializer",
    "interceptor.classes",
)


def _security(cluster_key: str | None, cluster_secret: str | None) -> dict[str, str]:
    if not cluster_key:
        return {}
    jaas = (
        "org.apache.kafka.common.security.plain.PlainLoginModule required "
        f'username="{cluster_key}" password="{cluster_secret}";'
    )
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": jaas,
    }


def _user_options(kafka_options: dict | str | None) -> dict[str, str]:
    if not kafka_options:
        return {}
    if isinstance(kafka_options, str):
        pairs = [p.split(":", 1) for p in kafka_options.split(",") if p.strip()]
        kafka_options = {k.strip(): v.strip() for k, v in pairs}
    bad = [k for k in kafka_options if k in SPARK_OWNED]
    if bad:
        raise ContractError([f"Kafka option {k!r} is managed by Spark" for k in bad])
    return {f"kafka.{k}": str(v) for k, v in kafka_options.items()}


def starting_offsets_json(topic: str, offsets: dict[int, int]) -> str:
    """Spark's ``startingOffsets`` JSON; -2 = earliest and -1 = latest as in Kafka."""
    return json.dumps({topic: {str(p): int(o) for p, o in sorted(offsets.items())}})


def kafka_read_options(
    brokers: str,
    topic: str,
    partitions: str | list | None = None,
    default_offset: int = -1,
    initial_offsets: str | dict | None = None,
    saved_offsets: dict[int, int] | None = None,
    ending_offsets: dict[int, int] | None = None,
    max_rate: int | None = None,
    batch_interval_s: float = 1.0,
    partition_count: int | None = None,
    cluster_key: str | None = None,
    cluster_secret: str | None = None,
    kafka_options: dict | str | None = None,
    streaming: bool = False,
    spark_options: dict | None = None,
) -> dict[str, str]:
    """Options for ``format("kafka")`` reads.

    Saved offsets replace everything, and partitions missing from them start
    at the earliest offset; otherwise explicit initial offsets, then
    ``default_offset``. Selected partitions use ``assign``; offsets of other
    partitions are ignored with a warning. Spark's connector wants explicit
    offsets of every partition: they are written for the selected ones or for
    0 to ``partition_count`` - 1, and without either a partial list is refused.
    ``spark_options`` are source options of Spark's connector itself
    (``minPartitions``, ``failOnDataLoss``, ...). A rate is per partition, while
    ``maxOffsetsPerTrigger`` caps the whole topic: it is rate * partitions *
    ``batch_interval_s`` (the trigger's interval), and is left out with a
    warning where the number of partitions is not known.
    """
    failures: list[str] = []
    parts = parse_partitions(partitions, failures)
    initial = parse_initial_offsets(initial_offsets, failures)
    if failures:
        raise ContractError(failures)
    opts: dict[str, str] = {"kafka.bootstrap.servers": brokers}
    opts.update({f"kafka.{k}": v for k, v in FIXED_CLIENT_OPTIONS.items()})
    if parts:
        opts["assign"] = json.dumps({topic: parts})
    else:
        opts["subscribe"] = topic
    explicit, rest, kind = (saved_offsets, -2, "saved") if saved_offsets else (initial, default_offset, "initial")
    if not streaming and not saved_offsets and rest == -1:
        rest = -2  # a bounded read begins at the earliest: batch starts cannot be "latest"
    if explicit:
        known = parts or (list(range(partition_count)) if partition_count else sorted(explicit))
        outside = sorted(p for p in explicit if p not in known)
        if outside:
            warnings.warn(f"{kind} offsets of partitions {outside} are ignored: not in the selected partitions",
                          stacklevel=2)
        if not parts and not partition_count:
            raise ContractError([f"{kind} offsets without a partition list need partition_count: "
                                 "Spark's connector wants an offset of every partition"])
        start = {p: explicit.get(p, rest) for p in known}
        if not streaming and -1 in start.values():
            raise ContractError(["a bounded read cannot start at the latest offset"])
        opts["startingOffsets"] = starting_offsets_json(topic, start)
    else:
        opts["startingOffsets"] = "earliest" if rest == -2 else "latest"
        if rest >= 0:
            named = parts or (list(range(partition_count)) if partition_count else None)
            if named is None:
                raise ContractError(["a default start offset needs the partition list or partition_count"])
            opts["startingOffsets"] = starting_offsets_json(topic, dict.fromkeys(named, rest))
    if ending_offsets and not streaming:
        opts["endingOffsets"] = starting_offsets_json(topic, ending_offsets)
    if streaming and max_rate:
        n = len(parts) or partition_count
        if n:
            opts["maxOffsetsPerTrigger"] = str(max(1, int(max_rate * n * batch_interval_s)))
        else:
            warnings.warn("max_rate is per partition: give partitions or partition_count to apply it", stacklevel=2)
    opts.update(_security(cluster_key, cluster_secret))
    opts.update(_user_options(kafka_options))
    opts.update({k: str(v) for k, v in (spark_options or {}).items()})
    return opts


def kafka_write_options(
    brokers: str,
    topic: str,
    is_async: bool = False,
    compression: str = "none",
    cluster_key: str | None = None,
    cluster_secret: str | None = None,
    kafka_options: dict | str | None = None,
) -> dict[str, str]:
    """Options for ``format("kafka")`` writes."""
    if compression not in ("none", "gzip", "snappy"):
        raise ContractError([f"compression {compression!r} is not none, gzip or snappy"])
    opts = {"kafka.bootstrap.servers": brokers, "topic": topic}
    opts.update({f"kafka.{k}": v for k, v in FIXED_CLIENT_OPTIONS.items()})
    opts["kafka.compression.type"] = compression
    opts["kafka.acks"] = "1" if is_async else "all"
    opts.update(_security(cluster_key, cluster_secret))
    opts.update(_user_options(kafka_options))
    return opts


def kafka_range_options(source: dict, partitions: list[int] | None = None, ranges=None) -> dict[str, str]:
    """Options for a bounded Kafka read of ``[from, until)`` per partition.

    ``ranges`` is a range frame (one row per partition, collected: the same
    metadata Spark's Kafka source plans with) or ``{partition: (from, until)}``.
    """
    src = dict(source)
    if ranges is not None:
        if isinstance(ranges, dict):
            bounds = {int(p): (int(f), int(u)) for p, (f, u) in ranges.items()}
        else:
            rows = ranges.select("partition", "from_offset", "until_offset").collect()
            bounds = {int(r.partition): (int(r.from_offset), int(r.until_offset)) for r in rows}
        if partitions:
            bounds = {p: b for p, b in bounds.items() if p in set(partitions)}
        src["partitions"] = sorted(bounds)
        src["initial_offsets"] = {p: f for p, (f, _) in bounds.items()}
        src["ending_offsets"] = {p: u for p, (_, u) in bounds.items()}
    elif partitions:
        src["partitions"] = list(partitions)
    return kafka_read_options(**src)
