"""Streaming topic source and sink.

A topic stream is a streaming DataFrame with the Kafka source columns:
``format("kafka")`` when the connector is on the class path, otherwise a
stored topic table folder read with the file source. Offsets are tracked
by the query checkpoint (F7); ``foreachBatch`` sinks are idempotent by
batch id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicframe.operators.ledger import LedgerStore, batch_ranges, ledger_upsert, resume_from_ledger
from topicframe.operators.offsets import resolve_sentinels, resolve_start_offsets, select_partitions
from topicframe.sources.topic import TOPIC_COLUMNS
from topicframe.sources.topic_table import TOPIC_TABLE_SCHEMA, TopicTable


# Message position that travels beside records until the ledger is saved.
POSITION = {"_topic": "topic", "_partition": "partition", "_offset": "offset"}


def read_topic_stream(
    spark: SparkSession,
    source: str | TopicTable | dict,
    partitions: list[int] | None = None,
    max_files_per_trigger: int | None = None,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """Unbounded topic scan (A1).

    ``source``: Kafka options (see ``sources.kafka.kafka_read_options``) or a
    topic table or its folder (its committed files are streamed one by one).
    ``ledger`` (``[topic,] partition, next_offset``) starts each partition at its
    remembered offset (F3): the table's log tells the first commit of each
    partition that has it, and the folders of earlier ones are not read; the
    exact offset is a stream-static join. For Kafka pass ``saved_offsets`` in
    the options instead.
    """
    if isinstance(source, dict):
        from topicframe.sources.kafka import kafka_read_options

        reader = spark.readStream.format("kafka").options(**kafka_read_options(streaming=True, **source))
        return select_partitions(reader.load(), partitions)
    # the folder layout batch_id=N/partition=P is discovered as partition columns
    reader = spark.readStream.schema(TOPIC_TABLE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    table = source if isinstance(source, TopicTable) else TopicTable(spark, source)
    df = reader.option("basePath", table.data_path).parquet(table.data_path)
    if ledger is not None:
        df = df.where(unread_commits(table, ledger))
    df = select_partitions(df.select(*TOPIC_COLUMNS), partitions)
    return resume_from_ledger(df, ledger) if ledger is not None else df


def unread_commits(table: TopicTable, ledger: DataFrame) -> Column:
    """A filter on folders alone (batch_id, partition): commits that can hold a message at or after
    the ledger's offsets. Partitions that the ledger does not name are taken whole."""
    topic = F.col("topic") if "topic" in ledger.columns else F.lit(None).cast("string")
    rows = ledger.where("partition IS NOT NULL AND next_offset IS NOT NULL").select(topic.alias("topic"), "partition", "next_offset").collect()  # a row a topic partition
    first = table.first_versions({(r.topic, r.partition): r.next_offset for r in rows})
    # another topic of the table may have the same partition: the ledger does not speak for it
    named = {r.topic for r in rows}
    if None not in named and any(r.topic not in named for c in table.commits() for r in c.ranges):
        return F.lit(True)
    keep = ~F.col("partition").isin(list(first)) if first else F.lit(True)
    for version in sorted(set(first.values())):
        keep = keep | (F.col("partition").isin([p for p, v in first.items() if v == version]) & (F.col("batch_id") >= version))
    return keep


def stream_start(
    table: TopicTable,
    initial: dict | None,
    default: int,
    saved: DataFrame | None = None,
    starts: LedgerStore | None = None,
) -> DataFrame:
    """Start offsets of a stream over a topic table (A7): ``topic, partition, next_offset``.

    "latest" means the end of the table when the stream starts for the first
    time. ``starts`` remembers what was resolved then, so a restart from a
    checkpoint skips nothing that came in between; without it the offsets are
    resolved again at every start.
    """
    if starts is not None and starts.newest() is not None:
        return starts.read()
    resolved = resolve_sentinels(resolve_start_offsets(table.bounds(), saved, initial, default))
    resolved = resolved.select("topic", "partition", F.col("from_offset").alias("next_offset"))
    if starts is None:
        return resolved
    starts.save(resolved)
    return starts.read()


def run_stream(
    df: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    timeout_s: float | None = None,
) -> StreamingQuery:
    """Start a ``foreachBatch`` query; with ``availableNow`` (default) wait until
    all available data is processed (F8). The checkpoint gives resume (F7).
    If that takes longer than ``timeout_s`` the query is stopped and
    TimeoutError raised: a partial result is never taken for a whole one."""
    trig = trigger or {"availableNow": True}
    q = df.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**trig).start()
    if trig.get("availableNow") or trig.get("once"):
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            q.stop()
            raise TimeoutError(f"the stream was not done after {timeout_s} s; its checkpoint resumes it")
        if q.exception() is not None:
            raise q.exception()
    return q


def batch_folder_sink(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing each micro-batch to ``path/batch_id=N``
    with overwrite: a replayed batch rewrites its own folder (effectively-once)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def dead_letter_sink(path: str, fmt: str, schema, value_col: str = "value", bad: str = "bad", **decoding) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes good records and malformed messages of a micro-batch in one pass.

    Each message is decoded once, and one write puts both halves into
    ``path/batch_id=N/<bad>=false`` and ``...=true``, so they share a batch id
    and a replayed batch rewrites both. Malformed messages keep their payload
    as ``dead_letter``, which is null for good ones.
    """
    from topicframe.operators.decode import split_malformed

    def write(batch: DataFrame, batch_id: int) -> None:
        flagged = split_malformed(batch, fmt, schema, value_col=value_col, flag=bad, **decoding)
        out = flagged.withColumn("dead_letter", F.when(F.col(bad), F.col(value_col))).drop(value_col)
        out.write.mode("overwrite").partitionBy(bad).parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def topic_table_sink(table: TopicTable, writer: str, order_cols: list | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function appending each micro-batch to a topic table.

    ``writer`` names the stream (its checkpoint): a batch that it replays is
    not written again, and another stream's batch of the same number is another commit.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, batch_id=batch_id, order_cols=order_cols, writer=writer)

    return write


def ledger_tracking_sink(
    store: LedgerStore, inner: Callable[[DataFrame, int], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """Wrap a ``foreachBatch`` function so that, after the batch is written, the
    next offsets of the batch are saved as a new ledger version (F1, F2).

    The batch is a topic frame, or records with the position columns of
    ``open_source(keep_position=True)``, which ``inner`` does not see. The
    ledger comes from the batch's own positions (a second, column-pruned read
    of the micro-batch), so it never runs ahead of finished work; a batch
    with no rows saves nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        has_position = set(POSITION) <= set(batch.columns)
        if inner is not None:
            inner(batch.drop(*POSITION) if has_position else batch, batch_id)
        place = batch.select(*[F.col(c if has_position else name).alias(name) for c, name in POSITION.items()])
        ranges = batch_ranges(place)
        previous = store.read()
        new = ledger_upsert(previous if previous.limit(1).count() else None, ranges)
        if new.limit(1).count():
            store.save(new)

    return write


def write_topic_stream(
    messages: DataFrame,
    table: TopicTable | dict,
    checkpoint: str,
    trigger: dict | None = None,
    order_cols: list | None = None,
) -> StreamingQuery:
    """Streaming write of an outbound frame (E2): to a topic table through
    ``foreachBatch`` (the checkpoint names the writer), or to Kafka with
    ``writeStream.format("kafka")``."""
    if isinstance(table, dict):
        from topicframe.sources.kafka import kafka_write_options

        q = (
            messages.select("topic", "partition", "key", "value")
            .writeStream.format("kafka")
            .options(**kafka_write_options(**table))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .start()
        )
        return q
    return run_stream(messages, topic_table_sink(table, checkpoint, order_cols), checkpoint, trigger)
