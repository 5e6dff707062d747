"""Offset bookkeeping on topic frames.

All inputs and outputs are DataFrames. A *range frame* has one row per
topic partition: ``[topic,] partition, from_offset, until_offset`` with
``from`` inclusive and ``until`` exclusive. Joins use (topic, partition)
where both sides have a topic; none is hinted, Spark chooses by size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicframe.plans.numbering import number_rows, running_sum
from topicframe.plans.small import known_rows, sized

EARLIEST = -2
LATEST = -1


def join_keys(left: DataFrame, right: DataFrame) -> list[str]:
    return ["topic", "partition"] if "topic" in left.columns and "topic" in right.columns else ["partition"]


def with_position_value(df: DataFrame, small: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with ``small``'s ``value`` of its (topic, partition) as ``name``, null where there is none."""
    keys = join_keys(df, small)
    side = small.select(*[F.col(k).alias(f"_tf_{k}") for k in keys], F.col(value).cast("bigint").alias(name))
    cond = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"_tf_{k}"))
        cond = term if cond is None else cond & term
    return df.join(side, cond, "left").drop(*[f"_tf_{k}" for k in keys])


def select_partitions(df: DataFrame, partitions: Iterable[int] | None) -> DataFrame:
    """Only the listed partitions; empty/None = all (A3). Pushed into the scan."""
    parts = [int(p) for p in (partitions or [])]
    return df.where(F.col("partition").isin(parts)) if parts else df


def list_partitions(df: DataFrame) -> DataFrame:
    """Distinct (topic, partition) of a topic frame (A4)."""
    return df.select("topic", "partition").distinct()


def partition_bounds(df: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per partition: earliest offset and latest = last offset + 1.

    One partial aggregate per task and a tiny final merge, so a hot partition
    costs nothing extra. Empty partitions have no rows; pass ``known``
    (``partition[, next_offset]``, e.g. a ledger or partition list) to list them
    with an empty range at their remembered offset (0 when unknown).
    """
    keys = [c for c in ("topic", "partition") if c in df.columns]
    bounds = df.groupBy(*keys).agg(
        F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("latest")
    )
    if known is None:
        return bounds
    nxt = F.col("next_offset") if "next_offset" in known.columns else F.lit(0)
    on = join_keys(bounds, known)
    k = known.select(*on, nxt.cast("bigint").alias("_tf_k"))
    joined = bounds.join(k, on, "full_outer")
    cols = [
        F.coalesce("earliest", "_tf_k").alias("earliest"),
        F.coalesce("latest", "_tf_k").alias("latest"),
    ]
    return joined.select(*keys, *cols)


def _bounds(df: DataFrame) -> DataFrame:
    return df if {"earliest", "latest"} <= set(df.columns) else partition_bounds(df)


def earliest_offsets(df: DataFrame) -> DataFrame:
    """Of a topic frame, or of bounds that are known already (a topic table's log has them)."""
    return _bounds(df).select("topic", "partition", "earliest")


def latest_offsets(df: DataFrame) -> DataFrame:
    return _bounds(df).select("topic", "partition", "latest")


def offsets_frame(spark: SparkSession, offsets: dict[int, int] | None, name: str = "offset") -> DataFrame:
    """``{partition: offset}`` → DataFrame ``partition int, <name> bigint``."""
    rows = [(int(p), int(o)) for p, o in (offsets or {}).items()]
    return known_rows(spark, rows, f"partition int, {name} bigint")


def resolve_start_offsets(
    partitions: DataFrame,
    saved: DataFrame | None = None,
    initial: DataFrame | dict | None = None,
    default: int = LATEST,
) -> DataFrame:
    """Start offset per partition.

    ``partitions`` has ``partition`` and ``earliest`` (with ``latest`` they are
    carried along, see :func:`resolve_sentinels`). A saved ledger
    (``[topic,] partition, next_offset``) with rows for these topics replaces
    everything, and partitions missing from it start at the earliest offset.
    Otherwise an explicit initial offset (``partition, offset``) wins over
    ``default``. The result may still hold the sentinels -2 (earliest) and -1 (latest).
    """
    spark = partitions.sparkSession
    keep = [c for c in ("topic", "partition", "earliest", "latest") if c in partitions.columns]
    if saved is not None:
        if "topic" in saved.columns and "topic" in partitions.columns:
            saved = saved.join(partitions.select("topic").distinct(), "topic", "left_semi")
        if saved.limit(1).count() > 0:
            return with_position_value(partitions, saved, "next_offset", "_tf_next").select(
                *keep, F.coalesce("_tf_next", "earliest").cast("bigint").alias("start_offset")
            )
    if isinstance(initial, dict) or initial is None:
        initial = offsets_frame(spark, initial)
    return with_position_value(partitions, initial, initial.columns[-1], "_tf_ini").select(
        *keep, F.coalesce("_tf_ini", F.lit(default)).cast("bigint").alias("start_offset")
    )


def resolve_sentinels(starts: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Replace -2 by the earliest and -1 by the latest offset.

    ``starts`` carries its bounds, or ``bounds`` has them. Output is a range
    frame ``[topic,] partition, from_offset, until_offset`` (until = latest,
    but never below from: a start beyond the end is an empty range). A
    sentinel without bounds for its partition fails the job with a message
    naming the partition.
    """
    if not {"earliest", "latest"} <= set(starts.columns):
        starts = with_position_value(starts, bounds, "earliest", "earliest")
        starts = with_position_value(starts, bounds, "latest", "latest")
    keys = [c for c in ("topic", "partition") if c in starts.columns]
    s = F.col("start_offset")
    missing = F.raise_error(
        F.concat(F.lit("no earliest/latest offset known for partition "), F.col("partition").cast("string"))
    )
    frm = (
        F.when(s.isin(EARLIEST, LATEST) & F.col("latest").isNull(), missing.cast("bigint"))
        .when(s == EARLIEST, F.col("earliest"))
        .when(s == LATEST, F.col("latest"))
        .otherwise(s)
    )
    return starts.select(*keys, frm.cast("bigint").alias("from_offset"), F.col("latest").cast("bigint").alias("_tf_l")).select(
        *keys, "from_offset", F.greatest("from_offset", "_tf_l").alias("until_offset")
    )


#: Intervals that a filter lists at most; more are joined.
MOST_INTERVALS = 500


def merged_intervals(ranges: DataFrame | list[tuple]) -> list[tuple[str | None, int, int, int]]:
    """(topic, partition, from, until) of the ranges that are not empty, those that meet joined; a null topic is any.

    The range frame has a row per topic partition, or some (read splits): the
    metadata Spark's Kafka source plans with too. Ranges that the driver has
    already come as a list of such tuples.
    """
    if isinstance(ranges, list):
        rows = [r for r in ranges if None not in r[1:] and r[3] > r[2]]
    else:
        topic = F.col("topic") if "topic" in ranges.columns else F.lit(None).cast("string")
        rows = ranges.where("until_offset > from_offset AND partition IS NOT NULL").select(topic.alias("topic"), "partition", "from_offset", "until_offset").collect()
    out: list[tuple[str | None, int, int, int]] = []
    for r in sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or "", *r[1:])):
        if out and out[-1][:2] == r[:2] and r[2] <= out[-1][3]:
            out[-1] = (*out[-1][:3], max(out[-1][3], r[3]))
        else:
            out.append(r)
    return out


def _any(terms: list[str]) -> str:
    """OR of the terms as a balanced tree."""
    while len(terms) > 1:
        terms = [f"({a} OR {b})" for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) - len(terms) % 2 :]
    return terms[0]


def range_predicate(intervals: list[tuple[str | None, int, int, int]]) -> Column:
    """Exactly the offsets of the intervals, each in its own partition.

    Spark takes the partitions out of it (folders are pruned); the lowest and
    highest offset are stated too, which it pushes into the scan.
    """
    if not intervals:
        return F.lit(False)
    by_place: dict[tuple, list[int]] = {}
    for topic, partition, low, high in intervals:
        by_place.setdefault((topic, low, high), []).append(partition)
    terms = []
    for (topic, low, high), partitions in by_place.items():
        named = "" if topic is None else f" AND topic = CAST(X'{topic.encode().hex()}' AS STRING)"
        terms.append(f"(`partition` IN ({', '.join(map(str, partitions))}) AND `offset` >= {low}L AND `offset` < {high}L{named})")
    low, high = min(i[2] for i in intervals), max(i[3] for i in intervals)
    # one text: a column object would be a call to the driver's JVM a term
    return F.expr(f"`offset` >= {low}L AND `offset` < {high}L AND ({_any(terms)})")


def slice_offsets(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows with ``from_offset <= offset < until_offset`` of their partition.

    The ranges become one static filter with an interval a partition. More
    than ``MOST_INTERVALS`` of them are stored and joined, and the filter
    keeps their partitions and the lowest and highest offset. Partitions
    without a range are dropped; overlapping ranges give a row once.
    """
    if "topic" not in df.columns:
        ranges = ranges.drop("topic")
    intervals = merged_intervals(ranges)
    if len(intervals) <= MOST_INTERVALS:
        return df.where(range_predicate(intervals))
    # folders, and the hull, are still pruned statically
    wide = [(None, p, min(i[2] for i in intervals), max(i[3] for i in intervals)) for p in sorted({i[1] for i in intervals})]
    known = known_rows(df.sparkSession, intervals, "_tf_t string, _tf_p int, _tf_from long, _tf_until long")
    here = (F.col("_tf_p") == F.col("partition")) & (F.col("offset") >= F.col("_tf_from")) & (F.col("offset") < F.col("_tf_until"))
    if "topic" in df.columns:
        here = here & (F.col("_tf_t").isNull() | (F.col("_tf_t") == F.col("topic")))
    return df.where(range_predicate(wide)).join(known, here, "left_semi")


def cap_rate(ranges: DataFrame, rate: int, interval_s: float = 1.0) -> DataFrame:
    """At most ``rate`` records per second per partition over one batch
    interval, and at least one, so that a short interval never stalls (A10); rate 0 = no cap."""
    if not rate:
        return ranges
    return cap_records(ranges, capped(rate, interval_s))


def capped(rate: int, interval_s: float) -> int:
    """Most records of a partition in one batch interval."""
    return max(1, int(rate * interval_s))


def cap_records(ranges: DataFrame, max_records: int) -> DataFrame:
    """At most ``max_records`` per partition per run; -1 = all."""
    if max_records is None or max_records < 0:
        return ranges
    return ranges.withColumn(
        "until_offset",
        F.greatest("from_offset", F.least("until_offset", F.col("from_offset") + F.lit(int(max_records)))),
    )


def estimate_read_bytes(ranges: DataFrame, avg_message_size: int | Column = 1024) -> DataFrame:
    """Read-size estimate per range: (until - from) * average message size."""
    avg = F.lit(avg_message_size) if isinstance(avg_message_size, int) else avg_message_size
    return ranges.withColumn(
        "est_bytes", ((F.col("until_offset") - F.col("from_offset")) * avg).cast("bigint")
    )


def order_messages(df: DataFrame, name: str = "pos") -> DataFrame:
    """Canonical order: partition, offset, then payload checksum.

    Adds ``name`` = 1-based global position, numbered without a single-task
    window (distributed prefix sums). Without a ``value`` column a ``crc``
    column orders duplicates, so a caller that needs no payload moves none.
    """
    crc = F.crc32("value") if "value" in df.columns else F.col("crc")
    return number_rows(df, [], ["partition", "offset", crc], name, start=1)


def message_sizes(df: DataFrame) -> DataFrame:
    """Messages and payload bytes per partition."""
    return df.groupBy("partition").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.octet_length("value"), F.lit(0))).cast("bigint").alias("bytes")
    )


def running_bytes(df: DataFrame, name: str = "running") -> DataFrame:
    """Payload bytes of each message and of all up to it in its partition.

    ``[topic,] partition, offset, bytes`` and ``name`` (inclusive). Only
    positions and sizes move; a partition of any size is many tasks.
    """
    keys = [c for c in ("topic", "partition") if c in df.columns]
    sizes = df.select(*keys, "offset", F.coalesce(F.octet_length("value"), F.lit(0)).cast("bigint").alias("bytes"))
    return running_sum(sizes, keys, ["offset"], "bytes", name)


def read_splits(df: DataFrame, target_bytes: int) -> DataFrame:
    """Ranges of about ``target_bytes`` each, so that one hot partition is many splits.

    ``[topic,] partition, split, from_offset, until_offset, n, bytes``. A split
    holds the messages that begin in the same stretch of ``target_bytes`` of
    their partition's bytes, so it has at most that and one message. The
    splits of a partition meet: a gap in the offsets belongs to the split
    before it. ``read_topic(ranges=...)`` and ``TopicTable.slice`` read them.
    """
    keys = [c for c in ("topic", "partition") if c in df.columns]
    sized_ = running_bytes(df).withColumn("split", F.floor((F.col("running") - F.col("bytes")) / F.lit(int(target_bytes))))
    splits = sized_.groupBy(*keys, "split").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("_tf_end"), F.count(F.lit(1)).alias("n"), F.sum("bytes").cast("bigint").alias("bytes")
    )
    # a row a split from here on; a stretch that no message begins in has none
    order = Window.partitionBy(*keys).orderBy("split")
    return splits.select(
        *keys, (F.row_number().over(order) - 1).alias("split"), "from_offset",
        F.coalesce(F.lead("from_offset").over(order), F.col("_tf_end")).alias("until_offset"), "n", "bytes",
    )


def assign_offsets(
    df: DataFrame,
    ledger: DataFrame | None = None,
    order_cols: list[str | Column] | None = None,
) -> DataFrame:
    """Offsets on append, as a broker assigns them.

    Per (topic, partition), rows get ``next_offset, next_offset + 1, ...``
    (``next_offset`` from the ledger, 0 when absent) in ``order_cols`` order;
    ties, and all rows without order columns, in the order they are sent.
    Numbering is distributed, so one hot partition is not one task.
    """
    group = [c for c in ("topic", "partition") if c in df.columns]
    base = df.drop("offset")
    if ledger is not None:
        base = with_position_value(base, sized(ledger, "ledger"), "next_offset", "_tf_next")
    else:
        base = base.withColumn("_tf_next", F.lit(None).cast("bigint"))
    out = number_rows(base, group, order_cols or [], "offset", start=F.coalesce("_tf_next", F.lit(0)))
    return out.drop("_tf_next")
