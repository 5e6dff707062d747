"""Distributed, skew-proof row numbering.

``row_number() over (partition by g order by o)`` puts every row of a
group into one task. A topic partition routinely holds a third of a topic,
so offsets must be numbered without that. The plan is the one RDD
``zipWithIndex`` uses, expressed with DataFrame operators:

1. ``repartitionByRange(n, g..., o...)`` + ``sortWithinPartitions``: a hot
   group is spread over many tasks; each task holds one contiguous slice
   of the global order. ``monotonically_increasing_id`` gives
   (task, position-in-task).
2. The sliced rows are written once as a parquet table in the shared
   checkpoint folder. Two separately planned range exchanges sample
   different boundaries, so both passes below must read one
   materialisation; it also cuts the lineage, so a lost executor never
   re-slices the data differently. The count pass reads two columns only.
3. Per (group, task): count and first position. That frame has at most
   ``n + groups`` rows, independent of the data size; it is stored, so that
   Spark broadcasts it if it is in fact small.
4. A running sum of counts over tasks gives each slice its base offset.

Rows that tie on all order columns are told apart by a generated row id,
so even a topic of identical messages is dealt over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicframe.plans.materialize import materialize
from topicframe.plans.small import sized

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def number_rows(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str | Column],
    name: str,
    start: Column | int = 0,
    num_slices: int | None = None,
) -> DataFrame:
    """Add ``name`` = 0-based position of the row in its group (+ ``start``).

    Ties on ``order_cols`` are numbered in the order the rows are read; no
    order columns number them all that way. ``start`` may be a column of
    ``df`` (e.g. a per-group base offset).
    """
    group = list(group_cols)
    df = df.withColumn("_tf_row", F.monotonically_increasing_id())
    keys = _cols(group) + _cols(order_cols) + [F.col("_tf_row")]
    # AQE may coalesce adjacent ranges to its advisory size; slices stay contiguous
    ranged = df.repartitionByRange(num_slices, *keys) if num_slices else df.repartitionByRange(*keys)
    sliced = (
        ranged
        .sortWithinPartitions(*keys)
        .drop("_tf_row")
        .withColumn("_tf_mid", F.monotonically_increasing_id())
        .withColumn("_tf_task", F.shiftright(F.col("_tf_mid"), _POS_BITS))
        .withColumn("_tf_pos", F.col("_tf_mid").bitwiseAND(F.lit(_POS_MASK)))
        .drop("_tf_mid")
    )
    sliced = materialize(sliced, "slices")
    stats = sliced.groupBy(*group, "_tf_task").agg(
        F.count(F.lit(1)).alias("_tf_n"), F.min("_tf_pos").alias("_tf_first")
    )
    before = Window.partitionBy(*group).orderBy("_tf_task").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(
        *[F.col(c).alias(f"_tf_g{i}") for i, c in enumerate(group)],
        F.col("_tf_task").alias("_tf_t"),
        (F.coalesce(F.sum("_tf_n").over(before), F.lit(0)) - F.col("_tf_first")).alias("_tf_base"),
    )
    stats = sized(stats, "slice-bases")
    same = F.col("_tf_task") == F.col("_tf_t")
    for i, c in enumerate(group):  # null-safe: rows of a null group are numbered too
        same = same & F.col(c).eqNullSafe(F.col(f"_tf_g{i}"))
    start_col = F.lit(start) if isinstance(start, int) else start
    out = sliced.join(stats, same, "inner")
    return out.withColumn(name, (F.col("_tf_base") + F.col("_tf_pos") + start_col).cast("bigint")).drop(
        "_tf_task", "_tf_pos", "_tf_base", "_tf_t", *[f"_tf_g{i}" for i in range(len(group))]
    )


def running_sum(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """Add ``name`` = sum of ``value`` (bigint) over the rows of the group up to this one, itself included.

    The same plan as :func:`number_rows`: slices of the order, sums inside
    a slice, and the sums of the slices before. No task holds more than a
    slice of a group. Ties follow the order in which the rows are read.
    """
    group = list(group_cols)
    keys = [*group, "_tf_task"]
    df = df.withColumn("_tf_row", F.monotonically_increasing_id())
    order = _cols(group) + _cols(order_cols) + [F.col("_tf_row")]
    sliced = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tf_row")
        .withColumn("_tf_mid", F.monotonically_increasing_id())
        .withColumn("_tf_task", F.shiftright(F.col("_tf_mid"), _POS_BITS))
    )
    sliced = materialize(sliced, "slices")
    inside = Window.partitionBy(*keys).orderBy("_tf_mid").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*group).orderBy("_tf_task").rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy(*keys).agg(F.sum(value).alias("_tf_sum"))
    sums = sums.select(
        *[F.col(c).alias(f"_tf_g{i}") for i, c in enumerate(group)], F.col("_tf_task").alias("_tf_t"),
        F.coalesce(F.sum("_tf_sum").over(before), F.lit(0)).alias("_tf_base"),
    )
    sums = sized(sums, "slice-sums")
    same = F.col("_tf_task") == F.col("_tf_t")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_tf_g{i}"))
    out = sliced.withColumn("_tf_here", F.sum(value).over(inside)).join(sums, same, "inner")
    return out.withColumn(name, (F.col("_tf_base") + F.coalesce("_tf_here", F.lit(0))).cast("bigint")).drop(
        "_tf_task", "_tf_mid", "_tf_here", "_tf_base", "_tf_t", *[f"_tf_g{i}" for i in range(len(group))]
    )
