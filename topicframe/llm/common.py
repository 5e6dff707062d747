"""Small helpers that the operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from functools import partial, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicframe.plans.materialize import collected, keep_last, materialize, scratch
from topicframe.session import remove

__all__ = ["bounded_batches", "bucket_of_id", "checkpointed", "documents", "fresh_name", "gathered", "keep_last", "most_frequent", "read_table", "release", "scratch", "stage"]


#: Rows of an Arrow batch between Spark and Python: texts are long, and the JVM holds a batch outside its heap.
BATCH_ROWS = 2000


def bounded_batches(query: Callable) -> Callable:
    """A query or stage (its first argument is the session) with Arrow batches of at most BATCH_ROWS rows."""

    @wraps(query)
    def run(spark, *args):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return query(spark, *args)

    return run


def release(spark) -> None:
    """Let Spark remove the shuffle files of work that has been written.

    Its cleaner waits until the driver's JVM collects garbage, which a small
    driver of a long job rarely does by itself.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_before: list[str] = []


def stage(work: Callable | None = None, *, first: bool = False) -> Callable:
    """A pipeline stage (spark, docs, sf_dir) whose tables in the shared folder go when the next stage begins.

    The stage's result must have been written by then, as a pipeline's stages are.
    The ``first`` stage begins a run: what the last stage of a run before keeps stays.
    """
    if work is None:
        return partial(stage, first=first)

    @wraps(work)
    def run(spark, docs, sf_dir):
        if not first:
            for path in _before:
                remove(spark, path)
        with collected() as paths:
            out = work(spark, docs, sf_dir)
        _before[:] = paths
        return out

    return bounded_batches(run)


def gathered(batches: Iterator[pa.RecordBatch], size: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """The batches joined to larger ones of about ``size`` bytes."""
    held: list[pa.RecordBatch] = []

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield joined()
            held = []
    if held:
        yield joined()


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text")))


def bucket_of_id(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def checkpointed(df: DataFrame, name: str) -> DataFrame:
    """Written to the cluster's shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    return materialize(df, name)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def frequency_step(column: str) -> Column:
    """Eighths of doublings of a count."""
    return F.floor(F.log2(column) * 8)


def least_step(counts: DataFrame, most: int) -> int | None:
    """The smallest frequency_step that at most ``most`` rows of ``counts`` (n) reach; None if too many reach the greatest one."""
    bound, seen = None, 0
    for step, rows in counts.groupBy(frequency_step("n").alias("step")).count().orderBy(F.desc("step")).collect():  # 8 a doubling
        seen += rows
        if seen > most:
            break
        bound = step
    return bound


def most_frequent(counts: DataFrame, most: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Keys (uint64, sorted) and counts of at most ``most`` rows of ``counts`` (key, n).

    They are the rows with at least the smallest count that lets no more in,
    to an eighth of a doubling; nothing is sorted in one task.
    """
    counts = counts.where(F.col("n") >= least)
    bound = least_step(counts, most)
    if bound is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = counts.where(frequency_step("n") >= bound).select("key", "n").toArrow()
    key, n = got["key"].to_numpy().view(np.uint64), got["n"].to_numpy()
    order = np.argsort(key)
    return key[order], n[order]
