"""Cut lineage by writing a table in the shared checkpoint folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from topicframe.session import remove, work_dir

_scopes: list[list[str]] = []


@contextmanager
def collected() -> Iterator[list[str]]:
    """The folders that are materialised inside, for the caller to remove."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.remove(paths)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Folders that are materialised inside are removed at the end: for work
    whose result has been written when the block is left. :func:`keep_last` spares a result."""
    with collected() as paths:
        try:
            yield paths
        finally:
            for path in paths:
                remove(spark, path)


def keep_last(paths: list[str]) -> None:
    """The folder materialised last is not scratch of this block but of the one around it."""
    path = paths.pop()
    outer = _scopes.index(paths) - 1
    if outer >= 0:
        _scopes[outer].append(path)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet below ``spark.checkpoint.dir`` and read it back.

    One job, columnar and compressed; later passes read only the columns they
    use, and a lost executor never recomputes the upstream plan (which may
    hold nondeterministic steps such as range sampling).
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)
