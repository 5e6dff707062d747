"""Offset ledger: remembered next offsets per partition.

A ledger is a DataFrame ``[topic,] partition, next_offset`` (one row per
topic partition). Its JSON form is ``{"partitionOffsets":{"0":5,"1":7}}``.
:class:`LedgerStore` keeps versions of it in a folder on the shared file
system: each save writes a new version folder through Spark's commit
protocol and reads take the newest complete one, so a crash never leaves
a torn ledger and a replayed batch id rewrites its own version.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicframe.operators.offsets import with_position_value
from topicframe.plans.small import known_rows, sized
from topicframe.session import list_dirs, path_exists, remove, write_file

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("next_offset", T.LongType(), True),
    ]
)
LEDGER_DDL = "topic string, partition int, next_offset bigint"
_JSON_SCHEMA = "partitionOffsets map<string, bigint>"


def batch_ranges(df: DataFrame) -> DataFrame:
    """Offset range of each partition in a (micro-)batch (F1):
    ``topic, partition, from_offset, until_offset``."""
    return df.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def ledger_upsert(previous: DataFrame | None, ranges: DataFrame) -> DataFrame:
    """New ledger after a batch (F2): per partition the larger of the
    remembered next offset and the batch's ``until_offset``; partitions the
    batch did not touch keep their entry."""
    topic = ["topic"] if "topic" in ranges.columns and (previous is None or "topic" in previous.columns) else []
    nxt = ranges.select(*topic, "partition", F.col("until_offset").alias("_tf_until"))
    if previous is None:
        return nxt.select(*topic, "partition", F.col("_tf_until").alias("next_offset"))
    prev = previous.select(*topic, "partition", F.col("next_offset").alias("_tf_prev"))
    joined = prev.join(nxt, [*topic, "partition"], "full_outer")
    return joined.select(
        *topic, "partition", F.greatest(F.col("_tf_prev"), F.col("_tf_until")).cast("bigint").alias("next_offset")
    )


def ledger_to_json(ledger: DataFrame) -> DataFrame:
    """One JSON text per topic (F4): ``topic, ledger_json``. The ledger has one
    row per partition, so the collected map is bounded by the partition count."""
    keys = ["topic"] if "topic" in ledger.columns else []
    entries = F.map_from_entries(
        F.array_sort(F.collect_list(F.struct(F.col("partition").cast("string"), F.col("next_offset"))))
    )
    return ledger.groupBy(*keys).agg(
        F.to_json(F.struct(entries.alias("partitionOffsets"))).alias("ledger_json")
    )


def ledger_from_json(df: DataFrame, col: str = "ledger_json") -> DataFrame:
    """Parse ledger JSON texts back to rows ``[topic,] partition, next_offset``.
    Text that is not a ledger fails the task."""
    parsed = df.withColumn("_tf_l", F.from_json(F.col(col), _JSON_SCHEMA, {"mode": "FAILFAST"}))
    keep = [c for c in df.columns if c != col]
    return parsed.select(*keep, F.explode("_tf_l.partitionOffsets").alias("_tf_p", "next_offset")).select(
        *keep, F.col("_tf_p").cast("int").alias("partition"), "next_offset"
    )


def ledger_path(directory: str, namespace: str, pipeline: str) -> str:
    """``<dir>/<namespace>.<pipeline>.offsets.json``."""
    return f"{directory.rstrip('/')}/{namespace}.{pipeline}.offsets.json"


# Versions that stay; older ones are removed on save.
KEPT_VERSIONS = 20


class LedgerStore:
    """Versioned ledger folder (F5): absent → empty ledger, bad JSON → error."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folders(self) -> list[int]:
        return sorted(int(name[2:]) for name in list_dirs(self.spark, self.path) if name.startswith("v="))

    def _complete(self, version: int) -> bool:
        return path_exists(self.spark, f"{self.path}/v={version}/_SUCCESS")

    def versions(self) -> list[int]:
        return [v for v in self._folders() if self._complete(v)]

    def newest(self, before: int | None = None) -> int | None:
        """The newest complete version (below ``before``): one listing and, as a rule, one check."""
        for v in reversed(self._folders()):
            if (before is None or v < before) and self._complete(v):
                return v
        return None

    def read(self, before: int | None = None) -> DataFrame:
        """Newest complete version (strictly before ``before`` if given)."""
        newest = self.newest(before)
        if newest is None:
            return known_rows(self.spark, [], LEDGER_DDL)
        text = self.spark.read.text(f"{self.path}/v={newest}").withColumnRenamed("value", "ledger_json")
        rows = text.select(F.get_json_object("ledger_json", "$.topic").alias("topic"), "ledger_json")
        return ledger_from_json(rows).select("topic", "partition", "next_offset")

    def rows(self) -> DataFrame:
        """The newest ledger, read once: a row a topic partition, kept in the plan."""
        return known_rows(self.spark, [tuple(r) for r in self.read().collect()], LEDGER_DDL)

    def save(self, ledger: DataFrame, version: int | None = None) -> int:
        """Write ``ledger`` as version ``version`` (default: newest + 1)."""
        if version is None:
            newest = self.newest()
            version = 0 if newest is None else newest + 1
        keys = ["topic"] if "topic" in ledger.columns else []
        entries = F.map_from_entries(
            F.array_sort(F.collect_list(F.struct(F.col("partition").cast("string"), F.col("next_offset"))))
        )
        fields = [F.col("topic")] if keys else []
        doc = ledger.groupBy(*keys).agg(F.to_json(F.struct(*fields, entries.alias("partitionOffsets"))).alias("value"))
        doc.select("value").coalesce(1).write.mode("overwrite").text(f"{self.path}/v={version}")
        self._forget()
        return version

    def save_rows(self, rows: list[tuple], version: int) -> int:
        """As :meth:`save`, for (topic, partition, next_offset) that the driver knows: no Spark job.
        The version is complete once its marker is there, which is written last."""
        if any(partition is None for _, partition, _ in rows):
            raise ValueError("a ledger cannot hold the offset of a null partition")
        docs: dict[str | None, dict[str, int]] = {}
        for topic, partition, offset in sorted(rows, key=lambda r: (r[0] or "", str(r[1]))):
            docs.setdefault(topic, {})[str(partition)] = offset
        lines = [json.dumps(({} if t is None else {"topic": t}) | {"partitionOffsets": d}, ensure_ascii=False, separators=(",", ":")) for t, d in docs.items()]
        folder = f"{self.path}/v={version}"
        remove(self.spark, folder)
        write_file(self.spark, f"{folder}/part-00000.txt", "".join(f"{x}\n" for x in lines))
        write_file(self.spark, f"{folder}/_SUCCESS", "")
        if version % KEPT_VERSIONS == 0:  # so at most twice as many stay
            self._forget()
        return version

    def _forget(self) -> None:
        for old in self._folders()[:-KEPT_VERSIONS]:
            remove(self.spark, f"{self.path}/v={old}")


def resume_from_ledger(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows at or after the remembered next offset of their (topic, partition)
    (F3); partitions absent from the ledger are read from the start."""
    known = sized(ledger, "ledger")
    return (
        with_position_value(df, known, "next_offset", "_tf_next")
        .where(F.col("offset") >= F.coalesce(F.col("_tf_next"), F.lit(0)))
        .drop("_tf_next")
    )
