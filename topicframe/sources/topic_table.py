"""Topic table sink: append messages to a parquet topic table.

Layout: ``<path>/data/batch_id=V/partition=P/*.parquet``, a commit log
``<path>/_log/v=V.json`` (writer, its batch, the offset range of each topic
partition, and a reader's ledger if the commit carries one) and the offset
range of every file in ``<path>/_log/files``. A commit

1. numbers messages after the log's last offsets and writes them to a staged
   folder of its own,
2. creates the log entry of the next version ``V``, which fails if another
   writer has created it: that writer's messages took the same offsets, so
   this commit ends with :class:`CommitConflict` and leaves nothing,
3. renames the staged folder to ``data/batch_id=V``.

The log entry is the commit. Whoever looks at the log next, a writer or a
reader, does step 3 if the committing writer died before it, so what the log
promises can always be read. A batch that the log already has (same writer,
same batch) is not written again, so a replay delivers nothing twice. A file
never changes, and an entry is read once by an object of this class.

The entry is created by a hard link on a local file system and by a rename
that refuses to overwrite elsewhere; both the entry and the folder need a
file system with atomic renames, which plain object stores do not have.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicframe.operators.offsets import assign_offsets, merged_intervals, range_predicate
from topicframe.plans.materialize import scratch
from topicframe.plans.small import known_rows
from topicframe.session import create_new, list_dirs, list_files, path_exists, remove, rename
from topicframe.sources.topic import TOPIC_COLUMNS, TOPIC_SCHEMA

# Stored columns plus the folder-level partition columns.
TOPIC_TABLE_SCHEMA = T.StructType(
    [f for f in TOPIC_SCHEMA.fields if f.name != "partition"]
    + [T.StructField("batch_id", T.IntegerType(), True), T.StructField("partition", T.IntegerType(), True)]
)

# Columns read back from a just-written batch folder (an empty batch has no files).
_WRITTEN = T.StructType(
    [T.StructField("topic", T.StringType()), T.StructField("offset", T.LongType()),
     T.StructField("partition", T.IntegerType())]
)
_RANGE = "topic string, partition int, from_offset long, until_offset long"
_ENTRY = (
    f"version int, writer string, batch long, id string, ranges array<struct<{_RANGE.replace(' ', ':').replace(',:', ',')}>>, "
    "reader string, ledger array<struct<topic:string,partition:int,next_offset:long>>"
)
_FILES = f"id string, file string, {_RANGE}"


class CommitConflict(RuntimeError):
    """Another writer committed the version that this commit was numbered for; append again."""


class TopicTable:
    def __init__(self, spark: SparkSession, path: str, topic: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.topic = topic
        self._entries: dict[int, T.Row] = {}
        self._listed: tuple[list[int], list[tuple]] = ([], [])

    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    # ------------------------------------------------------------- commit log

    def commits(self) -> list[T.Row]:
        """All log entries by version; each is a row of at most one range a partition. Entries
        that are known already are not read again, and folders of dead writers are moved in place."""
        names = list_files(self.spark, f"{self.path}/_log")
        new = [v for v in sorted(int(n[2:-5]) for n in names if n.startswith("v=") and n.endswith(".json")) if v not in self._entries]
        if new:
            rows = self.spark.read.schema(_ENTRY).json([f"{self.path}/_log/v={v}.json" for v in new]).collect()
            there = set(list_dirs(self.spark, self.data_path))
            for row in sorted(rows, key=lambda r: r.version):
                if f"batch_id={row.version}" not in there:
                    self._place(row.version, row.id)
                self._entries[row.version] = row
        return [self._entries[v] for v in sorted(self._entries)]

    def _place(self, version: int, staged: str) -> None:
        """The staged folder of a commit becomes its data folder; another may have done it meanwhile."""
        target = f"{self.data_path}/batch_id={version}"
        try:
            rename(self.spark, f"{self.path}/_staged/{staged}", target)
        except OSError:
            if not path_exists(self.spark, target):
                raise

    def versions(self) -> list[int]:
        return [c.version for c in self.commits()]

    def _ranges(self) -> list[tuple]:
        return [(c.version, c.writer, c.batch, r.topic, r.partition, r.from_offset, r.until_offset) for c in self.commits() for r in c.ranges]

    def log(self) -> DataFrame:
        """version, writer, batch, topic, partition, from_offset, until_offset of every commit that has messages."""
        return known_rows(self.spark, self._ranges(), f"version int, writer string, batch long, {_RANGE}")

    def bounds(self) -> DataFrame:
        """topic, partition, earliest, latest from the log: no message is read."""
        found: dict[tuple, tuple] = {}
        for *_, topic, partition, low, high in self._ranges():
            a, b = found.get((topic, partition), (low, high))
            found[topic, partition] = (min(a, low), max(b, high))
        rows = [(*k, *v) for k, v in sorted(found.items(), key=str)]
        return known_rows(self.spark, rows, "topic string, partition int, earliest long, latest long")

    def next_offsets(self) -> DataFrame:
        """The table's ledger: topic, partition, next_offset."""
        return self.bounds().select("topic", "partition", F.col("latest").alias("next_offset"))

    def files(self) -> DataFrame:
        """version, topic, partition, file (relative to the data folder), from_offset, until_offset of every file."""
        ids = [(c.id, c.version) for c in self.commits()]
        if not ids:
            return known_rows(self.spark, [], f"version int, topic string, partition int, {_FILES.split(', ', 1)[1]}").select(
                "version", "topic", "partition", "file", "from_offset", "until_offset")
        found = self.spark.read.schema(_FILES).json([f"{self.path}/_log/files/{i}" for i, _ in ids])
        known = known_rows(self.spark, ids, "id string, version int")
        path = F.concat(F.lit("batch_id="), F.col("version"), F.lit("/partition="), F.col("partition"), F.lit("/"), F.col("file"))
        return found.join(known, "id").select("version", "topic", "partition", path.alias("file"), "from_offset", "until_offset")

    def first_versions(self, starts: dict[tuple[str | None, int], int]) -> dict[int, int]:
        """Per partition the first version with a message at or after its start (the next version if there is none).

        ``starts`` maps (topic, partition) to an offset; a null topic speaks for any.
        """
        commits, out = self.commits(), {}
        end = commits[-1].version + 1 if commits else 0
        for (topic, partition), start in starts.items():
            hit = [c.version for c in commits for r in c.ranges if r.partition == partition and topic in (None, r.topic) and r.until_offset > start]
            out[partition] = min([out.get(partition, end), *hit[:1]])
        return out

    def ledger(self, reader: str) -> DataFrame:
        """What ``reader`` has read, as of its last commit to this table: topic, partition, next_offset (no rows before the first)."""
        own = [c for c in self.commits() if c.reader == reader]
        rows = [tuple(x) for x in own[-1].ledger] if own else []
        return known_rows(self.spark, rows, "topic string, partition int, next_offset long")

    def _commit(
        self, frame_of, writer: str | None, batch: int | None, compression: str | None,
        reader: str | None = None, ledger: list[tuple] | None = None,
    ) -> int:
        commits = self.commits()
        if writer is not None:
            done = [c.version for c in commits if c.writer == writer and c.batch == batch]
            if done:
                return done[-1]
        version = commits[-1].version + 1 if commits else 0
        own = uuid.uuid4().hex
        staged, listed = f"{self.path}/_staged/{own}", f"{self.path}/_log/files/{own}"
        with scratch(self.spark):  # the numbered slices go when the batch is written
            w = frame_of().write.mode("overwrite").partitionBy("partition")
            if compression:
                w = w.option("compression", compression)
            w.parquet(staged)
        # the ranges come from the written files: a two-column scan
        written = self.spark.read.schema(_WRITTEN).parquet(staged).select(
            F.lit(own).alias("id"), F.col("_metadata.file_name").alias("file"), "topic", "partition", "offset")
        written.groupBy("id", "file", "topic", "partition").agg(
            F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
        ).write.json(listed)
        ranges = self.spark.read.schema(_FILES).json(listed).groupBy("topic", "partition").agg(
            F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset")).collect()
        entry = {
            "version": version, "writer": writer or own, "batch": -1 if batch is None else batch, "id": own,
            "ranges": [r.asDict() for r in ranges], "reader": reader,
            "ledger": [dict(zip(("topic", "partition", "next_offset"), x, strict=True)) for x in ledger or []],
        }
        if not create_new(self.spark, f"{self.path}/_log/v={version}.json", json.dumps(entry)):
            remove(self.spark, staged)
            remove(self.spark, listed)
            raise CommitConflict(f"version {version} of {self.path} was committed by another writer")
        self._place(version, own)
        return version

    # ------------------------------------------------------------- writes and reads

    def append(
        self,
        messages: DataFrame,
        batch_id: int | None = None,
        order_cols: list[str | Column] | None = None,
        compression: str | None = None,
        writer: str | None = None,
        reader: str | None = None,
        ledger: list[tuple] | None = None,
    ) -> int:
        """Append an outbound frame (``topic, partition, timestamp, key, value``); returns the version.

        Rows with a null partition must have been routed before (see
        ``encode.route``). Offsets follow ``order_cols``; ties, and everything
        without them, keep the order in which the rows are sent. With a
        ``writer`` (e.g. a stream's checkpoint) the commit is known by
        (writer, ``batch_id``) and done once. ``ledger`` (topic, partition,
        next_offset) is remembered for ``reader`` by the same commit.
        """
        if writer is not None and batch_id is None:
            raise ValueError("a named writer needs the number of its batch")

        def numbered() -> DataFrame:
            frame = messages
            if "topic" not in frame.columns or self.topic:
                frame = frame.withColumn("topic", F.lit(self.topic))
            if "timestamp" not in frame.columns:
                frame = frame.withColumn("timestamp", F.current_timestamp())
            frame = frame.withColumn("timestampType", F.lit(0)).withColumn(
                "partition",
                F.when(F.col("partition").isNull(), F.raise_error(F.lit("message without a target partition")))
                .otherwise(F.col("partition"))
                .cast("int"),
            )
            out = assign_offsets(frame, self.next_offsets(), order_cols).select(*TOPIC_COLUMNS)
            return out.sortWithinPartitions("partition", "offset")

        return self._commit(numbered, writer, batch_id, compression, reader, ledger)

    def put(self, topic_frame: DataFrame, batch_id: int | None = None, writer: str | None = None) -> int:
        """Store a frame that already carries offsets (e.g. a copy of a topic).

        Rows are dealt by offset range, so that each file covers a narrow
        range and offset filters skip the others.
        """
        return self._commit(
            lambda: topic_frame.select(*TOPIC_COLUMNS).repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset"),
            writer, batch_id, None,
        )

    def _read(self, *paths: str) -> DataFrame:
        df = self.spark.read.schema(TOPIC_TABLE_SCHEMA).option("basePath", self.data_path).parquet(*paths)
        return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in TOPIC_SCHEMA.fields])

    def read(self) -> DataFrame:
        """The topic frame (Kafka source columns) of the committed batches; partition
        pruning and offset pushdown apply to filters on it."""
        if not self.commits():
            return self.spark.createDataFrame([], TOPIC_SCHEMA)
        return self._read(self.data_path)

    def slice(self, ranges: DataFrame | list[tuple]) -> DataFrame:
        """The messages of ``ranges`` (``[topic,] partition, from_offset, until_offset``, A9).

        Only files that hold offsets of one of the ranges are read: they are
        looked up in the log, one interval a partition or more. Ranges that
        the driver has already come as a list of such tuples with their
        topic; the files of the log are then kept for the next slice.
        """
        wanted = merged_intervals(ranges)
        if not wanted:
            return self.spark.createDataFrame([], TOPIC_SCHEMA)
        if isinstance(ranges, list):
            versions = self.versions()
            if versions != self._listed[0]:
                # a row a file, as Spark's own file index
                found = self.files().select("topic", "partition", "from_offset", "until_offset", "file").collect()
                self._listed = versions, [tuple(r) for r in found]
            paths = {f for t, p, low, high, f in self._listed[1] if any(x[0] in (None, t) and x[1] == p and low < x[3] and high > x[2] for x in wanted)}
        else:
            known = known_rows(self.spark, wanted, "topic string, partition int, low long, high long")
            at = (F.col("w.topic").isNull() | (F.col("w.topic") == F.col("f.topic"))) & (F.col("w.partition") == F.col("f.partition"))
            overlap = (F.col("from_offset") < F.col("high")) & (F.col("until_offset") > F.col("low"))
            paths = [r.file for r in self.files().alias("f").join(known.alias("w"), at & overlap).select("file").distinct().collect()]
        if not paths:
            return self.spark.createDataFrame([], TOPIC_SCHEMA)
        return self._read(*[f"{self.data_path}/{p}" for p in sorted(paths)]).where(range_predicate(wanted))

    def drop(self) -> None:
        """Remove the table's folder."""
        remove(self.spark, self.path)
        self._entries, self._listed = {}, ([], [])
