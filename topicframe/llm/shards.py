"""Sharding by histogram sort: near-equal bytes, one exchange.

Rows are ordered by (hash of the text, doc_id), so equal texts lie side by
side, and a group of copies too large for one shard is cut by doc_id.

1. One pass writes each row's key and size (24 bytes a row) to the shared
   folder; later rounds read only that.
2. A round: every partition counts exactly the bytes and rows below each
   candidate key (``numpy.searchsorted`` over its keys and one histogram), Spark sums
   them, and the driver narrows the interval of each splitter to the two
   probes around its target. New probes are keys drawn from inside the
   interval, at a rate that its exact row count gives. It stops for a
   splitter when its bytes are within tolerance of the target, or one key
   is left between its two probes; then the nearer one is taken.
3. The exact counts below the final splitters are each shard's first row
   and size, so rows need only one exchange: each goes to the range of its
   shard and is numbered inside it. A shard is ``ranges_per_shard`` ranges,
   so a task is a small part of a shard.

Probes a round: splitters x ``probes``; the driver holds nothing else.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicframe.llm.common import checkpointed, documents, fresh_name
from topicframe.llm.spans import mix

ROW_BYTES = 16
LAW = "bytes"
_BIG = 1 << 64


def _to_key(h: int, i: int) -> int:
    """One 128-bit integer that orders as (hash, id)."""
    return ((h + (1 << 63)) << 64) | (i + (1 << 63))


def _of_key(key: int) -> tuple[int, int]:
    return (key >> 64) - (1 << 63), (key & (_BIG - 1)) - (1 << 63)


def _split(probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    parts = [_of_key(p) for p in probes]
    return np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts], np.int64)


def _rank(high: np.ndarray, low: np.ndarray, h: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Number of probes (high, low; sorted) that are not above each key (h, i)."""
    at, end = np.searchsorted(high, h, "left"), np.searchsorted(high, h, "right")
    tied = np.flatnonzero(at < end)
    if len(tied):
        order = tied[np.argsort(h[tied], kind="stable")]
        for k in np.split(order, np.flatnonzero(np.diff(h[order])) + 1):
            a, b = at[k[0]], end[k[0]]
            at[k] = a + np.searchsorted(low[a:b], i[k], "right")
    return at


def _below(keys: DataFrame, probes: list[int]) -> list[tuple[int, int]]:
    """Exact (bytes, rows) of keys below each probe (sorted): one pass, a histogram a partition."""
    high, low = _split(probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(high) + 1, np.int64), np.zeros(len(high) + 1, np.int64)
        for b in batches:
            h, i, s = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            at = _rank(high, low, h, i)
            np.add.at(size, at, s)
            rows += np.bincount(at, minlength=len(rows))
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_pydict({"probe": some, "size": size[some], "n": rows[some]})

    out = keys.mapInArrow(count, "probe long, size long, n long").groupBy("probe").agg(F.sum("size"), F.sum("n")).collect()
    size, n = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for probe, s, k in out:
        size[probe], n[probe] = s, k
    return [(int(s), int(k)) for s, k in zip(np.cumsum(size)[:-1], np.cumsum(n)[:-1], strict=True)]


def _drawn(keys: DataFrame, spans: list[tuple[int, int, float]], turn: int) -> list[int]:
    """Keys of ``keys`` inside the intervals (from, to, share that is drawn); the intervals do not overlap."""
    ends = sorted({x for a, b, _ in spans for x in (a, b) if x < 1 << 128})
    high, low = _split(ends)
    share = np.zeros(len(ends) + 1)
    place = {end: k for k, end in enumerate(ends)}
    for a, _, rate in spans:
        share[place[a] + 1] = rate

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, i = (b.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            rate = share[_rank(high, low, h, i)]
            luck = mix(h.view(np.uint64) + mix(i.view(np.uint64) + np.uint64(turn))) / 2.0**64
            mine = luck < rate
            yield pa.RecordBatch.from_pydict({"h": h[mine], "i": i[mine]})

    return [_to_key(r[0], r[1]) for r in keys.mapInArrow(draw, "h long, i long").distinct().collect()]


def find_splitters(keys: DataFrame, n_ranges: int, tolerance: float, probes: int = 48) -> tuple[list[int], list[tuple[int, int]], int]:
    """Keys that cut the rows of ``keys`` (h, i, size) into ``n_ranges`` of near-equal bytes.

    Returns the splitters, (bytes, rows) below each, and the rounds taken.
    ``tolerance`` is a share of a range's bytes; about ``probes`` keys are
    drawn from each splitter's interval in a round.
    """
    rows, total = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ideal = total / n_ranges
    low, high = _to_key(-(1 << 63), -(1 << 63)), _to_key((1 << 63) - 1, (1 << 63) - 1) + 1
    spans = [[low, (0, 0), high, (total, rows)] for _ in range(1, n_ranges)]
    found: dict[int, tuple[int, tuple[int, int]]] = {}
    rounds = 0
    while True:
        for k, (a, below_a, b, below_b) in enumerate(spans):
            target = ideal * (k + 1)
            best = min(((a, below_a), (b, below_b)), key=lambda x: abs(x[1][0] - target))
            if abs(best[1][0] - target) <= tolerance * ideal or below_b[1] - below_a[1] <= 1 or b - a <= 1:
                found[k] = best
        todo = [k for k in range(n_ranges - 1) if k not in found]
        if not todo:
            return [found[k][0] for k in range(n_ranges - 1)], [found[k][1] for k in range(n_ranges - 1)], rounds
        rounds += 1
        apart: dict[tuple[int, int], float] = {}  # several splitters can share an interval
        for k in todo:
            a, below_a, b, below_b = spans[k]
            apart[a, b] = apart.get((a, b), 0.0) + probes / max(1, below_b[1] - below_a[1])
        drawn = _drawn(keys, [(a, b, rate) for (a, b), rate in apart.items()], rounds)
        # a key and its successor: what lies between them is the ties of that key
        asked = sorted({p for key in drawn for p in (key, key + 1) if p < high})
        below = _below(keys, asked) if asked else []
        bytes_below = [b[0] for b in below]
        for k in todo:
            target, span = ideal * (k + 1), spans[k]
            after = bisect_right(bytes_below, target)  # the first probe with more bytes below it
            if after and asked[after - 1] > span[0]:
                span[0], span[1] = asked[after - 1], below[after - 1]
            if after < len(asked) and asked[after] < span[2]:
                span[2], span[3] = asked[after], below[after]


def larger_than_a_shard(sizes: list[int], total: int, n_shards: int) -> list[int]:
    """Of the largest sizes (descending): those that are more than an even share of what is left without them, all but one shard at most."""
    out: list[int] = []
    for size in sizes[: n_shards - 1]:
        if size * (n_shards - len(out)) <= total - sum(out):
            break
        out.append(size)
    return out


def shard_documents(
    docs: DataFrame,
    n_shards: int = 40,
    ranges_per_shard: int | None = None,
    tolerance: float = 0.002,
    id_column: str = "doc_id",
    text_column: str = "text",
    range_bytes: int = 128 << 20,
) -> DataFrame:
    """``docs`` with size, shard and slot (and the ``range`` that held the row).

    A row's size is its text's UTF-8 bytes plus 16. Shards are consecutive in
    the order of (text hash, id); each boundary is the row boundary nearest
    to its share, or within ``tolerance`` of a range's bytes. Slots count
    from 0 in that order. ``ranges_per_shard`` defaults to the shard's bytes
    over ``range_bytes``. A row that is larger than an even share of the bytes
    has one of the last shards to itself, and the others share the rest evenly.

    Null and empty texts have size 16. Rows without an id sort first in their
    group. Rows that agree in text and id stay in one shard, in any order. With fewer rows
    than shards some shards are empty; no rows give none. Columns named like the new ones are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("size", "shard", "slot", "range")
    h, i = fresh_name(docs, "h"), fresh_name(docs, "i")
    keyed = docs.withColumns(
        {
            h: F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))),
            i: F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(1 << 63))),
            "size": F.coalesce(F.octet_length(text_column), F.lit(0)).cast("bigint") + ROW_BYTES,
        }
    )
    keys = checkpointed(keyed.select(F.col(h).alias("h"), F.col(i).alias("i"), "size"), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    # at most one row a shard can be larger than a shard
    largest = [r[0] for r in keys.orderBy(F.desc("size")).limit(n_shards).select("size").collect()]
    alone = larger_than_a_shard(largest, total, n_shards)
    shared = n_shards - len(alone)
    parts = ranges_per_shard or max(1, math.ceil((total - sum(alone)) / shared / range_bytes))
    n = shared * parts
    fits = F.col("size") < F.lit(alone[-1]) if alone else F.lit(True)
    splitters, below, _ = find_splitters(keys.where(fits), n, tolerance)

    # a range is the number of splitters not above the row's key; splitters may be equal, and those behind the last row cut nothing
    cuts = [_of_key(s) for s in splitters if s < 1 << 128]
    number = _range_of(cuts, h, i)
    starts = [0, *[b[1] for b in below]]
    first_row = [starts[r] - starts[r // parts * parts] for r in range(n)]
    r, first = fresh_name(docs, "_range"), fresh_name(docs, "_first")
    base = spark.createDataFrame([(k, k // parts, first_row[k]) for k in range(n)], f"{r} int, shard int, {first} long")
    placed = keyed.where(fits).withColumn("range", number).repartitionById(n, F.col("range"))
    # the partitioning by id already puts a range into one task; the window sorts there
    inside = Window.partitionBy("range").orderBy(h, i)
    ranked = placed.withColumn("slot", F.row_number().over(inside).cast("bigint") - 1)
    out = ranked.join(F.broadcast(base), F.col("range") == F.col(r))  # n rows
    columns = [*docs.columns, "size", "shard", "slot", "range"]
    out = out.withColumn("slot", F.col("slot") + F.col(first)).select(*columns)
    if not alone:
        return out
    # as many rows as shards at most
    each = F.row_number().over(Window.orderBy(h, i)) - 1
    own = keyed.where(~fits).withColumn("shard", (each + shared).cast("int")).withColumns({"slot": F.lit(0).cast("bigint"), "range": (F.col("shard") - shared + n).cast("int")})
    return out.unionByName(own.select(*columns))


def _range_of(cuts: list[tuple[int, int]], h: str, i: str):
    """Number of cuts not above (h, i), by a binary search written as nested conditions (depth log2 of the cuts)."""

    def search(a: int, b: int):
        if a == b:
            return F.lit(a)
        mid = (a + b) // 2
        ch, ci = cuts[mid]
        above = (F.col(h) > F.lit(ch)) | ((F.col(h) == F.lit(ch)) & (F.col(i) >= F.lit(ci)))
        return F.when(above, search(mid + 1, b)).otherwise(search(a, mid))

    return search(0, len(cuts)).cast("int")


def op5_histogram_shards(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return shard_documents(docs.withColumn("text_crc32", crc), 40).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
