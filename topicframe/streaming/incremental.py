"""Bounded incremental reads with a ledger.

Each run: ledger → start offsets (A7) → sentinels (A8) → record cap (A11)
→ slice (A9) → user sink → ledger upsert (F2). The next run continues
where this one stopped; a capped run leaves the rest for later.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from topicframe.operators.ledger import LEDGER_DDL, LedgerStore, ledger_upsert
from topicframe.operators.offsets import (
    EARLIEST,
    cap_records,
    capped,
    partition_bounds,
    resolve_sentinels,
    resolve_start_offsets,
    select_partitions,
    slice_offsets,
)
from topicframe.plans.small import known_rows
from topicframe.sources.topic_table import TopicTable


def plan_ranges(
    topic: DataFrame | TopicTable,
    store: LedgerStore | None = None,
    saved: DataFrame | None = None,
    initial: DataFrame | dict | None = None,
    default: int = EARLIEST,
    max_records: int = -1,
    partitions: list[int] | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Offset ranges for the next run, one row per partition, computed once.

    ``bounds`` (``[topic,] partition, earliest, latest``, e.g. of a topic
    table's log) saves the scan of the topic that finds them; a topic table knows its own.
    """
    if bounds is None and isinstance(topic, TopicTable):
        bounds = topic.bounds()
    bounds = select_partitions(partition_bounds(topic) if bounds is None else bounds, partitions)
    if saved is None and store is not None:
        saved = store.read()
    starts = resolve_start_offsets(bounds, saved, initial, default)
    ranges = cap_records(resolve_sentinels(starts), max_records)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranges.schema.fields)
    return known_rows(ranges.sparkSession, [tuple(r) for r in ranges.collect()], ddl)  # a row a partition


def read_ranges(topic: DataFrame | TopicTable, ranges: DataFrame, partitions: list[int] | None = None) -> DataFrame:
    """The messages of the ranges: of a topic table only the files that hold them."""
    batch = topic.slice(ranges) if isinstance(topic, TopicTable) else slice_offsets(topic, ranges)
    return select_partitions(batch, partitions)


def run_incremental(
    topic: DataFrame | TopicTable,
    store: LedgerStore,
    sink: Callable[[DataFrame], None],
    max_records: int = -1,
    initial: DataFrame | dict | None = None,
    default: int = EARLIEST,
    partitions: list[int] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """One bounded run; returns the ranges it covered.

    The ledger is saved only after ``sink`` returned, so a failed run is
    repeated from the same offsets (at-least-once; idempotent sinks make it
    effectively-once).
    """
    previous = store.rows()
    ranges = plan_ranges(topic, saved=previous, initial=initial, default=default,
                         max_records=max_records, partitions=partitions, bounds=bounds)
    batch = read_ranges(topic, ranges, partitions)
    sink(transform(batch) if transform else batch)
    has_previous = previous.limit(1).count() > 0
    store.save(ledger_upsert(previous if has_previous else None, ranges))
    return ranges


def run_into_table(
    topic: DataFrame | TopicTable,
    target: TopicTable,
    reader: str,
    transform: Callable[[DataFrame], DataFrame],
    max_records: int = -1,
    initial: DataFrame | dict | None = None,
    default: int = EARLIEST,
    partitions: list[int] | None = None,
    order_cols: list | None = None,
) -> int | None:
    """One bounded run whose output and ledger are one commit of ``target`` (F2, F10); returns its version.

    ``transform`` turns the run's messages into an outbound frame. What
    ``reader`` has read is remembered by the commit that holds the output, so a
    crash leaves both or neither and the next run repeats nothing. Returns
    None, and commits nothing, when there is nothing to read.
    """
    previous = target.ledger(reader)
    ranges = plan_ranges(topic, saved=previous, initial=initial, default=default, max_records=max_records, partitions=partitions)
    new = ledger_upsert(previous if previous.limit(1).count() else None, ranges).select("topic", "partition", "next_offset").collect()  # a row a partition
    if not ranges.where("until_offset > from_offset").limit(1).count():
        return None
    done = [c.batch for c in target.commits() if c.reader == reader]
    return target.append(
        transform(read_ranges(topic, ranges, partitions)), batch_id=max(done, default=-1) + 1, order_cols=order_cols,
        writer=f"reader {reader}", reader=reader, ledger=[tuple(r) for r in new],
    )


def run_paced(
    table: TopicTable,
    store: LedgerStore,
    sink: Callable[[DataFrame, int], None],
    rate: int,
    interval_s: float = 1.0,
    wait: bool = True,
    runs: int | None = None,
    initial: DataFrame | dict | None = None,
    default: int = EARLIEST,
    partitions: list[int] | None = None,
    ahead: int = 1,
) -> int:
    """Drain a topic table at an exact rate per partition (A10); returns the number of runs.

    Spark's own limits cap files or the total of a trigger. Here each
    micro-run is planned from the log: from the ledger's offsets, at most
    ``rate`` x ``interval_s`` messages of each partition (one at least).
    ``sink(batch, run)`` gets them, then the ledger is saved, so a stopped
    drain goes on where it stopped and a failed run is repeated with the same
    range. ``run`` counts on from the ledger's versions, so it names the same
    batch when a run is repeated. The next run begins ``interval_s`` after
    this one began (``wait=False``: at once). Ends when nothing is left, or after ``runs``.

    The log and the ledger are read again when either has a version that this
    drain does not know; in between a run is planned from a row a partition
    on the driver. Up to ``ahead`` runs are in their sinks at a time, which
    must be idempotent by run and safe in threads if it is more than one; the
    ledger is saved run by run, in order, and no further than the first that fails.
    """
    done = 0
    position: dict[tuple, int] = {}  # next offsets, also of runs that are not saved yet
    ends: list[tuple] = []
    known, last = None, None
    flying: deque = deque()

    def finish() -> None:
        run, ledger, future = flying[0]
        if ahead > 1:
            future.result()
        store.save_rows(ledger, run)
        flying.popleft()

    with ThreadPoolExecutor(ahead) as pool:
        try:
            while runs is None or done < runs:
                began = time.monotonic()
                if not flying:
                    newest = store.newest()
                    if last is None or newest != last:
                        position, known = {tuple(r)[:2]: r.next_offset for r in store.rows().collect()}, None
                        last = newest
                versions = table.versions()
                if versions != known:
                    saved = known_rows(table.spark, [(*k, n) for k, n in position.items()], LEDGER_DDL)
                    planned = plan_ranges(table, saved=saved, initial=initial, default=default, partitions=partitions)
                    ends = [(r.topic, r.partition, r.from_offset, r.until_offset) for r in planned.collect()]  # a row a partition
                    known = versions
                starts = [(t, p, max(low, position.get((t, p), low)), high) for t, p, low, high in ends]
                now = [(t, p, low, max(low, min(high, low + capped(rate, interval_s)) if rate else high)) for t, p, low, high in starts]
                if not any(high > low for *_, low, high in now):
                    if not flying:
                        break
                    finish()
                    continue
                for t, p, _, high in now:
                    position[t, p] = max(high, position.get((t, p), high))
                last = 0 if last is None else last + 1
                batch = select_partitions(table.slice(now), partitions)
                future = pool.submit(sink, batch, last) if ahead > 1 else sink(batch, last)
                flying.append((last, [(*k, n) for k, n in position.items()], future))
                if len(flying) == ahead:
                    finish()
                done += 1
                if wait and (runs is None or done < runs):
                    time.sleep(max(0.0, interval_s - (time.monotonic() - began)))
            while flying:
                finish()
        finally:
            for *_, future in flying if ahead > 1 else ():
                future.cancel()
    return done
