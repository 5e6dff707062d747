"""Commits of topic tables: crashes, racing writers, file choice by the log, paced drains, output and ledger as one commit."""

import threading

import pytest
from conftest import make_topic
from pyspark.sql import functions as F

from topicframe.operators import offsets as off
from topicframe.operators.ledger import LedgerStore
from topicframe.plans import materialize as mat
from topicframe.sources import topic_table as tt
from topicframe.sources.topic import read_topic
from topicframe.sources.topic_table import CommitConflict, TopicTable
from topicframe.streaming import stream as st
from topicframe.streaming.incremental import run_incremental, run_into_table, run_paced


def _messages(spark, values, partition=0):
    return spark.createDataFrame([(v, partition) for v in values], "v string, partition int").select(
        F.lit("t").alias("topic"), "partition", F.lit(None).cast("binary").alias("key"), F.col("v").cast("binary").alias("value"))


def _values(df):
    return sorted(r.value.decode() for r in df.select("value").collect())


def _spoil(table, versions):
    """Make every file of the commits unreadable."""
    import glob

    for v in versions:
        for name in glob.glob(f"{table.data_path}/batch_id={v}/*/*.parquet"):
            with open(name, "wb") as f:
                f.write(b"not parquet")


def _drain(table, store, out):
    def sink(batch):
        out.extend(_values(batch))

    run_incremental(table, store, sink)


# ------------------------------------------------------------------ crashes


def test_no_message_is_lost_when_a_writer_dies_after_its_commit(spark, tmp_dir, monkeypatch):
    table, store, got = TopicTable(spark, f"{tmp_dir}/t", topic="t"), LedgerStore(spark, f"{tmp_dir}/ledger"), []
    table.append(_messages(spark, ["a", "b"]))
    _drain(TopicTable(spark, table.path), store, got)
    with monkeypatch.context() as m:
        m.setattr(tt, "rename", lambda *a: (_ for _ in ()).throw(OSError("the writer died")))
        with pytest.raises(OSError, match="died"):
            table.append(_messages(spark, ["c", "d"]))
    _drain(TopicTable(spark, table.path), store, got)  # the reader finishes the commit
    TopicTable(spark, table.path, topic="t").append(_messages(spark, ["e"]))
    _drain(TopicTable(spark, table.path), store, got)
    assert got == ["a", "b", "c", "d", "e"]
    assert _values(TopicTable(spark, table.path).read()) == got


def test_bounds_and_reads_agree_after_a_crash(spark, tmp_dir, monkeypatch):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    monkeypatch.setattr(tt, "rename", lambda *a: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        table.append(_messages(spark, ["a"]))
    monkeypatch.undo()
    other = TopicTable(spark, table.path)
    assert [(r.earliest, r.latest) for r in other.bounds().collect()] == [(0, 1)]
    assert _values(read_topic(spark, table.path)) == ["a"]


def test_a_writer_that_dies_before_its_commit_leaves_nothing(spark, tmp_dir, monkeypatch):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    table.append(_messages(spark, ["a"]))
    with monkeypatch.context() as m:
        m.setattr(tt, "create_new", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            table.append(_messages(spark, ["lost"]))
    table.append(_messages(spark, ["b"]))
    assert [(r.offset, r.value.decode()) for r in table.read().orderBy("offset").collect()] == [(0, "a"), (1, "b")]


def test_a_replay_after_a_crash_is_not_written_twice(spark, tmp_dir, monkeypatch):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    with monkeypatch.context() as m:
        m.setattr(tt, "rename", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            table.append(_messages(spark, ["a"]), batch_id=3, writer="w")
    again = TopicTable(spark, table.path, topic="t")
    assert again.append(_messages(spark, ["a"]), batch_id=3, writer="w") == 0
    assert _values(again.read()) == ["a"]


def test_of_two_writers_one_commits_and_the_other_is_told(spark, tmp_dir, monkeypatch):
    one, two = (TopicTable(spark, f"{tmp_dir}/t", topic="t") for _ in range(2))
    create = tt.create_new

    def late(*args):
        monkeypatch.setattr(tt, "create_new", create)
        two.append(_messages(spark, ["two"]))  # between the first one's numbering and its commit
        return create(*args)

    monkeypatch.setattr(tt, "create_new", late)
    with pytest.raises(CommitConflict):
        one.append(_messages(spark, ["one"]))
    one.append(_messages(spark, ["one"]))
    assert [(r.offset, r.value.decode()) for r in one.read().orderBy("offset").collect()] == [(0, "two"), (1, "one")]


def test_racing_threads_lose_nothing(spark, tmp_dir):
    errors, done = [], []

    def write(k):
        table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
        try:
            table.append(_messages(spark, [f"m{k}"]))
            done.append(f"m{k}")
        except CommitConflict as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    table = TopicTable(spark, f"{tmp_dir}/t")
    assert len(done) + len(errors) == 4 and done
    assert _values(table.read()) == sorted(done)
    assert sorted(r.offset for r in table.read().collect()) == list(range(len(done)))


def test_an_object_reads_each_log_entry_once(spark, tmp_dir, monkeypatch):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    for k in range(3):
        table.append(_messages(spark, [str(k)]))
    assert table.versions() == [0, 1, 2]
    monkeypatch.setattr(type(spark.read), "json", lambda *a: pytest.fail("an entry is read again"))
    assert table.versions() == [0, 1, 2] and len(table.commits()) == 3


# ------------------------------------------------------------------ streams that start late (A1)


def test_a_stream_from_the_end_reads_no_old_file(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    for k in range(6):
        table.append(_messages(spark, [f"old{k}"], partition=k % 2))
    start = st.stream_start(table, None, off.LATEST)
    table.append(_messages(spark, ["new"], partition=1))
    _spoil(table, range(6))
    out = f"{tmp_dir}/out"
    st.run_stream(st.read_topic_stream(spark, table, ledger=start), st.batch_folder_sink(out), f"{tmp_dir}/ckpt")
    assert _values(spark.read.parquet(out)) == ["new"]


def test_each_partition_starts_at_its_own_commit(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    for k in range(4):
        table.append(_messages(spark, [f"p{k % 2}-{k}", f"p{k % 2}-{k}b"], partition=k % 2))
    table.append(_messages(spark, ["p7"], partition=7))  # the ledger does not know it
    ledger = spark.createDataFrame([(0, 3), (1, 2)], "partition int, next_offset long")
    assert table.first_versions({(None, 0): 3, (None, 1): 2}) == {0: 2, 1: 3}
    _spoil(table, [0, 1])
    out = f"{tmp_dir}/out"
    st.run_stream(st.read_topic_stream(spark, table.path, ledger=ledger), st.batch_folder_sink(out), f"{tmp_dir}/ckpt")
    assert _values(spark.read.parquet(out)) == ["p0-2b", "p1-3", "p1-3b", "p7"]


def test_a_ledger_of_another_topic_skips_nothing(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t")
    table.append(_messages(spark, ["a"]))
    table.append(_messages(spark, ["x"]).withColumn("topic", F.lit("u")))
    ledger = spark.createDataFrame([("t", 0, 1)], "topic string, partition int, next_offset long")
    out = f"{tmp_dir}/out"
    st.run_stream(st.read_topic_stream(spark, table, ledger=ledger), st.batch_folder_sink(out), f"{tmp_dir}/ckpt")
    assert _values(spark.read.parquet(out)) == ["x"]


# ------------------------------------------------------------------ ranges by partition


RANGE = "partition int, from_offset long, until_offset long"


def test_a_slice_reads_only_files_of_its_intervals(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    for low in (0, 100, 200):
        table.put(make_topic(spark, [(0, low + k, None, f"a{low + k}") for k in range(100)]))
    table.put(make_topic(spark, [(1, 10**6 + k, None, f"b{k}") for k in range(50)]))
    table.put(make_topic(spark, [(1, 100 + k, None, f"c{k}") for k in range(50)]))
    ranges = spark.createDataFrame([(0, 100, 200), (1, 10**6, 10**6 + 9)], RANGE)
    _spoil(table, [0, 2, 4])  # inside the hull of both ranges, but of neither
    got = table.slice(ranges)
    assert _values(got) == sorted([f"a{k}" for k in range(100, 200)] + [f"b{k}" for k in range(9)])
    assert len(got.inputFiles()) == len([f for f in table.files().collect() if f.version in (1, 3)])
    assert table.slice(ranges.where("false")).count() == 0
    assert table.slice(spark.createDataFrame([(9, 0, 5)], RANGE)).count() == 0


@pytest.mark.parametrize("most", [500, 1])
def test_ranges_of_a_frame(spark, monkeypatch, most):
    monkeypatch.setattr(off, "MOST_INTERVALS", most)
    topic = make_topic(spark, [(p, k, None, f"{p}-{k}") for p in range(3) for k in range(20)])
    rows = [(0, 2, 5), (0, 4, 8), (1, 19, 40), (2, 6, 6), (2, None, 3), (None, 0, 9), (0, 15, 16)]
    want = sorted([f"0-{k}" for k in (2, 3, 4, 5, 6, 7, 15)] + ["1-19"])
    assert _values(off.slice_offsets(topic, spark.createDataFrame(rows, RANGE))) == want
    named = spark.createDataFrame([("t", *r) for r in rows] + [("u", 2, 0, 9)], f"topic string, {RANGE}")
    assert _values(off.slice_offsets(topic, named)) == want
    assert _values(off.slice_offsets(topic, named.where("false"))) == []


# ------------------------------------------------------------------ bytes


def test_running_bytes_and_splits_of_a_hot_partition(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else 300 rows are one slice
    sizes = [(0, k, (k * 37) % 50) for k in range(300)] + [(1, 5, 900), (1, 9, 0), (1, 40, 3)]
    topic = make_topic(spark, [(p, o, None, "x" * n) for p, o, n in sizes] + [(2, 0, None, None)]).repartition(4)
    total = {}
    want = []
    for p, o, n in sizes + [(2, 0, 0)]:
        total[p] = total.get(p, 0) + n
        want.append((p, o, n, total[p]))
    with mat.collected() as paths:
        got = off.running_bytes(topic.drop("topic"))
        assert sorted(map(tuple, got.select("partition", "offset", "bytes", "running").collect())) == sorted(want)
        slices = spark.read.parquet(paths[0])
        assert "value" not in slices.columns and slices.where("partition = 0").select("_tf_task").distinct().count() > 1
    splits = sorted(map(tuple, off.read_splits(topic, 400).select("partition", "split", "from_offset", "until_offset", "n", "bytes").collect()))
    assert sum(s[4] for s in splits) == 304 and sum(s[5] for s in splits) == sum(n for *_, n in sizes)
    assert len([s for s in splits if s[0] == 0]) > 10 and all(s[5] <= 400 + 900 for s in splits)
    for a, b in zip(splits, splits[1:]):
        if a[0] == b[0]:
            assert a[3] == b[2] and b[1] == a[1] + 1
    parts = [off.slice_offsets(topic, off.read_splits(topic, 400).where(F.col("split") % 2 == k)).count() for k in (0, 1)]
    assert sum(parts) == 304
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# ------------------------------------------------------------------ paced drains (A10)


def test_a_paced_drain_keeps_the_rate_and_delivers_all(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    table.put(make_topic(spark, [(p, k, None, f"{p}-{k}") for p, n in ((0, 25), (1, 4)) for k in range(n)]))
    store, seen = LedgerStore(spark, f"{tmp_dir}/ledger"), {}

    def sink(batch, run):
        for r in batch.groupBy("partition").agg(F.count("*").alias("n")).collect():
            seen[run, r.partition] = r.n

    assert run_paced(table, store, sink, rate=5, interval_s=2, wait=False, runs=1) == 1
    assert seen == {(0, 0): 10, (0, 1): 4}
    assert run_paced(TopicTable(spark, table.path), store, sink, rate=5, interval_s=2, wait=False) == 2  # goes on where it stopped
    assert seen == {(0, 0): 10, (0, 1): 4, (1, 0): 10, (2, 0): 5}
    assert run_paced(table, store, sink, rate=5, interval_s=2) == 0


def test_a_failed_paced_run_is_repeated_with_the_same_range(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    table.put(make_topic(spark, [(0, k, None, str(k)) for k in range(7)]))
    store, seen = LedgerStore(spark, f"{tmp_dir}/ledger"), []

    def sink(batch, run):
        if run == 1 and len(seen) == 1:
            seen.append("failed")
            raise RuntimeError("no")
        seen.append((run, _values(batch)))

    with pytest.raises(RuntimeError):
        run_paced(table, store, sink, rate=3, wait=False)
    run_paced(table, store, sink, rate=3, wait=False)
    assert seen == [(0, ["0", "1", "2"]), "failed", (1, ["3", "4", "5"]), (2, ["6"])]


@pytest.mark.parametrize("ahead", [1, 3])
def test_a_long_drain_reads_log_and_ledger_once(spark, tmp_dir, monkeypatch, ahead):
    from topicframe.streaming import incremental as inc

    table = TopicTable(spark, f"{tmp_dir}/t", topic="it's")
    table.put(make_topic(spark, [(p, k, None, f"{p}-{k}") for p, n in ((0, 23), (1, 4)) for k in range(n)], topic="it's"))
    store, seen, plans = LedgerStore(spark, f"{tmp_dir}/ledger"), {}, []
    plan = inc.plan_ranges
    monkeypatch.setattr(inc, "plan_ranges", lambda *a, **k: plans.append(1) or plan(*a, **k))
    assert run_paced(table, store, lambda b, run: seen.update({run: _values(b)}), rate=2, wait=False, ahead=ahead) == 12
    assert len(plans) == 1
    assert {run: sorted(v) for run, v in seen.items()} == {
        run: sorted(f"{p}-{k}" for p, n in ((0, 23), (1, 4)) for k in range(2 * run, min(n, 2 * run + 2))) for run in range(12)}
    assert sorted(tuple(r) for r in store.read().collect()) == [("it's", 0, 23), ("it's", 1, 4)]
    assert store.newest() == 11


def test_a_null_partition_is_not_passed_over(spark, tmp_dir):
    with pytest.raises(ValueError, match="null partition"):
        LedgerStore(spark, f"{tmp_dir}/ledger").save_rows([("t", 0, 3), ("t", None, 2)], 0)


def test_runs_ahead_of_a_failed_one_are_repeated(spark, tmp_dir):
    table = TopicTable(spark, f"{tmp_dir}/t", topic="t")
    table.put(make_topic(spark, [(0, k, None, str(k)) for k in range(9)]))
    store, seen, failed = LedgerStore(spark, f"{tmp_dir}/ledger"), {}, []

    def sink(batch, run):
        if run == 1 and not failed:
            failed.append(run)
            raise RuntimeError("no")
        seen[run] = _values(batch)

    with pytest.raises(RuntimeError):
        run_paced(table, store, sink, rate=2, wait=False, ahead=3)
    assert store.newest() == 0 and [tuple(r) for r in store.read().collect()] == [("t", 0, 2)]
    run_paced(table, store, sink, rate=2, wait=False, ahead=3)
    assert seen == {0: ["0", "1"], 1: ["2", "3"], 2: ["4", "5"], 3: ["6", "7"], 4: ["8"]}


# ------------------------------------------------------------------ output and ledger as one commit


def _copy(batch):
    return batch.select("partition", "key", "value", F.col("offset").alias("sent"))


@pytest.mark.parametrize("crash", ["create_new", "rename"])
def test_a_crash_repeats_and_loses_nothing(spark, tmp_dir, monkeypatch, crash):
    source, target = TopicTable(spark, f"{tmp_dir}/s", topic="t"), TopicTable(spark, f"{tmp_dir}/t", topic="copy")
    source.put(make_topic(spark, [(0, k, None, str(k)) for k in range(7)]))
    assert run_into_table(source, target, "r", _copy, max_records=3, order_cols=["sent"]) == 0
    with monkeypatch.context() as m:
        m.setattr(tt, crash, lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            run_into_table(source, target, "r", _copy, max_records=3, order_cols=["sent"])
    target = TopicTable(spark, target.path, topic="copy")
    while run_into_table(source, target, "r", _copy, max_records=3, order_cols=["sent"]) is not None:
        pass
    assert [(r.offset, r.value.decode()) for r in target.read().orderBy("offset").collect()] == [(k, str(k)) for k in range(7)]
    assert [tuple(r) for r in target.ledger("r").collect()] == [("t", 0, 7)]
    assert target.ledger("another").count() == 0


# ------------------------------------------------------------------ dead letters


def test_a_replayed_batch_adds_no_dead_letters(spark, tmp_dir):
    batch = make_topic(spark, [(0, 0, None, "1,a"), (0, 1, None, "broken"), (0, 2, None, None), (0, 3, None, "")]).select("offset", "value")
    write = st.dead_letter_sink(f"{tmp_dir}/out", "csv", "id int, name string")
    for _ in range(2):
        write(batch, 0)
    write(batch.limit(0), 1)
    rows = {r.offset: r for r in spark.read.parquet(f"{tmp_dir}/out/batch_id=0").collect()}
    assert len(rows) == 4 and [rows[k].bad for k in range(4)] == ["false", "true", "false", "true"]  # folder names
    assert rows[0].id == 1 and rows[0].dead_letter is None and bytes(rows[1].dead_letter) == b"broken"
