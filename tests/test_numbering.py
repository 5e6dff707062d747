"""Distributed numbering equals row_number, also with a hot group and ties."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from topicframe.plans.numbering import number_rows


def test_matches_row_number_with_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = 0 if i % 3 == 0 else rnd.randint(1, 20)  # group 0 holds a third of the rows
        rows.append((g, rnd.randint(0, 50), i))
    df = spark.createDataFrame(rows, "g int, ts int, id int")
    got = number_rows(df, ["g"], ["ts", "id"], "n", num_slices=16)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("ts", "id")) - 1)
    assert sorted(got.select("g", "id", "n").collect()) == sorted(want.select("g", "id", "n").collect())


def test_global_numbering_and_start_column(spark):
    df = spark.createDataFrame([(i % 5, i) for i in range(500)], "g int, id int")
    got = number_rows(df, [], ["id"], "pos", start=1, num_slices=7)
    assert sorted(r.pos for r in got.collect()) == list(range(1, 501))
    base = df.withColumn("b", F.col("g") * 1000)
    got2 = number_rows(base, ["g"], ["id"], "o", start=F.col("b"))
    by = {}
    for r in got2.collect():
        by.setdefault(r.g, []).append(r.o)
    assert all(sorted(v) == list(range(g * 1000, g * 1000 + 100)) for g, v in by.items())


def test_one_slice_per_task_is_the_only_shuffle(spark):
    df = spark.createDataFrame([(i % 2, i) for i in range(100)], "g int, id int")
    plan = number_rows(df, ["g"], ["id"], "n")._jdf.queryExecution().executedPlan().toString()
    # the sliced rows are read from one checkpoint; per-slice counts are small, so Spark broadcasts them
    assert "BroadcastHashJoin" in plan
    assert "rangepartitioning" not in plan


def test_aqe_sized_slices_with_hot_group(spark):
    rows = [(0 if i % 2 else i % 7, i // 3, i) for i in range(4000)]  # group 0: half the rows, ties on ts
    df = spark.createDataFrame(rows, "g int, ts int, id int")
    got = number_rows(df, ["g"], ["ts", "id"], "n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("ts", "id")) - 1)
    assert sorted(got.select("g", "id", "n").collect()) == sorted(want.select("g", "id", "n").collect())


def test_ties_are_dealt_over_slices_in_read_order(spark):
    df = spark.range(4000, numPartitions=4).select(F.lit(1).alias("g"), F.lit(None).cast("string").alias("key"), "id")
    got = number_rows(df, ["g"], ["key"], "n", num_slices=8).withColumn("task", F.spark_partition_id())
    rows = got.collect()
    assert [r.id for r in sorted(rows, key=lambda r: r.n)] == list(range(4000))
    assert [r.n for r in sorted(rows, key=lambda r: r.n)] == list(range(4000))


def test_repeated_and_null_keys_multiply_nothing(spark):
    rows = [(0 if i % 3 else None, None if i % 11 == 0 else i * 7 % 10, i % 2, "x" * (i % 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, ts int, id int, payload string")
    got = number_rows(df, ["g"], ["ts", "id"], "n", start=F.lit(10)).collect()
    assert sorted((str(r.g), r.payload) for r in got) == sorted((str(r[0]), r[3]) for r in rows)
    for g in (0, None):
        assert sorted(r.n for r in got if r.g == g) == list(range(10, 10 + sum(r[0] == g for r in rows)))
