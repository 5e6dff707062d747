import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from topicframe.sources.topic import TOPIC_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("topicframe-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="topicframe-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="topicframe-test-")


def make_topic(spark, rows, topic="t"):
    """rows: (partition, offset, key, value[, ts_ms]) with str/bytes/None key and value."""
    out = []
    for r in rows:
        p, o, k, v = r[:4]
        ts = r[4] if len(r) > 4 else 1_700_000_000_000 + o
        enc = lambda x: x.encode() if isinstance(x, str) else x
        out.append((enc(k), enc(v), topic, p, o, ts, 0))
    df = spark.createDataFrame(
        out, "key binary, value binary, topic string, partition int, offset bigint, ts_ms bigint, timestampType int"
    )
    return df.select(
        "key", "value", "topic", "partition", "offset", F.timestamp_millis("ts_ms").alias("timestamp"), "timestampType"
    ).select(*[f.name for f in TOPIC_SCHEMA.fields])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A frame of documents from (doc_id, text) rows, over a few partitions, with columns that clash with the operators' own."""

    def make(rows, extra=True):
        schema = "doc_id long, text string" + (", score string, shard string, N string, row string" if extra else "")
        rows = [(*r, *("x",) * 4) if extra else r for r in rows]
        return spark.createDataFrame(rows, schema).repartition(3)

    return make
