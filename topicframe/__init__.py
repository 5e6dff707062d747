"""topicframe: analyse partitioned, offset-addressed message topics as Spark DataFrames.

A topic is a DataFrame with the column set of Spark's Kafka source
(``key, value, topic, partition, offset, timestamp, timestampType``).
Every operator takes DataFrames and returns DataFrames; nothing is
computed on the driver except metadata of bounded size.
"""

import sys

from pyspark import cloudpickle

# Ship the package by value inside UDF closures, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from topicframe.sources.topic import TOPIC_SCHEMA, topic_from_events, read_topic  # noqa: F401
from topicframe.session import get_session, work_dir  # noqa: F401

__all__ = ["TOPIC_SCHEMA", "topic_from_events", "read_topic", "get_session", "work_dir"]
