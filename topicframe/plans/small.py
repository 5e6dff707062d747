"""Small sides of joins, with their size on record.

Spark broadcasts a join side whose size it knows to be small. The size of
an aggregate or of rows made on the driver is not known when the join is
planned, so such a frame is written to the shared folder first: its files'
size then decides between broadcast and shuffle, at any data size, and no
hint overrides it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicframe.plans.materialize import materialize

#: Rows that are written into the plan; more become tasks.
MOST_LITERALS = 2000


def sized(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored and read back, so that joins are planned by its real size."""
    return materialize(df, name)


def known_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A few rows of numbers and strings that the driver knows (a row a topic partition, say) as a
    literal of the plan: Spark sees that they are few, and reading them is one small task."""
    schema = T.StructType.fromDDL(ddl)
    if len(rows) > MOST_LITERALS:
        return spark.createDataFrame(list(rows), schema)
    text = json.dumps([dict(zip(schema.fieldNames(), row, strict=True)) for row in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), T.ArrayType(schema))))
