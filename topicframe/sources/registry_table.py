"""A schema-registry table derived from the test tables.

``subject string, version int, id int, schema string``. Nation rows give
subjects ``<n_name>-value`` with three versions each (id = key*10+version);
the ``events`` topic gets ``events-value`` with three versions whose ids
500-502 are the ids the framed test topic carries.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_VALUE_FIELDS = [
    ("event_id", "long"),
    ("user_id", "long"),
    ("event_type", "string"),
    ("amount", "double"),
]
EVENTS_SCHEMA_BASE_ID = 500


def events_value_schema(version: int) -> str:
    """Avro JSON of version 1-3 of ``events-value``: v1 ids only, v2 adds the
    type, v3 adds the amount. Later fields are nullable with default null."""
    n = {1: 2, 2: 3, 3: 4}[version]
    fields = []
    for i, (name, typ) in enumerate(EVENTS_VALUE_FIELDS[:n]):
        if i < 2:
            fields.append({"name": name, "type": ["null", typ]})
        else:
            fields.append({"name": name, "type": ["null", typ], "default": None})
    return json.dumps({"type": "record", "name": "message", "fields": fields})


def registry_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir.rstrip('/')}/nation.parquet")
    field = lambda name, typ: F.concat(F.lit('{"name":"'), F.lit(name), F.lit('","type":"' + typ + '"}'))
    fields = F.concat_ws(
        ",",
        field("n_nationkey", "int"),
        F.when(F.col("version") >= 2, field("n_name", "string")),
        F.when(F.col("version") >= 3, field("n_regionkey", "int")),
    )
    per_version = nation.withColumn("version", F.explode(F.array(*[F.lit(v) for v in (1, 2, 3)])))
    nations = per_version.select(
        F.concat(F.col("n_name"), F.lit("-value")).alias("subject"),
        "version",
        (F.col("n_nationkey") * 10 + F.col("version")).cast("int").alias("id"),
        F.concat(F.lit('{"type":"record","name":"nation","fields":['), fields, F.lit("]}")).alias("schema"),
    )
    events = spark.createDataFrame(
        [("events-value", v, EVENTS_SCHEMA_BASE_ID + v - 1, events_value_schema(v)) for v in (1, 2, 3)],
        "subject string, version int, id int, schema string",
    )
    return nations.unionByName(events)
