"""Schema registry as a table, registry wire frames, and Avro payloads.

The registry is a DataFrame ``subject string, version int, id int, schema
string`` (schema = Avro JSON text), not an HTTP client. Messages framed
for a registry carry ``0x00``, a 4-byte big-endian schema id, then the
datum. Everything is column expressions: one branch a writer schema of the
topic's subject, each datum resolved onto the reader's record.

A datum is binary or in Avro's JSON encoding (``encoding="json"``). Binary
datums are read and written by Spark's own ``from_avro`` and ``to_avro``,
which need the spark-avro module; without it they are refused with one error.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicframe.functions.columns import col_of, from_int32_be, int32_be
from topicframe.schema import ContractError, SchemaError, avro_to_spark, spark_to_avro

MAGIC = 0


def latest_schemas(registry: DataFrame) -> DataFrame:
    """Latest version per subject (D3): ``subject, version, id, schema``."""
    latest = F.max_by(F.struct("version", "id", "schema"), "version")
    return registry.groupBy("subject").agg(latest.alias("_tf_l")).select(
        "subject", "_tf_l.version", "_tf_l.id", "_tf_l.schema"
    )


def subject_schemas(registry: DataFrame, subject: str) -> dict[int, object]:
    """Schema id → parsed schema of the versions of one subject (the writers a topic can have)."""
    rows = registry.where(F.col("subject") == subject).select("id", "schema").collect()
    if not rows:
        raise SchemaError(f"subject {subject!r} is not in the registry")
    return {int(r["id"]): json.loads(r["schema"]) for r in rows}


def _latest(registry: DataFrame, subject: str) -> tuple[int, object]:
    rows = latest_schemas(registry.where(F.col("subject") == subject)).collect()  # <= 1 row
    if not rows:
        raise SchemaError(f"subject {subject!r} is not in the registry")
    return int(rows[0]["id"]), json.loads(rows[0]["schema"])


def infer_output_schema(
    registry: DataFrame,
    topic: str,
    key_field: str | None = None,
    value_field: str | None = None,
) -> T.StructType:
    """Output schema from the latest ``<topic>-key`` / ``<topic>-value`` (D4),
    each under its field name, only when that field name is set."""
    wanted = {}
    if key_field:
        wanted[f"{topic}-key"] = key_field
    if value_field:
        wanted[f"{topic}-value"] = value_field
    if not wanted:
        return T.StructType([])
    rows = latest_schemas(registry.where(F.col("subject").isin(list(wanted)))).collect()  # <= 2 rows
    found = {r["subject"]: r["schema"] for r in rows}
    fields = []
    for subject, name in wanted.items():
        if subject not in found:
            raise SchemaError(f"subject {subject!r} is not in the registry")
        dt, nullable = avro_to_spark(json.loads(found[subject]))
        fields.append(T.StructField(name, dt, True))
    return T.StructType(fields)


def split_registry_frame(df: DataFrame, col: str = "value") -> DataFrame:
    """Add ``magic`` (first byte), ``schema_id`` (bytes 1-4, big endian) and
    ``body`` (the rest) of a registry-framed payload (C11)."""
    v = F.col(col)
    return df.withColumns(
        {
            "magic": F.conv(F.hex(F.substring(v, 1, 1)), 16, 10).cast("int"),
            "schema_id": from_int32_be(F.substring(v, 2, 4)),
            "body": F.expr(f"substr(`{col}`, 6)"),
        }
    )


# ---------------------------------------------------------------- datums


def _check_encoding(encoding: str) -> None:
    if encoding not in ("binary", "json"):
        raise ContractError([f"Avro encoding must be binary or json, not {encoding!r}"])
    if encoding == "binary":
        spark = SparkSession.getActiveSession()
        module = spark.sparkContext._jvm.org.apache.spark.sql.avro
        if type(module.AvroDataToCatalyst).__name__ == "JavaPackage":
            raise ContractError(["binary Avro needs the spark-avro module on Spark's class path"])


def _member(avro: object) -> tuple[str | None, object]:
    """Name of the one member of a nullable union in the JSON encoding, and the type itself."""
    if not isinstance(avro, list):
        return None, avro
    members = [m for m in avro if m != "null"]
    if len(members) != 1:
        raise SchemaError("the JSON encoding is supported for unions of null and one type")
    m = members[0]
    return (m if isinstance(m, str) else m.get("name") or m["type"]), m


def _json_shape(avro: object) -> T.DataType:
    """The type that ``from_json`` reads a JSON-encoded datum as: a union's value is an object named by its type."""
    name, avro = _member(avro)
    if isinstance(avro, dict) and avro.get("type") == "record":
        shape: T.DataType = T.StructType([T.StructField(f["name"], _json_shape(f["type"])) for f in avro["fields"]])
    elif isinstance(avro, dict) and avro.get("type") == "array":
        shape = T.ArrayType(_json_shape(avro["items"]))
    elif isinstance(avro, dict) and avro.get("type") == "map":
        shape = T.MapType(T.StringType(), _json_shape(avro["values"]))
    else:
        shape, _ = avro_to_spark(avro)
        if isinstance(shape, (T.BinaryType, T.DecimalType)):
            raise SchemaError(f"no JSON encoding of {shape.simpleString()} here")
    return T.StructType([T.StructField(name, shape)]) if name else shape


def _from_json_value(col: Column, avro: object) -> Column:
    name, avro = _member(avro)
    col = col.getField(name) if name else col
    if isinstance(avro, dict) and avro.get("type") == "record":
        whole = F.struct(*[_from_json_value(col.getField(f["name"]), f["type"]).alias(f["name"]) for f in avro["fields"]])
        return F.when(col.isNotNull(), whole)
    if isinstance(avro, dict) and avro.get("type") == "array":
        return F.transform(col, lambda x: _from_json_value(x, avro["items"]))
    if isinstance(avro, dict) and avro.get("type") == "map":
        return F.transform_values(col, lambda _, x: _from_json_value(x, avro["values"]))
    return col


def _required(col: Column, f: dict) -> Column:
    """A field that is no union must have a value."""
    if isinstance(f["type"], list):
        return col
    return F.when(col.isNull(), F.raise_error(F.lit(f"null in the non-nullable field {f['name']!r}"))).otherwise(col)


def _to_json_value(col: Column, avro: object) -> Column:
    name, avro = _member(avro)
    out = col
    if isinstance(avro, dict) and avro.get("type") == "record":
        out = F.struct(*[_to_json_value(_required(col.getField(f["name"]), f), f["type"]).alias(f["name"]) for f in avro["fields"]])
    elif isinstance(avro, dict) and avro.get("type") == "array":
        out = F.transform(col, lambda x: _to_json_value(x, avro["items"]))
    elif isinstance(avro, dict) and avro.get("type") == "map":
        out = F.transform_values(col, lambda _, x: _to_json_value(x, avro["values"]))
    return F.when(col.isNotNull(), F.struct(out.alias(name))) if name else out


def _resolved(col: Column, writer: object, reader: T.DataType) -> Column:
    """A decoded datum of ``writer`` as the reader's type: fields by name, others null or their default."""
    _, writer = _member(writer) if isinstance(writer, list) else (None, writer)
    if not isinstance(reader, T.StructType):
        return col.cast(reader)
    known = {f["name"]: f["type"] for f in writer["fields"]}
    fields = [
        (_resolved(col.getField(f.name), known[f.name], f.dataType) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in reader.fields
    ]
    return F.when(col.isNotNull(), F.struct(*fields))


def datum_value(body: Column, writer: object, reader: T.DataType, encoding: str) -> Column:
    """One datum written with ``writer`` (parsed schema), as the reader's type."""
    if encoding == "binary":
        from pyspark.sql.avro.functions import from_avro

        return _resolved(from_avro(body, json.dumps(writer), {"mode": "FAILFAST"}), writer, reader)
    shape = T.StructType([T.StructField("v", _json_shape(writer))])
    text = F.concat(F.lit('{"v":'), body.cast("string"), F.lit("}"))
    value = _from_json_value(F.from_json(text, shape, {"mode": "FAILFAST"}).getField("v"), writer)
    return _resolved(value, writer, reader)


def value_datum(value: Column, writer: object, encoding: str) -> Column:
    """The datum of a value, written with ``writer`` (parsed schema); it must have the schema's fields."""
    if encoding == "binary":
        from pyspark.sql.avro.functions import to_avro

        return to_avro(value, json.dumps(writer))
    text = F.to_json(F.struct(_to_json_value(value, writer).alias("v")), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(6), F.length(text) - F.lit(6)).cast("binary")


def decode_avro(
    df: DataFrame, schema: T.StructType | str, value_col: str = "value", nest: str | None = None, encoding: str = "binary"
) -> DataFrame:
    """Bare Avro datums (no frame) with a given record schema."""
    _check_encoding(encoding)
    writer = json.loads(schema) if isinstance(schema, str) else spark_to_avro(schema)
    reader, _ = avro_to_spark(writer)
    v = F.col(value_col)
    st = F.when(v.isNotNull(), datum_value(v, writer, reader, encoding))
    if nest:
        return df.withColumn(nest, st)
    return df.withColumn("_tf_rec", st).select(*[c for c in df.columns if c not in reader.fieldNames()], "_tf_rec.*")


def decode_registry_avro(
    df: DataFrame,
    registry: DataFrame,
    topic: str,
    value_field: str = "message",
    key_field: str | None = None,
    col: str = "value",
    encoding: str = "binary",
) -> DataFrame:
    """Registry-framed Avro value → struct column ``value_field``.

    Each message is decoded with its writer schema (one of the subject's
    versions, by its schema id) and resolved onto the latest ``<topic>-value``
    schema. A payload that is not framed, or of an id that the subject does
    not have, fails the task. With ``key_field`` the key is decoded the same
    way from ``<topic>-key`` and passed on as is, any type (C13).
    """
    _check_encoding(encoding)
    target = infer_output_schema(registry, topic, key_field, value_field)
    by_name = {f.name: f for f in target.fields}
    if not isinstance(by_name[value_field].dataType, T.StructType):
        raise ContractError([f"registry value schema of {topic!r} is not a record"])
    out = df
    for src, name, subject in [(col, value_field, f"{topic}-value")] + ([("key", key_field, f"{topic}-key")] if key_field else []):
        dtype, v = by_name[name].dataType, F.col(src)
        framed = (F.conv(F.hex(F.substring(v, 1, 1)), 16, 10).cast("int") == MAGIC) & (F.octet_length(v) >= 5)
        sid, body = from_int32_be(F.substring(v, 2, 4)), F.expr(f"substr(`{src}`, 6)")
        bad = F.raise_error(F.concat(F.lit(f"{src} is not registry framed: first bytes "), F.hex(F.substring(v, 1, 5))))
        unknown = F.raise_error(F.concat(F.lit("schema id "), sid.cast("string"), F.lit(f" is not a version of {subject}")))
        value = F.when(v.isNull(), F.lit(None).cast(dtype)).when(~framed, bad.cast(dtype))
        for known, writer in sorted(subject_schemas(registry, subject).items()):
            value = value.when(sid == known, datum_value(body, writer, dtype, encoding))
        out = out.withColumn(name, value.otherwise(unknown.cast(dtype)))
    return out


# ---------------------------------------------------------------- encode


def encode_avro(df: DataFrame, field: str, encoding: str = "binary") -> Column:
    """Bare Avro datum of a struct field with the schema derived from its type."""
    _check_encoding(encoding)
    return value_datum(F.col(field), spark_to_avro(df.schema[field].dataType, field), encoding)


def _framed(sid: int, datum: Column) -> Column:
    return F.concat(F.lit(bytes([MAGIC])), int32_be(F.lit(sid)), datum)


def encode_registry_avro(
    df: DataFrame,
    registry: DataFrame,
    topic: str,
    field: str,
    schema_id: str | Column | None = None,
    encoding: str = "binary",
) -> Column:
    """Registry-framed Avro value of the record ``field``.

    The writer schema is the latest ``<topic>-value`` version, or per row
    the version named by ``schema_id``. The field must be a record.
    """
    if not isinstance(df.schema[field].dataType, T.StructType):
        raise ContractError([f"field {field!r} must be a record to be written with a registry"])
    _check_encoding(encoding)
    if schema_id is None:
        sid, writer = _latest(registry, f"{topic}-value")
        return F.when(F.col(field).isNotNull(), _framed(sid, value_datum(F.col(field), writer, encoding)))
    ids = col_of(schema_id)
    value = F.when(F.col(field).isNull(), F.lit(None).cast("binary"))
    for sid, writer in sorted(subject_schemas(registry, f"{topic}-value").items()):
        value = value.when(ids == sid, _framed(sid, value_datum(F.col(field), writer, encoding)))
    unknown = F.raise_error(F.concat(F.lit("schema id "), ids.cast("string"), F.lit(f" is not a version of {topic}-value")))
    return value.otherwise(unknown.cast("binary"))


def encode_registry_key(df: DataFrame, registry: DataFrame, topic: str, field: str, encoding: str = "binary") -> Column:
    """Registry-framed Avro key (the sink's registry mode passes the key to the
    registry serializer unchanged): the key field, any type, written with the
    latest ``<topic>-key`` schema. A null key stays null."""
    _check_encoding(encoding)
    sid, writer = _latest(registry, f"{topic}-key")
    return F.when(F.col(field).isNotNull(), _framed(sid, value_datum(F.col(field), writer, encoding)))
