"""Record schemas: parsing, metadata/message split, Avro type mapping, contract checks.

Schemas are driver-side metadata only (a ``StructType``); nothing here runs a job.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column metadata: the logical type that a declared field had.
LOGICAL_TYPE = "logicalType"

# The default record schema when none is declared (one string field).
DEFAULT_SCHEMA = T.StructType([T.StructField("message", T.StringType(), True)])

# Avro primitive type names and their Spark types.
_PRIMITIVES = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}


class SchemaError(ValueError):
    """A schema cannot be parsed or mapped."""


class ContractError(ValueError):
    """One or more configuration/schema rules failed; ``failures`` lists all of them."""

    def __init__(self, failures: list[str]):
        self.failures = list(failures)
        super().__init__("; ".join(self.failures))


# ---------------------------------------------------------------- Avro <-> Spark


def avro_to_spark(avro: object) -> tuple[T.DataType, bool]:
    """Map an Avro-style type (parsed JSON) to ``(spark type, nullable)``."""
    if isinstance(avro, str):
        if avro in _PRIMITIVES:
            return _PRIMITIVES[avro], avro == "null"
        raise SchemaError(f"unsupported type {avro!r}")
    if isinstance(avro, list):
        members = [m for m in avro if m != "null"]
        nullable = len(members) < len(avro)
        if len(members) == 1:
            dt, _ = avro_to_spark(members[0])
            return dt, nullable
        return (
            T.StructType([T.StructField(f"member{i}", avro_to_spark(m)[0], True) for i, m in enumerate(members)]),
            nullable,
        )
    if isinstance(avro, dict):
        t = avro.get("type")
        logical = avro.get("logicalType")
        if logical == "decimal":
            return T.DecimalType(int(avro.get("precision", 10)), int(avro.get("scale", 0))), False
        if logical == "date":
            return T.DateType(), False
        if logical in ("timestamp-millis", "timestamp-micros"):
            return T.TimestampType(), False
        if logical in ("local-timestamp-millis", "local-timestamp-micros", "datetime"):
            return T.TimestampNTZType(), False
        if t == "record":
            fields = []
            for f in avro.get("fields", []):
                dt, nullable = avro_to_spark(f["type"])
                members = f["type"] if isinstance(f["type"], list) else [f["type"]]
                logical = next((m["logicalType"] for m in members if isinstance(m, dict) and m.get("logicalType")), None)
                fields.append(T.StructField(f["name"], dt, nullable, {LOGICAL_TYPE: logical} if logical else None))
            return T.StructType(fields), False
        if t == "enum":
            return T.StringType(), False
        if t == "fixed":
            return T.BinaryType(), False
        if t == "array":
            dt, nullable = avro_to_spark(avro["items"])
            return T.ArrayType(dt, nullable), False
        if t == "map":
            dt, nullable = avro_to_spark(avro["values"])
            kt = avro_to_spark(avro["keys"])[0] if "keys" in avro else T.StringType()
            return T.MapType(kt, dt, nullable), False
        if t is not None:
            return avro_to_spark(t)
    raise SchemaError(f"unsupported type {avro!r}")


def spark_to_avro(dt: T.DataType, name: str = "record", nullable: bool = False) -> object:
    """Map a Spark type to an Avro-style type (for encoders and the registry)."""
    if isinstance(dt, T.StructType):
        out: object = {
            "type": "record",
            "name": name,
            "fields": [
                {"name": f.name, "type": spark_to_avro(f.dataType, f.name, f.nullable)} for f in dt.fields
            ],
        }
    elif isinstance(dt, T.ArrayType):
        out = {"type": "array", "items": spark_to_avro(dt.elementType, name, dt.containsNull)}
    elif isinstance(dt, T.MapType):
        out = {"type": "map", "values": spark_to_avro(dt.valueType, name, dt.valueContainsNull)}
    elif isinstance(dt, T.DecimalType):
        out = {"type": "bytes", "logicalType": "decimal", "precision": dt.precision, "scale": dt.scale}
    elif isinstance(dt, T.DateType):
        out = {"type": "int", "logicalType": "date"}
    elif isinstance(dt, T.TimestampType):
        out = {"type": "long", "logicalType": "timestamp-micros"}
    elif isinstance(dt, T.TimestampNTZType):
        out = {"type": "long", "logicalType": "local-timestamp-micros"}
    elif isinstance(dt, (T.ShortType, T.ByteType)):
        out = "int"
    else:
        for avro_name, sdt in _PRIMITIVES.items():
            if type(sdt) is type(dt):
                out = avro_name
                break
        else:
            raise SchemaError(f"no Avro type for {dt.simpleString()}")
    return ["null", out] if nullable else out


# ---------------------------------------------------------------- parsing


def parse_schema(text: str | T.StructType | None) -> T.StructType:
    """Record schema from a StructType, an Avro-style JSON record, a primitive
    type name (``"string"``), or a Spark DDL string. Empty → DEFAULT_SCHEMA."""
    if text is None or (isinstance(text, str) and not text.strip()):
        return DEFAULT_SCHEMA
    if isinstance(text, T.StructType):
        return text
    s = text.strip()
    if s.startswith("{") or s.startswith("[") or s.startswith('"'):
        try:
            parsed = json.loads(s)
        except json.JSONDecodeError as e:
            raise SchemaError(f"invalid schema JSON: {e}") from e
        dt, _ = avro_to_spark(parsed)
        if not isinstance(dt, T.StructType):
            return T.StructType([T.StructField("message", dt, True)])
        return dt
    if s in _PRIMITIVES:
        return T.StructType([T.StructField("message", _PRIMITIVES[s], True)])
    return _parse_ddl(s)


def _parse_ddl(ddl: str) -> T.StructType:
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    if spark is None:
        raise SchemaError("a DDL schema needs an active SparkSession")
    dt = T._parse_datatype_string(ddl)
    if not isinstance(dt, T.StructType):
        raise SchemaError(f"DDL is not a record: {ddl!r}")
    return dt


def to_ddl(schema: T.StructType) -> str:
    """DDL text for from_csv and friends."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def message_schema(schema: T.StructType, *metadata_fields: str | None) -> T.StructType:
    """Declared schema minus the named metadata fields (time, key, partition, offset)."""
    meta = {m for m in metadata_fields if m}
    rest = [f for f in schema.fields if f.name not in meta]
    if not rest:
        raise ContractError(["schema must contain at least one message field"])
    return T.StructType(rest)


# ---------------------------------------------------------------- contract checks


def _parse_brokers(brokers: str | None, failures: list[str]) -> None:
    if not brokers or not brokers.strip():
        failures.append("brokers: at least one host:port is required")
        return
    for b in brokers.split(","):
        b = b.strip()
        host, sep, port = b.rpartition(":")
        if not sep or not host:
            failures.append(f"brokers: {b!r} is not host:port")
            continue
        try:
            int(port)
        except ValueError:
            failures.append(f"brokers: port of {b!r} is not an integer")


def parse_partitions(text: str | list | None, failures: list[str]) -> list[int]:
    if text is None or text == "" or text == []:
        return []
    items = text if isinstance(text, list) else [p for p in str(text).split(",") if p.strip()]
    out = []
    for p in items:
        try:
            out.append(int(str(p).strip()))
        except ValueError:
            failures.append(f"partitions: {p!r} is not an integer")
    return out


def parse_initial_offsets(text: str | dict | None, failures: list[str]) -> dict[int, int]:
    """``"p:o,p:o"`` (or a dict) → {partition: offset}."""
    if not text:
        return {}
    if isinstance(text, dict):
        items = list(text.items())
    else:
        items = []
        for pair in str(text).split(","):
            if not pair.strip():
                continue
            k, sep, v = pair.partition(":")
            if not sep:
                failures.append(f"initial offsets: {pair!r} is not partition:offset")
                continue
            items.append((k, v))
    out = {}
    for k, v in items:
        try:
            p = int(str(k).strip())
        except ValueError:
            failures.append(f"initial offsets: partition {k!r} is not an integer")
            continue
        try:
            out[p] = int(str(v).strip())
        except ValueError:
            failures.append(f"initial offsets: offset {v!r} of partition {p} is not a long")
    return out


def _plain(f: T.StructField, *types: type) -> bool:
    return isinstance(f.dataType, types) and not f.metadata.get(LOGICAL_TYPE)


@dataclass
class SourceConfig:
    """Options of a topic source (streaming or bounded)."""

    brokers: str | None = None
    topic: str | None = None
    schema: T.StructType | str | None = None
    fmt: str | None = None
    partitions: str | list | None = None
    default_offset: int | None = -1
    initial_offsets: str | dict | None = None
    max_rate: int | None = 1000
    max_records: int = -1
    time_field: str | None = None
    key_field: str | None = None
    partition_field: str | None = None
    offset_field: str | None = None
    value_field: str | None = None
    cluster_key: str | None = None
    cluster_secret: str | None = None
    registry: object | None = None
    kafka_options: dict = field(default_factory=dict)
    bounded: bool = False
    pattern: str | None = None
    # partitions of the Kafka topic, where none are listed: the rate cap and
    # partial initial offsets need them
    partition_count: int | None = None
    # how registry-framed payloads are written: "binary" or "json"
    avro_encoding: str = "binary"
    # options of the payload format (csv/json options, syslog "year", avro "encoding")
    format_options: dict = field(default_factory=dict)

    def validate(self) -> T.StructType:
        """Check every rule; raise one ContractError listing all failures."""
        failures: list[str] = []
        _parse_brokers(self.brokers, failures)
        if not self.topic:
            failures.append("topic is required")
        parse_partitions(self.partitions, failures)
        parse_initial_offsets(self.initial_offsets, failures)
        if not self.bounded and (self.max_rate is None or self.max_rate < 0):
            failures.append("max rate per partition must be at least 0")
        if self.time_field and self.time_field == self.key_field:
            failures.append("time field and key field must differ")
        if bool(self.cluster_key) != bool(self.cluster_secret):
            failures.append("cluster API key and secret must be given together")
        if self.registry is not None and self.fmt:
            failures.append("a schema registry and a message format are exclusive")
        if self.registry is not None and not self.value_field and not self.bounded:
            failures.append("a schema registry needs a value field")
        try:
            schema = parse_schema(self.schema)
        except SchemaError as e:
            raise ContractError(failures + [str(e)]) from e
        names = set(schema.fieldNames())
        by_name = {f.name: f for f in schema.fields}
        meta = [self.time_field, self.key_field, self.partition_field, self.offset_field]
        for label, name in zip(("time", "key", "partition", "offset"), meta):
            if name and name not in names:
                failures.append(f"{label} field {name!r} is not in the schema")
        if self.time_field in by_name and not _plain(by_name[self.time_field], T.LongType):
            failures.append(f"time field {self.time_field!r} must be a long")
        if self.key_field in by_name and self.registry is None and not _plain(
            by_name[self.key_field], T.StringType, T.BinaryType
        ):
            failures.append(f"key field {self.key_field!r} must be string or bytes")
        if self.partition_field in by_name and not _plain(by_name[self.partition_field], T.IntegerType):
            failures.append(f"partition field {self.partition_field!r} must be an int")
        if self.offset_field in by_name and not _plain(by_name[self.offset_field], T.LongType):
            failures.append(f"offset field {self.offset_field!r} must be a long")
        rest = [f for f in schema.fields if f.name not in {m for m in meta if m}]
        if not rest:
            failures.append("schema must contain at least one message field")
        elif self.registry is None and not self.fmt:
            if len(rest) != 1 or not _plain(rest[0], T.BinaryType):
                failures.append("without a format the message must be exactly one bytes field")
        elif self.fmt and self.fmt.lower() not in DECODER_FORMATS:
            failures.append(f"unknown format {self.fmt!r}")
        elif self.fmt and self.fmt.lower() == "grok" and not self.pattern:
            failures.append("the grok format needs a pattern")
        if failures:
            raise ContractError(failures)
        return schema


# Payload formats the source decodes.
DECODER_FORMATS = ("binary", "bytes", "text", "csv", "tsv", "json", "clf", "syslog", "grok", "avro")
# Payload formats the sink encodes.
ENCODER_FORMATS = ("csv", "json")


@dataclass
class SinkConfig:
    """Options of a topic sink."""

    brokers: str | None = None
    topic: str | None = None
    fmt: str | None = None
    key_field: str | None = None
    partition_field: str | None = None
    time_field: str | None = None
    is_async: bool = False
    compression: str = "none"
    cluster_key: str | None = None
    cluster_secret: str | None = None
    registry: object | None = None
    kafka_options: dict = field(default_factory=dict)
    # partitions of a topic table: messages without a partition are dealt by key
    num_partitions: int | None = None
    avro_encoding: str = "binary"

    def validate(self, input_schema: T.StructType) -> T.StructType:
        """Check the rules against the input schema; return the message schema."""
        failures: list[str] = []
        _parse_brokers(self.brokers, failures)
        if not self.topic:
            failures.append("topic is required")
        if bool(self.cluster_key) != bool(self.cluster_secret):
            failures.append("cluster API key and secret must be given together")
        if self.registry is not None and self.fmt:
            failures.append("a schema registry and a message format are exclusive")
        if self.compression not in ("none", "gzip", "snappy"):
            failures.append(f"compression {self.compression!r} is not none, gzip or snappy")
        by_name = {f.name: f for f in input_schema.fields}
        for label, name in (("key", self.key_field), ("partition", self.partition_field), ("time", self.time_field)):
            if name and name not in by_name:
                failures.append(f"{label} field {name!r} is not in the input schema")
        if self.key_field in by_name and self.registry is None and not _plain(
            by_name[self.key_field], T.StringType, T.BinaryType
        ):
            failures.append(f"key field {self.key_field!r} must be string or bytes")
        if self.partition_field in by_name and not _plain(by_name[self.partition_field], T.IntegerType):
            failures.append(f"partition field {self.partition_field!r} must be an int")
        if self.time_field in by_name and not _plain(by_name[self.time_field], T.LongType):
            failures.append(f"time field {self.time_field!r} must be a long")
        meta = {m for m in (self.key_field, self.partition_field, self.time_field) if m}
        rest = [f for f in input_schema.fields if f.name not in meta]
        if not rest:
            failures.append("input must contain at least one message field")
        elif self.registry is not None:
            if len(rest) != 1:
                failures.append("with a schema registry the message must be exactly one field")
        elif self.fmt:
            if self.fmt.lower() not in ENCODER_FORMATS:
                failures.append(f"format {self.fmt!r} is not csv or json")
        elif len(rest) != 1 or not _plain(rest[0], T.BinaryType):
            failures.append("without a format the message must be exactly one bytes field")
        if failures:
            raise ContractError(failures)
        return T.StructType(rest)
