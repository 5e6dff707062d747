"""Payload decoders and record assembly.

A decoder turns the ``value`` bytes of a topic frame into a struct column
with one projection over the whole topic, all of it JVM expressions
(``from_csv``, ``from_json``, regular expressions); there is no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicframe.functions.columns import col_of
from topicframe.functions.logformats import (
    CLF_GROUPS,
    CLF_REGEX,
    CLF_TIME_FORMAT,
    SYSLOG_DERIVED,
    SYSLOG_GROUPS,
    SYSLOG_REGEX,
    SYSLOG_TIME_FORMAT,
    expand_grok,
)
from topicframe.schema import ContractError, message_schema, parse_schema, to_ddl

CORRUPT = "_corrupt_record"


def _check_mode(mode: str) -> str:
    m = mode.lower()
    if m not in ("failfast", "permissive"):
        raise ValueError(f"mode must be failfast or permissive, not {mode!r}")
    return m


def _text(value: Column) -> Column:
    return value.cast("string")


def _single_field(schema: T.StructType, fmt: str) -> T.StructField:
    if len(schema.fields) != 1:
        raise ContractError([f"format {fmt!r} needs exactly one message field, got {schema.fieldNames()}"])
    return schema.fields[0]


_SEP = "\u0001"


def _with_groups(text: Column, regex: str, n_groups: int, build, unmatched: Column) -> Column:
    """Evaluate the (anchored) regex once per row and hand the groups to ``build``.

    ``regexp_replace`` with back-references turns a match into a separator
    and the groups joined by it; ``split`` cuts that. A text without the
    separator has it afterwards only if the regex matched. The rare text
    that contains it is matched by ``rlike`` and one ``regexp_extract`` a
    group. The parts are bound once through a one-element ``transform``
    (Spark has no let-binding). Rows that do not match give ``unmatched``.
    """
    template = _SEP + _SEP.join(f"${i}" for i in range(1, n_groups + 1))
    odd = F.instr(text, _SEP) > 0
    extracted = F.array(F.lit(""), *[F.regexp_extract(text, regex, i) for i in range(1, n_groups + 1)])
    parts = F.when(odd, F.when(text.rlike(regex), extracted).otherwise(F.array(F.lit("")))).otherwise(
        F.split(F.regexp_replace(text, regex, template), _SEP, -1)
    )
    return F.transform(
        F.array(parts), lambda p: F.when(F.size(p) == n_groups + 1, build(lambda i: F.element_at(p, i + 1))).otherwise(unmatched)
    ).getItem(0)


def _regex_struct(
    text: Column,
    schema: T.StructType,
    regex: str,
    groups: dict[str, int],
    mode: str,
    fmt: str,
    derived: dict[str, Column] | None = None,
    ts_format: str | None = None,
    ts_text=None,
    missing: tuple[str, ...] = ("",),
) -> Column:
    """The fields of a line format; null (or an error in ``failfast`` mode) where the line does not match.

    ``missing``: group texts that stand for no value. ``ts_text`` prepares a
    group's text for ``ts_format``.
    """
    strict = mode == "failfast"
    for f in schema.fields:
        if f.name not in groups and not (derived and f.name in derived):
            known = sorted(set(groups) | set(derived or {}))
            raise ContractError([f"{fmt}: field {f.name!r} is not one of {known}"])

    def build(group):
        fields = []
        for f in schema.fields:
            if derived and f.name in derived:
                raw = derived[f.name](group)
            else:
                raw = group(groups[f.name])
                # a text field keeps its empty text; other types have no value of it
                none = missing if not isinstance(f.dataType, T.StringType) or "-" in missing else ()
                raw = F.when(raw.isin(*none), F.lit(None)).otherwise(raw) if none else raw
            dt = f.dataType
            if isinstance(dt, (T.TimestampType, T.TimestampNTZType)) and ts_format:
                val = F.try_to_timestamp(ts_text(raw) if ts_text else raw, F.lit(ts_format))
                if isinstance(dt, T.TimestampNTZType):
                    val = val.cast("timestamp_ntz")
            elif isinstance(dt, T.StringType):
                val = raw.cast("string")
            elif strict:
                val = raw.cast(dt)
            else:
                val = raw.try_cast(dt)
            fields.append(val.alias(f.name))
        return F.struct(*fields)

    nothing = F.lit(None).cast(schema)
    if strict:
        nothing = F.raise_error(F.concat(F.lit(f"Malformed {fmt} payload: "), F.substring(text, 1, 200))).cast(schema)
    st = _with_groups(text, regex, max([*groups.values(), 1]), build, nothing)
    return F.when(text.isNull(), F.lit(None).cast(schema)).otherwise(st)


def payload_struct(
    value: str | Column,
    fmt: str | None,
    schema: T.StructType | str,
    mode: str = "failfast",
    pattern: str | None = None,
    options: dict | None = None,
) -> Column:
    """Decode a payload column into a struct of ``schema`` (C0 dispatch).

    Formats: None/binary/bytes, text, csv, tsv, json, clf, syslog, grok
    (``pattern`` required), avro (``options={"encoding": ...}``). A null payload
    gives a null struct. A syslog time has no year: a timestamp field of it
    needs ``options={"year": ...}``. In ``failfast`` mode a malformed payload fails the task, like the
    reference; ``permissive`` yields nulls (see :func:`split_malformed`).
    """
    schema = parse_schema(schema)
    mode = _check_mode(mode)
    v = col_of(value)
    f = (fmt or "binary").lower()
    opts = dict(options or {})
    if f in ("binary", "bytes"):
        fld = _single_field(schema, f)
        return F.struct(v.cast(fld.dataType).alias(fld.name))
    if f == "text":
        fld = _single_field(schema, f)
        return F.struct(_text(v).cast(fld.dataType).alias(fld.name))
    if f in ("csv", "tsv"):
        opts.setdefault("sep", "," if f == "csv" else "\t")
        opts["mode"] = mode.upper()
        return F.from_csv(_text(v), to_ddl(schema), opts)
    if f == "json":
        opts["mode"] = mode.upper()
        return F.from_json(_text(v), schema, opts)
    if f == "clf":
        return _regex_struct(_text(v), schema, CLF_REGEX, CLF_GROUPS, mode, f, ts_format=CLF_TIME_FORMAT, missing=("", "-"))
    if f == "syslog":
        text = _text(v)
        derived = dict(zip(SYSLOG_DERIVED, (
            lambda g: F.floor(g(1).try_cast("int") / 8).cast("int"),
            lambda g: (g(1).try_cast("int") % 8).cast("int"),
        )))
        timed = [x.name for x in schema.fields if isinstance(x.dataType, (T.TimestampType, T.TimestampNTZType))]
        if timed and "year" not in opts:
            raise ContractError([f"syslog field {timed[0]!r}: a timestamp needs the year option"])
        year = F.lit(str(opts.get("year", "")))
        return _regex_struct(
            text, schema, SYSLOG_REGEX, SYSLOG_GROUPS, mode, f, derived=derived, ts_format=SYSLOG_TIME_FORMAT,
            ts_text=lambda raw: F.concat_ws(" ", year, F.regexp_replace(raw, " +", " ")),
        )
    if f == "grok":
        if not pattern:
            raise ContractError(["grok format needs a pattern"])
        regex, groups, _types = expand_grok(pattern, opts.get("patterns"))
        return _regex_struct(_text(v), schema, f"^(?:{regex})$", groups, mode, f)
    if f == "avro":
        # a bare Avro datum written with the declared message schema
        from topicframe.operators.registry import _check_encoding, datum_value
        from topicframe.schema import spark_to_avro

        encoding = opts.get("encoding", "binary")
        _check_encoding(encoding)
        return F.when(v.isNotNull(), datum_value(v, spark_to_avro(schema, "message"), schema, encoding))
    raise ContractError([f"unknown format {fmt!r}"])


def decode(
    df: DataFrame,
    fmt: str | None,
    schema: T.StructType | str,
    nest: str | None = None,
    mode: str = "failfast",
    pattern: str | None = None,
    value_col: str = "value",
    options: dict | None = None,
) -> DataFrame:
    """Decode ``value_col`` and add the fields as top-level columns (B7),
    or as one struct column named ``nest`` (B8). Other columns are kept."""
    schema = parse_schema(schema)
    st = payload_struct(value_col, fmt, schema, mode, pattern, options)
    if nest:
        return df.withColumn(nest, st)
    return df.withColumn("_tf_rec", st).select(
        *[c for c in df.columns if c not in schema.fieldNames()], "_tf_rec.*"
    )


def split_malformed(
    df: DataFrame,
    fmt: str,
    schema: T.StructType | str,
    value_col: str = "value",
    flag: str = "malformed",
    pattern: str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Decode permissively and flag rows whose payload does not fit.

    Short, long and uncastable csv rows and unparsable json are flagged by
    the parser's corrupt-record column; empty payloads are flagged too (the
    parsers return an all-null record for them without a marker). Null
    payloads (tombstones) are not malformed.
    """
    schema = parse_schema(schema)
    f = fmt.lower()
    v = F.col(value_col)
    text = _text(v)
    empty = v.isNotNull() & (F.octet_length(v) == 0)
    if f in ("csv", "tsv", "json"):
        wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
        opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        if f == "json":
            st = F.from_json(text, wide, opts)
        else:
            opts["sep"] = "," if f == "csv" else "\t"
            st = F.from_csv(text, to_ddl(wide), opts)
        bad = st[CORRUPT].isNotNull() | empty
        rec = F.struct(*[st[n].alias(n) for n in schema.fieldNames()])
    elif f in ("clf", "syslog", "grok"):
        rec = payload_struct(v, f, schema, "permissive", pattern, options)
        bad = v.isNotNull() & F.col("_tf_rec").isNull()  # a line that matches is never a null record
    else:
        raise ContractError([f"no malformed-row check for format {fmt!r}"])
    return (
        df.withColumn("_tf_rec", rec)
        .withColumn(flag, F.coalesce(bad, F.lit(False)))
        .select(*[c for c in df.columns if c not in schema.fieldNames()], "_tf_rec.*", flag)
    )


# ---------------------------------------------------------------- metadata columns


def read_time(batch_time: int | None = None) -> Column:
    """Batch read time in epoch ms: one value for all rows of a (micro-)batch (B1)."""
    if batch_time is not None:
        return F.lit(int(batch_time)).cast("bigint")
    return F.unix_millis(F.current_timestamp())


def key_column(key_type: T.DataType | str = "bytes", key_col: str = "key") -> Column:
    """The message key as bytes or UTF-8 text; null stays null (B2).

    Text uses ``cast``: invalid UTF-8 keeps its bytes instead of failing
    (``make_valid_utf8`` gives the replacement-character form).
    """
    k = F.col(key_col)
    if key_type in ("string", "text") or isinstance(key_type, T.StringType):
        return k.cast("string")
    if key_type in ("bytes", "binary") or isinstance(key_type, T.BinaryType):
        return k
    raise ContractError([f"key type must be string or bytes, not {key_type}"])


def with_read_time(df: DataFrame, name: str, batch_time: int | None = None) -> DataFrame:
    return df.withColumn(name, read_time(batch_time))


def with_key(df: DataFrame, name: str, key_type: str = "bytes") -> DataFrame:
    return df.withColumn(name, key_column(key_type))


def with_partition(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.col("partition").cast("int"))


def with_offset(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.col("offset").cast("bigint"))


def with_payload(df: DataFrame, name: str) -> DataFrame:
    """Raw payload bytes in ``name`` (B6); null allowed."""
    return df.withColumn(name, F.col("value"))


def _registry_records(df, registry, topic, schema, time_field, key_field, partition_field, offset_field,
                      value_field, batch_time, encoding, position):
    from topicframe.operators.registry import decode_registry_avro, infer_output_schema

    if not topic or not value_field:
        raise ContractError(["a schema registry needs the topic and a value field"])
    inferred = infer_output_schema(registry, topic, key_field, value_field)
    decoded = decode_registry_avro(df, registry, topic, value_field, key_field=key_field, encoding=encoding)
    meta = {time_field: read_time(batch_time), partition_field: F.col("partition").cast("int"),
            offset_field: F.col("offset").cast("bigint")}
    names = parse_schema(schema).fieldNames() if schema is not None else (
        [f for f in (time_field, partition_field, offset_field) if f] + inferred.fieldNames())
    cols = []
    for name in names:
        if name in inferred.fieldNames():
            cols.append(F.col(name))
        elif name in meta and name:
            cols.append(meta[name].alias(name))
        else:
            raise ContractError([f"field {name!r} is neither a registry field nor a metadata field"])
    return decoded.select(*cols, *_position(position))


def _position(wanted: bool) -> list[Column]:
    return [F.col(c).alias(f"_{c}") for c in ("topic", "partition", "offset")] if wanted else []


def to_records(
    df: DataFrame,
    schema: T.StructType | str | None,
    fmt: str | None = None,
    time_field: str | None = None,
    key_field: str | None = None,
    partition_field: str | None = None,
    offset_field: str | None = None,
    value_field: str | None = None,
    batch_time: int | None = None,
    mode: str = "failfast",
    pattern: str | None = None,
    registry: DataFrame | None = None,
    topic: str | None = None,
    options: dict | None = None,
    encoding: str = "binary",
    keep_position: bool = False,
) -> DataFrame:
    """Topic frame → typed records in declared column order.

    Metadata fields are filled from the message (key, partition, offset) and
    the batch (read time); the other fields come from the decoded payload,
    flattened, or nested under ``value_field`` (which must be a struct field
    of ``schema``).

    With a ``registry`` (and ``topic``) the value is registry-framed Avro
    nested under ``value_field`` and the key is registry-framed too (any
    type); ``schema`` may then be None and is inferred from the latest
    ``<topic>-key``/``<topic>-value`` plus the requested metadata fields.

    ``keep_position`` adds ``_topic, _partition, _offset`` for a ledger.
    """
    if registry is not None:
        return _registry_records(df, registry, topic, schema, time_field, key_field, partition_field,
                                 offset_field, value_field, batch_time, encoding, keep_position)
    schema = parse_schema(schema)
    meta = (time_field, key_field, partition_field, offset_field)
    msg = message_schema(schema, *meta)
    if value_field:
        vf = next((f for f in msg.fields if f.name == value_field), None)
        if vf is None or not isinstance(vf.dataType, T.StructType):
            raise ContractError([f"value field {value_field!r} must be a record field of the schema"])
        st = payload_struct("value", fmt, vf.dataType, mode, pattern, options)
    else:
        st = payload_struct("value", fmt, msg, mode, pattern, options)
    rec = df.select("key", *(["topic"] if keep_position else []), "partition", "offset", st.alias("_tf_rec"))
    cols = []
    for f in schema.fields:
        if f.name == time_field:
            c = read_time(batch_time)
        elif f.name == key_field:
            c = key_column(f.dataType)
        elif f.name == partition_field:
            c = F.col("partition").cast("int")
        elif f.name == offset_field:
            c = F.col("offset").cast("bigint")
        elif f.name == value_field:
            c = F.col("_tf_rec")
        else:
            c = F.col("_tf_rec").getField(f.name).cast(f.dataType)
        cols.append(c.alias(f.name))
    return rec.select(*cols, *_position(keep_position))
