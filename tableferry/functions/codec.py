"""Rows to text and back. A payload is a JSON array of row objects, never code."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Names that a record carries, beside its values.
FIELDS = "_fields"


def _nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))


def wire(c: Column, dtype: T.DataType) -> Column:
    """A value in a form whose JSON text casts back to the same value, at every level."""
    if isinstance(dtype, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[wire(c[f.name], f.dataType).alias(f.name)
                                                for f in dtype.fields]))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: wire(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        values = F.transform_values(c, lambda _, v: wire(v, dtype.valueType))
        if isinstance(dtype.keyType, T.StringType):
            return values
        if _nested(dtype.keyType):
            raise ValueError("a map whose keys are nested has no JSON form")
        return F.transform_keys(values, lambda k, _: wire(k, dtype.keyType).cast("string"))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)  # an instant, whatever zones sender and receiver are in
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(dtype, T.BinaryType):
        return F.base64(c)
    if isinstance(dtype, (T.DecimalType, T.DateType, T.DayTimeIntervalType,
                          T.YearMonthIntervalType)):
        return c.cast("string")
    return c


def wire_column(name: str, dtype: T.DataType) -> Column:
    return wire(F.col(f"`{name}`"), dtype)


def encoded(schema: T.StructType, columns: Sequence[str] | None = None) -> Column:
    """The JSON object of a row; null fields are kept."""
    wanted = set(columns or schema.names)
    fields = [wire_column(f.name, f.dataType).alias(f.name)
              for f in schema.fields if f.name in wanted]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def encode_rows(df: DataFrame, columns: Sequence[str] | None = None,
                out: str = "enc") -> DataFrame:
    return df.withColumn(out, encoded(df.schema, columns))


def json_array(rows: Column) -> Column:
    """Join a list of encoded rows to one payload."""
    return F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]"))


def _listed(data: Column) -> tuple[Column, Column]:
    """A payload as an array, and whether it was a single object."""
    single = F.ltrim(data, F.lit(" \t\r\n")).startswith("{")
    return F.when(single, F.concat(F.lit("["), data, F.lit("]"))).otherwise(data), single


def _mark(data: Column) -> Column:
    """What is put behind a payload before it is read. Only a reader that gets to the end of the
    text finds it, and a text that holds the hash of itself cannot be written."""
    return F.xxhash64(data).cast("string")


def parsed(data: Column, names: Sequence[str]) -> Column:
    """Payload to a list of all-string structs; null when the text cannot be read.

    The payload is one array of objects, or one object. Text behind it and null elements make it
    unreadable: the reader alone would pass them.
    """
    names = list(names)
    row = T.StructType([T.StructField(n, T.StringType()) for n in names])
    listed, single = _listed(data)
    text = F.concat(F.lit("["), listed, F.lit(f",[{{{json.dumps(names[0])}:\""), _mark(data),
                    F.lit('"}]]'))

    def whole(read: Column) -> Column:
        rows, mark = F.get(read, F.lit(0)), F.get(F.get(read, F.lit(1)), F.lit(0))[names[0]]
        return F.when((F.size(read) == 2) & (mark == _mark(data))
                      & (~single | (F.size(rows) == 1)) & ~F.exists(rows, lambda r: r.isNull()),
                      rows)

    # bound to a name, so that it is evaluated once
    return F.get(F.transform(F.array(F.from_json(text, T.ArrayType(T.ArrayType(row)))), whole),
                 F.lit(0))


def with_records(messages: DataFrame, data: str = "data", out: str = "rows") -> DataFrame:
    """Messages with their payload as ``array<map<string,variant>>``, null when it cannot be
    read, by the rules of :func:`parsed`. No schema is needed: one pass over the text serves
    records of any table. A record that names a column twice is unreadable."""
    listed, single = _listed(F.col(data))
    text = F.concat(F.lit("["), listed, F.lit(',"'), _mark(F.col(data)), F.lit('"]'))
    read = messages.withColumn("_payload", F.try_parse_json(text))
    whole = (F.try_variant_get("_payload", "$[1]", "string").eqNullSafe(_mark(F.col(data)))
             & F.try_variant_get("_payload", "$[2]", "variant").isNull())
    found = read.withColumn("_records", F.when(whole, F.try_variant_get(
        "_payload", "$[0]", "array<map<string,variant>>"))).drop("_payload")
    sound = (~single | (F.size("_records") == 1)) & ~F.exists("_records", lambda r: r.isNull())
    return found.withColumn(out, F.when(sound, F.col("_records"))).drop("_records")


def named_fields(records: Column, names: Sequence[str], partial: bool = False) -> Column:
    """Records of :func:`with_records` as all-string structs of one table's columns, as
    :func:`parsed` gives them. With ``partial`` each says which columns it carries."""
    def struct(record: Column) -> Column:
        fields = [F.try_variant_get(record[n], "$", "string").alias(n) for n in names]
        if partial:
            fields.append(F.map_keys(record).alias(FIELDS))
        return F.struct(*fields)

    return F.transform(records, struct)


def decode_rows(messages: DataFrame, names: Sequence[str], data: str = "data",
                pos: str = "row_pos") -> DataFrame:
    """One row per record of each readable message, fields still text.

    Unreadable messages give no rows here; :mod:`tableferry.operators.route` audits them.
    """
    keep = [c for c in messages.columns if c != data]
    return (
        messages.select(*keep, F.posexplode_outer(parsed(F.col(data), names)).alias(pos, "_row"))
        .where(F.col(pos).isNotNull())
        .select(*keep, pos, *[F.col(f"_row.`{n}`").alias(n) for n in names])
    )


def from_wire(text: Column, dtype: T.DataType) -> Column:
    """Text field to its type; null when it does not fit."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.BinaryType):
        return F.try_to_binary(text, F.lit("base64"))
    if _nested(dtype):
        return _nested_from_wire(text, dtype)
    if isinstance(dtype, T.TimestampType):
        return F.coalesce(F.timestamp_micros(text.try_cast("bigint")), text.try_cast(dtype))
    return text.try_cast(dtype)


def _nested_from_wire(text: Column, dtype: T.DataType) -> Column:
    """One level is parsed with its values as text, then each value is read by its own type, so
    that a misfit at any depth makes the whole field null."""
    def bound(value: Column, use) -> Column:
        # the parse is evaluated once, however often its parts are used
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def fits(raw: Column, kind: T.DataType) -> Column:
        return raw.isNull() | from_wire(raw, kind).isNotNull()

    if isinstance(dtype, T.ArrayType):
        kind = dtype.elementType
        return bound(F.from_json(text, "array<string>"), lambda raw: F.when(
            F.forall(raw, lambda x: fits(x, kind)), F.transform(raw, lambda x: from_wire(x, kind))))
    if isinstance(dtype, T.MapType):
        keys, kind = dtype.keyType, dtype.valueType
        return bound(F.from_json(text, "map<string,string>"), lambda raw: F.when(
            F.forall(F.map_keys(raw), lambda k: from_wire(k, keys).isNotNull())
            & F.forall(F.map_values(raw), lambda v: fits(v, kind)),
            F.map_from_arrays(F.transform(F.map_keys(raw), lambda k: from_wire(k, keys)),
                              F.transform(F.map_values(raw), lambda v: from_wire(v, kind)))))
    broken = "_unreadable"
    level = T.StructType([*[T.StructField(f.name, T.StringType()) for f in dtype.fields],
                          T.StructField(broken, T.StringType())])

    def struct(raw: Column) -> Column:
        ok = text.isNotNull() & raw[broken].isNull()
        for f in dtype.fields:
            ok = ok & fits(raw[f.name], f.dataType)
        return F.when(ok, F.struct(*[from_wire(raw[f.name], f.dataType).alias(f.name)
                                     for f in dtype.fields]))

    return bound(F.from_json(text, level, {"columnNameOfCorruptRecord": broken}), struct)


def with_fields(rows: Column, data: Column) -> Column:
    """Parsed records with the names that each carries in ``fields``: a record without a column
    is told apart from one in which it is null."""
    listed = F.when(F.trim(data).startswith("{"), F.concat(F.lit("["), data, F.lit("]"))).otherwise(
        data)
    names = F.transform(F.from_json(listed, "array<string>"), F.json_object_keys)

    def named(known: Column) -> Column:
        return F.transform(rows, lambda r, i: r.withField(FIELDS, F.get(known, i)))

    # bound to a name, so that a payload is read once and not for each of its records
    return F.get(F.transform(F.array(names), named), F.lit(0))
