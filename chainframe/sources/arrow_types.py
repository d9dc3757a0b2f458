"""Import of any Arrow schema into Spark, and JSON egress of rows.

Spark takes most Arrow types as they are. The others are cast in Arrow first: unsigned integers and half
floats widen, millisecond dates keep their time as timestamps, times become microseconds, calendar
intervals and unions become structs, wide decimals become strings, dictionaries become their values.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDER = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64(), pa.uint64(): pa.decimal128(20, 0), pa.float16(): pa.float32(), pa.date64(): pa.timestamp("ms")}
MOST_DECIMAL_DIGITS = 38
MONTH_DAY_NANO = pa.struct([("months", pa.int32()), ("days", pa.int32()), ("nanoseconds", pa.int64())])


def normal_type(t: pa.DataType) -> pa.DataType:
    """The Arrow type that stands for t in Spark."""
    k = pa.types
    if t in _WIDER:
        return _WIDER[t]
    if k.is_dictionary(t):
        return normal_type(t.value_type)
    if k.is_decimal(t):
        return pa.string() if t.precision > MOST_DECIMAL_DIGITS else pa.decimal128(t.precision, t.scale)
    if k.is_time(t):
        return pa.time64("us")
    if k.is_timestamp(t):
        return pa.timestamp("us", t.tz)
    if k.is_duration(t):
        return pa.duration("us")
    if t == pa.month_day_nano_interval():
        return MONTH_DAY_NANO
    if k.is_large_string(t) or k.is_string_view(t):
        return pa.string()
    if k.is_large_binary(t) or k.is_fixed_size_binary(t) or k.is_binary_view(t):
        return pa.binary()
    if k.is_map(t):  # Spark's maps refuse the repeated keys that Arrow allows
        return pa.list_(pa.struct([pa.field("key", normal_type(t.key_type), False), pa.field("value", normal_type(t.item_type))]))
    if k.is_list(t) or k.is_large_list(t) or k.is_fixed_size_list(t):
        return pa.list_(t.value_field.with_type(normal_type(t.value_type)))
    if k.is_struct(t):
        return pa.struct([f.with_type(normal_type(f.type)) for f in t])
    if k.is_union(t):
        return pa.struct([pa.field("_type", pa.string()), *(pa.field(t.field(i).name, normal_type(t.field(i).type)) for i in range(t.num_fields))])
    return t


def normal_schema(schema: pa.Schema) -> pa.Schema:
    return pa.schema([f.with_type(normal_type(f.type)) for f in schema], schema.metadata)


def normal_array(a: pa.Array) -> pa.Array:
    """The array as its normal type; nulls stay nulls."""
    t, k = a.type, pa.types
    to = normal_type(t)
    if t == to:
        return a
    if k.is_union(t) or k.is_map(t) or t == pa.month_day_nano_interval() or k.is_nested(t):
        return pa.array([_plain(x, t) for x in a], to)
    if k.is_dictionary(t):
        return normal_array(a.dictionary_decode())
    if k.is_decimal(t) and k.is_string(to):
        return pa.array([None if x is None else format(x, "f") for x in a.to_pylist()], to)
    if k.is_temporal(t):
        return pc.cast(a, to, safe=False)
    return pc.cast(a, to)


def _plain(x: pa.Scalar, t: pa.DataType):
    """A scalar as Python data of the normal type."""
    k = pa.types
    if not x.is_valid and not k.is_union(t):
        return None
    if k.is_union(t):
        codes = [t.type_codes.index(x.type_code)] if x.type_code in t.type_codes else []
        return {"_type": t.field(codes[0]).name if codes else None, **{t.field(i).name: _plain(x.value, t.field(i).type) if codes == [i] and x.value is not None else None for i in range(t.num_fields)}}
    if k.is_map(t):
        return [{"key": _plain(e["key"], t.key_type), "value": _plain(e["value"], t.item_type)} for e in x.values]
    if k.is_struct(t):
        return {f.name: _plain(x[f.name], f.type) for f in t}
    if k.is_nested(t):
        return [_plain(e, t.value_type) for e in x.values]
    if t == pa.month_day_nano_interval():
        months, days, nanos = x.as_py()
        return {"months": months, "days": days, "nanoseconds": nanos}
    return normal_array(pa.array([x.as_py()], t))[0].as_py()


def normal_table(table: pa.Table) -> pa.Table:
    return pa.Table.from_arrays([pa.chunked_array([normal_array(c) for c in column.chunks], normal_type(column.type)) for column in table.columns], schema=normal_schema(table.schema))


def from_arrow(spark: SparkSession, table: pa.Table) -> DataFrame:
    return spark.createDataFrame(normal_table(table))


def read_ipc(spark: SparkSession, paths: Iterable[str] | str, schema: pa.Schema | None = None) -> DataFrame:
    """Arrow IPC streams (compressed or not, with dictionaries or not) as a DataFrame; a task reads a file at a time.

    schema: what the streams hold; by default the first stream is asked.
    """
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    if schema is None:
        schema = pa.ipc.open_stream(files.orderBy("path").first()["content"]).schema
    normal = normal_schema(schema)
    ddl = spark.createDataFrame(normal_table(schema.empty_table())).schema

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                for found in pa.ipc.open_stream(content.as_py()):
                    yield pa.RecordBatch.from_arrays([normal_array(c) for c in found.columns], schema=normal)

    return files.select("content").mapInArrow(run, ddl)


class Egress(NamedTuple):
    """How rows leave as JSON: longs as string or number; times as iso or timestamp (milliseconds since 1970); binary as base64, hex or array (of bytes)."""

    longs: str = "string"
    times: str = "iso"
    binary: str = "base64"


def _json_binary(column: Column, form: str) -> Column:
    if form == "hex":
        return F.lower(F.hex(column))
    if form == "array":
        digits = F.regexp_extract_all(F.hex(column), F.lit("(..)"), F.lit(1))
        return F.transform(digits, lambda x: F.conv(x, 16, 10).cast("int"))
    return F.regexp_replace(F.base64(column), "[\r\n]", "")


def json_value(column: Column, kind: T.DataType, how: Egress = Egress()) -> Column:
    """A value as JSON consumers get it, by default 64-bit integers as strings, binary as base64 in one line, dates and times as ISO
    with milliseconds cut towards zero. Decimals are strings, maps arrays of key and value."""
    if isinstance(kind, T.LongType):
        return column.cast("string") if how.longs == "string" else column
    if isinstance(kind, T.DecimalType):
        return column.cast("string")
    if isinstance(kind, T.BinaryType):
        return _json_binary(column, how.binary)
    if isinstance(kind, T.DateType):
        return F.date_format(column, "yyyy-MM-dd'T'00:00:00.000'Z'") if how.times == "iso" else F.unix_date(column).cast("long") * 86_400_000
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        micros = F.unix_micros(column.cast("timestamp"))
        # whole milliseconds towards zero: a floor would take times before 1970 one further
        millis = ((micros - micros % 1000) / 1000).cast("long")
        return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") if how.times == "iso" else millis
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: json_value(x, kind.elementType, how))
    if isinstance(kind, T.StructType):
        return F.when(column.isNotNull(), F.struct(*(json_value(column[f.name], f.dataType, how).alias(f.name) for f in kind)))
    if isinstance(kind, T.MapType):
        return F.transform(F.map_entries(column), lambda e: F.struct(json_value(e["key"], kind.keyType, how).alias("key"), json_value(e["value"], kind.valueType, how).alias("value")))
    return column


def json_ready(df: DataFrame, how: Egress = Egress()) -> DataFrame:
    return df.select(*(json_value(F.col(f.name), f.dataType, how).alias(f.name) for f in df.schema))


def to_json(df: DataFrame, nulls: bool = True, how: Egress = Egress()) -> DataFrame:
    """One JSON object a row, in column ``value``."""
    return json_ready(df, how).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false" if nulls else "true"}).alias("value"))


def write_json(df: DataFrame, path: str, nulls: bool = True, how: Egress = Egress(), mode: str = "error") -> None:
    """Writes a JSON object a line, in as many files as df has partitions (one array for all rows would be one task's work)."""
    to_json(df, nulls, how).write.mode(mode).text(path)
