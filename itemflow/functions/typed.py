"""Decode straight into typed columns when the caller knows the document schema.

The JSON reader gets a schema with only the wanted attributes and only the tags that can
yield the wanted type, so nothing else is parsed and no VARIANT is built.
A declared type doubles as the field transform: TIMESTAMP reads date-time text or Unix
seconds, DOUBLE reads numeric text.
"""

from __future__ import annotations

from pyspark.sql import types as T

from itemflow.functions.expr import bind, case, fn, lit, name
from itemflow.functions.numbers import int64
from itemflow.functions.transforms import in_range, text_to_double, text_to_timestamp
from itemflow.functions.wire import av_type, decode_value

_SMALL = (T.ByteType, T.ShortType, T.IntegerType)


def wire_type(dtype: T.DataType) -> str:
    """DDL of the attribute value that can hold ``dtype``."""
    if isinstance(dtype, T.VariantType):
        return av_type()
    tags = ["`NULL` boolean"]
    if isinstance(dtype, T.StructType):
        inner = ", ".join(f"`{f.name}` {wire_type(f.dataType)}" for f in dtype.fields)
        tags.append(f"M struct<{inner}>")
    elif isinstance(dtype, T.MapType):
        tags.append(f"M map<string, {wire_type(dtype.valueType)}>")
    elif isinstance(dtype, T.ArrayType):
        tags.append(f"L array<{wire_type(dtype.elementType)}>")
        if isinstance(dtype.elementType, T.StringType):
            tags += ["SS array<string>", "BS array<string>"]
        elif isinstance(dtype.elementType, T.NumericType):
            tags.append("NS array<string>")
    elif isinstance(dtype, T.BooleanType):
        tags.append("BOOL boolean")
    elif isinstance(dtype, T.NumericType):
        tags += ["N string", "S string"]
    elif isinstance(dtype, T.TimestampType):
        tags += ["S string", "N string"]
    else:
        tags += ["S string", "B string"]
    return f"struct<{', '.join(tags)}>"


def _number(text: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.LongType):
        return int64(text)
    if isinstance(dtype, _SMALL):
        return f"try_cast({int64(text)} as {dtype.simpleString()})"
    if isinstance(dtype, T.DecimalType):
        exact = f"try_cast({text} as {dtype.simpleString()})"
        return case((f"{text_to_double(text)} is not null", exact))
    return f"cast({text_to_double(text)} as {dtype.simpleString()})"


def typed_value(av: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.VariantType):
        return decode_value(av)
    if isinstance(dtype, T.StructType):
        fields = [f"{lit(f.name)}, {typed_value(f'{av}.M.{name(f.name)}', f.dataType)}" for f in dtype]
        return case((f"{av}.M is not null", f"named_struct({', '.join(fields)})"))
    if isinstance(dtype, T.MapType):
        return f"transform_values({av}.M, {fn(lambda _, v: typed_value(v, dtype.valueType), 2)})"
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        out = f"transform({av}.L, {fn(lambda v: typed_value(v, element))})"
        if isinstance(element, T.StringType):
            return f"coalesce({out}, {av}.SS, {av}.BS)"
        if isinstance(element, T.NumericType):
            return f"coalesce({out}, transform({av}.NS, {fn(lambda n: _number(n, element))}))"
        return out
    if isinstance(dtype, T.BooleanType):
        return f"{av}.BOOL"
    if isinstance(dtype, T.NumericType):
        return bind(f"coalesce({av}.N, {av}.S)", lambda text: _number(text, dtype))
    if isinstance(dtype, T.TimestampType):
        from_number = bind(
            text_to_double(f"{av}.N"), lambda s: case((in_range(s), f"timestamp_seconds({s})"))
        )
        return f"coalesce({bind(f'{av}.S', text_to_timestamp)}, {from_number})"
    text = f"coalesce({av}.S, {av}.B)"
    return text if isinstance(dtype, T.StringType) else f"try_cast({text} as {dtype.simpleString()})"


def misfit(av: str, value: str, dtype: T.DataType) -> str:
    """True when an attribute is there, is no explicit null, and does not fit the type.

    ``value`` is the decoded attribute, so that nothing is converted twice.
    """
    any_of = [f"({av} is not null and {av}.`NULL` is null and {value} is null)"]
    if isinstance(dtype, T.StructType):
        for f in dtype:
            any_of.append(misfit(f"{av}.M.{name(f.name)}", f"{value}.{name(f.name)}", f.dataType))
    elif isinstance(dtype, T.MapType):
        pair = fn(lambda a, v: misfit(a, v, dtype.valueType), 2)
        any_of.append(f"array_contains(zip_with(map_values({av}.M), map_values({value}), {pair}), true)")
    elif isinstance(dtype, T.ArrayType):
        pair = fn(lambda a, v: misfit(a, v, dtype.elementType), 2)
        any_of.append(f"array_contains(zip_with({av}.L, {value}, {pair}), true)")
        if isinstance(dtype.elementType, T.NumericType):
            any_of.append(f"({av}.NS is not null and exists({value}, {fn(lambda v: f'{v} is null')}))")
    return "(" + " or ".join(f"coalesce({part}, false)" for part in any_of) + ")"

