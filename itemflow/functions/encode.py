"""Back to typed attribute values: from VARIANT documents and from typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.functions.deep import encode_deep
from itemflow.functions.expr import (
    NO_VALUE,
    VARIANT_MAP,
    bind,
    case,
    fn,
    get,
    has_null,
    lit,
    name,
    once,
)
from itemflow.functions.numbers import plain_double
from itemflow.functions.wire import DEFAULT_DEPTH


def _tagged(tag: str, value: str) -> str:
    return f"to_variant_object(struct({value} as `{tag}`))"


def encode_value(value: str, depth: int = DEFAULT_DEPTH) -> str:
    """VARIANT attribute value of a VARIANT; SQL NULL for a type that has no tag or lies
    deeper than ``depth``."""
    text = get(value, "string")

    # Elements and field values take one shared branch: two would double per level.
    def container(fields: str) -> str:
        children = f"coalesce(map_values({fields}), {get(value, 'array<variant>')})"
        encoded = f"transform({children}, {fn(lambda child: encode_value(child, depth - 1))})"
        return bind(
            encoded,
            lambda kids: case(
                (has_null(kids), NO_VALUE),
                (f"{fields} is not null", _tagged("M", f"map_from_arrays(map_keys({fields}), {kids})")),
                default=_tagged("L", kids),
            ),
        )

    def of_kind(kind: str) -> str:
        branches = [
            (f"{kind} = 'STRING'", _tagged("S", text)),
            (f"{kind} = 'BIGINT'", _tagged("N", text)),
            (f"{kind} = 'DOUBLE'", _tagged("N", bind(get(value, "double"), plain_double))),
            (f"{kind} like 'DECIMAL%'", _tagged("N", text)),
            (f"{kind} = 'BOOLEAN'", _tagged("BOOL", get(value, "boolean"))),
            (f"{kind} = 'VOID'", _tagged("NULL", "true")),
        ]
        if depth > 0:
            nested = f"{kind} like 'ARRAY%' or {kind} like 'OBJECT%'"
            branches.append((nested, bind(get(value, VARIANT_MAP), container)))
        return case(*branches)

    return bind(f"schema_of_variant({value})", of_kind)


def encode_map(fields: str, depth: int = DEFAULT_DEPTH) -> str:
    return f"transform_values({fields}, {fn(lambda _, v: encode_value(v, depth), 2)})"


def encode_documents(df: DataFrame, doc: str = "doc", depth: int = DEFAULT_DEPTH, deep: bool = True) -> DataFrame:
    """Add ``line``: the export line of a document, NULL if a value in it has no tag.

    Documents that nest deeper than ``depth`` take the Arrow path, if ``deep`` allows it; all others pass it as NULLs.
    """
    line = bind(
        encode_map(get(name(doc), VARIANT_MAP), depth),
        lambda m: case(
            (f"not {has_null(f'map_values({m})')}", f"to_json(named_struct('Item', {m}))")
        ),
    )
    rows = df.withColumn("line", once(line))
    if not deep:
        return rows
    rest = F.when(F.col("line").isNull() & F.col(name(doc)).isNotNull(), F.col(name(doc)))
    rows = rows.withColumn("_deep", F.try_variant_get(encode_deep(rest), "$.M", "variant"))
    deep_line = F.when(F.col("_deep").isNotNull(), F.to_json(F.struct(F.col("_deep").alias("Item"))))
    return rows.withColumn("line", once(F.coalesce("line", deep_line))).drop("_deep")


def encode_column(value: str, dtype: T.DataType) -> str:
    """Attribute value STRUCT of a typed column; the tag is chosen from the type."""

    def tagged(tag: str, body: str) -> str:
        return f"named_struct('{tag}', {body}, 'NULL', {case((f'{value} is null', 'true'))})"

    if isinstance(dtype, T.BooleanType):
        return tagged("BOOL", value)
    if isinstance(dtype, T.FloatType | T.DoubleType):
        # The short text of a float, not its digits as a double.
        return tagged("N", bind(f"cast(cast({value} as string) as double)", plain_double))
    if isinstance(dtype, T.NumericType):
        return tagged("N", f"cast({value} as string)")
    if isinstance(dtype, T.BinaryType):
        return tagged("B", f"base64({value})")
    if isinstance(dtype, T.TimestampType | T.TimestampNTZType):
        utc = value
        if isinstance(dtype, T.TimestampType):
            utc = f"to_utc_timestamp({value}, current_timezone())"
        text = f"""date_format({utc}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")"""
        return tagged("S", f"regexp_replace({text}, '[.]000000Z$', 'Z')")
    if isinstance(dtype, T.ArrayType):
        element = fn(lambda v: encode_column(v, dtype.elementType))
        return tagged("L", f"transform({value}, {element})")
    if isinstance(dtype, T.MapType):
        entry = fn(lambda _, v: encode_column(v, dtype.valueType), 2)
        return tagged("M", f"transform_values({value}, {entry})")
    if isinstance(dtype, T.StructType):
        fields = [
            f"{lit(f.name)}, {encode_column(f'{value}.{name(f.name)}', f.dataType)}" for f in dtype
        ]
        return tagged("M", case((f"{value} is not null", f"named_struct({', '.join(fields)})")))
    if isinstance(dtype, T.VariantType):
        return encode_value(value)
    return tagged("S", f"cast({value} as string)")


def encode_struct(df: DataFrame, columns: list[str] | None = None) -> Column:
    """STRUCT of attribute values, one field per column of ``df``."""
    chosen = columns or df.columns
    fields = [f"{lit(c)}, {encode_column(name(c), df.schema[c].dataType)}" for c in chosen]
    return F.expr(f"named_struct({', '.join(fields)})")


def _lost(value: str, dtype: T.DataType) -> str | None:
    """Whether a VARIANT somewhere in a typed value has no attribute value; None if there can be none."""
    if isinstance(dtype, T.VariantType):
        return f"({value} is not null and {encode_value(value)} is null)"
    if isinstance(dtype, T.ArrayType | T.MapType):
        inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype.valueType
        if _lost("v", inner) is None:
            return None
        values = value if isinstance(dtype, T.ArrayType) else f"map_values({value})"
        return f"coalesce(exists({values}, {fn(lambda v: _lost(v, inner))}), false)"
    if isinstance(dtype, T.StructType):
        found = [x for x in (_lost(f"{value}.{name(f.name)}", f.dataType) for f in dtype) if x]
        return f"({' or '.join(found)})" if found else None
    return None


def encode_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Typed rows as export lines: one STRING column ``value``, ready for ``write.text``.

    VARIANT columns are encoded at any depth. A row with a value that has no tag is NULL as a whole, never
    a line without it.
    """
    chosen = columns or df.columns
    rows = df.select(*[F.col(name(c)) for c in chosen])
    lost = []
    for c in chosen:
        dtype = df.schema[c].dataType
        if isinstance(dtype, T.VariantType):
            native, deep = f"_native {c}", f"_deep {c}"
            rows = rows.withColumn(native, once(encode_value(name(c))))
            rows = rows.withColumn(deep, encode_deep(F.when(F.col(name(native)).isNull(), F.col(name(c)))))
            lost.append(f"({name(c)} is not null and {name(native)} is null and {name(deep)} is null)")
        elif (found := _lost(name(c), dtype)) is not None:
            lost.append(found)
    fields = []
    for c in chosen:
        own = isinstance(df.schema[c].dataType, T.VariantType)
        value = f"coalesce({name(f'_native {c}')}, {name(f'_deep {c}')})" if own else encode_column(name(c), df.schema[c].dataType)
        fields.append(f"{lit(c)}, {value}")
    line = f"to_json(named_struct('Item', named_struct({', '.join(fields)})))"
    if lost:
        line = case((f"not ({' or '.join(lost)})", line))
    return rows.select(F.expr(line).alias("value"))
