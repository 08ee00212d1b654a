"""Item exports: JSON lines ``{"Item": {name: attribute value}}``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.functions.expr import bind, case, lit, name, once
from itemflow.functions.paths import field
from itemflow.functions.typed import misfit, typed_value, wire_type
from itemflow.functions.wire import DEFAULT_DEPTH, av_map_type, av_type
from itemflow.plans.pair import Scan


def read_lines(
    spark: SparkSession, path: str, segments: int | None = None, segment: int | None = None
) -> DataFrame:
    """Raw lines as ``raw``; with ``segments``, only those of one of that many segments.

    Each file belongs to one segment by its name, so the choice prunes whole files while the
    plan is made, and a resumed run never reads what is already done.
    """
    lines = spark.read.text(path, recursiveFileLookup=True)
    if segments is not None:
        lines = lines.filter(file_segment(F.col("_metadata.file_path"), segments) == segment)
    return lines.select(F.col("value").alias("raw"))


def file_segment(file_path: Column, segments: int) -> Column:
    return F.pmod(F.xxhash64(file_path), F.lit(segments)).cast("int")


def parse_items(
    lines: DataFrame, depth: int = DEFAULT_DEPTH, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Add ``item MAP<STRING, attribute value>``; NULL for a line that is not one item and nothing else.

    With ``columns`` the JSON reader skips every other attribute.
    """
    if columns is None:
        return lines.withColumn("item", F.expr(_only_item(av_map_type(depth))))
    fields = ", ".join(f"`{c}` {av_type(depth)}" for c in columns)
    narrow = lines.withColumn("_item", F.expr(_only_item(f"struct<{fields}>")))
    entries = [F.lit(c) for c in columns], [F.col("_item")[c] for c in columns]
    as_map = F.map_from_arrays(F.array(*entries[0]), F.array(*entries[1]))
    present = F.map_filter(as_map, lambda _, v: v.isNotNull())
    return narrow.withColumn("item", F.when(F.col("_item").isNotNull(), present)).drop("_item")


def _only_item(ddl: str) -> str:
    """The item of a line. The reader stops after one value, so the line is read as the one element of a list."""
    read = f"from_json(concat('[', raw, ']'), {lit(f'array<struct<Item: {ddl}>>')})"
    return bind(read, lambda r: case((f"size({r}) = 1", f"{r}[0].Item")))


def filter_items(items: DataFrame, scan: Scan) -> DataFrame:
    """Keep the items that satisfy ``scan.where``; a missing attribute is NULL in it.

    Lines that are no items stay, so that they reach the quarantine.
    """
    if scan.where is None:
        return items
    text = scan.where
    for alias in sorted(scan.names, key=len, reverse=True):
        text = re.sub(re.escape(alias) + r"\b", name(scan.names[alias]), text)
    typed = []
    for attribute, ddl in scan.attributes.items():
        dtype = T._parse_datatype_string(ddl)
        value = bind(field("item", attribute), lambda av: typed_value(av, dtype))
        typed.append(F.expr(value).alias(attribute))
    # The attributes are the only columns the predicate sees, next to the row they come from.
    parsed = items.withColumn("item", once(F.col("item")))
    candidates = parsed.select(F.struct("*").alias("_row"), *typed)
    return items.sparkSession.sql(
        f"SELECT _row.* FROM {{candidates}} WHERE _row.item IS NULL OR ({text})",
        args={k.lstrip(":"): v for k, v in scan.values.items()} or None,
        candidates=candidates,
    )


def scan_items(
    spark: SparkSession,
    path: str,
    scan: Scan | None = None,
    depth: int = DEFAULT_DEPTH,
    segments: int | None = None,
    segment: int | None = None,
) -> DataFrame:
    """Parsed items with ``raw``, filtered and projected as ``scan`` says."""
    scan = scan or Scan()
    wanted = scan.columns
    if wanted is not None:
        wanted = tuple(dict.fromkeys((*wanted, *scan.attributes)))
    items = filter_items(parse_items(read_lines(spark, path, segments, segment), depth, wanted), scan)
    if scan.columns is not None and wanted != scan.columns:
        keep = list(scan.columns)
        items = items.withColumn("item", F.map_filter("item", lambda k, _: k.isin(keep)))
    return items


def typed_items(lines: DataFrame, schema: str | T.StructType) -> DataFrame:
    """``fields STRUCT`` of declared types plus ``misfits``, the names that did not fit.

    ``schema`` uses the attribute names of the source. Parsing and decoding are one bound
    expression: generated code for wide schemas would outgrow what the JVM compiles.
    """
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    inner = ", ".join(f"`{f.name}` {wire_type(f.dataType)}" for f in struct.fields)

    def decoded(wire: str) -> str:
        attrs = {f.name: f"{wire}.{name(f.name)}" for f in struct}
        values = [f"{typed_value(attrs[f.name], f.dataType)} as {name(f.name)}" for f in struct]

        def checked(fields: str) -> str:
            names = [
                case((misfit(attrs[f.name], f"{fields}.{name(f.name)}", f.dataType), lit(f.name)))
                for f in struct
            ]
            return f"struct({fields} as fields, concat_ws(',', {', '.join(names)}) as misfits)"

        return case((f"{wire} is not null", bind(f"struct({', '.join(values)})", checked)))

    item = _only_item(f"struct<{inner}>")
    rows = lines.select(*lines.columns, once(bind(item, decoded)).alias("_typed"))
    return rows.select(
        *lines.columns,
        F.col("_typed.fields").alias("fields"),
        F.coalesce("_typed.misfits", F.lit("*")).alias("misfits"),
    )
