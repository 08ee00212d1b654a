"""Items to documents: decode, key mapping, renaming, transforms, quarantine.

A document row is ``(key, doc, status, raw, field, reason)``. Nothing is dropped: a row
that cannot be converted has ``status='quarantine'`` and keeps its raw text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.functions.deep import decode_deep
from itemflow.functions.expr import bind, case, fn, lit, name, once
from itemflow.functions.keys import composite_key, variant_key
from itemflow.functions.naming import rename_keys, rename_text
from itemflow.functions.paths import as_object, field
from itemflow.functions.transforms import apply_transforms, passes
from itemflow.functions.wire import decode_map, is_complete
from itemflow.plans.pair import Mapping
from itemflow.sources.items import typed_items

GOOD, BAD = "good", "quarantine"
UNQUOTED = r'"(S|N|B)"\s*:\s*[^"\s]'


def _failing(fields: str) -> str:
    bad = f"map_filter({fields}, {fn(lambda _, v: f'{v} is null', 2)})"
    return f"array_join(array_sort(map_keys({bad})), ',')"


def decode_items(
    items: DataFrame,
    mapping: Mapping,
    item: str = "item",
    path: tuple[str, ...] = ("Item",),
) -> DataFrame:
    """Replace ``item`` by ``attrs MAP<STRING, VARIANT>`` (source names), NULL when anything
    failed, and ``failed``: the names that cannot be decoded, ``*`` for a line that is no item.

    The rows that the native decode leaves get a second try over Arrow, if the mapping
    allows it; all other rows pass that step as NULLs.
    """
    options = {
        "naming": mapping.naming,
        "binary": mapping.binary,
        "wide_numbers": mapping.wide_numbers,
    }

    # The JSON reader turns any value into text where text is asked for. Lines in which the body of a text tag does not
    # start with a quote are left to the strict decoder.
    trusted = ~F.col("raw").rlike(UNQUOTED) if mapping.deep else F.lit(True)

    # ``item`` is used once, so its parser runs inside this one expression and neither the
    # wire form nor the partly decoded map is ever written out as a row.
    def decoded(wire: str) -> str:
        def checked(native: str) -> str:
            return bind(
                case((is_complete(wire, native), native)),
                lambda attrs: (
                    f"struct({attrs} as attrs, "
                    f"{case((f'{attrs} is null', _failing(native)))} as failed, "
                    f"map_keys({native}) as names)"
                ),
            )

        native = bind(decode_map(wire, mapping.depth, **options), checked)
        return case((f"{wire} is not null", native))

    passed = [F.col(c) for c in items.columns if c != item]
    rows = items.select(*passed, F.expr(bind(name(item), decoded)).alias("_decoded"), trusted.alias("_trusted")).select(
        *passed,
        F.when(F.col("_trusted"), F.col("_decoded.attrs")).alias("attrs"),
        F.when(F.col("_decoded").isNull(), "*").when(F.col("_trusted"), F.col("_decoded.failed")).otherwise("?").alias("failed"),
        F.col("_decoded.names").alias("_names"),
    )
    if not mapping.deep:
        return rows.drop("_names")
    leftover = F.when(F.col("failed") != "*", F.col("raw"))
    deep, still_failed = decode_deep(leftover, F.when(leftover.isNotNull(), F.col("_names")), path, **options)
    rows = rows.withColumns({"_deep": deep, "_still": still_failed})
    rows = rows.withColumn("failed", F.when(F.col("_deep").isNull(), F.coalesce("_still", "failed")))
    return rows.withColumn("attrs", F.coalesce("attrs", "_deep")).drop("_deep", "_still", "_names")


def _key_value(attrs: str, mapping: Mapping) -> str:
    values = [field(attrs, f) for f in mapping.key_fields]
    if len(values) == 1:
        return values[0]
    present = " and ".join(f"{v} is not null" for v in values)
    parts = [
        f"{v} as {name(rename_text(f, mapping.naming))}"
        for f, v in zip(mapping.key_fields, values, strict=True)
    ]
    return case((present, f"to_variant_object(struct({', '.join(parts)}))"))


def document_fields(attrs: str, mapping: Mapping) -> str:
    """Renamed fields with the key under its target name, which wins over a field of that name."""
    if mapping.key_source is None:
        return rename_keys(attrs, mapping.naming)
    sources = ", ".join(lit(f) for f in mapping.key_fields)
    target = lit(mapping.key_target)
    others = f"map_filter({attrs}, {fn(lambda k, _: f'{k} not in ({sources})', 2)})"

    def keyed(key: str) -> str:
        rest = rename_keys(others, mapping.naming)
        free = f"map_filter({rest}, {fn(lambda k, _: f'{k} <> {target}', 2)})"
        return case(
            (f"{key} is not null", f"map_concat(map({target}, {key}), {free})"),
            default=rename_keys(attrs, mapping.naming),
        )

    return bind(_key_value(attrs, mapping), keyed)


def document_key(attrs: str, fields: str, mapping: Mapping) -> str:
    """Canonical key: the mapped attributes before any transform, so that a change record's
    keys give the same text; else the field already called like the key."""
    own = variant_key(field(fields, mapping.key_target))
    if mapping.key_source is None:
        return own
    parts = [variant_key(field(attrs, f)) for f in mapping.key_fields]
    return f"coalesce({composite_key(parts)}, {own})"


def _document(attrs: str, mapping: Mapping) -> str:
    """STRUCT<key, doc, failed> of decoded attributes."""

    def finish(fields: str, key: str) -> str:
        return bind(
            as_object(fields),
            lambda doc: (
                f"struct({key} as key, {doc} as doc, "
                f"{case((f'{doc} is null', _failing(fields)))} as failed)"
            ),
        )

    def transformed(fields: str, key: str, todo: list) -> str:
        if not todo:
            return finish(fields, key)
        changed = apply_transforms(fields, todo[0], mapping.exact_decimals)
        return bind(changed, lambda m: transformed(m, key, todo[1:]))

    return bind(
        document_fields(attrs, mapping),
        lambda fields: transformed(
            fields, document_key(attrs, fields, mapping), passes(mapping.transforms)
        ),
    )


def to_documents(
    items: DataFrame,
    mapping: Mapping,
    item: str = "item",
    path: tuple[str, ...] = ("Item",),
) -> DataFrame:
    """Document rows of parsed items (``raw`` and ``item``); other columns pass through."""
    passed = [F.col(c) for c in items.columns if c not in ("raw", item)]
    rows = decode_items(items, mapping, item, path)
    made = bind("attrs", lambda a: case((f"{a} is not null", _document(a, mapping))))
    rows = rows.select(
        *passed,
        "raw",
        "failed",
        F.col("attrs").isNotNull().alias("_decoded"),
        once(made).alias("_made"),
    )
    ok = F.col("_made.doc").isNotNull()
    return rows.select(
        *passed,
        F.when(ok, F.col("_made.key")).alias("key"),
        F.col("_made.doc").alias("doc"),
        F.when(ok, GOOD).otherwise(BAD).alias("status"),
        F.when(~ok, F.col("raw")).alias("raw"),
        F.when(F.col("_decoded"), F.col("_made.failed")).otherwise(F.col("failed")).alias("field"),
        F.when(F.col("failed") == "*", "malformed record")
        .when(~F.col("_decoded"), "value cannot be decoded")
        .when(~ok, "transform failed")
        .alias("reason"),
    )


def typed_documents(lines: DataFrame, schema: str | T.StructType, mapping: Mapping) -> DataFrame:
    """Typed document columns of raw lines, for callers who know the schema.

    Names are settled while the plan is built, so renaming costs nothing per row. Rows that
    do not fit come back with ``misfits`` filled; ``key`` is NULL for keyless rows.
    """
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    rows = typed_items(lines, struct)
    names = {f.name: rename_text(f.name, mapping.naming) for f in struct.fields}
    if len(mapping.key_fields) == 1:
        names[mapping.key_fields[0]] = mapping.key_target
    seen: dict[str, str] = {}
    for source in sorted(names, key=lambda s: (s in mapping.key_fields, s)):
        seen[names[source]] = source
    types = {f.name: f.dataType for f in struct}
    columns = [
        _renamed(F.col("fields")[seen[new]], types[seen[new]], mapping.naming).alias(new)
        for new in dict.fromkeys(names.values())
    ]
    passed = [F.col(c) for c in lines.columns]
    return rows.select(*passed, *columns, "misfits")


def _renamed(value: Column, dtype: T.DataType, naming: str) -> Column:
    """A typed value with the names of its structs and maps renamed, at any depth of its schema."""
    if naming == "preserve" or not _has_names(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda v: _renamed(v, dtype.elementType, naming))
    if isinstance(dtype, T.MapType):
        inner = F.transform_values(value, lambda _, v: _renamed(v, dtype.valueType, naming))
        # Of names that meet the last in source order stays, as in documents.
        pairs = F.array_sort(F.map_entries(inner), lambda a, b: F.when(a["key"] < b["key"], -1).otherwise(1))
        named = F.transform(pairs, lambda e: F.struct(_name_of(e["key"], naming).alias("key"), e["value"].alias("value")))
        last = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda later: later["key"] == e["key"]))
        return F.when(value.isNotNull(), F.map_from_entries(last))
    fields = [
        _renamed(value[f.name], f.dataType, naming).alias(rename_text(f.name, naming))
        for f in dtype.fields
    ]
    return F.when(value.isNotNull(), F.struct(*fields))


def _has_names(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_names(dtype.elementType)
    return isinstance(dtype, (T.StructType, T.MapType))


def _name_of(key: Column, naming: str) -> Column:
    """The rule of ``functions/naming`` as a Column over a map's keys."""
    if naming == "snake_case":
        return F.lower(F.regexp_replace(key, r"(?s)(?<=.)([A-Z])", "_$1"))
    parts = F.split(key, "_", -1)
    raised = F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.substr(p, F.lit(2))))
    return F.concat(parts[0], F.array_join(raised, ""))


def good(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("status") == GOOD).drop("status", "raw", "field", "reason")


def quarantined(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("status") == BAD).select("raw", "field", "reason")

