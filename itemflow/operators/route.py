"""Change records to keyed operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemflow.functions.expr import bind, case
from itemflow.functions.keys import composite_key, variant_key
from itemflow.functions.naming import rename_keys
from itemflow.functions.paths import field
from itemflow.functions.wire import av_map_type, decode_map, is_complete
from itemflow.operators.convert import BAD, to_documents
from itemflow.plans.pair import Mapping

UPSERT, DELETE = "UPSERT", "DELETE"


def operation(event_name: Column, new_image: Column, keys: Column) -> Column:
    """INSERT and MODIFY with a new image upsert, REMOVE with keys deletes, else NULL."""
    return F.when(event_name.isin("INSERT", "MODIFY") & new_image.isNotNull(), UPSERT).when(
        (event_name == "REMOVE") & keys.isNotNull(), DELETE
    )


def problem(event_name: Column, new_image: Column, keys: Column) -> Column:
    """Why a record yields no operation, NULL if it does."""
    return (
        F.when(event_name.isNull(), "malformed record")
        .when(event_name.isin("INSERT", "MODIFY") & new_image.isNull(), "new image missing")
        .when((event_name == "REMOVE") & keys.isNull(), "keys missing")
        .when(~event_name.isin("INSERT", "MODIFY", "REMOVE"), "unknown event")
    )


def unordered(seq_key: Column) -> Column:
    """Why an operation cannot be put in order, NULL if it can."""
    return F.when(seq_key.isNull(), "sequence number missing or not a number")


def delete_key(keys: str, mapping: Mapping) -> str:
    """Canonical key of a delete: the mapped key if it is there, else all keys, converted."""

    def of_decoded(decoded: str) -> str:
        def fallback(fields: str) -> str:
            own = variant_key(field(fields, mapping.key_target))
            whole = f"concat('k:', to_json(to_variant_object({fields})))"
            return f"coalesce({own}, {case((is_complete(keys, decoded), whole))})"

        unmapped = bind(rename_keys(decoded, mapping.naming), fallback)
        if mapping.key_source is None:
            return unmapped
        parts = [variant_key(field(decoded, f)) for f in mapping.key_fields]
        return f"coalesce({composite_key(parts)}, {unmapped})"

    options = {"binary": mapping.binary, "wide_numbers": mapping.wide_numbers}
    return bind(decode_map(keys, 0, **options), of_decoded)


def to_operations(changes: DataFrame, mapping: Mapping, strict: bool = False) -> DataFrame:
    """Operation rows ``(op, key, seq_key, approx_ts, doc, status, raw, field, reason)``.

    Records that yield no operation are skipped; with ``strict`` they go to the quarantine.
    Documents that cannot be converted and operations without a place in the order always do.
    Without a mapped key the record's own keys name the document, for upserts and deletes alike.
    """
    event, image, keys = F.col("event_name"), F.col("new_image"), F.col("keys")
    ordered = F.col("seq_key").isNotNull()
    own_keys = event == "REMOVE" if mapping.key_source else F.lit(True)
    routed = changes.select(
        "raw",
        operation(event, image, keys).alias("op"),
        F.coalesce(problem(event, image, keys), unordered(F.col("seq_key"))).alias("_problem"),
        "seq_key",
        "approx_ts",
        F.when(own_keys, keys).alias("_keys"),
        # A delete has no image: the empty item converts to an empty document at no cost.
        F.when(event.isin("INSERT", "MODIFY") & ordered, image)
        .when((event == "REMOVE") & ordered, F.create_map().cast(av_map_type(mapping.depth)))
        .alias("item"),
    )
    if not strict:
        routed = routed.filter(F.col("op").isNotNull() | (F.col("_problem") == "malformed record"))
    is_delete = F.col("op") == DELETE
    by_keys = F.col("_keys").isNotNull()
    routed = routed.withColumn("_delete_key", F.when(by_keys, F.expr(delete_key("_keys", mapping))))
    rows = to_documents(routed.drop("_keys"), mapping, path=("dynamodb", "NewImage"))
    by_own = F.lit(None).cast("string") if mapping.key_source else F.col("_delete_key")
    lost_key = is_delete & F.col("_delete_key").isNull()
    reason = F.when(lost_key, "keys cannot be decoded").otherwise(F.coalesce("_problem", "reason"))
    return rows.select(
        "op",
        F.when(is_delete, F.col("_delete_key")).otherwise(F.coalesce(by_own, "key")).alias("key"),
        "seq_key",
        "approx_ts",
        F.when(~is_delete, F.col("doc")).alias("doc"),
        F.when(reason.isNotNull(), BAD).otherwise(F.col("status")).alias("status"),
        "raw",
        "field",
        reason.alias("reason"),
    )


def operation_counts(changes: DataFrame) -> DataFrame:
    """Records per operation, skipped ones by reason."""
    event, image, keys = F.col("event_name"), F.col("new_image"), F.col("keys")
    return (
        changes.select(
            F.coalesce(operation(event, image, keys), F.lit("SKIP")).alias("op"),
            problem(event, image, keys).alias("problem"),
        )
        .groupBy("op", "problem")
        .agg(F.count(F.lit(1)).alias("records"))
    )


