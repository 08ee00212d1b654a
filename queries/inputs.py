"""Items and change records built by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemflow.functions.encode import encode_columns, encode_struct
from itemflow.session import spread, work_folder

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
START = "2024-01-15 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def micros(column: str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, {column})")


def lines_of(df: DataFrame) -> DataFrame:
    """Typed rows as raw export lines."""
    return encode_columns(df).select(F.col("value").alias("raw"))


def order_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderKey"),
        F.col("o_custkey").alias("custKey"),
        F.col("o_orderstatus").alias("orderStatus"),
        F.struct(
            F.col("o_totalprice").alias("totalPrice"), F.col("o_orderpriority").alias("orderPriority")
        ).alias("orderInfo"),
        F.col("o_orderdate").alias("orderDate"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(order_columns(spark, sf_dir))


def change_lines(events: DataFrame) -> DataFrame:
    """Change records keyed by user: signup inserts, error removes, the rest modifies."""
    name = (
        F.when(F.col("event_type") == "signup", "INSERT")
        .when(F.col("event_type") == "error", "REMOVE")
        .otherwise("MODIFY")
    )
    source = events.select(
        "event_id", "event_type", "ts", F.col("user_id").alias("userId"), F.col("event_id").alias("eventId"),
        F.col("event_type").alias("eventType"), "value", "props",
    )
    image = encode_struct(source, ["userId", "eventId", "eventType", "value", "props"])
    record = F.struct(
        name.alias("eventName"),
        F.lit("aws:dynamodb").alias("eventSource"),
        F.lit("us-west-2").alias("awsRegion"),
        F.concat(F.lit("shard-"), F.col("userId") % 4).alias("shardId"),
        F.struct(
            (micros("ts") / 1000000).alias("ApproximateCreationDateTime"),
            encode_struct(source, ["userId"]).alias("Keys"),
            F.when(name != "REMOVE", image).alias("NewImage"),
            F.col("event_id").cast("string").alias("SequenceNumber"),
            F.length("props").cast("bigint").alias("SizeBytes"),
            F.lit("NEW_IMAGE").alias("StreamViewType"),
        ).alias("dynamodb"),
    )
    return source.select(F.to_json(record).alias("raw"))


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_lines(table(spark, sf_dir, "events"))


def staged(spark: SparkSession, lines: DataFrame, name: str, files: int | None = None) -> str:
    """Write raw lines as an export of about ``files`` files in the shared folder; its path."""
    path = work_folder(spark, name)
    out = lines.repartition(files) if files else lines
    out.write.text(path)
    return path


def field(path: str, ddl: str, doc: str = "doc") -> Column:
    return F.try_variant_get(F.col(doc), "$." + path, ddl)


def document_table(spark: SparkSession, name: str):
    """A new document table in the shared folder."""
    from itemflow.sinks.table import DocTable

    return DocTable(spark, work_folder(spark, name))
