"""Reports: source and target profiles, progress, pair status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemflow.plans.ledger import Ledger
from itemflow.plans.pair import Pair
from itemflow.sinks.table import DocTable, said
from itemflow.sources.items import read_lines


def source_profile(spark: SparkSession, path: str) -> DataFrame:
    """One row: number of items and their size in bytes."""
    return read_lines(spark, path).agg(
        F.count(F.lit(1)).alias("items"),
        F.coalesce(F.sum(F.octet_length("raw")), F.lit(0)).alias("bytes"),
    )


def scan_counts(items: DataFrame, kept: Column) -> DataFrame:
    """One row: rows scanned and rows that satisfy a predicate."""
    return items.agg(
        F.count(F.lit(1)).alias("scanned_count"),
        F.count_if(kept).alias("item_count"),
    )


def progress(processed: Column, total: Column, seconds: Column) -> list[Column]:
    """Percentage and rows per second; NULL instead of a division by zero."""
    return [
        F.try_divide(processed * 100.0, total).alias("percent"),
        F.try_divide(processed, seconds).alias("rows_per_second"),
    ]


def pair_status(spark: SparkSession, pair: Pair, table: DocTable, ledger: Ledger) -> DataFrame:
    """One row for a pair. Each part is a small aggregation tagged with the pair's name."""
    name = F.lit(pair.name).alias("pair")
    run = ledger.current_run(pair.name) or {}
    seen = ledger.read().filter(
        (F.col("run_id") == run.get("run_id", "")) & F.col("event").isin("segment", "batch")
    )

    # Segment rows add up; the newest row of a stream holds running counts.
    def total(column: str) -> Column:
        segments = F.sum(F.when(F.col("event") == "segment", F.col(column)))
        stream = F.max_by(column, F.when(F.col("event") == "batch", F.col("batch_id")))
        return F.coalesce(segments, stream, F.lit(0)).alias(column)

    done = seen.agg(
        total("processed"),
        total("quarantined"),
        F.max("high_water").alias("high_water"),
        F.max("updated").alias("last_updated"),
    ).select(
        name,
        F.lit(run.get("mode")).cast("string").alias("mode"),
        F.lit(run.get("stream_id")).cast("string").alias("stream_id"),
        F.lit(run.get("bootstrap_done")).cast("boolean").alias("bootstrap_done"),
        "*",
    )
    try:
        source = source_profile(spark, pair.source).select(
            name, "items", "bytes", F.lit(None).cast("string").alias("source_error")
        )
    except Exception as error:  # a part that cannot be read says so in its column
        source = spark.createDataFrame(
            [(pair.name, None, None, said(error))],
            "pair string, items bigint, bytes bigint, source_error string",
        )
    target = table.count().select(name, "documents")
    joined = done.join(source, "pair").join(target, "pair")
    started = F.lit(run.get("started")).cast("timestamp")
    seconds = (F.unix_micros("last_updated") - F.unix_micros(started)) / 1000000
    return joined.select(
        "*",
        F.lit(pair.changes is not None).alias("stream_enabled"),
        *progress(F.col("processed"), F.col("items"), seconds),
    )
