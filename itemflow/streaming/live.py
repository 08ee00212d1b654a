"""Follow a change log: file stream, route, append by batch id, move the high-water mark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from itemflow.operators.convert import GOOD
from itemflow.operators.route import operation, to_operations
from itemflow.plans.ledger import DROPS, Ledger
from itemflow.plans.pair import Mapping
from itemflow.sinks.table import ROW, DocTable
from itemflow.sources.changes import parse_changes, read_change_lines, since


def change_operations(
    lines: DataFrame, mapping: Mapping, start: dt.datetime | None = None, strict: bool = False
) -> DataFrame:
    """Operation rows of raw change lines; the same plan in batch and in a stream."""
    changes = since(parse_changes(lines, mapping.depth, old_images=False), start, keep_malformed=True)
    return to_operations(changes, mapping, strict)


def drop_metrics(start: dt.datetime | None, strict: bool) -> list[Column]:
    """What a batch of parsed records holds and what of it makes no operation, each record counted once."""
    malformed = F.col("event_name").isNull()
    timed = F.lit(False) if start is None else F.unix_millis("approx_ts") < F.unix_millis(F.lit(start).cast("timestamp"))
    untimed = F.lit(False) if start is None else F.col("approx_ts").isNull() & ~malformed
    older = F.coalesce(timed, F.lit(False)) & ~malformed
    idle = operation(F.col("event_name"), F.col("new_image"), F.col("keys")).isNull() & ~malformed & ~older & ~untimed
    return [
        F.count(F.lit(1)).alias("read"), F.count_if(older).alias("older"), F.count_if(untimed).alias("untimed"),
        F.count_if(idle & F.lit(not strict)).alias("skipped"),
    ]


def apply_batch(
    table: DocTable, ledger: Ledger, run_id: str, name: str, mapping: Mapping, start: dt.datetime | None, strict: bool,
    result_counts: bool = False,
):
    """The ``foreachBatch`` function for raw lines: all that it writes is named after the batch id.

    What the batch drops is observed in the pass that writes it.
    """

    def apply(lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        dropped = Observation()
        changes = parse_changes(lines, mapping.depth, old_images=False).observe(dropped, *drop_metrics(start, strict))
        ops = to_operations(since(changes, start, keep_malformed=True), mapping, strict)
        path = table.append_batch(ops, batch_id, run_id)
        written = spark.read.schema(ROW).parquet(path)
        counts = written.agg(
            F.count(F.lit(1)).alias("processed"),
            F.count_if(F.col("status") != GOOD).alias("quarantined"),
            F.max("approx_ts").alias("high_water"),
        ).select("*", *[F.lit(dropped.get[c]).cast("bigint").alias(c) for c in DROPS])
        if result_counts:
            effects = table.batch_effects(batch_id, run_id).withColumn("_one", F.lit(1))
            counts = counts.withColumn("_one", F.lit(1)).join(effects, "_one").drop("_one")  # one row each
        ledger.batch_done(run_id, name, batch_id, counts)

    return apply


def follow(
    spark: SparkSession,
    changes_path: str,
    table: DocTable,
    ledger: Ledger,
    mapping: Mapping,
    run_id: str,
    name: str,
    start: dt.datetime | None,
    trigger: dict | None = None,
    max_files: int | None = None,
    strict: bool = False,
    result_counts: bool = False,
) -> StreamingQuery:
    """Start the stream. Offsets live in a checkpoint next to the table, one per run.

    The default trigger polls every 30 seconds; ``{"availableNow": True}`` reads what is
    there and stops.
    """
    lines = read_change_lines(spark, changes_path, streaming=True, max_files=max_files)
    apply = apply_batch(table, ledger, run_id, name, mapping, start, strict, result_counts)
    return (
        lines.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{table.root}/_stream/{run_id}")
        .queryName(name)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )
