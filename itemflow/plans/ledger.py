"""Progress ledger: small parquet rows.

Every write goes to a directory of its own name and overwrites only that, so a repeated
write of the same fact changes nothing, and a half-written one is not seen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemflow.operators.latest import EFFECTS

SCHEMA = (
    "run_id string, table string, mode string, event string, segment int, segments int, "
    "batch_id bigint, processed bigint, quarantined bigint, completed boolean, "
    "start_ts timestamp, high_water timestamp, stream_id string, bootstrap_done boolean, "
    "read bigint, older bigint, untimed bigint, skipped bigint, "
    "inserted bigint, upserted bigint, modified bigint, unchanged bigint, deleted bigint, not_found bigint, "
    "updated timestamp"
)
#: What a stream read and what of it made no operation: before the start time, without a time, of no kind to apply.
DROPS = ("read", "older", "untimed", "skipped")
#: Columns that add up over the batches of a stream.
SUMS = ("processed", "quarantined", *DROPS, *EFFECTS)
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self) -> DataFrame:
        """All rows of all runs; empty when there are none."""
        reader = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true")
        try:
            return reader.parquet(self.root)
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return self.spark.createDataFrame([], SCHEMA)
            raise

    def table(self, table: str) -> DataFrame:
        return self.read().filter(F.col("table") == table)

    def tables(self) -> DataFrame:
        """Tables with saved progress."""
        return self.read().filter("event != 'deleted'").select("table").distinct()

    def append(self, name: str, **row: object) -> None:
        values = {"updated": dt.datetime.now(dt.timezone.utc), **row}
        record = self.spark.createDataFrame([tuple(values.get(c) for c in COLUMNS)], SCHEMA)
        self.append_rows(name, record)

    def append_rows(self, name: str, rows: DataFrame) -> None:
        missing = [
            F.lit(None).cast(c.split()[1]).alias(c.split()[0])
            for c in SCHEMA.split(", ")
            if c.split()[0] not in rows.columns
        ]
        full = rows.select("*", *missing).select(*COLUMNS)
        full.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{name}")

    def start_migrate(self, run_id: str, table: str, segments: int) -> None:
        self.append(f"{run_id}/start", run_id=run_id, table=table, mode="migrate", event="start",
                    segments=segments, start_ts=dt.datetime.now(dt.timezone.utc))

    def start_live(self, run_id: str, table: str, stream_id: str, start: dt.datetime) -> None:
        self.append(f"{run_id}/start", run_id=run_id, table=table, mode="live", event="start",
                    start_ts=start, stream_id=stream_id, bootstrap_done=False)

    def segment_done(self, run_id: str, table: str, segment: int, counts: DataFrame) -> None:
        """``counts``: one row (processed, quarantined), computed by Spark from what was written."""
        row = counts.select(
            "processed", "quarantined",
            F.lit(run_id).alias("run_id"), F.lit(table).alias("table"),
            F.lit("migrate").alias("mode"), F.lit("segment").alias("event"),
            F.lit(segment).alias("segment"), F.lit(True).alias("completed"),
            F.current_timestamp().alias("updated"),
        )
        self.append_rows(f"{run_id}/segment={segment}", row)

    def batch_done(self, run_id: str, table: str, batch_id: int, counts: DataFrame) -> None:
        """Progress of a stream up to a batch: running counts and the highest change time.

        ``counts``: one row (processed, quarantined, high_water, and of ``SUMS`` what is known) of the batch. Two slots take
        turns, each computed from the other, so the ledger of a stream stays two rows and a
        replayed batch is counted once.
        """
        sums = list(SUMS)
        counts = counts.select("*", *[F.lit(None).cast("bigint").alias(c) for c in sums if c not in counts.columns])
        try:
            before = self.spark.read.schema(SCHEMA).parquet(f"{self.root}/{run_id}/slot={(batch_id + 1) % 2}")
            before = before.filter(F.col("batch_id") < batch_id).select(*sums, "high_water")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            before = counts.select(*sums, "high_water").limit(0)
        row = (
            counts.select(*sums, "high_water")
            .unionByName(before)
            .agg(*[F.sum(c).alias(c) for c in sums], F.max("high_water").alias("high_water"))
            .select(
                "*",
                F.lit(run_id).alias("run_id"), F.lit(table).alias("table"),
                F.lit("live").alias("mode"), F.lit("batch").alias("event"),
                F.lit(batch_id).cast("bigint").alias("batch_id"),
                F.current_timestamp().alias("updated"),
            )
        )
        self.append_rows(f"{run_id}/slot={batch_id % 2}", row)

    def published(self, run_id: str, table: str, mode: str, counts: DataFrame) -> None:
        """Result counts of a copy that has become visible: one row of ``EFFECTS``."""
        row = counts.select(
            *EFFECTS, F.lit(run_id).alias("run_id"), F.lit(table).alias("table"), F.lit(mode).alias("mode"),
            F.lit("published").alias("event"), F.current_timestamp().alias("updated"),
        )
        self.append_rows(f"{run_id}/published", row)

    def results(self, table: str) -> DataFrame:
        """Per run what its copy and its stream did to the table, and what the stream left out: ``DROPS`` and ``EFFECTS``."""
        rows = self.table(table).filter(F.col("event").isin("batch", "published"))
        newest = rows.groupBy("run_id", "event").agg(F.max_by(F.struct(*DROPS, *EFFECTS), F.coalesce("batch_id", F.lit(-1))).alias("n"))
        return newest.groupBy("run_id").agg(*[F.coalesce(F.sum(f"n.{c}"), F.lit(0)).alias(c) for c in (*DROPS, *EFFECTS)])

    def delete(self, table: str) -> None:
        """Forget a table's progress: later reads start after this row."""
        now = dt.datetime.now(dt.timezone.utc)
        self.append(f"deleted/{table}/{now:%Y%m%dT%H%M%S%f}", table=table, event="deleted",
                    run_id="")

    def current_run(self, table: str) -> dict | None:
        """The newest run of a table: its first row, plus what its other rows say.

        One row per run reaches the driver.
        """
        rows = self.table(table)
        runs = rows.filter("event != 'deleted'").groupBy("run_id").agg(
            F.max_by("mode", F.when(F.col("event") == "start", F.col("updated"))).alias("mode"),
            F.max("segments").alias("segments"),
            F.min("start_ts").alias("start_ts"),
            F.max_by("stream_id", F.when(F.col("stream_id").isNotNull(), F.col("updated"))).alias("stream_id"),
            F.max("bootstrap_done").alias("bootstrap_done"),
            F.max("high_water").alias("high_water"),
            F.sum(F.when(F.col("event") == "segment", F.col("processed"))).alias("processed"),
            F.min(F.when(F.col("event") == "start", F.col("updated"))).alias("started"),
        )
        deleted = rows.filter("event = 'deleted'").agg(F.max("updated")).collect()[0][0]
        if deleted is not None:
            runs = runs.filter(F.col("started") > F.lit(deleted))
        found = runs.orderBy(F.col("started").desc()).limit(1).collect()
        return found[0].asDict() if found else None

    def completed_segments(self, run_id: str) -> DataFrame:
        return (
            self.read()
            .filter((F.col("run_id") == run_id) & (F.col("event") == "segment") & F.col("completed"))
            .select("segment")
            .distinct()
        )

    def totals(self) -> DataFrame:
        """Rows processed per table and run: the sum over its segments."""
        return (
            self.read()
            .filter("event = 'segment'")
            .groupBy("table", "run_id")
            .agg(F.sum("processed").alias("processed"), F.count(F.lit(1)).alias("segments_done"))
        )

    def high_water(self, table: str) -> DataFrame:
        """Newest change time applied per table; it never moves back and ignores nulls."""
        return self.table(table).groupBy("table").agg(F.max("high_water").alias("high_water"))
