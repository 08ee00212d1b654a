"""Change records: JSON lines with an event name, sequence number, keys and images."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemflow.functions.expr import once
from itemflow.functions.keys import sequence_key
from itemflow.functions.wire import DEFAULT_DEPTH, av_map_type
from itemflow.session import work_folder


# The years 1 to 9999. A time outside is none.
FIRST_MICROS, LAST_MICROS = -62135596800000000, 253402300799999999


def change_type(depth: int = DEFAULT_DEPTH, old_images: bool = True) -> str:
    """DDL of one change record line. Keys are scalars and need no depth."""
    image = av_map_type(depth)
    old = f"OldImage: {image}, " if old_images else ""
    return (
        "struct<eventName: string, eventSource: string, awsRegion: string, shardId: string, "
        "dynamodb: struct<ApproximateCreationDateTime: double, "
        f"Keys: {av_map_type(0)}, NewImage: {image}, {old}"
        "SequenceNumber: string, SizeBytes: bigint, StreamViewType: string>>"
    )


def read_change_lines(
    spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """Raw change lines as ``raw``, in batch or as a stream.

    A stream skips files trimmed from the directory before they were read, as a trimmed log is.
    In batch a file that vanishes after the listing ends the job: its records would be missing.
    """
    options = {"recursiveFileLookup": "true"}
    if streaming:
        options["ignoreMissingFiles"] = "true"
        if max_files:
            options["maxFilesPerTrigger"] = str(max_files)
        reader = spark.readStream.format("text").options(**options)
    else:
        reader = spark.read.format("text").options(**options)
    return reader.load(path).select(F.col("value").alias("raw"))


def parse_changes(
    lines: DataFrame, depth: int = DEFAULT_DEPTH, old_images: bool = True
) -> DataFrame:
    """Flat change records next to ``raw``; ``seq_key`` orders them within a key.

    A time that is no number or outside the calendar is NULL, a sequence number that is not all digits has no ``seq_key``.

    Without ``old_images`` the JSON reader skips them; replication does not use them.
    """
    record_type = change_type(depth, old_images)
    record = lines.withColumn("_record", once(F.from_json("raw", record_type)))
    data = F.col("_record.dynamodb")
    micros = F.round(data["ApproximateCreationDateTime"] * 1000000).try_cast("bigint")
    columns = {
        "event_name": F.col("_record.eventName"),
        "event_source": F.col("_record.eventSource"),
        "aws_region": F.col("_record.awsRegion"),
        "shard_id": F.col("_record.shardId"),
        "approx_ts": F.when(micros.between(FIRST_MICROS, LAST_MICROS), F.timestamp_micros(micros)),
        "seq": data["SequenceNumber"],
        "seq_key": sequence_key(data["SequenceNumber"]),
        "size_bytes": data["SizeBytes"],
        "view_type": data["StreamViewType"],
        "keys": data["Keys"],
        "new_image": data["NewImage"],
    }
    if old_images:
        columns["old_image"] = data["OldImage"]
    return record.select(*lines.columns, *[c.alias(name) for name, c in columns.items()])


def since(
    changes: DataFrame, start: dt.datetime | Column | None, keep_malformed: bool = False
) -> DataFrame:
    """Records created at or after ``start``, compared in milliseconds.

    Records without a time go once there is a start; without a start all stay.
    ``keep_malformed`` keeps lines that are no records at all, for the quarantine.
    """
    if start is None:
        return changes
    bound = start if isinstance(start, Column) else F.lit(start).cast("timestamp")
    recent = F.unix_millis("approx_ts") >= F.unix_millis(bound)
    return changes.filter(recent | F.col("event_name").isNull() if keep_malformed else recent)


def since_counts(changes: DataFrame, start: dt.datetime) -> DataFrame:
    """One row: records that ``since`` keeps, drops as older, and drops for want of a time."""
    bound = F.unix_millis(F.lit(start).cast("timestamp"))
    at = F.unix_millis("approx_ts")
    return changes.agg(
        F.count_if(at >= bound).alias("kept"),
        F.count_if(at < bound).alias("older"),
        F.count_if(at.isNull()).alias("untimed"),
    )


def from_sequence(changes: DataFrame, sequence: str, after: bool = False) -> DataFrame:
    """Start at (or just after) a sequence number."""
    bound = sequence_key(F.lit(sequence))
    return changes.filter(F.col("seq_key") > bound if after else F.col("seq_key") >= bound)


def seek_index(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """First and last sequence and time that each file of a change log has of each shard:
    ``(file, shard_id, first_seq_key, last_seq_key, first_ts, last_ts, records)``.

    Files of a ``known`` index are not read again. A log only gains files, so an index that was written down stays right.
    """
    lines = spark.read.format("text").option("recursiveFileLookup", "true").load(path)
    lines = lines.select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"))
    if known is not None:
        lines = lines.join(known.select("file").distinct(), "file", "left_anti")
    found = parse_changes(lines, 0, old_images=False).groupBy("file", "shard_id").agg(
        F.min("seq_key").alias("first_seq_key"), F.max("seq_key").alias("last_seq_key"),
        F.min("approx_ts").alias("first_ts"), F.max("approx_ts").alias("last_ts"), F.count(F.lit(1)).alias("records"),
    )
    return found if known is None else known.select(*found.columns).unionByName(found)


def changes_from(
    spark: SparkSession, index: DataFrame, *, at: str | None = None, after: str | None = None, start: dt.datetime | None = None,
    newest: bool = False, depth: int = DEFAULT_DEPTH,
) -> DataFrame:
    """Parsed changes of a log from a position on: a sequence number, the one behind it, a time, or the newest record's.

    Files that end before the position are not opened. Paths of the others reach the driver, as those of any scan do.
    """
    if newest:
        last = index.agg(F.max("last_seq_key")).collect()[0][0]
        bound, strict = F.lit(last), True
    else:
        bound, strict = sequence_key(F.lit(at if after is None else after)), after is not None
    late = F.lit(True)
    if newest or at is not None or after is not None:
        late = F.col("last_seq_key") > bound if strict else F.col("last_seq_key") >= bound
    if start is not None:
        late = late & (F.unix_millis("last_ts") >= F.unix_millis(F.lit(start).cast("timestamp")))
    files = [r[0] for r in index.filter(late).select("file").distinct().collect()]
    lines = spark.read.format("text").load(files) if files else spark.createDataFrame([], "value string")
    changes = since(parse_changes(lines.select(F.col("value").alias("raw")), depth, old_images=False), start)
    if newest or at is not None or after is not None:
        changes = changes.filter(F.col("seq_key") > bound if strict else F.col("seq_key") >= bound)
    return changes


def trimmed_records(spark: SparkSession, path: str, index: DataFrame, applied: str | None = None) -> DataFrame:
    """What a log has lost before it was read: ``(shard_id, files, records, first_seq_key, last_seq_key)`` of files that are gone.

    ``index`` is what the log once held; files all of whose records of a shard lie at or before the sequence number
    ``applied`` were read in time. Files are listed, none is opened.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"))
    gone = index.join(listed, "file", "left_anti")
    if applied is not None:
        gone = gone.filter(F.coalesce(F.col("last_seq_key") > sequence_key(F.lit(applied)), F.lit(True)))
    return gone.groupBy("shard_id").agg(
        F.count_distinct("file").alias("files"), F.sum("records").alias("records"),
        F.min("first_seq_key").alias("first_seq_key"), F.max("last_seq_key").alias("last_seq_key"),
    )


def shard_order(shards: DataFrame) -> DataFrame:
    """``(shard_id, generation)`` of rows ``(shard_id, parent_id)``: parents before their children, by iterative joins.

    A shard that was merged has a row for each parent. Parents that are no shards themselves, trimmed long ago, count as none.
    A shard's generation is one more than its latest parent's; shards in a circle have none and are left out.
    """
    spark = shards.sparkSession
    known = shards.select("shard_id").distinct()
    edges = shards.join(known.select(F.col("shard_id").alias("parent_id")), "parent_id", "left_semi").select("shard_id", "parent_id").distinct()
    left, placed, generation = edges, known.join(edges, "shard_id", "left_anti").withColumn("generation", F.lit(0).cast("bigint")), 0
    path = work_folder(spark, "shards")
    while True:
        placed.write.mode("overwrite").parquet(f"{path}/generation={generation}")
        done = spark.read.schema("shard_id string").parquet(f"{path}/generation={generation}")
        if done.isEmpty():
            break
        # a child is next when no edge to an unplaced parent is left
        rest = left.join(done.select(F.col("shard_id").alias("parent_id")), "parent_id", "left_anti")
        rest.write.mode("overwrite").parquet(f"{path}-edges/{generation}")
        rest = spark.read.schema("shard_id string, parent_id string").parquet(f"{path}-edges/{generation}")
        generation += 1
        placed = left.select("shard_id").distinct().join(rest.select("shard_id").distinct(), "shard_id", "left_anti")
        left = rest
    return spark.read.schema("shard_id string, generation bigint").parquet(path).select("shard_id", "generation")


def list_shards(changes: DataFrame) -> DataFrame:
    """Shards with first and last sequence number, in order of their first; unknown ones last."""
    shards = changes.groupBy("shard_id").agg(
        F.min("seq_key").alias("start_seq_key"),
        F.max("seq_key").alias("end_seq_key"),
        F.count(F.lit(1)).alias("records"),
    )
    return shards.filter(F.col("shard_id").isNotNull()).orderBy(F.col("start_seq_key").asc_nulls_last())
