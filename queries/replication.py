"""Queries over change records, tables, ledgers and jobs."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemflow.operators.convert import good
from itemflow.operators.latest import EFFECTS, latest_per_key, live, write_counts
from itemflow.operators.route import operation_counts, to_operations
from itemflow.plans.jobs import JobError, dry_run, migrate, migrate_all, open_pair, replicate, status
from itemflow.plans.ledger import Ledger
from itemflow.plans.pair import Mapping, Pair, RunSettings
from itemflow.session import work_folder
from itemflow.sinks.manifest import remove
from itemflow.sources.changes import changes_from, from_sequence, list_shards, parse_changes, seek_index, shard_order, since, since_counts, trimmed_records
from itemflow.streaming.live import change_operations, follow
from queries.batch import ORDERS, bad_dates, flat_orders
from queries.inputs import (
    START,
    change_lines,
    document_table,
    event_changes,
    field,
    lines_of,
    order_columns,
    order_lines,
    staged,
    table,
)

USERS = Mapping(key_source="userId", naming="snake_case")
START_TIME = dt.datetime.fromisoformat(START).replace(tzinfo=dt.timezone.utc)
STOP_WHEN_READ = {"availableNow": True}


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_changes(event_changes(spark, sf_dir), old_images=False)


def third_of_operations(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Operations whose sequence number leaves ``n`` when divided by 3, chosen before they are converted: three thirds cost one pass."""
    events = table(spark, sf_dir, "events").filter((F.col("event_id") >= 0) & (F.col("event_id") % 3 == n))
    return change_operations(change_lines(events), USERS)


def user_state(docs: DataFrame) -> DataFrame:
    return docs.select(
        field("_id", "bigint").alias("user_id"),
        field("event_id", "bigint").alias("event_id"),
        field("event_type", "string").alias("event_type"),
        field("value", "double").alias("value"),
        field("props", "string").alias("props"),
    )


def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records with all their metadata and the width of their images."""
    return records(spark, sf_dir).select(
        F.col("seq").cast("bigint").alias("event_id"), "event_name", "aws_region", "shard_id", "size_bytes",
        "view_type", F.unix_micros("approx_ts").alias("ts_us"),
        F.size("keys").cast("bigint").alias("keys"),
        F.when(F.col("new_image").isNotNull(), F.size("new_image")).cast("bigint").alias("fields"),
    )


def time_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = since(records(spark, sf_dir), START_TIME)
    return kept.select(F.col("seq").cast("bigint").alias("event_id"), "event_name")


def time_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth record has no time: it is dropped, but counted."""
    seq = F.regexp_extract("raw", '"SequenceNumber":"([0-9]+)"', 1).cast("bigint")
    untimed = F.when(seq % 9 == 0, F.replace("raw", F.lit("ApproximateCreationDateTime"), F.lit("Unknown")))
    lines = event_changes(spark, sf_dir).select(F.coalesce(untimed, F.col("raw")).alias("raw"))
    return since_counts(parse_changes(lines, old_images=False), START_TIME)


def sequence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = from_sequence(records(spark, sf_dir), "777")
    return kept.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("records"), F.min(F.col("seq").cast("bigint")).alias("first_seq")
    )


def event_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operation_counts(records(spark, sf_dir))


def strict_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without image or keys and of unknown kind, sent to the quarantine."""
    raw = event_changes(spark, sf_dir)
    seq = F.regexp_extract("raw", '"SequenceNumber":"([0-9]+)"', 1).cast("bigint")
    damaged = (
        F.when(seq % 5 == 0, F.replace(F.replace("raw", F.lit('"NewImage"'), F.lit('"Gone"')), F.lit('"Keys"'), F.lit('"Lost"')))
        .when(seq % 7 == 0, F.regexp_replace("raw", '"eventName":"[A-Z]+"', '"eventName":"OTHER"'))
        .otherwise(F.col("raw"))
    )
    ops = to_operations(parse_changes(raw.select(damaged.alias("raw")), old_images=False), USERS, strict=True)
    return ops.groupBy("op", "status", "reason").agg(F.count(F.lit(1)).alias("records"))


def delete_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = to_operations(records(spark, sf_dir), USERS)
    return ops.filter(F.col("op") == "DELETE").groupBy("key").agg(F.count(F.lit(1)).alias("deletes"))


def apply_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = good(change_operations(event_changes(spark, sf_dir), USERS))
    return user_state(live(latest_per_key(ops)))


def poison_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh record without a sequence number, every thirteenth with a time beyond all calendars."""
    seq = F.regexp_extract("raw", '"SequenceNumber":"([0-9]+)"', 1).cast("bigint")
    late = F.regexp_replace("raw", '"ApproximateCreationDateTime":[0-9.E]+', '"ApproximateCreationDateTime":1e30')
    damaged = (
        F.when(seq % 11 == 0, F.replace("raw", F.lit('"SequenceNumber"'), F.lit('"Unknown"')))
        .when(seq % 13 == 0, late)
        .otherwise(F.col("raw"))
    )
    raw = event_changes(spark, sf_dir).select(damaged.alias("raw"))
    ops = to_operations(parse_changes(raw, old_images=False), USERS)
    return ops.groupBy("op", "status", "reason").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("approx_ts").isNull()).alias("untimed")
    )


def unmapped_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest document of each user, known by the records' own keys alone."""
    ops = good(to_operations(records(spark, sf_dir), Mapping(naming="snake_case")))
    return live(latest_per_key(ops)).select(
        "key", field("user_id", "bigint").alias("user_id"), field("event_id", "bigint").alias("event_id"),
        field("event_type", "string").alias("event_type"), field("value", "double").alias("value"),
    )


def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).groupBy("shard_id").agg(F.unix_micros(F.max("approx_ts")).alias("high_water_us"))


def shard_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_shards(records(spark, sf_dir))


def bulk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the changes after the start time do to the state before it."""
    events = table(spark, sf_dir, "events")
    early = events.filter(F.col("ts") < F.lit(START).cast("timestamp_ntz"))
    late = events.filter(F.col("ts") >= F.lit(START).cast("timestamp_ntz"))
    before = live(latest_per_key(good(change_operations(change_lines(early), USERS))))
    return write_counts(before, good(change_operations(change_lines(late), USERS)))


def order_pair(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame | None = None) -> Pair:
    source = staged(spark, lines if lines is not None else order_lines(spark, sf_dir), f"{name}-items", 16)
    return Pair(
        name=name, source=source, target_root=work_folder(spark, name), collection="customerOrders",
        mapping=Mapping(
            key_source="orderKey", naming="snake_case", transforms=ORDERS.transforms,
            collection_naming="snake_case",
        ),
        settings={"segments": 4},
    )


def migrate_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole copy: export files, segments, table, current view."""
    pair = order_pair(spark, sf_dir, "migrate")
    migrate(spark, pair)
    return flat_orders(open_pair(spark, pair, RunSettings())[0].current())


def resume_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy that stopped after some segments is resumed: all rows, each once."""
    from itemflow.plans.jobs import documents

    pair = order_pair(spark, sf_dir, "resume")
    target, ledger = open_pair(spark, pair, RunSettings())
    ledger.start_migrate("stopped", pair.name, 4)
    for segment in (0, 2):
        rows = documents(spark, pair, 4, segment)
        ledger.segment_done("stopped", pair.name, segment, target.write_base(rows, "stopped", segment))
    migrate(spark, pair, resume=True)
    return flat_orders(good(target.base()))


def scan_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress rows of a segmented copy, summed."""
    pair = order_pair(spark, sf_dir, "segments")
    migrate(spark, pair)
    return open_pair(spark, pair, RunSettings())[1].totals().select("table", "processed", "segments_done")


def pair_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = order_pair(spark, sf_dir, "status", bad_dates(spark, sf_dir))
    migrate(spark, pair)
    return status(spark, [pair]).select(
        "pair", "mode", "processed", "quarantined", "items", "documents", "percent", "stream_enabled"
    )


def many_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pairs at once, one without a source: the others are copied, and all failures are told together."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("orderKey"), F.col("c_name").alias("name"))
    pairs = [order_pair(spark, sf_dir, "orders"), order_pair(spark, sf_dir, "customers", lines_of(customers))]
    pairs.append(replace(pairs[0], name="lost", source=work_folder(spark, "nowhere"), target_root=work_folder(spark, "lost")))
    failed: list[str] = []
    try:
        migrate_all(spark, pairs, settings=RunSettings(max_concurrent_pairs=3))
    except JobError as error:
        failed = list(error.errors)
    rows = status(spark, pairs).select("pair", "processed", "documents", "source_error")
    return rows.withColumn("failed", F.col("pair").isin(failed))


def dry_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dry_run(spark, [order_pair(spark, sf_dir, "dry", bad_dates(spark, sf_dir))])


def table_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = order_pair(spark, sf_dir, "rejects", bad_dates(spark, sf_dir))
    migrate(spark, pair)
    target = open_pair(spark, pair, RunSettings())[0]
    return target.quarantine().groupBy("field", "reason").agg(F.count("raw").alias("records"))


def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late batches arrive first; the log is folded into a base between two of them."""
    target = document_table(spark, "compacted")
    target.append_batch(third_of_operations(spark, sf_dir, 2), 0)
    target.append_batch(third_of_operations(spark, sf_dir, 0), 1)
    target.compact()
    target.append_batch(third_of_operations(spark, sf_dir, 1), 2)
    return user_state(target.current())


def two_pairs_one_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second pair copies into the same collection: its orders replace those of their keys, the others stay."""
    first = order_pair(spark, sf_dir, "accumulated")
    migrate(spark, first)
    poor = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("custKey"), F.col("c_mktsegment").alias("segment"))
    changed = order_columns(spark, sf_dir).join(poor, "custKey").withColumn("orderStatus", F.col("segment")).drop("segment")
    source = staged(spark, lines_of(changed), "more-items", 4)
    migrate(spark, replace(first, name="more", source=source))
    return flat_orders(open_pair(spark, first, RunSettings())[0].current())


def migrate_after_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes are followed, then a copy of customers as users goes on top; the table is folded in between."""
    pair = Pair(
        name="users", source=staged(spark, lines_of(spark.createDataFrame([], "userId bigint")), "no-items"),
        target_root=work_folder(spark, "users"), collection="users", mapping=USERS,
        changes=staged(spark, event_changes(spark, sf_dir), "users-changes", 4),
    )
    replicate(spark, pair, trigger=STOP_WHEN_READ, start=dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)).awaitTermination()
    target = open_pair(spark, pair, RunSettings())[0]
    target.compact()
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("userId"), F.lit("restored").alias("eventType"), F.col("c_acctbal").alias("value"), F.col("c_name").alias("props")
    )
    migrate(spark, replace(pair, name="customers", source=staged(spark, lines_of(customers), "customer-items", 4)))
    return user_state(target.current())


def table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of all customers' numbers, looked up in a table of users whose log is folded by bucket twice."""
    target = document_table(spark, "looked-up")
    for batch, n in enumerate((2, 0, 1)):
        target.append_batch(third_of_operations(spark, sf_dir, n), batch)
        if batch < 2:
            target.compact()
    keys = table(spark, sf_dir, "customer").select(F.concat(F.lit("n:"), F.col("c_custkey").cast("string")).alias("key"))
    return user_state(target.lookup(keys))


def stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over files that arrive out of order, stopped and restarted on the way."""
    events = table(spark, sf_dir, "events")
    folder = work_folder(spark, "changes")
    target, ledger = document_table(spark, "streamed"), Ledger(spark, work_folder(spark, "ledger"))
    for arrivals in ((2, 0), (1,)):
        for n in arrivals:
            change_lines(events.filter(F.col("event_id") % 3 == n)).write.text(f"{folder}/part={n}")
        query = follow(spark, folder, target, ledger, USERS, "main", "users", None, STOP_WHEN_READ, max_files=8)
        query.awaitTermination()
    return user_state(target.current())


def live_drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream leaves out, told by its ledger: every ninth record has no time, every seventh is of an unknown kind."""
    raw = event_changes(spark, sf_dir)
    seq = F.regexp_extract("raw", '"SequenceNumber":"([0-9]+)"', 1).cast("bigint")
    damaged = (
        F.when(seq % 9 == 0, F.replace("raw", F.lit("ApproximateCreationDateTime"), F.lit("Unknown")))
        .when(seq % 7 == 0, F.regexp_replace("raw", '"eventName":"[A-Z]+"', '"eventName":"OTHER"'))
        .otherwise(F.col("raw"))
    )
    folder = staged(spark, raw.select(damaged.alias("raw")), "dropping-changes", 6)
    target, ledger = document_table(spark, "dropping"), Ledger(spark, work_folder(spark, "ledger"))
    follow(spark, folder, target, ledger, USERS, "main", "users", START_TIME, STOP_WHEN_READ, max_files=2).awaitTermination()
    return ledger.results("users").select("read", "older", "untimed", "skipped")


def replicate_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest change of each user, from four start positions of one indexed log."""
    events = table(spark, sf_dir, "events").repartitionByRange(8, "event_id")
    folder = work_folder(spark, "sought")
    change_lines(events).write.text(folder)
    index = seek_index(spark, folder)
    parts = {
        "at": changes_from(spark, index, at="777"), "after": changes_from(spark, index, after="777"),
        "time": changes_from(spark, index, start=START_TIME), "newest": changes_from(spark, index, newest=True),
    }
    found = None
    for name, changes in parts.items():
        state = latest_per_key(good(to_operations(changes, USERS)))
        one = state.select(F.lit(name).alias("position"), F.col("seq_key").cast("bigint").alias("event_id"), "op")
        found = one if found is None else found.unionByName(one)
    return found


def trimmed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of an indexed log is taken away before it is read: which shards lack how many records, and from where to where."""
    events = table(spark, sf_dir, "events")
    folder = work_folder(spark, "trimmed")
    for n in range(4):
        change_lines(events.filter(F.col("event_id") % 4 == n)).write.text(f"{folder}/part={n}")
    index = work_folder(spark, "seek-index")
    seek_index(spark, folder).write.parquet(index)
    remove(spark, [f"{folder}/part=2"])
    lost = trimmed_records(spark, folder, spark.read.parquet(index))
    ends = [F.col(c).cast("bigint").alias(c.replace("_key", "")) for c in ("first_seq_key", "last_seq_key")]
    return lost.select("shard_id", "records", *ends, (F.col("files") > 0).alias("files_gone"))


def shard_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as shards: each is split from the one of half its number, and every third is merged from two."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("u")).distinct()
    half = users.select(F.concat(F.lit("s"), F.col("u")).alias("shard_id"), F.when(F.col("u") > 1, F.concat(F.lit("s"), F.expr("u DIV 2"))).alias("parent_id"))
    merged = users.filter("u % 3 = 0").select(F.concat(F.lit("s"), F.col("u")).alias("shard_id"), F.concat(F.lit("s"), F.expr("u DIV 3")).alias("parent_id"))
    return shard_order(half.unionByName(merged))


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a batch of a stream does to the documents that earlier batches left, told by its ledger."""
    events = table(spark, sf_dir, "events")
    folder = work_folder(spark, "changes")
    target, ledger = document_table(spark, "counted"), Ledger(spark, work_folder(spark, "ledger"))
    for late in (False, True):
        part = events.filter((F.col("ts") >= F.lit(START).cast("timestamp_ntz")) == F.lit(late))
        change_lines(part).write.text(f"{folder}/late={late}")
        follow(
            spark, folder, target, ledger, USERS, "main", "users", None, STOP_WHEN_READ, max_files=1000, result_counts=late
        ).awaitTermination()
        target.compact()
    return ledger.results("users").select(*EFFECTS)


def live_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy the state at the start time, then follow the log from there."""
    events = table(spark, sf_dir, "events")
    before = events.filter(F.col("ts") < F.lit(START).cast("timestamp_ntz"))
    last = before.groupBy("user_id").agg(F.max_by(F.struct(*before.columns), F.col("event_id")).alias("e"))
    items = last.select("e.*").filter(F.col("event_type") != "error").select(
        F.col("user_id").alias("userId"), F.col("event_id").alias("eventId"),
        F.col("event_type").alias("eventType"), "value", "props",
    )
    pair = Pair(
        name="users", source=staged(spark, lines_of(items), "users-items"),
        target_root=work_folder(spark, "users"), collection="users", mapping=USERS,
        changes=staged(spark, event_changes(spark, sf_dir), "users-changes", 4),
    )
    replicate(spark, pair, trigger=STOP_WHEN_READ, start=START_TIME).awaitTermination()
    return user_state(open_pair(spark, pair, RunSettings())[0].current())


QUERIES = {
    "change_records": change_records,
    "time_filter": time_filter,
    "time_filter_counts": time_filter_counts,
    "sequence_filter": sequence_filter,
    "event_route": event_route,
    "strict_route": strict_route,
    "delete_keys": delete_keys,
    "apply_latest": apply_latest,
    "poison_changes": poison_changes,
    "unmapped_apply": unmapped_apply,
    "high_water": high_water,
    "shard_list": shard_list,
    "bulk_counts": bulk_counts,
    "migrate_job": migrate_job,
    "resume_segments": resume_segments,
    "scan_segments": scan_segments,
    "pair_status": pair_status,
    "many_pairs": many_pairs,
    "dry_run": dry_run_report,
    "table_quarantine": table_quarantine,
    "compacted_table": compacted_table,
    "two_pairs_one_target": two_pairs_one_target,
    "migrate_after_live": migrate_after_live,
    "table_lookup": table_lookup,
    "stream_apply": stream_apply,
    "live_bootstrap": live_bootstrap,
    "live_drop_counts": live_drop_counts,
    "stream_counts": stream_counts,
    "replicate_from": replicate_from,
    "shard_lineage": shard_lineage,
    "trimmed_log": trimmed_log,
}
