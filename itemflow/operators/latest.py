"""Last writer per key, and what a batch of operations does to a state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemflow.operators.route import DELETE

STATE = ("key", "seq_key", "op", "approx_ts", "doc")
#: With the run that wrote a row, how many commits its writer had seen, and whether it is a change rather than a copy.
RUN_STATE = (*STATE, "run", "epoch", "from_log")
#: What is left of a run's newest change to a key that another run has written since: its place in the run's order.
SHADOW = "SHADOW"


def latest_per_key(ops: DataFrame) -> DataFrame:
    """The operation with the highest sequence per key, tombstones included.

    ``max_by`` combines on the map side, so a key that holds a third of all rows reaches
    the shuffle as one row per task.
    """
    payload = F.struct(*[c for c in STATE if c != "key"])
    winner = ops.groupBy("key").agg(F.max_by(payload, F.col("seq_key")).alias("w"))
    return winner.select("key", *[F.col(f"w.{c}").alias(c) for c in STATE if c != "key"])


def live(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("op").isin(DELETE, SHADOW))


def _latest_of_run(rows: DataFrame) -> DataFrame:
    payload = F.struct(*[c for c in RUN_STATE if c not in ("key", "run")])
    winner = rows.groupBy("key", "run").agg(F.max_by(payload, F.struct("seq_key", "epoch")).alias("w"))
    return winner.select(*[F.col(f"w.{c}").alias(c) if c not in ("key", "run") else F.col(c) for c in RUN_STATE])


def _written() -> Column:
    """When a run last wrote a key, to compare runs."""
    return F.struct("epoch", "from_log", "approx_ts", "run")


def latest_of_runs(rows: DataFrame) -> DataFrame:
    """The state of each key that several runs have written: of the newest operation of each run the one written last.

    Both steps combine on the map side.
    """
    payload = F.struct(*[c for c in STATE if c != "key"])
    winner = _latest_of_run(rows).groupBy("key").agg(F.max_by(payload, _written()).alias("w"))
    return winner.select("key", *[F.col(f"w.{c}").alias(c) for c in STATE if c != "key"])


def fold_runs(rows: DataFrame, one_run: bool, purge_before: dt.datetime | None = None) -> DataFrame:
    """Rows of ``RUN_STATE`` that give every later reader the same states as ``rows``: a compaction.

    One row for each key, and a shadow for each other run whose log wrote it, so that a late older record of that run
    still loses. Keys whose state is a tombstone older than ``purge_before`` go.
    """
    latest = _latest_of_run(rows)
    old = F.lit(False) if purge_before is None else F.coalesce((F.col("op") == DELETE) & (F.col("approx_ts") < F.lit(purge_before)), F.lit(False))
    if one_run:
        return latest.filter(~old)
    own = Window.partitionBy("key")
    ranked = latest.withColumn("_first", F.max(_written()).over(own) == _written())
    ranked = ranked.withColumn("_gone", F.max(F.col("_first") & old).over(own))
    kept = ranked.filter(~F.col("_gone") & (F.col("_first") | (F.col("from_log") == 1)))
    return kept.select(
        *[
            F.when(F.col("_first"), F.col("doc")).alias(c) if c == "doc"
            else F.when(F.col("_first"), F.col("op")).otherwise(SHADOW).alias(c) if c == "op"
            else F.col(c)
            for c in RUN_STATE
        ]
    )


def merge_latest(base: DataFrame, log: DataFrame) -> DataFrame:
    """Latest operation per key of a ``base`` with one row per key and a ``log`` of changes.

    The base is not shuffled when the log is small: both joins look up the reduced log,
    which Spark broadcasts if its measured size is under the broadcast threshold and
    shuffles otherwise. A log row that is older than the base row of its key loses.
    """
    changed = latest_per_key(log)
    marks = log.groupBy(F.col("key").alias("_key")).agg(F.max("seq_key").alias("_seq"))
    beaten = (
        base.select("key", "seq_key")
        .join(marks, (F.col("key") == F.col("_key")) & (F.col("seq_key") > F.col("_seq")), "left_semi")
        .select(F.col("key").alias("_key"))
    )
    newer = (F.col("key") == F.col("_key")) & (F.col("_seq") >= F.col("seq_key"))
    kept = base.select(*STATE).join(marks, newer, "left_anti")
    winners = changed.join(beaten, F.col("key") == F.col("_key"), "left_anti")
    return kept.unionByName(winners.select(*STATE))


def comparable(doc: Column) -> Column:
    """Text by which documents are compared; VARIANT itself has no order."""
    return F.to_json(doc)


EFFECTS = ("inserted", "upserted", "modified", "unchanged", "deleted", "not_found")


def effect_counts(keys: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """One row of result counts for the written ``keys``, from the hashes of their documents before and after.

    ``unchanged`` documents are as they were, ``not_found`` are keys without a document on both sides; documents
    without a key of their own (``u:``) are ``inserted``.
    """
    old = before.select("key", F.col("doc_hash").alias("_old"), F.lit(True).alias("_was"))
    new = after.select("key", F.col("doc_hash").alias("_new"), F.lit(True).alias("_is"))
    joined = keys.join(old, "key", "left").join(new, "key", "left")
    effect = (
        F.when(F.col("key").startswith("u:"), "inserted")
        .when(F.col("_is") & F.col("_was").isNull(), "upserted")
        .when(F.col("_is") & (F.col("_old") != F.col("_new")), "modified")
        .when(F.col("_is"), "unchanged")
        .when(F.col("_was"), "deleted")
        .otherwise("not_found")
    )
    return joined.select(effect.alias("effect")).agg(*[F.count_if(F.col("effect") == n).alias(n) for n in EFFECTS])


def write_counts(before: DataFrame, ops: DataFrame) -> DataFrame:
    """One row of result counts for ``ops`` applied to the live documents ``before``.

    Net effect per key: ``upserted`` are new keys, ``modified`` and ``unchanged`` replace a
    document, ``deleted`` remove one; documents without a key are ``inserted``.
    """
    keyless = F.col("key").isNull()
    net = latest_per_key(ops.filter(~keyless)).select(
        "key", "op", F.xxhash64(comparable(F.col("doc"))).alias("new_hash")
    )
    old = before.select(
        F.col("key").alias("_key"), F.xxhash64(comparable(F.col("doc"))).alias("old_hash")
    )
    joined = net.join(old, F.col("key") == F.col("_key"), "left")
    known, upsert = F.col("_key").isNotNull(), F.col("op") != DELETE
    effect = (
        F.when(upsert & ~known, "upserted")
        .when(upsert & (F.col("old_hash") != F.col("new_hash")), "modified")
        .when(upsert, "unchanged")
        .when(known, "deleted")
        .otherwise("not_found")
    )
    effects = joined.select(effect.alias("effect")).unionByName(
        ops.filter(keyless).select(F.lit("inserted").alias("effect"))
    )
    return effects.agg(*[F.count_if(F.col("effect") == n).alias(n) for n in EFFECTS])


def key_collisions(rows: DataFrame) -> DataFrame:
    """One row: documents, distinct keys, and documents that another one of their key replaces."""
    per_key = rows.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("documents"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("replaced"),
    )


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Documents that differ between two states: key, side and how many of them (``n``).

    Both sides count into one aggregation over key and digest: one shuffle of short rows,
    combined on the map side, and no document leaves its task.
    """

    def counted(rows: DataFrame, sign: int) -> DataFrame:
        digest = F.sha2(comparable(F.col("doc")), 256)
        return rows.select("key", digest.alias("digest"), F.lit(sign).alias("n"))

    net = counted(left, 1).unionByName(counted(right, -1)).groupBy("key", "digest").agg(
        F.sum("n").alias("n")
    )
    side = F.when(F.col("n") > 0, "left").otherwise("right")
    return net.filter(F.col("n") != 0).select("key", side.alias("side"), F.abs("n").alias("n"))
