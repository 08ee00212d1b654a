"""Document table: copies and an append-only log of keyed operations over parquet, indexed by key buckets.

Layout below one root on shared storage::

    base/<name>/[segment=<n>/]status=<s>/bucket=<b>/...  rows of one full copy or compaction
    log/<run>/batch_id=<n>/status=<s>/bucket=<b>/...     rows of one micro-batch of a run
    versions/<entry>/...                                 one small row per commit

All rows have one schema (state columns plus quarantine columns) and are partitioned by
``status``, so that one pass over a source writes both good and rejected rows. Rows that are not laid out
by key lie in ``bucket=-1``.

The state is the latest operation per key. Targets accumulate: a copy adds to what is there, whoever wrote it.
Within a run operations apply in sequence order, whenever they arrive; of several runs the one that
wrote the key last counts: the higher epoch (how many commits its writer had seen), a log over a base, then the
later change time. A repeated batch replaces its own directory.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from itemflow.functions.keys import bucket_of
from itemflow.operators.convert import BAD, GOOD
from itemflow.operators.latest import RUN_STATE, STATE, comparable, effect_counts, fold_runs, latest_of_runs, latest_per_key, live, merge_latest
from itemflow.operators.route import DELETE, UPSERT
from itemflow.sinks.manifest import COMPACTION, COPY, DEFAULT_RUN, Manifest, commit, existing, remove, utc

ROW = (
    "key string, seq_key string, op string, approx_ts timestamp, doc variant, "
    "raw string, field string, reason string, run string, epoch bigint, from_log int, doc_hash bigint, status string"
)
COLUMNS = [c.split()[0] for c in ROW.split(", ")]
ANY_BUCKET = -1
#: Parquet keeps a Bloom filter of the keys of each row group, next to their range.
KEY_INDEX = {"parquet.bloom.filter.enabled#key": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def is_missing(error: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def said(error: Exception) -> str:
    """An error in one line, for the columns of reports."""
    return "not found" if is_missing(error) else (str(error).splitlines() or [type(error).__name__])[0]


def _up_to(batches: dict[str, int]) -> Column:
    """Rows of each run's batches up to one."""
    return reduce(lambda a, b: a | b, [(F.col("run") == run) & (F.col("batch_id") <= n) for run, n in batches.items()])


@dataclass(frozen=True)
class Snapshot:
    """One manifest, and so one consistent state of bases; what readers ask is answered from it."""

    table: DocTable
    manifest: Manifest

    def bases(self, buckets: list[int] | None = None) -> DataFrame | None:
        """Rows of all visible bases, rejected ones included, with ``bucket``."""
        found = []
        for entry, seen in self.manifest.visible_bases():
            wanted = [b for b in seen if buckets is None or b in buckets]
            rows = self.table._read(self.table.base_path(entry.base), ", bucket int") if wanted else None
            if rows is None:
                continue
            rows = self._placed(rows, None if len(wanted) == self.manifest.buckets else wanted)
            if entry.kind == COPY:
                rows = rows.withColumns({"run": F.lit(entry.runs[0]), "epoch": F.lit(entry.epoch).cast("bigint"), "from_log": F.lit(0)})
            found.append(rows)
        return reduce(DataFrame.unionByName, found) if found else None

    def logs(self, buckets: list[int] | None = None) -> DataFrame | None:
        """Rows of all batches that no base covers, with ``bucket`` and ``batch_id``."""
        found = []
        for run in self.manifest.runs():
            rows = self.table._read(f"{self.table.root}/log/{run}", ", batch_id bigint, bucket int")
            if rows is None:
                continue
            marks = self.manifest.log_marks(run)
            rows = self._placed(rows.filter(F.col("batch_id") > min(marks)), buckets)
            if len(set(marks)) > 1:
                rows = rows.filter(F.col("batch_id") > F.get(F.lit(marks), F.col("bucket")))
            found.append(rows.withColumns({"run": F.lit(run), "from_log": F.lit(1)}))
        return reduce(DataFrame.unionByName, found) if found else None

    def _placed(self, rows: DataFrame, buckets: list[int] | None) -> DataFrame:
        """Fill in the bucket of rows that are not laid out by it, and keep those of some buckets: whole directories and single rows."""
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin([ANY_BUCKET, *buckets]))
        rows = rows.withColumn("bucket", F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(bucket_of(F.col("key"), self.manifest.buckets)))
        return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))

    def one_run(self) -> bool:
        """Whether all rows come from one run and one copy, so that sequence numbers alone order them."""
        seen = [b for _, buckets in self.manifest.visible_bases() for b in buckets]
        if len(seen) > len(set(seen)):
            return False
        runs = {r for e, _ in self.manifest.visible_bases() for r in e.runs}
        return len(runs | {r for r in self.manifest.runs() if self.table._has_log(r)}) <= 1

    def unique_base(self) -> bool:
        """Whether no two rows of the visible bases share a key."""
        seen: set[int] = set()
        for entry, buckets in self.manifest.visible_bases():
            if not entry.one_row_per_key or seen & set(buckets):
                return False
            seen |= set(buckets)
        return bool(seen)

    def states(self) -> DataFrame:
        """Latest operation per key, tombstones included."""
        return self.latest(self.bases(), self.logs())

    def digests(self, keys: DataFrame, before: tuple[str, int] | None = None) -> DataFrame:
        """``(key, doc_hash)`` of the documents that some keys have: of each row its key, place and hash are read, nothing else.

        ``before`` leaves out a run's batches from one on. In a clustered table only the keys' buckets are read.
        """
        buckets = None
        if self.table.clustered:
            buckets = [r[0] for r in keys.select(bucket_of(F.col("key"), self.manifest.buckets)).distinct().collect()]
        base, log = self.bases(buckets), self.logs(buckets)
        if log is not None and before is not None:
            log = log.filter((F.col("run") != before[0]) | (F.col("batch_id") < before[1]))
        parts = [r if r is None else r.withColumn("doc", F.col("doc_hash").cast("variant")).join(keys, "key", "left_semi") for r in (base, log)]
        found = live(self.latest(*parts))
        return found.select("key", F.try_variant_get("doc", "$", "bigint").alias("doc_hash"))

    def latest(self, base: DataFrame | None, log: DataFrame | None, wanted: Column | None = None) -> DataFrame:
        """The same of some rows of the bases and the log; ``wanted`` may look at keys only."""

        def good(rows: DataFrame | None, columns: tuple[str, ...]) -> DataFrame:
            if rows is None:
                return self.table._empty().select(*columns)
            rows = rows.filter(F.col("status") == GOOD)
            return (rows if wanted is None else rows.filter(wanted)).select(*columns)

        if not self.one_run():
            return latest_of_runs(good(base, RUN_STATE).unionByName(good(log, RUN_STATE)))
        if self.unique_base():
            return merge_latest(good(base, STATE), good(log, STATE))
        return latest_per_key(good(base, STATE).unionByName(good(log, STATE)))


class DocTable:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, clustered: bool = False):
        """``clustered`` lays every batch out by key bucket, as compactions are, at the cost of a shuffle of the batch."""
        self.spark, self.root, self.buckets, self.clustered = spark, root.rstrip("/"), buckets, clustered

    # -- writing -------------------------------------------------------------------------

    def _rows(self, rows: DataFrame) -> DataFrame:
        have = set(rows.columns)
        filled = []
        for spec in ROW.split(", "):
            name, ddl = spec.split()
            if name not in have:
                default = {"op": UPSERT, "seq_key": "", "status": GOOD}.get(name)
                filled.append(F.lit(default).cast(ddl).alias(name))
            elif name == "key":
                # A document without a key is inserted under a fresh one, never replaced.
                filled.append(F.coalesce(F.col(name), F.concat(F.lit("u:"), F.uuid())).alias(name))
            else:
                filled.append(F.col(name))
        # Short enough to compare whole states by, without reading a document.
        return rows.select(*filled).withColumn("doc_hash", F.xxhash64(comparable(F.col("doc"))))

    def _write(self, rows: DataFrame, path: str, cluster: bool, buckets: int) -> None:
        """Replace the whole directory, whatever the session's overwrite mode.

        The rebalance hint lets Spark split a bucket that holds too many rows.
        """
        if cluster:
            rows = rows.withColumn("bucket", bucket_of(F.col("key"), buckets))
            rows = rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("status", "bucket", "key")
        else:
            rows = rows.withColumn("bucket", F.lit(ANY_BUCKET))
        writer: DataFrameWriter = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.options(**(KEY_INDEX if cluster else {})).partitionBy("status", "bucket").parquet(path)

    def base_path(self, name: str, segment: int | None = None) -> str:
        path = f"{self.root}/base/{name}"
        return path if segment is None else f"{path}/segment={segment}"

    def write_base(
        self, rows: DataFrame, name: str, segment: int | None = None, cluster: bool = False
    ) -> DataFrame:
        """Write document rows as (a segment of) a base; returns its row counts.

        ``cluster`` lays the rows out by key bucket and sorted by key, the table's index:
        a lookup reads one bucket and skips row groups by their key range and Bloom filter.
        """
        path = self.base_path(name, segment)
        self._write(self._rows(rows), path, cluster, self.manifest().buckets)
        return self.written_counts(path)

    def written_counts(self, path: str) -> DataFrame:
        """Counts of what a write left behind; exact whatever was retried."""
        written = self.spark.read.schema(ROW).parquet(path)
        return written.agg(
            F.count(F.lit(1)).alias("processed"),
            F.count_if(F.col("status") == BAD).alias("quarantined"),
        )

    def commit_version(
        self,
        base: str,
        run_id: str = DEFAULT_RUN,
        one_row_per_key: bool = False,
        cluster: bool = False,
    ) -> int:
        """Add a finished base to what readers see, and the log of ``run_id`` on top; returns the version."""
        commit(
            self.spark, self.root, self.manifest(), kind=COPY, base=base, runs=[run_id],
            one_row_per_key=one_row_per_key, clustered=cluster,
        )
        return self.version()["version"]

    def append_batch(self, ops: DataFrame, batch_id: int, run_id: str = DEFAULT_RUN) -> str:
        """Append one micro-batch; a replay overwrites its own directory. Unless the table is clustered nothing is shuffled."""
        path = f"{self.root}/log/{run_id}/batch_id={batch_id}"
        manifest = self.manifest()
        rows = self._rows(ops).withColumn("epoch", F.lit(manifest.epoch).cast("bigint"))
        self._write(rows, path, self.clustered, manifest.buckets)
        return path

    def batch_effects(self, batch_id: int, run_id: str = DEFAULT_RUN) -> DataFrame:
        """One row of result counts of a batch that has been appended: what it did to the table's documents, by key."""
        snapshot = self.snapshot()
        rows = self._read(f"{self.root}/log/{run_id}/batch_id={batch_id}").filter(F.col("status") == GOOD)
        keys = rows.select("key").distinct()
        return effect_counts(keys, snapshot.digests(keys, before=(run_id, batch_id)), snapshot.digests(keys))

    def copy_effects(self, base: str, before: Snapshot) -> DataFrame:
        """The same of a copy that has been made visible, against the table as it was."""
        keys = self._read(self.base_path(base)).filter(F.col("status") == GOOD).select("key").distinct()
        return effect_counts(keys, before.digests(keys), self.snapshot().digests(keys))

    def delete(
        self, keys: DataFrame, batch_id: int, seq_key: Column | str, run_id: str = DEFAULT_RUN
    ) -> str:
        """Tombstones for a column of keys."""
        tombstones = keys.select(
            "key",
            F.lit(DELETE).alias("op"),
            (F.lit(seq_key) if isinstance(seq_key, str) else seq_key).alias("seq_key"),
            F.lit(None).cast("variant").alias("doc"),
        )
        return self.append_batch(tombstones, batch_id, run_id)

    # -- reading -------------------------------------------------------------------------

    def _read(self, path: str, partitions: str = "") -> DataFrame | None:
        try:
            return self.spark.read.schema(ROW + partitions).parquet(path).select(*COLUMNS, *[p.split()[0] for p in partitions.split(", ") if p])
        except Exception as error:
            if is_missing(error):
                return None
            raise

    def _has_log(self, run: str) -> bool:
        return self._read(f"{self.root}/log/{run}") is not None

    def manifest(self) -> Manifest:
        return Manifest.read(self.spark, self.root, self.buckets)

    def snapshot(self) -> Snapshot:
        return Snapshot(self, self.manifest())

    def version(self) -> dict | None:
        """The newest commit: its number, base, runs, epoch and time."""
        entries = self.manifest().entries
        if not entries:
            return None
        newest = entries[-1]
        return {
            "version": len(entries) - 1, "base": newest.base, "runs": list(newest.runs), "epoch": newest.epoch,
            "one_row_per_key": newest.one_row_per_key, "buckets": newest.buckets, "committed_at": newest.committed_at,
        }

    def has_base(self, name: str) -> bool:
        return any(e.base == name for e in self.manifest().entries)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], ROW)

    def base(self) -> DataFrame:
        """All rows of the visible bases, rejected ones included."""
        found = self.snapshot().bases()
        return self._empty() if found is None else found

    def log(self) -> DataFrame:
        """All rows of batches the bases do not cover yet, with ``batch_id``."""
        found = self.snapshot().logs()
        return self._empty().withColumn("batch_id", F.lit(None).cast("bigint")) if found is None else found

    def states(self) -> DataFrame:
        """Latest operation per key, tombstones included."""
        return self.snapshot().states()

    def current(self) -> DataFrame:
        """The documents: ``(key, doc)``."""
        return live(self.states()).select("key", "doc")

    def count(self) -> DataFrame:
        """One row ``documents``; 0 for a table that does not exist yet."""
        return live(self.states()).agg(F.count(F.lit(1)).alias("documents"))

    def quarantine(self) -> DataFrame:
        return self._rejected(self.snapshot(), None).select("raw", "field", "reason")

    def _rejected(self, snapshot: Snapshot, buckets: list[int] | None) -> DataFrame:
        found = [rows.select(*COLUMNS) for rows in (snapshot.bases(buckets), snapshot.logs(buckets)) if rows is not None]
        return reduce(DataFrame.unionByName, found or [self._empty()]).filter(F.col("status") == BAD)

    def lookup(self, keys: list[str] | DataFrame) -> DataFrame:
        """Documents of some keys, given as a list or as a column ``key`` of any length.

        Only the buckets of the keys are read. The keys of a list are pushed to the scan, where row groups are skipped by
        their key range and Bloom filter; a column of keys is joined. At most one number for each bucket reaches the driver.
        """
        snapshot = self.snapshot()
        of = bucket_of(F.col("key"), snapshot.manifest.buckets)
        asked = self.spark.createDataFrame([(k,) for k in keys], "key string") if isinstance(keys, list) else keys.select("key")
        buckets = [r[0] for r in asked.select(of).distinct().collect()]
        base, log = snapshot.bases(buckets), snapshot.logs(buckets)
        if isinstance(keys, list):
            return live(snapshot.latest(base, log, F.col("key").isin(keys))).select("key", "doc")
        wanted = asked.where("key IS NOT NULL").distinct()
        base, log = [rows if rows is None else rows.join(wanted, "key", "left_semi") for rows in (base, log)]
        return live(snapshot.latest(base, log)).select("key", "doc")

    # -- maintenance ---------------------------------------------------------------------

    def _finished_batches(self, run: str) -> int:
        """The last batch of a run before any that is still being written; -1 for none."""
        def numbers(pattern: str, part: int) -> set[int]:
            return {int(p.split("/")[part].split("=")[1]) for p in existing(self.spark, f"{self.root}/log/{run}/{pattern}")}

        done, begun = numbers("batch_id=*/_SUCCESS", -2), numbers("batch_id=*", -1)
        first_open = min(begun - done, default=None)
        return max((n for n in done if first_open is None or n < first_open), default=-1)

    def _changed(self, snapshot: Snapshot, upto: dict[str, int]) -> list[int]:
        """Buckets that are not one compacted, unique base: with new bases, or rows of the log."""
        manifest = snapshot.manifest
        bases: dict[int, int] = dict.fromkeys(range(manifest.buckets), 0)
        changed = set()
        for entry, seen in manifest.visible_bases():
            for b in seen:
                bases[b] += 1
                if bases[b] > 1 or not (entry.clustered and entry.one_row_per_key):
                    changed.add(b)
        log = snapshot.logs()
        if log is not None:
            changed |= {r[0] for r in log.filter(_up_to(upto)).select("bucket").distinct().collect()}
        return sorted(changed)

    def compact(self, purge_before: dt.datetime | None = None, cluster: bool = True) -> int:
        """Fold bases and log into one row per key and run; returns the version.

        With ``cluster`` only buckets that changed are read and written; others keep their files. Tombstones stay,
        so that a late older record still loses, unless they are older than ``purge_before`` (the caller knows that
        no older record can arrive any more). Rejected rows are carried over. Batches still being written stay in the
        log. Compactions at once do no harm: each bucket takes the first.
        """
        snapshot = self.snapshot()
        manifest = snapshot.manifest
        upto = {run: self._finished_batches(run) for run in manifest.runs()}
        every = list(range(manifest.buckets))
        buckets = self._changed(snapshot, upto) if cluster and purge_before is None else every
        if not buckets:
            return len(manifest.entries) - 1
        log = snapshot.logs(buckets)
        if log is not None:
            log = log.filter(_up_to(upto))
        parts = [rows.select(*COLUMNS) for rows in (snapshot.bases(buckets), log) if rows is not None]
        rows = reduce(DataFrame.unionByName, parts or [self._empty()])
        one_run = snapshot.one_run()
        folded = fold_runs(rows.filter(F.col("status") == GOOD).select(*RUN_STATE), one_run, purge_before)
        rejected = rows.filter(F.col("status") == BAD)
        out = folded.withColumn("status", F.lit(GOOD)).unionByName(rejected, allowMissingColumns=True)
        last = manifest.state_of()
        name = f"compact-{manifest.epoch + 1}-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}"
        self._write(self._rows(out), self.base_path(name), cluster, manifest.buckets)
        commit(
            self.spark, self.root, manifest, kind=COMPACTION, base=name, runs=manifest.runs() if not one_run else self._only_run(snapshot),
            one_row_per_key=one_run, clustered=cluster,
            **{part: {b: last[b].entry if b in last else "" for b in of} for part, of in (("from", buckets), ("quiet", sorted(set(every) - set(buckets))))},
            folds={**{e.base: -1 for e in manifest.entries}, **{f"log:{r}": n for r, n in upto.items()}},
        )
        return len(manifest.entries)

    def _only_run(self, snapshot: Snapshot) -> list[str]:
        runs = {r for e, _ in snapshot.manifest.visible_bases() for r in e.runs}
        return sorted(runs | {r for r in snapshot.manifest.runs() if self._has_log(r)})[:1] or [DEFAULT_RUN]

    def vacuum(self, older_than: dt.datetime) -> int:
        """Delete what compactions from before ``older_than`` have replaced; returns how many directories went.

        Readers that opened the table before that time must have ended. Bases go bucket by bucket, batches when
        every bucket has folded them. Copies that were never finished stay, since they may still be under way.
        """
        manifest = self.manifest()
        last = manifest.state_of()
        aged = {b: e for b, e in last.items() if utc(e.committed_at) < older_than}
        gone: list[str] = []
        for e in manifest.entries:
            if e.kind == COMPACTION:
                hidden = [b for b in e.from_ if b in aged and aged[b].entry != e.entry and e.epoch <= aged[b].epoch]
                whole = len(hidden) == len(e.from_)
            else:
                hidden = [b for b, c in aged.items() if e.base in c.folds]
                whole = len(hidden) == manifest.buckets
            path = self.base_path(e.base)
            if whole:
                gone += existing(self.spark, path)
            else:
                for b in hidden:
                    gone += existing(self.spark, f"{path}/status=*/bucket={b}") + existing(self.spark, f"{path}/segment=*/status=*/bucket={b}")
        for run in manifest.runs():
            mark = min(manifest.log_marks(run, older_than))
            if mark >= 0:
                gone += [p for p in existing(self.spark, f"{self.root}/log/{run}/batch_id=*") if int(p.rsplit("=", 1)[1]) <= mark]
        return remove(self.spark, gone)
