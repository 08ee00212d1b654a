"""The jobs a user runs: migrate, replicate, dry run, status, and all of them over many pairs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from itemflow.operators.convert import GOOD, to_documents
from itemflow.plans.ledger import Ledger
from itemflow.plans.pair import Pair, RunSettings, check_pairs, select_pairs
from itemflow.plans.report import pair_status
from itemflow.sinks.table import DocTable, said
from itemflow.sources.items import scan_items
from itemflow.streaming.live import follow


class JobError(RuntimeError):
    """All failures of a run over segments or pairs, by name."""

    def __init__(self, what: str, errors: dict[str, Exception]):
        self.errors = errors
        shown = "; ".join(f"{name}: {error}" for name, error in errors.items())
        super().__init__(f"{what} failed with {len(errors)} errors: {shown}")


def open_pair(spark: SparkSession, pair: Pair, settings: RunSettings) -> tuple[DocTable, Ledger]:
    return DocTable(spark, pair.target, settings.buckets, pair.mapping.cluster), Ledger(spark, f"{pair.target}/_ledger")


def new_run_id(mode: str) -> str:
    return f"{mode}-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def _settings(pair: Pair, settings: RunSettings | None) -> RunSettings:
    return (settings or RunSettings()).override(pair.settings)


def _run_all(
    spark: SparkSession, tasks: dict[str, Callable[[], object]], workers: int
) -> tuple[dict[str, object], dict[str, Exception]]:
    """Submit Spark jobs from a few driver threads; one failure does not stop the others."""
    results: dict[str, object] = {}
    errors: dict[str, Exception] = {}
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        in_session = inheritable_thread_target(spark)
        futures = {name: pool.submit(in_session(task)) for name, task in tasks.items()}
        for name, future in futures.items():
            try:
                results[name] = future.result()
            except Exception as error:
                errors[name] = error
    return results, errors


def _in_pool(spark: SparkSession, name: str, task: Callable[[], object]) -> Callable[[], object]:
    """Jobs of a pair in a scheduler pool of its own: under ``spark.scheduler.mode=FAIR`` a large pair does not hold up small ones."""

    def run() -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return task()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    return run


def documents(
    spark: SparkSession, pair: Pair, segments: int | None = None, segment: int | None = None
) -> DataFrame:
    """Document rows of a pair's source: the plan behind migrate, bootstrap and dry run.

    The segment is chosen at the scan, where it prunes files.
    """
    items = scan_items(spark, pair.source, pair.scan, pair.mapping.depth, segments, segment)
    return to_documents(items, pair.mapping)


def _publish(table: DocTable, pair: Pair, run_id: str, ledger: Ledger, mode: str, size: RunSettings) -> None:
    before = table.snapshot()
    table.commit_version(
        run_id, run_id, one_row_per_key=pair.mapping.unique_keys, cluster=pair.mapping.cluster
    )
    if size.result_counts:
        ledger.published(run_id, pair.name, mode, table.copy_effects(run_id, before))


def migrate(
    spark: SparkSession,
    pair: Pair,
    resume: bool = False,
    settings: RunSettings | None = None,
) -> str:
    """Copy a source once; returns the run id.

    The source is cut into segments of whole files. Each is its own Spark job that
    overwrites its own directory, and gets a ledger row after its commit; ``resume``
    continues the last unfinished copy and skips the segments that have one. The copy becomes
    visible when the last segment is done, on top of what the target holds already: documents of
    its keys are replaced, all others stay.
    """
    size = _settings(pair, settings)
    table, ledger = open_pair(spark, pair, size)
    run = ledger.current_run(pair.name) if resume else None
    if run is not None and run["mode"] != "migrate":
        run = None
    if run is None:
        run_id, segments = new_run_id("migrate"), size.segments
        ledger.start_migrate(run_id, pair.name, segments)
    else:
        run_id, segments = run["run_id"], run["segments"] or 1
    done = {row["segment"] for row in ledger.completed_segments(run_id).collect()}

    def copy(segment: int) -> Callable[[], None]:
        def job() -> None:
            rows = documents(spark, pair, segments, segment)
            counts = table.write_base(rows, run_id, segment, pair.mapping.cluster)
            ledger.segment_done(run_id, pair.name, segment, counts)

        return job

    todo = {f"segment {s}": copy(s) for s in range(segments) if s not in done}
    _, errors = _run_all(spark, todo, size.parallel_readers)
    if errors:
        raise JobError("migration", errors)
    if not table.has_base(run_id):
        _publish(table, pair, run_id, ledger, "migrate", size)
    return run_id


def bootstrap(spark: SparkSession, pair: Pair, run_id: str, settings: RunSettings | None = None) -> None:
    """One full copy without progress rows, made visible when complete."""
    size = _settings(pair, settings)
    table, ledger = open_pair(spark, pair, size)
    table.write_base(documents(spark, pair), run_id, cluster=pair.mapping.cluster)
    if not table.has_base(run_id):
        _publish(table, pair, run_id, ledger, "live", size)


def replicate(
    spark: SparkSession,
    pair: Pair,
    trigger: dict | None = None,
    settings: RunSettings | None = None,
    start: dt.datetime | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Copy a source, then follow its change log. Always resumes.

    The start time is fixed before the copy, so that changes made during it are replayed
    rather than lost. A ledger of another mode starts a new run; a changed stream is
    accepted and recorded.
    """
    if pair.changes is None:
        raise ValueError(f"pair {pair.name} has no change log")
    size = _settings(pair, settings)
    table, ledger = open_pair(spark, pair, size)
    run = ledger.current_run(pair.name)
    if run is None or run["mode"] != "live":
        run_id = new_run_id("live")
        begin = start or dt.datetime.now(dt.timezone.utc)
        ledger.start_live(run_id, pair.name, pair.changes, begin)
        bootstrapped = False
    else:
        run_id, begin, bootstrapped = run["run_id"], run["start_ts"], run["bootstrap_done"]
        if run["stream_id"] != pair.changes:
            ledger.append(f"{run_id}/stream-{uuid.uuid4().hex[:8]}", run_id=run_id, table=pair.name,
                          mode="live", event="stream", stream_id=pair.changes)
    if not bootstrapped:
        bootstrap(spark, pair, run_id, settings)
        ledger.append(f"{run_id}/bootstrap", run_id=run_id, table=pair.name, mode="live",
                      event="bootstrap", bootstrap_done=True)
    return follow(spark, pair.changes, table, ledger, pair.mapping, run_id, pair.name, begin,
                  trigger, size.max_files_per_trigger, strict, size.result_counts)


def migrate_all(
    spark: SparkSession,
    pairs: Iterable[Pair],
    names: Iterable[str] | None = None,
    resume: bool = False,
    settings: RunSettings | None = None,
) -> dict[str, str]:
    """Migrate several pairs at once; every pair runs, then all failures are raised together."""
    chosen = select_pairs(check_pairs(pairs), names)
    size = settings or RunSettings()
    tasks = {p.name: _in_pool(spark, p.name, lambda p=p: migrate(spark, p, resume, settings)) for p in chosen}
    results, errors = _run_all(spark, tasks, size.max_concurrent_pairs)
    if errors:
        raise JobError("migration of pairs", errors)
    return results


def replicate_all(
    spark: SparkSession,
    pairs: Iterable[Pair],
    names: Iterable[str] | None = None,
    trigger: dict | None = None,
    settings: RunSettings | None = None,
    start: dt.datetime | None = None,
) -> tuple[dict[str, StreamingQuery], dict[str, Exception]]:
    """Start several live pairs; a pair that fails to start leaves the others running."""
    chosen = select_pairs(check_pairs(pairs), names)
    size = settings or RunSettings()
    tasks = {p.name: _in_pool(spark, p.name, lambda p=p: replicate(spark, p, trigger, settings, start)) for p in chosen}
    return _run_all(spark, tasks, size.max_concurrent_pairs)


CHECK = "pair string, check string, ok boolean, detail string"


def dry_run(spark: SparkSession, pairs: Iterable[Pair], names: Iterable[str] | None = None) -> DataFrame:
    """What a run would meet, nothing written: source readable, target readable, and how many
    items convert or go to the quarantine. The counts run when the result is used."""
    checks = spark.createDataFrame([], CHECK)
    for pair in select_pairs(check_pairs(pairs), names):
        try:
            rows = documents(spark, pair)
            counts = rows.agg(
                F.count_if(F.col("status") == GOOD).alias("ok"),
                F.count_if(F.col("status") != GOOD).alias("bad"),
            ).select(
                F.lit(pair.name).alias("pair"),
                F.lit("source").alias("check"),
                F.lit(True).alias("ok"),
                F.format_string("%d documents, %d quarantined", "ok", "bad").alias("detail"),
            )
        except Exception as error:  # the other pairs are still checked
            counts = spark.createDataFrame([(pair.name, "source", False, said(error))], CHECK)
        try:
            version = DocTable(spark, pair.target).version()
            found = True, "new" if version is None else f"version {version['version']}"
        except Exception as error:
            found = False, said(error)
        target = spark.createDataFrame([(pair.name, "target", *found)], CHECK)
        checks = checks.unionByName(counts).unionByName(target)
    return checks


def status(spark: SparkSession, pairs: Iterable[Pair], names: Iterable[str] | None = None) -> DataFrame:
    """One row per pair: progress, source profile and target count; errors stay in their column."""
    rows = None
    for pair in select_pairs(check_pairs(pairs), names):
        table, ledger = open_pair(spark, pair, _settings(pair, None))
        one = pair_status(spark, pair, table, ledger)
        rows = one if rows is None else rows.unionByName(one)
    return rows
