"""Change records, document table, ledger, jobs and streams."""

import datetime as dt
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from itemflow import (
    DocTable,
    Ledger,
    Mapping,
    Pair,
    RunSettings,
    dry_run,
    list_shards,
    migrate,
    migrate_all,
    parse_changes,
    replicate,
    replicate_all,
    since,
    status,
    to_operations,
)
from itemflow.operators.latest import difference, latest_per_key, live, merge_latest, write_counts
from itemflow.plans import jobs
from itemflow.plans.jobs import JobError, open_pair
from itemflow.plans.pair import check_pairs, select_pairs
from itemflow.session import shared_folder, work_folder
from itemflow.sources.changes import from_sequence
from itemflow.streaming.live import change_operations, follow

UTC = dt.timezone.utc
T0 = dt.datetime(2024, 1, 1, tzinfo=UTC)
ONCE = {"availableNow": True}


def record(event, seq, key=None, value=None, ts=0.0, **extra):
    data = {"SequenceNumber": str(seq)}
    if ts is not None:
        data["ApproximateCreationDateTime"] = T0.timestamp() + ts
    if key is not None:
        data["Keys"] = {"id": {"S": key}}
    if value is not None:
        data["NewImage"] = {"id": {"S": key}, "v": {"N": str(value)}}
    return json.dumps({"eventName": event, "dynamodb": data | extra})


def raw(spark, records):
    return spark.createDataFrame([(r,) for r in records], "raw string")


def write_lines(spark, path, texts, files=1):
    raw(spark, texts).repartition(files).write.mode("append").text(path)
    return path


def item(key, value):
    return json.dumps({"Item": {"id": {"S": key}, "v": {"N": str(value)}}})


def state(docs):
    v = F.try_variant_get("doc", "$.v", "bigint")
    return {r.key: r.v for r in docs.select("key", v.alias("v")).collect()}


MAPPING = Mapping(key_source="id")


def operations(spark, records, **options):
    return to_operations(parse_changes(raw(spark, records)), MAPPING, **options)


def test_time_filter(spark):
    df = parse_changes(raw(spark, [record("INSERT", 1, "a", 1, ts=t) for t in (-0.001, 0, 0.0004, None)]))
    assert since(df, T0).count() == 2
    assert since(df, None).count() == 4


def test_routing(spark):
    records = [record("INSERT", 1, "a", 1), record("MODIFY", 2, "a"), record("REMOVE", 3, "a"),
               record("REMOVE", 4), record("OTHER", 5, "a", 1), "junk"]
    ops = operations(spark, records).collect()
    assert [(r.op, r.status, r.reason) for r in ops] == [
        ("UPSERT", "good", None), ("DELETE", "good", None), (None, "quarantine", "malformed record")]
    strict = operations(spark, records, strict=True).collect()
    assert [r.reason for r in strict] == [
        None, "new image missing", None, "keys missing", "unknown event", "malformed record"]


def test_delete_key_falls_back_to_all_keys(spark):
    lines = [json.dumps({"eventName": "REMOVE", "dynamodb": {"SequenceNumber": "1", "Keys": k}}) for k in (
        {"id": {"S": "a"}, "sortKey": {"N": "1.0"}}, {"pk": {"S": "a"}, "sortKey": {"N": "1"}}, {"_id": {"S": "z"}})]
    ops = to_operations(parse_changes(raw(spark, lines)), Mapping(key_source="id", naming="snake_case"))
    assert [r.key for r in ops.collect()] == ["s:a", 'k:{"pk":"a","sort_key":1}', "s:z"]


def test_shards_in_order_of_their_first_sequence(spark):
    records = [json.dumps({"eventName": "INSERT", "shardId": s, "dynamodb": {"SequenceNumber": n}}) for s, n in
               (("b", "99"), ("a", "100000000000000000001"), ("b", "100000000000000000009"), (None, "1"))]
    shards = list_shards(parse_changes(raw(spark, records))).collect()
    assert [(s.shard_id, s.records) for s in shards] == [("b", 2), ("a", 1)]
    df = parse_changes(raw(spark, records))
    assert from_sequence(df, "99").count() == 3 and from_sequence(df, "99", after=True).count() == 2


def brute(ops):
    out = {}
    for op, key, seq, value in sorted(ops, key=lambda o: o[2]):
        out[key] = value if op == "UPSERT" else None
    return {k: v for k, v in out.items() if v is not None}


def random_ops(seed, n=400):
    rnd = random.Random(seed)
    hot = ["s:hot"] * 8
    return [(rnd.choice(["UPSERT"] * 3 + ["DELETE"]), rnd.choice(hot + [f"s:{i}" for i in range(16)]), seq, rnd.randrange(99))
            for seq in range(n)]


def ops_frame(spark, ops):
    rows = [(op, key, f"{seq:040d}", v if op == "UPSERT" else None) for op, key, seq, v in ops]
    df = spark.createDataFrame(rows, "op string, key string, seq_key string, v bigint")
    doc = F.when(F.col("op") == "UPSERT", F.to_variant_object(F.struct("v")))
    return df.select("op", "key", "seq_key", F.lit(None).cast("timestamp").alias("approx_ts"), doc.alias("doc"))


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_and_merge_match_brute_force(spark, seed):
    ops = random_ops(seed)
    rnd = random.Random(seed)
    assert state(live(latest_per_key(ops_frame(spark, ops)))) == brute(ops)
    shuffled = rnd.sample(ops, len(ops))
    base = latest_per_key(ops_frame(spark, shuffled[:250]))
    assert state(live(merge_latest(base, ops_frame(spark, shuffled[250:])))) == brute(ops)


def test_merge_without_broadcast(spark):
    """A log beyond the broadcast threshold takes shuffled joins, hot key included."""
    ops = random_ops(7)
    shuffled = random.Random(7).sample(ops, len(ops))
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in settings:
        spark.conf.set(name, "-1")
    try:
        base = latest_per_key(ops_frame(spark, shuffled[:200]))
        merged = live(merge_latest(base, ops_frame(spark, shuffled[200:])))
        assert "BroadcastHashJoin" not in merged._jdf.queryExecution().executedPlan().toString()
        assert state(merged) == brute(ops)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_table_is_independent_of_batches_and_replays(spark):
    ops = random_ops(3)
    shuffled = random.Random(3).sample(ops, len(ops))
    table = DocTable(spark, work_folder(spark, "t"))
    for batch in range(4):
        table.append_batch(ops_frame(spark, shuffled[batch::4]), batch)
        if batch == 1:
            table.compact()
        if batch == 2:
            table.append_batch(ops_frame(spark, shuffled[batch::4]), batch)
    assert state(table.current()) == brute(ops)
    table.compact(cluster=False)
    assert state(table.current()) == brute(ops)
    assert table.version()["version"] == 1 and table.log().count() == 0


def test_missing_table_is_empty(spark):
    table = DocTable(spark, work_folder(spark, "none"))
    assert table.count().first().documents == 0 and table.quarantine().count() == 0


def test_late_record_loses_to_kept_tombstone_and_purge_drops_it(spark):
    table = DocTable(spark, work_folder(spark, "t"))
    table.append_batch(ops_frame(spark, [("UPSERT", "s:a", 5, 1), ("DELETE", "s:a", 7, 0)]), 0)
    table.compact()
    table.append_batch(ops_frame(spark, [("UPSERT", "s:a", 6, 2)]), 1)
    assert state(table.current()) == {}
    table.append_batch(ops_frame(spark, [("UPSERT", "s:a", 8, 3)]), 2)
    assert state(table.current()) == {"s:a": 3}
    gone = ops_frame(spark, [("DELETE", "s:a", 9, 0)]).withColumn("approx_ts", F.lit(T0))
    table.append_batch(gone, 3)
    table.compact(purge_before=T0 + dt.timedelta(days=1))
    assert table.states().count() == 0


def test_clustered_lookup_reads_one_bucket(spark):
    table = DocTable(spark, work_folder(spark, "t"), buckets=8)
    rows = ops_frame(spark, [("UPSERT", f"s:{i}", i, i) for i in range(200)])
    table.write_base(rows, "b", cluster=True)
    table.commit_version("b", cluster=True)
    found = table.lookup(["s:7", "s:9", "s:x"])
    assert state(found) == {"s:7": 7, "s:9": 9}
    one = table.lookup(["s:7"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1]
    table.delete(spark.createDataFrame([("s:7",)], "key string"), 0, "9" * 40)
    assert state(table.lookup(["s:7", "s:9"])) == {"s:9": 9}


def test_keyless_documents_are_inserted(spark):
    table = DocTable(spark, work_folder(spark, "t"))
    twin = ops_frame(spark, [("UPSERT", None, 1, 5), ("UPSERT", None, 1, 5)])
    table.append_batch(twin, 0)
    assert table.current().count() == 2


def test_write_counts(spark):
    before = live(latest_per_key(ops_frame(spark, [("UPSERT", k, 1, 1) for k in ("s:a", "s:b", "s:c")])))
    ops = ops_frame(spark, [("UPSERT", "s:a", 2, 2), ("UPSERT", "s:a", 3, 9), ("UPSERT", "s:b", 2, 1), ("DELETE", "s:c", 2, 0),
                            ("DELETE", "s:q", 2, 0), ("UPSERT", "s:n", 2, 1), ("UPSERT", None, 2, 1)])
    assert write_counts(before, ops).first().asDict() == {
        "inserted": 1, "upserted": 1, "modified": 1, "unchanged": 1, "deleted": 1, "not_found": 1}


def pair_of(spark, name, texts, files=6, changes=None, **options):
    source = write_lines(spark, work_folder(spark, f"{name}-src"), texts, files)
    return Pair(name=name, source=source, target_root=work_folder(spark, name), collection="myUsers",
                mapping=Mapping(key_source="id", collection_naming="snake_case"), changes=changes, **options)


def current(spark, pair):
    return state(open_pair(spark, pair, RunSettings())[0].current())


ITEMS = [item(f"u{i}", i) for i in range(40)]
EXPECTED = {f"s:u{i}": i for i in range(40)}


def test_migrate_resumes_after_failed_segments(spark, monkeypatch):
    pair = pair_of(spark, "m", [*ITEMS, "junk"], settings={"segments": 3})
    assert pair.target.endswith("/my_users")
    plain, calls = jobs.documents, []

    def failing(spark, pair, segments=None, segment=None):
        calls.append(segment)
        if segment == 1:
            raise RuntimeError("lost")
        return plain(spark, pair, segments, segment)

    monkeypatch.setattr(jobs, "documents", failing)
    with pytest.raises(JobError, match="segment 1: lost"):
        migrate(spark, pair)
    assert sorted(calls) == [0, 1, 2] and current(spark, pair) == {}
    calls.clear()
    monkeypatch.setattr(jobs, "documents", lambda *a: calls.append(a[3]) or plain(*a))
    run = migrate(spark, pair, resume=True)
    assert calls == [1] and current(spark, pair) == EXPECTED
    table, ledger = open_pair(spark, pair, RunSettings())
    assert table.quarantine().collect()[0].raw == "junk"
    total = ledger.totals().first()
    assert (total.run_id, total.processed, total.segments_done) == (run, 41, 3)
    assert [r.table for r in ledger.tables().collect()] == ["m"]
    again = migrate(spark, pair)
    assert again != run and current(spark, pair) == EXPECTED
    report = status(spark, [pair]).first()
    assert (report.processed, report.quarantined, report["items"], report.documents, report.percent) == (41, 1, 41, 40, 100.0)


def test_deleted_progress_starts_over(spark):
    ledger = Ledger(spark, work_folder(spark, "l"))
    assert ledger.current_run("t") is None
    ledger.start_migrate("r1", "t", 4)
    assert ledger.current_run("t")["segments"] == 4
    ledger.delete("t")
    assert ledger.current_run("t") is None
    ledger.start_live("r2", "t", "s", T0)
    run = ledger.current_run("t")
    assert (run["run_id"], run["mode"], run["bootstrap_done"], run["start_ts"]) == ("r2", "live", False, T0.replace(tzinfo=None))


def test_dry_run_writes_nothing(spark):
    pair = pair_of(spark, "d", [*ITEMS, "junk"])
    lost = Pair(name="lost", source=work_folder(spark, "nowhere"), target_root="/x", collection="c")
    rows = {(r.pair, r.check): (r.ok, r.detail) for r in dry_run(spark, [pair, lost]).collect()}
    assert rows[("d", "source")] == (True, "40 documents, 1 quarantined")
    assert rows[("lost", "source")] == (False, "not found") and rows[("d", "target")] == (True, "new")
    assert current(spark, pair) == {}
    assert status(spark, [lost]).first().source_error == "not found"


def test_pairs_run_side_by_side_and_fail_alone(spark):
    good_pair = pair_of(spark, "g", ITEMS)
    lost = Pair(name="lost", source=work_folder(spark, "nowhere"), target_root=work_folder(spark, "lost"), collection="c")
    with pytest.raises(JobError) as failure:
        migrate_all(spark, [lost, good_pair], settings=RunSettings(max_concurrent_pairs=2, segments=2))
    assert set(failure.value.errors) == {"lost"} and current(spark, good_pair) == EXPECTED
    with pytest.raises(ValueError, match="duplicate"):
        check_pairs([lost, lost])
    with pytest.raises(ValueError):
        check_pairs([])
    assert select_pairs([lost, good_pair], ["g"]) == [good_pair]
    assert RunSettings().override({"segments": 3, "parallel_readers": 0}) == RunSettings(segments=3)


CHANGES = [record("MODIFY", 11, "u1", 100, ts=5), record("REMOVE", 12, "u2", ts=6), record("INSERT", 13, "new", 7, ts=7),
           record("MODIFY", 3, "u3", 999, ts=-5)]
AFTER = {k: v for k, v in EXPECTED.items() if k != "s:u2"} | {"s:u1": 100, "s:new": 7}


def test_live_copies_then_follows_and_resumes(spark, monkeypatch):
    changes = write_lines(spark, work_folder(spark, "changes"), [*CHANGES, "junk"])
    pair = pair_of(spark, "live", ITEMS, changes=changes)
    replicate(spark, pair, ONCE, start=T0).awaitTermination()
    assert current(spark, pair) == AFTER
    write_lines(spark, changes, [record("MODIFY", 14, "u1", 101, ts=9), record("MODIFY", 10, "u1", 55, ts=9)])
    monkeypatch.setattr(jobs, "bootstrap", lambda *a: pytest.fail("the copy must not run again"))
    moved = Pair(**{**pair.__dict__, "changes": changes + "/"})
    replicate(spark, moved, ONCE).awaitTermination()
    assert current(spark, pair) == AFTER | {"s:u1": 101}
    table, ledger = open_pair(spark, pair, RunSettings())
    assert [r.reason for r in table.quarantine().collect()] == ["malformed record"]
    run = ledger.current_run("live")
    assert run["stream_id"] == changes + "/" and run["start_ts"] == T0.replace(tzinfo=None)
    assert ledger.high_water("live").first().high_water == (T0 + dt.timedelta(seconds=9)).replace(tzinfo=None)
    table.compact()
    assert current(spark, pair) == AFTER | {"s:u1": 101}
    write_lines(spark, changes, [record("REMOVE", 15, "u1", ts=10)])
    replicate(spark, moved, ONCE).awaitTermination()
    assert "s:u1" not in current(spark, pair)


def test_unique_keys_leave_the_copy_unshuffled(spark):
    changes = write_lines(spark, work_folder(spark, "changes"), CHANGES)
    source = write_lines(spark, work_folder(spark, "src"), ITEMS, 3)
    pair = Pair(name="uniq", source=source, target_root=work_folder(spark, "uniq"), collection="c",
                mapping=Mapping(key_source="id", unique_keys=True, deep=False, cluster=True), changes=changes)
    replicate(spark, pair, ONCE, start=T0).awaitTermination()
    assert current(spark, pair) == AFTER
    docs = open_pair(spark, pair, RunSettings())[0].current()
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [key" in plan and "SortMergeJoin" not in plan


def test_stream_progress_is_two_rows_and_counts_replays_once(spark):
    ledger = Ledger(spark, work_folder(spark, "l"))
    one = spark.sql("select 5L processed, 1L quarantined, timestamp'2024-01-02' high_water")
    old = spark.sql("select 2L processed, 0L quarantined, timestamp'2024-01-01' high_water")
    for batch, counts in ((0, one), (1, old), (1, old), (2, one), (2, one)):
        ledger.batch_done("r", "t", batch, counts)
    rows = {r.batch_id: (r.processed, r.quarantined, r.high_water.day) for r in ledger.read().collect()}
    assert rows == {1: (7, 1, 2), 2: (12, 2, 2)}


def test_difference(spark):
    left = ops_frame(spark, [("UPSERT", "s:a", 1, 1), ("UPSERT", "s:b", 1, 2), ("UPSERT", "s:c", 1, 3), ("UPSERT", "s:c", 1, 3)])
    right = ops_frame(spark, [("UPSERT", "s:a", 9, 1), ("UPSERT", "s:b", 1, 5)])
    got = sorted((r.key, r.side) for r in difference(left, right).collect() for _ in range(r.n))
    assert got == [("s:b", "left"), ("s:b", "right"), ("s:c", "left"), ("s:c", "left")]


def test_live_after_migrate_starts_a_new_run(spark):
    changes = write_lines(spark, work_folder(spark, "changes"), CHANGES)
    pair = pair_of(spark, "switch", ITEMS, changes=changes)
    old = migrate(spark, pair)
    replicate(spark, pair, ONCE, start=T0).awaitTermination()
    assert current(spark, pair) == AFTER
    assert open_pair(spark, pair, RunSettings())[1].current_run("switch")["run_id"] != old
    assert migrate(spark, pair, resume=True) != old
    assert current(spark, pair) == EXPECTED | {"s:new": 7}, "a copy adds to what is there"


def test_replicate_all_reports_failures(spark):
    changes = write_lines(spark, work_folder(spark, "changes"), CHANGES)
    pair = pair_of(spark, "one", ITEMS, changes=changes)
    queries, errors = replicate_all(spark, [pair, pair_of(spark, "none", ITEMS)], trigger=ONCE, start=T0)
    queries["one"].awaitTermination()
    assert set(errors) == {"none"} and current(spark, pair) == AFTER


def test_stream_out_of_order_with_restart(spark):
    rnd = random.Random(5)
    ops = random_ops(5, 120)
    texts = [record("MODIFY" if op == "UPSERT" else "REMOVE", seq, key[2:], v if op == "UPSERT" else None)
             for op, key, seq, v in rnd.sample(ops, len(ops))]
    folder, name = work_folder(spark, "changes"), f"s{uuid.uuid4().hex[:6]}"
    table, ledger = DocTable(spark, work_folder(spark, "t")), Ledger(spark, work_folder(spark, "l"))
    for part in range(3):
        write_lines(spark, folder, texts[part::3])
        follow(spark, folder, table, ledger, MAPPING, "main", name, None, ONCE).awaitTermination()
    assert state(table.current()) == brute(ops)
    batch = state(live(latest_per_key(change_operations(raw(spark, texts), MAPPING))))
    assert batch == brute(ops)


def test_work_goes_to_the_named_folder(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert named is None or shared_folder(spark) == named.rstrip("/")


def test_bad_records_are_set_aside_and_end_nothing(spark):
    def change(sequence, time=0, key="a"):
        data = {"SequenceNumber": sequence, "ApproximateCreationDateTime": time, "Keys": {"id": {"S": key}}}
        return json.dumps({"eventName": "INSERT", "dynamodb": {**data, "NewImage": {"id": {"S": key}}}})

    lines = [change("1", 1e30), change("9" * 41), change("9" * 40), change(None), change("x1"), change("3", "soon")]
    records = parse_changes(raw(spark, lines))
    assert [r.approx_ts is None for r in records.collect()][:2] == [True, False]
    ops = to_operations(records, MAPPING).collect()
    assert [r.status for r in ops] == ["good"] * 3 + ["quarantine"] * 2 + [ops[5].status]
    assert ops[3].reason == ops[4].reason == "sequence number missing or not a number" and ops[3].raw == lines[3]
    assert ops[2].seq_key < ops[1].seq_key


def test_binary_as_text_never_fails_the_job(spark):
    mapping = Mapping(key_source="id", binary="utf8")
    blobs = ["aGk=", "/w==", "not base64!"]
    records = [json.dumps({"Item": {"id": {"S": str(i)}, "b": {"B": b}}}) for i, b in enumerate(blobs)]
    from itemflow.operators.convert import to_documents
    from itemflow.sources.items import parse_items

    rows = to_documents(parse_items(raw(spark, records)), mapping).orderBy("key")
    got = rows.select("status", F.try_variant_get("doc", "$.b", "string").alias("b")).collect()
    assert sorted(got, key=str) == sorted([("good", "hi"), ("good", "\ufffd"), ("quarantine", None)], key=str)


def test_deletes_of_unmapped_pairs_find_their_document(spark):
    lines = [json.dumps({"eventName": e, "dynamodb": {
        "SequenceNumber": str(i), "Keys": {"pk": {"S": k}, "sk": {"N": "1"}}, "NewImage": {"pk": {"S": k}, "v": {"N": str(i)}}}})
        for i, (e, k) in enumerate([("INSERT", "a"), ("INSERT", "b"), ("MODIFY", "b"), ("REMOVE", "a")])]
    ops = to_operations(parse_changes(raw(spark, lines)), Mapping())
    assert {k: v for k, v in state(live(latest_per_key(ops))).items()} == {'k:{"pk":"b","sk":1}': 2}


def test_exact_decimals_never_round(spark):
    from itemflow.functions.expr import variant
    from itemflow.functions.transforms import to_decimal

    texts = ["0.1234567890123456789", "0.123456789012345678000", "12345678901234567890", "1e3", "-.5", "x", "123456789012345678901"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = df.select(F.expr(f"cast({to_decimal(variant('v'), exact=True)} as string)").alias("d")).collect()
    assert [r.d is not None for r in got] == [False, True, True, False, True, False, False]
