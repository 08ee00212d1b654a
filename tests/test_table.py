"""Targets that accumulate, compaction by bucket, lookups and vacuum."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_replication import T0, ops_frame, record, state, write_lines

from itemflow import DocTable
from itemflow.functions.keys import bucket_of
from itemflow.session import work_folder
from itemflow.sinks.manifest import existing, remove
from itemflow.sources.changes import changes_from, seek_index, shard_order, trimmed_records

LATER = dt.datetime(2999, 1, 1, tzinfo=dt.timezone.utc)


def new_table(spark, **options):
    return DocTable(spark, work_folder(spark, "t"), buckets=4, **options)


def copy(table, spark, run, values):
    rows = ops_frame(spark, [("UPSERT", k, 0, v) for k, v in values.items()]).withColumn("seq_key", F.lit(""))
    table.write_base(rows, run)
    table.commit_version(run, run)


class Plain:
    """What the table should hold: per run and key its newest operation, and which run wrote last."""

    def __init__(self):
        self.epoch, self.rows = -1, []

    def copy(self, run, values):
        self.epoch += 1
        self.rows += [(k, run, -1, self.epoch, 0, "UPSERT", v) for k, v in values.items()]

    def batch(self, run, ops):
        self.rows += [(key, run, seq, self.epoch, 1, op, v) for op, key, seq, v in ops]

    def state(self):
        newest = {}
        for key, run, seq, epoch, log, op, v in self.rows:
            if (key, run) not in newest or newest[key, run][0] < (seq, epoch):
                newest[key, run] = ((seq, epoch), (epoch, log, run), op, v)
        last = {}
        for (key, _), (_, rank, op, v) in newest.items():
            if key not in last or last[key][0] < rank:
                last[key] = (rank, op, v)
        return {k: v for k, (_, op, v) in last.items() if op == "UPSERT"}


@pytest.mark.parametrize("seed,clustered", [(1, False), (2, True)])
def test_copies_and_logs_of_several_runs_match_brute_force(spark, seed, clustered):
    rnd, table, plain = random.Random(seed), new_table(spark, clustered=clustered), Plain()
    keys, batches, seqs = [f"s:{i}" for i in range(12)], {"a": 0, "b": 0}, {"a": [*range(60)], "b": [*range(60)]}
    for run in batches:
        first = {k: rnd.randrange(99) for k in keys[:6]}
        copy(table, spark, run, first)
        plain.copy(run, first)
        rnd.shuffle(seqs[run])
    for step in range(8):
        kind = ["batch", "batch", "compact", "copy", "batch", "compact", "batch", "batch"][step]
        if kind == "batch":
            run = rnd.choice("ab")
            ops = [(rnd.choice(["UPSERT", "UPSERT", "DELETE"]), rnd.choice(keys), seqs[run].pop(), rnd.randrange(99)) for _ in range(6)]
            table.append_batch(ops_frame(spark, ops), batches[run], run)
            batches[run] += 1
            plain.batch(run, ops)
        elif kind == "copy":
            values = {k: rnd.randrange(99) for k in rnd.sample(keys, 4)}
            copy(table, spark, f"copy{step}", values)
            plain.copy(f"copy{step}", values)
        else:
            table.compact()
            plain.epoch += 1
            assert table.log().count() == 0
        assert state(table.current()) == plain.state(), (step, kind)
    assert state(table.lookup(keys[:5])) == {k: v for k, v in plain.state().items() if k in keys[:5]}


def test_a_copy_adds_to_what_another_left(spark):
    table = new_table(spark)
    copy(table, spark, "p1", {"s:a": 1, "s:c": 2})
    copy(table, spark, "p2", {"s:b": 3, "s:c": 4})
    assert state(table.current()) == {"s:a": 1, "s:b": 3, "s:c": 4}
    table.compact()
    assert state(table.current()) == {"s:a": 1, "s:b": 3, "s:c": 4} and table.base().count() == 3


def test_committers_at_once_lose_nothing(spark, monkeypatch):
    """Both worked from the same manifest, as two drivers would."""
    table = new_table(spark)
    copy(table, spark, "old", {"s:a": 0, "s:z": 9})
    before = table.manifest()
    monkeypatch.setattr(DocTable, "manifest", lambda self: before)
    for run, value in (("p1", 1), ("p2", 2)):
        table.write_base(ops_frame(spark, [("UPSERT", f"s:{run}", 0, value)]), run)
        from itemflow.sinks.manifest import COPY, commit

        commit(spark, table.root, before, kind=COPY, base=run, runs=[run])
    monkeypatch.undo()
    assert state(table.current()) == {"s:a": 0, "s:z": 9, "s:p1": 1, "s:p2": 2}


def test_compactions_at_once_count_once_for_each_bucket(spark, monkeypatch):
    table = new_table(spark)
    for batch in range(3):
        table.append_batch(ops_frame(spark, [("UPSERT", f"s:{i}", 10 * batch + i, batch) for i in range(9)]), batch)
    want, stale = state(table.current()), table.snapshot()
    table.compact()
    with monkeypatch.context() as patch:
        patch.setattr(DocTable, "snapshot", lambda self: stale)
        table.compact()
    assert len(table.manifest().entries) == 2
    assert state(table.current()) == want and table.base().count() == 9
    table.append_batch(ops_frame(spark, [("DELETE", "s:1", 99, 0)]), 3)
    table.compact()
    assert state(table.current()) == {k: v for k, v in want.items() if k != "s:1"}
    assert table.vacuum(LATER) > 0
    assert state(table.current()) == {k: v for k, v in want.items() if k != "s:1"}


def test_one_changed_key_rewrites_one_bucket(spark):
    table = new_table(spark, clustered=True)
    table.append_batch(ops_frame(spark, [("UPSERT", f"s:{i}", i, i) for i in range(100)]), 0)
    table.compact()
    table.append_batch(ops_frame(spark, [("UPSERT", "s:7", 200, -1)]), 1)
    table.compact()
    newest = table.manifest().entries[-1]
    of = spark.range(1).select(bucket_of(F.lit("s:7"), 4)).first()[0]
    assert list(newest.from_) == [of]
    written = existing(spark, f"{table.base_path(newest.base)}/status=good/bucket=*")
    assert [p.rsplit("=", 1)[1] for p in written] == [str(of)]
    assert state(table.current()) == {f"s:{i}": i for i in range(100)} | {"s:7": -1}
    assert table.compact() == 1 and len(table.manifest().entries) == 2, "nothing changed, nothing written"


def test_vacuum_takes_only_what_is_replaced_and_old(spark):
    table = new_table(spark)
    table.append_batch(ops_frame(spark, [("UPSERT", f"s:{i}", i, i) for i in range(40)]), 0)
    table.compact()
    table.append_batch(ops_frame(spark, [("UPSERT", "s:3", 99, 0), ("DELETE", "s:4", 99, 0)]), 1)
    table.compact()
    table.append_batch(ops_frame(spark, [("UPSERT", "s:5", 100, 1)]), 2)
    want = {f"s:{i}": i for i in range(40) if i != 4} | {"s:3": 0, "s:5": 1}
    assert table.vacuum(dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc)) == 0
    assert table.vacuum(LATER) > 0 and state(table.current()) == want
    left = existing(spark, f"{table.root}/log/main/batch_id=*")
    assert [p.rsplit("=", 1)[1] for p in left] == ["2"]
    assert table.vacuum(LATER) == 0


def test_a_batch_still_being_written_stays_in_the_log(spark):
    table = new_table(spark)
    table.append_batch(ops_frame(spark, [("UPSERT", "s:a", 1, 1)]), 0)
    open_batch = table.append_batch(ops_frame(spark, [("UPSERT", "s:b", 2, 2)]), 1)
    remove(spark, [f"{open_batch}/_SUCCESS"])
    table.append_batch(ops_frame(spark, [("UPSERT", "s:c", 3, 3)]), 2)
    table.compact()
    assert sorted(r.batch_id for r in table.log().select("batch_id").distinct().collect()) == [1, 2]
    assert state(table.current()) == {"s:a": 1, "s:b": 2, "s:c": 3}


@pytest.mark.parametrize("clustered", [False, True])
def test_lookup_by_a_column_of_keys(spark, clustered):
    table = new_table(spark, clustered=clustered)
    table.append_batch(ops_frame(spark, [("UPSERT", f"s:{i}", i, i) for i in range(200)]), 0)
    table.compact()
    table.append_batch(ops_frame(spark, [("DELETE", "s:9", 300, 0), ("UPSERT", "s:7", 301, 77)]), 1)
    keys = spark.createDataFrame([("s:7",), ("s:7",), ("s:9",), ("s:20",), ("none",), (None,)], "key string")
    assert state(table.lookup(keys)) == {"s:7": 77, "s:20": 20}
    assert table.lookup(keys.limit(0)).collect() == []


def test_keys_are_found_by_bloom_filters_of_the_files(spark):
    table = new_table(spark)
    table.append_batch(ops_frame(spark, [("UPSERT", f"s:{i}", i, i) for i in range(500)]), 0)
    table.compact()
    import pyarrow.parquet as pq

    files = spark.read.parquet(table.base_path(table.version()["base"])).inputFiles()
    metadata = pq.read_metadata(files[0].removeprefix("file://"))
    assert metadata.row_group(0).column(0).path_in_schema == "key"
    with open(files[0].removeprefix("file://"), "rb") as f:
        plain = f.read()
    assert metadata.serialized_size < len(plain) and b"key" in plain
    assert table.lookup(["s:none"]).collect() == []


def test_a_log_is_read_from_a_position_without_opening_what_lies_before(spark):
    folder = work_folder(spark, "log")
    for n in range(4):
        write_lines(spark, f"{folder}/f{n}", [record("INSERT", 10 * n + i, f"u{i}", i, ts=10 * n + i) for i in range(10)])
    seek_index(spark, folder).write.parquet(f"{folder}-index")
    index = spark.read.parquet(f"{folder}-index")
    assert [r.records for r in index.orderBy("first_seq_key").collect()] == [10] * 4
    remove(spark, [f"{folder}/f0", f"{folder}/f1"])

    def seen(**position):
        return sorted(int(r.seq) for r in changes_from(spark, index, **position).collect())

    assert seen(at="25") == [*range(25, 40)] and seen(after="29") == [*range(30, 40)] and seen(newest=True) == []
    assert seen(start=T0 + dt.timedelta(seconds=33)) == [*range(33, 40)] and seen(after="99") == []
    write_lines(spark, f"{folder}/f4", [record("INSERT", 40, "u", 1, ts=40)])
    grown = seek_index(spark, folder, index)
    assert grown.count() == 5 and sorted(int(r.seq) for r in changes_from(spark, grown, after="38").collect()) == [39, 40]
    lost = trimmed_records(spark, folder, index, applied="9").collect()
    assert [(r.files, r.records, int(r.first_seq_key), int(r.last_seq_key)) for r in lost] == [(1, 10, 10, 19)]


def test_shards_come_after_all_their_parents(spark):
    rows = [("a", None), ("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("d", "x"), ("e", "d"), ("e", "a"), ("l", "l"), ("m", "l")]
    got = shard_order(spark.createDataFrame(rows, "shard_id string, parent_id string")).collect()
    assert {r.shard_id: r.generation for r in got} == {"a": 0, "b": 1, "c": 1, "d": 2, "e": 3}


def test_result_counts_of_copies_and_batches(spark):
    table = new_table(spark)
    copy(table, spark, "p1", {"s:a": 1, "s:b": 2, "s:c": 3})
    before = table.snapshot()
    copy(table, spark, "p2", {"s:a": 1, "s:b": 9, "s:n": 4})
    counts = table.copy_effects("p2", before).first().asDict()
    assert counts == {"inserted": 0, "upserted": 1, "modified": 1, "unchanged": 1, "deleted": 0, "not_found": 0}
    ops = [("DELETE", "s:a", 1, 0), ("DELETE", "s:q", 2, 0), ("UPSERT", "s:c", 3, 7), ("UPSERT", None, 4, 7)]
    for _ in range(2):  # a replay counts the same
        table.append_batch(ops_frame(spark, ops), 0, "p2")
        counts = table.batch_effects(0, "p2").first().asDict()
        assert counts == {"inserted": 1, "upserted": 0, "modified": 1, "unchanged": 0, "deleted": 1, "not_found": 1}
