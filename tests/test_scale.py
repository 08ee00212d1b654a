"""Work is dealt out evenly, and done once."""

import pytest
from decimal import Decimal

from pyspark.sql import functions as F

from itemflow.functions.encode import encode_documents
from itemflow.functions.variants import variant_reader, variant_writer
from itemflow.operators.convert import to_documents
from itemflow.plans.pair import Mapping
from itemflow.session import spread
from itemflow.sources.items import parse_items
from queries.replication import third_of_operations


def sizes(df):
    return [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]


def test_splits_without_rows_do_not_count(spark, tmp_path):
    """One row group is cut into as many splits as there are cores, of which one has all rows."""
    path = str(tmp_path / "one")
    spark.range(0, 40_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text")).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        scan = spark.read.parquet(path)
        assert scan.rdd.getNumPartitions() >= cores and max(sizes(scan)) == 40_000
        dealt = spread(scan)
        assert max(sizes(dealt)) <= 40_000 / cores * 1.1
        assert dealt.agg(F.sum("id")).collect()[0][0] == sum(range(40_000))
        many = spark.range(0, 40_000, 1, cores * 3)
        assert spread(many) is many
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_a_third_of_the_log_is_chosen_before_it_is_converted(spark, tmp_path):
    events = spark.range(100).selectExpr(
        "id AS event_id", "'click' AS event_type", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id", "0.5D AS value", "'{}' AS props"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    ops = [third_of_operations(spark, str(tmp_path), n) for n in range(3)]
    for n, part in enumerate(ops):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "% 3) = " in plan and "PushedFilters: [IsNotNull(event_id), GreaterThanOrEqual(event_id,0)]" in plan
        assert {int(r[0]) % 3 for r in part.select(F.col("seq_key").cast("bigint")).collect()} == {n}
    assert sum(part.count() for part in ops) == 100


@pytest.mark.parametrize(
    "value",
    [{"a": [1, -129, 2**40, None, True, 1.5], "": {"é": "x" * 70, "\U0001f600": [], "￾": {}}}, [str(i) * 9 for i in range(300)], {str(i): i for i in range(300)},
     Decimal("9" * 38), Decimal("-1.50"), float("inf"), "y" * 300],
)
def test_reader_gives_back_what_the_writer_got(value):
    assert variant_reader()(variant_writer()(value)) == value


def test_values_deeper_than_python_recurses_are_written():
    deep = []
    for _ in range(50_000):
        deep = [deep]
    assert len(variant_writer()(deep).value) > 50_000


def test_wide_numbers_keep_their_digits_beside_deep_values(spark, lines):
    """Documents that nest too deep for generated code used to lose digits beyond the 28th when they were encoded."""
    deep = {"L": [{"L": [{"L": [{"L": [{"L": [{"N": "1"}]}]}]}]}]}
    wide = "9" * 37 + "7"
    docs = to_documents(parse_items(lines({"id": {"N": "1"}, "n": {"N": wide}, "v": deep})), Mapping(key_source="id", wide_numbers="decimal"))
    assert f'"N":"{wide}"' in encode_documents(docs.select("doc")).collect()[0]["line"]


def test_a_value_with_two_tags_is_not_decoded(spark, lines):
    """Whatever the two tags are, and also where containers are no longer decoded."""
    tags = {"S": "a", "N": "1", "BOOL": True, "NULL": True, "B": "eA==", "SS": ["a"], "NS": ["1"], "BS": ["eA=="], "L": [], "M": {}}
    pairs = [(a, b) for a in tags for b in tags if a < b]
    items = lines(*[{"id": {"N": str(i)}, "v": {a: tags[a], b: tags[b]}} for i, (a, b) in enumerate(pairs)])
    for depth in (0, 3):
        rows = to_documents(parse_items(items, depth), Mapping(key_source="id", depth=depth, deep=False))
        assert {(r.status, r.field) for r in rows.collect()} == {("quarantine", "v")}
