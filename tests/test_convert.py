"""Decode, mapping, quarantine, typed output and the way back."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from itemflow.functions.deep import item_decoder
from itemflow.functions.encode import encode_columns, encode_documents
from itemflow.operators.convert import good, quarantined, to_documents, typed_documents
from itemflow.plans.pair import Mapping, Scan
from itemflow.session import work_folder
from itemflow.sinks.export import write_items
from itemflow.sources.items import filter_items, parse_items


def convert(lines, mapping=Mapping()):
    rows = to_documents(parse_items(lines, mapping.depth), mapping)
    out = rows.select("key", F.to_json("doc").alias("doc"), "status", "raw", "field", "reason")
    return [r.asDict() | {"doc": r.doc and json.loads(r.doc)} for r in out.collect()]


def docs(lines, mapping=Mapping()):
    return [r["doc"] for r in convert(lines, mapping)]


ALL_TAGS = {
    "s": {"S": "x"}, "i": {"N": "41"}, "f": {"N": "1.5"}, "w": {"N": "oops"}, "b": {"BOOL": False},
    "z": {"NULL": True}, "ss": {"SS": ["a", "b"]}, "ns": {"NS": ["1", "2.5"]}, "bin": {"B": "aGk="},
    "bs": {"BS": ["aGk="]}, "l": {"L": [{"N": "1"}, {"S": "t"}]}, "el": {"L": []}, "em": {"M": {}},
    "m": {"M": {"zipCode": {"S": "9000"}, "in": {"M": {"deepKey": {"NULL": True}}}}},
}
DECODED = {
    "s": "x", "i": 41, "f": 1.5, "w": "oops", "b": False, "z": None, "ss": ["a", "b"], "ns": [1, 2.5],
    "bin": "aGk=", "bs": ["aGk="], "l": [1, "t"], "el": [], "em": {},
    "m": {"zipCode": "9000", "in": {"deepKey": None}},
}


def test_every_tag(lines):
    assert docs(lines(ALL_TAGS)) == [DECODED]
    decode = item_decoder("preserve", "base64", "double")
    assert {k: decode(v) for k, v in ALL_TAGS.items()} == DECODED


def test_binary_as_text(lines):
    got = docs(lines({"a": {"B": "aGk="}, "b": {"BS": ["aGk="]}}), Mapping(binary="utf8"))
    assert got == [{"a": "hi", "b": ["hi"]}]


def test_key_mapping_and_naming(lines):
    item = {"id": {"S": "u1"}, "userName": {"S": "Ann"}, "homeAddr": {"M": {"zipCode": {"N": "9"}}}}
    rows = convert(lines(item), Mapping(key_source="id", naming="snake_case"))
    assert rows[0]["key"] == "s:u1"
    assert rows[0]["doc"] == {"_id": "u1", "user_name": "Ann", "home_addr": {"zip_code": 9}}


def test_mapped_key_wins_and_missing_source_adds_nothing(lines):
    mapping = Mapping(key_source="id")
    rows = convert(lines({"id": {"N": "1"}, "_id": {"S": "other"}}, {"a": {"S": "x"}}, {"_id": {"S": "own"}}), mapping)
    assert [r["doc"] for r in rows] == [{"_id": 1}, {"a": "x"}, {"_id": "own"}]
    assert [r["key"] for r in rows] == ["n:1", None, "s:own"]


def test_key_target_is_not_renamed(lines):
    rows = convert(lines({"pk": {"S": "a"}, "_x": {"S": "b"}}), Mapping(key_source="pk", key_target="my_key", naming="camelCase"))
    assert rows[0]["doc"] == {"my_key": "a", "X": "b"} and rows[0]["key"] == "s:a"


def test_composite_key(lines):
    mapping = Mapping(key_source=("conv_id", "turn"))
    rows = convert(lines({"conv_id": {"N": "1"}, "turn": {"N": "2"}, "t": {"S": "x"}}, {"conv_id": {"N": "1"}}), mapping)
    assert rows[0]["key"] == 'c:["n:1","n:2"]' and rows[0]["doc"] == {"_id": {"conv_id": 1, "turn": 2}, "t": "x"}
    assert rows[1]["key"] is None and rows[1]["doc"] == {"conv_id": 1}


def test_name_collisions_nested_and_flat(lines):
    item = {"aB": {"N": "2"}, "a_b": {"N": "1"}, "m": {"M": {"xY": {"N": "2"}, "x_y": {"N": "1"}}}}
    assert docs(lines(item), Mapping(naming="snake_case")) == [{"a_b": 1, "m": {"x_y": 1}}]


def nested(levels):
    value = {"N": "1.5"}
    for i in range(levels):
        value = {"L": [value]} if i % 2 else {"M": {"k": value}}
    return {"a": value}


def plain(levels):
    value = 1.5
    for i in range(levels):
        value = [value] if i % 2 else {"k": value}
    return {"a": value}


def test_deeper_than_declared(lines):
    df = lines(nested(3), nested(4), nested(32))
    assert docs(df, Mapping(depth=3)) == [plain(3), plain(4), plain(32)]
    rows = convert(df, Mapping(depth=3, deep=False))
    assert [r["status"] for r in rows] == ["good", "quarantine", "quarantine"]
    assert rows[1]["field"] == "a" and json.loads(rows[1]["raw"])["Item"] == nested(4)


def test_nothing_is_lost(lines):
    bad = [{"x": {"X": "?"}, "ok": {"S": "1"}}, "not json", '{"other":1}', {"n": {"L": [{"Q": 1}]}}, {"n": {}}]
    rows = convert(lines({"a": {"S": "1"}}, *bad))
    assert [r["status"] for r in rows] == ["good"] + ["quarantine"] * 5
    assert [r["reason"] for r in rows[1:]] == [
        "value cannot be decoded", "malformed record", "malformed record", "value cannot be decoded",
        "value cannot be decoded",
    ]
    assert rows[1]["field"] == "x" and rows[2]["raw"] == "not json"


def test_repeated_attribute_name_keeps_last(lines):
    assert docs(lines('{"Item":{"a":{"S":"1"},"a":{"S":"2"}}}')) == [{"a": "2"}]


def test_transforms(lines):
    mapping = Mapping(naming="snake_case", transforms=[
        ("created_at", "datetime"), ("info.price", "decimal128"), ("tags", "array"), ("blob", "object"),
        ("missing", "datetime"), ("blob.when", "datetime"),
    ])
    item = {"createdAt": {"S": "2024-01-02"}, "info": {"M": {"price": {"S": "1.5"}, "n": {"N": "1"}}},
            "tags": {"S": "x"}, "blob": {"S": '{"when":"2024-01-02"}'}}
    assert docs(lines(item), mapping) == [{
        "created_at": "2024-01-02 00:00:00+00:00", "info": {"price": 1.5, "n": 1}, "tags": ["x"],
        "blob": {"when": "2024-01-02 00:00:00+00:00"},
    }]
    bad = item | {"createdAt": {"S": "junk"}}
    row = convert(lines(bad), mapping)[0]
    assert (row["status"], row["field"], row["reason"]) == ("quarantine", "created_at", "transform failed")
    worse = item | {"info": {"M": {"price": {"BOOL": True}}}}
    assert convert(lines(worse), mapping)[0]["field"] == "info"


def test_transform_names_with_dots_and_arrays_are_not_entered(lines):
    mapping = Mapping(transforms=[("a.b", "datetime")])
    item = {"a": {"L": [{"M": {"b": {"S": "junk"}}}]}, "a.b": {"S": "junk"}}
    assert docs(lines(item), mapping) == [{"a": [{"b": "junk"}], "a.b": "junk"}]


def test_good_and_quarantined_split(lines):
    rows = to_documents(parse_items(lines({"a": {"S": "1"}}, "junk")), Mapping())
    assert good(rows).columns == ["key", "doc"] and good(rows).count() == 1
    assert quarantined(rows).collect()[0].raw == "junk"


def test_projection_and_filter(lines):
    df = lines({"a": {"S": "1"}, "n": {"N": "5"}}, {"a": {"S": "2"}, "n": {"N": "7"}}, {"a": {"S": "3"}}, "junk")
    scan = Scan(where="#num > :low AND a <> 'the n of a'", names={"#num": "n"}, values={":low": 5},
                attributes={"n": "double", "a": "string"})
    kept = filter_items(parse_items(df, columns=("a", "n")), scan)
    assert docs_of(kept) == [{"a": "2", "n": 7}, None]
    only = parse_items(df, columns=("a",))
    assert docs_of(only) == [{"a": "1"}, {"a": "2"}, {"a": "3"}, None]


def docs_of(items):
    rows = to_documents(items, Mapping()).select(F.to_json("doc").alias("d")).collect()
    return [r.d and json.loads(r.d) for r in rows]


SCHEMA = ("orderKey bigint, price double, info struct<aB: string, n: int>, at timestamp, tags array<string>, "
          "nums array<double>, flag boolean, m map<string,bigint>, any variant")


def test_typed_documents(lines):
    item = {"orderKey": {"N": "1"}, "price": {"S": "2.5"}, "info": {"M": {"aB": {"S": "x"}, "n": {"N": "3"}}},
            "at": {"N": "1704067200.25"}, "tags": {"SS": ["a"]}, "nums": {"NS": ["1", "2.5"]},
            "flag": {"BOOL": True}, "m": {"M": {"k": {"N": "4"}}}, "any": {"L": [{"N": "1"}]}}
    bad = {"orderKey": {"S": "x"}, "info": {"M": {"n": {"N": "y"}}}, "nums": {"NS": ["1", "z"]}, "price": {"NULL": True},
           "m": {"M": {"k": {"S": "q"}}}}
    mapping = Mapping(key_source="orderKey", naming="snake_case")
    out = typed_documents(lines(item, bad, "junk"), SCHEMA, mapping)
    assert out.columns == ["raw", "_id", "price", "info", "at", "tags", "nums", "flag", "m", "any", "misfits"]
    first, second, third = out.select("*", F.unix_micros("at").alias("us"), F.to_json("any").alias("a")).collect()
    assert (first._1 if hasattr(first, "_1") else first["_id"]) == 1 and first.price == 2.5
    assert first["info"].asDict() == {"a_b": "x", "n": 3} and first.us == 1704067200250000
    assert (first.tags, first.nums, first.flag, first.m, first.a, first.misfits) == (["a"], [1.0, 2.5], True, {"k": 4}, "[1]", "")
    assert second.misfits == "orderKey,info,nums,m" and third.misfits == "*"


def test_encode_columns(spark, lines):
    df = spark.sql("""select 1 as i, 1e22 as d, 'x' as s, true as b, array(1, 2) as l, named_struct('q', 1.5D) as st,
        map('k', 'v') as m, timestamp_ntz'2024-01-02 03:04:05' as t, cast(null as string) as n, cast('hi' as binary) as bin""")
    line = encode_columns(df).first()[0]
    assert json.loads(line) == {"Item": {
        "i": {"N": "1"}, "d": {"N": "1" + "0" * 22}, "s": {"S": "x"}, "b": {"BOOL": True},
        "l": {"L": [{"N": "1"}, {"N": "2"}]}, "st": {"M": {"q": {"N": "1.5"}}}, "m": {"M": {"k": {"S": "v"}}},
        "t": {"S": "2024-01-02T03:04:05Z"}, "n": {"NULL": True}, "bin": {"B": "aGk="},
    }}


def test_encoded_timestamps_are_utc_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        line = encode_columns(spark.sql("select timestamp'2024-01-02 03:04:05.25Z' as t")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert json.loads(line)["Item"]["t"] == {"S": "2024-01-02T03:04:05.250000Z"}


def test_write_items_sets_unencodable_documents_apart(spark, lines):
    mapping = Mapping(transforms=[("when", "datetime")])
    rows = to_documents(parse_items(lines({"a": {"S": "1"}}, {"when": {"S": "2024-01-02"}})), mapping)
    path = work_folder(spark, "export")
    assert [json.loads(r.value) for r in spark.read.text(write_items(rows, path)).collect()] == [{"Item": {"a": {"S": "1"}}}]
    assert "2024-01-02" in spark.read.text(f"{path}/status=quarantine").first().value


JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**63), 2**63 - 1)
    | st.floats(allow_nan=False, allow_infinity=False) | st.text(st.characters(exclude_categories=["Cs"]), max_size=8),
    lambda kids: st.lists(kids, max_size=3) | st.dictionaries(st.text(st.characters(exclude_categories=["Cs"]), max_size=4), kids, max_size=3),
    max_leaves=5,
)


def to_wire(value):
    if value is None:
        return {"NULL": True}
    if isinstance(value, bool):
        return {"BOOL": value}
    if isinstance(value, int):
        return {"N": str(value)}
    if isinstance(value, float):
        return {"N": repr(value)}
    if isinstance(value, str):
        return {"S": value}
    if isinstance(value, list):
        return {"L": [to_wire(v) for v in value]}
    return {"M": {k: to_wire(v) for k, v in value.items()}}


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(st.text(st.characters(exclude_categories=["Cs"]), max_size=4), JSON, max_size=4), min_size=20, max_size=40))
def test_decode_inverts_encode(lines, documents):
    df = lines(*[{k: to_wire(v) for k, v in d.items()} for d in documents])
    rows = to_documents(parse_items(df), Mapping())
    assert [json.loads(r.d) for r in rows.select(F.to_json("doc").alias("d")).collect()] == documents
    back = encode_documents(rows.select("doc"), depth=6).select(F.col("line").alias("raw"))
    again = to_documents(parse_items(back), Mapping())
    assert [json.loads(r.d) for r in again.select(F.to_json("doc").alias("d")).collect()] == documents


@pytest.mark.parametrize("bad", [
    {"naming": "kebab"}, {"key_source": ""}, {"key_source": ()}, {"key_target": ""}, {"transforms": [("", "array")]},
    {"transforms": [("a", "bson")]}, {"binary": "hex"}, {"depth": 9}, {"collection_naming": "x"},
])
def test_mapping_rules(bad):
    with pytest.raises(ValueError):
        Mapping(**bad)
