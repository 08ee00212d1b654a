"""Function tables: literal inputs and the outputs the rules demand."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from itemflow.functions import naming, numbers, paths, transforms
from itemflow.functions.expr import VARIANT_MAP
from itemflow.functions.keys import composite_key, sequence_key, variant_key


def column(df, expr):
    expr = F.expr(expr) if isinstance(expr, str) else expr
    return [r[0] for r in df.select(expr.alias("o"), "i").orderBy("i").collect()]


def variant(text):
    return f"try_parse_json({text})"


def shown(df, expr):
    """JSON text and type of a VARIANT result; None for SQL NULL."""
    expr = F.expr(expr)
    rows = df.select(F.to_json(expr).alias("j"), F.schema_of_variant(expr).alias("t"), "i")
    return [(r.j, r.t) if r.t is not None else None for r in rows.orderBy("i").collect()]


def test_number(values):
    df = values("12", "1.0", "1e5", "9223372036854775808", "abc", "1e400", " 7 ", "1d", "-3", "+4", ".5", "0x1p-2")
    assert shown(df, numbers.number("v")) == [
        ("12", "BIGINT"), ("1.0", "DOUBLE"), ("100000.0", "DOUBLE"), ("9.223372036854776E18", "DOUBLE"),
        ('"abc"', "STRING"), ('"1e400"', "STRING"), ('" 7 "', "STRING"), ('"1d"', "STRING"),
        ("-3", "BIGINT"), ("4", "BIGINT"), ("0.5", "DOUBLE"), ("0.25", "DOUBLE"),
    ]


def test_wide_number(values):
    got = shown(values("9223372036854775808", "5"), numbers.number("v", "decimal"))
    assert got == [("9223372036854775808", "DECIMAL(19,0)"), ("5", "BIGINT")]


def test_plain_double(values):
    df = values("1e22", "1.5", "-0.001", "1e-10", "123456789.25", "5", "-1.25e21", "0")
    assert column(df, numbers.plain_double("cast(v as double)")) == [
        "1" + "0" * 22, "1.5", "-0.001", "0.0000000001", "123456789.25", "5", "-125" + "0" * 19, "0",
    ]


NAMES = ["userName", "HTTPServer", "user_ID", "Abc", "_id", "user_name", "a__b_", "abc", ""]


def test_naming(values):
    snake = ["user_name", "h_t_t_p_server", "user__i_d", "abc", "_id", "user_name", "a__b_", "abc", ""]
    camel = ["userName", "HTTPServer", "userID", "Abc", "Id", "userName", "aB", "abc", ""]
    assert column(values(*NAMES), naming.snake_case("v")) == snake
    assert column(values(*NAMES), naming.camel_case("v")) == camel
    assert [naming.rename_text(n, "snake_case") for n in NAMES] == snake
    assert [naming.rename_text(n, "camelCase") for n in NAMES] == camel
    assert [naming.rename_text(n, "preserve") for n in NAMES] == NAMES


@pytest.mark.parametrize("fields,expected", [
    ({"aB": 2, "a_b": 1}, {"a_b": 1}),
    ({"a_b": 1, "aB": 2, "c": 3}, {"a_b": 1, "c": 3}),
    ({"x": 1}, {"x": 1}),
])
def test_rename_keys_keeps_last_in_source_order(spark, fields, expected):
    df = spark.createDataFrame([(fields,)], "m map<string,int>")
    assert df.select(F.expr(naming.rename_keys("m", "snake_case"))).first()[0] == expected


def utc(*parts):
    return dt.datetime(*parts)


def test_text_to_timestamp(values):
    cases = {
        "2024-01-02T03:04:05Z": utc(2024, 1, 2, 3, 4, 5),
        "2024-01-02T03:04:05.5+02:00": utc(2024, 1, 2, 1, 4, 5, 500000),
        "2024-01-02T03:04:05,25Z": utc(2024, 1, 2, 3, 4, 5, 250000),
        "2024-01-02T03:04:05.123456789Z": utc(2024, 1, 2, 3, 4, 5, 123456),
        "2024-01-02 03:04:05": utc(2024, 1, 2, 3, 4, 5),
        "2024-01-02": utc(2024, 1, 2),
        "2024": utc(1970, 1, 1, 0, 33, 44),
        "1704067200": utc(2024, 1, 1),
        "-1": utc(1969, 12, 31, 23, 59, 59),
        "2024-1-2": None, "2024-02-30": None, "junk": None, "2024-01-02T03:04:05": None, "": None,
        "9223372036854775807": None,
    }
    got = column(values(*cases), F.date_format(F.expr(transforms.text_to_timestamp("v")), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    want = [None if v is None else v.strftime("%Y-%m-%d %H:%M:%S.%f") for v in cases.values()]
    assert got == want


def test_text_to_timestamp_ignores_session_zone(spark, values):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = values("2024-01-02", "2024-01-02 00:00:00", "2024-01-02T00:00:00Z")
        got = column(df, F.unix_millis(F.expr(transforms.text_to_timestamp("v"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [1704153600000] * 3


def test_to_datetime(values):
    df = values('"2024-01-02"', "1704067200", "1.70406720025E9", "true", "null", "[1]", '"junk"')
    got = shown(df, transforms.to_datetime(variant("v")))
    assert got == [
        ('"2024-01-02 00:00:00+00:00"', "TIMESTAMP"), ('"2024-01-01 00:00:00+00:00"', "TIMESTAMP"),
        ('"2024-01-01 00:00:00.25+00:00"', "TIMESTAMP"), None, ("null", "VOID"), None, None,
    ]


def test_to_decimal(values):
    df = values('"1.50"', "7", '"x"', "true", "null", "1.5E0", '"12"')
    assert shown(df, transforms.to_decimal(variant("v"))) == [
        ("1.5", "DOUBLE"), ("7", "BIGINT"), None, None, ("null", "VOID"), ("1.5", "DOUBLE"), ("12.0", "DOUBLE"),
    ]
    exact = shown(values('"1.50"'), transforms.to_decimal(variant("v"), exact=True))
    assert exact[0][1].startswith("DECIMAL")


def test_to_array(values):
    df = values("[1]", '"[1,2]"', '"x"', '"true"', "5", '"null"', "null", '"{}"', '{"a":1}')
    assert shown(df, transforms.to_array(variant("v"))) == [
        ("[1]", "ARRAY<BIGINT>"), ("[1.0,2.0]", "ARRAY<DOUBLE>"), ('["x"]', "ARRAY<STRING>"),
        ('["true"]', "ARRAY<STRING>"), ("[5]", "ARRAY<BIGINT>"), ("null", "VOID"), ("null", "VOID"),
        ('["{}"]', "ARRAY<STRING>"), ('[{"a":1}]', "ARRAY<OBJECT<a: BIGINT>>"),
    ]


def test_to_object(values):
    df = values('{"a":1}', json.dumps('{"a":1}'), '"[1]"', '"x"', "5", '"null"', "null")
    assert shown(df, transforms.to_object(variant("v"))) == [
        ('{"a":1}', "OBJECT<a: BIGINT>"), ('{"a":1.0}', "OBJECT<a: DOUBLE>"), None, None, None,
        ("null", "VOID"), ("null", "VOID"),
    ]


def test_json_text_numbers_become_doubles(values):
    texts = ['[1,-2,3e2,1.5E-3,"4","a, 5, \\" 6 \\\\"]', '{"a":{"b":[10, 20]}, "c":"1"}', "[1] x", "[12345678901234567890123]"]
    got = shown(values(*texts), transforms.parse_json_text("v"))
    assert json.loads(got[0][0]) == [1.0, -2.0, 300.0, 0.0015, "4", 'a, 5, " 6 \\']
    assert got[1][1] == "OBJECT<a: OBJECT<b: ARRAY<DOUBLE>>, c: STRING>"
    assert got[2] is None
    assert got[3][1] == "ARRAY<DOUBLE>"


def test_transform_passes_split_on_prefix():
    got = transforms.passes([("a", "object"), ("b", "array"), ("a.x", "datetime"), ("ab", "array")])
    assert got == [{"a": "object", "b": "array"}, {"a.x": "datetime", "ab": "array"}]


def as_fields(text):
    return f"try_variant_get(try_parse_json({text}), '$', '{VARIANT_MAP}')"


def test_get_path(values):
    df = values('{"a":{"b":{"c":7}}}', '{"a":[1]}', '{"a":{"b":null}}', '{"a.b":1}')
    assert column(df, f"to_json({paths.get_path(as_fields('v'), 'a.b')})") == ['{"c":7}', None, "null", None]


def test_set_path(values):
    df = values('{"a":1}', '{"n":1}', '{"n":{"c":5,"d":6}}', '{"n":{"c":{"z":1}}}')
    got = column(df, f"to_json(to_variant_object({paths.set_path(as_fields('v'), 'n.c', 'cast(2 as variant)')}))")
    assert [g and json.loads(g) for g in got] == [
        {"a": 1, "n": {"c": 2}}, None, {"n": {"c": 2, "d": 6}}, {"n": {"c": 2}},
    ]


def test_sequence_key(values):
    numbers = ["99", "100000000000000000001", "100", "0" * 50 + "7", "9" * 40, "1" + "0" * 40, "2" + "0" * 40, "1" * 60]
    got = column(values(*numbers), sequence_key(F.col("v")))
    assert sorted(numbers, key=int) == [n for _, n in sorted(zip(got, numbers, strict=True))]
    assert column(values("x12y", "", "1.5", "-1", None), sequence_key(F.col("v"))) == [None] * 5


def test_keys(values):
    df = values('"abc"', "5", "5.0E0", "5.5E0", "true", "null", '{"b":1,"a":2}', '"5"')
    assert column(df, variant_key(variant("v"))) == [
        "s:abc", "n:5", "n:5", "n:5.5", "b:true", "j:null", 'j:{"a":2,"b":1}', "s:5",
    ]
    two = composite_key([variant_key(variant("v")), "'s:x'"])
    assert column(values('"abc"', "oops"), two) == ['c:["s:abc","s:x"]', None]
