"""Queries over items: decode, mapping, transforms, quarantine, encode, scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemflow.functions.encode import encode_documents
from itemflow.functions.expr import VARIANT_MAP
from itemflow.functions.naming import camel_case, snake_case
from itemflow.functions.numbers import number
from itemflow.functions.paths import as_object, get_path, set_path
from itemflow.functions.transforms import text_to_timestamp, to_array, to_decimal, to_object
from itemflow.operators.convert import to_documents, typed_documents
from itemflow.operators.latest import difference, key_collisions
from itemflow.plans.pair import Mapping, Scan
from itemflow.plans.report import scan_counts
from itemflow.session import work_folder
from itemflow.sinks.export import write_items
from itemflow.sources.items import filter_items, parse_items, scan_items
from queries.inputs import field, lines_of, micros, order_columns, order_lines, staged, table

ORDERS = Mapping(key_source="orderKey", naming="snake_case", transforms=(("order_date", "datetime"),))
ORDER_SCHEMA = (
    "orderKey bigint, custKey bigint, orderStatus string, "
    "orderInfo struct<totalPrice double, orderPriority string>, orderDate timestamp"
)


def flat_orders(docs: DataFrame) -> DataFrame:
    return docs.select(
        field("_id", "bigint").alias("_id"),
        field("cust_key", "bigint").alias("cust_key"),
        field("order_status", "string").alias("order_status"),
        field("order_info.total_price", "double").alias("total_price"),
        field("order_info.order_priority", "string").alias("order_priority"),
        F.unix_millis(field("order_date", "timestamp")).alias("order_ms"),
    )


def order_documents(spark: SparkSession, sf_dir: str, mapping: Mapping = ORDERS) -> DataFrame:
    return to_documents(parse_items(order_lines(spark, sf_dir)), mapping)


def migrate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_orders(order_documents(spark, sf_dir))


def migrate_orders_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = typed_documents(order_lines(spark, sf_dir), ORDER_SCHEMA, ORDERS)
    return docs.select(
        "_id", "cust_key", "order_status", "order_info.total_price", "order_info.order_priority",
        F.unix_millis("order_date").alias("order_ms"), "misfits",
    )


def typed_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns with names to change inside arrays, maps and structs of them."""
    inner = F.struct(F.col("o_custkey").alias("custKey"), F.array(F.struct(F.col("o_orderpriority").alias("orderPriority"))).alias("someTags"))
    source = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderKey"), F.array(inner, inner).alias("orderLines"),
        F.create_map(F.lit("firstOne"), inner, F.lit("first_one"), inner, F.lit("zLast"), inner).alias("byName"),
    )
    element = "struct<custKey: bigint, someTags: array<struct<orderPriority: string>>>"
    schema = f"orderKey bigint, orderLines array<{element}>, byName map<string, {element}>"
    docs = typed_documents(lines_of(source), schema, Mapping(key_source="orderKey", naming="snake_case"))
    return docs.select("_id", F.to_json("order_lines").alias("order_lines"), F.to_json("by_name").alias("by_name"), "misfits")


def migrate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through encode, decode and mapping."""
    source = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    docs = to_documents(parse_items(lines_of(source)), Mapping(key_source="doc_id"))
    return docs.select(
        field("_id", "bigint").alias("_id"),
        field("lang", "string").alias("lang"),
        F.length(field("text", "string")).cast("bigint").alias("chars"),
        F.md5(field("text", "string").cast("binary")).alias("text_md5"),
    )


def embedding_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as lists of numbers, read back into typed arrays."""
    source = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    docs = typed_documents(
        lines_of(source), "vec_id bigint, embedding array<double>, label int", Mapping(key_source="vec_id")
    )
    return docs.select(
        "_id", "label", F.size("embedding").cast("bigint").alias("dims"),
        F.get("embedding", F.lit(0)).cast("float").cast("double").alias("first"),
    )


def decode_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items nested 0 to 5 levels deep at declared depth 3, some with an unknown tag."""
    levels = (F.col("o_orderkey") % 6).cast("int")
    leaf = F.when(F.col("o_orderkey") % 7 == 0, F.lit('{"X":')).otherwise(F.lit('{"N":'))
    raw = F.concat(
        F.lit('{"Item":{"id":{"N":"'), F.col("o_orderkey"), F.lit('"},"v":'),
        F.repeat(F.lit('{"M":{"k":'), levels), leaf, F.lit('"'), F.col("o_custkey"), F.lit('"}'),
        F.repeat(F.lit("}}"), levels), F.lit("}}"),
    )
    lines = table(spark, sf_dir, "orders").select(raw.alias("raw"))
    rows = to_documents(parse_items(lines, 3), Mapping(key_source="id", depth=3))
    value = F.to_json(field("v", "variant"))
    return rows.select(
        F.regexp_extract(F.coalesce("raw", F.to_json("doc")), '"(?:_id":|id":[{]"N":")([0-9]+)', 1).cast("bigint").alias("id"),
        "status", "field", "reason",
        F.regexp_extract(value, "([0-9]+)", 1).try_cast("bigint").alias("leaf"),
        (F.length(value) - F.length(F.replace(value, F.lit("k"), F.lit("")))).cast("bigint").alias("levels"),
    )


def nested_lines(spark: SparkSession, sf_dir: str, leaf: Column, *others: Column | str) -> DataFrame:
    """One item for each order: ``v`` holds a leaf below 0 to 6 levels of maps; then other attributes, as text."""
    levels = (F.col("o_orderkey") % 7).cast("int")
    raw = F.concat(
        F.lit('{"Item":{"id":{"N":"'), F.col("o_orderkey"), F.lit('"},"v":'), F.repeat(F.lit('{"M":{"k":'), levels),
        leaf, F.repeat(F.lit("}}"), levels), *others, F.lit("}}"),
    )
    return table(spark, sf_dir, "orders").select(raw.alias("raw"))


def _levels(value: Column) -> Column:
    return (F.length(value) - F.length(F.replace(value, F.lit("k"), F.lit("")))).cast("bigint")


def number_leaf() -> Column:
    return F.concat(F.lit('{"N":"'), F.col("o_custkey"), F.lit('"}'))


def project_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan of two attributes, however deep they nest: no other one is in the documents."""
    secret = F.concat(F.lit(',"secret":{"S":"'), F.col("o_orderpriority"), F.lit('"}'))
    path = staged(spark, nested_lines(spark, sf_dir, number_leaf(), secret), "secret-items")
    docs = to_documents(scan_items(spark, path, Scan(columns=("id", "v"))), Mapping(key_source="id"))
    value = F.to_json(field("v", "variant"))
    return docs.select(
        field("_id", "bigint").alias("_id"), "status", F.size(F.try_variant_get("doc", "$", VARIANT_MAP)).cast("bigint").alias("fields"),
        F.regexp_extract(value, "([0-9]+)", 1).cast("bigint").alias("leaf"), _levels(value).alias("levels"),
    )


def decode_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number texts of all kinds: by themselves, beside a deeply nested value, and nested in it."""
    texts = ("'-7'", "'1.5e2'", "'NaN'", "'-Infinity'", "'1e400'", "'92233720368547758070'", "' 5 '", "'0x1p4'")
    text = F.element_at(F.array(*[F.expr(t) for t in texts]), (F.col("o_orderkey") % 8 + 1).cast("int"))
    number = F.concat(F.lit('{"N":"'), text, F.lit('"}'))
    orders = table(spark, sf_dir, "orders")
    item = F.concat(F.lit('{"Item":{"id":{"N":"'), F.col("o_orderkey"), F.lit('"},"n":'), number)
    alone = orders.select(F.concat(item, F.lit("}}")).alias("raw"))
    beside = orders.select(F.concat(item, F.lit(',"v":'), F.lit('{"L":[' * 6), number, F.lit("]}" * 6), F.lit("}}")).alias("raw"))

    def decoded(lines: DataFrame, path: str, name: str) -> DataFrame:
        docs = to_documents(parse_items(lines), Mapping(key_source="id"))
        value = field(path, "variant")
        return docs.select(
            field("_id", "bigint").alias("_id"), F.lit(name).alias("place"), F.schema_of_variant(value).alias("kind"), F.to_json(value).alias("value")
        )

    deepest = "v" + "[0]" * 6
    return decoded(alone, "n", "alone").unionByName(decoded(beside, "n", "beside")).unionByName(decoded(beside, deepest, "inside"))


def round_trip_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents nested 0 to 6 levels deep to items and back, with nothing declared."""
    leaf = F.concat(F.lit('{"L":['), number_leaf(), F.lit(',{"S":"'), F.col("o_orderpriority"), F.lit('"},{"NULL":true}]}'))
    docs = to_documents(parse_items(nested_lines(spark, sf_dir, leaf)), Mapping(key_source="id"))
    lines = encode_documents(docs.select("doc")).select(F.col("line").alias("raw"))
    again = to_documents(parse_items(lines), Mapping(key_source="_id"))
    value = F.to_json(field("v", "variant"))
    inner = F.from_json(F.regexp_extract(value, r"(\[.*\])", 1), "array<string>")
    return again.select(
        field("_id", "bigint").alias("_id"), "status", inner[0].cast("bigint").alias("number"), inner[1].alias("text"),
        F.size(inner).cast("bigint").alias("elements"), _levels(value).alias("levels"),
    )


def poison_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with something behind the item, and items of which one attribute is wrong beside a deep, good one."""
    kinds = (
        '{"S":"fine"}', '{"S":"a","N":"1"}', '{"S":{"x":1}}', '{"L":{"x":1}}', '{"S":"fine"}', '{"S":"fine"}', '{"N":[5]}', '{"BS":"eA=="}'
    )
    kind = F.col("o_orderkey") % 8
    bad = F.element_at(F.array(*[F.lit(k) for k in kinds]), (kind + 1).cast("int"))
    lines = nested_lines(spark, sf_dir, number_leaf(), F.lit(',"bad":'), bad, F.when(kind == 4, "}} junk").when(kind == 5, '}} {"Item":{').otherwise(""))
    rows = to_documents(parse_items(lines), Mapping(key_source="id"))
    return rows.groupBy("status", "field", "reason").agg(F.count(F.lit(1)).alias("records"), F.count("raw").alias("with_raw"))


def snake_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    name = F.concat(F.col("p_type"), F.lit("_"), F.col("p_brand"), F.initcap("p_name"))
    return part.select("p_partkey", name.alias("n")).select("p_partkey", F.expr(snake_case("n")).alias("name"))


def camel_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    name = F.concat(F.lower("p_type"), F.lit("__"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"))
    return part.select("p_partkey", name.alias("n")).select("p_partkey", F.expr(camel_case("n")).alias("name"))


def number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    text = (
        F.when(F.col("o_orderkey") % 5 == 0, F.col("o_custkey").cast("string"))
        .when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit(" "), F.col("o_custkey"), F.lit(" ")))
        .when(F.col("o_orderkey") % 5 == 2, F.concat(F.col("o_custkey"), F.lit("e2")))
        .when(F.col("o_orderkey") % 5 == 3, F.concat(F.lit("9223372036854775808"), F.col("o_custkey")))
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    value = orders.withColumn("text", text).select("o_orderkey", F.expr(number("text")).alias("n"))
    kind = F.schema_of_variant("n")
    return value.select(
        "o_orderkey", kind.alias("kind"),
        F.when(kind != "STRING", F.try_variant_get("n", "$", "double")).alias("value"),
        F.when(kind == "STRING", F.try_variant_get("n", "$", "string")).alias("text"),
    )


def decimal_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.when(F.col("c_custkey") % 9 == 0, F.lit("x")).otherwise(F.lit("")), F.col("c_acctbal"))
    value = table(spark, sf_dir, "customer").withColumn("text", text.cast("variant")).select(
        "c_custkey", F.expr(to_decimal("text")).alias("d")
    )
    return value.select("c_custkey", F.try_variant_get("d", "$", "double").alias("acctbal"))


def to_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five accepted spellings and two rejected ones."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(day, F.lit("T01:02:03Z")))
        .when(F.col("o_orderkey") % 7 == 1, F.concat(day, F.lit("T01:02:03.5+02:00")))
        .when(F.col("o_orderkey") % 7 == 2, F.concat(day, F.lit(" 01:02:03")))
        .when(F.col("o_orderkey") % 7 == 3, day)
        .when(F.col("o_orderkey") % 7 == 4, (micros("o_orderdate") / 1000000).cast("bigint").cast("string"))
        .when(F.col("o_orderkey") % 7 == 5, F.concat(F.lit("on "), day))
        .otherwise(F.date_format("o_orderdate", "yyyy/MM/dd"))
    )
    dates = table(spark, sf_dir, "orders").withColumn("text", text)
    return dates.select("o_orderkey", F.unix_millis(F.expr(text_to_timestamp("text"))).alias("ms"))


def object_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.expr(to_object("cast(props as variant)")).alias("doc")
    )
    return events.select(
        "event_id", F.try_variant_get("doc", "$.k", "double").alias("k"),
        F.schema_of_variant("doc").alias("shape"),
    )


def array_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON array text is parsed, other text is wrapped."""
    text = F.when(
        F.col("o_orderkey") % 2 == 0, F.concat(F.lit("["), F.col("o_custkey"), F.lit(", "), F.col("o_totalprice"), F.lit("]"))
    ).otherwise(F.col("o_orderpriority"))
    texts = table(spark, sf_dir, "orders").withColumn("text", text.cast("variant"))
    arrays = texts.select(
        "o_orderkey", F.try_variant_get(F.expr(to_array("text")), "$", "array<variant>").alias("a")
    )
    first = F.get("a", F.lit(0))
    return arrays.select(
        "o_orderkey", F.size("a").cast("bigint").alias("n"),
        F.when(F.schema_of_variant(first) == "DOUBLE", F.try_variant_get(first, "$", "double")).alias("number"),
        F.when(F.schema_of_variant(first) == "STRING", F.try_variant_get(first, "$", "string")).alias("text"),
    )


def binary_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary attributes as Base64 text and as the bytes themselves."""
    source = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").cast("binary").alias("blob"))
    lines = lines_of(source)
    as_text = to_documents(parse_items(lines), Mapping(key_source="p_partkey")).select(
        field("_id", "bigint").alias("_id"), field("blob", "string").alias("blob"), F.lit("base64").alias("mode")
    )
    as_bytes = to_documents(parse_items(lines), Mapping(key_source="p_partkey", binary="utf8")).select(
        field("_id", "bigint").alias("_id"), field("blob", "string").alias("blob"), F.lit("utf8").alias("mode")
    )
    return as_text.unionByName(as_bytes)


def filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row filter with bound names and values, then two attributes only."""
    scan = Scan(
        where="#s = :wanted AND price > :low",
        names={"#s": "orderStatus"},
        values={":wanted": "O", ":low": 100000.0},
        attributes={"orderStatus": "string", "price": "double"},
    )
    source = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderKey"), F.col("o_orderstatus").alias("orderStatus"),
        F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("unused"),
    )
    items = filter_items(parse_items(lines_of(source), columns=("orderKey", "orderStatus", "price")), scan)
    docs = to_documents(items, Mapping(key_source="orderKey"))
    fields = F.try_variant_get("doc", "$", VARIANT_MAP)
    return docs.select(
        field("_id", "bigint").alias("_id"), field("orderStatus", "string").alias("status"),
        F.size(fields).cast("bigint").alias("fields"),
    )


def scan_count_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = parse_items(order_lines(spark, sf_dir), columns=("orderStatus",))
    return scan_counts(items, F.try_element_at("item", F.lit("orderStatus"))["S"] == "F")


def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that one another replace under a single-field key and under the full key."""
    source = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    lines = lines_of(source)
    single = to_documents(parse_items(lines), Mapping(key_source="conv_id"))
    both = to_documents(parse_items(lines), Mapping(key_source=("conv_id", "turn")))
    return (
        key_collisions(single).withColumn("key_fields", F.lit("conv_id"))
        .unionByName(key_collisions(both).withColumn("key_fields", F.lit("conv_id,turn")))
    )


def key_collision_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    key = ("l_orderkey", "l_linenumber")
    rows = to_documents(parse_items(lines_of(source), columns=key), Mapping(key_source=key))
    return key_collisions(rows)


def keyless_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a key field are all kept, each under a fresh key."""
    from queries.inputs import document_table

    source = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment")
    target = document_table(spark, "keyless")
    target.write_base(to_documents(parse_items(lines_of(source)), Mapping()), "all")
    target.commit_version("all")
    return target.current().groupBy(
        field("c_nationkey", "bigint").alias("nation"), field("c_mktsegment", "string").alias("segment")
    ).agg(F.count(F.lit(1)).alias("documents"))


def set_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set a field in a new nested object, and find that a parent is no object."""
    fields = F.try_variant_get("doc", "$", VARIANT_MAP).alias("fields")
    docs = order_documents(spark, sf_dir).select(fields)
    priority = get_path("fields", "order_info.order_priority")
    made = docs.select(
        F.expr(get_path("fields", "_id")).try_cast("bigint").alias("_id"),
        F.expr(as_object(set_path("fields", "extra.flags.priority", priority))).alias("made"),
        F.expr(f"{set_path('fields', 'cust_key.x', priority)} is null").alias("clash"),
    )
    return made.select(
        "_id", F.try_variant_get("made", "$.extra.flags.priority", "string").alias("priority"),
        F.try_variant_get("made", "$.order_info.total_price", "double").alias("total_price"), "clash",
    )


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items to documents, back to items, and to documents again."""
    plain = Mapping(key_source="orderKey", naming="snake_case")
    docs = order_documents(spark, sf_dir, plain)
    back = encode_documents(docs.select("doc"), depth=3).select(F.col("line").alias("raw"))
    again = to_documents(parse_items(back), Mapping(transforms=(("order_date", "datetime"),)))
    return flat_orders(again)


def export_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as an export and scanned again."""
    docs = order_documents(spark, sf_dir, Mapping(key_source="orderKey", naming="snake_case"))
    folder = write_items(docs, work_folder(spark, "export"))
    items = scan_items(spark, folder)
    return flat_orders(to_documents(items, Mapping(transforms=(("order_date", "datetime"),))))


def naming_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two attributes that rename to one field: the last in source order wins."""
    source = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("aB"), (F.col("o_orderkey") * 2).alias("a_b")
    )
    docs = to_documents(parse_items(lines_of(source)), Mapping(key_source="id", naming="snake_case"))
    fields = F.try_variant_get("doc", "$", VARIANT_MAP)
    return docs.select(
        field("_id", "bigint").alias("_id"), field("a_b", "bigint").alias("a_b"),
        F.size(fields).cast("bigint").alias("fields"),
    )


def nulls_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit nulls stay fields; they differ from absent ones."""
    source = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("positive")
    )
    docs = to_documents(parse_items(lines_of(source)), Mapping(key_source="id"))
    return docs.select(
        field("_id", "bigint").alias("_id"),
        F.schema_of_variant(field("positive", "variant")).alias("kind"),
        field("absent", "variant").isNull().alias("absent"),
        field("positive", "double").alias("positive"),
    )


def bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of which every eleventh has a date that is none and every 13th no JSON."""
    raw = order_lines(spark, sf_dir)
    key = F.regexp_extract("raw", '"orderKey":[{]"N":"([0-9]+)"', 1).cast("bigint")
    broken = (
        F.when(key % 13 == 0, F.concat(F.lit("broken "), F.col("raw")))
        .when(key % 11 == 0, F.regexp_replace("raw", '"[0-9]{4}-[0-9]{2}-[0-9]{2}T', '"someday T'))
        .otherwise(F.col("raw"))
    )
    return raw.select(broken.alias("raw"))


def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_documents(parse_items(bad_dates(spark, sf_dir)), ORDERS)
    return rows.groupBy("status", "field", "reason").agg(
        F.count(F.lit(1)).alias("records"), F.count("raw").alias("with_raw"), F.count("doc").alias("with_doc")
    )


def state_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that differ between two copies, of which one has changed customers."""
    orders = order_columns(spark, sf_dir)
    moved = orders.withColumn("custKey", F.when(F.col("custKey") % 3 == 0, -F.col("custKey")).otherwise(F.col("custKey")))
    plain = Mapping(key_source="orderKey")
    left = to_documents(parse_items(lines_of(orders)), plain)
    right = to_documents(parse_items(lines_of(moved)), plain)
    return difference(left, right).groupBy("side").agg(F.sum("n").alias("documents"))


QUERIES = {
    "migrate_orders": migrate_orders,
    "migrate_orders_typed": migrate_orders_typed,
    "typed_nested": typed_nested,
    "project_deep": project_deep,
    "decode_both_ways": decode_both_ways,
    "round_trip_deep": round_trip_deep,
    "poison_items": poison_items,
    "migrate_documents": migrate_documents,
    "embedding_items": embedding_items,
    "decode_guard": decode_guard,
    "snake_case": snake_case_names,
    "camel_case": camel_case_names,
    "number_parse": number_parse,
    "decimal_transform": decimal_transform,
    "to_datetime": to_datetime,
    "to_object": object_transform,
    "to_array": array_transform,
    "binary_values": binary_values,
    "filter_project": filter_project,
    "scan_counts": scan_count_pair,
    "composite_key": composite_key,
    "key_collisions": key_collision_report,
    "keyless_insert": keyless_insert,
    "set_nested": set_nested,
    "round_trip": round_trip,
    "export_items": export_items,
    "naming_collision": naming_collision,
    "nulls_kept": nulls_kept,
    "quarantine_split": quarantine_split,
    "state_difference": state_difference,
}
