"""Typed attribute values: schema and native decode to VARIANT.

A value is an object with one tag (``S N BOOL NULL B SS NS BS L M``). Catalyst has no
recursion, so the decode expression is unrolled to a declared depth while the plan is
built. Inside it SQL NULL means "could not decode" (an explicit null is a VARIANT null), and
a container holding such a value becomes SQL NULL itself: unknown tags, malformed values and
values below the declared depth all surface at the top of the item without a second pass.
"""

from __future__ import annotations

from itemflow.functions.expr import (
    NO_VALUE,
    NULL_VARIANT,
    all_distinct,
    bind,
    case,
    fn,
    has_null,
    variant,
)
from itemflow.functions.naming import rename
from itemflow.functions.numbers import number

DEFAULT_DEPTH = 3
BINARY_MODES = ("base64", "utf8")


def av_type(depth: int = DEFAULT_DEPTH) -> str:
    """DDL of one attribute value whose containers may nest ``depth`` levels."""
    if depth > 0:
        inner = av_type(depth - 1)
        nested = f"L array<{inner}>, M map<string,{inner}>"
    else:
        nested = "L variant, M variant"
    return (
        "struct<S string, N string, BOOL boolean, `NULL` boolean, B string, "
        f"SS array<string>, NS array<string>, BS array<string>, {nested}>"
    )


def av_map_type(depth: int = DEFAULT_DEPTH) -> str:
    return f"map<string,{av_type(depth)}>"


def decode_value(
    av: str,
    depth: int = DEFAULT_DEPTH,
    naming: str = "preserve",
    binary: str = "base64",
    wide_numbers: str = "double",
) -> str:
    """VARIANT of an attribute value; SQL NULL when it cannot be decoded natively."""

    def numeric(text: str) -> str:
        return number(text, wide_numbers)

    def blob(text: str) -> str:
        # Exports hold Base64 text; utf8 gives the bytes themselves as a string.
        # Bytes that are no UTF-8 become the replacement character, text that is no Base64 fails its row.
        return text if binary == "base64" else f"make_valid_utf8(cast(try_to_binary({text}, 'base64') as string))"

    alike = (("S", "N", "B"), ("BOOL", "NULL"), ("SS", "NS", "BS"), ("L",), ("M",))

    # Branches are asked in turn, so a value that reaches one has none of the tags asked before.
    def alone(av: str, asked: list[str], *tags: str) -> str:
        groups = [[f"{av}.`{t}`" for t in group if t not in asked and t not in tags] for group in alike]
        if "M" in tags:
            groups.append([f"if({av}.M is not null, {av}.L, null)"])
        return " and ".join(f"{g[0] if len(g) == 1 else f'coalesce({chr(44).join(g)})'} is null" for g in groups if g) or "true"

    def level(av: str, depth: int) -> str:
        branches: list[tuple[str, str]] = []
        asked: list[str] = []

        def branch(value: str, *tags: str) -> None:
            found = " or ".join(f"{av}.`{t}` is not null" for t in tags)
            branches.append((found, case((alone(av, asked, *tags), value))))
            asked.extend(tags)

        branch(variant(f"{av}.S"), "S")
        branch(numeric(f"{av}.N"), "N")
        if depth > 0:
            children = f"coalesce(map_values({av}.M), {av}.L)"
            decoded = f"transform({children}, {fn(lambda child: level(child, depth - 1))})"
            branch(bind(decoded, lambda kids: _container(av, kids, naming)), "M", "L")
        branch(variant(f"{av}.BOOL"), "BOOL")
        branch(NULL_VARIANT, "NULL")
        branch(variant(f"{av}.SS"), "SS")
        branch(variant(f"transform({av}.NS, {fn(numeric)})"), "NS")
        branch(variant(blob(f"{av}.B")), "B")
        branch(bind(f"transform({av}.BS, {fn(blob)})", _all_or_none), "BS")
        return case(*branches)

    return level(av, depth)


def _all_or_none(values: str) -> str:
    return case((has_null(values), NO_VALUE), default=variant(values))


def _container(av: str, kids: str, naming: str) -> str:
    names = f"map_keys({av}.M)"
    if naming != "preserve":
        names = f"transform({names}, {fn(lambda n: rename(n, naming))})"
    # Names that meet after renaming are left to the Arrow path, like values nested too deep.
    as_object = bind(
        names,
        lambda ns: case((all_distinct(ns), f"to_variant_object(map_from_arrays({ns}, {kids}))")),
    )
    return case(
        (has_null(kids), NO_VALUE), (f"{av}.M is not null", as_object), default=variant(kids)
    )


def decode_map(item: str, depth: int = DEFAULT_DEPTH, **options: str) -> str:
    """MAP<STRING, VARIANT> of an item; attributes that cannot be decoded hold SQL NULL."""
    return f"transform_values({item}, {fn(lambda _, av: decode_value(av, depth, **options), 2)})"


def is_complete(item: str, decoded: str) -> str:
    """True when every attribute was decoded and no attribute name repeats."""
    return f"(not {has_null(f'map_values({decoded})')} and {all_distinct(f'map_keys({item})')})"
