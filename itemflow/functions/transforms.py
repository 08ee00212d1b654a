"""Typed field transforms on VARIANT values: datetime, decimal128, array, object.

Every function maps a VARIANT to a VARIANT. An explicit null passes through; SQL NULL is the
result for a value that cannot be converted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from itemflow.functions.expr import bind, case, fn, get, variant
from itemflow.functions.numbers import float64, int64
from itemflow.functions.paths import as_map, field, update_paths

# The accepted date-time spellings; zone-less text is UTC.
RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.,][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
BLANK_SEPARATED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.,][0-9]+)?$"
DATE_ONLY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# Fixed value: the largest second count that a microsecond timestamp holds.
MAX_SECONDS = 9223372036854
# Numbers that DECIMAL(38,18) holds as they are written.
EXACT = r"^[+-]?(?=[.]?[0-9])[0-9]*(?:[.][0-9]{0,18}0*)?$"
# Fixed value: name of the field behind a text that is read as JSON.
AFTER = "after the value"
# An escaped backslash and quote, and their spelling by code point.
BACKSLASH = ("r'\\\\'", "r'\\u005c'")
QUOTE = ("r'\\\"'", "r'\\u0022'")


def in_range(seconds: str) -> str:
    return f"{seconds} between -{MAX_SECONDS} and {MAX_SECONDS}"


def text_to_timestamp(text: str) -> str:
    """TIMESTAMP of date-time text or of integer Unix seconds; NULL for anything else."""
    dotted = f"replace({text}, ',', '.')"
    seconds = int64(text)
    return case(
        (f"{text} rlike r'{RFC3339}'", f"try_cast({dotted} as timestamp)"),
        (f"{text} rlike r'{BLANK_SEPARATED}'", f"try_cast(concat({dotted}, 'Z') as timestamp)"),
        (f"{text} rlike r'{DATE_ONLY}'", f"try_cast(concat({text}, 'T00:00:00Z') as timestamp)"),
        (in_range(seconds), f"timestamp_seconds({seconds})"),
    )


def text_to_double(text: str) -> str:
    """DOUBLE of numeric text, integers included."""
    return float64(text)


def by_kind(value: str, body: Callable[[str], str]) -> str:
    return bind(f"schema_of_variant({value})", body)


def to_datetime(value: str) -> str:
    seconds, fraction = get(value, "bigint"), get(value, "double")
    return by_kind(
        value,
        lambda kind: case(
            (f"{kind} = 'VOID'", value),
            (f"{kind} = 'STRING'", variant(bind(get(value, "string"), text_to_timestamp))),
            (f"{kind} = 'BIGINT' and {in_range(seconds)}", variant(f"timestamp_seconds({seconds})")),
            (f"{kind} = 'DOUBLE' and {in_range(fraction)}", variant(f"timestamp_seconds({fraction})")),
        ),
    )


def to_decimal(value: str, exact: bool = False) -> str:
    """Numeric text becomes DOUBLE (DECIMAL(38,18) when ``exact``); numbers stay as they are.

    ``exact`` never rounds: text with more digits before or after the point than the type holds fails,
    and so does text with an exponent, whose digits are not all written out.
    """

    def parsed(text: str) -> str:
        if exact:
            return case((f"{text} rlike r'{EXACT}'", f"try_cast({text} as decimal(38,18))"))
        return float64(text)

    return by_kind(
        value,
        lambda kind: case(
            (f"{kind} = 'STRING'", variant(bind(get(value, "string"), parsed))),
            (f"{kind} in ('VOID', 'BIGINT', 'DOUBLE', 'FLOAT') or {kind} like 'DECIMAL%'", value),
        ),
    )


def parse_json_text(text: str) -> str:
    """VARIANT of JSON text in which every number is a DOUBLE; NULL if it is not JSON.

    Escaped quotes and backslashes are spelled by code point first, so that the pieces
    between quotes alternate between outside and inside a string; numbers outside get an
    exponent, which makes the parser read them as doubles. The parser ignores what follows
    a complete value, so the text is read as one field of an object with a field behind it.
    """
    plain = f"replace(replace({text}, {BACKSLASH[0]}, {BACKSLASH[1]}), {QUOTE[0]}, {QUOTE[1]})"

    def piece(part: str, i: str) -> str:
        number = r"(?<![0-9.eE+-])(-?[0-9]+(?:[.][0-9]+)?)(?![0-9.eE])"
        return case((f"{i} % 2 = 0", f"regexp_replace({part}, r'{number}', '$1E0')"), default=part)

    pieces = f"transform(split({plain}, '\"', -1), {fn(piece, 2)})"
    framed = f"""concat('{{"v":', array_join({pieces}, '"'), ',"{AFTER}":0}}')"""
    return bind(
        as_map(f"try_parse_json({framed})"),
        lambda m: case((f"size({m}) = 2 and {field(m, AFTER)} is not null", field(m, "v"))),
    )


def to_array(value: str) -> str:
    """Arrays stay, JSON array text is parsed, anything else is wrapped."""
    wrapped = variant(f"array({value})")

    def from_text(parsed: str) -> str:
        kind = f"schema_of_variant({parsed})"
        return case((f"{kind} like 'ARRAY%' or {kind} = 'VOID'", parsed), default=wrapped)

    return by_kind(
        value,
        lambda kind: case(
            (f"{kind} like 'ARRAY%' or {kind} = 'VOID'", value),
            (f"{kind} = 'STRING'", bind(parse_json_text(get(value, "string")), from_text)),
            (f"{kind} is not null", wrapped),
        ),
    )


def to_object(value: str) -> str:
    """Objects stay, JSON object text is parsed, anything else cannot be converted."""

    def from_text(parsed: str) -> str:
        kind = f"schema_of_variant({parsed})"
        return case((f"{kind} like 'OBJECT%' or {kind} = 'VOID'", parsed))

    return by_kind(
        value,
        lambda kind: case(
            (f"{kind} like 'OBJECT%' or {kind} = 'VOID'", value),
            (f"{kind} = 'STRING'", bind(parse_json_text(get(value, "string")), from_text)),
        ),
    )


TRANSFORMS: dict[str, Callable[[str], str]] = {
    "datetime": to_datetime,
    "decimal128": to_decimal,
    "array": to_array,
    "object": to_object,
}


def transform_value(value: str, kind: str, exact_decimals: bool = False) -> str:
    if kind == "decimal128":
        return to_decimal(value, exact_decimals)
    return TRANSFORMS[kind](value)


def passes(transforms: Sequence[tuple[str, str]]) -> list[dict[str, str]]:
    """Split a transform list into groups that can run as one expression.

    The list order matters only where one path is another's prefix (or the same path).
    """
    groups: list[dict[str, str]] = []
    for path, kind in transforms:
        clash = groups and any(
            (path + ".").startswith(other + ".") or (other + ".").startswith(path + ".")
            for other in groups[-1]
        )
        if not groups or clash:
            groups.append({})
        groups[-1][path] = kind
    return groups


def apply_transforms(fields: str, group: dict[str, str], exact_decimals: bool = False) -> str:
    """One group of ``passes`` applied to a MAP<STRING, VARIANT>; failed fields become SQL NULL."""
    return update_paths(
        fields,
        {
            path: (lambda value, kind=kind: transform_value(value, kind, exact_decimals))
            for path, kind in group.items()
        },
    )
