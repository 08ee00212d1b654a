"""Number text: int64 if it parses, else float64, else not a number."""

from __future__ import annotations

from itemflow.functions.expr import case, variant

# The spellings of integers and floats that count as numbers.
INTEGER = r"^[+-]?[0-9]+$"
FLOAT = (
    r"^[+-]?(?:(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?"
    r"|0[xX](?:[0-9a-fA-F]+[.]?[0-9a-fA-F]*|[.][0-9a-fA-F]+)[pP][+-]?[0-9]+)$"
)
SPECIAL = r"(?i)^(?:[+-]?inf(?:inity)?|nan)$"


def int64(text: str) -> str:
    """BIGINT of an integer literal in range, else NULL (casts alone also trim blanks)."""
    return case((f"{text} rlike r'{INTEGER}'", f"try_cast({text} as bigint)"))


def float64(text: str) -> str:
    """DOUBLE of a float literal, else NULL; a literal too large for float64 is NULL too."""
    value = f"try_cast({text} as double)"
    finite = case((f"abs({value}) < double('infinity')", value))
    special = case(
        (f"lower({text}) = 'nan'", "double('nan')"),
        (f"{text} like '-%'", "double('-infinity')"),
        default="double('infinity')",
    )
    return case((f"{text} rlike r'{FLOAT}'", finite), (f"{text} rlike r'{SPECIAL}'", special))


def number(text: str, wide_numbers: str = "double") -> str:
    """VARIANT of a number text: BIGINT, else DOUBLE, else the text itself.

    ``wide_numbers='decimal'`` keeps integers beyond int64 exact, up to 38 digits.
    """
    ways = [variant(int64(text))]
    if wide_numbers == "decimal":
        wide = case((f"{text} rlike r'{INTEGER}'", f"try_cast({text} as decimal(38,0))"))
        ways.append(variant(wide))
    return f"coalesce({', '.join(ways)}, {variant(float64(text))}, {variant(text)})"


def plain_double(value: str) -> str:
    """Decimal text of a double without an exponent: ``1.0E22`` becomes 22 zeros after a 1."""
    text = f"cast(abs({value}) as string)"
    digits = f"replace(split_part({text}, 'E', 1), '.', '')"
    point = f"(try_cast(split_part({text}, 'E', 2) as int) + 1)"
    moved = case(
        (f"{point} <= 0", f"concat('0.', repeat('0', -{point}), {digits})"),
        (f"{point} >= length({digits})", f"concat({digits}, repeat('0', {point} - length({digits})))"),
        default=f"concat(substr({digits}, 1, {point}), '.', substr({digits}, {point} + 1))",
    )
    unsigned = case((f"contains({text}, 'E')", moved), default=text)
    trimmed = f"trim(trailing '.' from regexp_replace({unsigned}, r'([.][0-9]*?)0+$', '$1'))"
    return case(
        (f"isnan({value}) or abs({value}) = double('infinity')", f"cast({value} as string)"),
        (f"{value} < 0", f"concat('-', {trimmed})"),
        default=trimmed,
    )
