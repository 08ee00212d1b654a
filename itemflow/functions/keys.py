"""Canonical document keys. VARIANT cannot be grouped or joined, so a key is tagged text:
``s:`` strings, ``n:`` numbers (equal integers and floats share one key), ``b:`` booleans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from itemflow.functions.expr import bind, case, get

# Fixed value: whole doubles up to 2^53 are exact integers.
EXACT_DOUBLE = 2**53


def _number_text(value: str) -> str:
    whole = f"{value} = floor({value}) and abs({value}) <= {EXACT_DOUBLE}"
    return case(
        (whole, f"cast(cast({value} as bigint) as string)"), default=f"cast({value} as string)"
    )


def variant_key(value: str) -> str:
    """Key text of a decoded value; SQL NULL for a missing one."""
    text, double = get(value, "string"), get(value, "double")
    return bind(
        f"schema_of_variant({value})",
        lambda kind: case(
            (f"{kind} = 'STRING'", f"concat('s:', {text})"),
            (f"{kind} = 'BIGINT'", f"concat('n:', {text})"),
            (f"{kind} = 'DOUBLE'", f"concat('n:', {bind(double, _number_text)})"),
            (f"{kind} = 'BOOLEAN'", f"concat('b:', {text})"),
            (f"{kind} is not null", f"concat('j:', to_json({value}))"),
        ),
    )


def composite_key(parts: list[str]) -> str:
    """One part as it is; several as a JSON array. NULL when any part is missing."""
    if len(parts) == 1:
        return parts[0]
    return bind(
        f"array({', '.join(parts)})",
        lambda ps: case((f"array_size(array_compact({ps})) = {len(parts)}", f"concat('c:', to_json({ps}))")),
    )


def sequence_key(sequence: Column) -> Column:
    """Text of a sequence number whose order is numeric order; NULL for anything but digits.

    Up to 40 digits stand at a fixed width; longer ones come after them, by their length first.
    """
    digits = F.regexp_replace(F.when(sequence.rlike("^[0-9]+$"), sequence), "^0+(?=[0-9])", "")
    size = F.length(digits)
    long = F.concat(F.lit("~"), F.lpad(size.cast("string"), 10, "0"), digits)
    return F.when(size <= 40, F.lpad(digits, 40, "0")).otherwise(long)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
