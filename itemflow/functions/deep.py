"""Arrow path for the few values the native expressions leave: deeper nesting, repeated names, doubtful lines."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from itemflow.functions.expr import VARIANT_MAP
from itemflow.functions.naming import renamer
from itemflow.functions.numbers import FLOAT, INTEGER, SPECIAL
from itemflow.functions.variants import variant_reader, variant_writer

BAD_VALUE = (ValueError, KeyError, TypeError, AttributeError, RecursionError)


def item_decoder(naming: str, binary: str, wide_numbers: str) -> Callable[[dict], object]:
    """Function from one attribute value to the Python value it stands for; the same values as the native decode gives.

    It raises on an unknown tag, on more than one and on a body of another kind than its tag's. Everything it uses is
    local to it, so that it travels to the tasks whole and they need not have this package.
    """
    is_int, is_float, is_special = re.compile(INTEGER), re.compile(FLOAT), re.compile(SPECIAL)
    int64, infinity = range(-(2**63), 2**63), float("inf")
    rename, wide = renamer(naming), wide_numbers == "decimal"

    def text(body: object) -> str:
        if not isinstance(body, str):
            raise ValueError("no text")
        return body

    def number(body: object) -> object:
        body = text(body)
        if is_int.match(body) and body.isascii():
            if int(body) in int64:
                return int(body)
            if wide and len(body.lstrip("+-0")) <= 38:
                return Decimal(int(body))
        if is_float.match(body) and body.isascii():
            value = float.fromhex(body) if "x" in body.lower() else float(body)
            return body if abs(value) == infinity else value
        return float(body) if is_special.match(body) else body

    def blob(body: object) -> str:
        if binary == "base64":
            return text(body)
        return base64.b64decode(text(body)).decode("utf-8", "replace")

    def one(av: dict) -> object:
        (tag, body), *more = av.items() if len(av) == 1 else [(t, b) for t, b in av.items() if b is not None]
        if more:
            raise ValueError("more than one tag")
        if body is None:
            raise ValueError("no body")
        if tag == "S":
            return text(body)
        if tag == "N":
            return number(body)
        if tag in ("BOOL", "NULL") and isinstance(body, bool):
            return body if tag == "BOOL" else None
        if tag == "B":
            return blob(body)
        if tag == "M":
            # Of names that meet after renaming the last in source order stays.
            return {rename(k): one(body[k]) for k in sorted(body)}
        each = {"L": one, "SS": text, "NS": number, "BS": blob}[tag]
        if not isinstance(body, list):
            raise ValueError("no list")
        return [each(b) for b in body]

    return one


def decode_deep(
    raw: Column,
    names: Column,
    path: tuple[str, ...],
    naming: str = "preserve",
    binary: str = "base64",
    wide_numbers: str = "double",
) -> tuple[Column, Column]:
    """MAP<STRING, VARIANT> of the attributes ``names`` of a raw record, and the names that cannot be decoded.

    One of the two is NULL; both are for a NULL record, which costs nothing. ``path`` leads from the record to
    the item inside it. Attributes that a scan leaves out are not among ``names``, and never looked at.
    """
    decode_value, write, bad_value = item_decoder(naming, binary, wide_numbers), variant_writer(), BAD_VALUE

    @F.pandas_udf("variant")
    def decode(texts: pd.Series, wanted: pd.Series) -> pd.Series:
        def one(text: str | None, wanted: object) -> object:
            if text is None:
                return None
            try:
                value = json.loads(text)
                for name in path:
                    value = value[name]
                good, bad = {}, []
                for key in sorted(set(wanted) & value.keys()):
                    try:
                        good[key] = decode_value(value[key])
                    except bad_value:
                        bad.append(key)
                return write({"bad": ",".join(bad)} if bad else {"good": good})
            except bad_value:
                return write({"bad": "*"})

        return pd.Series([one(t, w) for t, w in zip(texts, wanted, strict=True)], dtype=object)

    made = decode(raw, names)
    return F.try_variant_get(made, "$.good", VARIANT_MAP), F.try_variant_get(made, "$.bad", "string")


def value_encoder() -> Callable[[object], dict]:
    """Function from a Python value to its attribute value; it raises for a type without a tag. Local as a whole."""

    def number(value: object) -> str:
        if isinstance(value, float):
            if value != value or abs(value) == float("inf"):
                return "NaN" if value != value else "Infinity" if value > 0 else "-Infinity"
            return format(Decimal(repr(value)).normalize(), "f") if value else "0"
        return format(value, "f") if isinstance(value, Decimal) else str(value)

    def one(value: object) -> dict:
        if value is None:
            return {"NULL": True}
        if isinstance(value, bool):
            return {"BOOL": value}
        if isinstance(value, str):
            return {"S": value}
        if isinstance(value, (int, float, Decimal)):
            return {"N": number(value)}
        if isinstance(value, dict):
            return {"M": {k: one(v) for k, v in value.items()}}
        if isinstance(value, list):
            return {"L": [one(v) for v in value]}
        raise TypeError("no tag for this type")

    return one


def encode_deep(value: Column) -> Column:
    """VARIANT attribute value of a VARIANT of any depth; NULL if something in it has no tag. NULL costs nothing."""
    encode_value, read, write, bad_value = value_encoder(), variant_reader(), variant_writer(), BAD_VALUE

    @F.pandas_udf("variant")
    def encode(values: pd.Series) -> pd.Series:
        def one(value: object) -> object:
            try:
                return None if value is None else write(encode_value(read(value)))
            except bad_value:
                return None

        return pd.Series([one(v) for v in values], dtype=object)

    return encode(value)
