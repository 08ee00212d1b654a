"""Small pieces of Spark SQL shared by the function modules.

The functions of this package take and return Spark SQL expression text; ``F.expr`` turns a
finished text into a Column. A decode expression has some thousand nodes, and one text costs
one call into the JVM where Column objects would cost one per node.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

VARIANT_MAP = "map<string,variant>"
NULL_VARIANT = "parse_json('null')"  # an explicit null value, distinct from SQL NULL
NO_VALUE = "cast(null as variant)"  # SQL NULL: the error marker in decode and transforms

_fresh = count()


def lit(text: str) -> str:
    """String literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(identifier: str) -> str:
    """Quoted identifier."""
    return "`" + identifier.replace("`", "``") + "`"


def fn(body: Callable[..., str], arguments: int = 1) -> str:
    """Lambda with fresh variable names."""
    variables = [f"v{next(_fresh)}" for _ in range(arguments)]
    listed = ", ".join(variables)
    return f"{f'({listed})' if arguments > 1 else listed} -> {body(*variables)}"


def bind(value: str, body: Callable[[str], str]) -> str:
    """Evaluate ``value`` once and hand it to ``body``.

    A text used twice is computed twice; as the start of an ``aggregate`` over nothing it keeps recursive
    expressions linear in depth instead of doubling per level. A one-element ``transform`` would do the same, but
    Spark copies what it returns, whole documents once per level.
    """
    same = fn(lambda kept, _: kept, 2)
    return f"aggregate(array(), {value}, {same}, {fn(body)})"


def case(*branches: tuple[str, str], default: str | None = None) -> str:
    whens = " ".join(f"when {condition} then {value}" for condition, value in branches)
    return f"(case {whens}{'' if default is None else f' else {default}'} end)"


def variant(value: str) -> str:
    return f"cast({value} as variant)"


def get(value: str, ddl: str) -> str:
    """A VARIANT as a type; NULL when it does not fit."""
    return f"try_variant_get({value}, '$', '{ddl}')"


def has_null(values: str) -> str:
    return f"exists({values}, {fn(lambda v: f'{v} is null')})"


def all_distinct(values: str) -> str:
    return f"size(array_distinct({values})) = size({values})"


def once(value: Column | str) -> Column:
    """Keep ``value`` in its own projection.

    Catalyst pushes a filter below the projection that computes its columns by copying their
    expressions, which would parse and convert every record twice. It leaves projections with
    a nondeterministic part where they are; the partition number is the cheapest such part.
    """
    column = F.expr(value) if isinstance(value, str) else value
    return F.when(F.spark_partition_id() >= 0, column)
