"""Field naming: preserve, snake_case, camelCase."""

from __future__ import annotations

import re
from collections.abc import Callable

from itemflow.functions.expr import all_distinct, bind, case, fn

NAMINGS = ("preserve", "snake_case", "camelCase")


def snake_case(text: str) -> str:
    """An underscore before every ASCII capital but a leading one, then lower case."""
    return f"lower(regexp_replace({text}, r'(?s)(?<=.)([A-Z])', '_$1'))"


def camel_case(text: str) -> str:
    """Join the parts between underscores, raising the first letter of all but the first."""
    parts = f"split({text}, '_', -1)"
    raised = fn(lambda p: f"concat(upper(left({p}, 1)), substr({p}, 2))")
    return f"concat({parts}[0], array_join(transform(slice({parts}, 2, size({parts})), {raised}), ''))"


def rename(text: str, naming: str) -> str:
    if naming == "snake_case":
        return snake_case(text)
    if naming == "camelCase":
        return camel_case(text)
    return text


def renamer(naming: str) -> Callable[[str], str]:
    """The same rule as a Python function that carries all it needs, so tasks can run it."""
    capital = re.compile(r"(?s)(?<=.)([A-Z])")

    def snake(text: str) -> str:
        return capital.sub(r"_\1", text).lower()

    def camel(text: str) -> str:
        first, *tail = text.split("_")
        return first + "".join(p[:1].upper() + p[1:] for p in tail)

    def preserve(text: str) -> str:
        return text

    return {"snake_case": snake, "camelCase": camel}.get(naming, preserve)


def rename_text(text: str, naming: str) -> str:
    """Rename a name known while the plan is built."""
    return renamer(naming)(text)


def rename_keys(fields: str, naming: str) -> str:
    """Rename the keys of a map. Of fields meeting in one name the last in source order stays."""
    if naming == "preserve":
        return fields

    def renamed(m: str) -> str:
        return bind(
            f"transform(map_keys({m}), {fn(lambda k: rename(k, naming))})",
            lambda names: case(
                (all_distinct(names), f"map_from_arrays({names}, map_values({m}))"),
                default=_last_per_name(f"map_keys({m})", names, f"map_values({m})"),
            ),
        )

    return bind(fields, renamed)


def _last_per_name(sources: str, names: str, values: str) -> str:
    """Rare path of ``rename_keys``: order positions by source name, keep the last per new name."""
    order = f"array_sort(transform({sources}, {fn(lambda s, i: f'struct({s} as s, {i} as i)', 2)}))"
    ordered = f"transform({order}, {fn(lambda o: f'struct(get({names}, {o}.i) as n, {o}.i as i)')})"

    def kept(es: str) -> str:
        def is_last(e: str, j: str) -> str:
            later = f"slice({es}, {j} + 2, size({es}))"
            return f"not exists({later}, {fn(lambda x: f'{x}.n = {e}.n')})"

        return f"filter({es}, {fn(is_last, 2)})"

    def rebuilt(es: str) -> str:
        keys = f"transform({es}, {fn(lambda e: f'{e}.n')})"
        return f"map_from_arrays({keys}, transform({es}, {fn(lambda e: f'get({values}, {e}.i)')}))"

    return bind(bind(ordered, kept), rebuilt)
