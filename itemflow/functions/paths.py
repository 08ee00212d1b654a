"""Dotted paths into documents held as MAP<STRING, VARIANT>. Paths pass through objects only."""

from __future__ import annotations

from collections.abc import Callable

from itemflow.functions.expr import NO_VALUE, VARIANT_MAP, bind, case, fn, get, has_null, lit


def as_map(value: str) -> str:
    """The fields of an object; NULL for anything else."""
    return get(value, VARIANT_MAP)


def as_object(fields: str) -> str:
    """The object of a field map; SQL NULL (error) if one of its values is SQL NULL."""
    return case((has_null(f"map_values({fields})"), NO_VALUE), default=f"to_variant_object({fields})")


def field(fields: str, key: str) -> str:
    return f"try_element_at({fields}, {lit(key)})"


def get_path(fields: str, path: str) -> str:
    """Value at a dotted path, SQL NULL when there is none."""
    first, *rest = path.split(".")
    value = field(fields, first)
    for key in rest:
        value = field(as_map(value), key)
    return value


def update_paths(fields: str, changes: dict[str, Callable[[str], str]]) -> str:
    """Replace the values at existing paths; absent paths are left alone.

    No path may be a prefix of another. A change that returns SQL NULL makes every object
    above it SQL NULL, so a failed change shows at the top level.
    """
    tree: dict = {}
    for path, change in changes.items():
        node = tree
        *parents, last = path.split(".")
        for key in parents:
            node = node.setdefault(key, {})
        node[last] = change
    return _update(fields, tree)


def _update(fields: str, tree: dict) -> str:
    def value_of(key: str, value: str) -> str:
        branches = [
            (f"{key} = {lit(part)}", node(value) if callable(node) else _inside(value, node))
            for part, node in tree.items()
        ]
        return case(*branches, default=value)

    return f"transform_values({fields}, {fn(value_of, 2)})"


def _inside(value: str, tree: dict) -> str:
    return bind(
        as_map(value),
        lambda inner: case(
            (f"{inner} is null", value), default=bind(_update(inner, tree), as_object)
        ),
    )


def set_path(fields: str, path: str, value: str) -> str:
    """Set the value at a dotted path, making missing parents.

    NULL when a parent exists but is no object.
    """
    first, *rest = path.split(".")

    def put(new: str) -> str:
        others = f"map_filter({fields}, {fn(lambda k, _: f'{k} <> {lit(first)}', 2)})"
        return case((f"{new} is not null", f"map_concat({others}, map({lit(first)}, {new}))"))

    if not rest:
        return bind(value, put)
    child = field(fields, first)
    inner = case(
        (f"{child} is null", f"cast(map() as {VARIANT_MAP})"), default=as_map(child)
    )
    changed = bind(inner, lambda m: set_path(m, ".".join(rest), value))
    return bind(bind(changed, lambda m: case((f"{m} is not null", f"to_variant_object({m})"))), put)
