"""What to copy where, and how documents are shaped. All rules are checked on construction."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, fields, replace

from itemflow.functions.naming import NAMINGS, rename_text
from itemflow.functions.transforms import TRANSFORMS
from itemflow.functions.wire import BINARY_MODES, DEFAULT_DEPTH

WIDE_NUMBERS = ("double", "decimal")


@dataclass(frozen=True)
class Mapping:
    """Shape of a document.

    ``key_source`` names the item attribute (or attributes) that become the document key,
    ``key_target`` the document field that holds it. Without ``key_source`` a document is
    identified by an attribute already called ``key_target``, or not at all.
    ``transforms`` is an ordered list of (dotted path in renamed fields, type).
    ``unique_keys`` declares that no two items share a key (it is the whole primary key of
    the source): reading the copy then needs no shuffle of it. ``deep`` allows the Arrow
    step for items nested deeper than ``depth``; without it they go to the quarantine.
    """

    key_source: str | tuple[str, ...] | None = None
    key_target: str = "_id"
    naming: str = "preserve"
    transforms: tuple[tuple[str, str], ...] = ()
    collection_naming: str = "preserve"
    cluster: bool = False
    binary: str = "base64"
    wide_numbers: str = "double"
    exact_decimals: bool = False
    depth: int = DEFAULT_DEPTH
    deep: bool = True
    unique_keys: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "transforms", tuple((p, t) for p, t in self.transforms))
        for name in (self.naming, self.collection_naming):
            if name not in NAMINGS:
                raise ValueError(f"naming must be one of {NAMINGS}, not {name!r}")
        if self.key_source is not None and not all(self.key_fields):
            raise ValueError("the key needs a source field")
        if self.key_source is not None and not self.key_fields:
            raise ValueError("the key needs a source field")
        if not self.key_target:
            raise ValueError("the key needs a target field")
        for path, kind in self.transforms:
            if not path:
                raise ValueError("a transform needs a field")
            if kind not in TRANSFORMS:
                raise ValueError(f"transform must be one of {tuple(TRANSFORMS)}, not {kind!r}")
        if self.binary not in BINARY_MODES:
            raise ValueError(f"binary must be one of {BINARY_MODES}, not {self.binary!r}")
        if self.wide_numbers not in WIDE_NUMBERS:
            raise ValueError(f"wide_numbers must be one of {WIDE_NUMBERS}")
        if not 0 <= self.depth <= 5:
            raise ValueError("depth must lie between 0 and 5; deeper items take the Arrow path")

    @property
    def key_fields(self) -> tuple[str, ...]:
        if self.key_source is None:
            return ()
        return (self.key_source,) if isinstance(self.key_source, str) else tuple(self.key_source)


@dataclass(frozen=True)
class Scan:
    """What to read of a source: attributes to keep and rows to keep.

    ``where`` is a Spark SQL predicate over the attributes declared in ``attributes``
    (name to type). ``names`` maps ``#alias`` placeholders to attribute names; ``values`` binds
    ``:name`` parameters as literals.
    """

    columns: tuple[str, ...] | None = None
    where: str | None = None
    attributes: dict[str, str] = field(default_factory=dict)
    names: dict[str, str] = field(default_factory=dict)
    values: dict[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class RunSettings:
    """Sizes of a run. Only values above zero override the general ones."""

    segments: int = 8
    parallel_readers: int = 4
    max_concurrent_pairs: int = 1
    max_files_per_trigger: int = 1000
    buckets: int = 64
    #: Report what copies and batches do to the documents of their keys; costs a scan of keys and hashes each.
    result_counts: bool = False

    def override(self, other: RunSettings | dict | None) -> RunSettings:
        if other is None:
            return self
        if isinstance(other, RunSettings):
            other = {f.name: getattr(other, f.name) for f in fields(other)}
        return replace(self, **{k: v for k, v in other.items() if v and v > 0})


@dataclass(frozen=True)
class Pair:
    """One source and the target it is copied to. All paths are on storage every executor sees."""

    name: str
    source: str
    target_root: str
    collection: str
    mapping: Mapping = field(default_factory=Mapping)
    changes: str | None = None
    scan: Scan = field(default_factory=Scan)
    settings: dict | None = None

    def __post_init__(self) -> None:
        for what in ("name", "source", "target_root", "collection"):
            if not getattr(self, what):
                raise ValueError(f"a pair needs a {what}")

    @property
    def target(self) -> str:
        name = rename_text(self.collection, self.mapping.collection_naming)
        return f"{self.target_root.rstrip('/')}/{name}"


def check_pairs(pairs: Iterable[Pair]) -> list[Pair]:
    """The pairs as a list; at least one, names unique."""
    checked = list(pairs)
    if not checked:
        raise ValueError("at least one pair is required")
    names = [p.name for p in checked]
    for name in names:
        if names.count(name) > 1:
            raise ValueError(f"duplicate pair name: {name}")
    return checked


def select_pairs(pairs: Iterable[Pair], names: Iterable[str] | None) -> list[Pair]:
    """The named pairs in their own order; all of them when no name is given."""
    wanted = set(names or ())
    return [p for p in pairs if not wanted or p.name in wanted]
