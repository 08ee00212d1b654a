"""Merkle manifest of a data set: hash trees per group and one over the groups, proofs and their check, in SQL alone.

Leaves lie in groups by key. Aligned blocks of ``fan ** levels`` neighbours are one row, in which each level
of the tree is one hex string of digests of 64 characters: fixed-width substrings of a level are the runs whose
hashes make the next one, and what flanks a digest within its run are its siblings. What is left of each
block is a leaf of the next, shorter table of blocks, until every group has one digest, its subroot; the
subroots are leaves of a last tree. So every shuffle but the first carries one row for hundreds of leaves,
and a group with most of all rows is as many blocks as any other rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemflow.llm.scratch import stored

FAN = 8
#: Levels of the tree in one block: 512 leaves, a string of 32 KB.
LEVELS = 3
#: Characters of a digest.
WIDE = 64
#: The group of rows whose group is null; others are prefixed by ``=``, which sorts after it.
NO_GROUP = "-"


def leaf_hash(*fields: Column) -> Column:
    """Hash of a row: of each field ``-`` if null, else its length in UTF-8 bytes, ``:`` and its text."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def group_name(group: Column) -> Column:
    """A group's place in the order of groups: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(NO_GROUP))


@dataclass(frozen=True)
class Manifest:
    """Blocks from the leaves up, one table for each time they were cut; ``subroots``: (_group, subroot, root, path)."""

    blocks: list[DataFrame]
    subroots: DataFrame

    def root(self) -> DataFrame:
        """One row ``root``, none if there are no leaves."""
        return self.subroots.select("root").limit(1)


def build_manifest(
    rows: DataFrame, leaf: str = "leaf", key: str = "doc_id", group: str = "lang", *, fan: int = FAN, levels: int = LEVELS
) -> Manifest:
    """Trees over the digests in ``leaf`` (64 hex characters), by ``key`` within each ``group``.

    While a group has several nodes, every ``fan`` consecutive ones are hashed, the last run with fewer, even
    with one. Null keys come first; rows of one key are ordered by their digest, and rows that are alike in both
    may stand in any order, since no digest depends on it. A null group is a group. Other columns are
    carried with their leaf under their own names, whatever those are. No rows: no blocks, no root.
    """
    own = [f"`{c}`" for c in rows.columns]
    packed = rows.select(
        group_name(F.col(f"`{group}`")).alias("_group"), F.col(f"`{key}`").alias("_key"), F.col(f"`{leaf}`").alias("_leaf"), F.struct(*own).alias("_row")
    )
    blocks, tops = _trees(_numbered(stored(packed, "manifest-rows")), fan, levels)
    above = tops.select(F.lit("").alias("_group"), F.col("_group").alias("_key"), "_leaf", F.struct("_group").alias("_row"))
    upper, last = _trees(_numbered(above), fan, levels)
    start = last.select("_group", F.struct(F.col("_leaf").alias("root")).alias("_end"), F.expr("CAST(array() AS array<struct<l string, r string>>)").alias("_path"))
    paths = _paths(upper, start, fan)
    return Manifest(
        blocks,
        stored(paths.select("_row._group", F.col("_leaf").alias("subroot"), "_end.root", F.col("_path").alias("path")), "manifest-subroots"),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """``_place`` of each row in its group and ``_n``, the rows of the group.

    Rows are dealt and sorted by (group, key, digest), so a group of any share lies in as many parts as it fills; a
    row's place is its offset in its part behind the rows of its group in parts before.
    """
    dealt = rows.repartitionByRange("_group", "_key", "_leaf").sortWithinPartitions("_group", "_key", "_leaf")
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "manifest-leaves")
    part = F.shiftright("_at", 33)
    parts = dealt.groupBy("_group", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_here"))
    ahead = F.expr("sum(_here) OVER (PARTITION BY _group ORDER BY _part) - _here")
    parts = parts.select("_group", "_part", (ahead - F.col("_first")).alias("_shift"), F.expr("sum(_here) OVER (PARTITION BY _group)").alias("_n"))
    return dealt.withColumn("_part", part).join(parts, ["_group", "_part"]).select(
        "_group", (F.col("_at") + F.col("_shift")).alias("_place"), "_n", "_leaf", "_row"
    )


def _trees(nodes: DataFrame, fan: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Tables of blocks from the bottom up, and (_group, _leaf) of what is left of each group."""
    size = fan**levels
    tables = []
    while True:
        node = F.struct(*[c for c in ("_place", "_leaf", "_row") if c in nodes.columns])
        found = nodes.groupBy("_group", F.expr(f"_place DIV {size}").alias("_block")).agg(
            F.first("_n").alias("_n"), F.array_sort(F.collect_list(node), _by_place).alias("_nodes")
        )
        # levels that the group still needs, as far as a block reaches
        needed = F.lit(levels)
        for k in range(levels - 1, -1, -1):
            needed = F.when(F.col("_n") <= fan**k, F.lit(k)).otherwise(needed)
        found = found.withColumn("_needed", needed).withColumn("_s0", F.expr("array_join(transform(_nodes, x -> x._leaf), '')"))
        for k in range(levels):
            hashed = f"array_join(transform(sequence(1, length(_s{k}), {fan * WIDE}), i -> sha2(substring(_s{k}, i, {fan * WIDE}), 256)), '')"
            found = found.withColumn(f"_s{k + 1}", F.expr(f"CASE WHEN _needed > {k} THEN {hashed} ELSE _s{k} END"))
        strings = ", ".join(f"_s{k}" for k in range(levels))
        found = stored(
            found.select("_group", "_block", "_n", "_nodes", F.expr(f"slice(array({strings}), 1, _needed)").alias("_levels"), F.col(f"_s{levels}").alias("_top")),
            "manifest-blocks",
        )
        tables.append(found)
        nodes = found.select("_group", F.col("_block").alias("_place"), F.expr(f"(_n + {size - 1}) DIV {size}").alias("_n"), F.col("_top").alias("_leaf"))
        if nodes.where("_n > 1").isEmpty():
            return tables, nodes.select("_group", "_leaf")


def _by_place(a: Column, b: Column) -> Column:
    return F.when(a["_place"] < b["_place"], -1).otherwise(1)


def _paths(tables: list[DataFrame], tops: DataFrame, fan: int) -> DataFrame:
    """From ``_path`` and ``_end`` of each group's last node down to the leaves: (_leaf, _row, _path, _end).

    A path is one segment for each level: the digests of the run left and right of the node.
    """
    at = f"(i DIV CAST(pow({fan}, j) AS BIGINT))"
    first = f"({at} - {at} % {fan})"
    segment = (
        f"named_struct('l', substring(s, CAST({first} * {WIDE} + 1 AS INT), CAST(({at} - {first}) * {WIDE} AS INT)), "
        f"'r', substring(s, CAST(({at} + 1) * {WIDE} + 1 AS INT), CAST(({first} + {fan - 1} - {at}) * {WIDE} AS INT)))"
    )
    path = f"concat(transform(_levels, (s, j) -> {segment}), _up)"
    above = tops.select("_group", F.lit(0).cast("long").alias("_block"), F.col("_path").alias("_up"), "_end")
    for table in reversed(tables[1:]):
        here = table.join(above, ["_group", "_block"])
        above = here.selectExpr(
            "_group", "_end", f"inline(transform(_nodes, (x, i) -> named_struct('_block', x._place, '_up', {path})))"
        )
    here = tables[0].join(above, ["_group", "_block"])
    return here.selectExpr(
        "_end", f"inline(transform(_nodes, (x, i) -> named_struct('_leaf', x._leaf, '_row', x._row, '_path', {path})))"
    )


def proofs(manifest: Manifest, fan: int = FAN) -> DataFrame:
    """A row for each leaf: the columns it came with, and ``manifest`` (struct of subroot, root and path).

    ``path``: segments ``(l, r)`` from the leaf's run up to the root, hex digests left and right of the node.
    """
    tops = manifest.subroots.select("_group", F.struct("subroot", "root").alias("_end"), F.col("path").alias("_path"))
    found = _paths(manifest.blocks, tops, fan)
    return found.select("_row.*", F.struct("_end.subroot", "_end.root", F.col("_path").alias("path")).alias("manifest"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def proof_hash(path: Column) -> Column:
    """One hash of all siblings of a path, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""), 256)
