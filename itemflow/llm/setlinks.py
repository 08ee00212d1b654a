"""Components of sets that overlap enough, from candidate lists that may be very long.

A candidate list is all sets that share one key. No list is turned into all of its pairs: sets
first meet in blocks around the smallest set of their lists, which joins nearly all that belongs
together; only lists that then still hold several components are searched again, in blocks of
bounded size, between their components. Every pair that shares enough keys and is not yet known to be
connected is looked at, so the components are those of all links.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemflow.llm.connect import connected
from itemflow.llm.scratch import forget_shuffles, stored

#: A block has about so many sets, and so many items in all of them.
SETS, ITEMS = 1024, 1 << 21
#: Only lists of at most so many sets are ever taken as pairs.
SHORT = 32
#: Cost of a probe, times the logarithm of a list's length, against that of a step of the merge.
MU = 8
#: So many postings are merged by a heap; more are counted, which gives the same counts sooner.
HEAP = 256
BLOOM_BITS = 24
#: The items of the sets of some blocks, where each block begins and the last ends, the sets' components and the least similarity
#: to pairs of positions that join, in each block, the components of all links.
Search = Callable[[pa.Array, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]]


def components(
    entries: DataFrame, sets: Callable[[NodeFilter], DataFrame], percent: int, name: str, spare: int = 0, search: Search | None = None
) -> DataFrame:
    """``(node, component)`` of the sets that link with another one.

    ``entries``: ``(key, node, n)``, ``n`` being the number of a set's items; rows may repeat. With ``spare``,
    keys are the ``n - ceil(percent n / 100) + 1 + n div spare`` first items of each set in one order of all items, so that
    two sets that link share ``enough`` of them; else they share at least one key. ``sets(keep)`` gives ``(node, items)`` of all nodes
    that ``keep`` lets through, items as ``search`` reads a column of them (else as ``packed`` makes them); a node may come more than once.
    Two sets link when ``100 * intersection >= percent * union``; ``search`` finds them in some blocks, as ``linked`` does in one.
    """
    search = search or _block_by_block
    members, least = _shared_lists(entries), f"1 + ((n * {percent} + 99) div 100) div {spare}" if spare else "1"
    if spare:
        able = members.groupBy("node").agg(F.max("n").alias("n"), F.collect_list("key").alias("keys")).where(f"size(keys) >= {least}")
        members = _shared_lists(able.select(F.explode("keys").alias("key"), "node", "n"))
    members = stored(members, f"{name}-members")

    forget_shuffles(members)
    near = members
    if spare:  # a set meets those around a hub with which it shares enough keys itself; all other pairs are for the second search
        near = members.where("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("keys"), F.max("n").alias("n"), F.max("m").alias("m"))
        near = near.where(_enough(percent, spare))
    nodes = stored(near.groupBy("node").agg(F.min("hub").alias("hub"), F.max("n").alias("n")), f"{name}-nodes")
    items = stored(sets(NodeFilter.of(members.select("node"))), f"{name}-sets")
    forget_shuffles(items)
    spread = nodes.groupBy("hub").agg(F.count("*").alias("count"), F.sum("n").alias("weight")).select("hub", _parts().alias("parts"))
    dealt = nodes.join(spread, "hub")
    dealt = dealt.select(F.col("hub").alias("block"), F.expr("pmod(xxhash64(node), parts)").alias("part"), "node")
    dealt = stored(dealt, f"{name}-cells")
    centres = dealt.select("block", "part", F.col("block").alias("node"))
    first = dealt.unionByName(centres).distinct().withColumn("component", F.col("node"))
    links = stored(_searched(first, _of_nodes(items, first) if spare else items, percent, search), f"{name}-links")

    forget_shuffles(members)
    labels = connected(links, f"{name}-components")
    rest = members.join(labels, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    rest = _unsettled(rest, name, least)
    if rest.isEmpty():
        return labels
    again = _between(rest, labels, percent, spare, name)
    if spare:
        again = stored(again, f"{name}-again")
        items = _of_nodes(items, again)
    forget_shuffles(members)
    more = _searched(again, items, percent, search)
    return connected(links.unionByName(stored(more, f"{name}-links")), f"{name}-components")


def _of_nodes(items: DataFrame, blocks: DataFrame) -> DataFrame:
    """The items of the nodes of some blocks, and few others: large sets that take no part are not shuffled."""
    keep = NodeFilter.of(blocks.select("node"))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.filter(pa.array(keep.mask(batch.column(0).to_numpy().view(np.uint64))))
            if kept.num_rows:
                yield kept

    return items.select("node", "items").mapInArrow(some, "node long, items binary")


def _shared_lists(entries: DataFrame) -> DataFrame:
    """``(key, node, n, hub, m)`` of the keys of several nodes, each node once; ``hub`` is the key's smallest, with ``m`` items.

    One shuffle and sort of the entries, whatever their number: most keys are of one set alone and go where they were sorted.
    A list is read row by row, however long it is.
    """
    rows = entries.select("key", "node", F.col("n").cast("long").alias("n")).repartition("key").sortWithinPartitions("key", "node")

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, last, shown = [np.zeros(0, np.int64)] * 3, np.zeros(0, np.int64), False  # of the open list: first row, last node, whether it is out
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, n = (np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(hub))
            before = np.append(node[:1], node[:-1])
            before[1 : 1 + len(last)] = last
            new = np.append(True, key[1:] != key[:-1])
            begin = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            other = np.flatnonzero((node != node[begin]) & (node != before))
            hubs = np.unique(begin[other])
            at = np.sort(np.concatenate([hubs[hubs > 0] if shown else hubs, other]))
            shown = (shown and begin[-1] == 0) or begin[-1] in hubs
            hub, last = [x[begin[-1:]] for x in (key, node, n)], node[-1:]
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[at], node[at], n[at], node[begin[at]], n[begin[at]])], ["key", "node", "n", "hub", "m"])

    return rows.mapInArrow(several, "key long, node long, n long, hub long, m long")


def _parts() -> Column:
    """Into how many cells of bounded size so many sets go."""
    return F.greatest(F.expr(f"ceil(count / {SETS})"), F.expr(f"ceil(weight / {ITEMS})"))


def _unsettled(rest: DataFrame, name: str, least: str) -> DataFrame:
    """The lists that hold more than one component, of lists with the same sets one; ``keys`` is how many it stands for.

    A set that links with one of another component shares only such lists with it, so sets in too few of them go.
    """
    lists = rest.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    once = lists.where("low <> high").groupBy("size", "x", "y")
    once = once.agg(F.min("key").alias("key"), F.count("*").alias("keys")).drop("x", "y")
    found = stored(rest.join(once, "key"), f"{name}-unsettled")
    able = found.groupBy("node").agg(F.max("n").alias("n"), F.sum("keys").alias("keys")).where(f"keys >= {least}").select("node")
    return stored(found.join(able, "node"), f"{name}-unsettled")


def _enough(percent: int, spare: int) -> str:
    """SQL: whether sets of ``n`` and ``m`` items that share ``keys`` keys could link; see ``enough``."""
    fits = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    if not spare:
        return fits
    left = [f"(({x} * {percent} + 99) div 100 - 1 - {x} div {spare})" for x in "nm"]
    both = f"((n + m) * {percent} + {99 + percent}) div {100 + percent}"
    return f"{fits} AND keys >= {both} - greatest(0, {left[0]}, {left[1]})"


def enough(n: np.ndarray, m: int, shared: np.ndarray, percent: int, spare: int) -> np.ndarray:
    """Whether sets of ``n`` items that share so many keys with one of ``m`` could link with it.

    Sizes must fit. Of the set whose last key comes first in the order of items, all common items that are no
    common keys come after its keys, so there are at most as many as it has items that are no keys.
    """
    fits = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (shared > 0)
    if not spare:
        return fits
    left = [(x * percent + 99) // 100 - 1 - x // spare for x in (n, m)]
    both = ((n + m) * percent + 99 + percent) // (100 + percent)
    return fits & (shared >= both - np.maximum(0, np.maximum(*left)))


def _between(rest: DataFrame, labels: DataFrame, percent: int, spare: int, name: str) -> DataFrame:
    """What is searched again, as blocks of sets that could still link.

    Pairs that meet in short lists and share enough keys make families: one that is small enough is a block, in
    a larger one every set is a block with its partners. A long list is a block, or pairs of its cells.
    """
    short, long = rest.where(f"size <= {SHORT}"), rest.where(f"size > {SHORT}")
    ahead = short.select("key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("component").alias("other"))
    fits = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    pairs = short.join(ahead, "key").where(f"node < b AND component <> other AND {fits}").groupBy(F.col("node").alias("a"), "b")
    pairs = pairs.agg(F.sum("keys").alias("keys"), F.max("n").alias("n"), F.max("m").alias("m")).where(_enough(percent, spare))
    pairs = stored(pairs.select("a", "b", "n", "m"), f"{name}-pairs")
    family = connected(pairs.select("a", "b"), f"{name}-families").withColumnRenamed("component", "family")
    sizes = pairs.select(F.explode(F.expr("array(struct(a AS node, n), struct(b AS node, m AS n))")).alias("x"))
    sizes = sizes.groupBy("x.node").agg(F.max("x.n").alias("n")).join(family, "node")
    whole = sizes.groupBy("family").agg(F.count("*").alias("count"), F.sum("n").alias("weight"))
    whole = stored(family.join(whole.select("family", (_parts() == 1).alias("whole")), "family"), f"{name}-family")
    block = whole.where("whole").select(F.col("family").alias("block"), F.lit(0).cast("long").alias("part"), "node")

    split = pairs.join(whole.where("NOT whole").select(F.col("node").alias("a")), "a")
    parts = split.groupBy("a").agg(F.count("*").alias("count"), F.sum("m").alias("weight")).select("a", _parts().alias("parts"))
    split = split.join(parts, "a").select(F.col("a").alias("block"), F.expr("pmod(xxhash64(b), parts)").alias("part"), "a", "b")
    split = split.select("block", "part", F.explode(F.array("a", "b")).alias("node")).distinct()
    met = block.unionByName(split).unionByName(_meeting(long, rest, percent, spare)).join(labels, "node", "left")
    return met.select("block", "part", "node", F.coalesce("component", "node").alias("component"))


def _meeting(long: DataFrame, rest: DataFrame, percent: int, spare: int) -> DataFrame:
    """The rows ``(block, part, node)`` of long lists whose set shares enough keys with one of another component.

    Only the keys of unsettled lists are fetched for this, a small part of a set. Two sets are looked at in the first long list they share.
    """
    lists = long.groupBy("key").agg(F.count("*").alias("count"), F.sum("n").alias("weight")).select("key", _parts().alias("parts"))
    rows = long.select("key", "node").join(lists, "key").withColumn("own", F.expr("pmod(xxhash64(node), parts)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0L, CAST(parts AS LONG) - 1)")))
    rows = rows.select(F.col("key").alias("block"), F.expr("least(own, other) * parts + greatest(own, other)").alias("part"), "node")
    weight = F.when(F.col("size") > SHORT, -F.col("keys")).otherwise(F.col("keys"))  # below zero: that of a long list
    marks = rest.join(long.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.max("component").alias("component"), F.max("n").alias("n"), F.collect_list(F.struct("key", weight.cast("int").alias("weight"))).alias("keys")
    )
    rows = rows.join(marks, "node").select("block", "part", "node", "component", "n", "keys")
    rows = rows.repartition("block", "part").sortWithinPartitions("block", "part")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, 2):
            keys = group.column("keys").combine_chunks()
            pairs = keys.flatten()
            kept = _partnered(
                pairs.field("key").to_numpy(), np.diff(keys.offsets.to_numpy()), pairs.field("weight").to_numpy(),
                group.column("component").to_numpy(), group.column("n").to_numpy(), group.column("block")[0].as_py(), percent, spare,
            )
            if kept.any():
                for batch in group.select(["block", "part", "node"]).filter(pa.array(kept)).to_batches():
                    yield batch

    return rows.mapInArrow(search, "block long, part long, node long")


def _partnered(
    keys: np.ndarray, counts: np.ndarray, weights: np.ndarray, component: np.ndarray, sizes: np.ndarray, block: int, percent: int, spare: int
) -> np.ndarray:
    """Which sets share enough keys with one of another component, and no long list before ``block``."""
    n = len(counts)
    owner = np.repeat(np.arange(n), counts)
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    lists = np.empty(len(keys), np.int64)
    lists[order] = np.cumsum(new) - 1
    low = np.append(np.flatnonzero(new), len(keys))
    length, posting = np.diff(low), owner[order]
    first = np.concatenate([[0], np.cumsum(counts)])
    before, weights = (weights < 0) & (keys < block), np.abs(weights)
    kept = np.zeros(n, bool)
    for q in range(n):
        if kept[q]:
            continue
        at = slice(first[q], first[q + 1])
        shared = _weighed(posting, low, length, lists[at], weights[at], n)
        some = enough(sizes, int(sizes[q]), shared, percent, spare) & (component != component[q])
        if some.any() and before[at].any():
            own = lists[at][before[at]]
            some &= _weighed(posting, low, length, own, np.ones(len(own)), n) == 0
        if some.any():
            kept[q] = True
            kept |= some
    return kept


def _weighed(posting: np.ndarray, low: np.ndarray, length: np.ndarray, own: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """The weight of those lists that each set is in."""
    at = np.repeat(low[own] - np.cumsum(length[own]) + length[own], length[own]) + np.arange(int(length[own].sum()))
    return np.bincount(posting[at], weights=np.repeat(weights, length[own]), minlength=n)


def _searched(blocks: DataFrame, items: DataFrame, percent: int, search: Search) -> DataFrame:
    """Links ``(a, b)`` within each block of ``(block, part, node, component)``."""
    rows = blocks.join(items.select("node", "items"), "node").select("block", "part", "node", "component", "items")
    rows = rows.repartition("block", "part").sortWithinPartitions("block", "part", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 2, together=True):
            block, part, node = (table.column(k).to_numpy() for k in range(3))
            new = np.append(True, (block[1:] != block[:-1]) | (part[1:] != part[:-1]))
            kept = np.flatnonzero(new | np.append(True, node[1:] != node[:-1]))
            node, comps = node[kept], table.column("component").to_numpy()[kept]
            first = np.append(np.flatnonzero(new[kept]), len(kept))
            items = table.column("items").take(pa.array(kept)).combine_chunks()
            a, b = search(items, first, comps, percent)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _block_by_block(items: pa.Array, first: np.ndarray, components: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """``linked`` in each block, of ``packed`` sets."""
    found = []
    for low, high in pairwise(first.tolist()):
        if high - low > 1:
            sets = [unpacked(x.as_py()) for x in items[low:high]]
            found += [(low + i, low + j) for i, j in linked(sets, components[low:high].tolist(), percent)]
    return tuple(np.array(found, np.int64).reshape(-1, 2).T)


def packed(values: np.ndarray) -> bytes:
    """The low six bytes of each 64-bit hash: most of what is shuffled are these."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int, together: bool = False) -> Iterator[pa.Table]:
    """Cut sorted batches into the groups of their first columns; one group is held at a time, or ``together`` those that end in a batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        inner = np.flatnonzero(new).tolist()
        begin = [0, *(inner[-1:] if together else inner), batch.num_rows]
        for low, high in zip(begin, begin[1:], strict=False):
            key = tuple(c[low] for c in columns)
            if key != last and held and not (together and low == 0):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def linked(sets: list[np.ndarray], components: list[int], percent: int) -> list[tuple[int, int]]:
    """Pairs of positions that join all components of the links of these sets.

    T-occurrence search over an inverted index of the block: a set's partners hold at least
    ``T`` of its items. Its ``L`` longest lists are set aside; the short ones are merged, and only
    sets found ``T - L`` times are looked up in the long ones, by binary search.
    Pairs already in one component are passed over.
    """
    n, sizes = len(sets), np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    new = np.ones(len(values), bool)
    new[1:] = values[order][1:] != values[order][:-1]
    lists = np.empty(len(values), np.int64)
    lists[order] = np.cumsum(new) - 1
    low = np.append(np.flatnonzero(new), len(values))
    length = np.diff(low)
    posting = owner[order]
    place = (np.cumsum(new) - 1) * n + posting
    first = np.concatenate([[0], np.cumsum(sizes)])
    component = np.unique(np.array(components), return_inverse=True)[1]

    found = []
    for q in range(n):
        if (component == component[0]).all():
            break
        own = lists[first[q] : first[q + 1]]
        own = own[length[own] > 1]
        need = -(-percent * int(sizes[q]) // 100)
        if len(own) < max(need, 1):
            continue
        own = own[np.argsort(-length[own], kind="stable")]
        aside = min(need - 1, int(need / (MU * math.log2(length[own[0]]) + 1)))
        far, near = own[:aside], own[aside:]
        counts = _merged(posting, low[near], length[near], n)
        fits = 100 * np.minimum(sizes, sizes[q]) >= percent * np.maximum(sizes, sizes[q])
        some = np.flatnonzero(fits & (counts >= need - aside) & (component != component[q]))
        some = some[some > q]
        if not len(some):
            continue
        overlap = counts[some]
        if aside:
            probes = (far[:, None] * n + some[None, :]).ravel()
            at = np.minimum(np.searchsorted(place, probes), len(place) - 1)
            overlap = overlap + (place[at] == probes).reshape(aside, len(some)).sum(axis=0)
        some = some[(100 + percent) * overlap >= percent * (sizes[some] + sizes[q])]
        for d in some[np.unique(component[some], return_index=True)[1]].tolist():
            found.append((q, d))
            component[component == component[d]] = component[q]
    return found


def _merged(posting: np.ndarray, low: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """How often each set occurs in some lists."""
    total = int(length.sum())
    if total <= HEAP:
        counts = np.zeros(n, np.int64)
        runs = [posting[a : a + k].tolist() for a, k in zip(low.tolist(), length.tolist(), strict=True)]
        for d, hits in groupby(heapq.merge(*runs)):
            counts[d] = sum(1 for _ in hits)
        return counts
    at = np.repeat(low - np.cumsum(length) + length, length) + np.arange(total)
    return np.bincount(posting[at], minlength=n)


class NodeFilter:
    """A Bloom filter over nodes that are 64-bit hashes, of fixed size whatever their number.

    Too many nodes let others through as well, which costs time and changes no result.
    """

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, nodes: DataFrame, bits: int = BLOOM_BITS) -> NodeFilter:
        spots = F.array(F.shiftrightunsigned("node", 64 - bits), F.col("node").bitwiseAND((1 << bits) - 1))
        rows = (
            nodes.select(F.explode(spots).alias("spot"))
            .groupBy(F.shiftright("spot", 6).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits"))
            .toArrow()
        )
        words = np.zeros(1 << (bits - 6), np.uint64)
        words[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
        return cls(words)

    def mask(self, nodes: np.ndarray) -> np.ndarray:
        """Which of these unsigned hashes may be in it."""
        bits = np.uint64(len(self.words).bit_length() + 5)
        six, keep = np.uint64(6), np.ones(len(nodes), bool)
        for spot in (nodes >> (np.uint64(64) - bits), nodes & ((np.uint64(1) << bits) - np.uint64(1))):
            keep &= (self.words[spot >> six] >> (spot & np.uint64(63))) & np.uint64(1) == 1
        return keep
