"""Benchmark decontamination with generalised suffix automata of the test items.

Items are dealt into groups of bounded size; each group becomes one automaton, built inside a task and
kept as a row of a table. Training tokens stream through it: each word moves it to the longest stretch of words
that ends there and occurs in an item. Where that is as long as a window, the words are hit.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.llm import textpack
from itemflow.llm.scratch import stored

WINDOW = 10
#: Words of all items that one automaton may hold: some 60 MB in a task.
GROUP_WORDS = 100_000
#: The benchmark's words, lower case: anything but ASCII other than letters and digits.
WORD = np.ones(256, bool)
WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
WORD[0x41:0x5B] = True


class ItemAutomaton:
    """All stretches of words of some items; states carry the items that windows name."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for name, words in items]
        for _, words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        #: For states at which windows end: the items; for whole short items: their length too.
        self.full: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for name, words in coded:
            if len(words) < window:
                state, _ = self._walk(0, 0, words)
                self.short.setdefault(self._shrunk(state, len(words)), {}).setdefault(len(words), set()).add(name)
                continue
            state = length = 0
            for w in words:
                state, length = self._walk(state, length, [w])
                if length >= window:
                    self.full.setdefault(self._shrunk(state, window), set()).add(name)

    def _extend(self, last: int, w: int) -> int:
        """Add one word after ``last`` (the usual online construction, for several texts)."""
        known = self.step[last].get(w)
        if known is not None and self.longest[known] == self.longest[last] + 1:
            return known
        if known is not None:
            return self._clone(last, known, w)
        state = self._state({}, self.longest[last] + 1, 0)
        at = last
        while at >= 0 and w not in self.step[at]:
            self.step[at][w] = state
            at = self.link[at]
        if at >= 0:
            known = self.step[at][w]
            self.link[state] = known if self.longest[known] == self.longest[at] + 1 else self._clone(at, known, w)
        return state

    def _clone(self, at: int, known: int, w: int) -> int:
        copy = self._state(dict(self.step[known]), self.longest[at] + 1, self.link[known])
        while at >= 0 and self.step[at].get(w) == known:
            self.step[at][w] = copy
            at = self.link[at]
        self.link[known] = copy
        return copy

    def _state(self, step: dict[int, int], longest: int, link: int) -> int:
        self.step.append(step)
        self.longest.append(longest)
        self.link.append(link)
        return len(self.step) - 1

    def _walk(self, state: int, length: int, words: list[int]) -> tuple[int, int]:
        for w in words:
            while state and w not in self.step[state]:
                state = self.link[state]
                length = self.longest[state]
            to = self.step[state].get(w)
            state, length = (to, length + 1) if to is not None else (0, 0)
        return state, length

    def _shrunk(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what ``state`` stands for."""
        while self.longest[self.link[state]] >= length:
            state = self.link[state]
        return state

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """``(first, last + 1, items)`` of every window that occurs in ``words``."""
        state = length = 0
        least = min([self.window, *(n for lengths in self.short.values() for n in lengths)])
        for i, word in enumerate(words, 1):
            w = self.vocabulary.get(word)
            if w is None:
                state = length = 0
                continue
            state, length = self._walk(state, length, [w])
            if length < least:
                continue
            at = state
            while at > 0:  # suffixes of the match, from long to short
                if length >= self.window > self.longest[self.link[at]] and at in self.full:
                    yield i - self.window, i, self.full[at]
                for n, items in self.short.get(at, {}).items():
                    if n <= length:
                        yield i - n, i, items
                at = self.link[at]


def matched_spans(
    docs: DataFrame, items: DataFrame, *, window: int = WINDOW, group_words: int = GROUP_WORDS,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``(<id_col>, n_words, spans, items, <text_col>)``, a row for each row of ``docs``.

    Words: A-Z lower-cased, then runs of ASCII letters, digits and bytes from 0x80. A window is ``window``
    consecutive words of one item; an item with fewer words, but not none, is one window.
    ``spans`` are the word ranges ``(start, stop)`` that windows cover, joined and ascending; ``items`` the ids,
    as strings, of items with occurring windows. Null and empty texts have no words. Rows without
    item id or text name no item; items of equal text are all named. No items, no hits.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    found = _found(source, items, window, group_words, item_id_col, item_text_col)
    return found.select(F.col("_id").alias(id_col), "n_words", "spans", "items", F.col("_text").alias(text_col))


def remove_spans(
    docs: DataFrame, items: DataFrame, *, max_coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text", **how
) -> DataFrame:
    """``docs`` without benchmark passages: spans are cut from the text, documents covered beyond ``max_coverage`` go.

    Coverage is hit words over words. A cut takes the words of the span and what stands between
    them and puts one space in its place. Null and unmatched texts stay as they are; columns
    keep names and order. Each row is judged by itself.
    """
    settings = {"window": WINDOW, "group_words": GROUP_WORDS, "item_id_col": "item_id", "item_text_col": "text", **how}
    others = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c != text_col}
    source = docs.select(
        F.lit(0).alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"), *(F.col(f"`{c}`").alias(x) for c, x in others.items())
    )
    found = _found(source, items, **settings)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    stays = found.where((F.size("spans") == 0) | (hit <= max_coverage * F.col("n_words")))
    cut = F.when(F.size("spans") == 0, F.col("_text")).otherwise(_cut(F.col("_text"), F.col("spans")))
    return stays.select(*[cut.alias(c) if c == text_col else F.col(others[c]).alias(c) for c in docs.columns])


def _found(
    source: DataFrame, items: DataFrame, window: int, group_words: int, item_id_col: str, item_text_col: str
) -> DataFrame:
    """``source`` (``_id``, ``_text`` and others) with ``n_words``, ``spans`` and ``items``."""
    named = items.select(F.col(item_id_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    named = named.where("item IS NOT NULL AND text IS NOT NULL")
    weight = named.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = max(1, -(-weight // (4 * group_words)))
    automata = stored(_automata(named, groups, window), "automata")
    if groups == 1:
        return _search(source, automata, 0)
    # a number for each row, so that equal rows stay apart when the groups' hits meet
    source = stored(source.withColumn("_row", F.expr("uuid()")), "decontaminate-docs")
    return _merge_groups(source, automata, groups)


@F.arrow_udf(T.StringType())
def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, some in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        if text is not None and some:
            piece = next(textpack.pieces(pa.array([text]), 1 << 62))
            words, at, parts = piece.runs(WORD), 0, []
            data = piece.buf.tobytes()
            for s in some:
                parts.append(data[at : words.start[s["start"]]])
                at = words.end[s["stop"] - 1]
            text = b" ".join([*parts, data[at:]]).decode()
        out.append(text)
    return pa.array(out, pa.string())


def _words(text: str | None) -> list[bytes]:
    for piece in textpack.pieces(pa.array([text], pa.string()), 1 << 62):
        words = piece.lowered().runs(WORD)
        data = textpack.LOWER[piece.buf].tobytes()
        return [data[a:b] for a, b in zip(words.start.tolist(), words.end.tolist(), strict=True)]
    return []


def _automata(named: DataFrame, groups: int, window: int) -> DataFrame:
    """``(part, automaton)``; an item is whole in one part."""

    def build(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("item").to_pylist(), table.column("text").to_pylist(), strict=True), key=str)
        made = ItemAutomaton([(name, words) for name, text in rows if (words := _words(text))], window)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "automaton": pa.array([pickle.dumps(vars(made))], pa.binary())})

    dealt = named.withColumn("part", F.expr(f"cast(pmod(xxhash64(item, text), {groups}) as int)"))
    return dealt.groupBy("part").applyInArrow(build, "part int, automaton binary")


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))


def _search(source: DataFrame, automata: DataFrame, part: int) -> DataFrame:
    rows = automata.where(F.col("part") == part).select("automaton").collect()
    packed = rows[0][0] if rows else None
    extra = [c for c in source.columns if c not in ("_id", "_text")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = ItemAutomaton.__new__(ItemAutomaton)
        if packed:
            vars(made).update(pickle.loads(packed))
            known = _hashes(list(made.vocabulary))
            least = min([made.window, *(n for lengths in made.short.values() for n in lengths)])
        for batch in batches:
            for texts in textpack.pieces(batch.column(1)):
                low = texts.lowered()
                words = low.runs(WORD)
                spans: list[list] = [[] for _ in range(len(texts))]
                items: list[list] = [[] for _ in range(len(texts))]
                if packed and len(known):
                    for text, start, stop in _known_runs(low, words, known, least):
                        data = low.buf[words.start[start] : words.end[stop - 1]].tobytes()
                        base = words.start[start]
                        run = [data[a:b] for a, b in zip((words.start[start:stop] - base).tolist(), (words.end[start:stop] - base).tolist(), strict=True)]
                        offset = start - int(words.first[text])
                        for a, b, names in made.matches(run):
                            spans[text].append((a + offset, b + offset))
                            items[text].extend(names)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[texts.rows], pa.array(words.counts.astype(np.int64)),
                        pa.array([[{"start": a, "stop": b} for a, b in _joined(s)] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                        pa.array([sorted(set(names)) for names in items], pa.list_(pa.string())), batch.column(1)[texts.rows],
                        *(batch.column(2 + k)[texts.rows] for k in range(len(extra))),
                    ],
                    ["_id", "n_words", "spans", "items", "_text", *extra],
                )

    fields = [source.schema["_id"], T.StructField("n_words", T.LongType()), T.StructField("spans", _SPANS)]
    fields += [T.StructField("items", T.ArrayType(T.StringType())), T.StructField("_text", T.StringType())]
    return source.mapInArrow(scan, T.StructType([*fields, *(source.schema[c] for c in extra)]))


def _merge_groups(source: DataFrame, automata: DataFrame, groups: int) -> DataFrame:
    """One pass for each automaton; the hits of a row are put together, rows without a hit stay out of the shuffle."""
    hits = None
    for part in range(groups):
        one = _search(source, automata, part).where(F.size("spans") > 0).select("_row", "spans", "items")
        hits = one if hits is None else hits.unionByName(one)
    joined = F.udf(lambda lists: [{"start": a, "stop": b} for a, b in _joined([(s["start"], s["stop"]) for x in lists for s in x])], _SPANS)
    hits = hits.groupBy("_row").agg(
        joined(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    counted = _search(source, automata.limit(0), 0).drop("spans", "items")
    none = F.array().cast(_SPANS), F.array().cast("array<string>")
    return counted.join(hits, "_row", "left").withColumns(
        {"spans": F.coalesce("spans", none[0]), "items": F.coalesce("items", none[1])}
    )


def _hashes(words: list[bytes]) -> np.ndarray:
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words], dtype=np.int64)
    return np.sort(textpack.Hasher(data)(ends - np.array([len(w) for w in words], np.int64), ends)) if words else np.zeros(0, np.uint64)


def _known_runs(texts: textpack.Texts, words: textpack.Spans, known: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """``(text, first word, last + 1)`` of the stretches of item words long enough for a window."""
    if not len(words):
        return
    hashes = texts.hasher()(words.start, words.end)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    inside = known[at] == hashes
    edge = np.ones(len(words) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[words.first] = True
    cuts = np.flatnonzero(edge)
    long = inside[cuts[:-1]] & (np.diff(cuts) >= least)
    text = words.text
    for a, b in zip(cuts[:-1][long].tolist(), cuts[1:][long].tolist(), strict=True):
        yield int(text[a]), a, b


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
