"""Lines that nearly repeat: MinHash over character shingles, exact check, one line of each group stays.

Lines with the same text are one node. Signatures and bands come from the same scan; a task
signs each different line once, unless it is shorter than a shingle: such lines are the same or share nothing. Bands that
several lines share go to ``setlinks``, which checks exact Jaccard similarity and joins the links.
With 7 bands of 3 rows a pair of similarity 0.8 meets in a band with probability 0.993, one of
0.9 with 0.9999, one of 0.2 with 0.05.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.llm import textpack
from itemflow.llm.scratch import stored
from itemflow.llm.setlinks import NodeFilter, components, linked

PERCENT, SHINGLE, BANDS, ROWS, MIN_WORDS = 80, 8, 7, 3, 5
#: A line of so many words or characters is long: what documents keep of short lines alone is a fragment.
MIN_CHARS = 16
_SEEN = 1 << 20
#: Bytes of text that are signed at once: their hashes stay in a core's cache.
_PIECE = 1 << 17
#: Lines of a block that are compared at once, and cells of their table of shingles; of so many lines all links are returned.
_FEW, _CELLS, _ALL = 1 << 11, 1 << 23, 96
#: Bits for the place of a line in a small block and for the blocks that are compared at once, and lines of so many blocks at least.
_MEMBERS, _BLOCKS, _SMALL = 4, 12, 1 << 12


def line_groups(
    docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, *, bands: int = BANDS, rows: int = ROWS,
    min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    r"""``(id, line_no, component, stays)`` of every line with a word.

    Lines are the parts between ``\n``, counted from 0; they are compared without white space at their
    ends and with A-Z lower-cased, as sets of ``size`` characters, a shorter line as one shingle.
    Lines of similarity ``percent`` or more are linked, short ones too. Of all lines that links reach the first, by id
    and line number, stays. Lines without words, null texts and rows without id have no rows here. Rows
    with one id are one document: their lines stay or go together.
    """
    how = dict(bands=bands, rows=rows, min_words=min_words, min_chars=min_chars, id_col=id_col, text_col=text_col)
    joined = _joined_lines(docs, percent, size, **how)
    return _first_stays(joined).select("id", "line_no", "component", "stays")


def _joined_lines(
    docs: DataFrame, percent: int, size: int, *, bands: int = BANDS, rows: int = ROWS,
    min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS, id_col: str, text_col: str,
) -> DataFrame:
    """``(id, line_no, words, long, component)`` of every line with a word."""
    source = docs.where(F.col(id_col).isNotNull())
    source = source.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = _signed_lines(source, docs.schema[id_col].dataType, size, bands, rows, min_words, min_chars)
    lines = stored(signed, "lines", plain=_bands(bands))

    def sets(keep: NodeFilter) -> DataFrame:
        return _kept_lines(source, size, keep)

    def search(items: pa.Array, first: np.ndarray, components: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        return _linked_lines(items, first, components, percent, size)

    entries = lines.where("band0 IS NOT NULL").select(F.explode(F.array(*_bands(bands))).alias("key"), "node", "n")
    labels = components(entries, sets, percent, "lines", search=search)
    joined = lines.select("id", "line_no", "words", "long", "node").join(labels, "node", "left")
    return joined.select("id", "line_no", "words", "long", F.coalesce("component", "node").alias("component"))


def _first_stays(joined: DataFrame) -> DataFrame:
    """``joined`` with ``stays``: whether a line is the first of its component."""
    return joined.withColumn("stays", F.rank().over(Window.partitionBy("component").orderBy("id", "line_no")) == 1)


def dedup_lines(
    docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, *, id_col: str = "doc_id", text_col: str = "text", **how
) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, and ``lines_removed`` (long) as a last column.

    See ``line_groups`` for what is a repeat. A text that loses no line is the same, null stays null; one
    that loses all is empty. Columns keep their names and order; a column of ``docs`` that
    is called ``lines_removed`` is replaced.
    """
    return _without_lines(docs, line_groups(docs, percent, size, id_col=id_col, text_col=text_col, **how), id_col, text_col)


def dedup_documents(
    docs: DataFrame, min_left: int, percent: int = PERCENT, size: int = SHINGLE, *, id_col: str = "doc_id", text_col: str = "text", **how
) -> DataFrame:
    """``dedup_lines`` without the documents of which it leaves a fragment.

    A document that loses lines is a fragment if fewer than ``min_left`` words stay, or if less than half of its words
    do and no line among them has ``min_words`` words or ``min_chars`` characters. A line that would have stayed in a fragment
    stays in the next document that has it and is none.
    """
    joined = stored(_joined_lines(docs, percent, size, id_col=id_col, text_col=text_col, **how), "line-components")
    left = _first_stays(joined).groupBy("id").agg(
        F.count_if(~F.col("stays")).alias("lost"), F.sum("words").alias("had"),
        F.sum(F.when(F.col("stays"), F.col("words")).otherwise(0)).alias("words"),
        F.max(F.col("stays") & F.col("long")).alias("long"),
    )
    fragments = left.where(f"lost > 0 AND (words < {min_left} OR 2 * words < had AND NOT long)").select("id")
    fragments = stored(fragments, "line-fragments")
    groups = _first_stays(joined.join(fragments, "id", "left_anti"))
    fragments = fragments.withColumnRenamed("id", "_id")
    kept = docs.join(fragments, F.col(id_col) == F.col("_id"), "left_anti")
    return _without_lines(kept, groups, id_col, text_col)


def _without_lines(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the lines of ``groups`` that do not stay."""
    gone = groups.where("NOT stays").groupBy("id").agg(F.collect_set("line_no").alias("_gone"))
    gone = gone.withColumnRenamed("id", "_id")
    joined = docs.drop("lines_removed").join(gone, F.col(id_col) == F.col("_id"), "left").drop("_id")
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(_without(F.col(text_col).cast("string"), F.col("_gone")))
    removed = F.coalesce(F.size("_gone").cast("long"), F.lit(0).cast("long")).alias("lines_removed")
    kept = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != "lines_removed"]
    return joined.select(*kept, removed)


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, gone: pd.Series) -> pd.Series:
    out = []
    for text, numbers in zip(texts, gone, strict=True):
        if text is not None and numbers is not None and len(numbers):
            drop = set(numbers.tolist())
            text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
        out.append(text)
    return pd.Series(out, dtype=object)


def _worded_lines(texts: textpack.Texts) -> tuple[textpack.Texts, *tuple[np.ndarray, ...]]:
    """Lower-cased texts; of every line with a word its text, number, start and end, without space at its ends, words and characters."""
    texts = texts.lowered()
    lines, words = texts.lines(), texts.runs(textpack.NOT_SPACE)
    low, high = np.searchsorted(words.start, lines.start), np.searchsorted(words.start, lines.end)
    some = np.flatnonzero(high > low)
    number = np.arange(len(lines)) - lines.first[lines.text]
    start, end = words.start[low[some]], words.end[high[some] - 1]
    chars = np.concatenate([[0], np.cumsum((texts.buf & 0xC0) != 0x80)])
    return texts, lines.text[some], number[some], start, end, (high - low)[some], chars[end] - chars[start]


def _trimmed(texts: textpack.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every line with a word, without white space at its ends."""
    lines = texts.lines()
    start, end = lines.start, lines.end
    for _ in range(16):
        start, end = start[start < end], end[start < end]
        left, right = textpack.SPACE[texts.buf[start]], textpack.SPACE[texts.buf[end - 1]]
        if not (left.any() or right.any()):
            return start, end
        start, end = start + left, end - (right & (end - start > left))
    return _worded_lines(texts)[3:5]  # some have more of it


def _windows(texts: textpack.Texts, hasher: textpack.Hasher, start: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``size`` characters from the first of these lines on, none being shorter; where those of each line begin and end."""
    chars = np.append(np.flatnonzero((texts.buf & 0xC0) != 0x80), len(texts.buf))
    bounds = np.stack([np.searchsorted(chars, start), np.searchsorted(chars, end) - size + 1], axis=1).ravel()
    values = hasher.neighbours(chars[bounds[0] :], size)
    return np.append(values, np.uint64(0)), bounds - bounds[0]


def _line_shingles(texts: textpack.Texts, hasher: textpack.Hasher, start: np.ndarray, end: np.ndarray, size: int):
    """Hashes of every ``size`` characters of each line, and the index of each line's first."""
    chars = np.append(np.flatnonzero((texts.buf & 0xC0) != 0x80), len(texts.buf))
    low, high = np.searchsorted(chars, start), np.searchsorted(chars, end)
    counts = np.maximum(high - low - size + 1, 1)
    first = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(first[-1]) + np.repeat(low - first[:-1], counts)
    values = np.append(hasher.neighbours(chars, size), np.zeros(size, np.uint64))[at]
    short = np.flatnonzero(high - low < size)
    values[first[short]] = hasher(chars[low[short]], chars[high[short]])
    return values, first


def _linked_lines(
    items: pa.Array, first: np.ndarray, components: np.ndarray, percent: int, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """The links within blocks of lines: small blocks are compared many at a time, others one by one."""
    offsets = np.frombuffer(items.buffers()[1], np.int32)[items.offset :]
    found, at = [np.zeros((2, 0), np.int64)], 0
    while at < len(first) - 1:
        to = np.searchsorted(offsets[first], offsets[first[at]] + textpack.PIECE, side="right") - 1
        to = max(at + 1, min(int(to), int(np.searchsorted(first, first[at] + 2 * _SMALL, side="right")) - 1))
        low, high = int(first[at]), int(first[to])
        (texts,) = textpack.pieces(items[low:high], 1 << 62)
        values, begin = _line_shingles(texts, texts.hasher(), texts.starts, texts.ends, size)
        some, counts = first[at : to + 1] - low, np.diff(first[at : to + 1])
        pairs = [_small_blocks(values, begin, some[:-1], counts, percent)]
        for k in np.flatnonzero(counts > 1 << _MEMBERS).tolist():
            a, b = int(some[k]), int(some[k + 1])
            sets = [textpack.signed(values[x:y]) for x, y in pairwise(begin[a : b + 1].tolist())]
            pairs.append(a + np.array(_alike(sets, components[low + a : low + b].tolist(), percent), np.int64).reshape(-1, 2).T)
        found += [low + x for x in pairs]
        at = to
    a, b = np.concatenate(found, axis=1)
    known = components[a] == components[b]
    return a[~known], b[~known]


def _small_blocks(values: np.ndarray, begin: np.ndarray, first: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """All links of the blocks of 2 to 16 lines: one sort by block, shingle and line puts what lines share side by side.

    A block's number and a line's place in it take 16 bits of a shingle's hash; 48 bits tell shingles of a block apart.
    """
    blocks = np.flatnonzero((counts > 1) & (counts <= 1 << _MEMBERS))
    first, counts = first[blocks], counts[blocks]
    if not len(blocks):
        return np.zeros((2, 0), np.int64)
    block = np.repeat(np.arange(len(blocks)), counts)
    place = np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts)
    row = first[block] + place
    length = begin[row + 1] - begin[row]
    at = np.arange(int(length.sum())) + np.repeat(begin[row] - np.cumsum(length) + length, length)
    low, mine = np.uint64(_MEMBERS), (block.astype(np.uint64) << np.uint64(64 - _BLOCKS)) | place.astype(np.uint64)
    tags = ((values[at] >> np.uint64(_BLOCKS + _MEMBERS)) << low) | np.repeat(mine, length)
    tags.sort()
    tags = tags[np.append(True, tags[1:] != tags[:-1])]
    shingle, place = tags >> low, (tags & np.uint64((1 << _MEMBERS) - 1)).astype(np.int64)
    block = (tags >> np.uint64(64 - _BLOCKS)).astype(np.int64)
    sizes = np.bincount(first[block] + place, minlength=len(begin))
    base = np.concatenate([[0], np.cumsum(counts * counts)])
    met, apart = [], 1
    same = np.flatnonzero(shingle[1:] == shingle[:-1])
    while len(same):
        met.append(base[block[same]] + place[same] * counts[block[same]] + place[same + apart])
        apart += 1
        same = same[: np.searchsorted(same, len(shingle) - apart)]
        same = same[shingle[same] == shingle[same + apart]]
    if not met:
        return np.zeros((2, 0), np.int64)
    overlap = np.bincount(np.concatenate(met))
    pair = np.flatnonzero(overlap)
    block = np.searchsorted(base, pair, side="right") - 1
    a, b = first[block] + np.divmod(pair - base[block], counts[block])
    links = (100 + percent) * overlap[pair] >= percent * (sizes[a] + sizes[b])
    return np.stack([a[links], b[links]])


def _alike(sets: list[np.ndarray], components: list[int], percent: int) -> list[tuple[int, int]]:
    """``linked`` for lines, in whose values some may repeat: the overlaps are one product of the table of lines and shared shingles."""
    n = len(sets)
    bits = np.uint64(n.bit_length())
    tags = np.concatenate(sets).view(np.uint64) >> bits << bits
    tags |= np.repeat(np.arange(n, dtype=np.uint64), [len(s) for s in sets])
    tags.sort()
    tags = tags[np.append(True, tags[1:] != tags[:-1])]
    row = (tags & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    tags >>= bits
    item, sizes = np.cumsum(np.append(False, tags[1:] != tags[:-1])), np.bincount(row, minlength=n)
    shared = np.bincount(item) > 1
    if n > _FEW or n * int(shared.sum()) > _CELLS:
        return linked([np.unique(s) for s in sets], components, percent)
    column, some = np.cumsum(shared) - 1, shared[item]
    table = np.zeros((n, int(shared.sum())), np.float32)
    table[row[some], column[item[some]]] = 1
    overlap = table @ table.T  # whole numbers below 2 ** 24
    known = np.unique(np.array(components), return_inverse=True)[1]
    links = ((100 + percent) * overlap >= percent * (sizes[:, None] + sizes)) & (known[:, None] != known)
    if n > _ALL:
        return _joining(links)
    return list(zip(*(x.tolist() for x in np.nonzero(np.triu(links))), strict=True))


def _joining(links: np.ndarray) -> list[tuple[int, int]]:
    """Of a symmetric table of links those that join the same lines, fewer than there are lines."""
    found, left = [], links.any(axis=1)
    for root in np.flatnonzero(left).tolist():
        todo = [root] if left[root] else []
        left[root] = False
        while todo:
            q = todo.pop()
            some = np.flatnonzero(links[q] & left).tolist()
            left[some] = False
            found += [(q, d) for d in some]
            todo += some
    return found


def _set_sizes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many different values each line has, told apart by as many bits as fit beside the line's number."""
    n = len(bounds)
    bits = np.uint64(n.bit_length())
    tagged = np.repeat(np.arange(n, dtype=np.uint64) << (np.uint64(64) - bits), np.diff(bounds, append=len(values)))
    tagged |= values >> bits
    tagged.sort()
    new = np.append(True, tagged[1:] != tagged[:-1])
    return np.add.reduceat(new, bounds)[::2].astype(np.int32)


def _bands(bands: int) -> list[str]:
    return [f"band{b}" for b in range(bands)]


def _signed_lines(source: DataFrame, id_type: T.DataType, size: int, bands: int, rows: int, min_words: int, min_chars: int) -> DataFrame:
    draw = np.random.default_rng(20)
    odd = draw.integers(1 << 31, size=bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    flip = draw.integers(1 << 32, size=bands * rows, dtype=np.uint32)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for texts in textpack.pieces(batch.column(1), _PIECE):
                texts, text, number, start, end, count, chars = _worded_lines(texts)
                if not len(text):
                    continue
                hasher = texts.hasher()
                node = textpack.signed(hasher(start, end))
                new = np.zeros(len(node), bool)
                for i in np.flatnonzero(chars >= size).tolist():
                    if (x := int(node[i])) not in done:
                        new[i] = True
                        if len(done) < _SEEN:
                            done.add(x)
                keys, length = np.zeros((len(node), bands), np.int64), np.ones(len(node), np.int32)
                if new.any():
                    values, bounds = _windows(texts, hasher, start[new], end[new], size)
                    length[new] = _set_sizes(values, bounds)
                    values = (values >> np.uint64(32)).astype(np.uint32)
                    least, drawn = [], np.empty_like(values)
                    for k in range(bands * rows):
                        np.multiply(np.bitwise_xor(values, flip[k], out=drawn), odd[k], out=drawn)
                        least.append(np.minimum.reduceat(drawn, bounds)[::2].astype(np.uint64))
                    for b in range(bands):
                        key = np.full(int(new.sum()), b + 1, np.uint64)
                        for k in range(b * rows, (b + 1) * rows):
                            key = textpack.mix(key ^ least[k])
                        keys[new, b] = textpack.signed(key)
                drawn_keys = [pa.array(np.ascontiguousarray(keys[:, b]), mask=~new) for b in range(bands)]
                long = (count >= min_words) | (chars >= min_chars)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(text + texts.row)), pa.array(number.astype(np.int32)), pa.array(count.astype(np.int32)),
                     pa.array(long), pa.array(node), pa.array(length), *drawn_keys],
                    ["id", "line_no", "words", "long", "node", "n", *_bands(bands)],
                )

    fields = [T.StructField("id", id_type), T.StructField("line_no", T.IntegerType())]
    fields += [T.StructField("words", T.IntegerType()), T.StructField("long", T.BooleanType())]
    fields += [T.StructField("node", T.LongType()), T.StructField("n", T.IntegerType())]
    fields += [T.StructField(b, T.LongType()) for b in _bands(bands)]
    return source.mapInArrow(scan, T.StructType(fields))


def _kept_lines(source: DataFrame, size: int, keep: NodeFilter) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for texts in textpack.pieces(batch.column(0), _PIECE):
                texts = texts.lowered()
                start, end = _trimmed(texts)
                node = texts.hasher()(start, end)
                some = []
                for i in np.flatnonzero(keep.mask(node)).tolist():
                    if (x := int(node[i])) not in done:
                        some.append(i)
                        if len(done) < _SEEN:
                            done.add(x)
                if not some:
                    continue
                data = texts.buf.tobytes()
                sets = [data[a:b] for a, b in zip(start[some].tolist(), end[some].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(textpack.signed(node[some])), pa.array(sets, pa.binary())], ["node", "items"]
                )

    return source.select("text").mapInArrow(scan, "node long, items binary")  # the line itself is a sixth of its set
