"""SentencePiece encoding that keeps, for every piece, the bytes of the original text it came from.

The text is normalised by the longest prefix that the model's compiled character map knows, with the source
of every normalised character at hand. Byte-pair merges then run on all different words of half a
megabyte at once; a word starts where an escaped space follows another character, and around
characters that no piece has: no piece crosses these places. Models: byte-pair, byte fallback, spaces as prefixes.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.llm import textpack
from itemflow.llm.scratch import shared

SPACE = 0x2581
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Longer words are merged one by one with a heap.
WIDE = 32
#: Bytes of text that are encoded at once; the arrays beside them take some seventy times as much.
PIECE = 512 << 10
NO_RANK = np.iinfo(np.int32).max


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[at : at + size]
            at += size


class CharMap:
    """A compiled character map: a double-array trie over UTF-8 keys, and what each key becomes."""

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.out = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key at a place, and its replacement."""
        if not self.units:
            return None
        units, found = self.units, None
        place = units[0]
        place = (place >> 10) << ((place & 512) >> 6)
        for i in range(at, len(text)):
            place ^= text[i]
            unit = units[place]
            if unit & 0x800000FF != text[i]:
                break
            place ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = i + 1 - at, units[place] & 0x7FFFFFFF
        return found and (found[0], self.out[found[1] : self.out.index(0, found[1])])

    def normalised(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The text after replacement, and for each of its bytes where its source starts and stops."""
        parts, start, stop, at = [], [], [], 0
        while at < len(text):
            hit = self.longest(text, at)
            if hit:
                size, new = hit
                start += [at] * len(new)
                stop += [at + size] * len(new)
            else:
                size = 1 + sum(text[at] >= lead for lead in (0xC0, 0xE0, 0xF0))
                new = text[at : at + size]
                start += [at] * size
                stop += [at + size] * size
            parts.append(new)
            at += size
        return b"".join(parts), np.array(start, np.int64), np.array(stop, np.int64)


class PieceModel:
    """What encoding and decoding need of a ``.model`` file."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        training, rules = {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                training = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        self.map = CharMap(rules.get(2, b""))
        self.prefix, self.trim, escape = rules.get(3, 1), rules.get(4, 1), rules.get(5, 1)
        if training.get(3) != 2 or not training.get(35) or training.get(24) or not escape:
            raise ValueError("only byte-pair models with byte fallback and spaces as escaped prefixes")
        if {USER_DEFINED, UNUSED} & set(self.kinds) or any("▁" in p.lstrip("▁") for p in self.pieces):
            raise ValueError("user-defined, unused and several-word pieces are not supported")
        self.eos = self.pieces.index(training.get(47, b"</s>").decode()) if 47 in training else self.pieces.index("</s>")
        self.bytes_at = self.kinds.index(BYTE)
        normal = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        order = sorted(normal, key=lambda p: (-scores[normal[p]], normal[p]))
        #: Symbols: pieces by their id, then characters that occur in pieces but are none.
        self.symbols = dict(normal)
        for p in order:
            for c in p:
                self.symbols.setdefault(c, len(self.pieces) + len(self.symbols) - len(normal))
        self.n_symbols = len(self.pieces) + len(self.symbols) - len(normal)
        pairs = {}
        for rank, p in enumerate(order):
            for cut in range(1, len(p)):
                left, right = self.symbols.get(p[:cut]), self.symbols.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = rank, normal[p]
        keys = np.array([a * self.n_symbols + b for a, b in pairs], np.int64)
        by = np.argsort(keys)
        self.pair_keys = np.append(keys[by], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.array([r for r, _ in pairs.values()], np.int32)[by], np.int32(NO_RANK))
        self.by_rank = np.array([normal[p] for p in order], np.int32)
        self.char_symbol = np.full(0x110000, -1, np.int32)
        for s, i in self.symbols.items():
            if len(s) == 1:
                self.char_symbol[ord(s)] = i
        plain = [self._plain(i) for i in range(len(self.pieces))]
        self.plain = np.frombuffer(b"".join(plain), np.uint8)
        self.plain_at = np.concatenate([[0], np.cumsum([len(x) for x in plain])]).astype(np.int64)
        self.n_chars = np.array([len(p) if k == NORMAL else 0 for p, k in zip(self.pieces, self.kinds, strict=True)], np.int32)
        leads = [b for b in range(256) if b & 0xC0 != 0x80]
        self.n_chars[self.bytes_at + np.array(leads)] = 1

    def _plain(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == NORMAL:
            return self.pieces[i].replace("▁", " ").encode()
        return bytes([int(self.pieces[i][3:5], 16)]) if kind == BYTE else " ⁇ ".encode() if kind == UNKNOWN else b""

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each two neighbouring symbols; no pair holds a negative one."""
        keys = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.n_symbols + right)
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)

    def merged(self, words: np.ndarray) -> np.ndarray:
        """Merge the symbols of words of one length, a row each; -1 fills what merges leave free."""
        n, width = words.shape
        words = words.copy()
        ranks = np.full((n, width), NO_RANK, np.int32)
        ranks[:, : width - 1] = self.ranks(words[:, :-1], words[:, 1:])
        live, column = np.arange(n), np.arange(width)
        while width > 1 and len(live):
            part = ranks[live]
            at = part.argmin(axis=1)
            best = part[np.arange(len(live)), at]
            some = best < NO_RANK
            live, at, best = live[some], at[some], best[some]
            if not len(live):
                break
            source = np.minimum(column + (column > at[:, None]), width - 1)
            part = np.take_along_axis(words[live], source, axis=1)
            part[:, -1] = -1
            rows = np.arange(len(live))
            part[rows, at] = self.by_rank[best]
            words[live] = part
            part_ranks = np.take_along_axis(ranks[live], source, axis=1)
            part_ranks[:, -1] = NO_RANK
            after = np.minimum(at + 1, width - 1)
            part_ranks[rows, at] = np.where(at + 1 < width, self.ranks(part[rows, at], part[rows, after]), NO_RANK)
            inner = at > 0
            part_ranks[rows[inner], at[inner] - 1] = self.ranks(part[rows[inner], at[inner] - 1], part[rows[inner], at[inner]])
            ranks[live] = part_ranks
        return words

    def word(self, chars: list[int]) -> list[int]:
        """The ids of one word of any length and any characters."""
        symbol = self.char_symbol[chars].tolist()
        n = len(symbol)
        ahead, back = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, ranks = self.pair_keys, self.pair_ranks

        def rank(a: int, b: int) -> int | None:
            if a < 0 or b < 0:
                return None
            key = a * self.n_symbols + b
            k = int(np.searchsorted(pairs, key))
            return int(ranks[k]) if pairs[k] == key else None

        heap = []

        def offer(i: int) -> None:
            if i >= 0 and (j := ahead[i]) < n and (r := rank(symbol[i], symbol[j])) is not None:
                heap.append((r, i, symbol[i], j, symbol[j])) if not ready else heapq.heappush(heap, (r, i, symbol[i], j, symbol[j]))

        ready = False
        for i in range(n):
            offer(i)
        heapq.heapify(heap)
        ready, gone = True, [False] * n
        while heap:
            r, i, a, j, b = heapq.heappop(heap)
            if gone[i] or gone[j] or symbol[i] != a or symbol[j] != b or ahead[i] != j:
                continue
            symbol[i], gone[j] = int(self.by_rank[r]), True
            ahead[i] = ahead[j]
            if ahead[i] < n:
                back[ahead[i]] = i
            offer(i)
            offer(back[i])
        out = []
        for i in range(n):
            if not gone[i]:
                if 0 <= symbol[i] < len(self.pieces):
                    out.append(symbol[i])
                else:
                    out += [self.bytes_at + x for x in chr(chars[i]).encode("utf-8", "surrogatepass")]
        return out

    def encode_words(self, chars: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words ``chars[start:stop]``, one after the other, and where those of each word start."""
        size = stop - start
        symbols = self.char_symbol[chars]
        strange = np.concatenate([[0], np.cumsum((symbols < 0) | (symbols >= len(self.pieces)))])
        single = (size > WIDE) | (strange[stop] > strange[start])
        counts = np.zeros(len(start), np.int64)
        made = []
        for width in np.unique(size[~single]).tolist():
            rows = np.flatnonzero(~single & (size == width))
            for k in range(0, len(rows), 1 << 15):
                part = rows[k : k + (1 << 15)]
                ids = self.merged(symbols[start[part][:, None] + np.arange(width)])
                counts[part] = (ids >= 0).sum(axis=1)
                made.append((part, ids[ids >= 0]))
        for i in np.flatnonzero(single).tolist():
            ids = np.array(self.word(chars[start[i] : stop[i]].tolist()), np.int32)
            counts[i] = len(ids)
            made.append((np.array([i]), ids))
        first = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(first[-1], np.int32)
        for part, ids in made:
            out[_expand(first[part], counts[part])] = ids
        return out, first

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of some ids; a space that stands for the start of the text goes."""
        out = self.plain[_expand(self.plain_at[ids], self.plain_at[ids + 1] - self.plain_at[ids])].tobytes()
        said = [i for i in ids[:64].tolist() if self.kinds[i] != CONTROL] or [i for i in ids.tolist() if self.kinds[i] != CONTROL]
        if said and (self.prefix or self.trim) and self.kinds[said[0]] == NORMAL and out[:1] == b" ":
            out = out[1:]
        return out


def _expand(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices ``start, start + 1, ...`` of each stretch, one after the other."""
    return np.repeat(start - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))


@dataclass
class Encoded:
    """Pieces of some texts: those of text ``i`` are ``first[i]`` up to ``first[i + 1]``."""

    ids: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray


def _normal_chars(model: PieceModel, texts: textpack.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Normalised characters of all texts, each one's source bytes, and where each text starts."""
    if model.map.units or model.trim:
        parts, starts, stops, first = [], [], [], [0]
        data = texts.buf.tobytes()
        for a, b in zip(texts.starts.tolist(), texts.ends.tolist(), strict=True):
            new, start, stop = model.map.normalised(data[a:b])
            lead = (np.frombuffer(new, np.uint8) & 0xC0) != 0x80
            chars, start, stop = _chars(new), start[lead], stop[lead]
            if model.trim:
                keep = chars != 0x20
                keep[1:] |= chars[:-1] != 0x20
                if len(chars) and chars[0] == 0x20:
                    keep[0] = False
                last = np.flatnonzero(chars != 0x20)
                keep[last[-1] + 1 if len(last) else 0 :] = False
                chars, start, stop = chars[keep], start[keep], stop[keep]
            parts.append(chars)
            starts.append(start)
            stops.append(stop)
            first.append(first[-1] + len(chars))
        chars, start, stop, first = np.concatenate(parts), np.concatenate(starts), np.concatenate(stops), np.array(first)
    else:
        lead = (texts.buf & 0xC0) != 0x80
        chars = _chars(texts.buf.tobytes())
        place = np.append(np.flatnonzero(lead), len(texts.buf))
        first = np.searchsorted(place, np.append(texts.starts, len(texts.buf)))
        sizes = np.diff(first)
        begin = np.repeat(texts.starts, sizes)
        start, stop = place[:-1] - begin, place[1:] - begin
    chars = np.where(chars == 0x20, np.uint32(SPACE), chars)
    if model.prefix:
        full = np.flatnonzero(np.diff(first) > 0)
        chars = np.insert(chars, first[full], np.uint32(SPACE))
        start, stop = np.insert(start, first[full], 0), np.insert(stop, first[full], 0)
        first = first + np.concatenate([[0], np.cumsum(np.diff(first) > 0)])
    return chars, start, stop, first


def _chars(data: bytes) -> np.ndarray:
    return np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)


def encode_texts(model: PieceModel, texts: textpack.Texts, *, eos: bool = True) -> Encoded:
    """Ids and source bytes of all pieces; the end id has an empty span at the text's end."""
    chars, source, source_stop, first = _normal_chars(model, texts)
    n = len(chars)
    ids, start, stop, counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    if n:
        cut = np.zeros(n, bool)
        cut[1:] = (chars[1:] == SPACE) & (chars[:-1] != SPACE)
        cut[first[:-1][np.diff(first) > 0]] = True
        alone = model.char_symbol[chars] < 0  # in no piece: such a character merges with nothing
        cut |= alone
        cut[1:] |= alone[:-1]
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], n)
        _, where, which = np.unique(textpack.Hasher(chars)(begin, end), return_index=True, return_inverse=True)
        known, at = model.encode_words(chars, begin[where], end[where])
        size = (at[1:] - at[:-1])[which]
        ids = known[_expand(at[which], size)]
        words = np.append(np.searchsorted(begin, first[:-1]), len(begin))
        total = np.concatenate([[0], np.cumsum(size)])
        counts = total[words[1:]] - total[words[:-1]]
        n_chars = model.n_chars[ids]
        after = np.cumsum(n_chars, dtype=np.int64)
        start, stop = source[np.where(n_chars > 0, after - n_chars, after - 1)], source_stop[after - 1]
    if eos:
        at = np.cumsum(counts)
        ids = np.insert(ids, at, np.int32(model.eos))
        size = texts.ends - texts.starts
        start, stop = np.insert(start, at, size), np.insert(stop, at, size)
        counts = counts + 1
    return Encoded(ids, start, stop, np.concatenate([[0], np.cumsum(counts)]))


def _encoded(model: PieceModel, batch: pa.RecordBatch, eos: bool) -> Iterator[pa.RecordBatch]:
    """The rows of a batch of ids and texts, encoded and decoded, a batch for each piece of it."""
    for texts in textpack.pieces(batch.column(1), PIECE):
        made = encode_texts(model, texts, eos=eos)
        cuts = list(zip(made.first[:-1].tolist(), made.first[1:].tolist(), strict=True))
        decoded = [model.decode(made.ids[a:b]) for a, b in cuts]
        offsets = pa.array(made.first, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (made.ids, made.start, made.stop)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)[texts.rows], *lists, pa.array(decoded, pa.binary()).cast(pa.string())],
            ["_id", "ids", "starts", "stops", "decoded"],
        )


def encode_documents(
    docs: DataFrame, model_file: str, *, eos: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(<id_col>, ids, starts, stops, decoded)``, a row for each row of ``docs``.

    Ids are those of the sentencepiece library for the model, with the end id if ``eos``. Piece ``i`` comes from
    the bytes ``starts[i]`` up to ``stops[i]`` of the UTF-8 text; pieces for single bytes have the span of their
    whole character, the added first space and the end id an empty one. ``decoded`` is the text of the ids.
    Null is an empty text. The model file is read on the driver and goes to the tasks, so executors
    need no copy. Whole texts are encoded, half a megabyte at a time; other columns are not read.
    """
    with open(model_file, "rb") as f:
        model = shared(docs.sparkSession, PieceModel(f.read()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model()
        for batch in batches:
            yield from _encoded(own, batch, eos)

    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    ints = T.ArrayType(T.IntegerType())
    fields = [T.StructField("_id", docs.schema[id_col].dataType), *(T.StructField(c, ints) for c in ("ids", "starts", "stops"))]
    return source.mapInArrow(scan, T.StructType([*fields, T.StructField("decoded", T.StringType())])).withColumnRenamed("_id", id_col)
