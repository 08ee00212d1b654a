"""Alignment of two tokenisers over the same texts, by words over which no token of either reaches.

A word is white space and what follows up to the next one; where a model has tokens that reach over that border, a
whole text is one word. Words come again and again, so each different one (by a 64-bit hash of its bytes) is
tokenised by both and aligned once in a block of documents and remembered, many new ones in one text. A document is its list of words, and all it is asked for is a sum over
them. Which ids go together most often is counted over documents: blocks send each of their different id
pairs once, with how many of their documents hold it, and get the corpus' counts back by joins on 64-bit
numbers; texts and tokens stay where they are.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.llm import textpack
from itemflow.llm.scratch import once_per_worker, stored
from itemflow.llm.token_files import Column, _counted, spread

#: A block is closed once its texts have so many bytes, each document so many more; a longer text is a block of its own.
BLOCK, ROOM = 4 << 20, 64
#: A block is kept in rows of so many bytes: Spark copies whole rows, and every buffer they pass through grows with the largest.
PART = 64 << 10
#: How such rows are written: pages are closed after a few of them, and groups of rows at about this size.
SMALL_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "8"}
#: Fixed value: the sign that stands for a space in pieces.
SPACE_SIGN = "▁"
#: Bytes of text that are cut into words at once.
PIECE = 256 << 10
#: Groups with more links than this are counted by different ids.
SMALL = 64
#: Pairs of documents with so many words are looked at together.
HELD = 1 << 16
#: So many new words are tokenised in one text.
TOGETHER = 64
#: Stands before new words, so that the first of them begins as it does in its text.
BEFORE = b" a"
#: What words begin with, and the last bytes of characters of two and three that Unicode counts, or once counted, as white space.
BORDER = np.zeros(256, bool)
BORDER[[0x0A, 0x20]] = True
_WHITE: dict[int, list[int]] = {2: [], 3: []}
for _c in "\x85\xa0\u1680\u180e\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(map(chr, range(0x2000, 0x200C))):
    _WHITE[len(_c.encode())].append(int.from_bytes(_c.encode(), "big"))


class Tokens:
    """Bytes of every token of a vocabulary."""

    def __init__(self, bodies: list[bytes]):
        self.size = np.array([len(b) for b in bodies], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(bodies), np.uint8)
        self.spaced = np.array([b[:1] == b" " for b in bodies])

    def bytes(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spread(self.start[ids], self.size[ids])]


class Pair:
    """The two tokenisers: byte-level pairs of the ``tokenizers`` library (a), pieces of ``sentencepiece`` (b).

    Special strings in a text are plain text; the first puts a space before a text as the second does by itself.
    """

    def __init__(self, spec: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(spec)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = {c: b for b, c in _byte_letters().items()}
        by_id = {i: t for t, i in json.loads(spec)["model"]["vocab"].items()}
        by_id = {i: bytes(letters[c] for c in t) if set(t) <= letters.keys() else t.encode() for i, t in by_id.items()}
        self.a = Tokens([by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)])
        self.b = Tokens([self._piece(i) for i in range(self.second.get_piece_size())])
        #: Ids in decimal: a row of digits for each, room for a sign behind them, and which of a row counts.
        texts = [str(i).encode() for i in range(max(len(self.a.size), len(self.b.size)))]
        most = max(map(len, texts), default=0) + 1
        self.width = np.array([len(t) for t in texts], np.int64)
        self.digits = np.frombuffer(b"".join(t.ljust(most) for t in texts), np.uint8).reshape(-1, most)
        self.written = np.arange(most) <= self.width[:, None]
        self.by_word = self._keeps_words(json.loads(spec))

    def _keeps_words(self, spec: dict) -> bool:
        """Whether a text's ids are those of its words, for both models."""
        cut = spec["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        plain = plain and not (spec["normalizer"] or spec["post_processor"] or spec["truncation"] or spec["padding"])
        plain = plain and all(t["special"] for t in spec["added_tokens"])
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size()) if not self.second.is_byte(i)]
        over = re.compile(f"[^\\s{SPACE_SIGN}][\n {SPACE_SIGN}]")
        probe = " a  \ufb01\u2460\xa0e\u0301\uff21\n "
        same = self.second.normalize(probe) == (" " + probe).replace(" ", SPACE_SIGN)
        if not (plain and same) or any(over.search(p) for p in pieces):
            return False
        a, b = self.encode([BEFORE[1:].decode()])
        return self.a.bytes(_flat(a)).tobytes() == self.b.bytes(_flat(b)).tobytes() == BEFORE

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.second.is_byte(i) else piece.replace(SPACE_SIGN, " ").encode()

    def encode(self, texts: list[str]) -> tuple[list, list]:
        made = self.first.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in made], self.second.encode(texts, num_threads=1)


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else the next from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Block:
    """Words and their linked id pairs, for some documents; words are numbered as they come."""

    def __init__(self, pair: Pair, keep_groups: bool) -> None:
        self.pair, self.keep = pair, keep_groups
        #: Known words by the hash of their bytes, ascending, with their numbers.
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        #: Of each word: whether its tokens have its bytes, how many tokens of a and b, groups and links, its groups as text.
        self.good, self.totals = Column(bool), [Column(np.int64) for _ in range(4)]
        self.groups: list[bytes] = []
        #: Of each word in order: how many different pairs, which (a * ids of b + b), how often.
        self.counts: list[np.ndarray] = []
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.keys: list[pa.Array] = []
        self.docs: list[np.ndarray] = []
        self.digests: list[str] = []
        self.texts: list[str | None] = []
        self.windows: list[np.ndarray] = []
        self.bytes = 0

    def add(self, keys: pa.Array, texts: textpack.Texts) -> None:
        """Cut some documents into words and tokenise and align those that are new."""
        full = texts.ends > texts.starts
        body = np.insert(texts.buf, texts.starts[full], 32)
        sizes = texts.ends - texts.starts + full
        doc_at = np.cumsum(sizes) - sizes
        start = _word_starts(body, doc_at[full], self.pair.by_word)
        end = np.append(start[1:], len(body))[: len(start)]
        per_doc = np.diff(np.append(np.searchsorted(start, doc_at), len(start)))
        which = self._known(body, start, end)
        lost = _sums(~self.good.data[which], per_doc) > 0
        which, per_doc = which[~np.repeat(lost, per_doc)], np.where(lost, 0, per_doc)
        self.keys.append(keys)
        self.bytes += len(body) + ROOM * len(texts)
        self.docs.append(np.stack([*(_sums(c.data[which], per_doc) for c in self.totals), per_doc]))
        self.windows.append(which.astype(np.uint32))
        whole, stops = which.tolist(), np.cumsum(per_doc).tolist()
        for low, high in zip([0, *stops], stops):
            own = b"".join(map(self.groups.__getitem__, whole[low:high]))[:-1]
            self.digests.append(hashlib.sha256(own).hexdigest() if own else "")
            self.texts.append(own.decode() if self.keep else None)

    def _known(self, body: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each word; those that are new are tokenised and aligned, each different one once."""
        found, where, which = _first(textpack.Hasher(body)(start, end))
        at = np.searchsorted(self.hashes, found)
        old = np.zeros(len(found), bool)
        inside = at < len(self.hashes)
        old[inside] = self.hashes[at[inside]] == found[inside]
        numbers = np.empty(len(found), np.int64)
        numbers[old] = self.numbers[at[old]]
        new = np.flatnonzero(~old)
        if len(new):
            data = body.tobytes()
            low, high = start[where[new]], end[where[new]]
            words = [data[i:j] for i, j in zip(low.tolist(), high.tolist(), strict=True)]
            numbers[new] = len(self.hashes) + np.arange(len(new))
            self.hashes = np.insert(self.hashes, at[new], found[new])
            self.numbers = np.insert(self.numbers, at[new], numbers[new])
            self._learn(words, _solid(body, high))
        return numbers[which]

    def _learn(self, words: list[bytes], solid: np.ndarray) -> None:
        """Number new words, in order. One whose tokens' bytes differ from it has none, and ``good`` tells.

        Words that end in white space stand at the end of a text and so are tokenised alone.
        """
        pair = self.pair
        some = np.flatnonzero(solid).tolist() if pair.by_word else []
        alone = np.flatnonzero(~solid).tolist() if pair.by_word else list(range(len(words)))
        groups = [some[i : i + TOGETHER] for i in range(0, len(some), TOGETHER)] + [[k] for k in alone]
        before = BEFORE if pair.by_word else b""
        bodies = [before + b"".join([words[k] for k in g]) for g in groups]
        ids_a, ids_b, same = self._tokenised(bodies)
        if not all(same):
            odd = [[k] for g, s in zip(groups, same, strict=True) if not s for k in g]
            made = self._tokenised([before + words[k] for k, in odd])
            ids_a, ids_b = ([x for x, s in zip(ids, same, strict=True) if s] + y for ids, y in zip((ids_a, ids_b), made, strict=False))
            groups = [g for g, s in zip(groups, same, strict=True) if s] + odd
            same = [True] * (len(groups) - len(odd)) + made[2]
        kept = [(g, x, y) for g, x, y, s in zip(groups, ids_a, ids_b, same, strict=True) if s]
        order = np.array([k for g, _, _ in kept for k in ([-1, *g] if before else g)], np.int64)
        size = np.array([len(words[k]) if k >= 0 else len(before) for k in order.tolist()], np.int64)
        self._align(len(words), order, size, _flat([x for _, x, _ in kept]), _flat([y for _, _, y in kept]))

    def _tokenised(self, bodies: list[bytes]) -> tuple[list, list, list[bool]]:
        """Ids of both for texts, given with the space before each, and whether both have the bytes of the text."""
        pair = self.pair
        ids_a, ids_b = pair.encode([b[1:].decode("utf-8", "replace") for b in bodies])
        same = np.ones(len(bodies), bool)
        whole, sizes = np.frombuffer(b"".join(bodies), np.uint8), np.array([len(b) for b in bodies], np.int64)
        for made, tokens in ((ids_a, pair.a), (ids_b, pair.b)):
            flat, n = _flat(made), np.array([len(i) for i in made], np.int64)
            if (_sums(tokens.size[flat], n) == sizes).all():
                same &= _sums(tokens.bytes(flat) != whole, sizes) == 0
            else:
                same &= [tokens.bytes(_flat([i])).tobytes() == b for i, b in zip(made, bodies, strict=True)]
        return ids_a, ids_b, same.tolist()

    def _align(self, count: int, order: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Groups and links of ``count`` new words, of which those of ``order`` stand in the tokens, joined; -1 is no word."""
        pair, n, at = self.pair, int(size.sum()), np.cumsum(size) - size
        ends_a, ends_b = np.cumsum(pair.a.size[a]), np.cumsum(pair.b.size[b])
        start_a, start_b = ends_a - pair.a.size[a], ends_b - pair.b.size[b]
        both = np.zeros(n + 1, np.uint8)
        both[ends_a] = 1
        both[ends_b] += 1
        group_at = np.cumsum(both == 2)  # groups that end up to each byte
        in_a, in_b = (np.bincount(group_at[s], minlength=int(group_at[-1])) for s in (start_a, start_b))
        first_group = group_at[np.append(at, n)]
        of = np.full(count, -1, np.int64)  # where each word stands
        there = order >= 0
        of[order[there]] = np.flatnonzero(there)
        good = of >= 0
        low, high = (np.where(good, first_group[of + k], 0) for k in (0, 1))
        groups_of = high - low
        group = spread(low, groups_of)
        self.good.add(good)
        for total, of_group in zip(self.totals, (in_a, in_b, np.ones(len(in_a), np.int64), in_a * in_b), strict=True):
            total.add(_sums(of_group[group], groups_of))
        self._write_groups(a, b, in_a, in_b, group, groups_of)
        self._link(a, b, in_a, in_b, low, high)

    def _link(self, a, b, in_a, in_b, first: np.ndarray, last: np.ndarray) -> None:
        """The different id pairs of some words, given by their groups, and how often each is linked."""
        group, window = spread(first, last - first), np.repeat(np.arange(len(first)), last - first)
        at_a, at_b = (np.cumsum(x) - x for x in (in_a, in_b))
        wide, links = len(self.pair.b.size), in_a[group] * in_b[group]
        small = np.flatnonzero(links <= SMALL)
        g, n = group[small], links[small]
        step = spread(np.zeros(len(n), np.int64), n)
        own = np.repeat(in_b[g], n)
        codes = a[np.repeat(at_a[g], n) + step // own] * wide + b[np.repeat(at_b[g], n) + step % own]
        found, times = [np.repeat(window[small], n)], [np.ones(len(codes), np.int64)]
        codes = [codes]
        for k in np.flatnonzero(links > SMALL).tolist():  # by different ids, not one by one
            i, j = group[k], window[k]
            xs, nx = np.unique(a[at_a[i] : at_a[i] + in_a[i]], return_counts=True)
            ys, ny = np.unique(b[at_b[i] : at_b[i] + in_b[i]], return_counts=True)
            codes.append((xs[:, None] * wide + ys).ravel())
            times.append((nx[:, None] * ny).ravel())
            found.append(np.full(len(codes[-1]), j))
        window, codes, times = np.concatenate(found), np.concatenate(codes), np.concatenate(times)
        order = np.lexsort((codes, window))
        window, codes, times = window[order], codes[order], times[order]
        new = np.ones(len(codes), bool)
        new[1:] = (window[1:] != window[:-1]) | (codes[1:] != codes[:-1])
        begin = np.flatnonzero(new)
        self.counts.append(np.bincount(window[begin], minlength=len(first)))
        self.codes.append(_narrow(codes[begin]))
        self.times.append(_narrow(np.add.reduceat(times, begin) if len(begin) else times))

    def _write_groups(self, a, b, in_a, in_b, group: np.ndarray, groups_of: np.ndarray) -> None:
        """Each word's groups as text, ``a1,a2|b1;a3|b2;``."""
        at_a, at_b = (np.cumsum(x) - x for x in (in_a, in_b))
        n_a, n_b = in_a[group], in_b[group]
        size = n_a + n_b
        start, total = np.cumsum(size) - size, int(size.sum())
        ids, between = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[spread(start, n_a)] = a[spread(at_a[group], n_a)]
        ids[spread(start + n_a, n_b)] = b[spread(at_b[group], n_b)]
        between[start + n_a - 1] = ord("|")
        between[start + size - 1] = ord(";")
        width = self.pair.width[ids]
        rows = self.pair.digits[ids]
        rows[np.arange(total), width] = between
        whole, end = rows[self.pair.written[ids]].tobytes(), np.cumsum(width + 1)
        ends = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(size)])[np.cumsum(groups_of)]].tolist()
        self.groups += [whole[low:high] for low, high in zip([0, *ends], ends)]

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """All of the block in rows of about ``PART`` bytes, each with its share of every list and of all packed bytes."""
        none = np.zeros(0, np.int64)
        docs, counts = np.concatenate(self.docs, axis=1), np.concatenate([none, *self.counts])
        windows = np.concatenate([np.zeros(0, np.uint32), *self.windows])
        pairs, of = _counted(np.concatenate([none, *self.codes]))[::2]
        wide = len(self.pair.b.size)
        lists = [
            pa.concat_arrays(self.keys), *[pa.array(docs[c]) for c in range(4)], pa.array(self.digests, pa.string()), pa.array(self.texts, pa.string()),
            pa.array(docs[4]), pa.array((pairs // wide) << 32 | pairs % wide), pa.array(_holders(windows, docs[4], counts, of, len(pairs))),
        ]
        packed = [_packed(p) for p in (windows, counts, of, np.concatenate([none, *self.times]))]
        parts = max(1, -(-(sum(x.nbytes for x in lists) + sum(map(len, packed))) // PART))
        for k in range(parts):
            own, data = ([x[len(x) * k // parts : len(x) * (k + 1) // parts] for x in some] for some in (lists, packed))
            cells = [pa.array([block], pa.int64()), pa.array([k], pa.int32()), pa.array([len(pairs) * k // parts], pa.int32())]
            cells += [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in own]
            yield pa.RecordBatch.from_arrays([*cells, *[pa.array([d], pa.binary()) for d in data]], COLUMNS)


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _packed(values: np.ndarray) -> bytes:
    """Numbers in as many bytes each as the largest needs, 1, 2 or 4; the first byte tells."""
    width = next(w for w in (1, 2, 4) if not len(values) or int(values.max()) < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def _whole(rows: pa.Table) -> dict[str, pa.Array | np.ndarray]:
    """Lists and packed numbers of a block, from its rows in any order."""
    rows = rows.take(pa.array(np.argsort(rows.column("part").to_numpy())))
    lists = {c: pa.concat_arrays([x.flatten() for x in rows.column(c).chunks]) for c in LISTS if c in rows.column_names}
    return lists | {c: _unpacked(b"".join(rows.column(c).to_pylist())) for c in PACKED}


def _solid(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether what ends at each place is a character, and none that may count as white space."""
    last = body[at - 1]
    solid, high = last > 0x20, np.flatnonzero(last >= 0x80)
    place = at[high]
    two = body[place - 2].astype(np.int64) << 8 | body[place - 1]
    three = body[np.maximum(place - 3, 0)].astype(np.int64) << 16 | two
    solid[high[np.isin(two, _WHITE[2]) | np.isin(three, _WHITE[3])]] = False
    return solid


def _word_starts(body: np.ndarray, doc_at: np.ndarray, by_word: bool) -> np.ndarray:
    """Where words begin: each text, and each white space behind a character that is none."""
    head = np.zeros(len(body), bool)
    head[doc_at] = True
    if by_word:
        border = BORDER[body]
        at = np.flatnonzero(border[1:] & ~border[:-1]) + 1
        head[at[_solid(body, at)]] = True
    return np.flatnonzero(head)


def _first(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values, ascending, where each is first, and which of them each value is."""
    found, which = _counted(values)[::2]
    where = np.empty(len(found), np.int64)
    where[which[::-1]] = np.arange(len(which))[::-1]
    return found, where, which


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _holders(windows: np.ndarray, per_doc: np.ndarray, counts: np.ndarray, of: np.ndarray, n_pairs: int) -> np.ndarray:
    """How many documents hold each pair; some documents with at least so many words at a time, as their pairs are many."""
    n, wide, first, out = max(len(counts), 1), max(n_pairs, 1), np.cumsum(counts) - counts, np.zeros(n_pairs, np.int64)
    stops, at, begin = np.cumsum(per_doc), 0, 0
    while at < len(per_doc):
        to = min(int(np.searchsorted(stops, begin + HELD)) + 1, len(per_doc))
        end = int(stops[to - 1])
        own = _distinct(np.repeat(np.arange(to - at), per_doc[at:to]) * n + windows[begin:end])
        doc, window = own // n, own % n
        many = counts[window]
        held = _distinct(np.repeat(doc, many) * wide + of[spread(first[window], many)])
        out += np.bincount(held % wide, minlength=n_pairs)
        at, begin = to, end
    return out


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of neighbouring values, ``counts[i]`` of them for each ``i``."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


LISTS = ["keys", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "n_windows", "pairs", "holders"]
PACKED = ["windows", "window_pairs", "pair_of", "pair_times"]
#: ``first``: which of the block's pairs is the first of a row.
COLUMNS = ["block", "part", "first", *LISTS, *PACKED]


@dataclass(frozen=True)
class Alignment:
    """``blocks``: some rows for each block of documents. ``pairs``: (pair, a, b, documents, best), one row for each linked id pair."""

    blocks: DataFrame
    pairs: DataFrame
    key: str

    def documents(self) -> DataFrame:
        """``(<key>, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups)``, a row for each document."""
        blocks = self.blocks
        kind = blocks.schema["keys"].dataType.elementType
        asked = blocks.select(F.col("block").alias("of_block"), "first", F.posexplode("pairs").alias("at", "pair"))
        asked = asked.select("of_block", (F.col("first") + F.col("at")).alias("at"), "pair")
        told = asked.join(self.pairs.select("pair", "documents", "best"), "pair").select("of_block", "at", "documents", "best")

        def answer(rows: pa.Table, counts: pa.Table) -> pa.Table:
            row = _whole(rows)
            at = counts.column("at").to_numpy()
            documents, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            documents[at], best[at] = counts.column("documents").to_numpy(), counts.column("best").to_numpy(zero_copy_only=False)
            windows, window_pairs, of, times = (row[c] for c in PACKED)
            n_windows = row["n_windows"].to_numpy()
            sums = [_sums(_sums(times * v[of], window_pairs)[windows], n_windows) for v in (best, documents)]
            plain = [row[c] for c in ("keys", "n_a", "n_b", "n_groups", "n_links")]
            return pa.Table.from_arrays(
                [*plain, *map(pa.array, sums), row["groups_sha256"], row["groups"]],
                ["_key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"],
            )

        fields = [T.StructField("_key", kind)]
        fields += [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
        fields += [T.StructField("groups_sha256", T.StringType()), T.StructField("groups", T.StringType())]
        both = blocks.drop("first", "pairs", "holders").groupBy("block").cogroup(told.groupBy("of_block"))
        return both.applyInArrow(answer, T.StructType(fields)).withColumnRenamed("_key", self.key)


def align_documents(
    docs: DataFrame, byte_file: str, piece_file: str, *, key: str = "doc_id", text: str = "text", keep_groups: bool = False,
    block_bytes: int = BLOCK,
) -> Alignment:
    """Align the tokens of a byte-level file (a) and of a piece model (b) over whole texts, a space before each.

    Groups are cut where tokens of both end; all of a group's ids are linked with each other. Null and empty texts,
    and those whose tokens' bytes are not a space and the text, have no tokens. ``groups`` lists a document's groups as
    ``a1,a2|b1;a3|b2`` if ``keep_groups``, else it is null. Rows that repeat are rows like others, ids may repeat or be
    null, and other columns are not read. An empty table has no rows and no pairs.
    """
    with open(byte_file, encoding="utf-8") as f:
        spec = f.read()
    with open(piece_file, "rb") as f:
        made = once_per_worker(docs.sparkSession, Pair, spec, f.read())
    kind = docs.schema[key].dataType

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = made()
        number = TaskContext.get().partitionId() << 33
        block = Block(pair, keep_groups)
        for batch in batches:
            column = batch.column(1)
            for texts in textpack.pieces(column, PIECE):
                if block.bytes and block.bytes + len(texts.buf) > block_bytes:
                    yield from block.rows(number)
                    number, block = number + 1, Block(pair, keep_groups)
                block.add(batch.column(0)[texts.rows], texts)
        if block.docs:
            yield from block.rows(number)

    long, whole = T.LongType(), T.ArrayType(T.LongType())
    kinds = [long, T.IntegerType(), T.IntegerType(), T.ArrayType(kind), *[whole] * 4, *[T.ArrayType(T.StringType())] * 2, *[whole] * 3, *[T.BinaryType()] * 4]
    schema = T.StructType([T.StructField(c, k) for c, k in zip(COLUMNS, kinds, strict=True)])
    source = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    blocks = stored(source.mapInArrow(scan, schema), "align-blocks", plain=PACKED, options=SMALL_GROUPS)
    held = blocks.select(F.inline(F.arrays_zip("pairs", "holders"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("documents"))
    held = stored(held.select("pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "documents"), "align-pairs")
    most = held.groupBy("a").agg(F.max("documents").alias("_most"))
    pairs = held.join(most, "a").select("pair", "a", "b", "documents", (F.col("documents") == F.col("_most")).alias("best"))
    return Alignment(blocks, stored(pairs, "align-best"), key)
