"""Token ids in binary files: shards in key order, each compressed by a grammar of repeated pairs.

Rows are dealt by key and encoded in order; a shard is the ids of some neighbouring documents. In a shard
frequent pairs of ids are replaced by new symbols, again and again, until none is frequent. A file keeps the
rules, how many ids each symbol stands for, and the positions of every so many symbols, so any stretch of ids
is decoded from the symbols that cover it. Spark's committer writes the shards, rows of a Parquet table whose
``payload`` has the format of ``Grammar.to_bytes``; so a lost or doubled task leaves no half shard, and the
files may lie wherever Spark can write.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.llm import textpack
from itemflow.llm.scratch import once_per_worker

#: A shard is closed once it has so many ids; a longer document is a shard of its own.
SHARD = 1 << 19
#: A pair is frequent if it is there so many times.
LEAST = 16
#: A round takes pairs down to this share of the most frequent one.
SHARE = 32
#: Every so many symbols their position is stored.
MARK = 256
MAGIC = b"RPG1"
#: So many words are remembered, or so many bytes of them, each word in one of so many places.
REMEMBERED, REMEMBERED_BYTES, PROBES = 1 << 20, 12 << 20, 8
#: Bytes of text that are encoded at once.
PIECE = 512 << 10
#: A number sign: a word of its own wherever it stands, so words between two of them are encoded as if alone.
SIGN, TOGETHER = "\u2460".encode(), 256
_HASH, _BITS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)), 18


def spread(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ...``, ``counts[i]`` numbers for each ``i``."""
    return np.repeat(start - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))


@dataclass
class Grammar:
    """``terminals``: ids by symbol; rule ``k`` makes symbol ``len(terminals) + k`` of ``left[k], right[k]``.

    ``rounds``: how many rules each round made; the rules of a round use symbols of earlier ones only.
    ``lengths``: ids that each rule stands for. ``marks``: position of every ``MARK``-th symbol of ``symbols``.
    """

    n_ids: int
    terminals: np.ndarray
    rounds: np.ndarray
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    marks: np.ndarray
    symbols: np.ndarray

    def to_bytes(self) -> bytes:
        """Magic, nine 64-bit sizes, then the arrays, little-endian; symbols in 16 bits where they fit."""
        width = 2 if len(self.terminals) + len(self.left) <= 1 << 16 else 4
        parts = [self.terminals, self.rounds, self.left, self.right, self.lengths, self.marks]
        sizes = [self.n_ids, width, *(len(p) for p in parts), len(self.symbols)]
        body = [p.astype("<u4").tobytes() for p in parts] + [self.symbols.astype(f"<u{width}").tobytes()]
        return b"".join([MAGIC, np.array(sizes, "<i8").tobytes(), *body])

    @staticmethod
    def from_bytes(data: bytes) -> Grammar:
        if data[:4] != MAGIC:
            raise ValueError("no shard of token ids")
        sizes = np.frombuffer(data, "<i8", 9, 4).tolist()
        at, parts = 4 + 72, []
        for n, width in zip(sizes[2:], [4] * 6 + [sizes[1]], strict=True):
            parts.append(np.frombuffer(data, f"<u{width}", n, at))
            at += n * width
        return Grammar(sizes[0], *parts)

    def bodies(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all symbols in one array, where each symbol's start and how many they are."""
        n = len(self.terminals)
        size = np.concatenate([np.ones(n, np.int64), self.lengths.astype(np.int64)])
        start = np.cumsum(size) - size
        flat = np.empty(int(size.sum()), np.uint32)
        flat[:n] = self.terminals
        pair = np.stack([self.left, self.right], 1).astype(np.int64)
        done = 0
        for count in self.rounds.tolist():
            of = pair[done : done + count].ravel()
            where = spread(start[of], size[of])
            first = int(start[n + done])
            flat[first : first + len(where)] = flat[where]
            done += count
        return flat, start, size

    def ids(self, begin: int = 0, end: int | None = None, bodies: tuple | None = None) -> np.ndarray:
        """Ids ``begin`` up to ``end``, from the symbols that cover them."""
        end = self.n_ids if end is None else min(end, self.n_ids)
        if begin >= end:
            return np.zeros(0, np.uint32)
        flat, start, size = bodies or self.bodies()
        block = int(np.searchsorted(self.marks, begin, side="right")) - 1
        stop = int(np.searchsorted(self.marks, end, side="left")) * MARK
        part = self.symbols[block * MARK : stop].astype(np.int64)
        skip = begin - int(self.marks[block])
        return flat[spread(start[part], size[part])][skip : skip + end - begin]


def compress(ids: np.ndarray, least: int = LEAST) -> Grammar:
    """Re-Pair, many pairs a round: the most frequent ones that cannot overlap are replaced at once.

    In a round a symbol is the left or the right part of all pairs taken, so that no two occurrences share an id and
    their order does not matter. Of a run of equal symbols every second pair is taken.
    """
    ids = np.asarray(ids, np.uint32)
    if len(ids) and int(ids.max()) < 1 << 22:
        there = np.zeros(int(ids.max()) + 1, bool)
        there[ids] = True
        terminals, seq = np.flatnonzero(there).astype(np.uint32), (np.cumsum(there, dtype=np.uint32) - np.uint32(1))[ids]
    else:
        terminals, seq = np.unique(ids, return_inverse=True)
        seq = seq.astype(np.uint32)
    n = len(terminals)
    length = np.ones(n, np.int64)
    left, right, rounds = [], [], []
    limit = len(seq)
    while len(seq) > 1:
        slot = ((seq[:-1] * _HASH[0] + seq[1:] * _HASH[1]) >> np.uint32(32 - _BITS)).astype(np.int64)
        full = np.bincount(slot, minlength=1 << _BITS)  # at least as many as any pair in the slot
        limit = max(least, min(limit, int(full.max()) // SHARE))
        while True:
            at = np.flatnonzero((full >= limit)[slot])
            keys, counts, which = _counted(seq[at].astype(np.int64) << 32 | seq[at + 1])
            often = counts >= limit
            if often.any() or limit == least:
                break
            limit = max(least, limit // SHARE)
        if not often.any():
            break
        pairs = _apart(keys[often], counts[often])
        number = np.full(len(keys), -1, np.int64)
        number[np.searchsorted(keys, pairs)] = np.arange(len(pairs))
        found = number[which]
        hit = found >= 0
        at, found = at[hit], found[hit]
        twin = (pairs >> 32) == (pairs & 0xFFFFFFFF)
        if twin.any():
            at, found = _every_second(at, found, twin)
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        left.append(a)
        right.append(b)
        rounds.append(len(pairs))
        length = np.concatenate([length, length[a] + length[b]])
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq[at] = n + found
        seq = seq[np.flatnonzero(stay)]
        n += len(pairs)
    none = np.zeros(0, np.int64)
    position = np.cumsum(length[seq]) - length[seq]
    return Grammar(
        len(ids), terminals, np.array(rounds, np.int64), np.concatenate([none, *left]), np.concatenate([none, *right]),
        length[len(terminals) :], position[::MARK], seq,
    )


def _codes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values as they first come, and which of them each value is."""
    made = pa.array(values).dictionary_encode()
    return made.dictionary.to_numpy(), made.indices.to_numpy()


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values, ascending, how often each is there, and which of them each value is."""
    some, which = _codes(values)
    order = np.argsort(some)
    place = np.empty(len(some), np.int64)
    place[order] = np.arange(len(some))
    return some[order], np.bincount(which, minlength=len(some))[order], place[which]


def _apart(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Pairs, ascending, of which no two occurrences overlap: taken by count, each symbol on one side only."""
    side: dict[int, int] = {}
    taken = []
    order = np.argsort(-counts, kind="stable")
    for a, b in zip((pairs[order] >> 32).tolist(), (pairs[order] & 0xFFFFFFFF).tolist(), strict=True):
        if a == b:
            if a in side:
                continue
            side[a] = 2
        elif side.get(a, 0) or side.get(b, 1) != 1:
            continue
        else:
            side[a], side[b] = 0, 1
        taken.append(a << 32 | b)
    return np.sort(np.array(taken, np.int64))


def _every_second(at: np.ndarray, found: np.ndarray, twin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of neighbouring occurrences of a pair of equal symbols the first, third and so on."""
    begins = np.ones(len(at), bool)
    begins[1:] = (at[1:] != at[:-1] + 1) | (found[1:] != found[:-1])
    index = np.arange(len(at))
    first = np.maximum.accumulate(np.where(begins, index, 0))
    keep = ~twin[found] | ((index - first) % 2 == 0)
    return at[keep], found[keep]


class Column:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.data, self.n = np.empty(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> None:
        n = self.n + len(values)
        if n > len(self.data):
            grown = np.empty(max(n, 2 * len(self.data)), self.data.dtype)
            grown[: self.n] = self.data[: self.n]
            self.data = grown
        self.data[self.n : n] = values
        self.n = n


class Remembered:
    """Ids of words, which are found by hash and then compared byte by byte; at most ``most`` words."""

    def __init__(self, most: int):
        self.bits = (2 * most - 1).bit_length()
        self.hashes = np.zeros(1 << self.bits, np.uint64)  # 0: free
        self.word = np.zeros(1 << self.bits, np.int32)
        self.first, self.size, self.text = Column(np.int64), Column(np.int32), Column(np.uint8)
        self.first_id, self.n_ids, self.ids = Column(np.int64), Column(np.int32), Column(np.uint32)

    def __len__(self) -> int:
        return self.size.n

    def _slots(self, hashes: np.ndarray, k: int) -> np.ndarray:
        return ((hashes >> np.uint64(64 - self.bits)).astype(np.int64) + k) & ((1 << self.bits) - 1)

    def find(self, hashes: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each word ``buf[start:end]``, -1 if it is not here."""
        word, left = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for k in range(PROBES):
            slot = self._slots(hashes[left], k)
            there = self.hashes[slot]
            same = there == hashes[left]
            word[left[same]] = self.word[slot[same]]
            left = left[~same & (there != 0)]
        size = end - start
        known = np.flatnonzero(word >= 0)
        other = self.size.data[word[known]] != size[known]
        word[known[other]] = -1
        known = known[~other]
        counts = size[known]
        unlike = self.text.data[spread(self.first.data[word[known]], counts)] != buf[spread(start[known], counts)]
        if unlike.any():
            word[known[np.repeat(np.arange(len(known)), counts)[unlike]]] = -1
        return word

    def add(self, hashes: np.ndarray, words: list[bytes], ids: list[bytes]) -> None:
        """New words. One for which all its places are taken is not found again."""
        number, left = np.arange(len(words)) + len(self), np.arange(len(words))
        for k in range(PROBES):
            slot = self._slots(hashes[left], k)
            free = self.hashes[slot] == 0
            self.hashes[slot[free]] = hashes[left[free]]
            self.word[slot[free]] = number[left[free]]
            placed = free & (self.word[slot] == number[left])
            left = left[~placed]
        for first, size, pool, made, width in ((self.first, self.size, self.text, words, 1), (self.first_id, self.n_ids, self.ids, ids, 4)):
            sizes = np.fromiter(map(len, made), np.int64, len(made)) // width
            first.add(np.cumsum(sizes) - sizes + pool.n)
            size.add(sizes)
            pool.add(np.frombuffer(b"".join(made), pool.data.dtype))


class WordEncoder:
    """The ``tokenizers`` library over whole texts, with the ids of each different word remembered.

    Words end at ASCII white space, which a model of this kind drops before it looks for tokens; of a model that is
    of another kind whole texts are encoded. Special strings in a text are handled as the library does by default.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(spec)
        made = json.loads(spec)
        #: The same model behind words that are letters in lower case already; ASCII stands for itself among its bytes.
        self.ascii, self.letters = Tokenizer(self.library.model), Tokenizer(self.library.model)
        self.ascii.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([self.ascii.pre_tokenizer, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.by_word = _drops_space(made) and not any(set(t["content"]) & set(" \t\n\v\f\r") for t in made["added_tokens"])
        self.known = Remembered(REMEMBERED)
        self.final = np.zeros(self.library.get_vocab_size(), bool)
        if self.by_word:
            suffix = made["model"]["end_of_word_suffix"]
            self.final[[i for t, i in made["model"]["vocab"].items() if t.endswith(suffix)]] = True
        self.sign = self.library.encode(SIGN.decode(), add_special_tokens=False).ids
        self.lower = self._two_byte_letters() if self.by_word else np.zeros(1 << 11, np.int64)

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        made = self.library.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in made]

    def _two_byte_letters(self) -> np.ndarray:
        """By code point, the letter in lower case of each letter of two bytes for which the library has one of two bytes; else 0."""
        lower = np.zeros(1 << 11, np.int64)
        for i in range(0x80, 1 << 11):
            made = self.library.normalizer.normalize_str(f"a{chr(i)}a")
            if len(made) == 3 and 0x80 <= ord(made[1]) < 1 << 11 and len(self.library.pre_tokenizer.pre_tokenize_str(made)) == 1:
                lower[i] = ord(made[1])
        return lower

    def _encode_words(self, words: list[bytes], letters: list[bool]) -> dict[bytes, bytes]:
        """Ids of different words, many in one text.

        Words of letters are in lower case and one word of the model each, so the tokens that end words tell them apart. Between
        others stands a sign that is always a word of its own; words that hold this sign are encoded alone.
        """
        out: dict[bytes, bytes] = {}
        plain = [w for w, own in zip(words, letters, strict=True) if own]
        ascii_, wide = [w for w in plain if w.isascii()], [w for w in plain if not w.isascii()]
        for library, some in ((self.ascii, ascii_), (self.letters, wide)):
            groups = [some[i : i + TOGETHER] for i in range(0, len(some), TOGETHER)]
            made = library.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)
            parts = [np.array(m.ids, np.uint32) for m in made]
            ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            data, ends = ids.tobytes(), ((np.flatnonzero(self.final[ids]) + 1) * 4).tolist()
            out.update(zip(some, [data[a:b] for a, b in zip([0, *ends], ends)], strict=True))
        others = [w for w, own in zip(words, letters, strict=True) if not own]
        odd = [w for w in others if SIGN in w]
        out.update(zip(odd, self._encode(odd), strict=True))
        out.update(self._encode_apart([w for w in others if SIGN not in w]))
        return out

    def _encode_apart(self, words: list[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        between, sign = b" " + SIGN + b" ", self.sign
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        texts = [between.join(g).decode("utf-8", "replace") for g in groups]
        for group, made in zip(groups, self.library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(made.ids, np.uint32)
            here = np.ones(max(len(ids) - len(sign) + 1, 0), bool)
            for j, token in enumerate(sign):
                here &= ids[j : j + len(here)] == token
            at = np.flatnonzero(here)
            data = ids.tobytes()
            begins, ends = [0, *((at + len(sign)) * 4).tolist()], [*(at * 4).tolist(), len(data)]
            out.update(zip(group, [data[i:j] for i, j in zip(begins, ends, strict=True)], strict=True))
        return out

    def __call__(self, texts: textpack.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's start."""
        if not self.by_word:
            data = texts.buf.tobytes()
            made = self._encode([data[a:b] for a, b in zip(texts.starts.tolist(), texts.ends.tolist(), strict=True)])
            return np.frombuffer(b"".join(made), np.uint32), np.cumsum([0, *(len(m) // 4 for m in made)])
        texts, words, letters = _words(texts, self.lower)
        some, which = _codes(texts.hasher()(words.start, words.end))
        where = np.empty(len(some), np.int64)
        where[which[::-1]] = np.arange(len(which))[::-1]  # the first of each
        some = np.maximum(some, np.uint64(1))
        start, end = words.start[where], words.end[where]
        number = self.known.find(some, texts.buf, start, end)
        new = np.flatnonzero(number < 0)
        if len(self.known) + len(new) > REMEMBERED or self.known.text.n + int((end - start)[new].sum()) > REMEMBERED_BYTES:
            self.known = Remembered(max(REMEMBERED, len(some)))
            new = np.arange(len(some))
        if len(new):
            data = texts.buf.tobytes()
            parts = [data[a:b] for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)]
            own = self._encode_words(parts, letters[where[new]].tolist())
            number[new] = np.arange(len(new)) + len(self.known)
            self.known.add(some[new], parts, [own[p] for p in parts])
        known = number[which]
        counts = self.known.n_ids.data[known].astype(np.int64)
        ids = self.known.ids.data[spread(self.known.first_id.data[known], counts)]
        return ids, np.concatenate([[0], np.cumsum(counts)])[words.first]


#: White space, letters, digits and other signs (control characters too) of ASCII; what is cut by other rules is WHOLE.
WHOLE = 4
_KIND = np.full(256, WHOLE, np.uint8)
_KIND[0x00:0x80] = 3
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = 1
_KIND[[*b"'<"]] = WHOLE
_KIND[textpack.SPACE] = 0
_KINDS, _LOWER = _KIND.tobytes(), textpack.LOWER.tobytes()


def _words(texts: textpack.Texts, lower: np.ndarray) -> tuple[textpack.Texts, textpack.Spans, np.ndarray]:
    """The words, plain ones in lower case and cut into letters, digits and signs; and which are letters.

    Plain is ASCII and what ``lower`` gives for letters of two bytes. Words with other characters, with an apostrophe
    (some endings belong to it) or with a sign that may begin a special string stay whole.
    """
    n, data = len(texts.buf), texts.buf.tobytes()
    kind = np.frombuffer(bytearray(data.translate(_KINDS)), np.uint8)
    low = np.frombuffer(bytearray(data.translate(_LOWER)), np.uint8)
    head = np.zeros(n + 1, bool)
    head[texts.starts] = True
    two = np.flatnonzero((texts.buf >= 0xC2) & (texts.buf < 0xE0))
    two = two[~head[two + 1] & (two < n - 1)]
    two = two[(texts.buf[two + 1] & 0xC0) == 0x80]
    to = lower[(texts.buf[two].astype(np.int64) & 0x1F) << 6 | texts.buf[two + 1] & 0x3F]
    two, to = two[to > 0], to[to > 0]
    kind[two] = kind[two + 1] = 1
    low[two], low[two + 1] = 0xC0 | to >> 6, 0x80 | to & 0x3F
    edge = head.copy()
    edge[1:n] |= kind[1:] != kind[:-1]
    edge[n] = True
    at = np.flatnonzero(edge)
    kinds = kind[at[:-1]]
    start, end, kinds = at[:-1][kinds > 0], at[1:][kinds > 0], kinds[kinds > 0]
    begins = np.ones(len(start), bool)  # where a word does
    begins[1:] = (start[1:] != end[:-1]) | head[start[1:]]
    word = np.cumsum(begins) - 1
    whole = np.zeros(len(start), bool)
    whole[word[kinds == WHOLE]] = True
    letters = kinds == 1
    if whole.any():
        whole = whole[word]
        same = spread(start[whole], (end - start)[whole])
        low[same] = texts.buf[same]
        ends = np.append(begins[1:], True)
        letters = (letters & ~whole)[begins | ~whole]
        start, end = start[begins | ~whole], end[ends | ~whole]
    lowered = textpack.Texts(low, texts.starts, texts.ends, texts.row)
    return lowered, textpack.Spans(start, end, lowered.index(start)), letters


def _drops_space(spec: dict) -> bool:
    """Whether white space is dropped from texts before tokens are looked for, and nothing reaches over it."""
    try:
        first = spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        #: Fixed value: the pattern of words, none of which holds white space.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        dropped = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] and first["pattern"]["Regex"] == pattern
        return dropped and set(kinds) <= {"NFC", "Replace", "Lowercase"} and not spec["post_processor"] and bool(spec["model"]["end_of_word_suffix"])
    except (KeyError, TypeError, IndexError):
        return False


def write_token_files(
    docs: DataFrame, tokenizer_file: str, path: str, *, key: str = "doc_id", text: str = "text", end_id: int | None = 2,
    shard_ids: int = SHARD, least: int = LEAST,
) -> None:
    """Encode every row's text, ``end_id`` behind it, and write the ids to ``path`` in ascending order of ``key``.

    Null texts are empty; null keys come first. Rows of one key are ordered by their text's hash. Other columns are
    not read. An empty table makes an empty one. A key with most of all rows is dealt over as many shards as it fills.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        own_encoder = once_per_worker(docs.sparkSession, WordEncoder, f.read())
    tail = np.array([] if end_id is None else [end_id], np.uint32)
    kind = docs.schema[key].dataType

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = own_encoder()
        part, before, keys, ids = TaskContext.get().partitionId(), 0, [], []

        def close() -> pa.RecordBatch:
            nonlocal before
            all_keys = pa.concat_arrays(keys)
            ends = np.cumsum([len(x) for x in ids])
            row = [
                pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([int(ends[-1])], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(all_keys)], pa.int32()), all_keys),
                pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([compress(np.concatenate(ids), least).to_bytes()], pa.binary()),
            ]
            before += int(ends[-1])
            keys.clear()
            ids.clear()
            return pa.RecordBatch.from_arrays(row, ["part", "before", "n_ids", "keys", "ends", "payload"])

        held = 0
        for batch in batches:
            for texts in textpack.pieces(batch.column(1), PIECE):
                made, first = encoder(texts)
                for k in range(len(texts)):
                    own = np.concatenate([made[first[k] : first[k + 1]], tail])
                    if held and held + len(own) > shard_ids:
                        yield close()
                        held = 0
                    keys.append(batch.column(0)[texts.row + k : texts.row + k + 1])
                    ids.append(own)
                    held += len(own)
        if keys:
            yield close()

    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()), T.StructField("n_ids", T.LongType())]
        + [T.StructField("keys", T.ArrayType(kind)), T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType())]
    )
    source = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    order = ["_key", F.xxhash64("_text").alias("_hash"), F.monotonically_increasing_id().alias("_at")]
    source = source.select(*order, "_text")
    dealt = source.repartitionByRange("_key", "_hash", "_at").sortWithinPartitions("_key", "_hash", "_at")
    dealt.select("_key", "_text").mapInArrow(shards, schema).write.parquet(path)


def _parts(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The ids up to each end as little-endian unsigned 32-bit integers, one value after the other."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * 4
    made = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))])
    return made.cast(pa.binary())


def read_token_files(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """``(<key>, start, n_tokens, ids)`` of every document in the files of ``path``.

    ``start`` is the number of ids of all documents before it; ``ids`` are its ids as little-endian unsigned 32-bit
    integers. A shard is decoded at once; ``Grammar.ids`` decodes a stretch from the symbols that cover it.
    """
    table = spark.read.parquet(path)
    kind = table.schema["keys"].dataType.elementType
    #: One row of two numbers for each task that wrote, so it may be broadcast.
    parts = table.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    parts = parts.select("part", F.expr("sum(_n) OVER (ORDER BY part) - _n").alias("_shift"))
    rows = table.join(F.broadcast(parts), "part").select((F.col("before") + F.col("_shift")).alias("_first"), "keys", "ends", "payload")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                keys, ends = batch.column(1)[k].values, np.asarray(batch.column(2)[k].values)
                grammar = Grammar.from_bytes(batch.column(3)[k].as_py())
                begins = np.concatenate([[0], ends[:-1]])
                made = _parts(grammar.ids(), ends)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(begins + batch.column(0)[k].as_py()), pa.array(ends - begins), made],
                    ["_key", "start", "n_tokens", "ids"],
                )

    fields = [T.StructField("_key", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    return rows.mapInArrow(documents, T.StructType(fields)).withColumnRenamed("_key", key)
