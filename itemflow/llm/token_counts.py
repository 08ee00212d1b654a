"""Token counts of every prefix of a text, by dynamic programming over byte-pair tokens.

The last token of a prefix is the one token that ends there and stands well beside the last token of the
prefix before it: no merge across their border comes before the merges that make the two.
So each prefix of a word costs a few look-ups, and a truncation or a budget needs no second encoding. Models:
``tokenizers`` files of byte-level pairs with an end-of-word mark, lower case, words by pattern.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.llm import textpack
from itemflow.llm.scratch import shared

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: The model's pattern of words, and the endings after an apostrophe that it names.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = "s", "t", "re", "ve", "m", "ll", "d"
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
NONE = 1 << 60
#: Prefixes of at most so many bytes are remembered, and so many of them and of words.
SHORT, REMEMBERED = 40, 400_000


class WordModel:
    """Tokens, merges and character classes of a word-level byte-pair model."""

    def __init__(self, data: str):
        spec = json.loads(data)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        end = model["end_of_word_suffix"]
        if kinds != ["NFC", "Replace", "Lowercase"] or pattern != PATTERN or not end or model["byte_fallback"]:
            raise ValueError("another kind of tokenizer than this operator knows")
        letters = _byte_letters()
        to_bytes = {c: b for b, c in letters.items()}
        vocabulary = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pair_rank = {(vocabulary[a], vocabulary[b]): r for r, (a, b) in enumerate(merges)}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token, i in vocabulary.items():
            body = token[: -len(end)] if token.endswith(end) and len(token) > len(end) else token
            (self.inner if body is token else self.final)[bytes(to_bytes[c] for c in body)] = i
        made = {vocabulary[a + b]: (vocabulary[a], vocabulary[b], r) for r, (a, b) in enumerate(merges)}
        if len(made) != len(merges):
            raise ValueError("a token is made by two merges")
        self.left = {i: _edge(i, made, 0) for i in vocabulary.values()}
        self.right = {i: _edge(i, made, 1) for i in self.inner.values()}
        #: The longest token that ends in each two bytes.
        self.reach: dict[bytes, int] = {}
        for body in (*self.inner, *self.final):
            self.reach[body[-2:]] = max(len(body), self.reach.get(body[-2:], 1))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.kind = np.zeros(0x110000, np.uint8)
        self.lower = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            group = unicodedata.category(chr(c))[0]
            if group in "LN":
                self.kind[c] = LETTER if group == "L" else NUMBER
            if len(low := chr(c).lower()) == 1:
                self.lower[c] = ord(low)
        self.kind[WHITE_SPACE] = SPACE


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else the next from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def _edge(token: int, made: dict[int, tuple[int, int, int]], side: int) -> list[tuple[int, int]]:
    """A token's outermost parts on one side, from single byte to whole, each with the rank of its merge."""
    out = []
    while token in made:
        out.append((token, made[token][2]))
        token = made[token][side]
    return [(token, -1), *reversed(out)]


class Counter:
    """Prefix counts of words, remembered up to a bound."""

    def __init__(self, model: WordModel):
        self.model = model
        self.fits: dict[tuple[int, int], bool] = {}
        self.prefixes: dict[bytes, tuple[int, int, int]] = {}
        self.words: dict[bytes, tuple[int, bytes]] = {}

    def _fit(self, a: int, b: int) -> bool:
        """Whether two tokens stay apart: follow both edges in the order of merges."""
        known = self.fits.get((a, b))
        if known is not None:
            return known
        right, left, ranks = self.model.right[a], self.model.left[b], self.model.pair_rank
        i = j = 0
        while True:
            ahead = right[i + 1][1] if i + 1 < len(right) else NONE
            other = left[j + 1][1] if j + 1 < len(left) else NONE
            across = ranks.get((right[i][0], left[j][0]), NONE)
            if across < ahead and across <= other and across < NONE:
                good = False
                break
            if ahead == other == NONE:
                good = True
                break
            if ahead <= other:
                i += 1
            else:
                j += 1
        if len(self.fits) < 2 * REMEMBERED:
            self.fits[a, b] = good
        return good

    def _next(self, word: bytes, i: int, count: list[int], last: list[int]) -> tuple[int, int, int]:
        """Tokens of ``word[:i]`` if more follows, its last token, and tokens if it ends there."""
        inner, final, most = self.model.inner, self.model.final, min(i, self.model.reach.get(word[max(0, i - 2) : i], 1))
        open_, token, closed = 0, -1, 0
        for k in range(most, 0, -1):
            part, before = word[i - k : i], i - k
            if token < 0 and (t := inner.get(part)) is not None and (not before or self._fit(last[before], t)):
                open_, token = count[before] + 1, t
                if closed:
                    break
            if not closed and (t := final.get(part)) is not None and (not before or self._fit(last[before], t)):
                closed = count[before] + 1
                if token >= 0:
                    break
        return open_, token, closed

    def word(self, word: bytes) -> tuple[int, bytes]:
        """Tokens of a word, and as 32-bit numbers those of each of its prefixes, by characters."""
        known = self.words.get(word)
        if known is not None:
            return known
        if word[:1] == b"'" and len(word) > 1 and word[1:].decode(errors="replace") in ENDINGS:
            rest = self.word(word[1:])[1]
            counts = [1, *(1 + c for c in np.frombuffer(rest, np.int32).tolist())]
            counts[-1] = self._counts(word)[-1]
        else:
            counts = self._counts(word)
        made = counts[-1], np.array(counts, np.int32).tobytes()
        if len(self.words) >= REMEMBERED:
            self.words.clear()
        self.words[word] = made
        return made

    def _counts(self, word: bytes) -> list[int]:
        count, last, out = [0], [-1], []
        prefixes = self.prefixes
        if len(prefixes) > REMEMBERED:
            prefixes.clear()
        for i in range(1, len(word) + 1):
            if i <= SHORT:
                part = word[:i]
                state = prefixes.get(part)
                if state is None:
                    state = prefixes[part] = self._next(word, i, count, last)
            else:
                state = self._next(word, i, count, last)
            count.append(state[0])
            last.append(state[1])
            if i == len(word) or word[i] & 0xC0 != 0x80:
                out.append(state[2])
        return out


def _normal_chars(model: WordModel, texts: textpack.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Characters in normal form and lower case, and where each text starts."""
    text = texts.buf.tobytes().decode("utf-8", "surrogatepass")
    if unicodedata.is_normalized("NFC", text) and "İ" not in text:
        place = np.append(np.flatnonzero((texts.buf & 0xC0) != 0x80), len(texts.buf))
        first = np.searchsorted(place, np.append(texts.starts, len(texts.buf)))
    else:
        data, parts = texts.buf.tobytes(), []
        special = re.compile("(" + "|".join(map(re.escape, model.special)) + ")")
        for a, b in zip(texts.starts.tolist(), texts.ends.tolist(), strict=True):
            own = special.split(data[a:b].decode("utf-8", "surrogatepass"))
            parts.append("".join(unicodedata.normalize("NFC", x).replace("İ", "i̇") for x in own))
        text, first = "".join(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), first


def prefix_counts(counter: Counter, texts: textpack.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each prefix of the texts, by characters in normal form, and where each text starts."""
    model = counter.model
    raw, first = _normal_chars(model, texts)
    n = len(raw)
    if not n:
        return np.zeros(0, np.int32), first
    chars = model.lower[raw]
    kind = model.kind[chars]
    cut = np.ones(n, bool)
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    cut[first[:-1][np.diff(first) > 0]] = True
    _cut_endings(chars, kind, cut, set(first.tolist()))
    marked = _cut_special(model, raw, first, cut) if (raw == 0x3C).any() else {}
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], n)
    full = np.flatnonzero(kind[begin] != SPACE)
    low, high = begin[full], end[full]
    _, where, which = np.unique(textpack.Hasher(chars)(low, high), return_index=True, return_inverse=True)
    text = chars.tobytes().decode("utf-32-le", "surrogatepass")
    made = [counter.word(text[a:b].encode("utf-8", "surrogatepass")) for a, b in zip(low[where].tolist(), high[where].tolist(), strict=True)]
    local = np.frombuffer(b"".join(m[1] for m in made), np.int32)
    size = (high - low)[where]
    at = np.cumsum(size) - size
    tokens = np.zeros(len(begin), np.int64)
    tokens[full] = np.array([m[0] for m in made], np.int64)[which]
    own = np.zeros(n, np.int32)
    own[_expand(low, high - low)] = local[_expand(at[which], high - low)]
    for a, (b, counts) in marked.items():
        tokens[np.searchsorted(begin, a)], own[a:b] = counts[-1], counts
    before = np.cumsum(tokens) - tokens
    start = before[np.searchsorted(begin, first[:-1].clip(max=n - 1))]
    before -= np.repeat(start, np.diff(np.append(np.searchsorted(begin, first[:-1]), len(begin))))
    return own + np.repeat(before, end - begin).astype(np.int32), first


def _expand(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.repeat(start - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))


def _cut_endings(chars: np.ndarray, kind: np.ndarray, cut: np.ndarray, first: set[int]) -> None:
    """A lone apostrophe before one of the endings starts a word with it."""
    n = len(chars)
    for i in np.flatnonzero((chars == 0x27) & cut).tolist():
        if i + 1 < n and cut[i + 1] and kind[i + 1] == LETTER and i + 1 not in first:
            stop = i + 1
            while stop < min(i + 3, n) and kind[stop] == LETTER and (stop == i + 1 or not cut[stop]):
                stop += 1
            for ending in ENDINGS:
                if [ord(c) for c in ending] == chars[i + 1 : min(i + 1 + len(ending), stop)].tolist():
                    cut[i + 1] = False
                    if i + 1 + len(ending) < n:
                        cut[i + 1 + len(ending)] = True
                    break


def _cut_special(model: WordModel, raw: np.ndarray, first: np.ndarray, cut: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Special strings are one token; up to its last character one counts as its parts."""
    found = {}
    text = raw.tobytes().decode("utf-32-le", "surrogatepass")
    for match in re.finditer("|".join(map(re.escape, model.special)), text):
        a, b = match.span()
        if np.searchsorted(first, a, side="right") == np.searchsorted(first, b - 1, side="right"):
            cut[a + 1 : b] = False
            cut[a] = True
            if b < len(cut):
                cut[b] = True
            inside = Counter(model)
            parts = [prefix for prefix in re.split(r"([a-z]+)", match[0][:-1]) if prefix]
            counts, total = [], 0
            for part in parts:
                own = inside._counts(part.encode())
                counts += [total + c for c in own]
                total += own[-1]
            found[a] = b, [*counts, 1]
    return found


def count_documents(
    docs: DataFrame, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(<id_col>, n_tokens, prefix_tokens)``, a row for each row of ``docs``.

    ``prefix_tokens[k - 1]`` (int) is the count of the first ``k`` characters of the text in NFC and lower case, which
    has as many characters as the text unless NFC joins or U+0130 splits some. ``n_tokens`` (long) is the last, 0 for
    empty and null texts. Counts are those of the ``tokenizers`` library without begin and end tokens;
    special strings are one token. No text is cut; other columns are not read. Long words cost
    time in proportion to their length.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        model = shared(docs.sparkSession, WordModel(f.read()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(model())
        for batch in batches:
            for texts in textpack.pieces(batch.column(1), 2 << 20):
                counts, first = prefix_counts(counter, texts)
                size = np.diff(first)
                last = np.where(size > 0, counts[np.maximum(first[1:] - 1, 0)] if len(counts) else 0, 0)
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(counts.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[texts.rows], pa.array(last.astype(np.int64)), lists], ["_id", "n_tokens", "prefix_tokens"]
                )

    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    fields = [T.StructField("_id", docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))]
    return source.mapInArrow(scan, T.StructType(fields)).withColumnRenamed("_id", id_col)


def longest_within(budget: int, counts: str = "prefix_tokens") -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from the stored counts alone.

    A longer prefix may have fewer tokens, so the last fitting one is taken, not the one before the first that is too long.
    """
    return F.coalesce(
        F.expr(f"array_max(transform({counts}, (n, i) -> if(n <= {int(budget)}, i + 1, 0)))"), F.lit(0)
    )
