"""Language by character n-grams: one Bloom filter for all languages, a bit for each.

A slot of the filter is a bit mask of languages. The masks of an n-gram's slots, anded, are all the languages that
have it, so one look-up answers for every language. A text's hits are counted per language, set right for the filter's
share of false hits, and the language with most of them is taken. A language's set holds its n-grams of at
least ``MIN_RATE`` of its text that no other language has ``RATIO`` times as often: at most ``1 / MIN_RATE`` of them,
however large the corpus is, so the filter has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.llm import textpack
from itemflow.llm.scratch import shared

SIZE, SLOT_BITS, PROBES = 3, 20, 3
MIN_RATE, RATIO = 2e-5, 6.0
_HELD = 1 << 21


@dataclass
class LanguageFilter:
    """``slots[:, w]`` has the bits of languages ``64 w`` to ``64 w + 63``; ``false_rate`` is each one's share of false hits."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    size: int


def _character_tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of each character that is a letter, 0x20 for any other; and whether it is a letter."""
    low = np.full(0x110000, 0x20, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            lower = chr(c).lower()
            low[c] = ord(lower[0])
    return low, low != 0x20


def _grams(texts: textpack.Texts, low: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of every n-gram of the words, each with a space on both sides; and which texts have a letter."""
    place = np.append(np.flatnonzero((texts.buf & 0xC0) != 0x80), len(texts.buf))
    chars = np.frombuffer(texts.buf.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.searchsorted(place, np.append(texts.starts, len(texts.buf)))
    chars = low[chars]
    letter = chars != 0x20
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    edge = np.ones(len(chars), bool)
    edge[1:] = (letter[1:] != letter[:-1]) | (owner[1:] != owner[:-1])
    # one space for each gap, and one more before each text
    keep = letter | edge
    chars, letter, owner = chars[keep], letter[keep], owner[keep]
    counts = np.bincount(owner, minlength=len(texts))
    start = np.concatenate([[0], np.cumsum(counts)])
    chars = np.append(np.insert(chars, start[:-1], np.uint32(0x20)), np.uint32(0x20))
    owner = np.append(np.insert(owner, start[:-1], np.arange(len(texts))), -1)
    n = len(chars) - size + 1
    has = np.bincount(owner[:-1][chars[:-1] != 0x20], minlength=len(texts)) > 0 if len(texts) else np.zeros(0, bool)
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has
    values = np.full(n, size, np.uint64)
    inner = np.ones(n, bool)
    for k in range(size):
        part = chars[k : k + n]
        values = values * np.uint64(0x1000193) + part
        if 0 < k < size - 1:
            inner &= part != 0x20
    text = owner[1 : n + 1]  # a space stands between texts, so the inner characters are of one
    inner &= text >= 0
    return textpack.mix(values[inner]), text[inner], has


def learn_languages(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", size: int = SIZE, slot_bits: int = SLOT_BITS,
    probes: int = PROBES, min_rate: float = MIN_RATE, ratio: float = RATIO,
) -> LanguageFilter:
    """Count the n-grams (of three or more characters) of all rows with a text and a language and build the filter.

    Counts are summed in the tasks, then by Spark; of the filter at most ``2 ** slot_bits`` slots reach the
    driver. Rows with a null in either column teach nothing; no rows give a filter without languages.
    """
    source = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = _gram_counts(source.where("lang IS NOT NULL AND text IS NOT NULL"), size)
    totals = counts.where("gram IS NULL").groupBy("lang").agg(F.sum("n").alias("total"))
    each = counts.where("gram IS NOT NULL").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    names = sorted(r[0] for r in totals.select("lang").collect())
    number = F.array_position(F.array(*map(F.lit, names)) if names else F.array().cast("array<string>"), F.col("lang")) - 1
    rates = each.join(totals, "lang").select("gram", number.alias("number"), (F.col("n") / F.col("total")).alias("rate"))
    best = rates.groupBy("gram").agg(F.max("rate").alias("best"), F.collect_list(F.struct("number", "rate")).alias("all"))
    chosen = best.where(F.col("best") >= min_rate).select("gram", "best", F.explode("all").alias("one"))
    chosen = chosen.where((F.col("one.rate") >= min_rate) & (F.col("one.rate") * ratio >= F.col("best")))
    spots = F.array(*(_spot_column(k, slot_bits) for k in range(probes)))
    rows = (
        chosen.select(F.explode(spots).alias("slot"), F.expr("cast(one.number div 64 as int)").alias("word"),
                      F.expr("shiftleft(1L, cast(one.number % 64 as int))").alias("bit"))
        .groupBy("slot", "word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    words = max(1, -(-len(names) // 64))
    slots = np.zeros((1 << slot_bits, words), np.uint64)
    slots[rows.column(0).to_numpy(), rows.column(1).to_numpy()] = rows.column(2).to_numpy().view(np.uint64)
    fill = np.array([np.count_nonzero(slots[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(names))])
    if len(names) <= 8:
        slots = slots.astype(np.uint8)
    return LanguageFilter(names, slots, (fill / (1 << slot_bits)) ** probes, size)


def _spot_column(k: int, bits: int):
    """The ``k``-th slot of a hashed n-gram: other bits of the hash each time."""
    return F.shiftrightunsigned("gram", k * bits).bitwiseAND((1 << bits) - 1)


def _gram_counts(source: DataFrame, size: int) -> DataFrame:
    low, _ = _character_tables()
    tables = shared(source.sparkSession, low)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        lower = tables()
        total: dict[str, int] = {}

        def rows(lang: str) -> pa.RecordBatch:
            grams, counts = _summed(held.pop(lang))
            n = total.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(grams) + 1)), pa.array([*textpack.signed(grams).tolist(), None], pa.int64()), pa.array([*counts.tolist(), n], pa.int64())],
                ["lang", "gram", "n"],
            )

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for texts in textpack.pieces(batch.column(1)):
                grams, text, _ = _grams(texts, lower, size)
                own = langs[texts.rows]
                for lang in set(own):
                    mine = np.array([x == lang for x in own])
                    part = grams[mine[text]]
                    total[lang] = total.get(lang, 0) + len(part)
                    lists = held.setdefault(lang, [])
                    lists.append(np.unique(part, return_counts=True))
                    if len(lists) > 16:
                        held[lang] = [_summed(lists)]
                        if len(held[lang][0][0]) > _HELD:
                            yield rows(lang)
        for lang in list(held):
            yield rows(lang)

    return source.mapInArrow(scan, "lang string, gram long, n long")


def _summed(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, at = np.unique(np.concatenate([g for g, _ in lists]), return_inverse=True)
    return grams, np.bincount(at, weights=np.concatenate([c for _, c in lists])).astype(np.int64)


def identify(
    docs: DataFrame, learned: LanguageFilter, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(<id_col>, lang_pred, score, n_grams, hits)``, a row for each row of ``docs``.

    ``score`` is the language's share of all languages' corrected hits, 0 where there are none;
    of equal languages the first by name is taken. ``und`` and 0 for a null text, one without a letter,
    or a filter without languages. ``hits``: the corrected count of the language. Whole texts are read.
    """
    low, _ = _character_tables()
    tables = shared(docs.sparkSession, (low, learned))
    probes = PROBES

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, made = tables()
        bits = np.uint64(len(made.slots).bit_length() - 1)
        low_bits = np.uint64(len(made.slots) - 1)
        for batch in batches:
            for texts in textpack.pieces(batch.column(1)):
                grams, text, has = _grams(texts, low, made.size)
                n = np.bincount(text, minlength=len(texts))
                masks = made.slots[(grams & low_bits).astype(np.int64)]
                for k in range(1, probes):
                    masks = masks & made.slots[(grams >> (np.uint64(k) * bits) & low_bits).astype(np.int64)]
                hits = np.zeros((len(texts), max(1, len(made.languages))))
                for i in range(len(made.languages)):
                    word = masks[:, i // 64]
                    one = word >> word.dtype.type(i % 64) & word.dtype.type(1)
                    raw = np.bincount(text, weights=one, minlength=len(texts))
                    rate = made.false_rate[i]
                    hits[:, i] = np.maximum(0, raw - n * rate) / max(1 - rate, 1e-9)
                best = hits.argmax(axis=1)
                top = hits[np.arange(len(texts)), best]
                every = hits.sum(axis=1)
                has = has & bool(made.languages)
                score = np.where(has & (every > 0), top / np.maximum(every, 1e-300), 0.0)
                names = [made.languages[b] if h else "und" for b, h in zip(best.tolist(), has.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[texts.rows], pa.array(names, pa.string()), pa.array(score), pa.array(n.astype(np.int64)), pa.array(np.where(has, top, 0.0))],
                    ["_id", "lang_pred", "score", "n_grams", "hits"],
                )

    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    fields = [T.StructField("_id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    fields += [T.StructField("n_grams", T.LongType()), T.StructField("hits", T.DoubleType())]
    return source.mapInArrow(scan, T.StructType(fields)).withColumnRenamed("_id", id_col)
