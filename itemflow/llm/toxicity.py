"""Toxicity by a classifier that answers alike for sentences in which only identity terms differ.

A logistic model over the words of a text and their stems. Besides the usual loss, it pays for every labelled sentence
whose score changes when its identity terms are swapped for others of their group, so the mention of a group alone
moves no score. The model is fitted on a bounded sample of labelled rows; every row is scored.
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
from itemflow.llm.decontaminate import WORD

#: At most so many labelled rows are learned from: those with the smallest hashes of their ids.
MAX_ROWS = 12_000
#: A word counts if so many rows of the sample have it, and so many standard deviations lie between their labels and all.
MIN_ROWS, MIN_ODDS = 5, 4.0
#: Lengths of the stems of words that are features too.
STEMS = 4, 5
RIDGE, FAIRNESS, STEPS, RATE = 1e-3, 1.0, 300, 0.05
#: Groups of terms that stand for one another; each is swapped for the next of its group.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("she", "he"), ("her", "him"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "hispanic", "arab", "african", "european", "american"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "homosexual", "transgender"),
    ("immigrants", "natives"), ("immigrant", "native"), ("disabled", "blind", "deaf"), ("old", "young"),
    ("french", "german", "spanish", "mexican", "chinese", "indian"),
)


@dataclass
class ToxicityModel:
    """Weights of hashed words, ascending by hash, and the intercept."""

    words: np.ndarray
    weights: np.ndarray
    intercept: float


def _features(low: textpack.Texts) -> tuple[textpack.Spans, np.ndarray, np.ndarray, np.ndarray]:
    """Words of lower-cased texts and their hashes; then hash and text of every feature: words and their stems.

    Stems are the first four and five characters of longer words, so that forms of one word are learned together.
    """
    words, hasher = low.runs(WORD), low.hasher()
    hashes, text = hasher(words.start, words.end), words.text
    chars = np.append(np.flatnonzero((low.buf & 0xC0) != 0x80), [len(low.buf)] * 8)
    first = np.searchsorted(chars, words.start)
    values, owners = [hashes], [text]
    for size in STEMS:
        stop = chars[np.minimum(first + size, len(chars) - 1)]
        longer = stop < words.end
        values.append(textpack.mix(hasher(words.start[longer], stop[longer]) ^ np.uint64(size)))
        owners.append(text[longer])
    return words, hashes, np.concatenate(values), np.concatenate(owners)


def word_features(word: str) -> list[int]:
    """Hashes of a word and of its stems."""
    data = np.frombuffer(word.encode(), np.uint8)
    return _features(textpack.Texts(data, np.array([0]), np.array([len(data)]), 0))[2].tolist()


def swaps(groups=IDENTITY_GROUPS) -> dict[int, tuple[list[int], list[int]]]:
    """By each identity term's hash: its features, and those of the term put in its place."""
    pairs = [(word_features(a), word_features(b)) for g in groups for a, b in zip(g, (*g[1:], g[0]), strict=True)]
    return {a[0]: (a, b) for a, b in pairs}


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = MAX_ROWS, fairness: float = FAIRNESS, groups=IDENTITY_GROUPS,
) -> ToxicityModel:
    """Fit on at most ``max_rows`` of the documents that have a label and a text.

    A document with several labels has the highest. Rows with a null id or label teach nothing; a sample with
    one class or none gives a model without words. Only hashed words of the sample reach the driver.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)  # the documented bound of the sample
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    rows = texts.join(F.broadcast(chosen), "id").select("y", "text")
    return _fit(_sentences(rows, swaps(groups)).toArrow(), fairness)


def _sentences(rows: DataFrame, swapped: dict[int, tuple[list[int], list[int]]]) -> DataFrame:
    """Each text's distinct words; for each sentence with identity terms those that a swap takes out and puts in."""
    terms = np.array(sorted(swapped), np.uint64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in textpack.pieces(batch.column(1)):
                words, hashes, values, owners = _features(texts.lowered())
                values, first = textpack.distinct(values, owners, len(texts))
                out, into = [[] for _ in range(len(texts))], [[] for _ in range(len(texts))]
                if len(terms):
                    text = words.text
                    for i in np.flatnonzero(np.isin(hashes, terms)).tolist():
                        gone, put = swapped[int(hashes[i])]
                        out[text[i]] += gone
                        into[text[i]] += put
                as_long = lambda lists: pa.array([[x - (x >> 63 << 64) for x in own] for own in lists], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[texts.rows], pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(textpack.signed(values))),
                        as_long(out), as_long(into),
                    ],
                    ["y", "words", "out", "into"],
                )

    return rows.mapInArrow(scan, "y int, words array<long>, out array<long>, into array<long>")


def _fit(sample: pa.Table, fairness: float) -> ToxicityModel:
    """Adam on the logistic loss, a ridge and the squared score changes of swaps."""
    sample = sample.combine_chunks()
    y = sample.column("y").to_numpy().astype(float)
    none = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
    if not len(y) or y.min() == y.max():
        return none
    column = sample.column("words").chunk(0)
    flat = column.flatten().to_numpy().view(np.uint64)
    row = np.repeat(np.arange(len(y)), np.diff(column.offsets.to_numpy()))
    words, at, counts = np.unique(flat, return_inverse=True, return_counts=True)
    extra = np.unique(np.concatenate([sample.column(c).chunk(0).flatten().to_numpy().view(np.uint64) for c in ("out", "into")]))
    # a word is kept if its rows have the label more or less often than chance explains
    share = y.mean()
    odds = (np.bincount(at, weights=y[row], minlength=len(words)) - counts * share) / np.sqrt(counts * share * (1 - share))
    keep = ((counts >= MIN_ROWS) & (np.abs(odds) >= MIN_ODDS)) | np.isin(words, extra)
    new = np.cumsum(keep) - 1
    some = keep[at]
    row, at, words = row[some], new[at[some]], words[keep]
    if not len(words):
        return none
    swap_row, swap_word, sign = [], [], []
    for c, s in (("out", 1.0), ("into", -1.0)):
        lists = sample.column(c).chunk(0)
        values = lists.flatten().to_numpy().view(np.uint64)
        place = np.minimum(np.searchsorted(words, values), len(words) - 1)
        inside = words[place] == values
        swap_row.append(np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))[inside])
        swap_word.append(place[inside])
        sign.append(np.full(int(inside.sum()), s))
    swap_row, swap_word, sign = map(np.concatenate, (swap_row, swap_word, sign))

    n, w, b = len(y), np.zeros(len(words)), none.intercept
    swapped = max(1, len(np.unique(swap_row)))
    mean, square = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, weights=w[at], minlength=n) + b
        miss = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        change = np.bincount(swap_row, weights=sign * w[swap_word], minlength=n)
        slope = np.bincount(at, weights=miss[row], minlength=len(words)) + RIDGE * w
        slope += fairness * 2 / swapped * np.bincount(swap_word, weights=sign * change[swap_row], minlength=len(words))
        slope = np.append(slope, miss.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return ToxicityModel(words, w, float(b))


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, score)`` for each row: the probability of the label, of the distinct words and stems of the whole text.

    Null and empty texts have no words and get the intercept's probability.
    """
    fitted = shared(docs.sparkSession, model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = fitted()
        for batch in batches:
            for texts in textpack.pieces(batch.column(1)):
                _, _, values, owners = _features(texts.lowered())
                z = np.full(len(texts), own.intercept)
                if len(values) and len(own.words):
                    place = np.minimum(np.searchsorted(own.words, values), len(own.words) - 1)
                    some = own.words[place] == values
                    pairs = np.unique(owners[some] * len(own.words) + place[some])
                    z += np.bincount(pairs // len(own.words), weights=own.weights[pairs % len(own.words)], minlength=len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[texts.rows], pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["_id", "score"]
                )

    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    fields = [T.StructField("_id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())]
    return source.mapInArrow(scan, T.StructType(fields)).withColumnRenamed("_id", id_col)
