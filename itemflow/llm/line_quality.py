r"""Line-first cleaning: rules judge each line, lines that fail are taken out, and a document that lost too much is rejected.

Rules per line, on its words (runs of bytes other than ASCII white space); lines without words stay:

* punctuation: it ends in a mark that ends or pauses a sentence, perhaps closed by a quote or bracket;
* symbols: at most one in ten of its characters is one of ``# * $ % & | < >``;
* shouting: ``!!`` occurs at most once;
* navigation: fewer than two of ``|``, and no run of menu words such as "home about contact";
* boilerplate: none of ``BOILERPLATE`` occurs in it, in whatever case (A-Z).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.llm import textpack

MIN_WORDS, MAX_REPEATED, MAX_LOST = 50, 50, 30
#: Last bytes of the marks that may end a line.
TERMINAL = ".", "!", "?", ":", ";", '"', "'", ")", "]", "…", "”", "’", "»", "。", "！", "？"
BOILERPLATE = (
    "javascript", "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "lorem ipsum", "click here", "subscribe to our", "sign up for", "log in to", "powered by", "skip to content",
)
NAVIGATION = "home about contact", "home > ", "previous next", "share this", "follow us", "read more", "back to top"
SYMBOLS = b"#*$%&|<>"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "lines_removed", "chars_removed",
)


def clean_lines(
    docs: DataFrame, *, min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED, max_lost: int = MAX_LOST,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    r"""Measures, verdict and cleaned text of each row: ``id_col``, ``MEASURES``, ``base_failed``, ``kept``, ``clean_text``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeated`` percent of them in three-word
    windows found twice or more. ``kept``: not ``base_failed``, and at most ``max_lost`` percent of the
    characters in words lie in removed lines. ``n_dup_lines`` counts ``\n``-split lines with a word that
    equal an earlier one. A null text has no words and a null ``clean_text``. Rows stay
    rows, whatever their ids; other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    judged = _judged(source, min_words, max_repeated, max_lost)
    return judged.select(F.col("_id").alias(id_col), *MEASURES, "base_failed", "kept", "clean_text")


def clean_documents(
    docs: DataFrame, *, min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED, max_lost: int = MAX_LOST, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that are kept, with their text cleaned; see ``clean_lines``. Columns keep names and order."""
    others = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c != text_col}
    source = docs.select(
        F.lit(0).alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"), *(F.col(f"`{c}`").alias(x) for c, x in others.items())
    )
    kept = _judged(source, min_words, max_repeated, max_lost).where("kept")
    return kept.select(*[F.col("clean_text" if c == text_col else others[c]).alias(c) for c in docs.columns])


def _judged(source: DataFrame, min_words: int, max_repeated: int, max_lost: int) -> DataFrame:
    """``_id``, measures, verdict and cleaned text of ``_text``, then the other columns of ``source``."""
    extra = [c for c in source.columns if c not in ("_id", "_text")]
    marks = [m.encode() for m in TERMINAL]
    phrases = re.compile(b"|".join(re.escape(p.encode()) for p in (*BOILERPLATE, *NAVIGATION)))
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True

    def measure(texts: textpack.Texts) -> tuple[list[np.ndarray], list[bytes]]:
        words, lines = texts.runs(textpack.NOT_SPACE), texts.lines()
        hasher = texts.hasher()
        char = ((texts.buf & 0xC0) != 0x80) & textpack.NOT_SPACE[texts.buf]
        signs = symbol[texts.buf]
        n_words = words.counts

        before = lambda flags: np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        low, high = np.searchsorted(words.start, lines.start), np.searchsorted(words.start, lines.end)
        full = high > low
        chars, signs_at = before(char), before(signs)
        line_chars = chars[lines.end] - chars[lines.start]
        fails = 10 * (signs_at[lines.end] - signs_at[lines.start]) > line_chars
        stop = np.where(full, words.end[np.maximum(high - 1, 0)] if len(words) else 0, 0)
        fails |= ~_ends_with(texts.buf, stop, marks)
        bang = np.zeros(len(texts.buf), bool)
        bang[1:] = (texts.buf[1:] == 33) & (texts.buf[:-1] == 33)
        for flags in (bang, texts.buf == 124):
            sums = before(flags)
            fails |= sums[lines.end] - sums[lines.start] >= 2
        lowered = textpack.LOWER[texts.buf].tobytes()
        hit = np.array([m.span() for m in phrases.finditer(lowered)], np.int64).reshape(-1, 2)
        line = np.searchsorted(lines.start, hit[:, 0], side="right") - 1
        fails[line[hit[:, 1] <= lines.end[line]]] = True
        fails &= full

        sums = before(fails)
        removed = sums[lines.first[1:]] - sums[lines.first[:-1]]
        sums = before(np.where(fails, line_chars, 0))
        lost = sums[lines.first[1:]] - sums[lines.first[:-1]]
        out = [
            n_words, chars[texts.ends] - chars[texts.starts], signs_at[texts.ends] - signs_at[texts.starts],
            _repeated_lines(hasher, lines, full, len(texts)), _repeated_words(hasher, words, len(texts)), lines.counts, removed, lost,
        ]
        data, cleaned = texts.buf.tobytes(), []
        for i in range(len(texts)):
            if removed[i]:
                span = range(lines.first[i], lines.first[i + 1])
                cleaned.append(b"\n".join(data[lines.start[k] : lines.end[k]] for k in span if not fails[k]))
            else:
                cleaned.append(data[texts.starts[i] : texts.ends[i]])
        return out, cleaned

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in textpack.pieces(batch.column(1)):
                measures, cleaned = measure(texts)
                n_words, chars, repeated, lost = measures[0], measures[1], measures[4], measures[7]
                failed = (n_words < min_words) | (100 * repeated > max_repeated * n_words)
                kept = ~failed & (100 * lost <= max_lost * chars)
                null = batch.column(1)[texts.rows].is_null()
                text = pa.array(cleaned, pa.binary(), mask=null.to_numpy(zero_copy_only=False)).cast(pa.string())
                columns = [pa.array(m.astype(np.int64)) for m in measures]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[texts.rows], *columns, pa.array(failed), pa.array(kept), text,
                     *(batch.column(2 + k)[texts.rows] for k in range(len(extra)))],
                    ["_id", *MEASURES, "base_failed", "kept", "clean_text", *extra],
                )

    fields = [source.schema["_id"], *(T.StructField(m, T.LongType()) for m in MEASURES)]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    fields += [T.StructField("clean_text", T.StringType()), *(source.schema[c] for c in extra)]
    return source.mapInArrow(scan, T.StructType(fields))


def _ends_with(buf: np.ndarray, stop: np.ndarray, marks: list[bytes]) -> np.ndarray:
    """Whether one of the marks stands right before each place."""
    out = np.zeros(len(stop), bool)
    for mark in marks:
        same = stop >= len(mark)
        at = np.where(same, stop, len(mark))
        for k, byte in enumerate(mark):
            place = at - len(mark) + k
            same &= (place < len(buf)) & (buf[np.minimum(place, len(buf) - 1)] == byte) if len(buf) else False
        out |= same
    return out


def _repeated_lines(hasher: textpack.Hasher, lines: textpack.Spans, full: np.ndarray, n: int) -> np.ndarray:
    values, text = hasher(lines.start[full], lines.end[full]), lines.text[full]
    different = np.diff(textpack.distinct(values, text, n)[1])
    return np.bincount(text, minlength=n) - different


def _repeated_words(hasher: textpack.Hasher, words: textpack.Spans, n: int) -> np.ndarray:
    """Words in three-word windows that a text has twice or more."""
    at, text = textpack.windows(words.first, 3)
    if not len(at):
        return np.zeros(n, np.int64)
    values = textpack.folded(hasher(words.start, words.end), at, 3)
    order = np.lexsort((values, text))
    v, t = values[order], text[order]
    same = (v[1:] == v[:-1]) & (t[1:] == t[:-1])
    twice = np.zeros(len(v), bool)
    twice[1:] |= same
    twice[:-1] |= same
    begin = at[order[twice]]
    hit = np.zeros(len(words) + 3, bool)
    for k in range(3):
        hit[begin + k] = True
    sums = np.concatenate([[0], np.cumsum(hit)])
    return sums[words.first[1:]] - sums[words.first[:-1]]
