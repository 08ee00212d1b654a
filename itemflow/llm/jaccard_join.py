"""Documents joined by the Jaccard similarity of their word n-grams, as T-occurrence search.

Every document is its set of distinct word shingles, ordered from rare to frequent by a sketch
of fixed size. Linked sets share ``c`` of their rarest ``|s| - ceil(t |s|) + c`` shingles, so only those
are shuffled, as 64-bit values, and documents that share fewer, such as those with a passage
in common, go no further. The search itself (heap-merged short lists, binary probes of
the long ones) runs in blocks, see ``setlinks``. Equal sets are one node from the first scan on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemflow.llm import textpack
from itemflow.llm.scratch import stored
from itemflow.llm.setlinks import NodeFilter, components, packed

#: Cells of the sketch. With fewer, frequent shingles of larger inputs drown in the number of rare ones in their cell.
SKETCH_BITS = 20
#: Cells that are summed up together.
_CHUNK = 1 << 14
#: ``c`` is one and an item more for each so many of the set.
SPARE = 32
_LOW = np.uint64(8)


def jaccard_components(
    docs: DataFrame, percent: int = 90, size: int = 3, *, id_col: str = "doc_id", text_col: str = "text",
    sketch_bits: int = SKETCH_BITS,
) -> DataFrame:
    """``(<id_col>, n_shingles, component_id)``, a row for each row of ``docs``.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; shingles have ``size``
    words, and fewer words, but not none, are one shingle. Documents link when
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest id that links reach.
    Null and empty texts have no shingles, link with nothing and are components of their own.
    Rows with one id stay rows of their own; a null id is never the smallest. Sets are known
    by 64-bit hashes, shingles by 56-bit ones. Other columns of ``docs`` are not read.
    """
    ids = docs.schema[id_col]
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    seen = stored(_scan_sets(source, ids.dataType, size, sketch_bits), "jaccard-sets")
    order = _frequency_levels(seen, sketch_bits)
    rare = stored(_rare_items(source, order, size, percent), "jaccard-rare")

    def sets(keep: NodeFilter) -> DataFrame:
        return _kept_sets(source, order, size, keep)

    entries = rare.select(F.explode("items").alias("key"), "node", "n")
    labels = components(entries, sets, percent, "jaccard", SPARE)
    known = seen.where("counts IS NULL")
    known = known.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = known.groupBy("component").agg(F.min("id").alias("component_id")).where("component IS NOT NULL")
    return known.join(least, "component", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id")
    )


def _hashed(texts: textpack.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.lowered()
    words = texts.runs(textpack.NOT_SPACE)
    return textpack.shingles(texts.hasher()(words.start, words.end), words.first, size)


def _scan_sets(source: DataFrame, id_type: T.DataType, size: int, bits: int) -> DataFrame:
    """Each row's set size and set hash; at a task's end how often each sketch cell was hit, up to 255 times."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << bits, np.int32)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for texts in textpack.pieces(batch.column(1)):
                values, text = _hashed(texts, size)
                values, first = textpack.distinct(values, text, len(texts))
                np.add.at(cells, (values & np.uint64((1 << bits) - 1)).astype(np.int64), np.int32(1))
                sizes = np.diff(first)
                node = textpack.signed(textpack.set_hash(values, first))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[texts.rows], pa.array(sizes), pa.array(node, mask=sizes == 0), pa.nulls(len(texts), pa.binary())],
                    ["id", "n_shingles", "node", "counts"],
                )
        if kind is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.array([0], pa.int64()), pa.nulls(1, pa.int64()), pa.array([np.minimum(cells, 255).astype(np.uint8).tobytes()], pa.binary())],
                ["id", "n_shingles", "node", "counts"],
            )

    fields = [T.StructField("id", id_type), T.StructField("n_shingles", T.LongType())]
    fields += [T.StructField("node", T.LongType()), T.StructField("counts", T.BinaryType())]
    return source.mapInArrow(scan, T.StructType(fields))


def _frequency_levels(seen: DataFrame, bits: int) -> np.ndarray:
    """Steps of a quarter power of two of each cell's count. A byte for each of ``2 ** bits`` cells reaches the driver, whatever the input."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = None
        for batch in batches:
            for counts in batch.column(0):
                counts = np.frombuffer(counts.as_buffer(), np.uint8)
                cells = counts.astype(np.int64) if cells is None else cells + counts
        if cells is not None:
            chunks = [cells[k : k + _CHUNK].tobytes() for k in range(0, len(cells), _CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.binary())], ["chunk", "counts"])

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                cells[chunk] = np.frombuffer(counts.as_buffer(), np.int64) + cells.get(chunk, 0)
        found = [np.minimum(4 * np.log2(np.maximum(n, 1)) + (n > 0), 126).astype(np.uint8).tobytes() for n in cells.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(cells), pa.int32()), pa.array(found, pa.binary())], ["chunk", "levels"])

    chunks = seen.where("counts IS NOT NULL").select("counts").mapInArrow(summed, "chunk int, counts binary")
    rows = chunks.repartition("chunk").mapInArrow(levels, "chunk int, levels binary").toArrow()
    found = np.zeros(1 << bits, np.uint8)
    for chunk, data in zip(*rows.to_pydict().values(), strict=True):
        found[chunk * _CHUNK : (chunk + 1) * _CHUNK] = np.frombuffer(data, np.uint8)
    return found


def _ordered(texts: textpack.Texts, order: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles as 63-bit values that sort from rare to frequent."""
    values, text = _hashed(texts, size)
    values = (order[values & np.uint64(len(order) - 1)].astype(np.uint64) << np.uint64(56)) | (values >> _LOW)
    return textpack.distinct(values, text, len(texts))


def _node_of(texts: textpack.Texts, size: int) -> np.ndarray:
    values, text = _hashed(texts, size)
    return textpack.set_hash(*textpack.distinct(values, text, len(texts)))


def _rare_items(source: DataFrame, order: np.ndarray, size: int, percent: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for texts in textpack.pieces(batch.column(0)):
                values, first = _ordered(texts, order, size)
                sizes = np.diff(first)
                take = np.where(sizes > 0, sizes + (-percent * sizes // 100) + 1 + sizes // SPARE, 0)
                take = np.minimum(take, sizes)
                nodes = _node_of(texts, size)
                for i, node in enumerate(nodes.tolist()):
                    if node in done:
                        take[i] = 0
                    elif len(done) < 1 << 20:  # copies beyond are told apart later
                        done.add(node)
                some = np.flatnonzero(take)
                at = np.repeat(first[some] - np.cumsum(take[some]) + take[some], take[some]) + np.arange(take.sum())
                offsets = np.concatenate([[0], np.cumsum(take[some])])
                items = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(textpack.signed(values[at])))
                sizes = pa.array(sizes[some].astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(textpack.signed(nodes[some])), sizes, items], ["node", "n", "items"])

    return source.select("text").mapInArrow(scan, "node long, n int, items array<long>")


def _kept_sets(source: DataFrame, order: np.ndarray, size: int, keep: NodeFilter) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for texts in textpack.pieces(batch.column(0)):
                nodes = _node_of(texts, size)
                some = [i for i in np.flatnonzero(keep.mask(nodes) & (nodes > 0)).tolist() if int(nodes[i]) not in done]
                if not some:
                    continue
                if len(done) < 1 << 20:
                    done.update(nodes[some].tolist())
                values, first = _ordered(texts, order, size)
                sets = [values[first[i] : first[i + 1]] for i in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(textpack.signed(nodes[some])), pa.array([packed(s) for s in sets], pa.binary())], ["node", "items"]
                )

    return source.select("text").mapInArrow(scan, "node long, items binary")
