"""Write documents as item exports, the layout that ``scan_items`` reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.functions.encode import encode_documents
from itemflow.functions.wire import DEFAULT_DEPTH
from itemflow.operators.convert import BAD, GOOD


def write_items(docs: DataFrame, path: str, doc: str = "doc", depth: int = DEFAULT_DEPTH) -> str:
    """Write each document as one export line; returns the folder of the written items.

    One pass: documents holding a value without a wire type (a timestamp, say) land next to
    them under ``status=quarantine`` as plain JSON.
    """
    encoded = encode_documents(docs, doc, depth)
    line = F.col("line")
    rows = encoded.select(
        F.coalesce(line, F.to_json(doc)).alias("value"),
        F.when(line.isNotNull(), GOOD).otherwise(BAD).alias("status"),
    )
    rows.write.partitionBy("status").text(path)
    return f"{path}/status={GOOD}"
