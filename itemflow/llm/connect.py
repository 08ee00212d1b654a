"""Connected components by contraction: joins and minima only, tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.llm.scratch import stored


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of the pairs ``(a, b)``; a component is its smallest node.

    Distributed union-find. In each round every node points to its smallest neighbour, pointers are
    halved until they end at roots, and the edges move to the roots; edges within one root go. Each
    round leaves at most half of the nodes. A node with a large share of all edges combines on the
    map side. Null ends, loops and repeated pairs count for nothing; no pairs give no rows.
    """
    pairs = stored(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        name,
    )
    found = None
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        up = _roots(stored(up.select("node", F.least("node", "to").alias("component")), name), name)
        found = up if found is None else _follow(found, up)
        pairs = stored(_move(_move(pairs, up, "a"), up, "b").where("a <> b").distinct(), name)
    if found is None:
        kind = dict(pairs.dtypes)["a"]
        return pairs.select(F.col("a").alias("node"), F.col("a").cast(kind).alias("component")).limit(0)
    return stored(found, name)


def _step(up: DataFrame) -> DataFrame:
    return up.select(F.col("node").alias("_at"), F.col("component").alias("_to"))


def _follow(labels: DataFrame, up: DataFrame) -> DataFrame:
    joined = labels.join(_step(up), F.col("component") == F.col("_at"), "left")
    return joined.select("node", F.coalesce("_to", "component").alias("component"))


def _move(pairs: DataFrame, up: DataFrame, end: str) -> DataFrame:
    other = "b" if end == "a" else "a"
    return pairs.join(_step(up), F.col(end) == F.col("_at")).select(F.col("_to").alias(end), other)


def _roots(up: DataFrame, name: str) -> DataFrame:
    """Pointers to smaller nodes, followed to their ends by doubling."""
    while True:
        far = up.where("component <> node").join(_step(up.where("component <> node")), F.col("component") == F.col("_at"))
        if far.isEmpty():
            return up
        up = stored(_follow(up, up), name)
