"""What tasks share: intermediate tables in the folder that all executors see, and broadcast values."""

from __future__ import annotations

import gc
import os
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Unset, a temporary folder serves under a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir: executors have folders of their own")
        root = os.path.join(tempfile.gettempdir(), "itemflow-llm")
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *partition_by: str, plain: Iterable[str] = (), options: Mapping[str, str] | None = None) -> DataFrame:
    """Write a table and read it back: cuts the lineage, and a lost executor loses nothing of it. Values of ``plain`` columns hardly repeat; ``options`` are the writer's."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**{f"parquet.enable.dictionary#{c}": "false" for c in plain}, **(options or {})).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget_shuffles(df: DataFrame) -> None:
    """Let executors delete the shuffle files of plans that have ended: the driver tells them when it collects garbage."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def shared(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast a value of bounded size, its class included; tasks call what is returned to get it."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)


def once_per_worker(spark: SparkSession, make: Callable[..., object], *args: object) -> Callable[[], object]:
    """Broadcast what ``make`` needs; each Python worker calls it once and keeps what it made for its later tasks."""
    held = spark.sparkContext.broadcast([args])

    def get() -> object:
        if len(held.value) == 1:
            held.value.append(make(*held.value[0]))
        return held.value[1]

    return get
