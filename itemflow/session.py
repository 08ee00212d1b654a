"""Where work that must outlive a task goes, and the session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    A local session that names none (a test) gets a folder of its own; on a cluster each machine
    would have another one, so there it is an error.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    master = spark.sparkContext.master
    if not named and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
    return (named or tempfile.gettempdir()).rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; Spark makes it when something is written."""
    return f"{shared_folder(spark)}/itemflow-{name}-{uuid.uuid4().hex[:12]}"


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan whose rows lie in few splits, dealt out over all of the session's cores.

    Decoding costs far more than reading, so one small, unsplittable (gzip) or coarse file must not hold it to few
    cores. Splits without a row count for nothing: a Parquet file is cut at any byte, but a row group is read by one of them.
    The rows of each split are counted from the files' footers. A scan whose largest split is at most half of a core's share
    is left alone, as any large one of many files or row groups is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    splits = scan.rdd.getNumPartitions()
    if splits >= cores:
        held = scan.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
        largest, rows = held.agg(F.max("n"), F.sum("n")).collect()[0]
        if rows is None or largest * cores * 2 <= rows:
            return scan
    return scan.repartition(-(-max(splits, cores) // cores) * cores)


def local_session(cpus: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("itemflow")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
