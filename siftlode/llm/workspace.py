"""Shared scratch space and size-checked joins for multi-step corpus jobs."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a local session may do without that setting; it gets a temporary folder of its own."""
    told = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="siftlode-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Workspace:
    """Named Parquet tables in a folder of their own under the shared one.

    Writing a table cuts the lineage: an executor lost later costs the tasks at hand only.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/siftlode-{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def split(self, df: DataFrame, name: str, by: str, number: int) -> dict[str, DataFrame]:
        """A table in as many parts as ``by`` has values below ``number``, each of which can be dropped alone."""
        kept = df.drop(by)
        df.write.partitionBy(by).parquet(f"{self.root}/{name}")
        parts = {f"{name}/{by}={k}": None for k in range(number)}
        jvm = self.spark.sparkContext._jvm
        for part in parts:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{part}")
            # a value that no row has leaves no folder
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
            self.names.add(part)
            parts[part] = self.spark.read.schema(kept.schema).parquet(f"{self.root}/{part}")
        return parts

    def drop(self, name: str) -> None:
        """Delete a table that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.names.discard(name)

    def settle(self) -> None:
        """Let go of the shuffle files behind tables that have been written: Spark deletes them once the driver has collected the plans that name them.

        A first collection leaves those of the last plan.
        """
        for _ in range(2):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()

    def keep(self, *names: str) -> None:
        """Delete all tables but these, which the result reads."""
        for name in self.names - {*names}:
            self.drop(name)


#: Rows of a batch that goes to Python and back, where the session doesn't set their number itself.
BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Let batches of whole texts or sets be of few rows: executors hold several copies of one for each task, outside the heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000" and spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, BATCH)


#: Bytes up to which a side may be broadcast, by an upper bound of its size.
BROADCAST_BYTES = 32 << 20


def checked_join(left: DataFrame, right: DataFrame, on, how: str, size: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join with the right side broadcast if its ``size`` in bytes is within ``limit``; otherwise shuffled."""
    return left.join(F.broadcast(right) if size <= limit else right, on, how)


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Column names like these that the taken ones, in whatever case, leave free."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        own = f"__{name}"
        while own in used:
            own = f"_{own}"
        used.add(own)
        out.append(own)
    return out
