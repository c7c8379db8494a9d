"""Tables written once per application into the cluster's shared folder and read back.

A written table cuts lineage for good: it survives lost executors, unlike cached blocks, and every
mart that reads it gets column pruning and filter pushdown from Parquet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
PARTITION_BYTES = 16 << 20  # of input, which sorted rows in memory exceed some twenty times


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names. If it names none, one set earlier on the context, or one in the
    warehouse folder, which all executors reach as well."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints").rstrip("/")


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let iterative jobs checkpoint into the shared folder, unless the session already does."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def fingerprint(spark: SparkSession, directory: str, tables: list[str]) -> str:
    """Changes when an input changes: a digest of path, modification time, bytes and file count.

    Asks the file system that Spark uses, so it works for local and remote folders alike.
    """
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    digest = hashlib.md5()
    for name in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/{name}.parquet")
        files = path.getFileSystem(configuration)
        summary = files.getContentSummary(path)
        changed = files.getFileStatus(path).getModificationTime()
        stamp = (path.toString(), changed, summary.getLength(), summary.getFileCount())
        digest.update(repr(stamp).encode())
    return digest.hexdigest()


def stored_bytes(spark: SparkSession, directory: str, tables: list[str]) -> int:
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for name in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/{name}.parquet")
        total += path.getFileSystem(configuration).getContentSummary(path).getLength()
    return total


class WorkArea:
    """Builds each named table at most once and returns it as a Parquet scan.

    While tables are written, shuffles have at least a partition for every so many bytes of what the
    tables derive from, so that sorts need no disk; the session's own number holds again after it.
    """

    def __init__(self, spark: SparkSession, key: str, source_bytes: int = 0):
        self.spark = spark
        application = spark.sparkContext.applicationId
        self.root = f"{shared_folder(spark)}/wayfunnel-{application}/{key}"
        self.partitions = source_bytes // PARTITION_BYTES + 1
        self._schemas: dict[str, StructType] = {}
        self._lock, self._writing, self._before = Lock(), 0, None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @contextmanager
    def _sized_shuffles(self) -> Iterator[None]:
        """Tables may be written from several threads, or while another is built."""
        with self._lock:
            if not self._writing:
                self._before = self.spark.conf.get(SHUFFLE_PARTITIONS)
                wanted = max(self.partitions, int(self._before))
                self.spark.conf.set(SHUFFLE_PARTITIONS, wanted)
            self._writing += 1
        try:
            yield
        finally:
            with self._lock:
                self._writing -= 1
                if not self._writing:
                    self.spark.conf.set(SHUFFLE_PARTITIONS, self._before)

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._schemas:
            with self._sized_shuffles():
                built = build()
                built.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
            self._schemas[name] = built.schema
        # with a schema the reader opens no footers for inference
        return self.spark.read.schema(self._schemas[name]).parquet(self.path(name))
