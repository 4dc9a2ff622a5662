"""Folders on whatever file system Spark is configured for."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Folder:
    """Listing, existence and deletion of paths through Spark's Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self.path = path.rstrip("/")
        jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._at = jvm_path(self.path)
        self._fs = self._at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def child(self, *names: str) -> Folder:
        return Folder(self._spark, "/".join([self.path, *names]))

    def exists(self) -> bool:
        return self._fs.exists(self._at)

    def children(self) -> list[str]:
        if not self.exists():
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._at))

    def files(self) -> list[str]:
        """The path itself if it is a file, else the visible files below it."""
        if not self.exists():
            return []
        if self._fs.getFileStatus(self._at).isFile():
            return [self.path]
        found = []
        for status in self._fs.listStatus(self._at):
            name = status.getPath().getName()
            if not name.startswith(("_", ".")):
                found += [f"{self.path}/{name}"] if status.isFile() else self.child(name).files()
        return sorted(found)

    def touch(self) -> None:
        """An empty file at this place."""
        self._fs.create(self._at, True).close()

    def delete(self) -> None:
        self._fs.delete(self._at, True)

    def is_complete(self) -> bool:
        """True once a Spark job has committed its output here."""
        return self.child("_SUCCESS").exists()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        # Local mode, and nothing configured: a folder of this process, gone when it ends.
        configured = tempfile.mkdtemp(prefix="claimloom-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        context.setCheckpointDir(configured)
        configured = context.getCheckpointDir()
    return configured.rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing path for one intermediate table."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open_blocks: dict[SparkSession, list] = {}  # how many, and the setting before the first
_lock = threading.Lock()


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """In here the shuffle files of a query go as it ends, not when the driver happens to collect its garbage.

    Several blocks may be open at a time; the session is as it was once all of them are closed.
    """
    with _lock:
        block = _open_blocks.setdefault(spark, [0, spark.conf.get(_SHUFFLES_GO, None)])
        block[0] += 1
        spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        with _lock:
            block[0] -= 1
            if not block[0]:
                before = _open_blocks.pop(spark)[1]
                spark.conf.unset(_SHUFFLES_GO) if before is None else spark.conf.set(_SHUFFLES_GO, before)


def land(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table and go on from its files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_counted(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """As ``land``, with the number of rows, observed while they are written."""
    seen = Observation()
    landed = land(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return landed, seen.get["rows"]
