"""Shared working folders: what one job writes, every executor and the driver can read again.

The base folder is the cluster's ``spark.checkpoint.dir``. Only where that is unset and the session is a plain
local one (as in tests) is a folder of this machine used; elsewhere the warehouse folder serves.

Results are lazy, so an operator cannot know when its folder is no longer needed: whoever writes a result elsewhere calls ``drop`` (of one
call) or ``drop_since`` (of all calls since a ``mark``); the rest goes when the driver's Python ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession


def base_uri(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if spark.sparkContext.master.startswith(("local[", "local-one")) or spark.sparkContext.master == "local":
        base = "file://" + tempfile.mkdtemp(prefix="evidentia-")
        spark.conf.set("spark.checkpoint.dir", base)
        return base
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def unused(name: str, columns: list[str]) -> str:
    """A column name that begins with ``name`` and that no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bytes of an Arrow batch between the JVM and Python.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Batches of at most BATCH_BYTES (one row may be longer), unless the session has a limit of its own: texts make 64 MB, the default, of a few
    thousand rows, and both sides hold a batch whole, several times over."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, BATCH_BYTES)


class Scratch:
    """One folder per operator call; ``drop()`` removes it once the call's result has been written elsewhere."""

    _open: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.uri, self._n = spark, f"{base_uri(spark)}/{name}-{uuid.uuid4().hex}", 0
        Scratch._open.append(self)
        small_batches(spark)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.uri}/{name}-{self._n}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it back: lineage ends here, and a lost executor costs only its own tasks."""
        at = self.path(name)
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def remove(self, at: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self) -> None:
        if self in Scratch._open:
            Scratch._open.remove(self)
            self.remove(self.uri)


def mark() -> int:
    return len(Scratch._open)


def drop_since(at: int) -> None:
    """Drop the folders of all calls since that mark."""
    for s in Scratch._open[at:]:
        s.drop()


@atexit.register
def _drop_all() -> None:
    """At the driver's end, while its session is still there."""
    for s in list(Scratch._open):
        if s.spark.sparkContext._jsc is not None and not s.spark.sparkContext._jsc.sc().isStopped():
            s.drop()


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The folder's file system and its path there, made if it is missing. Runs on executors."""
    filesystem, path = pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))
    filesystem.create_dir(path, recursive=True)
    return filesystem, path
