"""Tables written once into the shared folder of the cluster and read back: lineage ends there, and what was computed is fixed.

The folder is ``spark.checkpoint.dir``. Only where that is unset and the session is a plain local one (as in tests) is a folder of this machine
used; elsewhere the warehouse folder serves. Results are lazy, so the tables stay until ``drop`` or the driver's end.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def base_uri(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local["):
        base = "file://" + tempfile.mkdtemp(prefix="evidentia-")
        spark.conf.set("spark.checkpoint.dir", base)
        return base
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    at = f"{base_uri(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, at))
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


@atexit.register
def drop() -> None:
    """Remove all tables written so far, as far as their sessions still run."""
    while _written:
        spark, at = _written.pop()
        jsc = spark.sparkContext._jsc
        if jsc is not None and not jsc.sc().isStopped():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)
