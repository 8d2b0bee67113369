"""Several tables that change together: each version is a manifest, made last and only if it is not there yet, that names the folder of every table.

A writer puts its tables into folders that nobody reads yet, then creates the manifest of the next version. Creating a file that may not exist is one step for the file system, so of two writers one
wins, and what fails before that step changes nothing. Readers take the highest manifest. (On stores whose create is not exclusive, give the folder a file system that is.)"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer made this version first."""


def _files(spark: SparkSession, at: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    return jvm, path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, at: str) -> list[int]:
    """Versions that were committed, in order."""
    _, path, fs = _files(spark, f"{at}/manifests")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(path) if s.getPath().getName().isdigit()) if fs.exists(path) else []


def manifest(spark: SparkSession, at: str, version: int) -> dict[str, str]:
    """Folders of the tables of a version, by name."""
    jvm, path, fs = _files(spark, f"{at}/manifests/{version:020d}")
    stream = fs.open(path)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read(spark: SparkSession, at: str, version: int | None = None) -> tuple[int, dict[str, DataFrame]]:
    """The tables of a version (the last one, if none is given) and its number; 0 and nothing before the first."""
    known = versions(spark, at)
    version = version if version is not None else known[-1] if known else 0
    if not version:
        return 0, {}
    return version, {name: spark.read.parquet(folder) for name, folder in manifest(spark, at, version).items()}


def commit(spark: SparkSession, at: str, tables: dict[str, DataFrame], base: int) -> int:
    """Write all tables as the version after ``base``; tables of that version that are not given stay. Raises ``Conflict`` if another writer was first."""
    folders = dict(manifest(spark, at, base)) if base else {}
    for name, df in tables.items():
        folders[name] = f"{at}/tables/{name}-{uuid.uuid4().hex}"
        df.write.parquet(folders[name])
    jvm, path, fs = _files(spark, f"{at}/manifests/{base + 1:020d}")
    try:
        stream = fs.create(path, False)
    except Exception as e:
        if fs.exists(path):
            raise Conflict(f"version {base + 1} of {at} is there already") from e
        raise
    try:
        stream.write(bytearray(json.dumps(folders).encode()))
    finally:
        stream.close()
    return base + 1


def update(spark: SparkSession, at: str, change: Callable[[dict[str, DataFrame]], dict[str, DataFrame]], tries: int = 5) -> int:
    """Read, change and commit, again from the newest version whenever another writer was first."""
    for i in range(tries):
        base, tables = read(spark, at)
        try:
            return commit(spark, at, change(tables), base)
        except Conflict:
            if i == tries - 1:
                raise
    raise AssertionError
