"""Readers and writers with fixed schemas: parquet, delimited, JSON documents and lines, key lists, XML, snapshots."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def delimited(spark: SparkSession, path: str, columns: list[str], sep: str = "\t") -> DataFrame:
    """All strings, no quoting, header line."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("sep", sep).option("header", True).option("quote", "" if sep == "\t" else '"').csv(path)


def or_empty(spark: SparkSession, schema: T.StructType, read: Callable) -> DataFrame:
    """What ``read`` gives from a reader with that schema; an empty table if the path does not exist. Any other failure is one."""
    try:
        return read(spark.read.schema(schema))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def json_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A whole-file JSON document; a missing file is an empty table."""
    return or_empty(spark, schema, lambda r: r.option("multiLine", True).json(path))


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return or_empty(spark, schema, lambda r: r.json(path))


def key_list(spark: SparkSession, path: str, sep: str = "\t", header: str | None = None) -> DataFrame:
    """First field of each line, less what follows " (", without the header and blanks."""
    key = F.trim(F.substring_index(F.substring_index("value", sep, 1), " (", 1))
    out = spark.read.text(path).select(key.alias("key")).filter("key <> ''")
    return out.filter(F.col("key") != header) if header else out


def xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def _names(spark: SparkSession, root: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def latest_snapshot(spark: SparkSession, root: str, table: str) -> str | None:
    """The newest dated folder (YYYY-MM-DD) under ``root`` whose table can be read."""
    for d in sorted((x for x in _names(spark, root) if re.fullmatch(r"\d{4}-\d{2}-\d{2}", x)), reverse=True):
        try:
            spark.read.parquet(f"{root}/{d}/{table}").schema  # noqa: B018
            return d
        except (PySparkException, Py4JJavaError):  # missing, or no footer that can be read
            continue
    return None


def constant(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def append_new(claims: DataFrame, path: str, schema: T.StructType, key: str = "claim_key") -> None:
    """Append-if-new to a JSON-lines log."""
    from evidentia.operators.claims import new_only

    new_only(claims, json_lines(claims.sparkSession, path, schema), key).write.mode("append").json(path)


def dated_snapshot(df: DataFrame, path: str, day: str) -> None:
    """The snapshot of a day in its folder; written again, it replaces that day and no other."""
    df.write.mode("overwrite").parquet(f"{path}/run_date={day}")


def replace_state(df: DataFrame, path: str, version: int) -> None:
    """Keyed state as a new version folder, so that a reader of the old one is never cut off."""
    df.write.mode("overwrite").parquet(f"{path}/version={version:010d}")


def newest_state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The state's last whole version; without one, an empty table."""
    found = sorted(name for name in _names(spark, path) if name.startswith("version=") and "_SUCCESS" in _names(spark, f"{path}/{name}"))
    return spark.read.schema(schema).parquet(f"{path}/{found[-1]}") if found else spark.createDataFrame([], schema)


def overwrite_json(df: DataFrame, path: str) -> None:
    """A JSON artifact as a folder of lines, replaced as a whole."""
    df.write.mode("overwrite").json(path)


def write_pointer(spark: SparkSession, path: str, value: str) -> None:
    """A one-row table that names the current snapshot."""
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_pointer(spark: SparkSession, path: str) -> str | None:
    row = or_empty(spark, T.StructType([T.StructField("value", T.StringType())]), lambda r: r.text(path)).first()
    return row.value if row else None


def xlsx(spark: SparkSession, path: str, columns: list[str], *, sheet: int = 1, skip: int = 1) -> DataFrame:
    """Rows of one sheet of each workbook under ``path`` as strings, less the first ``skip``: a workbook is a zip of XML. Empty cells are null, further
    ones are left out; ``file`` and ``row`` (from 1, in the sheet) come first."""
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("row", T.LongType()), *(T.StructField(c, T.StringType()) for c in columns)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import xml.etree.ElementTree as ET
        import zipfile

        ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        place = lambda ref: sum((ord(c) - 64) * 26**i for i, c in enumerate(reversed(re.match("[A-Z]+", ref)[0]))) - 1
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                book, out = zipfile.ZipFile(io.BytesIO(content)), []
                shared = []
                if "xl/sharedStrings.xml" in book.namelist():
                    shared = ["".join(t.text or "" for t in si.iter(ns + "t")) for si in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(ns + "si")]
                with book.open(f"xl/worksheets/sheet{sheet}.xml") as f:
                    for _, row in ET.iterparse(f):
                        if row.tag != ns + "row":
                            continue
                        cells: list[str | None] = [None] * len(columns)
                        for c in row.iter(ns + "c"):
                            i, v = place(c.get("r")), c.find(ns + "v")
                            text = "".join(t.text or "" for t in c.iter(ns + "t")) if c.get("t") == "inlineStr" else None if v is None else shared[int(v.text)] if c.get("t") == "s" else v.text
                            if i < len(columns):
                                cells[i] = text
                        out.append((file, int(row.get("r")), *cells))
                        row.clear()
                yield pd.DataFrame([r for r in out if r[1] > skip], columns=schema.names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)
