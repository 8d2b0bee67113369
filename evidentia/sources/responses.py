"""Answers of remote services, shared by all tasks and kept between runs.

A request is its method, URL and body; its key is their SHA-256. What is asked is made different first and held against the stored answers by an anti-join, so each request goes out once for the
whole job, and not at all if its answer is there and good. Answers are appended under the key's first byte; the newest one counts."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.sources import files

ANSWER = "key string, method string, url string, body string, answer string, error string, asked_at timestamp, shard string"


def request_key(method: Column, url: Column, body: Column) -> Column:
    return F.sha2(F.concat_ws("\n", F.upper(method), url, F.coalesce(body, F.lit(""))), 256)


def stored(spark: SparkSession, at: str, *, since: Column | None = None) -> DataFrame:
    """The newest good answer of each request; ``since`` leaves out older ones."""
    rows = files.or_empty(spark, spark.createDataFrame([], ANSWER).schema, lambda r: r.parquet(at)).filter("error is null")
    if since is not None:
        rows = rows.filter(F.col("asked_at") >= since)
    newest = rows.groupBy("key").agg(F.max_by(F.struct("method", "url", "body", "answer", "asked_at"), "asked_at").alias("a"))
    return newest.select("key", "a.*")


def answered(requests: DataFrame, at: str, fetch: Callable[[str, str, str | None], str], *, since: Column | None = None, tasks: int | None = None) -> DataFrame:
    """``requests`` (method, url, body, and any columns) with their ``answer``. Requests without a good stored answer go out, once each, and their answers are stored; what fails is stored with its error, has a
    null answer and is asked again next time. ``fetch(method, url, body)`` runs in ``tasks`` tasks."""
    spark = requests.sparkSession
    keyed = requests.withColumn("key", request_key(F.col("method"), F.col("url"), F.col("body")))
    wanted = keyed.select("key", F.upper("method").alias("method"), "url", "body").dropDuplicates(["key"])
    missing = wanted.join(stored(spark, at, since=since).select("key"), "key", "left_anti")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():  # an answer at a time: what was got is not lost with the batch
                answer = error = None
                try:
                    answer = fetch(row["method"], row["url"], row["body"])
                    answer = answer if isinstance(answer, str) else json.dumps(answer)
                except Exception as e:  # noqa: BLE001  whatever a service does is its answer
                    error = f"{type(e).__name__}: {e}"[:500]
                yield pa.RecordBatch.from_pylist([{**row, "answer": answer, "error": error}], schema=pa.schema([(n, pa.string()) for n in ("key", "method", "url", "body", "answer", "error")]))

    asked = missing.repartition(tasks or spark.sparkContext.defaultParallelism, "key").mapInArrow(run, "key string, method string, url string, body string, answer string, error string")
    asked.withColumns({"asked_at": F.current_timestamp(), "shard": F.substring("key", 1, 2)}).write.mode("append").partitionBy("shard").parquet(at)
    return keyed.join(stored(spark, at, since=since).select("key", "answer"), "key", "left").drop("key")


def evict(spark: SparkSession, at: str, to: str, sound: Column, *, since: Column | None = None) -> None:
    """Write the good answers that are sound (a condition on the answers' columns) to a new folder: the rest will be asked again."""
    kept = stored(spark, at, since=since).filter(F.coalesce(sound, F.lit(False)))
    kept.withColumns({"error": F.lit(None).cast("string"), "shard": F.substring("key", 1, 2)}).write.partitionBy("shard").parquet(to)
