"""Structured Streaming forms of first-seen alerts, idempotent appends, windows and merged moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.sources import files


def source(spark: SparkSession, path: str, schema, *, files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def timed(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on a timestamp (a timestamp without zone is cast first, as watermarks ask)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def first_seen(df: DataFrame, keys: list[str], *, within_watermark: bool = False) -> DataFrame:
    """The first row of each key. Keys are kept for good, unless ``within_watermark`` asks for state that forgets what is older than the watermark (a key may then come again)."""
    return df.dropDuplicatesWithinWatermark(keys) if within_watermark else df.dropDuplicates(keys)


def tumbling(df: DataFrame, ts: str, size: str, *keys: str, slide: str | None = None) -> DataFrame:
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return df.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def sessions(df: DataFrame, ts: str, gap: str, *keys: str) -> DataFrame:
    return df.groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def merged_moves(df: DataFrame, company: str, target: str, kind: str, ts: str) -> DataFrame:
    """Update-mode aggregate: an earlier event from another source upgrades the pair's row."""
    return df.groupBy(company, target).agg(F.min(ts).alias("earliest"), F.max(ts).alias("latest"), F.array_sort(F.collect_set(kind)).alias("kinds")).withColumn("cross_linked", F.size("kinds") > 1)


def append_new(stream: DataFrame, path: str, checkpoint: str, key: str):
    """foreachBatch sink that adds only keys the table does not have yet; safe when a batch is run again."""
    from evidentia.operators.claims import new_only

    def write(batch: DataFrame, _: int) -> None:
        log = files.or_empty(batch.sparkSession, batch.schema, lambda r: r.parquet(path))  # the first batch has no table yet
        new_only(batch, log, key).write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def appended(df: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over what is there now and append its rows to a table on shared storage; run again, it goes on from its checkpoint."""
    df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def drained(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now and return its rows through the driver: for smoke runs on a few rows; ``appended`` and ``upserted`` are for others."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def upserted(df: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream of changed rows over what is there now: each batch's rows go to a folder of its own, numbered, so that a batch that is run again replaces itself (``latest`` reads them)."""

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={n}")

    df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest(spark: SparkSession, path: str, keys: list[str], schema) -> DataFrame:
    """The last version of each key that ``upserted`` wrote."""
    rows = files.or_empty(spark, T.StructType([*schema.fields, T.StructField("batch", T.LongType())]), lambda r: r.parquet(path))
    rest = [f.name for f in schema.fields if f.name not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r"))
    return newest.select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest))


def newer(df: DataFrame, date: str, have: DataFrame, have_date: str, lag_days: int = 0) -> DataFrame:
    """Incremental cursor: rows after the last date there is, less ``lag_days`` for late ones (take what is new of them by key). Without a date
    all rows are new."""
    last = have.agg(F.max(have_date)).first()[0]
    return df if last is None else df.filter(F.col(date) > F.date_sub(F.lit(last).cast("date"), lag_days))


def evicted(state: DataFrame, sound) -> DataFrame:
    """State without entries that can no longer be verified, so that they are looked up again."""
    return state.filter(F.coalesce(sound, F.lit(False)))
