"""URL filters: rules by host suffix and path prefix, and a Bloom filter cascade for everything else.

Cascade. Level 1 is a Bloom filter of the listed keys. The keys of the complete universe that it wrongly admits form level 2,
the listed keys that level 2 wrongly admits form level 3, and so on until nothing is wrongly admitted. A key is listed exactly if the
first level that rejects it has an even number (or if it passes an odd number of levels). Over the universe this is exact, without a join
with the list.

Scale. Keys are dealt to shards by hash and each shard has its own cascade, built in one task from its share of the universe
(distinct keys, at most about ``SHARD_KEYS`` of them whatever the corpus; repeated keys are removed before the shuffle). Filters
are applied by broadcast only while all shards together stay under ``BROADCAST_BYTES``; beyond that, rows meet the
shard's filter in a cogroup, with each shard's rows salted over tasks.

Null urls and urls without ``://`` have empty host and path and fit no rule; their key is the empty one. Empty tables, repeated rows
and further columns are handled; a very long url is one key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.scratch import small_batches, unused
from evidentia.llm.textnum import U, mix

SHARD_KEYS, BROADCAST_BYTES, SALTS = 200_000, 8 << 20, 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(rest, _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rules (verdict, host, path): the name and verdict of the longest that fits; ties go to the first given. Null without one."""
    name = verdict = F.lit(None).cast("string")
    for _, (kind, h, p) in sorted(enumerate(rules), key=lambda r: (len(r[1][1]) + len(r[1][2]), -r[0])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _slots(a: np.ndarray, b: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bit positions by double hashing, another pair for each level."""
    a, b = mix(a + U(level * 0x9E3779B97F4A7C15 % (1 << 64))), mix(b ^ U(level * 0x5851F42D4C957F2D % (1 << 64))) | U(1)
    return (a[:, None] + b[:, None] * np.arange(hashes, dtype=U)) % U(bits)


def _size(n: int, rate: float) -> tuple[int, int]:
    bits = max(64, int(-n * np.log(rate) / np.log(2) ** 2))
    return (bits + 63) // 64 * 64, max(1, round(-np.log2(rate)))


def build_cascade(a: np.ndarray, b: np.ndarray, listed: np.ndarray) -> bytes:
    """The cascade of one shard's universe; each level: number of bits, number of hashes, bits."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    out, level = [], 0
    while len(inside):
        level += 1
        bits, hashes = _size(len(inside), min(0.5, max(0.002, len(inside) / max(1, len(outside)) / 1.44)) if level == 1 else 0.5)
        field = np.zeros(bits, bool)
        field[_slots(a[inside], b[inside], level, bits, hashes)] = True
        out.append(np.array([bits, hashes], "<u4").tobytes() + np.packbits(field).tobytes())
        passed = outside[field[_slots(a[outside], b[outside], level, bits, hashes)].all(1)] if len(outside) else outside
        inside, outside = passed, inside
    return b"".join(out)


def in_cascade(blob: bytes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    alive, at, level, verdict = np.arange(len(a)), 0, 0, np.zeros(len(a), bool)
    while at < len(blob) and len(alive):
        level += 1
        bits, hashes = map(int, np.frombuffer(blob, "<u4", 2, at))
        field = np.unpackbits(np.frombuffer(blob, np.uint8, bits // 8, at + 8)).astype(bool)
        at += 8 + bits // 8
        ok = field[_slots(a[alive], b[alive], level, bits, hashes)].all(1)
        verdict[alive[~ok]] = level % 2 == 0
        alive = alive[ok]
    verdict[alive] = level % 2 == 1
    return verdict


def _keyed(df: DataFrame, key: Column, shards: int, names: list[str]) -> DataFrame:
    a, b, shard = names
    return df.withColumns({a: F.xxhash64(key), b: F.xxhash64(F.lit(1), key)}).withColumn(shard, F.pmod(a, F.lit(shards)).cast("int"))


def shard_count(n_rows: int) -> int:
    return max(1, -(-n_rows // SHARD_KEYS))


def listed_keys(universe: DataFrame, key: Column, outside: DataFrame, outside_key: Column) -> DataFrame:
    """(key, listed): the different keys of the universe, and whether a list from outside has them. One grouped union, no join; keys that only
    the list has are left out, as the universe is complete. Null keys of the list match null keys."""
    rows = universe.select(key.alias("key"), F.lit(True).alias("inside"), F.lit(False).alias("listed"))
    rows = rows.unionByName(outside.select(outside_key.alias("key"), F.lit(False).alias("inside"), F.lit(True).alias("listed")))
    return rows.groupBy("key").agg(F.max("inside").alias("inside"), F.max("listed").alias("listed")).filter("inside").select("key", "listed")


def cascades(universe: DataFrame, key: Column, listed: Column, shards: int) -> DataFrame:
    """(shard, cascade): ``listed`` is a boolean column over the universe. A key counts as listed if any of its rows does."""
    keys = _keyed(universe.select(key.alias("_key"), F.coalesce(listed, F.lit(False)).alias("_listed")), F.col("_key"), shards, ["_a", "_b", "_shard"])
    keys = keys.groupBy("_shard", "_a", "_b").agg(F.max("_listed").alias("_listed"))

    def build(table: pa.Table) -> pa.Table:
        a, b = (table.column(c).to_numpy().view(U) for c in ("_a", "_b"))
        blob = build_cascade(a, b, table.column("_listed").to_numpy(zero_copy_only=False))
        return pa.table({"shard": table.column("_shard")[:1], "cascade": pa.array([blob], pa.binary())})

    return keys.groupBy("_shard").applyInArrow(build, "shard int, cascade binary")


def apply_cascades(df: DataFrame, key: Column, filters: DataFrame, shards: int, *, out_col: str = "listed") -> DataFrame:
    """Add the exact membership of each row's key; a column named like the new one is replaced."""
    small_batches(df.sparkSession)
    names = [unused(x, df.columns) for x in ("_a", "_b", "_shard", "_salt")]
    of_a, of_b, of_shard, salt = names
    df = _keyed(df, key, shards, names[:3])
    kept = [c for c in df.columns if c not in names and c.lower() != out_col.lower()]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept), f"`{out_col}` boolean"])

    def judged(batch, blobs) -> pa.Array:
        a, b = (batch.column(c).to_numpy().view(U) for c in (of_a, of_b))
        shard, got = batch.column(of_shard).to_numpy(), np.zeros(batch.num_rows, bool)
        for s in np.unique(shard):
            at = np.flatnonzero(shard == s)
            got[at] = in_cascade(blobs.get(int(s), b""), a[at], b[at])
        return pa.array(got)

    size = filters.agg(F.coalesce(F.sum(F.octet_length("cascade")), F.lit(0)).cast("long")).first()[0]
    if size <= BROADCAST_BYTES:
        sent = df.sparkSession.sparkContext.broadcast({r.shard: bytes(r.cascade) for r in filters.collect()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), judged(batch, sent.value)], names=[*kept, out_col])

        return df.mapInArrow(run, schema)
    salted = df.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in kept]), F.lit(SALTS)).cast("int"))
    spread = filters.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def both(rows: pa.Table, blob: pa.Table) -> pa.Table:
        blobs = dict(zip(blob.column("shard").to_pylist(), blob.column("cascade").to_pylist(), strict=True))
        return rows.select(kept).append_column(out_col, judged(rows.combine_chunks(), blobs))

    return salted.groupBy(of_shard, salt).cogroup(spread.groupBy("shard", salt)).applyInArrow(both, schema)
