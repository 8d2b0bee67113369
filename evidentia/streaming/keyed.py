"""Streams with state for each key: verdicts that change, and moves of a pair that later events upgrade.

Both are ``transformWithStateInPandas`` processors with value state, which Spark keeps in its checkpoint and can drop some time after its last change (``ttl``). Rows come out when something
changed, in append mode, so any sink on shared storage will do; a restart goes on from the checkpoint. They need Spark's RocksDB state store (``with_state_store``).

A call of a processor, its requests for state and the frames that go in and out cost some ten milliseconds, however few rows they are for. Keys are therefore dealt by their hash to ``buckets``, and a call takes a
bucket: its rows of the batch and the state of its keys. The number of buckets belongs to the checkpoint, as the number of state partitions does; it has to grow with the keys, so that a bucket stays small."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A time that is not known, as the least and as the greatest of none.
NEVER, EVER = 2**63 - 1, -(2**63)


def with_state_store(spark: SparkSession) -> None:
    """Choose the RocksDB state store, unless the session names one of its own."""
    if "RocksDB" not in (spark.conf.get(STORE, None) or ""):
        spark.conf.set(STORE, ROCKS)


def _coded(stream: DataFrame, keys: list[str]) -> Column:
    """One text for the keys of a row, from which ``_decoded`` makes them again: no key is a pandas number on the way, which would lose digits beside a null."""

    def text(c: str) -> Column:
        kind = stream.schema[c].dataType.simpleString()
        if kind in ("float", "double"):
            return (F.col(c) + F.lit(0).cast(kind)).cast("string")  # 0.0 and -0.0 are one key
        return F.hex(c) if kind == "binary" else F.unix_micros(c).cast("string") if kind == "timestamp" else F.col(c).cast("string")

    return F.to_json(F.array(*map(text, keys)))


def _decoded(stream: DataFrame, keys: list[str]) -> list[Column]:
    parts = F.from_json("row_key", "array<string>")

    def value(i: int, c: str) -> Column:
        kind = stream.schema[c].dataType.simpleString()
        return (F.unhex(parts[i]) if kind == "binary" else F.timestamp_micros(parts[i].cast("long")) if kind == "timestamp" else parts[i].cast(kind)).alias(c)

    return [value(i, c) for i, c in enumerate(keys)]


def _dealt(stream: DataFrame, keys: list[str], buckets: int, at: str, **others: str):
    """Rows as the processors take them, by bucket; times are numbers, as pandas has not all of them."""
    rows = stream.select(_coded(stream, keys).alias("row_key"), F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(NEVER)).alias("row_at"), *(F.col(c).cast("string").alias(n) for n, c in others.items()))
    return rows.withColumn("bucket", F.pmod(F.xxhash64("row_key"), F.lit(buckets))).groupBy("bucket")


def _time(c: str, none: int) -> Column:
    return F.when(F.col(c) != none, F.timestamp_micros(c)).alias(c)


class _Bucket(StatefulProcessor):
    """The keys of a bucket with their state, each dropped ``ttl`` after its last row."""

    def __init__(self, fields: dict[str, str], ttl: int | None):
        self.fields, self.ttl = fields, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        arrays = ", ".join(f"{n} array<{kind}>" for n, kind in {"keys": "string", "touched": "bigint", **self.fields}.items())
        self.held = handle.getValueState("bucket", arrays, self.ttl)

    def load(self, timers) -> tuple[dict, dict, int]:
        """State and time of the last row by key, and the time now."""
        now, got = timers.getCurrentProcessingTimeInMs() if self.ttl is not None else 0, self.held.get()
        if got is None:
            return {}, {}, now
        keys, touched, *values = got
        known, last = dict(zip(keys, zip(*values, strict=True), strict=True)), dict(zip(keys, touched, strict=True))
        if self.ttl is not None:
            last = {k: t for k, t in last.items() if t + self.ttl > now}
            known = {k: known[k] for k in last}
        return known, last, now

    def save(self, known: dict, last: dict) -> None:
        values = [list(x) for x in zip(*known.values(), strict=True)] or [[] for _ in self.fields]
        self.held.update((list(known), [last[k] for k in known], *values))


class _Verdicts(_Bucket):
    def __init__(self, ttl: int | None):
        super().__init__({"verdicts": "string"}, ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        known, last, now = self.load(timers)
        seen = pd.concat(list(rows))
        key, keys = pd.factorize(seen["row_key"])
        verdict, names = pd.factorize(seen["row_verdict"], sort=True)  # null is -1
        order = np.lexsort((np.where(verdict < 0, len(names), verdict), seen["row_at"], key))
        key, verdict, at = key[order], verdict[order], seen["row_at"].to_numpy()[order]
        first = np.append(True, key[1:] != key[:-1])
        after = np.array([*names, None], dtype=object)[verdict]
        before, status = np.append(None, after[:-1]), np.full(len(after), "CHANGED", dtype=object)
        changed = np.append(True, verdict[1:] != verdict[:-1])
        for i, k in zip(np.flatnonzero(first).tolist(), keys, strict=True):
            had = known.get(k)
            before[i], status[i], changed[i] = had and had[0], "CHANGED" if had else "NEW", had is None or had[0] != after[i]
        known.update(zip(keys, zip(after[np.append(first[1:], True)]), strict=True))
        last.update(dict.fromkeys(keys, now))
        self.save(known, last)
        yield pd.DataFrame({"row_key": np.asarray(keys, dtype=object)[key], "at": at, "before": before, "after": after, "status": status})[changed]


def changes(stream: DataFrame, key: str, verdict: str, at: str, ttl: int | None = None, buckets: int = 1024) -> DataFrame:
    """A row for each new key and each changed verdict: key, at, before, after, status (NEW or CHANGED). Rows of a batch go by ``at`` (a timestamp), then by verdict; a key whose state was dropped (``ttl``, in
    milliseconds) is new again."""
    rows = _dealt(stream, [key], buckets, at, row_verdict=verdict)
    out = rows.transformWithStateInPandas(_Verdicts(ttl), "row_key string, at long, before string, after string, status string", "Append", "None" if ttl is None else "ProcessingTime")
    return out.select(*_decoded(stream, [key]), _time("at", NEVER), "before", "after", "status")


class _Moves(_Bucket):
    def __init__(self, ttl: int | None):
        super().__init__({"earliest": "bigint", "latest": "bigint", "kinds": "array<string>"}, ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        known, last, now = self.load(timers)
        fresh: dict[str, list] = {}
        for pdf in rows:
            for k, at, kind in zip(pdf["row_key"].tolist(), pdf["row_at"].tolist(), pdf["row_kind"].tolist(), strict=True):
                new = fresh.get(k)
                if new is None:
                    low, high, kinds = known.get(k, (NEVER, EVER, ()))
                    new = fresh[k] = [low, high, set(kinds)]
                if at != NEVER:
                    new[0], new[1] = min(new[0], at), max(new[1], at)
                if isinstance(kind, str):
                    new[2].add(kind)
        out = []
        for k, (low, high, kinds) in fresh.items():
            old = known.get(k)
            what = "NEW" if old is None else "UPGRADED" if len(kinds) > len(old[2]) else "EXTENDED"
            if what != "EXTENDED" or (low, high) != tuple(old[:2]):
                out.append((k, low, high, ",".join(sorted(kinds)), len(kinds) > 1, what))
            known[k], last[k] = (low, high, sorted(kinds)), now
        self.save(known, last)
        yield pd.DataFrame(out, columns=["row_key", "earliest", "latest", "kinds", "cross_linked", "what"])


def upgraded_moves(stream: DataFrame, company: str, target: str, kind: str, at: str, ttl: int | None = None, buckets: int = 1024) -> DataFrame:
    """The move of each pair as it is after a batch that changed it: first and last event, kinds (joined by commas), whether there are several, and what happened: NEW, UPGRADED (by an event of
    another kind) or EXTENDED (in time). The last row of a pair is its move."""
    rows = _dealt(stream, [company, target], buckets, at, row_kind=kind)
    schema = "row_key string, earliest long, latest long, kinds string, cross_linked boolean, what string"
    out = rows.transformWithStateInPandas(_Moves(ttl), schema, "Append", "None" if ttl is None else "ProcessingTime")
    return out.select(*_decoded(stream, [company, target]), _time("earliest", NEVER), _time("latest", EVER), "kinds", "cross_linked", "what")
