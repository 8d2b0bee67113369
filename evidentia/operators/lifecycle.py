"""Identifiers that are merged and renamed, and claims in two times."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from evidentia.sources.shared import written


def canonical_ids(changes: DataFrame, old: str, new: str) -> DataFrame:
    """(id, canonical): what each replaced identifier is called at last, over any number of renamings and mergers.

    Pointer jumping: in each round an identifier points to what its pointer points to, so a chain of n changes takes log n rounds. A cycle has no last name and is refused, and so is an identifier
    with two different successors; changes into itself and repeated ones say nothing."""
    edges = changes.select(F.col(old).alias("id"), F.col(new).alias("to")).filter("id is not null and to is not null and id <> to").distinct()
    forked = edges.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).collect()
    if forked:
        raise ValueError(f"{forked[0]['id']} has more than one successor")
    pointers = written(edges, "pointers")
    rounds, most = 0, max(1, pointers.count()).bit_length() + 1
    while True:
        after = pointers.select(F.col("id").alias("to"), F.col("to").alias("next"))
        jumped = written(pointers.join(after, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "pointers")
        rounds += 1
        if not jumped.filter("moved").limit(1).count():
            return jumped.select("id", F.col("to").alias("canonical"))
        if rounds > most or jumped.filter("id = to").limit(1).count():
            raise ValueError("identifiers replace each other in a cycle")
        pointers = jumped.drop("moved")


def as_canonical(claims: DataFrame, key: str, canonical: DataFrame, version: str) -> DataFrame:
    """Claims under the names of one version of the identifiers: ``original`` keeps the name that they were made under."""
    names = canonical.withColumnRenamed("id", key)
    out = claims.join(names, key, "left").withColumn("original", F.col(key)).withColumn(key, F.coalesce("canonical", key))
    return out.drop("canonical").withColumn("id_version", F.lit(version))


def by_version(changes: DataFrame, old: str, new: str, version: str, upto: Column) -> DataFrame:
    """The changes that a version of the identifiers knows."""
    return changes.filter(F.col(version) <= upto).select(old, new)


def successors(dates: DataFrame, key: str, date: str, known: str) -> DataFrame:
    """(key, date, _from, _to, valid_to): for each date of a key, which later date of it comes next, by what is known; a stretch for each change. A new date changes the successor of the one before it
    only, so there are at most twice as many stretches as dates.

    One pass over the keys' dates in order, many keys to a batch. What is kept is a stack of the dates of one key that have no later date known as early (earlier dates are known earlier in it), each with the
    start of the stretch that was found last, which ends the next one: the calendar bounds it."""
    once = dates.groupBy(key, date).agg(F.min(known).alias(known))
    kinds = {c: once.schema[c].dataType.simpleString() for c in (key, date, known)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stack, out = None, [], []

        def told(schema: pa.Schema) -> pa.RecordBatch:
            types = [schema.field(i).type for i in (0, 1, 2, 2, 1)]
            columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=[key, date, "_from", "_to", "valid_to"])

        def close() -> None:
            out.extend((now, day, since, end, None) for day, since, end in stack)
            stack.clear()

        for batch in batches:
            for k, day, since in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != now and (k == k or now == now):  # NaN is one key
                    close()
                    now = k
                while stack and stack[-1][1] >= since:
                    before = stack.pop()
                    out.append((k, before[0], before[1], before[2], day))
                    if before[1] == since:
                        break
                else:
                    if stack:
                        out.append((k, stack[-1][0], since, stack[-1][2], day))
                        stack[-1][2] = since
                stack.append([day, since, None])
            yield told(schema := batch.schema)
        close()
        if out:
            yield told(schema)

    sorted_dates = once.repartition(key).sortWithinPartitions(key, date)
    return sorted_dates.mapInArrow(run, f"`{key}` {kinds[key]}, `{date}` {kinds[date]}, _from {kinds[known]}, _to {kinds[known]}, valid_to {kinds[date]}")


def rectangles(claims: DataFrame, key: str, valid: str, observed: str, *tie: str) -> DataFrame:
    """Each claim as rectangles of the two times: valid from its date until the next date for which its key has a claim that is known as well, and known from its observation until a later one about
    the same date (``valid_to``, ``observed_to``: null while open, ends exclusive). A correction that reaches back closes what was said, from when on it was known to be so. ``valid`` is a date; rows without a key or
    either time say nothing. Of several claims of one key, date and observation the last by ``tie`` counts."""
    order = [F.col(c).desc_nulls_last() for c in tie] or [F.lit(1)]
    rows = claims.filter(" and ".join(f"`{c}` is not null" for c in (key, valid, observed)))
    rows = rows.withColumn("_n", F.row_number().over(W.partitionBy(key, valid, observed).orderBy(*order))).filter("_n = 1").drop("_n")
    rows = rows.withColumn("_until", F.lead(observed).over(W.partitionBy(key, valid).orderBy(observed)))
    next_dates = successors(rows, key, valid, observed)
    both = rows.join(next_dates, [key, valid]).filter((F.col("_until").isNull() | (F.col("_from") < F.col("_until"))) & (F.col("_to").isNull() | (F.col("_to") > F.col(observed))))
    out = both.withColumn("observed_to", F.least("_until", "_to")).withColumn(observed, F.greatest(F.col(observed), F.col("_from")))
    return out.select(*claims.columns, "valid_to", "observed_to")


def as_of_both(rects: DataFrame, valid: str, observed: str, day: Column, known: Column) -> DataFrame:
    """What was known at ``known`` to hold at ``day``: one row for each key."""
    inside = lambda at, start, end: (F.col(start) <= at) & (F.col(end).isNull() | (F.col(end) > at))
    return rects.filter(inside(day, valid, "valid_to") & inside(known, observed, "observed_to"))


def known_to_hold(claims: DataFrame, key: str, valid: str, observed: str, day: Column, known: Column, *tie: str) -> DataFrame:
    """The claims whose rectangles ``as_of_both`` would find, without the rectangles of all other times: what was observed by ``known`` about ``day`` or before it, and of that the last by date, observation
    and ``tie`` for each key. Each task keeps one row of a key before the shuffle, so a key of very many claims is no larger than others."""
    rows = claims.filter((F.col(valid) <= day) & (F.col(observed) <= known) & F.col(key).isNotNull())
    rest = [c for c in claims.columns if c != key]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(valid, observed, *tie)).alias("_r"))
    return newest.select(*(F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in claims.columns))
