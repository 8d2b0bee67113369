"""Claim log: build, append only what is new, corroborate, rank, read as of a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from evidentia.functions.text import claim_key, symbols
from evidentia.operators.resolve import resolve
from evidentia.sources.shared import written

CLAIM = T.StructType([T.StructField(n, T.StringType()) for n in ("subject", "evidence_type", "source", "source_record_id", "actor")] + [T.StructField("valid_time", T.DateType()), T.StructField("observed_at", T.DateType()), T.StructField("path", T.StringType()), T.StructField("claim_key", T.StringType())])


def build(df: DataFrame, *, subject: Column, evidence_type: Column, source: Column, record: Column, actor: Column, valid_time: Column, observed_at: Column, path: Column) -> DataFrame:
    cols = {"subject": subject, "evidence_type": evidence_type, "source": source, "source_record_id": record, "actor": actor, "path": path}
    out = df.select(*(c.cast("string").alias(n) for n, c in cols.items()), valid_time.cast("date").alias("valid_time"), observed_at.cast("date").alias("observed_at"))
    keyed = out.withColumn("claim_key", claim_key(F.col("source"), F.col("source_record_id"), F.col("evidence_type"), F.col("subject")))
    return keyed.select(*CLAIM.names)


def new_only(claims: DataFrame, log: DataFrame, key: str = "claim_key") -> DataFrame:
    """Claims whose key is not in the log, one of each key (the first by all columns): appending twice adds nothing."""
    order = [F.col(c).asc_nulls_last() for c in claims.columns if c != key]
    first = claims.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter("_n = 1").drop("_n")
    return first.join(log.select(key).distinct(), key, "left_anti").select(*claims.columns)


def emerging(df: DataFrame, subject: str, actor: str, date: str, kind: str) -> DataFrame:
    """Subjects with an actor and a date: first date, actors, kinds, records; newest first, then fewest actors."""
    agg = df.groupBy(subject).agg(F.min(date).alias("earliest"), F.countDistinct(F.when(F.col(actor) != "", F.col(actor)) if dict(df.dtypes)[actor] == "string" else F.col(actor)).alias("sponsors"), F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("kinds"), F.count("*").alias("n_claims"))
    return agg.filter((F.col("sponsors") > 0) & F.col("earliest").isNotNull())


#: Bits of a row's place within its partition in ``monotonically_increasing_id``.
PLACE_BITS = 33


def sorted_once(df: DataFrame, *order: Column) -> DataFrame:
    """Rows in global order with ``_part``, the range partition, and ``_place``, the place in it from 0. The sort is written, since partitions
    are cut anew (by size, and so by columns) whenever a sort is planned again: numbers from two plans do not fit together."""
    at = F.monotonically_increasing_id()
    placed = df.orderBy(*order).withColumns({"_part": F.shiftright(at, PLACE_BITS), "_place": at.bitwiseAND((1 << PLACE_BITS) - 1)})
    return written(placed, "sorted")


def before_parts(parts: DataFrame, amount: Column) -> DataFrame:
    """(_part, _offset): the sum of ``amount`` over all partitions before. One row for each partition."""
    sums = parts.groupBy("_part").agg(amount.alias("_s"))
    return sums.select("_part", F.coalesce(F.sum("_s").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Global ordinal rank from 1, without one task that sorts everything: the place within a range partition plus the rows of those before it."""
    parts = sorted_once(df, *order)
    offsets = before_parts(parts, F.count("*"))
    return parts.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_place") + F.col("_offset") + 1).drop("_part", "_place", "_offset")


def corroborated(df: DataFrame, subject: str, kind: str, least: int = 2) -> DataFrame:
    return df.groupBy(subject).agg(F.countDistinct(kind).alias("n_kinds")).filter(F.col("n_kinds") >= least)


def as_of(df: DataFrame, key: str, observed: str, when: Column, *tie: str) -> DataFrame:
    """Latest row of each key observed up to ``when``."""
    w = W.partitionBy(key).orderBy(F.col(observed).desc(), *(F.col(t).desc() for t in tie))
    return df.filter(F.col(observed) <= when).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def rolled_up(df: DataFrame, subject: str, actor: str, kind: str, date: str, days: int) -> DataFrame:
    """Corroboration within a window before each subject's last date: independent actors and kinds."""
    last = df.groupBy(subject).agg(F.max(date).alias("last"))
    near = df.join(last, subject).filter(F.col(date) >= F.date_sub("last", days))
    return near.groupBy(subject).agg(F.countDistinct(actor).alias("actors"), F.countDistinct(kind).alias("kinds")).filter("actors > 1")


def mentions(df: DataFrame, text: Column | None, drugs: Column | None, symbol: DataFrame, alias: DataFrame, targets: DataFrame | None = None, *, stop: list[str] = ()) -> DataFrame:
    """The entities of each row, exploded: path A, the upper-case tokens of its text that resolve; path B, the resolved targets (name, id) of its drugs. A pair of
    row and entity that both paths give stays twice, once for each path."""
    out = None
    if text is not None:
        tokens = df.withColumn("mention", F.explode(symbols(text, list(stop))))
        out = resolve(tokens, "mention", symbol, alias).filter("outcome = 'RESOLVED'").select(*df.columns, F.col("id").alias("entity"), F.lit("A").alias("path"))
    if drugs is not None and targets is not None:
        named = df.withColumn("_drug", F.explode(drugs)).join(targets.select(F.col("name").alias("_drug"), F.col("id").alias("entity")).distinct(), "_drug")
        b = named.select(*df.columns, "entity", F.lit("B").alias("path"))
        out = b if out is None else out.unionByName(b)
    return out


def projected(log: DataFrame, mention: str, symbol: DataFrame, alias: DataFrame, version: str) -> DataFrame:
    """The canonical claims under one version of the resolver: the log stays as it is, and what resolves to one entity has it as subject."""
    got = resolve(log, mention, symbol, alias).filter("outcome = 'RESOLVED'")
    return got.withColumn("subject", F.col("id")).withColumn("resolver_version", F.lit(version)).drop("outcome", "id", "candidates")


def trailing(df: DataFrame, date: str, as_of: Column, days: int = 90) -> DataFrame:
    """Rows of the window that ends at ``as_of``."""
    return df.filter((F.col(date) > F.date_sub(as_of, days)) & (F.col(date) <= as_of))


def out_of_order(df: DataFrame, *order: Column, key: str, date: str) -> DataFrame:
    """Adds ``in_order``: whether a row's date is not before that of the row before it, by key in the given order (the first row: null)."""
    return df.withColumn("in_order", F.lag(date).over(W.partitionBy(key).orderBy(*order)) <= F.col(date))
