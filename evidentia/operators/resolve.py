"""Three-outcome entity resolution: RESOLVED by symbol, RESOLVED by the only alias, AMBIGUOUS with candidates, UNRESOLVED."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.functions.text import base_substance, norm_key, split_packed, unsuppressed


def index(entities: DataFrame, id_col: str, symbol: str, packed_aliases: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(key, id) of symbols, and (key, ids) of aliases as sorted sets."""
    sym = entities.select(norm_key(F.col(symbol)).alias("key"), F.col(id_col).cast("string").alias("id")).filter("key <> ''").groupBy("key").agg(F.max("id").alias("id"))
    names = F.concat(*(split_packed(F.col(c)) for c in packed_aliases)) if packed_aliases else F.array().cast("array<string>")
    alias = entities.select(F.explode(names).alias("key"), F.col(id_col).cast("string").alias("id"))
    return sym, aliases(alias, "key", "id")


def aliases(df: DataFrame, name: str, id_col: str) -> DataFrame:
    return df.select(norm_key(F.col(name)).alias("key"), F.col(id_col).cast("string").alias("id")).filter("key <> ''").groupBy("key").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def resolve(mentions: DataFrame, mention: str, symbols: DataFrame, alias: DataFrame) -> DataFrame:
    """Adds ``outcome``, ``id``, ``candidates``. Two equi-joins on the normalised mention; the sizes decide their kind."""
    m = mentions.withColumn("_key", norm_key(F.col(mention)))
    s, a = symbols.select(F.col("key").alias("_key"), F.col("id").alias("_sid")), alias.select(F.col("key").alias("_key"), F.col("ids").alias("_ids"))
    j = m.join(s, "_key", "left").join(a, "_key", "left")
    n = F.coalesce(F.size("_ids"), F.lit(0))
    outcome = F.when(F.col("_sid").isNotNull() | (n == 1), "RESOLVED").when(n > 1, "AMBIGUOUS").otherwise("UNRESOLVED")
    none = F.array().cast("array<string>")
    return j.select(*mentions.columns, outcome.alias("outcome"), F.coalesce("_sid", F.when(n == 1, F.element_at("_ids", 1))).alias("id"), F.when(F.col("_sid").isNull() & (n > 1), F.col("_ids")).otherwise(none).alias("candidates"))


def resolve_substance(names: DataFrame, name: str, parents: DataFrame, targets: DataFrame, fallback: DataFrame, symbols: DataFrame, alias: DataFrame) -> DataFrame:
    """Substance cascade. ``parents`` (name, parent), ``targets`` (parent, symbol, kind), ``fallback`` (name, symbol): base name to its only parent
    (several: AMBIGUOUS), its single-protein targets, else the fallback's; each symbol is then resolved."""
    base = names.withColumn("_base", base_substance(F.col(name)))
    p = parents.select(base_substance(F.col("name")).alias("_base"), "parent").groupBy("_base").agg(F.array_sort(F.collect_set("parent")).alias("_parents"))
    j = base.join(p, "_base", "left")
    one = j.withColumn("_parent", F.when(F.size("_parents") == 1, F.element_at("_parents", 1)))
    t = targets.filter("kind = 'SINGLE PROTEIN'").groupBy("parent").agg(F.array_sort(F.collect_set("symbol")).alias("_t")).withColumnRenamed("parent", "_parent")
    f = fallback.select(base_substance(F.col("name")).alias("_base"), "symbol").groupBy("_base").agg(F.array_sort(F.collect_set("symbol")).alias("_f"))
    named = one.join(t, "_parent", "left").join(f, "_base", "left")
    many = F.coalesce(F.size("_parents") > 1, F.lit(False))
    got = named.select(*names.columns, many.alias("_many"), F.explode_outer(F.when(~many, F.coalesce("_t", "_f"))).alias("symbol"))
    r = resolve(got, "symbol", symbols, alias)
    return r.withColumn("outcome", F.when(F.col("_many"), "AMBIGUOUS").otherwise(F.col("outcome"))).drop("_many")


def named_targets(df: DataFrame, key: str, text, symbols: DataFrame, alias: DataFrame, labels: DataFrame, stop: list[str] = ()) -> DataFrame:
    """(key, targets): the sorted symbols (``labels``: id, symbol) that a text's upper-case tokens of three to eight signs resolve to, without stop words and
    without tokens that only name a status; what is ambiguous names nothing. Texts without targets have an empty array."""
    tokens = F.array_except(unsuppressed(text, 2, 7), F.array(*map(F.lit, stop)).cast("array<string>"))
    found = resolve(df.select(key, F.explode(tokens).alias("mention")), "mention", symbols, alias).filter("outcome = 'RESOLVED'")
    named = found.join(labels.select(F.col("id").cast("string").alias("id"), "symbol"), "id").groupBy(key).agg(F.array_sort(F.collect_set("symbol")).alias("targets"))
    return df.select(key).join(named, key, "left").withColumn("targets", F.coalesce("targets", F.array().cast("array<string>")))
