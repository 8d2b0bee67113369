"""Moves: merge two legs of events into one cross-linked log, keep the best of duplicates, link trials to owners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from evidentia.functions.text import all_of, any_of, split_packed
from evidentia.operators.crowding import LANE, tier


def unify(df: DataFrame, company: str, target: str, kind: str, date: str, ident: str, saturated: Column | None = None) -> DataFrame:
    """One row per (company, target): first and last event, numbers by kind, cross-linked if both kinds occur, companies on the
    target, its lane, and its events (``signals``: date, kind, id) in order. Undated events sort last and never give the latest date. Rows without a company are left out.

    Companies per target come from a second aggregation joined back, so no window holds all rows of a popular target."""
    rows = df.filter(F.col(company).isNotNull() & (F.col(company).cast("string") != ""))
    signals = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(date).cast("string"), F.lit("9999")).alias("d"), F.col(kind).alias("k"), F.col(ident).cast("string").alias("i"))))
    g = rows.groupBy(company, target).agg(signals.alias("s"), F.max(date).alias("latest"), F.min(date).alias("earliest"), F.count_if(F.col(kind) == "patent").alias("n_patents"), F.count_if(F.col(kind) == "clinical").alias("n_trials"))
    peers = g.groupBy(target).agg(F.count("*").alias("n_companies"))
    out = g.join(peers, target).withColumns({"earliest_kind": F.element_at("s", 1)["k"], "cross_linked": (F.col("n_patents") > 0) & (F.col("n_trials") > 0), "n_signals": F.size("s").cast("long"), "signals": F.transform("s", lambda x: F.struct(F.when(x["d"] != "9999", x["d"]).alias("date"), x["k"].alias("kind"), x["i"].alias("id")))})
    return out.drop("s").withColumn("lane", tier(F.col("n_companies"), saturated=saturated, **LANE))


def best_of(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key: the first in the order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def crosslink(events: DataFrame, event: str, targets: str, owner: str, index: DataFrame, idx_target: str, idx_owner: str) -> DataFrame:
    """Per event: LIKELY if its own owner holds one of its targets (the first such), POSSIBLE if anyone does, else NONE with the first target, if it has any. An
    owner without a name holds nothing, but what it holds is held by someone."""
    t = events.select(event, owner, F.posexplode_outer(targets).alias("pos", "_t"))
    pairs = index.select(F.col(idx_target).alias("_t"), F.col(idx_owner).alias(owner)).filter(F.col(owner).isNotNull()).distinct()
    held = pairs.select("_t").distinct().withColumn("_held", F.lit(True))
    j = t.join(pairs.filter(F.col(owner).cast("string") != "").withColumn("_own", F.lit(True)), ["_t", owner], "left").join(held, "_t", "left")
    level = F.when(F.col("_own"), 0).when(F.col("_held"), 1).otherwise(2)
    best = j.groupBy(event).agg(F.min_by(F.struct("_t", level.alias("lv")), F.struct(level, "pos")).alias("b"))
    name = F.when(F.col("b.lv") == 0, "LIKELY").when(F.col("b.lv") == 1, "POSSIBLE").otherwise("NONE")
    return best.select(event, name.alias("link"), F.col("b._t").alias("link_target"))


def cascade(link: Column, class_hit: Column, fingerprint: Column, least: int = 4) -> Column:
    """Link first; a class word makes LIKELY; a fingerprint upgrades what is not LIKELY."""
    return F.when(link == "LIKELY", "LIKELY").when(class_hit, "LIKELY").when(fingerprint >= least, "FINGERPRINT").otherwise(link)


def covalency(link: Column, class_hit: Column, fingerprint: Column, published: Column, web_claim: Column, web_sources: Column, least: int = 4) -> Column:
    """All levels of the cascade, each upgrading what the ones before left open: link, class word, fingerprint (of NONE or POSSIBLE), publications (of anything below LIKELY), and the
    web, where a claim with a source makes LIKELY and one without makes POSSIBLE of NONE."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    level = F.when(yes(class_hit), "LIKELY").otherwise(link)
    level = F.when((F.coalesce(fingerprint, F.lit(0)) >= least) & level.isin("NONE", "POSSIBLE"), "FINGERPRINT").otherwise(level)
    level = F.when(yes(published) & (level != "LIKELY"), "LIKELY").otherwise(level)
    cited = F.coalesce(web_sources, F.lit(0)) > 0
    return F.when(yes(web_claim) & (level != "LIKELY") & cited, "LIKELY").when(yes(web_claim) & (level == "NONE"), "POSSIBLE").otherwise(level)


def publications(refs: DataFrame, trial: str, position: str, ident: str, papers: DataFrame, paper: str, title: str, abstract: str, most: int = 5) -> DataFrame:
    """(trial, text): titles and abstracts of a trial's first publications, in order. References without a paper count among the first, and give no text."""
    first = refs.filter(F.col(ident).isNotNull()).withColumn("_n", F.row_number().over(W.partitionBy(trial).orderBy(position, ident))).filter(F.col("_n") <= most)
    text = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit("")))
    both = first.join(papers.select(F.col(paper).alias(ident), text.alias("_text")), ident)
    texts = F.array_sort(F.collect_list(F.struct("_n", "_text")))
    return both.groupBy(trial).agg(F.array_join(F.transform(texts, lambda x: x["_text"]), " ").alias("text"))


def novelty(*flags: Column) -> Column:
    n = sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0))
    return F.when(n == 0, "NOVEL").when(n == 1, "EMERGING").otherwise("KNOWN")


def snapshot_delta(old: DataFrame, new: DataFrame, key: str, verdict: str) -> DataFrame:
    """NEW, GONE, CHANGED or SAME per key."""
    o, n = old.select(key, F.col(verdict).alias("before")), new.select(key, F.col(verdict).alias("after"))
    j = o.join(n, key, "full_outer")
    status = F.when(F.col("before").isNull(), "NEW").when(F.col("after").isNull(), "GONE").when(F.col("before") != F.col("after"), "CHANGED").otherwise("SAME")
    return j.withColumn("status", status)


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return df.join(seen.select(key).distinct(), key, "left_anti")


def digest(df: DataFrame, limit: int, *order: Column) -> DataFrame:
    """The first ``limit`` rows with the number left over."""
    return df.orderBy(*order).limit(limit).withColumn("overflow", F.lit(max(0, df.count() - limit)).cast("long"))


def upsert(base: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """Base rows stay; rows of ``more`` with new keys are added."""
    return base.unionByName(unseen(more, base, key).select(*base.columns))


def top_up(feed: DataFrame, census: DataFrame, hits: DataFrame, key: str, name: Column, *, full: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both tables with the hits' new keys added (``name``: the normalised key of a row of any of the three); with ``full``, the hits replace the feed."""
    keyed = hits.withColumn("_k", name).withColumn("_n", F.row_number().over(W.partitionBy("_k").orderBy(key))).filter("_n = 1").drop("_n")

    def add(base: DataFrame) -> DataFrame:
        new = keyed.join(base.select(name.alias("_k")).distinct(), "_k", "left_anti")
        return base.unionByName(new.select(*base.columns))

    return keyed.select(*feed.columns) if full else add(feed), add(census)


def live(df: DataFrame, url: str, alive: Column) -> DataFrame:
    """Links that do not answer become empty; ``alive`` is whatever checks them."""
    return df.withColumn(url, F.when(F.coalesce(alive, F.lit(False)), F.col(url)).otherwise(F.lit("")))


def judged(candidates: DataFrame, key: str, facts: DataFrame, verdicts: DataFrame, intel: DataFrame) -> DataFrame:
    """Wide evidence of each candidate: checked facts override verdicts, and intelligence comes along where there is any. One row per key on each right side."""
    out = candidates.join(verdicts, key, "left").join(facts.withColumnRenamed("verdict", "_fact"), key, "left").join(intel, key, "left")
    return out.withColumn("verdict", F.coalesce("_fact", "verdict")).drop("_fact")


def small_molecule(df: DataFrame, drugs: str, title: str, not_small: str, probe: str) -> DataFrame:
    """Records with a drug that may be a small molecule and that are no probe study."""
    text = F.concat(F.coalesce(F.col(drugs), F.array().cast("array<string>")), F.array(F.coalesce(title, F.lit(""))))
    return df.filter(~all_of(F.col(drugs), not_small) & ~any_of(text, probe))


def widened(base: DataFrame, key: str, *sides: tuple[DataFrame, dict[str, object]]) -> DataFrame:
    """Wide evidence: each side (one row per key) joined to the left by the key, its columns with their defaults where there is no row."""
    for side, defaults in sides:
        base = base.join(side, key, "left").fillna({c: v for c, v in defaults.items() if v is not None})
    return base


def by_alias(df: DataFrame, packed: str, position: Column, *values: str) -> DataFrame:
    """(key, values): rows exploded by their packed keys; of several rows with one key the last by position counts."""
    rows = df.select(F.explode(split_packed(F.col(packed))).alias("key"), F.struct(position.alias("_at"), *(F.col(v) for v in values)).alias("r"))
    return rows.groupBy("key").agg(F.max("r").alias("r")).select("key", *(F.col(f"r.{v}") for v in values))


def in_report_order(df: DataFrame, cross_linked: str, earliest_kind: str, earliest: str, *tie: str) -> DataFrame:
    """Chained stable sorts as one: cross-linked first, then those that a trial began, then the latest beginning; ties by key."""
    return df.orderBy(F.col(cross_linked).desc(), (F.col(earliest_kind) == "clinical").desc(), F.col(earliest).desc_nulls_last(), *tie)
