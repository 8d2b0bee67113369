"""Crowding: windows, lanes and landscapes from numbers of players, with named presets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from evidentia.functions.text import academic, positions_of


def tier(n: Column, steps: list[tuple[int, str]], above: str, saturated: Column | None = None) -> Column:
    """The first step with n <= limit; ``saturated`` keys are ``above`` outright."""
    out = F.when(saturated, F.lit(above)) if saturated is not None else None
    for limit, name in steps:
        out = F.when(n <= limit, F.lit(name)) if out is None else out.when(n <= limit, F.lit(name))
    return out.otherwise(F.lit(above))


#: The presets of window, lane and landscape.
WINDOW = dict(steps=[(2, "OPEN"), (4, "CONTESTED")], above="CLOSED")
LANE = dict(steps=[(1, "OPEN"), (3, "EMERGING"), (10, "CONTESTED")], above="CROWDED")
LANDSCAPE = dict(steps=[(1, "OPEN"), (4, "CONTESTED")], above="CROWDED")
BRACKETS = (2012, 2015, 2018, 2020, 2022, 2024)


def bracket(year: Column, brackets: tuple[int, ...] = BRACKETS) -> Column:
    """The least bracket that is not below the year."""
    out = None
    for b in brackets:
        out = F.when(year <= b, F.lit(b)) if out is None else out.when(year <= b, F.lit(b))
    return out


def window(df: DataFrame, target: str, player: str, date: str, now: int, since: Column | None = None, brackets: tuple[int, ...] = BRACKETS, top: int = 8) -> DataFrame:
    """Per target with a record from ``since`` on: players, records, latest date and first players by name of those records; first year of all of them, its
    bracket and years since; tier."""
    y = F.year(date)
    now_on = F.coalesce(F.col(date) >= since, F.lit(False)) if since is not None else F.lit(True)
    who, day = F.when(now_on, F.col(player)), F.when(now_on, F.col(date).cast("date"))
    rows = df.filter(F.col(player).isNotNull())
    agg = rows.groupBy(target).agg(F.countDistinct(who).alias("players"), F.count_if(now_on).alias("records"), F.min(y).alias("first_year"), F.max(day).alias("latest"))
    # the first players by name, without an array of all of them: Spark cuts each task's share of a target to ``top`` before the shuffle
    each = rows.filter(now_on).select(target, F.col(player).cast("string").alias("_name")).distinct()
    some = each.withColumn("_n", F.row_number().over(W.partitionBy(target).orderBy("_name"))).filter(F.col("_n") <= top)
    names = some.groupBy(target).agg(F.array_join(F.array_sort(F.collect_list("_name")), ",").alias("names"))
    agg = agg.filter("records > 0").join(names, target, "left")
    return agg.withColumns({"bracket": bracket(F.col("first_year"), brackets), "years": F.lit(now) - F.col("first_year"), "window": tier(F.col("players"), **WINDOW)})


def landscape(df: DataFrame, target: str, player: str, phase: str, rank: dict[str, float]) -> DataFrame:
    """Per target: players and the furthest phase by rank, and the tier."""
    order = F.lit(0.0)
    for name, r in rank.items():
        order = F.when(F.col(phase) == name, F.lit(float(r))).otherwise(order)
    agg = df.groupBy(target).agg(F.countDistinct(player).alias("players"), F.max_by(F.col(phase), F.struct(order, F.col(phase))).alias("furthest"))
    return agg.withColumn("tier", tier(F.col("players"), **LANDSCAPE))


def competition(programs: DataFrame, filers: DataFrame, entries: DataFrame, target: str, sponsor: str, phase: str, rank: dict[str, float], drug: str, covalent: str) -> DataFrame:
    """Per target of any of the three: the registry's programs (industry sponsors, with the furthest phase and first drug of the leading one), entries found elsewhere, crowding by the larger number of
    the two, and the covalent lane, contested if someone filed or an entry is covalent. ``filers`` has a row for each filing."""
    order = F.lit(0.0)
    for name, r in rank.items():
        order = F.when(F.col(phase) == name, F.lit(float(r))).otherwise(order)
    industry = programs.filter(F.col(sponsor).isNotNull() & (F.trim(sponsor) != "") & ~academic(F.col(sponsor)))
    each = industry.groupBy(target, sponsor).agg(F.max(order).alias("_r"), F.max_by(F.col(phase), F.struct(order, F.col(phase))).alias("_p"), F.min(drug).alias("_d"))
    lead = F.min_by(F.struct(F.col("_p").alias("p"), F.col("_d").alias("d"), F.col(sponsor).alias("s")), F.struct(-F.col("_r"), F.col(sponsor)))
    clinical = each.groupBy(target).agg(F.count("*").alias("n_clinical"), lead.alias("_lead"))
    found = entries.groupBy(target).agg(F.count("*").alias("n_landscape"), F.bool_or(F.coalesce(F.col(covalent), F.lit(False))).alias("_covalent"))
    filed = filers.select(target).distinct().withColumn("_filed", F.lit(True))
    out = clinical.join(found, target, "full_outer").join(filed, target, "full_outer").fillna({"n_clinical": 0, "n_landscape": 0, "_covalent": False, "_filed": False})
    out = out.withColumn("crowding", tier(F.greatest("n_clinical", "n_landscape"), **LANDSCAPE)).withColumn("covalent_lane", F.when(F.col("_covalent") | F.col("_filed"), "contested").otherwise("open"))
    return out.select(target, "n_clinical", "n_landscape", F.col("_lead.s").alias("leader"), F.col("_lead.p").alias("phase"), F.col("_lead.d").alias("drug"), "crowding", "covalent_lane")


def opportunity_table(entities: DataFrame, ident: str, aliases: DataFrame, sites: DataFrame, flags: list[str], wanted: str, proven: str, closed: DataFrame, toxic: DataFrame, order: list[Column]) -> DataFrame:
    """Entities that are wanted, under their symbols (``aliases``: key, symbol; one row for each key), one row for each symbol: flags joined by OR, the largest number of sites (``sites``: a row for
    each), and the other columns of the first by ``order``. ``bucket``: what is proven and not closed is an opportunity, or a toxic one; the rest is other."""
    n = sites.groupBy(ident).agg(F.count("*").alias("n_sites"))
    named = entities.filter(F.coalesce(F.col(wanted), F.lit(False))).join(aliases.withColumnRenamed("key", ident), ident).join(n, ident, "left").fillna({"n_sites": 0})
    listed = lambda df, name: df.select("symbol").distinct().withColumn(name, F.lit(True))
    known = named.join(listed(closed, "closed"), "symbol", "left").join(listed(toxic, "toxic"), "symbol", "left").fillna({"closed": False, "toxic": False})
    one = flags_of(known, "symbol", [*flags, "closed", "toxic"], ["n_sites"], order)
    hit = F.coalesce(F.col(proven), F.lit(False)) & ~F.col("closed")
    return one.withColumn("bucket", F.when(hit & ~F.col("toxic"), "opportunity").when(hit, "toxic").otherwise("other"))


def fresh(df: DataFrame, target: str, player: str, date: str, title: str, names: list[str], *, since: Column, latest_since: Column, skip: str, most: int = 3) -> DataFrame:
    """Fresh filings: targets that a title since then names (one of ``names``, case-folded; titles with the pattern ``skip`` are left out), with at most ``most``
    players and a latest date of late; latest first, then fewest players."""
    up = F.upper(title)
    named = F.lit(False)
    for n in names:
        named = named | F.coalesce((F.length(n) > 0) & up.contains(F.upper(n)), F.lit(False))
    rows = df.filter((F.col(date) >= since) & ~F.coalesce(up.rlike("(?i)" + skip), F.lit(False)) & named & (F.col(player).cast("string") != ""))
    g = rows.groupBy(target).agg(F.countDistinct(player).alias("players"), F.max(date).alias("latest"), F.count("*").alias("filings"))
    return g.filter((F.col("players") <= most) & (F.col("latest") >= latest_since)).orderBy(F.col("latest").desc(), "players", target)


def buckets(df: DataFrame, *rules: tuple[str, Column], rest: str, name: str = "bucket") -> DataFrame:
    """Disjoint buckets of one relation: the first rule that holds names it, nothing is dropped."""
    out = None
    for label, rule in rules:
        hit = F.coalesce(rule, F.lit(False))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return df.withColumn(name, out.otherwise(F.lit(rest)) if out is not None else F.lit(rest))


def flags_of(df: DataFrame, key: str, flags: list[str], most: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: flags joined by OR, maxima, and the other columns of the first row in the order."""
    others = [c for c in df.columns if c not in (key, *flags, *most)]
    first = F.min(F.struct(F.struct(*order).alias("o"), F.struct(*(F.col(c) for c in others) or [F.lit(0).alias("_")]).alias("r"))).alias("_f")
    g = df.groupBy(key).agg(*(F.bool_or(f).alias(f) for f in flags), *(F.max(m).alias(m) for m in most), first)
    return g.select(key, *flags, *most, *(F.col(f"_f.r.{c}").alias(c) for c in others))


def prior_art(df: DataFrame, key: str, item: str, group: str, kind: str, value: Column) -> DataFrame:
    """Per key: items, groups, sorted kinds and the best value (of the rows where it is not null)."""
    return df.groupBy(key).agg(F.count(item).alias("n"), F.countDistinct(group).alias("groups"), F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("kinds"), F.max(value).alias("best"))


def opportunities(df: DataFrame, wanted: Column, hits: DataFrame, deny: DataFrame, hit_key: str, deny_key: str) -> DataFrame:
    """Rows that are wanted, have a hit and are not denied: semi and anti joins (a null in the deny list empties nothing)."""
    return df.filter(wanted).join(hits.select(hit_key), hit_key, "left_semi").join(deny.select(deny_key), deny_key, "left_anti")


def frequencies(df: DataFrame, key: str, value: str, flag: Column) -> DataFrame:
    """Per key: rows, median and maximum of the value, and the rate of the flag."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.median(value).alias("med"), F.avg(flag.cast("int")).alias("rate"), F.max(value).alias("top"))


def accelerating(sums: DataFrame, recent: str, base: str, years: tuple[int, int], least: int) -> DataFrame:
    """Momentum: recent per year against base per year, smoothed by one, for keys with enough recent ones."""
    return sums.filter(F.col(recent) >= least).withColumn("accel", (F.col(recent) / F.lit(float(years[0]))) / (F.col(base) / F.lit(float(years[1])) + 1))


def pockets(df: DataFrame, key: str, group: str, sequence: str, length: int, letter: str, regions: list[tuple[str, int, int]], order: list[str]) -> DataFrame:
    """One row per key: of its sequences of the right length with the letter in a region, the one whose best region comes first in ``order`` (ties by group), with
    all its handles (region@position)."""
    handles = positions_of(F.col(sequence), letter, regions)
    rows = df.filter(F.length(sequence) == length).withColumn("handles", handles).filter(F.size("handles") > 0)
    region = lambda h: F.substring_index(h, "@", 1)
    best = rows.withColumn("_best", F.array_min(F.transform("handles", lambda h: F.struct(F.array_position(F.array(*map(F.lit, order)), region(h)).alias("r"), region(h).alias("n")))))
    one = best.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy("_best.r", group))).filter("_n = 1")
    return one.select(key, group, "handles", F.col("_best.n").alias("best"))
