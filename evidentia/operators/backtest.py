"""Back-tests: window sums, lifts, rank statistics, matched controls, permutation tests."""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from evidentia.functions.text import normal_tail
from evidentia.operators.claims import before_parts, ranked, sorted_once
from evidentia.sources.shared import written


def year_sums(df: DataFrame, key: str, year: Column, n: Column, **windows: tuple[int, int]) -> DataFrame:
    return df.groupBy(key).agg(*(F.coalesce(F.sum(F.when(year.between(a, b), n)), F.lit(0)).cast("long").alias(name) for name, (a, b) in windows.items()))


def tertile_lift(df: DataFrame, outcome: str, *order: Column) -> DataFrame:
    """Outcome rates of the first and last third by the order, k = max(1, n // 3), and their lift."""
    r = ranked(df, *order, name="_r")
    n = r.count()
    k = max(1, n // 3)
    out = r.agg(F.avg(F.when(F.col("_r") <= k, F.col(outcome).cast("double"))).alias("top"), F.avg(F.when(F.col("_r") > n - k, F.col(outcome).cast("double"))).alias("bottom"))
    return out.withColumn("lift", F.col("top") / (F.col("bottom") + 1e-9))


def precision_at(df: DataFrame, outcome: str, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k).agg(F.avg(F.col(outcome).cast("double")).alias("precision"))


def spearman(df: DataFrame, x: str, y: str, tie: str) -> DataFrame:
    """Correlation of ordinal ranks (ties by ``tie``); 0 without variance."""
    r = ranked(ranked(df, F.col(x), F.col(tie), name="_x"), F.col(y), F.col(tie), name="_y")
    return r.agg(F.coalesce(F.nanvl(F.corr(F.col("_x").cast("double"), F.col("_y").cast("double")), F.lit(0.0)), F.lit(0.0)).alias("rho"))


def auc(df: DataFrame, value: str, positive: str) -> DataFrame:
    """AUC with ties at 0.5 by rank sums over different values (pre-aggregated), and the one-sided normal p without tie correction."""
    v = df.groupBy(value).agg(F.count("*").alias("_c"), F.sum(F.col(positive).cast("long")).alias("_p"))
    r = ranked_sum(v, value)
    s = r.agg(F.sum("_p").cast("double").alias("np"), F.sum(F.col("_c") - F.col("_p")).cast("double").alias("nn"), F.sum(F.col("_p") * (F.col("_before") + (F.col("_c") + 1) / F.lit(2.0))).alias("rs"))
    u = F.col("rs") - F.col("np") * (F.col("np") + 1) / 2
    out = s.select((u / (F.col("np") * F.col("nn"))).alias("auc"), ((u - F.col("np") * F.col("nn") / 2) / F.sqrt(F.col("np") * F.col("nn") * (F.col("np") + F.col("nn") + 1) / 12)).alias("z"))
    return out.withColumn("p", normal_tail(F.col("z")))


def ranked_sum(v: DataFrame, value: str, amount: str = "_c") -> DataFrame:
    """``_before``: the sum of ``amount`` over all smaller values (one row for each value): running sums within range partitions plus the partitions before."""
    parts = sorted_once(v, F.col(value))
    own = F.coalesce(F.sum(amount).over(W.partitionBy("_part").orderBy("_place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = before_parts(parts, F.sum(amount))
    return parts.withColumn("_own", own).join(F.broadcast(offsets), "_part").withColumn("_before", F.col("_own") + F.col("_offset")).drop("_part", "_place", "_own", "_offset")


def matched(cases: DataFrame, controls: DataFrame, key: str, level: str, k: int, width: float | None = None) -> DataFrame:
    """The k controls nearest in level for each case, with replacement; ties go to the smaller key. ``width`` is a calliper, if one is wanted.

    Exact however far the nearest are: the k nearest are among the k controls next above a case's level and the k next below, so
    controls are ranked both ways, a case's place among them is counted, and the places around it are joined by equality."""
    left = cases.select(F.col(key).alias("case"), F.col(level).alias("case_level")).filter("case_level is not null")
    right = written(controls.select(F.col(key).alias("control"), F.col(level).alias("control_level")).filter("control_level is not null"), "controls")
    n = right.count()
    counts = left.select(F.col("case_level").alias("v"), F.lit(0).alias("c")).unionByName(right.select(F.col("control_level").alias("v"), F.lit(1).alias("c")))
    below = ranked_sum(counts.groupBy("v").agg(F.sum("c").alias("_c")), "v").select(F.col("v").alias("case_level"), F.col("_before").alias("below"))
    placed = left.join(below, "case_level")
    up = ranked(right, F.col("control_level"), F.col("control"), name="place")
    down = ranked(right, F.col("control_level").desc(), F.col("control"), name="place")
    steps = F.sequence(F.lit(1), F.lit(k))
    above = placed.withColumn("place", F.explode(F.transform(steps, lambda i: F.col("below") + i))).join(up, "place")
    under = placed.withColumn("place", F.explode(F.transform(steps, lambda i: F.lit(n) - F.col("below") + i))).join(down, "place")
    under = under.filter("control_level < case_level")
    near = above.unionByName(under).withColumn("distance", F.abs(F.col("case_level") - F.col("control_level"))).drop("place", "below")
    if width is not None:
        near = near.filter(F.col("distance") <= width)
    w = W.partitionBy("case").orderBy("distance", "control")
    return near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


#: A prime below 2^32, and multipliers whose products with what they meet stay below 2^63.
PRIME, SPREAD, STIR = 4294967291, 2654435761, 1540483477
#: Rounds of the keyed bijection, the least bits of a half (networks of fewer make some orders only), and permutations that a task works on at once.
FEISTEL, LEAST_HALF, AT_ONCE = 4, 4, 16


def keyed_places(places: np.ndarray, permutation: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Where keyed bijections of 0 to n - 1 put some places (last axis; one bijection for each row of ``permutation``): a Feistel network over the two halves of a place's bits, walked on until it
    falls below n."""
    half = max(LEAST_HALF, (max(1, n - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    x = np.broadcast_to(places, np.broadcast_shapes(places.shape, permutation.shape)).astype(np.int64)
    key = np.broadcast_to(permutation, x.shape)
    todo = np.ones(x.shape, bool)
    while todo.any():
        left, right, k = x[todo] >> half, x[todo] & mask, key[todo]
        for r in range(FEISTEL):
            f = (right * SPREAD + k * FEISTEL + r + seed) % PRIME
            f = (f ^ f >> 16) * STIR % PRIME
            f = (f ^ f >> 13) * STIR % PRIME >> 9
            left, right = right, left ^ f & mask
        x[todo] = left << half | right
        todo[todo] = x[todo] >= n
    return x


#: Rows of a segment, and different outcomes that may have ties.
SEGMENT, MOST_OUTCOMES = 1 << 16, 100_000


def permutation_p(df: DataFrame, signal: str, outcome: str, tie: str, k: int = 2000, seed: int = 11) -> DataFrame:
    """(ge + 1) / (k + 1): permutations of the outcomes whose Spearman value (ordinal ranks, ties by ``tie``) reaches that of the data. The ranks are permutations of the same numbers, so
    the sums of their products are compared, exactly.

    A permutation is a keyed bijection of the rows' places by ``tie``: each row finds for itself whose outcome it gets. Its rank among equal outcomes is the number of such rows before it; a segment of
    SEGMENT rows counts within itself, and what segments before it hold is added to its sums afterwards. So no task holds more than a segment, and what is shuffled are, for each segment and
    permutation, three numbers for each different outcome: at most MOST_OUTCOMES of them, unless all differ (then nothing is tied, and one number does)."""
    both = df.select(F.col(signal).alias("_s"), F.col(outcome).cast("double").alias("_o"), F.col(tie).alias("_t"))
    for name, order in (("_x", [F.col("_s"), F.col("_t")]), ("_y", [F.col("_o"), F.col("_t")]), ("_i", [F.col("_t")])):
        both = ranked(both, *order, name=name)
    rows = written(both.select((F.col("_x") - 1).alias("x"), (F.col("_y") - 1).alias("y"), (F.col("_i") - 1).alias("i"), F.col("_o").alias("o")), "ranks")
    spark, n = rows.sparkSession, rows.count()
    if not n:
        return spark.createDataFrame([(1.0,)], "p double")
    kinds = rows.groupBy("o").agg(F.min("y").alias("y"))
    starts = np.array([0])
    tied = kinds.count() < n
    if tied:
        starts = np.array(sorted(r.y for r in kinds.limit(MOST_OUTCOMES + 1).select("y").collect()))
        if len(starts) > MOST_OUTCOMES:
            raise ValueError(f"more than {MOST_OUTCOMES} different outcomes with ties among them")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        at, seg = table.column("i").to_numpy(), int(table.column("seg")[0].as_py())
        x = table.column("x").to_numpy() - n // 2
        out = []
        for p in range(0, k, AT_ONCE):
            got = keyed_places(at, np.arange(p, min(k, p + AT_ONCE))[:, None], n, seed)
            for j, place in enumerate(got):
                if not tied:  # a row's rank is the place
                    out.append((p + j, 0, int((place & 0xFFFF) @ x) + (int((place >> 16) @ x) << 16), 0, 0))
                    continue
                kind = np.searchsorted(starts, place, "right") - 1
                order = np.argsort(kind, kind="stable")
                many = np.bincount(kind, minlength=len(starts))
                before = np.empty(len(kind), np.int64)
                before[order] = np.arange(len(kind)) - (np.cumsum(many) - many)[kind[order]]
                within, own = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
                np.add.at(within, kind, before * x)
                np.add.at(own, kind, x)
                out += [(p + j, c, int(within[c]), int(own[c]), int(many[c])) for c in np.flatnonzero(many).tolist()]
        columns = list(zip(*out, strict=True)) or [()] * 5
        number = pa.decimal128(38, 0)
        return pa.table([pa.array([seg] * len(out), pa.int64()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *(pa.array([decimal.Decimal(v) for v in c], number) for c in columns[2:4]), pa.array(columns[4], pa.int64())], names=["seg", "p", "kind", "within", "own", "many"])

    parts = rows.withColumn("seg", F.floor(F.col("i") / SEGMENT)).groupBy("seg").applyInArrow(run, "seg long, p long, kind long, within decimal(38,0), own decimal(38,0), many long")
    earlier = F.coalesce(F.sum("many").over(W.partitionBy("p", "kind").orderBy("seg").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    begin = spark.createDataFrame([(i, int(y)) for i, y in enumerate(starts)], "kind long, start long")
    summed = parts.withColumn("before", earlier).join(begin, "kind").groupBy("p").agg(F.sum(F.col("within") + (F.col("start") + F.col("before")).cast("decimal(19,0)") * F.col("own").cast("decimal(18,0)")).alias("s"))
    of_data = rows.agg(F.sum((F.col("x") - n // 2).cast("decimal(18,0)") * F.col("y").cast("decimal(18,0)"))).first()[0]  # one number
    return summed.agg(((F.count_if(F.col("s") >= F.lit(of_data)) + 1) / F.lit(float(k + 1))).alias("p"))


def rank_sum(df: DataFrame, signals: list[str], positive: str, tie: str) -> DataFrame:
    """AUC (and p) of the sum of ordinal ranks over rows that have all signals; ties within a signal by ``tie``."""
    both = df.filter(" and ".join(f"`{s}` is not null" for s in signals))
    for i, s in enumerate(signals):
        both = ranked(both, F.col(s), F.col(tie), name=f"_rank{i}")
    return auc(both.withColumn("_sum", sum((F.col(f"_rank{i}") for i in range(len(signals))), F.lit(0))), "_sum", positive)


def strided(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Every so many rows in the order, at least ``n`` of them if there are as many: rows 0, s, 2s, ... with s = max(1, rows // n)."""
    r = ranked(df, *order, name="_r")
    stride = max(1, r.count() // n)
    return r.filter((F.col("_r") - 1) % stride == 0).drop("_r")


def seeded_sample(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def until(df: DataFrame, keep: Column, kept: int, screened: int, *order: Column) -> DataFrame:
    """Early-exit screening: rows in order until ``kept`` pass or ``screened`` were looked at; the passing ones. The screened prefix is bounded."""
    first = df.orderBy(*order).limit(screened)
    w = W.orderBy(*order)
    return first.withColumn("_k", F.sum(F.when(keep, 1).otherwise(0)).over(w)).filter(keep & (F.col("_k") <= kept)).drop("_k")
