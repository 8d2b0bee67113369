"""Greedy matching without replacement, in parallel and equal to the sequential one.

One after the other, in the order of their keys, cases take the k nearest controls that are left. That is the one stable matching in which cases rank controls by distance and all
controls rank cases by their order, and it may be found by proposals in any sequence: a case asks the nearest control that no earlier case holds, and a control leaves a later case for an
earlier one. So the line of controls, sorted by level, is cut into blocks, each of which plays its own cases to the end as far as it can be sure; what it is not sure of (a nearer control may
lie beyond its edge) waits for the next round, whose blocks are cut half a block further. If neither cut brings anything new, blocks double.

A block is bounded by ``size`` controls and their cases; it grows beyond only where more cases than that compete for one stretch of the line."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.operators.backtest import ranked_sum
from evidentia.operators.claims import ranked
from evidentia.sources.shared import written

SIZE = 4096


def played(controls: pd.DataFrame, cases: pd.DataFrame, k: int, n: int) -> np.ndarray:
    """Who holds each control of a block (place, level, holder: -1 for nobody) once its cases (ord, level, below, have) have asked all that they can be sure of."""
    controls, cases = controls.sort_values("place"), cases.sort_values("ord")
    level, holder, begin = controls["level"].to_numpy(), controls["holder"].to_numpy().copy(), int(controls["place"].iloc[0])
    size = len(level)
    first, last = begin == 0, begin + size == n
    own = {int(o): [float(v), int(b) - begin - 1, int(b) - begin, int(h)] for o, v, b, h in zip(cases["ord"], cases["level"], cases["below"], cases["have"], strict=True)}
    waiting = sorted((o for o in own if own[o][3] < k), reverse=True)
    while waiting:
        me = waiting[-1]
        v, left, right, have = own[me]
        if have >= k:
            waiting.pop()
            continue
        while left >= 0 and 0 <= holder[left] <= me:
            left -= 1
        while right < size and 0 <= holder[right] <= me:
            right += 1
        own[me][1], own[me][2] = left, right
        to_left = v - level[left] if left >= 0 else None
        to_right = level[right] - v if right < size else None
        if to_left is not None and (to_left <= to_right if to_right is not None else last or to_left <= level[-1] - v):
            at = left
        elif to_right is not None and (to_left is not None or first or to_right < v - level[0]):
            at = right
        else:
            waiting.pop()  # not sure, or nothing is left: beyond this block
            continue
        loser, holder[at] = int(holder[at]), me
        own[me][3] += 1
        if loser in own:
            own[loser][3] -= 1
            waiting.append(loser)
            waiting.sort(reverse=True)
    return holder


def greedy_matched(cases: DataFrame, controls: DataFrame, key: str, level: str, k: int, size: int = SIZE) -> DataFrame:
    """(case, control, distance): the k nearest controls of each case, none twice; earlier cases first, ties to the lower level. Rows without a level take no part; a pool that is too short serves the
    earlier cases."""
    number = F.col(level).cast("double").alias("level")
    line = ranked(controls.select(F.col(key).alias("control"), number).filter("level is not null"), F.col("level"), F.col("control"), name="place")
    held = written(line.select("control", "level", (F.col("place") - 1).alias("place"), F.lit(-1).cast("long").alias("holder")), "held")
    n = held.count()
    own = ranked(cases.select(F.col(key).alias("case"), number).filter("level is not null"), F.col("case"), name="ord")
    counts = own.select("level", F.lit(0).alias("c")).unionByName(held.select("level", F.lit(1).alias("c"))).groupBy("level").agg(F.sum("c").alias("_c"))
    below = ranked_sum(counts, "level").select("level", F.col("_before").alias("below"))
    own = written(own.join(below, "level").select("case", "ord", "level", "below"), "cases")
    shifted, still = 0, 0
    while n:
        have = held.filter("holder >= 0").groupBy(F.col("holder").alias("ord")).agg(F.count("*").alias("have"))
        asked = own.join(have, "ord", "left").fillna({"have": 0})
        open_, first = asked.filter(F.col("have") < k).agg(F.count("*"), F.min("ord")).first()
        free, most = held.agg(F.count_if(F.col("holder") < 0), F.max("holder")).first()
        if not open_ or not free and most < first:
            break
        home = F.least(F.col("below"), F.lit(n - 1))
        block = lambda place: F.floor((place + shifted) / size)  # noqa: B023, E731
        left = held.withColumn("block", block(F.col("place"))).groupBy("block")
        right = asked.select("ord", "level", "below", "have", block(home).alias("block")).groupBy("block")

        def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            a = a.sort_values("place")
            return a.assign(before=a["holder"], holder=played(a, b, k, n) if len(a) and len(b) else a["holder"])[["control", "level", "place", "holder", "before"]]

        kind = held.schema["control"].dataType.simpleString()
        after = written(left.cogroup(right).applyInPandas(run, f"control {kind}, level double, place long, holder long, before long"), "held")
        moved = after.filter("holder <> before").limit(1).count()
        held = after.drop("before")
        still = 0 if moved else still + 1
        if still >= 2:
            if size >= n:
                break
            size, still, shifted = 2 * size, 0, 0
        else:
            shifted = 0 if shifted else size // 2
    pairs = held.filter("holder >= 0").join(own.select("case", F.col("ord").alias("holder"), F.col("level").alias("_level")), "holder")
    return pairs.select("case", "control", F.abs(F.col("_level") - F.col("level")).alias("distance"))
