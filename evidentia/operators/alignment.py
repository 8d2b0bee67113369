"""Global alignment with affine gaps (BLOSUM62, open -11, extend -1), many pairs at once in a band that is proven wide enough, and residue checks by position."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: The public BLOSUM62 matrix, rows and columns in this order.
ORDER = "ARNDCQEGHILKMFPSTWYV"
BLOSUM62 = """
4 -1 -2 -2 0 -1 -1 0 -2 -1 -1 -1 -1 -2 -1 1 0 -3 -2 0
-1 5 0 -2 -3 1 0 -2 0 -3 -2 2 -1 -3 -2 -1 -1 -3 -2 -3
-2 0 6 1 -3 0 0 0 1 -3 -3 0 -2 -3 -2 1 0 -4 -2 -3
-2 -2 1 6 -3 0 2 -1 -1 -3 -4 -1 -3 -3 -1 0 -1 -4 -3 -3
0 -3 -3 -3 9 -3 -4 -3 -3 -1 -1 -3 -1 -2 -3 -1 -1 -2 -2 -1
-1 1 0 0 -3 5 2 -2 0 -3 -2 1 0 -3 -1 0 -1 -2 -1 -2
-1 0 0 2 -4 2 5 -2 0 -3 -3 1 -2 -3 -1 0 -1 -3 -2 -2
0 -2 0 -1 -3 -2 -2 6 -2 -4 -4 -2 -3 -3 -2 0 -2 -2 -3 -3
-2 0 1 -1 -3 0 0 -2 8 -3 -3 -1 -2 -1 -2 -1 -2 -2 2 -3
-1 -3 -3 -3 -1 -3 -3 -4 -3 4 2 -3 1 0 -3 -2 -1 -3 -1 3
-1 -2 -3 -4 -1 -2 -3 -4 -3 2 4 -2 2 0 -3 -2 -1 -2 -1 1
-1 2 0 -1 -3 1 1 -2 -1 -3 -2 5 -1 -3 -1 0 -1 -3 -2 -2
-1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1 5 0 -2 -1 -1 -1 -1 1
-2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0 6 -4 -2 -2 1 3 -1
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4 7 -1 -1 -4 -3 -2
1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1 4 1 -3 -2 -2
0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1 5 -2 -2 0
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2 11 2 -3
-2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2 7 -1
0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1 4
"""


_TABLE = np.full((256, 256), -1, np.int32)
np.fill_diagonal(_TABLE, 4)
for _i, _row in enumerate(BLOSUM62.strip().splitlines()):
    for _j, _v in enumerate(_row.split()):
        _TABLE[ord(ORDER[_i]), ord(ORDER[_j])] = int(_v)


def align(a: str, b: str, opening: int = -11, extend: int = -1) -> list[int]:
    """For each place of ``a`` the aligned place of ``b``, or -1 at a gap (Gotoh). Cells of an anti-diagonal depend on earlier ones only, so each is one step.

    Three scores for each cell: ending in a match (0), in a gap of ``b`` (1, a place of ``a`` alone) and in a gap of ``a`` (2)."""
    x, y = (np.frombuffer(s.encode("latin-1", "replace"), np.uint8) for s in (a, b))
    n, m, low = len(x), len(y), -(10**9)
    v = np.full((3, n + 1, m + 1), low, np.int64)
    v[0, 0, 0] = 0
    v[1, 1:, 0] = opening + extend * np.arange(n)
    v[2, 0, 1:] = opening + extend * np.arange(m)
    for d in range(2, n + m + 1):
        i = np.arange(max(1, d - m), min(n, d - 1) + 1)
        j = d - i
        v[0, i, j] = v[:, i - 1, j - 1].max(0) + _TABLE[x[i - 1], y[j - 1]]
        v[1, i, j] = np.maximum(np.maximum(v[0, i - 1, j], v[2, i - 1, j]) + opening, v[1, i - 1, j] + extend)
        v[2, i, j] = np.maximum(np.maximum(v[0, i, j - 1], v[1, i, j - 1]) + opening, v[2, i, j - 1] + extend)
    out, i, j = [-1] * n, n, m
    state = int(v[:, n, m].argmax())
    while i > 0 or j > 0:
        here = v[state, i, j]
        i, j, gap = (i - 1, j - 1, None) if state == 0 else (i - 1, j, 1) if state == 1 else (i, j - 1, 2)
        if gap is None:
            out[i] = j
            state = int(v[:, i, j].argmax())
        elif v[gap, i, j] + extend != here:
            others = [k for k in (0, 1, 2) if k != gap]
            state = max(others, key=lambda k: v[k, i, j])
    return out


#: Diagonals on each side at first, pairs that are aligned at once, and numbers that their table may have.
BAND, PAIRS, CELLS = 16, 128, 24_000_000
LOW = -(10**8)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [np.frombuffer(s.encode("latin-1", "replace"), np.uint8) for s in texts]
    size = np.array([len(x) for x in raw])
    out = np.zeros((len(raw), max(1, size.max(initial=0))), np.uint8)
    for i, x in enumerate(raw):
        out[i, : len(x)] = x
    return out, size


def _banded(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, band: int, opening: int, extend: int) -> tuple[np.ndarray, int]:
    """Scores of all pairs within a band: by kind (as in ``align``), pair, i + j, and j - i from the band's first diagonal, which comes too. In this order each step is one of whole arrays: the
    cells before are the same diagonal two steps back, and its neighbours one step back."""
    gap = m - n
    low, high = min(0, int(gap.min())) - band, max(0, int(gap.max())) + band
    width, steps = high - low + 1, int((n + m).max()) + 1
    v = np.full((3, len(x), steps, width + 2), LOW, np.int32)  # a column on each side that nothing reaches
    d = np.arange(low, high + 1)
    v[0, :, 0, 1 - low] = 0
    rows = np.arange(len(x))[:, None]
    for s in range(1, steps):
        i, j = (s - d) >> 1, (s + d) >> 1
        ok = ((s - d) & 1 == 0) & (i >= 0) & (j >= 0) & (i <= n[:, None]) & (j <= m[:, None])
        left, right = v[:, :, s - 1, 2:], v[:, :, s - 1, :-2]  # from (i - 1, j), from (i, j - 1)
        one = np.maximum(np.maximum(left[0], left[2]) + opening, left[1] + extend)
        two = np.maximum(np.maximum(right[0], right[1]) + opening, right[2] + extend)
        v[1, :, s, 1:-1] = np.where(ok & (i > 0), one, LOW)
        v[2, :, s, 1:-1] = np.where(ok & (j > 0), two, LOW)
        if s > 1:
            inside = ok & (i > 0) & (j > 0)
            match = _TABLE[x[rows, np.clip(i - 1, 0, x.shape[1] - 1)], y[rows, np.clip(j - 1, 0, y.shape[1] - 1)]]
            v[0, :, s, 1:-1] = np.where(inside, v[:, :, s - 2, 1:-1].max(0) + match, LOW)
    return v, low


def _followed(v: np.ndarray, low: int, n: np.ndarray, m: np.ndarray, extend: int) -> np.ndarray:
    """The aligned place of each place of the first sequences, -1 at a gap: all pairs are walked back together."""
    b = np.arange(len(n))
    out = np.full((len(n), max(1, int(n.max(initial=0)))), -1)
    i, j = n.copy(), m.copy()
    at = lambda kind, i, j: v[kind, b, i + j, j - i - low + 1]
    state = np.stack([at(k, i, j) for k in range(3)]).argmax(0)
    while (live := (i > 0) | (j > 0)).any():
        here = at(state, i, j)
        i2, j2 = i - (live & (state != 2)), j - (live & (state != 1))
        every = np.stack([at(k, i2, j2) for k in range(3)])
        matched = live & (state == 0)
        out[b[matched], i2[matched]] = j2[matched]
        other = every.copy()
        other[state, b] = LOW - 1
        stays = every[state, b] + extend == here
        state = np.where(live, np.where(state == 0, every.argmax(0), np.where(stays, state, other.argmax(0))), state)
        i, j = i2, j2
    return out


def align_many(a: list[str], b: list[str], opening: int = -11, extend: int = -1, band: int = BAND) -> list[np.ndarray]:
    """``align`` of many pairs at once. Only a band of diagonals is filled; it is wide enough once the score beats all that a path beyond it could have (every residue at its best, less the gaps that
    such a path needs), and doubles for the pairs for which it is not."""
    out: list[np.ndarray | None] = [None] * len(a)
    best = _TABLE[:128, :128].max(1).clip(0)
    best = np.append(best, np.full(128, 4))
    todo = sorted(range(len(a)), key=lambda p: (len(a[p]) + len(b[p]), p))
    while todo:
        wider, lo = [], 0
        while lo < len(todo):
            hi = lo + 1
            while hi < len(todo) and hi - lo < PAIRS and 3 * (hi - lo + 1) * (len(a[todo[hi]]) + len(b[todo[hi]]) + 1) * (2 * band + 3 + abs(len(a[todo[hi]]) - len(b[todo[hi]]))) < CELLS:
                hi += 1
            some = todo[lo:hi]
            (x, n), (y, m) = _codes([a[p] for p in some]), _codes([b[p] for p in some])
            v, low = _banded(x, y, n, m, band, opening, extend)
            at = np.arange(len(some))
            score = v[:, at, n + m, m - n - low + 1].max(0)
            most = np.minimum([best[x[i, : n[i]]].sum() for i in at], [best[y[i, : m[i]]].sum() for i in at])
            beyond = most + 2 * opening + extend * (2 * (band + 1) + np.abs(m - n) - 2)
            sure = (score > beyond) | (band >= np.maximum(n, m))
            places = _followed(v, low, n, m, extend)
            for i, p in enumerate(some):
                if sure[i]:
                    out[p] = places[i, : n[i]]
                else:
                    wider.append(p)
            lo = hi
        todo, band = wider, 2 * band
    return out


@F.pandas_udf(StringType())
def aligned_residue(a: pd.Series, at: pd.Series, b: pd.Series) -> pd.Series:
    """The residue of ``b`` aligned with place ``at`` (from 1) of ``a``; '-' at a gap. The pairs of a batch are aligned together, each different one once."""
    rows = list(zip(a, at, b, strict=True))
    pairs = list(dict.fromkeys((x, y) for x, p, y in rows if x and y and 1 <= p <= len(x)))
    place = dict(zip(pairs, align_many([x for x, _ in pairs], [y for _, y in pairs]), strict=True))
    found = (place[x, y][int(p) - 1] if (x, y) in place and 1 <= p <= len(x) else -1 for x, p, y in rows)
    return pd.Series([y[j] if j >= 0 else "-" for (_, _, y), j in zip(rows, found, strict=True)], dtype=object)


def residue_is(seq: Column, at: Column, residue: str = "C") -> Column:
    return F.substring(seq, at, F.lit(1)) == residue


#: Outcomes of the vote, the most selective first.
VOTES = ["unique-handle", "partial", "conserved-liability"]


def selectivity(df: DataFrame, target: str, position: str, residue: str, wanted: str = "C") -> DataFrame:
    """Per target and position, from the paralogs' residues (null: could not be aligned): none has the wanted one (unique-handle), all have it
    (conserved-liability), or some (partial); and the target's most selective verdict. Without paralogs, nothing speaks against a position."""
    has = F.count_if(F.coalesce(F.col(residue) == wanted, F.lit(False)))
    per = df.groupBy(target, position).agg(F.when(has == 0, VOTES[0]).when(has == F.count("*"), VOTES[2]).otherwise(VOTES[1]).alias("verdict"))
    rank = F.array_position(F.array(*map(F.lit, VOTES)), F.col("verdict"))
    best = per.groupBy(target).agg(F.min_by("verdict", rank).alias("selectivity"))
    return per.join(best, target)
