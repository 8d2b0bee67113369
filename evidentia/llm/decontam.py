"""Benchmark decontamination by template canonicalisation.

Texts become sequences of canonical words: outer punctuation goes, A-Z is lower-cased, numbers, units after a number and names
(capitalised words within a sentence) become typed placeholders. Windows of WINDOW canonical words are hash-joined
with those of the benchmark's items. Matches on one diagonal (a document position less an item position) form an occurrence, and so do those of
several diagonals in order, since words put in or left out move the diagonal, within three times the item's length; each occurrence is judged alone. Its
coverage is the share of the item's windows that matched, and its slots, the placeholders' values, must be consistent: an item's
value maps to one value in the occurrence wherever it recurs, but for a share of SLACK of the values (a number may have been mistaken or changed alone). So a question asked again with other numbers or names is found, once or several times in a document, and a
chance meeting of templates is not. Template windows without a plain word, and short ones (of items of fewer than WINDOW words) with fewer than LITERAL, say nothing and are left out on both sides.

Besides, windows of the words as they stand, lower-cased and without outer punctuation, are matched in the same way; they have no placeholders and no
bound on plain words, so copies word for word are found whatever the item is made of and however it is capitalised or spaced. What stays out of reach: other numbers in items
of numbers alone, and in short ones with fewer than LITERAL plain words.

Items shorter than WINDOW words are one shorter window, down to a single word, which is then found wherever it stands. Null and empty texts
match nothing. Repeated items or documents give their own rows, a pair's row is of its best occurrence: contaminated, then most windows, then fewest slots that disagree. The item table is sent to the tasks in
blocks of at most BLOCK_ITEMS items and BLOCK_BYTES of text, a pass over the documents for each: no join, no shuffle of texts, and
no task gets more because an item is popular.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.scratch import small_batches
from evidentia.llm.textnum import U, Words, mix, slices

WINDOW, LITERAL, COVERAGE, SLACK = 8, 3, 0.5, 0.25
BLOCK_ITEMS, BLOCK_BYTES = 50_000, 32 << 20
FOUND = ["matched", "windows", "coverage", "n_slots", "n_inconsistent", "contaminated"]
#: Units that follow numbers.
UNITS = "mm cm m km inch inches feet ft yards mile miles mg g kg t lb lbs pounds ounces oz ml l liter liters litre litres gallons s sec seconds min minutes h hour hours day days week weeks month months year years percent % usd eur dollars euros cents mph kmh kph watts w kw volts v amps hz khz mhz ghz".split()

_NUMERIC = np.zeros(256, bool)
_NUMERIC[[*range(48, 58), *b".,:/-+$%"]] = True
_WORDLIKE = np.zeros(256, bool)
_WORDLIKE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?:;\"'([{|")] = True
PLAIN, NUMBER, UNIT, NAME = range(4)
_MARK = mix(np.arange(4, dtype=U) + U(0xC0FFEE))


def _unit_keys() -> np.ndarray:
    w = Words(pa.array([" ".join(UNITS)]))
    return np.unique(w.hash)


class Canonical:
    """Canonical words of a slice: ``key`` (hash or placeholder), ``kind``, ``value`` (hash of what stood there), ``doc``."""

    _units: np.ndarray | None = None

    def __init__(self, arr: pa.Array):
        w = Words(arr)
        if Canonical._units is None:
            Canonical._units = _unit_keys()
        n = len(w.data)
        good = np.flatnonzero(_WORDLIKE[w.original])
        lo = np.searchsorted(good, w.start)
        hi = np.searchsorted(good, w.end) - 1
        has = hi >= lo
        doc = w.doc[has]
        start, end = good[np.minimum(lo, max(0, len(good) - 1))][has] if len(good) else lo[has], (good[hi[has]] + 1 if len(good) else hi[has])
        raw_end = w.end[has]
        value = w.span_hash(start, end)
        other = np.append(0, np.cumsum(~_NUMERIC[w.original]))
        digit = np.append(0, np.cumsum((w.original >= 48) & (w.original < 58)))
        kind = np.zeros(len(start), np.uint8)
        kind[(other[end] == other[start]) & (digit[end] > digit[start])] = NUMBER
        first = np.ones(len(start), bool)
        first[1:] = doc[1:] != doc[:-1]
        after_stop = first.copy()
        after_stop[1:] |= _STOPS[w.original[raw_end[:-1] - 1]] | (start[1:] > raw_end[:-1] + 1) & True
        after_number = np.zeros(len(start), bool)
        after_number[1:] = (kind[:-1] == NUMBER) & ~first[1:]
        kind[after_number & np.isin(value, Canonical._units)] = UNIT
        lower = np.append(0, np.cumsum((w.original >= 97) & (w.original < 123)))
        name = ~after_stop & (kind == PLAIN) & (lower[end] > lower[start]) if n else np.zeros(0, bool)
        if n:
            name &= _UPPER[w.original[start]]
        kind[name] = NAME
        self.rows = w.rows
        self.word, self.word_doc = value, doc  # the words as they stand
        self.word_first = np.searchsorted(doc, np.arange(self.rows + 1))
        keep = np.ones(len(start), bool)
        keep[1:] = ~((kind[1:] == NAME) & (kind[:-1] == NAME) & ~first[1:])  # a name of several words is one
        self.kind, self.value, self.doc = kind[keep], value[keep], doc[keep]
        self.key = np.where(self.kind == PLAIN, self.value, _MARK[self.kind])
        self.first = np.searchsorted(self.doc, np.arange(self.rows + 1))

    def windows(self, k: int, literal: bool) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of windows of ``k`` words, as they stand or canonical ones with enough plain ones, and the places of their first words."""
        key, doc = (self.word, self.word_doc) if literal else (self.key, self.doc)
        n = len(key) - k + 1
        if n <= 0:
            return np.zeros(0, U), np.zeros(0, np.int64)
        h = np.zeros(n, U)
        for j in range(k):
            h = h * U(0x9FB21C651E98DF25) + key[j : j + n]
        good = doc[:n] == doc[k - 1 : k - 1 + n]
        if not literal:
            plain = np.append(0, np.cumsum(self.kind == PLAIN))
            n_plain = plain[k:] - plain[:-k]
            good &= (n_plain >= LITERAL) | ((k == WINDOW) & (n_plain >= 1))
        at = np.flatnonzero(good)
        return mix(h[at] + U(k)), at


def _in_order(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The longest run of (place in the text, place in the item, k) that rises in both; among equals the one that begins latest, so that it lies close."""
    last: list[int] = []
    tail: list[int] = []
    before: list[int] = []
    matches = sorted(matches, key=lambda m: (m[0], -m[1]))
    for i, (_, y, _) in enumerate(matches):
        n = bisect.bisect_left(last, y)
        before.append(tail[n - 1] if n else -1)
        last[n : n + 1] = [y]
        tail[n : n + 1] = [i]
    out, i = [], tail[-1] if tail else -1
    while i >= 0:
        out.append(matches[i])
        i = before[i]
    return out[::-1]


def _occurrences(diagonals: dict[int, set[tuple[int, int]]], size: int, need: float) -> Iterator[list[tuple[int, int, int]]]:
    """Matches (place in the text, place in the item, k) of each occurrence that covers enough: of each diagonal, then of all diagonals in order in
    stretches of one and a half and of three times the item's ``size``, which overlap."""
    for diagonal, places in diagonals.items():
        if len(places) >= need:
            yield sorted((diagonal + y, y, k) for y, k in places)
    if len(diagonals) == 1:
        return
    every = sorted((diagonal + y, y, k) for diagonal, places in diagonals.items() for y, k in places)
    at = [m[0] for m in every]
    for span in (size + size // 2 + 1, 3 * size):
        end = lo = 0
        while end < len(every):
            end = bisect.bisect_left(at, at[lo] + span)
            part = every[lo:end]
            while len({m[1] for m in part}) >= need:
                chain = _in_order(part)
                if len(chain) < need:
                    break
                yield chain
                part = sorted(set(part) - set(chain))
            lo = max(lo + 1, bisect.bisect_left(at, at[lo] + span // 3))


class Templates:
    """Windows of a block of items: sorted hashes with item and position, by window length, canonical and as they stand."""

    def __init__(self, texts: list[str | None]):
        c = Canonical(pa.array(texts, pa.string()))
        self.c, self.by_k, self.count = c, {}, {}
        for literal in (False, True):
            doc, size = (c.word_doc, np.diff(c.word_first)) if literal else (c.doc, np.diff(c.first))
            self.by_k[literal], self.count[literal] = [], np.zeros(len(texts), np.int64)
            for k in sorted({WINDOW, *(int(s) for s in np.unique(size) if (1 if literal else LITERAL) <= s < WINDOW)}):
                h, at = c.windows(k, literal)
                own = (size[doc[at]] >= WINDOW) if k == WINDOW else (size[doc[at]] == k)
                h, at = h[own], at[own]
                np.add.at(self.count[literal], doc[at], 1)
                order = np.argsort(h, kind="stable")
                if len(h):
                    self.by_k[literal].append((k, h[order], at[order]))

    def search(self, arr: pa.Array) -> list[tuple[int, int, int, int, int, int, bool]]:
        """(row, item, matched windows, windows, slots, slots that disagree, consistent) of the best occurrence of each pair that covers enough.
        Canonical windows come first, those as they stand where the former do not pass."""
        d = Canonical(arr)
        best = self._best(d, False)
        for pair, got in self._best(d, True).items():
            if pair not in best or not best[pair][-1]:
                best[pair] = got
        return sorted(best.values())

    def _best(self, d: Canonical, literal: bool) -> dict[tuple[int, int], tuple[int, int, int, int, int, int, bool]]:
        c, count = self.c, self.count[literal]
        (d_doc, d_first), (c_doc, c_first) = ((o.word_doc, o.word_first) if literal else (o.doc, o.first) for o in (d, c))
        found: dict[tuple[int, int], dict[int, set[tuple[int, int]]]] = defaultdict(lambda: defaultdict(set))
        for k, table, places in self.by_k[literal]:
            h, at = d.windows(k, literal)
            lo, hi = np.searchsorted(table, h, "left"), np.searchsorted(table, h, "right")
            for i in np.flatnonzero(hi > lo).tolist():
                x = int(at[i])
                row = int(d_doc[x])
                for y in places[lo[i] : hi[i]].tolist():
                    item = int(c_doc[y])
                    y -= int(c_first[item])
                    found[row, item][x - int(d_first[row]) - y].add((y, k))
        out = {}
        for (row, item), diagonals in found.items():
            need = max(1, count[item] * COVERAGE)
            if len({y for places in diagonals.values() for y, _ in places}) < need:
                continue
            from_x, from_y = int(d_first[row]), int(c_first[item])
            best = None
            for chain in _occurrences(diagonals, int(c_first[item + 1]) - from_y, need):
                slots: dict[int, set[int]] = defaultdict(set)
                for x, y, k in () if literal else chain:
                    for j in range(k):
                        if c.kind[from_y + y + j] != PLAIN:
                            slots[int(c.value[from_y + y + j])].add(int(d.value[from_x + x + j]))
                wrong = sum(len(v) > 1 for v in slots.values())
                rank = (wrong <= SLACK * len(slots), len(chain), -wrong)
                if best is None or rank > best:
                    best = rank
                    out[row, item] = (row, item, len(chain), int(count[item]), len(slots), wrong, rank[0])
        return out


def _blocks(items: DataFrame, item_col: str, item_text: str):
    """The items in broadcast blocks whose number follows from their size."""
    small_batches(items.sparkSession)
    sizes = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(item_text)), F.lit(0))).first()
    blocks = max(1, -(-sizes[0] // BLOCK_ITEMS), -(-int(sizes[1]) // BLOCK_BYTES))
    own = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    for block in range(blocks):
        rows = own.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).toArrow()
        yield items.sparkSession.sparkContext.broadcast((rows.column("item").combine_chunks(), rows.column("text").to_pylist()))


def matches(docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_col: str, item_text: str) -> DataFrame:
    """Pairs of documents and items: matched and all windows of the item, coverage, slots, slots that disagree, ``contaminated``."""
    types = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    if len({c.lower() for c in (id_col, item_col, *FOUND)}) < 2 + len(FOUND):
        raise ValueError(f"the ids need names of their own, other than {FOUND}")
    schema = f"`{id_col}` {types[0]}, `{item_col}` {types[1]}, matched long, windows long, coverage double, n_slots long, n_inconsistent long, contaminated boolean"
    src = docs.select(id_col, text_col)
    out = None
    for sent in _blocks(items, item_col, item_text):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            names, texts = sent.value
            templates = Templates(texts)
            for batch in batches:
                for lo, hi in slices(batch.column(1)):
                    part = batch.slice(lo, hi - lo)
                    got = templates.search(part.column(1))
                    r = [g[0] for g in got]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(r, pa.int32())), names.take(pa.array([g[1] for g in got], pa.int32())), *(pa.array(x, t) for x, t in (([g[2] for g in got], pa.int64()), ([g[3] for g in got], pa.int64()), ([g[2] / g[3] for g in got], pa.float64()), ([g[4] for g in got], pa.int64()), ([g[5] for g in got], pa.int64()), ([g[6] for g in got], pa.bool_())))], names=[id_col, item_col, *FOUND])

        found = src.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, text_col: str, items: DataFrame, item_col: str, item_text: str) -> DataFrame:
    """The documents that hold no item: rows are dropped where they are read, all columns stay."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    for sent in _blocks(items, item_col, item_text):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            templates = Templates(sent.value[1])
            for batch in batches:
                for lo, hi in slices(batch.column(text_col)):
                    part = batch.slice(lo, hi - lo)
                    keep = np.ones(part.num_rows, bool)
                    keep[[g[0] for g in templates.search(part.column(text_col)) if g[6]]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, schema)
    return docs
