"""Exact substring dedup: remove each byte covered by a string of LENGTH bytes that also starts elsewhere.

Method. Sorting every suffix of a corpus moves many times its size, but whether a window of LENGTH bytes recurs is decided among windows with the same
minimiser: each window has an anchor, the place of the smallest hash among the K-byte strings in it, at the same offset in equal windows.
1. Anchors whose K-byte string occurs once in the corpus cannot lie in a recurring window; packed counts find them (the duplicate
   detection that comes before a distributed string sort), and only suffixes that begin at the other anchors go on.
2. Each chunk sorts these suffixes (up to LENGTH bytes from the anchor, then what the anchor's windows hold before it) and sends each range of anchors
   one sorted run, front-coded: the common prefix's length with the suffix before, and the rest. Equal ones go once, with their number.
3. A range merges its runs with a loser tree that carries each suffix's common prefix with the last winner: longer ones win without a look at the
   bytes, and equal ones are compared from there on. The merged order comes with its common prefix array.
4. A window at offset o before its anchor recurs if another suffix shares LENGTH - o bytes after the anchor, which the common prefix array
   tells as an interval, and the same o bytes before it.
Anchors with HOT or more occurrences (a passage in very many documents) take another, equally exact way: their windows' hashes are counted, a window
being one entry per chunk, so that no task gets all of them. Window and left-context equality rest on 64-bit hashes.

Bytes are UTF-8; null is empty. Documents shorter than LENGTH lose nothing. Repeated rows count as occurrences of each other, ties do not matter, empty tables
give empty tables. Matches never cross documents; a very long document is one chunk, of any length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm import exchange as ex
from evidentia.llm.scratch import Scratch
from evidentia.llm.textnum import BASE, INVERSE, U, mix, packed, powers, raw

LENGTH, K, HOT = 200, 100, 200
OFFSETS = LENGTH - K + 1


#: Bits of a place in ``sliding_argmin``; longer arrays are cut.
PLACE_BITS = 28


def sliding_argmin(h: np.ndarray, w: int, bits: int = PLACE_BITS) -> np.ndarray:
    """For each p, the place of the smallest of h[p:p+w], by running minima over blocks of w; the first place on ties of
    the upper bits, which is the same choice in equal windows. Arrays of more than 2^bits are done in parts that overlap by w - 1."""
    n = len(h)
    if n > 1 << bits:
        step = (1 << bits) - w + 1
        return np.concatenate([sliding_argmin(h[lo : lo + (1 << bits)], w, bits) + lo for lo in range(0, n - w + 1, step)])
    low = U(PLACE_BITS)  # which bits count does not depend on the parts
    key = (h >> low << low) | np.arange(n, dtype=U)
    pad = -n % w
    blocks = np.append(key, np.full(pad, ~U(0))).reshape(-1, w)
    left = np.minimum.accumulate(blocks, 1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].reshape(-1)
    m = n - w + 1
    return (np.minimum(right[:m], left[w - 1 : w - 1 + m]) & U((1 << PLACE_BITS) - 1)).astype(np.int64)


class Anchored:
    """Windows of a chunk: ``window`` (start of each), ``anchor`` (its place), ``at``/``key``/``of`` (anchors, their hashes, and the
    anchor index of each window)."""

    def __init__(self, texts: pa.Array, length: int = LENGTH, k: int = K):
        self.data, self.offs = raw(texts)
        n = len(self.data)
        self.prefix = np.zeros(n + 1, U)
        np.cumsum((self.data.astype(U) + U(1)) * powers(BASE, n), dtype=U, out=self.prefix[1:])
        self.inverse = powers(INVERSE, n + 1)
        size = np.diff(self.offs)
        if n < length or not (size >= length).any():
            self.window = self.anchor = self.at = self.of = np.zeros(0, np.int64)
            self.key = np.zeros(0, U)
            return
        valid = np.zeros(n + 1, np.int32)
        big = np.flatnonzero(size >= length)
        np.add.at(valid, self.offs[big], 1)
        np.add.at(valid, self.offs[big + 1] - length + 1, -1)
        grams = mix((self.prefix[k:] - self.prefix[:-k]) * self.inverse[: n - k + 1])
        place = sliding_argmin(grams, length - k + 1)
        self.window = np.flatnonzero(np.cumsum(valid[: len(place)]) > 0)
        self.anchor = place[self.window]
        self.at, self.of = np.unique(self.anchor, return_inverse=True)
        self.key = mix(grams[self.at] + U(1))  # anchors are minima of their hashes: mixed again, keys spread over all ranges

    def hash(self, start: np.ndarray, n: int) -> np.ndarray:
        return mix((self.prefix[start + n] - self.prefix[start]) * self.inverse[start] + U(n))


def _occurrences(c: Anchored, counts: np.ndarray) -> np.ndarray:
    """Numbers of the anchors' strings in the corpus, from the replies to the chunk's different ones."""
    return counts[np.searchsorted(np.unique(c.key), c.key)] if len(c.key) else np.zeros(0, np.uint8)


def _runs(c: Anchored, use: np.ndarray, ranges: int) -> tuple[dict[int, bytes], bytes]:
    """Front-coded sorted runs of the anchors ``use`` by range, and the anchors of each suffix in the order of the runs, packed: how many
    suffixes, how many anchors each has, and the anchors.

    A suffix is what follows the anchor in its windows, a zero byte, and what lies before it in reverse: so the order by suffix comes first."""
    first = np.searchsorted(c.of, np.arange(len(c.at)))  # windows of an anchor lie in a row
    last = np.searchsorted(c.of, np.arange(len(c.at)), "right") - 1
    b = ex.bounds(np.sort(c.key[use]), ranges)
    order = use[np.argsort(c.key[use], kind="stable")]
    text = c.data.tobytes()
    out, members = {}, []
    for r in range(ranges):
        group = order[b[r] : b[r + 1]]
        if not len(group):
            continue
        items: dict[tuple[bytes, bytes], list[int]] = {}
        for a in group.tolist():
            at, lo, hi = int(c.at[a]), int(c.window[first[a]]), int(c.window[last[a]]) + LENGTH
            items.setdefault((text[at:hi], text[lo:at]), []).append(a)
        made, before = [], b""
        for right, left in sorted(items):
            same = common(before, right, 0)
            made.append(np.array([same, len(right) - same, len(left), min(len(items[right, left]), 255)], "<u2").tobytes() + right[same:] + left)
            before = right
            members.append(items[right, left])
        out[r] = b"".join(made)
    sizes = [len(m) for m in members]
    return out, np.array([len(members), *sizes, *(a for m in members for a in m)], "<i4").tobytes()


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix, given that the first ``at`` bytes agree."""
    n = min(len(a), len(b))
    if a[at:n] == b[at:n]:
        return n
    step = 32
    while a[at : at + step] == b[at : at + step]:
        at += step
    while step > 1:
        step //= 2
        if a[at : at + step] == b[at : at + step]:
            at += step
    return at


def _read_run(blob: bytes) -> tuple[list[int], list[bytes], list[bytes], list[int]]:
    same, right, left, count, at, before = [], [], [], [], 0, b""
    while at < len(blob):
        s, n, m, c = np.frombuffer(blob, "<u2", 4, at).tolist()
        at += 8
        before = before[:s] + blob[at : at + n]
        same.append(s)
        right.append(before)
        left.append(blob[at + n : at + n + m])
        count.append(c)
        at += n + m
    return same, right, left, count


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> list[tuple[int, int, int]]:
    """Merge sorted runs of (common prefix with the one before, string) by a loser tree: (run, place in it, common prefix with the
    string before in the merged order). ``known[i]`` is the common prefix of run i's head with the last winner; a longer one is
    smaller, and equal ones are compared from there on only. The loser keeps its common prefix with its winner."""
    k = 1
    while k < len(runs):
        k *= 2
    heads = [r[1][0] if i < len(runs) and r[1] else None for i, r in enumerate(runs)] + [None] * (k - len(runs))
    place, known = [0] * k, [0] * k
    losers = [0] * k

    def play(x: int, y: int) -> tuple[int, int]:
        a, b = heads[x], heads[y]
        if b is None:
            return x, y
        if a is None:
            return y, x
        p, q = known[x], known[y]
        if p > q:
            return x, y
        if q > p:
            return y, x
        h = common(a, b, p)
        if h == len(a) or h < len(b) and a[h] < b[h]:
            known[y] = h
            return x, y
        known[x] = h
        return y, x

    level = list(range(k))
    at = k
    while len(level) > 1:
        at //= 2
        nxt = []
        for i in range(0, len(level), 2):
            w, loser = play(level[i], level[i + 1])
            losers[at + i // 2] = loser
            nxt.append(w)
        level = nxt
    winner, out = level[0], []
    while heads[winner] is not None:
        out.append((winner, place[winner], known[winner]))
        place[winner] += 1
        same, strings = runs[winner]
        i = place[winner]
        if i < len(strings):
            heads[winner], known[winner] = strings[i], same[i]
        else:
            heads[winner] = None
        node = (winner + k) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
    return out


def resolve(table: pa.Table) -> pa.Table:
    """One range: merge the chunks' runs, then tell for each suffix and offset whether the window recurs (101 bits)."""
    runs = [_read_run(zlib.decompress(b)) for b in table.column("keys").to_pylist()]
    merged = merge_runs([(r[0], r[1]) for r in runs])
    n = len(merged)
    who = np.array([(x, i) for x, i, _ in merged], np.int64).reshape(n, 2)
    lcp = np.array([c for _, _, c in merged], np.int64)
    count = np.array([runs[x][3][i] for x, i, _ in merged], np.int64)
    right = np.array([len(runs[x][1][i]) for x, i, _ in merged], np.int64)
    left_bytes = [runs[x][2][i] for x, i, _ in merged]
    left = np.array([len(b) for b in left_bytes], np.int64)
    ends = np.cumsum(left)
    flat = np.frombuffer(b"".join(left_bytes), np.uint8)
    bits = np.zeros((n, OFFSETS), bool)
    h = np.zeros(n, U)  # of the o bytes before the anchor
    for o in range(OFFSETS):
        if o:
            has = np.flatnonzero(left >= o)
            h[has] = h[has] * U(BASE) + flat[ends[has] - o] + U(1)
        own = np.flatnonzero((left >= o) & (right >= LENGTH - o))
        if len(own):
            # strings between two that share this prefix share it too, so intervals are cut where the prefix is shorter
            interval = np.cumsum(lcp < LENGTH - o)
            _, which = np.unique(mix(h[own] + interval[own].astype(U) * U(0x9FB21C651E98DF25)), return_inverse=True)
            bits[own, o] = (np.bincount(which, count[own]) >= 2)[which]
    packed_bits = np.packbits(bits, axis=1)
    out = []
    start = np.append(0, np.cumsum([len(r[1]) for r in runs]))
    back = np.zeros((start[-1], packed_bits.shape[1]), np.uint8)
    back[start[who[:, 0]] + who[:, 1]] = packed_bits
    out = [back[a:b].tobytes() for a, b in zip(start[:-1], start[1:], strict=True)]
    return pa.table({"chunk": table.column("chunk"), "r": table.column("r"), "counts": pa.array(out, pa.binary())})


def _kind(t: pa.Table, kind: int) -> pa.Table:
    return t.filter(pc.equal(t.column("kind"), kind)) if t.num_rows else t


def dedup(df: DataFrame, id_col: str, text_col: str, scratch: Scratch, *, hot_from: int = HOT) -> DataFrame:
    """Per row: id, ``n_bytes``, ``kept`` (remaining bytes), ``spans`` (start and length of each maximal removed run)."""
    rows = ex.store_chunks(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", scratch)
    chunks = ex.Chunks(rows, scratch)
    ranges = ex.ranges_for(int(rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]) * 8 // OFFSETS)
    id_type = df.schema[id_col].dataType.simpleString()

    def anchors(table: pa.Table) -> pa.Table:
        c = Anchored(ex.load(table).column("text"))
        return ex.to_rows(table.column("chunk")[0].as_py(), *ex.counted(c.key), ranges)

    replies = scratch.keep(ex.total(chunks.each(anchors, ex.KEYS), ranges).withColumn("kind", F.lit(1)), "anchors")

    def suffixes(pointer: pa.Table, reply: pa.Table) -> pa.Table:
        chunk = pointer.column("chunk")[0].as_py()
        c = Anchored(ex.load(pointer).column("text"))
        n = _occurrences(c, ex.answer(reply))
        runs, members = _runs(c, np.flatnonzero((n >= 2) & (n < hot_from)), ranges)
        windows = c.window[np.isin(c.of, np.flatnonzero(n >= hot_from))]
        counted = ex.to_rows(chunk, *ex.counted(c.hash(windows, LENGTH)), ranges)
        sorted_runs = pa.table({"r": pa.array(list(runs), pa.int32()), "chunk": pa.array([chunk] * len(runs), pa.int64()), "keys": pa.array([zlib.compress(x, 1) for x in runs.values()], pa.binary()), "counts": pa.array([b""] * len(runs), pa.binary())})
        own = pa.table({"r": pa.array([0], pa.int32()), "chunk": pa.array([chunk], pa.int64()), "keys": pa.array([zlib.compress(members, 1)], pa.binary()), "counts": pa.array([b""], pa.binary())})
        out = pa.concat_tables([counted, sorted_runs, own])
        return out.append_column("kind", pa.array([3] * counted.num_rows + [2] * len(runs) + [4], pa.int32()))

    sent = scratch.keep(chunks.with_replies(replies, suffixes, ex.KEYS + ", kind int"), "runs")
    merged = ex.by_range(sent.filter("kind = 2"), ranges).applyInArrow(resolve, "chunk long, r int, counts binary").withColumn("kind", F.lit(2))
    hot_counts = ex.total(sent.filter("kind = 3").drop("kind"), ranges).withColumn("kind", F.lit(3))

    def cut(pointer: pa.Table, reply: pa.Table) -> pa.Table:
        part = ex.load(pointer)
        c = Anchored(part.column("text"))
        hot = np.flatnonzero(_occurrences(c, ex.answer(_kind(reply, 1))) >= hot_from)
        recurs = np.zeros((len(c.at), OFFSETS), bool)
        bits = np.unpackbits(ex.answer(_kind(reply, 2)).reshape(-1, (OFFSETS + 7) // 8), axis=1)[:, :OFFSETS].astype(bool)
        members = np.frombuffer(zlib.decompress(_kind(reply, 4).column("counts")[0].as_py()), "<i4")
        sizes, anchors = members[1 : 1 + members[0]], members[1 + members[0] :]
        recurs[anchors] = np.repeat(bits, sizes, axis=0)
        dup = recurs[c.of, c.anchor - c.window] if len(c.window) else np.zeros(0, bool)
        at = np.flatnonzero(np.isin(c.of, hot))
        if len(at):
            h = c.hash(c.window[at], LENGTH)
            keys = np.unique(h)
            dup[at] = ex.answer(_kind(reply, 3))[np.searchsorted(keys, h)] >= 2
        n = len(c.data)
        mark = np.zeros(n + 1, np.int32)
        starts = c.window[dup]
        mark[starts] += 1
        mark[starts + LENGTH] -= 1
        gone = np.cumsum(mark[:n]) > 0
        kept_before = np.append(0, np.cumsum(~gone))
        edge = np.zeros(n + 1, bool)
        edge[c.offs] = True
        begin, end = gone.copy(), gone.copy()
        begin[1:] &= ~gone[:-1] | edge[1:n]
        end[:-1] &= ~gone[1:] | edge[1:n]
        begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        to = np.searchsorted(begin, c.offs)
        doc = np.searchsorted(c.offs, begin, "right") - 1
        spans = pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.StructArray.from_arrays([pa.array(begin - c.offs[doc], pa.int64()), pa.array(end - begin, pa.int64())], names=["start", "length"]))
        return pa.table({"id": part.column("id"), "n_bytes": np.diff(c.offs), "kept": packed(c.data[~gone], kept_before[c.offs]), "spans": spans})

    own = sent.filter("kind = 4").select("chunk", "r", F.col("keys").alias("counts"), "kind")
    everything = replies.unionByName(scratch.keep(merged.unionByName(hot_counts), "recurring")).unionByName(own)
    return chunks.with_replies(everything, cut, f"id {id_type}, n_bytes long, kept binary, spans array<struct<start:long,length:long>>").withColumnRenamed("id", id_col)
