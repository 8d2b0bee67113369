"""Target-distribution importance resampling over hashed n-grams, through a dictionary of distinct features.

Texts are read once: each word becomes its CRC-32 and its length, and only these are kept, in chunks. A feature, a run of 1 to ``LONGEST`` words
joined by one space, is known by the CRCs and lengths of its words. A chunk sends each range of the dictionary its different features once, with their
numbers in the source and in the target; the range's task counts equal features over all chunks, hashes each different one once (the CRC-32 of the joined
string follows from those of its words), adds up the buckets' sums, and answers every chunk with the buckets of its features. The gains, one for each bucket, are then
joined back to the per-document features. (Two features whose words all agree in CRC and length have one hash, and so one bucket and one gain: nothing depends on telling them apart.)

A feature that makes up a third of all is one entry for each chunk, so no range is hot; a hot bucket is one sum. The dictionary is worked off in ``PASSES`` parts,
so that only one part's features are on the way at a time. Documents are ranked by one written range sort; nothing but the ``BUCKETS`` sums comes to the driver.

Null and empty texts have no features and weight 0; so has everything if both sides are empty (gains are then 0). Equal texts get equal weights and, by their ids, different
scores; equal scores go by the smaller id. A null id counts as an empty one in the hash and comes last among equals. Very long texts are one chunk of their own. Other columns
of the table, whatever their names, are not looked at.
"""

from __future__ import annotations

import gc
import math
import time
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm import exchange as ex
from evidentia.llm.scratch import Scratch
from evidentia.llm.textnum import _LOWER, U, give_back, mix, raw, slices

LONGEST, BUCKETS, LEAST_WORDS, PERCENT, SEED, PASSES = 3, 10_000, 20, 5, 42, 3
#: For the edges of ranges: chunks (and one more for every eight ranges), and the features of each length taken from each.
EDGE_CHUNKS, SAMPLE = 16, 400
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SPACE_CRC = np.uint32(zlib.crc32(b" "))
WORDS = "n_words long, crc binary, size binary"


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 and length of each word of some texts, and where each text's words begin."""
    data, offs = raw(texts)
    data = _LOWER[data]
    n, inside = len(data), _INSIDE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = end - start
    ends = np.append(0, np.cumsum(size))
    flat = np.ascontiguousarray(data[inside])
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(flat)]).dictionary_encode()
    crc = np.array([zlib.crc32(w) for w in coded.dictionary.to_pylist()], np.uint32)
    return crc[coded.indices.to_numpy()] if len(size) else np.zeros(0, np.uint32), size.astype(np.uint32), np.searchsorted(start, offs)


def hashed_words(df: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """The texts as words' CRCs and lengths (packed), with their number."""
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep))
            for lo, hi in slices(texts, 2 << 20):
                crc, size, at = words_of(texts.slice(lo, hi - lo))
                to = np.int64(4) * at
                packed = [pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(to), pa.py_buffer(x)]).cast(pa.binary()) for x in (crc, size)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(len(keep))), pa.array(np.diff(at)), *packed], names=[*keep, "n_words", "crc", "size"])
            give_back()

    return df.select(*keep, text_col).mapInArrow(run, f"{kinds}, {WORDS}")


class Features:
    """The different features of a chunk by length, each in the order of its words' hashes, with their numbers, and the features of each text."""

    def __init__(self, part: pa.Table, first: U | None = None, last: U | None = None):
        """Of the features whose first word's hash lies between two bounds, if they are given."""
        crc, size = (np.frombuffer(raw(part.column(c))[0], np.uint32) for c in ("crc", "size"))
        n = part.column("n_words").to_numpy()
        doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
        self.target = part.column("target").to_numpy(zero_copy_only=False)
        key = crc.astype(U) << U(32) | size
        self.hash, word = np.unique(mix(key), return_inverse=True)
        m = max(1, len(self.hash))
        self.key = np.empty(len(self.hash), U)
        self.key[word] = key
        self.m, self.n_docs, self.kinds, self.own, self.docs = m, len(n), [], [], []
        own, kinds, at = word, np.arange(len(self.hash)), np.arange(len(word))
        if first is not None or last is not None:
            low = 0 if first is None else np.searchsorted(self.hash, first)
            high = len(self.hash) if last is None else np.searchsorted(self.hash, last, "right")
            at = np.flatnonzero((word >= low) & (word < high))
            own = word[at]
        for k in range(1, LONGEST + 1):
            if k > 1:  # each run of k words is one of k - 1 and the word after it
                more = np.flatnonzero(at < len(word) - k + 1)
                more = more[doc[at[more]] == doc[at[more] + k - 1]]
                at = at[more]
                kinds, own = np.unique(own[more] * m + word[at + k - 1], return_inverse=True)
            self.kinds.append(kinds)
            self.own.append(own)
            self.docs.append(doc[at])

    def words(self, k: int, some: np.ndarray) -> list[np.ndarray]:
        """The words (places in ``hash``) of some features of k words."""
        out = []
        for j in range(k - 1, 0, -1):
            code = self.kinds[j][some]
            out.append(code % self.m)
            some = code // self.m
        return [some, *out[::-1]]

    def cuts(self, edges: np.ndarray) -> list[np.ndarray]:
        """Where each range begins among the features of each length. An edge is as many hashes as the longest feature has words; a feature goes by its hashes, a shorter one before the
        longer ones that begin with it."""
        out = [[] for _ in range(LONGEST)]
        for edge in edges:
            at, exact = 0, True  # of the features of k words that begin before the edge does, and whether one is its beginning
            for k in range(LONGEST):
                place = int(np.searchsorted(self.hash, edge[k]))
                there = place < len(self.hash) and self.hash[place] == edge[k]
                if k == 0:
                    low = place
                elif exact:
                    low = int(np.searchsorted(self.kinds[k], at * self.m + place))
                    there = there and low < len(self.kinds[k]) and self.kinds[k][low] == at * self.m + place
                else:
                    low = int(np.searchsorted(self.kinds[k], at * self.m))
                exact = exact and bool(there)
                at = low
                out[k].append(low + (exact and k < LONGEST - 1))
        return [np.concatenate([[0], np.array(x, np.int64), [len(kinds)]]).astype(np.int64) for x, kinds in zip(out, self.kinds, strict=True)]

    def rows(self, chunk: int, edges: np.ndarray, ranges: range) -> pa.Table:
        """A packed row for each of these ranges of the dictionary that has features here."""
        cuts, words, counts = self.cuts(edges), [], []
        begin = [int(c[ranges.start]) for c in cuts]
        for k in range(LONGEST):
            low, high = begin[k], int(cuts[k][ranges.stop])
            side, own = self.target[self.docs[k]], self.own[k]
            words.append(self.words(k + 1, np.arange(low, high)))
            counts.append([np.bincount(own[pick], minlength=len(self.kinds[k]))[low:high].astype("<u4") for pick in (~side, side)])
        out, used, name = [], np.zeros(self.m, bool), np.zeros(self.m, "<u4")
        for r in ranges:
            some = [slice(int(c[r]) - b, int(c[r + 1]) - b) for c, b in zip(cuts, begin, strict=True)]
            if any(x.stop > x.start for x in some):
                own = [[w[x] for w in ws] for ws, x in zip(words, some, strict=True)]
                for ws in own:
                    for w in ws:
                        used[w] = True
                table = np.flatnonzero(used)
                used[table] = False
                name[table] = np.arange(len(table))
                out.append((r, pack(self.key[table], [[name[w] for w in ws] for ws in own], [[c[x] for c in cs] for cs, x in zip(counts, some, strict=True)])))
        return pa.table([pa.array([r for r, _ in out], pa.int32()), pa.array([chunk] * len(out), pa.int64()), pa.array([x for _, x in out], pa.binary())], names=["r", "chunk", "features"])

    def weights(self, buckets: np.ndarray, edges: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """Sums of gains by text; ``buckets`` come in the order of the packed rows."""
        cuts, total, gain = self.cuts(edges), np.zeros(self.n_docs), gains[buckets]
        begin = np.cumsum(np.stack([np.diff(c) for c in cuts], axis=1).ravel())
        begin = np.append(0, begin)[:-1].reshape(-1, LONGEST)  # by range, then length
        for k in range(LONGEST):
            n = np.diff(cuts[k])
            own = gain[np.repeat(begin[:, k] - cuts[k][:-1], n) + np.arange(cuts[k][-1])]
            total += np.bincount(self.docs[k], own[self.own[k]], minlength=self.n_docs) if len(self.docs[k]) else 0
        return total.astype(np.int64)

    def sample(self, most: int) -> np.ndarray:
        """Hashes of some features, evenly spaced (at most ``most`` of the commonest length), 0 where there is no further word."""
        out, every = [], max(map(len, self.kinds)) // most + 1
        for k in range(1, LONGEST + 1):
            some = np.arange(every // 2, len(self.kinds[k - 1]), every)
            h = np.zeros((len(some), LONGEST), U)
            for j, w in enumerate(self.words(k, some)):
                h[:, j] = self.hash[w]
            out.append(h)
        return np.concatenate(out)


def _planes(x: np.ndarray) -> np.ndarray:
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel()


def pack(table: np.ndarray, words: list[list[np.ndarray]], counts: list[list[np.ndarray]]) -> bytes:
    """Features by length, compressed: a table of their words' CRCs and lengths, their words' places in it (as differences from the feature before), and their numbers."""
    flat = [np.array([len(table), *(len(c[0]) for c in counts)], "<u4").view(np.uint8), _planes(table >> U(32)), _planes(table & U(0xFFFFFFFF))]
    for ws, cs in zip(words, counts, strict=True):
        for w in ws:
            delta = w.copy()
            delta[1:] ^= w[:-1]
            flat.append(_planes(delta))
        flat += map(_planes, cs)
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(flat).tobytes())


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Words (CRC and length in one number, 0 where there is no further word) and numbers of a packed row's features: an array for each place of a word, and for each side."""
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    at = 4 * (LONGEST + 1)
    m, *sizes = flat[:at].view("<u4").tolist()

    def column(n: int) -> np.ndarray:
        nonlocal at
        at += 4 * n
        return np.ascontiguousarray(flat[at - 4 * n : at].reshape(4, n).T).view("<u4").ravel()

    table = column(m).astype(U) << U(32)
    table |= column(m)
    words, numbers, row = np.zeros((LONGEST, sum(sizes)), U), np.zeros((2, sum(sizes)), "<u4"), 0
    for k, n in enumerate(sizes, 1):
        for j in range(k):
            words[j, row : row + n] = table[np.bitwise_xor.accumulate(column(n))]
        for side in (0, 1):
            numbers[side, row : row + n] = column(n)
        row += n
    return words, numbers


def _after_zeros() -> np.ndarray:
    """Tables of what a CRC register becomes after 2^j zero bytes, by its four bytes."""
    one = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)  # the usual table, up to its constant
    step = np.zeros((4, 256), np.uint32)
    for i in range(4):
        state = np.arange(256, dtype=np.uint32) << np.uint32(8 * i)
        step[i] = one[state & 255] ^ (state >> np.uint32(8))
    out = [step]
    for _ in range(31):
        out.append(_apply(out[-1], out[-1].ravel()).reshape(4, 256))
    return np.stack(out)


def _apply(table: np.ndarray, state: np.ndarray) -> np.ndarray:
    return table[0][state & 255] ^ table[1][state >> np.uint32(8) & 255] ^ table[2][state >> np.uint32(16) & 255] ^ table[3][state >> np.uint32(24)]


_ZEROS = _after_zeros()


def joined_crc(crc: np.ndarray, more: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings in a row, from those of each and the second one's length."""
    crc = crc.copy()
    for j in range(int(size.max(initial=0)).bit_length()):
        some = np.flatnonzero(size >> np.uint32(j) & 1)
        crc[some] = _apply(_ZEROS[j], crc[some])
    return crc ^ more


def feature_crc(words: np.ndarray) -> np.ndarray:
    """CRC-32 of features from their words' CRCs and lengths."""
    crc = (words[0] >> U(32)).astype(np.uint32)
    for more in words[1:]:
        some = np.flatnonzero(more)
        spaced = _apply(_ZEROS[0], crc[some]) ^ _SPACE_CRC
        crc[some] = joined_crc(spaced, (more[some] >> U(32)).astype(np.uint32), more[some].astype(np.uint32))
    return crc


def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different features of a range's parts: which one each entry is, their words, and their numbers in the source and the target."""
    words, numbers = (np.concatenate(x, axis=1) for x in zip(*parts, strict=True))
    key = np.zeros(words.shape[1], U)
    for w in words:
        key = (key + w + U(1)) * U(0x9FB21C651E98DF25)
        key ^= key >> U(29)
    kinds, which = np.unique(key, return_inverse=True)
    first = np.empty(len(kinds), np.int64)
    first[which] = np.arange(len(which))
    if not all(np.array_equal(w[first][which], w) for w in words):  # two features of one key
        _, first, which = np.unique(words, axis=1, return_index=True, return_inverse=True)
        which = which.ravel()
    sums = np.stack([np.bincount(which, n, minlength=len(first)) for n in numbers])
    return which, words[:, first], sums.astype(np.int64)


def _release(df: DataFrame) -> None:
    """Let go of the shuffle files of finished jobs: Spark removes them once both languages have collected what refers to them (a first time what Python held, then the rest)."""
    for _ in range(2):
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def weighted(docs: DataFrame, id_col: str, text_col: str, target: DataFrame, target_text: str, scratch: Scratch) -> DataFrame:
    """(id, n_words, n_features, weight) for each row of ``docs``."""
    spark, id_type = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(False).alias("target"))
    both = source.unionByName(target.select(F.lit(None).cast(id_type).alias("id"), F.col(target_text).alias("text"), F.lit(True).alias("target")))
    rows = ex.store_chunks(hashed_words(both, "text", "id", "target"), "crc", scratch)
    chunks = ex.Chunks(rows, scratch)
    features = int(rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]) // 4 * LONGEST * 3 // 5
    ranges = -(-ex.ranges_for(features) // PASSES) * PASSES
    edges = spark.sparkContext.broadcast(range_edges(chunks, ranges))

    def sent(some: range):
        def run(pointer: pa.Table) -> pa.Table:
            first = edges.value[some.start - 1][0] if some.start else None
            last = edges.value[some.stop - 1][0] if some.stop < ranges else None
            return Features(ex.load(pointer), first, last).rows(pointer.column("chunk")[0].as_py(), edges.value, some)

        return run

    def answered(table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table.column("features").to_pylist()]
        which, words, (s, t) = counted(parts)
        bucket = (feature_crc(words) % BUCKETS).astype("<u2")
        ends = np.append(0, np.cumsum([p.shape[1] for p, _ in parts]))
        small = zstandard.ZstdCompressor(level=1)
        replies = [small.compress(np.ascontiguousarray(bucket[which[a:b]].view(np.uint8).reshape(-1, 2).T).tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        sums = np.stack([np.bincount(bucket, x, minlength=BUCKETS) for x in (s, t)]).astype("<i8")
        return pa.table([pa.array([None, *table.column("chunk").to_pylist()], pa.int64()), pa.array([None, *table.column("r").to_pylist()], pa.int32()), pa.array([small.compress(sums.tobytes()), *replies], pa.binary())], names=["chunk", "r", "buckets"])

    replies, each = None, ranges // PASSES
    for part in range(PASSES):
        asked = chunks.each(sent(range(part * each, (part + 1) * each)), "r int, chunk long, features binary")
        reply = scratch.keep(ex.by_range(asked, each).applyInArrow(lambda t: ex._trimmed(answered, t), "chunk long, r int, buckets binary"), f"buckets-{part}")
        replies = reply if replies is None else replies.unionByName(reply)
        del asked
        _release(docs)

    gains = spark.sparkContext.broadcast(bucket_gains(replies))

    def weigh(pointer: pa.Table, reply: pa.Table) -> pa.Table:
        part = ex.load(pointer)
        order = np.argsort(reply.column("r").to_numpy()) if reply.num_rows else []
        got = reply.column("buckets").to_pylist()
        plain = zstandard.ZstdDecompressor()
        buckets = [np.frombuffer(plain.decompress(got[i]), np.uint8).reshape(2, -1).T.astype("<u2") for i in order]
        buckets = np.concatenate(buckets) if buckets else np.zeros((0, 2), "<u2")
        weight = Features(part).weights(buckets[:, 0] | buckets[:, 1] << 8, edges.value, gains.value)
        out = pa.table([part.column("id"), part.column("n_words"), pa.array(weight)], names=["id", "n_words", "weight"])
        return out.filter(pa.array(~part.column("target").to_numpy(zero_copy_only=False)))

    got = chunks.with_replies(replies.filter("chunk is not null"), weigh, f"id {id_type}, n_words long, weight long")
    n = F.col("n_words")
    features = sum((F.greatest(n - k, F.lit(0)) for k in range(1, LONGEST)), n)
    return got.select("id", "n_words", features.cast("long").alias("n_features"), "weight")


def range_edges(chunks: ex.Chunks, ranges: int) -> np.ndarray:
    """Edges of ranges with about as many features each, from some features of some chunks; results don't depend on them."""
    some = chunks.df.orderBy(F.xxhash64("chunk"), "chunk").limit(EDGE_CHUNKS + ranges // 8)

    def run(pointer: pa.Table) -> pa.Table:
        return pa.table([pa.array([Features(ex.load(pointer)).sample(SAMPLE).astype("<u8").tobytes()], pa.binary())], names=["hashes"])

    got = [np.frombuffer(x.hashes, "<u8").reshape(-1, LONGEST) for x in some.groupBy("chunk").applyInArrow(lambda p: ex._trimmed(run, p), "hashes binary").collect()]
    found = np.concatenate([np.zeros((0, LONGEST), U), *got])
    if not len(found):
        return np.array([[(r << 64) // ranges, 0, 0][:LONGEST] for r in range(1, ranges)], U).reshape(-1, LONGEST)
    found = found[np.lexsort(found.T[::-1])]
    return found[np.arange(1, ranges) * len(found) // ranges]


def bucket_gains(replies: DataFrame) -> np.ndarray:
    """Gains by bucket from the ranges' sums: added up by task, then by bucket; ``BUCKETS`` rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, plain = np.zeros((2, BUCKETS), np.int64), zstandard.ZstdDecompressor()
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(plain.decompress(x), "<i8").reshape(2, BUCKETS)
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])], names=["bucket", "s", "t"])

    sums = replies.filter("chunk is null").select("buckets").mapInArrow(run, "bucket long, s long, t long").groupBy("bucket").agg(F.sum("s"), F.sum("t")).collect()
    s, t = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for b, x, y in sums:
        s[b], t[b] = x, y
    all_s, all_t = int(s.sum()), int(t.sum())
    if not all_s and not all_t:
        return np.zeros(BUCKETS, np.int64)
    return np.array([math.floor(1000 * math.log((y + 1) * (all_s + BUCKETS) / ((x + 1) * (all_t + BUCKETS)))) for x, y in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def resample(docs: DataFrame, id_col: str, text_col: str, target: DataFrame, target_text: str, scratch: Scratch, *, percent: int = PERCENT, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Per row: id, ``n_features``, ``weight``, ``score`` (weight with Gumbel noise from the id), and ``rank`` among the ``percent`` drawn of the rows with at least ``least`` words (else null)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    rows = weighted(docs, id_col, text_col, target, target_text, scratch).withColumn("score", F.col("weight") + noise).withColumn("_out", F.col("n_words") < least)
    at = F.monotonically_increasing_id()
    placed = rows.orderBy("_out", F.col("score").desc(), F.col("id").asc_nulls_last()).withColumns({"_part": F.shiftright(at, 33), "_place": at.bitwiseAND((1 << 33) - 1)})
    placed = scratch.keep(placed, "sorted")
    parts = placed.groupBy("_part").agg(F.count("*").alias("n"), F.count_if(~F.col("_out")).alias("in")).orderBy("_part").collect()  # one row for each part of the sort
    before, drawn = 0, percent * sum(p["in"] for p in parts) // 100
    offsets = []
    for p in parts:
        offsets.append((p["_part"], before))
        before += p["n"]
    offset = F.broadcast(docs.sparkSession.createDataFrame(offsets, "_part long, _before long"))
    rank = F.col("_place") + F.col("_before") + 1
    out = placed.join(offset, "_part").withColumn("rank", F.when(~F.col("_out") & (rank <= drawn), rank))
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
