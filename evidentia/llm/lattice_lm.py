"""Subword lattice likelihood: marginal probability of a text over all segmentations into vocabulary pieces.

Model. A word is drawn whole, with probability c / N of the training tokens times (1 - NOVEL), or spelled: a sequence of
pieces of an existing subword vocabulary and then an end mark. Spelling sums over all segmentations, by forward recursion
in log space over the word's bytes. NOVEL is the share of training tokens seen once (Good-Turing). The vocabulary's own
scores start the piece weights (a merge list has ranks, read as a Zipf law); PASSES passes of expected counts over the training words seen
once, which stand for unseen words, re-weight them. Every byte is a piece too, so each word can be spelled. A text is its words and one end token.
Within a text, that distribution is the base of a Pitman-Yor process over the text's own words so far (DISCOUNT, STRENGTH): words that a
text has used become likelier in it. All of it is normalised: the score is the log of a probability. (``base_score`` is not: it gives each of any number of unseen
words the mass of one, so on small corpora it can exceed a true probability.)

Gathering. Words of all texts are counted by the packed exchange: a chunk sends each range its different words, once, with
their training numbers; a range's task adds up, spells each different word of the corpus once and answers each chunk with counts and scores.
Words meet by hash and are told apart by their bytes, in the chunk and in the range, and a chunk's answers come back by place.
No word is hot (one entry per chunk) and no table of words is broadcast; what is broadcast has the vocabulary's size.

Nulls and texts without words are the end token alone. Tables without training rows score by spelling only (N = 0). Ties and repeated rows
are counted as they come; very long words are spelled by the same recursion.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm import exchange as ex
from evidentia.llm.scratch import Scratch
from evidentia.llm.textnum import BASE, INVERSE, U, Words, equal_groups, give_back, mix, powers

PASSES, DISCOUNT, STRENGTH = 2, 0.7, 30.0
#: Bytes of words that are spelled at once (one word may be longer), and partial sums that one task adds up.
SPELLED, FAN = 1 << 17, 32


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes (a word's beginning is a space), all single bytes first, and their weights from the vocabulary's scores."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes([b]): 1e-6 for b in range(256)}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            p = sp.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in p[1:]:  # words have no space within
                pieces[p] = pieces.get(p, 0) + 1.0 / (10.0 + abs(sp.get_score(i)))
    weights = np.array(list(pieces.values()))
    return list(pieces), weights / weights.sum()


class Lattice:
    """Vectorised spelling of many words: ``flat`` bytes with ``offs``, each word with its space before it."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray, log_end: float):
        self.log_p, self.log_end = log_p, log_end
        lengths = np.array([len(p) for p in pieces])
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in np.unique(lengths):
            ids = np.flatnonzero(lengths == n)
            block = np.frombuffer(b"".join(pieces[i] for i in ids), np.uint8).reshape(-1, n)
            h = mix(((block.astype(U) + U(1)) * powers(BASE, int(n))).sum(1, dtype=U))
            order = np.argsort(h)
            wide = np.zeros((len(ids), -(-int(n) // 8) * 8), np.uint8)
            wide[:, :n] = block
            self.by_length[int(n)] = h[order], ids[order], wide[order].view("<u8")

    def arcs(self, flat: np.ndarray, offs: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(length, begin positions, piece ids) of all matches; hashes find them, bytes decide."""
        n = len(flat)
        h = np.zeros(n + 1, U)
        np.cumsum((flat.astype(U) + U(1)) * powers(BASE, n), dtype=U, out=h[1:])
        inv = powers(INVERSE, n + 1)
        eight = np.ndarray(n + 1, "<u8", np.concatenate([flat, np.zeros(8, np.uint8)]), strides=(1,))
        room = np.repeat(offs[1:], np.diff(offs)) - np.arange(n)
        out = []
        for k, (table, ids, wide) in self.by_length.items():
            at = np.flatnonzero(room >= k)
            if len(at):
                key = mix((h[at + k] - h[at]) * inv[at])
                j = np.minimum(np.searchsorted(table, key), len(table) - 1)
                hit = table[j] == key
                at, j = at[hit], j[hit]
                same = np.ones(len(at), bool)
                for x in range(wide.shape[1]):
                    same &= (eight[at + 8 * x] ^ wide[j, x]) << U(8 * max(0, 8 - (k - 8 * x))) == 0
                out.append((k, at[same], ids[j[same]]))
        return out

    def forward(self, flat: np.ndarray, offs: np.ndarray, want_counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probability (natural) of each word; with ``want_counts`` (a weight for each word) also expected piece counts.

        Positions are processed by their distance from the word's beginning, all words at once."""
        sizes = np.diff(offs)
        arcs = self.arcs(flat, offs)
        begin = np.concatenate([a for _, a, _ in arcs])
        length = np.concatenate([np.full(len(a), k) for k, a, _ in arcs])
        piece = np.concatenate([p for _, _, p in arcs])
        word = np.searchsorted(offs, begin, "right") - 1
        end = begin + length + word  # nodes: one more than bytes for each word
        start = begin + word
        base = offs[:-1] + np.arange(len(sizes))
        depth = begin + length - offs[word]
        order = np.argsort(depth, kind="stable")
        start, end, piece, word, depth = start[order], end[order], piece[order], word[order], depth[order]
        cut = np.append(np.flatnonzero(np.diff(depth, prepend=-1)), len(depth))
        alpha = np.full(len(flat) + len(sizes), -np.inf)
        alpha[base] = 0.0
        w = self.log_p[piece]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            to, x = end[a:b], alpha[start[a:b]] + w[a:b]
            nodes, which = np.unique(to, return_inverse=True)
            top = np.full(len(nodes), -np.inf)
            np.maximum.at(top, which, x)
            alpha[nodes] = top + np.log(np.bincount(which, np.exp(x - top[which])))
        finish = base + sizes
        score = alpha[finish] + self.log_end
        if want_counts is None:
            return score, None
        beta = np.full(len(alpha), -np.inf)
        beta[finish] = 0.0
        order = np.argsort(start - base[word], kind="stable")[::-1]
        s, e, wb, kb = start[order], end[order], w[order], (start - base[word])[order]
        cut = np.append(np.flatnonzero(np.diff(kb, prepend=-1)), len(kb))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            x = beta[e[a:b]] + wb[a:b]
            nodes, which = np.unique(s[a:b], return_inverse=True)
            top = np.full(len(nodes), -np.inf)
            np.maximum.at(top, which, x)
            beta[nodes] = top + np.log(np.bincount(which, np.exp(x - top[which])))
        share = np.exp(alpha[start] + w + beta[end] - alpha[finish][word]) * want_counts[word]
        return score, np.bincount(piece, share, minlength=len(self.log_p))


def _word_parts(w: Words, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words ``first`` in a row."""
    n = w.end[first] - w.start[first]
    ends = np.append(0, np.cumsum(n))
    return w.data[np.repeat(w.start[first] - ends[:-1], n) + np.arange(ends[-1])], ends


def _spaced(flat: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(offs)
    out = np.full(len(flat) + len(n), 32, np.uint8)
    out[np.arange(len(flat)) + np.repeat(np.arange(len(n)), n) + 1] = flat
    return out, offs + np.arange(len(offs))


class Chunk:
    """Words of a chunk: the different ones in the order of their keys, and for each word which of them it is."""

    def __init__(self, part: pa.Table):
        self.w = w = Words(part.column("text").combine_chunks() if part.column("text").num_chunks != 1 else part.column("text").chunk(0))
        self.first, self.which = equal_groups(w.data, w.start, w.end, w.hash)
        self.keys = w.hash[self.first]
        self.train = part.column("train").to_numpy(zero_copy_only=False) if part.num_rows else np.zeros(0, bool)
        self.counts = np.bincount(self.which, self.train[w.doc] if len(w.doc) else None, minlength=len(self.keys)).astype(np.int64)


SENT = "r int, chunk long, keys binary, counts binary, sizes binary, words binary"
#: One row of a range has its different words (no chunk), the others each chunk's places in them.
TABLE = "r int, chunk long, places binary, counts binary, sizes binary, words binary"
STATISTICS = "n long, v long, singles long, expected binary"


def _statistics(n: int, v: int, singles: int, expected: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (n, v, singles)] + [pa.array([expected.tobytes()], pa.binary())], names=["n", "v", "singles", "expected"])


def summed(parts: DataFrame, tasks: int, size: int) -> list:
    """At most ``FAN`` rows that add up to the statistics of all tasks: sums of sums, so no task and not the driver reads a row for each range."""

    def add(batches):
        n = v = s = 0
        expected = np.zeros(size)
        for batch in batches:
            for row in batch.to_pylist():
                n, v, s = n + row["n"], v + row["v"], s + row["singles"]
                expected = expected + np.frombuffer(row["expected"])
        yield _statistics(n, v, s, expected)

    while tasks > FAN:
        tasks = -(-tasks // FAN)
        parts = parts.repartition(tasks).mapInArrow(add, STATISTICS)
    return parts.collect()


def score(df: DataFrame, id_col: str, text_col: str, train: Column, path: str, scratch: Scratch) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one unigram) and ``score`` (log10)."""
    spark = df.sparkSession
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    rows = ex.store_chunks(src, "text", scratch, "train boolean", lambda t: [t.column("train").combine_chunks()])
    chunks = ex.Chunks(rows, scratch)
    size, train_rows = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.coalesce(F.sum(F.col("train").cast("long")), F.lit(0))).first()
    ranges = ex.ranges_for(int(size) // 24)
    id_type = df.schema[id_col].dataType.simpleString()

    def words(table: pa.Table) -> pa.Table:
        c = Chunk(ex.load(table))
        b, out = ex.bounds(c.keys, ranges), []
        for r in range(ranges):
            lo, hi = b[r], b[r + 1]
            if hi > lo:
                flat, ends = _word_parts(c.w, c.first[lo:hi])
                out.append((r, table.column("chunk")[0].as_py(), c.keys[lo:hi].tobytes(), c.counts[lo:hi].astype("<i4").tobytes(), np.diff(ends).astype("<i4").tobytes(), flat.tobytes()))
        return pa.table([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int64(), *[pa.binary()] * 4))], names=["r", "chunk", "keys", "counts", "sizes", "words"])

    sent = chunks.each(words, SENT)

    def merged(table: pa.Table) -> pa.Table:
        """The range's different words, each with its training number and bytes, and for each chunk its words' places among them."""
        parts = [np.frombuffer(x, U) for x in table.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, "<i4") for x in table.column("counts").to_pylist()])
        sizes = np.concatenate([np.frombuffer(x, "<i4") for x in table.column("sizes").to_pylist()]).astype(np.int64)
        flat = np.frombuffer(b"".join(table.column("words").to_pylist()), np.uint8)
        begin = np.cumsum(sizes) - sizes
        first, which = equal_groups(flat, begin, begin + sizes, np.concatenate(parts))
        n = sizes[first]
        ends = np.append(0, np.cumsum(n))
        text = flat[np.repeat(begin[first] - ends[:-1], n) + np.arange(ends[-1])]
        c = np.bincount(which, counts, minlength=len(first)).astype("<i8")
        to = np.append(0, np.cumsum([len(p) for p in parts]))
        places = [which[a:b].astype("<i4").tobytes() for a, b in zip(to[:-1], to[1:], strict=True)]
        none = [None] * len(parts)
        columns = [table.column("r").to_pylist()[:1] + table.column("r").to_pylist(), [None, *table.column("chunk").to_pylist()], [None, *places], [c.tobytes(), *none], [n.astype("<i4").tobytes(), *none], [text.tobytes(), *none]]
        types = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
        give_back()
        return pa.table([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["r", "chunk", "places", "counts", "sizes", "words"])

    known = scratch.keep(ex.by_range(sent, ranges).applyInArrow(merged, TABLE), "table")
    pieces, start_p = vocabulary(path)

    def blocks(row: dict, pick: np.ndarray):
        """Words chosen of a range, in blocks of SPELLED bytes, spaced."""
        sizes = np.frombuffer(row["sizes"], "<i4").astype(np.int64)
        begin = np.append(0, np.cumsum(sizes))
        flat = np.frombuffer(row["words"], np.uint8)
        lo = 0
        total = np.append(0, np.cumsum(sizes[pick]))
        while lo < len(pick):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + SPELLED, "right")) - 1)
            some = pick[lo:hi]
            n = sizes[some]
            ends = np.append(0, np.cumsum(n))
            yield some, *_spaced(flat[np.repeat(begin[some] - ends[:-1], n) + np.arange(ends[-1])], ends)
            lo = hi

    def expect(log_weights: np.ndarray) -> DataFrame:
        """Statistics of each task's ranges: training tokens, different and single words; expected piece counts."""

        def run(batches):
            lattice = Lattice(vocabulary(path)[0], log_weights, 0.0)
            n = v = singles = 0
            counts = np.zeros(len(log_weights))
            for batch in batches:
                for row in batch.to_pylist():
                    c = np.frombuffer(row["counts"], "<i8")
                    single = np.flatnonzero(c == 1)
                    for some, flat, offs in blocks(row, single):
                        counts += lattice.forward(flat, offs, np.ones(len(some)))[1]
                    n, v, singles = n + int(c.sum()), v + int((c > 0).sum()), singles + len(single)
                    give_back()
            yield _statistics(n, v, singles, counts)

        # a task for some ranges each, whatever their files: their words are to be spelled
        words_of = known.filter("chunk is null").select("r", "counts", "sizes", "words")
        return words_of.repartition(tasks, "r").mapInArrow(run, STATISTICS)

    tasks = max(8, -(-ranges // 4))
    # sums of the vocabulary's size: by task, then in a tree, then on the driver for a number of rows that does not grow
    log_p = np.log(start_p)
    for _ in range(PASSES):
        parts = summed(expect(log_p), tasks, len(pieces))
        n_words, v, singles = (sum(p[k] for p in parts) for k in ("n", "v", "singles"))
        p = sum((np.frombuffer(x.expected) for x in parts), np.zeros(len(pieces))) + start_p * 50.0
        log_p, log_end = np.log(p / (p.sum() + singles + 1)), float(np.log((singles + 1) / (p.sum() + singles + 1)))
    n = n_words + train_rows  # each training text has one end token
    v += train_rows > 0
    novel = max(1, singles) / max(1, n) if singles < n else 0.5
    model = spark.sparkContext.broadcast((log_p, log_end))
    base_0 = float(n + (v + 1))

    def both(c: np.ndarray, spelling: np.ndarray) -> np.ndarray:
        whole = np.log(np.maximum(c, 1e-300) / max(1, n)) + np.log1p(-novel)
        return np.logaddexp(np.where(c > 0, whole, -np.inf), np.log(novel) + spelling) / np.log(10)

    def replies(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words_row = next(x for x in rows if x["chunk"] is None)
        asked = [x for x in rows if x["chunk"] is not None]
        lattice = Lattice(vocabulary(path)[0], *model.value)
        c = np.frombuffer(words_row["counts"], "<i8")
        spelling = np.zeros(len(c))
        for some, flat, offs in blocks(words_row, np.arange(len(c))):
            spelling[some] = lattice.forward(flat, offs)[0]
        value = both(c, spelling)
        at = [np.frombuffer(x["places"], "<i4") for x in asked]
        out = pa.table({"chunk": pa.array([x["chunk"] for x in asked], pa.int64()), "r": pa.array([x["r"] for x in asked], pa.int32()), "counts": pa.array([c[i].tobytes() for i in at], pa.binary()), "scores": pa.array([value[i].tobytes() for i in at], pa.binary())})
        del spelling, lattice
        give_back()
        return out

    answers = ex.by_range(known, ranges).applyInArrow(replies, "chunk long, r int, counts binary, scores binary")
    end_value = float(both(np.array([train_rows]), np.array([log_end]))[0])
    end_base = float(np.log10((train_rows + 1) / base_0))

    def sums(pointer: pa.Table, reply: pa.Table) -> pa.Table:
        part = ex.load(pointer)
        ch = Chunk(part)
        c, value = ex.answer(reply, "<i8"), ex.answer(reply, "<f8", "scores")
        rows = part.num_rows
        doc = ch.w.doc
        per = lambda x: np.bincount(doc, x, minlength=rows) if len(doc) else np.zeros(rows)
        order = np.lexsort((ch.which, doc))
        new = np.ones(len(doc), bool)
        new[1:] = (np.diff(doc[order]) != 0) | (np.diff(ch.which[order]) != 0)
        since = np.arange(len(doc)) - np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
        used = np.empty(len(doc), np.int64)
        used[order] = since  # times that the text has used the word before
        tables = np.append(0, np.cumsum(used == 0))
        seen, kinds = np.arange(len(doc)) - ch.w.first[doc], tables[:-1] - tables[ch.w.first[doc]]

        def drawn(value: np.ndarray, used: np.ndarray, seen: np.ndarray, kinds: np.ndarray) -> np.ndarray:
            own = np.where(used > 0, np.log(np.maximum(used - DISCOUNT, 1e-9)), -np.inf)
            return (np.logaddexp(own, np.log(STRENGTH + DISCOUNT * kinds) + value * np.log(10)) - np.log(seen + STRENGTH)) / np.log(10)

        size, kinds_in = np.diff(ch.w.first), tables[ch.w.first[1:]] - tables[ch.w.first[:-1]]
        total = per(drawn(value[ch.which], used, seen, kinds)) + drawn(np.full(rows, end_value), np.zeros(rows), size, kinds_in)
        tokens = size + 1
        return pa.table({
            "id": part.column("id"), "held_out": pa.array(~ch.train), "n_tokens": tokens.astype(np.int64),
            "n_known": (per((c > 0)[ch.which].astype(float)) + (train_rows > 0)).astype(np.int64), "train_tokens": np.full(rows, n, np.int64),
            "base_score": per(np.log10((c + 1) / base_0)[ch.which]) + end_base, "score": total,
        })

    out = chunks.with_replies(answers, sums, f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)
