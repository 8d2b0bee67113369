"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming decoder.

Method. In a merge table where every token is the encoding of its own bytes, a token sequence is an encoding exactly if
each neighbouring pair is: encode(a + b) = [a, b]. So a prefix's encoding ends in the one token that fits the encoding
of what lies before it. The transducer guesses where tokens begin: its nondeterministic states are the partial tokens (nodes of a
trie of all tokens). Their subset construction is carried out on demand: the set of live partial tokens is named by its
longest one, and a transition on a byte is computed once and kept. With each set go the tokens that end there; the one that fits is
the last token of the prefix read so far. Tokens are emitted once all live partial tokens continue the same encoding, that is
after a lookahead bounded by the longest token; in practice at a piece's end, and in long pieces every ``FLUSH`` bytes.

Pieces are the matches of the tokenizer's pattern; a piece that is itself a token is that token, as in the library.
Outputs for short pieces are kept in a bounded table, since pieces recur. The tables of pairs and pieces are cleared when
they reach their bounds and the states are bounded by the trie, so memory is bounded.

Nulls are empty texts: no tokens, empty bytes. Empty tables give empty tables; other columns pass through untouched; rows are
independent, so repeated rows and ties change nothing. Very long texts are encoded piece by piece.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.scratch import small_batches
from evidentia.llm.textnum import Spans, equal_groups, packed, raw, slices

#: Bounds of the tables: token pairs, and pieces with their length; bytes of a long piece between emissions; bytes of text at once.
PAIRS, PIECES, PIECE_BYTES, FLUSH, BATCH = 500_000, 300_000, 48, 4096, 1 << 19


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.joined: dict[tuple[int, int], int] = {}  # pair of tokens -> the token that merging them makes
        self.halves: dict[int, tuple[int, int]] = {}  # token -> the pair of its last merge
        self.proper: set[int] = set()  # tokens that merging can reach
        for t in sorted(self.bytes_of):
            b = self.bytes_of[t]
            pairs = ((self.ranks.get(b[:i], t), self.ranks.get(b[i:], t)) for i in range(1, len(b)))
            last = next(((x, y) for x, y in pairs if x < t and y < t and x in self.proper and y in self.proper and self._adjacent(x, y)), None)
            if last:
                self.halves[t] = last
                self.joined[last] = t
            if last or len(b) == 1:
                self.proper.add(t)
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for t in self.proper:
            node = 0
            for x in self.bytes_of[t]:
                nxt = self.children[node].get(x)
                if nxt is None:
                    nxt = self.children[node][x] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = t
        self.longest = max(map(len, ranks))
        self.size = {t: len(b) for t, b in self.bytes_of.items()}
        self.pair: dict[int, bool] = {}
        self.names = {(0,): 0}  # set of live partial tokens -> state
        self.sets: list[tuple[int, ...]] = [(0,)]
        self.ends: list[list[tuple[int, int]]] = [[]]  # by state: (token, length) that end there, longest first
        self.moves: list[dict[int, int]] = [{}]

    def _adjacent(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay apart when merged side by side: undo their merges from the latest on, and see
        that at no moment the tokens at the seam would have merged earlier than the merge just undone."""
        before = 1 << 60
        while True:
            made = self.joined.get((a, b))
            if made is not None and made < before:
                return False
            left, right = self.halves.get(a), self.halves.get(b)
            if left is None and right is None:
                return True
            if right is None or left is not None and a > b:
                before, a = a, left[1]  # at equal rank the left one merges first
            else:
                before, b = b + 1, right[0]

    def _fits(self, a: int, t: int) -> bool:
        if len(self.pair) >= PAIRS:
            self.pair.clear()
        ok = self.pair[a << 32 | t] = self._adjacent(a, t)
        return ok

    def _move(self, state: int, byte: int) -> int:
        """The transition, determinised now: every live partial token reads the byte, and a new one begins."""
        nodes = tuple(n for n in (self.children[x].get(byte) for x in self.sets[state]) if n is not None)
        live = (*(n for n in nodes if self.children[n]), 0)
        tokens = tuple(t for t in (self.token_at[n] for n in nodes) if t >= 0)
        to = self.names.get((live, tokens))
        if to is None:
            to = self.names[live, tokens] = len(self.sets)
            self.sets.append(live)
            self.ends.append([(t, len(self.bytes_of[t])) for t in tokens])
            self.moves.append({})
        self.moves[state][byte] = to
        return to

    def run(self, piece: bytes) -> list[int]:
        """Encode a piece. ``last[i]``: the last token of the encoding of its first i bytes."""
        out: list[int] = []
        last, state, moves, ends, pair, i = [-1], 0, self.moves, self.ends, self.pair, 0
        for byte in piece:
            nxt = moves[state].get(byte)
            state = self._move(state, byte) if nxt is None else nxt
            i += 1
            for t, n in ends[state]:
                a = last[i - n]
                if a < 0:
                    break
                ok = pair.get(a << 32 | t)
                if ok or ok is None and self._fits(a, t):
                    break
            last.append(t)
            if i >= FLUSH:
                agreed = self._agreed(last, i)
                out += self._trace(last, agreed)
                last = last[agreed:]
                i -= agreed
        return out + self._trace(last, i)

    def _trace(self, last: list[int], i: int) -> list[int]:
        back, size = [], self.size
        while i > 0:
            back.append(last[i])
            i -= size[last[i]]
        return back[::-1]

    def _agreed(self, last: list[int], i: int) -> int:
        """The furthest position at which the encodings of all prefixes still alive have a token's end."""
        common: set[int] | None = None
        for j in range(max(0, i - self.longest), i + 1):
            ends = {0}
            while j > 0:
                ends.add(j)
                j -= self.size[last[j]]
            common = ends if common is None else common & ends
        return max(common or {0})


_CLASS = None  # of each code point: 0 white space, 1 letter, 2 number, 3 other


def _classes() -> np.ndarray:
    global _CLASS
    if _CLASS is None:
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        table = np.full(0x110000, 3, np.uint8)
        for k, kind in enumerate((r"\s+", r"\p{L}+", r"\p{N}+")):
            for m in regex.finditer(kind, every):
                lo, hi = m.span()
                at = lambda i: i if i < 0xD800 else i + 0x800
                table[at(lo) : at(hi - 1) + 1] = k
        _CLASS = table
    return _CLASS


#: Endings that the pattern takes as pieces of their own after an apostrophe.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: The pattern that ``split`` follows; any other is run by the regex library.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def split(points: np.ndarray) -> np.ndarray:
    """Starts of the pattern's matches in a text's code points (they tile the text), by runs of character classes:

    a run of letters, numbers or others takes one space before it; a run of white space before a run leaves its last
    character, which is a piece of its own unless it is that space; at the text's end it is whole. A lone apostrophe that
    begins a piece and is followed by one of the endings forms a piece with it."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    begin = np.ones(n, bool)
    begin[1:] = kind[1:] != kind[:-1]
    runs = np.flatnonzero(begin)
    last = np.append(runs[1:], n) - 1
    white = kind[runs] == 0
    inner = white & (last < n - 1)  # white space before something
    begin[last[inner]] = True
    spaces = last[inner][points[last[inner]] == 32]
    begin[spaces + 1] = False
    lone = runs[(kind[runs] == 3) & (runs == last) & (points[runs] == 39) & begin[runs]]
    for i in lone[lone + 1 < n]:
        for end in _ENDINGS:
            k = i + 1 + len(end)
            if k <= n and all(points[i + 1 + j] == ord(c) for j, c in enumerate(end)):
                begin[i + 1] = False
                if k < n:
                    begin[k] = True
                break
    return np.flatnonzero(begin)


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer, self.pattern = Transducer(ranks), pattern
        # packed ids (an array for each piece would take three times the memory) of the pieces met of late, and of those before
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for b, t in ranks.items():
            size[t] = len(b)
        self.size, self.at = size, np.cumsum(size) - size  # all tokens' bytes in one array, in the order of their ids
        self.flat = np.frombuffer(b"".join(b for b, _ in sorted(ranks.items(), key=lambda x: x[1])), np.uint8)

    def piece(self, piece: bytes) -> bytes:
        """Ids of a piece that is not among those met of late: the half of the table that was filled before is looked at, and goes when this one is full."""
        ids = self.older.get(piece)
        if ids is None:
            one = self.transducer.ranks.get(piece)
            ids = one.to_bytes(4, "little") if one is not None else np.array(self.transducer.run(piece), "<u4").tobytes()
        if len(piece) <= PIECE_BYTES:
            if len(self.known) >= PIECES // 2:
                self.older, self.known = self.known, {}
            self.known[piece] = ids
        return ids

    def encode_many(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin. Each different piece is looked up once."""
        lead = (data & 0xC0) != 0x80
        at = np.flatnonzero(lead)
        starts = np.zeros(len(data) + 1, bool)
        text_at = np.searchsorted(at, offs)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        for lo, hi in zip(text_at[:-1], text_at[1:], strict=True):
            if self.pattern == SPLIT_PATTERN:
                starts[at[lo + split(points[lo:hi])]] = True
            elif hi > lo:
                text = points[lo:hi].tobytes().decode("utf-32-le")
                starts[at[lo + np.array([m.start() for m in regex.finditer(self.pattern, text)])]] = True
        begin = np.flatnonzero(starts)
        end = np.append(begin[1:], len(data))
        return self._gather(data, offs, begin, end)

    def _gather(self, data: np.ndarray, offs: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, which = equal_groups(data, begin, end, Spans(data)(begin, end))
        whole, got = data.tobytes(), []
        for b, e in zip(begin[first].tolist(), end[first].tolist(), strict=True):
            p = whole[b:e]
            ids = self.known.get(p)
            got.append(self.piece(p) if ids is None else ids)
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        where = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(got), "<u4")
        n = size[which]
        to = np.append(0, np.cumsum(n))
        ids = flat[np.repeat(where[which] - to[:-1], n) + np.arange(to[-1])]
        return ids, to[np.searchsorted(begin, offs)]

    def encode(self, text: str) -> list[int]:
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        return self.encode_many(data, np.array([0, len(data)]))[0].tolist()

    def decode_many(self, ids: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts in a row, and where each text's begin."""
        n = self.size[ids]
        ends = np.append(0, np.cumsum(n))
        return self.flat[np.repeat(self.at[ids] - ends[:-1], n) + np.arange(ends[-1])], ends[to]

    def decode_texts(self, ids: np.ndarray, to: np.ndarray) -> list[str]:
        """Texts from ids through the streaming state machine, ``FLUSH`` tokens at a time; where each text's ids begin is in ``to``."""
        out = []
        for lo, hi in zip(to[:-1].tolist(), to[1:].tolist(), strict=True):
            stream, parts = Utf8Stream(), []
            for i in range(lo, hi, FLUSH):
                some = ids[i : min(i + FLUSH, hi)]
                parts.append(stream.feed(self.decode_many(some, np.array([0, len(some)]))[0].tobytes()))
            parts.append(stream.feed(b"", final=True))
            out.append("".join(parts))
        return out


_BEYOND_ASCII = re.compile(rb"[\x80-\xff]")


class Utf8Stream:
    """An incremental UTF-8 state machine: feed bytes of tokens as they come, get the text that is complete so far.
    A token may end within a character; what is unfinished waits. Malformed input gives U+FFFD, once for each maximal
    ill-formed part, as the Unicode Standard recommends. Between characters, a run of ASCII is one step."""

    def __init__(self):
        self.need, self.low, self.high, self.held = 0, 0x80, 0xBF, bytearray()

    def feed(self, data: bytes, final: bool = False) -> str:
        out, i, n = [], 0, len(data)
        while i < n:
            b = data[i]
            if not self.need:
                if b < 0x80:
                    found = _BEYOND_ASCII.search(data, i)
                    j = found.start() if found else n
                    out.append(data[i:j].decode("ascii"))
                    i = j
                    continue
                self.low, self.high = 0x80, 0xBF
                if 0xC2 <= b <= 0xDF:
                    self.need = 1
                elif 0xE0 <= b <= 0xEF:
                    self.need, self.low, self.high = 2, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF
                elif 0xF0 <= b <= 0xF4:
                    self.need, self.low, self.high = 3, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF
                else:
                    out.append("\ufffd")
                    i += 1
                    continue
                self.held = bytearray([b])
                i += 1
            elif self.low <= b <= self.high:
                self.held.append(b)
                self.low, self.high, self.need = 0x80, 0xBF, self.need - 1
                i += 1
                if not self.need:
                    out.append(self.held.decode("utf-8"))
            else:
                out.append("\ufffd")
                self.need = 0
        if final and self.need:
            out.append("\ufffd")
            self.need = 0
        return "".join(out)


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """Read a rank file once per worker; the file lies with the installed tokenizers on each machine."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return Encoder(ranks, pattern)


def encode(df: DataFrame, text_col: str, path: str, pattern: str, *, ids_col: str = "token_ids", n_col: str = "n_tokens", decoded_col: str | None = None) -> DataFrame:
    """Add the ids of each text, packed as little-endian unsigned 32-bit integers, their number, and on request the UTF-8 bytes
    of the text that the streaming state machine decodes from them. Columns of these names are replaced; all others pass through.

    One Arrow pass without a shuffle; a task holds one batch's texts and ids."""
    small_batches(df.sparkSession)
    added = [(ids_col, "binary"), (n_col, "long"), *([(decoded_col, "binary")] if decoded_col else [])]
    own = {c for c, _ in added}
    src = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in own or c == text_col])
    kept = [c for c in src.columns if c not in own]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name in kept), *(f"`{c}` {t}" for c, t in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for whole in batches:
            for lo, hi in slices(whole.column(text_col), BATCH):
                batch = whole.slice(lo, hi - lo)
                ids, to = enc.encode_many(*raw(batch.column(text_col)))
                cols = [batch.column(c) for c in kept]
                cols.append(packed(ids, to * 4))
                cols.append(pa.array(np.diff(to), pa.int64()))
                if decoded_col:
                    cols.append(pa.array(enc.decode_texts(ids, to), pa.string()).cast(pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[*kept, *(c for c, _ in added)])

    return src.mapInArrow(run, schema)


def decode(df: DataFrame, ids_col: str, path: str, pattern: str, *, text_col: str = "decoded_text") -> DataFrame:
    """Decode packed ids to text through the streaming state machine, token by token; null ids are an empty text."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text_col), f"`{text_col}` string"])
    kept = [c for c in df.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            data, offs = raw(batch.column(ids_col))
            out = enc.decode_texts(np.frombuffer(data.tobytes(), "<u4"), offs // 4)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out, pa.string())], names=[*kept, text_col])

    return df.mapInArrow(run, schema)
