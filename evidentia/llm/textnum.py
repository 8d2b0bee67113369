"""Vectorised text arithmetic over Arrow string arrays: words, word hashes and shingles without a Python loop per word.

Texts are UTF-8 bytes. A-Z is lower-cased byte by byte; the separators (space and 0x09-0x0D) are ASCII, so working on
bytes splits exactly where a character regex would. Words are hashed by polynomials modulo two primes, then mixed; where equal
words must be told from words of equal hash, ``equal_groups`` looks at the bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Polynomials modulo 2^64, for strings of bounded length only: longer ones of a regular make-up can collide.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Two families of (prime, base), for words of any length.
FAMILIES = (((2147483647, 1392081259), (2147483629, 972663749)), ((2147483587, 1812433253), (2147483579, 630360016)))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[tuple[int, int], np.ndarray] = {}
#: Bytes of text handled at once, unless one text is longer: some dozens of arrays of 8 bytes for each byte are alive then. Powers up to POWERS are kept.
BLOCK, POWERS = 1 << 19, 3 << 20


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # GNU's C library has it


def give_back() -> None:
    """Return freed memory to the system: a worker serves many tasks, and would else keep the most that one of them ever held."""
    if _TRIM is not None:
        _TRIM(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), so that sums and ranks of hashes behave as random."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    """Powers of ``base`` modulo 2^64."""
    have = _POWERS.get((0, base))
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK + 1024), base, U)
        have[0] = 1
        have = np.cumprod(have, dtype=U)
        if n <= POWERS:
            _POWERS[0, base] = have
    return have[:n]


def powers_mod(base: int, prime: int, n: int) -> np.ndarray:
    """Powers modulo a prime; those for a block of text are kept."""
    have = _POWERS.get((prime, base))
    if have is None or len(have) < n:
        have = np.ones(max(n, min(BLOCK, 64 * n)) + 1024, np.uint32)
        m = 1
        while m < len(have):
            some = have[m : 2 * m]
            some[:] = have[: len(some)] * U(pow(base, m, prime)) % U(prime)
            m *= 2
        if len(have) <= BLOCK + 2048:
            _POWERS[prime, base] = have
    return have[:n]


def powers_at(base: int, prime: int, places: np.ndarray) -> np.ndarray:
    """Powers at some places, as products of two from small tables."""
    if not len(places):
        return np.zeros(0, U)
    low, high = powers_mod(base, prime, 1024), powers_mod(pow(base, 1024, prime), prime, (int(places.max()) >> 10) + 1)
    return low[places & 1023] * high[places >> 10].astype(U) % U(prime)


class Spans:
    """Hashes of parts of ``data``: polynomials modulo the two primes of a family, their values and the length mixed to 64 bits."""

    def __init__(self, data: np.ndarray, family: int = 0):
        self.family, self.sums = FAMILIES[family], []
        n = len(data)
        for prime, base in self.family:
            terms = np.multiply(data, powers_mod(base, prime, n), dtype=U)
            if n > 1 << 24:  # else sums of products stay under 2^64
                terms %= U(prime)
            h = np.zeros(n + 1, U)
            np.cumsum(terms, dtype=U, out=h[1:])
            self.sums.append(h)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start), U)
        for (prime, base), h in zip(self.family, self.sums, strict=True):
            out = (out << U(31)) | (h[end] - h[start]) % U(prime) * powers_at(pow(base, -1, prime), prime, start) % U(prime)
        return mix(out + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def equal_groups(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of parts with equal bytes, in the order of ``key`` (any hash of the bytes): the first part of each group, and the group of each part.
    The bytes decide: parts that share a key and differ are groups of their own."""
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    rep, n = first[which], end - start
    same = n == n[rep]
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))  # eight bytes from each place on
    at = np.flatnonzero(same & (rep != np.arange(len(rep))) & (n > 0))
    for j in range(0, 64, 8):
        if not len(at):
            break
        beyond = np.maximum(0, 8 - (n[at] - j)).astype(U) * U(8)
        same[at[((eight[start[at] + j] ^ eight[start[rep[at]] + j]) << beyond) != 0]] = False
        at = at[n[at] > j + 8]
    for i in at.tolist():
        r = rep[i]
        same[i] &= np.array_equal(data[start[i] + 64 : end[i]], data[start[r] + 64 : end[r]])
    if same.all():
        return first, which
    more: dict[tuple[int, bytes], int] = {}
    firsts, which = first.tolist(), which.copy()
    for i in np.flatnonzero(~same).tolist():
        name = int(which[i]), data[start[i] : end[i]].tobytes()
        if name not in more:
            more[name] = len(firsts)
            firsts.append(i)
        which[i] = more[name]
    first = np.array(firsts)
    order = np.argsort(key[first], kind="stable")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return first[order], back[which]


def raw(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offs, data = arr.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def packed(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    """A binary array over bytes that lie in a row."""
    wide = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offs) - 1, [None, pa.py_buffer(np.ascontiguousarray(offs, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return wide.cast(pa.binary())


def slices(arr: pa.Array, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (one row may be longer)."""
    if not len(arr):
        return
    _, offs = raw(arr)
    lo = 0
    while lo < len(arr):
        hi = int(np.searchsorted(offs, offs[lo] + most, "right")) - 1
        hi = min(max(hi, lo + 1), len(arr))
        yield lo, hi
        lo = hi


class Words:
    """Words of a slice of texts: ``data`` (lower-cased bytes), ``start``/``end`` in it, ``doc`` (row of each word), ``hash`` on request."""

    def __init__(self, arr: pa.Array):
        data, offs = raw(arr)
        self.rows, self.offs, self.original = len(arr), offs, data
        self._spans: Spans | None = None
        self.data = _LOWER[data]
        n = len(data)
        inside = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:n]
        end[:-1] &= ~inside[1:] | edge[1:n]
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(end) + 1
        self.doc = np.searchsorted(offs, self.start, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(self.rows + 1))  # words of row i: first[i]:first[i+1]
        self._hash: np.ndarray | None = None

    @property
    def hash(self) -> np.ndarray:
        """Hashes of the words, made when they are first asked for."""
        if self._hash is None:
            self._hash = (self._spans or Spans(self.data))(self.start, self.end)
        return self._hash

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of parts of words, comparable with ``hash``."""
        if self._spans is None:
            self._spans = Spans(self.data)
        return self._spans(start, end)

    def other_hash(self) -> np.ndarray:
        """Hashes of the words by the other family: with ``hash``, some 124 independent bits."""
        return Spans(self.data, 1)(self.start, self.end)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def windows(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` words in a row within one text, and the index of each one's first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    out = np.zeros(n, U)
    for j in range(k):
        out = out * U(0x9FB21C651E98DF25) + h[j : j + n]
    at = np.flatnonzero(doc[:n] == doc[k - 1 : k - 1 + n])
    return mix(out[at] + U(k)), at


def _shingles(w: Words, word: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the row of each."""
    h, at = windows(word, w.doc, k)
    doc = w.doc[at]
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = np.zeros(len(short), U)
        for j in range(k - 1):
            has = np.flatnonzero(count[short] > j)
            extra[has] = extra[has] * U(0x9FB21C651E98DF25) + word[w.first[short[has]] + j]
        h = np.concatenate([h, mix(extra + U(k) + count[short].astype(U) * U(0xA24BAED4963EE407))])
        doc = np.concatenate([doc, short])
    return h, doc


def shingle_sets(w: Words, k: int, *, other: bool = False) -> tuple[np.ndarray, ...]:
    """Per row the distinct ``k``-word shingles, sorted: hashes, and where each row's begin; on request also each one's hash by the other
    family. Under ``k`` words, the whole sequence is the one shingle; without words there is none."""
    h, doc = _shingles(w, w.hash, k)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    to = np.searchsorted(doc[new], np.arange(w.rows + 1))
    if not other:
        return h[new], to
    return h[new], to, _shingles(w, w.other_hash(), k)[0][order][new]
