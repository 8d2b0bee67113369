"""Token counts: batch encoding in Arrow functions that return lengths only.

A text's tokens never leave the worker. Batches are cut by bytes, not rows. White space never belongs to a token of a
tokenizer that drops it, so long texts are split there: a text's count is the sum over its white-space separated parts,
and each different part of a batch is encoded once (recurring parts stay in a bounded table). Parts that hold one of the
tokenizer's special strings are handled by the library in the same way, since no such string contains white space.
That splitting is checked on construction (``safe``); a tokenizer for which it does not hold gets whole texts.

Nulls and empty texts have 0 tokens. Other columns pass through; rows are independent, so repeats and ties change nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from evidentia.llm.scratch import small_batches
from evidentia.llm.textnum import Spans, equal_groups, raw, slices

#: Parts kept in the table, bytes of the longest one kept, and bytes of a batch.
PARTS, PART_BYTES, BATCH = 600_000, 64, 4 << 20
#: ASCII white space; cutting at a subset of what the tokenizer drops is always safe.
_CUT = np.zeros(256, bool)
_CUT[[0x20, 0x09, 0x0A, 0x0D]] = True


@functools.lru_cache(maxsize=4)
def lengths_of(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """A function from texts to their numbers of tokens, and whether texts may be split at white space."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)], False
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    count = lambda texts: [len(x) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]
    probes = ["a b", "it's 12 a\n\tb", "Zé 漢字 !? x", "<|endoftext|> a<|endoftext|>b c", "é ́a  b", "a 's t"]
    parts = lambda s: [p for p in s.replace("\t", " ").replace("\n", " ").split(" ") if p]
    return count, all(count([s])[0] == sum(count(parts(s))) for s in probes)


class Counter:
    def __init__(self, path: str):
        self.count, self.safe = lengths_of(path)
        self.known: dict[bytes, int] = {}

    def __call__(self, arr: pa.Array) -> np.ndarray:
        if not self.safe:
            return np.array(self.count(["" if x is None else x for x in arr.to_pylist()]), np.int64)
        data, offs = raw(arr)
        n = len(data)
        inside = ~_CUT[data]
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:n]
        end[:-1] &= ~inside[1:] | edge[1:n]
        start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
        first, which = equal_groups(data, start, end, Spans(data)(start, end))
        whole, known = data.tobytes(), self.known
        parts = [whole[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        got = list(map(known.get, parts))
        missing = [i for i, x in enumerate(got) if x is None]
        if len(known) + len(missing) > PARTS:
            known.clear()
        for lo in range(0, len(missing), 20_000):
            some = missing[lo : lo + 20_000]
            for i, c in zip(some, self.count([parts[i].decode("utf-8") for i in some]), strict=True):
                got[i] = c
                if len(parts[i]) <= PART_BYTES:
                    known[parts[i]] = c
        sums = np.append(0, np.cumsum(np.array(got, np.int64)[which] if len(parts) else np.zeros(0, np.int64)))
        return np.diff(sums[np.searchsorted(start, offs)])


@functools.lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(df: DataFrame, text_col: str, path: str, *, n_col: str = "n_tokens", bytes_col: str = "n_bytes") -> DataFrame:
    """Add each text's length in UTF-8 bytes and in tokens of the tokenizer at ``path`` (``.json`` or ``.model``), without
    the text itself: one Arrow pass, no shuffle. Columns of these names are replaced."""
    small_batches(df.sparkSession)
    kept = [f for f in df.schema if f.name not in (text_col, n_col, bytes_col)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{bytes_col}` long", f"`{n_col}` long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for batch in batches:
            texts = batch.column(text_col)
            n = [counts(texts.slice(lo, hi - lo)) for lo, hi in slices(texts, BATCH)]
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            cols = [*(batch.column(f.name) for f in kept), pa.array(np.diff(raw(texts)[1]), pa.int64()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*(f.name for f in kept), bytes_col, n_col])

    return df.mapInArrow(run, schema)
