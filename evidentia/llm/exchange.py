"""Chunks of texts in a shared folder, and exchange of packed keys between them.

Operators that need corpus-wide counts of very many keys (shingles, substrings, words) do not shuffle a row for each key.
Texts are cut into chunks of some megabytes, written once, compressed, to a shared folder. A chunk sends each range of keys one packed row
(its sorted different keys and their numbers); the range's task adds up and answers with one packed row of the same order. Texts
are never shuffled again: later passes read chunks by path and offset. A key with a third of all rows is one entry per chunk, so no key is hot.
Memory is one chunk, or one range's keys: the number of ranges follows from the number of keys.

A row's number, ``chunk << ROW_BITS | idx``, is its own: chunks are numbered by the task that writes them and their place in it.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.scratch import Scratch, open_folder, unused
from evidentia.llm.textnum import U, give_back

#: Bytes of text in a chunk (one text may be longer), and keys in a range.
CHUNK_BYTES, RANGE_KEYS = 2 << 20, 1_000_000
#: Bits of a row's place in its chunk, and of a chunk's place in its task.
ROW_BITS, CHUNK_BITS = 20, 20
POINTER = "chunk long, folder string, file string, offset long, length long"
KEYS = "r int, chunk long, keys binary, counts binary"


def row_number() -> Column:
    return F.shiftleft("chunk", ROW_BITS).bitwiseOR(F.col("idx").cast("long"))


def size_column(columns: list[str]) -> str:
    """The name of the column of sizes in chunks of a table with these columns."""
    return unused("_bytes", columns)


def store_chunks(df: DataFrame, text_col: str, scratch: Scratch, extra: str = "", describe: Callable[[pa.Table], list[pa.Array]] | None = None) -> DataFrame:
    """Write the rows of ``df`` as chunks and return, as a table, for each row its chunk's pointer, its place in it (``idx``), its
    length in bytes and the columns ``extra`` that ``describe`` computes from the chunk."""
    folder = scratch.path("chunks")
    names = [c.strip().split(" ")[0] for c in extra.split(",") if c.strip()]
    size_col = size_column(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, file, held, size, rows, chunk = None, f"{uuid.uuid4().hex}.chunks", [], 0, 0, TaskContext.get().partitionId() << CHUNK_BITS

        def flush() -> pa.RecordBatch:
            nonlocal out, held, size, rows, chunk
            part = pa.Table.from_batches(held).combine_chunks()
            held, size, rows = [], 0, 0
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(part)
            blob = sink.getvalue()
            if out is None:
                filesystem, path = open_folder(folder)
                out = filesystem.open_output_stream(f"{path}/{file}", compression=None)
            at = out.tell()
            out.write(blob)
            n = part.num_rows
            cols = [pa.array(np.full(n, chunk)), pa.array([folder] * n, pa.string()), pa.array([file] * n, pa.string()), pa.array(np.full(n, at)), pa.array(np.full(n, len(blob)))]
            cols += [pa.array(np.arange(n, dtype=np.int32)), part.column(size_col).combine_chunks(), *(describe(part) if describe else [])]
            chunk += 1
            if chunk & (1 << CHUNK_BITS) - 1 == 0:
                raise OverflowError("a task writes too many chunks: use more, smaller input partitions")
            give_back()
            return pa.RecordBatch.from_arrays(cols, names=["chunk", "folder", "file", "offset", "length", "idx", "n_bytes", *names])

        try:
            for batch in batches:
                ends = np.cumsum(batch.column(size_col).to_numpy())
                lo = 0
                while lo < batch.num_rows:
                    hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK_BYTES - size, "right")))
                    hi = min(hi, lo + (1 << ROW_BITS) - rows)
                    held.append(batch.slice(lo, hi - lo))
                    rows += hi - lo
                    size += int(ends[hi - 1] - (ends[lo - 1] if lo else 0))
                    lo = hi
                    if size >= CHUNK_BYTES * 0.9 or rows == 1 << ROW_BITS:
                        yield flush()
            if held:
                yield flush()
        finally:
            if out is not None:
                out.close()

    src = df.withColumn(size_col, F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long"))
    return scratch.keep(src.mapInArrow(run, f"{POINTER}, idx int, n_bytes long{', ' + extra if extra else ''}"), "rows")


class Chunks:
    """The pointers of the chunks of a table of rows, and functions over chunks. Pointers are few bytes, the chunks behind them are not: so the number
    of tasks follows from the number of chunks, and adaptive coalescing, which sees only the pointers, has no say."""

    def __init__(self, rows: DataFrame, scratch: Scratch):
        found = rows.groupBy("chunk").agg(*(F.first(c).alias(c) for c in ("folder", "file", "offset", "length")))
        self.df = scratch.keep(found, "pointers")
        self.tasks = max(1, -(-self.df.count() // 3))

    def each(self, f: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
        return self.df.repartition(self.tasks, "chunk").groupBy("chunk").applyInArrow(lambda p: _trimmed(f, p), schema)

    def with_replies(self, replies: DataFrame, f: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        """``f(pointer, replies)`` for each chunk."""
        left, right = (df.repartition(self.tasks, "chunk").groupBy("chunk") for df in (self.df, replies))
        return left.cogroup(right).applyInArrow(lambda p, r: _trimmed(f, p, r), schema)


def _trimmed(f: Callable[..., pa.Table], *args: pa.Table) -> pa.Table:
    out = f(*args)
    give_back()
    return out


def by_range(sent: DataFrame, ranges: int):
    return sent.repartition(ranges, "r").groupBy("r")


@functools.lru_cache(maxsize=8)
def _handle(folder: str, file: str):
    filesystem, path = open_folder(folder)
    return filesystem.open_input_file(f"{path}/{file}")


def load(pointer: pa.Table) -> pa.Table:
    """The chunk that a one-row table of pointers names."""
    p = pointer.slice(0, 1).to_pylist()[0]
    return pa.ipc.open_stream(_handle(p["folder"], p["file"]).read_at(p["length"], p["offset"])).read_all().combine_chunks()


def ranges_for(n_keys: int) -> int:
    return max(8, -(-n_keys // RANGE_KEYS))


def bounds(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins in sorted keys."""
    edges = np.array([(r << 64) // ranges for r in range(ranges)], U)
    return np.append(np.searchsorted(keys, edges), len(keys))


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and their numbers up to 255."""
    keys, n = np.unique(keys, return_counts=True)
    return keys, np.minimum(n, 255).astype(np.uint8)


def to_rows(chunk: int, keys: np.ndarray, counts: np.ndarray, ranges: int) -> pa.Table:
    b = bounds(keys, ranges)
    full = [r for r in range(ranges) if b[r + 1] > b[r]]
    return pa.table({
        "r": pa.array(full, pa.int32()), "chunk": pa.array([chunk] * len(full), pa.int64()),
        "keys": pa.array([keys[b[r] : b[r + 1]].tobytes() for r in full], pa.binary()),
        "counts": pa.array([counts[b[r] : b[r + 1]].tobytes() for r in full], pa.binary()),
    })


def total(sent: DataFrame, ranges: int) -> DataFrame:
    """Answer each packed row of keys with the keys' total numbers, up to 255: (chunk, r, counts)."""

    def add(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(k, U) for k in table.column("keys").to_pylist()]
        keys = np.concatenate(parts)
        n = np.concatenate([np.frombuffer(c, np.uint8) for c in table.column("counts").to_pylist()])
        _, which = np.unique(keys, return_inverse=True)
        sums = np.minimum(np.bincount(which, n), 255).astype(np.uint8)[which]
        ends = np.append(0, np.cumsum([len(p) for p in parts]))
        return pa.table({"chunk": table.column("chunk"), "r": table.column("r"), "counts": pa.array([sums[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())})

    return by_range(sent, ranges).applyInArrow(lambda t: _trimmed(add, t), "chunk long, r int, counts binary")


def answer(replies: pa.Table, dtype=np.uint8, col: str = "counts") -> np.ndarray:
    """The replies to a chunk, in the order of its sorted keys."""
    if not replies.num_rows:
        return np.zeros(0, dtype)
    order = np.argsort(replies.column("r").to_numpy())
    got = replies.column(col).to_pylist()
    return np.concatenate([np.frombuffer(got[i], dtype) for i in order])
