"""Media columns: content-addressed payloads in tar shards; rows carry digest, offset and length.

Writing: each task appends its payloads, stored losslessly as 8-bit greyscale PNG, to one tar shard in a shared folder and
returns an index row (digest of the payload, shard, offset, length) for each different payload it met. The index is written as
a table, so after a lost executor only shards named by committed rows are ever read. Equal payloads from different tasks
agree on their digest, and one location is kept for each.

Reading: header-only range reads (the first 33 bytes: signature and IHDR) fill metadata columns; full range reads give the
stored bytes for features. Rows of one shard are read together, in offset order.

Nulls are empty texts, which are one padded block. Repeated texts share digest and location. Empty tables give empty results.
Other columns are kept, but for the text and those named like new ones. A payload, however long, is held whole in one task while it is written or read.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.scratch import Scratch, open_folder, unused

#: Payloads are padded with byte 255 to a positive multiple of WIDTH, the row length of the stored images.
WIDTH = 576
#: Bytes of a shard that are read together, and stored bytes for each task that reads.
RUN_BYTES, READ_BYTES = 4 << 20, 32 << 20
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
HEADER_BYTES = 33
INDEX = "digest binary, shard string, offset long, length long"
_HEADER = [("width", "int"), ("height", "int"), ("bit_depth", "int")]
_READ = [("payload_bytes", "long"), ("payload_sha256", "string"), ("tail_crc32", "long"), ("media_sha256", "string"), ("feature", "string")]
#: All columns that ``media_columns`` adds.
ADDED = ["n_bytes", "digest", "shard", "offset", "length", *(n for n, _ in _HEADER + _READ)]


def payload(text: Column) -> Column:
    """The text as UTF-8 with its padding; null is empty."""
    data = F.encode(F.coalesce(text, F.lit("")), "utf-8")
    n = F.octet_length(data)
    pad = F.when(n == 0, F.lit(WIDTH)).otherwise(F.pmod(-n, F.lit(WIDTH)))
    return F.concat(data, F.substring(F.unhex(F.lit("FF" * WIDTH)), F.lit(1), pad))


def to_png(data: bytes) -> bytes:
    """8-bit greyscale samples, WIDTH to a row, filter type 0."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    filtered = np.zeros((len(rows), WIDTH + 1), np.uint8)
    filtered[:, 1:] = rows

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(filtered, 6)) + chunk(b"IEND", b"")


def png_header(first: bytes) -> tuple[int, int, int]:
    """Width, height and bit depth from the first bytes."""
    if first[:8] != _SIGNATURE or first[12:16] != b"IHDR":
        raise ValueError("not a stored image")
    return struct.unpack(">IIB", first[16:25])


def from_png(stored: bytes) -> bytes:
    """The samples again; image data may be split over several chunks."""
    width, height, _ = png_header(stored[:HEADER_BYTES])
    at, parts = 8, []
    while at < len(stored):
        n = struct.unpack(">I", stored[at : at + 4])[0]
        if stored[at + 4 : at + 8] == b"IDAT":
            parts.append(stored[at + 8 : at + 8 + n])
        at += n + 12
    rows = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, width + 1)
    return rows[:, 1:].tobytes()


def features(samples: bytes) -> str:
    """Mean, deviation, entropy and mean step between neighbouring samples, as fixed decimals."""
    x = np.frombuffer(samples, np.uint8)
    p = np.bincount(x, minlength=256) / len(x)
    p = p[p > 0]
    step = np.abs(np.diff(x.astype(np.int16))).mean()
    return f"w={WIDTH};h={len(x) // WIDTH};mean={x.mean():.4f};sd={x.std():.4f};entropy={-(p * np.log2(p)).sum():.4f};step={step:.4f}"


def store(df: DataFrame, payload_col: str, scratch: Scratch) -> DataFrame:
    """Write each different payload and return the index, one location for each digest."""
    folder = scratch.path("shards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        out = tar = None
        name = f"shard-{uuid.uuid4().hex}.tar"
        try:
            for batch in batches:
                rows = []
                for value in batch.column(0):
                    data = value.as_buffer()
                    digest = hashlib.sha256(data).digest()
                    if digest in done:
                        continue
                    if len(done) >= 1_000_000:
                        done.clear()
                    done.add(digest)
                    if tar is None:
                        filesystem, path = open_folder(folder)
                        out = filesystem.open_output_stream(f"{path}/{name}", compression=None)
                        tar = tarfile.open(fileobj=out, mode="w|")
                    png = to_png(data)
                    info = tarfile.TarInfo(digest.hex() + ".png")
                    info.size = len(png)
                    at = tar.offset + 512
                    tar.addfile(info, pa.BufferReader(png))
                    tar.members.clear()  # else each header stays in memory until the shard ends
                    rows.append((digest, at, len(png)))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([f"{folder}/{name}"] * len(rows), pa.string()), *(pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2))], names=["digest", "shard", "offset", "length"])
        finally:
            if tar is not None:
                tar.close()
                out.close()

    index = scratch.keep(df.select(F.col(payload_col).alias("payload")).mapInArrow(run, INDEX), "index")
    return index.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at")).select("digest", "at.*")


def _ranges(df: DataFrame, tasks: int, fields: list[tuple[str, str]], length: int | None, make) -> DataFrame:
    """Read each row's byte range (its first ``length`` bytes, or all) and add the columns that ``make`` gives."""
    kept = df.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *(f"`{n}` {t}" for n, t in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, handle = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                got = []
                for shard, at, n in zip(*(part.column(c).to_pylist() for c in ("shard", "offset", "length")), strict=True):
                    if shard != name:
                        folder, _, file = shard.rpartition("/")
                        filesystem, path = open_folder(folder)
                        name, handle = shard, filesystem.open_input_file(f"{path}/{file}")
                    got.append(make(handle.read_at(n if length is None else min(n, length), at)))
                cols = [pa.array([g[i] for g in got], {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[t]) for i, (_, t) in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *cols], names=[*kept, *(n for n, _ in fields)])

    # index rows are small, but not what they point to: the number of tasks follows from that
    return df.repartition(tasks, "shard", F.floor(F.col("offset") / RUN_BYTES)).sortWithinPartitions("shard", "offset").mapInArrow(run, schema)


def read_tasks(index: DataFrame) -> int:
    return max(1, -(-int(index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]) // READ_BYTES))


def metadata(index: DataFrame, tasks: int) -> DataFrame:
    """Width, height and bit depth by header-only range reads."""
    return _ranges(index, tasks, _HEADER, HEADER_BYTES, png_header)


def read_back(index: DataFrame, tasks: int) -> DataFrame:
    """Read and decode each stored payload once; add its digests, sizes and features."""

    def make(stored: bytes) -> tuple:
        samples = from_png(stored)
        return len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), hashlib.sha256(stored).hexdigest(), features(samples)

    return _ranges(index, tasks, _READ, None, make)


def media_columns(df: DataFrame, text_col: str, scratch: Scratch, *, id_col: str) -> DataFrame:
    """``df`` without its text, and with unpadded bytes, digest and the columns of the stored form (``ADDED``). Texts are read once and never
    shuffled: only the other columns and digests meet the read-back rows. That join is on the digest; Spark splits a digest with very many rows."""
    own = {c.lower() for c in ADDED}
    if id_col.lower() in own:
        raise ValueError(f"the id column cannot be named {id_col!r}: a new column has that name")
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in own and c != text_col]
    body = unused("_payload", df.columns)
    src = df.select(*kept, F.octet_length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("long").alias("n_bytes"), payload(F.col(f"`{text_col}`")).alias(body))
    index = store(src, body, scratch)
    tasks = read_tasks(index)
    found = scratch.keep(read_back(metadata(index, tasks), tasks), "read")
    return src.select(*kept, "n_bytes", F.unhex(F.sha2(body, 256)).alias("digest")).join(found, "digest")
