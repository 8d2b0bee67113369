"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence, with size-derived bounds.

Sets are the different K-word shingles of a text (see ``textnum``). Two texts link at 100 |A & B| >= PERCENT |A | B|. Copies with one set are one
class. Bounds on what can link, none of which loses a pair:

1. Of sets that link, each holds PERCENT % of the other's size, so the smallest hashes of both must share a known number (``lead``). Packed counts of these
   leading shingles over all classes leave only classes with enough shared ones.
2. For those the incidence is spread out, shingles that one class has alone drop out (they only count as differences), and the others are ordered by how
   many classes have them. Linked sets share a shingle among the first |A| - ceil(PERCENT |A| / 100) + 1 of each: these are the blocks.
3. Products are taken block by block of rows against columns, accumulating overlap counts. A first round multiplies each class with one pivot of each of its
   blocks, and components are formed. Then only pairs of one block in different components remain, within the bounds on size and position; they are multiplied
   too, so every link between components is found, and no pair within a component is looked at again.

Result: one row for each input row with its set size and the smallest id that links reach. Nulls, empty texts and texts without words have no set and
are alone; repeated rows are one class. Empty tables give empty tables. Rows with a null id take part; ids of components are the smallest non-null ones.
Hot pivots are salted by the members of their rows' sets, so a very long text is a tile of its own. Equal sets are known by some 124 bits of
independent hashes, a class is named by the number of one of its rows, and members of two sets are compared by 62-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm import exchange as ex
from evidentia.llm.scratch import Scratch
from evidentia.llm.textnum import U, Words, mix, shingle_sets

K, PERCENT = 3, 90
#: Rows that are multiplied with one pivot in one group, and members of their sets (one row may have more).
TILE_ROWS, TILE = 128, 1 << 18


def lead(n: np.ndarray) -> np.ndarray:
    """How many shared leading shingles a set of size n is asked for."""
    return np.maximum(1, n // 5)


def at_least(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-n * percent // 100)


def set_keys(h: np.ndarray, to: np.ndarray) -> np.ndarray:
    """A hash of each set: sum of its mixed members' hashes, and its size."""
    sums = np.append(U(0), np.cumsum(mix(h ^ U(0xA5A5A5A5)), dtype=U))
    return mix(sums[to[1:]] - sums[to[:-1]] + np.diff(to).astype(U) * U(0x9E3779B97F4A7C15)).view(np.int64)


def _sets(part: pa.Table, text_col: str, k: int, *, other: bool = False) -> tuple[np.ndarray, ...]:
    column = part.column(text_col)
    return shingle_sets(Words(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column), k, other=other)


def _leading(h: np.ndarray, to: np.ndarray, rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the leading shingles of the chosen rows, and where each row's begin."""
    n = to[rows + 1] - to[rows]
    m = np.minimum(n, n - at_least(n, percent) + lead(n))
    ends = np.append(0, np.cumsum(m))
    return np.repeat(to[rows] - ends[:-1], m) + np.arange(ends[-1]), ends


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, component) of the nodes that have links (a, b): the smallest label spreads, and labels are followed to their own."""
    both = scratch.keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), label)
    comp = scratch.keep(both.groupBy("a").agg(F.least("a", F.min("b")).alias("c")).withColumnRenamed("a", "node"), label)
    while True:
        near = both.join(comp, both.b == comp.node).groupBy("a").agg(F.min("c").alias("m"))
        step = comp.join(near, comp.node == near.a, "left").select("node", F.col("c").alias("old"), F.least("c", F.coalesce("m", "c")).alias("c"))
        step = scratch.keep(step, label)
        up = step.select(F.col("node").alias("n2"), F.col("c").alias("c2"))
        jumped = scratch.keep(step.join(up, step.c == up.n2, "left").select("node", "old", F.least("c", F.coalesce("c2", "c")).alias("c")), label)
        changed = jumped.filter("old <> c").limit(1).count()
        comp = jumped.drop("old")
        if not changed:
            return comp


def _multiply(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among candidate pairs (a, b, na: the size of a's set): for each column b in tiles of rows, overlap counts in one sparse product."""
    tiles = pairs.groupBy("b").agg(F.greatest(F.ceil(F.count("*") / TILE_ROWS), F.ceil(F.sum("na") / TILE)).cast("int").alias("tiles"))
    rows = pairs.join(tiles, "b").select("a", "b", "na", F.pmod(F.xxhash64("a", "b"), F.col("tiles")).cast("int").alias("tile"))
    rows = rows.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
    cols = tiles.join(sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb")), "b").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    cols = cols.select(F.col("b").alias("b2"), F.col("tile").alias("tile2"), "nb", "tb")

    def product(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        tokens = left.column("ta").combine_chunks()
        column = np.sort(right.column("tb").combine_chunks().flatten().to_numpy())
        flat, to = tokens.flatten().to_numpy(), np.append(0, np.cumsum(tokens.value_lengths().to_numpy()))
        at = np.minimum(np.searchsorted(column, flat), len(column) - 1)
        hits = np.append(0, np.cumsum(column[at] == flat))
        overlap = hits[to[1:]] - hits[to[:-1]]
        na, nb = left.column("na").to_numpy(), int(right.column("nb")[0].as_py())
        ok = overlap * 100 >= percent * (na + nb - overlap)
        return left.select(["a", "b"]).filter(pa.array(ok))

    return rows.groupBy("b", "tile").cogroup(cols.groupBy("b2", "tile2")).applyInArrow(product, "a long, b long")


def _classes(src: DataFrame, id_col: str, text_col: str, scratch: Scratch, k: int, percent: int) -> tuple[ex.Chunks, DataFrame]:
    """The chunks, and for each row (chunk, idx): id, n, the component and its smallest id."""
    id_type = src.schema[id_col].dataType.simpleString()

    def describe(part: pa.Table) -> list[pa.Array]:
        h, to, other = _sets(part, text_col, k, other=True)
        return [part.column(id_col).combine_chunks(), pa.array(set_keys(h, to)), pa.array(set_keys(other, to)), pa.array(np.diff(to).astype(np.int64))]

    rows = ex.store_chunks(src, text_col, scratch, f"id {id_type}, sh long, sh2 long, n long", describe)
    full = rows.filter("n > 0")
    reps = full.groupBy("sh", "sh2").agg(F.min(ex.row_number()).alias("node"), F.min("id").alias("least"), F.max("n").alias("n"))
    reps = scratch.keep(reps, "classes")
    chunks = ex.Chunks(rows, scratch)
    total_n = int(reps.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    ranges = ex.ranges_for(total_n * 3 // 10)
    mine = reps.select(F.shiftright("node", ex.ROW_BITS).alias("chunk"), F.col("node").bitwiseAND((1 << ex.ROW_BITS) - 1).cast("int").alias("idx"))

    def leading(pointer: pa.Table, own: pa.Table) -> pa.Table:
        if not own.num_rows:
            return ex.to_rows(0, np.zeros(0, U), np.zeros(0, np.uint8), ranges)
        part = ex.load(pointer).take(pa.array(np.sort(own.column("idx").to_numpy())))
        h, to = _sets(part, text_col, k)
        at, _ = _leading(h, to, np.arange(part.num_rows), percent)  # the smallest hashes: mixed again, keys spread over all ranges
        return ex.to_rows(pointer.column("chunk")[0].as_py(), *ex.counted(mix(h[at] + U(1))), ranges)

    sent = chunks.with_replies(mine, leading, ex.KEYS)
    replies = scratch.keep(ex.total(sent, ranges), "shared")
    both = mine.select("chunk", "idx", F.lit(None).cast("int").alias("r"), F.lit(None).cast("binary").alias("counts")).unionByName(replies.select("chunk", F.lit(None).cast("int").alias("idx"), "r", "counts"))

    def survivors(pointer: pa.Table, got: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        own = got.filter(pc.is_valid(got.column("idx")))
        reply = got.filter(pc.is_valid(got.column("r")))
        idx = np.sort(own.column("idx").to_numpy())
        part = ex.load(pointer).take(pa.array(idx))
        h, to = _sets(part, text_col, k)
        rows = np.arange(part.num_rows)
        at, ends = _leading(h, to, rows, percent)
        sent_keys = mix(h[at] + U(1))
        keys = np.unique(sent_keys)
        shared = np.append(0, np.cumsum(ex.answer(reply)[np.searchsorted(keys, sent_keys)] >= 2)) if len(at) else np.zeros(1, np.int64)
        n = np.diff(to)
        keep = rows[shared[ends[1:]] - shared[ends[:-1]] >= lead(at_least(n, percent))]
        tokens = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n[keep])), pa.int32()), pa.array(np.concatenate([h[to[i] : to[i + 1]] for i in keep]).view(np.int64) if len(keep) else np.zeros(0, np.int64)))
        nodes = pointer.column("chunk")[0].as_py() << ex.ROW_BITS | idx[keep].astype(np.int64)
        return pa.table({"node": pa.array(nodes), "n": pa.array(n[keep].astype(np.int64)), "tokens": tokens})

    sets = scratch.keep(chunks.with_replies(both, survivors, "node long, n long, tokens array<long>"), "sets")
    spread = sets.select("node", "n", F.explode("tokens").alias("t"))
    # sides of joins on a shingle are written first: only joins of plain tables are split by Spark where a shingle has very many rows
    df_of = scratch.keep(spread.groupBy("t").agg(F.count("*").alias("df")).filter("df > 1"), "frequencies")
    prefix = spread.join(df_of, "t").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("common"))
    alone = F.col("n") - F.size("common")
    room = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - alone
    prefix = prefix.select("node", "n", alone.alias("alone"), F.posexplode(F.slice("common", F.lit(1), F.greatest(F.lit(0), room).cast("int"))).alias("i", "c"))
    blocks = scratch.keep(prefix.select("node", "n", F.col("c.t").alias("t"), (F.col("alone") + F.col("i")).alias("pos")), "blocks")

    size_ok = F.least("n", "n2") * 100 >= percent * F.greatest("n", "n2")
    pivots = blocks.groupBy("t").agg(F.min(F.struct("pos", "node", "n")).alias("p"), F.count("*").alias("members")).filter("members > 1").select("t", F.col("p.node").alias("node2"), F.col("p.n").alias("n2"))
    pivots = scratch.keep(pivots, "pivots")
    first = blocks.join(pivots, "t").filter((F.col("node") != F.col("node2")) & size_ok).select(F.col("node").alias("a"), F.col("node2").alias("b"), F.col("n").alias("na")).distinct()
    links = scratch.keep(_multiply(scratch.keep(first, "first"), sets, percent), "links")
    comp = components(links, scratch, "components")

    labelled = scratch.keep(blocks.join(comp, "node", "left").select("t", "node", "n", "pos", F.coalesce("c", "node").alias("c")), "labelled")
    mixed = scratch.keep(labelled.groupBy("t").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("t"), "mixed-blocks")
    left = scratch.keep(labelled.join(mixed, "t"), "mixed")
    right = left.select("t", F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("c").alias("c2"))
    # with i and j members before the first one in common, at most min(n - i, m - j) can be shared
    most = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    bound = most * 100 >= percent * (F.col("n") + F.col("n2") - most)
    rest = left.join(right, "t").filter((F.col("c") < F.col("c2")) & size_ok & bound).select(F.col("node").alias("a"), F.col("node2").alias("b"), F.col("n").alias("na")).distinct()
    more = scratch.keep(_multiply(scratch.keep(rest, "rest"), sets, percent), "links")
    final = components(links.unionByName(more), scratch, "final")

    named = reps.join(final, "node", "left").select("sh", "sh2", "least", F.coalesce("c", "node").alias("c"))
    smallest = named.groupBy("c").agg(F.min("least").alias("component_id"))
    named = scratch.keep(named.join(smallest, "c").select("sh", "sh2", "component_id", F.col("c").alias("component")), "named")
    mine = ["chunk", "idx", "id", "n"]
    out = full.join(named, ["sh", "sh2"], "left").select(*mine, "component", "component_id")
    return chunks, out.unionByName(rows.filter("n = 0").select(*mine, F.lit(None).cast("long").alias("component"), F.col("id").alias("component_id")))


def classes(df: DataFrame, id_col: str, text_col: str, scratch: Scratch, *, k: int = K, percent: int = PERCENT) -> DataFrame:
    """Rows of ``id_col``, ``n_shingles``, ``component_id``."""
    _, rows = _classes(df.select(id_col, text_col), id_col, text_col, scratch, k, percent)
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def deduplicate(df: DataFrame, id_col: str, text_col: str, scratch: Scratch, *, k: int, percent: int) -> DataFrame:
    """The rows of ``df`` less all but one of each component: the one with the smallest id. Rows without words all stay.
    The rows come out of the stored chunks, so texts are neither shuffled nor joined."""
    chunks, rows = _classes(df, id_col, text_col, scratch, k, percent)
    size_col = ex.size_column(df.columns)
    grouped = rows.filter("component is not null")
    # null ids come last
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "chunk", "idx")).alias("first")
    kept = grouped.groupBy("component").agg(first).select("first.chunk", "first.idx").unionByName(rows.filter("component is null").select("chunk", "idx"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def take(pointer: pa.Table, own: pa.Table) -> pa.Table:
        part = ex.load(pointer).drop_columns([size_col])
        return part.take(pa.array(np.sort(own.column("idx").to_numpy()))) if own.num_rows else part.slice(0, 0)

    return chunks.with_replies(scratch.keep(kept, "kept"), take, schema)
