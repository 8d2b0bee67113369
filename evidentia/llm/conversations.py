"""Conversation structure repair: the cheapest edits that make the roles of a conversation follow a grammar.

The grammar is ``(s?(ua)+)?`` over the initials of roles. A backward pass gives each row its cost to go by grammar state; a forward walk takes, among the edits that keep
to that cost, the one whose initial comes first in ASCII (Delete, Insert, Keep, Rerole), and turns are built anew on the way.

Both passes are streams over sorted rows: a task holds one batch of rows and the costs of one row, however long a conversation is (its audit grows by a letter for each
row, and its hash is sequential by nature; no group is collected). The backward pass sees no texts: rows equal in turn, role and text are counted first, before the shuffle, and
a text is known by its SHA-256, so what repeats thousands of times is one row. Duplicates are told by a join on (conversation, role, text) with the first turn of each, whose hot keys
Spark can split. Texts are shuffled once, for the walk. Everything ends in rows; a lost executor costs its tasks.

Defined cases: null roles and texts are one space; null turns come first; null ids are a conversation of their own. Rows of one turn go by role, then by the text's SHA-256, and
equal rows are repeats: all but the first are duplicates. A role that is empty or has another initial cannot be kept. An empty table gives an empty result. Other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.scratch import small_batches

#: Costs of edits, and of keeping or re-assigning a truncated row.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a. Where an initial leads, which state a user's or assistant's turn leads to (the only one that fits), and costs at the end.
START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
AT_END = (0, 2 * INSERT, INSERT, 0)
LEGAL = {"su", "ua", "au"}
#: Rows and bytes of a batch that goes back to Spark.
OUT_ROWS, OUT_BYTES = 8192, 2 << 20


def damaged(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows with faults: by the CRC-32 of ``conv:turn`` modulo 20, a row goes, loses its text or its sentence ends, comes twice, or gets the role of a user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    n = F.crc32(F.concat_ws(":", space(conv), space(turn))) % 20
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.when(n == 4, "user").otherwise(space(role)).alias("role"), F.when(n == 1, "").when(n == 2, F.regexp_replace(space(text), "[.!?]", "")).otherwise(space(text)).alias("text"), n.alias("n"))
    return rows.filter("n <> 0").withColumn("n", F.explode(F.when(F.col("n") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("n")


def faults(text: Column) -> tuple[Column, Column]:
    """Blank: nothing but white space. Truncated: the last other character ends no sentence."""
    ink = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return ink == "", ~F.substring(ink, -1, 1).isin(".", "!", "?")


def cells(rows: DataFrame) -> DataFrame:
    """Different rows (conv, turn, role, h) with their number, and whether they are blank, truncated or seen in an earlier turn."""
    blank, truncated = faults(F.col("text"))
    one = rows.select("conv", "turn", "role", F.unhex(F.sha2("text", 256)).alias("h"), blank.alias("blank"), truncated.alias("truncated"))
    one = one.groupBy("conv", "turn", "role", "h", "blank", "truncated").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("turn").isNotNull().alias("k"), F.coalesce("turn", F.lit(0)).alias("t"))
    first = one.groupBy(F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("h").alias("_h")).agg(F.min(order).alias("_first"))
    both = one.join(first, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("h") == F.col("_h")))
    return both.select("conv", "turn", "role", "h", "copies", "blank", "truncated", (F.col("_first") < order).alias("again"))


def closed(cost: list[int]) -> list[int]:
    """Costs by state if turns may be inserted first (two at most, more come back to the same state)."""
    one = [min(cost[s], INSERT + cost[NEXT[s]]) for s in range(4)]
    return [min(one[s], INSERT + one[NEXT[s]]) for s in range(4)]


def row_costs(initial: str, truncated: bool, after: list[int]) -> list[int]:
    """Cost to go by state before a row that need not be deleted, from the costs after it."""
    more, kept = TRUNCATED * truncated, KEPT.get(initial, {})
    own = [min(DELETE + after[s], REROLE + more + after[NEXT[s]]) for s in range(4)]
    return closed([min(own[s], more + after[kept[s]]) if s in kept else own[s] for s in range(4)])


def with_costs(cell: DataFrame) -> DataFrame:
    """Adds the costs to go by state: ``before`` the rows of a cell, and ``after`` the first of them."""
    kind = cell.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, turn long, role string, h binary, blank boolean, truncated boolean, again boolean, before array<long>, after array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, costs, begun = None, list(AT_END), False
        for batch in batches:
            t = batch.to_pydict()
            before, after = [], []
            for own, role, copies, blank, truncated, again in zip(t["conv"], t["role"], t["copies"], t["blank"], t["truncated"], t["again"], strict=True):
                if not begun or own != conv:
                    conv, costs, begun = own, list(AT_END), True
                must = copies if blank or again else copies - 1
                costs = [c + DELETE * must for c in costs]
                after.append(costs)
                if must < copies:
                    costs = row_costs(role[:1], truncated, costs)
                before.append(costs)
            columns = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "copies"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.list_(pa.int64())), pa.array(after, pa.list_(pa.int64()))], names=[n.split(" ")[0] for n in schema.split(", ")])

    light = cell.select("conv", "turn", "role", "h", "copies", "blank", "truncated", "again").repartition("conv")
    return light.sortWithinPartitions("conv", F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("h").desc()).mapInArrow(run, schema)


def edit_at(state: int, initial: str, truncated: bool, before: list[int], after: list[int]) -> tuple[str, int]:
    """The edit whose initial comes first among those that keep to the cost to go, and the state it leads to."""
    cost, more = before[state], TRUNCATED * truncated
    if cost == DELETE + after[state]:
        return "D", state
    if cost == INSERT + before[NEXT[state]]:
        return "I", NEXT[state]
    kept = KEPT.get(initial, {})
    if state in kept and cost == more + after[kept[state]]:
        return "K", kept[state]
    return "R", NEXT[state]


SCRIPT = "place long, turn long, edit string, fault string, illegal boolean, cost long, role string, text string"


class _Out:
    """Rows of the edit script, given on in batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, conv, place: int, turn, edit, fault, illegal, cost: int, role, text) -> None:
        self.rows.append((conv, place, turn, edit, fault, illegal, cost, role, text))
        self.size += len(text or "")

    def full(self) -> bool:
        return len(self.rows) >= OUT_ROWS or self.size >= OUT_BYTES

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.size = [], 0


def _stream(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """What the walk needs of each conversation in its order: an opening row, then for each cell its costs, then its texts."""
    small_batches(rows.sparkSession)
    none = lambda *names: [F.lit(None).cast(k).alias(n) for n, k in names]
    costs = with_costs(cells(rows)).withColumn("text", F.lit(None).cast("string")).withColumn("kind", F.lit(1))
    flags = (("blank", "boolean"), ("truncated", "boolean"), ("again", "boolean"), ("before", "array<long>"), ("after", "array<long>"))
    texts = rows.select("conv", "turn", "role", F.unhex(F.sha2("text", 256)).alias("h"), *none(*flags), "text", F.lit(2).alias("kind"))
    opening = ids.select("conv").distinct().select("conv", *none(("turn", "long"), ("role", "string"), ("h", "binary"), *flags, ("text", "string")), F.lit(0).alias("kind"))
    stream = costs.unionByName(texts).unionByName(opening).repartition("conv")
    # the opening row first: it has no role
    return stream.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("h").asc_nulls_first(), "kind")


def repair(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The edit script of each conversation of ``ids`` (column conv) and ``rows``, in order and one conversation after the other within a partition: a row with place 0 and no edit that opens it, then one row for each
    edit, with the fault of the edited row (blank, duplicate, truncated), whether its role's initial may not follow the one before, the edit's cost, and the repaired turn's role and text (null if it goes).
    ``rows``: conv, turn (long), role, text, as ``damaged`` gives them."""
    return _stream(rows, ids).mapInArrow(_walk, f"conv {ids.schema['conv'].dataType.simpleString()}, {SCRIPT}")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, conv, state, place, last, cell, first, begun = None, None, START, 0, None, None, True, False

    def insert(at: int) -> int:
        nonlocal place
        place += 1
        out.add(conv, place, None, "I", None, None, INSERT, NAMES[at], "")
        return at

    def end() -> None:
        s = state
        while s not in (START, ASSISTANT):
            s = insert(NEXT[s])

    for batch in batches:
        if out is None:
            out = _Out(pa.schema([pa.field("conv", batch.schema.field("conv").type), ("place", pa.int64()), ("turn", pa.int64()), ("edit", pa.string()), ("fault", pa.string()), ("illegal", pa.bool_()), ("cost", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
        t = batch.to_pydict()
        for own, turn, role, kind, text, blank, truncated, again, before, after in zip(*(t[n] for n in ("conv", "turn", "role", "kind", "text", "blank", "truncated", "again", "before", "after")), strict=True):
            if kind == 0 or own != conv or not begun:  # an opening row, or rows of a conversation that has none
                end()
                conv, state, place, last, cell, begun = own, START, 0, None, None, True
                out.add(conv, 0, None, None, None, None, 0, None, None)
            if kind == 1:
                cell, first = (blank, truncated, again, before, after), True
            elif kind == 2:
                blank, truncated, again, before, after = cell
                illegal = last is not None and last + role[:1] not in LEGAL
                last = role[:1]
                fault = "blank" if blank else "duplicate" if again or not first else "truncated" if truncated else None
                edit = "D"
                if fault not in ("blank", "duplicate"):
                    edit, to = edit_at(state, last, truncated, before, after)
                    while edit == "I":
                        state = insert(to)
                        edit, to = edit_at(state, last, truncated, before, after)
                    state = to
                first = False
                place += 1
                cost = {"D": DELETE, "K": TRUNCATED * truncated, "R": REROLE + TRUNCATED * truncated}[edit]
                kept = role if edit == "K" else NAMES[state] if edit == "R" else None
                out.add(conv, place, turn, edit, fault, illegal, cost, kept, None if edit == "D" else text)
            if out.full():
                yield from out.flush()
    if out is not None:
        end()
        yield from out.flush()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digests of an edit script that comes in order."""
    names, done, now, last = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"], [], None, None

    def close() -> None:
        if now is not None:
            seen = 0 if now["low"] is None else now["turn"] - now["low"] + 1 - now["turns"]
            done.append((now["conv"], seen, *(now[n] for n in ("blank", "duplicate", "truncated", "illegal", "cost")), "".join(now["audit"]), now["sha"].hexdigest()))

    for batch in batches:
        t = batch.to_pydict()
        for conv, place, turn, edit, fault, illegal, cost, role, text in zip(*(t[n] for n in ("conv", "place", "turn", "edit", "fault", "illegal", "cost", "role", "text")), strict=True):
            if not place:
                close()
                now = {"conv": conv, "low": None, "turn": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "any": False}
                continue
            if turn is not None:
                now["turns"] += turn != now["turn"]
                now["low"] = turn if now["low"] is None else now["low"]
                now["turn"] = turn
            if fault:
                now[fault] += 1
            now["illegal"] += bool(illegal)
            now["cost"] += cost
            now["audit"].append(edit)
            if role is not None:
                now["sha"].update((("\n" if now["any"] else "") + f"{role}:{text}").encode())
                now["any"] = True
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, batch.schema.field("conv").type if i == 0 else pa.string() if i > 6 else pa.int64()) for i, c in enumerate(zip(*done, strict=True))], names=names)
            done = []
        last = batch.schema.field("conv").type
    close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, last if i == 0 else pa.string() if i > 6 else pa.int64()) for i, c in enumerate(zip(*done, strict=True))], names=names)


def digests(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each conversation of ``ids``, from its edit script (``repair``), which is folded as it comes: gaps in turns, faults, illegal neighbours, cost, audit (initials of the edits)
    and the SHA-256 of the repaired turns."""
    schema = f"conv {ids.schema['conv'].dataType.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _stream(rows, ids).mapInArrow(lambda batches: _fold(_walk(batches)), schema)
