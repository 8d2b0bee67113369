"""Conversation repair, personal data and importance resampling: plain versions, planted cases and hard inputs."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidentia.llm import conversations as cv
from evidentia.llm import importance as im
from evidentia.llm import pii
from evidentia.llm.scratch import Scratch

# --- conversations ---


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        s = lambda x: " " if x is None else str(x)
        n, role, text = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20, s(role), s(text)
        if n == 1:
            text = ""
        if n == 2:
            text = re.sub("[.!?]", "", text)
        if n == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if n == 0 else 2 if n == 3 else 1)
    return out


def plain_repair(rows):
    """Of one conversation's damaged rows: all edit scripts by search over (place, state), the cheapest, then the ASCII-least."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        ink = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None)
        seen.add((role, text))
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {}

    def go(i, state):  # (cost, audit, turns)
        if (i, state) in best:
            return best[i, state]
        best[i, state] = (10**9, "", ())  # inserting for ever is no way
        options = [(0, "", ())] if i == len(rows) and state in (0, 3) else []

        def then(edit, cost, to, turn):
            c, audit, turns = to
            options.append((cost + c, edit + audit, (turn, *turns) if turn else turns))

        if i < len(rows):
            _, _, role, text = rows[i]
            then("D", 2, go(i + 1, state), None)
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                if (state, role[:1]) in step:
                    then("K", more, go(i + 1, step[state, role[:1]]), f"{role}:{text}")
                for name in ("user", "assistant"):
                    if (state, name[0]) in step:
                        then("R", 1 + more, go(i + 1, step[state, name[0]]), f"{name}:{text}")
        del best[i, state]
        inserts = [(name, step[state, name[0]]) for name in ("user", "assistant") if (state, name[0]) in step]
        for (name, to), depth in itertools.product(inserts, (0,)):
            if go.depth < 3:
                go.depth += 1
                then("I", 5, go(i, to), f"{name}:")
                go.depth -= 1
        return min(options, default=(10**9, "", ()))

    go.depth = 0
    cost, audit, turns = go(0, 0)
    turns_of = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns_of) - min(turns_of) + 1 - len(set(turns_of)) if turns_of else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest())


def repaired(spark, rows, damage=True):
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    got = cv.damaged(df, "conv", "turn", "role", "text") if damage else df
    return {r.conv: tuple(r)[1:] for r in cv.digests(got, df.select("conv")).collect()}


def test_repair_equals_a_search(spark):
    r = random.Random(5)
    rows = []
    for conv in range(120):
        for turn in range(r.randint(0, 5)):
            rows.append((conv, r.choice([turn, turn, turn + 1, None]), r.choice(["user", "assistant", "system", "tool", None, "user", "assistant"]), r.choice(["Yes.", "no", "What?", " \n", "", None, "a. b", f"t{turn}!"])))
    got = repaired(spark, rows)
    by = collections.defaultdict(list)
    for row in plain_damage(rows):
        by[row[0]].append(row)
    want = {conv: plain_repair(by[conv]) for conv in {x[0] for x in rows}}
    assert got == want and len({w[6] for w in want.values()}) > 20
    assert any(not by[c] for c in want)  # a conversation of which nothing is left


def test_repair_cases(spark):
    empty = hashlib.sha256(b"").hexdigest()
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yo."), (2, 0, "user", "Hi."), (3, 0, "assistant", "a."), (4, 0, "system", "s."), (5, 0, "user", "q?"), (5, 1, "user", "r?"), (None, None, "user", "x."), (6, 0, "", "x."), (7, 3, "user", "cut"), (7, 9, "assistant", "ok.")]
    got = repaired(spark, rows, damage=False)
    assert got[1][5:] == (0, "KK", hashlib.sha256(b"user:Hi.\nassistant:Yo.").hexdigest()) and got[7][:1] == (5,) and got[7][3] == 1
    assert got[2][5:7] == (2, "D") and got[2][7] == empty and got[3][5:7] == (2, "D") and got[4][5:7] == (2, "D") and got[5][5:7] == (1, "KR") and got[5][4] == 1
    assert got[6][5:7] == (2, "D") and got[None][5:7] == (2, "D")
    script = cv.repair(spark.createDataFrame(rows, "conv long, turn long, role string, text string"), spark.createDataFrame([(5,), (8,)], "conv long"))
    assert [(r.place, r.edit, r.role, r.text) for r in script.filter("conv = 5").collect()] == [(0, None, None, None), (1, "K", "user", "q?"), (2, "R", "assistant", "r?")]
    assert [(r.place, r.edit) for r in script.filter("conv = 8").collect()] == [(0, None)]
    assert repaired(spark, [], damage=False) == {}


def test_a_long_conversation_and_many_copies(spark):
    """Longer than any batch, with texts that repeat thousands of times and one very long one."""
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}.") for i in range(30_000)] + [(2, i, "user", "same.") for i in range(5000)] + [(3, 0, "user", "x" * 3_000_000 + "."), (3, 1, "assistant", "y.")]
    got = repaired(spark, rows, damage=False)
    assert got[1][5:7] == (0, "K" * 30_000) and got[2][2] == 4999 and got[2][5] == 10_000 and got[2][6] == "D" * 5000 and got[3][5] == 0
    sha = hashlib.sha256("\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:t{i}." for i in range(30_000)).encode()).hexdigest()
    assert got[1][7] == sha


def test_clashing_columns_do_not_matter(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", 7, "x")], "conv_id long, turn long, role string, text string, n long, h string")
    rows = cv.damaged(df, "conv_id", "turn", "role", "text")
    assert cv.digests(rows, df.select(F.col("conv_id").alias("conv"))).count() == 1


# --- personal data ---


def plain_rules(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        doubled = [x if i % 2 == 0 else 2 * x - 9 * (2 * x > 9) for i, x in enumerate(reversed(d))]
        if 14 <= len(d) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_rules_equal_their_patterns():
    r = random.Random(1)
    bits = ["@", ".", "a", "b.c", "-", "+", "1", "23", "256", "255", "007", " ", "4539148803436467", "(", ")", "x@y.z", "é", "\n", "%", "+1 (269) 555-3296", "000"]
    for _ in range(20_000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert pii.found_by_rules(t)[0] == plain_rules(t), t
    long = "1" * 300_000 + " " + "a" * 300_000 + "@" + "." * 10 + " 1.2.3.4 " + "1." * 50_000
    assert [s for s in pii.found_by_rules(long)[0] if s[1] == 1][0][0] == long.index("1.2.3.4")


def messages_by_hand(graph, w, pair):
    """Marginals by summing over all labellings."""
    n, total = len(graph.label), np.zeros((len(graph.label), pii.LABELS))
    unary = w[graph.features].sum(axis=1)
    for labels in itertools.product(range(pii.LABELS), repeat=n):
        if any(graph.label[i] > 0 and graph.label[i] != labels[i] for i in range(n)):
            continue
        p = math.exp(sum(unary[i, x] for i, x in enumerate(labels)) + sum(pair[k, labels[a], labels[b]] for a, b, k in zip(graph.a, graph.b, graph.kind, strict=True)))
        for i, x in enumerate(labels):
            total[i, x] += p
    return total / total.sum(axis=1, keepdims=True)


def test_messages_are_exact_on_trees_and_near_on_loops():
    r = np.random.default_rng(3)
    row = lambda label, beside, same, alike: {"label": [label], "features": [list(range(7 * len(label)))], "same": [same], "alike": [alike], "beside": [beside]}
    w, pair = r.normal(0, 1, (pii.BUCKETS, pii.LABELS)), r.normal(0, 0.6, (3, pii.LABELS, pii.LABELS))
    pair[1:] = (pair[1:] + pair[1:].transpose(0, 2, 1)) / 2
    tree = pii.Graph(row([0, -1, 3, 0], [1, 0, 1, 0], [1, 2, 1, 3], [0, 0, 0, 0]))
    assert np.allclose(pii.marginals(tree, w, pair), messages_by_hand(tree, w, pair), atol=1e-3)
    loop = pii.Graph(row([0, 0, 0], [1, 1, 0], [5, 6, 5], [0, 0, 0]))
    assert len(loop.a) == 3 and np.abs(pii.marginals(loop, w, pair) - messages_by_hand(loop, w, pair)).max() < 0.1
    both = {c: [*row([0, -1, 3, 0], [1, 0, 1, 0], [1, 2, 1, 3], [0, 0, 0, 0])[c], *row([0, 0, 0], [1, 1, 0], [5, 6, 5], [0, 0, 0])[c]] for c in ("label", "features", "same", "alike", "beside")}
    assert np.allclose(pii.marginals(pii.Graph(both), w, pair)[:4], pii.marginals(tree, w, pair))  # other documents change nothing


def numbers(r):
    d = [r.randint(1, 9)] + [r.randint(0, 9) for _ in range(14)]
    d += [next(c for c in range(10) if pii.luhn("".join(map(str, [*d, c]))))]
    card = "".join(map(str, d))
    return card, f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}", ".".join(str(r.randint(1, 255)) for _ in range(4)), f"u{r.randint(1, 999)}@mail{r.randint(1, 9)}.example.com"


def test_the_field_adds_what_rules_drop(spark):
    r, rows = random.Random(4), []
    for i in range(1500):
        card, phone, ip, mail = numbers(r)
        rows.append((i, f"word {r.choice([card, phone, ip, mail, 'version 2.0', 'in 1999 and 2004', str(r.randint(10, 99999))])} of the rest."))
    card, phone, ip, mail = numbers(r)
    other, *_ = numbers(r)
    planted = {2000: (f"call {phone} {ip} now", "phone"), 2001: (f"pay {card} {other} now", "card"), 2002: (f"pay {card} {other}, and then {card} alone", "card")}
    rows += [(i, t) for i, (t, _) in planted.items()] + [(3000, None), (3001, ""), (3002, "clean text, version 2.0 of 1999; 12345 items, chapter 3.4.5"), (3003, "1234567 " * 2)]
    df = spark.createDataFrame(rows, "id long, body string").withColumn("spans", F.lit(1))
    got = {x.id: x for x in pii.find(df, "id", "body", Scratch(spark, "pii-test")).collect()}
    text = dict(rows)
    for i, t in text.items():
        assert [(s.start, pii.KINDS.index(s.kind), s.end) for s in got[i].base] == plain_rules(t or "")
        kept = {tuple(s) for s in got[i].spans}
        assert {tuple(s) for s in got[i].base} <= kept and [s.start for s in got[i].spans] == sorted(s.start for s in got[i].spans)
    for i, (t, kind) in planted.items():
        assert any(s.kind == kind and s not in got[i].base for s in got[i].spans), t
    assert {t[s.start : s.end] for t in [text[2001]] for s in got[2001].spans} == {card, other}
    assert not got[3000].spans and not got[3001].spans and not got[3002].spans
    clean = [x for x in got.values() if x.id < 1500 and not x.base]
    assert sum(bool(x.spans) for x in clean) <= 0.01 * len(clean)  # held-out kinds of numbers stay clean
    assert pii.find(df.limit(0), "id", "body", Scratch(spark, "pii-test")).count() == 0
    nothing = pii.find(df.filter("id = 3002"), "id", "body", Scratch(spark, "pii-test")).collect()
    assert len(nothing) == 1 and not nothing[0].spans


# --- importance resampling ---

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(t):
    w = WORD.findall((t or "").encode().translate(bytes(range(256)).lower()))
    return len(w), [b" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain_resample(docs, bench):
    s, t, each = collections.Counter(), collections.Counter(), []
    for i, text in docs:
        n, f = plain_features(text)
        c = collections.Counter(zlib.crc32(x) % 10000 for x in f)
        each.append((i, n, len(f), c))
        s.update(c)
    for text in bench:
        t.update(zlib.crc32(x) % 10000 for x in plain_features(text)[1])
    a, b = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (a + 10000) / ((s[k] + 1) * (b + 10000)))) for k in range(10000)]
    out = []
    for i, n, nf, c in each:
        w, h = sum(gain[k] * m for k, m in c.items()), int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, nf, w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    drawn = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(drawn[: 5 * len(drawn) // 100])}
    return sorted(((r[0], r[2], r[3], r[4], rank.get(id(r))) for r in out), key=str)


@pytest.mark.parametrize("ranges", [None, 9])
def test_resampling_equals_a_plain_version(spark, ranges, monkeypatch):
    if ranges:
        monkeypatch.setattr(im.ex, "ranges_for", lambda n: ranges)
    r = random.Random(8)
    words = ["the", "The", "of", "naïve", "x1", "ß", "a-b", "12", "…", "zürich", "w" * 400, *[f"w{i}" for i in range(300)]]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.choice([0, 1, 2, 19, 20, 25, 60])))) for i in range(500)] + [(900, None), (901, ""), (902, "the of " * 20_000), (903, "same text " * 12), (904, "same text " * 12), (905, "x" * 400_000), (None, "null id " * 15)]
    bench = [" ".join(r.choice(words[:60]) for _ in range(30)) for _ in range(20)] + [None]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("weight", F.lit(1)).repartition(4)
    target = spark.createDataFrame([(x,) for x in bench], "text string")
    got = im.resample(df, "doc_id", "text", target, "text", Scratch(spark, "importance-test"))
    assert sorted((tuple(x) for x in got.collect()), key=str) == plain_resample(docs, bench)


def test_resampling_of_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    none = df.limit(0)
    make = lambda d, t: sorted(tuple(x)[:3] for x in im.resample(d, "doc_id", "text", t, "text", Scratch(spark, "importance-test")).collect())
    assert make(none, df) == [] and [x[:2] for x in make(df, none)] == [(1, 6), (2, 0)] and make(df.filter("doc_id = 2"), none) == [(2, 0, 0)]


def test_joined_crcs():
    r = random.Random(2)
    for _ in range(200):
        a, b = (bytes(r.randrange(256) for _ in range(r.choice([0, 1, 5, 300, 70_000]))) for _ in range(2))
        got = im.joined_crc(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)], np.uint32))
        assert int(got[0]) == zlib.crc32(a + b)


# --- re-parameterised benchmark items ---


def test_items_full_of_numbers_are_found_with_other_numbers():
    """Recall on items of which a tenth to two thirds of the words are numbers, asked again with other numbers inside other text; and what is only like them stays."""
    import pyarrow as pa

    from evidentia.llm import decontam

    r = random.Random(9)
    words = ["".join(r.choice("aeioustrnlm") for _ in range(r.randint(3, 9))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [" ".join(str(r.randint(2, 999)) if r.random() < share else r.choice(words) for _ in range(r.randint(9, 40))) for share in (0.1, 0.3, 0.5, 0.66) for _ in range(40)]
    items += ["Compute 12 + 15 + 19 + 23 + 31 + 47 + 52", "Solve 3 x + 7 = 22 for x"]
    table = decontam.Templates(items)
    found = 0
    for i, item in enumerate(items):
        other = {}
        again = re.sub(r"\d+", lambda m, other=other: other.setdefault(m[0], str(r.randint(1000, 9999))), item)
        got = table.search(pa.array([f"{prose(60)}. {again}. And {prose(60)}"]))
        found += any(g[1] == i and g[6] for g in got)
    assert found >= 0.95 * len(items)
    clean = [prose(300) for _ in range(50)] + [" ".join(str(r.randint(1, 99)) for _ in range(300)) for _ in range(10)] + ["row " + " ".join(f"{r.randint(1, 99)} {r.choice(words)}" for _ in range(100)) for _ in range(10)]
    assert not table.search(pa.array(clean))
