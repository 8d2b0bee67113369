"""Window joins, parallel matching, keyed permutations, streams with state, identifiers and claims in two times: plain versions and hard inputs."""

import datetime as dt
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidentia.operators import attribution as at
from evidentia.operators import backtest as bt
from evidentia.operators import lifecycle as lc
from evidentia.operators import matching as mt
from evidentia.operators import moves as mv
from evidentia.streaming import keyed as ky
from evidentia.streaming import state as st


def test_windows_meet_forms_as_a_search_would(spark):
    r = random.Random(3)
    bits = ["AB", "A", "AB-1", " ", "-", "C3", ".", "  ", "é", "\n", "1"]
    titles = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 9)))) for i in range(150)] + [(900, None), (901, "")]
    forms = [(f"E{i % 7}", "".join(r.choice(bits) for _ in range(r.randint(1, 4)))) for i in range(80)] + [("E1", "")]
    pairs = [(i, f"E{k}") for i, _ in titles for k in (0, 1, 2, 3, 3)] + [(None, "E1"), (5, None)]
    df = lambda rows, s: spark.createDataFrame(rows, s)
    got = at.in_title(df(pairs, "rec int, ent string"), "rec", "ent", df(titles, "rec int, title string"), F.col("title"), df(forms, "entity string, form string"))
    text = dict(titles)
    hit = lambda t, f: f and t is not None and re.search(rf"(?<![A-Z0-9]){re.escape(f)}(?![A-Z0-9])", t.upper())
    want = {(i, e) for i, e in pairs if i in text and any(e == x and hit(text[i], f) for x, f in forms)}
    assert {tuple(x) for x in got.collect()} == want and len(want) > 50 and got.count() == len(want)
    assert at.in_title(df(pairs, "rec int, ent string"), "rec", "ent", df(titles, "rec int, title string"), F.col("title"), df([], "entity string, form string")).count() == 0


def test_rows_of_a_task_are_bounded_by_parts(spark, monkeypatch):
    """With many rows the parts follow their number and the results stay: titles in 13 parts, and attribution."""
    monkeypatch.setattr(at, "ROWS", 100)
    r = random.Random(4)
    rows = spark.createDataFrame([(r.randrange(300), f"E{r.randrange(6)}", r.choice("AR"), 1.0) for _ in range(1250)], "rec int, entity string, field string, n double")
    titles = spark.createDataFrame([(i, f"about e{i % 6} and e{i % 4}") for i in range(300)], "rec int, title string")
    forms = spark.createDataFrame([(f"E{i}", f"E{i}") for i in range(6)], "entity string, form string")
    symbols = spark.createDataFrame([(f"E{i}", f"S{i}") for i in range(6)], "entity string, symbol string")
    parts = at.parts_for(rows)
    assert parts == 13 and at.parts_for(rows.limit(300)) is None
    got = at.in_title(rows, "rec", "entity", titles, F.col("title"), forms, parts)
    want = {(x.rec, x.entity) for x in rows.collect() if x.entity in (f"E{x.rec % 6}", f"E{x.rec % 4}")}
    assert {tuple(x) for x in got.collect()} == want and got.count() == len(want) and got.rdd.getNumPartitions() == 13
    both = [at.attribute(rows, "rec", "entity", "field", "n", {"title": "A", "claims": "R"}, titles, F.col("title"), forms, symbols, parts=p) for p in (None, parts)]
    plain, dealt = (sorted(map(tuple, x.collect()), key=repr) for x in both)
    assert plain == dealt and len(plain) > 200 and both[1].rdd.getNumPartitions() == 13


def greedy_by_hand(cases, controls, k):
    """One after the other, as the operator says."""
    pool = sorted((v, c) for c, v in controls if v is not None)
    out = []
    for case, v in sorted((c, v) for c, v in cases if v is not None):
        for _ in range(k):
            order = sorted((abs(x - v), x >= v, -i if x < v else i) for i, (x, _) in enumerate(pool))
            if not order:
                break
            i = abs(order[0][2])
            out.append((case, pool[i][1], abs(pool[i][0] - v)))
            del pool[i]
    return sorted(out)


@pytest.mark.parametrize("seed,levels,n,m,k,size", [(1, 8, 25, 90, 2, 8), (2, 1000, 30, 70, 3, 10), (3, 3, 12, 20, 4, 6), (4, 1, 10, 40, 2, 4)])
def test_parallel_matching_equals_the_sequential_one(spark, seed, levels, n, m, k, size):
    """Many ties, levels of their own, pools that are too short, and one level for all, in blocks of a few controls."""
    r = random.Random(seed)
    cases = [(i, float(r.randrange(levels))) for i in r.sample(range(1000), n)] + [(2000, None)]
    controls = [(i, float(r.randrange(levels))) for i in r.sample(range(1000), m)] + [(2001, None)]
    df = lambda rows: spark.createDataFrame(rows, "key long, level double")
    got = sorted(tuple(x) for x in mt.greedy_matched(df(cases), df(controls), "key", "level", k, size=size).collect())
    assert got == greedy_by_hand(cases, controls, k)


def test_keyed_bijections():
    for n in (1, 2, 3, 5, 64, 65, 1000):
        got = bt.keyed_places(np.arange(n), np.arange(30)[:, None], n, 5)
        assert all(sorted(x) == list(range(n)) for x in got.tolist())
    got = bt.keyed_places(np.arange(4), np.arange(24_000)[:, None], 4, 5)
    seen = {p: int((got == np.array(p)).all(axis=1).sum()) for p in itertools.permutations(range(4))}
    assert min(seen.values()) > 600 and max(seen.values()) < 1500  # each of the 24 orders about a thousand times


def test_permutation_values(spark):
    df = lambda rows: spark.createDataFrame(rows, "id int, x double, y double")
    p = lambda rows, **o: bt.permutation_p(df(rows), "x", "y", "id", **o).first().p
    rows = [(i, float(i), float(i)) for i in range(7)]
    assert p(rows, k=2000) < 0.003 and p([(i, x, -y) for i, x, y in rows], k=200) > 0.99 and p([], k=10) == 1.0
    mixed = [(i, float(i), float((i * 5) % 7)) for i in range(7)]
    base = sum(i * ((i * 5) % 7) for i in range(7))
    exact = sum(sum(i * x for i, x in enumerate(q)) >= base for q in itertools.permutations(range(7))) / 5040
    assert abs(p(mixed, k=4000) - exact) < 0.03


def test_changes_come_once_over_restarts(spark, tmp_path):
    ky.with_state_store(spark)
    schema, src, out, checkpoint = "k long, v string, t timestamp", str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    day = lambda i: dt.datetime(2024, 1, 1 + i)
    files = [[(1, "a", day(0)), (2, "x", day(0)), (1, "a", day(1))], [(1, "b", day(3)), (1, "c", day(2)), (3, None, day(2))], [(2, "x", day(5)), (3, "z", day(6)), (None, "n", day(6))]]
    got = []
    for rows in files:  # a batch each, and a restart between
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        st.appended(ky.changes(st.source(spark, src, spark.createDataFrame([], schema).schema), "k", "v", "t"), out, checkpoint)
        got.append(spark.read.parquet(out).count())
    rows = {tuple(x) for x in spark.read.parquet(out).select("k", F.dayofmonth("at"), "before", "after", "status").collect()}
    assert rows == {(1, 1, None, "a", "NEW"), (2, 1, None, "x", "NEW"), (1, 3, "a", "c", "CHANGED"), (1, 4, "c", "b", "CHANGED"), (3, 3, None, None, "NEW"), (3, 7, None, "z", "CHANGED"), (None, 7, None, "n", "NEW")} and got == [2, 5, 7]


@pytest.mark.parametrize("buckets", [1, 7])
def test_moves_and_changes_of_many_keys_in_few_buckets(spark, tmp_path, buckets):
    """Keys that share a bucket keep their own state over batches; kinds with commas, times and parts of keys that are null, and numbers of 19 digits beside them stay what they are."""
    ky.with_state_store(spark)
    r, big = random.Random(buckets), 2**60
    when = lambda: r.choice([None] + [dt.datetime(2024, 1, 1, 0, 0, 0, i) for i in range(1, 40)] + [dt.datetime(1800, 1, 1)])
    batches = [[(r.choice([None, big + 1, big + 2, *range(60)]), r.choice(["x", None, '"', "a,b"]), r.choice(["k", "k,l", "", None, "l"]), when()) for _ in range(200)] for _ in range(3)]
    schema, src = "c long, t string, kind string, at timestamp", str(tmp_path / "in")
    seen, verdicts, moves, want_changes, out = {}, {}, [], [], str(tmp_path / "out")
    last = dt.datetime(9999, 1, 1)
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        before = {k: (set(d), set(s)) for k, (d, s) in seen.items()}
        for c, t, kind, at in rows:
            days, kinds = seen.setdefault((c, t), (set(), set()))
            days |= {at} - {None}
            kinds |= {kind} - {None}
        for k in {(c, t) for c, t, _, _ in rows}:
            (days, kinds), old = seen[k], before.get(k)
            ends = lambda x: (min(x, default=None), max(x, default=None))
            if old is None or len(kinds) > len(old[1]) or ends(days) != ends(old[0]):
                moves.append((*k, *ends(days), ",".join(sorted(kinds)), len(kinds) > 1, "NEW" if old is None else "UPGRADED" if len(kinds) > len(old[1]) else "EXTENDED"))
        for c, _, kind, at in sorted(rows, key=lambda x: (x[3] or last, x[2] is None, x[2] or "")):
            if c not in verdicts or verdicts[c] != kind:
                want_changes.append((c, at, verdicts.get(c), kind, "CHANGED" if c in verdicts else "NEW"))
            verdicts[c] = kind
    stream = lambda: st.source(spark, src, spark.createDataFrame([], schema).schema)
    for name, f, want in (("moves", ky.upgraded_moves(stream(), "c", "t", "kind", "at", buckets=buckets), moves), ("changes", ky.changes(stream(), "c", "kind", "at", buckets=buckets), want_changes)):
        st.appended(f, f"{out}/{name}", str(tmp_path / name))
        got = [tuple(x) for x in spark.read.parquet(f"{out}/{name}").collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(want) > 100


def test_turns_of_several_files_are_batches(spark, tmp_path):
    """A turn's files are written by several tasks, all turns have as many of them, and a stream takes a turn for each batch; where a turn has few rows there is a file for each."""
    from evidentia.plans import queries as pq

    start = dt.datetime(2024, 1, 1)
    for name, many, want in (("even", [100] * 8, 3), ("uneven", [397, 1, 1, 1], 1)):
        rows = [(start + dt.timedelta(minutes=600 * i + j),) for i, n in enumerate(many) for j in range(n)]
        rows[-1] = (start + dt.timedelta(minutes=600 * len(many) - 1),)
        spark.createDataFrame(rows, "ts timestamp_ntz").repartition(3).write.parquet(str(tmp_path / name / "events.parquet"))
        path, k = pq._several_files(spark, str(tmp_path / name), rows=80)
        assert k == want
        st.upserted(st.source(spark, path, "ts timestamp_ntz", files=k).groupBy("ts").count(), str(tmp_path / name / "out"), str(tmp_path / name / "cp"))
        got = spark.read.parquet(str(tmp_path / name / "out")).groupBy("batch").agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.sum("count").alias("n")).orderBy("batch").collect()
        assert len(got) == 4 and sum(r.n for r in got) == sum(many) and all(x.b < y.a for x, y in itertools.pairwise(got))


def test_verdicts_of_a_bucket_are_told_apart_at_once():
    """Rows of many keys in one call against a plain loop: nulls, ties and keys that come again; the call loops over keys, not over rows."""
    import pandas as pd

    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    r, p, known = random.Random(11), ky._Verdicts(None), {}
    p.held = Held()
    for _ in range(20):
        rows = [(f"k{r.randrange(9)}", r.choice([ky.NEVER, 1, 2, 3]), r.choice([None, "", "a", "b", "\U0001d4b3", "\uffff"])) for _ in range(r.choice([1, 5, 200]))]
        want = []
        for k, at_, v in sorted(rows, key=lambda x: (x[0], x[1], x[2] is None, x[2] or "")):
            if k not in known or known[k] != v:
                want.append((k, at_, known.get(k), v, "CHANGED" if k in known else "NEW"))
            known[k] = v
        got = pd.concat(p.handleInputRows((0,), iter([pd.DataFrame(rows, columns=["row_key", "row_at", "row_verdict"])]), None))
        assert sorted(map(repr, got.astype(object).itertuples(index=False, name=None))) == sorted(map(repr, want))
    assert dict(zip(p.held.value[0], p.held.value[2], strict=True)) == known


def test_first_seen_over_batches(spark, tmp_path):
    schema, src = "k long, v string", str(tmp_path / "in")
    for i in range(3):
        spark.createDataFrame([(j, f"b{i}") for j in range(i, 6)], schema).coalesce(1).write.mode("append").parquet(src)
    st.appended(st.first_seen(st.source(spark, src, spark.createDataFrame([], schema).schema), ["k"]), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(tuple(x) for x in spark.read.parquet(str(tmp_path / "out")).collect()) == [(i, "b0") for i in range(6)]


def test_feed_with_last_metadata(spark):
    rows = spark.createDataFrame([(1, 1, "a", True), (1, 3, "c", True), (1, 2, "b", True), (1, 9, "no", False), (2, 1, "x", True)], "k int, day int, title string, hit boolean")
    got = at.feed(rows, "k", F.when(F.col("hit"), F.array("title")).otherwise(F.array().cast("array<string>")), 2, title=F.max_by("title", "day"), latest=F.max("day"))
    assert [tuple(x) for x in got.collect()] == [(1, 3, "a,b,c", "c", 3)] and got.columns == ["k", "n", "hits", "title", "latest"]


def test_identifiers(spark):
    df = lambda *rows: spark.createDataFrame(rows, "old string, new string")
    chain = [(f"i{i}", f"i{i + 1}") for i in range(37)]
    got = {r.id: r.canonical for r in lc.canonical_ids(df(*chain, ("a", "i30"), ("b", "i30"), ("b", "i30"), ("c", "c"), (None, "x"), ("y", None)), "old", "new").collect()}
    assert got == {**{f"i{i}": "i37" for i in range(37)}, "a": "i37", "b": "i37"}
    for bad in ([("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("x", "y")], [("a", "b"), ("a", "c")]):
        with pytest.raises(ValueError):
            lc.canonical_ids(df(*bad), "old", "new").collect()
    assert lc.canonical_ids(df().limit(0) if False else spark.createDataFrame([], "old string, new string"), "old", "new").count() == 0


def test_rectangles_answer_as_the_claims_do(spark):
    r = random.Random(6)
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(i)
    claims = [(r.randrange(3), day(r.randrange(12)), day(r.randrange(30)), f"v{i}", i) for i in range(90)] + [(None, day(1), day(1), "x", 500), (1, None, day(1), "x", 501)]
    rects = lc.rectangles(spark.createDataFrame(claims, "k int, valid date, observed date, v string, n int"), "k", "valid", "observed", "n")
    rows = rects.collect()
    for valid, known in itertools.product(range(-1, 14, 2), range(-1, 32, 3)):
        want = {}
        for k, a, b, v, n in claims:
            if k is not None and a is not None and a <= day(valid) and b <= day(known) and ((a, b, n) > want.get(k, (dt.date.min,))[:3]):
                want[k] = (a, b, n, v)
        inside = [x for x in rows if x.valid <= day(valid) and (x.valid_to is None or x.valid_to > day(valid)) and x.observed <= day(known) and (x.observed_to is None or x.observed_to > day(known))]
        assert {x.k: x.v for x in inside} == {k: w[3] for k, w in want.items()} and len(inside) == len(want)
    assert lc.as_of_both(rects, "valid", "observed", F.lit(day(5)), F.lit(day(20))).count() == 3


def test_one_pair_of_times_needs_no_rectangles(spark):
    """What one asks of claims equals what one asks of their rectangles, with ties, null parts and equal rows; a key leaves a task as one row, and all is done in one exchange without Python."""
    from evidentia.plans import more

    r = random.Random(7)
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(i)
    maybe = lambda x: None if r.random() < 0.05 else x
    rows = [(maybe(float(r.choice(["nan", 0, 1, 2]))), maybe(day(r.randrange(10))), maybe(day(r.randrange(20))), maybe("ab"[i % 2]), maybe(i // 3)) for i in range(300)]
    claims = spark.createDataFrame(rows, "k double, valid date, observed date, v string, n int").repartition(5)
    rects = lc.rectangles(claims, "k", "valid", "observed", "n", "v").cache()
    for valid, known in itertools.product((-1, 4, 11), (7, 19)):
        both = F.lit(day(valid)), F.lit(day(known))
        want = sorted(repr((x.k, x.valid, x.v, x.n)) for x in lc.as_of_both(rects, "valid", "observed", *both).collect())
        got = lc.known_to_hold(claims, "k", "valid", "observed", *both, "n", "v")
        assert sorted(repr((x.k, x.valid, x.v, x.n)) for x in got.collect()) == want and got.columns == claims.columns
    assert len(want) == 4
    plan = more.claims_as_of_both(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan and "MapInArrow" not in plan and "Join" not in plan


def test_successors_of_many_keys_pass_in_batches(spark):
    """Ties and keys that go on from one batch to the next, against a plain version; no call for each key."""
    r = random.Random(8)
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(i)
    dates = {(f"k{r.randrange(40)}", day(r.randrange(25))): day(r.randrange(12)) for _ in range(500)}
    want = set()
    for (k, d), since in dates.items():
        later = sorted((x, s) for (q, x), s in dates.items() if q == k and x > d)
        stretches = []
        for at in sorted({since, *(s for _, s in later if s > since)}):
            after = next((x for x, s in later if s <= at), None)
            if not stretches or stretches[-1][1] != after:
                stretches.append((at, after))
        ends = [*(a for a, _ in stretches[1:]), None]
        want |= {(k, d, a, b, x) for (a, x), b in zip(stretches, ends, strict=True)}
    df = spark.createDataFrame([(k, d, s) for (k, d), s in dates.items()], "k string, d date, s date")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = lc.successors(df, "k", "d", "s")
        rows = [tuple(x) for x in got.select("k", "d", "_from", "_to", "valid_to").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(rows) == want and len(rows) == len(want) > len(dates)
    assert "FlatMapGroups" not in got._jdf.queryExecution().toString()


def test_all_levels_of_the_cascade(spark):
    rows = [("NONE", False, 0, None, None, None, "NONE"), ("NONE", True, 0, False, False, 0, "LIKELY"), ("POSSIBLE", False, 4, False, None, None, "FINGERPRINT"), ("POSSIBLE", False, 4, True, None, None, "LIKELY"), ("NONE", None, None, True, None, None, "LIKELY"), ("NONE", False, 0, False, True, 0, "POSSIBLE"), ("NONE", False, 0, False, True, 2, "LIKELY"), ("POSSIBLE", False, 3, False, True, None, "POSSIBLE"), ("LIKELY", False, 9, True, True, 0, "LIKELY"), ("FINGERPRINT", False, 0, None, True, 1, "LIKELY")]
    df = spark.createDataFrame(rows, "link string, c boolean, f int, p boolean, w boolean, s int, want string")
    got = df.select("want", mv.covalency(*(F.col(x) for x in ("link", "c", "f", "p", "w", "s"))).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    refs = spark.createDataFrame([(1, i, f"p{i}") for i in range(8)] + [(2, 0, None), (3, 0, "gone")], "t int, pos int, pmid string")
    papers = spark.createDataFrame([(f"p{i}", f"T{i}", None if i == 1 else f"A{i}") for i in range(8) if i != 2], "id string, title string, abstract string")
    assert {r.t: r.text for r in mv.publications(refs, "t", "pos", "pmid", papers, "id", "title", "abstract").collect()} == {1: "T0 A0 T1  T3 A3 T4 A4"}


def test_batched_alignment_equals_one_at_a_time():
    """Sequences with parts left out, put in and exchanged, and strangers; bands from one diagonal on."""
    from evidentia.operators import alignment as al

    r, a, b = random.Random(1), [], []
    some = lambda n: "".join(r.choice(al.ORDER) for _ in range(n))
    for _ in range(150):
        x = y = some(r.choice([0, 1, 3, 10, 40, 90]))
        for _ in range(r.choice([0, 1, 3])):
            k, n = r.randint(0, len(y)), r.choice([1, 2, 8, 25])
            y = r.choice([y[:k] + y[k + n :], y[:k] + some(n) + y[k:], y[:k] + some(1) + y[k + 1 :]])
        a.append(x)
        b.append(some(r.choice([0, 1, 5, 60])) if r.random() < 0.2 else y)
    want = [al.align(x, y) if x or y else [] for x, y in zip(a, b, strict=True)]
    for band in (1, 16):
        assert [list(g) for g in al.align_many(a, b, band=band)] == [list(w) for w in want]
    assert al.align_many([], []) == []


def test_state_of_a_bucket_is_dropped_key_by_key():
    """A key that rests longer than the time to live is new again, though its bucket had rows meanwhile."""
    import pandas as pd

    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Clock:
        def __init__(self, now):
            self.getCurrentProcessingTimeInMs = lambda: now

    p = ky._Verdicts(100)
    p.held = Held()
    run = lambda now, *rows: [tuple(x)[0::4] for x in pd.concat(p.handleInputRows((0,), iter([pd.DataFrame(rows, columns=["row_key", "row_at", "row_verdict"])]), Clock(now))).itertuples(index=False)]
    assert run(1000, ("a", 1, "x"), ("b", 1, "x")) == [("a", "NEW"), ("b", "NEW")]
    assert run(1060, ("a", 2, "x")) == []
    assert run(1120, ("a", 3, "y"), ("b", 3, "x")) == [("a", "CHANGED"), ("b", "NEW")]
