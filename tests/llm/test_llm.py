"""The training-data operators against brute force, round trips and held-out accuracy, with nulls, empty texts, ties, repeats and further columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from evidentia.llm import bpe, decontam, lattice_lm, media, ngram_join, quality, queries, secret_scan, suffix_dedup, token_counts, url_filter
from evidentia.llm.scratch import Scratch

DIR = "/root/testdata/sf0.001"
FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(s):
    return re.findall(r"[^\x20\x09-\x0D]+", (s or "").translate(FOLD))


def prose(r, n):
    return " ".join("".join(r.choice("abcdeéß") for _ in range(r.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    base = [prose(r, 70) for _ in range(5)]
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "one"), (5, "two Words"), (6, "a" * 900)]
    for i in range(7, 150):
        k = i % 7
        w = base[i % 5].split()
        if k == 0:
            t = prose(r, 60) + base[0] + prose(r, 20)
        elif k in (1, 2):
            w[r.randrange(len(w))] = "x"
            t = " ".join(w)
        elif k == 3:
            t = base[i % 5]
        elif k == 4:
            t = base[2] + base[2]
        else:
            t = prose(r, r.randint(0, 90))
        out.append((i, t))
    return out


@pytest.fixture
def frame(spark, rows):
    return spark.createDataFrame([(i, t, "c", 1, "n") for i, t in rows], "doc_id long, text string, chunk string, r int, n string").repartition(3)


def brute_components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    best = {i: i for i in sets}

    def find(i):
        while best[i] != i:
            i = best[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                best[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_ngram_join(spark, frame, rows, k, percent):
    got = {r[0]: (r[1], r[2]) for r in ngram_join.classes(frame, "doc_id", "text", Scratch(spark, "t"), k=k, percent=percent).collect()}
    assert got == brute_components(rows, k, percent)


def test_deduplicate_keeps_one_of_each(spark, frame, rows):
    got = ngram_join.deduplicate(frame, "doc_id", "text", Scratch(spark, "t"), k=5, percent=80)
    expect = brute_components(rows, 5, 80)
    assert got.columns == frame.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, (_, c) in expect.items() if i == c)


def test_bpe(spark, frame, rows):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    e = bpe.encoder(path, P.PATTERN)
    ref = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=e.transducer.ranks, special_tokens={})
    out = bpe.encode(frame, "text", path, P.PATTERN, decoded_col="back")
    back = bpe.decode(out, "token_ids", path, P.PATTERN)
    text = dict(rows)
    for r in back.collect():
        ids = ref.encode_ordinary(text[r.doc_id] or "")
        assert bytes(r.token_ids) == b"".join(x.to_bytes(4, "little") for x in ids) and r.n_tokens == len(ids)
        assert bytes(r.back) == (text[r.doc_id] or "").encode() and r.decoded_text == (text[r.doc_id] or "") and r.n == "n"
    r = random.Random(1)
    for _ in range(1500):
        s = "".join(r.choice(["a", "th", " ", "\n", "é", "漢", "😀", "ing", "    ", "\t", "1", "'s", "'", "ll", "²", "…", "\u0301", "\x85", "_"]) for _ in range(r.randint(0, 50)))
        assert e.encode(s) == ref.encode_ordinary(s)
    s = "ab" * 9000
    assert e.encode(s) == ref.encode_ordinary(s)


def test_utf8_stream():
    r = random.Random(2)
    for _ in range(2000):
        b = bytes(r.choice([0x41, 0xC3, 0xA9, 0xE0, 0xA0, 0x80, 0xED, 0xF0, 0x9F, 0xFF, 0xF4, 0x90]) for _ in range(9))
        s = bpe.Utf8Stream()
        assert "".join(s.feed(b[i : i + 1]) for i in range(9)) + s.feed(b"", True) == b.decode("utf-8", "replace")


def test_media(spark, frame, rows):
    text = dict(rows)
    got = media.media_columns(frame, "text", Scratch(spark, "t"), id_col="doc_id").collect()
    assert len(got) == len(rows)
    for r in got:
        data = (text[r.doc_id] or "").encode()
        pay = data + b"\xff" * (-len(data) % 576 or (576 if not data else 0))
        png = media.to_png(pay)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-32:]))
        assert (r.length, r.media_sha256, r.height) == (len(png), hashlib.sha256(png).hexdigest(), len(pay) // 576)


def test_url_filter(spark):
    urls = [None, "no scheme", "https://EXAMPLE.org/en/1?x", "http://a.example.org/es/", "http://notexample.org/es/", "ftp://org", "x://www.com/fr/1#a", "x://www.com/de/"] + [f"http://h{i}.net/p{i}" for i in range(3000)] * 2
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    keyed = df.select("page_id", url_filter.host(F.col("url")).alias("h"), url_filter.path(F.col("url")).alias("p"))
    key = F.concat("h", "p")
    for bound, shards in ((8 << 20, 1), (0, 3)):
        old, url_filter.BROADCAST_BYTES = url_filter.BROADCAST_BYTES, bound
        filters = url_filter.cascades(keyed, key, F.md5(key).startswith("0"), shards)
        out = url_filter.apply_cascades(keyed, key, filters, shards)
        url_filter.BROADCAST_BYTES = old
        for r in out.collect():
            assert r.listed == hashlib.md5((r.h + r.p).encode()).hexdigest().startswith("0")
    name, verdict = url_filter.longest_rule(F.col("h"), F.col("p"), queries.URL_RULES)
    got = [tuple(r) for r in keyed.filter("page_id < 8").orderBy("page_id").select(name, verdict).collect()]
    assert got == [(None, None), (None, None), ("example.org/en/1", "block"), ("example.org/es/", "block"), ("org/", "allow"), (None, None), ("com/fr/", "allow"), ("com/de/", "block")]


@pytest.mark.parametrize("hot", [4, 200])
def test_suffix_dedup(spark, frame, rows, hot):
    b = {i: (t or "").encode() for i, t in rows}
    count = collections.Counter(x[p : p + 200] for x in b.values() for p in range(len(x) - 199))
    got = {r.doc_id: r for r in suffix_dedup.dedup(frame, "doc_id", "text", Scratch(spark, "t"), hot_from=hot).collect()}
    assert set(got) == set(b)
    for i, x in b.items():
        gone = bytearray(len(x))
        for p in range(len(x) - 199):
            if count[x[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        spans = [(m.start(), m.end() - m.start()) for m in re.finditer(b"\1+", bytes(gone))]
        assert bytes(got[i].kept) == bytes(y for y, g in zip(x, gone, strict=True) if not g) and [tuple(s) for s in got[i].spans] == spans


def test_loser_tree():
    r = random.Random(3)
    runs = []
    for _ in range(13):
        s = sorted(bytes(r.choice(b"ab") for _ in range(r.randint(0, 9))) for _ in range(r.randint(0, 30)))
        runs.append(([suffix_dedup.common(a, b, 0) for a, b in zip([b"", *s], s, strict=False)], s))
    out = suffix_dedup.merge_runs(runs)
    merged = [runs[x][1][i] for x, i, _ in out]
    assert merged == sorted(b for _, s in runs for b in s)
    assert [c for _, _, c in out] == [suffix_dedup.common(a, b, 0) for a, b in zip([b"", *merged], merged, strict=False)]


def test_decontamination(spark):
    item = "If a train leaves at 40 km and Anna Smith walks 40 m past the old red barn, how far is it to the mill by the river then?"
    other = "If a train leaves at 75 km and Bert walks 75 m past the old red barn, how far is it to the mill by the river then?"
    wrong = "If a train leaves at 75 km and Bert walks 81 m past the old red barn, how far is it to the mill by the river then?"
    docs = spark.createDataFrame([(0, "Words before. " + item + " Words after."), (1, "So: " + other), (2, "nothing of that kind here at all, only a few words"), (3, None), (4, ""), (5, wrong)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, None), (9, "too short")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.matches(docs, "doc_id", "text", items, "item_id", "text").collect()}
    assert set(got) >= {(0, 7), (1, 7)} and got[0, 7].contaminated and got[1, 7].contaminated and not {k for k in got if k[1] != 7}
    assert got[5, 7].n_inconsistent == 1
    left = decontam.clean(docs, "text", items, "item_id", "text")
    assert {2, 3, 4} <= {r.doc_id for r in left.collect()} and left.columns == docs.columns
    assert decontam.matches(docs.limit(0), "doc_id", "text", items, "item_id", "text").count() == 0


def test_decontamination_judges_each_occurrence(spark):
    item = "If a train leaves at 40 km and Anna Smith walks 40 m past the old red barn, how far is it to the mill by the river then?"
    other = item.replace("40", "75").replace("Anna Smith", "Bert")
    third = item.replace("40", "91").replace("Anna Smith", "Carl").replace("old red barn", "old and very large red barn")
    filler = " ".join(f"w{i} of" for i in range(200))
    parts = item.split(" walks ")
    half = item.split()
    scattered = f" {filler} ".join(" ".join(half[i : i + 10]) for i in range(0, len(half), 5))
    docs = spark.createDataFrame([(0, item + " " + other), (1, other + " " + third), (2, third + " " + item.replace("old red", "old and red")), (3, f"{parts[0]} walks {parts[1]}"), (4, scattered)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert {r.doc_id for r in decontam.matches(docs, "doc_id", "text", items, "item_id", "text").filter("contaminated").collect()} == {0, 1, 2, 3}


def test_decontamination_finds_copies_word_for_word(spark):
    numbers, short = "Compute 12 + 15 + 19 + 23 + 31 + 47 + 52", "Anna walks to the old mill"
    names = "We saw Anna Smith give Bert Jones, Carl Maier, Dora Kent and Emil Falk to Gina Hall, Hugo Lenz and Ida Moor for Jon Kerr, Kai Lund and Lea Marx"
    docs = spark.createDataFrame([(0, "So " + numbers + " now"), (1, "so " + names.lower() + " then"), (2, names.replace(" Bert", "  Bert").upper()), (3, "and anna walks to the old mill again"), (4, "Compute 1 + 2 of the old mill")], "doc_id long, text string")
    items = spark.createDataFrame([(7, numbers), (8, names), (9, "Well, " + short), (10, short), (11, None), (12, " ")], "item_id long, text string")
    got = decontam.matches(docs, "doc_id", "text", items, "item_id", "text").filter("contaminated").collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(0, 7), (1, 8), (2, 8), (3, 10)} and all(r.coverage == 1 for r in got)
    assert [r.doc_id for r in decontam.clean(docs, "text", items, "item_id", "text").collect()] == [4]


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    train = labels.filter("doc_id % 3 <> 0")
    out = quality.classify(docs, train, Scratch(spark, "t"), keep_text=False)
    held = out.join(labels.filter("doc_id % 3 = 0"), "doc_id").select("accepted", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")).collect()
    assert out.count() == docs.count() and sum(r.accepted == r.good for r in held) / len(held) > 0.9
    none = spark.createDataFrame([(1, None, None, None), (2, "", "a", "b")], "doc_id long, text string, lang string, source string")
    assert quality.classify(none, train.limit(0), Scratch(spark, "t")).count() == 2


def test_quality_without_labels_of_both_kinds(spark):
    good = [(i, f"a calm and useful text about rivers number {i}", "en", "s") for i in range(40)]
    poor = [(i, f"BUY NOW!!! cheap cheap {i} $$$", "en", "s") for i in range(40, 80)]
    docs = spark.createDataFrame(good + poor, "doc_id long, text string, lang string, source string")
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for none in (labels([]), labels([(i, 1, 0) for i in range(1000, 1050)]), labels([(i, 1, 0) for i in range(40)])):
        out = quality.classify(docs, none, Scratch(spark, "t")).collect()
        assert len(out) == 80 and all(r.accepted and r.posterior == 0.5 and r.evidence == 0 for r in out)
    for quality_of, toxic_of in ((lambda i: int(i < 40), lambda i: 0), (lambda i: 1, lambda i: int(i >= 40))):
        out = quality.classify(docs, labels([(i, quality_of(i), toxic_of(i)) for i in range(0, 80, 2)]), Scratch(spark, "t")).collect()
        assert all(r.accepted == (r.doc_id < 40) for r in out)


def test_secrets(spark):
    key = hashlib.sha1(b"k").hexdigest()
    docs = spark.createDataFrame([(0, f'x token = "{key}" y {key}'), (1, f"commit {key} of the tree"), (2, None), (3, ""), (4, "plain words " * 2000)], "doc_id long, text string")
    got = {r.doc_id: [c.score >= secret_scan.ACCEPT for c in r.candidates] for r in secret_scan.scan(docs, "text").collect()}
    assert got[0][0] and not any(got[1]) and got[2] == got[3] == got[4] == []
    out = {r.doc_id: r.text for r in secret_scan.redact(docs, "text").collect()}
    assert key not in out[0] and key in out[1] and out[2] is None and out[3] == ""
    held = secret_scan.labelled_findings(spark, 9000).filter("id >= 6000")
    score = "(" + " + ".join(secret_scan.forest(spark)) + f") / {secret_scan.TREES}D >= 0.5 = (label = 1.0)"
    struct = ", ".join(f"'{n}', cast({q} as double)" for n, q in secret_scan.FEATURES.items())
    assert held.selectExpr("label", f"named_struct({struct}) AS f").selectExpr(f"avg(cast({score} as int))").first()[0] > 0.95


def test_secrets_alone_in_a_text(spark):
    bare = ["Authorization bearer Ab3dE5gH7j", "password hunter2abc", "client secret Zk4.qW8e-Rt2", "x aB3dE5.gH7jK9.mN1pQ4.sT6v y"]
    signs = ['password = "p@ssw0rd!23"', "passwd: q!7Zr#w9Lx", '{"api_key": "tR5$kL9&vB2x"}', "secret=Xy7%gH2!pQ4z,"]
    plain = ["nothing of that kind", "das Passwort: übergeben wurde", "the secret: „wunderbar“ said"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(bare + signs + plain)], "doc_id int, text string")
    filler = "some/long/path/of/more/than/twenty "
    got = {r.doc_id: [(c.value, c.score) for c in r.candidates] for r in secret_scan.scan(docs, "text").collect()}
    far = secret_scan.scan(docs.withColumn("text", F.concat(F.lit(filler * 3 + "a b c d "), "text")), "text").collect()
    assert all(got[i] for i in range(len(bare + signs)))
    for r in far:  # a text's findings do not depend on what else it holds
        assert [(c.value, c.score) for c in r.candidates if c.value not in filler] == got[r.doc_id]
    for i, v in enumerate(["p@ssw0rd!23", "q!7Zr#w9Lx", "tR5$kL9&vB2x", "Xy7%gH2!pQ4z"], len(bare)):
        assert dict(got[i])[v] >= secret_scan.ACCEPT, (v, got[i])
    assert dict(got[0])["Ab3dE5gH7j"] >= secret_scan.ACCEPT
    assert not any(s >= secret_scan.ACCEPT for i in range(len(bare + signs), len(docs.collect())) for _, s in got[i]), got
    left = {r.doc_id: r.text for r in secret_scan.redact(docs, "text").collect()}
    assert left[len(bare)] == 'password = "[SECRET]"' and "Ab3dE5gH7j" not in left[0]


def test_token_counts(spark, frame, rows):
    from tokenizers import Tokenizer

    text = dict(rows)
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        tok = Tokenizer.from_file(P.path(name))
        for r in token_counts.count_tokens(frame, "text", P.path(name)).collect():
            assert r.n_tokens == len(tok.encode(text[r.doc_id] or "", add_special_tokens=False).ids) and r.n_bytes == len((text[r.doc_id] or "").encode())


def test_lattice(spark, frame, rows):
    train = F.col("doc_id") % 3 > 0
    got = {r.doc_id: r for r in lattice_lm.score(frame, "doc_id", "text", train, P.path("piece_bpe_32k.model"), Scratch(spark, "t")).collect()}
    c = collections.Counter(w for i, t in rows if i % 3 > 0 for w in [*words(t), "\0end"])
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        w = [*words(t), "\0end"]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i % 3 == 0, len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9) and r.score < 0
    import numpy as np

    pieces, p = [b"a", b"b", b"ab", b" ", b" a"], np.array([0.2, 0.1, 0.3, 0.3, 0.1])
    one = lattice_lm.Lattice(pieces, np.log(p), 0.0).forward(np.frombuffer(b" ab", np.uint8), np.array([0, 3]))[0][0]
    assert math.isclose(math.exp(one), 0.3 * 0.3 + 0.3 * 0.2 * 0.1 + 0.1 * 0.1)


def test_empty_tables(spark, frame):
    none = frame.limit(0)
    assert ngram_join.classes(none, "doc_id", "text", Scratch(spark, "t")).count() == 0
    assert suffix_dedup.dedup(none, "doc_id", "text", Scratch(spark, "t")).count() == 0
    assert media.media_columns(none, "text", Scratch(spark, "t"), id_col="doc_id").count() == 0
    assert lattice_lm.score(none, "doc_id", "text", F.lit(True), P.path("piece_bpe_32k.model"), Scratch(spark, "t")).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as cp

    out = {r.doc_id: r for r in cp.run(spark, DIR).collect()}
    docs = {r.doc_id: r.text for r in queries.table(spark, DIR, "documents").collect()}
    judged = quality.classify(queries.table(spark, DIR, "documents"), queries.table(spark, DIR, "labels"), Scratch(spark, "t"), keep_text=False)
    kept = [(r.doc_id, docs[r.doc_id]) for r in judged.filter("accepted").collect()]
    comp = brute_components(kept, 5, 80)
    kept = {i: t for i, t in kept if comp[i][1] == i}
    items = [r.text for r in queries.table(spark, DIR, "benchmark").collect()]
    clean = {i for i, t in kept.items() if not any(x in t for x in items)}
    assert set(out) <= clean and len(clean - set(out)) <= 1
    assert all(not re.search(r'token = "[0-9a-f]{40}', docs[i]) or r.ids_sha256 for i, r in out.items())
