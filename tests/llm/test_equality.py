"""Texts that a polynomial hash modulo 2^64 takes for equal, forced collisions of keys, long texts in parts, and the model score word by word."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from evidentia.llm import bpe, lattice_lm, ngram_join, suffix_dedup, textnum, token_counts
from evidentia.llm.scratch import Scratch


def thue_morse(n, a, b):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


PAIRS = [(n, a, b) for n in (1024, 2048) for a, b in (("a", "b"), ("a", "e"))]


@pytest.fixture(scope="module")
def twins(spark):
    """Pairs of words that differ everywhere, alone and side by side."""
    rows = []
    for n, a, b in PAIRS:
        x, y = thue_morse(n, a, b), thue_morse(n, b, a)
        rows += [x, y, f"{x} {y}", f"{y} and {x}"]
    return rows, spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(2)


def test_words_that_differ_have_different_hashes():
    w = textnum.Words(pa.array([" ".join(thue_morse(n, a, b) + " " + thue_morse(n, b, a) for n, a, b in PAIRS)]))
    assert len(set(w.hash.tolist())) == len(set(w.other_hash().tolist())) == 2 * len(PAIRS)


def test_bytes_decide_where_keys_agree():
    r = random.Random(4)
    parts = [bytes(r.choice(b"ab\0") for _ in range(r.choice([0, 1, 3, 8, 9, 16, 64, 65, 70, 129]))) for _ in range(600)]
    parts += [p[:-1] + b"z" for p in parts if len(p) > 60]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    start = ends - [len(p) for p in parts]
    for key in (np.zeros(len(parts), np.uint64), np.array([len(p) % 3 for p in parts], np.uint64), textnum.Spans(data)(start, ends)):
        first, which = textnum.equal_groups(data, start, ends, key)
        assert len(first) == len(set(parts)) and all(parts[first[g]] == p for g, p in zip(which, parts, strict=True))
        assert (np.diff(key[first].astype(np.int64)) >= 0).all() or len(set(key.tolist())) == len(first)


def test_join_tells_twins_apart(spark, twins):
    rows, df = twins
    got = {r.doc_id: r.component_id for r in ngram_join.classes(df, "doc_id", "text", Scratch(spark, "t")).collect()}
    assert got == {i: i for i in range(len(rows))}


def test_bpe_tells_twins_apart(spark, twins):
    import tiktoken

    rows, df = twins
    path = P.path("byte_bpe_50k.tiktoken")
    ref = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.encoder(path, P.PATTERN).transducer.ranks, special_tokens={})
    for r in bpe.encode(df, "text", path, P.PATTERN, decoded_col="back").collect():
        assert np.frombuffer(r.token_ids, "<u4").tolist() == ref.encode_ordinary(rows[r.doc_id]) and bytes(r.back) == rows[r.doc_id].encode()


def test_token_counts_tell_twins_apart(spark, twins):
    from tokenizers import Tokenizer

    rows, df = twins
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for r in token_counts.count_tokens(df, "text", P.path("word_bpe_49k.json")).collect():
        assert r.n_tokens == len(tok.encode(rows[r.doc_id], add_special_tokens=False).ids)


def test_token_counts_of_special_strings_and_long_texts(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = ["<|endoftext|>", "a<|endoftext|>b", "x <|startoftext|> y <|endoftext|>", "word " * 300_000, "x" * 100_000, " \n\t", "<|endoftext|" * 3]
    df = spark.createDataFrame([(i, t, 7, 8) for i, t in enumerate(rows)], "id long, text string, n_tokens int, n_bytes int")
    got = token_counts.count_tokens(df, "text", P.path("word_bpe_49k.json"))
    assert got.columns == ["id", "n_bytes", "n_tokens"] and token_counts.count_tokens(df.limit(0), "text", P.path("word_bpe_49k.json")).count() == 0
    for r in got.collect():
        assert r.n_tokens == len(tok.encode(rows[r.id], add_special_tokens=False).ids) and r.n_bytes == len(rows[r.id].encode())


def test_bpe_of_long_texts_empty_tables_and_clashing_columns(spark):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ref = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.encoder(path, P.PATTERN).transducer.ranks, special_tokens={})
    rows = ["Wörter und so, 漢字 😀. " * 40_000, None, "", "é" * 5000]
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(rows)], "doc_id long, text string, token_ids string, ids_sha256 string, n_tokens string")
    out = bpe.encode(df, "text", path, P.PATTERN, decoded_col="back")
    assert out.columns == ["doc_id", "text", "ids_sha256", "token_ids", "n_tokens", "back"] and bpe.encode(df.limit(0), "text", path, P.PATTERN).count() == 0
    for r in out.collect():
        assert np.frombuffer(r.token_ids, "<u4").tolist() == ref.encode_ordinary(rows[r.doc_id] or "") and bytes(r.back) == (rows[r.doc_id] or "").encode() and r.ids_sha256 == "y"


def test_join_of_very_long_texts_and_clashing_columns(spark):
    r = random.Random(9)
    long = [f"w{r.randrange(10**6)}" for _ in range(120_000)]
    near = long[:60_000] + ["x"] + long[60_001:]
    far = [f"v{r.randrange(10**6)}" for _ in range(50_000)]
    rows = [(3, " ".join(long)), (1, " ".join(near)), (2, " ".join(far)), (None, " ".join(long)), (7, "a b c"), (7, "a b c")]
    df = spark.createDataFrame([(i, t, 1, "s", 2, 3, "c") for i, t in rows], "doc_id long, text string, _bytes int, sh string, node int, n int, component string")
    got = ngram_join.classes(df, "doc_id", "text", Scratch(spark, "t"))
    assert sorted((r.doc_id or 0, r.component_id) for r in got.collect()) == [(0, 1), (1, 1), (2, 2), (3, 1), (7, 7), (7, 7)]
    kept = ngram_join.deduplicate(df, "doc_id", "text", Scratch(spark, "t"), k=5, percent=80)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 7] and {r._bytes for r in kept.collect()} == {1}


def test_smallest_places_in_parts():
    h = textnum.mix(np.arange(5000, dtype=np.uint64) % np.uint64(700))
    whole = suffix_dedup.sliding_argmin(h, 101)
    assert (suffix_dedup.sliding_argmin(h, 101, bits=9) == whole).all() and (h[whole] == [h[p : p + 101].min() for p in range(4900)]).all()


def test_passages_in_very_long_texts(spark):
    """Texts of more than a chunk, with one passage in common that stands between signs of its own."""
    r = random.Random(12)
    noise = lambda n: "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    passage, a, b = noise(300), noise(2_300_000), noise(900_000)
    rows = [(1, a + "<" + passage + ">" + noise(500), 7), (2, "[" + passage + "]", 7), (3, b + "{" + passage + "}" + noise(1_500_000) + "(" + passage + ")", 7), (4, None, 7), (5, noise(199), 7)]
    df = spark.createDataFrame(rows, "id long, text string, kept int")
    got = {x.id: [tuple(s) for s in x.spans] for x in suffix_dedup.dedup(df, "id", "text", Scratch(spark, "t")).collect()}
    assert got == {i: [(k + 1, 300) for k, c in enumerate(t or "") if c in "<[{("] for i, t, _ in rows}


def spell(word, pieces, longest, p, end):
    """Probability of a word by forward sums, and the expected number of each piece."""
    b = b" " + word
    ahead, back = [1.0] + [0.0] * len(b), [0.0] * len(b) + [1.0]
    arcs = [(i, j, pieces[b[i:j]]) for i in range(len(b)) for j in range(i + 1, min(len(b), i + longest) + 1) if b[i:j] in pieces]
    for i, j, x in arcs:
        ahead[j] += ahead[i] * p[x]
    for i, j, x in reversed(arcs):
        back[i] += back[j] * p[x]
    return ahead[-1] * end, [(x, ahead[i] * p[x] * back[j] / ahead[-1]) for i, j, x in arcs]


def test_model_score_word_by_word(spark, twins):
    r = random.Random(8)
    some = ["сентября", "the", "naïve", "Straße", "don't", "сентябрь", "a", "zz", "internationalization"]
    texts = [" ".join(r.choice(some) if r.random() < 0.5 else "".join(r.choice("abcdeß") for _ in range(r.randint(1, 6))) for _ in range(r.randint(0, 25))) for _ in range(50)]
    texts += [None, "", "  ", texts[3], texts[3], "lorem ipsum the " * 4000, thue_morse(64, "a", "b") + " " + thue_morse(64, "b", "a")]
    path = P.path("piece_bpe_32k.model")
    names, start = lattice_lm.vocabulary(path)
    pieces, longest = {x: i for i, x in enumerate(names)}, max(map(len, names))
    assert longest > 16
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x.doc_id: x for x in lattice_lm.score(df, "doc_id", "text", F.col("doc_id") % 4 > 0, path, Scratch(spark, "t")).collect()}

    tokens = [[w.translate(str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})).encode() for w in (t or "").split()] for t in texts]
    train = [i for i in range(len(texts)) if i % 4 > 0]
    c = collections.Counter(w for i in train for w in tokens[i])
    single = [w for w, n in c.items() if n == 1]
    p = start
    for _ in range(lattice_lm.PASSES):
        counts = start * 50.0
        for w in single:
            for x, e in spell(w, pieces, longest, p, 1.0)[1]:
                counts[x] += e
        total = counts.sum() + len(single) + 1
        p, end = counts / total, (len(single) + 1) / total
    n = sum(c.values()) + len(train)
    novel = len(single) / n
    known = {w: spell(w, pieces, longest, p, end)[0] for words in tokens for w in set(words)}
    of = lambda seen, spelled: (1 - novel) * seen / n + novel * spelled
    for i, words in enumerate(tokens):
        used, total = collections.Counter(), 0.0
        for k, w in enumerate([*words, None]):
            base = of(len(train), end) if w is None else of(c[w], known[w])
            own = max(0.0, used[w] - lattice_lm.DISCOUNT) if used[w] else 0.0
            total += math.log10((own + (lattice_lm.STRENGTH + lattice_lm.DISCOUNT * len(used)) * base) / (k + lattice_lm.STRENGTH))
            used[w] += 1
        assert math.isclose(got[i].score, total, rel_tol=1e-9), (i, texts[i])
        assert got[i].n_tokens == len(words) + 1 and got[i].n_known == sum(c[w] > 0 for w in words) + 1
