"""Personal data by rules and a skip-chain conditional random field.

The rules (``found_by_rules``) give e-mail addresses, IP addresses, card numbers and phone numbers; what they find stays. The field decides about the tokens that
may be such data (no letters but digits, or an ``@``): tokens side by side share potentials, and so do distant tokens of a document that are equal or alike (the same last
seven digits, the same name before ``@``). Labels of tokens that the rules found are given; sum-product messages, ``ROUNDS`` of them over the loopy graph, carry them to the rest. A token
whose label other than none has a marginal of ``ACCEPT`` is data too; neighbours of one label make one span.

The field is fitted by pseudo-likelihood on a bounded sample: at most ``TRAIN_DOCS`` documents of at most ``TRAIN_NODES`` tokens each, chosen by hash. What the rules found has its
kind, other tokens have none, and tokens in matches that the rules drop for too many digits (two numbers side by side) are left out of the fit.

Texts are read once; after that only spans and tokens are. There is no shuffle. Equal tokens are linked to the next one only, so links grow with the tokens and not with their
square. A document's graph is its own: what a batch holds besides does not change it. Null and empty texts have no spans; without any token to learn from, only the rules count. Repeated rows
get equal results. Very long texts are one row. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.scratch import Scratch
from evidentia.llm.textnum import give_back

KINDS = ("email", "ip", "card", "phone")
LABELS, TRAIN_DOCS, TRAIN_NODES, ROUNDS, ACCEPT = 1 + len(KINDS), 4000, 200, 12, 0.7
#: Buckets of hashed features, features of a token, steps and size of steps of the fit, weight of its penalty.
BUCKETS, FEATURES, STEPS, RATE, PENALTY = 1 << 13, 7, 150, 0.5, 1e-4
_NAME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT, _HIT, _WHITE = re.compile("[0-9]"), re.compile("[0-9@]"), re.compile(r"[\x20\x09-\x0D]")
_NUMBER = re.compile(r"[+(]{0,2}[0-9][0-9().+-]*")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+")
_RUN = re.compile("[0-9]+")


def digits(s: str) -> str:
    return "".join(_RUN.findall(s))


def luhn(d: str) -> bool:
    """Whether the check digit of a number is right."""
    odd, even = map(int, d[-1::-2]), (2 * int(c) for c in d[-2::-2])
    return (sum(odd) + sum(x - 9 * (x > 9) for x in even)) % 10 == 0


def byte_sized(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def found_by_rules(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Spans (start, place of the kind in ``KINDS``, end) by start, then kind; and the matches with too many digits, which are dropped. Leftmost and non-overlapping for each kind, in linear time."""
    spans, dropped, at, done = [], [], text.find("@"), 0
    while at >= 0:  # the name before an @ ends there, so it reaches back as far as its characters do
        start = at
        while start > done and text[start - 1] in _NAME:
            start -= 1
        m = _HOST.match(text, at) if start < at else None
        if m:
            spans.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for m in _DOTTED.finditer(text):
            parts, start = m[0].split("."), m.start()
            for i in range(0, len(parts) - 3, 4):
                end = start + sum(map(len, parts[i : i + 4])) + 3
                if all(map(byte_sized, parts[i : i + 4])):
                    spans.append((start, 1, end))
                start = end + 1
        for m in _CARD.finditer(text):
            d = digits(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                spans.append((m.start(), 2, m.end()))
            elif len(d) > 19:
                dropped.append(m.span())
        for m in _PHONE.finditer(text):
            n = len(digits(m[0]))
            if 10 <= n <= 15:
                spans.append((m.start(), 3, m.end()))
            elif n > 15:
                dropped.append(m.span())
    return sorted(spans), dropped


def tokens(text: str) -> list[tuple[int, int]]:
    """Tokens that may be personal data, without the punctuation around them."""
    out, pos = [], 0
    while m := _HIT.search(text, pos):
        a, end = m.start(), _WHITE.search(text, m.start())
        b = end.start() if end else len(text)
        while a > pos and not _WHITE.match(text[a - 1]):
            a -= 1
        pos = b
        if b - a > 256:
            continue
        while b > a and (text[b - 1] in ".,;:!?\"']}>" or text[b - 1] == ")" and text.count("(", a, b) < text.count(")", a, b)):
            b -= 1
        if b - a > 64:
            continue
        while a < b and text[a] in "\"'[{<":
            a += 1
        if _NUMBER.fullmatch(text, a, b) or _MAIL.fullmatch(text, a, b):
            out.append((a, b))
    return out


def shape(s: str) -> str:
    """Digits by the length of their runs, letters as one."""
    return re.sub("[A-Za-z_%]+", "a", _RUN.sub(lambda m: f"{len(m[0])}", s))


def features_of(text: str, nodes: list[tuple[int, int]]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Hashed features of each token (``FEATURES`` of them), the hashes by which it equals and resembles others (0: none), and whether the next token is beside it."""
    shapes = [shape(text[a:b]) for a, b in nodes]
    beside = [int(i + 1 < len(nodes) and nodes[i + 1][0] == nodes[i][1] + 1 and text[nodes[i][1]] == " ") for i in range(len(nodes))]
    feats, same, alike = [], [], []
    key = lambda s: int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little", signed=True)
    for i, (a, b) in enumerate(nodes):
        s, d = text[a:b], digits(text[a:b])
        before = shapes[i - 1] if i and beside[i - 1] else "-"
        after = shapes[i + 1] if beside[i] else "-"
        parts = s.split(".")
        dotted = len(parts) == 4 and all(p.isascii() and p.isdigit() and byte_sized(p) for p in parts)
        kind = "mail" if "@" in s else f"{dotted}{12 <= len(d) <= 19 and luhn(d)}{s[0] == '+'}"
        for k, x in enumerate((shapes[i], f"{before} {shapes[i]}", f"{shapes[i]} {after}", f"{before} {shapes[i]} {after}", f"{kind} {min(len(d), 20)}", f"{kind} {re.sub('[0-9]+', '9', shapes[i])}", "")):
            feats.append(zlib.crc32(f"{k} {x}".encode()) % BUCKETS)
        same.append(key(s.lower()) if len(s) >= 4 else 0)
        alike.append(key("@" + s.partition("@")[0].lower()) if "@" in s else key(d[-7:]) if len(d) >= 7 else 0)
    return feats, same, alike, beside


SPANS = "array<struct<kind:string,start:int,end:int>>"
READ = f"base {SPANS}, node_start array<int>, node_end array<int>, digits array<int>, opens array<boolean>, label array<int>, features array<int>, same array<long>, alike array<long>, beside array<int>"
_LIST = pa.list_(pa.int32())
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_READ_TYPES = [_SPAN_TYPE, _LIST, _LIST, _LIST, pa.list_(pa.bool_()), _LIST, _LIST, pa.list_(pa.int64()), pa.list_(pa.int64()), _LIST]


def read(text: str | None) -> tuple:
    """What the rules find in a text, and its tokens: where they are, digits, whether a token opens a number, labels (0: none, -1: not known, else the kind's place + 1), features and links."""
    text = text or ""
    spans, dropped = found_by_rules(text)
    nodes = tokens(text)
    label, s = [], 0
    by_end = sorted(spans, key=lambda x: x[2])
    for a, b in nodes:
        while s < len(by_end) and by_end[s][2] <= a:
            s += 1
        over = next((k + 1 for start, k, _ in by_end[s : s + 8] if start < b), 0)
        label.append(over or (-1 if any(x < b and a < y for x, y in dropped) else 0))
    feats, same, alike, beside = features_of(text, nodes)
    base = [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]
    own = [text[a:b] for a, b in nodes]
    opens = [x[0] == "+" or 14 <= len(digits(x)) <= 19 and luhn(digits(x)) for x in own]
    return base, [a for a, _ in nodes], [b for _, b in nodes], [len(digits(x)) for x in own], opens, label, feats, same, alike, beside


def read_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(*map(read, batch.column(1).to_pylist()), strict=True) if batch.num_rows else [[]] * len(_READ_TYPES)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, _READ_TYPES, strict=True))], names=["id", *(x.strip().split(" ")[0] for x in READ.replace("struct<kind:string,start:int,end:int>", "").split(", "))])
            give_back()

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, {READ}")


class Graph:
    """Tokens of some documents and their links. Kinds of links: side by side (0), equal (1), alike (2)."""

    def __init__(self, rows: dict[str, list]):
        sizes = [len(x) for x in rows["label"]]
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        flat = lambda name, kind: np.array([x for r in rows[name] for x in r], kind)
        self.label = flat("label", np.int64)
        self.features = flat("features", np.int64).reshape(-1, FEATURES)
        near = np.flatnonzero(flat("beside", np.int64))
        links = [(near, near + 1, np.zeros(len(near), np.int64))]
        same, alike = flat("same", np.int64), flat("alike", np.int64)
        for kind, key in ((1, same), (2, alike)):  # each token to the next one of its key in the document
            order = np.lexsort((np.arange(len(key)), key, self.doc))
            a, b = order[:-1], order[1:]
            hit = (key[a] == key[b]) & (self.doc[a] == self.doc[b]) & (key[a] != 0)
            if kind == 2:
                hit &= same[a] != same[b]
            links.append((a[hit], b[hit], np.full(int(hit.sum()), kind)))
        self.a, self.b, self.kind = (np.concatenate(x) for x in zip(*links, strict=True))


def fit(graph: Graph) -> tuple[np.ndarray, np.ndarray]:
    """Weights of features (bucket, label) and of links (kind, label, label) by pseudo-likelihood: each known label given those around it."""
    w, pair = np.zeros((BUCKETS, LABELS)), np.zeros((3, LABELS, LABELS))
    known = graph.label >= 0
    n = len(graph.label)
    if not known.any() or not (graph.label > 0).any():
        return w, pair
    truth = np.zeros((n, LABELS))
    truth[np.flatnonzero(known), graph.label[known]] = 1
    use = known[graph.a] & known[graph.b]
    a, b, kind = graph.a[use], graph.b[use], graph.kind[use]
    la, lb = graph.label[a], graph.label[b]
    total_w, total_p = np.full_like(w, 1e-6), np.full_like(pair, 1e-6)
    for _ in range(STEPS):
        score = w[graph.features].sum(axis=1)
        np.add.at(score, b, pair[kind, la])
        np.add.at(score, a, pair[kind, :, lb])
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        p /= p.sum(axis=1, keepdims=True)
        error = (truth - p) * known[:, None]
        step_w, step_p = -PENALTY * n * w, -PENALTY * n * pair
        for k in range(LABELS):
            step_w[:, k] += np.bincount(graph.features.ravel(), np.repeat(error[:, k], FEATURES), minlength=BUCKETS)
        np.add.at(step_p, (kind, la), error[b])
        np.add.at(step_p.transpose(0, 2, 1), (kind, lb), error[a])
        total_w += step_w**2
        total_p += step_p**2
        w += RATE * step_w / np.sqrt(total_w)
        pair += RATE * step_p / np.sqrt(total_p)
    pair[1:] = (pair[1:] + pair[1:].transpose(0, 2, 1)) / 2  # distant links have no direction
    return w, pair


def marginals(graph: Graph, w: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Marginal of each label of each token: loopy sum-product over all links at once; labels from the rules are given."""
    n = len(graph.label)
    unary = w[graph.features].sum(axis=1)
    unary -= unary.max(axis=1, keepdims=True) if n else 0
    own = np.flatnonzero(graph.label > 0)
    unary[own] = -1e3
    unary[own, graph.label[own]] = 0
    src, dst = np.concatenate([graph.a, graph.b]), np.concatenate([graph.b, graph.a])
    table = np.concatenate([pair[graph.kind], pair[graph.kind].transpose(0, 2, 1)])
    table = np.exp(table - table.max(axis=(1, 2), keepdims=True)) if len(table) else table
    back = np.concatenate([np.arange(len(graph.a)) + len(graph.a), np.arange(len(graph.a))])
    message = np.zeros((len(src), LABELS))
    for _ in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, dst, message)
        out = belief[src] - message[back]
        out = np.exp(out - out.max(axis=1, keepdims=True)) if len(src) else out
        new = np.log(np.einsum("el,elm->em", out, table) + 1e-300)
        new -= new.max(axis=1, keepdims=True) if len(src) else 0
        message = (message + new) / 2
    np.add.at(unary, dst, message)
    unary -= unary.max(axis=1, keepdims=True) if n else 0
    p = np.exp(unary)
    return p / p.sum(axis=1, keepdims=True)


def spans_of(row: dict, p: np.ndarray) -> list[dict]:
    """Spans that the field adds to those of a document: neighbours of one label, with as many digits as their kind may have."""
    label = p.argmax(axis=1)
    sure = (label > 0) & (p.max(axis=1) >= ACCEPT) & (np.array(row["label"]) <= 0)
    out, i = [], 0
    while i < len(label):
        if not sure[i]:
            i += 1
            continue
        j = i + 1
        many = label[i] >= 3  # cards and phones may have more than one token
        whole = row["opens"][i] and label[i] == 3
        while many and not whole and j < len(label) and sure[j] and label[j] == label[i] and row["beside"][j - 1] and not row["opens"][j]:
            j += 1
        n = sum(row["digits"][i:j])
        if label[i] < 3 or (12 <= n <= 19 if label[i] == 3 else 7 <= n <= 15):
            out.append({"kind": KINDS[label[i] - 1], "start": row["node_start"][i], "end": row["node_end"][j - 1]})
        i = j
    return out


def find(df: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """Per row: id, ``base`` (what the rules find) and ``spans`` (with what the field adds): arrays of kind, start and end (code points, end exclusive), by start, then kind."""
    spark = df.sparkSession
    seen = scratch.keep(read_texts(df, id_col, text_col), "read")
    sample = seen.filter(F.size("label").between(1, TRAIN_NODES)).select("label", "features", "same", "alike", "beside").orderBy(F.xxhash64("features", "same"), F.xxhash64("same")).limit(TRAIN_DOCS).toArrow().to_pydict()
    model = spark.sparkContext.broadcast(fit(Graph(sample)))
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            graph = Graph({c: [r[c] for r in rows] for c in ("label", "features", "same", "alike", "beside")})
            p, at, spans = marginals(graph, *model.value), 0, []
            for r in rows:
                n = len(r["label"])
                more = spans_of(r, p[at : at + n]) if n else []
                at += n
                spans.append(sorted(r["base"] + more, key=lambda s: (s["start"], KINDS.index(s["kind"]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, _SPAN_TYPE)], names=["id", "base", "spans"])
            give_back()

    return seen.mapInArrow(run, f"id {id_type}, base {SPANS}, spans {SPANS}").withColumnRenamed("id", id_col)


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def same_as(kind: str):
    return lambda k: k == kind
