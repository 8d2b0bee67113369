"""Quality classifier by hierarchical empirical Bayes.

Document evidence: two sparse logistic models (good quality, toxic) over hashed words, word shapes and a few measures of the text, fitted
with an L1 penalty on a bounded sample of labelled rows (``TRAIN_ROWS`` rows and ``TRAIN_FEATURES`` features in all, chosen by hash). Site evidence: the mean evidence of a
host, and of a path in it, from grouped sums over all documents. A host's mean is shrunk toward the global mean, and a path's toward
its host's, with strengths fitted by moments, so sparse sites follow their parents. The posterior adds the site's shift of log odds, damped by ``SITE_WEIGHT``, to the
document's own; a document is accepted if the posterior reaches ``ACCEPT``.

Null or empty texts have no evidence of their own beyond the shape of an empty text and are judged like others. Null hosts and paths are sites of their own. Repeated rows
count as they come; ties do not arise. A model without labelled rows of both kinds is left out, its probability 1/2 for all; without both models, all documents get the prior 1/2 and are accepted. Only sums
by site are shuffled (pre-aggregated); sites are broadcast up to ``SITES_BROADCAST`` rows, beyond that joined with salted rows. Evidence is computed once and
written. Columns named like new ones are replaced (``accept`` keeps them); a very long text is one row of features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from evidentia.llm.scratch import Scratch, unused
from evidentia.llm.textnum import U, Words, mix, slices

TRAIN_ROWS, TRAIN_FEATURES, BUCKETS, SITE_WEIGHT, ACCEPT, SITES_BROADCAST, SALTS = 4000, 16_000_000, 1 << 18, 0.25, 0.5, 50_000, 16
ADDED = ["p_quality", "p_toxic", "evidence", "site_shift", "posterior", "accepted"]

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SHAPE = np.full(256, 3, np.uint8)  # 0 lower or beyond ASCII, 1 upper, 2 digit, 3 other
_SHAPE[[*range(97, 123), *range(128, 256)]] = 0
_SHAPE[65:91] = 1
_SHAPE[48:58] = 2


def features(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Different hashed features of each text: buckets, and where each row's begin.

    Words without their outer signs; trailing signs; and for the whole text the binned shares of words with signs, of capitals, of digits,
    of repeated words and of words equal to the one before, and the binned length."""
    w = Words(arr)
    n = len(w.original)
    letters = np.flatnonzero(_LETTER[w.original] | (_SHAPE[w.original] == 2)) if n else np.zeros(0, np.int64)
    lo, hi = np.searchsorted(letters, w.start), np.searchsorted(letters, w.end) - 1
    core = np.flatnonzero(hi >= lo)
    start, end = (letters[lo[core]], letters[hi[core]] + 1) if len(core) else (core, core)
    word = w.span_hash(start, end) if len(core) else np.zeros(0, U)
    tail = np.flatnonzero(w.end[core] - end >= 2)
    signs = w.span_hash(end[tail], w.end[core][tail]) + U(77) if len(tail) else np.zeros(0, U)
    rows = w.rows
    total = np.maximum(1, np.diff(w.first)).astype(float)
    kinds = np.array([np.append(0, np.cumsum(_SHAPE[w.original] == k)) for k in range(4)])
    by_doc = [np.diff(k[w.offs]) for k in kinds]
    chars = np.maximum(1, by_doc[0] + by_doc[1] + by_doc[2]).astype(float)
    per = lambda x: np.bincount(w.doc[x], minlength=rows) / total if len(w.doc) else np.zeros(rows)
    signed = np.zeros(len(w.doc), bool)
    signed[core[tail]] = True
    bare = np.ones(len(w.doc), bool)
    bare[core] = False
    same = np.zeros(len(w.doc), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    order = np.lexsort((w.hash, w.doc))
    again = np.zeros(len(w.doc), bool)
    again[order[1:]] = (w.hash[order[1:]] == w.hash[order[:-1]]) & (w.doc[order[1:]] == w.doc[order[:-1]])
    shares = [per(np.flatnonzero(x)) for x in (signed, bare, same, again)] + [by_doc[1] / chars, by_doc[2] / chars]
    binned = [np.minimum(9, (s * 10).astype(np.int64)) for s in shares] + [np.minimum(9, np.log2(total).astype(np.int64))]
    extra = np.concatenate([mix(np.full(rows, 1000 + 16 * i, U) + b.astype(U)) for i, b in enumerate(binned)]) if rows else np.zeros(0, U)
    key = np.concatenate([word, signs, extra])
    doc = np.concatenate([w.doc[core], w.doc[core][tail], np.tile(np.arange(rows), len(binned))])
    pair = np.unique(doc.astype(U) << U(32) | key % U(BUCKETS))
    return (pair & U(0xFFFFFFFF)).astype(np.int32), np.searchsorted(pair >> U(32), np.arange(rows + 1))


def fit(rows: list[np.ndarray], y: np.ndarray, *, l1: float = 0.4, steps: int = 150, rate: float = 0.3) -> tuple[np.ndarray, float] | None:
    """Weights and bias by AdaGrad on all rows with soft thresholding; None without rows of both kinds."""
    if not len(y) or y.all() or not y.any():
        return None
    weights = np.zeros(BUCKETS)
    flat = np.concatenate(rows)
    used, flat = np.unique(flat, return_inverse=True)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, g2, b2 = np.zeros(len(used)), np.full(len(used), 1e-6), 1e-6
    bias = float(np.log(y.mean() / (1 - y.mean())))
    balance = np.where(y, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(doc, w[flat], minlength=len(y)) + bias, -30, 30)))
        e = (p - y) * balance
        g = np.bincount(flat, e[doc], minlength=len(used))
        g2 += g * g
        b2 += e.sum() ** 2
        step = rate / np.sqrt(g2)
        w -= step * g
        w = np.sign(w) * np.maximum(0, np.abs(w) - step * l1)
        bias -= rate / np.sqrt(b2) * e.sum()
    weights[used] = w
    return weights, bias


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, *, rows: int = TRAIN_ROWS) -> list[tuple[np.ndarray, float] | None]:
    """Models of (good quality, toxic), None where they cannot be fitted, from at most ``rows`` labelled documents. ``labels``: id, quality, toxic."""
    chosen = labels.filter(F.col("quality").isNotNull() & F.col("toxic").isNotNull()).select(F.col(id_col).alias("_id"), "quality", "toxic")
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id", "quality", "toxic").limit(rows)
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("_text")):
                part = batch.slice(lo, hi - lo)
                buckets, to = features(part.column("_text"))
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(buckets)), part.column("quality").cast(pa.int32()), part.column("toxic").cast(pa.int32())], names=["id", "x", "quality", "toxic"])

    got = sample.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, x array<int>, quality int, toxic int")
    # at most ``rows`` of them, so one task may add up their sizes; the order by id fixes the order of the model's sums
    so_far = F.sum(F.size("x").cast("long")).over(W.orderBy(F.xxhash64("id"), "id", "quality", "toxic").rowsBetween(W.unboundedPreceding, 0))
    got = got.orderBy("id").limit(rows).withColumn("so_far", so_far).filter(F.col("so_far") <= TRAIN_FEATURES).drop("so_far").orderBy("id").toArrow().to_pydict()
    x = [np.array(v, np.int64) for v in got["x"]]
    return [fit(x, np.array(got[k], bool)) for k in ("quality", "toxic")]


def evidence(df: DataFrame, text_col: str, models: list[tuple[np.ndarray, float] | None], *, keep_text: bool = True) -> DataFrame:
    """Add ``p_quality``, ``p_toxic`` and ``evidence`` (log odds that the document is good and not toxic, as far as there are models)."""
    sent = df.sparkSession.sparkContext.broadcast([m and (np.flatnonzero(m[0]), m[0][np.flatnonzero(m[0])], m[1]) for m in models])
    kept = [f for f in df.schema if f.name not in ("p_quality", "p_toxic", "evidence") and (keep_text or f.name != text_col)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "p_quality double, p_toxic double, evidence double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = []
        for m in sent.value:
            full = np.zeros(BUCKETS)
            if m:
                full[m[0]] = m[1]
            dense.append((full, m[2] if m else 0.0))
        has_good, has_toxic = (m is not None for m in sent.value)
        for batch in batches:
            for lo, hi in slices(batch.column(text_col)):
                part = batch.slice(lo, hi - lo)
                buckets, to = features(part.column(text_col))
                doc = np.repeat(np.arange(part.num_rows), np.diff(to))
                z = [np.clip(np.bincount(doc, w[buckets], minlength=part.num_rows) + b, -20, 20) for w, b in dense]
                good, toxic = (1 / (1 + np.exp(-x)) for x in z)
                p = (good if has_good else 1) * (1 - toxic if has_toxic else 1) if has_good or has_toxic else np.full(part.num_rows, 0.5)
                p = np.clip(p, 1e-6, 1 - 1e-6)
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), *(pa.array(v) for v in (good, toxic, np.log(p / (1 - p))))], names=[*(f.name for f in kept), "p_quality", "p_toxic", "evidence"])

    return df.mapInArrow(run, schema)


def _strength(groups: DataFrame, mean: Column, n: Column, around: Column) -> float:
    """Method of moments: prior observations k with variance(mean) = v/(k+1) + v/n, v = around (1 - around)."""
    v = around * (1 - around)
    between = F.greatest(F.lit(1e-6), F.sum(n * ((mean - around) ** 2 - v / n)) / F.sum(n))
    k = groups.agg((F.avg(v) / between - 1).alias("k")).first().k
    return min(1e4, max(5.0, k)) if k is not None else 5.0


def sites(scored: DataFrame, host: str, path: str, scratch: Scratch) -> DataFrame:
    """(host, path, site_shift): the shrunken posterior of each path, as a shift of log odds from the global mean. Sums by path are written; the global mean
    and the two strengths are numbers."""
    p = 1 / (1 + F.exp(-F.col("evidence")))
    grouped = scored.groupBy(F.col(f"`{host}`").alias("host"), F.col(f"`{path}`").alias("path")).agg(F.count("*").cast("double").alias("n"), F.sum(p).alias("s"))
    by_path = scratch.keep(grouped, "paths")
    by_host = by_path.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    g = by_host.agg((F.sum("hs") / F.sum("hn")).alias("g")).first().g
    g = 0.5 if g is None else float(g)
    k = _strength(by_host, F.col("hs") / F.col("hn"), F.col("hn"), F.lit(g))
    hosts = by_host.select(F.col("host").alias("own"), ((F.col("hs") + k * g) / (F.col("hn") + k)).alias("hp"))
    paths = scratch.keep(by_path.join(hosts, F.col("host").eqNullSafe(F.col("own"))).drop("own"), "shrunken")
    k2 = _strength(paths, F.col("s") / F.col("n"), F.col("n"), F.col("hp"))
    pp = (F.col("s") + k2 * F.col("hp")) / (F.col("n") + k2)
    logit = lambda x: F.log(F.greatest(F.lit(1e-6), x) / F.greatest(F.lit(1e-6), 1 - x))
    return paths.select("host", "path", (logit(pp) - logit(F.lit(g))).alias("site_shift"))


def classify(df: DataFrame, labels: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", host: str = "source", path: str = "lang", keep_text: bool = True) -> DataFrame:
    """All rows with ``p_quality``, ``p_toxic``, ``evidence``, ``site_shift``, ``posterior`` and ``accepted``."""
    models = train(df, labels, id_col, text_col)
    df = df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in ADDED))
    scored = scratch.keep(evidence(df, text_col, models, keep_text=keep_text), "scored")
    of_host, of_path, salt, of_salt = (unused(x, scored.columns) for x in ("_host", "_path", "_salt", "_of_salt"))
    shifts = scratch.keep(sites(scored, host, path, scratch), "sites").withColumnsRenamed({"host": of_host, "path": of_path})
    same = F.col(f"`{host}`").eqNullSafe(F.col(of_host)) & F.col(f"`{path}`").eqNullSafe(F.col(of_path))
    if shifts.limit(SITES_BROADCAST + 1).count() <= SITES_BROADCAST:
        joined = scored.join(F.broadcast(shifts), same, "left")
    else:  # a site may have a third of all rows
        dealt = scored.withColumn(salt, F.pmod(F.xxhash64(F.col(f"`{id_col}`"), "evidence"), F.lit(SALTS)))
        joined = dealt.join(shifts.withColumn(of_salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), same & (F.col(salt) == F.col(of_salt)), "left").drop(salt, of_salt)
    odds = F.col("evidence") + SITE_WEIGHT * F.coalesce("site_shift", F.lit(0.0))
    out = joined.drop(of_host, of_path).withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return out.withColumn("accepted", F.col("posterior") >= ACCEPT)


def accept(df: DataFrame, labels: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", host: str = "source", path: str = "lang") -> DataFrame:
    """The accepted rows of ``df``, with its columns whatever their names."""
    place = {c: f"c{i}" for i, c in enumerate(df.columns)}
    own = labels.withColumnRenamed(id_col, place[id_col])
    judged = classify(df.toDF(*place.values()), own, scratch, id_col=place[id_col], text_col=place[text_col], host=place[host], path=place[path])
    return judged.filter("accepted").select(*(F.col(new).alias(old) for old, new in place.items()))
