"""Toxicity scores by a factorization machine over hashed terms.

Terms are runs of letters and digits, lower-cased and hashed to 2**HASH_BITS
buckets; a text is the set of its buckets.  The model is a bias, a weight for
each bucket and a short vector for each bucket whose dot products are the
weights of pairs, so a pair such as an insult with a group's name counts
beyond what either adds alone.  It is fitted on a bounded sample of labelled
rows (``max_rows``, by hash of doc_id).  A bucket enters by itself, where its document frequency
differs between the labels, or by a pair, where the rows that hold both are toxic
more or less often than the terms alone explain, though each may be neutral.
Scoring reads all of every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HASH_BITS = 26
CACHE_WORDS = 300_000
_TERM = re.compile(r"[^\W_]+")


def bucket(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass")) & ((1 << HASH_BITS) - 1)


def terms(text: str | None) -> set[str]:
    return set(_TERM.findall((text or "").lower()))


class Machine:
    """bias + sum of weights + sum over pairs of vector dot products, through a logistic."""

    def __init__(self, buckets: np.ndarray, bias: float, weights: np.ndarray, vectors: np.ndarray):
        self.place = {int(b): i for i, b in enumerate(buckets)}
        self.bias, self.weights, self.vectors = bias, weights, vectors
        self.cache: dict[str, int] = {}

    def score(self, text: str | None) -> float:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        at, seen = set(), self.cache
        for t in terms(text):
            i = seen.get(t)
            if i is None:
                i = seen[t] = self.place.get(bucket(t), -1)
            if i >= 0:
                at.add(i)
        z = self.bias
        if at:
            k = sorted(at)
            v = self.vectors[k]
            z += float(self.weights[k].sum() + 0.5 * (v.sum(0) ** 2 - (v**2).sum(0)).sum())
        return 1.0 / (1.0 + float(np.exp(-np.clip(z, -500, 500))))


def interacting(start: np.ndarray, at: np.ndarray, labels: np.ndarray, chance: np.ndarray, among: np.ndarray, nats: float, least: int) -> set[int]:
    """Terms of the pairs, one of them in ``among``, whose rows are toxic more or less often than ``chance`` of each row explains.

    Row k holds the terms ``at[start[k]:start[k + 1]]`` in ascending order.  A pair counts where the
    likelihood ratio of its rows, a bound of how probable such a share is by chance, reaches ``nats``, in ``least`` rows or more.
    """
    who = np.repeat(np.arange(len(start) - 1), np.diff(start))
    order = np.argsort(at, kind="stable")
    of = at[order]
    out: set[int] = set()
    for i in among:
        pos = order[np.searchsorted(of, i) : np.searchsorted(of, i, side="right")]
        row = who[pos]
        toxic = int(labels[row].sum())
        first = np.argsort(-labels[row], kind="stable")  # toxic rows first
        pos, row = pos[first], row[first]
        size = pos - start[row]  # terms of the row below i: each pair is met once
        ends = np.cumsum(size)
        if not len(ends) or not ends[-1]:
            continue
        j = at[np.repeat(start[row] - (ends - size), size) + np.arange(ends[-1])]
        cut = ends[toxic - 1] if toxic else 0
        x = np.bincount(j[:cut], minlength=i)
        n = x + np.bincount(j[cut:], minlength=i)
        seen = np.flatnonzero(n >= least)
        e = np.bincount(j, weights=np.repeat(chance[row], size), minlength=i)[seen]
        x, n = x[seen].astype(np.float64), n[seen].astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(x > 0, x * np.log(x / e), 0) + np.where(n > x, (n - x) * np.log((n - x) / (n - e)), 0)
        hit = seen[gain >= nats]
        if len(hit):
            out.update([int(i), *hit.tolist()])
    return out


def _fewest(inv: np.ndarray, who: np.ndarray, chance: np.ndarray, terms: int, nats: float) -> np.ndarray:
    """For each term the number of rows below which no pair of it can reach ``nats``.

    A pair of n rows says n times what its share of toxic rows is apart from their mean chance, and no share is further apart than
    the logarithm of the least chance, of being toxic or not, that any row of the term has.
    """
    least = np.full(terms, 0.5)
    np.minimum.at(least, inv, np.minimum(chance[who], 1 - chance[who]))
    return nats / -np.log(np.maximum(least, 1e-12))


def _interacting_on(spark: SparkSession, tasks: int, start, at, labels, chance, count: int, nats: float, least: int) -> set[int]:
    """The same for all ``count`` terms, dealt over tasks; the sample is bounded, so each task is sent the whole of it."""
    sent = spark.sparkContext.broadcast((start, at, labels, chance))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column("id").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(sorted(interacting(*sent.value, np.arange(t, count, tasks), nats, least)), pa.int32())], names=["term"])

    found = {r.term for r in spark.range(0, tasks, 1, tasks).mapInArrow(run, "term int").distinct().collect()}
    sent.unpersist()
    return found


class _Sparse:
    """A matrix of zeros and ones by the places of its ones, row by row."""

    def __init__(self, who: np.ndarray, col: np.ndarray, rows: int, cols: int):
        self.who, self.col, self.shape = who, col, (rows, cols)
        size = np.bincount(who, minlength=rows)
        self.full = np.flatnonzero(size)
        self.start = (np.cumsum(size) - size)[self.full]

    def times(self, v: np.ndarray) -> np.ndarray:
        out = np.zeros((self.shape[0], *v.shape[1:]))
        if len(self.full):
            out[self.full] = np.add.reduceat(v[self.col], self.start, axis=0)
        return out

    def turned(self, e: np.ndarray) -> np.ndarray:
        """The transpose times a vector or matrix."""
        one = lambda x: np.bincount(self.col, weights=x[self.who], minlength=self.shape[1])
        return one(e) if e.ndim == 1 else np.stack([one(x) for x in e.T], axis=1)


def _descend(x: _Sparse, labels: np.ndarray, bias: float, factors: int, rounds: int, ridge: float, weight: float, seed: int) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Bias, weights and vectors by Adam on the log loss, and the score of each row before the logistic."""
    n = len(labels)
    scale = np.where(labels > 0, weight, 1.0) / n
    rng = np.random.Generator(np.random.PCG64(seed))
    par = [np.array([bias]), np.zeros(x.shape[1]), rng.normal(0, 0.01, (x.shape[1], factors))]
    mom = [[np.zeros_like(a), np.zeros_like(a)] for a in par]
    for t in range(1, rounds + 1):
        b, w, v = par
        s = x.times(v)
        zed = b[0] + x.times(w) + 0.5 * (s**2 - x.times(v**2)).sum(1)
        err = (1 / (1 + np.exp(-np.clip(zed, -500, 500))) - labels) * scale
        gx = x.turned(err)
        grads = [np.array([err.sum()]), gx + ridge * w / 10, x.turned(err[:, None] * s) - gx[:, None] * v + ridge * v]
        for a, g, m in zip(par, grads, mom, strict=True):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.999 * m[1] + 0.001 * g * g
            a -= 0.05 * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.999**t)) + 1e-8)
    return float(par[0][0]), par[1], par[2], zed


def fit(rows: list[np.ndarray], labels: np.ndarray, factors: int = 4, rounds: int = 400, least: int = 4, z_least: float = 4.0, ridge: float = 3e-5, weight: float = 4.0, seed: int = 7, spark: SparkSession | None = None, tasks: int = 32) -> Machine:
    """Chooses terms and fits the machine; positive rows count ``weight`` times.

    The first machine has the terms whose document frequency differs between the labels by
    ``z_least``.  Then every pair of terms is held against what that machine expects of its rows;
    terms of pairs that differ beyond chance (one pair in 20 such samples) join, and a second
    machine is fitted.  Terms and pairs in fewer than ``least`` rows do not enter.  With ``spark`` the pairs are dealt over ``tasks`` tasks.
    """
    labels = np.asarray(labels, dtype=np.float64)
    n, pos = len(rows), float(labels.sum())
    prior = (pos + 0.5) / (n + 1)
    bias = float(np.log(prior / (1 - prior)))
    none = Machine(np.empty(0, np.int64), bias, np.empty(0), np.empty((0, factors)))
    if not n or not 0 < pos < n:
        return none
    flat = np.concatenate([*rows, np.empty(0, np.int64)])
    who = np.repeat(np.arange(n), [len(r) for r in rows])
    ids, inv = np.unique(flat, return_inverse=True)
    df = np.bincount(inv, minlength=len(ids))
    dp = np.bincount(inv, weights=labels[who], minlength=len(ids))
    p = (df + 1) / (n + 2)
    z = (dp / pos - (df - dp) / (n - pos)) / np.sqrt(p * (1 - p) * (1 / pos + 1 / (n - pos)))

    def machine(ok: np.ndarray) -> tuple[Machine, np.ndarray]:
        new = np.full(len(ids), -1)
        new[ok] = np.arange(len(ok))
        hit = new[inv] >= 0
        b, w, v, zed = _descend(_Sparse(who[hit], new[inv][hit], n, len(ok)), labels, bias, factors, rounds, ridge, weight, seed)
        return Machine(ids[ok], b, w, v), zed

    main = np.flatnonzero((np.abs(z) >= z_least) & (df >= least))
    first, chance = none, np.full(n, pos / n)
    if len(main):
        first, zed = machine(main)
        odds = np.exp(np.clip(zed, -30, 30)) / weight  # without the weight of positive rows
        chance = odds / (1 + odds)

    nats = float(np.log(20.0 * max(1, int((df >= least).sum())) ** 2 / 2))
    common = np.flatnonzero(df >= np.maximum(least, np.ceil(_fewest(inv, who, chance, len(ids), nats))))
    place = np.full(len(ids), -1)
    place[common] = np.arange(len(common))
    keep = place[inv] >= 0
    at = place[inv][keep]
    start = np.concatenate([[0], np.cumsum(np.bincount(who[keep], minlength=n))])
    sample = (start, at, labels, chance)
    found = interacting(*sample, np.arange(len(common)), nats, least) if spark is None else _interacting_on(spark, tasks, *sample, len(common), nats, least)
    both = np.union1d(main, common[sorted(found)]).astype(np.int64)
    if len(both) == len(main):
        return first
    return machine(both)[0]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [sorted({bucket(t) for t in terms(x)}) for x in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.int32())), b.column("label"), b.column("h")], names=["terms", "label", "h"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 12000, **how) -> Machine:
    """Texts of ``docs`` (doc_id, text) with labels (doc_id, label) -> model.

    Uses the ``max_rows`` labels with the smallest hash of doc_id, few enough to be sent to
    every task, so no text is shuffled; null labels are left out.  Of the rows that these labels meet, which are more
    where doc_ids repeat, ``max_rows`` at most come to the driver, those of the smallest hash of doc_id and text.  ``how`` goes to ``fit``.
    """
    some = labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    met = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "label", F.xxhash64("doc_id", "text", "label").alias("h"))
    got = met.mapInArrow(_hashed, "terms array<int>, label int, h long").orderBy("h", "label").limit(max_rows).collect()
    got.sort(key=lambda r: (r.label, len(r.terms), r.terms))
    return fit([np.array(r.terms, dtype=np.int64) for r in got], np.array([r.label for r in got]), **{"spark": docs.sparkSession} | how)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def score(docs: DataFrame, model: Machine, carry: tuple[str, ...] = ("doc_id",), threshold: float = 0.7) -> DataFrame:
    """``carry`` columns with score and predicted; null and empty texts get the score of the bias alone."""
    names = list(carry)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [model.score(x) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())], names=[*names, "score", "predicted"])

    return docs.select(*{**dict.fromkeys(names), "text": None}).mapInArrow(run, f"{ddl}, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 12000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Labels of held-out rows are not read.  A term enters by itself if |z| of its document frequencies is 4 or more, or by a pair, in 4 rows or more
    either way (``fit``); rarer terms have no weight.  Texts are read whole, however long.  Ties among labels at ``max_rows`` go by doc_id.  Without labels of both kinds the score is the prior's.
    Repeated rows are scored alike; a null doc_id is scored but never trains.
    """
    known = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))
    model = train(docs, known, max_rows)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
