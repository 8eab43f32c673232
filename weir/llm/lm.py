"""Language-model scores: prediction by partial matching over bytes, beside a unigram word model.

Training counts every (context, byte) pair of ORDER bytes of context.  A context's
escape probability is that of method C: distinct successors over all
successors and distinct ones; what longer contexts have offered is excluded
from shorter ones.  The trie is kept as rows (gram, count) spread by the two
bytes before the predicted one, so each part holds whole suffix chains; the
two lowest orders, of at most 65,536 pairs, go to every part.  Code lengths of
the grams in use are looked up while texts stream by; a fixed number of the
most used grams and words is sent to every task and the rest is joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import Stash

ORDER = 5
START, END = 0xFE, 0xFF  # bytes that no UTF-8 text has
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MULT = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased; the six separators are those of bytes.split."""
    return text.translate(_LOWER).split()


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The gram at each byte and at the end of each text, and where texts start among them."""
    pad = bytes([START]) * ORDER
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    joined = np.frombuffer(b"".join(x for t in texts for x in (pad, t, b"\xff")), dtype=np.uint8)
    key = np.zeros(len(joined) - ORDER if len(joined) else 0, dtype=np.uint64)
    for j in range(ORDER + 1):
        key = (key << np.uint64(8)) | joined[j : j + len(key)]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.empty(0, np.int64)
    keep = np.ones(len(key), dtype=bool)
    for j in range(ORDER):  # grams that end within the padding of a later text
        at = (starts + ORDER * np.arange(len(starts)))[1:] - 1 - j
        keep[at] = False
    return key[keep], starts


class Lookup:
    """Open addressing over 64-bit keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        n = 1 << self.bits
        self.keys = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.zeros(n, dtype=values.dtype)
        left, val, at = keys, values, self._slot(keys)
        while len(left):
            free = self.keys[at] == np.uint64(0xFFFFFFFFFFFFFFFF)
            _, first = np.unique(np.where(free, at, n + np.arange(len(at))), return_index=True)
            first = first[free[first]]
            self.keys[at[first]], self.values[at[first]] = left[first], val[first]
            rest = np.ones(len(left), dtype=bool)
            rest[first] = False
            left, val, at = left[rest], val[rest], (at[rest] + 1) & (n - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULT) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values and whether each key is there."""
        at = self._slot(keys)
        got = self.keys[at]
        out, found = self.values[at], got == keys
        todo = np.flatnonzero(~found & (got != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            got = self.keys[at[todo]]
            hit = got == keys[todo]
            out[todo[hit]], found[todo[hit]] = self.values[at[todo[hit]]], True
            todo = todo[~hit & (got != np.uint64(0xFFFFFFFFFFFFFFFF))]
        out[~found] = 0
        return out, found


def held_out(doc_id: Column, folds: int = 10) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def _chunks(texts: list[bytes], size: int = 1 << 21) -> Iterator[tuple[int, int]]:
    lo = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= size:
            yield lo, i + 1
            lo, n = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    k, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return k, np.bincount(inv, weights=np.concatenate([p[1] for p in parts]), minlength=len(k)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: grams and words with their counts in training texts (c) and in all (u)."""
    sides: dict[bool, list] = {False: [], True: []}
    known: dict[bool, Counter] = {False: Counter(), True: Counter()}

    def flush_words(held: bool) -> Iterator[pa.RecordBatch]:
        ws = list(known[held].items())
        known[held].clear()
        for i in range(0, len(ws), 50_000):
            some = ws[i : i + 50_000]
            k = np.array([c for _, c in some], dtype=np.int64)
            yield _row(None, [w for w, _ in some], k * (not held), k)

    def _row(gram, word, c, u) -> pa.RecordBatch:
        n = len(c)
        g = pa.array(gram.astype(np.int64)) if gram is not None else pa.nulls(n, pa.int64())
        w = pa.array(word, pa.binary()) if word is not None else pa.nulls(n, pa.binary())
        return pa.RecordBatch.from_arrays([g, w, pa.array(c), pa.array(u)], names=["gram", "word", "c", "u"])

    for b in batches:
        held = np.array(b.column("held_out").to_pylist(), dtype=bool)
        data = b.column("text").cast(pa.binary()).to_pylist()
        for side in (False, True):
            texts = [data[i] or b"" for i in np.flatnonzero(held == side)]
            for lo, hi in _chunks(texts):
                k, c = np.unique(grams(texts[lo:hi])[0], return_counts=True)
                sides[side].append((k, c))
                if sum(len(p[0]) for p in sides[side]) > 3_000_000:
                    sides[side] = [_merge(sides[side])]
                    if len(sides[side][0][0]) > 1_500_000:
                        k, c = sides[side].pop()
                        yield _row(k, None, c * (not side), c)
                for t in texts[lo:hi]:
                    known[side].update(tokens(t))
                    known[side][b""] += 1
                if len(known[side]) > 600_000:
                    yield from flush_words(side)
    for side in (False, True):
        yield from flush_words(side)
        if sides[side]:
            k, c = _merge(sides[side])
            for i in range(0, len(k), 200_000):
                yield _row(k[i : i + 200_000], None, c[i : i + 200_000] * (not side), c[i : i + 200_000])


class _Level:
    """Counts of one order: pairs by gram, totals and distinct successors by context."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int):
        mask = np.uint64((1 << (8 * (order + 1))) - 1)
        seen = counts > 0
        self.keys, inv = np.unique(keys[seen] & mask, return_inverse=True)
        self.counts = np.bincount(inv, weights=counts[seen], minlength=len(self.keys))
        self.mask = mask
        self.ctx, inv = np.unique(self.keys >> np.uint64(8), return_inverse=True)
        self.n = np.bincount(inv, weights=self.counts, minlength=len(self.ctx))
        self.q = np.bincount(inv, minlength=len(self.ctx)).astype(float)
        self.inv = inv

    @staticmethod
    def _find(table: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not len(table):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, values[at], 0.0)

    def count(self, keys):
        return self._find(self.keys, self.counts, keys & self.mask)

    def node(self, keys, values):
        return self._find(self.ctx, values, (keys & self.mask) >> np.uint64(8))

    def offered(self, lower: _Level) -> np.ndarray:
        """Per context: what its successors count in the context one shorter."""
        return np.bincount(self.inv, weights=lower.count(self.keys), minlength=len(self.ctx))


def code_lengths(keys: np.ndarray, counts: np.ndarray, low_keys: np.ndarray, low_counts: np.ndarray) -> np.ndarray:
    """log10 probability of each gram's last byte after its context.

    ``keys`` hold whole suffix chains down to two bytes of context; ``low_*`` are all pairs of order 1.
    """
    levels = [_Level(low_keys, low_counts, 0), _Level(low_keys, low_counts, 1)] + [_Level(keys, counts, j) for j in range(2, ORDER + 1)]
    out, open_ = np.zeros(len(keys)), np.ones(len(keys), dtype=bool)
    gone_n, gone_q = np.zeros(len(keys)), np.zeros(len(keys))  # excluded from this order
    for j in range(ORDER, -1, -1):
        lv = levels[j]
        n, q, c = lv.node(keys, lv.n), lv.node(keys, lv.q), lv.count(keys)
        n2, q2 = n - gone_n, q - gone_q
        here = open_ & (c > 0)
        out[here] += np.log10(c[here] / (n2 + q2)[here])
        open_ &= ~here
        esc = open_ & (n > 0) & (n2 > 0)
        out[esc] += np.log10((q2 / np.maximum(n2 + q2, 1e-300))[esc])
        if j:
            gone_n = np.where(n > 0, lv.node(keys, lv.offered(levels[j - 1])), 0.0)
            gone_q = np.where(n > 0, q, 0.0)
        else:
            out[open_] -= np.log10(256 - q[open_])
    return out


def _fit_part(low_keys: np.ndarray, low_counts: np.ndarray):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_ = list(frames)
        if not all_ or not sum(len(f) for f in all_):
            return
        f = pd.concat(all_)
        yield pd.DataFrame({"gram": f["gram"], "u": f["u"], "bits": code_lengths(f["gram"].to_numpy().astype(np.uint64), f["c"].to_numpy(), low_keys, low_counts)})

    return run


def hot_bound(table: DataFrame, most: int) -> int:
    """The least use count such that at most ``most`` rows have it, to a power of two."""
    hist = {r.b: r.k for r in table.groupBy(F.floor(F.log2("u")).alias("b")).agg(F.count("*").alias("k")).collect()}
    total, bound = 0, 0
    for b in sorted(hist, reverse=True):
        total += hist[b]
        if total > most:
            bound = 1 << (int(b) + 1)
            break
    return bound


def score(docs: DataFrame, folds: int = 10, hot_grams: int = 4_000_000, hot_words: int = 300_000) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    Learns from rows whose crc32(doc_id as text) mod ``folds`` is not 0; a null doc_id trains.
    Null texts are empty ones, scored by their end alone.  Without training
    rows every byte is equally likely and base_score takes N = V = 0.
    Repeated rows are scored alike, and ties do not arise.  Texts are scored whole, in pieces; other columns are not read.
    """
    spark = docs.sparkSession
    stash = Stash(spark, "ppm")
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id"), folds).alias("held_out"))
    counts = stash.put(rows.select("text", "held_out").mapInArrow(_count, "gram long, word binary, c long, u long").groupBy("gram", "word").agg(F.sum("c").alias("c"), F.sum("u").alias("u")))
    gram_rows, word_rows = counts.filter(F.col("gram").isNotNull()).select("gram", "c", "u"), counts.filter(F.col("word").isNotNull()).select("word", "c", "u")
    total = word_rows.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.coalesce(F.sum((F.col("c") > 0).cast("long")), F.lit(0)).alias("v")).first()
    low = gram_rows.groupBy(F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("g")).agg(F.sum("c").alias("c")).orderBy("g").collect()  # at most 65,536
    low_keys, low_counts = np.array([r.g for r in low], dtype=np.uint64), np.array([r.c for r in low], dtype=np.int64)
    parted = gram_rows.repartition(F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF)))
    model = stash.put(parted.mapInPandas(_fit_part(low_keys, low_counts), "gram long, u long, bits double"))

    base = lambda c: math.log10((c + 0.1) / (total.n + 0.1 * (total.v + 1)))
    g_least, w_least = hot_bound(model, hot_grams), hot_bound(word_rows, hot_words)
    got = model.filter(F.col("u") >= g_least).select("gram", "bits").toArrow()
    hot_g = spark.sparkContext.broadcast((got.column("gram").to_numpy().astype(np.uint64), got.column("bits").to_numpy()))
    got = word_rows.filter(F.col("u") >= w_least).select("word", "c").toArrow()
    hot_w = spark.sparkContext.broadcast((got.column("word").to_pylist(), got.column("c").to_pylist()))
    del got
    stored: dict = {}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with what the hot tables give, and rows for the grams and words that they lack."""
        if not stored:
            stored["g"] = Lookup(*hot_g.value)
            stored["w"] = {w: (base(c), c > 0) for w, c in zip(*hot_w.value, strict=True)}
        lookup, hot, part, n = stored["g"], stored["w"], TaskContext.get().partitionId() << 33, 0

        def rest(ids, gram, word, times) -> pa.RecordBatch:
            k = len(ids)
            null = lambda t: pa.nulls(k, t)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), null(pa.int64()), null(pa.bool_()), null(pa.int64()), null(pa.int64()), null(pa.float64()), null(pa.float64()), pa.array(gram, pa.int64()) if gram is not None else null(pa.int64()), pa.array(word, pa.binary()) if word is not None else null(pa.binary()), pa.array(times, pa.int64())], names=names)

        for b in batches:
            data = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            ids = part + n + np.arange(len(data), dtype=np.int64)
            n += len(data)
            score_, base_, n_tok, n_known = np.zeros(len(data)), np.zeros(len(data)), np.zeros(len(data), np.int64), np.zeros(len(data), np.int64)
            for lo, hi in _chunks(data):
                keys, starts = grams(data[lo:hi])
                bits, found = lookup.get(keys)
                score_[lo:hi] = np.add.reduceat(bits, starts)
                if not found.all():
                    miss = np.flatnonzero(~found)
                    who = np.searchsorted(starts, miss, side="right") - 1 + lo
                    pairs, times = np.unique(np.stack([who.astype(np.uint64), keys[miss]]), axis=1, return_counts=True)
                    yield rest(ids[pairs[0].astype(np.int64)], pairs[1].astype(np.int64), None, times)
            m_id, m_word, m_times = [], [], []
            for i, t in enumerate(data):
                ws = tokens(t)
                ws.append(b"")
                n_tok[i] = len(ws)
                got = [hot.get(w) for w in ws]
                if None in got:
                    own = Counter(w for w, g in zip(ws, got, strict=True) if g is None)
                    m_id += [int(ids[i])] * len(own)
                    m_word += own.keys()
                    m_times += own.values()
                    got = [g for g in got if g is not None]
                base_[i] = math.fsum(g[0] for g in got)
                n_known[i] = sum(g[1] for g in got)
                if len(m_id) > 100_000:
                    yield rest(m_id, None, m_word, m_times)
                    m_id, m_word, m_times = [], [], []
            if m_id:
                yield rest(m_id, None, m_word, m_times)
            k = len(data)
            yield pa.RecordBatch.from_arrays([pa.array(ids), b.column("doc_id"), b.column("held_out"), pa.array(n_tok), pa.array(n_known), pa.array(base_), pa.array(score_), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64())], names=names)

    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "gram", "word", "times"]
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    scanned = stash.put(rows.mapInArrow(scan, f"row long, doc_id {doc_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double, gram long, word binary, times long"))
    zero, none = F.lit(0.0), F.lit(0).cast("long")
    c_log = F.log10((F.col("c") + 0.1) / F.lit(total.n + 0.1 * (total.v + 1)))
    more_w = scanned.filter(F.col("word").isNotNull()).select("row", "word", "times").join(word_rows.filter(F.col("u") < w_least).select("word", "c"), "word").select("row", F.when(F.col("c") > 0, F.col("times")).otherwise(none).alias("k"), (F.col("times") * c_log).alias("b"), zero.alias("s"))
    more_g = scanned.filter(F.col("gram").isNotNull()).select("row", "gram", "times").join(model.filter(F.col("u") < g_least).select("gram", "bits"), "gram").select("row", none.alias("k"), zero.alias("b"), (F.col("times") * F.col("bits")).alias("s"))
    own = scanned.filter(F.col("gram").isNull() & F.col("word").isNull())
    parts = own.select("row", "doc_id", "held_out", "n_tokens", F.col("n_known").alias("k"), F.col("base_score").alias("b"), F.col("score").alias("s")).unionByName(more_w.unionByName(more_g), allowMissingColumns=True)
    return parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("k").alias("n_known"),
        F.lit(int(total.n)).cast("long").alias("train_tokens"), F.sum("b").alias("base_score"), F.sum("s").alias("score"),
    ).drop("row")
