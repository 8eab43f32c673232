"""Exact substring dedup over bytes with a logarithmic family of suffix arrays.

Every window of LENGTH bytes is given to its anchor, the least of the hashed
K-byte strings in it, so equal windows have equal anchors at equal places.
Windows of one anchor are neighbours and make one segment.  Anchors that occur
once have no repeated window and go no further.  Equal segments of an anchor
repeat as a whole.  What remains, segments of one anchor that differ
somewhere, is decided by suffix arrays: the parts of the anchor space are
indexed independently, each in batches; a batch's suffixes are sorted,
merge-scanned against every existing level, and levels of equal size merge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import Stash, free_names

LENGTH, K = 200, 64
_BYTE = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_P), n, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def anchors(data: bytes, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place, first and last window start of each anchor of a text; ``k`` is a power of two."""
    n = len(data)
    if n < length:
        e = np.empty(0, np.int64)
        return np.empty(0, np.uint64), e, e, e
    h = _BYTE[np.frombuffer(data, dtype=np.uint8)]
    size = 1
    while size < k:
        h = h[: len(h) - size] * _power(size) + h[size:]
        size *= 2
    h = _mix(h)
    # least hash of each run of w, ties to the left: the place goes below the hash
    w, bits = length - k + 1, max(1, int(n).bit_length())
    low = np.uint64((1 << bits) - 1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while 2 * span <= w:
        m = np.minimum(m[: len(m) - span], m[span:])
        span *= 2
    if span < w:
        m = np.minimum(m[: len(m) - (w - span)], m[w - span :])
    at = (m & low).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    return h[at[first]], at[first], first, last


def _scan(length: int, k: int, full: bool):
    """Anchors of each text; ``full`` adds what tells segments and places apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(5)]
            held = 0

            def flush() -> pa.RecordBatch:
                cols = [pa.array(np.concatenate(c)) for c in out[: 5 if full else 1]]
                return pa.RecordBatch.from_arrays(cols, names=["anchor", "seg", "rid", "start", "shape"][: len(cols)])

            for rid, t in zip(b.column("rid").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                h, at, first, last = anchors(t or b"", length, k)
                if not len(h):
                    continue
                out[0].append(h.astype(np.int64))
                if full:
                    digest = xxhash.xxh3_64_intdigest
                    seg = [digest(t[i : j + length], p - i) for i, j, p in zip(first.tolist(), last.tolist(), at.tolist(), strict=True)]
                    out[1].append(np.array(seg, dtype=np.uint64).astype(np.int64))
                    out[2].append(np.full(len(h), rid, dtype=np.int64))
                    out[3].append(first)
                    out[4].append(((at - first) << 16 | (last - first)).astype(np.int32))
                held += len(h)
                if held > 200_000:
                    yield flush()
                    out, held = [[] for _ in range(5)], 0
            if held:
                yield flush()

    return run


class Family:
    """Sorted arrays of windows in levels of doubling size; tells which windows occur more than once."""

    def __init__(self, base: int = 4096):
        self.base = base
        self.levels: list[tuple[np.ndarray, np.ndarray] | None] = []
        self.hits: list[np.ndarray] = []  # ids found to repeat

    def add(self, keys: np.ndarray, ids: np.ndarray) -> None:
        """Sorts a batch, scans it for repeats in itself and in every level, and merges it in."""
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[order]
        same = keys[1:] == keys[:-1]
        self.hits.append(ids[np.concatenate([same, [False]]) | np.concatenate([[False], same])])
        first = np.concatenate([[True], ~same])  # one entry for each distinct window
        for level in self.levels:
            if level is not None:
                at = np.minimum(np.searchsorted(level[0], keys), len(level[0]) - 1)
                hit = level[0][at] == keys
                self.hits += [ids[hit], level[1][at[hit & first]]]
        keys, ids = keys[first], ids[first]
        rank = max(0, int(np.ceil(np.log2(max(1, len(keys)) / self.base))))
        while True:
            while len(self.levels) <= rank:
                self.levels.append(None)
            other = self.levels[rank]
            if other is None:
                break
            self.levels[rank] = None
            at = np.searchsorted(other[0], keys) + np.arange(len(keys))
            merged, who = np.empty(len(keys) + len(other[0]), keys.dtype), np.empty(len(keys) + len(other[0]), ids.dtype)
            rest = np.ones(len(merged), dtype=bool)
            rest[at] = False
            merged[at], who[at], merged[rest], who[rest] = keys, ids, other[0], other[1]
            keys, ids, rank = merged, who, rank + 1
        self.levels[rank] = (keys, ids)

    def repeated(self) -> np.ndarray:
        return np.unique(np.concatenate(self.hits)) if self.hits else np.empty(0, np.int64)


def _indexed(length: int, batch: int = 100_000):
    """Repeated windows of segments that come sorted by anchor; an index lives as long as its last anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(family: Family, single: list, counts: list) -> pa.RecordBatch | None:
            hit = family.repeated()
            edges = np.concatenate([[0], np.cumsum(counts)])
            seg = np.searchsorted(edges, hit, side="right") - 1
            keep = np.array([s is not None for s in single], dtype=bool)[seg] if len(hit) else np.empty(0, bool)
            hit, seg = hit[keep], seg[keep]
            if not len(hit):
                return None
            new = np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(seg) > 0)])
            lo, hi = np.flatnonzero(new), np.concatenate([np.flatnonzero(new)[1:], [len(hit)]]) - 1
            rid = np.array([single[s][0] for s in seg[lo]], dtype=np.int64)
            start = np.array([single[s][1] for s in seg[lo]], dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(rid), pa.array(start + hit[lo] - edges[seg[lo]]), pa.array(start + hit[hi] - edges[seg[lo]] + length)], names=["rid", "s", "e"])

        family, single, counts, total = Family(), [], [], 0
        chunk: list[np.ndarray] = []
        held, last = 0, None

        def feed() -> None:
            nonlocal chunk, held, total
            keys = np.concatenate(chunk)
            family.add(keys.view(f"S{length + 8}").ravel(), np.arange(total, total + len(keys)))
            total += len(keys)
            chunk, held = [], 0

        for b in batches:
            for anchor, salt, rid, start, n, data in zip(*(b.column(c).to_pylist() for c in ("anchor", "salt", "rid", "start", "n", "data")), strict=True):
                if held >= batch:
                    feed()
                    if last != (anchor, salt):
                        if (out := close(family, single, counts)) is not None:
                            yield out
                        family, single, counts, total = Family(), [], [], 0
                last = (anchor, salt)
                w = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, dtype=np.uint8), length)
                rows = np.empty((len(w), length + 8), dtype=np.uint8)
                rows[:, :8] = np.frombuffer(int(anchor).to_bytes(8, "big", signed=True), dtype=np.uint8)
                rows[:, 8:] = w
                chunk.append(rows)
                single.append((rid, start) if n == 1 else None)
                counts.append(len(w))
                held += len(w)
        if held:
            feed()
        if (out := close(family, single, counts)) is not None:
            yield out

    return run


def _slices(length: int, step: int):
    """Segments of texts for the index; those of hot anchors in parts by the anchor's place in the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, size = [], 0
            for rid, text, parts in zip(b.column("rid").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), b.column("parts").to_pylist(), strict=True):
                for p in parts:
                    start, off, span = p["start"], p["shape"] >> 16, p["shape"] & 0xFFFF
                    if not p["hot"]:
                        cuts = [(0, span)]
                    else:  # window start + i has the anchor at off - i
                        groups: dict[int, list[int]] = {}
                        for i in range(span + 1):
                            groups.setdefault((off - i) // step, []).append(i)
                        cuts = [(g[0], g[-1]) for g in groups.values()]
                    for lo, hi in cuts:
                        data = text[start + lo : start + hi + length]
                        rows.append((p["anchor"], (off - lo) // step if p["hot"] else 0, rid, start + lo, p["n"], data))
                        size += len(data)
                        if size > 4_000_000:
                            yield _table(rows)
                            rows, size = [], 0
            if rows:
                yield _table(rows)

    return run


def _table(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["anchor", "salt", "rid", "start", "n", "data"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that touch or overlap as one."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _cut(names: list[str], texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t, spans in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("spans").to_pylist(), strict=True):
                t = t or b""
                gone = merged([(p["s"], p["e"]) for p in spans or []])
                left, at = [], 0
                for s, e in gone:
                    left.append(t[at:s])
                    at = e
                kept = b"".join([*left, t[at:]])
                rows.append((len(t), len(t) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), *([kept, [{"s": s, "e": e} for s, e in gone]] if texts else [])))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * (6 if texts else 4)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=False))], names=[*names, *NEW[: len(cols)]])

    return run


NEW = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes", "removed"]


def dedup_substrings(docs: DataFrame, length: int = LENGTH, k: int = K, carry: tuple[str, ...] = ("doc_id",), texts: bool = False, hot: int = 1000, step: int = 16) -> DataFrame:
    """``carry`` columns with n_bytes, n_removed, n_spans and kept_sha256 (with ``texts`` also kept_bytes and the removed spans).

    Removes each byte covered by a ``length``-byte string that also starts anywhere else
    in the texts, the same text included.  A null text is an empty one.  Texts
    below ``length`` bytes are kept whole.  Repeated rows are occurrences of their own, so all copies of a text lose what they share.  Texts of any
    length are taken whole, in a few arrays of their size.  Columns that are not carried may have any names; carried ones may not be named like those that are added
    (ValueError).
    """
    free_names(carry, (*NEW, "rid", "spans"))
    spark = docs.sparkSession
    stash = Stash(spark, "suffix")
    keyed = docs.select(*{**dict.fromkeys(carry), "text": None}).withColumn("rid", F.xxhash64(F.coalesce("text", F.lit(""))))
    scan = keyed.filter(F.octet_length("text") >= length).select("rid", "text")
    twice = stash.put(scan.mapInArrow(_scan(length, k, False), "anchor long").groupBy("anchor").count().filter("count > 1").select("anchor"))
    found = stash.put(scan.mapInArrow(_scan(length, k, True), "anchor long, seg long, rid long, start long, shape int").join(twice, "anchor", "left_semi"))
    stash.drop(twice)
    kinds = stash.put(found.groupBy("anchor", "seg").agg(F.count("*").alias("n"), F.min(F.struct("rid", "start", "shape")).alias("at")))
    several = kinds.groupBy("anchor").agg(F.count("*").alias("variants"), F.min("n").alias("least")).filter("variants > 1 and least = 1").select("anchor", "variants")
    parts = kinds.join(several, "anchor").select("at.rid", F.struct("anchor", "n", "at.start", "at.shape", (F.col("variants") > hot).alias("hot")).alias("part"))
    parts = parts.groupBy("rid").agg(F.collect_list("part").alias("parts"))  # as many as one text has anchors
    sliced = scan.join(parts, "rid").groupBy("rid").agg(F.first("text").alias("text"), F.first("parts").alias("parts")).mapInArrow(_slices(length, step), "anchor long, salt int, rid long, start long, n long, data binary")
    spans = stash.put(sliced.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt").mapInArrow(_indexed(length), "rid long, s long, e long"))
    whole = found.join(kinds.filter("n > 1").select("anchor", "seg"), ["anchor", "seg"], "left_semi")
    whole = whole.select("rid", F.col("start").alias("s"), (F.col("start") + F.col("shape").bitwiseAND(F.lit(0xFFFF)) + length).alias("e"))
    gone = stash.put(whole.unionByName(spans).groupBy("rid").agg(F.collect_set(F.struct("s", "e")).alias("spans")))
    stash.drop(found, kinds, spans)
    names = list(carry)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    more = ", kept_bytes binary, removed array<struct<s: long, e: long>>" if texts else ""
    return keyed.join(gone, "rid", "left").select(*{**dict.fromkeys(names), "text": None, "spans": None}).mapInArrow(_cut(names, texts), f"{ddl}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{more}")
