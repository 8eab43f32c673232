"""Words one edit apart, by forward and reversed sorted dictionaries.

One edit leaves a half of the shorter word intact, at its start or at its end: words of
length L, and those one longer, meet in blocks that share the first L // 2 code points or the last ones.
A block of more than ``limit`` words is cut by the same rule for what its words do
not share yet: the next half of it from the start, or that from the end.  Blocks are ranges of a
dictionary sorted by what is shared; each is scanned and its pairs verified.  A pair meets
once: where it goes by the end, its shared start must be too short for the other way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import Stash, lower_ascii

RUN = r"[A-Za-zÀ-ÿ]"
#: Most keys of large blocks that are sent to every task instead of joined by shuffle.
SENT = 200_000
LONG = 256  # words beyond are compared one by one, not in a matrix


def spoken(docs: DataFrame, key: str, text: str, least: int, typo: int | None) -> DataFrame:
    """(word) of every run of letters with ``least`` code points or more; with ``typo`` a run whose checksum it divides loses one of them."""
    runs = F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{least},}}"), F.lit(0))
    one = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.explode(runs).alias("r")).withColumn("r", lower_ascii(F.col("r")))
    if typo is None:
        return one.select(F.col("r").alias("word"))
    h = F.crc32(F.concat("k", F.lit(":"), "r").cast("binary"))
    at = F.pmod("h", F.length("r").cast("long")).cast("int")
    cut = F.concat(F.substring("r", F.lit(1), at), F.substring("r", at + 2, F.length("r")))
    return one.withColumn("h", h).select(F.when(F.col("h") % typo == 0, cut).otherwise(F.col("r")).alias("word")).filter(F.length("word") >= least)


def _shared(lo: Column, hi: Column) -> Column:
    """What the words of a block share, as it is sorted: length, how much from either end, and the code points."""
    return F.concat_ws("/", F.col("len").cast("string"), lo.cast("string"), hi.cast("string"), F.substring("word", F.lit(1), lo), F.when(hi > 0, F.substring("word", F.length("word") - hi + 1, hi)).otherwise(""))


def _halved(rows: DataFrame) -> DataFrame:
    """Each (word, n, len, lo, hi, cap) by the next half from the start and by that from the end."""
    half = F.floor((F.col("len") - F.col("lo") - F.col("hi")) / 2).cast("int")
    first = F.struct((F.col("lo") + half).alias("lo"), F.col("hi").alias("hi"), F.col("cap").alias("cap"))
    last = F.struct(F.col("lo").alias("lo"), (F.col("hi") + half).alias("hi"), F.least("cap", F.col("lo") + half).alias("cap"))
    both = rows.select("word", "n", "len", F.explode(F.array(first, last)).alias("p")).select("word", "n", "len", "p.*").filter("lo < cap")
    return both.withColumn("block", _shared(F.col("lo"), F.col("hi")))


def _common(a: str, b: str) -> int:
    """Length of the shared start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is shared, a[:high] is not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def _one_edit(a: str, b: str) -> int | None:
    """Length of the shared start of words of equal length, or of b one longer, that are one edit apart."""
    k = _common(a, b)
    same = a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]
    return k if same and a != b else None


def _pairs(words: list[str], size: int, cap: int) -> list[tuple[int, int]]:
    """Places of a block's pairs one edit apart that share fewer than ``cap`` code points at the start."""
    short = [i for i, w in enumerate(words) if len(w) == size]
    long = [i for i, w in enumerate(words) if len(w) == size + 1]
    if size > LONG:
        near = [(i, j) for x, i in enumerate(short) for j in short[x + 1 :] + long if (k := _one_edit(words[i], words[j])) is not None and k < cap]
        return near
    out = []
    a = np.array([words[i] for i in short], dtype=f"U{size}").view(np.uint32).reshape(len(short), size)
    b = np.array([words[j] for j in long], dtype=f"U{size + 1}").view(np.uint32).reshape(len(long), size + 1)
    for x in range(len(short)):
        same = a[x + 1 :] == a[x]
        hit = np.flatnonzero((same.sum(axis=1) == size - 1) & (np.argmin(same, axis=1) < cap))
        out += [(short[x], short[x + 1 + y]) for y in hit.tolist()]
        if long:
            head = np.logical_and.accumulate(b[:, :size] == a[x], axis=1).sum(axis=1)
            tail = np.logical_and.accumulate((b[:, 1:] == a[x])[:, ::-1], axis=1).sum(axis=1)
            out += [(short[x], long[y]) for y in np.flatnonzero((head + tail >= size) & (head < cap)).tolist()]
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of every near pair of the blocks of a sorted stream."""
    at, words, counts, size, cap, out = None, [], [], 0, 0, []

    def found() -> None:
        for i, j in _pairs(words, size, cap):
            out.append((words[i], counts[i], words[j], counts[j]))
            out.append((words[j], counts[j], words[i], counts[i]))

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64()) * 2, strict=True)], names=["word", "n", "other", "m"])

    for b in batches:
        for k, w, n, length, c in zip(*(b.column(x).to_pylist() for x in ("block", "word", "n", "len", "cap")), strict=True):
            if (k, c) != at:
                found()
                if len(out) > 20_000:
                    yield batch()
                    out.clear()
                at, words, counts, size, cap = (k, c), [], [], length, c
            words.append(w)
            counts.append(n)
    found()
    if out:
        yield batch()


def near_words(words: DataFrame, stash: Stash, limit: int = 512) -> DataFrame:
    """(word, n) -> (word, n, other, m) of all pairs exactly one edit apart, in both directions."""
    none = F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(2**31 - 1).alias("cap")
    lengths = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("len")
    rows = _halved(words.select("word", "n", lengths).filter("len > 0").select("word", "n", "len", *none))
    done = None
    while True:
        rows = stash.put(rows)
        can = (F.col("len") - F.col("lo") - F.col("hi")) > 1  # what is left to share has halves
        large = stash.put(rows.filter(can).groupBy(F.col("block").alias("b"), F.col("cap").alias("c")).agg(F.count("*").alias("size")).filter(F.col("size") > limit).select("b", "c"))
        n = large.count()
        keys = F.broadcast(large) if n <= SENT else large
        same = (F.col("block") == F.col("b")) & (F.col("cap") == F.col("c"))
        small = rows if not n else rows.join(keys, same, "left_anti")
        sorted_ = small.repartitionByRange("block", "cap").sortWithinPartitions("block", "cap").select("block", "word", "n", "len", "cap")
        found = stash.put(sorted_.mapInArrow(_scan, "word string, n long, other string, m long"))
        done = found if done is None else done.unionByName(found)
        if not n:
            return done
        rows = _halved(rows.join(keys, same, "left_semi"))


def roots(forms: DataFrame, stash: Stash) -> DataFrame:
    """(word, form) -> (word, root), the end of each chain; every round doubles what was walked, and counts of forms grow tenfold a step, so rounds are few."""
    now = stash.put(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = stash.put(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = not new.filter("moved").isEmpty()
        stash.drop(now)
        now = new.drop("moved")
        if not moved:
            return now


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7, twice: int = 2, typo: int | None = None, ratio: int = 10, limit: int = 512) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of all texts: runs of letters of ``least`` code points or more that occur ``twice`` or more.

    A word's form is the near word (exactly one edit apart) of largest n, the least in code-point order
    among equals, if that n is ``ratio`` times the word's own or more, and null otherwise; its root is the end of the chain of forms.  Null and
    empty texts have no words, and a text or word of any length is taken whole; rows with one key count
    each; a null key counts as an empty one in the checksum.  Without words the result is empty; other columns are not read.
    ``limit`` only says when a block is cut further.
    """
    stash = Stash(docs.sparkSession, "spelling")
    words = stash.put(spoken(docs, key, text, least, typo).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= twice))
    near = near_words(words, stash, limit).groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    is_form = -F.col("best.m") >= ratio * F.col("n")
    near = stash.put(near.select("word", "n_near", F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")))
    ends = roots(near.filter(F.col("form").isNotNull()), stash)
    return words.join(near, "word", "left").join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
