"""Language identification by the ends of words: a model that is counted in Spark and scored by numpy in Arrow batches.

Each word gives two n-grams, its first and its last three characters (fewer where it is shorter), each
numbered by its code points; short words are among them whole.  A language's weight of a number is the
logarithm of its smoothed share, as a whole number, so sums do not depend on their order.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions.text import normalize_ws
from weir.operators.pack import slices

NONE = "und_Latn"
UNIT = 1000  # weights are in thousandths


def words_of(text: Column) -> Column:
    """Lower-cased words."""
    return F.array_remove(F.split(normalize_ws(F.lower(text)), " "), "")


def _number(a: Column, b: Column, c: Column, buckets: int) -> Column:
    return (F.ascii(a) * 961 + F.ascii(b) * 31 + F.ascii(c)) % buckets


def numbers_of(words: Column, buckets: int) -> Column:
    """The numbers of all words' n-grams: first ones below ``buckets``, last ones from there on."""
    char = lambda w, i: F.substring(w, i, 1)

    def both(w: Column) -> Column:
        return F.array(_number(char(w, 1), char(w, 2), char(w, 3), buckets), _number(char(w, -1), char(w, -2), char(w, -3), buckets) + buckets)

    return F.flatten(F.transform(words, both))


def score_words(text: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of each language's weights, languages by texts, and the number of n-grams of each text; words are parted by single spaces."""
    texts = ["" if t is None else t for t in text.to_pylist()]
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    points = np.frombuffer("".join(f"{t} " for t in texts).encode("utf-32-le"), "<u4").astype(np.int64)
    inside = np.concatenate([[False], points != 32, [False]])
    first, end = (np.flatnonzero(x) for x in (inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]))
    of = np.searchsorted(np.cumsum(sizes), first, side="right")
    buckets = weights.shape[1] // 2

    def number(step: int, start: np.ndarray, last: np.ndarray) -> np.ndarray:
        a, b, c = (np.where((last - start) * step >= i, points[np.clip(start + step * i, 0, len(points) - 1)], 0) for i in range(3))
        return (a * 961 + b * 31 + c) % buckets

    front, back = number(1, first, end), number(-1, end, first) + buckets
    sums = np.array([np.bincount(of, w[front] + w[back], len(texts)) for w in weights])
    return sums, 2 * np.bincount(of, minlength=len(texts))


@dataclass
class NgramModel:
    """Labels in order, and each one's weights of the 2 * ``buckets`` numbers."""

    labels: list[str]
    weights: list[list[int]]
    buckets: int

    def predict(self, text: Column) -> Column:
        """struct<lid, prob> of a text; null stays null.  No shuffle: the highest score, the first label of equals; without words NONE and 0.

        Words are made in Spark, their numbers and weights are looked up by numpy in parts of about 1 MB of text.
        """
        weights, labels = np.array(self.weights, np.float64), np.array(self.labels, object)

        @F.arrow_udf("struct<lid:string,prob:double>")
        def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for part in slices(batches):
                sums, n = score_words(part, weights)
                shares = 1.0 / sum(np.exp((s - sums.max(axis=0)) / UNIT) for s in sums)
                lid, prob = np.where(n > 0, labels[sums.argmax(axis=0)], NONE), np.where(n > 0, shares, 0.0)
                empty = part.is_null()
                yield pa.StructArray.from_arrays([pa.array(lid.tolist(), pa.string()), pa.array(prob, pa.float64())], ["lid", "prob"], mask=empty)

        return scored(normalize_ws(F.lower(text)))

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            json.dump({"labels": self.labels, "buckets": self.buckets, "weights": self.weights}, f)

    @classmethod
    def load(cls, path: str) -> NgramModel:
        with open(path, encoding="utf-8") as f:
            return cls(**json.load(f))


def fit_language_model(rows: DataFrame, text: str = "text", label: str = "lang", max_rows: int | None = None, buckets: int = 4096, seed: int = 7, per_label: int = 200) -> NgramModel:
    """A model of all labelled rows, counted in one pass.

    The labels times 2 * ``buckets`` counts come to the driver.  Rows without label or text do not count.  Only where ``max_rows`` is given,
    rows beyond it are sampled by a digest of their text to about that many, of rare labels at least ``per_label`` or all there are.
    """
    rows = rows.select(F.col(text).alias("t"), F.col(label).alias("l")).where(F.col("t").isNotNull() & F.col("l").isNotNull())
    have = {} if max_rows is None else {r.l: r.n for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if have and max_rows < sum(have.values()):
        share = max_rows / sum(have.values())
        keep = F.element_at(F.create_map(*[F.lit(x) for k, n in have.items() for x in (k, max(share, min(1.0, per_label / n)))]), F.col("l"))
        u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}-"), "t")), 1, 8), 16, 10).cast("double") / float(1 << 32)
        rows = rows.where(u < keep)
    # a row without words leaves its label, without a number
    counted = rows.select("l", F.explode_outer(numbers_of(words_of(F.col("t")), buckets)).alias("b")).groupBy("l", "b").agg(F.count("*").alias("n")).collect()
    labels = sorted({*have, *(r.l for r in counted)})
    if not labels:
        raise ValueError("there are no labelled rows")
    counts = {x: [0] * (2 * buckets) for x in labels}
    for r in counted:
        if r.b is not None:
            counts[r.l][r.b] = r.n
    weights = [[math.floor(UNIT * math.log((n + 0.5) / (sum(counts[x]) + buckets))) for n in counts[x]] for x in labels]
    return NgramModel(labels, weights, buckets)


@dataclass
class StopWords:
    """The language with most of its frequent short words in a text; the stand-in where there are no labelled rows and no model."""

    lists: dict[str, list[str]]

    def predict(self, text: Column) -> Column:
        """struct<lid, prob> of a text, prob being the share of all listed words found; null stays null."""
        labels = sorted(self.lists)
        words = F.transform(words_of(text), lambda w: F.btrim(w, F.lit(".,;:!?")))

        def found(ws: Column, label: str) -> Column:
            return F.size(F.filter(ws, lambda w: w.isin(self.lists[label])))

        hits = F.transform(F.array(words), lambda ws: F.array(*[found(ws, x) for x in labels]))

        def best(h: Column) -> Column:
            total = F.aggregate(h, F.lit(0), lambda a, n: a + n)
            lid = F.element_at(F.array(*[F.lit(x) for x in labels]), F.array_position(h, F.array_max(h)).cast("int"))
            return F.when(total > 0, F.struct(lid.alias("lid"), (F.array_max(h) / total).alias("prob"))).otherwise(F.struct(F.lit(NONE).alias("lid"), F.lit(0.0).alias("prob")))

        return F.when(text.isNotNull(), F.get(F.transform(hits, best), 0))
