"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same expected number of copies, its
source's target divided by the source's size.  The whole part is taken as it
is; the fractional parts are rounded in pairs: word mass moves at random
between two documents until one of them holds a whole number of copies, so a
pair keeps its words exactly and each document its expectation.  Leaves of a
bounded number of documents are reduced on their own; the one residual of
each leaf goes up a reduction tree, and the last residual of a source is
rounded alone.  A source's words therefore miss their target by less than one
document.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weir.llm.common import Stash, words

EPS = 1e-9


def word_count(text: Column) -> Column:
    """Words of a text; null gives 0."""
    return F.size(words(text)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> the same with target.

    Sources by code point, null last, take ``weights`` in turn and share ``share``
    of all sizes by weight; no target exceeds ``most`` times its source's size and
    the excess is shared again by weight.  In order of size per weight the full
    sources come first, so one pass of running sums finds the level of the rest.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    k = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (k + 1).cast("int"))
    cap = most * F.col("source_size").cast("double")
    one = W.orderBy("ratio", F.col("source").isNull(), "source")
    before = one.rowsBetween(W.unboundedPreceding, -1)
    rest = one.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy()
    level = (share * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    return (
        sizes.withColumn("w", w).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("w"))
        .withColumn("level", level)
        .withColumn("at", F.row_number().over(one))
        .withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("at", "level"))).over(whole)["level"])
        .withColumn("target", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap"))))
        .drop("w", "cap", "ratio", "level", "at")
    )


def unit(*key) -> float:
    """A number in [0, 1) that depends on the key alone."""
    return int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=8).digest(), "big") / 2**64


def pivot(x: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Rounds all but at most one of the fractions x in pairs, keeping sum(x * size)."""
    x = x.copy()
    open_ = -1
    for i in range(len(x)):
        if x[i] <= EPS or x[i] >= 1 - EPS:
            x[i] = round(x[i])
            continue
        if open_ < 0:
            open_ = i
            continue
        j, si, sj = open_, size[i], size[open_]
        up = min((1 - x[i]) * si, x[j] * sj)  # mass that may move from j to i
        down = min(x[i] * si, (1 - x[j]) * sj)
        d = up if draws[i] * (up + down) < down else -down
        x[i] += d / si
        x[j] -= d / sj
        whole = [k for k in (i, j) if x[k] <= EPS or x[k] >= 1 - EPS]
        for k in whole:
            x[k] = round(x[k])
        open_ = next((k for k in (i, j) if k not in whole), -1)
    return x


def _reduce(level: int, seed: int, carry: tuple[str, ...] = ()):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # large documents first: they end whole while there is mass left to pair them with
        pdf = pdf.sort_values(["size", "h", "doc_id", *carry], ascending=[False, *[True] * (2 + len(carry))], kind="stable", na_position="first")
        draws = np.random.Generator(np.random.PCG64([seed, level, *(int(v) & 0xFFFFFFFF for v in (pdf["source_no"].iloc[0], pdf["leaf"].iloc[0]))])).random(len(pdf))
        x = pivot(pdf["x"].to_numpy(float), pdf["size"].to_numpy(float), draws)
        pdf["copies"] = pdf["copies"] + np.where((x <= EPS) | (x >= 1 - EPS), np.round(x), 0).astype("int64")
        pdf["x"] = np.where((x <= EPS) | (x >= 1 - EPS), 0.0, x)
        return pdf

    return run


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, leaf: int = 4096, fan: int = 64, seed: int = 42, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, copies, taken) of a mix of ``docs``, with ``carry`` columns after them.

    ``carry`` tells rows of one doc_id apart; ties in size go by a hash of doc_id, then by doc_id and ``carry``.  Texts of any length count whole.  Null texts and texts without words have size 0 and are never taken.  A null
    source is a source.  Repeated rows are documents of their own.  An empty
    table gives no rows.  Other columns are not carried.  The result depends
    on the rows alone, not on how they are partitioned.
    """
    spark = docs.sparkSession
    stash = Stash(spark, "mix")
    sized = stash.put(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *carry))
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    ranked = targets(by, weights, share, most).withColumn("leaves", F.ceil(F.col("n") / leaf)).withColumn("source_no", F.row_number().over(W.orderBy(F.col("source").isNull(), "source")).cast("long")).drop("n")
    ranked = stash.put(ranked)
    height = ranked.agg(F.max("leaves")).first()[0] or 1
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (
        sized.join(ranked.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        .withColumn("rate", F.when(F.col("size") > 0, F.least(rate, F.lit(float(most)))).otherwise(F.lit(0.0)))
        .withColumn("copies", F.floor(F.col("rate") + EPS).cast("long"))
        .withColumn("x", F.greatest(F.col("rate") - F.col("copies"), F.lit(0.0)))
        .withColumn("h", F.xxhash64(F.lit(seed), "doc_id"))
        .withColumn("leaf", F.pmod(F.xxhash64("h", F.lit(1)), F.col("leaves")))
        .select("doc_id", "source", "source_no", "size", "source_size", "target", "copies", "x", "h", "leaf", *carry)
    )
    done, level, left = [], 0, rows.filter(F.col("x") > EPS)
    done.append(rows.filter(F.col("x") <= EPS))
    while True:
        out = stash.put(left.groupBy("source_no", "leaf").applyInPandas(_reduce(level, seed, carry), left.schema))
        done.append(out.filter(F.col("x") <= EPS))
        left = out.filter(F.col("x") > EPS)
        if height <= 1:
            break
        height, level = math.ceil(height / fan), level + 1
        left = left.withColumn("leaf", F.floor(F.col("leaf") / fan).cast("long"))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.lit("last"), "source_no"), F.lit(1 << 30)) / float(1 << 30)
    done.append(left.withColumn("copies", F.col("copies") + F.when(draw < F.col("x"), 1).otherwise(0)))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *carry)
