"""Quality rules: text statistics and robust multivariate outliers, in DataFrame functions only.

Per language and source a minimum-covariance-determinant estimate is fitted to
transformed statistics by concentration steps: keep the share of rows with the
smallest distances, recompute mean and covariance, repeat.  A row whose
Mahalanobis distance under the final estimate passes the cut-off is rejected.  There are two
starts, and the estimate of the least determinant is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import SPACE_CLASS, Stash, words

#: Statistics of the vector and the least standard deviation that each is given.
FLOORS = {"z_len": 0.3, "z_word": 0.06, "z_sym": 0.6, "z_dup": 0.8, "z_rep": 0.8}
UNIT = 1000  # statistics are integers in thousandths, so sums do not depend on order


def text_stats(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Null and empty texts have zeros.  Window digests are compared within one text.
    """
    long0 = F.lit(0).cast("long")
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    df = docs.withColumn("_w", words(text)).withColumn("_l", lines)
    df = df.withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
    df = df.withColumn("_w", F.transform("_w", lambda w: F.xxhash64(w)))
    df = df.withColumn("n_words", F.size("_w").cast("long"))
    df = df.withColumn("n_symbols", (F.size(F.split(text, "[#*$%&|<>]", -1)) - 1).cast("long"))
    df = df.withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long")).drop("_l")
    none = F.array().cast("array<bigint>")
    window = lambda k: F.transform(F.sequence(F.lit(0), F.size("_w") - k), lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(k)]))
    # texts without a repeated window of four words have none of eight
    df = df.withColumn("_q", F.when(F.col("n_words") >= 9, window(4)).otherwise(none))
    df = df.withColumn("_v", F.when(F.size(F.array_distinct("_q")) < F.size("_q"), window(8)).otherwise(none)).drop("_w", "_q")
    df = df.withColumn("_v", F.when(F.size(F.array_distinct("_v")) < F.size("_v"), F.col("_v")).otherwise(none))
    df = df.withColumn("_s", F.sort_array(F.transform("_v", lambda v, i: F.struct(v.alias("v"), i.alias("i"))))).drop("_v")
    same = F.filter("_s", lambda x, k: F.coalesce(F.get("_s", k - 1)["v"] == x["v"], F.lit(False)) | F.coalesce(F.get("_s", k + 1)["v"] == x["v"], F.lit(False)))
    df = df.withColumn("_p", F.sort_array(F.transform(same, lambda x: x["i"]))).drop("_s")
    run = F.aggregate(
        "_p", F.struct(long0.alias("c"), F.lit(-8).alias("last")),
        lambda a, p: F.struct((a["c"] + F.least(F.lit(8), p - a["last"])).cast("long").alias("c"), p.alias("last")), lambda a: a["c"],
    )
    return df.withColumn("n_repeat_words", F.when(F.size("_p") > 0, run).otherwise(long0)).drop("_p")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _vector() -> dict[str, Column]:
    n = F.col("n_words").cast("double")
    z = {"z_len": F.log(n), "z_word": F.log(F.col("word_chars") / n), "z_sym": F.log1p(100 * F.col("n_symbols") / n), "z_dup": F.log1p(F.col("n_dup_lines").cast("double")), "z_rep": F.log1p(100 * F.col("n_repeat_words") / n)}
    return {k: F.round(UNIT * v).cast("long") for k, v in z.items()}


def _distance(names: list[str]) -> Column:
    """Squared Mahalanobis distance from the columns m_* and the inverse factor w_*."""
    total = F.lit(0.0)
    for i in range(len(names)):
        y = F.lit(0.0)
        for j in range(i + 1):
            y = y + F.col(f"w_{i}_{j}") * (F.col(names[j]) - F.col(f"m_{j}"))
        total = total + y * y
    return total


def _bucket(d: Column) -> Column:
    return F.least(F.lit(600), F.floor(16 * F.log2(1 + 16 * d))).cast("int")


def _bucket_top(b: Column) -> Column:
    """The largest distance of a bucket."""
    return (F.pow(F.lit(2.0), (b + 1) / 16) - 1) / 16


def _estimate(rows: DataFrame, names: list[str], keep: Column) -> DataFrame:
    """Mean, inverse Cholesky factor and log determinant of the covariance of the kept rows of each group and start; sums are exact."""
    p = len(names)
    big = lambda c: F.sum(F.when(keep, c).cast("decimal(20,0)"))
    aggs = [F.sum(F.when(keep, 1)).cast("double").alias("n")]
    aggs += [big(F.col(a)).cast("double").alias(f"s_{i}") for i, a in enumerate(names)]
    aggs += [big(F.col(names[i]) * F.col(names[j])).cast("double").alias(f"q_{i}_{j}") for i in range(p) for j in range(i + 1)]
    df = rows.groupBy("g", "s").agg(*aggs)
    df = df.withColumns({f"m_{i}": F.col(f"s_{i}") / F.col("n") for i in range(p)})
    floor = [(UNIT * FLOORS[a]) ** 2 for a in names]
    df = df.withColumns({f"c_{i}_{j}": F.col(f"q_{i}_{j}") / F.col("n") - F.col(f"m_{i}") * F.col(f"m_{j}") + F.lit(floor[i] if i == j else 0.0) for i in range(p) for j in range(i + 1)})
    for j in range(p):  # Cholesky, column by column
        rest = {i: F.col(f"c_{i}_{j}") - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0)) for i in range(j, p)}
        df = df.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(rest[j], F.lit(floor[j]) / 2)))
        df = df.withColumns({f"l_{i}_{j}": rest[i] / F.col(f"l_{j}_{j}") for i in range(j + 1, p)})
    for off in range(p):  # its inverse, diagonal by diagonal
        df = df.withColumns({f"w_{j + off}_{j}": (F.lit(float(off == 0)) - sum((F.col(f"l_{j + off}_{k}") * F.col(f"w_{k}_{j}") for k in range(j, j + off)), F.lit(0.0))) / F.col(f"l_{j + off}_{j + off}") for j in range(p - off)})
    det = sum((2 * F.log(F.col(f"l_{j}_{j}")) for j in range(p)), F.lit(0.0))
    return df.select("g", "s", *[f"m_{i}" for i in range(p)], *[f"w_{i}_{j}" for i in range(p) for j in range(i + 1)], det.alias("det"))


def _threshold(rows: DataFrame, d: Column, share: float, name: str) -> DataFrame:
    """Per group and start the first bucket under which ``share`` of its rows lie: a histogram of at most 601 buckets."""
    from pyspark.sql import Window as W

    hist = rows.groupBy("g", "s", _bucket(d).alias("b")).agg(F.count("*").alias("k"))
    run = hist.withColumn("run", F.sum("k").over(W.partitionBy("g", "s").orderBy("b").rowsBetween(W.unboundedPreceding, 0))).withColumn("all", F.sum("k").over(W.partitionBy("g", "s")))
    return run.filter(F.col("run") >= share * F.col("all")).groupBy("g", "s").agg(F.min("b").alias(name))


def _medians(rows: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """The lower median of each value: exact, by counts of whole numbers that are merged in any order."""
    named = rows.select(*keys, *[v.alias(k) for k, v in values.items()])
    return named.groupBy(*keys).agg(*[F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {k})").cast("double").alias(k) for k in values])


def fit_mcd(rows: DataFrame, names: list[str], stash: Stash, share: float = 0.75, steps: int = 3) -> DataFrame:
    """(g, statistics) -> per group m_*, w_* and the scale that makes the median distance that of a chi-square.

    Concentration starts from medians and median deviations, and from the plain mean and covariance; of what the two
    come to, the estimate with the least determinant stays, the first of equals.
    """
    p = len(names)
    m = [f"m_{i}" for i in range(p)]
    med = _medians(rows, ["g"], {m[i]: F.col(a) for i, a in enumerate(names)})
    dev = _medians(rows.join(med, "g"), ["g", *m], {f"d_{i}": F.abs(F.col(a) - F.col(m[i])).cast("long") for i, a in enumerate(names)})
    spread = lambda i: F.lit(1.0) / F.sqrt(F.pow(1.4826 * F.col(f"d_{i}"), 2) + (UNIT * FLOORS[names[i]]) ** 2)
    robust = dev.select("g", F.lit(0).alias("s"), *m, *[(spread(i) if i == j else F.lit(0.0)).alias(f"w_{i}_{j}") for i in range(p) for j in range(i + 1)])
    plain = _estimate(rows.withColumn("s", F.lit(1)), names, F.lit(True)).drop("det")
    par = stash.put(robust.unionByName(plain))
    for _ in range(steps):
        with_par = rows.join(par, "g")  # each row once for each start
        par2 = stash.put(par.join(_threshold(with_par, _distance(names), share, "h"), ["g", "s"]))
        kept = rows.join(par2, "g")
        par = stash.put(_estimate(kept, names, _bucket(_distance(names)) <= F.col("h")))
    best = par.groupBy("g").agg(F.min(F.struct("det", "s")).alias("best")).select("g", F.col("best.s").alias("s"))
    par = stash.put(par.join(best, ["g", "s"]).drop("det"))
    mid = _threshold(rows.join(par, "g"), _distance(names), 0.5, "mid")
    return stash.put(par.join(mid, ["g", "s"]).withColumn("scale", F.lit(chi2_median(p)) / _bucket_top(F.col("mid"))).drop("mid", "s"))


def chi2_median(p: int) -> float:
    """Wilson-Hilferty approximation."""
    return p * (1 - 2 / (9 * p)) ** 3


def robust_quality(docs: DataFrame, cutoff: float = 36.0, share: float = 0.75, steps: int = 3, least: int = 60, carry: list[str] | None = None, widen: bool = False) -> DataFrame:
    """Adds the base statistics, base_failed, distance and kept to ``docs``.

    A row of a group (language, source) with fewer than ``least`` rows that pass the
    base rules is judged in the pool of its language's small groups; in a pool that
    is itself too small only the base rules count, or with ``widen`` an estimate of all rows
    of the language, and where they are too few one of all rows.  Null languages and sources are
    values like others.  Null, empty and short texts fail the base rules.
    Texts of any length are counted whole.  Equal rows get equal verdicts, so ties do not matter.  Columns of ``docs`` (those of ``carry`` if
    given) are kept as they are; one named like a column that is added is
    replaced.  The distance is scaled so that its median is
    a chi-square's; scales below 1 only (wide groups) are undone, so no group is
    judged more strictly than its own spread.
    """
    stash = Stash(docs.sparkSession, "mcd")
    names = list(FLOORS)
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept"]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in added]
    stats = text_stats(docs.select(*{**dict.fromkeys(keep), "text": None, "lang": None, "source": None}))
    stats = stats.select(*{**dict.fromkeys(keep), "lang": None, "source": None}, *added[:5])
    full = stash.put(stats.withColumn("base_failed", base_failed()).withColumns({f"__{k}": F.when(~F.col("base_failed"), v) for k, v in _vector().items()}))
    size = full.filter(~F.col("base_failed")).groupBy(F.col("lang").alias("__l"), F.col("source").alias("__s")).agg(F.count("*").alias("__n"))
    key = F.when(F.col("__n") >= least, F.to_json(F.struct(F.col("__l"), F.col("__s"), F.lit(1).alias("own")))).otherwise(F.to_json(F.struct(F.col("__l"))))
    groups = size.withColumn("g", key)
    pool = groups.groupBy("g").agg(F.sum("__n").alias("__pool"))
    lang = size.groupBy(F.col("__l").alias("__k")).agg(F.sum("__n").alias("__lang"))
    sized = groups.join(pool, "g").join(lang, F.col("__l").eqNullSafe(F.col("__k")))
    # a pool that is too small is judged by its whole language, and a language that is by all rows
    whole = F.to_json(F.struct(F.col("__l"), F.lit(1).alias("whole")))
    if not widen:
        sized = sized.filter(F.col("__pool") >= least)
    choice = F.when(F.col("__pool") >= least, F.col("g")).when(F.col("__lang") >= least, whole).otherwise(F.lit("all"))
    groups = stash.put(sized.select("__l", "__s", choice.alias("g"), whole.alias("__w")))
    wide = groups.select("g").distinct()
    same = F.col("lang").eqNullSafe(F.col("__l")) & F.col("source").eqNullSafe(F.col("__s"))
    fit = full.filter(~F.col("base_failed")).join(groups, same).withColumn("own", F.col("g"))
    fit = fit.withColumn("g", F.explode(F.array_distinct(F.array("own", "__w", F.lit("all"))))).join(F.broadcast(wide), "g", "left_semi")
    rows = stash.put(fit.select("g", *[F.col(f"__{k}").alias(k) for k in names]))
    par = fit_mcd(rows, names, stash, share, steps)
    stash.drop(rows)
    judged = full.join(groups.drop("__w"), same, "left").join(par, "g", "left")
    dist = _distance([f"__{k}" for k in names]) * F.least(F.col("scale"), F.lit(1.0))
    out = judged.withColumn("distance", F.when(~F.col("base_failed"), dist)).withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff))
    return out.select(*keep, *added)
