"""Dedup, merging, mixing, pivots and reports over datasets with a ``split`` and an ``idx`` column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weir.functions.messages import assistant_text, is_messages
from weir.sources.shared import materialize


def _key(df: DataFrame, name: str) -> Column:
    """What two rows must share in a column: the assistant's words of a conversation, or the value."""
    return assistant_text(F.col(name)) if is_messages(df.schema[name].dataType) else F.col(name)


def keep_first(df: DataFrame, keys: list[Column], order: list[str], within: list[str] = ()) -> DataFrame:
    """The first row, by ``order``, of each key; nulls are equal.

    A partial aggregation finds the first row of a key and a semi-join fetches it, so a key that many rows share
    sends one row from each task.  Strings are keys by their SHA-256, so whole texts are neither sorted nor sent.
    """
    named = {f"__k{i}": k for i, k in enumerate(keys)}
    small = df.select(*within, *order, *[v.alias(k) for k, v in named.items()])
    small = small.withColumns({k: F.unhex(F.sha2(k, 256)) for k in named if small.schema[k].dataType.typeName() == "string"})
    least = F.min(order[0] if len(order) == 1 else F.struct(*order))
    first = small.groupBy(*within, *named).agg(least.alias("__first"))
    at = [F.col("__first")] if len(order) == 1 else [F.col("__first")[o] for o in order]
    wanted = first.select(*[F.col(w).alias(f"__w{i}") for i, w in enumerate(within)], *[c.alias(f"__o{i}") for i, c in enumerate(at)])
    same = reduce(lambda a, b: a & b, [F.col(w).eqNullSafe(F.col(f"__w{i}")) for i, w in enumerate(within)] + [F.col(o).eqNullSafe(F.col(f"__o{i}")) for i, o in enumerate(order)])
    return df.join(wanted, same, "left_semi")


def dedup_sequential(df: DataFrame, columns: list[str], order: list[str] = ("idx",), within: list[str] = ()) -> DataFrame:
    """Per column in turn, the first row of each value among those still there."""
    for c in columns:
        df = keep_first(df, [_key(df, c)], list(order), list(within))
    return df


def common_columns(frames: list[DataFrame]) -> list[str]:
    return [c for c in frames[0].columns if all(c in f.columns for f in frames)]


def merge_revisions(frames: list[DataFrame], on: list[str], order: list[str] = ("idx",)) -> DataFrame:
    """Inner join of revisions on ``on``, null keys equal, each deduplicated first; rows with a null elsewhere go.

    Clashing names get _x and _y; a second clash is an error.
    """
    frames = [keep_first(f, [F.col(c) for c in on], list(order)).drop(*[o for o in order if o not in on]) for f in frames]

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        clash = [c for c in a.columns if c in b.columns and c not in on]
        a, b = a.withColumnsRenamed({c: f"{c}_x" for c in clash}), b.withColumnsRenamed({c: f"{c}_y" for c in clash})
        if len(set(a.columns)) < len(a.columns) or (set(a.columns) & set(b.columns)) - set(on):
            raise ValueError("columns clash again after _x and _y were added")
        b = b.withColumnsRenamed({c: f"__on{i}" for i, c in enumerate(on)})
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__on{i}")) for i, c in enumerate(on)])
        return a.join(b, same).drop(*[f"__on{i}" for i in range(len(on))])

    out = reduce(join, frames)
    rest = [c for c in out.columns if c not in on]
    return out.na.drop("any", subset=rest) if rest else out


def first_n(df: DataFrame, n: int, small: int = 1_000) -> DataFrame:
    """The n rows with the least idx of each split, gaps or not; without a split column, of all rows.  idx is unique within a split.

    Up to ``small`` rows are found by a window that each task cuts short before anything travels, more by a distributed sort of
    the keys.  Either way one bound for each split is found and rows are held against it.
    """
    if n < 0:
        raise ValueError("the number of rows must not be negative")
    by = ["split"] if "split" in df.columns else []
    keys = df.select(*by, "idx")
    if n <= small:
        first = keys.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy("idx"))).where(F.col("__r") <= n)
    else:
        place = ranked(keys.withColumnRenamed("idx", "__own"), [*by, "__own"])
        start = place.groupBy(*by).agg(F.min("idx").alias("__start")).withColumnsRenamed({b: f"__{b}" for b in by})
        same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by], F.lit(True))
        first = place.join(start, same).where(F.col("idx") < F.col("__start") + n).select(*by, F.col("__own").alias("idx"))
    bound = first.groupBy(*by).agg(F.max("idx").alias("__bound")).withColumnsRenamed({b: f"__{b}" for b in by})
    within = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by], F.col("idx") <= F.col("__bound"))
    return df.join(bound, within, "left_semi")


def prefix_fraction(df: DataFrame, fraction: float) -> DataFrame:
    """The first int(fraction * rows) rows by idx, which may have gaps; idx is unique.

    With gapless idx from 0 this is a predicate that reaches the scan; otherwise rows are numbered by a distributed sort.
    """
    if fraction < 0:
        raise ValueError("fractions must not be negative")
    n, low, high = df.agg(F.count("*"), F.min("idx"), F.max("idx")).first()
    k = int(fraction * n)
    if k > n:
        raise IndexError(f"{k} rows were asked for and there are {n}")
    if not n or (low == 0 and high == n - 1):
        return df.where(F.col("idx") < k)
    numbered = ranked(df.withColumnRenamed("idx", "__own"), ["__own"])
    return numbered.where(F.col("idx") < k).drop("idx").withColumnRenamed("__own", "idx").select(*df.columns)


def split_kind(name: str) -> str:
    if "train" in name:
        return "train"
    if "test" in name:
        return "test"
    raise ValueError(f"split {name} is neither a train nor a test split")


def shuffled(df: DataFrame, key: Column, seed: int = 42) -> DataFrame:
    """A deterministic permutation: rows in the order of a digest of seed and key."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string"))), key)


def mix(parts: list[tuple[str, str, DataFrame, float]], columns: list[str] | None = None, seed: int | None = 42) -> dict[str, DataFrame]:
    """(dataset, split, rows, fraction) -> train and test: fractions of train splits, whole test splits, in a shuffled union.

    ``columns`` None keeps all.
    """
    out: dict[str, list[DataFrame]] = {"train": [], "test": []}
    for name, split, df, fraction in parts:
        kind = split_kind(split)
        df = prefix_fraction(df, fraction) if kind == "train" else df
        keep = [c for c in df.columns if columns is None or c in columns]
        out[kind].append(df.select(F.lit(name).alias("dataset"), *(["idx"] if "idx" in df.columns and "idx" not in keep else []), *keep))
    done = {k: reduce(lambda a, b: a.unionByName(b), v) for k, v in out.items() if v}
    if seed is not None:
        done = {k: shuffled(v, F.concat_ws("-", "dataset", "idx"), seed) for k, v in done.items()}
    return done


def weighted_choice(names: list[str], weights: list[float] | None, seed: int, *keys: Column) -> Column:
    """One of ``names`` by weight, fixed by seed and keys; weights need not sum to 1."""
    weights = [1.0] * len(names) if weights is None else weights
    if len(weights) != len(names) or not names or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("weights must be one number, not negative, for each name")
    u = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), *[k.cast("string") for k in keys])), 1, 8), 16, 10).cast("double") / float(1 << 32)
    out, left = F.lit(names[-1]), sum(weights)
    for name, w in reversed(list(zip(names, weights, strict=True))):
        left -= w
        out = F.when((u >= left / sum(weights)) & (u < (left + w) / sum(weights)), name).otherwise(out)
    return out


def pivot_ledger(ledger: DataFrame, value: str, columns: list[str]) -> DataFrame:
    """(split, idx, column, value) -> a column for each of ``columns``, missing ones empty; two rows of one cell are an error."""
    cells = ledger.groupBy("split", "idx").pivot("column", sorted(columns)).agg(F.first(value).alias("v"), F.count(F.lit(1)).alias("n"))
    checked = F.greatest(*[F.coalesce(F.col(f"{c}_n"), F.lit(0)) for c in columns], F.lit(0)) > 1
    guard = F.when(checked, F.raise_error(F.lit("the ledger has two rows for one cell")).cast("string"))
    return cells.select("split", "idx", *[F.coalesce(guard, F.col(f"{c}_v"), F.lit("")).alias(c) for c in sorted(columns)])


def join_columns(df: DataFrame, more: DataFrame) -> DataFrame:
    """Columns side by side for equal (split, idx); equal names are an error and the result's columns are sorted."""
    clash = (set(df.columns) & set(more.columns)) - {"split", "idx"}
    if clash:
        raise ValueError(f"columns are in both: {sorted(clash)}")
    return sort_columns(df.join(more, ["split", "idx"]))


def sort_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def exclude(df: DataFrame, done: DataFrame, keys: list[str] = ("split", "idx")) -> DataFrame:
    """Rows that are not in ``done`` by ``keys``."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def processed(done: DataFrame, failed: DataFrame, keys: list[str] = ("split", "column", "idx")) -> DataFrame:
    """Keys of rows that succeeded or failed, each once."""
    return done.select(*keys).unionByName(failed.select(*keys)).distinct()


# What error texts of each kind hold, lower-cased.
ERROR_TEXTS = {
    "rate_limit": ["error code: 429"],
    "empty": ["empty conversation"],
    "time_out": ["timed out", "time out", "timeout"],
}


def error_kind(error: Column) -> Column:
    """rate_limit, empty, time_out or null, the first that fits."""
    e = F.lower(error)
    return F.coalesce(*[F.when(reduce(lambda a, b: a | b, [e.contains(t) for t in texts]), kind) for kind, texts in ERROR_TEXTS.items()])


def failure_report(failed: DataFrame) -> DataFrame:
    """Counts of failures by kind and in total; other kinds count in the total only."""
    kinds = ["rate_limit", "empty", "time_out"]
    k = error_kind(F.col("error"))
    return failed.agg(*[F.coalesce(F.sum(F.when(k == n, 1)), F.lit(0)).cast("long").alias(n) for n in kinds], F.count("*").alias("total"))


# The metric that counts for each dataset.
METRICS = {
    "dutch-social": "test_macro_f1",
    "conll-nl": "test_micro_f1",
    "scala-nl": "test_macro_f1",
    "squad-nl": "test_f1",
    "wiki-lingua-nl": "test_bertscore",
    "mmlu-nl": "test_accuracy",
    "hellaswag-nl": "test_accuracy",
}


def flatten_scores(records: DataFrame, alias: dict[str, str] | None = None, order: str = "idx") -> DataFrame:
    """(model, task, dataset, results.total) records -> one row per dataset and model, the first by ``order``."""
    model = F.element_at(F.split("model", "/"), -1)
    for old, new in (alias or {}).items():
        model = F.when(model == old, new).otherwise(model)
    flat = records.select(order, model.alias("model"), "task", "dataset", F.col("results.total").alias("total"))
    return keep_first(flat, [F.col("dataset"), F.col("model")], [order])


def mean_of(columns: list[str]) -> Column:
    """Mean of the values that are there."""
    have = F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda x: x.isNotNull())
    return F.when(F.size(have) > 0, F.aggregate(have, F.lit(0.0), lambda a, x: a + x) / F.size(have))


def scoreboard(scores: DataFrame, metrics: dict[str, str] = METRICS, apart: str = "conll", compat: bool = False) -> DataFrame:
    """Models that have every dataset, a column {dataset}_{metric} each, average, and the average without ``apart``.

    ``compat`` counts the average itself as one of the latter's values.
    """
    metric = F.element_at(F.create_map(*[F.lit(x) for kv in metrics.items() for x in kv]), F.col("dataset"))
    cells = scores.filter(F.col("dataset").isin(list(metrics))).select("model", "dataset", F.try_element_at("total", metric).alias("score"))
    wide = cells.groupBy("model").pivot("dataset", list(metrics)).agg(F.first("score").alias("score"), F.count(F.lit(1)).alias("n"))
    wide = wide.filter(reduce(lambda a, b: a & b, [F.col(f"{d}_n") > 0 for d in metrics]))
    names = {d: f"{d}_{m}" for d, m in metrics.items()}
    out = wide.select("model", *[F.col(f"{d}_score").alias(n) for d, n in names.items()])
    out = out.withColumn("average", mean_of(list(names.values())))
    rest = [n for n in names.values() if apart not in n] + (["average"] if compat else [])
    return out.withColumn(f"average_no_{apart}", mean_of(rest))


def checkpoint_series(scores: DataFrame, prefix: str, apart: str = "_se") -> DataFrame:
    """Plot-ready rows (dataset, checkpoint, metric, value, error) of models named prefix + number."""
    step = F.replace(F.col("model"), F.lit(prefix), F.lit("")).try_cast("int")
    rows = scores.filter(F.col("model").startswith(prefix)).select("dataset", step.alias("checkpoint"), "total", F.explode("total").alias("metric", "value"))
    rows = rows.filter(F.col("metric").startswith("test_") & ~F.col("metric").endswith(apart))
    return rows.select("dataset", "checkpoint", "metric", "value", F.try_element_at("total", F.concat("metric", F.lit(apart))).alias("error")).orderBy("dataset", "metric", "checkpoint")


def unpivot(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row (keys, column, text) for each of ``columns``, in one pass."""
    return df.unpivot(keys, columns, "column", "text")


def ranked(df: DataFrame, by: list[str]) -> DataFrame:
    """idx from 0 in the order of ``by``, by a distributed sort: partition sizes first, then places within them.

    The sorted table is written once: a sampled range exchange that ran twice would draw other borders.
    """
    place = F.monotonically_increasing_id()
    sorted_ = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__p", F.shiftright(place, 33)).withColumn("__i", place.bitwiseAND(F.lit((1 << 33) - 1)))
    sorted_ = materialize(sorted_, "ranked")
    sizes = sorted_.groupBy("__p").count()  # one row for each partition
    before = sizes.withColumn("__b", F.coalesce(F.sum("count").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("__p", "__b")
    return sorted_.join(before, "__p").withColumn("idx", F.col("__b") + F.col("__i")).drop("__p", "__i", "__b")


def preview(df: DataFrame, n: int = 3) -> list:
    """The first ``n`` rows by idx, for a look."""
    return df.orderBy("idx").limit(n).collect()


def sorted_items(c: Column) -> Column:
    """A map as an array of its entries by key, which can be compared and grouped by."""
    return F.array_sort(F.map_entries(c))
