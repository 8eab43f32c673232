"""Whitening of embeddings by the eigenvectors of their exact covariance.

Entries become whole numbers, so sums are exact and a row times n less the sums is too: rows
are centred before they are rounded.  The centred rows go to a ``RowMatrix``, whose
Gramian over n is the covariance; its eigenvectors are found on the driver, for it is as
large as the vectors are long and no larger with more rows, and sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
OUT = "component int, n long, deviation long, whitened double, explained double"


@dataclass
class Fit:
    """What whitens vectors of one length: rows, sums, and components (a column each) with their eigenvalues."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def whole(vector: Column) -> Column:
    """Entries as whole numbers, null where there is none; filters may be merged, so this must not fail on rows that another drops."""
    return F.transform(vector, lambda c: F.when(_finite(c), F.floor(c.cast("double") * SCALE) + SHIFT))


def _finite(c: Column) -> Column:
    return F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) != F.lit(float("inf"))), F.lit(False))


def usable(vector: Column) -> Column:
    """Not null or empty, and no entry null or not finite."""
    return (F.size(vector) > 0) & F.forall(vector, _finite)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each length of vector in a partition: count, sums, least and largest entries."""
    held: dict[int, list] = {}
    for b in batches:
        for x, size in _matrices(b.column("x")):
            s = held.setdefault(size, [0, np.zeros(size, dtype=np.int64), np.full(size, np.iinfo(np.int64).max), np.full(size, np.iinfo(np.int64).min)])
            if len(x) * float(np.abs(x).max()) + float(np.abs(s[1]).max()) > 2**62:
                raise OverflowError("sums of entries do not fit a long")
            s[0] += len(x)
            s[1] += x.sum(axis=0)
            s[2], s[3] = np.minimum(s[2], x.min(axis=0)), np.maximum(s[3], x.max(axis=0))
    for size, (n, total, low, high) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (size, n, total.tolist(), low.tolist(), high.tolist())], names=["size", "n", "total", "low", "high"])


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, int]]:
    """The lists of a batch as one matrix of rows for each length above 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    first = column.offsets.to_numpy()[:-1] - column.offsets[0].as_py()
    for size in np.unique(sizes[sizes > 0]).tolist():
        at = first[sizes == size]
        yield flat[at[:, None] + np.arange(size)], size


def _statistics(rows: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """size -> (count, sums): one row for each dimension comes to the driver."""
    part = rows.select("x").mapInArrow(_sums, "size long, n long, total array<long>, low array<long>, high array<long>")
    one = part.select("size", "n", F.posexplode(F.arrays_zip("total", "low", "high")).alias("d", "v"))
    got = one.groupBy("size", "d").agg(F.sum("n").alias("n"), F.sum("v.total").alias("total"), F.min("v.low").alias("low"), F.max("v.high").alias("high")).orderBy("size", "d").collect()
    out = {}
    for size in {r["size"] for r in got}:
        mine = [r for r in got if r["size"] == size]
        n = mine[0].n
        far = [max(n * r.high - r.total, r.total - n * r.low) for r in mine]
        if max(abs(n * v) for r in mine for v in (r.low, r.high)) >= 2**63 or sum(f * f for f in far) >= 2**63:
            raise OverflowError("deviations do not fit a long")
        out[size] = n, np.array([r.total for r in mine], dtype=np.int64)
    return out


def fit(rows: DataFrame, size: int, n: int, sums: np.ndarray, most: int) -> Fit:
    """Components of the vectors of one length in ``rows`` (x array<long>)."""
    total = F.lit(sums.tolist())
    centred = F.zip_with("x", total, lambda x, s: (x * F.lit(n) - s).cast("double") / F.lit(float(n)))
    frame = MLUtils.convertVectorColumnsFromML(rows.filter(F.size("x") == size).select(array_to_vector(centred).alias("v")), "v")
    gram = RowMatrix(frame, n, size).computeGramianMatrix().toArray() / n
    values, axes = np.linalg.eigh((gram + gram.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    values, axes, trace = values[order], axes[:, order], float(np.trace(gram))
    top = np.argmax(np.abs(axes), axis=0)
    axes = axes * np.where(axes[top, np.arange(axes.shape[1])] < 0, -1.0, 1.0)  # a sign that reruns repeat
    floor = size * np.finfo(float).eps * max(float(values.max(initial=0)), 0.0)
    values = np.where(values > floor, values, 0.0)
    return Fit(n, sums, axes, values, values / trace if trace > 0 else np.zeros(len(values)))


def _projected(f: Fit, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact deviations and whitened values (NaN for components without variance) of some rows."""
    d = f.n * x - f.sums
    with np.errstate(divide="ignore", invalid="ignore"):
        w = (d / f.n) @ np.where(f.values > 0, f.axes / np.sqrt(f.values), np.nan)
    return (d * d).sum(axis=1), w


def _moments(fits: dict[int, Fit]):
    """Sums and products of a partition's whitened rows, by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for x, size in _matrices(b.column("x")):
                w = _projected(fits[size], x)[1]
                s = held.setdefault(size, [np.zeros(w.shape[1]), np.zeros((w.shape[1],) * 2)])
                s[0] += w.sum(axis=0)
                s[1] += w.T @ w
        for size, (total, product) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (size, total.tolist(), product.ravel().tolist())], names=["size", "total", "product"])

    return run


def identity_errors(rows: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """size -> largest entry of the whitened covariance less the identity, over components with variance; a second pass over all rows."""
    part = rows.select("x").mapInArrow(_moments(fits), "size long, total array<double>, product array<double>")
    both = part.select("size", F.posexplode(F.concat("total", "product")).alias("i", "v")).groupBy("size", "i").agg(F.sum("v").alias("v"))
    got: dict[int, list] = {}
    for r in both.orderBy("size", "i").collect():
        got.setdefault(r["size"], []).append(r.v)
    out = {}
    for size, v in got.items():
        f = fits[size]
        k, v = len(f.values), np.array(v) / f.n
        cov = v[k:].reshape(k, k) - np.outer(v[:k], v[:k])
        live = np.flatnonzero(f.values > 0)
        out[size] = float(np.abs((cov - np.eye(k))[np.ix_(live, live)]).max(initial=0.0))
    return out


def whiten(vectors: DataFrame, most: int = 32, carry: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """``carry`` columns and (component, n, deviation, whitened, explained, identity_error) for each usable row of ``vectors`` (embedding) and component up to ``most``.

    Rows whose vector is null, or has a null or non-finite entry, are left out, and so are empty
    vectors, which have no component.  Vectors of each length are whitened by themselves, with
    their own n.  Equal rows, and rows with one vec_id or none, are rows of their own.  A component without variance has
    whitened null and takes no part in identity_error.  Equal eigenvalues may share any axes of their space.  Sums and deviations are
    exact; where they would not fit a long, OverflowError is raised.  Other columns are not read.
    """
    kept = vectors.select(*carry, F.col("embedding").alias("__v")).filter(usable(F.col("__v"))).select(F.struct(*carry).alias("carry"), whole(F.col("__v")).alias("x"))
    stats = _statistics(kept)
    fits = {size: fit(kept, size, n, sums, most) for size, (n, sums) in stats.items()}
    errors = identity_errors(kept, fits) if fits else {}
    sent = vectors.sparkSession.sparkContext.broadcast((fits, errors))
    kinds = [f for f in kept.schema["carry"].dataType if f.name in carry]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fits, errors = sent.value
        for f in frames:
            sizes = f["x"].map(len).to_numpy()
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                one = fits[size]
                k = len(one.values)
                far, w = _projected(one, np.stack(f["x"].to_numpy()[at]).astype(np.int64))
                out = {c: np.repeat(f[f"c{i}"].array.take(at), k) for i, c in enumerate(carry)}
                out |= {"component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(at)), "n": one.n, "deviation": np.repeat(far, k)}
                out |= {"whitened": pd.array(w.ravel(), dtype="Float64"), "explained": np.tile(one.explained, len(at)), "identity_error": errors[size]}
                yield pd.DataFrame(out)

    flat = kept.select(*[F.col("carry")[c].alias(f"c{i}") for i, c in enumerate(carry)], "x")
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds)
    out = flat.mapInPandas(run, f"{names}, {OUT}, identity_error double")
    return out.withColumn("whitened", F.nanvl("whitened", F.lit(None).cast("double")))
