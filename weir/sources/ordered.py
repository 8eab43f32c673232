"""Tables whose files are in the order of idx, with a manifest that says so."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_order.json"


def write_ordered(df: DataFrame, path: str, order: tuple[str, ...] = ("idx",), files: int | None = None) -> list[dict]:
    """Writes a split dataset so that its files, one after the other, hold the rows of each split by ``order``.

    One range exchange deals the rows, ``files`` partitions or as many as the session shuffles to; no partition holds a whole split unless it is small.  The manifest lists each file with
    its split, number of rows and first and last key; it has a line for each file, and is written last.
    """
    spark = df.sparkSession
    by = ["split", *order] if "split" in df.columns else list(order)
    dealt = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    sorted_ = dealt.sortWithinPartitions(*by)
    (sorted_.write.partitionBy("split") if "split" in df.columns else sorted_.write).parquet(path)
    key = F.struct(*order)
    seen = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), *(["split"] if "split" in df.columns else [F.lit("").alias("split")]), key.alias("k"))
    rows = seen.groupBy("split", "file").agg(F.count("*").alias("rows"), F.to_json(F.min("k")).alias("first"), F.to_json(F.max("k")).alias("last"), F.min("k").alias("m")).orderBy("split", "m", "file").collect()
    manifest = [{"split": r.split, "file": r.file, "rows": r.rows, "first": json.loads(r.first), "last": json.loads(r.last)} for r in rows]
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray("\n".join(json.dumps(m) for m in manifest).encode()))
    out.close()
    return manifest


def read_manifest(spark: SparkSession, path: str) -> list[dict]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")  # readers of the table pass over a name like this
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [json.loads(line) for line in text.splitlines()]


def read_ordered(spark: SparkSession, path: str, split: str | None = None, skip: int = 0, take: int | None = None) -> DataFrame:
    """Rows ``skip`` to ``skip`` + ``take`` of a split by its order, from the files that hold them alone."""
    files = [m for m in read_manifest(spark, path) if split is None or m["split"] == split]
    if not files:
        raise ValueError(f"there is no split {split}")
    at, wanted = 0, []
    for m in files:
        low, high = max(skip - at, 0), m["rows"] if take is None else min(skip + take - at, m["rows"])
        if low < high:
            wanted.append((m["file"], low, high))
        at += m["rows"]
    df = spark.read.option("basePath", path).parquet(*[f for f, _, _ in wanted] or [files[0]["file"]])
    inside = F.lit(False)
    for f, low, high in wanted:
        if (low, high) != (0, next(m["rows"] for m in files if m["file"] == f)):
            inside = inside | ((F.col("_metadata.file_path") == f) & F.col("_metadata.row_index").between(low, high - 1))
        else:
            inside = inside | (F.col("_metadata.file_path") == f)
    return df.where(inside)
