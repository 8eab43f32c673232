"""Exact dedup of a growing folder of documents by a streaming aggregation with state on disk.

The state keeps, for each digest and without expiry, the number of rows, the largest
identifier and the locator (file and row) of the row that holds it, in RocksDB; each run
of the stream takes what is new in the folder and goes on from the state.  Rows
that hit a digest of several rows are then checked byte for byte against the text at its locator; texts that
share a digest and differ are grouped by their bytes.  All of it is DataFrame functions.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm.common import Stash, lower_ascii

#: Settings of the stream: state on the executors' disks, copied to the checkpoint as changes; files take no more room there than they fill.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}
#: Most digests of repeated texts that are sent to every task to spare other texts the shuffle.
SENT = 1_000_000


def normalised(text: Column) -> Column:
    """A-Z lower-cased; null is empty."""
    return lower_ascii(F.coalesce(text, F.lit("")))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextlib.contextmanager
def _settings(spark: SparkSession, given: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in given}
    for k, v in given.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _located(rows: DataFrame, key: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    whole = normalised(F.col(text))
    return rows.select(F.col(key).alias("id"), at.alias("at"), whole.alias("whole"), digest(whole).alias("digest"), F.sha2(whole, 256).alias("sha"))


def _pattern(spark: SparkSession, path: str) -> str:
    """The path itself, or a pattern that only it fits where it is a file, which a stream takes by pattern alone."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    is_file = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()
    return f"{path[:-1]}[{path[-1]}]" if is_file else path


class ExactIndex:
    """Digests of all texts seen in a folder, kept in ``root``.

    ``update`` takes what is new in the folder, in batches of about ``batch`` bytes of files (None: 64 MB for each
    core); one that was cut off is taken up where its last batch ended.  ``groups`` reads the state.
    ``state_parts`` is the number of state stores (None: the session's shuffle partitions), fixed with the first run.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256, state_parts: int | None = None, batch: int | None = None):
        self.spark, self.root, self.key, self.text, self.digest = spark, root, key, text, digest
        self.batch = batch or spark.sparkContext.defaultParallelism << 26
        self.parts = {} if state_parts is None else {"spark.sql.shuffle.partitions": str(state_parts)}

    def update(self, path: str) -> None:
        """Takes the files of a Parquet table that no earlier update took."""
        rows = self.spark.readStream.schema(self.spark.read.parquet(path).schema).option("maxBytesPerTrigger", self.batch).parquet(_pattern(self.spark, path))
        one = _located(rows, self.key, self.text, self.digest).select("digest", F.struct("id", "at").alias("place"))
        state = one.groupBy("digest").agg(F.max("place").alias("place"), F.count("*").alias("n"))
        with _settings(self.spark, STATE | self.parts):
            run = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", self.root).trigger(availableNow=True).start()
        run.awaitTermination()

    def groups(self) -> DataFrame:
        """(digest, place<id, at<file, row>>, n) of every digest, from the state."""
        with _settings(self.spark, STATE):
            state = self.spark.read.format("statestore").load(self.root)
        place, n = state.schema["value"].dataType.names
        return state.select(F.col("key.digest").alias("digest"), F.col("value")[place].alias("place"), F.col("value")[n].alias("n"))


def dedup_exact(spark: SparkSession, path: str, key: str = "doc_id", text: str = "text", index: ExactIndex | None = None, digest: Callable[[Column], Column] = sha256, split: int = 512) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256) of every row of the Parquet table at ``path``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  Of equal texts the row
    with the largest ``key`` stays, a null key being the least; of rows that share that key too, the last
    by file name and place in it.  An empty table gives no rows; other columns are not read.  Texts are compared whole, however long.
    ``index``, if given, is one over the same table whose state is taken up.  Groups with more than a thousandth of
    the rows are dealt over tasks, ``split`` rows to a slice, and the text that stays is sent to each slice.
    """
    stash = Stash(spark, "exact")
    index = index or ExactIndex(spark, f"{stash.root}/state", key, text, digest)
    index.update(path)
    groups = stash.put(index.groups().withColumn("short", F.xxhash64("digest")))
    total, repeated = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 1).cast("long")), F.lit(0))).first()
    rows = _located(spark.read.parquet(path), key, text, index.digest).withColumn("short", F.xxhash64("digest"))
    slices = F.when(F.col("n") * 1000 > total, F.ceil(F.col("n") / split)).otherwise(1).cast("int")
    many = groups.filter("n > 1").withColumn("slices", slices)

    # rows that may belong to a repeated digest, and among them those that may hold the text at its locator
    if repeated <= SENT:
        may = F.broadcast(many.select("short").distinct())
        near, other = rows.join(may, "short", "left_semi"), rows.join(may, "short", "left_anti")
        holders = near.withColumn("spot", F.xxhash64("at")).join(F.broadcast(many.select(F.xxhash64("place.at").alias("spot")).distinct()), "spot", "left_semi")
    else:
        near, other, holders = rows, None, rows
    known = many.select(F.col("digest").alias("d"), "place", "n", "slices")
    held = holders.join(known, F.col("at") == F.col("place.at")).select("d", "place", "n", F.col("whole").alias("held"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("s"))

    # every row against that text; fewer than a thousand groups have several slices
    big = F.broadcast(many.filter("slices > 1").select(F.col("digest").alias("b"), "slices"))
    slice_ = F.pmod(F.xxhash64("at"), F.coalesce("slices", F.lit(1)).cast("long")).cast("int")
    dealt = near.join(big, F.col("digest") == F.col("b"), "left").withColumn("slice", slice_)
    met = dealt.join(held, (F.col("digest") == F.col("d")) & (F.col("slice") == F.col("s")), "left")
    differs = F.coalesce(F.col("held") != F.col("whole"), F.lit(False))
    met = stash.put(met.select("id", "at", "digest", "sha", "place", F.coalesce("n", F.lit(1)).alias("n"), F.when(differs, F.col("whole")).alias("own")))
    odd = met.filter(F.col("own").isNotNull())
    if not odd.isEmpty():  # one digest, several texts
        met = stash.put(_by_bytes(met, odd.select(F.col("digest").alias("d")).distinct()))
    out = met.select(F.col("id").alias(key), F.when(F.col("place").isNull(), F.col("id")).otherwise(F.col("place.id")).alias("keep_id"), F.col("n").alias("group_size"), F.coalesce(F.col("at") == F.col("place.at"), F.lit(True)).alias("kept"), F.col("sha").alias("text_sha256"))
    if other is not None:
        out = out.unionByName(other.select(F.col("id").alias(key), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256")))
    return out


def _by_bytes(met: DataFrame, digests: DataFrame) -> DataFrame:
    """Rows with those digests grouped by digest and text, ``own`` being null for the text at the digest's locator."""
    mixed, pure = met.join(digests, F.col("digest") == F.col("d"), "left_semi"), met.join(digests, F.col("digest") == F.col("d"), "left_anti")
    new = mixed.groupBy(F.col("digest").alias("d"), F.col("own").alias("o")).agg(F.max(F.struct("id", "at")).alias("p"), F.count("*").alias("m"))
    both = mixed.join(new, (F.col("digest") == F.col("d")) & F.col("own").eqNullSafe(F.col("o")))
    return pure.unionByName(both.select("id", "at", "digest", "sha", F.col("p").alias("place"), F.col("m").alias("n"), "own"))
