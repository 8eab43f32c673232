"""Shared folder handling and small expressions of the corpus operators."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.sources.shared import fresh_path

#: Characters that separate words, as a Java regex class body and as plain characters.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD = rf"[^{SPACE_CLASS}]+"

class Stash:
    """Tables written to the shared folder, which cuts lineage and survives lost executors.

    ``put`` writes and rereads a table; ``drop`` deletes those no longer needed, and the end of the application the rest.
    The shuffle files of a write go when it has ended.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = fresh_path(spark, tag)
        self.n = 0
        self.paths: dict[int, str] = {}

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.n}"
        self.n += 1
        with self.cleanup():
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    @contextlib.contextmanager
    def cleanup(self) -> Iterator[None]:
        """Actions in it leave no shuffle files behind."""
        before = self.spark.conf.get(self.CLEANUP, "false")
        self.spark.conf.set(self.CLEANUP, "true")
        try:
            yield
        finally:
            self.spark.conf.set(self.CLEANUP, before)

    def drop(self, *dfs: DataFrame) -> None:
        for df in dfs:
            path = self.paths.pop(id(df), None)
            if path:
                jvm = self.spark.sparkContext._jvm
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def lower_ascii(c: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(c: Column) -> Column:
    """Array of the words of a text; null gives an empty array."""
    return F.coalesce(F.regexp_extract_all(c, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def free_names(carry: tuple[str, ...], own: tuple[str, ...]) -> None:
    """Columns that are carried must not be named like those that an operator adds."""
    if clash := sorted(set(carry) & set(own)):
        raise ValueError(f"carried columns are named like the operator's own: {clash}")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
