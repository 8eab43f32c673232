"""Tables in the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names; a temporary folder only where it is unset and all runs on one machine."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="weir-"))


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A folder of that name's own, made now and deleted when the application ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def materialize(df: DataFrame, tag: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Writes a table once and reads it again, so that everything that follows sees the same rows."""
    path = f"{fresh_path(df.sparkSession, tag)}/rows"
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return df.sparkSession.read.parquet(path) if partition_by else df.sparkSession.read.schema(df.schema).parquet(path)
