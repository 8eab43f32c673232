"""Datasets as directories: one Parquet folder per split, or one table partitioned by ``split``."""

from __future__ import annotations

import os
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.sources.revisions import Revisions, wait_for

RECORDS = "model string, task string, dataset string, results struct<total:map<string,double>>"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of sub-folders: the splits of a dataset, or its revisions."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and not s.getPath().getName().startswith(("_", ".")))


def resolve(root: str, name: str, config: str | None = None, revision: str | None = None) -> str:
    """The folder of a dataset's configuration and revision under a root."""
    return "/".join(x for x in (root.rstrip("/"), name, config, revision) if x)


def read_dataset(spark: SparkSession, path: str, splits: str | list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """All or some splits of a dataset with a ``split`` column; a split that is not there is an error.

    ``order`` adds idx, each row's place in its split, which belongs persisted (``write_dataset``) before it is relied on.
    """
    have = children(spark, path)
    partitioned = bool(have) and all(re.match("split=", h) for h in have)
    names = [h.removeprefix("split=") for h in have]
    want = names if splits is None else [splits] if isinstance(splits, str) else list(splits)
    if missing := [s for s in want if s not in names]:
        raise ValueError(f"splits {missing} are not among {names}")
    if not want:
        raise ValueError("the dataset has no splits")
    if partitioned:
        df = spark.read.parquet(path).where(F.col("split").isin(want))
    else:
        df = None
        for s in want:
            one = spark.read.parquet(f"{path}/{s}").withColumn("split", F.lit(s))
            df = one if df is None else df.unionByName(one)
    if order:
        from weir.operators.relational import ranked

        parts = [ranked(df.where(F.col("split") == s), order) for s in want]
        df = parts[0]
        for p in parts[1:]:
            df = df.unionByName(p)
    return df


def fetch_hub(name: str, revision: str | None, folder: str, allow: list[str] | None = None, ignore: list[str] | None = None) -> None:
    """Fetches a dataset's files to a folder that all machines see, by a client that is not installed everywhere."""
    import huggingface_hub

    huggingface_hub.snapshot_download(name, repo_type="dataset", revision=revision, local_dir=folder, allow_patterns=allow, ignore_patterns=ignore)


def hub_refs(name: str) -> list[str]:
    """Branches of a dataset on the hub."""
    import huggingface_hub

    return [b.name for b in huggingface_hub.HfApi().list_repo_refs(name, repo_type="dataset").branches]


def read_hub(spark: SparkSession, name: str, folder: str, config: str | None = None, revision: str | None = None, splits: str | list[str] | None = None, fetch=fetch_hub, tries: int = 1) -> DataFrame:
    """A dataset of the hub: fetched to ``folder`` (once for each revision), all its splits or some with a split column.

    Files lie in the configuration's folder, or in data/, and are named {split}-*.parquet, or lie in folders of their splits.  A failed fetch is tried
    ``tries`` times; one that ended halfway is not taken for a whole one.
    """
    home = resolve(folder, name.replace("/", "--"), revision=revision or "main")
    mark = f"{home}/.whole"
    for k in range(tries):
        if exists(spark, mark):
            break
        try:
            fetch(name, revision, home.removeprefix("file://"))
            p, fs = _fs(spark, mark)
            fs.create(p, True).close()
        except Exception:
            if k + 1 == tries:
                raise
    base = next((b for b in (f"{home}/{config}" if config else None, f"{home}/data", home) if b and exists(spark, b)), home)
    if config and not base.endswith(f"/{config}"):
        raise ValueError(f"{name} has no configuration {config}")
    p, fs = _fs(spark, base)
    files = [f.getPath().getName() for f in fs.listStatus(p) if f.isFile() and f.getPath().getName().endswith(".parquet")]
    if not files:
        return read_dataset(spark, base, splits)
    have: dict[str, list[str]] = {}
    for f in sorted(files):
        have.setdefault(re.split(r"-\d|\.parquet$", f)[0], []).append(f"{base}/{f}")
    want = sorted(have) if splits is None else [splits] if isinstance(splits, str) else list(splits)
    if missing := [s for s in want if s not in have]:
        raise ValueError(f"splits {missing} are not among {sorted(have)}")
    parts = [spark.read.parquet(*have[s]).withColumn("split", F.lit(s)) for s in want]
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split, by a folder of its own if there is no table of splits."""
    direct = f"{path}/{split}"
    return spark.read.parquet(direct) if exists(spark, direct) else read_dataset(spark, path, split).drop("split")


def read_revisions(spark: SparkSession, root: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Revisions by name: the last entry of each published reference, or plain folders."""
    if exists(spark, f"{root}/refs"):
        published = Revisions(spark, *root.rsplit("/", 1))
        return {n: published.read(n) for n in names or published.refs()}
    return {n: read_dataset(spark, f"{root}/{n}") for n in names or children(spark, root)}


def common_splits(spark: SparkSession, paths: list[str]) -> list[str]:
    sets = [{c.removeprefix("split=") for c in children(spark, p)} for p in paths]
    return sorted(set.intersection(*sets))


def write_dataset(df: DataFrame, path: str, publish=None) -> None:
    """A table partitioned by split; ``publish``, if given, is called with the path afterwards and nothing is sent anywhere otherwise."""
    df.write.partitionBy("split").parquet(path)
    if publish is not None:
        publish(path)


def pair_configs(datasets: list[str], configs: list[str | None] | None, fractions: list[float] | None = None) -> list[tuple[str, str | None, float]]:
    """(dataset, configuration, fraction) in turn; configurations and fractions are none or one for each dataset."""
    configs = [None] * len(datasets) if configs is None else list(configs)
    fractions = [1.0] * len(datasets) if fractions is None else list(fractions)
    if len(configs) != len(datasets) or len(fractions) != len(datasets):
        raise ValueError("configurations and fractions need one value for each dataset")
    return list(zip(datasets, configs, fractions, strict=True))


def publish_to(root: str, name: str, revision: str, config: str | None = None):
    """A publisher that makes a written dataset the last entry of a revision."""

    def run(path: str) -> None:
        spark = SparkSession.active()
        Revisions(spark, root, name, config).publish(spark.read.parquet(path), revision)

    return run


def read_records(spark: SparkSession, path: str, schema: str | T.StructType = RECORDS) -> DataFrame:
    """JSON lines; blank lines are skipped.  Adds idx in the order of files and lines."""
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i")).where(F.trim("value") != "")
    return text.select(F.from_json("value", schema).alias("r"), F.col("i").alias("idx")).select("idx", "r.*")


def read_files(spark: SparkSession, path: str, allow: str | list[str] | None = None, recursive: bool = True, ignore: str | list[str] | None = None) -> DataFrame:
    """Paths and sizes of files: those whose path below the folder fits a glob of ``allow`` and none of ``ignore``; * also fits slashes."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    base, fs = _fs(spark, path)
    inside = F.substring("path", F.lit(len(fs.getFileStatus(base).getPath().toString().rstrip("/")) + 2), F.length("path"))
    globs = lambda g: [g] if isinstance(g, str) else list(g or [])
    fits = lambda patterns: reduce(lambda a, b: a | b, [inside.rlike(f"^(?:{_glob(p)})$") for p in patterns], F.lit(False))
    files = r.load(path).select("path", "length")
    files = files.where(fits(globs(allow))) if globs(allow) else files
    return files.where(~fits(globs(ignore))) if globs(ignore) else files


def _glob(pattern: str) -> str:
    """A glob as a regular expression of Java."""
    out = ""
    for c in re.split(r"(\*|\?|\[[^\]]*\])", pattern):
        out += ".*" if c == "*" else "." if c == "?" else c.replace("[!", "[^") if c.startswith("[") else re.escape(c)
    return out


def snapshot(spark: SparkSession, path: str, allow: str | list[str] | None = None, ignore: str | list[str] | None = None, every: float = 60.0, most: float | None = None) -> list[str]:
    """Paths of a folder's files as ``read_files`` chooses them, waiting until there are some: what a checkpoint that is still being uploaded will have."""

    def look() -> list[str]:
        if not exists(spark, path):
            return []
        return [r.path for r in read_files(spark, path, allow, ignore=ignore).orderBy("path").toLocalIterator()]

    return wait_for(look, every, most)


def write_sheets(df: DataFrame, group: str, folder: str) -> list[str]:
    """One CSV per group of a small report, without an index column; ``workbook.write_workbook`` has them as sheets of one file."""
    pdf = df.toPandas()
    os.makedirs(folder, exist_ok=True)
    out = []
    for name, part in pdf.groupby(group):
        out.append(f"{folder}/{re.sub('[^A-Za-z0-9._-]', '_', str(name))}.csv")
        part.to_csv(out[-1], index=False)
    return out
