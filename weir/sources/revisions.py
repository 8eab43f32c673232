"""Published datasets: immutable data folders, and references whose entries appear all at once.

A reference (a branch or a tag) is a folder of numbered entries; each names a data folder and what it holds.  Data are written first, the entry is written
aside and renamed to the next number, which fails if another writer was there before.  So readers see a whole revision
or the one before it, and one who read an entry keeps its rows whatever is published later.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Entry:
    """One published state of a reference."""

    ref: str
    number: int
    data: str
    rows: dict[str, int]
    columns: list[str]
    note: str
    at: float


class Revisions:
    """The revisions of one dataset's configuration under a root folder."""

    def __init__(self, spark: SparkSession, root: str, name: str, config: str | None = None):
        self.spark = spark
        self.base = "/".join(x for x in (root.rstrip("/"), name, config) if x)
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(self.base).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, path: str) -> list[str]:
        p = self._path(path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def refs(self) -> list[str]:
        return [r for r in self._names(f"{self.base}/refs") if self.numbers(r)]

    def numbers(self, ref: str) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names(f"{self.base}/refs/{ref}") if n.endswith(".json") and not n.startswith((".", "_"))]

    def entry(self, ref: str = "main", number: int | None = None) -> Entry:
        """An entry of a reference: the last, or the one with that number."""
        have = self.numbers(ref)
        if not have:
            raise FileNotFoundError(f"{self.base} has no revision {ref}; there are {self.refs()}")
        if number is not None and number not in have:
            raise FileNotFoundError(f"revision {ref} has no number {number}, only {have}")
        n = have[-1] if number is None else number
        text = self.spark.read.text(f"{self.base}/refs/{ref}/{n:010d}.json", wholetext=True).first().value
        return Entry(**json.loads(text))

    def log(self, ref: str = "main") -> list[Entry]:
        return [self.entry(ref, n) for n in self.numbers(ref)]

    def read(self, ref: str = "main", number: int | None = None, split: str | None = None) -> DataFrame:
        e = self.entry(ref, number)
        df = self.spark.read.parquet(f"{self.base}/{e.data}")
        if split is None:
            return df
        if split not in e.rows:
            raise ValueError(f"split {split} is not among {sorted(e.rows)}")
        return df.where(F.col("split") == split)

    def publish(self, df: DataFrame, ref: str = "main", note: str = "") -> Entry:
        """Writes ``df``, which has a split column, and makes it the last entry of ``ref``; if writing fails nothing is published."""
        data = f"data/{uuid.uuid4().hex}"
        df.write.partitionBy("split").parquet(f"{self.base}/{data}")
        rows = {r.split: r.n for r in self.spark.read.parquet(f"{self.base}/{data}").groupBy(F.col("split").cast("string").alias("split")).agg(F.count("*").alias("n")).collect()}
        return self._enter(ref, data, rows, df.columns, note)

    def tag(self, name: str, ref: str = "main", number: int | None = None) -> Entry:
        """A new reference to what another one has; a tag that is there already stays."""
        if self.numbers(name):
            raise FileExistsError(f"there is a revision {name} already")
        e = self.entry(ref, number)
        return self._enter(name, e.data, e.rows, e.columns, e.note, once=True)

    def _enter(self, ref: str, data: str, rows: dict[str, int], columns: list[str], note: str, once: bool = False) -> Entry:
        if "/" in ref or ref.startswith((".", "_")):
            raise ValueError(f"{ref} is no name for a revision")
        folder = f"{self.base}/refs/{ref}"
        self.fs.mkdirs(self._path(folder))
        while True:
            n = max(self.numbers(ref), default=0) + 1
            if once and n > 1:
                raise FileExistsError(f"there is a revision {ref} already")
            e = Entry(ref, n, data, rows, columns, note, time.time())
            if self._claim(f"{folder}/{n:010d}.json", json.dumps(asdict(e))):
                return e

    def _claim(self, path: str, text: str) -> bool:
        """A whole new file, or False if there is one by that name."""
        aside = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
        out = self.fs.create(self._path(aside), False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        never_over = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._path(aside), self._path(path), never_over)
        except Exception:
            self.fs.delete(self._path(aside), False)
            if self.fs.exists(self._path(path)):
                return False
            raise
        return True


def wait_for(look: Callable[[], list], every: float = 60.0, most: float | None = None, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> list:
    """Looks again every ``every`` seconds until something is found; after ``most`` seconds TimeoutError."""
    end = None if most is None else clock() + most
    while not (found := look()):
        if end is not None and clock() + every > end:
            raise TimeoutError("nothing was found in time")
        sleep(every)
    return found
