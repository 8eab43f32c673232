"""Connected components by alternating large-star and small-star rounds, all in joins.

With ``held`` tasks first contract what links they hold, so many at a time: each node then has one link, to the least
that it reaches there.  Rounds join what the tasks leave until one task can hold it; fewer links need no round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import Stash

#: Links (16 bytes each) that a task contracts at once.
HELD = 1 << 16


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links, and the least node that each reaches."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    of = np.arange(len(nodes))
    while True:
        x, y = of[a], of[b]
        apart = x != y
        if not apart.any():
            return nodes, nodes[of]
        np.minimum.at(of, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(of, of[of]):
            of = of[of]


def _contract(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined() -> pa.RecordBatch:
            t = pa.Table.from_batches(some)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in least_reached(t.column("u").to_numpy(), t.column("v").to_numpy())], names=["node", "component"])

        some: list[pa.RecordBatch] = []
        for b in batches:
            for i in range(0, b.num_rows, held):
                part = b.slice(i, held)
                if sum(x.num_rows for x in some) + part.num_rows > held:
                    yield joined()
                    some.clear()
                some.append(part)
        if some:
            yield joined()

    return run


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of each node u (those above it, or those below it and itself) to the least of them."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
    both = pairs.join(least, "u")
    if large:
        return both.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return both.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, stash: Stash, held: int = 0) -> DataFrame:
    """(u, v) links of long ids -> (node, component) for every linked node, component being its least node.

    Without ``held`` it takes joins only, without Python.
    """
    links = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    n, before = 0, None
    if held:
        contracted = lambda df, tasks: df.coalesce(tasks).mapInArrow(_contract(held), "node long, component long")
        links = stash.put(links)
        n = links.count()
        if n > held:
            own = contracted(links, -(-n // held)).filter("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
            links, whole = stash.put(own.distinct()), links
            stash.drop(whole)
    else:
        links = stash.put(links.distinct())
    while not held or n > held:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, True).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
        new = stash.put(_star(large, False).filter("u <> v").distinct())
        stash.drop(links)
        links = new
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before:
            break
        before, n = now, now[0]
    if held and n <= held:
        out = stash.put(contracted(links, 1))
        stash.drop(links)
        return out
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
