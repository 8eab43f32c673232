"""Near-duplicate vectors by NN-descent.

Equal vectors form a class that is compared once.  Neighbour lists start from
a forest of random hyperplane codes, the planes going through the mean of all vectors: classes with one code are compared in
blocks of bounded size, and codes that too many share are cut by further planes.  Rounds refine them: neighbours of a class, in either direction, are
compared with each other, and the best stay, until ``patience`` rounds in a row join no
labels or no list changes: as each label is compared within itself at the end, a round
that joins none adds no link.  Then a bounded sample of classes is held against all vectors, and while links of
theirs are missing a larger forest follows.  Lists are
bounded, links are not: whatever passes the threshold in a block joins its two labels,
through a spanning forest of the block, confirmed in double precision.  A class whose list
passes throughout also lists its nearest under other labels, so that the
search goes on beyond its own group.  At the end each component
is compared within itself in pairs of blocks, so its links
are complete whatever its size.  ``audit`` measures recall against all pairs of sampled queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weir.llm.common import Stash
from weir.llm.components import components

MARGIN = 1e-4  # single precision may miss the threshold by less
LIST, BEYOND, LINK = 0, 1, 2


def _unit(x) -> np.ndarray | None:
    """The vector over its length, or None where it has none."""
    if x is None or any(v is None for v in x):
        return None
    v = np.array(x, dtype=np.float64)
    if not len(v) or not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if top == 0:
        return None
    v = v / top  # so that squares neither vanish nor overflow
    return v / np.sqrt(np.dot(v, v))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, n = TaskContext.get().partitionId() << 33, 0
    for b in batches:
        units = [_unit(x) for x in b.column("embedding").to_pylist()]
        row = pa.array(part + n + np.arange(len(units), dtype=np.int64))
        n += len(units)
        yield pa.RecordBatch.from_arrays([row, b.column("vec_id"), pa.array([None if u is None else u.tobytes() for u in units], pa.binary())], names=["row", "vec_id", "unit"])


def _by_length(units: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix) of the vectors of a batch, for each length."""
    sizes = np.array([len(u) // 8 for u in units], dtype=np.int64)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield size, at, np.frombuffer(b"".join(units[i] for i in at)).reshape(len(at), size)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a partition's vectors, one row for each length."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for size, _, m in _by_length(b.column("unit").to_pylist()):
            total[size] = total.get(size, 0) + m.sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["size", "total"])


def _centres(classes: DataFrame) -> dict[int, np.ndarray]:
    """The mean of the vectors of each length; one number for each dimension comes to the driver."""
    part = classes.select("unit").mapInArrow(_summed, "size long, total array<double>").select("size", F.posexplode("total").alias("i", "v"))
    got = part.groupBy("size", "i").agg(F.sum("v").alias("v")).orderBy("size", "i").collect()
    n = {r["size"]: r["n"] for r in classes.groupBy((F.length("unit") / 8).cast("long").alias("size")).agg(F.count("*").alias("n")).collect()}
    return {size: np.array([r.v for r in got if r["size"] == size]) / n[size] for size in n}


def _codes(trees: int, bits: int, seed: int, centres: dict[int, np.ndarray]):
    """Each vector's side of ``bits`` random planes through the centre of all, as one number for each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weight = (1 << np.arange(bits - 1, -1, -1, dtype=np.int64)).astype(np.int64)
        for b in batches:
            for size, at, m in _by_length(b.column("unit").to_pylist()):
                if size not in planes:
                    planes[size] = np.random.Generator(np.random.PCG64([seed, size])).normal(size=(trees, bits, size))
                cls = b.column("cls").take(pa.array(at))
                for t in range(trees):
                    code = ((m - centres[size]) @ planes[size][t].T > 0) @ weight
                    yield pa.RecordBatch.from_arrays([cls, pa.array([size] * len(at), pa.int32()), pa.array([t] * len(at), pa.int32()), pa.array(code)], names=["cls", "size", "tree", "code"])

    return run


def _blocks(codes: DataFrame, depth: int, bits: int, block: int, stash: Stash, step: int = 4) -> DataFrame:
    """(cls, block): classes by the first ``depth`` planes of a tree, and where these are more than ``block`` by further ones.

    Classes that all ``bits`` planes leave together are dealt at random into parts; they lie so close that each part joins the others in other trees.
    """
    done, left, level = None, codes, depth
    while True:
        left = left.withColumn("prefix", F.shiftright("code", bits - level))
        key = ["size", "tree", "prefix"]
        large = left.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > block)
        name = [F.lit(str(level)), *[F.col(c).cast("string") for c in key]]
        if level == bits:
            part = F.pmod(F.xxhash64("cls", "tree"), F.coalesce(F.ceil(F.col("n") / block), F.lit(1))).cast("string")
            here = left.join(large, key, "left").select("cls", F.concat_ws("/", *name, part).alias("block"))
            return here if done is None else done.unionByName(here)
        large = stash.put(large.drop("n"))
        here = left.join(large, key, "left_anti").select("cls", F.concat_ws("/", *name).alias("block"))
        done = here if done is None else done.unionByName(here)
        if large.isEmpty():
            return done
        left, level = left.join(large, key, "left_semi"), min(bits, level + step)


def _missing(queries: pa.Table, least: float):
    """Per batch: how many links the queries have in it, how many of them join two labels, and one such pair for each query and label."""
    ask: dict[int, tuple] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not ask and queries.num_rows:
            ids, labels = (queries.column(c).to_numpy() for c in ("cls", "label"))
            for size, at, m in _by_length(queries.column("unit").to_pylist()):
                ask[size] = ids[at], labels[at], m, m.astype(np.float32).T
        for b in batches:
            ids, labels = (b.column(c).to_numpy() for c in ("cls", "label"))
            for size, at, m in _by_length(b.column("unit").to_pylist()):
                if size not in ask:
                    continue
                q, ql, whole, single = ask[size]
                for i in range(0, len(at), 256):
                    part = at[i : i + 256]
                    near = m[i : i + 256].astype(np.float32) @ single >= least - MARGIN
                    apart = near & (labels[part][:, None] != ql)
                    u, v = np.nonzero(apart)
                    ok = np.einsum("ij,ij->i", m[i : i + 256][u], whole[v]) >= least
                    u, v = u[ok], v[ok]
                    first = np.unique(np.stack([v, labels[part][u]]), axis=1, return_index=True)[1] if len(u) else np.empty(0, np.int64)
                    seen = int(near.sum()) - int((near & (ids[part][:, None] == q)).sum())
                    cols = [np.concatenate([ids[part][u[first]], [0]]), np.concatenate([q[v[first]], [0]]), np.concatenate([np.zeros(len(first), np.int64), [seen]]), np.concatenate([np.zeros(len(first), np.int64), [len(u)]])]
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["u", "v", "seen", "lost"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[int], list[int], list[bool], list[bytes]]]:
    """Runs of rows with one key, in a stream sorted by it: key, classes, labels, whether they want more, vectors."""
    at, cols = None, ([], [], [], [])
    for b in batches:
        for k, *row in zip(*(b.column(x).to_pylist() for x in (key, "cls", "label", "wants", "unit")), strict=True):
            if k != at and cols[0]:
                yield at, *cols
                cols = ([], [], [], [])
            at = k
            for c, x in zip(cols, row, strict=True):
                c.append(x)
    if cols[0]:
        yield at, *cols


def _joining(sim: np.ndarray, same: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block that connect all that its passing pairs do: a spanning forest of the sure ones, and every doubtful one between its trees."""
    sure = (sim >= least + MARGIN) & ~same
    tree, u, v = np.arange(len(sim)), [], []
    open_ = sure.any(axis=1)
    while open_.any():
        root = int(np.argmax(open_))
        open_[root], stack = False, [root]
        while stack:
            i = stack.pop()
            new = np.flatnonzero(sure[i] & open_)
            open_[new], tree[new] = False, root
            u.append(np.full(len(new), i))
            v.append(new)
            stack.extend(new.tolist())
    a, b = np.nonzero(np.triu((sim >= least - MARGIN) & (sim < least + MARGIN) & ~same & (tree[:, None] != tree)))
    return np.concatenate([*u, a]).astype(np.int64), np.concatenate([*v, b]).astype(np.int64)


def _best(keep: int, least: float):
    """Per block: each class's ``keep`` nearest of the block (LIST), of classes that want it also those under other labels (BEYOND), and the pairs that join labels (LINK)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for _, ids, labels, wants, vecs in _groups(batches, "block"):
            if len(ids) < 2 or len({len(x) for x in vecs}) > 1:
                continue
            m = np.frombuffer(b"".join(vecs), dtype=np.float32).reshape(len(ids), -1)
            sim = m @ m.T
            np.fill_diagonal(sim, -2)
            k = min(keep, len(ids) - 1)
            ids, labels = np.array(ids, dtype=np.int64), np.array(labels, dtype=np.int64)
            same = labels[:, None] == labels
            rows = np.arange(len(ids))
            for kind, at, s in ((LIST, rows, sim), (BEYOND, rows[np.array(wants)], np.where(same, np.float32(-2), sim))):
                if len(at):
                    top = np.argpartition(-s[at], k - 1, axis=1)[:, :k]
                    out.append((np.repeat(ids[at], k), ids[top].ravel(), np.take_along_axis(s[at], top, 1).ravel(), kind))
                    held += k * len(at)
            u, v = _joining(sim, same, least)
            out.append((ids[u], ids[v], sim[u, v], LINK))
            held += len(u)
            if held > 100_000:
                yield _pairs(out)
                out, held = [], 0
        if out:
            yield _pairs(out)

    return run


def _pairs(out) -> pa.RecordBatch:
    u, v, s = (np.concatenate([x[i] for x in out]) for i in range(3))
    kind = np.concatenate([np.full(len(x[0]), x[3], dtype=np.int32) for x in out])
    keep = (u != v) & (s > -2)
    return pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep]), pa.array(s[keep].astype(np.float32)), pa.array(kind[keep])], names=["u", "v", "sim", "kind"])


def _dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        dot = [float(np.dot(np.frombuffer(x), np.frombuffer(y))) if len(x) == len(y) else -2.0 for x, y in zip(b.column("uu").to_pylist(), b.column("uv").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v"), pa.array(dot, pa.float64())], names=["u", "v", "sim"])


def _counts(least: float):
    """Blocks of a component's pair of parts: links of each class of either part with the other, by multiplicity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sides = None, {}

        def close() -> pa.RecordBatch:
            a, b = sides.get(0, ([], [], [])), sides.get(1)
            left = np.frombuffer(b"".join(a[1])).reshape(len(a[0]), -1)
            if b is None:  # a part with itself
                hit = left @ left.T >= least
                np.fill_diagonal(hit, False)
                n = hit @ np.array(a[2])
                ids = a[0]
            else:
                right = np.frombuffer(b"".join(b[1])).reshape(len(b[0]), -1)
                hit = left @ right.T >= least
                n = np.concatenate([hit @ np.array(b[2]), hit.T @ np.array(a[2])])
                ids = a[0] + b[0]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n.astype(np.int64))], names=["cls", "links"])

        for b in batches:
            for k, side, c, u, times in zip(*(b.column(x).to_pylist() for x in ("block", "side", "cls", "unit", "times")), strict=True):
                if k != at and sides:
                    yield close()
                    sides = {}
                at = k
                s = sides.setdefault(side, ([], [], []))
                s[0].append(c)
                s[1].append(u)
                s[2].append(times)
        if sides:
            yield close()

    return run


def _top(pairs: DataFrame, k: int) -> DataFrame:
    one = pairs.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    return one.withColumn("rank", F.row_number().over(W.partitionBy("u").orderBy(F.desc("sim"), "v"))).filter(F.col("rank") <= k).drop("rank")


def near_vectors(vectors: DataFrame, least: float = 0.9, k: int = 10, trees: int = 10, leaf: int = 128, block: int = 256, seed: int = 5, miss: float = 0.05, patience: int = 2, asked: int = 8192, goal: float = 0.9995) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding).

    Links have a cosine of at least ``least``; vectors of other lengths, null,
    zero and empty ones and those with null or non-finite components have none.
    ``trees`` is the least number of trees of the first forest; up to four times as many are taken where a pair at the threshold
    would share no leaf with a chance above ``miss``.  Then ``asked`` classes, drawn anew each time, are held against all vectors: while
    more than 1 - ``goal`` of their links are not found yet, these are added and a forest of twice as many trees is compared.  Rows with one
    vec_id, or none, are vectors of their own, and equal vectors are links like others; ties in a list go to the smaller class number, and change the work alone.
    n_links counts the other rows.
    """
    spark = vectors.sparkSession
    stash = Stash(spark, "descent")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = stash.put(vectors.select("vec_id", "embedding").mapInArrow(_read, f"row long, vec_id {kind}, unit binary").withColumn("cls", F.xxhash64("unit")))
    classes = stash.put(rows.filter(F.col("unit").isNotNull()).groupBy("cls").agg(F.first("unit").alias("unit"), F.count("*").alias("times"), F.min("vec_id").alias("least")))
    n = classes.count()
    centres = _centres(classes)
    depth = max(0, int(np.ceil(np.log2(max(1, n) / leaf))))
    bits = min(62, depth + 24)
    if depth:
        common = max(float(c @ c) for c in centres.values())  # what all vectors share does not tell them apart
        angle = math.acos(max(0.0, (least - common) / (1 - common))) if common < 1 else math.pi / 2
        together = (1 - angle / math.pi) ** depth
        trees = min(max(trees, math.ceil(math.log(miss) / math.log1p(-together))), 4 * trees)
    single = stash.put(classes.select("cls", "unit").mapInArrow(_single, "cls long, unit binary"))

    def forest(trees: int, seed: int) -> DataFrame:
        codes = stash.put(classes.select("cls", "unit").mapInArrow(_codes(trees, bits, seed, centres), "cls long, size int, tree int, code long"))
        return stash.put(_blocks(codes, depth, bits, block, stash))

    blocks = forest(trees, seed)
    unit = classes.select("cls", "unit")
    label = stash.put(classes.select("cls", F.col("cls").alias("label")))

    def merged(new: DataFrame) -> DataFrame:
        """Labels after the pairs of ``new`` that double precision confirms; ``label`` itself where they join none."""
        near = new.filter((F.col("kind") == LINK) & (F.col("sim") >= least - MARGIN)).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        near = near.join(unit.withColumnsRenamed({"cls": "u", "unit": "uu"}), "u").join(unit.withColumnsRenamed({"cls": "v", "unit": "uv"}), "v").select("u", "v", "uu", "uv")
        links = near.mapInArrow(_dots, "u long, v long, sim double").filter(F.col("sim") >= least).select("u", "v")
        ends = links.join(label.withColumnsRenamed({"cls": "u", "label": "lu"}), "u").join(label.withColumnsRenamed({"cls": "v", "label": "lv"}), "v")
        ends = stash.put(ends.filter("lu <> lv").select(F.col("lu").alias("u"), F.col("lv").alias("v")).distinct())
        if ends.isEmpty():
            return label
        joined = components(ends, stash).withColumnsRenamed({"node": "label", "component": "to"})
        return stash.put(label.join(joined, "label", "left").select("cls", F.coalesce("to", "label").alias("label")))

    def tagged(graph: DataFrame) -> DataFrame:
        """Labels, and whether a class's whole list passes, so that it needs the nearest beyond its label too."""
        full = graph.groupBy("u").agg((F.min("sim") >= least - MARGIN).alias("wants")).withColumnRenamed("u", "cls")
        return stash.put(label.join(full, "cls", "left").select("cls", "label", F.coalesce("wants", F.lit(False)).alias("wants")))

    def apart(pairs: DataFrame) -> DataFrame:
        both = pairs.join(label.withColumnsRenamed({"cls": "u", "label": "lu"}), "u").join(label.withColumnsRenamed({"cls": "v", "label": "lv"}), "v")
        return both.filter("lu <> lv").select("u", "v", "sim")

    plain = label.withColumn("wants", F.lit(False))
    start = stash.put(_compared(blocks, single, plain, k, least))
    graph = stash.put(_top(_kind(start, LIST), k))
    label = merged(start)
    stash.drop(start)
    tags = tagged(graph)
    asking = blocks.join(tags.filter("wants").select("cls"), "cls", "left_semi").select("block").distinct()
    beyond = stash.put(_top(_kind(_compared(blocks.join(asking, "block", "left_semi"), single, tags, k, least), BEYOND), k))
    seen, quiet = None, 0
    while True:
        ways = [_top(x.unionByName(x.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim")), 2 * k) for x in (graph, beyond)]
        lists = stash.put(ways[0].unionByName(ways[1]).select(F.col("u").alias("block"), F.col("v").alias("cls")).distinct())
        marks = stash.put(lists.join(tags, "cls").groupBy("block").agg(F.bit_xor(F.xxhash64("cls", "label", "wants")).alias("mark")))
        changed = marks if seen is None else stash.put(marks.join(seen, ["block", "mark"], "left_anti"))
        if changed.isEmpty():
            break
        new = stash.put(_compared(lists.join(changed.select("block"), "block", "left_semi"), single, tags, k, least))
        old, before = (graph, beyond, tags, lists), label
        label = merged(new)
        quiet = quiet + 1 if label is before else 0
        if quiet == patience:
            break
        graph = stash.put(_top(_kind(new, LIST).unionByName(graph), k))
        beyond = stash.put(_top(apart(_kind(new, BEYOND).unionByName(beyond)), k))
        tags = tagged(graph)
        seen = marks
        stash.drop(*old, new)
    size = max(1, max((len(c) for c in centres.values()), default=1))
    asked = max(1, min(asked, (32 << 20) // (8 * size)))  # what is sent to every task stays below 32 MB
    turn = 0
    while n > 1:
        labelled = classes.select("cls", "unit").join(label, "cls")
        queries = labelled.orderBy(F.xxhash64("cls", F.lit(turn)), "cls").limit(asked).toArrow()
        got = stash.put(labelled.mapInArrow(_missing(queries, least), "u long, v long, seen long, lost long"))
        seen, lost = got.agg(F.coalesce(F.sum("seen"), F.lit(0)), F.coalesce(F.sum("lost"), F.lit(0))).first()
        if lost:
            label = merged(got.filter("u <> 0 or v <> 0").select("u", "v", F.lit(1.0).cast("float").alias("sim"), F.lit(LINK).alias("kind")))
        if lost <= (1 - goal) * seen:
            break
        turn, trees = turn + 1, 2 * trees
        start = stash.put(_compared(forest(trees, seed + turn), single, label.withColumn("wants", F.lit(False)), k, least))
        label = merged(start)
        stash.drop(start)
    large = label.groupBy("label").agg(F.count("*").alias("n")).filter("n > 1").select("label")
    found = stash.put(label.join(large, "label", "left_semi").select(F.col("cls").alias("node"), F.col("label").alias("component")))

    # each component against itself, part by part
    member = classes.join(found.withColumnRenamed("node", "cls"), "cls")
    width = member.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    member = member.join(width, "component").withColumn("p", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("parts")).cast("int"))
    pair = member.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    name = F.concat_ws("/", "component", F.least("p", "q"), F.greatest("p", "q"))
    pair = pair.select(name.alias("block"), F.when(F.col("p") <= F.col("q"), 0).otherwise(1).alias("side"), "cls", "unit", "times")
    counted = pair.repartition("block").sortWithinPartitions("block", "side").mapInArrow(_counts(least), "cls long, links long").groupBy("cls").agg(F.sum("links").alias("links"))

    group = classes.select("cls", "times", "least").join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    low = group.groupBy("component").agg(F.min("least").alias("low"))
    group = group.join(low, "component").join(counted, "cls", "left").select("cls", "low", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n"))
    out = rows.select("vec_id", "unit", "cls").join(group, "cls", "left")
    valid = F.col("unit").isNotNull()
    out = out.withColumn("n_links", F.when(valid, F.col("n")).otherwise(0).cast("long")).withColumn("component_id", F.when(valid, F.coalesce("low", "vec_id")).otherwise(F.col("vec_id")))
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("cls"), pa.array([np.frombuffer(u).astype(np.float32).tobytes() for u in b.column("unit").to_pylist()], pa.binary())], names=["cls", "unit"])


def _kind(pairs: DataFrame, kind: int) -> DataFrame:
    return pairs.filter(F.col("kind") == kind).select("u", "v", "sim")


def _compared(blocks: DataFrame, single: DataFrame, tags: DataFrame, k: int, least: float) -> DataFrame:
    """(block, cls) -> the best and the joining pairs of each block."""
    full = blocks.join(tags, "cls").join(single, "cls").select("block", "cls", "label", "wants", "unit")
    return full.repartition("block").sortWithinPartitions("block").mapInArrow(_best(k, least), "u long, v long, sim float, kind int")


def audit(vectors: DataFrame, result: DataFrame, every: int = 100, least: float = 0.9, at_once: int = 5_000) -> tuple[int, int]:
    """(links found, links there are) of all rows whose vec_id is divisible by ``every``, against all rows; ``at_once`` queries or so are sent at a time."""
    ask = vectors.filter(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "embedding")
    parts = max(1, -(-ask.count() // at_once))
    found = there = 0
    for part in range(parts):
        some = ask.filter(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part)
        queries = [(r.vec_id, u) for r in some.collect() if (u := _unit(r.embedding)) is not None]
        total = vectors.mapInArrow(_linked(queries, least), "vec_id long, there long").groupBy("vec_id").agg((F.sum("there") - 1).alias("there"))
        got = result.join(total, "vec_id").agg(F.sum("n_links"), F.sum("there")).first()
        found, there = found + (got[0] or 0), there + (got[1] or 0)
    return found, there


def _linked(queries: list[tuple[int, np.ndarray]], least: float):
    """How many rows of a partition each query links with, itself included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for b in batches:
            units = [u for u in map(_unit, b.column("embedding").to_pylist()) if u is not None]
            for size in {len(u) for u in units}:
                m = np.array([u for u in units if len(u) == size])
                for i, q in queries:
                    if len(q) == size:
                        total[i] = total.get(i, 0) + int((m @ q >= least).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["vec_id", "there"])

    return run
