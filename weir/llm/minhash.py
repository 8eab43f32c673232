"""Near-duplicate documents by bottom-k sketches from one hash function.

Texts with equal shingle sets form a class; classes are compared, not copies.
One hash function deals the shingles of a set into parts and gives each part,
with all that it holds, one value.  Two sets that differ in d shingles differ in
d parts at most, so of P parts P - d are equal, and sketches of the d + 1 least
values of each set share one: no link is missed.  A part holds two shingles or
more as a rule, and their frequencies come first in the order of values: below
the number of sets that would have the part by chance, its hash decides.  So the lists of unrelated
sets stay short where single shingles are common to ever more sets as the
corpus grows.  (Any order gives the same links; each task tells its most used counters only.)

P depends on the size: sets of 2**j to 2**(j + 1) - 1 shingles are at home on level j, and a set
is a guest on each higher level where its partners can be at home.  A set whose sketch
would take a part that many have by chance is weak: it keeps the other values, and is dealt
anew by the next of SALTS deals.  Where one of two sets is not weak, the value they
share is in both sketches; where both are weak, they meet in the next deal.  After the
last deal all values are kept.

An inverted list holds the classes that retain a value.  Pairs of short lists, and of the
members of a long list with one leader, remain if the sizes and the parities of the two sets,
PARITIES bits, allow them to be similar: a shingle that only one of them has changes one bit at most.
Each class is compared with the partner that most of its lists
name.  Components close over the links, and only what still joins several
components goes on: long lists with other leaders, then pair by pair.  The full sets decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import Stash
from weir.llm.components import HELD, components
from weir.llm.shingles import mix, shingle_sets

COUNTERS_LOG2 = 22
SENT_SLOTS = 1 << 16  # of each task
SHORT = 16  # classes of a list that are paired at once; longer lists go by leaders first
TEXTS = 512  # texts that are hashed at once
SALTS = 4  # deals of a set whose sketches stay weak
FULL = 0.78  # share of the parts that the most different partners of the largest sets of a level can change
CHANCE = 4  # a part that more than 2**CHANCE sets would have by chance is weak
DEALT = 1 << 20  # shingles that are dealt at once; a set with more by itself
PARITIES = 512  # bits; they tell sets of up to about twice as many shingles apart
WORDS = [f"b{i}" for i in range(PARITIES // 64)]
#: Classes whose texts are fetched by a broadcast of their keys (16 bytes each); more are joined by shuffle.
SENT_KEYS = 200_000


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _slots(sets: np.ndarray) -> np.ndarray:
    return (mix(sets) >> np.uint64(64 - COUNTERS_LOG2)).astype(np.int64)


def _counted(size: int):
    """The counters that the sets of a task use most, SENT_SLOTS at most, and at -1 the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTERS_LOG2, dtype=np.int32)
        held: list[np.ndarray] = []
        rows = 0

        def add() -> None:
            slots, uses = np.unique(_slots(np.concatenate([np.empty(0, np.uint64), *held])), return_counts=True)
            total[slots] += uses.astype(np.int32)
            held.clear()

        for b in batches:
            texts = _texts(b.column("text"))
            rows += len(texts)
            for i in range(0, len(texts), TEXTS):
                held += shingle_sets(texts[i : i + TEXTS], size)
                if sum(map(len, held)) > 1_000_000:
                    add()
        add()
        least = max(2, int(np.partition(total, -SENT_SLOTS)[-SENT_SLOTS]) + 1)
        at = np.flatnonzero(total >= least)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at].astype(np.int32)), pa.array(np.r_[rows, total[at]].astype(np.int64))], names=["slot", "uses"])

    return run


def levels(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(level, parts, most shingles in which a partner there can differ) of a set of n, home first; none where partners are equal sets."""
    apart, whole, reach = 100 - percent, 100 + percent, n * 100 // percent
    out, j = [], n.bit_length() - 1
    while 1 << j <= reach:
        last = (2 << j) - 1
        differ = (n + min(reach, last)) * apart // whole
        if differ:
            out.append((j, max(2 * last * apart // whole + 1, round((4 << j) * apart / whole / FULL)), differ))
        j += 1
    return out


def sketches(sets: list[np.ndarray], octaves: np.ndarray, rows: int, percent: int) -> list[np.ndarray]:
    """The retained values of each set, above a last bit that tells whether the set is at home on the value's level; never negative as longs."""
    out: list[list[np.ndarray]] = [[] for _ in sets]
    jobs, held = [], 0
    for i, s in enumerate(sets):
        for level in levels(len(s), percent) if len(s) else ():
            jobs.append((i, *level))
            held += len(s)
        if held > DEALT:
            _deal(sets, jobs, octaves, rows, out)
            jobs, held = [], 0
    _deal(sets, jobs, octaves, rows, out)
    return [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]


def _deal(sets: list[np.ndarray], jobs: list[tuple[int, int, int, int]], octaves: np.ndarray, rows: int, out: list[list[np.ndarray]]) -> None:
    """Adds the values that the sets retain on the levels of the jobs (set, level, parts, most different)."""
    whole = rows.bit_length() - 1
    for salt in range(SALTS):
        if not jobs:
            return
        flat = np.concatenate([sets[i] for i, *_ in jobs])
        sizes, parts = np.array([len(sets[i]) for i, *_ in jobs]), np.array([p for _, _, p, _ in jobs])
        ends = np.concatenate([[0], np.cumsum(parts)])
        x = mix(flat ^ np.uint64(0x9E3779B97F4A7C15 * (salt + 1) % (1 << 64)))
        at = ((x >> np.uint64(32)) * np.repeat(parts, sizes).astype(np.uint64) >> np.uint64(32)).astype(np.int64) + np.repeat(ends[:-1], sizes)
        held = np.zeros(ends[-1], dtype=np.uint64)
        np.add.at(held, at, x)
        rare = np.bincount(at, weights=whole - np.minimum(octaves[_slots(flat)], whole), minlength=len(held)).astype(np.int64)
        chance = np.clip(128 + whole - rare, 0, 255).astype(np.uint64)  # octaves above 128; of an empty part the highest
        part = (np.arange(len(held)) - np.repeat(ends[:-1], parts)).astype(np.uint64)
        value = mix(held + mix(part * np.uint64(4096) + np.repeat(np.array([64 * j + salt for _, j, _, _ in jobs], np.uint64), parts)))
        value = (chance << np.uint64(56)) | (value >> np.uint64(8))
        weak = []
        for job, lo, hi in zip(jobs, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            i, j, _, differ = job
            kept = np.partition(value[lo:hi], differ)[: differ + 1]
            strong = (kept >> np.uint64(56)) <= 128 + CHANCE
            if salt < SALTS - 1 and not strong.all():
                weak.append(job)
                kept = kept[strong]
            home = len(sets[i]) >> j == 1
            out[i].append((((kept & np.uint64((1 << 56) - 1)) << np.uint64(1)) | np.uint64(home)).astype(np.int64))
        jobs = weak


def parities(sets: np.ndarray) -> np.ndarray:
    """How often, odd or even, the shingles of a set fall on each bit, as whole numbers of 64 bits."""
    odd = np.bincount((mix(sets) & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketch_rows(size: int, percent: int, octaves, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _texts(b.column("text"))
            for i in range(0, len(texts), TEXTS):
                sets = shingle_sets(texts[i : i + TEXTS], size)
                cls = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                kept = sketches(sets, octaves.value, rows, percent)
                offsets = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int32)
                flat = np.concatenate(kept)
                bits = np.array([parities(s) for s in sets], dtype=np.int64).reshape(len(sets), len(WORDS))
                part = b.slice(i, len(sets))
                cols = [part.column(c) for c in part.schema.names if c != "text"]
                names = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.binary()), pa.ListArray.from_arrays(offsets, flat), *(pa.array(w) for w in bits.T)], names=[*names, "n_shingles", "cls", "sketch", *WORDS])

    return run


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    inter = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * inter >= percent * (len(a) + len(b) - inter)


def _verified(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, TEXTS):
                part = b.slice(i, TEXTS)
                us = part.column("u").to_pylist()
                fresh = [k for k, u in enumerate(us) if not k or u != us[k - 1]]
                tu = _texts(part.column("tu").take(pa.array(fresh)))
                sets = shingle_sets([*tu, *_texts(part.column("tv"))], size)
                left = np.searchsorted(np.array(fresh), np.arange(len(us)), side="right") - 1
                ok = [k for k in range(len(us)) if similar(sets[left[k]], sets[len(tu) + k], percent)]
                at = pa.array(ok, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("u").take(at), part.column("v").take(at)], names=["u", "v"])

    return run


def _same_text(size: int):
    """Keeps texts whose set is that of the class which their key stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, TEXTS):
                part = b.slice(i, TEXTS)
                sets = shingle_sets(_texts(part.column("text")), size)
                ok = [k for k, (s, c) in enumerate(zip(sets, part.column("cls").to_pylist(), strict=True)) if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == c]
                at = pa.array(ok, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id").take(at), part.column("text").take(at)], names=["id", "text"])

    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, carry: tuple[str, ...] = ("doc_id",), rounds: int = 2) -> DataFrame:
    """``carry`` columns with n_shingles, component_id and kept of every row of ``docs``.

    Rows whose sets have 100 * intersection >= ``percent`` * union are linked; component_id
    is the least doc_id that links reach, its own included.  Null, empty and
    wordless texts have no shingles and are linked with nothing.  Rows with
    one doc_id are rows of their own; a null doc_id is no candidate for
    component_id unless its component has no other.  Texts of any length are
    hashed whole, in pieces.  Which classes lead a list changes the work, not the
    result; ties go to the smaller class number.  Other columns of ``docs`` do not matter.
    """
    spark = docs.sparkSession
    stash = Stash(spark, "minhash")
    own = docs.select(F.struct(*carry).alias("carried"), "doc_id", "text", F.xxhash64("text").alias("tkey"))
    with stash.cleanup():
        slots = own.select("text").mapInArrow(_counted(size), "slot int, uses long").groupBy("slot").agg(F.sum("uses").alias("uses")).toArrow()  # at most 2**COUNTERS_LOG2 rows
    at, uses = slots.column("slot").to_numpy(), slots.column("uses").to_numpy()
    table = np.zeros(1 << COUNTERS_LOG2, dtype=np.uint8)
    table[at[at >= 0]] = np.log2(uses[at >= 0]).astype(np.uint8)
    n_rows = max(1, int(uses[at < 0].sum()))
    octaves = spark.sparkContext.broadcast(table)
    del slots, at, uses, table

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.drop("text").schema)
    full = stash.put(own.mapInArrow(_sketch_rows(size, percent, octaves, n_rows), f"{ddl}, n_shingles long, cls binary, sketch array<long>, {', '.join(f'{w} long' for w in WORDS)}"))
    octaves.destroy()  # what needs it is written
    sets = full.filter(F.col("cls").isNotNull())
    found = sets.groupBy("cls").agg(F.min("doc_id").alias("min_doc"), F.min("tkey").alias("tkey"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), *[F.first(w).alias(w) for w in WORDS])
    rows = stash.put(full.drop("sketch", "tkey", *WORDS))
    sketched = stash.put(found.withColumn("id", F.monotonically_increasing_id()))
    stash.drop(full)
    classes = stash.put(sketched.drop("sketch"))

    # classes that retain a value; guests of a level meet those at home there only
    entries = sketched.select("id", F.explode("sketch").alias("value"))
    entries = entries.select(F.shiftright("value", 1).alias("value"), (F.col("id") * 2 + F.col("value").bitwiseAND(F.lit(1))).alias("member"))
    home = F.col("member").bitwiseAND(F.lit(1))
    of = Window.partitionBy("value")
    every = entries.select("value", "member", F.count("*").over(of).alias("k"), F.sum(home).over(of).alias("homes")).filter("k > 1 and homes > 0")
    every = stash.put(every.select("value", F.shiftright("member", 1).alias("id"), (home == 1).alias("home"), "k"))
    stash.drop(sketched)
    short, lists = every.filter(F.col("k") <= SHORT).select("value", "id", "home"), every.filter(F.col("k") > SHORT).select("value", "id", "home")

    n, m = F.col("n"), F.col("m")
    sized = classes.select("id", "n", *WORDS)
    second = [f"{w}2" for w in WORDS]
    # whether sizes and parities allow sets of n and m shingles to be similar
    apart = sum((F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(WORDS, second, strict=True)), F.lit(0))
    near = (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (apart <= n + m - 2 * F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent)))
    pair = lambda a, b: (F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))

    def allowed(pairs: DataFrame) -> DataFrame:
        return pairs.join(sized.toDF("u", "n", *WORDS), "u").join(sized.toDF("v", "m", *second), "v").filter(near).select("u", "v", "votes")

    def confirm(pairs: DataFrame) -> DataFrame:
        """Links among the pairs (u, v), by their full sets."""
        need = pairs.select(F.col("u").alias("id")).unionByName(pairs.select(F.col("v").alias("id"))).distinct()
        need = stash.put(need.join(classes.select("id", "tkey", "cls"), "id"))
        few = need.count() <= SENT_KEYS
        got = own.select("tkey", "text").join(F.broadcast(need) if few else need, "tkey").select("id", "cls", "text")
        # copies of a text meet here: one from each task goes on, and one of those is kept
        one = got.groupBy("id", "cls").agg(F.first("text").alias("text"))
        texts = stash.put(one.mapInArrow(_same_text(size), "id long, text string"))
        both = pairs.join(texts.toDF("v", "tv"), "v").join(texts.toDF("u", "tu"), "u").select("u", "v", "tu", "tv")
        links = stash.put(both.mapInArrow(_verified(size, percent), "u long, v long"))
        stash.drop(texts, need)
        return links

    twin = short.select("value", F.col("id").alias("id2"), F.col("home").alias("home2"))
    met = short.join(twin, "value").filter((F.col("id") > F.col("id2")) & (F.col("home") | F.col("home2"))).select(F.col("id").alias("u"), F.col("id2").alias("v"))
    lead = lists.filter("home").groupBy("value").agg(F.min("id").alias("lead"))
    led = lists.join(lead, "value").filter("id <> lead").select(*pair("id", "lead"))
    met = stash.put(allowed(met.unionByName(led).groupBy("u", "v").agg(F.count("*").alias("votes"))))

    # each class with the partner that most of its lists name
    sides = [met.select(F.col(x).alias("id"), F.col(y).alias("other"), "votes") for x, y in ("uv", "vu")]
    best = sides[0].unionByName(sides[1]).groupBy("id").agg(F.max(F.struct("votes", (-F.col("other")).alias("other"))).alias("best")).select("id", (-F.col("best.other")).alias("other"))
    tried = stash.put(best.select(*pair("id", "other")).distinct())
    links = confirm(tried)
    lists = stash.put(lists)
    stash.drop(every)

    known = components(links, stash, HELD)
    for r in range(rounds + 1):
        named = lists.drop("component").join(known.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        some = named.groupBy("value").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("value")
        left = named.join(some, "value")
        left = stash.put(left if r else left.join(sized, "id"))
        stash.drop(lists)
        lists = left
        last = r == rounds or lists.isEmpty()
        # what is still open: pairs in different components, of long lists with one leader, drawn anew each time, and at last all of them,
        # each in the first of the lists that it shares
        side = ["value", F.col("id").alias("id2"), F.col("component").alias("c2"), n.alias("m"), *[F.col(w).alias(f"{w}2") for w in WORDS]]
        if last:
            lists = lists.withColumn("all", F.collect_set("value").over(Window.partitionBy("id")))
            other, once = lists.select(*side, F.col("all").alias("all2")), (F.col("id") > F.col("id2")) & near & (F.col("value") == F.array_min(F.array_intersect("all", "all2")))
        else:
            draw = F.struct(F.xxhash64("value", "id", F.lit(r)).alias("h"), "id")
            lead = lists.filter("home").groupBy("value").agg(F.min(draw)["id"].alias("id"))
            other, once = lists.join(lead, ["value", "id"]).select(*side), near
        more = lists.join(other, "value").filter((F.col("component") != F.col("c2")) & once).select(*pair("id", "id2")).groupBy("u", "v").agg(F.count("*").alias("votes"))
        new = met.unionByName(more).groupBy("u", "v").agg(F.max("votes").alias("votes")).join(tried, ["u", "v"], "left_anti")
        for c, to in (("u", "cu"), ("v", "cv")):
            new = new.join(known.toDF(c, to), c, "left").withColumn(to, F.coalesce(to, c))
        new = new.filter("cu <> cv")
        if not last:  # two components by the pair with the most values in common
            new = new.groupBy(F.least("cu", "cv").alias("a"), F.greatest("cu", "cv").alias("b")).agg(F.max(F.struct("votes", "u", "v")).alias("best")).select("best.u", "best.v")
        new = stash.put(new.select("u", "v"))
        if not new.isEmpty():
            found = confirm(new)
            links, tried = links.unionByName(found), tried.unionByName(new)
            known = known if found.isEmpty() else components(links, stash, HELD)
        if last:
            break
    stash.drop(met, left)

    label = classes.select("cls", "id", "min_doc").join(known.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = label.groupBy("component").agg(F.min("min_doc").alias("least"))
    label = label.join(least, "component").select("cls", "least")
    out = rows.join(label, "cls", "left")
    out = out.withColumn("component_id", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.coalesce("least", "doc_id")))
    return out.select("carried.*", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
