"""Line dedup: by digests of normalised units, and by an edit-distance join of near-equal lines.

``dedup_units`` hashes runs of lines, of paragraphs or of their sentences and keeps the
earliest ranked occurrence of each digest.  ``dedup_near_lines`` links lines within an edit
distance by a segment-partition join: a line of THRESHOLD + 1 segments that is at most
THRESHOLD edits away keeps one segment whole, at a place that its length
bounds.  It uses DataFrame functions only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import Stash
from weir.llm.components import components

#: Lines whose texts are fetched by a broadcast of their keys (24 bytes each); more are joined by shuffle.
SENT_LINES = 400_000
#: Lists of two lines or more that are sent to the entries (16 bytes each); more are joined by shuffle.
SENT_LISTS = 500_000
_SPACE = re.compile(rb"[\x20\x09-\x0D]+")
#: What ends a unit belongs to it, so the units of a text are the text.
_UNITS = {
    "sentence": re.compile(rb"[^\n.!?]*[\n.!?]+|[^\n.!?]+"),
    "line": re.compile(rb"[^\n]*\n|[^\n]+"),
    "paragraph": re.compile(rb"(?s:.*?)(?:\n[\x20\x09-\x0D]*\n|\Z)"),
}
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def units(text: bytes, unit: str) -> list[tuple[int, int]]:
    """Byte spans of a text's units, end to end."""
    return [m.span() for m in _UNITS[unit].finditer(text) if m.end() > m.start()]


def normal(unit: bytes) -> bytes:
    """A-Z lower-cased, white space runs as one space, none at the ends."""
    return _SPACE.sub(b" ", unit.translate(_LOWER)).strip(b" ")


def runs(text: bytes, unit: str, least: int) -> Iterator[tuple[int, int, bytes]]:
    """(first unit, last unit, normal form) of what is compared; units without words are passed over.

    The shortest run from each unit on that has ``least`` words; each whole line that has as many and is no such run; of a text with fewer words,
    all of it, marked so that it equals whole texts alone.
    """
    spans = units(text, unit)
    have = [(k, x, x.count(b" ") + 1) for k, (s, e) in enumerate(spans) if (x := normal(text[s:e]))]
    form = lambda a, b: b"\n".join(h[1] for h in have[a:b])
    if have and sum(h[2] for h in have) < least:
        yield have[0][0], have[-1][0], b"\x00" + form(0, len(have))
        return
    end = total = 0
    made = set()
    for a, (k, _, n) in enumerate(have):
        while end < len(have) and total < least:
            total += have[end][2]
            end += 1
        if total < least:
            break
        made.add((a, end))
        yield k, have[end - 1][0], form(a, end)
        total -= n
    if unit != "sentence":
        return
    a = 0
    for b in range(1, len(have) + 1):
        if b == len(have) or any(b"\n" in text[slice(*spans[k])] for k in range(have[b - 1][0], have[b][0])):  # a line ends here
            if sum(h[2] for h in have[a:b]) >= least and (a, b) not in made:
                yield have[a][0], have[b - 1][0], form(a, b)
            a = b


def _digests(unit: str, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table() -> pa.RecordBatch:
            at = pa.array(np.array(who, dtype=np.int64))
            d = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            cols = [b.column("doc_id").take(at), b.column("tid").take(at), *(pa.array(np.array(c, dtype=np.int32)) for c in (first, last)), pa.array(d[:, 0]), pa.array(d[:, 1])]
            return pa.RecordBatch.from_arrays(cols, names=["doc_id", "tid", "a", "b", "d1", "d2"])

        for b in batches:
            who, first, last, digests = [], [], [], []
            for i, t in enumerate(b.column("text").cast(pa.binary()).to_pylist()):
                for k, e, x in runs(t or b"", unit, least):
                    who.append(i)
                    first.append(k)
                    last.append(e)
                    digests.append(xxhash.xxh3_128_digest(x))
                if len(who) > 200_000:
                    yield table()
                    who, first, last, digests = [], [], [], []
            yield table()

    return run


def _without(unit: str, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, lost, md5, kept = [], [], [], [], []
            for t, found in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("removed").to_pylist(), strict=True):
                t = t or b""
                have = units(t, unit)
                drop = sorted({k for p in found or [] for k in range(p["a"], p["b"] + 1) if normal(t[slice(*have[k])])})
                n.append(len(have))
                lost.append(len(drop))
                gone.append(",".join(f"{have[k][0]}-{have[k][1]}" for k in drop))
                left = set(drop)
                kept.append(b"".join(t[s:e] for k, (s, e) in enumerate(have) if k not in left) if drop else t)
                md5.append(hashlib.md5(kept[-1]).hexdigest())
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(gone, pa.string()), pa.array(md5, pa.string())]
            names = ["doc_id", "n_units", "n_removed", "removed", "kept_md5"]
            yield pa.RecordBatch.from_arrays([*cols, *([pa.array([k.decode() for k in kept])] if texts else [])], names=[*names, *(["kept"] if texts else [])])

    return run


def dedup_units(docs: DataFrame, unit: str = "sentence", least: int = 30, texts: bool = False) -> DataFrame:
    """(doc_id, n_units, n_removed, removed, kept_md5) of every row of ``docs``, with ``texts`` also the kept text.

    A unit is a line, a paragraph (up to blank lines) or a line's part up to a full stop, exclamation or question mark.
    The shortest run of units from each unit on that has ``least`` words is hashed in normal form; of equal runs the first by
    (doc_id, place) stays, null ids first, and all units of the others go.  So the first occurrence of a
    unit always stays, and passages are found inside lines and across them.  Where units are sentences, lines of ``least`` words or more are hashed whole too, so that
    the end of a repeated line goes with it.  A text with fewer than ``least`` words is hashed whole and goes if it equals another such text; otherwise it is left
    alone.  ``removed`` lists the byte spans, start-end, of the removed units in the original text.
    Null and empty texts have no units.  Rows equal in doc_id and text are one
    document.  Texts of any length are taken whole.  Other columns do not matter.
    """
    stash = Stash(docs.sparkSession, "lines")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tid"))
    found = stash.put(rows.mapInArrow(_digests(unit, least), f"doc_id {kind}, tid long, a int, b int, d1 long, d2 long"))
    twice = stash.put(found.groupBy("d1", "d2").agg(F.count("*").alias("n")).filter("n > 1").select("d1", "d2"))
    shared = stash.put(found.join(twice, ["d1", "d2"]))
    stash.drop(found, twice)
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "a", "tid")
    first = shared.groupBy("d1", "d2").agg(F.min(place).alias("first"))
    again = shared.join(first, ["d1", "d2"]).filter(~place.eqNullSafe(F.col("first")))
    spans = stash.put(again.groupBy("doc_id", "tid").agg(F.collect_set(F.struct("a", "b")).alias("removed")).withColumnsRenamed({"doc_id": "d", "tid": "t"}))
    both = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tid") == F.col("t")), "left")
    more = ", kept string" if texts else ""
    return both.select("doc_id", "text", "removed").mapInArrow(_without(unit, texts), f"doc_id {kind}, n_units long, n_removed long, removed string, kept_md5 string{more}")


# ---- near-equal lines, in DataFrame functions only ----


def within(a: Column, b: Column, most: int) -> Column:
    """Whether the edit distance of two arrays of characters is at most ``most``: bit-parallel, in a band of 2 * most + 1 rows.

    Bit i of column j stands for row j - most + i of the first array.  The distance is
    followed down the band's lowest diagonal and then along the last row.
    """
    mask, last = (1 << (2 * most + 1)) - 1, 1 << (2 * most)
    n, m = F.size(a), F.size(b)
    flip = lambda x: x.bitwiseXOR(F.lit(mask))

    def column(s: Column, j: Column) -> Column:
        c = F.get(b, j - 1)
        eq = F.lit(0)
        for i in range(2 * most + 1):
            row = j - most + i
            eq = eq + F.when((row >= 1) & (F.get(a, row - 1) == c), 1 << i).otherwise(0)
        return F.struct(s["vp"].alias("vp"), s["vn"].alias("vn"), s["d"].alias("d"), eq.alias("eq"), j.alias("j"))

    def step(s: Column, j: Column) -> Column:
        return _step(column(s, j))

    def _step(t: Column) -> Column:
        # one struct layer per quantity, so that none is worked out twice
        one = lambda s, f: F.element_at(F.transform(F.array(s), f), 1)
        t = one(t, lambda s: F.struct(s["vp"].alias("vp"), s["vn"].alias("vn"), s["d"].alias("d"), s["j"].alias("j"), ((s["eq"].bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]).bitwiseOR(s["eq"]).bitwiseOR(s["vn"])).bitwiseAND(F.lit(mask)).alias("d0")))
        t = one(t, lambda s: F.struct(s["d"].alias("d"), s["j"].alias("j"), s["d0"].alias("d0"), s["vn"].bitwiseOR(flip(s["d0"].bitwiseOR(s["vp"]))).alias("hp"), s["d0"].bitwiseAND(s["vp"]).alias("hn")))

        def close(s: Column) -> Column:
            low = n - s["j"] + most  # bit of the last row, once the band has reached it
            bit = F.call_function("shiftleft", F.lit(1), F.greatest(F.lit(0), low))
            along = F.when(s["hp"].bitwiseAND(bit) != 0, 1).when(s["hn"].bitwiseAND(bit) != 0, -1).otherwise(0)
            down = F.when(s["d0"].bitwiseAND(F.lit(last)) == 0, 1).otherwise(0)
            d = s["d"] + F.when(s["j"] + most <= n, down).otherwise(along)
            x = F.shiftright(s["d0"], 1)
            return F.struct(s["hn"].bitwiseOR(flip(x.bitwiseOR(s["hp"]))).alias("vp"), x.bitwiseAND(s["hp"]).alias("vn"), d.cast("int").alias("d"))

        return one(t, close)

    above = mask ^ ((1 << most) - 1)  # before column 1, in its rows: 1 and below rise by one each
    start = F.struct(F.lit(above).alias("vp"), F.lit(0).alias("vn"), F.least(n, F.lit(most)).alias("d"))
    steps = F.aggregate(F.sequence(F.lit(1), m), start, step, lambda s: s["d"])
    return F.when(F.abs(n - m) > most, False).when(m == 0, n <= most).otherwise(steps <= most)


def may_be_within(a: Column, b: Column, most: int) -> Column:
    """Whether most of a's blocks lie in b where ``most`` edits leave them: an edit touches one block and shifts by one."""
    blocks, n = 2 * most + 4, F.length(a)
    cut = lambda i: F.floor(i * n / blocks).cast("int")

    def there(i: Column) -> Column:
        own = F.substring(a, cut(i) + 1, cut(i + 1) - cut(i))
        return F.exists(F.lit(list(range(-most, most + 1))), lambda d: (cut(i) + d >= 0) & (F.substring(b, cut(i) + d + 1, cut(i + 1) - cut(i)) == own))

    return F.size(F.filter(F.lit(list(range(blocks))), there)) >= blocks - most


def common_prefix(a: Column, b: Column, most_chars: int = 1 << 30) -> Column:
    """Length of the common prefix of two texts, by bisection."""
    steps = F.lit([1 << k for k in range(most_chars.bit_length() - 1, -1, -1)])
    shorter = F.least(F.length(a), F.length(b))
    fits = lambda k, p: (k + p <= shorter) & (F.substring(a, k + 1, p.cast("int")) == F.substring(b, k + 1, p.cast("int")))
    return F.aggregate(steps, F.lit(0), lambda k, p: F.when(F.when(k.cast("long") + p > shorter, False).otherwise(fits(k, p)), k + p).otherwise(k))


def _segments(most: int) -> tuple[list[Column], list[Column]]:
    """For a line ``x`` of ``len`` characters: its own segments, and the substrings where segments of lines as long or up to ``most`` shorter may lie.

    Segment i of a line of n characters starts at about i * n / (most + 1).  A line longer by d keeps some segment i at a
    start that differs by no more than the edits before it and by d less those behind it.
    """
    parts = most + 1

    def entry(size: Column, i: int, start: Column, begin: Column, end: Column) -> Column:
        return F.xxhash64(size, F.lit(i), F.substring(F.col("x"), start + 1, end - begin))  # where two differ, the edit distance tells

    def bounds(size: Column, i: int) -> tuple[Column, Column]:
        # any borders do that depend on the size alone; products keep the code small enough to be compiled
        return (size * F.lit(i / parts)).cast("int"), (size * F.lit((i + 1) / parts)).cast("int") if i + 1 < parts else size

    own = [entry(F.col("len"), i, bounds(F.col("len"), i)[0], *bounds(F.col("len"), i)) for i in range(parts)]
    probes = []
    for d, i, shift in _shifts(most):
        size = F.col("len") - d
        b, e = bounds(size, i)
        at = b + shift
        probes.append(F.when((size > 0) & (at >= 0) & (at + e - b <= F.col("len")), entry(size, i, at, b, e)))
    return own, probes


def _shifts(most: int) -> Iterator[tuple[int, int, int]]:
    """(how much shorter the other line is, segment, how far from its place) where a segment of another line may lie."""
    for d in range(most + 1):
        for i in range(most + 1):
            # multi-match bounds: i edits before the segment at most from the left, most - i behind it from the right
            for shift in range(max(-i, d - (most - i)), min(i, d + (most - i)) + 1):
                if d or shift:  # else the line's own segments
                    yield d, i, shift


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, tid, unit, x, len, k1, k2) of each line of at least ``least`` characters in normal form; k1 and k2 tell lines apart."""
    spaced = F.col("text").rlike(r"[\t\x0B\f\r]|  ")
    text = F.lower(F.when(spaced, F.regexp_replace("text", r"[ \t\x0B\f\r]+", " ")).otherwise(F.col("text")))
    rows = docs.select("doc_id", F.xxhash64("text").alias("tid"), F.posexplode(F.split(text, "\n", -1)).alias("unit", "x"))
    rows = rows.select("doc_id", "tid", F.col("unit").cast("long").alias("unit"), F.trim("x").alias("x")).withColumn("len", F.length("x"))
    return rows.filter(F.col("len") >= least).withColumns({"k1": F.xxhash64("x"), "k2": F.xxhash64(F.lit(1), "x")})


def bigram_parity(x: Column) -> Column:
    """64 bits, each the parity of how often the two-character strings of one hash class occur: an edit flips four of them at most."""
    chars = F.array_remove(F.split(x, ""), "")
    return F.transform(F.array(chars), lambda c: F.aggregate(F.sequence(F.lit(0), F.size(c) - 2), F.lit(0).cast("long"), lambda acc, i: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.xxhash64(F.get(c, i), F.get(c, i + 1)).bitwiseAND(F.lit(63)).cast("int")))))[0]


def near_line_groups(lines: DataFrame, stash: Stash, most: int = 2, least: int = 40) -> DataFrame:
    """(k1, k2, r1, r2): of the lines that have another within ``most`` edits, the line that stands for the group; equal lines are one.

    A list holds the lines that have a segment, or a substring where the segment of a line up to ``most`` shorter may
    lie.  Its members are compared with its first line; lists that still hold several groups after that go on pair by
    pair.  Pairs whose two-character strings differ by more than ``most`` edits can explain are never made.
    """
    own, probes = _segments(most)
    n_own, names = len(own), [f"h{i}" for i in range(len(own) + len(probes))]
    keyed = lines.filter(F.col("len") >= least).select("k1", "k2", "len", *[c.alias(h) for c, h in zip([*own, *probes], names, strict=True)])
    # numbers only, so that copies are combined by hash before the shuffle
    distinct = keyed.groupBy("k1", "k2").agg(F.max("len").alias("len"), *[F.max(h).alias(h) for h in names])
    distinct = stash.put(distinct.withColumn("id", F.monotonically_increasing_id()))
    entries = distinct.select("id", F.posexplode(F.array(*names)).alias("i", "h")).filter(F.col("h").isNotNull()).select("id", "h", (F.col("i") < n_own).alias("own"))
    # the least own line of a list leads it; lists without one, or with one line, link nothing
    ends = entries.groupBy("h").agg(F.min(F.when(F.col("own"), F.col("id"))).alias("lead"), F.max("id").alias("last"), F.min("id").alias("first"))
    lead = stash.put(ends.filter("lead is not null and first < last").select("h", "lead"))
    short = lead.count() <= SENT_LISTS
    led = stash.put(entries.join(F.broadcast(lead) if short else lead, "h"))
    need = stash.put(led.select("id").distinct().join(distinct.select("id", "k1", "k2"), "id"))
    few = need.count() <= SENT_LINES
    got = lines.select("k1", "k2", "x").join(F.broadcast(need) if few else need, ["k1", "k2"])
    text = stash.put(got.groupBy("id").agg(F.first("x").alias("x")).withColumn("bits", bigram_parity(F.col("x"))))
    stash.drop(need)
    bits = text.select("id", "bits")
    pair = lambda a, b: (F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    near = lambda a, b: F.call_function("bit_count", a.bitwiseXOR(b)) <= 4 * most
    chars = lambda c: F.array_remove(F.split(c, ""), "")

    def confirm(pairs: DataFrame) -> DataFrame:
        """Links among the pairs (u, v)."""
        both = pairs.join(text.select("id", "x").toDF("u", "xu"), "u").join(text.select("id", "x").toDF("v", "xv"), "v")
        # of pairs that have enough blocks in common only what lies between the first and the last edit is compared
        both = both.filter(may_be_within(F.col("xu"), F.col("xv"), most)).withColumn("p", common_prefix(F.col("xu"), F.col("xv"), 1 << 24))
        both = both.select("u", "v", *[F.reverse(F.substring(c, F.col("p") + 1, F.length(c))).alias(c) for c in ("xu", "xv")])
        both = both.withColumn("p", common_prefix(F.col("xu"), F.col("xv"), 1 << 24))
        # written, for a filter over a projection would split the texts again at every step of the distance
        both = stash.put(both.select("u", "v", *[chars(F.substring(c, F.col("p") + 1, F.length(c))).alias(c) for c in ("xu", "xv")]))
        out = stash.put(both.filter(within(F.col("xu"), F.col("xv"), most)).select("u", "v"))
        stash.drop(both)
        return out

    first = led.filter("id <> lead").select("id", "lead").distinct().join(bits, "id")
    first = first.join(bits.toDF("id2", "bits2"), (F.col("lead") == F.col("id2")) & near(F.col("bits"), F.col("bits2")))
    links = confirm(first.select(*pair("id", "lead")).distinct())
    known = components(links, stash)
    named = led.drop("lead").join(known.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_ = named.groupBy("h").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("h")
    named = stash.put(named.join(open_, "h").join(bits, "id"))
    index = named.filter("own").select("h", F.col("id").alias("id2"), F.col("component").alias("c2"), F.col("bits").alias("bits2"))
    rest = named.join(index, (named.h == index.h) & (F.col("component") != F.col("c2")) & near(F.col("bits"), F.col("bits2"))).select(*pair("id", "id2")).distinct()
    more = confirm(rest)
    found = known if more.isEmpty() else components(links.unionByName(more), stash)
    keys = distinct.select("id", "k1", "k2")
    one = keys.join(found.withColumnRenamed("node", "id"), "id").select("k1", "k2", "component")
    out = stash.put(one.join(keys.toDF("component", "r1", "r2"), "component").select("k1", "k2", "r1", "r2"))
    stash.drop(distinct, lead, led, text, named)
    return out


def dedup_near_lines(docs: DataFrame, most: int = 2, least: int = 40, exact: int = 20, texts: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) of every row of ``docs``; with ``texts`` the columns of ``docs`` and kept_text instead.

    Lines of at least ``least`` characters in normal form (lower-cased, white space as one space)
    that an edit distance of at most ``most`` links, directly or by others between
    them, form a group; shorter lines from ``exact`` characters on are grouped with equal ones.
    The first of a group by (doc_id, place) stays, null ids first.  ``removed`` lists the
    places of the others, from 0.  Lines below ``exact`` characters stay.  Null texts have no
    lines and stay null.  Rows equal in doc_id and text are one document.  Columns of ``docs`` may have any names but
    kept_text, which is replaced.  Lines of any length are compared whole.
    """
    stash = Stash(docs.sparkSession, "edit")
    exact = min(exact, least)
    lines = stash.put(_lines(docs, exact))
    group = near_line_groups(lines, stash, most, least)
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "unit", "tid")
    rows = lines.select("doc_id", "tid", "unit", "k1", "k2").join(group, ["k1", "k2"], "left")
    rows = stash.put(rows.select("doc_id", "tid", "unit", F.coalesce("r1", "k1").alias("k1"), F.coalesce("r2", "k2").alias("k2")))
    stash.drop(lines)
    twice = rows.groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1").select("k1", "k2")
    shared = stash.put(rows.join(twice, ["k1", "k2"]))
    first = shared.groupBy("k1", "k2").agg(F.min(place).alias("first"))
    gone = shared.join(first, ["k1", "k2"]).filter(~place.eqNullSafe(F.col("first"))).groupBy("doc_id", "tid").agg(F.sort_array(F.collect_set("unit")).alias("gone"))
    own = "__"  # no column of docs begins like ours
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    gone = stash.put(gone.toDF(f"{own}doc", f"{own}text", f"{own}gone"))
    stash.drop(group, rows, shared)
    keyed = docs.withColumn(f"{own}tid", F.xxhash64("text"))
    if not texts:
        keyed = keyed.select("doc_id", f"{own}tid", F.when(F.length("text") > 0, F.size(F.split("text", "\n", -1))).otherwise(0).cast("long").alias("n_lines"))
    both = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col(f"{own}doc")) & (F.col(f"{own}tid") == F.col(f"{own}text")), "left")
    lost = F.col(f"{own}gone")
    if not texts:
        return both.select("doc_id", "n_lines", F.coalesce(F.size(lost), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join(lost, ","), F.lit("")).alias("removed"))
    # array_contains is a scan, so the removed places go into a map first
    both = both.withColumn(f"{own}lost", F.map_from_arrays(lost, F.transform(lost, lambda x: F.lit(True))))
    left = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: F.element_at(F.col(f"{own}lost"), i.cast("long")).isNull()), "\n")
    return both.select(*[c for c in docs.columns if c != "kept_text"], F.when(lost.isNull(), F.col("text")).otherwise(left).alias("kept_text"))
