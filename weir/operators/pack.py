"""Tokenizing and packing into blocks of fixed size."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import ArrayType

from weir.functions.messages import ZEPHYR, ChatTemplate, render_chat
from weir.functions.template import ProgramTemplate


def hash_tokenizer() -> Callable[[str], list[int]]:
    """Words to stable numbers; the stand-in where no tokenizer file is given."""
    import zlib

    return lambda text: [zlib.crc32(w.encode()) & 0x7FFFFFFF for w in text.split()]


def file_tokenizer(path: str) -> Callable[[], Callable[[str], list[int]]]:
    """A factory that loads a tokenizers file once per Python worker."""

    def load() -> Callable[[str], list[int]]:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        return lambda text: t.encode(text).ids

    return load


def slices(batches: Iterator[pa.Array], most: int = 1 << 20) -> Iterator[pa.Array]:
    """Batches of strings in parts of about ``most`` bytes, or of one longer text; empty batches stay."""
    for a in batches:
        at = np.cumsum(pc.fill_null(pc.binary_length(a), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(a)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield a.slice(lo, hi - lo)


def window(ids: Column, max_length: int | None, side: str = "right") -> Column:
    """At most ``max_length`` elements; what is too much goes from ``side``."""
    if side not in ("left", "right"):
        raise ValueError(f"side {side} is neither left nor right")
    if max_length is None:
        return ids
    if max_length < 1:
        raise ValueError("max_length must be positive")
    start = F.greatest(F.lit(1), F.size(ids) - max_length + 1) if side == "left" else F.lit(1)
    return F.slice(ids, start, F.lit(max_length))


def tokenize(df: DataFrame, column: str = "text", factory: Callable[[], Callable[[str], list[int]]] = hash_tokenizer, keep: tuple[str, ...] = ("idx",), max_length: int | None = None, side: str = "right", mask: bool = False) -> DataFrame:
    """``keep`` columns and input_ids, with ``mask`` attention_mask too; the other columns go.  No padding.

    With ``max_length`` longer lists are cut at ``side``; null text has no tokens.  A worker holds the numbers of about 1 MB of text at a time.
    """

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t = factory()
        for part in slices(batches):
            values, ends = array("i"), [0]
            for x in part:
                if x.is_valid:
                    values.extend(t(x.as_py()))
                ends.append(len(values))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(values, np.int32)))

    out = df.select(*keep, ids(F.col(column)).alias("input_ids"))
    if max_length is not None:
        out = out.withColumn("input_ids", window(F.col("input_ids"), max_length, side))
    return out.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1))) if mask else out


def list_columns(df: DataFrame) -> list[str]:
    """The columns that hold lists, input_ids first."""
    names = [f.name for f in df.schema if isinstance(f.dataType, ArrayType)]
    if not names:
        raise ValueError("there is no column of lists")
    return sorted(names, key=lambda n: n != "input_ids")


def pack_blocks(df: DataFrame, block: int, batch: int = 10_000) -> DataFrame:
    """(batch, block_no, lists, labels): every column of lists of each ``batch`` rows by idx, end to end, in blocks of ``block``.

    The lists of a row are cut at the same places, so they must be equally long; null ones are empty.  labels repeats input_ids, or the first
    column where there is none.  What is left of a batch is dropped.  Blocks depend on idx alone, not on how rows are partitioned.
    """
    names = list_columns(df)
    lead = names[0]
    filled = df.select("idx", *[F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType)).alias(c) for c in names])
    step = F.col("idx") - F.pmod(F.col("idx"), F.lit(batch))
    sizes = W.partitionBy("batch").orderBy("idx").rowsBetween(W.unboundedPreceding, -1)
    n = F.size(lead)
    for c in names[1:]:
        n = F.when(F.size(c) == F.size(lead), n).otherwise(F.raise_error(F.lit(f"{c} and {lead} of a row differ in length")).cast("int"))
    at = filled.select((step / batch).cast("long").alias("batch"), "idx", *names, n.alias("n")).withColumn("at", F.coalesce(F.sum("n").over(sizes), F.lit(0)))
    # each row is cut at the block borders that it crosses; only whole slices travel
    first, last = F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("n") - 1) / block)
    cut = at.filter("n > 0").withColumn("block_no", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.lit(0), F.col("block_no") * block - F.col("at")).cast("int")
    hi = F.least(F.col("n").cast("long"), (F.col("block_no") + 1) * block - F.col("at")).cast("int")
    part = cut.select("batch", "block_no", F.struct("idx", *[F.slice(c, lo + 1, hi - lo).alias(c) for c in names]).alias("part"))
    rows = part.groupBy("batch", "block_no").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    whole = rows.select("batch", "block_no", *[F.flatten(F.col("parts")[c]).alias(c) for c in names])
    return whole.filter(F.size(lead) == block).withColumn("labels", F.col(lead))


def pack_blocks_fast(df: DataFrame, block: int, batch: int = 10_000) -> DataFrame:
    """The same blocks by one pass over each batch in Arrow; a batch is held in memory."""
    names = list_columns(df)
    kinds = {c: df.schema[c].dataType.simpleString() for c in names}
    schema = ", ".join(["batch long", "block_no long", *[f"{c} {k}" for c, k in kinds.items()], f"labels {kinds[names[0]]}"])

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("idx")
        flat = {c: pa.concat_arrays([x.flatten() for x in t.column(c).chunks]) for c in names}
        if len({len(x) for x in flat.values()}) > 1:
            raise ValueError("the lists of a row differ in length")
        k = len(flat[names[0]]) // block
        borders = pa.array(range(0, (k + 1) * block, block), pa.int32())
        lists = {c: pa.ListArray.from_arrays(borders, x.slice(0, k * block)) for c, x in flat.items()}
        b = t.column("batch")[0].as_py()
        return pa.table({"batch": pa.array([b] * k, pa.int64()), "block_no": pa.array(range(k), pa.int64()), **lists, "labels": lists[names[0]]})

    keyed = df.select(((F.col("idx") - F.pmod(F.col("idx"), F.lit(batch))) / batch).cast("long").alias("batch"), "idx", *names)
    return keyed.groupBy("batch").applyInArrow(run, schema)


def prepare_clm(df: DataFrame, block: int, column: str = "text", factory=hash_tokenizer, seed: int = 42, batch: int = 10_000, mask: bool = False) -> DataFrame:
    """Shuffle, tokenize, pack."""
    from weir.operators.relational import ranked

    df = ranked(df.withColumn("__h", F.md5(F.concat(F.lit(f"{seed}-"), F.col("idx").cast("string")))).withColumnRenamed("idx", "__old"), ["__h", "__old"])
    return pack_blocks(tokenize(df, column, factory, mask=mask), block, batch)


def prepare_chat(parts: list, block: int, task: str = "sft", factory=hash_tokenizer, batch: int = 10_000, template: ChatTemplate | ProgramTemplate = ZEPHYR, auto_system: bool = True, max_length: int | None = None, side: str = "left", mask: bool = False) -> dict[str, DataFrame]:
    """Mix, render, tokenize and pack; a preference task packs the chosen texts.  With ``max_length`` longer texts lose tokens at ``side``."""
    from weir.operators.relational import mix, ranked

    out = {}
    for kind, df in mix(parts, seed=None).items():
        df = df.withColumn("__h", F.md5(F.concat_ws("-", F.lit("42"), "dataset", "idx"))).withColumnRenamed("idx", "__old")
        text = "text" if task in ("sft", "generation") else "text_chosen"
        shown = render_chat(ranked(df, ["__h", "dataset", "__old"]), task, template, auto_system)
        out[kind] = pack_blocks(tokenize(shown, text, factory, max_length=max_length, side=side, mask=mask), block, batch)
    return out
