"""The corpus pipeline: five stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import bpe, lines, minhash, mixing, quality
from weir.llm.common import Stash, documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Most rows whose numbers (8 bytes each) are sent to every task to spare texts the shuffle.
SENT = 1_000_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.robust_quality(docs.select(*COLUMNS), widen=True).filter("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document or line has nearly; those left without a word go."""
    out = lines.dedup_near_lines(docs.select(*COLUMNS), texts=True)
    cut = out.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("kept_text").cast("long"))
    return cut.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least doc_id, of each group of near duplicates; null ids come after all others, and of equal ids one row stays."""
    stash = Stash(spark, "near")
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.unhex(F.sha2("text", 256)).alias("text"))  # what tells rows apart; no copy of the texts is written for it
    docs = docs.select(*COLUMNS)
    found = minhash.near_duplicates(docs.select(row.alias("doc_id"), "text"), size=5, percent=80)
    stays = stash.put(found.filter("kept").groupBy(F.col("doc_id").alias("__row")).agg(F.count("*").alias("__n")))
    few = stays.count() <= SENT

    def those(stays: DataFrame) -> DataFrame:
        stays = stays.select(F.col("__row").alias("__stays"))
        return docs.withColumn("__row", row).join(F.broadcast(stays) if few else stays, F.col("__row").eqNullSafe(F.col("__stays")), "left_semi")

    met, more = those(stays.filter("__n = 1")), stays.filter("__n > 1")
    if not more.isEmpty():
        met = met.unionByName(those(more).dropDuplicates(["__row"]))
    return met.select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows equal in doc_id, source and text are taken as often as all of them together."""
    stash = Stash(spark, "mixed")
    docs = docs.select(*COLUMNS).withColumn("__text", F.xxhash64("text"))
    taken = mixing.mix(docs, carry=("__text",)).groupBy("doc_id", "source", "__text").agg(F.sum("copies").alias("__copies"), F.count("*").alias("__n")).filter("__copies > 0")
    taken = stash.put(taken.withColumnsRenamed({"doc_id": "__id", "source": "__source", "__text": "__t"}))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("__text") == F.col("__t"))
    met = docs.join(taken.filter("__n = 1"), same)
    if not taken.filter("__n > 1").isEmpty():
        met = met.unionByName(docs.join(taken.filter("__n > 1"), same).dropDuplicates(["doc_id", "source", "__text"]))
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the mix."""
    return bpe.encode(docs, bpe.vocabulary(), carry=("doc_id", "lang", "source"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mix sources", mix_sources),
    ("encode", encode),
]

#: Robust estimates, edit joins and tokens have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents."""
    stash = Stash(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stash.put(stage(spark, docs, sf_dir))
    return docs
