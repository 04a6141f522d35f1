"""The training-data pipeline: documents through five operators, each stage written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.llm import minhash, mixing, packing, quality, substrings
from clicktide.llm.exchange import small, written
from clicktide.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Identities of kept rows (16 bytes each) that are broadcast; joined by shuffle beyond.
BROADCAST_KEPT = 2_000_000
# Blocks of the classifier, half of its own default: executors keep what earlier stages' workers have taken.
QUALITY_BLOCK_BYTES = 12 << 20


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; repeated rows are kept or go together."""
    labels = configure(spark).read.parquet(f"{sf_dir}/labels.parquet")
    decided = quality.classify(docs, labels, block_bytes=QUALITY_BLOCK_BYTES)
    kept = written(decided.where("kept").select(F.col("row_id").alias("_row_id")).distinct(), "kept")
    return docs.join(small(kept, BROADCAST_KEPT), quality.row_id(docs) == F.col("_row_id"), "left_semi")


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; documents without words all stay."""
    found = written(minhash.near_duplicates(docs), "near-duplicates")
    kept = found.where("kept")
    one = kept.where("n_shingles > 0").groupBy("component").agg(F.min("row_id").alias("_row_id")).select("_row_id")
    blank = kept.where("n_shingles = 0").select(F.col("row_id").alias("_row_id"))
    chosen = written(one.union(blank).distinct(), "kept")
    out = docs.join(small(chosen, BROADCAST_KEPT), minhash.row_key(docs) == F.col("_row_id"), "left_semi")
    if found.where("n_shingles > 0").groupBy("row_id").count().where("count > 1").limit(1).count():
        words = F.coalesce(F.col("text").rlike("[^ \\t-\\r]"), F.lit(False))
        out = out.where(words).dropDuplicates(["doc_id", "text"]).unionByName(out.where(~words))
    return out


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated passages; texts without any stay as they are."""
    names = [n for n in docs.columns if n != "text"]
    keep = {f"_{i}": F.col(f"`{n}`") for i, n in enumerate(names)} | {"_null": F.col("text").isNull()}
    cleaned = substrings.remove_repeats(docs, keep, with_text=True)
    text = F.when(~F.col("_null"), F.col("kept_text"))
    columns = {n: F.col(f"_{i}") for i, n in enumerate(names)} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(columns["n_chars"]).cast(
            docs.schema["n_chars"].dataType)
    return cleaned.select(*[columns[n].alias(n) for n in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the sources' target weights take."""
    return mixing.mixed_documents(docs)


def retrieval_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("retrieval_packing", retrieval_packing),
]

# Perplexities, sketches, draws and token ids are beyond SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
