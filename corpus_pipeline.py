"""The corpus pipeline: five stages, each on all that the one before kept.

Every stage but the last returns the columns of documents; the last returns the pieces
of packed sequences. Null and empty texts pass the stages by the rules their operators
state. Verdicts hold for a row's doc_id (null too) and text together, so texts that share
a doc_id are judged apart; rows that repeat both become one in the stage for exact copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from civitas.llm.common import scratch, stored
from civitas.llm.decontamination import leaks
from civitas.llm.exact_dedup import exact_dedup
from civitas.llm.ngram_join import similar_groups
from civitas.llm.packing import pack
from civitas.llm.quality import score


def keyed(docs: DataFrame, name: str) -> DataFrame:
    """docs and a key of doc_id and a 128-bit hash of the text; as a struct it orders by doc_id and joins null ids."""
    return docs.withColumn(name, F.struct("doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), F.col("text")).alias("b")))


def judged(docs: DataFrame) -> DataFrame:
    """The rows as operators take them, with the key for a doc_id."""
    return keyed(docs, "_key").select(F.col("_key").alias("doc_id"), "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score(spark, docs, labels, names=("_quality_score", "_quality_kept"))
    return scored.where("_quality_kept = 1").select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; one row of each doc_id and text."""
    verdicts = stored(spark, exact_dedup(spark, judged(docs)), scratch(spark), "verdicts")
    kept = verdicts.where("kept").groupBy(F.col("doc_id").alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    out = keyed(docs, "_key").join(kept.select("_key"), "_key", "left_semi")
    repeated = kept.where("n > 1").take(1)
    return (out.dropDuplicates(["_key"]) if repeated else out).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by similar shingle sets, the document of the smallest id."""
    groups = stored(spark, similar_groups(spark, judged(docs)), scratch(spark), "groups")
    kept = groups.where("doc_id <=> component_id").select(F.col("doc_id").alias("_key")).distinct()
    return keyed(docs, "_key").join(kept, "_key", "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    found = stored(spark, leaks(spark, judged(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")), scratch(spark), "leaks")
    return keyed(docs, "_key").join(found.select(F.col("doc_id").alias("_key")).distinct(), "_key", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return pack(spark, docs)


STAGES = [
    ("quality", quality),
    ("exact copies", exact_copies),
    ("near copies", near_copies),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Training, similarity joins and tokenisation are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each stage's rows written to the shared folder and read again."""
    folder = scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(spark, stage(spark, docs, sf_dir), folder, f"stage{i}")
    return docs.drop("ids")
