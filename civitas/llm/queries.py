"""Queries and SQL oracles of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from civitas.llm import centroids, chat, decontamination, exact_dedup, hard_negatives, language_id, licenses, ngram_join, packing, quality, secret_scan, suffix_dedup, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(spark, table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(spark, table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(chat.PROBE).alias("text")
    )
    return chat.digest(chat.format_chat(rows.unionByName(probe)))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(spark, docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"), texts_too=False)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), secret_scan.train(secret_scan.examples()))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents")).drop("ids")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark, table(spark, sf_dir, "embeddings"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark, table(spark, sf_dir, "embeddings")).drop("checked")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {k: f for k, f in globals().items() if k.startswith("op")} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_formatting": chat.ORACLE_SQL, "op8_exact_dedup": exact_dedup.ORACLE_SQL, "op10_license_scan": licenses.oracle_sql(), "op11_warc": warc.ORACLE_SQL, "op12_hard_negative_mining": hard_negatives.ORACLE_SQL, "op13_centroid_clustering": centroids.oracle_sql()}
