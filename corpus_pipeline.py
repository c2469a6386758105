"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read again as the next one's input.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intervalflow.llm import mixing, pii, quality, sentencepieces
from intervalflow.llm.minhash import near_duplicates
from intervalflow.llm.storage import stage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below its threshold go."""
    scored = quality.quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 1").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five words, similarity 0.8) stays.  Where an id repeats, rows are told apart by id and text, and
    one row of each id and text stays.  Rows with a null id stay."""
    if docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        gone = near_duplicates(docs).where("NOT kept").select(F.col("id").alias("__gone"))
        return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
    digest = F.coalesce(F.sha2("text", 256), F.lit(""))
    once = (docs.where("doc_id IS NOT NULL").groupBy("doc_id", digest.alias("__digest"))
            .agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*", "__digest"))
    # Keys rise with the ids, so the smallest id of a group still stays.
    keyed = once.orderBy(F.col("doc_id").cast("long"), "__digest").withColumn("__key", F.monotonically_increasing_id())
    keyed = stage(keyed, "keyed")
    gone = near_duplicates(keyed, id_col="__key").where("NOT kept").select(F.col("id").alias("__gone"))
    kept = keyed.join(gone, F.col("__key") == F.col("__gone"), "left_anti").select(*docs.columns)
    return kept.unionByName(docs.where("doc_id IS NULL"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become format-preserving pseudonyms; ``n_chars`` follows the new text."""
    return pii.pseudonymise(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeat, or go, by their source's rate."""
    return mixing.repeat(mixing.mix(docs), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document that is left, repeats included, with the text that they decode to."""
    coded = sentencepieces.encode(docs, decoded_col="decoded", keep_text=False)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality_classifier", quality_filter),
    ("minhash_near_dedup", near_dedup),
    ("pii_pseudonyms", pseudonyms),
    ("mixing", mixed),
    ("sentencepiece", tokens),
]
#: Trained models and hashes cannot be said in SQL; tests/llm compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
