"""A pipeline over documents: toxicity, exact and near duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm.common import stored, table
from arealis.llm.exact_dedup import exact_duplicates
from arealis.llm.mixing import mixed
from arealis.llm.near_dedup import near_duplicates
from arealis.llm.packing import packed
from arealis.llm.toxicity import toxicity_scores


def _key(name: str) -> Column:
    """The id as text, null as an empty one, so that it joins by plain equality."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _rows(docs: DataFrame) -> DataFrame:
    """Whole rows as one column next to their key: no name of theirs can clash with ours."""
    return docs.select(F.struct("*").alias("row")).withColumn("key", _key("row.doc_id"))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic.

    Of rows that repeat a doc_id all go if one of them is toxic.
    """
    scores = toxicity_scores(docs, table(spark, sf_dir, "labels"))
    toxic = scores.where("predicted = 1").select(_key("doc_id").alias("key")).distinct()
    return _rows(docs).join(toxic, "key", "left_anti").select("row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every text: the one with the largest doc_id; rows that repeat it go as well."""
    kept = (
        exact_duplicates(docs)
        .where("kept")
        .select(_key("doc_id").alias("key"), F.col("text_sha256").alias("digest"))
        .distinct()
    )
    return (
        _rows(docs)
        .withColumn("digest", F.sha2(F.coalesce("row.text", F.lit("")), 256))
        .join(kept, ["key", "digest"])
        .dropDuplicates(["key", "digest"])
        .select("row.*")
    )


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: the one with the smallest doc_id."""
    kept = near_duplicates(docs).where("kept").select(_key("doc_id").alias("key")).distinct()
    return _rows(docs).join(kept, "key", "left_semi").select("row.*")


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it.

    Rows that repeat a doc_id are each taken as often as the most taken of them.
    """
    taken = (
        mixed(docs)
        .groupBy(_key("doc_id").alias("key"))
        .agg(F.max("repeats").cast("int").alias("repeats"))
        .where("repeats > 0")
    )
    return (
        _rows(docs)
        .join(taken, "key")
        .select("row", F.explode(F.array_repeat(F.lit(0), F.col("repeats"))))
        .select("row.*")
    )


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their place in sequences."""
    return packed(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("mixing", to_weights),
    ("packing", into_sequences),
]

#: The classifier and the hashes are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
