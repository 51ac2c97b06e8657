"""The corpus pipeline: toxic documents go, poor documents go, one document of each near-duplicate group stays, the rest is packed.

Every stage takes any rows of documents: null and repeated ids, null, empty and very long texts, further columns (which are kept, but by
packing), and a table without rows. What a stage does with them stands with its operator; a stage judges each row, or group, by itself.
"""

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import jaccard, ordinal, packing, toxicity
from sievework.llm.common import scratch, table, until_exit
from sievework.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without labels nothing is known to be toxic, and all stay."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words are poor; without labels all others stay."""
    return ordinal.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row with the smallest id stays (null last); texts without words are one group."""
    return jaccard.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_duplicates", drop_near_duplicates), ("packing", pack)]

#: Trained models and sketches are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all kept documents (columns of packing.SCHEMA)."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        until_exit(spark, path)
        docs = spark.read.parquet(path)
    return docs
