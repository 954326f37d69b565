"""From raw documents to token ids: toxic documents go, one of each group of near duplicates
stays, repeated passages are cut, sources are mixed, and texts are encoded.

The mixture reads some documents more than once, so its stage returns rows that repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableferry.llm import bpe, mixing, neardup, repeats, toxicity
from tableferry.llm.queries import tokenizer_path
from tableferry.session import scratch
from tableferry.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, out="_score").where("_score < 0.5").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest id."""
    return neardup.kept_documents(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages that start in a document of smaller id; a text that
    loses nothing stays as it is."""
    cut = repeats.without_repeats(docs)
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept"))
    return cut.withColumn("text", text).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks for, in blocks of the mixture."""
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each reading, checked by decoding: ``(doc_id, source, n_tokens, ids,
    decoded_sha256)``."""
    merges = bpe.Merges(tokenizer_path())
    ids = bpe.encode(docs.select("doc_id", "source", "text"), merges)
    return bpe.decode(ids.select("doc_id", "source", "ids"), merges).select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates),
          ("substring_dedup", cut_repeats), ("mixing", mix_sources), ("bpe", encode_texts)]

#: Toxicity scores and merges cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
