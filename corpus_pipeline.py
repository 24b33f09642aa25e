"""A training-data pipeline over documents, built of the operators in hourglass.llm.

Five stages: quality classifier, SimHash near-duplicates, benchmark decontamination,
secret masking, SentencePiece encoding. Each takes (spark, docs, sf_dir); its result is
written as Parquet in the shared folder and read again as the next one's docs. All but the
last return the columns of documents.

Defined results: null texts are scored, linked and encoded as empty ones; documents with a
null id cannot be named as leaks and stay; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm import decontaminate, quality_cnn, secret_scan, sentencepiece_codec, simhash
from hourglass.llm.queries import table, tokenizer_file
from hourglass.session import work_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network, fit to the labelled ones, does not reject."""
    return quality_cnn.keep_good(docs, quality_cnn.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at 4 bits or fewer (4-word shingles)."""
    return simhash.keep_one_each(docs, work_dir(spark, "pipeline-simhash"), shingle=4, radius=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (5-word shingles, similarity 0.8 or more)."""
    folder = work_dir(spark, "pipeline-leaks")
    decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).write.parquet(folder)
    return decontaminate.without_leaks(docs, spark.read.schema(decontaminate.SCHEMA).parquet(folder))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; n_chars follows the text."""
    masked = secret_scan.mask_secrets(docs, secret_scan.train_on(docs))
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document with begin and end ids, and digests of them and of the decoded text."""
    found = sentencepiece_codec.encode_decode(docs, tokenizer_file("piece_bpe_32k.model"))
    return found.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality_classifier", quality), ("simhash_near_dedup", near_duplicates),
          ("benchmark_decontamination", decontaminated), ("secret_scans", without_secrets),
          ("sentencepiece", encoded)]
#: The network, the fingerprints and the encoding are beyond SQL; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents; each result but the last is written and read again."""
    folder = work_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        found = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            break
        found.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.schema(found.schema).parquet(f"{folder}/{k}-{name}")
    return found
