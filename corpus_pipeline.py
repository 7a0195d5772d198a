"""Corpus pipeline: quality rules, near-duplicate removal, secret removal, mixing, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm import mixing, pieces, quality, secrets, simhash
from keyflow.llm.common import load_table, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the model fitted on ``labels`` keep."""
    return quality.keep_good(docs, load_table(spark, sf_dir, "labels"))


def simhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: three-word shingles, at most two bits apart."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking credentials masked."""
    return secrets.remove_live(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents by whole passes, and blocks of them for the last pass."""
    return mixing.mixed_documents(docs)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mix, with the digests of ids and decoded text."""
    out = pieces.encoded(docs, pieces.default_model(), into="__p")
    return out.select("doc_id", "source", F.col("__p.n_tokens").alias("n_tokens"),
                      F.col("__p.ids_sha256").alias("ids_sha256"),
                      F.col("__p.decoded_sha256").alias("decoded_sha256"), F.col("__p.ids").alias("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_neardup),
    ("secret scans", secret_scan),
    ("mixing sources", mix_sources),
    ("SentencePiece ids", sentencepiece_ids),
]

# No SQL expresses boosted trees, token merges or the hash orders of the mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows lie in the shared folder."""
    docs = load_table(spark, sf_dir, "documents")
    base = shared_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{base}/{k}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
