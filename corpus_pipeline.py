"""A corpus pipeline over ``documents``: quality, near duplicates, benchmark leaks, secrets, token ids.

Each stage gets what the one before kept, as a Parquet table, and its decisions take effect:
rejected documents go, one document of each near-duplicate group stays, leaking documents go,
secrets are masked, and the last stage returns token ids. All but the last return the columns
of ``documents``. What each stage does with nulls, empty texts, ties and repeated rows is
said by its operator; a null text stays null until the quality rules reject it as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchpeaks.llm import byte_bpe, decontaminate, ngram_join, quality_rules, secret_scan
from matchpeaks.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(docs)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("secret scans", secrets),
    ("byte-level BPE", token_ids),
]
#: SQL has no exact binomial bounds, edit budgets or BPE; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
