"""Corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All but the last return the columns
of ``docs``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import bpe, decontaminate, pii, quality, simhash
from tidecast.session import checkpoint_dir

BPE_FILE = "byte_bpe_50k.json"
SHINGLE = 3
MAX_BITS = 3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on their labels, does not reject."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.deduplicate(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced; n_chars is that of the new text."""
    new = pii.pseudonymise(docs, count_col="_n_pii")
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return new.select(docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (little-endian unsigned 32-bit integers), n_tokens and
    whether the decoded ids give the text again (a null text counts as empty)."""
    tokenizer = bpe.Tokenizer(public_tokenizers.path(BPE_FILE))
    hashed = docs.select("doc_id", "lang", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"), "text")
    decoded = bpe.decode(bpe.encode(hashed, tokenizer), tokenizer)
    return decoded.select("doc_id", "lang", "source", "ids", "n_tokens", (F.xxhash64("text") == F.col("_hash")).alias("decodes"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII pseudonyms", pii_pseudonyms),
    ("BPE encoding", bpe_encoding),
]

ORACLE_SQL = None  # SQL cannot express the classifier, XXH64 fingerprints, alignment or BPE


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared checkpoint folder."""
    folder = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/stage-{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
