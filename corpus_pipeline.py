"""A training-corpus pipeline: quality rules, line dedup, near-dedup, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows that the next one reads;
all but the last keep the columns of ``documents``.

Defined results of every stage (tested): an empty table stays empty; other columns, also of
names that the operators use, are carried along; rows are taken one by one, so repeated rows
get equal verdicts. What a stage does with nulls, empty texts and ties is said with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm import bpe, lines, mixing, quality, simhash
from logtally.llm.queries import tokenizer_path
from logtally.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. A null or empty text has no words, so it fails the base rules; null
    languages and sources are groups like any other."""
    return quality.quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; so do documents left without any line. Of equal or near lines the one
    of the smallest id, then line, stays; documents without id come last and do not dedupe each
    other. Null and empty texts have no lines to lose and stay as they are."""
    return lines.deduped_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: that of the smallest id, then text hash; of
    repeated rows one. Null and empty texts share fingerprint zero, so one of them stays."""
    return simhash.deduped_documents(docs, words=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it. Documents without a word have size 0 and
    change no sum; a null source is the last one; equal hashes are taken or left together."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (binary, little-endian 32-bit), with digests of the ids and of the text
    decoded from them. A null text is encoded like an empty one: no ids."""
    coded = bpe.roundtrip_documents(docs, tokenizer_path(), keep=("doc_id", "lang", "source"))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

# Hash tables, components and tokenizers have no SQL; tests hold every stage against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{k}")
            out.write.parquet(path)
            out = spark.read.parquet(path)
        docs = out
    return docs
