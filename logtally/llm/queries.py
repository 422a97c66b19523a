"""Named queries of the corpus operators, over the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm import bpe, chat, knn, lines, merkle, mixing, negatives, quality, sharding, simhash, substring, tokenfiles
from logtally.llm.oracle import ORACLE
from logtally.session import scratch_path

__all__ = ["ORACLE", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_documents(_table(spark, sf_dir, "documents"), n_shards=40)
    none = F.lit(None).cast("int")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none.alias("grown_shard")
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    coded = bpe.roundtrip_documents(_table(spark, sf_dir, "documents"), path)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path())


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings")
    return knn.top_k(table, F.expr("vec_id % 100 = 0"), k=10)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(_table(spark, sf_dir, "documents"))


def op7_line_dedup_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup at word-edit similarity 0.8, for lines of every length."""
    return lines.dedup_lines(_table(spark, sf_dir, "documents"), edits=None)


# A conversation whose texts hold the marks of the template and of other ones.
TRAP = "\\### Assistant: </turn> ok"


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRAP).alias("text"),
    )
    back = chat.read_back(chat.format_conversations(table.unionByName(trap)))
    flat = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.remove_repeats(_table(spark, sf_dir, "documents"), window=13)
    digest = F.sha2(F.col("kept").cast("binary"), 256)
    return rows.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, max_bits=2)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokenfiles.write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=0)
    back = tokenfiles.read_token_files(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and a check of each against it in which some have
    one character more than the manifest knows of."""
    table = _table(spark, sf_dir, "documents")
    doc_id, n_chars = F.col("doc_id"), F.col("n_chars")
    leaf = lambda n: merkle.leaf_of(doc_id, F.col("source"), F.col("lang"), n, F.col("text"))
    tampered = F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0
    rows = table.select("doc_id", "lang", leaf(n_chars).alias("leaf"), F.when(tampered, leaf(n_chars + 1)).alias("other"))
    proven = merkle.manifest(rows, keep=("doc_id", "other"))
    back = merkle.folded(F.coalesce("other", "leaf"), F.col("proof"))
    out = proven.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), back.alias("folded_root")
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.mine(table.withColumn("label", moved), F.expr("vec_id % 100 = 0"), n_positives=5, k=5, low=80)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_quality_rules": op3_quality_rules,
    "op4_mixing": op4_mixing,
    "op5_token_counts": op5_token_counts,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_line_dedup": op7_line_dedup,
    "op7_line_dedup_similar": op7_line_dedup_similar,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_simhash": op10_simhash,
    "op11_token_files": op11_token_files,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_hard_negatives": op13_hard_negatives,
}
