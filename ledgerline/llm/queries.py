"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import ann, bpe, chat, decontaminate, langid, licenses, line_dedup, ngram_join, prefix_trie, sharding, suffix_dedup, token_counts, whiten
from ledgerline.llm.common import hex_sha256, read_table, shipped
from ledgerline.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

ENCODE_RANKS = "byte_bpe_multi_50k.tiktoken"
COUNT_VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode the ids again, and digest both."""
    path, pattern = public_tokenizers.path(ENCODE_RANKS), public_tokenizers.PATTERN
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, path, pattern, decoded_col="back", keep_text=False)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_sha256(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        hex_sha256(F.col("back")).alias("decoded_sha256"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by 3-word shingles at Jaccard 0.9 or more, and their components."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.similarity_components(docs, width=3, percent=90)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50-byte string kept in the smallest document that has it."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    left = suffix_dedup.remove_repeats(docs, length=50)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return left.select(
        "doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept_bytes")).alias("n_removed"),
        (F.size("removed_bounds") / 2).cast("long").alias("n_spans"), hex_sha256(F.col("kept_bytes")).alias("kept_sha256"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in 13-word windows of benchmark items."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"), window=13)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        hex_sha256(F.concat_ws(",", "items")).alias("items_sha256"),
                        decontaminate.is_contaminated(20).alias("contaminated"))


def held_out(doc_id):
    """The fold that nothing is learned from: crc32 of the id as text, modulo 4, is 2. False for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    return (docs.withColumn("found", langid.predicted(docs, model))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred", "found.score"))


def op8_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts, uniformly shuffled."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_rows(docs, n_shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they exceed the limit."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, public_tokenizers.path(COUNT_VOCABULARY))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one made of control strings, formatted and read back."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))],
                                   "conv_id long, turn long, role string, text string")
    return chat.conversation_digests(chat.format_turns(turns.unionByName(tricky))).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose whole text is a known licence."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "canonical_sha256", "license_id", F.col("license_id").isNotNull().alias("is_license"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, lambda vec_id: vec_id % 20 == 0, k=20)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight first whitened components of every embedding."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whiten.whiten(vectors, components=8).select("vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"),
                                                       "whitened", "explained", "identity_error")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations' turn prefixes, each conversation rebuilt on the first of its five."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.prefix_trie(turns, group=5, modulus=9)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 code points or more in three documents or more, kept in the one with the largest id."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_common_lines(docs, min_docs=3, min_chars=20).select(
        "doc_id", "n_lines", "n_dropped", hex_sha256(F.col("kept_text")).alias("kept_sha256"))


QUERIES = {name: shipped(query) for name, query in {
    "op1_chat_format": op1_chat_format,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_ngram_join": op3_ngram_join,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_hypergeometric_shards": op8_hypergeometric_shards,
    "op9_token_counts": op9_token_counts,
    "op10_nearest": op10_nearest,
    "op11_whitening": op11_whitening,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_line_dedup": op13_line_dedup,
}.items()}
