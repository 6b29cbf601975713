"""The registered queries of the operators, with production parameters over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import (
    ball_tree, byte_bpe, embedding_dedup, filter_audit, line_dedup, minhash_dedup, mixing, periodic_runs, scaled_sketch, substring_dedup,
    token_counts, token_files, toxicity)
from ticklake.llm.common import read_table
from ticklake.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]

TOKEN_LIMIT = 4096
LINE_DOCS = 10
END_ID = 1
MIX_WEIGHTS = (5, 2, 1)


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_rules() -> tuple[str, str]:
    """Rank file and split pattern of the byte-level BPE."""
    import public_tokenizers

    return vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_copies(read_table(spark, sf_dir, "documents"), "doc_id", "text")


def op2_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", every=20, k=20, scale=64.0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = toxicity.train(docs, read_table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    scored = toxicity.score(docs, "text", weights, "score")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_repeated_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=LINE_DOCS, min_chars=1)
    return cleaned.select("doc_id", "line_stats.*", F.sha2("text", 256).alias("kept_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(read_table(spark, sf_dir, "documents"), "doc_id", "text", *bpe_rules(), packed=True)
    decoded = byte_bpe.decode(encoded, "doc_id", "ids", *bpe_rules())
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return decoded.select("doc_id", n_tokens.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), "doc_id", "text", digest=True)
    return reduced.withColumnRenamed("kept", "kept_sha256")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    stored = token_files.stored_ids(docs, "doc_id", "text", vocabulary("word_bpe_49k.json"), END_ID)
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return stored.select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mixing.mix(docs, "doc_id", "source", mixing.count_words(F.col("text")), mixing.letter_share(F.col("text")), MIX_WEIGHTS)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with one document in ten made periodic from a place on, as the contract of op11 says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    # arrays of one element hold values that lambdas use, so that they are worked out once per row
    words = F.array(F.regexp_extract_all(F.col("text"), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0)))

    def planted(w):
        n = F.size(w).cast("long")
        places = F.array(F.struct((g % n).alias("a"), (F.lit(1) + F.floor((n - g % n) / (3 + g % 8))).alias("p")))
        return F.element_at(F.transform(places, lambda x: F.array_join(F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1),
            lambda i: F.get(w, F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]).cast("int"))), " ")), 1)

    periodic = F.element_at(F.transform(words, lambda w: F.when(F.size(w) > 0, planted(w))), 1)
    return docs.select("doc_id", F.coalesce(F.when(h % 10 == 0, periodic), F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_runs(read_table(spark, sf_dir, "documents")), "doc_id", "text")
    greatest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("greatest", greatest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("greatest.start")).alias("start"), F.col("greatest.length").alias("length"), (-F.col("greatest.period")).alias("period"),
        F.floor(1000 * F.col("greatest.length") / -F.col("greatest.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scaled_sketch.edited_fingerprints(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.withColumn("edited_sha256", F.sha2("edited_text", 256)).drop("edited_text")


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_minhash_dedup, op2_ball_tree, op3_toxicity, op4_line_dedup, op5_byte_bpe, op6_token_counts, op7_substring_dedup,
        op8_token_files, op9_embedding_dedup, op10_mixing, op11_periodic_runs, op12_filter_audit, op13_scaled_sketch)
}
