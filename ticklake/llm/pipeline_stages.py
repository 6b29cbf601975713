"""The stages of the corpus pipeline: each applies an operator to all rows it gets and lets its decisions take effect.

``docs`` has the columns of ``documents`` (doc_id, text, source and any others); all stages but the last return them.
``n_chars``, where there is one, follows the text. Tables without rows pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake.llm import byte_bpe, line_dedup, minhash_dedup, mixing, toxicity
from ticklake.llm.common import read_table
from ticklake.llm.queries import LINE_DOCS, MIX_WEIGHTS, bpe_rules


def _free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = "_" + name
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. NULL and empty texts are scored like others; rows without doc_id too."""
    weights = toxicity.train(docs, read_table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    score = _free_name(docs, "score")
    return toxicity.score(docs, "text", weights, score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in many documents go; all documents stay, also those that lose all their lines. NULL texts stay NULL."""
    cleaned = line_dedup.drop_repeated_lines(docs.withColumn(_free_name(docs, "no_text"), F.col("text").isNull()), "doc_id", "text", LINE_DOCS)
    text = F.when(~F.col(_free_name(docs, "no_text")), F.col("text"))
    changed = cleaned.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("line_stats.n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies stays, once. Rows without doc_id all stay; of
    several rows with one doc_id the one with the largest text stays (NULL last)."""
    copies = minhash_dedup.near_copies(docs, "doc_id", "text").where(~F.col("kept")).select("doc_id")
    left = docs.join(copies.hint("shuffle_merge"), "doc_id", "left_anti")
    rank, apart = _free_name(docs, "rank"), F.when(F.col("doc_id").isNull(), F.xxhash64(F.monotonically_increasing_id()))
    numbered = left.withColumn("apart_" + rank, apart)
    same = Window.partitionBy("doc_id", "apart_" + rank).orderBy(F.col("text").desc_nulls_last())
    return numbered.withColumn(rank, F.row_number().over(same)).where(F.col(rank) == 1).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: 0 to 3 times. Documents without words are never taken."""
    size, quality = mixing.count_words(F.col("text")), mixing.letter_share(F.col("text"))
    mixed = mixing.mix(docs, "doc_id", "source", size, quality, MIX_WEIGHTS, keep_rows=True).where("taken > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int")))).select("row.*")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) of every row."""
    return byte_bpe.encode(docs, "doc_id", "text", *bpe_rules()).withColumn("n_tokens", F.size("ids").cast("long"))
