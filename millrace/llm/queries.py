"""The training-data operators on whole test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.alignment import align_documents, link_statistics
from millrace.llm.bpe import encode_documents
from millrace.llm.common import fold_of
from millrace.llm.conversations import repair_conversations
from millrace.llm.exact_dedup import exact_groups
from millrace.llm.kd_sharding import kd_shards
from millrace.llm.minhash import near_duplicates
from millrace.llm.mixing import mix
from millrace.llm.ngram_lm import score_language
from millrace.llm.pieces import encode_pieces
from millrace.llm.pseudonyms import pseudonymize
from millrace.llm.quality import judge_quality
from millrace.llm.token_counts import count_section_tokens
from millrace.llm.toxicity import score_toxicity

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal data replaced. The key would come from a secret store."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pseudonymize(docs, "key of this corpus")


def weights_of(sources: list[str | None]) -> list[float]:
    """5, 2, 1 and again, in the order of the sources."""
    return [(5.0, 2.0, 1.0)[k % 3] for k in range(len(sources))]


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words takes of every document."""
    mixed = mix(documents(spark, sf_dir), weights_of)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every text, the fixed base rule, and the verdict of the voting rules."""
    # A document goes only where the odds against it are 49 to 1 and more.
    judged = judge_quality(documents(spark, sf_dir), least=0.02)
    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    judged = judged.withColumn("base_failed", (words < 20) | (100 * repeated > 30 * words))
    judged = judged.withColumn("kept", ~F.col("base_failed") & F.col("good"))
    measured = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *measured, "base_failed", "kept", "quality")


def learnable_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the rows that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.where(fold_of(F.col("doc_id"), 3) != 1)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every text; held-out rows are those never learned from."""
    scored = score_toxicity(documents(spark, sf_dir), learnable_labels(spark, sf_dir))
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, with the digest of every text."""
    return exact_groups(documents(spark, sf_dir), digest_column="text_sha256")


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes."""
    placed = kd_shards(documents(spark, sf_dir), shards=8)
    return placed.withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    ).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles are alike to 85 % and more."""
    return near_duplicates(documents(spark, sf_dir), shingle_words=3, percent=85)


def op8_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all texts, learned from the four folds that are not held out."""
    return score_language(documents(spark, sf_dir), fold_of(F.col("doc_id"), 5) != 1)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text decoded from them, as digests."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return coding_digests(encode_documents(docs, VOCABULARY, decoded_column="decoded"))


def coding_digests(coded: DataFrame) -> DataFrame:
    """Numbers and digests of ``ids`` and ``decoded``."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every text, lines being the sections."""
    return count_section_tokens(documents(spark, sf_dir), VOCABULARY)


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every text and the text decoded from them, as digests."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return coding_digests(encode_pieces(docs, PIECES, decoded_column="decoded"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults that follow from the checksum of conversation and
    turn: of twenty, 0 drops the row, 1 empties its text, 2 takes the ends of its sentences, 3 repeats
    it, and 4 makes it the user's. Nulls read as one space."""
    turns = conversations.select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    turns = turns.withColumn("fault", F.pmod(F.crc32(name.cast("binary")), F.lit(20)))
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy")
    return turns.where(fault != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the damage, those without rows too."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = repair_conversations(damaged(conversations))
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    joined = every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two vocabularies in every text."""
    aligned = align_documents(documents(spark, sf_dir), VOCABULARY, PIECES)
    groups = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    found = link_statistics(aligned.withColumn("groups_sha256", groups).drop("groups"))
    counts = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return found.select(F.col("id").alias("doc_id"), *counts, "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pseudonyms": op1_pseudonyms,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_kd_sharding": op6_kd_sharding,
    "op7_minhash": op7_minhash,
    "op8_ngram_lm": op8_ngram_lm,
    "op9_bpe": op9_bpe,
    "op10_token_counts": op10_token_counts,
    "op11_pieces": op11_pieces,
    "op12_conversations": op12_conversations,
    "op13_alignment": op13_alignment,
}
