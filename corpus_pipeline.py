"""From raw documents to token ids: each stage works on all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.bpe import encode_documents
from millrace.llm.common import stored
from millrace.llm.exact_dedup import drop_exact_copies
from millrace.llm.minhash import drop_near_duplicates
from millrace.llm.mixing import cut_texts, mix
from millrace.llm.queries import VOCABULARY, learnable_labels, weights_of
from millrace.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 and more for toxicity go."""
    return drop_toxic(docs, learnable_labels(spark, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose 5-word shingles are alike to 80 % and more, one of each component stays."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The blocks that a mix of 150 % of all words takes: a row for each turn of a document in it."""
    taken = cut_texts(docs, mix(docs, weights_of))
    if "n_chars" in docs.columns:
        taken = taken.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return taken


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text decoded from them."""
    rows = docs.select("doc_id", "lang", "source", F.col("text").alias("raw"))
    coded = encode_documents(rows, VOCABULARY, text_column="raw", decoded_column="text")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("bpe", bpe),
]

# SQL can express neither the trained classifier nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each result written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs)
    return docs
