"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import lower_ascii, stored

PREFIX_CHARS = 64
# The filter of surviving groups has this many words of 64 bits: 2**20 rows of 16 bytes are 16 MB,
# whatever the input, which is what makes it safe to broadcast.
FILTER_WORDS = 1 << 20


def _slot(length: Column, prefix: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(words * 64))


def exact_groups(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    filter_words: int = FILTER_WORDS,
    digest_column: str | None = None,
) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``.

    ``digest_column`` asks for the SHA-256 of every text, also of those that need none.

    Texts are equal when identical after lower-casing A-Z. The byte length is counted first; rows
    that share a length are counted by a hash of their prefix; only rows that share both have their
    whole text hashed (SHA-256). Groups are counted before any shuffle of rows, and only ids,
    lengths and hashes are shuffled, never texts. Which groups survived is told to the second scan
    by a bitmap of fixed size; a collision in it costs one hash more and changes no result.

    Defined cases: a null text counts as empty, and all empty texts are one group. The largest id of
    a group stays; a null id stays only if the group has no other. Rows that repeat an id are one
    document and stay or go together. An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(docs[text_column], F.lit(""))
    rows = docs.select(docs[id_column].alias("id"), text.alias("text"))
    rows = rows.select(
        "id",
        "text",
        F.octet_length("text").alias("length"),
        F.xxhash64(lower_ascii(F.substring("text", 1, prefix_chars))).alias("prefix"),
    )
    # A group of one by length is a group of one by length and prefix, so one scan counts both.
    counts = rows.groupBy("length", "prefix").agg(F.count("*").alias("n")).where("n > 1")
    slot = _slot(F.col("length"), F.col("prefix"), filter_words)
    bitmap = (
        counts.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(slot % 64 AS INT)))").alias("bits"))
    )
    # Only rows whose group survived have their whole text hashed.
    tested = rows.withColumn("slot", _slot(F.col("length"), F.col("prefix"), filter_words))
    tested = tested.withColumn("word", F.shiftright("slot", 6))
    tested = tested.join(F.broadcast(bitmap), "word", "left")
    survives = F.expr("bits IS NOT NULL AND getbit(bits, CAST(slot % 64 AS INT)) = 1")
    digest = F.unhex(F.sha2(lower_ascii(F.col("text")), 256))
    asked = [digest.alias("digest")] if digest_column else []
    thin = stored(tested.select("id", F.when(survives, digest).alias("full"), *asked))
    extra = ["digest"] if digest_column else []

    # Stored, so that the join below shuffles both sides itself and can split a hot group.
    sizes = stored(
        thin.where("full IS NOT NULL")
        .groupBy("full")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    hashed = thin.where("full IS NOT NULL").join(sizes, "full", "left")
    alone = F.col("group_size").isNull()
    grouped = hashed.select(
        "id",
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        *extra,
    )
    single = thin.where("full IS NULL").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), *extra
    )
    return grouped.unionByName(single).select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        *[F.lower(F.hex("digest")).alias(digest_column) for _ in extra],
    )


def drop_exact_copies(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options: int
) -> DataFrame:
    """``docs`` without the rows that go, all columns kept.

    A row is known by its id and the hash of its text, so that rows with the same id, or none, and
    different texts are told apart; rows that repeat both stay or go together. Those that go are
    joined against, as there are fewer of them than of those that stay.
    """
    text_hash = F.xxhash64(F.coalesce(docs[text_column], F.lit("")))
    rows = docs.select(F.struct(docs[id_column].alias("id"), text_hash.alias("hash")).alias("row"), docs[text_column].alias("text"))
    groups = exact_groups(rows, id_column="row", text_column="text", **options)
    gone = stored(groups.where("NOT kept").select(F.col("row.id").alias("gone_id"), F.col("row.hash").alias("gone_hash")))
    same = docs[id_column].eqNullSafe(gone["gone_id"]) & (text_hash == gone["gone_hash"])
    return docs.join(gone, same, "left_anti")
