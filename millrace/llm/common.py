"""Helpers that several training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from millrace.sources.scratch import scratch_folder

# White space between words, and the letters that are lower-cased.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

WORDS = re.compile(WORD)
FOLD = str.maketrans(UPPER, LOWER)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed.

    Where a text has bytes only of ASCII, the built-in lower-casing does just that and is faster.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def count_words(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    found = F.regexp_count(text, F.lit(WORD))
    return F.coalesce(found, F.lit(0)).cast("long")


def fold_of(doc_id: Column, modulus: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


# The setting that bounds what Spark sends to a Python worker at once, and the bytes asked for.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4_000_000


def bound_batches(spark: SparkSession) -> None:
    """Ask the session for Arrow batches of a few megabytes, where it has not been told otherwise.

    Spark counts rows, and would send ten thousand long texts at once; a worker holds a batch several
    times while it reads it.
    """
    known = spark.sparkContext.getConf().contains(BATCH_SETTING)
    if not known and spark.conf.get(BATCH_SETTING, None) != str(BATCH_BYTES):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


Scan = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Freed memory goes back to the system, where the C library and Arrow would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        # Other C libraries than glibc have no such call.
        pass


def frugal(scan: Scan) -> Scan:
    """``scan`` for mapInArrow that gives freed memory back after each batch and at its end.

    Workers outlive their task and wait beside those at work; what each kept of its largest moment
    would add up with the memory of later stages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                give_back()

        try:
            yield from scan(each())
        finally:
            gc.collect()
            give_back()

    return run


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, which cuts its lineage.

    The folder lies below ``spark.checkpoint.dir``. Later steps read it, and so does the result that
    an operator returns, so it stays until the caller clears that folder.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of numbers and names up to which a table from the driver is sent to all tasks.
BROADCAST_ROWS = 100_000


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table from the driver, broadcast where its rows are few; beyond that Spark may shuffle.

    It is handed over in Arrow's form: from a list of rows Spark would make an RDD, for which every
    executor starts Python workers of another kind, and keeps them.
    """
    fields = StructType.fromDDL(schema)
    columns = {name: pa.array([r[k] for r in rows]) for k, name in enumerate(fields.names)}
    table = spark.createDataFrame(pa.table(columns), fields)
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table


def lowest_hashes(df: DataFrame, key: str, most: int, rows: int, *ties: str) -> DataFrame:
    """Up to ``most`` of the ``rows`` rows of ``df``: those with the lowest hashes of ``key``.

    All but a few more than ``most`` are left out by their hash before any row is sorted, as the
    last step of a sort with a limit is one task.
    """
    hashed = F.xxhash64(key)
    share = (most + 6 * most**0.5 + 100) / max(rows, 1)
    if share < 1:
        df = df.where(hashed < int(share * 2**64) - 2**63)
    return df.orderBy(hashed, key, *ties).limit(most)


# A bitmap of fixed size, 2**20 rows of 64 bits, tells a scan which keys are of interest: 16 MB.
FILTER_WORDS = 1 << 20


def slot_of(key: Column) -> Column:
    """The bit of a key."""
    return F.pmod(F.xxhash64(key), F.lit(FILTER_WORDS * 64))


def bitmap(keys: DataFrame, slot: Column) -> DataFrame:
    """Bits of the slots of ``keys`` by word; at most FILTER_WORDS rows."""
    return (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(slot % 64 AS INT)))").alias("bits"))
    )


def flagged(rows: DataFrame, key: Column, bits: DataFrame) -> DataFrame:
    """Rows whose key may be in the bitmap: all that are, and a few others."""
    columns = rows.columns
    rows = rows.withColumn("_slot", slot_of(key)).withColumn("word", F.shiftright("_slot", 6))
    return (
        rows.join(F.broadcast(bits), "word")
        .where("getbit(bits, CAST(_slot % 64 AS INT)) = 1")
        .select(*columns)
    )


def shards_for(rows: int, *, each: int, most: int = 65536) -> int:
    """How many hash shards keep about ``each`` rows, and never more than ``most`` shards."""
    return max(1, min(most, -(-rows // each)))


def running_start(
    df: DataFrame, group: list[str], shard: str, order: list[str], weight: Column, name: str
) -> DataFrame:
    """Adds ``name``: the sum of ``weight`` over all rows of ``group`` that come before a row.

    Rows come shard after shard, and by ``order`` inside a shard. Each task orders one shard of one
    group; the shards of a group are chained by their sums alone, so a hot group is never in one
    task. The columns of ``group`` and ``shard`` must not be null.
    """
    keys = [*group, shard]
    sums = stored(df.groupBy(*keys).agg(F.sum(weight).alias("_sum")))
    chain = Window.partitionBy(*group).orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*keys, F.coalesce(F.sum("_sum").over(chain), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = df.withColumn("_inner", F.coalesce(F.sum(weight).over(inner), F.lit(0)))
    total = (F.col("_base") + F.col("_inner")).alias(name)
    return placed.join(base, keys).select(*df.columns, total)
