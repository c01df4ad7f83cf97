"""Near-duplicates by MinHash with tensored banding; every link is confirmed on whole sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from millrace.llm.bpe import small_batches
from millrace.llm.common import bitmap, flagged, frugal, slot_of, stored
from millrace.llm.components import connected_components

# Words whose hashes a worker remembers.
MEMORY_ENTRIES = 60_000


class Banding(NamedTuple):
    """Table keys are pairs of one key from each of two collections of ``keys`` keys, each made of
    ``rows`` minhashes: ``keys ** 2`` tables from ``2 * keys * rows`` minhashes, where tables of their
    own would take ``keys ** 2 * 2 * rows``. A pair of similarity s meets in no table with a chance of
    about ``2 * (1 - s ** rows) ** keys``: 2e-5 at 0.85, 4e-4 at 0.8."""

    keys: int = 12
    rows: int = 3
    # Pairs from the tables that agree in less than this share of the minhashes are not compared on
    # their sets. At a similarity of 0.8 a pair falls below it with a chance of about 2e-5.
    least_agreement: float = 0.6

    @property
    def minhashes(self) -> int:
        return 2 * self.keys * self.rows


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (two multiply and xor-shift steps)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sets of hashed word shingles."""

    def __init__(self, size: int):
        self.size = size
        self.memory: dict[bytes, int] = {}

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles; fewer words than ``size`` make one."""
        # Bytes are lower-cased in A-Z alone and split at the six white spaces of ASCII.
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        memory = self.memory
        if len(memory) > MEMORY_ENTRIES:
            memory.clear()
        for w in set(words).difference(memory):
            memory[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))
        n = min(self.size, len(words))
        if n < self.size:
            total = np.full(1, n, np.uint64)
        else:
            total = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            total = _mix(total + codes[k : len(codes) - n + 1 + k])
        return np.unique(total)


def _multipliers(count: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signatures(sets: list[np.ndarray], banding: Banding) -> np.ndarray:
    """Minhashes of each set, one row per set; all of them have members."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), banding.minhashes), np.uint32)
    for k, factor in enumerate(_multipliers(banding.minhashes)):
        values = ((flat * factor) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(values, starts)
    return out


def _keys(signatures: np.ndarray, banding: Banding) -> np.ndarray:
    """Keys of both collections, one row per set: ``keys`` of the first, then of the second."""
    parts = signatures.reshape(len(signatures), 2 * banding.keys, banding.rows).astype(np.uint64)
    total = np.broadcast_to(np.arange(2 * banding.keys, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(banding.rows):
        total = _mix(total + parts[:, :, r])
    return total.view(np.int64)


def _scan(docs: DataFrame, size: int, banding: Banding) -> DataFrame:
    """``id, text_hash, n, digest, signature, keys`` of every row ``id, text, text_hash``; digest and
    the rest null for empty sets."""
    schema = StructType(
        [
            StructField("id", docs.schema["id"].dataType),
            StructField("text_hash", LongType()),
            StructField("n", LongType()),
            StructField("digest", BinaryType()),
            StructField("signature", ArrayType(IntegerType(), False)),
            StructField("keys", ArrayType(LongType(), False)),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for whole in batches:
            for batch in small_batches(whole, "text", 1_000_000):
                sets = [shingler.shingles(t) for t in batch.column(1).to_pylist()]
                filled = [k for k, s in enumerate(sets) if len(s)]
                signature: list = [None] * len(sets)
                keys: list = [None] * len(sets)
                if filled:
                    found = _signatures([sets[k] for k in filled], banding)
                    for k, s, u in zip(filled, found.view(np.int32), _keys(found, banding)):
                        signature[k], keys[k] = s, u
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) for s in sets], pa.binary()),
                        pa.array(signature, pa.list_(pa.int32())),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    schema.names,
                )

    return docs.mapInArrow(frugal(scan), schema)


def _digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _whole_sets(docs: DataFrame, size: int) -> DataFrame:
    """``digest, shingles`` of rows with ``text``, as far as they have words."""
    schema = StructType([StructField("digest", BinaryType()), StructField("shingles", ArrayType(LongType(), False))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for whole in batches:
            for batch in small_batches(whole, "text", 1_000_000):
                sets = [s for t in batch.column(0).to_pylist() if len(s := shingler.shingles(t))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_digest(s) for s in sets], pa.binary()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    schema.names,
                )

    return docs.select("text").mapInArrow(frugal(scan), schema)


def _sized(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) whose sizes allow the similarity, with the minhashes of both."""
    for end in ("a", "b"):
        side = classes.select(F.col("id").alias(end), F.col("signature").alias(f"s{end}"), F.col("n").alias(f"n{end}"))
        pairs = pairs.join(side, end)
    return pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))


def _agreeing(pairs: DataFrame, banding: Banding) -> DataFrame:
    """Those of ``pairs`` with minhashes ``sa`` and ``sb`` that agree in enough of them."""
    agree = F.expr("aggregate(zip_with(sa, sb, (x, y) -> IF(x = y, 1, 0)), 0, (t, v) -> t + v)")
    return pairs.where(agree >= int(banding.least_agreement * banding.minhashes))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` whose whole sets are similar enough."""
    pairs = stored(pairs.select("a", "b"))
    for end in ("a", "b"):
        side = sets.select(F.col("id").alias(end), F.col("shingles").alias(f"x{end}"))
        pairs = pairs.join(side, end)
    common = F.size(F.array_intersect("xa", "xb"))
    union = F.size("xa") + F.size("xb") - common
    return pairs.where(100 * common >= percent * union).select("a", "b")


def _prefixes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``shingle, id, component, n, rest``: the rarest shingles of each member, so many that two
    members which are similar enough have one in common; ``rest`` counts it and all that are less
    rare. Those of one member only are counted but left out."""
    rows = stored(
        sets.join(members, "id").select(
            "id", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")
        )
    )
    common = stored(rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"))
    ranked = (
        rows.join(common, "shingle")
        .groupBy("id", "component", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("shared"))
    )
    length = F.col("n") - F.expr(f"(n * {percent} + 99) div 100") + 1
    left = length - (F.col("n") - F.size("shared"))
    listed = ranked.where(left > 0).select(
        "id",
        "component",
        "n",
        F.size("shared").alias("m"),
        F.posexplode(F.slice("shared", F.lit(1), left.cast("int"))).alias("k", "x"),
    )
    rest = (F.col("m") - F.col("k")).alias("rest")
    return listed.select(F.col("x.shingle").alias("shingle"), "id", "component", "n", rest)


def _other_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``members`` in different components that can be similar enough.

    In a list of members with a rare shingle, those outside the list's most frequent component meet
    all others; pairs within one component are never made. What two members have in common from
    their first common shingle on is at most the smaller ``rest``; it must reach the overlap that
    their sizes ask for.
    """
    lists = stored(_prefixes(members, sets, percent))
    counts = lists.groupBy("shingle", "component").agg(F.count("*").alias("c"))
    top = stored(
        counts.groupBy("shingle")
        .agg(F.max_by("component", F.struct("c", "component")).alias("top"), F.count("*").alias("k"))
        .where("k > 1")
        .select("shingle", "top")
    )
    few = stored(lists.join(top, "shingle").where("component <> top"))
    x, y = few.alias("x"), lists.alias("y")
    met = x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.component") != F.col("y.component"))
        & ((F.col("y.component") == F.col("x.top")) | (F.col("x.id") < F.col("y.id")))
        & ((100 + percent) * F.least("x.rest", "y.rest") >= percent * (F.col("x.n") + F.col("y.n"))),
    )
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    banding: Banding = Banding(),
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked when ``100 * intersection >= percent * union`` of their sets of word
    shingles (A-Z lower-cased). Documents with equal sets form a class, and only one of each class
    goes on. Classes meet in the tables of the tensored banding: rows are first grouped by the keys
    of the first collection alone, and only those that share one get the pairs with the second. In
    each table every class is compared with the most central one, not with all, first by their
    minhashes. Tables whose members then still lie in several components are finished exactly: their
    members are joined on the rarest shingles of each, which finds every pair that is similar enough,
    and pairs of different components are compared, by size and set alone. All comparisons end with
    the whole sets. Nothing is capped.

    Defined cases: a document without words has an empty set and is alone; fewer words than a
    shingle make one shingle of them all. Documents are told by their sets, not by their ids: rows
    that repeat an id with another text, and rows without an id, are compared like all others.
    ``component_id`` is the smallest id reachable, null where no row of the component has one.
    Where all are null, those with the smallest set digest and text hash are kept. Very long texts
    are taken whole. An empty table gives no rows; other columns are ignored.
    """
    found = _judged(docs, id_column, text_column, shingle_words, percent, banding)
    return found.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id", "kept")


def _judged(
    docs: DataFrame, id_column: str, text_column: str, shingle_words: int, percent: int, banding: Banding
) -> DataFrame:
    """``id, text_hash, n, component_id, kept`` of every row."""
    text = docs[text_column]
    rows = docs.select(docs[id_column].alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    thin = stored(_scan(rows, shingle_words, banding))
    present = thin.where("digest IS NOT NULL")
    # A class of equal sets is a node, with a number of its own; written at once, numbers stay.
    classes = stored(
        present.groupBy("digest")
        .agg(
            F.min("id").alias("first_id"),
            F.min("text_hash").alias("text_hash"),
            F.first("n").alias("n"),
            F.first("signature").alias("signature"),
            F.first("keys").alias("keys"),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )

    # Tables: the first collection alone, then the pairs of those that share a key of it.
    first = classes.select(
        "id",
        F.explode(F.slice("keys", 1, banding.keys)).alias("u"),
        F.slice("keys", banding.keys + 1, banding.keys).alias("v"),
    )
    shared = first.groupBy("u").agg(F.count("*").alias("c")).where("c > 1")
    first = flagged(first, F.col("u"), bitmap(shared, slot_of(F.col("u"))))
    second = first.select("id", "u", F.explode("v").alias("v"))
    table = stored(second.select("id", F.xxhash64("u", "v").alias("key")))
    sizes = stored(table.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    table = stored(table.join(sizes, "key"))

    # The most central member of a table is the one that meets most others in all its tables.
    central = stored(table.groupBy("id").agg(F.sum("c").alias("met")))
    table = stored(table.join(central, "id"))
    heads = stored(
        table.groupBy("key").agg(F.max_by("id", F.struct("met", -F.col("id"))).alias("head"))
    )
    star = (
        table.join(heads, "key")
        .where("id <> head")
        .select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b"))
        .distinct()
    )
    # One text of each class is read again; what its words make tells the class.
    met = stored(central.select("id").join(classes.select("id", "digest", "text_hash"), "id"))
    wanted = bitmap(met.select("text_hash"), slot_of(F.col("text_hash")))
    again = flagged(rows.select("text", "text_hash"), F.col("text_hash"), wanted)
    sets = stored(
        _whole_sets(again, shingle_words).join(met.select("id", "digest"), "digest").dropDuplicates(["id"]).select("id", "shingles")
    )
    links = stored(_confirmed(_agreeing(_sized(star, classes, percent), banding), sets, percent))
    labels = connected_components(links)

    # What the stars leave open: tables of three and more whose members are not yet together.
    placed = stored(
        table.where("c > 2")
        .join(labels.withColumnRenamed("node", "id"), "id", "left")
        .select("key", "id", F.coalesce("component", "id").alias("component"))
    )
    open_keys = stored(
        placed.groupBy("key")
        .agg(F.min("component").alias("p"), F.max("component").alias("q"))
        .where("p <> q")
        .select("key")
    )
    members = stored(placed.join(open_keys, "key").select("id", "component").distinct())
    more = _confirmed(_sized(_other_pairs(members, sets, percent), classes, percent), sets, percent)
    links = stored(links.unionByName(more))
    labels = connected_components(links)

    placed = stored(
        classes.select("digest", "id", "first_id", "text_hash")
        .join(labels.withColumnRenamed("node", "id"), "id", "left")
        .select("digest", "first_id", "text_hash", F.coalesce("component", "id").alias("component"))
    )
    # The smallest id of a component; one without ids is told by its first digest.
    named = placed.groupBy("component").agg(
        F.min("first_id").alias("component_id"), F.min(F.struct("digest", "text_hash")).alias("least")
    )
    named = placed.select("digest", "component").join(stored(named), "component").drop("component")
    grouped = present.select("id", "text_hash", "n", "digest").join(stored(named), "digest")
    least = F.struct("digest", "text_hash") == F.col("least")
    kept = F.when(F.col("component_id").isNull(), least).otherwise(F.col("id").eqNullSafe(F.col("component_id")))
    grouped = grouped.select("id", "text_hash", "n", "component_id", kept.alias("kept"))
    alone = thin.where("digest IS NULL")
    alone = alone.select("id", "text_hash", "n", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    return grouped.unionByName(alone)


def drop_near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    banding: Banding = Banding(),
) -> DataFrame:
    """``docs`` with one document of each component, all columns kept.

    Rows are judged by id and text: such as repeat both stay or go together.
    """
    found = _judged(docs, id_column, text_column, shingle_words, percent, banding)
    gone = found.where("NOT kept").select(F.col("id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    gone = stored(gone.distinct())
    same = docs[id_column].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs[text_column]) == gone["gone_hash"])
    return docs.join(gone, same, "left_anti")
