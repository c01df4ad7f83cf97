"""Shards as the leaves of a k-d tree over metadata, cut at distributed weighted medians."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from millrace.llm.common import running_start, shards_for, small_table, stored

# Bins of a node, and of all nodes of a round together while each has 16.
BINS, LEAST_BINS, ALL_BINS = 4096, 16, 1 << 20
# A bin with at most this share of its node's bytes is fine enough to cut beside it.
TOLERANCE = 0.0005
# Equal texts are cut apart only where they have more than this share of the bytes of a leaf.
GROUP_SHARE = 0.04
ROWS_PER_SLOT_SHARD = 256
TOP = 1 << 32


@dataclass
class Search:
    """The search for one node's weighted median. Keys are triples: the place along the node's
    widest dimension, the hash of the text, the hash of the id. ``fixed`` holds the leading parts
    that are settled; ``low`` to ``high`` is where the next part of the median lies."""

    node: int
    dimension: int
    weight: int
    leaves: int
    wanted: float
    low: int
    high: int
    fixed: tuple[int, ...] = ()
    before: int = 0
    bins: int = BINS
    cut: tuple[int, int, int] | None = None

    @property
    def step(self) -> int:
        return -(-(self.high - self.low + 1) // self.bins)

    def narrow(self, bins: list[Row]) -> None:
        """Takes the sums of the bins and settles the bin with the median, or the cut."""
        before = self.before
        bins = sorted(bins, key=lambda r: r["bin"])
        for k, row in enumerate(bins):
            if before + row["bytes"] >= self.wanted or k + 1 == len(bins):
                break
            before += row["bytes"]
        level = len(self.fixed)
        alone = row["least"] == row["most"]
        fine = TOLERANCE * self.weight
        if alone and level == 1:
            # One text, or rarely several of one hash, at one place.
            fine = max(fine, GROUP_SHARE * self.weight / self.leaves)
        if row["bytes"] <= fine or (alone and level == 2):
            # Beside the bin, on the side that is nearer to the wanted weight.
            left = self.wanted - before <= before + row["bytes"] - self.wanted
            at = row["least"] if left else row["most"] + 1
            self.cut = (*self.fixed, at, 0, 0)[:3]
            return
        self.before = before
        if alone:
            self.fixed = (*self.fixed, row["least"])
            self.low, self.high = 0, TOP - 1
        else:
            self.low, self.high = row["least"], row["most"]


def _key_parts(dimensions: list[str], number: Column) -> list[Column]:
    place = F.lit(None).cast("long")
    for k, name in enumerate(dimensions):
        place = F.when(number == k, F.col(name)).otherwise(place)
    return [place, F.col("text_hash"), F.col("id_hash")]


def _search(rows: DataFrame, dimensions: list[str], searches: list[Search]) -> None:
    """All nodes of a level at once: each round sums at most BINS bins per node, and fewer where there
    are many nodes, so that what the driver sees stays small."""
    spark = rows.sparkSession
    while waiting := {s.node: s for s in searches if s.cut is None}:
        for s in waiting.values():
            s.bins = max(LEAST_BINS, min(BINS, ALL_BINS // len(waiting)))
        table = [
            (s.node, s.dimension, len(s.fixed), *(*s.fixed, 0, 0)[:2], s.low, s.high, s.step)
            for s in waiting.values()
        ]
        asked = small_table(
            spark, table, "node int, dim int, level int, f0 long, f1 long, low long, high long, step long"
        )
        met = rows.join(asked, "node")
        x, t, h = _key_parts(dimensions, F.col("dim"))
        met = met.where(((F.col("level") < 1) | (x == F.col("f0"))) & ((F.col("level") < 2) | (t == F.col("f1"))))
        part = F.when(F.col("level") == 0, x).when(F.col("level") == 1, t).otherwise(h)
        met = met.select("node", "size", "low", "high", "step", part.alias("part"))
        sums = (
            met.where("part BETWEEN low AND high")
            .groupBy("node", F.expr("(part - low) div step").alias("bin"))
            .agg(F.sum("size").alias("bytes"), F.min("part").alias("least"), F.max("part").alias("most"))
            .collect()
        )
        found: dict[int, list[Row]] = {}
        for row in sums:
            found.setdefault(row["node"], []).append(row)
        for node, bins in found.items():
            waiting[node].narrow(bins)


def _one_place_per_text(rows: DataFrame, categories: list[str]) -> DataFrame:
    """Rows of equal texts get the places of one of them, whatever sources and languages they have.

    Only texts that occur at several places are joined back. Their rows are summed up before they
    are shuffled, and a text with very many rows is split by adaptive execution.
    """
    first = F.min(F.struct(*categories)).alias("first")
    several = F.lit(False)
    for c in categories:
        several = several | (F.min(c) != F.max(c))
    groups = rows.groupBy("text_key").agg(first, several.alias("several")).where("several")
    met = rows.join(groups, "text_key", "left")
    moved = {c: F.coalesce(F.col("first")[c], F.col(c)) for c in categories}
    return met.withColumns(moved).select(*rows.columns)


def kd_shards(
    docs: DataFrame,
    *,
    shards: int | None = None,
    target_bytes: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    category_columns: tuple[str, ...] = ("source", "lang"),
    seed: int = 3,
) -> DataFrame:
    """Id, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every document.

    ``size`` is the UTF-8 bytes of the text plus 1. The tree has ``shards`` leaves, or as many as
    make leaves of about ``target_bytes``. Its dimensions are the logarithm of the size and a fixed
    place for each value of the category columns. A node is cut along the dimension in which it is
    widest, measured against the width of the whole input (the first of equals), at the point that
    gives each side bytes in proportion to its leaves. Documents at one place, such as a source with
    a third of all rows, are cut by the hash of their text and then of their id, so that leaves are
    near equal in bytes. Equal texts share one place, the least of their rows', and stay in one shard
    unless they have more than GROUP_SHARE of the bytes of a leaf: such a group is cut, by the hash of
    the id, if a median falls on it. Keeping the others whole moves a cut by half of that at most.

    Medians are found by sums of at most 4,096 bins per node and round, and of about a million in all
    (16 a node beyond 65,536 nodes); the driver sees those sums and the cuts, never rows. ``slot`` numbers the documents of a shard from 0 without gaps, in hash
    order, over many tasks per shard.

    Defined cases: a null text has size 1 and the crc of the empty text, and is equal to it; very long
    texts are read whole, and one that is heavier than a leaf has it alone; null categories are a place
    of their own; rows that repeat id and text cannot be cut apart; a small table may leave leaves
    empty; an empty table gives no rows; other columns are ignored.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give shards or target_bytes")
    text = F.coalesce(docs[text_column], F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    dimensions = ["d_size", *[f"d_{k}" for k in range(len(category_columns))]]
    places = [F.floor(F.log2(size) * (1 << 24)).cast("long").alias("d_size")]
    for name, c in zip(dimensions[1:], category_columns):
        value = docs[c].cast("string")
        places.append(F.when(value.isNull(), 0).otherwise(1 + F.shiftrightunsigned(F.xxhash64(value), 34)).alias(name))
    rows = docs.select(
        docs[id_column].alias("id"),
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
        F.shiftrightunsigned(F.xxhash64(text), 32).alias("text_hash"),
        F.shiftrightunsigned(F.xxhash64(docs[id_column], F.lit(seed)), 32).alias("id_hash"),
        *places,
        F.lit(0).alias("node"),
    )
    rows = stored(rows)
    if category_columns:
        rows = stored(_one_place_per_text(rows, dimensions[1:]).drop("text_key"))
    bounds = [f(d).alias(f"{f.__name__}_{d}") for d in dimensions for f in (F.min, F.max)]
    total = rows.agg(F.sum("size").alias("size"), F.count("*").alias("rows"), *bounds).first()
    if shards is None:
        shards = max(1, -(-(total["size"] or 0) // target_bytes))
    spans = {d: max(1, (total[f"max_{d}"] or 0) - (total[f"min_{d}"] or 0)) for d in dimensions}

    # Node -> the number of its leaves; children are numbered anew on each level, left before right.
    leaves = {0: shards}
    while any(n > 1 for n in leaves.values()):
        searches = []
        for row in rows.groupBy("node").agg(F.sum("size").alias("size"), *bounds).collect():
            n = leaves[row["node"]]
            if n > 1:
                widths = [(row[f"max_{d}"] - row[f"min_{d}"]) / spans[d] for d in dimensions]
                k = widths.index(max(widths))
                low, high = row[f"min_{dimensions[k]}"], row[f"max_{dimensions[k]}"]
                wanted = row["size"] * (n // 2) / n
                searches.append(Search(row["node"], k, row["size"], n, wanted, low, high))
        _search(rows, dimensions, searches)
        cuts = {s.node: (s.dimension, *s.cut) for s in searches}
        table, below = [], {}
        for node, n in sorted(leaves.items()):
            first = len(below)
            if n > 1:
                below[first], below[first + 1] = n // 2, n - n // 2
                # A node without rows has no cut; its leaves stay empty.
                table.append((node, first, *cuts.get(node, (0, 0, 0, 0))))
            else:
                below[first] = n
                table.append((node, first, 0, TOP, 0, 0))
        leaves = below
        columns = "node int, first int, dim int, c0 long, c1 long, c2 long"
        moves = small_table(rows.sparkSession, table, columns)
        x, t, h = _key_parts(dimensions, F.col("dim"))
        c0, c1, c2 = F.col("c0"), F.col("c1"), F.col("c2")
        left = (x < c0) | ((x == c0) & ((t < c1) | ((t == c1) & (h < c2))))
        moved = rows.join(moves, "node")
        side = F.when(left, F.col("first")).otherwise(F.col("first") + 1).cast("int").alias("node")
        rows = stored(moved.select(*[c for c in rows.columns if c != "node"], side))

    buckets = shards_for(total["rows"], each=ROWS_PER_SLOT_SHARD)
    bucket = F.pmod("id_hash", F.lit(buckets)).cast("int").alias("bucket")
    rows = rows.select("id", "size", "text_crc32", F.col("node").alias("shard"), bucket, "id_hash")
    order = ["id_hash", "id", "text_crc32", "size"]
    placed = running_start(rows, ["shard"], "bucket", order, F.lit(1), "slot")
    return placed.select(F.col("id").alias(id_column), "size", "text_crc32", "shard", "slot")
