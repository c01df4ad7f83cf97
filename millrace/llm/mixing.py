"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.bpe import small_batches
from millrace.llm.common import WORDS, bound_batches, count_words, frugal, shards_for, small_table, stored

BLOCK_WORDS = 64
DOCS_PER_SHARD = 256


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what is above is shared
    again by weight among the others until none is above."""
    caps = [most * s for s in sizes]
    order = sorted(range(len(sizes)), key=lambda j: caps[j] / weights[j])
    out = [0.0] * len(sizes)
    left, weight = float(total), float(sum(weights))
    for j in order:
        share = left * weights[j] / weight if weight > 0 else 0.0
        out[j] = min(caps[j], share)
        left -= out[j]
        weight -= weights[j]
    return out


def sainte_lague(seats: int, weights: Sequence[float], caps: Sequence[int]) -> np.ndarray:
    """Seats by highest quotients ``weight / (2 * k + 1)``, the first of equals first; at most
    ``caps`` each.

    All seats but one per party at most are given by the divisor of the last quotient at once; a heap
    gives the rest one by one.
    """
    weights = np.asarray(weights, float)
    caps = np.where(weights > 0, np.asarray(caps, np.int64), 0)
    seats = int(min(seats, caps.sum()))
    if seats <= 0:
        return np.zeros(len(weights), np.int64)

    def given(divisor: float) -> np.ndarray:
        """Seats whose quotient is above the divisor."""
        return np.minimum(caps, np.floor(weights / (2 * divisor) + 0.5).astype(np.int64))

    high, low = weights.max() * 2, weights.max()
    while given(low).sum() < seats and low > 0:
        low /= 2
    for _ in range(80):
        middle = (high + low) / 2
        if given(middle).sum() > seats:
            low = middle
        else:
            high = middle
    out = given(high)
    heap = [(-w / (2 * k + 1), j) for j, (w, k) in enumerate(zip(weights, out)) if k < caps[j]]
    heapq.heapify(heap)
    for _ in range(seats - int(out.sum())):
        _, j = heapq.heappop(heap)
        out[j] += 1
        if out[j] < caps[j]:
            heapq.heappush(heap, (-weights[j] / (2 * out[j] + 1), j))
    return out


def by_code_point(name: str | None) -> tuple[bool, bytes]:
    """Order of sources: by code point, null last."""
    return name is None, (name or "").encode()


def mix(
    docs: DataFrame,
    weights: Callable[[list[str | None]], Sequence[float]],
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = BLOCK_WORDS,
    seed: int = 11,
) -> DataFrame:
    """What a mix takes of each document.

    Returns id, ``size`` (words), ``source_size``, ``target``, ``taken``, and what ``cut_texts``
    needs: ``start`` (words before it in its source's shard), ``blocks``, ``quota`` and ``turn`` of
    that shard, and ``digest`` of the text. ``weights`` gives a weight for each source in the order given to it (by code point,
    null last).

    The words of all documents times ``share`` are shared among the sources by weight; none gets
    more than ``most`` times its words. Documents lie in hash shards, in seeded order, and each
    source's words in a shard are cut into blocks of ``block_words``, the last one shorter. Blocks
    are apportioned to sources by highest quotients (Sainte-Laguë), then each source's blocks to its
    shards likewise, which gives an integer quota for every source and shard. A quota takes its
    blocks evenly spaced from a seeded start, each ``quota div blocks`` times or once more. So no
    word is taken more than ``ceil(most)`` times, and what a document gives follows from sums alone.

    The driver sees one row per source; ``mix`` is meant for named sources, which are few. Defined
    cases: null texts have size 0 and take 0; a null source is a source; repeated rows are documents
    of their own; an empty table gives no rows. Ties between equal quotients go to the source that
    comes first, and to the lower shard.
    """
    rows = docs.select(
        docs[id_column].alias("id"),
        docs[source_column].alias("source"),
        count_words(docs[text_column]).alias("size"),
        _digest(docs[text_column]).alias("digest"),
    )
    rows = stored(rows)
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).collect()
    totals.sort(key=lambda r: by_code_point(r["source"]))
    sizes = [r["size"] for r in totals]
    names = [r["source"] for r in totals]
    targets = water_fill(sizes, list(weights(names)), share * sum(sizes), most) if sum(sizes) else [0.0] * len(sizes)
    shards = shards_for(sum(r["docs"] for r in totals), each=DOCS_PER_SHARD)

    spark = docs.sparkSession
    table = [
        (j, name, size, target) for j, (name, size, target) in enumerate(zip(names, sizes, targets))
    ]
    sources = small_table(spark, table, "number int, name string, source_size long, target double")
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("name")))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(shards)).cast("int"))
    rows = rows.withColumn("order", F.xxhash64("id", F.lit(seed + 1)))

    pairs = rows.groupBy("number", "shard").agg(F.sum("size").alias("words"))
    pairs = stored(pairs.withColumn("blocks", F.ceil(F.col("words") / block_words)).where("words > 0"))
    counts = {r["number"]: r["n"] for r in pairs.groupBy("number").agg(F.sum("blocks").alias("n")).collect()}
    blocks = [counts.get(j, 0) for j in range(len(names))]
    # Targets in blocks: a source's blocks hold fewer words than block_words where some are short.
    wanted = [t * b / s if s else 0.0 for t, b, s in zip(targets, blocks, sizes)]
    seats = sainte_lague(round(sum(wanted)), wanted, [int(most * b) for b in blocks])
    quotas = small_table(spark, [(j, int(q)) for j, q in enumerate(seats)], "number int, seats long")
    schema = StructType([*pairs.schema.fields, StructField("quota", LongType())])

    def apportion(frame: pd.DataFrame) -> pd.DataFrame:
        """The quotas of one source's shards, of which there are 65,536 at most."""
        frame = frame.sort_values("shard")
        caps = np.floor(most * frame["blocks"].to_numpy()).astype(np.int64)
        frame["quota"] = sainte_lague(int(frame["seats"].iloc[0]), frame["words"].to_numpy(), caps)
        return frame[schema.fieldNames()]

    quotas = pairs.join(quotas, "number").groupBy("number").applyInPandas(apportion, schema)
    quotas = stored(quotas)

    inner = Window.partitionBy("number", "shard").orderBy("order", "id", "size", "digest")
    before = F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("start", F.coalesce(before, F.lit(0)))
    quotas = quotas.select("number", "shard", "blocks", "quota")
    placed = placed.join(quotas, ["number", "shard"], "left")
    turn = F.pmod(F.xxhash64("number", "shard", F.lit(seed + 2)), F.col("blocks"))
    placed = placed.withColumn("turn", turn)
    taken = _taken_before(F.col("start") + F.col("size"), block_words) - _taken_before(
        F.col("start"), block_words
    )
    return placed.select(
        F.col("id").alias(id_column),
        "size",
        "source_size",
        "target",
        F.coalesce(taken, F.lit(0)).cast("long").alias("taken"),
        "start",
        "blocks",
        "quota",
        "turn",
        "digest",
    )


def _digest(text: Column) -> Column:
    """What tells the texts of rows with one id apart; null for null."""
    return F.unhex(F.sha2(text, 256))


def _times_before(block: Column) -> Column:
    """How many blocks the first ``block`` blocks of a shard give, repeats counted."""
    return F.expr("1L") * F.floor((block * F.col("quota") + F.col("turn")) / F.col("blocks"))


def _taken_before(position: Column, block_words: int) -> Column:
    """How many words are taken of those before a position in the shard."""
    block = F.floor(position / block_words)
    whole, more = _times_before(block), _times_before(block + 1)
    return block_words * whole + (position % block_words) * (more - whole)


def cut_texts(
    docs: DataFrame,
    mixed: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` as the mix takes them: a row for each turn in which a document gives words.

    The text of a row is made of the blocks taken in that turn, with the white space between their
    words; a document taken whole once keeps its text as it is. Documents that give nothing go.
    Other columns stay. Rows that share an id, or have none, are told apart by their texts; those
    that repeat both are cut alike, by the span that starts first among those that give words.
    """
    fields = ("start", "size", "blocks", "quota", "turn")
    keys = (F.col(id_column).alias("_mix_id"), F.col("digest").alias("_mix_digest"))
    spans = mixed.where("taken > 0").groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_span"))
    spans = stored(spans.select("_mix_id", "_mix_digest", *[F.col(f"_span.{c}").alias(f"_mix_{c}") for c in fields]))
    # The join is by text too, as a span fits no other text than the one it was counted on.
    same = docs[id_column].eqNullSafe(spans["_mix_id"]) & (_digest(docs[text_column]) == spans["_mix_digest"])
    joined = docs.join(spans, same)

    bound_batches(docs.sparkSession)
    names = [f"_mix_{c}" for c in fields]
    joined = joined.select(*[docs[c] for c in docs.columns], *[spans[c] for c in names])
    columns_out = docs.columns
    at, width = columns_out.index(text_column), len(columns_out)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, text_column, 1_000_000):
                numbers = zip(*[batch.column(width + k).to_pylist() for k in range(len(fields))])
                turns = [cut_text(t, *n, block_words) for t, n in zip(batch.column(at).to_pylist(), numbers)]
                taken = pa.array(np.repeat(np.arange(batch.num_rows), [len(t) for t in turns]))
                columns = [batch.column(k).take(taken) for k in range(width)]
                columns[at] = pa.array([text for own in turns for text in own], pa.string())
                yield pa.RecordBatch.from_arrays(columns, columns_out)

    return joined.mapInArrow(frugal(cut), docs.schema)


def cut_text(
    text: str, start: int, size: int, blocks: int, quota: int, turn: int, block_words: int
) -> list[str]:
    """The text of each turn in which a document gives words."""
    first, last = start // block_words, (start + size - 1) // block_words
    edges = (np.arange(first, last + 2, dtype=object) * quota + turn) // blocks
    times = np.diff(edges).astype(np.int64)
    if len(times) == 0 or times.max() == 0:
        return []
    offsets = [m.start() for m in WORDS.finditer(text)] + [len(text)]
    out = []
    for k in range(int(times.max())):
        picked = times > k
        if picked.all():
            out.append(text)
            continue
        parts = []
        for b in np.flatnonzero(picked):
            low = max(start, (first + int(b)) * block_words) - start
            high = min(start + size, (first + int(b) + 1) * block_words) - start
            parts.append(text[offsets[low] : offsets[high]])
        # Blocks that do not follow each other are kept apart by a line break.
        out.append("".join(p if p[-1:].isspace() or i + 1 == len(parts) else p + "\n" for i, p in enumerate(parts)))
    return out
