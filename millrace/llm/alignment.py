"""Cross-tokenizer alignment: texts are cut where tokens of both vocabularies end.

The intervals of a batch are divided all at once: each looks for a common end near its middle by
bisecting the ends of the other vocabulary, is cut there, and both halves go on; an interval without
a common end inside is a leaf, a group of tokens that only belong together as a whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from millrace.llm.bpe import BYTE_LEVEL_WORDS, byte_of_symbol, small_batches
from millrace.llm.common import stored
from millrace.llm.pieces import Encoded, piece_codec, spans

# Pairs of ids are one number; both vocabularies must have fewer ids than this.
PAIR = 1 << 24
# Text of a batch, whose pairs get one table.
BATCH_BYTES = 4_000_000
SLICE_BYTES = 1_000_000


class TokenBytes(NamedTuple):
    """The bytes of all ids one behind the other."""

    starts: np.ndarray
    sizes: np.ndarray
    flat: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> TokenBytes:
        sizes = np.array([len(t) for t in tokens], np.int64)
        return cls(np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(tokens), np.uint8))

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[spans(self.starts[ids], self.sizes[ids])]


class ByteLevel:
    """Encoder of a byte-level tokenizer file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        splitter, bpe = model["pre_tokenizer"] or {}, model["model"]
        plain = (
            bpe["type"] == "BPE"
            and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space")
            and not model["normalizer"]
            and not bpe.get("ignore_merges")
            and not bpe.get("dropout")
        )
        merged = [a + b for a, b in (m if isinstance(m, list) else m.split(" ") for m in bpe["merges"])]
        numbers = [bpe["vocab"].get(m, -1) for m in merged]
        if not plain or numbers != sorted(numbers) or -1 in numbers:
            raise ValueError("not a plain byte-level tokenizer whose ids follow its merges")
        symbols = byte_of_symbol()
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {bytes(symbols[c] for c in t): k for t, k in bpe["vocab"].items() if t not in special}
        self.encoding = tiktoken.Encoding("own", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        tokens = [b""] * (max(bpe["vocab"].values()) + 1)
        for raw, k in ranks.items():
            tokens[k] = raw
        self.bytes = TokenBytes.of(tokens)

    def encode(self, texts: list[str]) -> Encoded:
        found = [np.array(self.encoding.encode_ordinary(t), np.int64) for t in texts]
        bounds = np.cumsum([0, *map(len, found)])
        return Encoded(np.concatenate(found) if found else np.empty(0, np.int64), bounds)


def divide(ends_a: np.ndarray, ends_b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """First tokens of the groups, in order.

    ``ends_a`` and ``ends_b`` are the ends of the tokens, ascending; the intervals ``starts`` to
    ``stops`` of tokens of the first vocabulary end where a token of the second ends too.
    """
    leaves = [starts[stops - starts == 1]]
    more = stops - starts > 1
    low, high = starts[more], stops[more]
    while len(low):
        # Places inside an interval at which it may be cut: behind its tokens low .. high - 2.
        last = high - 2
        middle = (low + last) // 2
        cut = np.full(len(low), -1, np.int64)
        open_ = np.arange(len(low))
        reach = np.maximum(middle - low, last - middle)
        step = 0
        while len(open_):
            for place in (middle[open_] - step, middle[open_] + step)[: 2 if step else 1]:
                there = np.flatnonzero((place >= low[open_]) & (place <= last[open_]) & (cut[open_] < 0))
                end = ends_a[place[there]]
                met = ends_b[np.searchsorted(ends_b, end)] == end
                cut[open_[there[met]]] = place[there[met]]
            step += 1
            open_ = open_[(cut[open_] < 0) & (reach[open_] >= step)]
        whole = cut < 0
        leaves.append(low[whole])
        low, high, cut = low[~whole], high[~whole], cut[~whole] + 1
        low, high = np.stack([low, cut], 1).ravel(), np.stack([cut, high], 1).ravel()
        single = high - low == 1
        leaves.append(low[single])
        low, high = low[~single], high[~single]
    return np.sort(np.concatenate(leaves))


class Alignment(NamedTuple):
    """Of all texts of a batch one behind the other; ``a`` and ``b`` without the texts that have no
    tokens. ``group_a`` and ``group_b`` are the first tokens of the groups."""

    a: Encoded
    b: Encoded
    group_a: np.ndarray
    group_b: np.ndarray
    group_bounds: np.ndarray
    pairs: np.ndarray
    pair_bounds: np.ndarray


class Aligner:
    def __init__(self, vocabulary: str, model: str):
        self.first = ByteLevel(vocabulary)
        self.second = piece_codec(model)
        self.bytes_b = TokenBytes.of(self.second.bytes_of)
        if max(len(self.first.bytes.sizes), len(self.bytes_b.sizes)) >= PAIR:
            raise ValueError("vocabularies are too large")
        # The text of an id with each sign that may follow it.
        self.said_a = [f"{k}{sign}" for sign in ",|" for k in range(len(self.first.bytes.sizes))]
        self.said_b = [f"{k}{sign}" for sign in (",", ";", "") for k in range(len(self.bytes_b.sizes))]

    @staticmethod
    def _same(table: TokenBytes, coded: Encoded, raw: list[bytes]) -> np.ndarray:
        """Of each text whether its tokens' bytes are its own."""
        joined = table.joined(coded.ids)
        sizes = np.concatenate(([0], np.cumsum(table.sizes[coded.ids])))[coded.bounds]
        wanted = np.fromiter(map(len, raw), np.int64, len(raw))
        same = np.diff(sizes) == wanted
        if same.all() and (joined == np.frombuffer(b"".join(raw), np.uint8)).all():
            return same
        places = sizes.tolist()
        return np.array([joined[i:j].tobytes() == r for i, j, r in zip(places, places[1:], raw)], bool)

    def align(self, texts: list[str | None]) -> Alignment:
        """Texts that are null, empty, or not equal to what their tokens stand for have no tokens."""
        # The second vocabulary puts a space before each text by itself.
        spaced = [f" {t}" if t else "" for t in texts]
        raw = [t.encode() for t in spaced]
        a, b = self.first.encode(spaced), self.second.encode(texts)
        table = self.first.bytes
        good = self._same(table, a, raw) & self._same(self.bytes_b, b, raw)
        if not good.all():
            a, b = _kept(a, good), _kept(b, good)
        # Both run over the same bytes, so their ends can be compared over the whole batch.
        ends_a, ends_b = np.cumsum(table.sizes[a.ids]), np.cumsum(self.bytes_b.sizes[b.ids])
        filled = np.flatnonzero(np.diff(a.bounds) > 0)
        group_a = divide(ends_a, ends_b, a.bounds[filled], a.bounds[filled + 1])
        before = ends_a[group_a] - table.sizes[a.ids[group_a]]
        group_b = np.searchsorted(ends_b, before, side="right")
        starts = ends_a - table.sizes[a.ids]
        low = np.searchsorted(ends_b, starts, side="right")
        count = np.searchsorted(ends_b, ends_a) + 1 - low
        pairs = np.repeat(a.ids * PAIR, count) + b.ids[spans(low, count)]
        pair_bounds = np.concatenate(([0], np.cumsum(count)))[a.bounds]
        return Alignment(a, b, group_a, group_b, np.searchsorted(group_a, a.bounds), pairs, pair_bounds)

    def written(self, found: Alignment) -> list[str]:
        """Groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        a, b = found.a, found.b
        if not len(a.ids):
            return [""] * (len(a.bounds) - 1)
        code_a, code_b = a.ids.copy(), b.ids.astype(np.int64)
        next_a, next_b = np.append(found.group_a[1:], len(a.ids)), np.append(found.group_b[1:], len(b.ids))
        code_a[next_a - 1] += len(self.first.bytes.sizes)
        code_b[next_b - 1] += len(self.bytes_b.sizes)
        filled = np.diff(b.bounds) > 0
        code_b[b.bounds[1:][filled] - 1] += len(self.bytes_b.sizes)
        # Tokens of the two by turns, group after group.
        group_of_a = np.repeat(np.arange(len(next_a)), next_a - found.group_a)
        group_of_b = np.repeat(np.arange(len(next_b)), next_b - found.group_b)
        mixed = np.empty(len(code_a) + len(code_b), np.int64)
        mixed[np.arange(len(code_a)) + found.group_b[group_of_a]] = code_a
        mixed[np.arange(len(code_b)) + next_a[group_of_b]] = code_b + len(self.said_a)
        said = self.said_a + self.said_b
        words = [*map(said.__getitem__, mixed.tolist())]
        ends = (a.bounds + b.bounds).tolist()
        return ["".join(words[i:j]) for i, j in zip(ends, ends[1:])]


def _kept(coded: Encoded, good: np.ndarray) -> Encoded:
    """``coded`` without the tokens of texts that are not ``good``."""
    sizes = np.diff(coded.bounds)
    stay = np.repeat(good, sizes)
    return Encoded(coded.ids[stay], np.concatenate(([0], np.cumsum(np.where(good, sizes, 0)))))


@lru_cache(maxsize=1)
def aligner(vocabulary: str, model: str) -> Aligner:
    return Aligner(vocabulary, model)


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def align_documents(
    docs: DataFrame, vocabulary: str, model: str, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The tokens of each whole text under two vocabularies, in groups that end together.

    ``vocabulary`` is a byte-level tokenizer file, which encodes a space and the text; ``model`` is a
    SentencePiece model, which puts that space before the text by itself. Where a token of both ends
    at the same byte, the text is cut into groups.

    A row per document has its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links`` (pairs of token
    occurrences that share bytes) and ``groups``, the ids of all groups as ``a1,a2|b1;a3|b2,b3``.
    ``batch``, ``links`` and ``times`` say which pairs of ids it links, by their place in the table of
    its batch, and how often. Each batch has one more row, without a document: ``pairs`` and
    ``pair_counts`` are that table. :func:`link_statistics` takes both kinds of rows.

    Defined cases: texts that are null, empty, or not equal to what the tokens of either vocabulary
    stand for (one with U+2581, which a model reads as a space) have no tokens, and zeros; very long
    texts are aligned whole, as a batch of their own; repeated rows and null ids are documents of
    their own; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    schema = StructType(
        [
            StructField("id", rows.schema["id"].dataType),
            *[StructField(name, LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")],
            StructField("groups", StringType()),
            StructField("batch", LongType()),
            StructField("links", ArrayType(IntegerType(), False)),
            StructField("times", ArrayType(IntegerType(), False)),
            StructField("pairs", ArrayType(LongType(), False)),
            StructField("pair_counts", ArrayType(LongType(), False)),
        ]
    )

    def one_batch(number: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        own = aligner(vocabulary, model)
        parts, held = [], []
        for part in small_batches(batch, "text", SLICE_BYTES):
            found = own.align(part.column(1).to_pylist())
            sizes = [np.diff(x) for x in (found.a.bounds, found.b.bounds, found.group_bounds, found.pair_bounds)]
            # Distinct pairs of each text, and how often it has them.
            text = np.repeat(np.arange(part.num_rows), sizes[3])
            order = np.lexsort((found.pairs, text))
            pairs, text = found.pairs[order], text[order]
            first = np.flatnonzero(np.concatenate(([True], (pairs[1:] != pairs[:-1]) | (text[1:] != text[:-1])))[: len(pairs)])
            times = np.diff(np.append(first, len(pairs)))
            bounds = np.searchsorted(text[first], np.arange(part.num_rows + 1))
            parts.append((part.column(0), sizes, pa.array(own.written(found), pa.string()), bounds, times))
            held.append(pairs[first])
        table, place = np.unique(np.concatenate(held), return_inverse=True)
        counts = np.zeros(len(table), np.int64)
        start = 0
        for ids, sizes, groups, bounds, times in parts:
            links = place[start : start + len(times)]
            start += len(times)
            counts += np.bincount(links, times, len(table)).astype(np.int64)
            none = pa.nulls(len(ids), pa.list_(pa.int64()))
            numbers = pa.array(np.full(len(ids), number, np.int64))
            columns = [ids, *map(pa.array, sizes), groups, numbers]
            columns += [_lists(links, bounds, pa.int32()), _lists(times, bounds, pa.int32()), none, none]
            yield pa.RecordBatch.from_arrays(columns, schema.names)
        last = [pa.nulls(1, batch.column(0).type), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string())]
        last += [pa.array([number]), *[pa.nulls(1, pa.list_(pa.int32()))] * 2]
        whole = np.array([0, len(table)])
        last += [_lists(table, whole, pa.int64()), _lists(counts, whole, pa.int64())]
        yield pa.RecordBatch.from_arrays(last, schema.names)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in small_batches(whole, "text", BATCH_BYTES):
                yield from one_batch(number, batch)
                number += 1

    return rows.mapInArrow(align, schema)


def link_statistics(aligned: DataFrame) -> DataFrame:
    """Documents of ``aligned`` (as from :func:`align_documents`) with ``n_best`` and ``count_sum``.

    The count of a pair of ids is how many links of all documents hold it. ``n_best`` are the links
    of a document whose count is the highest of all with their id of the second vocabulary, ties
    included; ``count_sum`` adds the counts of its links. The columns of :func:`align_documents` that
    this needs go, all others stay.

    ``aligned`` is written once. Each batch has its pairs in one table, so that what is summed and
    joined is a row per pair and batch, not one per link; a frequent pair has as many rows as there
    are batches, which the join can split. Counts come back to their batch and meet its documents,
    in groups as large as one batch.
    """
    rows = stored(aligned)
    tables = rows.where("pairs IS NOT NULL").select("batch", F.posexplode(F.arrays_zip("pairs", "pair_counts")).alias("place", "x"))
    tables = tables.select("batch", "place", F.col("x.pairs").alias("pair"), F.col("x.pair_counts").alias("n"))
    counts = stored(tables.groupBy("pair").agg(F.sum("n").alias("total")))
    second = F.col("pair") % PAIR
    best = counts.groupBy(second.alias("second")).agg(F.max("total").alias("most"))
    judged = counts.withColumn("second", second).join(best, "second")
    judged = judged.select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    replies = tables.join(judged, "pair").select(F.col("batch").alias("of_batch"), "place", "total", "best")

    used = ("batch", "links", "times", "pairs", "pair_counts")
    kept = [f for f in rows.schema.fields if f.name not in used]
    schema = StructType([*kept, StructField("n_best", LongType()), StructField("count_sum", LongType())])
    names = [f.name for f in kept]

    def score(documents: pa.Table, reply: pa.Table) -> pa.Table:
        documents, reply = documents.combine_chunks(), reply.combine_chunks()
        size = reply.num_rows
        total, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        place = reply.column("place").to_numpy()
        total[place] = reply.column("total").to_numpy()
        best[place] = reply.column("best").cast(pa.int64()).to_numpy()
        links = documents.column("links").combine_chunks()
        flat = links.flatten().to_numpy()
        times = documents.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        ends = np.cumsum([0, *links.value_lengths().to_pylist()])
        sums = [np.concatenate(([0], np.cumsum(values[flat] * times))) for values in (best, total)]
        new = [pa.array(np.diff(s[ends])) for s in sums]
        return pa.Table.from_arrays([*documents.select(names).columns, *new], schema.names)

    documents = rows.where("pairs IS NULL").select(*names, "batch", "links", "times")
    return documents.groupBy("batch").cogroup(replies.groupBy("of_batch")).applyInArrow(score, schema)
