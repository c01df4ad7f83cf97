"""Language-model scores by deleted interpolation of word n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from millrace.llm.bpe import small_batches
from millrace.llm.common import stored
from millrace.llm.minhash import _mix

BATCH_BYTES = 8_000_000
TOKENS_PER_BUCKET = 2_000_000
MOST_BUCKETS = 512
# So many batches at most send their keys to one group of a bucket; the groups then ask as batches do.
TEAM = 1024
# From here on 32 bits of a word's hash say in which bucket it is, below it 16.
MANY_BUCKETS = 1 << 14
# Parts of the corpus: counts come from MAIN, mixture weights from DELETED; OTHER is only scored.
# What a team of batches asks for them together is TEAMED.
MAIN, DELETED, OTHER, TEAMED = 0, 1, 2, 3
END = np.uint64(0x1F83D9ABFB41BD6B)
# Contexts are put together by the power of two of their count.
CONTEXT_CLASSES = 40
# Probabilities are told apart by steps of 0.2 of their decimal logarithm, for the weights only.
STEP, BINS = 0.2, 64


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers in the least bytes that hold them, compressed."""
    most = int(values.max()) if len(values) else 0
    kind = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + pa.Codec("zstd").compress(values.astype(kind).tobytes(), asbytes=True)


def _unpack(data: bytes, count: int) -> np.ndarray:
    size = data[0]
    raw = pa.Codec("zstd").decompress(data[1:], count * size, asbytes=True) if count else b""
    return np.frombuffer(raw, f"u{size}").astype(np.int64)


class Batch(NamedTuple):
    """Documents of one part, as numbers of the batch's own words; number 0 is the end token."""

    hashes: np.ndarray  # of the words
    tokens: np.ndarray  # each document's words and the end token
    lengths: np.ndarray  # tokens per document

    def before(self) -> np.ndarray:
        """The token before each token; the end token before the first of a document."""
        out = np.empty_like(self.tokens)
        out[1:] = self.tokens[:-1]
        out[0] = 0
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs as first and second word, the pair of each token, and the pairs' counts."""
        size = np.int64(len(self.hashes))
        codes = self.before().astype(np.int64) * size + self.tokens
        values, which, counts = np.unique(codes, return_inverse=True, return_counts=True)
        return values // size, values % size, which, counts


def _word_bucket(short: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(short) % np.uint64(buckets)).astype(np.int64)


def _pair_bucket(first: np.ndarray, second: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(_mix(first) + second) % np.uint64(buckets)).astype(np.int64)


def _short_type(buckets: int) -> type:
    return np.uint16 if buckets < MANY_BUCKETS else np.uint32


def _short(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bits of a word's hash that say in which bucket it is."""
    return hashes >> np.uint64(64 - 8 * np.dtype(_short_type(buckets)).itemsize)


class Numbered:
    """Documents of one part on their way to be a batch."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.tokens: list[np.ndarray] = []
        self.ids: list = []
        self.held_out: list[bool] = []
        self.size = 0

    def add(self, id_: object, text: str, held_out: bool) -> None:
        raw = text.encode().lower()
        words = raw.split()
        tokens = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
        self.tokens.append(np.array([*tokens, 0], np.uint32))
        self.ids.append(id_)
        self.held_out.append(held_out)
        self.size += len(raw) + 1

    def row(self, number: int, part: int) -> dict:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.numbers), np.uint64, len(self.numbers))
        tokens = np.concatenate(self.tokens)
        return {
            "batch": number,
            "part": part,
            "ids": self.ids,
            "held_out": self.held_out,
            "lengths": [len(t) for t in self.tokens],
            "hashes": np.append(END, hashes).tobytes(),
            "n_tokens": len(tokens),
            "tokens": _pack(tokens),
        }


def _forward(rows: DataFrame) -> DataFrame:
    """Batches of documents ``id, text, part, held_out`` as numbers: one row per batch and part."""
    schema = StructType(
        [
            StructField("batch", LongType()),
            StructField("part", IntegerType()),
            StructField("ids", ArrayType(rows.schema["id"].dataType)),
            StructField("held_out", ArrayType(BooleanType())),
            StructField("lengths", ArrayType(IntegerType())),
            StructField("hashes", BinaryType()),
            StructField("n_tokens", LongType()),
            StructField("tokens", BinaryType()),
        ]
    )

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_: dict[int, Numbered] = {}
        for whole in batches:
            for batch in small_batches(whole, "text", BATCH_BYTES):
                for id_, text, part, held_out in zip(*(c.to_pylist() for c in batch.columns)):
                    own = open_.setdefault(part, Numbered())
                    own.add(id_, text, held_out)
                    if own.size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist([own.row(number, part)], schema=arrow)
                        number += 1
                        del open_[part]
        for part, own in open_.items():
            yield pa.RecordBatch.from_pylist([own.row(number, part)], schema=arrow)
            number += 1

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(forward, schema)


def _batch_of(row: dict, hashes: np.ndarray) -> Batch:
    return Batch(hashes, _unpack(row["tokens"], row["n_tokens"]), np.array(row["lengths"], np.int64))


ASKED = "bucket long, batch long, part int, n long, keys binary, main binary, train binary"
TOLD = "batch long, bucket long, n long, total long, main binary, train binary"
# What a group of batches asks for as one, by part of its bucket, and where its batches find their keys.
MERGED = "bucket long, team long, sub int, batch long, part int, n long, keys binary, main binary, train binary, which binary"
# Rows of a bucket's own sums stand under these numbers in place of a batch.
MAIN_SUMS, TRAIN_SUMS = -1, -2


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(", "))])


def _ask(forward: DataFrame, buckets: int, pairs: bool) -> DataFrame:
    """Keys and counts of each batch's distinct words, or pairs of words, by bucket.

    No ``main`` means 0; no ``train`` means what ``main`` says.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for many in batches:
            for row in many.to_pylist():
                hashes = np.frombuffer(row["hashes"], np.uint64)
                batch = _batch_of(row, hashes)
                short = _short(hashes, buckets)
                if pairs:
                    first, second, _, counts = batch.pairs()
                    keys = _mix(_mix(hashes[first]) + hashes[second])
                    bucket = _pair_bucket(short[first], short[second], buckets)
                else:
                    keys = hashes
                    counts = np.bincount(batch.tokens, minlength=len(hashes))
                    bucket = _word_bucket(short, buckets)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                out = []
                for b in np.flatnonzero(np.diff(edges)):
                    picked = order[edges[b] : edges[b + 1]]
                    packed = _pack(counts[picked])
                    out.append(
                        {
                            "bucket": int(b),
                            "batch": row["batch"],
                            "part": row["part"],
                            "n": len(picked),
                            "keys": keys[picked].tobytes(),
                            "main": packed if row["part"] == MAIN else None,
                            "train": packed if row["part"] == DELETED else None,
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=asked)

    asked = _arrow(ASKED)
    return forward.mapInArrow(ask, ASKED)


def _summed(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of what was asked, which of them each entry is, their counts, and where rows begin."""
    sizes = [r["n"] for r in rows]
    keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
    values, which = np.unique(keys, return_inverse=True)
    edges = np.cumsum([0, *sizes])
    main, train = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
    for k, r in enumerate(rows):
        # A batch has each of its keys once.
        own = which[edges[k] : edges[k + 1]]
        if r["main"] is not None:
            main[own] += _unpack(r["main"], r["n"])
        if r["train"] is not None or r["main"] is not None:
            train[own] += _unpack(r["train"] or r["main"], r["n"])
    return values, which, main, train, edges


def _answer(row: dict, main: np.ndarray, train: np.ndarray) -> dict:
    wanted = row["part"] in (DELETED, TEAMED)
    return {
        "batch": row["batch"],
        "bucket": row["bucket"],
        "n": row["n"],
        "main": _pack(main) if wanted else None,
        "train": _pack(train),
    }


def _tell(asked: DataFrame) -> DataFrame:
    """The counts of all batches for each batch's keys, in the order of its keys.

    A bucket holds each key of a batch once, so a frequent word is as many entries as there are
    batches, not tokens. Two more rows per bucket have the number ``n`` of distinct keys and the
    ``total`` of counts, of MAIN, and of MAIN and DELETED together.
    """

    def tell(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        _, which, main, train, edges = _summed(rows)
        out = []
        for k, r in enumerate(rows):
            own = which[edges[k] : edges[k + 1]]
            out.append(_answer(r, main[own], train[own]))
        for number, sums in ((MAIN_SUMS, main), (TRAIN_SUMS, train)):
            out.append({"batch": number, "bucket": rows[0]["bucket"], "n": int((sums > 0).sum()), "total": int(sums.sum())})
        return pa.Table.from_pylist(out, schema=told)

    told = _arrow(TOLD)
    return asked.groupBy("bucket").applyInArrow(tell, TOLD)


def _tell_all(asked: DataFrame, batches: int, level: int = 1) -> DataFrame:
    """What ``_tell`` says, whatever the number of batches: no task sees more than about TEAM of them.

    Where more batches ask a bucket, they form teams. A team adds up the counts of its batches, so
    that a key of all of them is one entry; it then asks parts of the bucket, as a batch asks buckets.
    What it is told it hands on to its batches. Teams of teams follow until one group has the rest.
    """
    if batches <= TEAM:
        return _tell(asked)
    teams = -(-batches // TEAM)
    # As many parts as teams that may meet there: a group stays as large as a team's keys.
    width = min(TEAM, teams)
    salt = np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        values, which, main, train, edges = _summed(rows)
        at = {"bucket": rows[0]["bucket"], "team": rows[0]["team"]}
        sub = (_mix(values ^ salt) % np.uint64(width)).astype(np.int64)
        order = np.argsort(sub, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        ends = np.searchsorted(sub[order], np.arange(width + 1))
        out = []
        for b in np.flatnonzero(np.diff(ends)):
            own = order[ends[b] : ends[b + 1]]
            sums = {"main": _pack(main[own]), "train": _pack(train[own])}
            out.append({**at, "sub": int(b), "n": len(own), "keys": values[own].tobytes(), **sums})
        for k, r in enumerate(rows):
            own = place[which[edges[k] : edges[k + 1]]]
            out.append({**at, "batch": r["batch"], "part": r["part"], "n": r["n"], "which": _pack(own)})
        return pa.Table.from_pylist(out, schema=merged)

    def hand_on(members: pa.Table, answers: pa.Table) -> pa.Table:
        found = sorted(answers.to_pylist(), key=lambda r: r["part_of"])
        main, train = (np.concatenate([_unpack(r[c], r["n"]) for r in found]) for c in ("main", "train"))
        out = []
        for r in members.to_pylist():
            own = _unpack(r["which"], r["n"])
            out.append(_answer(r, main[own], train[own]))
        return pa.Table.from_pylist(out, schema=told)

    merged, told = _arrow(MERGED), _arrow(TOLD)
    team = F.pmod(F.xxhash64("batch", F.lit(level)), F.lit(teams)).alias("team")
    sums = stored(asked.select("*", team).groupBy("bucket", "team").applyInArrow(merge, MERGED))
    next_asked = sums.where("sub IS NOT NULL").select(
        (F.col("bucket") * width + F.col("sub")).alias("bucket"),
        F.col("team").alias("batch"),
        F.lit(TEAMED).alias("part"),
        *("n", "keys", "main", "train"),
    )
    next_told = stored(_tell_all(next_asked, teams, level + 1))
    answers = next_told.where("batch >= 0").select(
        F.expr(f"bucket DIV {width}").alias("bucket"),
        F.col("batch").alias("team"),
        F.col("bucket").alias("part_of"),
        *("n", "main", "train"),
    )
    members = sums.where("sub IS NULL").select("bucket", "team", "batch", "part", "n", "which")
    by_team = lambda df: df.groupBy("bucket", "team")
    handed = by_team(members).cogroup(by_team(answers)).applyInArrow(hand_on, TOLD)
    return handed.unionByName(next_told.where("batch < 0"))


class Totals(NamedTuple):
    """Distinct tokens and all tokens, of MAIN and of all training documents."""

    main_distinct: int
    main_tokens: int
    distinct: int
    tokens: int


def _gathered(told: list[dict], order: np.ndarray, buckets: np.ndarray, column: str) -> np.ndarray:
    """Counts of a batch's keys, out of the answers of the buckets."""
    out = np.zeros(len(buckets), np.int64)
    answers = sorted(told, key=lambda r: r["bucket"])
    if answers:
        out[order] = np.concatenate([_unpack(r[column], r["n"]) for r in answers])
    return out


def _components(row: dict, words: list[dict], pairs: list[dict], buckets: int, column: str):
    """Of each token: counts of the pair, of the token before, and of the token; and the batch."""
    short = np.frombuffer(row["short"], _short_type(buckets)).astype(np.uint64)
    batch = _batch_of(row, short)
    bucket = _word_bucket(short, buckets)
    counts = _gathered(words, np.argsort(bucket, kind="stable"), bucket, column)
    first, second, which, _ = batch.pairs()
    bucket = _pair_bucket(short[first], short[second], buckets)
    pair_counts = _gathered(pairs, np.argsort(bucket, kind="stable"), bucket, column)
    return pair_counts[which], counts[batch.before()], counts[batch.tokens], batch


def _context_class(counts: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else 1 and the power of two of the count."""
    found = np.zeros(len(counts), np.int64)
    seen = counts > 0
    found[seen] = np.minimum(1 + np.log2(counts[seen]).astype(np.int64), CONTEXT_CLASSES - 1)
    return found


def _bin(p: np.ndarray) -> np.ndarray:
    """0 for probability 0, else a step of its logarithm."""
    found = np.zeros(len(p), np.int64)
    some = p > 0
    found[some] = np.clip(1 + np.floor(-np.log10(p[some]) / STEP), 1, BINS - 1).astype(np.int64)
    return found


def fit_weights(codes: np.ndarray, counts: np.ndarray, floor: float, *, rounds: int = 200) -> np.ndarray:
    """Mixture weights of pair, word and uniform probability for each context class.

    Expectation-maximisation on held-out tokens, counted by context class and by the bins of both
    probabilities; ``floor`` is the uniform one. A context never seen has no pair probability.
    """
    middle = np.append(0.0, 10 ** (-(np.arange(BINS - 1) + 0.5) * STEP))
    context, two, one = codes // (BINS * BINS), codes // BINS % BINS, codes % BINS
    p = np.stack([middle[two], middle[one], np.full(len(codes), floor)])
    weights = np.tile([[0.4], [0.5], [0.1]], (1, CONTEXT_CLASSES))
    weights[:, 0] = 0.0, 0.9, 0.1
    start = weights
    for _ in range(rounds):
        joint = weights[:, context] * p
        share = joint / joint.sum(axis=0) * counts
        # One token's worth of the start keeps classes without tokens, and weights above 0.
        sums = start + np.stack([np.bincount(context, s, CONTEXT_CLASSES) for s in share])
        new = sums / sums.sum(axis=0)
        done = np.abs(new - weights).max() < 1e-7
        weights = new
        if done:
            break
    return weights


def score_language(
    docs: DataFrame,
    learn: Column,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    deleted: int = 10,
) -> DataFrame:
    """Log10 probabilities of every whole text under an interpolated word-pair model.

    Returns id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (words
    alone, each count with 0.5 added) and ``score``. Words are lower-cased in A-Z; a text is its words
    and an end token, and the end token also stands before its first word. Documents for which
    ``learn`` holds are learned from; null counts as not.

    The probability of a token is ``l2 * c(before, token) / c(before) + l1 * c(token) / N + l0 /
    (V + 1)``. The three weights are those of the class of ``c(before)``, its power of two. They are
    learned by expectation-maximisation on every ``deleted``-th learning document, by hash of its id,
    against counts from the others; the model then counts all learning documents.

    Batches of documents become numbers once. Each batch then asks for the counts of its distinct
    words and pairs, by the bucket of their 64-bit hashes, and every bucket answers each batch: what is
    shuffled are distinct keys of batches and counts, no token more than once per batch, and the text
    never. A word or pair of a third of all tokens is one entry per batch, and where there are more
    than TEAM batches, teams of them ask as one, level by level: a task sees about TEAM rows of a bucket
    and some two million keys, however large the corpus is and however many batches share a key. The
    driver sees four sums and the held-out tokens by bins, of which there are at most ``40 * 64 * 64``.

    Defined cases: null and empty texts are the end token alone; without learning documents all
    counts are 0 and a token has probability 1; repeated rows count as often as they come; an empty
    table gives no rows; other columns are ignored.
    """
    learned = F.coalesce(learn, F.lit(False))
    split = F.pmod(F.xxhash64(docs[id_column], F.lit(17)), F.lit(deleted)) == 0
    part = F.when(~learned, OTHER).when(split, DELETED).otherwise(MAIN)
    rows = docs.select(
        docs[id_column].alias("id"),
        F.coalesce(docs[text_column], F.lit("")).alias("text"),
        part.alias("part"),
        (~learned).alias("held_out"),
    )
    forward = stored(_forward(rows))
    total, batches = forward.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count("*")).first()
    buckets = int(min(MOST_BUCKETS, max(64, total // TOKENS_PER_BUCKET)))

    words = stored(_tell_all(_ask(forward, buckets, pairs=False), batches))
    pairs = stored(_tell_all(_ask(forward, buckets, pairs=True), batches))
    sums = words.where("batch < 0").groupBy("batch").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    found = {r["batch"]: (r["n"], r["total"]) for r in sums.collect()}
    totals = Totals(*found.get(MAIN_SUMS, (0, 0)), *found.get(TRAIN_SUMS, (0, 0)))

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the hashes only the bits that say where the answers are."""
        for many in batches:
            at = many.schema.get_field_index("hashes")
            hashes = [np.frombuffer(h, np.uint64) for h in many.column(at).to_pylist()]
            short = [_short(h, buckets).astype(_short_type(buckets)).tobytes() for h in hashes]
            columns = [c for k, c in enumerate(many.columns) if k != at]
            names = [n for n in many.schema.names if n != "hashes"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(short, pa.binary())], [*names, "short"])

    fields = [f for f in forward.schema.fields if f.name != "hashes"]
    slim = forward.mapInArrow(shorten, StructType([*fields, StructField("short", BinaryType())]))
    told = words.withColumn("kind", F.lit(1)).unionByName(pairs.withColumn("kind", F.lit(2))).where("batch >= 0").drop("total")

    def joined(batches: pa.Table, answers: pa.Table, column: str):
        row = batches.to_pylist()[0]
        rows = answers.to_pylist()
        one, two = ([r for r in rows if r["kind"] == k] for k in (1, 2))
        return row, _components(row, one, two, buckets, column)

    def held_bins(batches: pa.Table, answers: pa.Table) -> pa.Table:
        if not batches.num_rows:
            return pa.table({"code": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        _, (pair, before, word, _) = joined(batches, answers, "main")
        two = np.divide(pair, before, out=np.zeros(len(pair)), where=before > 0)
        one = word / max(1, totals.main_tokens)
        codes = (_context_class(before) * BINS + _bin(two)) * BINS + _bin(one)
        values, counts = np.unique(codes, return_counts=True)
        return pa.table({"code": pa.array(values), "n": pa.array(counts)})

    by_batch = lambda df: df.groupBy("batch")
    bins = (
        by_batch(slim.where(F.col("part") == DELETED))
        .cogroup(by_batch(told.where("main IS NOT NULL")))
        .applyInArrow(held_bins, "code long, n long")
        .groupBy("code")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    codes = np.array([r["code"] for r in bins], np.int64)
    held = np.array([r["n"] for r in bins], float)
    weights = fit_weights(codes, held, 1 / (totals.main_distinct + 1))

    out_schema = StructType(
        [
            StructField(id_column, rows.schema["id"].dataType),
            StructField("held_out", BooleanType()),
            StructField("n_tokens", LongType()),
            StructField("n_known", LongType()),
            StructField("train_tokens", LongType()),
            StructField("base_score", DoubleType()),
            StructField("score", DoubleType()),
        ]
    )

    def score(batches: pa.Table, answers: pa.Table) -> pa.Table:
        if not batches.num_rows:
            return result.empty_table()
        row, (pair, before, word, batch) = joined(batches, answers, "train")
        mixed = weights[:, _context_class(before)]
        two = np.divide(pair, before, out=np.zeros(len(pair)), where=before > 0)
        one = word / max(1, totals.tokens)
        p = mixed[0] * two + mixed[1] * one + mixed[2] / (totals.distinct + 1)
        base = (word + 0.5) / (totals.tokens + 0.5 * (totals.distinct + 1))
        if not totals.tokens:
            p = np.ones(len(p))
        starts = np.cumsum(batch.lengths) - batch.lengths
        values = [np.add.reduceat(x, starts) for x in ((word > 0).astype(np.int64), np.log10(base), np.log10(p))]
        return pa.Table.from_arrays(
            [
                batches.column("ids").combine_chunks().flatten(),
                pa.array(row["held_out"], pa.bool_()),
                pa.array(batch.lengths),
                pa.array(values[0]),
                pa.array(np.full(len(starts), totals.tokens)),
                pa.array(values[1]),
                pa.array(values[2]),
            ],
            schema=result,
        )

    from pyspark.sql.pandas.types import to_arrow_schema

    result = to_arrow_schema(out_schema)
    return by_batch(slim).cogroup(by_batch(told)).applyInArrow(score, out_schema)
