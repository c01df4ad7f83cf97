"""Toxicity by weak supervision: many voters, a label model, and a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from millrace.llm.bpe import small_batches
from millrace.llm.common import bitmap, flagged, frugal, lowest_hashes, slot_of, small_table, stored

LETTERS = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"\b[^\W\d_][*#@$]{2,}[^\W\d_]*")
PREFIXES = range(3, 8)
# Words whose codes a worker remembers.
MEMORY_ENTRIES = 60_000
# Bit of each lexicon in the code of a word.
LEXICONS = ("word_sure", "word_hint", "prefix_sure", "prefix_hint")
COUNTS = (*LEXICONS, "n_distinct", "n_words", "n_upper", "n_letters", "n_marks", "n_masked")


class Lexicons(NamedTuple):
    """Words and beginnings of words that toxic texts favour: surely, or by hint."""

    words: dict[str, int]
    prefixes: dict[str, int]

    def code(self, word: str) -> int:
        found = self.words.get(word, 0)
        for n in PREFIXES:
            if len(word) <= n:
                break
            found |= self.prefixes.get(word[:n], 0)
        return found


def mine_lexicons(
    labelled: DataFrame,
    *,
    entries: int = 20_000,
    least_texts: int = 5,
    sure: float = 3.5,
    hint: float = 1.5,
    z: float = 4.0,
) -> Lexicons:
    """Lexicons out of rows ``text, toxic``: words and beginnings of words by their log odds.

    For each of them the texts that hold it are counted by label, first in every slice of a batch and
    then over all. Entries are those in at least ``least_texts`` toxic texts whose log odds are ``z``
    standard errors above 0 and at least ``hint``; from ``sure`` on they are sure. A lexicon of words
    and one of beginnings hold the ``entries`` with the highest log odds.
    """
    schema = "kind string, entry string, clean long, toxic long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, "text", 1_000_000):
                seen = (Counter(), Counter())
                for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words = set(LETTERS.findall((text or "").lower()))
                    own = seen[int(toxic)]
                    own.update(words)
                    # Beginnings are told from words by a blank.
                    own.update({f" {w[:n]}" for w in words for n in PREFIXES if len(w) > n})
                keys = [*(seen[0].keys() | seen[1].keys())]
                columns = [["p" if k[0] == " " else "w" for k in keys], [k.lstrip(" ") for k in keys]]
                columns += [[own[k] for k in keys] for own in seen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                    ["kind", "entry", "clean", "toxic"],
                )

    counted = labelled.select("text", "toxic").mapInArrow(frugal(count), schema)
    sums = counted.groupBy("kind", "entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    base = float(np.log((sizes.get(0, 0) + 1) / (sizes.get(1, 0) + 1)))
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    sums = sums.withColumn("odds", F.log(a / b) + base).where(
        (F.col("toxic") >= least_texts)
        & (F.col("odds") >= hint)
        & (F.col("odds") >= z * F.sqrt(1 / a + 1 / b))
    )
    sums = stored(sums)
    found: list[dict[str, int]] = []
    for shift, kind in enumerate(("w", "p")):
        best = sums.where(F.col("kind") == kind).orderBy(F.desc("odds"), "entry").limit(entries).collect()
        found.append({r["entry"]: (1 if r["odds"] >= sure else 2) << (2 * shift) for r in best})
    return Lexicons(*found)


class _Counter:
    def __init__(self, lexicons: Lexicons):
        self.lexicons = lexicons
        self.memory: dict[str, int] = {}

    def counts(self, text: str | None) -> tuple[int, ...]:
        text = text or ""
        words = LETTERS.findall(text.lower())
        memory = self.memory
        if len(memory) > MEMORY_ENTRIES:
            memory.clear()
        distinct = set(words)
        for w in distinct.difference(memory):
            memory[w] = self.lexicons.code(w)
        codes = np.fromiter(map(memory.__getitem__, words), np.int8, len(words))
        codes = codes[codes > 0]
        return (
            *[int(((codes >> k) & 1).sum()) for k in range(len(LEXICONS))],
            sum(memory[w] > 0 for w in distinct) if len(codes) else 0,
            len(words),
            sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
            sum(map(len, words)),
            text.count("!") + text.count("?"),
            len(MASKED.findall(text)) if "*" in text or "#" in text or "@" in text or "$" in text else 0,
        )


def _scan(rows: DataFrame, lexicons: Lexicons) -> DataFrame:
    """``id``, ``text_hash`` and the COUNTS of every whole text of ``id, text``."""
    rows = rows.select("id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    schema = StructType([rows.schema["id"], rows.schema["text_hash"], *[StructField(c, LongType()) for c in COUNTS]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(lexicons)
        for whole in batches:
            for batch in small_batches(whole, "text", 1_000_000):
                found = np.array([counter.counts(t) for t in batch.column(1).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), *[pa.array(found[:, k]) for k in range(len(COUNTS))]], schema.names
                )

    return rows.mapInArrow(frugal(scan), schema)


def _hits() -> Column:
    return F.col("word_sure") + F.col("prefix_sure") + F.col("word_hint") + F.col("prefix_hint")


class Rates(NamedTuple):
    """Hits of the lexicons per word in labelled texts of both kinds."""

    clean: float
    toxic: float

    def odds(self) -> Column:
        """Log odds of the hits of a text of its length, as counts of rare events."""
        gain = float(np.log(self.toxic / self.clean))
        return _hits() * gain - F.col("n_words") * (self.toxic - self.clean)


def estimate_rates(judged: DataFrame) -> Rates:
    """From rows with COUNTS and ``toxic``; without words both are the same, and odds are 0."""
    sums = judged.groupBy("toxic").agg(F.sum(_hits()).alias("hits"), F.sum("n_words").alias("words")).collect()
    rates = {r["toxic"]: (r["hits"] + 0.5) / (r["words"] + 1000) for r in sums}
    return Rates(rates.get(0, 0.0005), rates.get(1, 0.0005))


def voters(rates: Rates) -> dict[str, Column]:
    """Votes on the COUNTS: 1 toxic, -1 clean, 0 abstains."""
    words, letters = F.greatest("n_words", F.lit(1)), F.greatest("n_letters", F.lit(1))
    hits, odds = _hits(), rates.odds()

    def vote(toxic: Column, clean: Column | None = None) -> Column:
        out = F.when(toxic, 1)
        return (out if clean is None else out.when(clean, -1)).otherwise(0)

    counts = {c: F.col(c) for c in COUNTS}
    return {
        "a sure word": vote(counts["word_sure"] >= 1),
        "sure words": vote(counts["word_sure"] >= 2, counts["word_sure"] == 0),
        "hinting words": vote(counts["word_hint"] >= 2, counts["word_hint"] == 0),
        "sure beginnings": vote(counts["prefix_sure"] >= 2, counts["prefix_sure"] == 0),
        "hinting beginnings": vote(counts["prefix_hint"] >= 2, counts["prefix_hint"] == 0),
        "many beginnings": vote(counts["prefix_hint"] >= 4),
        "dense": vote(hits / words >= 0.02, hits / words < 0.002),
        "more than chance": vote(odds >= 2, odds <= -1),
        "different words": vote(counts["n_distinct"] >= 2, counts["n_distinct"] == 0),
        "shouting": vote((counts["n_upper"] / letters > 0.5) & (counts["n_marks"] / words > 0.3)),
        "masked words": vote(counts["n_masked"] >= 2),
    }


class LabelModel(NamedTuple):
    """A generative model of class and votes: ``prior`` of toxic, and for each voter the chance of
    its votes -1, 0, 1 given the class and the vote of the voter it depends on, its ``parent`` (-1 for
    the first of all). Pairs of voters that repeat each other so share one voice."""

    prior: float
    parents: tuple[int, ...]
    tables: np.ndarray  # voter, class, vote of the parent, vote

    def posteriors(self, patterns: np.ndarray) -> np.ndarray:
        odds = np.log(self.tables[:, 1]) - np.log(self.tables[:, 0])
        above = _votes_above(patterns, self.parents)
        voters_ = np.arange(patterns.shape[1])[None, :]
        logit = np.log(self.prior / (1 - self.prior)) + odds[voters_, above, patterns + 1].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def _votes_above(patterns: np.ndarray, parents: tuple[int, ...]) -> np.ndarray:
    """For each pattern and voter the index of the vote of its parent; 0 without one."""
    above = patterns[:, [max(p, 0) for p in parents]] + 1
    return np.where(np.array(parents)[None, :] < 0, 0, above)


def _joint(one_hot: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weight of each pair of votes of each two voters by class: voter, voter, class, vote, vote."""
    return np.stack([np.einsum("p,piv,pjw->ijvw", w, one_hot, one_hot, optimize=True) for w in weights], axis=2)


def _dependence_tree(joint: np.ndarray) -> tuple[int, ...]:
    """Of each voter the one it depends on: the spanning tree with the most information that votes
    share once the class is known (Chow and Liu's tree, by class)."""
    joint = joint + 0.1
    total = joint.sum(axis=(2, 3, 4), keepdims=True)
    chance, inside = joint / total, joint.sum(axis=(3, 4), keepdims=True)
    first, second = joint.sum(axis=4, keepdims=True), joint.sum(axis=3, keepdims=True)
    shared = (chance * np.log(joint * inside / (first * second))).sum(axis=(2, 3, 4))
    n = len(shared)
    parents, reached = [-1] * n, [0]
    while len(reached) < n:
        rest = [j for j in range(n) if j not in reached]
        i, j = max(((i, j) for i in reached for j in rest), key=lambda pair: (shared[pair], -pair[0], -pair[1]))
        parents[j] = i
        reached.append(j)
    return tuple(parents)


def fit_label_model(
    patterns: np.ndarray, counts: np.ndarray, labelled: np.ndarray, *, rounds: int = 100, strength: float = 20.0
) -> LabelModel:
    """Expectation-maximisation over vote patterns and their counts.

    ``labelled`` has for each pattern the number of clean and of toxic labelled documents; they give
    the start, which also says which class is which, and stay in the sums, where each weighs as much as
    ``strength`` others: else the many texts of which little is known move the classes.
    Each round finds prior, dependence tree and tables that make the expected counts likeliest.
    """
    one_hot = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)

    def fitted(weights: np.ndarray) -> LabelModel:
        joint = _joint(one_hot, weights)
        parents = _dependence_tree(joint)
        tables = np.empty((len(parents), 2, 3, 3))
        for j, i in enumerate(parents):
            alone = np.stack([np.diag(joint[j, j, c]) for c in (0, 1)]) + 0.5
            alone /= alone.sum(axis=1, keepdims=True)
            # Where the parent hardly ever votes so, the voter's own chances count.
            pairs = alone[:, None, :].repeat(3, axis=1) if i < 0 else joint[i, j] + 2 * alone[:, None, :]
            tables[j] = pairs / pairs.sum(axis=2, keepdims=True)
        return LabelModel(float((weights[1].sum() + 1) / (weights.sum() + 2)), parents, tables)

    known = labelled.T * strength
    model = fitted(known)
    for _ in range(rounds):
        toxic = model.posteriors(patterns)
        before = model
        model = fitted(np.stack([counts * (1 - toxic), counts * toxic]) + known)
        if abs(before.prior - model.prior) < 1e-9:
            break
    return model


def inputs(rates: Rates) -> list[Column]:
    """What the classifier sees of a document, from its COUNTS."""
    words, letters = F.greatest("n_words", F.lit(1)), F.greatest("n_letters", F.lit(1))
    out = []
    for c in (*LEXICONS, "n_distinct"):
        out += [F.log1p(F.col(c)), F.least(F.col(c), F.lit(1)), (F.col(c) >= 2).cast("int"), F.least(100 * F.col(c) / words, F.lit(10))]
    out += [F.log1p("n_words"), F.col("n_upper") / letters, F.least(F.col("n_marks") / words, F.lit(1)), F.log1p("n_masked")]
    odds = rates.odds()
    out += [F.greatest(F.least(odds, F.lit(high)), F.lit(low)) for low, high in ((-10, 20), (-3, 5))]
    return [c.cast("double") for c in out]


def fit_linear(x: np.ndarray, y: np.ndarray, *, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression on probabilities ``y``; the last one is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    training_rows: int = 50_000,
) -> DataFrame:
    """Id, ``text_hash``, ``score`` (probability of toxic) and ``label`` (the label model's
    posterior) of every document.

    ``labels`` holds the rows from which may be learned: id and label. All of them give the
    lexicons, how often these hit by chance, and the start of the label model. All documents are
    counted in whole by the lexicons and patterns; all vote patterns are counted by Spark (eleven
    voters with two or three outcomes: at most 34,992) and give the label model. A logistic regression
    is fitted to its posteriors on up to ``training_rows`` documents, chosen by hash, and scores all
    of them; that bound concerns fitting only.

    Texts of labelled documents are the only ones that move, and are found by a bitmap of fixed size.
    Scores depend on the text alone. Very long texts are read whole. Defined cases: null and empty
    texts are texts without words and get the score that follows; rows without a label (null) are not
    learned from; without labels of
    both kinds every score is the share of toxic labels, or 0; repeated rows get the same score; an
    empty table gives no rows; other columns are ignored. Of several labels of one id the toxic counts.
    """
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    known = labels.select(labels[id_column].alias("id"), labels[label_column].cast("int").alias("toxic"))
    known = known.where("id IS NOT NULL AND toxic IN (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = stored(known)
    wanted = bitmap(known, slot_of(F.col("id")))
    labelled = stored(flagged(rows.where("id IS NOT NULL"), F.col("id"), wanted).join(known, "id"))
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        share = float(sizes.get(1, 0) > 0)
        text_hash = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
        same = [F.lit(share).alias(name) for name in ("score", "label")]
        return rows.select(F.col("id").alias(id_column), text_hash, *same)
    lexicons = mine_lexicons(labelled)

    counted = stored(_scan(rows, lexicons))
    judged = stored(counted.join(known, "id").select("toxic", *COUNTS))
    rates = estimate_rates(judged)
    votes = F.array(*voters(rates).values()).alias("votes")
    counted = counted.select("*", votes)
    patterns = counted.groupBy("votes").count().collect()
    seen = {tuple(r["votes"]): [r["count"], 0.0, 0.0] for r in patterns}
    for r in judged.select("toxic", votes).groupBy("votes", "toxic").count().collect():
        seen[tuple(r["votes"])][1 + r["toxic"]] += r["count"]
    table = np.array([*seen.values()], float)
    keys = np.array([*seen], int)
    model = fit_label_model(keys, table[:, 0], table[:, 1:])
    posterior = small_table(
        counted.sparkSession,
        [(list(map(int, k)), float(p)) for k, p in zip(keys, model.posteriors(keys))],
        "votes array<int>, label double",
    )
    counted = counted.join(posterior, "votes", "left")
    features = F.array(*inputs(rates)).alias("x")
    n_rows = sum(r["count"] for r in patterns)
    chosen = lowest_hashes(counted, "id", training_rows, n_rows, *COUNTS).select(features, "label").collect()
    if not chosen:
        return counted.select(F.col("id").alias(id_column), "text_hash", F.lit(0.0).alias("score"), "label")
    weights = fit_linear(np.array([r["x"] for r in chosen]), np.array([r["label"] for r in chosen]))
    logit = F.lit(float(weights[-1]))
    for w, column in zip(weights, inputs(rates)):
        logit = logit + column * float(w)
    score = (1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(30.0)), F.lit(-30.0))))).cast(DoubleType())
    return counted.select(F.col("id").alias(id_column), "text_hash", score.alias("score"), "label")


def drop_toxic(
    docs: DataFrame, labels: DataFrame, *, most: float = 0.7, text_column: str = "text", **options: str
) -> DataFrame:
    """``docs`` without those that score ``most`` and more; all columns are kept.

    As a score depends on the text alone, the texts that go are joined against, by their hash.
    """
    scored = score_toxicity(docs, labels, text_column=text_column, **options)
    gone = stored(scored.where(F.col("score") >= most).select(F.col("text_hash").alias("gone_hash")).distinct())
    text_hash = F.xxhash64(F.coalesce(docs[text_column], F.lit("")))
    return docs.join(gone, text_hash == gone["gone_hash"], "left_anti")
