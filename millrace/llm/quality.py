"""Quality by weak supervision: rules vote or abstain, and their accuracies are estimated."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.bpe import small_batches
from millrace.llm.common import stored

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
WINDOW = 8
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_ended_lines",
    "n_distinct_words",
    "n_upper",
    "n_marks",
    "n_digits",
    "n_symbol_words",
    "n_symbol_lines",
)


def _repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that the text holds twice or more.

    Windows get exact numbers by doubling: pairs of words, pairs of pairs, and so on.
    """
    if len(words) <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    width = 1
    while width < WINDOW:
        pairs = codes[:-width] * (codes.max() + 1) + codes[width:]
        values, codes, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(values) == len(pairs):
            return 0
        width *= 2
    starts = np.flatnonzero(counts[codes] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


WITH_SYMBOL = re.compile(rb"[^\x20\x09-\x0D#*$%&|<>]*[#*$%&|<>][^\x20\x09-\x0D]*")


def measure(text: str | None) -> tuple[int, ...]:
    """The MEASURES of one text; all 0 for null."""
    if not text:
        return (0,) * len(MEASURES)
    # Bytes are split at the six white spaces of ASCII alone.
    raw = text.encode()
    words = raw.split()
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        symbols,
        len(lines) - len(set(lines)),
        _repeated_words(words),
        len(lines),
        sum(line.rstrip(SPACES)[-1] in ".!?\"'):;…。" for line in lines),
        len(set(words)),
        sum(map(str.isupper, text)) if text.upper() == text else sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        text.count("!") + text.count("?"),
        sum(map(text.count, "0123456789")),
        len(WITH_SYMBOL.findall(raw)) if symbols else 0,
        sum(any(c in line for c in SYMBOLS) for line in lines) if symbols else 0,
    )


def measures(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id`` and the MEASURES of every whole text, in one pass without a shuffle."""
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    schema = StructType([rows.schema["id"], *[StructField(m, LongType()) for m in MEASURES]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, "text"):
                found = np.array([measure(t) for t in batch.column(1).to_pylist()], np.int64)
                columns = [pa.array(found[:, k]) for k in range(len(MEASURES))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return rows.mapInArrow(scan, schema)


class Rule(NamedTuple):
    """Votes 1 (good), -1 (bad) or 0 (abstains); a null condition counts as not met."""

    bad: Column
    good: Column | None = None

    def vote(self) -> Column:
        bad = F.coalesce(self.bad, F.lit(False))
        good = F.lit(False) if self.good is None else F.coalesce(self.good, F.lit(False))
        return F.when(bad & ~good, -1).when(good & ~bad, 1).otherwise(0)


def rules() -> dict[str, Rule]:
    """Rules on the MEASURES. The limits are customary for web text. Most look for a fault and
    abstain where they see none, as its absence says little."""
    words = F.nullif(F.col("n_words"), F.lit(0))
    chars = F.nullif(F.col("word_chars"), F.lit(0))
    lines = F.nullif(F.col("n_lines"), F.lit(0))
    mean = F.col("word_chars") / words
    variety = F.col("n_distinct_words") / F.pow(words, F.lit(0.75))
    ended = F.col("n_ended_lines") / lines
    return {
        "length": Rule(F.col("n_words") < 20),
        "word_length": Rule((mean < 3) | (mean > 12)),
        "symbols": Rule(F.col("n_symbols") / words > 0.1),
        "symbol_words": Rule(F.col("n_symbol_words") / words > 0.15),
        "symbol_lines": Rule((F.col("n_symbol_lines") / lines > 0.4) & (F.col("n_symbols") > 10)),
        "same_lines": Rule(F.col("n_dup_lines") / lines > 0.3),
        "same_words": Rule(F.col("n_repeat_words") / words > 0.2),
        "variety": Rule(variety < 0.6),
        "capitals": Rule(F.col("n_upper") / chars > 0.4),
        "marks": Rule(F.col("n_marks") / words > 0.3),
        "line_ends": Rule(ended < 0.3),
        "digits": Rule(F.col("n_digits") / chars > 0.2),
        "prose": Rule(
            F.col("n_words") < 5,
            (ended > 0.7)
            & (F.col("n_symbols") / words < 0.01)
            & (F.col("n_upper") / chars < 0.1)
            & (F.col("n_repeat_words") / words < 0.05),
        ),
    }


class LabelModel(NamedTuple):
    """``prior`` of good, and the accuracy of each rule where it votes."""

    prior: float
    accuracies: np.ndarray

    def weights(self) -> np.ndarray:
        """Log odds that one vote of each rule adds."""
        return np.log(self.accuracies / (1 - self.accuracies))


def fit_label_model(
    patterns: np.ndarray,
    counts: np.ndarray,
    *,
    prior: float = 0.8,
    accuracy: float = 0.8,
    strength: float = 10.0,
    rounds: int = 200,
) -> LabelModel:
    """Expectation-maximisation over vote patterns (one row each, votes -1, 0, 1) and their counts.

    A rule that votes is right with its accuracy, whatever the class; votes are independent given
    the class, and abstaining says nothing. It starts from ``accuracy`` for all, which also fixes
    which class is the good one; that start counts as ``strength`` votes of each rule, and no
    accuracy leaves 0.55 to 0.995.
    """
    model = LabelModel(prior, np.full(patterns.shape[1], accuracy))
    voted = np.abs(patterns)
    for _ in range(rounds):
        good = posteriors(model, patterns)[:, None]
        right = np.where(patterns > 0, good, 1 - good) * voted
        hits = (counts[:, None] * right).sum(axis=0) + strength * accuracy
        accuracies = np.clip(hits / ((counts[:, None] * voted).sum(axis=0) + strength), 0.55, 0.995)
        share = float(((counts * good[:, 0]).sum() + strength * prior) / (counts.sum() + strength))
        done = np.abs(accuracies - model.accuracies).max() < 1e-9
        model = LabelModel(min(max(share, 0.01), 0.99), accuracies)
        if done:
            break
    return model


def posteriors(model: LabelModel, patterns: np.ndarray) -> np.ndarray:
    """Probability of good for each pattern."""
    logit = np.log(model.prior / (1 - model.prior)) + patterns @ model.weights()
    return 1 / (1 + np.exp(-logit))


def judge_quality(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: float = 0.5,
    own_rules: Mapping[str, Rule] | None = None,
) -> DataFrame:
    """Id, MEASURES, ``votes``, ``quality`` (posterior probability of good) and ``good``.

    Every rule votes or abstains on every whole text. The vote patterns of all documents are counted
    by Spark; by their outcomes the rules here allow at most 12,288 of them, whatever the
    input; the label model is fitted to those counts on the driver, and its log odds are added up per
    document. ``good`` is true where ``quality >= least``. No rule alone rejects a document.

    Defined cases: null and empty texts have measures 0, get votes where a measure alone decides and
    abstentions elsewhere; repeated rows are judged alike, and count as often; an empty table gives
    no rows; other columns are ignored.
    """
    chosen = dict(own_rules or rules())
    stats = measures(docs, id_column=id_column, text_column=text_column)
    votes = F.array(*[rule.vote() for rule in chosen.values()]).alias("votes")
    judged = stored(stats.select("*", votes))
    counted = judged.groupBy("votes").count().collect()
    if counted:
        patterns = np.array([r["votes"] for r in counted], int)
        model = fit_label_model(patterns, np.array([r["count"] for r in counted], float))
    else:
        model = LabelModel(0.5, np.full(len(chosen), 0.8))
    logit = F.lit(float(np.log(model.prior / (1 - model.prior))))
    for k, weight in enumerate(model.weights()):
        logit = logit + F.element_at("votes", k + 1) * float(weight)
    quality = (1 / (1 + F.exp(-logit))).alias("quality")
    return judged.select("*", quality).withColumn("good", F.col("quality") >= least).withColumnRenamed("id", id_column)
