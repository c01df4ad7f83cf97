import numpy as np

from millrace.llm.quality import MEASURES, fit_label_model, judge_quality, measure, posteriors
from millrace.llm.queries import QUERIES
from tests.llm.conftest import DATA, ODD


def repeated(words):
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    covered = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(8)}
    return len(covered)


def brute_force(text):
    text = text or ""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.encode().split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:k] for k, line in enumerate(lines)),
        repeated(words),
    )


def test_query_matches_brute_force(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, str(DATA)).collect()}
    for doc_id, text in texts.items():
        if text and len(text) > 20_000:
            continue
        row, expected = rows[doc_id], brute_force(text)
        assert tuple(row[m] for m in MEASURES[:5]) == expected
        failed = expected[0] < 20 or 100 * expected[4] > 30 * expected[0]
        assert row["base_failed"] == failed and not (failed and row["kept"])


def test_the_verdict_agrees_with_the_labels(spark):
    """Labels are not learned from: good texts are kept, and most bad ones go."""
    rows = QUERIES["op3_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = rows.where("NOT base_failed").join(labels.withColumnRenamed("quality", "truth"), "doc_id")
    share = {r["truth"]: r["s"] for r in found.groupBy("truth").agg({"kept": "count"}).selectExpr("truth", "1 s").collect()}
    kept = {r["truth"]: r["k"] for r in found.selectExpr("truth", "double(kept) k").groupBy("truth").agg({"k": "avg"}).withColumnRenamed("avg(k)", "k").collect()}
    assert share and kept[1] > 0.99 and kept.get(0, 0) < 0.1


def test_accuracies_are_found():
    """Three rules of known accuracy and one that guesses, on votes drawn from the model."""
    rnd = np.random.default_rng(2)
    truth = rnd.random(40_000) < 0.7
    votes = np.zeros((len(truth), 4), int)
    for k, accuracy in enumerate((0.95, 0.85, 0.75, 0.55)):
        right = rnd.random(len(truth)) < accuracy
        votes[:, k] = np.where(truth == right, 1, -1) * (rnd.random(len(truth)) < 0.8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = fit_label_model(patterns, counts.astype(float))
    assert np.abs(model.accuracies - [0.95, 0.85, 0.75, 0.55]).max() < 0.03
    assert abs(model.prior - 0.7) < 0.03
    assert ((posteriors(model, votes) > 0.5) == truth).mean() > 0.93


def test_measures_of_odd_texts():
    assert measure(None) == measure("") == (0,) * len(MEASURES)
    assert measure("a b c d e f g h " * 3)[4] == 24
    assert measure("a b c d e f g h x a b c d e f g h")[4] == 16
    assert measure("l\nl\n\n l\nl")[3] == 2


def test_odd_rows(odd, none):
    out = judge_quality(odd).collect()
    assert len(out) == len(ODD) and all(0 <= r["quality"] <= 1 for r in out)
    same = [r["quality"] for r in out if r["doc_id"] == 7]
    assert same[0] == same[1]
    assert judge_quality(none).count() == 0
