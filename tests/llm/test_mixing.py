from collections import defaultdict

import pytest

from millrace.llm.mixing import cut_text, cut_texts, mix, sainte_lague, water_fill
from millrace.llm.queries import QUERIES, weights_of
from tests.llm.conftest import DATA, ODD


def highest_quotients(seats, weights, caps):
    """Seat by seat, the definition."""
    out = [0] * len(weights)
    for _ in range(min(seats, sum(caps))):
        j = max((j for j in range(len(out)) if out[j] < caps[j] and weights[j] > 0), key=lambda j: (weights[j] / (2 * out[j] + 1), -j))
        out[j] += 1
    return out


@pytest.mark.parametrize("seats", [0, 1, 7, 40, 99, 500])
def test_apportionment_is_by_highest_quotients(seats):
    for weights, caps in (
        ([5, 2, 1], [1000] * 3),
        ([5, 5, 5, 1.5], [30, 3, 50, 20]),
        ([0.1, 7, 7, 0.3, 90], [10] * 5),
        ([1000, *[0.9] * 50], [2000, *[2] * 50]),
    ):
        assert sainte_lague(seats, weights, caps).tolist() == highest_quotients(seats, weights, caps)


def test_shares_above_the_bound_are_shared_again():
    assert water_fill([10, 100, 100], [5, 2, 1], 300, 2) == pytest.approx([20, 560 / 3, 280 / 3])
    assert sum(water_fill([3, 500, 40, 7], [5, 2, 1, 5], 800, 2)) == pytest.approx(800)
    assert water_fill([10, 10], [1, 1], 100, 2) == [20, 20]


def test_query_meets_its_targets(spark, texts):
    query = QUERIES["op2_mixing"]
    rows = [tuple(r) for r in query(spark, str(DATA)).collect()]
    assert sorted(rows) == sorted(tuple(r) for r in query(spark, str(DATA)).collect())
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    words = {i: len((t or "").encode().split()) for i, t in texts.items()}
    assert {r[0]: r[1] for r in rows} == words
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for doc_id, size, source_size, target, took in rows:
        assert 0 <= took <= 2 * size
        sizes[source[doc_id]] += size
        taken[source[doc_id]] += took
        targets[source[doc_id]] = (source_size, target)
    names = sorted(sizes)
    expected = water_fill([sizes[n] for n in names], weights_of(names), 1.5 * sum(sizes.values()), 2)
    for name, target in zip(names, expected):
        assert targets[name] == (sizes[name], pytest.approx(target))
        assert abs(taken[name] - target) <= max(0.02 * target, 64)


def test_texts_are_cut_as_counted(odd):
    mixed = mix(odd, weights_of)
    taken = {r["doc_id"]: r["taken"] for r in mixed.collect()}
    out = cut_texts(odd, mixed)
    assert out.columns == odd.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r["doc_id"]] += len(r["text"].encode().split())
    assert words[6] == taken[6] and words[9] == taken[9] and words[8] == taken[8]
    assert {1, 2, 3}.isdisjoint(words)


def test_rows_of_one_id_are_cut_by_their_own_spans(spark):
    """Null ids and repeated ids with texts of very different length, and quotas below the blocks."""
    rows = [(None, 900), (None, 50), (None, 333), (1, None), (1, 700), (1, 20), (2, 70), (2, 640)]
    text = lambda n: None if n is None else " ".join(f"{n}_{k}" for k in range(n))
    docs = spark.createDataFrame([(i, text(n), "s") for i, n in rows], "doc_id long, text string, source string")
    mixed = mix(docs, weights_of, share=0.6)
    found = mixed.collect()
    assert all(r["quota"] < r["blocks"] for r in found if r["size"])
    expected = {(r["doc_id"], r["size"]): r["taken"] for r in found if r["taken"]}
    assert len(expected) > 3
    words = defaultdict(int)
    for r in cut_texts(docs, mixed).collect():
        for word in r["text"].split():
            words[r["doc_id"], int(word.split("_")[0])] += 1
    assert words == expected


def test_a_cut_text_holds_its_blocks():
    text = " ".join(f"w{k}" for k in range(10))
    # Blocks of 4 words over words 2 to 11 of the shard; 3 of 4 blocks are taken once.
    out = cut_text(text, 2, 10, 4, 3, 1, 4)
    times = [((k + 1) * 3 + 1) // 4 - (k * 3 + 1) // 4 for k in range(4)]
    expected = [f"w{k}" for k in range(10) if times[(k + 2) // 4]]
    assert len(out) == 1 and out[0].split() == expected
    assert cut_text(text, 0, 10, 3, 6, 0, 4) == [text, text]
    assert cut_text(text, 0, 10, 3, 0, 0, 4) == []


def test_odd_rows(odd, none):
    out = mix(odd, weights_of).collect()
    assert len(out) == len(ODD)
    assert all(r["size"] == r["taken"] == 0 for r in out if r["doc_id"] in (1, 2, 3))
    assert all(r["taken"] <= 2 * r["size"] for r in out)
    nameless = [r for r in out if r["doc_id"] == 7]
    assert len(nameless) == 2 and {r["source_size"] for r in nameless} == {32}
    assert mix(none, weights_of).count() == 0
