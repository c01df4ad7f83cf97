import random
from collections import defaultdict

import numpy as np

from millrace.llm.components import connected_components
from millrace.llm.minhash import Banding, drop_near_duplicates, near_duplicates
from millrace.llm.queries import QUERIES
from tests.llm.conftest import DATA, ODD
from tests.llm.test_exact_dedup import folded

SPACES = " \t\n\r\x0b\x0c"


def shingles(text, size):
    words = [w for w in "".join(" " if c in SPACES else c for c in folded(text)).split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


def brute_force(texts, size, percent):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    leader = {i: i for i in sets}

    def find(i):
        while leader[i] != i:
            i = leader[i]
        return i

    ids = sorted(sets)
    holders = defaultdict(list)
    for i in ids:
        for s in sets[i]:
            holders[s].append(i)
    for i in ids:
        for j in {j for s in sets[i] for j in holders[s] if j < i}:
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                leader[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query_matches_brute_force(spark, texts):
    out = QUERIES["op7_minhash"](spark, str(DATA))
    assert found(out) == brute_force(texts, 3, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out.collect())


def edited(words, edits, rnd):
    words = list(words)
    for k in rnd.sample(range(len(words)), edits):
        words[k] = f"new{rnd.random()}"
    return " ".join(words)


def test_a_group_of_near_copies_around_the_threshold(spark):
    """Many copies of one text with few to many edits, and many texts that share a passage: what
    the stars leave open must be finished exactly."""
    rnd = random.Random(5)
    original = [f"w{k}" for k in range(120)]
    passage = " ".join(f"p{k}" for k in range(60))
    texts = {k: edited(original, rnd.randint(0, 14), rnd) for k in range(150)}
    for k in range(150, 250):
        texts[k] = passage + " " + " ".join(f"x{rnd.random()}" for _ in range(rnd.randint(20, 60)))
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    assert found(near_duplicates(df, shingle_words=3, percent=85)) == brute_force(texts, 3, 85)


def test_recall_of_the_tables():
    """Pairs at the threshold meet in some table but for a few in a hundred thousand."""
    from millrace.llm.minhash import _keys, _signatures

    rnd = np.random.default_rng(1)
    banding = Banding()
    missed = 0
    for _ in range(300):
        common = rnd.integers(0, 2**63, 85, dtype=np.uint64)
        sets = [np.concatenate([common, rnd.integers(0, 2**63, n, dtype=np.uint64)]) for n in (8, 7)]
        keys = _keys(_signatures(sets, banding), banding)
        same = keys[0] == keys[1]
        missed += not (same[: banding.keys].any() and same[banding.keys :].any())
    assert missed <= 1


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1200)] + [(7, 7)]
    out = connected_components(spark.createDataFrame(edges, "a long, b long"))
    labels = {r["node"]: r["component"] for r in out.collect()}
    assert all(labels[k] == 0 for k in range(301)) and all(labels[k] == 1000 for k in range(1000, 1200))


def test_odd_rows(odd, none):
    out = near_duplicates(odd).collect()
    assert len(out) == len(ODD)
    of = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert all(of[i]["n_shingles"] == 0 and of[i]["component_id"] == i for i in (1, 2, 3))
    assert of[5]["component_id"] == 4 and not of[5]["kept"]
    assert of[8]["component_id"] == 7
    # Without an id: one has the words of document 7, the other is alone.
    without = sorted((r["component_id"], r["kept"]) for r in out if r["doc_id"] is None and r["component_id"])
    assert without == [(7, False)] and [r["kept"] for r in out if r["doc_id"] is r["component_id"] is None] == [True]
    assert near_duplicates(none).count() == 0


def test_links_of_texts_under_one_id_and_without_ids(spark):
    """Rows are told by what they say: an id may have two texts, or there may be none."""
    rnd = random.Random(9)
    a, b, c = (" ".join(f"{name}{k}{rnd.random()}" for k in range(60)) for name in "abc")
    rows = [(1, a), (1, b), (5, b + " more"), (6, a + " more"), (None, a + " none"), (None, c), (None, c + " again"), (None, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = near_duplicates(df).collect()
    assert sorted(r["component_id"] or 0 for r in out) == [0, 0, 0, 1, 1, 1, 1, 1]
    assert sorted(r["doc_id"] for r in out if r["kept"] and r["doc_id"]) == [1, 1]
    left = [tuple(r) for r in drop_near_duplicates(df).collect()]
    assert {r for r in left if r[0]} == {(1, a), (1, b)}
    # Of the texts without any id one stays; the row that repeats it is the same.
    assert len({r for r in left if not r[0]}) == 1


def test_dropping_keeps_one_of_each_component(odd, none):
    out = drop_near_duplicates(odd)
    assert out.columns == odd.columns
    left = [r["doc_id"] for r in out.collect()]
    assert 8 not in left and 5 not in left and left.count(7) == 2 and left.count(None) == 1
    assert drop_near_duplicates(none).count() == 0
