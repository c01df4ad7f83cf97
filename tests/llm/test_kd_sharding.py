import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from millrace.llm.kd_sharding import GROUP_SHARE, kd_shards
from millrace.llm.queries import QUERIES
from tests.llm.conftest import DATA, ODD


def test_query_gives_near_equal_shards(spark, texts):
    rows = QUERIES["op6_kd_sharding"](spark, str(DATA)).collect()
    assert {r["doc_id"] for r in rows} == texts.keys() and len(rows) == len(texts)
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sizes.keys() == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r["size"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_a_hot_place_is_cut(spark):
    """All texts the same: only the hash of the id can cut them."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "'same text' AS text", "'a' AS source", "'en' AS lang")
    sizes = Counter(r["shard"] for r in kd_shards(docs, shards=5).collect())
    assert sizes.keys() == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 20


def places_by_hand(size, *categories):
    found = [math.floor(math.log2(size) * (1 << 24))]
    for c in categories:
        found.append(0 if c is None else 1 + (xxhash.xxh64_intdigest(c.encode(), 42) >> 34))
    return found


def test_shards_are_the_leaves_of_a_tree_built_by_hand(spark):
    """At every node, shards left and right of the cut lie apart along the dimension that is widest
    over the rows below it, with bytes in proportion, and no small group of equal texts is cut."""
    docs = spark.read.parquet(f"{DATA.parent}/sf0.01/documents.parquet").where("doc_id IS NOT NULL")
    rows = docs.join(kd_shards(docs, shards=8).select("doc_id", "size", "shard"), "doc_id").collect()
    assert len(rows) == docs.count() == len({r["doc_id"] for r in rows})
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r)
    total = sum(r["size"] for r in rows)
    split = [g for g in groups.values() if len({r["shard"] for r in g}) > 1]
    assert all(sum(r["size"] for r in g) > GROUP_SHARE * total / 8 for g in split) and len(split) <= 7

    points = []
    for g in groups.values():
        categories = min(places_by_hand(g[0]["size"], r["source"], r["lang"])[1:] for r in g)
        points += [([places_by_hand(r["size"])[0], *categories], r["size"], r["shard"]) for r in g]
    widths = lambda some: [max(p[0][d] for p in some) - min(p[0][d] for p in some) for d in range(3)]
    spans = [max(1, w) for w in widths(points)]
    for low, high in ((0, 8), (0, 4), (4, 8), (0, 2), (2, 4), (4, 6), (6, 8)):
        below = [p for p in points if low <= p[2] < high]
        shares = [w / s for w, s in zip(widths(below), spans)]
        d, middle = shares.index(max(shares)), (low + high) // 2
        left, right = ([p for p in below if (p[2] < middle) == side] for side in (True, False))
        assert max(p[0][d] for p in left) <= min(p[0][d] for p in right)
        largest = max(p[1] for p in below)
        assert abs(sum(p[1] for p in left) - sum(p[1] for p in right)) <= max(0.05 * total / 8, 2 * largest)


def test_equal_texts_stay_together_whatever_their_source(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "concat('text ', id % 300) AS text", "concat('s', id % 7) AS source", "concat('l', id % 3) AS lang"
    )
    places, sizes = defaultdict(set), Counter()
    for r in kd_shards(docs, shards=8).collect():
        places[r["text_crc32"]].add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert all(len(p) == 1 for p in places.values())
    assert max(sizes.values()) <= 1.08 * min(sizes.values())


def test_target_bytes(spark):
    docs = spark.range(1000).selectExpr("id AS doc_id", "repeat('x', 99) AS text", "'a' AS source", "'en' AS lang")
    out = kd_shards(docs, target_bytes=10_000)
    assert out.select("shard").distinct().count() == 10
    with pytest.raises(ValueError):
        kd_shards(docs)


def test_odd_rows(odd, none):
    out = kd_shards(odd, shards=3).collect()
    assert len(out) == len(ODD) and {r["size"] for r in out if r["doc_id"] in (1, 2)} == {1}
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert kd_shards(none, shards=3).count() == 0
