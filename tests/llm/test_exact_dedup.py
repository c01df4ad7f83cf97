import hashlib
from collections import defaultdict

from millrace.llm.exact_dedup import drop_exact_copies, exact_groups
from millrace.llm.queries import QUERIES
from tests.llm.conftest import DATA, ODD


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_query_matches_brute_force(spark, texts):
    groups = defaultdict(list)
    for i, text in texts.items():
        groups[folded(text)].append(i)
    expected = {
        (i, max(ids), len(ids), i == max(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for i in ids
    }
    assert {tuple(r) for r in QUERIES["op5_exact_dedup"](spark, str(DATA)).collect()} == expected


def test_prefixes_and_lengths_alone_do_not_make_copies(spark):
    """Same length and prefix, other ends; a full filter hashes all and changes nothing."""
    rows = [(i, "p" * 100 + f"{i % 7:03d}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for words in (1 << 20, 1):
        out = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_groups(df, filter_words=words).collect()}
        for i, _ in rows:
            same = [j for j in range(50) if j % 7 == i % 7]
            assert out[i] == (max(same), len(same))


def test_odd_rows(odd, none):
    out = exact_groups(odd).collect()
    assert len(out) == len(ODD)
    found = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert (found[1]["keep_id"], found[1]["group_size"], found[1]["kept"]) == (2, 2, False)
    assert (found[4]["keep_id"], found[4]["kept"], found[5]["kept"]) == (5, False, True)
    assert (found[7]["keep_id"], found[7]["group_size"]) == (8, 4)
    assert exact_groups(none).count() == 0


def test_dropping_keeps_columns_and_one_of_each_group(odd, none):
    out = drop_exact_copies(odd)
    assert out.columns == odd.columns
    left = [r["text"] for r in out.collect()]
    assert sorted(map(folded, left)) == sorted({folded(r[1]) for r in ODD})
    assert drop_exact_copies(none).count() == 0


def test_runs_without_python(odd):
    from tests.conftest import plan_text

    plan = plan_text(exact_groups(odd))
    assert not any(x in plan for x in ("PythonUDF", "MapIn", "Pandas", "ArrowEval"))
