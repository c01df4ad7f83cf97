"""The stages on the small tables, and the rules that hold for all operators."""

import re
import subprocess
import sys
from pathlib import Path

import duckdb

import corpus_pipeline
from millrace.llm.common import small_table
from millrace.llm.exact_dedup import exact_groups
from millrace.llm.minhash import near_duplicates
from millrace.llm.oracle import ORACLE
from millrace.llm.queries import QUERIES, learnable_labels
from millrace.llm.toxicity import score_toxicity
from tests.llm.conftest import DATA

ROOT = Path(__file__).resolve().parents[2]


def test_each_stage_works_on_all_that_is_left(spark, tmp_path, texts):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, str(DATA)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append((name, before, docs))
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == before.columns
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    by_name = {name: (before, after) for name, before, after in kept}
    before, after = by_name["toxicity"]
    assert ids(after) == ids(score_toxicity(before, learnable_labels(spark, str(DATA))).where("score < 0.7"))
    before, after = by_name["exact_dedup"]
    assert ids(after) == ids(exact_groups(before).where("kept"))
    before, after = by_name["near_dedup"]
    assert ids(after) == ids(near_duplicates(before).where("kept"))
    before, after = by_name["mixing"]
    assert set(ids(after)) <= set(ids(before)) and len(ids(after)) > len(ids(before))
    before, after = by_name["bpe"]
    pair = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    assert pair(after) == pair(before)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, str(DATA))
    assert out.count() > 0 and {"doc_id", "n_tokens", "ids"} <= set(out.columns)
    assert corpus_pipeline.ORACLE_SQL is None


def test_every_dealt_operator_has_one_query():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and ORACLE.keys() <= QUERIES.keys()


def test_sql_runs():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    for sql in ORACLE.values():
        assert con.execute(sql).fetchall()


def test_nothing_is_kept_on_one_machine_or_cut():
    banned = re.compile(r"localCheckpoint|toPandas|crossJoin|\.cache\(|\.persist\(|\.rdd\b|\.sample\(|tempfile")
    for path in [*ROOT.glob("millrace/llm/*.py"), ROOT / "corpus_pipeline.py"]:
        assert not banned.search(path.read_text()), path


def test_tables_of_the_driver_ask_for_no_python_workers(spark):
    rows = [(2, None, [1, -1], 0.5), (1, "é", None, None)]
    table = small_table(spark, rows, "number int, name string, votes array<int>, label double")
    assert sorted(map(tuple, table.collect())) == [(1, "é", None, None), (2, None, [1, -1], 0.5)]
    assert table.schema == spark.createDataFrame(rows, table.schema).schema
    assert "ExistingRDD" not in table._jdf.queryExecution().toString()
    assert small_table(spark, [], "number int, name string").count() == 0


def test_scans_give_their_memory_back():
    """A worker that waits for its next task is hardly larger than before the last one."""
    code = """
import re
import pyarrow as pa
from millrace.llm.common import frugal

def held():
    with open("/proc/self/smaps_rollup") as file:
        return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", file.read()))) / 1024

def scan(batches):
    for batch in batches:
        # Small objects that stay lie between those that go.
        parts = [bytes(2000) for _ in range(30_000)]
        large = pa.array(parts * 2)
        kept.append(bytes(2000))
        del parts, large
        yield batch

kept = []
batch = pa.RecordBatch.from_arrays([pa.array([1])], ["id"])
assert len(list(frugal(scan)(iter([batch] * 2)))) == 2
before = held()
for out in frugal(scan)(iter([batch] * 5)):
    pass
print(held() - before, held())
"""
    found = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    grown, all_held = map(float, found.stdout.split())
    assert grown < 20 and all_held < 100
