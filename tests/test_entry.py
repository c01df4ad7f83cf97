"""Every registered query against its SQL, on the smallest test tables."""

import importlib.util
import re
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
DATA = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

spec = importlib.util.spec_from_file_location("__spark_entry__", ROOT / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


# DuckDB's names of the Spark types that occur.
SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def by_name(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([r[i] for i in order]) for r in records)


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_matches_its_sql(spark, duck, name):
    result = entry.queries()[name](spark, str(DATA))
    sql = entry.oracle_sql()[name]
    described = {column: kind for column, kind, *_ in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {column: SQL_TYPES[kind] for column, kind in result.dtypes} == described
    expected = duck.execute(sql)
    names = [column[0] for column in expected.description]
    assert by_name(result.columns, result.collect()) == by_name(names, expected.fetchall())


def test_every_query_has_sql():
    """Those of the training-data operators are tested in their own folder."""
    assert entry.QUERIES.keys() == entry.ORACLE.keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_the_other_queries_work_without_the_training_data_operators(tmp_path):
    """Deployed without them, the entry still imports and offers everything else."""
    for name in ("millrace", "workload"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(*e.queries())"
    shown = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert shown.stdout.split() == list(entry.QUERIES), shown.stderr


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_queries_can_run_again_in_one_session(spark):
    for name in ("table_lifecycle", "stream_transactions", "scan_csv"):
        query = entry.queries()[name]
        first, second = query(spark, str(DATA)), query(spark, str(DATA))
        assert first.count() == second.count() > 0


def test_queries_take_directories_of_files(spark, tmp_path):
    """On a cluster a table is a directory of many files."""
    for name in ("orders", "events"):
        source = spark.read.parquet(f"{DATA}/{name}.parquet")
        source.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("stream_append", "stream_transactions", "table_count_sql"):
        query = entry.queries()[name]
        assert query(spark, str(tmp_path)).count() == query(spark, str(DATA)).count()


def test_no_rows_are_cut_and_nothing_is_collected():
    """Guard for the rules of scale: no caps, no unchecked broadcasts, no local checkpoints."""
    banned = re.compile(
        r"\.limit\(|\.sample\(|localCheckpoint|toPandas|crossJoin|\.cache\(|\.rdd\b"
    )
    library = [p for p in ROOT.glob("millrace/**/*.py") if "llm" not in p.parts]
    for path in [*library, *ROOT.glob("workload/*.py")]:
        assert not banned.search(path.read_text()), path
        pinned = path.read_text().count("F.broadcast(")
        assert pinned == (path.name == "dimension.py"), path
    for path in library:
        assert ".collect(" not in path.read_text(), path
