import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="run-")
    session = (
        # A failed task is tried again, as on a cluster.
        SparkSession.builder.master("local[8,4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        # No checksum files beside those on the local disk: a table of many dates is many files.
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        # Small tables of many dates: let several tasks write them.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def set_conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def namespace(spark):
    from millrace.sources.scratch import scratch_namespace

    return scratch_namespace(spark)


def plan_text(df, mode="formatted"):
    """The physical plan as text."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
