import glob
import threading
from unittest import mock

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.naming import name_parts, quote
from millrace.sources import (
    current_namespace,
    drop_table,
    ensure_namespace,
    ensure_table,
    list_namespaces,
    list_tables,
    replace_table,
)
from millrace.sources import tables
from tests.conftest import plan_text, rows
from millrace.sources.scratch import scratch_folder


def names(df):
    return {r.tableName for r in df.collect()}


def test_ensure_list_and_drop(spark, namespace):
    schema = StructType.fromDDL("id bigint, `odd name` string, s struct<a: int, b: array<double>>")
    table = f"{namespace}.kept"
    ensure_namespace(spark, namespace)
    ensure_table(spark, table, schema)
    assert spark.table(table).schema == schema
    assert names(list_tables(spark, namespace)) == {"kept"}
    assert namespace in {r.namespace for r in list_namespaces(spark).collect()}
    drop_table(spark, table)
    drop_table(spark, table)
    assert names(list_tables(spark, namespace)) == set()


def test_ensure_never_empties_a_table(spark, namespace):
    table = f"{namespace}.kept"
    ensure_table(spark, table, StructType.fromDDL("id bigint"))
    spark.range(3).write.insertInto(table)
    ensure_table(spark, table, StructType.fromDDL("id bigint"))
    assert spark.table(table).count() == 3


def test_ensure_partitioned(spark, namespace):
    table = f"{namespace}.parts"
    ensure_table(spark, table, StructType.fromDDL("id bigint, d date"), partition_by=["d"])
    described = {r.col_name for r in spark.sql(f"DESCRIBE {table}").collect()}
    assert "# Partition Information" in described


def test_one_part_name_in_the_current_namespace(spark, namespace):
    replace_table(spark.range(4), f"{namespace}.customer")
    before = spark.catalog.currentDatabase()
    with current_namespace(spark, namespace):
        assert spark.sql("SELECT * FROM customer").count() == 4
    assert spark.catalog.currentDatabase() == before
    with pytest.raises(ZeroDivisionError), current_namespace(spark, namespace):
        1 / 0
    assert spark.catalog.currentDatabase() == before


def test_names_with_three_parts(spark, namespace):
    replace_table(spark.range(4), f"spark_catalog.{namespace}.three")
    counted = spark.sql(f"SELECT count(*) AS n FROM spark_catalog.{namespace}.three")
    assert counted.collect()[0].n == 4


def test_name_parts():
    assert name_parts("a.b.c") == ["a", "b", "c"]
    assert name_parts("`a.x`.b") == ["a.x", "b"]
    assert name_parts(quote("it`s", "c d")) == ["it`s", "c d"]


def dated(spark, n=100):
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 5).cast("int"))
    return spark.range(n).select("id", F.when(F.col("id") % 7 > 0, day).alias("d"), F.lit("x").alias("z"))


def test_replace_returns_the_count_and_replaces_all(spark, namespace):
    table = f"{namespace}.r"
    assert replace_table(spark.range(7).withColumn("old", F.lit(1)), table) == 7
    assert replace_table(dated(spark), table, partition_by="d") == 100
    out = spark.table(table)
    assert set(out.columns) == {"id", "d", "z"}
    assert rows(out.select("id", "d", "z")) == rows(dated(spark))


def test_rows_without_a_date_are_kept(spark, namespace):
    replace_table(dated(spark), f"{namespace}.r", partition_by="d")
    expected = dated(spark).filter("d is null").count()
    assert spark.table(f"{namespace}.r").filter("d is null").count() == expected > 0


def test_replace_runs_its_input_once(spark, namespace):
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            ran.add(len(batch))
            yield batch

    df = spark.range(50, numPartitions=2).mapInPandas(count, "id bigint")
    assert replace_table(df, f"{namespace}.once") == 50
    assert ran.value == 50


@pytest.mark.parametrize("partition_by", [None, "d"])
def test_retried_tasks_are_counted_once(spark, namespace, partition_by):
    def fail_first(batches):
        from pyspark import TaskContext

        for batch in batches:
            yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost on purpose")

    df = dated(spark, 200).repartition(4).mapInPandas(fail_first, "id bigint, d date, z string")
    assert replace_table(df, f"{namespace}.retried", partition_by=partition_by) == 200
    assert rows(spark.table(f"{namespace}.retried").select("id", "d", "z")) == rows(dated(spark, 200))


def test_empty_input_gives_an_empty_table(spark, namespace):
    assert replace_table(dated(spark, 0), f"{namespace}.none", partition_by="d") == 0
    assert spark.table(f"{namespace}.none").count() == 0


def test_odd_partition_name(spark, namespace):
    df = dated(spark).withColumnRenamed("d", "the date.x")
    assert replace_table(df, f"{namespace}.odd", partition_by="the date.x") == 100


def test_date_filter_prunes_partitions(spark, namespace):
    replace_table(dated(spark), f"{namespace}.p", partition_by="d")
    out = spark.table(f"{namespace}.p").filter("d = date'2025-01-02'")
    plan = plan_text(out)
    assert "PartitionFilters: [isnotnull(d" in plan
    assert out.count() == dated(spark).filter("d = date'2025-01-02'").count()


def test_a_hot_date_is_written_by_several_tasks(spark, set_conf):
    """Small dates stay in one file; the one with most rows is split."""
    set_conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__shuffle__partitions="64",
    )
    folder = scratch_folder(spark)
    namespace = f"hot_{folder.rsplit('/', 1)[1]}"
    ensure_namespace(spark, namespace, folder)
    n = F.col("id")
    day = F.date_add(
        F.lit("2025-01-01").cast("date"), F.when(n % 3 > 0, 0).otherwise(n % 30).cast("int")
    )
    df = spark.range(0, 60_000, numPartitions=16).select(
        F.sha2(n.cast("string"), 256).alias("payload"), day.alias("d")
    )
    assert replace_table(df, f"{namespace}.t", partition_by="d") == 60_000
    files = sorted(len(glob.glob(f"{date}/*.parquet")) for date in glob.glob(f"{folder}/t.versions/*/d=*"))
    assert len(files) == 10
    assert files[-1] >= 8
    assert files[5] <= 2
    assert spark.table(f"{namespace}.t").count() == 60_000


def test_replacing_a_table_from_itself_is_harmless(spark, namespace):
    replace_table(spark.range(5), f"{namespace}.self")
    assert replace_table(spark.table(f"{namespace}.self"), f"{namespace}.self") == 5
    assert spark.table(f"{namespace}.self").count() == 5


def test_v2_catalogs_are_recognised(spark, set_conf):
    set_conf(spark__sql__catalog__lake="org.example.NoSuchCatalog")
    assert tables._is_v2(spark, "lake.db.t")
    assert tables._is_v2(spark, "`lake`.t")
    assert not tables._is_v2(spark, "lake")
    assert not tables._is_v2(spark, "db.t")
    assert not tables._is_v2(spark, "spark_catalog.db.t")


def test_v2_replacement_is_one_commit_without_extra_shuffle(spark, monkeypatch):
    """No v2 table catalog ships with Spark, so only the calls can be checked."""
    df = mock.MagicMock()
    df.sparkSession.table.return_value.count.return_value = 3
    monkeypatch.setattr(tables, "_is_v2", lambda *_: True)
    assert replace_table(df, "lake.db.t", partition_by="d", fmt="iceberg") == 3
    df.hint.assert_not_called()
    df.writeTo.assert_called_once_with("lake.db.t")
    writer = df.writeTo.return_value.using
    writer.assert_called_once_with("iceberg")
    writer.return_value.partitionedBy.assert_called_once()
    writer.return_value.partitionedBy.return_value.createOrReplace.assert_called_once_with()


def test_a_failed_replace_keeps_the_old_rows(spark, namespace):
    table = f"{namespace}.t"
    assert replace_table(spark.range(7), table) == 7
    broken = spark.range(3).withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(1))
    with pytest.raises(Exception, match="boom"):
        replace_table(broken, table)
    assert spark.table(table).count() == 7
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {namespace}").collect()] == ["t"]


def test_a_table_can_be_replaced_from_itself(spark, namespace):
    table = f"{namespace}.t"
    replace_table(spark.range(7).withColumn("d", F.col("id") % 2), table, partition_by="d")
    assert replace_table(spark.table(table).where("id > 2"), table, partition_by="d") == 4
    assert rows(spark.table(table).select("id")) == [(3,), (4,), (5,), (6,)]


def test_an_existing_table_must_have_the_schema(spark, namespace):
    table = f"{namespace}.t"
    schema = StructType.fromDDL("id bigint, name string")
    ensure_table(spark, table, schema)
    ensure_table(spark, table, StructType.fromDDL("NAME string, ID bigint"))
    for other in ("id bigint", "id int, name string", "id bigint, name string, x int"):
        with pytest.raises(ValueError, match="another schema"):
            ensure_table(spark, table, StructType.fromDDL(other))


def test_namespaces_of_the_current_catalog(spark, namespace):
    assert list_namespaces(spark).where(F.col("namespace") == namespace).count() == 1


# --- versions ---------------------------------------------------------------------------


@pytest.mark.parametrize("partition_by", [None, "d"])
def test_readers_see_whole_versions_while_the_table_is_replaced(spark, namespace, partition_by):
    table, stop, seen, failed = f"{namespace}.busy", threading.Event(), [], []

    def content(k):
        return spark.range(50).select("id", F.lit(k).alias("version"), (F.col("id") % 3).alias("d"))

    def read():
        while not stop.is_set():
            try:
                found = spark.table(table).groupBy("version").agg(F.count("*"), F.sum("id")).collect()
                seen.append([tuple(r) for r in found])
            except Exception as error:
                failed.append(error)
                return

    replace_table(content(0), table, partition_by=partition_by)
    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(1, 21):
            assert replace_table(content(k), table, partition_by=partition_by) == 50
            assert spark.table(table).select("version").distinct().collect() == [(k,)]
    finally:
        stop.set()
        reader.join()
    assert not failed, failed[0]
    versions = [found[0][0] for found in seen]
    assert all(found == [(found[0][0], 50, 49 * 25)] for found in seen)
    assert versions == sorted(versions) and len(set(versions)) > 3


def test_old_versions_go_and_a_drop_takes_all(spark, namespace):
    table, folder = f"{namespace}.t", tables._namespace_folder(spark, f"{namespace}.t").removeprefix("file:")
    for k in range(5):
        replace_table(spark.range(k), table, keep=1)
    assert len(glob.glob(f"{folder}/t.versions/*")) == 2
    spark.sql(f"DROP TABLE {table}")
    assert replace_table(spark.range(3), table, keep=0) == 3 and spark.table(table).count() == 3
    assert len(glob.glob(f"{folder}/t.versions/*")) == 1
    drop_table(spark, table)
    assert not glob.glob(f"{folder}/t.versions*") and not spark.catalog.tableExists(table)


def test_a_query_planned_before_a_replace_ends_on_its_version(spark, namespace):
    table = f"{namespace}.t"
    replace_table(dated(spark, 30), table, partition_by="d")
    old = spark.table(table)
    for n in (40, 50):
        replace_table(dated(spark, n), table, partition_by="d")
    assert old.count() == 30 and spark.table(table).count() == 50


def test_another_shape_makes_the_table_anew(spark, namespace):
    """Columns, types, order, partitioning, format, or a table that was not made here."""
    table = f"{namespace}.t"
    spark.range(9).write.saveAsTable(table)
    steps = [
        (spark.range(5), None, "parquet"),
        (spark.range(5).withColumn("x", F.lit("01")), None, "parquet"),
        (spark.range(5).withColumn("x", F.lit("01")), "x", "parquet"),
        (spark.range(5).select(F.lit("01").alias("x"), "id"), "x", "parquet"),
        (spark.range(5).withColumn("x", F.lit(1)), "x", "parquet"),
        (spark.range(5).withColumn("x", F.lit(1)), "x", "json"),
    ]
    for df, partition_by, fmt in steps * 2:
        replace_table(df, table, partition_by=partition_by, fmt=fmt)
        found = spark.table(table).select(*df.columns)
        assert found.dtypes == df.dtypes and rows(found) == rows(df)


def test_odd_columns_survive(spark, namespace):
    df = spark.sql("SELECT 1 AS `a b`, named_struct('x.y', 2) AS `s;t`, map('k', 1.5D) AS m, 'it''s' AS `d'`")
    for _ in range(2):
        assert replace_table(df, f"{namespace}.odd", partition_by="d'") == 1
    assert rows(spark.table(f"{namespace}.odd")) == rows(df)
