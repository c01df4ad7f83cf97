"""Namespaces and tables, in the session catalog or in any v2 catalog."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.naming import literal, name_parts, quote, quote_table
from millrace.operators.rows import observe_rows
from millrace.sources.storage import child_names, delete_folder

SESSION_CATALOG = "spark_catalog"
# The property that names the folder of a table's versions.
VERSIONS = "replace.versions"
# The property of a table that takes batches of several writers.
SHARED = "append.shared"
# More rows than the description of any table has.
DESCRIBED_ROWS = 100_000


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Create ``namespace`` (``catalog.namespace`` or one part) unless it exists."""
    clause = "" if location is None else f" LOCATION '{literal(location)}'"
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quote_table(namespace)}{clause}")


@contextmanager
def current_namespace(spark: SparkSession, namespace: str) -> Iterator[None]:
    """Resolve one-part table names in ``namespace``; switch back afterwards."""
    before = (spark.catalog.currentCatalog(), spark.catalog.currentDatabase())
    spark.sql(f"USE {quote_table(namespace)}")
    try:
        yield
    finally:
        # The namespace may have several parts, which arrive already joined by dots.
        spark.sql(f"USE {quote(before[0], *name_parts(before[1]))}")


def list_namespaces(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    """Namespaces of ``catalog``, by default of the current one."""
    return spark.sql(f"SHOW NAMESPACES IN {quote(catalog or spark.catalog.currentCatalog())}")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {quote_table(namespace)}")


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    *,
    shared: bool = False,
    add_columns: bool = False,
) -> None:
    """Create an empty ``table`` with ``schema`` unless it exists; never drops one.

    A stream that restarts from its checkpoint does not deliver old rows again, so a table
    emptied at start would lose them. Dropping is a separate, explicit call. An existing table
    must have the columns of ``schema``, whatever their order and letter case, with the same
    types; else ``ValueError`` is raised, since columns it lacks would vanish unseen and other
    types make files that cannot be read together. With ``add_columns`` columns that the table lacks
    are added to it, null in all rows it holds; types never change, and no column goes.

    A ``shared`` table is a file table of the session catalog, without partitions, that takes whole
    batches of several writers (see :func:`millrace.streaming.append_once`) beside ordinary inserts.
    An existing table must have been created so.
    """
    if shared and (partition_by or not holds_files(spark, table)):
        raise ValueError(f"{table} cannot be shared: that needs a table of files without partitions")
    existed = spark.catalog.tableExists(quote_table(table))
    extras = f" PARTITIONED BY ({', '.join(map(quote, partition_by))})" if partition_by else ""
    if shared:
        # Batches lie in folders of their own below the table's.
        extras += f" OPTIONS (recursiveFileLookup 'true') TBLPROPERTIES ('{SHARED}' = 'true')"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quote_table(table)} ({schema.toDDL()}) USING {fmt}{extras}")
    if existed:
        if shared and table_property(spark, table, SHARED) is None:
            raise ValueError(f"{table} exists and was not created for several writers")
        found, wanted = ({f.name.lower(): f.dataType.simpleString() for f in s} for s in (spark.table(table).schema, schema))
        missing = [f for f in schema.fields if f.name.lower() not in found] if add_columns else []
        differ = sorted(n for n in found.keys() | wanted.keys() if found.get(n) != wanted.get(n))
        differ = [n for n in differ if n not in {f.name.lower() for f in missing}]
        if differ:
            raise ValueError(f"{table} exists with another schema: {', '.join(differ)} differ")
        if missing:
            new = StructType(missing).toNullable().toDDL()
            spark.sql(f"ALTER TABLE {quote_table(table)} ADD COLUMNS ({new})")


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop ``table`` if it exists, with all versions that :func:`replace_table` has kept of it."""
    versions = table_property(spark, table, VERSIONS) if holds_files(spark, table) else None
    spark.sql(f"DROP TABLE IF EXISTS {quote_table(table)}")
    if versions is not None:
        delete_folder(spark, versions)


def replace_table(
    df: DataFrame,
    table: str,
    *,
    partition_by: str | None = None,
    fmt: str = "parquet",
    keep: int = 2,
) -> int:
    """Create or replace ``table`` with ``df`` and return the number of rows written.

    ``df`` runs once; a retried task is never counted twice. It may read the old table.

    In a v2 catalog the replacement is one atomic commit, and the table's own distribution
    rules arrange the rows, possibly in a stage after ``df``. The rows are therefore counted
    in the written table, which such tables answer from their metadata.

    In the session catalog each replacement writes a version, a folder of its own beside the
    namespace's tables, and then points the table to it, which is one change in the catalog: who
    reads sees the old version or the new one, whole, and nothing is renamed or copied. A failed
    write leaves the table as it was. The ``keep`` versions before the new one stay for queries that
    still read them; older ones are deleted. Partitions are found by their folders, so none is
    registered anywhere.

    Only where columns, partitioning or format differ from the old table, or where the old table was
    not made here, is it dropped and created anew, three quick changes in a row, between which the
    table is missing or, with partitions, empty. Another session may go on with what it remembers of
    the table until it refreshes it. A table of versions is dropped by :func:`drop_table`; a plain
    ``DROP TABLE`` leaves its folders.

    Rows are rebalanced by ``partition_by`` first, which gives each
    partition few files and lets adaptive execution split a partition value that holds more
    than one task should write. The rows are counted by the tasks that write them.
    """
    spark = df.sparkSession
    if _is_v2(spark, table):
        target = df.writeTo(table).using(fmt)
        if partition_by is not None:
            target = target.partitionedBy(F.col(quote(partition_by)))
        target.createOrReplace()
        return spark.table(table).count()
    versions = table_property(spark, table, VERSIONS)
    same = versions is not None and _same_shape(spark, table, df.schema, partition_by, fmt)
    if versions is None:
        versions = f"{_namespace_folder(spark, table)}/{name_parts(table)[-1]}.versions"
    # Names rise with time.
    version = f"{versions}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    if partition_by is not None:
        df = df.hint("rebalance", quote(partition_by))
    written = Observation()
    writer = observe_rows(df, written).write.format(fmt)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    try:
        writer.save(version)
    except Exception:
        delete_folder(spark, version)
        raise
    if not same:
        _create_anew(spark, table, df.schema, partition_by, fmt, version, versions)
    spark.sql(f"ALTER TABLE {quote_table(table)} SET LOCATION '{literal(version)}'")
    # Later names are those of replacements that are still being written.
    older = [name for name in child_names(spark, versions) if name < version.rsplit("/", 1)[1]]
    for name in older[: max(0, len(older) - keep)]:
        delete_folder(spark, f"{versions}/{name}")
    # A reader that resolved the table during the change may have put the old version back into the
    # session's memory. Another change of the table takes it out, and lists no files for that.
    last = literal(version.rsplit("/", 1)[1])
    spark.sql(f"ALTER TABLE {quote_table(table)} SET TBLPROPERTIES ('{VERSIONS}.last' = '{last}')")
    return written.get["rows"]


def replace_partitions(df: DataFrame, table: str) -> int:
    """Replace those partitions of ``table`` that ``df`` has rows for; return the rows written.

    All other partitions stay. The table must exist, with partitions and with the columns of ``df``
    in any order. ``df`` may not read the table. In a v2 catalog this is one atomic commit, whose rows
    are counted by its writing tasks. In the session catalog Spark moves the new files into place
    partition by partition once all are written, within the table's current version: a query that
    reads such a partition at that time may miss it or fail, one that reads others does not. Rows are
    rebalanced by the partition columns, as in :func:`replace_table`.
    """
    spark = df.sparkSession
    written = Observation()
    if _is_v2(spark, table):
        observe_rows(df, written).writeTo(table).overwritePartitions()
        return written.get["rows"]
    columns, described = spark.table(quote_table(table)).columns, _described(spark, table)
    parted, known = _partition_columns(described), {r["col_name"]: r["data_type"] for r in described}
    if not parted:
        raise ValueError(f"{table} has no partitions")
    if sorted(c.lower() for c in columns) != sorted(c.lower() for c in df.columns):
        raise ValueError(f"{table} has the columns {columns}, not {df.columns}")
    rows = df.select(*[F.col(quote(c)) for c in columns]).hint("rebalance", *[quote(c) for c in parted])
    # An insert would take that mode from the session alone, for all that runs in it.
    writer = observe_rows(rows, written).write.format(known["Provider"]).partitionBy(*parted)
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(known["Location"])
    if table_property(spark, table, VERSIONS) is None:
        spark.sql(f"MSCK REPAIR TABLE {quote_table(table)} SYNC PARTITIONS")
    spark.catalog.refreshTable(quote_table(table))
    return written.get["rows"]


def _described(spark: SparkSession, table: str) -> list[Row]:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}").tail(DESCRIBED_ROWS)


def _partition_columns(described: list[Row]) -> list[str]:
    """They stand, below the columns, under two titles of their own, up to an empty row or the next title."""
    titles = [k for k, row in enumerate(described) if row["col_name"] == "# Partition Information"]
    names = [row["col_name"] for row in described[titles[-1] + 2 :]] if titles else []
    return names[: next((k for k, name in enumerate(names) if not name or name.startswith("# ")), len(names))]


def _create_anew(
    spark: SparkSession,
    table: str,
    schema: StructType,
    partition_by: str | None,
    fmt: str,
    version: str,
    versions: str,
) -> None:
    """Create ``table`` in place of any other of that name: over its version, or, with partitions,
    over none yet, as Spark lists all folders of a partitioned table while it creates one."""
    name = quote_table(table)
    partitioning, folder = "", version
    if partition_by is not None:
        partitioning, folder = f" PARTITIONED BY ({quote(partition_by)})", f"{versions}/none"
    # Partitions that the catalog kept would have to be changed one by one.
    setting = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(
            f"CREATE TABLE {name} ({schema.toNullable().toDDL()}) USING {fmt}{partitioning} "
            f"LOCATION '{literal(folder)}' TBLPROPERTIES ('{VERSIONS}' = '{literal(versions)}')"
        )
    finally:
        spark.conf.set(setting, before)


def _same_shape(
    spark: SparkSession, table: str, schema: StructType, partition_by: str | None, fmt: str
) -> bool:
    """Whether ``table`` has just these columns in their order, this partitioning and this format."""
    described = _described(spark, table)
    provider = next((r["data_type"] for r in reversed(described) if r["col_name"] == "Provider"), None)
    wanted = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    partitions = [] if partition_by is None else [c for c in wanted if c[0].lower() == partition_by.lower()]
    wanted = [c for c in wanted if c not in partitions] + partitions
    found = [(f.name, f.dataType.simpleString()) for f in spark.table(quote_table(table)).schema.fields]
    parted = [c[0] for c in partitions]
    return found == wanted and _partition_columns(described) == parted and (provider or "").lower() == fmt.lower()


def _namespace_folder(spark: SparkSession, table: str) -> str:
    """The folder in which the namespace of ``table`` has its tables."""
    parents = name_parts(table)[:-1]
    name = quote(*parents) if parents else quote(*name_parts(spark.catalog.currentDatabase()))
    described = spark.sql(f"DESCRIBE NAMESPACE {name}").where("info_name = 'Location'")
    return described.first()["info_value"].rstrip("/")


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    """A property of a table; none if either does not exist."""
    if not spark.catalog.tableExists(quote_table(table)):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {quote_table(table)}").where(F.col("key") == key).first()
    return found and found["value"]


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a file table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}")
    # The last such row: a column may have that name too.
    return described.filter(F.col("col_name") == "Location").tail(1)[0]["data_type"]


def holds_files(spark: SparkSession, table: str) -> bool:
    """Whether ``table`` is of the session catalog, where a table is a folder of files."""
    return not _is_v2(spark, table)


def _is_v2(spark: SparkSession, table: str) -> bool:
    first = name_parts(table)[0]
    if first == SESSION_CATALOG:
        return False
    if len(name_parts(table)) > 1 and spark.conf.get(f"spark.sql.catalog.{first}", None) is not None:
        return True
    return spark.catalog.currentCatalog() != SESSION_CATALOG
