"""Append-only streaming into a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.naming import literal, quote_table
from millrace.operators.rows import observe_rows
from millrace.sources.storage import child_names, delete_folder, full_path, move_folder, path_exists
from millrace.sources.tables import SHARED, ensure_table, holds_files, table_location

# Formats whose sink keeps its own log of files, and where it does.
LOGGED_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")
SINK_LOG = "_spark_metadata"
OWNER = "streaming.checkpoint"
# Fixed value: under which name Spark tells the jobs of a query its number.
QUERY_ID = "sql.streaming.queryId"


def start_append(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    every: str = "6 seconds",
    until_caught_up: bool = False,
    name: str | None = None,
    files_per_batch: int | None = None,
    shared: bool = False,
    **options: object,
) -> StreamingQuery:
    """Start appending ``stream`` to ``table`` and return the running query.

    A micro-batch starts ``every`` interval; with ``until_caught_up`` the query instead
    takes everything available now, in as many batches as the source's limits ask for, and
    stops. Progress is kept in ``checkpoint``, which must be on storage that all executors
    reach and belong to this query alone; starting again with it continues where the last
    run stopped. The caller waits with ``query.awaitTermination()``.

    Readers of a file table that a stream has filled see only what the stream's own log names:
    rows written there by anything else would be hidden, and batches of a second checkpoint
    skipped. Such a table therefore belongs to one checkpoint, which is noted in its properties.
    Before anything starts, ``ValueError`` is raised if the table already holds other rows, was
    fed under another checkpoint or under one that is gone, or if a batch job has written into
    it meanwhile. Tables of a v2 catalog take rows from anyone and are not checked.

    With ``shared`` a file table takes rows of several streams and of batch jobs: it keeps no such
    log, and each batch is delivered once (see :func:`start_batches`).

    Each task of a batch writes one file, so a source of a thousand partitions read every
    few seconds makes millions of small files a day. ``files_per_batch`` shuffles the
    parsed rows of a batch into that many evenly filled files instead.
    """
    if shared:
        if options:
            raise ValueError(f"a shared table takes no writer options: {sorted(options)}")
        return start_batches(
            stream,
            {table: lambda batch: batch},
            checkpoint,
            fmt=fmt,
            every=every,
            until_caught_up=until_caught_up,
            name=name,
            files_per_batch=files_per_batch,
        )
    if fmt.lower() in LOGGED_FORMATS and holds_files(stream.sparkSession, table):
        _claim(stream, table, checkpoint, fmt)
    if files_per_batch is not None:
        stream = stream.repartition(files_per_batch)
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )
    return _started(writer, name, every, until_caught_up).toTable(table)


def _claim(stream: DataFrame, table: str, checkpoint: str, fmt: str) -> None:
    """Note in the table that ``checkpoint`` feeds it, or raise if that would lose rows."""
    spark = stream.sparkSession
    ensure_table(spark, table, stream.schema, fmt)
    name = quote_table(table)
    location = table_location(spark, table)
    checkpoint = full_path(spark, checkpoint)
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key").isin(OWNER, SHARED))
    noted = {r["key"]: r["value"] for r in properties.tail(2)}
    if SHARED in noted:
        raise ValueError(f"{table} takes batches of several writers; start with shared=True")
    owner = noted.get(OWNER)
    if owner is not None:
        owner = full_path(spark, owner)
    if not path_exists(spark, f"{location}/{SINK_LOG}"):
        if not spark.table(name).isEmpty():
            raise ValueError(f"{table} holds rows that a stream's log would hide; stream into an empty table")
    elif owner is not None and owner != checkpoint:
        raise ValueError(f"{table} is fed under checkpoint {owner}; rows under another would be skipped")
    elif not path_exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{table} was fed by a stream whose checkpoint is not in {checkpoint}")
    elif path_exists(spark, f"{location}/_SUCCESS"):
        _refuse_stray_files(spark, table, location)
    if owner != checkpoint:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{OWNER}' = '{literal(checkpoint)}')")


def _refuse_stray_files(spark: SparkSession, table: str, location: str) -> None:
    """Raise if the folder of a streamed table holds files that its log does not name."""
    logged = {path.rsplit("/", 1)[-1] for path in spark.table(quote_table(table)).inputFiles()}
    there = [n for n in child_names(spark, location) if not n.startswith(("_", "."))]
    stray = [n for n in there if n not in logged]
    if stray:
        raise ValueError(
            f"a batch job wrote rows into {table} that its stream's log hides, in {len(stray)} files such as "
            f"{location}/{stray[0]}. Read them by their paths, put the rows where they belong, delete the "
            "files, and start again"
        )


# --- several writers --------------------------------------------------------------------


def append_once(df: DataFrame, table: str, writer: str, number: int, *, fmt: str = "parquet") -> int:
    """Append ``df`` to the shared ``table`` as batch ``number`` of ``writer``, unless it is there.

    Returns the rows appended. The rows are written aside, where no reader looks, and their folder
    is then moved into the table: on HDFS and local disks that happens at once, so that readers see
    the whole batch or none of it, and a run that died leaves nothing behind that counts. The
    folder's name is the record that the batch was delivered: running it again adds no row. An
    object store moves a folder by copying; prefer tables of a v2 catalog there. A batch without
    rows leaves no folder. The table must have been created with ``ensure_table(..., shared=True)``.
    """
    return _deliver(df.sparkSession, df, table, writer, number, fmt)


def _deliver(spark: SparkSession, df: DataFrame, table: str, writer: str, number: int, fmt: str) -> int:
    name = quote_table(table)
    location = table_location(spark, table)
    target = f"{location}/{writer}/{number:012d}"
    if path_exists(spark, target):
        return 0
    aside = f"{location}/_{writer}-{number}"
    written = Observation()
    observe_rows(df, written).write.format(fmt).mode("overwrite").save(aside)
    rows = written.get["rows"]
    if not rows:
        delete_folder(spark, aside)
        return 0
    move_folder(spark, aside, target)
    # Any change of the table makes this session forget which files it had.
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('append.last' = '{literal(writer)}/{number}')")
    return rows


def start_batches(
    stream: DataFrame,
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
    checkpoint: str,
    *,
    fmt: str = "parquet",
    every: str = "6 seconds",
    until_caught_up: bool = False,
    name: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start appending what each function of ``outputs`` makes of ``stream`` to its shared table.

    All tables get their part of a batch before the batch counts as done. One that is run again
    after a failure, with the same input, adds only what is missing: parts are recorded under the
    query's own number, which lies in its checkpoint, and the number of the batch. So several
    streams, batch jobs by :func:`append_once` and ordinary inserts can write into one table. A lost
    checkpoint makes another query, which reads and appends everything anew. The functions must give
    the same rows when they run again. Every function reads the batch by itself.
    """
    spark = stream.sparkSession
    for table, transform in outputs.items():
        ensure_table(spark, table, transform(stream).schema, fmt, shared=True)

    def deliver(batch: DataFrame, number: int) -> None:
        writer = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        if writer is None:
            raise ValueError("the batch does not say which query it belongs to")
        for table, transform in outputs.items():
            rows = transform(batch)
            if files_per_batch is not None:
                rows = rows.repartition(files_per_batch)
            _deliver(spark, rows, table, writer, number, fmt)

    writer = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return _started(writer, name, every, until_caught_up).start()


def _started(
    writer: DataStreamWriter, name: str | None, every: str, until_caught_up: bool
) -> DataStreamWriter:
    if name is not None:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True) if until_caught_up else writer.trigger(processingTime=every)
