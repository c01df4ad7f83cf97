"""Unbounded sources."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.sources.storage import path_exists, renew_file

# Where in a checkpoint the start of its file stream is noted.
START_NOTE = "_starting"


def read_stream(
    spark: SparkSession,
    source: str,
    *,
    path: str | None = None,
    schema: StructType | None = None,
    **options: object,
) -> DataFrame:
    """Streaming DataFrame from any installed source; ``options`` go to that source."""
    reader = spark.readStream.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    **options: object,
) -> DataFrame:
    """Messages of one Kafka topic (needs Spark's Kafka connector on the class path).

    ``starting_offsets`` counts only for a query without a checkpoint. For a topic with one
    hot partition pass ``minPartitions``, which splits it over several tasks; to bound a
    batch after an outage pass ``maxOffsetsPerTrigger``.
    """
    return read_stream(
        spark,
        "kafka",
        **{
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "startingOffsets": starting_offsets,
        }
        | options,
    )


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    source: str = "parquet",
    *,
    max_file_age: str | None = None,
    finished: str | None = None,
    starting: str | datetime | None = None,
    checkpoint: str | None = None,
    **options: object,
) -> DataFrame:
    """Files that land under ``path``, each read once, however old they look.

    Spark ignores files whose time of change lies ``max_file_age`` and more before the newest
    one seen, 7 days if it is not told otherwise; a copy that keeps times may look that old. Without
    ``finished`` the default here is 100 years, which keeps every file, and for which the driver
    remembers each path.

    ``finished`` clears files away once the batch that took them is committed: ``"delete"`` removes
    them, and any other value is the folder they are moved to, which must lie outside ``path``. The
    driver then forgets a path after ``max_file_age`` (7 days here), so that what it remembers does
    not grow with the stream's life. Nothing is taken twice: a file that outlives its batch, as after
    a crash, is too old by then. Files that landed looking too old are taken up by
    :func:`renew_passed_files`. The folder must be read by this query alone. The files of a run's
    last batch are cleared by the first batch of the next run.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound the first batch when the
    directory already holds a backlog.

    ``starting`` says with which files a new query begins: ``"earliest"``, all; ``"latest"``, those
    changed from now on, by the driver's clock; or a time. It is noted in ``checkpoint``, the folder
    of the query that will read the stream, and counts only there once: when the query starts
    again, or its checkpoint holds progress already, the note holds, whatever ``starting`` says.
    A file that lands later with an older time of change, such as a copy that keeps times, is
    skipped. Skipped files are listed, but not opened.
    """
    if (starting is None) != (checkpoint is None):
        raise ValueError("a starting position and the query's checkpoint go together")
    settings = {"maxFileAge": max_file_age or ("36500d" if finished is None else "7d")}
    if finished == "delete":
        settings["cleanSource"] = "delete"
    elif finished is not None:
        settings |= {"cleanSource": "archive", "sourceArchiveDir": finished}
    rows = read_stream(spark, source, path=path, schema=schema, **settings | options)
    since = 0 if starting is None else _noted_start(spark, starting, checkpoint)
    if not since:
        return rows
    return rows.where(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(since)))


def _noted_start(spark: SparkSession, starting: str | datetime, checkpoint: str) -> int:
    """Milliseconds since 1970 from which on a query reads files, noted if that was not yet done."""
    if isinstance(starting, datetime):
        since = int(starting.timestamp() * 1000)
    elif starting in ("earliest", "latest"):
        since = 0 if starting == "earliest" else int(time.time() * 1000)
    else:
        raise ValueError(f"no starting position: {starting!r}")
    note, schema = f"{checkpoint}/{START_NOTE}", "since long"
    # A note without a row is one whose writing was interrupted.
    noted = spark.read.schema(schema).parquet(note).first() if path_exists(spark, note) else None
    if noted is not None:
        return noted["since"]
    if path_exists(spark, f"{checkpoint}/offsets"):
        since = 0
    spark.createDataFrame([(since,)], schema).write.mode("overwrite").parquet(note)
    return since


def renew_passed_files(spark: SparkSession, path: str, checkpoint: str, *, number: int = 0) -> int:
    """Give files that a query has passed over the present time, so that it takes them; returns how many.

    These are the files under ``path`` that the query's log does not name and that are older than the
    newest one it names. Call it while the query does not run. ``number`` tells its sources apart, if
    it has several. Files that were taken are left alone, also where they still lie in the folder.

    It needs a file system whose times can be set, such as HDFS. On an object store a file has the
    time at which it landed, so none looks old.
    """
    log = f"{checkpoint}/sources/{number}"
    if not path_exists(spark, log):
        return 0
    entry = F.from_json("value", "path string, timestamp long")
    taken = spark.read.text(log).where("value LIKE '{%'").select(entry.alias("file")).select("file.*")
    newest = taken.agg(F.max("timestamp")).first()[0]
    # The log has encoded addresses, a listing plain ones.
    named = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    lying = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    passed = (
        lying.where(F.col("modificationTime") < F.timestamp_millis(F.lit(newest)))
        .select("path", _address(F.col("path")).alias("address"))
        .join(taken.select(_address(named).alias("address")), "address", "left_anti")
    )
    renewed = 0
    for row in passed.select("path").toLocalIterator():
        renew_file(spark, row["path"])
        renewed += 1
    return renewed


def _address(path: Column) -> Column:
    """One spelling for local files, which have one slash or three."""
    return F.regexp_replace(path, "^file:/+", "file:/")
