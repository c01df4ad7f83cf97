"""Batch scans of file directories."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.naming import quote


def read_parquet(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    merge_schema: bool = True,
    **options: object,
) -> DataFrame:
    """Parquet files under ``path``, with the columns of all files; null where a file lacks one.

    Unless ``schema`` is given, one job reads the footers of all files and merges their schemas.
    ``merge_schema=False`` takes the columns of a single footer instead, which is right only where
    all files are known to agree. A column that is ``int`` in one file and ``bigint`` in another
    cannot be merged; a given schema with ``bigint`` reads both. ``options`` go to Spark's reader.
    """
    reader = spark.read.options(**options)
    if schema is not None:
        return reader.schema(schema).parquet(path)
    return reader.option("mergeSchema", merge_schema).parquet(path)


# The column in which Spark's reader leaves a line that does not fit.
REJECTED = "_rejected_line"


class CsvRows(NamedTuple):
    """The rows of CSV files, and in the column ``line`` the raw lines that give none."""

    rows: DataFrame
    rejected: DataFrame


def read_csv(
    spark: SparkSession, path: str, schema: StructType, *, strict: bool = False, **options: object
) -> DataFrame:
    """CSV files with a header row under ``path``.

    The schema is required: inferring it would read all files once more. The header is
    checked against it (``enforceSchema=False``), so columns delivered in another order
    fail instead of being swapped silently. An empty field is null; text such as ``N/A``
    stays text. ``options`` are passed to Spark's CSV reader.

    A line that does not fit, with a field that is not of its type or with more or fewer fields than
    the schema, ends the job if ``strict``; the error shows it. Otherwise a field of another type is
    null and further fields vanish, unseen: :func:`split_csv` keeps such lines apart.
    """
    if strict:
        lines = _csv_lines(spark, path, schema, options)
        line = F.col(REJECTED)
        message = F.concat(F.lit("a CSV line does not fit the schema: "), line)
        # Always true, but not foreseeable for Spark, which therefore keeps later filters behind this one:
        # a join asks for keys that are not null, and would drop a line whose key does not fit unseen.
        fits = F.when(line.isNull(), F.monotonically_increasing_id() >= 0).otherwise(F.raise_error(message).cast("boolean"))
        return lines.filter(fits).drop(REJECTED)
    settings = {"header": True, "enforceSchema": False} | options
    return spark.read.schema(schema).options(**settings).csv(path)


def split_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    metrics: Observation | None = None,
    **options: object,
) -> CsvRows:
    """The rows of CSV files that fit ``schema``, and the raw lines that do not, as they stand.

    Every line under the header is in one of the two, whichever columns are used later. Each result
    reads the files by itself; ``metrics`` counts all lines (``rows``) and the rejected ones
    (``rejected``) while the first is read. Files are read as by :func:`read_csv`.
    """
    lines = _csv_lines(spark, path, schema, options)
    line = F.col(REJECTED)
    counted = lines
    if metrics is not None:
        counted = lines.observe(
            metrics, F.count(F.lit(1)).alias("rows"), F.count_if(line.isNotNull()).alias("rejected")
        )
    rejected = lines.filter(line.isNotNull()).select(line.alias("line"))
    return CsvRows(counted.filter(line.isNull()).drop(REJECTED), rejected)


def _csv_lines(spark: SparkSession, path: str, schema: StructType, options: Mapping[str, object]) -> DataFrame:
    """Columns of ``schema`` and the raw line of each record that does not fit it."""
    taken = {"mode", "columnnameofcorruptrecord"} & {name.lower() for name in options}
    if taken:
        raise ValueError(f"these options decide what becomes of odd lines and are not taken: {sorted(taken)}")
    settings = {"header": True, "enforceSchema": False, "columnNameOfCorruptRecord": REJECTED} | options
    # Lines are judged by all their fields, also where the query uses few.
    settings["columnPruning"] = False
    wide = StructType([*schema.fields, StructField(REJECTED, StringType())])
    lines = spark.read.schema(wide).options(**settings).csv(path)
    # Spark refuses to read the raw lines alone; this test of another column is always true.
    return lines.filter(F.coalesce(F.length(F.col(quote(schema.fieldNames()[0])).cast("string")), F.lit(0)) >= 0)
