"""Row filters and row counts."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, functions as F

from millrace.naming import quote


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of ``columns`` is null."""
    return df.filter(reduce(and_, [F.col(quote(c)).isNotNull() for c in columns]))


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """The number of rows as a one-row DataFrame (partial counts, then one final sum)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def observe_rows(df: DataFrame, metrics: str | Observation, required: str | None = None) -> DataFrame:
    """``df`` unchanged, counted while something else runs it.

    Reports ``rows`` and, with ``required``, ``missing``: how many rows have a null there.
    Pass an ``Observation`` for a batch action; pass a name for a stream and read the
    numbers from the query's progress.
    """
    counts = [F.count(F.lit(1)).alias("rows")]
    if required is not None:
        counts.append(F.count_if(F.col(quote(required)).isNull()).alias("missing"))
    return df.observe(metrics, *counts)
