"""Joining one lookup table in one or more roles."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, functions as F

from millrace.functions.codes import lookup
from millrace.naming import quote, require_distinct

# Up to this many entries a CASE expression is as fast as a join with a table of them.
CASE_ENTRIES = 64


def join_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    *,
    fact_key: str,
    dimension_key: str,
    columns: Mapping[str, str],
    unique: bool = False,
) -> DataFrame:
    """Left-join ``dimension`` and append its ``columns`` (source name -> new name).

    A fact row with a null or unknown key keeps nulls; a key held twice by the dimension
    doubles its fact rows, unless ``unique`` asks that it end the job (see :func:`unique_keys`). Call it again with other names to
    join the same table in another role: both calls project the same columns, so Spark
    reads and broadcasts the dimension once.

    No join hint is given. Spark broadcasts the dimension only while it estimates its size
    under ``spark.sql.autoBroadcastJoinThreshold``; beyond that the join shuffles both
    sides, and adaptive execution splits a partition swollen by one hot or null key
    (``spark.sql.adaptive.skewJoin.enabled``); with adaptive execution off nothing splits it.
    A dimension that is itself a join is
    estimated far too large: pass it through :func:`broadcast_within`.
    """
    require_distinct((*fact.columns, *columns.values()), "joining a dimension")
    taken = {name.lower() for name in (*fact.columns, *columns.values())}
    key = f"{dimension_key}_joined"
    while key.lower() in taken:
        key += "_"
    if unique:
        # The same columns in the same order for every role, so that Spark does it once.
        dimension = unique_keys(dimension.select(*[F.col(quote(c)) for c in dict.fromkeys([dimension_key, *columns])]), dimension_key)
    role = dimension.select(
        F.col(quote(dimension_key)).alias(key),
        *[F.col(quote(source)).alias(target) for source, target in columns.items()],
    )
    return fact.join(role, F.col(quote(fact_key)) == F.col(quote(key)), "left").drop(key)


def unique_keys(dimension: DataFrame, key: str, *, newest_by: str | None = None) -> DataFrame:
    """``dimension`` with each key once; rows without a key go, as nothing joins them.

    A key that occurs again ends the job that uses the result, with the key in the error: the check
    is part of the plan and needs no job of its own. With ``newest_by`` the row with the largest
    value of that column stays instead; of equals the one whose other columns are the largest, in
    their order, so that reruns agree (all columns must be comparable, which maps are not; nulls
    come first).

    Rows of a key meet in one partial aggregation, so a hot key is counted where it is read. Spark
    still broadcasts a result it estimates as small; beyond that the rows are already dealt by key,
    and the join adds no second shuffle on this side.
    """
    others = [c for c in dimension.columns if c.lower() != key.lower()]
    present = dimension.filter(F.col(quote(key)).isNotNull())
    if newest_by is not None:
        order = [newest_by, *[c for c in others if c.lower() != newest_by.lower()]]
        newest = F.max(F.struct(*[F.col(quote(c)).alias(f"c{k}") for k, c in enumerate(order)]))
        kept = present.groupBy(quote(key)).agg(newest.alias("kept_row"))
        fields = {c.lower(): F.col(f"kept_row.c{k}") for k, c in enumerate(order)}
    else:
        row = F.first(F.struct(*[F.col(quote(c)).alias(f"c{k}") for k, c in enumerate(others)], F.lit(0).alias("c")))
        kept = present.groupBy(quote(key)).agg(row.alias("kept_row"), F.count(F.lit(1)).alias("kept_of"))
        message = F.concat(F.lit(f"the dimension holds this {key} more than once: "), F.col(quote(key)).cast("string"))
        once = F.when(F.col("kept_of") == 1, True).otherwise(F.raise_error(message).cast("boolean"))
        kept = kept.filter(once)
        fields = {c.lower(): F.col(f"kept_row.c{k}") for k, c in enumerate(others)}
    return kept.select(*[fields[c.lower()].alias(c) if c.lower() in fields else F.col(quote(c)) for c in dimension.columns])


def broadcast_within(dimension: DataFrame, limit_bytes: int = 32 * 1024**2) -> DataFrame:
    """``dimension``, marked for broadcast if its rows take at most ``limit_bytes``.

    Where Spark's own estimate fits, that is enough. Else the rows are measured by running
    ``dimension`` once, as a distributed sum. That pays off for a computed dimension: Spark
    multiplies the sizes of joined tables, so two small ones may look too large to broadcast,
    and the whole fact table would be shuffled for them. A larger dimension is returned as it
    is, and so is any while ``spark.sql.autoBroadcastJoinThreshold`` is -1, which forbids
    broadcasts. Select the needed columns first. A stream cannot be measured and is refused.
    """
    if dimension.isStreaming:
        raise ValueError("a stream has no size to measure: broadcast_within takes static dimensions")
    if dimension.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return dimension
    if _estimate(dimension) > limit_bytes and _measured(dimension) > limit_bytes:
        return dimension
    return F.broadcast(dimension)


def _estimate(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _measured(df: DataFrame) -> int:
    # Text of a row, plus a word for each field and for the row itself.
    text = F.octet_length(F.to_json(F.struct(*[F.col(quote(c)) for c in df.columns])))
    return df.agg(F.sum(text + 8 * (len(df.columns) + 1))).first()[0] or 0


def duplicate_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows; empty when it is safe to join."""
    return (
        dimension.filter(F.col(quote(key)).isNotNull())
        .groupBy(quote(key))
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def label_codes(
    df: DataFrame,
    code: str,
    mapping: Mapping[Any, Any],
    label: str,
    *,
    default: Any = None,
    case_entries: int = CASE_ENTRIES,
) -> DataFrame:
    """``df`` with the column ``label``: what ``mapping`` holds for ``code``, as :func:`lookup` has it.

    A CASE expression tests its entries one after the other for every row, and thousands of them
    no longer compile. Beyond ``case_entries`` the mapping becomes a table of its entries, which is
    joined: broadcast if its measured size fits (see :func:`broadcast_within`). Unknown codes get
    ``default``, null codes the entry under ``None`` or else ``default``, as there.
    """
    require_distinct((*df.columns, label), "labelling")
    column = F.col(quote(code))
    if len(mapping) <= case_entries:
        return df.withColumn(label, lookup(mapping, column, default))
    taken = {name.lower() for name in (*df.columns, label)}
    prefix = "entry_"
    while any(name.startswith(prefix) for name in taken):
        prefix += "_"
    key, value = f"{prefix}key", f"{prefix}value"
    entries = [(k, v) for k, v in mapping.items() if k is not None]
    table = broadcast_within(df.sparkSession.createDataFrame(entries, [key, value]))
    found = F.when(F.col(key).isNotNull(), F.col(value))
    if None in mapping:
        found = found.when(column.isNull(), F.lit(mapping[None]))
    if default is not None:
        found = found.otherwise(F.lit(default))
    joined = df.join(table, column == F.col(key), "left")
    return joined.select(*[F.col(quote(c)) for c in df.columns], found.alias(label))
