"""Transactions: binary JSON messages to a flat table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from millrace.functions import bytes_to_text, strip_whitespace
from millrace.naming import quote
from millrace.operators import drop_missing, explode_arrays, observe_rows, parse_json
from millrace.sources.tables import ensure_table
from millrace.streaming.append import start_append, start_batches

# The transaction message. The time stays text.
TRANSACTION_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField(
            "buyer",
            StructType(
                [
                    StructField("buyer_id", LongType()),
                    StructField("city", StringType()),
                    StructField("name", StringType()),
                ]
            ),
        ),
        StructField(
            "seller",
            StructType(
                [StructField("platform", StringType()), StructField("seller_id", LongType())]
            ),
        ),
        StructField(
            "transaction_details",
            StructType(
                [
                    StructField("amount", DoubleType()),
                    StructField("currency", StringType()),
                    StructField("merchant", StringType()),
                    StructField("transaction_time", StringType()),
                ]
            ),
        ),
    ]
)


# The name under which a message travels beside its parsed record.
RAW = "_message"


def _records(messages: DataFrame, schema: StructType, value: str, strip: bool, *, raw: bool = False) -> DataFrame:
    """Flat records of all messages, unusable ones with nulls; with ``raw`` the message beside each."""
    text = bytes_to_text(F.col(quote(value)))
    texts = [(strip_whitespace(text) if strip else text).alias("json")]
    if raw:
        texts.append(F.col(quote(value)).alias(RAW))
    return explode_arrays(parse_json(messages.select(*texts), "json", schema, keep=(RAW,) if raw else ()))


def parse_transactions(
    messages: DataFrame,
    schema: StructType = TRANSACTION_SCHEMA,
    *,
    value: str = "value",
    required: str = "transaction_id",
    strip: bool = True,
    metrics: str | Observation | None = None,
) -> DataFrame:
    """Flat rows of the JSON messages in the binary column ``value``.

    Rows without the ``required`` column (a name after flattening) are dropped, which covers
    all unusable text; ``metrics`` counts all and dropped rows on the way: messages, or where the
    schema has arrays the rows they explode to. By default whitespace is
    removed everywhere, even inside values; ``strip=False`` keeps it. Works the same on a
    table and on a stream: one stage, no shuffle, no state. :func:`split_transactions` gives the
    dropped messages too.
    """
    records = _records(messages, schema, value, strip)
    if metrics is not None:
        records = observe_rows(records, metrics, required)
    return drop_missing(records, required)


def split_transactions(
    messages: DataFrame,
    schema: StructType = TRANSACTION_SCHEMA,
    *,
    value: str = "value",
    required: str = "transaction_id",
    strip: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`parse_transactions`, and the messages that give none of them.

    The second has the column ``value`` as it came, byte for byte, null messages included; where the
    schema has arrays, it has a message for each exploded row that is dropped. Both read ``messages``
    by themselves and parse them alike, so that every message is in one of the two.
    """
    missing = F.col(quote(required)).isNull()
    rejected = _records(messages, schema, value, strip, raw=True).filter(missing)
    rows = parse_transactions(messages, schema, value=value, required=required, strip=strip)
    return rows, rejected.select(F.col(RAW).alias(value))


def ingest_transactions(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    schema: StructType = TRANSACTION_SCHEMA,
    *,
    value: str = "value",
    required: str = "transaction_id",
    strip: bool = True,
    fmt: str = "parquet",
    every: str = "6 seconds",
    until_caught_up: bool = False,
    name: str | None = None,
    metrics: str | None = None,
    files_per_batch: int | None = None,
    shared: bool = False,
    rejects: str | None = None,
) -> StreamingQuery:
    """Append the parsed messages to ``table``, which is created if absent.

    See :func:`parse_transactions` for ``value``, ``required``, ``strip`` and ``metrics``, and
    :func:`start_append` for the rest.

    Unusable messages go to the table ``rejects`` in the same batch, byte for byte: each message is
    in one of the two tables once, after restarts too. Both are shared tables then, as with
    ``shared``: other streams, batch jobs and inserts may write into them. Streams of a v2 catalog
    deliver one table each, so there ``rejects`` is refused: start a second query on the second
    result of :func:`split_transactions`.
    """
    if rejects is not None:
        if metrics is not None:
            raise ValueError("with a table of rejects its rows are the count: metrics are not taken")

        def part(which: int) -> Callable[[DataFrame], DataFrame]:
            return lambda batch: split_transactions(batch, schema, value=value, required=required, strip=strip)[which]

        return start_batches(
            messages,
            {table: part(0), rejects: part(1)},
            checkpoint,
            fmt=fmt,
            every=every,
            until_caught_up=until_caught_up,
            name=name,
            files_per_batch=files_per_batch,
        )
    rows = parse_transactions(
        messages, schema, value=value, required=required, strip=strip, metrics=metrics
    )
    ensure_table(rows.sparkSession, table, rows.schema, fmt, shared=shared)
    return start_append(
        rows,
        table,
        checkpoint,
        fmt=fmt,
        every=every,
        until_caught_up=until_caught_up,
        name=name,
        files_per_batch=files_per_batch,
        shared=shared,
    )
