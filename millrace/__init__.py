"""Ingestion and enrichment of raw data with PySpark, in batch and as a stream."""

from millrace.functions import bytes_to_text, lookup, strip_whitespace
from millrace.operators import (
    broadcast_within,
    count_rows,
    drop_missing,
    duplicate_keys,
    explode_arrays,
    flatten,
    join_dimension,
    label_codes,
    observe_rows,
    parse_json,
    unique_keys,
)
from millrace.plans import (
    TRANSACTION_SCHEMA,
    Labels,
    Role,
    enrich,
    enrich_trips,
    ingest_transactions,
    load_trips,
    parse_transactions,
    split_transactions,
)
from millrace.streaming import append_once, start_append, start_batches

__all__ = [
    "Labels",
    "Role",
    "TRANSACTION_SCHEMA",
    "append_once",
    "broadcast_within",
    "bytes_to_text",
    "count_rows",
    "drop_missing",
    "duplicate_keys",
    "enrich",
    "enrich_trips",
    "explode_arrays",
    "flatten",
    "ingest_transactions",
    "join_dimension",
    "label_codes",
    "load_trips",
    "lookup",
    "observe_rows",
    "parse_json",
    "parse_transactions",
    "split_transactions",
    "start_append",
    "start_batches",
    "strip_whitespace",
    "unique_keys",
]
