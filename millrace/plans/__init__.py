"""Complete jobs put together from the operators."""

from millrace.plans.enrichment import Labels, Role, enrich, enrich_trips, load_trips
from millrace.plans.transactions import (
    TRANSACTION_SCHEMA,
    ingest_transactions,
    parse_transactions,
    split_transactions,
)

__all__ = [
    "Labels",
    "Role",
    "TRANSACTION_SCHEMA",
    "enrich",
    "enrich_trips",
    "ingest_transactions",
    "load_trips",
    "parse_transactions",
    "split_transactions",
]
