"""Batch enrichment of a fact table: labels, event date, dimension roles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from millrace.functions import lookup
from millrace.naming import quote, quote_table, require_distinct
from millrace.operators import join_dimension, label_codes
from millrace.operators.dimension import CASE_ENTRIES
from millrace.sources.files import read_csv, read_parquet, split_csv
from millrace.sources.tables import replace_partitions, replace_table


class Role(NamedTuple):
    """One use of a dimension: the fact's key, and dimension column -> output name."""

    fact_key: str
    columns: Mapping[str, str]


class Labels(NamedTuple):
    """One coded column: its name, the name of its label, and code -> label."""

    code: str
    label: str
    mapping: Mapping[Any, Any]


def enrich(
    facts: DataFrame,
    dimension: DataFrame,
    *,
    dimension_key: str,
    roles: Sequence[Role],
    labels: Sequence[Labels] = (),
    event_time: str | None = None,
    date_column: str = "event_date",
    unique: bool = False,
) -> DataFrame:
    """``facts`` with codes replaced by labels, an event date, and the dimension's columns.

    Output: the facts without the coded columns, then the labels, the date, and the columns
    of each role in order. All facts are kept. A zoned ``event_time`` is cut to a date in
    the session time zone; text that is no date gives a null date instead of ending the job.
    Codes in a text column are compared as text with the keys of their mapping.

    Labels and date are made after the joins, so that what a join shuffles are the short codes.
    Mappings of many entries are joined, not tested one by one (see :func:`label_codes`). With
    ``unique`` a key that the dimension holds twice ends the job instead of doubling facts.
    """
    names = [part.label for part in labels] + ([] if event_time is None else [date_column])
    # A label may carry the name of a code column, as long as that code column goes away.
    coded = {part.code.lower() for part in labels}
    kept = [c for c in facts.columns if c.lower() not in coded]
    require_distinct((*kept, *names), "enriching")
    joined = [name for role in roles for name in role.columns.values()]
    require_distinct((*kept, *names, *joined), "joining a dimension")
    # Until they are decoded, codes travel under names that nothing else has.
    taken = {name.lower() for name in (*facts.columns, *names, *joined)}
    prefix = "code_"
    while any(name.startswith(prefix) for name in taken):
        prefix += "_"
    travelling = [F.col(quote(part.code)).alias(f"{prefix}{k}") for k, part in enumerate(labels)]
    time = [] if event_time is None else [F.col(quote(event_time)).alias(f"{prefix}time")]
    types = {c.lower(): kind for c, kind in facts.dtypes}
    result = facts.select(*[F.col(quote(c)) for c in kept], *travelling, *time)
    for role in roles:
        result = join_dimension(
            result,
            dimension,
            fact_key=role.fact_key,
            dimension_key=dimension_key,
            columns=role.columns,
            unique=unique,
        )
    added = []
    for k, part in enumerate(labels):
        mapping = part.mapping
        if types[part.code.lower()] == "string":
            mapping = {key if key is None else str(key): value for key, value in mapping.items()}
        if len(mapping) > CASE_ENTRIES:
            result = label_codes(result, f"{prefix}{k}", mapping, f"{prefix}{k}_label")
            added.append(F.col(f"{prefix}{k}_label").alias(part.label))
        else:
            added.append(lookup(mapping, F.col(f"{prefix}{k}")).alias(part.label))
    if event_time is not None:
        added.append(F.try_to_date(F.col(f"{prefix}time")).alias(date_column))
    return result.select(
        *[F.col(quote(c)) for c in kept], *added, *[F.col(quote(c)) for c in joined]
    )


# Column names of the trip and zone inputs and of the enriched output.
TRIP_LABELS = {
    "VendorID": "vendorName",
    "RatecodeID": "rateCodeName",
    "payment_type": "paymentMethod",
    "store_and_fwd_flag": "storeFwd",
}
TRIP_TIME = "tpep_pickup_datetime"
TRIP_DATE = "cobdate"
ZONE_KEY = "LocationID"
ZONE_SCHEMA = StructType(
    [
        StructField("LocationID", IntegerType()),
        StructField("Borough", StringType()),
        StructField("Zone", StringType()),
        StructField("service_zone", StringType()),
    ]
)
ZONE_ROLES = (
    Role(
        "PULocationID",
        {
            "Borough": "Pickup_Borough",
            "Zone": "Pickup_Zone",
            "service_zone": "Pickup_Service_Zone",
        },
    ),
    Role(
        "DOLocationID",
        {
            "Borough": "DropOff_Borough",
            "Zone": "DropOff_Zone",
            "service_zone": "DropOff_Service_Zone",
        },
    ),
)


def enrich_trips(
    trips: DataFrame,
    zones: DataFrame,
    mappings: Mapping[str, Mapping[Any, Any]],
    *,
    unique: bool = False,
) -> DataFrame:
    """Taxi trips with vendor, rate, payment and store labels, date, and both zones.

    ``mappings`` holds one code dictionary per coded column, under the column's name; ``unique`` is
    that of :func:`enrich`.
    """
    return enrich(
        trips,
        zones,
        dimension_key=ZONE_KEY,
        roles=ZONE_ROLES,
        labels=[Labels(code, label, mappings[code]) for code, label in TRIP_LABELS.items()],
        event_time=TRIP_TIME,
        date_column=TRIP_DATE,
        unique=unique,
    )


def load_trips(
    spark: SparkSession,
    trips_path: str,
    zones_path: str,
    table: str,
    mappings: Mapping[str, Mapping[Any, Any]],
    *,
    fmt: str = "parquet",
    schema: StructType | None = None,
    csv_options: Mapping[str, object] | None = None,
    zone_rejects: str | None = None,
    unique: bool = False,
    reload_dates: bool = False,
) -> int:
    """Replace ``table``, partitioned by date, with the enriched trips; rows written.

    Columns that only some months have are kept, null in the others; ``schema`` reads months
    whose types differ. ``csv_options`` are passed to the reader of the zones.

    A line of the zones that does not fit ends the job before anything is written, as its zone would
    match no trip; with ``zone_rejects`` such lines replace that table, and the job goes on without
    them. ``unique`` ends the job at a zone that is there twice. With ``reload_dates`` an existing
    table keeps all dates that the trips do not have (see :func:`replace_partitions`).
    """
    trips = read_parquet(spark, trips_path, schema)
    options = csv_options or {}
    if zone_rejects is None:
        zones = read_csv(spark, zones_path, ZONE_SCHEMA, strict=True, **options)
    else:
        zones, rejected = split_csv(spark, zones_path, ZONE_SCHEMA, **options)
        replace_table(rejected, zone_rejects, fmt=fmt)
    enriched = enrich_trips(trips, zones, mappings, unique=unique)
    if reload_dates and spark.catalog.tableExists(quote_table(table)):
        return replace_partitions(enriched, table)
    return replace_table(enriched, table, partition_by=TRIP_DATE, fmt=fmt)
