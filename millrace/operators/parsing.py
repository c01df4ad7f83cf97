"""Semi-structured text to typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from millrace.naming import quote, require_distinct


def parse_json(
    df: DataFrame,
    column: str,
    schema: StructType,
    *,
    keep: tuple[str, ...] = (),
    fields: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parse the JSON text in ``column`` and return ``keep`` plus the fields of ``schema``.

    Unusable text (null, malformed, not an object) gives a row whose fields are all null,
    a field of the wrong type becomes null alone, and unknown fields are ignored. Field
    names are matched case-sensitively.

    The fields come out of a one-element ``inline``, not of a projection. Catalyst pushes a
    filter on a projected field below the projection together with a second ``from_json``,
    and then parses each surviving text twice; it cannot do that through a generator, so
    every text is parsed exactly once whatever the query does with the fields later. Nor can it
    see through it which fields are used: name those of ``schema`` that are wanted in ``fields``,
    and only they are parsed, in the order of the schema.
    """
    if fields is not None:
        unknown = set(fields) - set(schema.fieldNames())
        if unknown:
            raise ValueError(f"not in the schema: {sorted(unknown)}")
        schema = StructType([f for f in schema.fields if f.name in fields])
    require_distinct((*keep, *schema.fieldNames()), "parsing")
    record = F.from_json(F.col(quote(column)), schema, dict(options or {}))
    return df.select(*[F.col(quote(name)) for name in keep], F.inline(F.array(record)))
