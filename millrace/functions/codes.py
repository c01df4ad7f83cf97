"""Decoding of coded columns."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, functions as F


def lookup(mapping: Mapping[Any, Any], code: Column, default: Any = None) -> Column:
    """Label of ``code`` under ``mapping``; ``default`` (null) for anything else.

    The result is one CASE expression, so it stays inside whole-stage codegen and the
    comparison follows Spark's usual type widening: an ``int`` dictionary also decodes
    ``bigint`` and ``double`` codes, and a code outside the key type's range is simply
    unmatched (indexing a literal map would cast the code and overflow under ANSI mode).
    A ``None`` key gives the label of null codes.

    Text codes need text keys: Spark would cast the text to the type of a number key, and one
    code that is no number would end the job.

    Meant for dictionaries that fit in the query text. A dictionary that lives in a table
    is a dimension: use :func:`millrace.operators.join_dimension`.
    """
    label = None
    for key, value in mapping.items():
        matches = code.isNull() if key is None else code == F.lit(key)
        label = F.when(matches, F.lit(value)) if label is None else label.when(matches, F.lit(value))
    if label is None:
        return F.lit(default).cast("string") if default is None else F.lit(default)
    return label if default is None else label.otherwise(F.lit(default))
