"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bytes_to_text(value: Column) -> Column:
    """UTF-8 text of a binary message payload."""
    return value.cast("string")


def strip_whitespace(text: Column) -> Column:
    r"""``text`` without any whitespace, including spaces inside words.

    Whitespace is ``\s`` of Java regular expressions: space, tab, line feed, vertical tab,
    form feed and carriage return; other Unicode spaces stay. A single regex pass measured
    faster than ``translate`` or nested ``replace`` on JSON payloads.
    """
    return F.regexp_replace(text, r"\s+", "")
