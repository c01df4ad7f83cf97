"""Quoting of column and table names."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

_PART = re.compile(r"`((?:[^`]|``)+)`|([^.`]+)")


def quote(*parts: str) -> str:
    """Back-quoted dotted reference, so that names may contain dots or spaces."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def name_parts(identifier: str) -> list[str]:
    """Parts of a possibly back-quoted table identifier."""
    return [
        quoted.replace("``", "`") if quoted else plain
        for quoted, plain in _PART.findall(identifier)
    ]


def quote_table(identifier: str) -> str:
    """A table identifier with each part back-quoted."""
    return quote(*name_parts(identifier))


def literal(text: str) -> str:
    """``text`` for use inside a quoted SQL string."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def require_distinct(names: Iterable[str], what: str) -> None:
    """Raise if two names are equal under Spark's case-insensitive resolution."""
    repeated = sorted(n for n, k in Counter(n.lower() for n in names).items() if k > 1)
    if repeated:
        raise ValueError(f"{what} would repeat these column names: {', '.join(repeated)}")
