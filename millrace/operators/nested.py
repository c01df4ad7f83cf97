"""Structs to columns, arrays to rows."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from millrace.naming import quote, require_distinct


class _Leaf(NamedTuple):
    """One non-struct position of a schema: how to read it and what to call it."""

    path: tuple[str, ...]
    name: str
    dtype: DataType

    @property
    def column(self) -> Column:
        return F.col(quote(*self.path)).alias(self.name)


def _leaves(dtype: DataType, path: tuple[str, ...], name: str) -> Iterator[_Leaf]:
    if isinstance(dtype, StructType):
        for field in dtype.fields:
            yield from _leaves(field.dataType, (*path, field.name), f"{name}_{field.name}")
    else:
        yield _Leaf(path, name, dtype)


def _layout(df: DataFrame) -> list[_Leaf]:
    leaves = [leaf for f in df.schema.fields for leaf in _leaves(f.dataType, (f.name,), f.name)]
    require_distinct((leaf.name for leaf in leaves), "flattening")
    return leaves


def flatten(df: DataFrame) -> DataFrame:
    """Replace every struct by its fields, at all depths, in one projection.

    ``a.b.c`` becomes ``a_b_c`` at the position of ``a``; a null struct gives null fields.
    Arrays and maps are left alone. Raises ``ValueError`` if two results share a name.
    """
    return df.select(*[leaf.column for leaf in _layout(df)])


def explode_arrays(df: DataFrame) -> DataFrame:
    """Flatten ``df`` and turn every array, at all depths, into rows.

    An empty or null array keeps its row with a null value. Several arrays in a row give
    their cross product. Arrays inside structs, structs inside arrays and arrays of arrays
    are all followed; map columns pass through. Names follow :func:`flatten`.

    The whole sequence is planned from the schema: one ``select`` with one generator per
    array, each also unpacking the structs the previous one produced. Rows are generated
    one by one, so neither long arrays nor large products build up in memory.
    """
    leaves = _layout(df)
    while True:
        target = next((leaf for leaf in leaves if isinstance(leaf.dtype, ArrayType)), None)
        if target is None:
            return df.select(*[leaf.column for leaf in leaves])
        df = df.select(
            *[
                F.explode_outer(quote(*leaf.path)).alias(leaf.name) if leaf is target else leaf.column
                for leaf in leaves
            ]
        )
        leaves = [
            after
            for leaf in leaves
            for after in _leaves(
                leaf.dtype.elementType if leaf is target else leaf.dtype, (leaf.name,), leaf.name
            )
        ]
        require_distinct((leaf.name for leaf in leaves), "exploding")
