"""Rows with columns of any names and types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def every(df: DataFrame) -> list[Column]:
    """All columns, whatever signs their names hold."""
    return [F.col(quoted(c)) for c in df.columns]


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row; columns that hold maps or variants are hashed as text."""
    kinds = [f.dataType for f in df.schema.fields]
    return F.xxhash64(*(c if _hashable(k) else c.cast("string") for c, k in zip(every(df), kinds, strict=True)))


def luck(name: str, *columns: str) -> Column:
    """A number from 0 up to 1 that follows from the columns, as fine as a double."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(name), *columns), 11) / F.lit(float(1 << 53))
