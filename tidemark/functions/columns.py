"""Column helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fresh(taken: Iterable[str], base: str) -> str:
    """A column name that is not taken (names compare without case, as Spark's do)."""
    low = {x.lower() for x in taken}
    name, n = base, 0
    while name.lower() in low:
        n += 1
        name = f"{base}_{n}"
    return name


def fresh_prefix(taken: Iterable[str], base: str) -> str:
    """A prefix that no taken name starts with."""
    low = {x.lower() for x in taken}
    prefix, n = base + "_", 0
    while any(x.startswith(prefix) for x in low):
        n += 1
        prefix = f"{base}{n}_"
    return prefix


def c(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.NullType))


def tie_break(df: DataFrame, used: Iterable[str] = ()) -> list[Column]:
    """An order over all other columns, so that rows equal in it are equal altogether."""
    used = set(used)
    out = []
    for f in df.schema.fields:
        if f.name in used or isinstance(f.dataType, T.NullType):
            continue
        out.append((c(f.name) if _orderable(f.dataType) else F.to_json(F.struct(c(f.name)))).asc_nulls_last())
    return out


def as_timestamp(df: DataFrame, *names: str) -> DataFrame:
    """Times without zone read as UTC-session timestamps."""
    return df.withColumns({n: c(n).cast("timestamp") for n in names if n in df.columns and df.schema[n].dataType == T.TimestampNTZType()})
