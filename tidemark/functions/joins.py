"""Join sides whose size is checked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c

#: Rows and bytes of a narrow key table that every executor can hold.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 * 1024 * 1024


def is_small(keys: DataFrame, rows: int | None = None) -> bool:
    """Whether a table has at most so many rows and bytes; it is counted no further."""
    rows = BROADCAST_ROWS if rows is None else rows
    wide = [F.coalesce(F.octet_length(c(f.name)), F.lit(0)) for f in keys.schema.fields if f.dataType.typeName() in ("string", "binary")]
    size = reduce(lambda a, b: a + b, wide, F.lit(8 * len(keys.columns)))
    n, total = keys.limit(rows + 1).agg(F.count("*"), F.sum(size)).first()
    return n <= rows and (total or 0) <= BROADCAST_BYTES


def checked_broadcast(keys: DataFrame, rows: int | None = None) -> DataFrame:
    """The table marked for broadcast if it is counted small; as it is otherwise, for a shuffle join with skew handling."""
    return F.broadcast(keys) if is_small(keys, rows) else keys
