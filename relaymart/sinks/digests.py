"""Row counts and content hashes that do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns) -> Column:
    """A 64-bit hash of the named columns, in name order, as an exact decimal."""
    return F.xxhash64(*[F.col(c) for c in sorted(columns)]).cast("decimal(38,0)")


def digest_columns(columns, where: Column | None = None, prefix: str = "") -> list[Column]:
    """Aggregates ``n`` and ``content`` (the sum of the rows' hashes) over the
    rows that meet ``where``. Repeated rows count each time."""
    h = row_hash(columns)
    one = F.lit(1)
    if where is not None:
        h, one = F.when(where, h), F.when(where, one)
    return [F.count(one).alias(f"{prefix}n"), F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).alias(f"{prefix}content")]


def digest(df: DataFrame) -> tuple[int, int]:
    """(rows, content) of a whole DataFrame, in one pass."""
    row = df.agg(*digest_columns(df.columns)).first()
    return row.n, int(row.content)
