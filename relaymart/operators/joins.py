"""Join operators used by the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def anti_join_existing(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    right_filter: Column | None = None,
) -> DataFrame:
    """Rows of ``left`` with no row in ``right`` (optionally filtered) on the
    equality of ``keys``: a correlated ``NOT EXISTS``.

    NULL keys never match, so such left rows are kept. The right side is
    reduced to its distinct key tuples first; the partial aggregate runs
    map-side and hash-partitions by the same keys the anti join needs, so a
    hot key costs one row instead of its whole duplicate run, and no extra
    shuffle is added.
    """
    r = right.filter(right_filter) if right_filter is not None else right
    r = r.select(*keys).dropDuplicates()
    return left.join(r, list(keys), "left_anti")


def lookup_join(fact: DataFrame, dim: DataFrame, keys: Sequence[str],
                dim_columns: Sequence[str]) -> DataFrame:
    """Left equi join of a fact to a dimension unique on ``keys``.

    Only the key and the wanted columns of the dimension enter the join
    (column pruning reaches the scan). The physical strategy is left to AQE:
    it broadcasts the dimension when its *measured* shuffle size is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps a
    sort-merge join, splitting a skewed fact partition (a hot key) via
    ``spark.sql.adaptive.skewJoin``. Dimensions grow with the data, so they
    are never broadcast on a static guess.
    """
    d = dim.select(*keys, *[c for c in dim_columns if c not in keys])
    return fact.join(d, list(keys), "left")
