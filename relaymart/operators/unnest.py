"""Lateral unnest of an array column (``cross join unnest(arr) as r``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_not_null(df: DataFrame, array_col: str, alias: str) -> DataFrame:
    """One row per non-NULL element of ``array_col``, exposed as ``alias``.

    A NULL or empty array gives no rows; NULL elements are dropped. The
    explode is a narrow (per-row) generator: no shuffle, and the NOT NULL
    filter runs in the same codegen stage.
    """
    return (
        df.select("*", F.explode(array_col).alias(alias))
        .filter(F.col(alias).isNotNull())
        .drop(array_col)
    )
