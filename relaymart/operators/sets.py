"""Set operators: UNION ALL by column name, and the per-property union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL (no dedup) matched by column name, so a branch whose
    columns are listed in another order cannot silently shift values."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def combine_properties(
    exports: Mapping[int, DataFrame],
    start_date: str,
    date_column: str = "event_date",
) -> DataFrame:
    """Combine per-property event exports into one dataset.

    Each export gets a literal ``property_id`` column and keeps only rows on
    or after ``start_date`` (given as ``YYYYMMDD`` or ``YYYY-MM-DD``). The
    date predicate sits on each branch, so on partitioned exports it prunes
    partitions at the scan.
    """
    start = start_date if "-" in start_date else (
        f"{start_date[:4]}-{start_date[4:6]}-{start_date[6:]}")
    branches = [
        df.filter(F.col(date_column) >= F.lit(start).cast("date"))
        .withColumn("property_id", F.lit(pid).cast("bigint"))
        for pid, df in exports.items()
    ]
    return union_all(branches)
