"""Date spines and day-by-day running state.

The reference states daily subscription status as a range join (every
subscriber x every day on or after its first event) followed by a join of
each subscriber-day to *all* earlier events. That emits every
(day, earlier event) pair of a subscriber and plans as nested-loop joins.
Here the same answer comes from (:func:`daily_state_from_changes`):

1. events reduced to one row per (key, day) with partial aggregation, so a
   hot key is cut down to one row per active day before it is shuffled;
2. one window per key, ordered by day, over those change rows only: running
   aggregates before / through each change day and the next change day;
3. each change row generates its own days up to the next change with a
   narrow ``explode(sequence(...))`` - no spine table, no join.

Two exchanges in all: (key, day) for the aggregate, key for the window. Per
key the window holds at most one row per active day, whatever the number of
its events, so neither skew nor event volume can blow a task up; the
expansion to every day happens after the sort, in the generator.

:func:`per_key_spine` is the plain per-key day spine (``explode`` of a
guarded ``sequence``), kept for callers that need the spine itself.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaymart.functions.columns import date_range


def date_spine(first_day: Column, last_day: Column | str) -> Column:
    """Inclusive array of days; empty when first > last, NULL on NULL."""
    last = F.lit(last_day).cast("date") if isinstance(last_day, str) else last_day
    return date_range(first_day, last)


def per_key_spine(
    firsts: DataFrame, key: str, first_col: str, as_of: str, day_col: str = "date_day",
    keep_empty: bool = True,
) -> DataFrame:
    """One row per key and day from its first day to ``as_of``.

    With ``keep_empty`` a key whose range is empty (first day after
    ``as_of``) or NULL still yields one row with a NULL day, like a left
    range join that matched nothing."""
    days = date_spine(F.col(first_col), as_of)
    gen = F.explode_outer if keep_empty else F.explode
    if keep_empty:
        days = F.coalesce(days, F.array().cast("array<date>"))
    return firsts.select(key, gen(days).alias(day_col))


def daily_state_from_changes(
    day_rows: DataFrame,
    key: str,
    day_col: str,
    metrics: Mapping[str, str],
    as_of: str,
    start: str | None = None,
) -> DataFrame:
    """Expand per-(key, day) change rows into one row per key and day, from
    the key's first day to ``as_of``, carrying running aggregates.

    ``day_rows`` holds at most one row per (key, day) with one column per
    metric (``metrics[name]`` in {'max', 'min'}). For every generated day
    ``d`` the result has, per metric ``m``:

    * ``m``        - the value of day ``d`` itself (NULL when it had no row);
    * ``m_before`` - the running aggregate over all days strictly before ``d``.

    A key whose first day is after ``as_of`` yields one row with a NULL day
    and NULL metrics (what a left range join that matched nothing gives).

    ``start``: only days from it on are generated; earlier change rows (such as
    one of :func:`state_through` a key) only carry their aggregates on.

    Plan: one window over the change rows (partitioned by ``key``, ordered
    by day) computes, per change row, the aggregates before it, through it,
    and the next change day; each row then generates its own days up to the
    next change (``explode(sequence(...))``). So the sort/window only sees
    change rows, gap days are produced by a narrow generator, and no spine
    table or join is needed.
    """
    aggs = {"max": F.max, "min": F.min}
    end = F.lit(as_of).cast("date")
    w = Window.partitionBy(key).orderBy(day_col)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    through = w.rowsBetween(Window.unboundedPreceding, 0)
    day = F.col(day_col)
    ranked = day_rows.select(
        key, day_col, *metrics.keys(),
        *[aggs[fn](m).over(before).alias(f"_{m}_before") for m, fn in metrics.items()],
        *[aggs[fn](m).over(through).alias(f"_{m}_through") for m, fn in metrics.items()],
        F.lead(day).over(w).alias("_next"),
        F.lag(day).over(w).alias("_prev"),
    )
    last = F.least(F.coalesce(F.date_sub("_next", 1), end), end)
    null_day = F.array(F.lit(None).cast("date"))
    none = F.array().cast("array<date>")
    first = day if start is None else F.greatest(day, F.lit(start).cast("date"))
    days = (
        F.when((day <= end) & (first > last), none)
        .when(day <= end, F.sequence(first, last, F.expr("interval 1 day")))
        # a NULL day never matches a day; it stands alone only for a key
        # with no dated row at all (NULLs sort first, so _next is then NULL)
        .when(day.isNull(), F.when(F.col("_next").isNull(), null_day).otherwise(none))
        # first dated row already after as_of: the one unmatched row
        .when(F.col("_prev").isNull(), null_day)
        .otherwise(none)
    )
    out = ranked.select("*", F.explode(days).alias("_d"))
    d = F.col("_d")
    on_change_day = d == day
    cols = []
    for m in metrics:
        cols.append(F.when(on_change_day, F.col(m)).alias(m))
        cols.append(
            F.when(d.isNull(), F.lit(None))
            .when(on_change_day, F.col(f"_{m}_before"))
            .otherwise(F.col(f"_{m}_through")).alias(f"{m}_before"))
    return out.select(key, d.alias(day_col), *cols)


def state_through(day_rows: DataFrame, key: str, day_col: str, metrics: Mapping[str, str], last_day: str) -> DataFrame:
    """One change row a key for all its days up to ``last_day``: that day, with
    the aggregates through it. Keys with no dated row by then have none."""
    aggs = {"max": F.max, "min": F.min}
    return (day_rows.filter(F.col(day_col) <= F.lit(last_day).cast("date")).groupBy(key)
            .agg(*[aggs[fn](m).alias(m) for m, fn in metrics.items()])
            .select(key, F.lit(last_day).cast("date").alias(day_col), *metrics))
