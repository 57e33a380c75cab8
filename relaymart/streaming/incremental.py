"""Trailing-window incremental rebuilds (the batch answer to late data).

The marts are refreshed on a schedule; late or restated rows only touch the
last few days. ``rebuild_trailing_window`` recomputes just those day
partitions and replaces them in place (dynamic partition overwrite), leaving
every older partition untouched; days of the window that have no rows any more
are removed. A full refresh rewrites every partition, unless the table is
*protected* (its history cannot be recomputed), in which case it is still
refreshed incrementally.

``rebuild_changed_days`` does the same with a ledger beside the table: row count
and content hash of each day as last written. It rewrites only days that changed,
removes emptied ones, and reports days before the window that differ from what
was written, which a window alone leaves behind silently.

There is no Structured Streaming here: the sources are append-style tables
read in full on each run.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from relaymart.sinks import files, versions
from relaymart.sinks.digests import digest_columns

# Fixed value: days rebuilt on an incremental run.
STATIC_INCREMENTAL_DAYS = 7


def should_full_refresh(now: dt.datetime, last_full_refresh: str) -> bool:
    """Whether a scheduled run refreshes everything: the first one of a Sunday
    (UTC). ``last_full_refresh`` is the ISO date of the last, or empty."""
    today = now.astimezone(dt.timezone.utc).date()
    return today.isoweekday() == 7 and today.isoformat() != last_full_refresh


def window_days(as_of: str, days: int) -> list[dt.date]:
    last = dt.date.fromisoformat(as_of)
    return [last - dt.timedelta(days=k) for k in range(days, -1, -1)]


def rebuild_trailing_window(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    date_col: str,
    as_of: str,
    days: int = STATIC_INCREMENTAL_DAYS,
    full_refresh: bool = False,
    protected: bool = False,
) -> str:
    """Write ``rows`` into the ``date_col``-partitioned table at ``path``.

    * first run (the file system says that there is nothing at ``path``) or
      ``full_refresh`` on an unprotected table: every partition is rewritten;
    * otherwise only partitions from ``as_of - days`` to ``as_of`` are
      replaced; ``rows`` is filtered before it is computed, so the filter
      reaches the source scan. The new days are switched in by one dynamic
      overwrite; then days that were there and got no rows (counted while
      writing) are removed. A run that dies between the two leaves only such
      days behind, and the next run removes them.

    Rows are rebalanced by day before the write, so that a day has files of
    about the advisory size, whatever the number of tasks. An error of the
    file system is raised and leaves the table as it is. Returns the mode used
    ('full'|'incremental').
    """
    full = not files.exists(spark, path) or (full_refresh and not protected)
    window = window_days(as_of, days)
    if not full:
        rows = rows.filter(F.col(date_col).between(F.lit(window[0]), F.lit(window[-1])))
    found = Observation("rows_by_day")
    rows = rows.hint("rebalance", date_col)
    if not full:  # above the rebalance: a window without rows empties what is below it, counts included
        rows = rows.observe(found, *[F.count_if(F.col(date_col) == F.lit(d)).alias(d.isoformat()) for d in window])
    (rows.write.mode("overwrite")
     .option("partitionOverwriteMode", "static" if full else "dynamic")
     .option("compression", "zstd")
     .partitionBy(date_col)
     .parquet(path))
    if not full:
        empty = {f"{date_col}={day}" for day, n in found.get.items() if not n}
        for name in empty.intersection(files.names(spark, path)):
            files.remove(spark, f"{path}/{name}")
    return "full" if full else "incremental"


#: Versions of the ledger that stay.
KEEP_LEDGERS = 2
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class ChangedDays:
    """What a rebuild found, by day (None: rows without a day)."""

    mode: str  # 'full' | 'incremental'
    rewritten: list[dt.date | None] = field(default_factory=list)
    emptied: list[dt.date | None] = field(default_factory=list)
    unchanged: list[dt.date | None] = field(default_factory=list)
    #: days before the window whose rows are no longer those written: not rebuilt
    late: list[dt.date | None] = field(default_factory=list)


def _ledger_path(path: str) -> str:
    return f"{path.rstrip('/')}/_ledger"


def _by_day(rows: DataFrame, date_col: str) -> dict[dt.date | None, tuple[int, int]]:
    """Rows and content of each day; one row a day reaches the driver."""
    found = rows.groupBy(F.col(date_col).alias("day")).agg(*digest_columns(rows.columns))
    return {r.day: (r.n, int(r.content)) for r in found.collect()}


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """day, n, content as last written; None if there is no ledger yet."""
    return versions.read(spark, _ledger_path(path))


def _write_ledger(spark: SparkSession, path: str, days: dict) -> None:
    rows = spark.createDataFrame([(d, n, str(c)) for d, (n, c) in days.items()], "day date, n long, content string")
    versions.write(rows.select("day", "n", F.col("content").cast("decimal(38,0)").alias("content")), _ledger_path(path))
    versions.clean(spark, _ledger_path(path), KEEP_LEDGERS)


def rebuild_changed_days(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    date_col: str,
    as_of: str,
    days: int = STATIC_INCREMENTAL_DAYS,
    full_refresh: bool = False,
    protected: bool = False,
    first_day: dt.date | None = None,
) -> ChangedDays:
    """Write those days of ``rows`` into the table at ``path`` that changed.

    The days of the window (``as_of - days`` to ``as_of``, and rows without a
    day) are compared by row count and content hash with the ledger. Changed ones
    are replaced in one dynamic overwrite, whose own metrics give their new ledger
    entries, so a ledger never says more than what was written; days that have no
    rows any more are removed; equal ones are not touched. Days before the window
    are only compared (``late``). ``first_day``: ``rows`` are known to hold nothing
    before it, so that earlier days are not compared.

    The first run, or ``full_refresh`` of a table that is not ``protected``,
    writes everything. So does a run that finds the table without a ledger, unless
    it is protected: then the written days are taken as the ledger. The ledger is
    written last: a run that dies before is repeated with the same result by the
    next one.
    """
    path = path.rstrip("/")
    ledger = read_ledger(spark, path)
    there = files.exists(spark, path)
    columns = rows.columns
    if not there or (full_refresh and not protected) or (ledger is None and not protected):
        _overwrite(rows, path, date_col, "static")
        written = spark.read.schema(rows.schema).parquet(path).select(*columns)
        new = _by_day(written, date_col)
        _write_ledger(spark, path, new)
        return ChangedDays("full", rewritten=sorted(new, key=str))
    if ledger is None:
        old = _by_day(spark.read.schema(rows.schema).parquet(path).select(*columns), date_col)
    else:
        old = {r.day: (r.n, int(r.content)) for r in ledger.collect()}  # a row a day
    window = [None, *window_days(as_of, days)]
    before = lambda d: d is not None and d < window[1] and (first_day is None or d >= first_day)
    now = _by_day(rows.filter(F.col(date_col).isNull() | (F.col(date_col) <= F.lit(window[-1]))), date_col)
    out = ChangedDays("incremental", late=sorted(d for d in old.keys() | now.keys() if before(d) and old.get(d) != now.get(d)))
    changed = [d for d in window if now.get(d, (0, 0)) != old.get(d, (0, 0))]
    out.unchanged = [d for d in window if d in now and d not in changed]
    new = dict(old)
    if any(d in now for d in changed):
        day = F.col(date_col)
        dated = [F.lit(d) for d in changed if d is not None]
        picked = (day.isin(*dated) if dated else F.lit(False)) | (day.isNull() if None in changed else F.lit(False))
        found = Observation("changed_days")
        metrics = [c for i, d in enumerate(changed)
                   for c in digest_columns(columns, day.eqNullSafe(F.lit(d).cast("date")), f"d{i}_")]
        _overwrite(rows.filter(picked), path, date_col, "dynamic", (found, metrics))
        for i, d in enumerate(changed):
            new[d] = (found.get[f"d{i}_n"], int(found.get[f"d{i}_content"]))
    else:
        new.update({d: (0, 0) for d in changed})
    out.rewritten = [d for d in changed if new[d][0]]
    out.emptied = [d for d in changed if not new[d][0]]
    for d in out.emptied:
        files.remove(spark, f"{path}/{date_col}={_NO_DAY if d is None else d.isoformat()}")
    if changed or ledger is None:
        _write_ledger(spark, path, {d: x for d, x in new.items() if x[0]})
    return out


def _overwrite(rows: DataFrame, path: str, date_col: str, mode: str, observed=None) -> None:
    rows = rows.hint("rebalance", date_col)
    if observed:
        rows = rows.observe(observed[0], *observed[1])
    (rows.write.mode("overwrite").option("partitionOverwriteMode", mode)
     .option("compression", "zstd").partitionBy(date_col).parquet(path))
