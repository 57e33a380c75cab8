"""The daily subscription fact, kept up to date from a state snapshot.

Expanding every subscriber from its first day at each run grows with the age of
the lists. ``refresh_daily_state`` keeps, beside the day-partitioned fact, one
change row a subscriber: its running state through the day before the window.
A run unions that with the events of the window's days, expands only these days,
and writes the ones that changed (:func:`rebuild_changed_days`). Then it carries
the snapshot on to the new window's start by a merge of the days that fell out.

What the snapshot stands on is checked first: count and content hash of the
events before its day, and the provider cutover, must be as they were when it was
made. A restated or late event before the window, or another cutover, leads to a
whole rebuild, so the fact always equals one built from the first day.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaymart.functions.columns import utc_date
from relaymart.operators.sets import union_all
from relaymart.operators.spine import state_through
from relaymart.plans.marts import DAILY_METRICS, daily_subscription_rows, provider_cutover, subscription_days
from relaymart.sinks import files, versions
from relaymart.sinks.digests import digest_columns
from relaymart.streaming.incremental import STATIC_INCREMENTAL_DAYS, ChangedDays, rebuild_changed_days

#: Snapshots that stay.
KEEP = 2
_META = "start date, as_of date, cutover date, n long, content string, snapshot string"


@dataclass
class DailyRefresh:
    mode: str  # 'full' | 'incremental'
    start: dt.date  # first day that was expanded (of a whole build: its snapshot's)
    days: ChangedDays


def refresh_daily_state(
    spark: SparkSession,
    subscription_events: DataFrame,
    stg_contacts: DataFrame,
    path: str,
    as_of: str,
    days: int = STATIC_INCREMENTAL_DAYS,
    full_refresh: bool = False,
) -> DailyRefresh:
    """Bring the fact at ``path`` (partitioned by ``date_day``) to ``as_of``.

    ``subscription_events`` is read once for the check of the snapshot (a scan
    and one small aggregate) and, from the snapshot's day on, for the rows. The
    snapshot's pointer is written last; a run that dies before leaves the old one,
    from which the next run expands the same days again.
    """
    path = path.rstrip("/")
    last, event_day = dt.date.fromisoformat(as_of), utc_date("event_ts")
    window_start = last - dt.timedelta(days=days)
    events = subscription_events.select("subscriber_id", "source", "subscriber_event_type", "event_ts")
    old = versions.read(spark, f"{path}/_state")
    old = None if old is None else old.first()
    start = window_start if old is None else min(old.start, window_start)

    def before(day: dt.date):
        return event_day < F.lit(day)

    # what the old snapshot stands on, and what the new one will: one pass
    marks = {"old": start, "new": window_start}
    found = events.agg(*[c for name, day in marks.items() for c in digest_columns(events.columns, before(day), f"{name}_")]).first()
    cutover = stg_contacts.select(provider_cutover(stg_contacts).alias("day")).first()
    cutover = cutover.day if cutover else None
    stands = (old is not None and not full_refresh and old.start <= window_start and old.as_of <= last and old.cutover == cutover
              and (old.n, old.content) == (found.old_n, str(int(found.old_content)))
              and files.exists(spark, f"{path}/_snapshots/{old.snapshot}/_SUCCESS"))

    if stands:
        snapshot = spark.read.parquet(f"{path}/_snapshots/{old.snapshot}")
        later = subscription_days(events.filter(event_day.isNull() | ~before(old.start)))
        changes = union_all([snapshot, later.select(*snapshot.columns)])
        rows = daily_subscription_rows(changes, stg_contacts, as_of, old.start.isoformat())
        done = rebuild_changed_days(spark, rows, path, "date_day", as_of, (last - old.start).days, first_day=old.start)
    else:
        changes = subscription_days(events)
        rows = daily_subscription_rows(changes, stg_contacts, as_of)
        done = rebuild_changed_days(spark, rows, path, "date_day", as_of, full_refresh=True)

    version = versions.claim(spark, f"{path}/_state")
    through = (window_start - dt.timedelta(days=1)).isoformat()
    (state_through(changes, "subscriber_id", "date_day", DAILY_METRICS, through)
     .write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/_snapshots/{version}"))
    meta = spark.createDataFrame(
        [(window_start, last, cutover, found.new_n, str(int(found.new_content)), version)], _META)
    versions.write(meta, f"{path}/_state", version)
    kept = versions.clean(spark, f"{path}/_state", KEEP)
    versions.clean_runs(spark, f"{path}/_snapshots", set(kept))
    return DailyRefresh("incremental" if stands else "full", old.start if stands else window_start, done)


def read_daily_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("email_subscriber_daily_id", "date_day", "subscriber_id", "is_subscribed")
