import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from relaymart.plans.marts import fct_email_subscribers_daily
from relaymart.session import work_path
from relaymart.sinks import files, versions
from relaymart.streaming import daily_state

EVENTS = "subscriber_id string, source string, subscriber_event_type string, ts string"


def history(spark, seed=1, n=60, days=40, extra=()):
    rng, rows = random.Random(seed), []
    for i in range(n):
        for _ in range(rng.randint(1, 5)):
            day = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randint(0, days), seconds=rng.randint(0, 86399))
            rows.append((f"s{i}", rng.choice(["sendgrid", "resend"]), rng.choice(["subscribed", "unsubscribed"]), str(day)))
    rows += [("none", "resend", "subscribed", None), *extra]
    return spark.createDataFrame(rows, EVENTS).select(
        "subscriber_id", "source", "subscriber_event_type", F.col("ts").cast("timestamp_ntz").alias("event_ts"))


def contacts(spark, day="2024-01-15"):
    return spark.sql(f"select timestamp_ntz '{day} 10:00:00' as backfilled_ts")


def check(spark, path, events, stg, as_of):
    want = fct_email_subscribers_daily(events, stg, as_of)
    got = daily_state.read_daily_state(spark, path)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(got) == rows(want)


def test_days_go_by(spark):
    """Day by day, over windows that overlap, skip days, and repeat."""
    path, events, stg = work_path(spark, "daily"), history(spark), contacts(spark)
    modes = []
    for as_of in ("2024-01-12", "2024-01-13", "2024-01-13", "2024-01-16", "2024-02-01", "2024-02-20"):
        modes.append(daily_state.refresh_daily_state(spark, events, stg, path, as_of, days=3).mode)
        check(spark, path, events, stg, as_of)
    assert modes == ["full"] + 5 * ["incremental"]
    assert len(files.names(spark, f"{path}/_state")) == 2


def test_restated_events_inside_the_window(spark):
    path, stg, as_of = work_path(spark, "daily"), contacts(spark), "2024-01-20"
    events = history(spark)
    daily_state.refresh_daily_state(spark, events, stg, path, as_of, days=5)
    restated = events.filter("event_ts < '2024-01-17' or event_ts is null or subscriber_id > 's3'").unionByName(
        history(spark, 2, n=0, extra=[("s1", "resend", "unsubscribed", "2024-01-18 03:00:00"), ("new", "resend", "subscribed", "2024-01-16 01:00:00")]))
    got = daily_state.refresh_daily_state(spark, restated, stg, path, as_of, days=5)
    assert got.mode == "incremental" and dt.date(2024, 1, 15) in got.days.unchanged and dt.date(2024, 1, 18) in got.days.rewritten
    check(spark, path, restated, stg, as_of)


@pytest.mark.parametrize("change", ["late", "restated", "cutover", "back in time", "asked"])
def test_what_a_snapshot_cannot_stand_leads_to_a_whole_build(spark, change):
    path, stg, as_of = work_path(spark, "daily"), contacts(spark), "2024-01-20"
    events = history(spark)
    daily_state.refresh_daily_state(spark, events, stg, path, as_of, days=5)
    if change == "late":
        events = events.unionByName(history(spark, n=0, extra=[("s1", "resend", "subscribed", "2024-01-02 03:00:00")]))
    elif change == "restated":
        events = events.withColumn("source", F.when(F.col("event_ts") < "2024-01-09", "resend").otherwise(F.col("source")))
    elif change == "cutover":
        stg = contacts(spark, "2024-01-10")
    elif change == "back in time":
        as_of = "2024-01-10"
    got = daily_state.refresh_daily_state(spark, events, stg, path, as_of, days=5, full_refresh=change == "asked")
    assert got.mode == "full"
    check(spark, path, events, stg, as_of)


@pytest.mark.parametrize("step", ["days", "snapshot"])
def test_a_run_that_dies_is_made_good(spark, monkeypatch, step):
    path, stg, events = work_path(spark, "daily"), contacts(spark), history(spark)
    daily_state.refresh_daily_state(spark, events, stg, path, "2024-01-20", days=5)

    def die(*_, **__):
        raise OSError("killed")

    with monkeypatch.context() as m:
        if step == "days":
            m.setattr(daily_state, "state_through", die)
        else:
            real = versions.write
            m.setattr(versions, "write", lambda rows, base, *a: die() if base.endswith("_state") else real(rows, base, *a))
        with pytest.raises(OSError, match="killed"):
            daily_state.refresh_daily_state(spark, events, stg, path, "2024-01-25", days=5)
    assert daily_state.refresh_daily_state(spark, events, stg, path, "2024-01-26", days=5).mode == "incremental"
    check(spark, path, events, stg, "2024-01-26")


def test_empty_history(spark):
    path, stg = work_path(spark, "daily"), contacts(spark).filter("false")
    for as_of in ("2024-01-20", "2024-01-22"):
        daily_state.refresh_daily_state(spark, history(spark, n=0), stg, path, as_of)
        check(spark, path, history(spark, n=0), stg, as_of)
