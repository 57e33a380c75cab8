"""Daily subscription state: the window plan against a brute-force
evaluation of the stated rule on small hand-made fixtures."""
import datetime as dt
import itertools

from relaymart.plans.marts import fct_email_subscribers_daily

EV = ("subscriber_id string, source string, resend_contact_id string, email_address string, "
      "subscriber_event_type string, event_ts timestamp_ntz")
CONTACTS = ("contact_id string, email_address string, is_subscribed boolean, "
            "contact_created_ts timestamp_ntz, backfilled_ts timestamp_ntz")


def brute_force(events, backfilled, as_of):
    """Literal rule: per subscriber, every day from its first event day to
    as_of; the provider in force is SendGrid before the cutover day."""
    cutover = (min(b.date() for b in backfilled) + dt.timedelta(days=1)) if backfilled else None
    out = {}
    subs = sorted({e[0] for e in events})
    for s in subs:
        evs = [e for e in events if e[0] == s]
        first = min(e[5].date() for e in evs)
        if first > as_of:
            out[(None, s)] = False
            continue
        day = first
        while day <= as_of:
            src = "sendgrid" if (cutover is not None and day < cutover) else "resend"
            mine = [e for e in evs if e[1] == src and e[5].date() <= day]
            on_day = any(e[4] == "subscribed" and e[5].date() == day for e in mine)
            sub_b = max((e[5] for e in mine if e[4] == "subscribed" and e[5].date() < day), default=None)
            uns_b = max((e[5] for e in mine if e[4] == "unsubscribed" and e[5].date() < day), default=None)
            if sub_b is not None and uns_b is not None:
                before = sub_b > uns_b
            else:
                before = sub_b is not None
            out[(day, s)] = on_day or before
            day += dt.timedelta(days=1)
    return out


def run(spark, events, backfilled, as_of):
    ev = spark.createDataFrame(events, EV)
    contacts = spark.createDataFrame(
        [(f"c{i}", f"x{i}@x.com", True, b, b) for i, b in enumerate(backfilled)], CONTACTS)
    df = fct_email_subscribers_daily(ev, contacts, as_of.isoformat())
    return {(r.date_day, r.subscriber_id): r.is_subscribed for r in df.collect()}


def t(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


EVENTS = [
    # SendGrid history then Resend
    ("a", "sendgrid", None, "a@x.com", "subscribed", t(1, 5)),
    ("a", "sendgrid", None, "a@x.com", "unsubscribed", t(3, 1)),
    ("a", "resend", "ca", "a@x.com", "subscribed", t(2, 9)),
    ("a", "resend", "ca", "a@x.com", "unsubscribed", t(7, 9)),
    ("a", "resend", "ca", "a@x.com", "subscribed", t(9, 10)),
    # same-instant subscribe/unsubscribe
    ("b", "resend", "cb", "b@x.com", "subscribed", t(4, 8)),
    ("b", "resend", "cb", "b@x.com", "unsubscribed", t(4, 8)),
    # only unsubscribes
    ("c", "resend", "cc", "c@x.com", "unsubscribed", t(6, 0)),
    # first event after as_of -> one NULL-day row
    ("d", "resend", "cd", "d@x.com", "subscribed", t(20, 0)),
    # event after as_of for a live subscriber is ignored
    ("a", "resend", "ca", "a@x.com", "unsubscribed", t(25, 0)),
]


def test_window_plan_matches_brute_force(spark):
    as_of = dt.date(2024, 1, 12)
    for backfilled in ([t(5, 12)], [t(2, 0), t(8, 0)], []):
        assert run(spark, EVENTS, backfilled, as_of) == brute_force(EVENTS, backfilled, as_of)


def test_hot_subscriber_many_events(spark):
    """One subscriber with most of the rows: per-day pre-aggregation keeps
    the window at one row per day."""
    as_of = dt.date(2024, 1, 10)
    hot = [("h", "resend", "ch", "h@x.com", kind, dt.datetime(2024, 1, 1 + i % 9, i % 24, i % 60))
           for i, kind in zip(range(3000), itertools.cycle(["subscribed", "unsubscribed", "subscribed"]))]
    cold = [("z", "resend", "cz", "z@x.com", "subscribed", t(3))]
    events = hot + cold
    got = run(spark, events, [t(1)], as_of)
    assert got == brute_force(events, [t(1)], as_of)
    assert sum(1 for k in got if k[1] == "h") == 10


def test_null_timestamps(spark):
    as_of = dt.date(2024, 1, 5)
    events = [("n", "resend", "cn", "n@x.com", "subscribed", None),
              ("m", "resend", "cm", "m@x.com", "subscribed", None),
              ("m", "resend", "cm", "m@x.com", "subscribed", t(3))]
    got = run(spark, events, [t(1)], as_of)
    assert got == {(None, "n"): False, (t(3).date(), "m"): True,
                   (dt.date(2024, 1, 4), "m"): True, (as_of, "m"): True}
