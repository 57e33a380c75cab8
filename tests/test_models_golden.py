"""The reference's model unit test, verbatim, plus edge rows it does not cover."""
import datetime as dt

from pyspark.testing import assertDataFrameEqual

from relaymart.plans.intermediate import int_email_subscribers

SCHEMA = ("subscriber_id string, source string, resend_contact_id string, email_address string, "
          "subscriber_event_type string, event_ts timestamp_ntz")
OUT = ("subscriber_id string, email_address string, resend_contact_id string, is_subscribed boolean, "
       "min_subscribed_ts timestamp_ntz, max_subscribed_ts timestamp_ntz, "
       "min_unsubscribed_ts timestamp_ntz, max_unsubscribed_ts timestamp_ntz")


def d(day):
    return dt.datetime(2026, 1, day)


def test_provider_lifecycle_golden_rows(spark):
    given = spark.createDataFrame([
        ("sendgrid_only", "sendgrid", None, "sendgrid@example.com", "subscribed", d(1)),
        ("active_resend", "resend", "contact_active", "active@example.com", "subscribed", d(2)),
        ("unsubscribed", "resend", "contact_unsubscribed", "unsubscribed@example.com", "subscribed", d(3)),
        ("unsubscribed", "resend", "contact_unsubscribed", "unsubscribed@example.com", "unsubscribed", d(4)),
        ("resubscribed", "resend", "contact_resubscribed", "resubscribed@example.com", "subscribed", d(5)),
        ("resubscribed", "resend", "contact_resubscribed", "resubscribed@example.com", "unsubscribed", d(6)),
        ("resubscribed", "resend", "contact_resubscribed", "resubscribed@example.com", "subscribed", d(7)),
    ], SCHEMA)
    expected = spark.createDataFrame([
        ("sendgrid_only", "sendgrid@example.com", None, False, d(1), d(1), None, None),
        ("active_resend", "active@example.com", "contact_active", True, d(2), d(2), None, None),
        ("unsubscribed", "unsubscribed@example.com", "contact_unsubscribed", False, d(3), d(3), d(4), d(4)),
        ("resubscribed", "resubscribed@example.com", "contact_resubscribed", True, d(5), d(7), d(6), d(6)),
    ], OUT)
    assertDataFrameEqual(int_email_subscribers(given), expected)


def test_lifecycle_edge_rows(spark):
    given = spark.createDataFrame([
        # only unsubscribe events -> NULL (the contract would reject it)
        ("only_unsub", "resend", "c1", "a@x.com", "unsubscribed", d(1)),
        # subscribe and unsubscribe at the same instant -> false
        ("tie", "resend", "c2", "b@x.com", "subscribed", d(2)),
        ("tie", "resend", "c2", "b@x.com", "unsubscribed", d(2)),
        # a later SendGrid resubscribe flips a known contact back to true
        ("sg_flip", "resend", "c3", "c@x.com", "unsubscribed", d(3)),
        ("sg_flip", "resend", "c3", "c@x.com", "subscribed", d(2)),
        ("sg_flip", "sendgrid", None, "c@x.com", "subscribed", d(4)),
    ], SCHEMA)
    got = {r.subscriber_id: r.is_subscribed for r in int_email_subscribers(given).collect()}
    assert got == {"only_unsub": None, "tie": False, "sg_flip": True}
