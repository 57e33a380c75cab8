"""Intermediate e-mail models: event spine, messages, subscription lifecycle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaymart.functions import columns as C
from relaymart.operators.aggregates import max_if, min_if, repeatable_any
from relaymart.operators.joins import anti_join_existing
from relaymart.operators.sets import union_all
from relaymart.operators.spine import date_spine

def _null_str():
    return F.lit(None).cast("string")


def default_as_of() -> str:
    """Today's UTC date, the reference's ``current_date()``."""
    return dt.datetime.now(dt.timezone.utc).date().isoformat()


def int_email_message_events(
    sendgrid_events: DataFrame,
    resend_events: DataFrame,
    resend_backfill: DataFrame,
) -> DataFrame:
    """Every e-mail event of both providers, plus backfilled Resend sends
    that no webhook 'sent' event already covers (same message and address)."""
    sendgrid = sendgrid_events.select(
        F.col("event_id").alias("email_event_id"),
        F.lit("sendgrid").alias("source"),
        "event_type",
        "event_ts",
        F.col("message_id").alias("source_email_id"),
        "email_address",
        _null_str().alias("subject"),
        "link_url",
        "ip_address",
        "user_agent",
        F.lit(False).alias("is_backfill"),
    )
    resend = resend_events.select(
        "email_event_id",
        F.lit("resend").alias("source"),
        "event_type",
        F.when(F.col("event_type") == "clicked",
               F.coalesce("click_ts", "event_created_ts"))
        .otherwise(F.col("event_created_ts")).alias("event_ts"),
        F.col("message_id").alias("source_email_id"),
        "email_address",
        "subject",
        F.col("click_link").alias("link_url"),
        F.col("click_ip_address").alias("ip_address"),
        F.col("click_user_agent").alias("user_agent"),
        F.lit(False).alias("is_backfill"),
    )
    missing_sends = anti_join_existing(
        resend_backfill,
        resend_events,
        ["message_id", "email_address"],
        right_filter=F.col("event_type") == "sent",
    )
    backfill = missing_sends.select(
        "email_event_id",
        F.lit("resend").alias("source"),
        F.lit("sent").alias("event_type"),
        F.col("email_created_ts").alias("event_ts"),
        F.col("message_id").alias("source_email_id"),
        "email_address",
        "subject",
        _null_str().alias("link_url"),
        _null_str().alias("ip_address"),
        _null_str().alias("user_agent"),
        F.lit(True).alias("is_backfill"),
    )
    events = union_all([sendgrid, resend, backfill])
    return events.select(
        "email_event_id",
        C.surrogate_key(["source", "source_email_id"]).alias("email_id"),
        "source", "event_type", "event_ts", "source_email_id", "email_address",
        "subject", "link_url", "ip_address", "user_agent", "is_backfill",
        C.privacy_or_bot_reason("event_type", "user_agent").alias("privacy_or_bot_reason"),
    )


def int_email_messages(message_events: DataFrame) -> DataFrame:
    """One row per message: a subject and the first send time."""
    return message_events.groupBy("email_id", "source", "source_email_id").agg(
        repeatable_any(F.col("subject")).alias("subject"),
        min_if(F.col("event_type") == "sent", F.col("event_ts")).alias("sent_ts"),
    )


def int_email_subscription_events(
    contacts: DataFrame,
    contact_events: DataFrame,
    message_events: DataFrame,
) -> DataFrame:
    """Subscribe/unsubscribe lifecycle events from four kinds of records
    (contact created, contact unsubscribed in the snapshot, contact
    webhooks, SendGrid resubscribes). No uniqueness is implied and nothing
    is deduplicated."""
    # every contact: subscribed at creation; contacts not subscribed in the
    # snapshot: also unsubscribed at backfill time. Both come from ONE scan
    # of the snapshot (an array of 1-2 events per contact, exploded).
    snapshot_events = F.array(
        F.struct(F.lit("subscribed").alias("t"), F.col("contact_created_ts").alias("ts")),
        F.when(~F.col("is_subscribed"),
               F.struct(F.lit("unsubscribed").alias("t"), F.col("backfilled_ts").alias("ts"))),
    )
    snapshot = (
        contacts.select("contact_id", "email_address", F.explode(snapshot_events).alias("e"))
        .filter(F.col("e").isNotNull())
        .select(
            F.lit("resend").alias("source"),
            F.col("contact_id").alias("resend_contact_id"),
            "email_address",
            F.col("e.t").alias("subscriber_event_type"),
            F.col("e.ts").alias("event_ts"),
        )
    )
    webhooks = contact_events.filter(
        F.col("event_type").isin("contact.created", "contact.updated")
    ).select(
        F.lit("resend").alias("source"),
        F.col("contact_id").alias("resend_contact_id"),
        "email_address",
        # a NULL flag is not true, so it reads as an unsubscribe
        F.when(F.col("is_subscribed"), F.lit("subscribed"))
        .otherwise(F.lit("unsubscribed")).alias("subscriber_event_type"),
        F.col("event_created_ts").alias("event_ts"),
    )
    resubscribes = message_events.filter(
        (F.col("source") == "sendgrid") & (F.col("event_type") == "resubscribed")
    ).select(
        F.lit("sendgrid").alias("source"),
        _null_str().alias("resend_contact_id"),
        "email_address",
        F.lit("subscribed").alias("subscriber_event_type"),
        "event_ts",
    )
    events = union_all([snapshot, webhooks, resubscribes])
    return events.select(
        C.surrogate_key(["email_address"]).alias("subscriber_id"),
        "source", "resend_contact_id", "email_address", "subscriber_event_type", "event_ts",
    )


def int_email_subscribers(subscription_events: DataFrame) -> DataFrame:
    """One row per address with its current subscription flag.

    Not known to Resend -> false; never unsubscribed -> true; else whether
    the last subscribe is later than the last unsubscribe (a tie is false,
    and min/max span both providers). A contact with only unsubscribe
    events gets NULL, which the mart contract then rejects."""
    is_sub = F.col("subscriber_event_type") == "subscribed"
    is_unsub = F.col("subscriber_event_type") == "unsubscribed"
    # Grouped by (subscriber_id, email_address), not by the address alone:
    # the facts join this dimension on the address, and a join input that
    # comes straight from its own shuffle is what lets AQE split a hot
    # address's partition on the fact side (a reused aggregate partitioning
    # would save one small shuffle but disable that skew split).
    summary = subscription_events.groupBy("subscriber_id", "email_address").agg(
        repeatable_any(F.col("resend_contact_id")).alias("resend_contact_id"),
        min_if(is_sub, F.col("event_ts")).alias("min_subscribed_ts"),
        max_if(is_sub, F.col("event_ts")).alias("max_subscribed_ts"),
        min_if(is_unsub, F.col("event_ts")).alias("min_unsubscribed_ts"),
        max_if(is_unsub, F.col("event_ts")).alias("max_unsubscribed_ts"),
    )
    return summary.select(
        "subscriber_id",
        "email_address",
        "resend_contact_id",
        F.when(F.col("resend_contact_id").isNull(), F.lit(False))
        .when(F.col("max_unsubscribed_ts").isNull(), F.lit(True))
        .otherwise(F.col("max_subscribed_ts") > F.col("max_unsubscribed_ts"))
        .alias("is_subscribed"),
        "min_subscribed_ts", "max_subscribed_ts",
        "min_unsubscribed_ts", "max_unsubscribed_ts",
    )


def dates(subscription_events: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row per day from the first subscription event to ``as_of``
    (default: today, UTC). The first day is a scalar subquery, evaluated
    once on the cluster and never collected by Python code."""
    as_of = as_of or default_as_of()
    first_day = subscription_events.select(
        F.min(C.utc_date("event_ts")).alias("first_day")).scalar()
    spark = subscription_events.sparkSession
    return spark.range(1).select(
        F.explode(date_spine(first_day, as_of)).alias("date_day"))
