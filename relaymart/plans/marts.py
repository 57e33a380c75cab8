"""Mart models: the published dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaymart.functions import columns as C
from relaymart.operators.aggregates import count_if, max_if, min_if
from relaymart.operators.joins import lookup_join
from relaymart.operators.sets import union_all
from relaymart.operators.spine import daily_state_from_changes

FORM_COLUMNS = (
    "form_submission_id", "source_form_submission_id", "source", "form_name",
    "email_address", "job_slug", "organization_slug", "posthog_distinct_id",
    "posthog_session_id", "form_submission_details", "submitted_ts",
)


def dim_organizations(stg_organizations: DataFrame) -> DataFrame:
    return stg_organizations.select(
        C.surrogate_key(["organization_slug"]).alias("organization_id"),
        "organization_slug", "is_active", "is_featured", "name", "description",
        "description_short", "organization_url", "headcount", "location",
    )


def dim_jobs(stg_jobs: DataFrame, dim_orgs: DataFrame) -> DataFrame:
    """Jobs with their organization key. A job whose organization file is
    missing keeps a NULL ``organization_id`` here; the mart contract
    (NOT NULL) is what rejects it at publish time."""
    joined = lookup_join(stg_jobs, dim_orgs, ["organization_slug"], ["organization_id"])
    return joined.select(
        C.surrogate_key(["organization_slug", "job_slug"]).alias("job_id"),
        "organization_id", "organization_slug", "job_slug", "is_active", "is_featured",
        "date_added", "date_removed", "title", "posting_url", "description",
        "location", "salary", "tags",
    )


def dim_email_messages(int_messages: DataFrame) -> DataFrame:
    return int_messages.select("email_id", "source", "source_email_id", "subject", "sent_ts")


def dim_email_subscribers(int_subscribers: DataFrame) -> DataFrame:
    return int_subscribers.select(
        "subscriber_id", "email_address", "resend_contact_id", "is_subscribed",
        "min_subscribed_ts", "max_subscribed_ts", "min_unsubscribed_ts",
        "max_unsubscribed_ts",
    )


def fct_email_events(message_events: DataFrame, int_subscribers: DataFrame) -> DataFrame:
    """Per event and recipient, linked to the subscriber by address."""
    e = lookup_join(message_events, int_subscribers, ["email_address"], ["subscriber_id"])
    flagged = F.col("privacy_or_bot_reason").isNotNull()
    return e.select(
        "email_event_id",
        "subscriber_id",
        "email_id",
        "event_type",
        "event_ts",
        F.col("event_type").isin(*C.ENGAGEMENT_EVENT_TYPES).alias("is_engagement"),
        flagged.alias("is_privacy_or_bot_like"),
        C.json_object_strip_nulls(
            ("link_url", F.col("link_url")),
            ("ip_address", F.col("ip_address")),
            ("user_agent", F.col("user_agent")),
            ("is_backfill", F.col("is_backfill")),
            ("is_privacy_or_bot_like", flagged),
            ("privacy_or_bot_reason", F.col("privacy_or_bot_reason")),
        ).alias("email_event_details"),
    )


def fct_email_subscriber_messages(email_events: DataFrame) -> DataFrame:
    """Per (message, known subscriber): first time of each event kind and
    engagement counts, all in one hash aggregate (partial map-side)."""
    et = F.col("event_type")
    ts = F.col("event_ts")
    return (
        email_events.filter(F.col("subscriber_id").isNotNull())
        .groupBy("email_id", "subscriber_id")
        .agg(
            min_if(et == "sent", ts).alias("min_sent_ts"),
            min_if(et == "delivered", ts).alias("min_delivered_ts"),
            min_if(et == "opened", ts).alias("min_opened_ts"),
            min_if(et == "clicked", ts).alias("min_clicked_ts"),
            count_if(et == "opened").alias("n_events_opened"),
            count_if(et == "clicked").alias("n_events_clicked"),
        )
        .select(
            C.surrogate_key(["email_id", "subscriber_id"]).alias("email_subscriber_message_id"),
            "email_id", "subscriber_id", "min_sent_ts", "min_delivered_ts",
            "min_opened_ts", "min_clicked_ts", "n_events_opened", "n_events_clicked",
        )
    )


_PAIRS = {
    ("sendgrid", "subscribed"): "sg_sub",
    ("sendgrid", "unsubscribed"): "sg_unsub",
    ("resend", "subscribed"): "re_sub",
    ("resend", "unsubscribed"): "re_unsub",
}


def provider_cutover(stg_contacts: DataFrame):
    """Day Resend becomes the system of record: the day after the first
    contact backfill (NULL when there is none, i.e. Resend throughout).
    Returned as a scalar-subquery Column, evaluated once on the cluster."""
    return stg_contacts.select(
        F.date_add(F.min(C.utc_date("backfilled_ts")), 1).alias("resend_start_date")
    ).scalar()


def subscription_days(subscription_events: DataFrame) -> DataFrame:
    """One row per subscriber and day with any event: the last of each kind
    (partial aggregation before the shuffle, so a hot subscriber is cut down to
    its days)."""
    ev = subscription_events.select(
        "subscriber_id", "source", "subscriber_event_type", "event_ts",
        C.utc_date("event_ts").alias("date_day"))
    metric_cols = [
        max_if((F.col("source") == src) & (F.col("subscriber_event_type") == kind),
               F.col("event_ts")).alias(name)
        for (src, kind), name in _PAIRS.items()
    ]
    return ev.groupBy("subscriber_id", "date_day").agg(*metric_cols)


DAILY_METRICS = {m: "max" for m in _PAIRS.values()}


def daily_subscription_rows(day_rows: DataFrame, stg_contacts: DataFrame, as_of: str, start: str | None = None) -> DataFrame:
    """The daily fact's rows, of days from ``start`` on, from the change rows of
    :func:`subscription_days` (or of a state through the day before ``start``)."""
    # expanded to every day of its lifetime with running "before" maxima
    state = daily_state_from_changes(day_rows, "subscriber_id", "date_day", DAILY_METRICS, as_of, start)
    cutover = provider_cutover(stg_contacts)
    # NULL cutover or NULL day -> Resend; projected once, so the scalar
    # subquery appears (and runs) once in the plan
    state = state.withColumn(
        "_use_sg", F.coalesce(F.col("date_day") < cutover, F.lit(False)))

    def pick(name: str):
        return F.when(F.col("_use_sg"), F.col(f"sg_{name}")).otherwise(F.col(f"re_{name}"))

    on_day = pick("sub").isNotNull()
    sub_before, unsub_before = pick("sub_before"), pick("unsub_before")
    is_subscribed = on_day | F.coalesce(sub_before > unsub_before, sub_before.isNotNull())
    return state.select(
        C.surrogate_key(["date_day", "subscriber_id"]).alias("email_subscriber_daily_id"),
        "date_day",
        "subscriber_id",
        is_subscribed.alias("is_subscribed"),
    )


def fct_email_subscribers_daily(
    subscription_events: DataFrame,
    stg_contacts: DataFrame,
    as_of: str,
) -> DataFrame:
    """Per (UTC day, subscriber) from the subscriber's first event to
    ``as_of``: was the address subscribed at any time that day.

    SendGrid state counts before the cutover day, Resend state from it on.
    Subscribed that day if a subscribe event of the provider in force falls
    on the day, or if, among that provider's earlier events, the last
    subscribe is later than the last unsubscribe (or there is a subscribe
    and no unsubscribe). A subscriber whose first event is after ``as_of``
    gets one row with a NULL day (as a left range join gives it).
    See :mod:`relaymart.operators.spine` for the plan.
    """
    return daily_subscription_rows(subscription_days(subscription_events), stg_contacts, as_of)


def fct_form_submissions(
    netlify: DataFrame,
    webflow: DataFrame,
    subscribers: DataFrame,
    jobs: DataFrame,
    organizations: DataFrame,
) -> DataFrame:
    """Form submissions of both providers linked to subscriber, job and
    organization; the job's organization wins over a direct match.

    Only submissions that name an organization can match a job or one. All others
    (every Webflow row) would meet in one task under the NULL slug, so they join
    by their own id beside a flag that no organization has: every source is read
    and parsed once, and they spread over all tasks."""
    forms = union_all([netlify.select(*FORM_COLUMNS), webflow.select(*FORM_COLUMNS)])
    named = F.col("organization_slug").isNotNull()
    forms = forms.withColumns({
        "_named": named, "_slug": F.coalesce("organization_slug", "form_submission_id")})
    mark = lambda df: df.withColumns({"_named": F.lit(True), "_slug": F.col("organization_slug")}).drop("organization_slug")
    j = mark(jobs.select("organization_slug", "job_slug", "job_id", F.col("organization_id").alias("job_organization_id")))
    o = mark(organizations.select("organization_slug", "organization_id"))
    linked = forms.join(j, ["_named", "_slug", "job_slug"], "left").join(o, ["_named", "_slug"], "left")
    fs = lookup_join(linked, subscribers, ["email_address"], ["subscriber_id"])
    return fs.select(
        "form_submission_id", "source_form_submission_id", "source", "form_name",
        "subscriber_id", "job_id",
        F.coalesce("job_organization_id", "organization_id").alias("organization_id"),
        "email_address", "posthog_distinct_id", "posthog_session_id",
        "form_submission_details", "submitted_ts",
    )
