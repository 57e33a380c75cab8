"""Staging models: one cleaned relation per provider source.

Each function takes the raw source DataFrame and returns a lazy DataFrame;
filters are written before any expensive projection so Catalyst pushes them
into the Parquet scan, and each JSON document is parsed once per row (into a
struct of just the keys the model reads).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaymart.functions import columns as C
from relaymart.operators.unnest import explode_not_null


JOB_KEYS = ("tags", "active", "featured", "date", "closed_at", "title", "url", "description",
            "location", "salary")
ORGANIZATION_KEYS = ("active", "featured", "title", "about", "about_short", "website",
                     "headcount", "headcount_inferred", "location", "location_inferred")
FORM_KEYS = ("email", "job_slug", "org_slug", "posthog_distinct_id", "posthog_session_id",
             "job_title", "job_url")


def _fields(df: DataFrame, text_col: str, keys) -> DataFrame:
    """Keep ``df`` and add its JSON document parsed once (``_j``)."""
    return df.withColumn("_j", C.json_fields(text_col, keys))


def stg_jobs(jobs: DataFrame) -> DataFrame:
    def v(key, typ="string"):
        return C.json_field("_j", "frontmatter", key, typ)

    return _fields(jobs.select("file_path", "frontmatter"), "frontmatter", JOB_KEYS).select(
        C.organization_slug("file_path").alias("organization_slug"),
        C.job_slug("file_path").alias("job_slug"),
        v("active", "boolean").alias("is_active"),
        v("featured", "boolean").alias("is_featured"),
        v("date", "date").alias("date_added"),
        v("closed_at", "date").alias("date_removed"),
        v("title").alias("title"),
        v("url").alias("posting_url"),
        v("description").alias("description"),
        v("location").alias("location"),
        v("salary").alias("salary"),
        C.json_string_array("_j", "frontmatter", "tags").alias("tags"),
    )


def stg_organizations(organizations: DataFrame) -> DataFrame:
    def v(key, typ="string"):
        return C.json_field("_j", "frontmatter", key, typ)

    return _fields(organizations.select("file_path", "frontmatter"), "frontmatter",
                   ORGANIZATION_KEYS).select(
        C.organization_slug("file_path").alias("organization_slug"),
        v("active", "boolean").alias("is_active"),
        v("featured", "boolean").alias("is_featured"),
        v("title").alias("name"),
        v("about").alias("description"),
        v("about_short").alias("description_short"),
        v("website").alias("organization_url"),
        # published value wins; an empty string is a value and blocks the fallback
        F.coalesce(v("headcount"), v("headcount_inferred")).alias("headcount"),
        F.coalesce(v("location"), v("location_inferred")).alias("location"),
    )


def stg_netlify__form_submissions(submissions: DataFrame) -> DataFrame:
    def field(key: str):
        return C.empty_to_null(C.json_field("_j", "form_data", key))

    return (
        _fields(submissions.filter(F.col("submission_id").isNotNull()), "form_data", FORM_KEYS)
        .select(
            C.surrogate_key([F.lit("netlify"), "submission_id"]).alias("form_submission_id"),
            F.col("submission_id").alias("source_form_submission_id"),
            F.lit("netlify").alias("source"),
            "form_name",
            C.normalize_email(C.json_field("_j", "form_data", "email")).alias("email_address"),
            field("job_slug").alias("job_slug"),
            field("org_slug").alias("organization_slug"),
            field("posthog_distinct_id").alias("posthog_distinct_id"),
            field("posthog_session_id").alias("posthog_session_id"),
            C.json_object_strip_nulls(
                ("job_title", field("job_title")),
                ("job_url", field("job_url")),
            ).alias("form_submission_details"),
            "submitted_ts",
            "loaded_ts",
        )
    )


def stg_webflow__form_submissions(submits: DataFrame) -> DataFrame:
    null_str = F.lit(None).cast("string")
    return submits.filter(F.col("event_id").isNotNull()).select(
        C.surrogate_key([F.lit("webflow"), "event_id"]).alias("form_submission_id"),
        F.col("event_id").alias("source_form_submission_id"),
        F.lit("webflow").alias("source"),
        F.lit("newsletter").alias("form_name"),
        C.normalize_email("data").alias("email_address"),
        null_str.alias("job_slug"),
        null_str.alias("organization_slug"),
        null_str.alias("posthog_distinct_id"),
        null_str.alias("posthog_session_id"),
        F.lit("{}").alias("form_submission_details"),
        F.col("event_timestamp").alias("submitted_ts"),
    )


def stg_resend__contact_events(contact_webhooks: DataFrame) -> DataFrame:
    return contact_webhooks.filter(F.col("email").isNotNull()).select(
        C.normalize_event_type("event_type").alias("event_type"),
        F.col("event_created_at").alias("event_created_ts"),
        "contact_id",
        C.normalize_email("email").alias("email_address"),
        (~F.col("unsubscribed")).alias("is_subscribed"),
    )


def stg_resend__contacts(contacts_backfill: DataFrame) -> DataFrame:
    return contacts_backfill.filter(F.col("email").isNotNull()).select(
        "contact_id",
        C.normalize_email("email").alias("email_address"),
        (~F.col("unsubscribed")).alias("is_subscribed"),
        F.col("created_at").alias("contact_created_ts"),
        F.col("backfilled_at").alias("backfilled_ts"),
    )


def stg_resend__email_events(email_webhooks: DataFrame) -> DataFrame:
    """One row per webhook event and recipient. The same address twice in
    one event gives two rows with the same key; that is reported by the
    uniqueness check, never silently removed."""
    r = C.normalize_email("recipient")
    return explode_not_null(email_webhooks, "to_addresses", "recipient").select(
        C.surrogate_key(["id", r]).alias("email_event_id"),
        C.normalize_event_type("event_type").alias("event_type"),
        F.col("event_created_at").alias("event_created_ts"),
        F.col("email_id").alias("message_id"),
        r.alias("email_address"),
        C.empty_to_null("subject").alias("subject"),
        C.empty_to_null("click_ip_address").alias("click_ip_address"),
        C.empty_to_null("click_link").alias("click_link"),
        F.col("click_timestamp").alias("click_ts"),
        C.empty_to_null("click_user_agent").alias("click_user_agent"),
    )


def stg_resend__emails_backfill(emails_backfill: DataFrame) -> DataFrame:
    r = C.normalize_email("recipient")
    return explode_not_null(emails_backfill, "to_addresses", "recipient").select(
        C.surrogate_key(["email_id", r]).alias("email_event_id"),
        F.col("email_id").alias("message_id"),
        r.alias("email_address"),
        C.empty_to_null("subject").alias("subject"),
        F.col("created_at").alias("email_created_ts"),
    )


def stg_sendgrid__email_events(webhooks: DataFrame) -> DataFrame:
    """An empty event name passes the NOT NULL filter and becomes NULL."""
    return webhooks.filter(F.col("email").isNotNull() & F.col("event").isNotNull()).select(
        F.col("sg_event_id").alias("event_id"),
        F.col("sg_message_id").alias("message_id"),
        C.normalize_email("email").alias("email_address"),
        C.normalize_event_type("event").alias("event_type"),
        C.epoch_seconds_to_ts("timestamp").alias("event_ts"),
        C.empty_to_null("url").alias("link_url"),
        C.empty_to_null("ip").alias("ip_address"),
        C.empty_to_null("useragent").alias("user_agent"),
    )
