"""Operator-level queries: each primitive exercised over whole derived tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame; the
matching DuckDB statement is registered next to it. Inputs are the provider
sources derived from the driver tables, or models built from them, so the
work of every query grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaymart.functions import columns as C
from relaymart.operators.aggregates import count_if, max_if, min_if
from relaymart.operators.joins import anti_join_existing, lookup_join
from relaymart.operators.sets import combine_properties, union_all
from relaymart.operators.spine import per_key_spine
from relaymart.plans.catalog import AS_OF, _render_arrays, graph, register
from relaymart.plans.marts import provider_cutover
from relaymart.quality import checks as Q
from relaymart.quality.contracts import CONTRACTS, json_columns, json_violations, not_null_violations, null_counts
from relaymart.session import apply_defaults, work_path
from relaymart.sinks.publish import export_parquet
from relaymart.sources.fixtures import events_by_property, load_sources, read_driver_table
from relaymart.sources.freshness import DECLARED as FRESHNESS, freshness_report
from relaymart.streaming.incremental import STATIC_INCREMENTAL_DAYS, rebuild_changed_days, rebuild_trailing_window
from relaymart.testing import oracle as O

# The two web-analytics properties and their start date.
PROPERTY_IDS = (333655999, 466027950)
PROPERTY_START_DATE = "20220101"
FRESHNESS_AS_OF_TS = "2024-01-31 00:00:00"
INCREMENTAL_AS_OF = "2024-01-30"
INCREMENTAL_VANISHED = "2024-01-27"  # a day of the window without restated rows


def _src(spark, sf_dir, name) -> DataFrame:
    apply_defaults(spark)
    return load_sources(spark, sf_dir, [name])[name]


# --- scalar functions -------------------------------------------------------

def op_surrogate_key(spark, sf_dir):
    s = _src(spark, sf_dir, "netlify_form_submissions")
    return s.select(
        "submission_id", "form_name",
        C.surrogate_key([F.lit("netlify"), "submission_id"]).alias("key_source_id"),
        C.surrogate_key(["submission_id", "form_name"]).alias("key_id_form"),
    )


register("op_surrogate_key", op_surrogate_key, O.with_query(f"""
select submission_id, form_name, {O.sk("'netlify'", 'submission_id')} as key_source_id,
       {O.sk('submission_id', 'form_name')} as key_id_form
from netlify_form_submissions""", ["netlify_form_submissions"]))


def _json_columns(spark, sf_dir, source: str, *outputs: tuple[str, str, str]) -> DataFrame:
    """file_path and (key, type, name) scalars of a content source's documents,
    by the reader that the models use."""
    keys = list(dict.fromkeys(key for key, _, _ in outputs))
    docs = _src(spark, sf_dir, source).withColumn("_j", C.json_fields("frontmatter", keys))
    return docs.select("file_path", *[
        C.json_field("_j", "frontmatter", key, kind).alias(name) for key, kind, name in outputs])


def op_json_scalar(spark, sf_dir):
    """A JSON null, a missing key and an array all give NULL."""
    return _json_columns(
        spark, sf_dir, "content_jobs", ("title", "string", "title"), ("salary", "string", "salary"),
        ("description", "string", "description"), ("location", "string", "location"),
        ("tags", "string", "tags_as_scalar"), ("active", "string", "active_text"))


register("op_json_scalar", op_json_scalar, O.with_query(f"""
select file_path, {O.jv('frontmatter', 'title')} as title, {O.jv('frontmatter', 'salary')} as salary,
       {O.jv('frontmatter', 'description')} as description,
       {O.jv('frontmatter', 'location')} as location,
       {O.jv('frontmatter', 'tags')} as tags_as_scalar,
       {O.jv('frontmatter', 'active')} as active_text
from content_jobs""", ["content_jobs"]))


def op_json_typed(spark, sf_dir):
    flags = ("active", "boolean", "is_active"), ("featured", "boolean", "is_featured")
    none = F.lit(None).cast("date")
    orgs = _json_columns(spark, sf_dir, "content_organizations", *flags)
    jobs = _json_columns(spark, sf_dir, "content_jobs", *flags, ("date", "date", "date_added"),
                         ("closed_at", "date", "date_removed"))
    return orgs.select("*", none.alias("date_added"), none.alias("date_removed")).unionByName(jobs)


register("op_json_typed", op_json_typed, O.with_query(f"""
select file_path, {O.jv('frontmatter', 'active', 'boolean')} as is_active,
       {O.jv('frontmatter', 'featured', 'boolean')} as is_featured,
       cast(null as date) as date_added, cast(null as date) as date_removed
from content_organizations
union all
select file_path, {O.jv('frontmatter', 'active', 'boolean')},
       {O.jv('frontmatter', 'featured', 'boolean')},
       {O.jv('frontmatter', 'date', 'date')}, {O.jv('frontmatter', 'closed_at', 'date')}
from content_jobs""", ["content_organizations", "content_jobs"]))


def op_json_bool(spark, sf_dir):
    """JSON scalar cast to boolean (strict: junk raises under ANSI)."""
    return _json_columns(spark, sf_dir, "content_organizations",
                         ("active", "boolean", "is_active"), ("featured", "boolean", "is_featured"))


register("op_json_bool", op_json_bool, O.with_query(f"""
select file_path, {O.jv('frontmatter', 'active', 'boolean')} as is_active,
       {O.jv('frontmatter', 'featured', 'boolean')} as is_featured
from content_organizations""", ["content_organizations"]))


def op_json_date(spark, sf_dir):
    """JSON scalar cast to date; a missing key gives NULL."""
    return _json_columns(spark, sf_dir, "content_jobs",
                         ("date", "date", "date_added"), ("closed_at", "date", "date_removed"))


register("op_json_date", op_json_date, O.with_query(f"""
select file_path, {O.jv('frontmatter', 'date', 'date')} as date_added,
       {O.jv('frontmatter', 'closed_at', 'date')} as date_removed
from content_jobs""", ["content_jobs"]))


def op_json_array(spark, sf_dir):
    docs = _src(spark, sf_dir, "content_jobs").withColumn("_j", C.json_fields("frontmatter", ["tags", "title"]))
    tags = C.json_string_array("_j", "frontmatter", "tags")
    return docs.select(
        "file_path",
        F.array_join(tags, ",").alias("tags"),
        F.size(tags).alias("n_tags"),
        F.array_join(C.json_string_array("_j", "frontmatter", "title"), ",").alias("title_as_array"),
    )


register("op_json_array", op_json_array, O.with_query("""
select file_path,
       array_to_string(case when json_type(frontmatter, '$.tags') = 'ARRAY'
            then cast(json_extract(frontmatter, '$.tags') as varchar[]) end, ',') as tags,
       cast(len(case when json_type(frontmatter, '$.tags') = 'ARRAY'
            then cast(json_extract(frontmatter, '$.tags') as varchar[]) end) as integer) as n_tags,
       cast(null as varchar) as title_as_array
from content_jobs""", ["content_jobs"]))


def op_json_object_strip(spark, sf_dir):
    s = _src(spark, sf_dir, "resend_wh_emails")
    return s.select(
        "id",
        C.json_object_strip_nulls(
            ("link", C.empty_to_null("click_link")),
            ("ip", C.empty_to_null("click_ip_address")),
            ("agent", C.empty_to_null("click_user_agent")),
            ("is_click", F.col("event_type") == "email.clicked"),
        ).alias("details"),
    )


register("op_json_object_strip", op_json_object_strip, O.with_query(f"""
select id, {O.json_obj(("link", "nullif(click_link, '')"), ("ip", "nullif(click_ip_address, '')"),
                       ("agent", "nullif(click_user_agent, '')"),
                       ("is_click", "event_type = 'email.clicked'"))} as details
from resend_wh_emails""", ["resend_wh_emails"]))


def op_path_slug(spark, sf_dir):
    src = load_sources(spark, sf_dir, ["content_jobs", "content_organizations"])
    paths = src["content_jobs"].select("file_path").unionByName(
        src["content_organizations"].select("file_path"))
    return paths.select(
        "file_path",
        C.organization_slug("file_path").alias("organization_slug"),
        C.job_slug("file_path").alias("job_slug"),
    )


register("op_path_slug", op_path_slug, O.with_query(f"""
select file_path, {O.slug('file_path', 2)} as organization_slug, {O.slug('file_path', 3)} as job_slug
from (select file_path from content_jobs union all select file_path from content_organizations) as p""",
    ["content_jobs", "content_organizations"]))


def op_normalize_email(spark, sf_dir):
    s = _src(spark, sf_dir, "sendgrid_webhooks")
    return s.select("sg_event_id", "email", C.normalize_email("email").alias("email_address"))


register("op_normalize_email", op_normalize_email, O.with_query(f"""
select sg_event_id, email, {O.norm_email('email')} as email_address
from sendgrid_webhooks""", ["sendgrid_webhooks"]))


def op_normalize_event_type(spark, sf_dir):
    src = load_sources(spark, sf_dir, ["sendgrid_webhooks", "resend_wh_emails", "resend_wh_contacts"])
    raw = (src["sendgrid_webhooks"].select(F.col("sg_event_id").alias("id"), F.col("event").alias("raw"))
           .unionByName(src["resend_wh_emails"].select("id", F.col("event_type").alias("raw")))
           .unionByName(src["resend_wh_contacts"].select(
               F.col("contact_id").alias("id"), F.col("event_type").alias("raw"))))
    return raw.select("id", "raw", C.normalize_event_type("raw").alias("event_type"))


register("op_normalize_event_type", op_normalize_event_type, O.with_query(f"""
select id, raw, {O.norm_event('raw')} as event_type
from (select sg_event_id as id, event as raw from sendgrid_webhooks
      union all select id, event_type from resend_wh_emails
      union all select contact_id, event_type from resend_wh_contacts) as r""",
    ["sendgrid_webhooks", "resend_wh_emails", "resend_wh_contacts"]))


def op_bot_reason(spark, sf_dir):
    s = _src(spark, sf_dir, "sendgrid_webhooks")
    et = C.normalize_event_type("event")
    return s.select("sg_event_id", et.alias("event_type"), "useragent",
                    C.privacy_or_bot_reason(et, F.col("useragent")).alias("privacy_or_bot_reason"))


register("op_bot_reason", op_bot_reason, O.with_query(f"""
select sg_event_id, {O.norm_event('event')} as event_type, useragent,
       {O.bot_reason(O.norm_event('event'), 'useragent')} as privacy_or_bot_reason
from sendgrid_webhooks""", ["sendgrid_webhooks"]))


def op_epoch_seconds(spark, sf_dir):
    s = _src(spark, sf_dir, "sendgrid_webhooks")
    return s.select("sg_event_id", "timestamp",
                    C.epoch_seconds_to_ts("timestamp").alias("event_ts"))


register("op_epoch_seconds", op_epoch_seconds, O.with_query("""
select sg_event_id, "timestamp", make_timestamp(cast("timestamp" as bigint) * 1000000) as event_ts
from sendgrid_webhooks""", ["sendgrid_webhooks"]))


def op_empty_to_null(spark, sf_dir):
    s = _src(spark, sf_dir, "resend_wh_emails")
    return s.select("id", *[C.empty_to_null(c).alias(c) for c in
                            ("subject", "click_ip_address", "click_link", "click_user_agent")])


register("op_empty_to_null", op_empty_to_null, O.with_query("""
select id, nullif(subject, '') as subject, nullif(click_ip_address, '') as click_ip_address,
       nullif(click_link, '') as click_link, nullif(click_user_agent, '') as click_user_agent
from resend_wh_emails""", ["resend_wh_emails"]))


def load_id_ts(spark, sf_dir):
    s = _src(spark, sf_dir, "content_jobs")
    return s.select("file_path", "_dlt_load_id", C.load_id_to_ts("_dlt_load_id").alias("loaded_at"))


register("load_id_ts", load_id_ts, O.with_query("""
select file_path, _dlt_load_id,
       make_timestamp(cast(round(cast(_dlt_load_id as double) * 1000) as bigint) * 1000) as loaded_at
from content_jobs""", ["content_jobs"]))


# --- joins / sets -----------------------------------------------------------

def op_explode_not_null(spark, sf_dir):
    from relaymart.operators.unnest import explode_not_null
    s = _src(spark, sf_dir, "resend_emails_backfill")
    return explode_not_null(s, "to_addresses", "recipient").select("email_id", "recipient")


register("op_explode_not_null", op_explode_not_null, O.with_query("""
select e.email_id, r.recipient
from resend_emails_backfill as e, unnest(e.to_addresses) as r(recipient)
where r.recipient is not null""", ["resend_emails_backfill"]))


def op_backfill_anti_join(spark, sf_dir):
    g = graph(spark, sf_dir)
    kept = anti_join_existing(
        g["stg_resend__emails_backfill"], g["stg_resend__email_events"],
        ["message_id", "email_address"], right_filter=F.col("event_type") == "sent")
    return kept.select("email_event_id", "message_id", "email_address")


register("op_backfill_anti_join", op_backfill_anti_join, O.with_query("""
select b.email_event_id, b.message_id, b.email_address
from stg_resend__emails_backfill as b
where not exists (select 1 from stg_resend__email_events as w
                  where w.message_id = b.message_id and w.email_address = b.email_address
                    and w.event_type = 'sent')""", ["stg_resend__emails_backfill", "stg_resend__email_events"]))


def op_left_join(spark, sf_dir):
    g = graph(spark, sf_dir)
    j = lookup_join(g["stg_netlify__form_submissions"], g["dim_organizations"],
                    ["organization_slug"], ["organization_id"])
    return j.select("form_submission_id", "organization_slug", "organization_id")


register("op_left_join", op_left_join, O.with_query("""
select f.form_submission_id, f.organization_slug, o.organization_id
from stg_netlify__form_submissions as f
left join dim_organizations as o on f.organization_slug = o.organization_slug""",
    ["stg_netlify__form_submissions", "dim_organizations"]))


def combine_properties_query(spark, sf_dir):
    exports = events_by_property(spark, sf_dir)
    combined = combine_properties(
        {PROPERTY_IDS[0]: exports[1], PROPERTY_IDS[1]: exports[2]}, PROPERTY_START_DATE)
    return combined.select("property_id", "event_id", "event_date", "user_id", "event_type", "value")


register("combine_properties", combine_properties_query, f"""
select cast(case when event_id % 2 = 0 then {PROPERTY_IDS[0]} else {PROPERTY_IDS[1]} end as bigint)
         as property_id,
       event_id, cast(ts as date) as event_date, user_id, event_type, value
from events
where cast(ts as date) >= date '2022-01-01'""")


# --- aggregates -------------------------------------------------------------

def op_first_event_date(spark, sf_dir):
    g = graph(spark, sf_dir)
    return g["int_email_subscription_events"].groupBy("subscriber_id").agg(
        F.min(C.utc_date("event_ts")).alias("first_event_date"))


register("op_first_event_date", op_first_event_date, O.with_query("""
select subscriber_id, min(cast(event_ts as date)) as first_event_date
from int_email_subscription_events group by subscriber_id""", ["int_email_subscription_events"]))


def op_conditional_min_max(spark, sf_dir):
    g = graph(spark, sf_dir)
    et, ts = F.col("event_type"), F.col("event_ts")
    return g["int_email_message_events"].groupBy("source", "source_email_id").agg(
        min_if(et == "sent", ts).alias("first_sent_ts"),
        max_if(et == "sent", ts).alias("last_sent_ts"),
        min_if(et == "opened", ts).alias("first_opened_ts"),
        max_if(et == "clicked", ts).alias("last_clicked_ts"),
        count_if(et == "opened").alias("n_opened"),
        count_if(et == "clicked").alias("n_clicked"),
    )


register("op_conditional_min_max", op_conditional_min_max, O.with_query("""
select source, source_email_id,
       min(case when event_type = 'sent' then event_ts end) as first_sent_ts,
       max(case when event_type = 'sent' then event_ts end) as last_sent_ts,
       min(case when event_type = 'opened' then event_ts end) as first_opened_ts,
       max(case when event_type = 'clicked' then event_ts end) as last_clicked_ts,
       count(*) filter (where event_type = 'opened') as n_opened,
       count(*) filter (where event_type = 'clicked') as n_clicked
from int_email_message_events group by source, source_email_id""", ["int_email_message_events"]))


def op_logical_or(spark, sf_dir):
    g = graph(spark, sf_dir)
    ev = g["int_email_subscription_events"]
    return ev.groupBy("subscriber_id").agg(
        F.bool_or(F.col("subscriber_event_type") == "unsubscribed").alias("ever_unsubscribed"),
        F.bool_or(F.col("source") == "sendgrid").alias("seen_on_sendgrid"),
        F.bool_or(F.col("resend_contact_id").startswith("c-")).alias("has_contact_id"),
    )


register("op_logical_or", op_logical_or, O.with_query("""
select subscriber_id,
       bool_or(subscriber_event_type = 'unsubscribed') as ever_unsubscribed,
       bool_or(source = 'sendgrid') as seen_on_sendgrid,
       bool_or(starts_with(resend_contact_id, 'c-')) as has_contact_id
from int_email_subscription_events group by subscriber_id""", ["int_email_subscription_events"]))


def op_provider_cutover(spark, sf_dir):
    g = graph(spark, sf_dir)
    contacts = g["stg_resend__contacts"]
    return contacts.agg(
        F.date_add(F.min(C.utc_date("backfilled_ts")), 1).alias("resend_start_date"),
        F.count(F.lit(1)).alias("n_contacts"))


register("op_provider_cutover", op_provider_cutover, O.with_query("""
select min(cast(backfilled_ts as date)) + 1 as resend_start_date, count(*) as n_contacts
from stg_resend__contacts""", ["stg_resend__contacts"]))


def op_range_join_dates(spark, sf_dir):
    """Per-subscriber day spine (a left range join days >= first day)."""
    g = graph(spark, sf_dir)
    firsts = g["int_email_subscription_events"].groupBy("subscriber_id").agg(
        F.min(C.utc_date("event_ts")).alias("first_event_date"))
    return per_key_spine(firsts, "subscriber_id", "first_event_date", AS_OF)


register("op_range_join_dates", op_range_join_dates, O.with_query("""
select s.subscriber_id, d.date_day
from (select subscriber_id, min(cast(event_ts as date)) as first_event_date
      from int_email_subscription_events group by subscriber_id) as s
left join dates as d on d.date_day >= s.first_event_date""", ["int_email_subscription_events", "dates"]))


def op_cutover_scalar(spark, sf_dir):
    """Scalar subquery (one-row aggregate) used inside a per-row expression."""
    g = graph(spark, sf_dir)
    cut = provider_cutover(g["stg_resend__contacts"])
    ev = g["int_email_subscription_events"]
    return ev.select("subscriber_id", "source", "event_ts",
                     (C.utc_date("event_ts") < cut).alias("before_cutover"))


register("op_cutover_scalar", op_cutover_scalar, O.with_query("""
select subscriber_id, source, event_ts,
       cast(event_ts as date) < (select min(cast(backfilled_ts as date)) + 1 from stg_resend__contacts)
         as before_cutover
from int_email_subscription_events""", ["int_email_subscription_events", "stg_resend__contacts"]))


# --- data quality -----------------------------------------------------------

def dq_not_null(spark, sf_dir):
    """Jobs whose organization file is missing (NOT NULL organization_id)."""
    g = graph(spark, sf_dir)
    return _render_arrays(Q.failing_not_null(g["dim_jobs"], "organization_id"))


register("dq_not_null", dq_not_null, O.with_query(
    "select * replace (array_to_string(tags, ',') as tags) from dim_jobs "
    "where organization_id is null", ["dim_jobs"]))


def dq_unique(spark, sf_dir):
    """Duplicated event keys: an address listed twice in one webhook."""
    g = graph(spark, sf_dir)
    return Q.failing_unique(g["stg_resend__email_events"], "email_event_id")


register("dq_unique", dq_unique, O.with_query("""
select email_event_id, count(*) as n_records
from stg_resend__email_events where email_event_id is not null
group by email_event_id having count(*) > 1""", ["stg_resend__email_events"]))


def dq_accepted_values(spark, sf_dir):
    g = graph(spark, sf_dir)
    return Q.failing_accepted_values(
        g["stg_resend__contact_events"], "event_type", ("contact.created", "contact.updated"))


register("dq_accepted_values", dq_accepted_values, O.with_query("""
select event_type, count(*) as n_records
from stg_resend__contact_events
where event_type not in ('contact.created', 'contact.updated')
group by event_type""", ["stg_resend__contact_events"]))


def dq_relationships(spark, sf_dir):
    """Form submissions naming an organization slug with no organization."""
    g = graph(spark, sf_dir)
    return Q.failing_relationships(g["stg_netlify__form_submissions"], "organization_slug",
                                   g["dim_organizations"], "organization_slug")


register("dq_relationships", dq_relationships, O.with_query("""
select f.organization_slug
from stg_netlify__form_submissions as f
where f.organization_slug is not null
  and not exists (select 1 from dim_organizations as o
                  where o.organization_slug = f.organization_slug)""",
    ["stg_netlify__form_submissions", "dim_organizations"]))


def dq_normalized_email(spark, sf_dir):
    """Raw Webflow addresses that are not in normalized form."""
    s = _src(spark, sf_dir, "webflow_form_submits")
    return Q.failing_normalized_email(s, "data")


register("dq_normalized_email", dq_normalized_email, O.with_query(f"""
select data from webflow_form_submits
where data is not null and data != {O.norm_email('data')}""", ["webflow_form_submits"]))


def dq_report(spark, sf_dir):
    """All 161 declared checks: one row per check with its failure count.
    Models are written once and the checks read the files."""
    g = graph(spark, sf_dir, materialize=True)
    return Q.run_suite(g.__getitem__)


def _dq_report_sql() -> str:
    parts = []
    for c in Q.DECLARED:
        lit = f"'{c.model}' as model, '{c.column}' as column_name, '{c.kind}' as check_name"
        col = c.column
        if c.kind == "not_null":
            q = f"select {lit}, count(*) filter (where {col} is null) as failures from {c.model}"
        elif c.kind == "normalized_email":
            q = (f"select {lit}, count(*) filter (where {col} is not null and "
                 f"{col} != {O.norm_email(col)}) as failures from {c.model}")
        elif c.kind == "unique":
            q = (f"select {lit}, (select count(*) from (select {col} from {c.model} where {col} "
                 f"is not null group by {col} having count(*) > 1) as d) as failures")
        elif c.kind == "accepted_values":
            vals = ", ".join(v if v in ("true", "false") else f"'{v}'" for v in c.values)
            q = (f"select {lit}, (select count(distinct {col}) from {c.model} "
                 f"where {col} not in ({vals})) as failures")
        else:
            pm, pc = c.parent
            q = (f"select {lit}, (select count(*) from {c.model} as ch where ch.{col} is not null "
                 f"and not exists (select 1 from {pm} as p where p.{pc} = ch.{col})) as failures")
        parts.append(q)
    needs = sorted({c.model for c in Q.DECLARED} | {c.parent[0] for c in Q.DECLARED if c.parent})
    return O.with_query("select * from (\n" + "\nunion all\n".join(parts) + "\n) as report", needs)


register("dq_report", dq_report, _dq_report_sql())


# --- contracts --------------------------------------------------------------

def _contract_frames(spark, sf_dir):
    g = graph(spark, sf_dir, materialize=True)
    return g, list(CONTRACTS)


def contract_report(spark, sf_dir):
    """Every contract column of the 8 marts: type check and NULL count."""
    g, marts = _contract_frames(spark, sf_dir)
    from relaymart.operators.sets import union_all
    return union_all([null_counts(g[m], m) for m in marts])


_SPARK_TYPE = {"string": "string", "json": "string", "bool": "boolean", "int64": "bigint",
               "date": "date", "timestamp": "timestamp_ntz", "array<string>": "array<string>"}


def _contract_sql(only_violations: bool) -> str:
    parts = []
    for mart, cols in CONTRACTS.items():
        for name, typ, req in cols:
            if only_violations and not req:
                continue
            n = f"count(*) filter (where {name} is null)"
            if only_violations:
                parts.append(f"select '{mart}' as mart, '{name}' as column_name, {n} as n_nulls "
                             f"from {mart} having {n} > 0")
            else:
                parts.append(
                    f"select '{mart}' as mart, '{name}' as column_name, '{typ}' as contract_type, "
                    f"'{_SPARK_TYPE[typ]}' as actual_type, {str(req).lower()} as is_required, "
                    f"true as type_matches, {n} as n_nulls from {mart}")
    return O.with_query("select * from (\n" + "\nunion all\n".join(parts) + "\n) as r",
                        list(CONTRACTS))


register("contract_report", contract_report, _contract_sql(False))


def not_null_constraints(spark, sf_dir):
    """NOT NULL constraint violations of the 8 marts (one pass per mart)."""
    g, marts = _contract_frames(spark, sf_dir)
    from relaymart.operators.sets import union_all
    return union_all([not_null_violations(g[m], m) for m in marts])


register("not_null_constraints", not_null_constraints, _contract_sql(True))


# --- freshness --------------------------------------------------------------

def source_freshness(spark, sf_dir):
    apply_defaults(spark)
    srcs = load_sources(spark, sf_dir, [d.source for d in FRESHNESS])
    return freshness_report(srcs, FRESHNESS_AS_OF_TS)


def _freshness_sql() -> str:
    loaded = {
        "content_jobs": "make_timestamp(cast(round(cast(_dlt_load_id as double) * 1000) as bigint) * 1000)",
        "content_organizations": "make_timestamp(cast(round(cast(_dlt_load_id as double) * 1000) as bigint) * 1000)",
        "netlify_form_submissions": "loaded_ts",
        "resend_wh_emails": "webhook_received_at",
    }
    now = f"timestamp '{FRESHNESS_AS_OF_TS}'"
    parts = []
    for d in FRESHNESS:
        age = f"(epoch_ms({now}) - epoch_ms(m))"
        parts.append(
            f"select '{d.source}' as source, m as max_loaded_at, round({age} / 3600000.0, 3) as age_hours, "
            f"case when m is null then 'error' when {age} > {d.error_hours * 3600000} then 'error' "
            f"when {age} > {d.warn_hours * 3600000} then 'warn' else 'pass' end as status, "
            f"{d.warn_hours} as warn_after_hours, {d.error_hours} as error_after_hours "
            f"from (select max({loaded[d.source]}) as m from {d.source}) as t")
    return O.with_query("select * from (\n" + "\nunion all\n".join(parts) + "\n) as f",
                        [d.source for d in FRESHNESS])


register("source_freshness", source_freshness, _freshness_sql())


# --- sinks: export, incremental ----------------------------------------------

def _export(relation: str):
    def run(spark, sf_dir):
        g = graph(spark, sf_dir)
        path = export_parquet(g[relation], work_path(spark, f"export-{relation}"))
        return _render_arrays(spark.read.parquet(path))
    run.__name__ = f"export_{relation}"
    return run


register("export_jobs", _export("dim_jobs"),
         O.model_sql("dim_jobs", select="select * replace (array_to_string(tags, ',') as tags) from dim_jobs"))
register("export_organizations", _export("dim_organizations"), O.model_sql("dim_organizations"))


def _event_days(spark, sf_dir, factor: float) -> DataFrame:
    ev = read_driver_table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", "event_type",
                     (F.col("value") * factor).alias("value"),
                     C.utc_date("ts").alias("event_date"))


def incremental_window(spark, sf_dir):
    """Initial full build, then a 7-day trailing rebuild from restated rows
    (values doubled, one day of the window gone): only the last 7 days (as of
    the run date) change, and the day without rows is removed."""
    apply_defaults(spark)
    path = work_path(spark, "incremental")
    rebuild_trailing_window(spark, _event_days(spark, sf_dir, 1.0), path, "event_date", INCREMENTAL_AS_OF)
    restated = _event_days(spark, sf_dir, 2.0).filter(F.col("event_date") != F.lit(INCREMENTAL_VANISHED).cast("date"))
    rebuild_trailing_window(spark, restated, path, "event_date", INCREMENTAL_AS_OF)
    return spark.read.parquet(path).select("event_id", "user_id", "event_type", "value", "event_date")


def _incremental_sql(full: bool, label: str | None = None) -> str:
    restated = "true" if full else (
        f"cast(ts as date) between date '{INCREMENTAL_AS_OF}' - {STATIC_INCREMENTAL_DAYS} and date '{INCREMENTAL_AS_OF}'")
    lab = f"'{label}' as table_kind, " if label else ""
    return (f"select {lab}event_id, user_id, event_type, "
            f"case when {restated} then value * 2.0 else value * 1.0 end as value, "
            f"cast(ts as date) as event_date from events")


register("incremental_window", incremental_window,
         _incremental_sql(False) + f" where cast(ts as date) <> date '{INCREMENTAL_VANISHED}'")


def incremental_full_refresh(spark, sf_dir):
    """Full refresh on an unprotected table rewrites every day; a protected
    table is still only rebuilt over the trailing window."""
    apply_defaults(spark)
    out = []
    for kind, protected in (("unprotected", False), ("protected", True)):
        path = work_path(spark, f"incremental-{kind}")
        rebuild_trailing_window(spark, _event_days(spark, sf_dir, 1.0), path, "event_date",
                                INCREMENTAL_AS_OF)
        rebuild_trailing_window(spark, _event_days(spark, sf_dir, 2.0), path, "event_date",
                                INCREMENTAL_AS_OF, full_refresh=True, protected=protected)
        out.append(spark.read.parquet(path).select(
            F.lit(kind).alias("table_kind"), "event_id", "user_id", "event_type", "value",
            "event_date"))
    return out[0].unionByName(out[1])


register("incremental_full_refresh", incremental_full_refresh,
         _incremental_sql(True, "unprotected") + "\nunion all\n" + _incremental_sql(False, "protected"))


# --- changed days, sets of marts, publishing -----------------------------------

RESTATED_DAY, LATE_DAY, QUIET_FROM = "2024-01-25", "2024-01-10", "2024-01-23"


def incremental_changed_days(spark, sf_dir):
    """The stored rows of two tables, each with what the rebuild said of its day:
    one with a restated, an emptied and a late day, one whose window went quiet.
    Emptied days stand for themselves, without an event."""
    apply_defaults(spark)
    day, base = F.col("event_date"), _event_days(spark, sf_dir, 1.0)
    changed = base.filter(day != F.lit(INCREMENTAL_VANISHED).cast("date")).withColumn(
        "value", F.col("value") * F.when(day == F.lit(RESTATED_DAY).cast("date"), 2.0)
        .when(day == F.lit(LATE_DAY).cast("date"), 3.0).otherwise(1.0))
    out = []
    for kind, rows in (("changed", changed), ("quiet", base.filter(day < F.lit(QUIET_FROM).cast("date")))):
        path = work_path(spark, f"ledger-{kind}")
        rebuild_changed_days(spark, base, path, "event_date", INCREMENTAL_AS_OF)
        found = rebuild_changed_days(spark, rows, path, "event_date", INCREMENTAL_AS_OF)
        said = [(d, what) for what in ("rewritten", "emptied", "unchanged", "late") for d in getattr(found, what)]
        status = spark.createDataFrame(said, "event_date date, day_status string")  # a row a day
        stored = spark.read.parquet(path).select("event_id", "user_id", "event_type", "value", "event_date")
        out.append(stored.join(F.broadcast(status), "event_date", "full").select(
            F.lit(kind).alias("table_kind"), "event_id", "user_id", "event_type", "value", "event_date",
            F.coalesce("day_status", F.lit("before")).alias("day_status")))
    return out[0].unionByName(out[1])


def _changed_days_sql() -> str:
    first = f"date '{INCREMENTAL_AS_OF}' - {STATIC_INCREMENTAL_DAYS}"
    return f"""
with e as (select event_id, user_id, event_type, value, cast(ts as date) as d,
  cast(ts as date) between {first} and date '{INCREMENTAL_AS_OF}' as due from events)
select 'changed' as table_kind, event_id, user_id, event_type,
  case when d = date '{RESTATED_DAY}' then value * 2.0 else value * 1.0 end as value, d as event_date,
  case when d = date '{RESTATED_DAY}' then 'rewritten' when d = date '{LATE_DAY}' then 'late'
       when due then 'unchanged' else 'before' end as day_status
from e where d <> date '{INCREMENTAL_VANISHED}'
union all
select distinct 'changed', null, null, null, null, d, 'emptied' from e where d = date '{INCREMENTAL_VANISHED}'
union all
select 'quiet', event_id, user_id, event_type, value * 1.0, d, 'before' from e where not due
union all
select distinct 'quiet', null, null, null, null, d, 'emptied' from e where due"""


register("incremental_changed_days", incremental_changed_days, _changed_days_sql())


def mart_generation(spark, sf_dir):
    """Two sets of the dimensions are switched to, the second without inactive
    rows, then the first again by a roll-back, then the second anew: what readers
    see after each step."""
    from relaymart.sinks import generations
    from relaymart.sinks.publish import write_table
    g, marts_dir = graph(spark, sf_dir), work_path(spark, "sets")
    whole = {m: g[m] for m in ("dim_organizations", "dim_email_subscribers")}
    some = {"dim_organizations": whole["dim_organizations"].filter("is_active"),
            "dim_email_subscribers": whole["dim_email_subscribers"].filter("is_subscribed")}
    keys = {"dim_organizations": "organization_id", "dim_email_subscribers": "subscriber_id"}
    out = []

    def look(step):
        for mart, key in keys.items():
            out.append(generations.read_mart(spark, marts_dir, mart, whole[mart].schema).select(
                F.lit(step).alias("step"), F.lit(mart).alias("mart"), F.col(key).alias("row_id")))

    for step, marts in (("first", whole), ("second", some), ("rolled back", None)):
        if marts is None:
            generations.roll_back(spark, marts_dir)
        else:
            generation = generations.begin()
            for mart, df in marts.items():
                write_table(df, f"{generations.folder(marts_dir, generation)}/{mart}")
            generations.switch(spark, marts_dir, generation, marts)
            generations.clean(spark, marts_dir)
        look(step)
    return union_all(out)


register("mart_generation", mart_generation, O.with_query("""
select s.step, m.mart, m.row_id
from (select unnest(['first', 'second', 'rolled back']) as step) as s
join (select 'dim_organizations' as mart, organization_id as row_id, is_active as kept from dim_organizations
      union all
      select 'dim_email_subscribers', subscriber_id, is_subscribed from dim_email_subscribers) as m
  on s.step <> 'second' or m.kept""", ["dim_organizations", "dim_email_subscribers"]))


def publish_round_trip(spark, sf_dir):
    """A publish, one that died before its pointer, and another: both exports as
    readers get them, with the counts that the pointer holds."""
    from relaymart.sinks import versions
    from relaymart.sinks.publish import publish_exports, read_published
    g, base = graph(spark, sf_dir), work_path(spark, "published")
    orgs = g["dim_organizations"]
    publish_exports(spark, {"dim_jobs": orgs, "dim_organizations": orgs.filter("is_active")}, base)
    export_parquet(orgs.filter("is_active"), f"{base}/runs/dead/jobs")
    versions.claim(spark, f"{base}/_pointers")
    pointer = publish_exports(spark, {"dim_jobs": g["dim_jobs"], "dim_organizations": orgs}, base, dead_after=0)
    n = {r.name: r.n_rows for r in pointer.collect()}  # a row an export
    return union_all([
        read_published(spark, base, name).select(F.lit(name).alias("name"), F.col(key).alias("row_id"),
                                                 F.lit(n[name]).cast("long").alias("n_rows"))
        for name, key in (("jobs", "job_id"), ("organizations", "organization_id"))])


register("publish_round_trip", publish_round_trip, O.with_query("""
select 'jobs' as name, job_id as row_id, count(*) over () as n_rows from dim_jobs
union all
select 'organizations', organization_id, count(*) over () from dim_organizations""", ["dim_jobs", "dim_organizations"]))


def daily_state_incremental(spark, sf_dir):
    """The daily fact, built whole as of an earlier day from events that are
    still to be restated in its window, then brought up to date from its snapshot:
    the rows of a whole build."""
    from relaymart.streaming.daily_state import read_daily_state, refresh_daily_state
    g, path = graph(spark, sf_dir), work_path(spark, "daily-state")
    events, contacts = g["int_email_subscription_events"], g["stg_resend__contacts"]
    day = C.utc_date("event_ts")
    then = events.filter(day.isNull() | (day != F.lit(RESTATED_DAY).cast("date"))).withColumn(
        "event_ts", F.when(day == F.lit(INCREMENTAL_VANISHED).cast("date"),
                           F.timestamp_add("HOUR", F.lit(-24), F.col("event_ts"))).otherwise(F.col("event_ts")))
    refresh_daily_state(spark, then, contacts, path, INCREMENTAL_AS_OF)
    done = refresh_daily_state(spark, events, contacts, path, AS_OF)
    return read_daily_state(spark, path).withColumn("refresh_mode", F.lit(done.mode))


register("daily_state_incremental", daily_state_incremental, O.model_sql(
    "fct_email_subscribers_daily", select="select *, 'incremental' as refresh_mode from fct_email_subscribers_daily"))


_JSON_TEXT = (("content_jobs", "frontmatter"), ("content_organizations", "frontmatter"), ("webflow_form_submits", "data"))
_JSON_MARTS = [(m, c) for m in CONTRACTS for c in json_columns(m)]


def contract_json(spark, sf_dir):
    """Rows and invalid documents of the marts' JSON columns, of the content
    sources' documents, and of a text column that holds addresses."""
    g, sources = graph(spark, sf_dir), load_sources(spark, sf_dir, [s for s, _ in _JSON_TEXT])
    return union_all([json_violations(frames[name], name, [c]) for frames, columns in ((sources, _JSON_TEXT), (g, _JSON_MARTS))
                      for name, c in columns])


register("contract_json", contract_json, O.with_query("\nunion all\n".join(
    f"select '{name}' as relation, '{c}' as column_name, count(*) as n_rows, "
    f"count(*) filter (where {c} is not null and not json_valid({c})) as n_invalid from {name}"
    for name, c in [*_JSON_TEXT, *_JSON_MARTS]), [name for name, _ in [*_JSON_TEXT, *_JSON_MARTS]]))


def named_views(spark, sf_dir):
    """SQL text over the named models: per sender and event type, events,
    recipients and those of them that subscribed by form or address book."""
    from relaymart.plans.views import create_views
    create_views(spark, graph(spark, sf_dir), prefix="named_views_")
    return spark.sql(_views_sql("named_views_"))


def _views_sql(prefix: str) -> str:
    return f"""
select e.source, e.event_type, count(*) as n_events, count(distinct e.email_address) as n_recipients,
       count(distinct s.subscriber_id) as n_subscribers,
       count(distinct case when f.email_address is not null then e.email_address end) as n_by_form
from {prefix}int_email_message_events as e
left join {prefix}int_email_subscribers as s on s.email_address = e.email_address
left join (select email_address from {prefix}stg_netlify__form_submissions
           union
           select email_address from {prefix}stg_webflow__form_submissions) as f on f.email_address = e.email_address
where cast(e.event_ts as date) in (select date_day from {prefix}dates)
group by e.source, e.event_type"""


register("named_views", named_views, O.with_query(_views_sql(""), [
    "int_email_message_events", "int_email_subscribers", "stg_netlify__form_submissions", "stg_webflow__form_submissions", "dates"]))


def bucketed_lookup(spark, sf_dir):
    """Message events with what two bucketed dimensions say of them."""
    from relaymart.sinks import buckets
    g, database = graph(spark, sf_dir), "relaymart_buckets"
    dims = ("dim_email_subscribers", "dim_email_messages")
    for name in dims:
        path, key = work_path(spark, f"buckets-{name}"), buckets.KEYS[name]
        buckets.write_buckets(g[name], path, key, 16)
        buckets.register_buckets(spark, database, name, path, key, 16)
    subscribers, messages = (spark.table(f"{database}.{name}") for name in dims)
    return (g["fct_email_events"].select("email_event_id", "subscriber_id", "email_id", "event_type")
            .join(subscribers.select("subscriber_id", "email_address", "is_subscribed"), "subscriber_id", "left")
            .join(messages.select("email_id", "source", "sent_ts"), "email_id", "left"))


register("bucketed_lookup", bucketed_lookup, O.with_query("""
select e.email_event_id, e.subscriber_id, e.email_id, e.event_type, s.email_address, s.is_subscribed, m.source, m.sent_ts
from fct_email_events as e
left join dim_email_subscribers as s on s.subscriber_id = e.subscriber_id
left join dim_email_messages as m on m.email_id = e.email_id""", ["fct_email_events", "dim_email_subscribers", "dim_email_messages"]))
