"""DuckDB oracle: every model re-stated as plain SQL over the driver's views.

The text follows the behaviour stated for each model, in another form than the
Spark code (as-of joins, scalar lookups, pivots of spans), and inlines the provider sources as CTEs (see
:mod:`relaymart.sources.fixtures`), so a query can be checked against an
engine that never saw the Spark plan. ``model_sql(name)`` returns a complete
``WITH ... SELECT`` statement with just the CTEs the model needs.
"""

from __future__ import annotations

import re

from relaymart.sources.fixtures import duckdb_source_sql

AS_OF = "2024-02-15"

# Fixed values (must match the reference's results), stated here again so that
# a wrong value in the Spark code does not pass unnoticed.
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
PRIVACY_PROXY_PATTERN = r"(googleimageproxy|gmailimageproxy|ggpht\.com|emailproxy|privacy|proxy)"
BOT_SCANNER_PATTERN = (
    r"(bot|crawl|spider|scanner|scan|preview|proofpoint|mimecast|barracuda"
    r"|safelinks|urldefense|curl/|wget/|python-requests|go-http-client"
    r"|headless|phantom|selenium)"
)


def sk(*cols: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '{SURROGATE_KEY_NULL}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def norm_email(x: str) -> str:
    return f"lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"


def norm_event(x: str) -> str:
    v = f"lower(nullif({x}, ''))"
    return (f"case {v} when 'processed' then 'sent' when 'open' then 'opened' "
            f"when 'click' then 'clicked' when 'group_resubscribe' then 'resubscribed' "
            f"else replace({v}, 'email.', '') end")


def bot_reason(et: str, ua: str) -> str:
    agent = f"lower(coalesce({ua}, ''))"
    return (f"case when {et} not in ('opened', 'clicked') then null "
            f"when regexp_matches({agent}, '{PRIVACY_PROXY_PATTERN}') then 'privacy_or_image_proxy' "
            f"when regexp_matches({agent}, '{BOT_SCANNER_PATTERN}') then 'bot_or_security_scanner' end")


def jv(doc: str, key: str, typ: str = "varchar") -> str:
    path = f"'$.{key}'"
    v = (f"case when json_type({doc}, {path}) in ('OBJECT', 'ARRAY') then null "
         f"else json_extract_string({doc}, {path}) end")
    return v if typ == "varchar" else f"cast({v} as {typ})"


def slug(path: str, pos: int) -> str:
    return f"split(regexp_replace({path}, '[/.]', '/', 'g'), '/')[{pos + 1}]"


def json_obj(*pairs: tuple[str, str]) -> str:
    body = ", ".join(f"'{k}', {v}" for k, v in pairs)
    return f"cast(json_merge_patch('{{}}', json_object({body})) as varchar)"


def _models(as_of: str) -> dict[str, str]:
    m: dict[str, str] = {}
    m["stg_jobs"] = f"""
select {slug('file_path', 2)} as organization_slug,
       {slug('file_path', 3)} as job_slug,
       {jv('frontmatter', 'active', 'boolean')} as is_active,
       {jv('frontmatter', 'featured', 'boolean')} as is_featured,
       {jv('frontmatter', 'date', 'date')} as date_added,
       {jv('frontmatter', 'closed_at', 'date')} as date_removed,
       {jv('frontmatter', 'title')} as title,
       {jv('frontmatter', 'url')} as posting_url,
       {jv('frontmatter', 'description')} as description,
       {jv('frontmatter', 'location')} as location,
       {jv('frontmatter', 'salary')} as salary,
       case when json_type(frontmatter, '$.tags') = 'ARRAY'
            then cast(json_extract(frontmatter, '$.tags') as varchar[]) end as tags
from content_jobs"""
    m["stg_organizations"] = f"""
select {slug('file_path', 2)} as organization_slug,
       {jv('frontmatter', 'active', 'boolean')} as is_active,
       {jv('frontmatter', 'featured', 'boolean')} as is_featured,
       {jv('frontmatter', 'title')} as name,
       {jv('frontmatter', 'about')} as description,
       {jv('frontmatter', 'about_short')} as description_short,
       {jv('frontmatter', 'website')} as organization_url,
       coalesce({jv('frontmatter', 'headcount')}, {jv('frontmatter', 'headcount_inferred')}) as headcount,
       coalesce({jv('frontmatter', 'location')}, {jv('frontmatter', 'location_inferred')}) as location
from content_organizations"""
    nz = lambda k: f"nullif({jv('form_data', k)}, '')"
    m["stg_netlify__form_submissions"] = f"""
select {sk("'netlify'", 'submission_id')} as form_submission_id,
       submission_id as source_form_submission_id,
       'netlify' as source,
       form_name,
       {norm_email(jv('form_data', 'email'))} as email_address,
       {nz('job_slug')} as job_slug,
       {nz('org_slug')} as organization_slug,
       {nz('posthog_distinct_id')} as posthog_distinct_id,
       {nz('posthog_session_id')} as posthog_session_id,
       {json_obj(('job_title', nz('job_title')), ('job_url', nz('job_url')))} as form_submission_details,
       submitted_ts,
       loaded_ts
from netlify_form_submissions
where submission_id is not null"""
    m["stg_webflow__form_submissions"] = f"""
select {sk("'webflow'", 'event_id')} as form_submission_id,
       event_id as source_form_submission_id,
       'webflow' as source,
       'newsletter' as form_name,
       {norm_email('data')} as email_address,
       cast(null as varchar) as job_slug,
       cast(null as varchar) as organization_slug,
       cast(null as varchar) as posthog_distinct_id,
       cast(null as varchar) as posthog_session_id,
       '{{}}' as form_submission_details,
       event_timestamp as submitted_ts
from webflow_form_submits
where event_id is not null"""
    m["stg_resend__contact_events"] = f"""
select {norm_event('event_type')} as event_type,
       event_created_at as event_created_ts,
       contact_id,
       {norm_email('email')} as email_address,
       not unsubscribed as is_subscribed
from resend_wh_contacts
where email is not null"""
    m["stg_resend__contacts"] = f"""
select contact_id,
       {norm_email('email')} as email_address,
       not unsubscribed as is_subscribed,
       created_at as contact_created_ts,
       backfilled_at as backfilled_ts
from resend_contacts_backfill
where email is not null"""
    m["stg_resend__email_events"] = f"""
select {sk('e.id', norm_email('r.addr'))} as email_event_id,
       {norm_event('e.event_type')} as event_type,
       e.event_created_at as event_created_ts,
       e.email_id as message_id,
       {norm_email('r.addr')} as email_address,
       nullif(e.subject, '') as subject,
       nullif(e.click_ip_address, '') as click_ip_address,
       nullif(e.click_link, '') as click_link,
       e.click_timestamp as click_ts,
       nullif(e.click_user_agent, '') as click_user_agent
from resend_wh_emails as e, unnest(e.to_addresses) as r(addr)
where r.addr is not null"""
    m["stg_resend__emails_backfill"] = f"""
select {sk('e.email_id', norm_email('r.addr'))} as email_event_id,
       e.email_id as message_id,
       {norm_email('r.addr')} as email_address,
       nullif(e.subject, '') as subject,
       e.created_at as email_created_ts
from resend_emails_backfill as e, unnest(e.to_addresses) as r(addr)
where r.addr is not null"""
    m["stg_sendgrid__email_events"] = f"""
select sg_event_id as event_id,
       sg_message_id as message_id,
       {norm_email('email')} as email_address,
       {norm_event('event')} as event_type,
       make_timestamp(cast("timestamp" as bigint) * 1000000) as event_ts,
       nullif(url, '') as link_url,
       nullif(ip, '') as ip_address,
       nullif(useragent, '') as user_agent
from sendgrid_webhooks
where email is not null and event is not null"""
    # one row shape for both providers; a backfilled send counts unless the
    # (message, address) pair is among those a webhook reported as sent
    m["provider_events"] = """
select 'sendgrid' as source, event_id as email_event_id, message_id as source_email_id,
       email_address, event_type, event_ts, user_agent, ip_address, link_url,
       cast(null as varchar) as subject, false as is_backfill
from stg_sendgrid__email_events
union all by name
select 'resend' as source, email_event_id, message_id as source_email_id, email_address,
       event_type, if(event_type = 'clicked', coalesce(click_ts, event_created_ts), event_created_ts) as event_ts,
       click_user_agent as user_agent, click_ip_address as ip_address, click_link as link_url,
       subject, false as is_backfill
from stg_resend__email_events
union all by name
select 'resend' as source, b.email_event_id, b.message_id as source_email_id, b.email_address,
       'sent' as event_type, b.email_created_ts as event_ts, b.subject, true as is_backfill
from stg_resend__emails_backfill as b
left join (select message_id, email_address, count(*) as n_sent
           from stg_resend__email_events where event_type = 'sent' group by all) as known
  on known.message_id = b.message_id and known.email_address = b.email_address
where known.n_sent is null"""
    m["int_email_message_events"] = f"""
select p.*, {sk('source', 'source_email_id')} as email_id,
       {bot_reason('event_type', 'user_agent')} as privacy_or_bot_reason
from provider_events as p"""
    m["int_email_messages"] = """
select email_id, source, source_email_id, min(subject) as subject,
       min(event_ts) filter (where event_type = 'sent') as sent_ts
from int_email_message_events
group by email_id, source, source_email_id"""
    # which kind of lifecycle change each record stands for, as a table: a
    # contact's snapshot is up to two changes, every other record one
    m["int_email_subscription_events"] = f"""
select {sk('email_address')} as subscriber_id, source, resend_contact_id, email_address,
       change.kind as subscriber_event_type, change.ts as event_ts
from (
    select 'resend' as source, contact_id as resend_contact_id, email_address,
           unnest([{{'kind': 'subscribed', 'ts': contact_created_ts, 'holds': true}},
                   {{'kind': 'unsubscribed', 'ts': backfilled_ts, 'holds': not is_subscribed}}]) as change
    from stg_resend__contacts
    union all
    select 'resend', contact_id, email_address,
           {{'kind': if(is_subscribed, 'subscribed', 'unsubscribed'), 'ts': event_created_ts,
             'holds': event_type in ('contact.created', 'contact.updated')}}
    from stg_resend__contact_events
    union all
    select source, null, email_address,
           {{'kind': 'subscribed', 'ts': event_ts, 'holds': event_type = 'resubscribed'}}
    from int_email_message_events
    where source = 'sendgrid'
) as records
where change.holds"""
    # first and last change of either kind, looked up per subscriber
    m["lifecycle_spans"] = """
select subscriber_id, email_address, subscriber_event_type as kind,
       min(event_ts) as first_ts, max(event_ts) as last_ts
from int_email_subscription_events
group by all"""
    m["int_email_subscribers"] = """
select p.subscriber_id, p.email_address, p.resend_contact_id,
       p.resend_contact_id is not null and (off.last_ts is null or s.last_ts > off.last_ts) as is_subscribed,
       s.first_ts as min_subscribed_ts, s.last_ts as max_subscribed_ts,
       off.first_ts as min_unsubscribed_ts, off.last_ts as max_unsubscribed_ts
from (select subscriber_id, email_address, min(resend_contact_id) as resend_contact_id
      from int_email_subscription_events group by all) as p
left join lifecycle_spans as s on s.subscriber_id = p.subscriber_id and s.kind = 'subscribed'
left join lifecycle_spans as off on off.subscriber_id = p.subscriber_id and off.kind = 'unsubscribed'"""
    m["dates"] = f"""
select cast(d as date) as date_day
from (select unnest(generate_series(
        cast((select min(cast(event_ts as date)) from int_email_subscription_events) as timestamp),
        timestamp '{as_of} 00:00:00', interval 1 day)) as d) as g"""
    m["dim_organizations"] = f"""
select {sk('organization_slug')} as organization_id, organization_slug, is_active,
       is_featured, name, description, description_short, organization_url, headcount, location
from stg_organizations"""
    m["dim_jobs"] = f"""
select {sk('j.organization_slug', 'j.job_slug')} as job_id, o.organization_id,
       j.organization_slug, j.job_slug, j.is_active, j.is_featured, j.date_added,
       j.date_removed, j.title, j.posting_url, j.description, j.location, j.salary, j.tags
from stg_jobs as j
left join dim_organizations as o on j.organization_slug = o.organization_slug"""
    m["dim_email_messages"] = """
select email_id, source, source_email_id, subject, sent_ts from int_email_messages"""
    m["dim_email_subscribers"] = """
select subscriber_id, email_address, resend_contact_id, is_subscribed, min_subscribed_ts,
       max_subscribed_ts, min_unsubscribed_ts, max_unsubscribed_ts
from int_email_subscribers"""
    # a subscriber's id follows from the address, for addresses with a lifecycle
    m["fct_email_events"] = f"""
select email_event_id,
       case when email_address in (select email_address from lifecycle_spans)
            then {sk('email_address')} end as subscriber_id,
       email_id, event_type, event_ts,
       event_type in ('opened', 'clicked') as is_engagement,
       privacy_or_bot_reason is not null as is_privacy_or_bot_like,
       {json_obj(('link_url', 'link_url'), ('ip_address', 'ip_address'),
                 ('user_agent', 'user_agent'), ('is_backfill', 'is_backfill'),
                 ('is_privacy_or_bot_like', 'privacy_or_bot_reason is not null'),
                 ('privacy_or_bot_reason', 'privacy_or_bot_reason'))} as email_event_details
from int_email_message_events"""
    m["fct_email_subscriber_messages"] = f"""
select {sk('email_id', 'subscriber_id')} as email_subscriber_message_id, email_id, subscriber_id,
       min(case when event_type = 'sent' then event_ts end) as min_sent_ts,
       min(case when event_type = 'delivered' then event_ts end) as min_delivered_ts,
       min(case when event_type = 'opened' then event_ts end) as min_opened_ts,
       min(case when event_type = 'clicked' then event_ts end) as min_clicked_ts,
       count(*) filter (where event_type = 'opened') as n_events_opened,
       count(*) filter (where event_type = 'clicked') as n_events_clicked
from fct_email_events
where subscriber_id is not null
group by email_id, subscriber_id"""
    # per subscriber, provider and active day: whether a subscription came that
    # day, and the state the day ends in (last change of either kind so far)
    m["active_days"] = """
select subscriber_id, source, day, came,
       coalesce(max(last_on) over so_far > max(last_off) over so_far,
                max(last_on) over so_far is not null) as ends_subscribed
from (
    select subscriber_id, source, cast(event_ts as date) as day,
           bool_or(subscriber_event_type = 'subscribed') as came,
           max(event_ts) filter (where subscriber_event_type = 'subscribed') as last_on,
           max(event_ts) filter (where subscriber_event_type = 'unsubscribed') as last_off
    from int_email_subscription_events
    where event_ts is not null
    group by all
) as per_day
window so_far as (partition by subscriber_id, source order by day
                  range between unbounded preceding and current row)"""
    # a day's state: a subscription on that day, else the state in which the
    # last active day before it ended, with the provider in force on the day
    m["fct_email_subscribers_daily"] = f"""
with starts as (select min(cast(backfilled_ts as date)) + 1 as resend_start from stg_resend__contacts),
people as (select subscriber_id, min(cast(event_ts as date)) as first_day
           from int_email_subscription_events group by subscriber_id),
grid as (
    select p.subscriber_id, d.date_day,
           if(d.date_day < (select resend_start from starts), 'sendgrid', 'resend') as provider
    from people as p left join dates as d on d.date_day >= p.first_day
)
select {sk('g.date_day', 'g.subscriber_id')} as email_subscriber_daily_id, g.date_day, g.subscriber_id,
       coalesce(today.came, false) or coalesce(earlier.ends_subscribed, false) as is_subscribed
from grid as g
left join active_days as today
  on today.subscriber_id = g.subscriber_id and today.source = g.provider and today.day = g.date_day
asof left join active_days as earlier
  on earlier.subscriber_id = g.subscriber_id and earlier.source = g.provider and earlier.day < g.date_day"""
    # links are scalar lookups: keys follow from address and slugs that exist
    m["fct_form_submissions"] = f"""
select form_submission_id, source_form_submission_id, source, form_name,
       case when email_address in (select email_address from lifecycle_spans)
            then {sk('email_address')} end as subscriber_id,
       case when (organization_slug, job_slug) in (select (organization_slug, job_slug) from stg_jobs)
            then {sk('organization_slug', 'job_slug')} end as job_id,
       case when organization_slug in (select organization_slug from stg_organizations)
            then {sk('organization_slug')} end as organization_id,
       email_address, posthog_distinct_id, posthog_session_id, form_submission_details, submitted_ts
from (
    select * exclude (loaded_ts) from stg_netlify__form_submissions
    union all by name
    select * from stg_webflow__form_submissions
) as forms"""
    return m


def ctes(as_of: str = AS_OF) -> dict[str, str]:
    """All named CTE bodies (sources first, then models) in dependency order."""
    out = dict(duckdb_source_sql())
    out.update(_models(as_of))
    return out


def _deps(name: str, bodies: dict[str, str]) -> list[str]:
    """Names in ``bodies`` referenced by ``name``'s body, transitively, in
    an order where every CTE follows its inputs."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(n: str):
        if n in seen:
            return
        seen.add(n)
        for other in bodies:
            if other != n and re.search(rf"\b{re.escape(other)}\b", bodies[n]):
                visit(other)
        order.append(n)

    visit(name)
    return order


def with_query(select_sql: str, needs: list[str], as_of: str = AS_OF) -> str:
    """``WITH <needed CTEs> <select_sql>``."""
    bodies = ctes(as_of)
    names: list[str] = []
    for n in needs:
        for d in _deps(n, bodies):
            if d not in names:
                names.append(d)
    parts = [f"{n} as ({bodies[n].strip()})" for n in names]
    return "with " + ",\n".join(parts) + "\n" + select_sql


def model_sql(name: str, as_of: str = AS_OF, select: str | None = None) -> str:
    return with_query(select or f"select * from {name}", [name], as_of)
