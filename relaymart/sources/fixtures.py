"""Provider source tables derived from the driver's TPC-H-like tables.

The marts read nine provider tables (e-mail webhooks, contact snapshots, web
forms, content files). Those are not shipped, so each one is *derived* from a
driver table with a fixed rule. Every rule reads its whole driver table:

* ``events`` rows are routed by parity: even ids become SendGrid webhooks,
  odd ids Resend e-mail webhooks (together they cover every row); every
  ``signup`` event also produces a Resend contact webhook;
* every ``customer`` row is a Resend contact and a backfilled Resend e-mail;
* every ``part`` row is a job file, every ``supplier`` row an organization file;
* every ``orders`` row is a form submission: status ``P`` ones arrive through
  Webflow, all others through Netlify.

Each rule is written once in the SQL subset both engines share and rendered
for Spark (``SPARK_DERIVATIONS``) and for DuckDB (``duckdb_source_sql``), so the DuckDB oracle can inline the same
source as a CTE. Both texts use only ``||``, ``case``, casts and arithmetic
that mean the same in both engines.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SOURCE_NAMES = (
    "sendgrid_webhooks",
    "resend_wh_emails",
    "resend_emails_backfill",
    "resend_wh_contacts",
    "resend_contacts_backfill",
    "content_jobs",
    "content_organizations",
    "netlify_form_submissions",
    "webflow_form_submits",
)


_SG_EVENT = (
    "case event_type when 'view' then 'open' when 'click' then 'click' "
    "when 'signup' then 'group_resubscribe' when 'purchase' then 'delivered' "
    "else 'processed' end"
)
_RE_EVENT = (
    "'email.' || case event_type when 'view' then 'opened' when 'click' then "
    "'clicked' when 'signup' then 'sent' when 'purchase' then 'delivered' "
    "else case event_id % 3 when 0 then 'bounced' when 1 then 'delivery_delayed' "
    "else 'suppressed' end end"
)
_RE_SUBJECT = (
    "case when event_id % 60 % 3 = 0 then '' "
    "else 'Subject ' || cast(event_id % 60 as string) end"
)
_CONTACT_EVENT = (
    "case when event_id % 100 = 3 then 'contact.deleted' "
    "when event_id % 10 = 3 then 'contact.created' else 'contact.updated' end"
)
_FORM_NAME = (
    "case o_orderkey % 4 when 0 then 'job-apply-capture' when 1 then 'newsletter' "
    "when 2 then 'offer-review' else 'resume-review' end"
)


def _job_frontmatter(idiv: str) -> str:
    return (
        "'{\"active\":' || case when p_size > 10 then 'true' else 'false' end"
        " || ',\"featured\":false'"
        " || ',\"date\":\"2024-01-0' || cast(1 + p_partkey % 9 as string) || '\"'"
        " || case when p_size <= 10 then ',\"closed_at\":\"2024-02-0' ||"
        " cast(1 + p_partkey % 9 as string) || '\"' else '' end"
        " || ',\"title\":\"' || p_name || '\"'"
        " || ',\"url\":\"https://jobs.example.com/' || cast(p_partkey as string) || '\"'"
        " || ',\"description\":null'"
        " || ',\"salary\":\"' || cast(cast(floor(p_retailprice) as bigint) as string) || '\"'"
        " || ',\"tags\":[\"' || p_brand || '\",\"' || p_type || '\"]}'"
    )


_ORG_FRONTMATTER = (
    "'{\"active\":' || case when s_acctbal > 0 then 'true' else 'false' end"
    " || ',\"featured\":' || case when s_suppkey % 5 = 0 then 'true' else 'false' end"
    " || ',\"title\":\"' || s_name || '\"'"
    " || ',\"about\":\"About ' || s_name || '\"'"
    " || ',\"about_short\":null'"
    " || ',\"website\":\"https://org-' || cast(s_suppkey as string) || '.example.com\"'"
    " || case when s_suppkey % 3 = 0 then ',\"headcount\":\"11-50\"'"
    " else ',\"headcount_inferred\":\"51-200\"' end"
    " || case when s_suppkey % 7 = 0 then ',\"location\":\"\"' else '' end"
    " || case when s_suppkey % 4 = 0 then '' else ',\"location_inferred\":\"NATION_' ||"
    " cast(s_nationkey as string) || '\"' end || '}'"
)


def _form_data(idiv: str) -> str:
    job = f"(o_orderkey {idiv} 8)"
    org = f"(o_orderkey {idiv} 8 {idiv} 16 + case when o_orderkey % 3 = 0 then 1 else 0 end)"
    return (
        "'{\"email\":\"  User' || cast(o_custkey as string) || '@Example.com \"'"
        " || case when o_orderkey % 4 = 0 then"
        f" ',\"job_slug\":\"job-' || cast({job} as string) || '\"'"
        f" || ',\"org_slug\":\"org-' || cast({org} as string) || '\"'"
        f" || ',\"job_title\":\"T' || cast({job} as string) || '\"'"
        " || ',\"job_url\":\"\"'"
        " else ',\"job_slug\":\"\",\"org_slug\":\"org-' || cast(o_orderkey % 150 as string) || '\"' end"
        " || case when o_orderkey % 3 = 0 then ',\"posthog_distinct_id\":\"ph-' ||"
        " cast(o_custkey as string) || '\"' else '' end"
        " || case when o_orderkey % 5 = 0 then ',\"posthog_session_id\":\"ps-' ||"
        " cast(o_orderkey as string) || '\"' else '' end || '}'"
    )


def _derivations(idiv: str, epoch_seconds: str, add_days: str) -> dict[str, tuple[str, str | None, list[str]]]:
    """(driver table, predicate, column expressions) per source, in one SQL
    dialect subset; ``idiv``/``epoch_seconds``/``add_days`` fill the three
    spots where the engines spell things differently."""
    return {
        "sendgrid_webhooks": ("events", "event_id % 2 = 0", [
            "'sg-' || cast(event_id as string) as sg_event_id",
            "'sgm-' || cast(event_id % 40 as string) as sg_message_id",
            "case when event_id % 97 = 0 then cast(null as string) "
            "else chr(10) || ' User' || cast(user_id as string) || '@Example.COM ' || chr(9) end as email",
            f"{_SG_EVENT} as event",
            f"{epoch_seconds} as timestamp",
            "case when event_type = 'click' then 'https://ex.com/' || "
            "cast(event_id % 10 as string) else '' end as url",
            "'10.0.0.' || cast(user_id % 250 as string) as ip",
            "case event_id % 5 when 0 then 'GoogleImageProxy' when 1 then "
            "'Barracuda Scanner' when 2 then '' when 3 then cast(null as string) "
            "else 'Mozilla/5.0' end as useragent",
        ]),
        "resend_wh_emails": ("events", "event_id % 2 <> 0 or event_id is null", [
            "'re-' || cast(event_id as string) as id",
            f"{_RE_EVENT} as event_type",
            "ts as event_created_at",
            "'rem-' || cast(event_id % 60 as string) as email_id",
            "ARRAY_CTOR('User' || cast(user_id as string) || '@example.com', "
            "case when event_id % 7 = 0 then cast(null as string) "
            "when event_id % 11 = 0 then 'USER' || cast(user_id as string) || '@example.com ' "
            "else ' user' || cast(user_id + 1 as string) || '@EXAMPLE.com' end) as to_addresses",
            f"{_RE_SUBJECT} as subject",
            "case when event_type = 'click' then '10.1.0.' || cast(user_id % 250 as string) "
            "else '' end as click_ip_address",
            "case when event_type = 'click' then 'https://ex.com/r' || "
            "cast(event_id % 10 as string) else '' end as click_link",
            "case when event_type = 'click' and event_id % 4 = 1 then "
            "ts - interval 30 second else cast(null as timestamp) end as click_timestamp",
            "case when event_type = 'click' then 'curl/8.0' else '' end as click_user_agent",
            "ts + interval 5 second as webhook_received_at",
        ]),
        "resend_emails_backfill": ("customer", None, [
            "'rem-' || cast(c_custkey % 80 as string) as email_id",
            f"ARRAY_CTOR(' User' || cast(c_custkey {idiv} 10 as string) || '@example.com', "
            "case when c_custkey % 5 = 0 then cast(null as string) else 'user' || "
            f"cast(c_custkey {idiv} 10 + 1 as string) || '@example.com' end) as to_addresses",
            "'Subject ' || cast(c_custkey % 80 as string) as subject",
            "cast('2023-12-31 08:00:00' as timestamp) as created_at",
        ]),
        "resend_wh_contacts": ("events", "event_type = 'signup'", [
            "'c-' || cast(user_id as string) as contact_id",
            f"{_CONTACT_EVENT} as event_type",
            "case when event_id % 97 = 0 then cast(null as string) "
            "else 'User' || cast(user_id as string) || '@Example.com' end as email",
            "event_id % 3 = 0 as unsubscribed",
            "ts as event_created_at",
        ]),
        "resend_contacts_backfill": ("customer", None, [
            "'c-' || cast(c_custkey as string) as contact_id",
            "' User' || cast(c_custkey as string) || '@Example.com' as email",
            "c_custkey % 4 = 0 as unsubscribed",
            f"{add_days} as created_at",
            "cast('2024-01-10 12:00:00' as timestamp) as backfilled_at",
        ]),
        "content_jobs": ("part", None, [
            "'content/jobs/org-' || cast(p_partkey " + idiv + " 16 as string) || '/job-' || "
            "cast(p_partkey as string) || '.md' as file_path",
            f"{_job_frontmatter(idiv)} as frontmatter",
            "'1706572' || lpad(cast(p_partkey % 1000 as string), 3, '0') || '.9996' as _dlt_load_id",
        ]),
        "content_organizations": ("supplier", None, [
            "'content/organizations/org-' || cast(s_suppkey as string) || '.md' as file_path",
            f"{_ORG_FRONTMATTER} as frontmatter",
            "'1706572' || lpad(cast(s_suppkey % 1000 as string), 3, '0') || '.5' as _dlt_load_id",
        ]),
        "netlify_form_submissions": ("orders", "o_orderstatus <> 'P' or o_orderstatus is null", [
            "case when o_orderkey % 50 = 0 then cast(null as string) "
            "else 'nf-' || cast(o_orderkey as string) end as submission_id",
            f"{_FORM_NAME} as form_name",
            f"{_form_data(idiv)} as form_data",
            "o_orderdate as submitted_ts",
            "o_orderdate + interval 1 hour as loaded_ts",
        ]),
        "webflow_form_submits": ("orders", "o_orderstatus = 'P'", [
            "case when o_orderkey % 50 = 0 then cast(null as string) "
            "else 'wf-' || cast(o_orderkey as string) end as event_id",
            "chr(9) || ' User' || cast(o_custkey as string) || '@Example.com' || chr(10) as data",
            "o_orderdate as event_timestamp",
        ]),
    }


def _spark_derivations():
    d = _derivations(
        idiv="div",
        epoch_seconds="timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)",
        add_days="timestampadd(DAY, c_custkey % 9, timestamp_ntz'2024-01-01 06:00:00')",
    )
    out = {}
    for name, (table, where, cols) in d.items():
        cols = [c.replace("ARRAY_CTOR(", "array(")
                 .replace("as timestamp)", "as timestamp_ntz)") for c in cols]
        out[name] = (table, where, cols)
    return out


def _duckdb_derivations():
    d = _derivations(
        idiv="//",
        epoch_seconds="cast(floor(epoch(ts)) as bigint)",
        add_days="timestamp '2024-01-01 06:00:00' + to_days(cast(c_custkey % 9 as integer))",
    )
    out = {}
    for name, (table, where, cols) in d.items():
        cols = [c.replace("ARRAY_CTOR(", "list_value(") for c in cols]
        out[name] = (table, where, cols)
    return out


SPARK_DERIVATIONS = _spark_derivations()


def duckdb_source_sql() -> dict[str, str]:
    """DuckDB SELECT text per source, over the driver's pre-registered views."""
    out = {}
    for name, (table, where, cols) in _duckdb_derivations().items():
        sql = "select " + ",\n       ".join(cols) + f"\nfrom {table}"
        if where:
            sql += f"\nwhere {where}"
        out[name] = sql
    return out


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table; its files are listed and its schema is read anew on
    every call, so a rewritten table is never read by an old schema."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive_source(driver_df: DataFrame, name: str) -> DataFrame:
    """Apply one derivation to its (already loaded) driver table."""
    _, where, cols = SPARK_DERIVATIONS[name]
    df = driver_df.filter(where) if where else driver_df
    return df.selectExpr(*cols)


class LazySources(Mapping):
    """Provider sources derived on first access (each driver table is read
    once per instance), so a query only lists and opens the files it uses."""

    def __init__(self, spark: SparkSession, sf_dir: str, names=SOURCE_NAMES):
        self._spark, self._dir, self._names = spark, sf_dir, tuple(names)
        self._tables: dict[str, DataFrame] = {}
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._cache:
            table = SPARK_DERIVATIONS[name][0]
            if table not in self._tables:
                self._tables[table] = read_driver_table(self._spark, self._dir, table)
            self._cache[name] = derive_source(self._tables[table], name)
        return self._cache[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)


def load_sources(spark: SparkSession, sf_dir: str, names=SOURCE_NAMES) -> Mapping[str, DataFrame]:
    """Lazily derive the named provider sources from the driver tables."""
    return LazySources(spark, sf_dir, names)


def events_by_property(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """Two per-property event exports (even ids -> property 1, odd -> 2),
    each with an ``event_date`` partition column."""
    ev = read_driver_table(spark, sf_dir, "events").withColumn(
        "event_date", F.to_date("ts"))
    return {
        1: ev.filter(F.col("event_id") % 2 == 0),
        2: ev.filter(F.col("event_id") % 2 == 1),
    }
