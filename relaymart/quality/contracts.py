"""Enforced mart contracts: column names, types and NOT NULL constraints.

The contract is also the published Parquet schema. ``enforce_schema`` fails
before anything is written; there is no silent casting. NOT NULL is checked
on the data (Parquet does not enforce it, and a DataFrame's declared
nullability says nothing about its rows): in one aggregate pass per mart
here, or as observed metrics of the write job in the build. So are ``json``
columns, which are carried as text: every value must parse as one JSON document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The eight mart contracts, one line per column in contract
# order: "mart.column: type[, not_null]".
CONTRACTS_TEXT = """
dim_jobs.job_id: string, not_null
dim_jobs.organization_id: string, not_null
dim_jobs.organization_slug: string, not_null
dim_jobs.job_slug: string, not_null
dim_jobs.is_active: bool
dim_jobs.is_featured: bool
dim_jobs.date_added: date
dim_jobs.date_removed: date
dim_jobs.title: string
dim_jobs.posting_url: string
dim_jobs.description: string
dim_jobs.location: string
dim_jobs.salary: string
dim_jobs.tags: array<string>
dim_organizations.organization_id: string, not_null
dim_organizations.organization_slug: string, not_null
dim_organizations.is_active: bool
dim_organizations.is_featured: bool
dim_organizations.name: string
dim_organizations.description: string
dim_organizations.description_short: string
dim_organizations.organization_url: string
dim_organizations.headcount: string
dim_organizations.location: string
fct_form_submissions.form_submission_id: string, not_null
fct_form_submissions.source_form_submission_id: string, not_null
fct_form_submissions.source: string, not_null
fct_form_submissions.form_name: string, not_null
fct_form_submissions.subscriber_id: string
fct_form_submissions.job_id: string
fct_form_submissions.organization_id: string
fct_form_submissions.email_address: string, not_null
fct_form_submissions.posthog_distinct_id: string
fct_form_submissions.posthog_session_id: string
fct_form_submissions.form_submission_details: json, not_null
fct_form_submissions.submitted_ts: timestamp, not_null
dim_email_messages.email_id: string, not_null
dim_email_messages.source: string, not_null
dim_email_messages.source_email_id: string, not_null
dim_email_messages.subject: string
dim_email_messages.sent_ts: timestamp
dim_email_subscribers.subscriber_id: string, not_null
dim_email_subscribers.email_address: string, not_null
dim_email_subscribers.resend_contact_id: string
dim_email_subscribers.is_subscribed: bool, not_null
dim_email_subscribers.min_subscribed_ts: timestamp
dim_email_subscribers.max_subscribed_ts: timestamp
dim_email_subscribers.min_unsubscribed_ts: timestamp
dim_email_subscribers.max_unsubscribed_ts: timestamp
fct_email_events.email_event_id: string, not_null
fct_email_events.subscriber_id: string
fct_email_events.email_id: string, not_null
fct_email_events.event_type: string, not_null
fct_email_events.event_ts: timestamp, not_null
fct_email_events.is_engagement: bool, not_null
fct_email_events.is_privacy_or_bot_like: bool, not_null
fct_email_events.email_event_details: json, not_null
fct_email_subscribers_daily.email_subscriber_daily_id: string, not_null
fct_email_subscribers_daily.date_day: date, not_null
fct_email_subscribers_daily.subscriber_id: string, not_null
fct_email_subscribers_daily.is_subscribed: bool, not_null
fct_email_subscriber_messages.email_subscriber_message_id: string, not_null
fct_email_subscriber_messages.email_id: string, not_null
fct_email_subscriber_messages.subscriber_id: string, not_null
fct_email_subscriber_messages.min_sent_ts: timestamp
fct_email_subscriber_messages.min_delivered_ts: timestamp
fct_email_subscriber_messages.min_opened_ts: timestamp
fct_email_subscriber_messages.min_clicked_ts: timestamp
fct_email_subscriber_messages.n_events_opened: int64, not_null
fct_email_subscriber_messages.n_events_clicked: int64, not_null
"""

# contract type name -> Spark type. JSON is carried as JSON text; timestamps
# are UTC wall-clock TIMESTAMP_NTZ.
TYPE_MAP = {
    "string": T.StringType(),
    "json": T.StringType(),
    "bool": T.BooleanType(),
    "int64": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _parse(text: str) -> dict[str, list[tuple[str, str, bool]]]:
    out: dict[str, list[tuple[str, str, bool]]] = {}
    for line in text.strip().splitlines():
        target, spec = line.split(": ", 1)
        mart, column = target.split(".")
        typ, _, constraint = spec.partition(", ")
        out.setdefault(mart, []).append((column, typ, constraint == "not_null"))
    return out


CONTRACTS: dict[str, list[tuple[str, str, bool]]] = _parse(CONTRACTS_TEXT)


def contract_schema(mart: str) -> T.StructType:
    return T.StructType([
        T.StructField(n, TYPE_MAP[t], not required) for n, t, required in CONTRACTS[mart]
    ])


def not_null_columns(mart: str) -> list[str]:
    return [n for n, _, required in CONTRACTS[mart] if required]


def json_columns(mart: str) -> list[str]:
    return [n for n, t, _ in CONTRACTS[mart] if t == "json"]


def is_invalid_json(column: Column | str) -> Column:
    """Text that is not one JSON document; an object with a repeated key is
    none, as its value would depend on the reader. NULL is not looked at.

    The parser stops at the end of the first value and does not mind what follows,
    so the text is parsed as an element and as a member: only one whole document
    can be both."""
    c = F.col(column) if isinstance(column, str) else column
    element = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    member = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    return c.isNotNull() & (element.isNull() | member.isNull())


def constraint_metrics(mart: str) -> list[Column]:
    """The aggregates that count what breaks a mart's constraints, to be observed
    while it is written: ``null:<column>`` and ``json:<column>``."""
    return [F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in not_null_columns(mart)] + [
        F.count_if(is_invalid_json(c)).alias(f"json:{c}") for c in json_columns(mart)]


def json_violations(df: DataFrame, relation: str, columns: list[str]) -> DataFrame:
    """(relation, column_name, n_rows, n_invalid) of each named JSON column, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(is_invalid_json(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(relation).alias("relation"), F.lit(c).alias("column_name"), F.col("n").alias("n_rows"),
                 F.col(f"c{i}").alias("n_invalid")) for i, c in enumerate(columns)])))


def _same_type(actual: T.DataType, expected: T.DataType) -> bool:
    if isinstance(expected, T.ArrayType):
        return isinstance(actual, T.ArrayType) and actual.elementType == expected.elementType
    return actual == expected


def schema_problems(df: DataFrame, mart: str) -> list[str]:
    """Differences between ``df``'s schema and the contract (names, types)."""
    expected = contract_schema(mart)
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in actual:
            problems.append(f"{mart}.{f.name}: missing")
        elif not _same_type(actual[f.name], f.dataType):
            problems.append(f"{mart}.{f.name}: {actual[f.name].simpleString()} "
                            f"!= {f.dataType.simpleString()}")
    for name in actual:
        if name not in {f.name for f in expected.fields}:
            problems.append(f"{mart}.{name}: not in contract")
    return problems


class ContractError(ValueError):
    pass


def enforce_schema(df: DataFrame, mart: str) -> DataFrame:
    """Select the contract's columns in contract order; raise on any name or
    type difference (checked on the plan, no data is read)."""
    problems = schema_problems(df, mart)
    if problems:
        raise ContractError("; ".join(problems))
    return df.select(*[n for n, _, _ in CONTRACTS[mart]])


def null_counts(df: DataFrame, mart: str) -> DataFrame:
    """One row per contract column: (mart, column_name, contract_type,
    actual_type, is_required, type_matches, n_nulls), from ONE aggregate pass
    over the mart (partial counts map-side, a single-row final merge)."""
    cols = CONTRACTS[mart]
    actual = {f.name: f.dataType for f in df.schema.fields}
    counts = df.agg(*[
        F.count_if(F.col(n).isNull()).alias(f"c{i}") for i, (n, _, _) in enumerate(cols)
    ])
    rows = F.array(*[
        F.struct(
            F.lit(mart).alias("mart"),
            F.lit(n).alias("column_name"),
            F.lit(t).alias("contract_type"),
            F.lit(actual[n].simpleString() if n in actual else None).cast("string")
            .alias("actual_type"),
            F.lit(req).alias("is_required"),
            F.lit(n in actual and _same_type(actual[n], TYPE_MAP[t])).alias("type_matches"),
            F.col(f"c{i}").alias("n_nulls"),
        )
        for i, (n, t, req) in enumerate(cols)
    ])
    return counts.select(F.inline(rows))


def not_null_violations(df: DataFrame, mart: str) -> DataFrame:
    """(mart, column_name, n_nulls) for required columns holding NULLs."""
    return (null_counts(df, mart)
            .filter(F.col("is_required") & (F.col("n_nulls") > 0))
            .select("mart", "column_name", "n_nulls"))
