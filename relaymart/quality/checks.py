"""Row-returning data-quality checks and the suite that runs all of them.

Each check returns its *failing rows*; a pass is zero rows. The suite
(``run_suite``) evaluates every declared check and returns one row per check
with its failure count, from one scan per model and one shared shuffle (see
``run_suite``); each relationship check adds an anti join against the
parent's distinct keys.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaymart.functions.columns import normalize_email
from relaymart.operators.sets import union_all
from relaymart.session import work_path


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str                      # not_null | unique | accepted_values | normalized_email | relationships
    values: tuple = ()             # accepted values
    parent: tuple[str, str] | None = None  # (model, column) for relationships


# The declared checks, one line per model column, in the
# order they are declared: "model.column: test, test, ...". Tests are
# not_null, unique, is_normalized_email_address, accepted_values(v|v|...)
# and relationships(parent_model.parent_column).
DECLARED_TEXT = """
stg_netlify__form_submissions.form_submission_id: not_null, unique
stg_netlify__form_submissions.source_form_submission_id: not_null, unique
stg_netlify__form_submissions.source: not_null, accepted_values(netlify)
stg_netlify__form_submissions.form_name: not_null, accepted_values(job-apply-capture|newsletter|offer-review|resume-review)
stg_netlify__form_submissions.email_address: not_null, is_normalized_email_address
stg_netlify__form_submissions.form_submission_details: not_null
stg_netlify__form_submissions.submitted_ts: not_null
stg_netlify__form_submissions.loaded_ts: not_null
stg_webflow__form_submissions.form_submission_id: not_null, unique
stg_webflow__form_submissions.source_form_submission_id: not_null, unique
stg_webflow__form_submissions.source: not_null, accepted_values(webflow)
stg_webflow__form_submissions.form_name: not_null, accepted_values(newsletter)
stg_webflow__form_submissions.email_address: not_null, is_normalized_email_address
stg_webflow__form_submissions.form_submission_details: not_null
stg_webflow__form_submissions.submitted_ts: not_null
stg_resend__contacts.contact_id: not_null, unique
stg_resend__contacts.email_address: not_null, is_normalized_email_address
stg_resend__contacts.is_subscribed: not_null
stg_resend__contacts.contact_created_ts: not_null
stg_resend__contacts.backfilled_ts: not_null
stg_resend__contact_events.contact_id: not_null
stg_resend__contact_events.email_address: not_null, is_normalized_email_address
stg_resend__contact_events.event_type: not_null, accepted_values(contact.created|contact.updated)
stg_resend__contact_events.event_created_ts: not_null
stg_resend__contact_events.is_subscribed: not_null
stg_resend__email_events.email_event_id: not_null, unique
stg_resend__email_events.message_id: not_null
stg_resend__email_events.email_address: not_null, is_normalized_email_address
stg_resend__email_events.event_type: not_null, accepted_values(bounced|clicked|delivered|delivery_delayed|opened|sent|suppressed)
stg_resend__email_events.event_created_ts: not_null
stg_resend__emails_backfill.email_event_id: not_null, unique
stg_resend__emails_backfill.message_id: not_null
stg_resend__emails_backfill.email_address: not_null, is_normalized_email_address
stg_resend__emails_backfill.email_created_ts: not_null
stg_sendgrid__email_events.event_id: not_null, unique
stg_sendgrid__email_events.message_id: not_null
stg_sendgrid__email_events.email_address: not_null, is_normalized_email_address
stg_sendgrid__email_events.event_type: not_null, accepted_values(clicked|delivered|opened|resubscribed|sent)
stg_sendgrid__email_events.event_ts: not_null
int_email_message_events.email_event_id: not_null, unique
int_email_message_events.email_id: not_null
int_email_message_events.source: not_null, accepted_values(resend|sendgrid)
int_email_message_events.source_email_id: not_null
int_email_message_events.event_type: not_null, accepted_values(bounced|clicked|delivered|delivery_delayed|opened|resubscribed|sent|suppressed)
int_email_message_events.email_address: not_null, is_normalized_email_address
int_email_message_events.event_ts: not_null
int_email_message_events.privacy_or_bot_reason: accepted_values(bot_or_security_scanner|privacy_or_image_proxy)
int_email_messages.email_id: not_null, unique
int_email_messages.source: not_null, accepted_values(resend|sendgrid)
int_email_messages.source_email_id: not_null
int_email_subscription_events.subscriber_id: not_null
int_email_subscription_events.source: not_null, accepted_values(resend|sendgrid)
int_email_subscription_events.email_address: not_null, is_normalized_email_address
int_email_subscription_events.subscriber_event_type: not_null, accepted_values(subscribed|unsubscribed)
int_email_subscription_events.event_ts: not_null
dates.date_day: not_null, unique
int_email_subscribers.subscriber_id: not_null, unique
int_email_subscribers.email_address: not_null, unique, is_normalized_email_address
int_email_subscribers.is_subscribed: not_null
dim_jobs.job_id: not_null, unique
dim_jobs.organization_id: not_null, relationships(dim_organizations.organization_id)
dim_jobs.organization_slug: not_null
dim_jobs.job_slug: not_null
dim_jobs.is_active: accepted_values(true|false)
dim_jobs.is_featured: accepted_values(true|false)
dim_organizations.organization_id: not_null, unique
dim_organizations.organization_slug: not_null, unique
dim_organizations.is_active: accepted_values(true|false)
dim_organizations.is_featured: accepted_values(true|false)
fct_form_submissions.form_submission_id: not_null, unique
fct_form_submissions.source_form_submission_id: not_null
fct_form_submissions.source: not_null, accepted_values(netlify|webflow)
fct_form_submissions.form_name: not_null, accepted_values(job-apply-capture|newsletter|offer-review|resume-review)
fct_form_submissions.subscriber_id: relationships(dim_email_subscribers.subscriber_id)
fct_form_submissions.job_id: relationships(dim_jobs.job_id)
fct_form_submissions.organization_id: relationships(dim_organizations.organization_id)
fct_form_submissions.email_address: not_null, is_normalized_email_address
fct_form_submissions.form_submission_details: not_null
fct_form_submissions.submitted_ts: not_null
dim_email_messages.email_id: not_null, unique
dim_email_messages.source: not_null, accepted_values(resend|sendgrid)
dim_email_messages.source_email_id: not_null
dim_email_subscribers.subscriber_id: not_null, unique
dim_email_subscribers.email_address: not_null, unique, is_normalized_email_address
dim_email_subscribers.is_subscribed: not_null
fct_email_events.email_event_id: not_null, unique
fct_email_events.subscriber_id: relationships(dim_email_subscribers.subscriber_id)
fct_email_events.email_id: not_null, relationships(dim_email_messages.email_id)
fct_email_events.event_type: not_null, accepted_values(bounced|clicked|delivered|delivery_delayed|opened|resubscribed|sent|suppressed)
fct_email_events.event_ts: not_null
fct_email_events.is_engagement: not_null, accepted_values(true|false)
fct_email_events.is_privacy_or_bot_like: not_null, accepted_values(true|false)
fct_email_events.email_event_details: not_null
fct_email_subscribers_daily.email_subscriber_daily_id: not_null, unique
fct_email_subscribers_daily.date_day: not_null
fct_email_subscribers_daily.subscriber_id: not_null, relationships(dim_email_subscribers.subscriber_id)
fct_email_subscribers_daily.is_subscribed: not_null, accepted_values(true|false)
fct_email_subscriber_messages.email_subscriber_message_id: not_null, unique
fct_email_subscriber_messages.email_id: not_null, relationships(dim_email_messages.email_id)
fct_email_subscriber_messages.subscriber_id: not_null, relationships(dim_email_subscribers.subscriber_id)
fct_email_subscriber_messages.n_events_opened: not_null
fct_email_subscriber_messages.n_events_clicked: not_null
"""

_KINDS = {"is_normalized_email_address": "normalized_email"}


def _parse_declared(text: str) -> list[Check]:
    checks: list[Check] = []
    for line in text.strip().splitlines():
        target, tests = line.split(": ", 1)
        model, column = target.split(".")
        for test in (t.strip() for t in tests.split(", ")):
            name, _, arg = test.partition("(")
            arg = arg.rstrip(")")
            kind = _KINDS.get(name, name)
            if kind == "accepted_values":
                checks.append(Check(model, column, kind, tuple(arg.split("|"))))
            elif kind == "relationships":
                pm, pc = arg.split(".")
                checks.append(Check(model, column, kind, parent=(pm, pc)))
            else:
                checks.append(Check(model, column, kind))
    return checks


DECLARED: list[Check] = _parse_declared(DECLARED_TEXT)


def _typed_values(df: DataFrame, column: str, values: tuple) -> list:
    if df.schema[column].dataType.typeName() == "boolean":  # quote: false
        return [v == "true" for v in values]
    return list(values)


# --- single checks: failing rows ------------------------------------------

def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once (NULLs ignored), with their count."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def failing_accepted_values(df: DataFrame, column: str, values: tuple) -> DataFrame:
    """Values outside the accepted set (NULL passes), with their count."""
    vals = _typed_values(df, column, values)
    return (df.filter(~F.col(column).isin(*vals)).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")))


def failing_normalized_email(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.filter(c.isNotNull() & (c != normalize_email(c))).select(column)


def failing_relationships(df: DataFrame, column: str, parent: DataFrame,
                          parent_column: str) -> DataFrame:
    """Child keys with no parent row; NULL keys pass. The parent is reduced
    to distinct keys (partial aggregate) before the anti join."""
    keys = parent.select(F.col(parent_column).alias(column)).dropDuplicates()
    return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti").select(column)


def failing_rows(check: Check, models: Mapping[str, DataFrame] | Callable[[str], DataFrame]) -> DataFrame:
    get = models.__getitem__ if isinstance(models, Mapping) else models
    df = get(check.model)
    if check.kind == "not_null":
        return failing_not_null(df, check.column)
    if check.kind == "unique":
        return failing_unique(df, check.column)
    if check.kind == "accepted_values":
        return failing_accepted_values(df, check.column, check.values)
    if check.kind == "normalized_email":
        return failing_normalized_email(df, check.column)
    if check.kind == "relationships":
        pm, pc = check.parent
        return failing_relationships(df, check.column, get(pm), pc)
    raise ValueError(check.kind)


# --- the suite --------------------------------------------------------------

def _row_predicate(check: Check, df: DataFrame) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~c.isin(*_typed_values(df, check.column, check.values))
    if check.kind == "normalized_email":
        return c.isNotNull() & (c != normalize_email(c))
    raise ValueError(check.kind)


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        failures.cast("bigint").alias("failures"),
    )


def _pair(i: int, emit: Column, value: Column | None) -> Column:
    v = value.cast("string") if value is not None else F.lit(None).cast("string")
    return F.when(emit, F.struct(F.lit(i).alias("k"), v.alias("v")))


#: Hashes of values that may repeat: up to so many (16 bytes each) are broadcast.
SUSPECTS = 1 << 20


def value_hash(value: Column) -> Column:
    return F.xxhash64(value.cast("string"))


def repeated_values(columns: list[tuple[int, DataFrame, str]], hashed: Callable[[Column], Column] = value_hash) -> DataFrame | None:
    """(k, failures): how many distinct non-NULL values of each column (k, table,
    name) occur more than once; None if no value does.

    Two phases. First (k, hash) is counted, map-side first: two numbers a value
    are shuffled, never the value. A hash that occurs once is of a value that
    occurs once. Then only values of the other hashes, repeated or colliding ones,
    are compared themselves. Their hashes are written and counted: up to
    ``SUSPECTS`` they are broadcast to a second scan, beyond that the join is a
    shuffle by hash, which spreads over as many tasks as it needs."""
    by_table: dict[int, list[tuple[int, DataFrame, str]]] = {}
    for one in columns:
        by_table.setdefault(id(one[1]), []).append(one)
    streams = []
    for of_one in by_table.values():
        df = of_one[0][1]
        streams.append(df.select(F.inline(F.array(*[
            F.struct(F.lit(k).alias("k"), F.when(F.col(c).isNotNull(), hashed(F.col(c))).alias("h")) for k, _, c in of_one
        ]))).filter(F.col("h").isNotNull()))
    spark = columns[0][1].sparkSession
    path = work_path(spark, "suspects")
    (union_all(streams).groupBy("k", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("k", "h")
     .write.option("compression", "zstd").parquet(path))
    suspects = spark.read.schema("k int, h long").parquet(path)
    by_check = {r.k: r["count"] for r in suspects.groupBy("k").count().collect()}  # a row a check
    if not by_check:
        return None
    small = sum(by_check.values()) <= SUSPECTS
    values = []
    for k, df, c in columns:
        if k in by_check:
            mine = suspects.filter(F.col("k") == k).select(F.col("h").alias("_h"))
            value = df.filter(F.col(c).isNotNull()).select(F.lit(k).alias("k"), F.col(c).cast("string").alias("v"))
            value = value.withColumn("_h", hashed(F.col("v")))
            values.append(value.join(F.broadcast(mine) if small else mine, "_h", "left_semi").select("k", "v"))
    counts = union_all(values).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return counts.groupBy("k").agg(F.count(F.lit(1)).alias("failures"))


def run_suite(models: Mapping[str, DataFrame] | Callable[[str], DataFrame],
              checks: list[Check] = DECLARED) -> DataFrame:
    """One row per check: (model, column_name, check_name, failures).

    Rows that pass cost a comparison and nothing more. NULLs and badly
    normalized addresses are counted by one aggregate a model (partial counts
    on every task, one row a task to merge). Values of unique columns are
    compared by hash first (:func:`repeated_values`). What else must be compared
    with other rows becomes (check, value) pairs: unaccepted values, and each
    relationship's orphan keys weighted by their row counts (child rows are
    counted per key map-side, then distinct keys meet in a left join, so a hot
    child key cannot stall a task). One weighted count per (check, value), with a
    map-side partial aggregate, and one per-check sum give distinct unaccepted
    values and orphan rows.

    The hashes are counted when this is called, the rest when its result is read."""
    get = models.__getitem__ if isinstance(models, Mapping) else models
    by_model: dict[str, list[tuple[int, Check]]] = {}
    for i, ch in enumerate(checks):
        by_model.setdefault(ch.model, []).append((i, ch))
    streams: list[DataFrame] = []
    counted: list[DataFrame] = []
    unique: list[tuple[int, DataFrame, str]] = []
    for model, chs in by_model.items():
        df = get(model)
        by_row = [(i, _row_predicate(c, df)) for i, c in chs if c.kind in ("not_null", "normalized_email")]
        if by_row:
            one = df.agg(*[F.count_if(p).alias(f"c{i}") for i, p in by_row])
            counted.append(one.select(F.inline(F.array(*[
                F.struct(F.lit(i).alias("k"), F.col(f"c{i}").alias("failures")) for i, _ in by_row]))))
        unique += [(i, df, c.column) for i, c in chs if c.kind == "unique"]
        pairs = [_pair(i, _row_predicate(c, df), F.col(c.column)) for i, c in chs if c.kind == "accepted_values"]
        if pairs:
            streams.append(df.select(F.explode(F.array_compact(F.array(*pairs))).alias("e")).select(
                F.col("e.k").alias("k"), F.col("e.v").alias("v"), F.lit(1).cast("bigint").alias("w")))
        for i, c in chs:
            if c.kind == "relationships":
                pm, pc = c.parent
                child = (df.filter(F.col(c.column).isNotNull()).groupBy(c.column)
                         .agg(F.count(F.lit(1)).alias("w")))
                parent = get(pm).select(F.col(pc).alias(c.column)).dropDuplicates().withColumn("_known", F.lit(True))
                # a left join and a filter: Spark moves an anti join below the
                # count, and every child row would be shuffled and sorted
                streams.append(child.join(parent, c.column, "left").filter(F.col("_known").isNull()).select(
                    F.lit(i).alias("k"), F.lit(None).cast("string").alias("v"), "w"))
    parts = list(counted)
    if streams:
        counts = union_all(streams).groupBy("k", "v").agg(F.sum("w").alias("n"))
        # contribution of one (check, value) group to its check's failures
        kind = F.element_at(F.array(*[F.lit(c.kind) for c in checks]), F.col("k") + 1)
        n = F.col("n")
        contrib = F.when(kind == "accepted_values", F.lit(1)).otherwise(n)
        parts.append(counts.groupBy("k").agg(F.sum(contrib).cast("bigint").alias("failures")))
    repeated = repeated_values(unique) if unique else None
    if repeated is not None:
        parts.append(repeated)
    if not parts:  # only unique columns, all of them so
        parts.append(get(checks[0].model).sparkSession.createDataFrame([], "k int, failures long"))
    per_check = union_all(parts)
    # label the (at most one per check) result rows; checks without rows pass
    labels = F.array(*[_result(c, F.lit(i)) for i, c in enumerate(checks)])
    catalog = per_check.sparkSession.range(1).select(F.inline(labels)).withColumnRenamed(
        "failures", "k")
    return (catalog.join(F.broadcast(per_check), "k", "left")
            .select("model", "column_name", "check_name",
                    F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")))
