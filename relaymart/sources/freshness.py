"""Source freshness: how old is the newest row of each source table.

Each declaration names a loaded-at expression and warn/error ages. Where it is a
plain column, the newest row is looked for among those of the warn age first: that
filter is pushed down to the files, whose row group statistics rule out all but
recent ones, so a fresh source costs its last few row groups and the footers. Only
if there is none, or the load time is an expression, is the whole column read (a
partial ``max`` on every task, one-row final merge).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaymart.functions.columns import load_id_to_ts
from relaymart.operators.sets import union_all


@dataclass(frozen=True)
class Freshness:
    source: str                       # source table name
    loaded_at: Callable[[], Column]   # loaded-at expression (UTC TIMESTAMP_NTZ)
    warn_hours: int
    error_hours: int


# The declared freshness targets (warn / error after, hours).
DECLARED = (
    Freshness("content_jobs", lambda: load_id_to_ts("_dlt_load_id"), 24, 48),
    Freshness("content_organizations", lambda: load_id_to_ts("_dlt_load_id"), 24, 48),
    Freshness("netlify_form_submissions", lambda: F.col("loaded_ts"), 12, 24),
    Freshness("resend_wh_emails", lambda: F.col("webhook_received_at"), 48, 72),
)


def _column(loaded_at: Column) -> bool:
    """Whether the expression is a column as it is stored."""
    return str(loaded_at).removeprefix("Column<'").removesuffix("'>").isidentifier()


def recent(df: DataFrame, d: Freshness, now: Column) -> DataFrame:
    """The rows no older than the warn age; the bound is a literal once planned."""
    return df.filter(d.loaded_at() >= F.timestamp_add("HOUR", F.lit(-d.warn_hours), now))


def freshness_report(sources: Mapping[str, DataFrame], as_of_ts: str,
                     declared=DECLARED) -> DataFrame:
    """(source, max_loaded_at, age_hours, status) per declared source.

    ``status`` is 'pass', 'warn' or 'error'; an empty table (no loaded-at
    value) reports 'error'. Age is measured against ``as_of_ts`` (UTC). One row
    a plain column is read when this is called."""
    now = F.lit(as_of_ts).cast("timestamp_ntz")
    parts = []
    for d in declared:
        newest, df = F.max(d.loaded_at()).alias("max_loaded_at"), sources[d.source]
        if _column(d.loaded_at()):
            found = recent(df, d, now).agg(newest).first().max_loaded_at
            if found is not None:  # nothing older can be newer
                df = df.sparkSession.createDataFrame([(found,)], "t timestamp_ntz")
                newest = F.max("t").alias("max_loaded_at")
        agg = df.agg(newest)
        age_ms = F.timestamp_diff("MILLISECOND", F.col("max_loaded_at"), now)
        age_h = (age_ms / F.lit(3_600_000.0)).alias("age_hours")
        status = (
            F.when(F.col("max_loaded_at").isNull(), "error")
            .when(age_ms > d.error_hours * 3_600_000, "error")
            .when(age_ms > d.warn_hours * 3_600_000, "warn")
            .otherwise("pass")
        )
        parts.append(agg.select(
            F.lit(d.source).alias("source"), "max_loaded_at",
            F.round(age_h, 3).alias("age_hours"), status.alias("status"),
            F.lit(d.warn_hours).alias("warn_after_hours"),
            F.lit(d.error_hours).alias("error_after_hours"),
        ))
    return union_all(parts)
