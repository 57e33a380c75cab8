"""Column -> Column helpers: the reusable expression templates of the marts.

Everything here is a pure composition of built-in ``pyspark.sql.functions``,
so it stays inside whole-stage codegen; there is no Python UDF anywhere.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must match the reference's results) ------------------------
# Marker that stands in for NULL inside a surrogate key, and the separator.
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_KEY_SEPARATOR = "-"
# Provider event names mapped before the generic "email." prefix removal.
EVENT_TYPE_MAP = {
    "processed": "sent",
    "open": "opened",
    "click": "clicked",
    "group_resubscribe": "resubscribed",
}
EVENT_TYPE_PREFIX = "email."
# User-agent patterns, tested in this order (privacy proxies first).
PRIVACY_PROXY_PATTERN = (
    r"(googleimageproxy|gmailimageproxy|ggpht\.com|emailproxy|privacy|proxy)"
)
BOT_SCANNER_PATTERN = (
    r"(bot|crawl|spider|scanner|scan|preview|proofpoint|mimecast|barracuda"
    r"|safelinks|urldefense|curl/|wget/|python-requests|go-http-client"
    r"|headless|phantom|selenium)"
)
PRIVACY_REASON = "privacy_or_image_proxy"
BOT_REASON = "bot_or_security_scanner"
ENGAGEMENT_EVENT_TYPES = ("opened", "clicked")
# Unicode White_Space code points (what "trim whitespace" removes).
WHITESPACE = "".join(chr(c) for c in (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
))
# Zero-based positions of the slugs in a content path split on "/" and ".".
ORGANIZATION_SLUG_POSITION = 2
JOB_SLUG_POSITION = 3
# ---------------------------------------------------------------------------

def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(cols: Iterable[Column | str]) -> Column:
    """md5 hex of the columns cast to string, NULL replaced by a marker,
    joined by '-'. Stable across runs and engines."""
    parts = [
        F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_KEY_NULL)) for c in cols
    ]
    return F.md5(F.concat_ws(SURROGATE_KEY_SEPARATOR, *parts))


def strip_whitespace(c: Column | str) -> Column:
    """Trim every kind of leading/trailing whitespace (Unicode White_Space).

    ``F.trim`` removes only spaces; tabs and newlines would survive it. A
    character-set ``btrim`` does it without a regex engine per row."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def normalize_email(c: Column | str) -> Column:
    """lower(trim(address)): the cross-provider join key."""
    return F.lower(strip_whitespace(c))


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def normalize_event_type(c: Column | str) -> Column:
    """Empty -> NULL, lower case, provider names mapped, else every
    'email.' removed. The map is consulted before the prefix removal, so
    'email.open' becomes 'open', not 'opened'."""
    lowered = F.lower(empty_to_null(c))
    out = None
    for raw, norm in EVENT_TYPE_MAP.items():
        out = (F.when(lowered == raw, F.lit(norm)) if out is None
               else out.when(lowered == raw, F.lit(norm)))
    return out.otherwise(F.replace(lowered, F.lit(EVENT_TYPE_PREFIX), F.lit("")))


def privacy_or_bot_reason(event_type: Column | str, user_agent: Column | str) -> Column:
    """Why an engagement event looks machine-made, or NULL.

    Only opened/clicked events are classified. A NULL event type makes the
    NOT IN test NULL, so such rows are still tested against the patterns."""
    et = _col(event_type)
    agent = F.lower(F.coalesce(_col(user_agent), F.lit("")))
    return (
        F.when(~et.isin(*ENGAGEMENT_EVENT_TYPES), F.lit(None).cast("string"))
        .when(agent.rlike(PRIVACY_PROXY_PATTERN), F.lit(PRIVACY_REASON))
        .when(agent.rlike(BOT_SCANNER_PATTERN), F.lit(BOT_REASON))
    )


def path_part(path: Column | str, position: int) -> Column:
    """Zero-based element of the path split on '/' and '.'; NULL when out of
    range. A dot inside a slug therefore splits it (kept on purpose)."""
    return F.get(F.split(F.regexp_replace(_col(path), r"[/.]", "/"), "/"), position)


def organization_slug(path: Column | str) -> Column:
    return path_part(path, ORGANIZATION_SLUG_POSITION)


def job_slug(path: Column | str) -> Column:
    return path_part(path, JOB_SLUG_POSITION)


# Text accepted by the strict casts (anything else fails the query, as a bad
# value fails the reference's cast): booleans true/false in any case; dates
# as year-month-day with 1-2 digit month and day.
STRICT_DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def strict_cast(c: Column, output_type: str) -> Column:
    """Cast text to ``output_type`` accepting only what a strict SQL cast
    accepts for booleans and dates (Spark alone would also take 'yes', '1',
    '2024' or a full timestamp); other types use the ordinary cast."""
    if output_type == "boolean":
        low = F.lower(c)
        return (F.when(c.isNull(), F.lit(None).cast("boolean"))
                .when(low.isin("true", "false"), low == "true")
                .otherwise(F.raise_error(F.concat(F.lit("invalid boolean: "), c)).cast("boolean")))
    if output_type == "date":
        return (F.when(c.isNull(), F.lit(None).cast("date"))
                .when(c.rlike(STRICT_DATE_PATTERN), c.cast("date"))
                .otherwise(F.raise_error(F.concat(F.lit("invalid date: "), c)).cast("date")))
    return c.cast(output_type)


# One parser with the same options reads every JSON value: strict double quotes;
# of a repeated key the last value counts; malformed text has no values.
_JSON_OPTIONS = {"allowSingleQuotes": "false"}


def json_fields(text: Column | str, keys) -> Column:
    """Parse JSON object text ONCE into a struct of the top-level ``keys``,
    each as text (strings unquoted; numbers as the parser prints them, so
    100000.00 is 100000.0; objects and arrays re-serialised). Malformed text
    gives NULL fields. Which text the reference's warehouse gives for such
    numbers could not be confirmed."""
    return F.from_json(_col(text), ", ".join(f"`{k}` string" for k in keys), _JSON_OPTIONS)


def _json_node(text: Column | str, key: str) -> Column:
    """Top-level ``key`` as a VARIANT, which knows the value's JSON type."""
    return F.from_json(_col(text), f"`{key}` variant", _JSON_OPTIONS).getField(key)


def _is_nested(node: Column) -> Column:
    kind = F.schema_of_variant(node)
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def json_field(fields: Column | str, text: Column | str, key: str,
               output_type: str = "string") -> Column:
    """Scalar value of top-level ``key`` from :func:`json_fields`, with the
    scalar-only rule: an object or array gives NULL. Only values that look
    like one (text starting with '{' or '[') are re-checked against the
    value's real JSON type, so a second parse is paid by those rows only.
    Other types than string are cast strictly: junk raises."""
    v = _col(fields).getField(key)
    nested = (v.startswith("{") | v.startswith("[")) & _is_nested(_json_node(text, key))
    out = F.when(~F.coalesce(nested, F.lit(False)), v)
    return out if output_type == "string" else strict_cast(out, output_type)


def json_string_array(fields: Column | str, text: Column | str, key: str) -> Column:
    """Array of scalars at top-level ``key`` as array<string>; NULL when
    missing, not an array, or when an element is an object or array."""
    v = _col(fields).getField(key)
    node = _json_node(text, key)
    has_nested = F.exists(F.try_variant_get(node, "$", "array<variant>"), _is_nested)
    is_array = v.startswith("[") & F.schema_of_variant(node).startswith("ARRAY")
    return F.when(is_array & ~F.coalesce(has_nested, F.lit(False)), F.from_json(v, "array<string>", _JSON_OPTIONS))


def json_object_strip_nulls(*pairs: tuple[str, Column]) -> Column:
    """JSON object text from (key, value) pairs with NULL members dropped;
    all-NULL gives '{}'. Booleans stay JSON booleans."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in pairs]), {"ignoreNullFields": "true"})


def epoch_seconds_to_ts(c: Column | str) -> Column:
    """Epoch seconds -> UTC wall-clock TIMESTAMP_NTZ (no session zone)."""
    return F.timestamp_add("SECOND", _col(c), _epoch())


def load_id_to_ts(c: Column | str) -> Column:
    """Loader id text 'epoch_seconds.fraction' -> TIMESTAMP_NTZ at the
    millisecond, rounding half away from zero like an float->int64 cast."""
    millis = F.round(_col(c).cast("double") * 1000).cast("bigint")
    return F.timestamp_add("MILLISECOND", millis, _epoch())


def utc_date(c: Column | str) -> Column:
    """Calendar day of a UTC TIMESTAMP_NTZ."""
    return F.to_date(_col(c))


def date_range(start: Column, end: Column) -> Column:
    """Inclusive day array start..end; empty when start > end (never counts
    down); NULL when either bound is NULL."""
    return F.when(
        start <= end, F.sequence(start, end, F.expr("interval 1 day"))
    ).when(start > end, F.array().cast("array<date>"))
