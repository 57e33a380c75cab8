"""Count the scale-relevant operators in a DataFrame's formatted plan."""

from __future__ import annotations

import contextlib
import io
import re

OPS = {
    "shuffles": r"^\(\d+\) Exchange\b",
    "broadcasts": r"^\(\d+\) BroadcastExchange\b",
    "smj": r"^\(\d+\) SortMergeJoin\b",
    "bhj": r"^\(\d+\) BroadcastHashJoin\b",
    "windows": r"^\(\d+\) Window\b",
    "generators": r"^\(\d+\) Generate\b",
    "scans": r"^\(\d+\) Scan parquet\b",
    "nested_loop": r"^\(\d+\) (BroadcastNestedLoopJoin|CartesianProduct)\b",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(df) -> dict:
    text = plan_text(df)
    out = {k: len(re.findall(p, text, flags=re.M)) for k, p in OPS.items()}
    out["pushed_filters"] = len(re.findall(r"^PushedFilters: \[.+\]", text, flags=re.M))
    return out


