"""Random event histories: window plan == brute-force rule."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from test_daily_state import brute_force, run

event = st.tuples(
    st.sampled_from(["a", "b", "c"]),
    st.sampled_from(["resend", "sendgrid"]),
    st.sampled_from(["subscribed", "unsubscribed"]),
    st.integers(min_value=1, max_value=14),   # day in January
    st.integers(min_value=0, max_value=3),    # hour: same-day ties happen
)


@settings(max_examples=25, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(events=st.lists(event, min_size=1, max_size=12),
       as_of_day=st.integers(min_value=1, max_value=16),
       backfill_day=st.one_of(st.none(), st.integers(min_value=1, max_value=15)))
def test_random_histories(spark, events, as_of_day, backfill_day):
    rows = [(s, src, None if src == "sendgrid" else f"c{s}", f"{s}@x.com", kind,
             dt.datetime(2024, 1, day, hour)) for s, src, kind, day, hour in events]
    backfilled = [] if backfill_day is None else [dt.datetime(2024, 1, backfill_day, 12)]
    as_of = dt.date(2024, 1, as_of_day)
    assert run(spark, rows, backfilled, as_of) == brute_force(rows, backfilled, as_of)
