"""A hot key holding most rows: results stay whole and exact."""
import datetime as dt

from relaymart.plans.intermediate import int_email_subscribers
from relaymart.plans.marts import fct_email_events, fct_email_subscriber_messages

EV = ("email_event_id string, email_id string, source string, event_type string, "
      "event_ts timestamp_ntz, source_email_id string, email_address string, subject string, "
      "link_url string, ip_address string, user_agent string, is_backfill boolean, "
      "privacy_or_bot_reason string")
SUBS = ("subscriber_id string, source string, resend_contact_id string, email_address string, "
        "subscriber_event_type string, event_ts timestamp_ntz")


def test_hot_address_lookup_and_rollup(spark):
    t = dt.datetime(2024, 1, 1)
    n_hot = 5000
    rows = [(f"e{i}", f"m{i % 3}", "resend", ["opened", "clicked", "sent"][i % 3], t,
             f"s{i % 3}", "hot@x.com" if i < n_hot else f"u{i}@x.com", None, None, None, None,
             False, None) for i in range(n_hot + 200)]
    events = spark.createDataFrame(rows, EV).repartition(8)
    subs = int_email_subscribers(spark.createDataFrame(
        [("sid-hot", "resend", "c1", "hot@x.com", "subscribed", t),
         ("sid-1", "resend", "c2", "u5001@x.com", "subscribed", t)], SUBS))
    fct = fct_email_events(events, subs)
    assert fct.count() == n_hot + 200
    assert fct.filter("subscriber_id = 'sid-hot'").count() == n_hot
    per_msg = {r.email_id: (r.n_events_opened, r.n_events_clicked)
               for r in fct_email_subscriber_messages(fct).filter("subscriber_id = 'sid-hot'").collect()}
    want = {f"m{k}": (sum(1 for i in range(n_hot) if i % 3 == k and i % 3 == 0),
                      sum(1 for i in range(n_hot) if i % 3 == k and i % 3 == 1)) for k in range(3)}
    assert per_msg == want


def test_aqe_splits_a_hot_address_in_the_event_lookup(spark):
    """With the sort-merge shape forced and tiny skew thresholds, the final
    adaptive plan of the event -> subscriber lookup splits the hot address."""
    import contextlib
    import io

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        t = dt.datetime(2024, 1, 1)
        rows = [(f"e{i}", "m1", "resend", "opened", t, "s1",
                 "hot@x.com" if i % 3 == 0 else f"u{i % 2000}@x.com", None, None, None, None,
                 False, None) for i in range(60000)]
        events = spark.createDataFrame(rows, EV)
        subs = int_email_subscribers(spark.createDataFrame(
            [(f"sid-{i}", "resend", f"c{i}", f"u{i}@x.com", "subscribed", t) for i in range(2000)]
            + [("sid-hot", "resend", "ch", "hot@x.com", "subscribed", t)], SUBS))
        fct = fct_email_events(events, subs)
        got = fct.collect()
        assert len(got) == 60000
        assert sum(1 for r in got if r.subscriber_id is not None) == 60000
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fct.explain()
        assert "isFinalPlan=true" in buf.getvalue()
        assert "SortMergeJoin(skew=true)" in buf.getvalue()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_null_slugs_meet_in_no_slug_join(spark):
    """Two thirds of the submissions name no organization: they do not meet under
    one key, match nothing (not even a slug that reads like their id), and keep
    their rows; one of them may still name a job. Every source is read once."""
    from relaymart.plans.marts import FORM_COLUMNS, fct_form_submissions

    schema = ", ".join(f"{c} {'timestamp_ntz' if c == 'submitted_ts' else 'string'}" for c in FORM_COLUMNS)
    t = dt.datetime(2024, 1, 1)

    def form(i, org, job):
        return (f"f{i}", f"s{i}", "netlify", "apply", f"u{i % 7}@x.com", job, org, None, None, "{}", t)

    netlify = spark.createDataFrame([form(i, *(("o1", "j1"), ("o2", "none"), ("o9", None))[i % 3]) for i in range(300)]
                                    + [form(900, None, "j1")], schema)
    webflow = spark.createDataFrame([form(1000 + i, None, None) for i in range(600)], schema)
    subs = spark.createDataFrame([("k1", "u1@x.com")], "subscriber_id string, email_address string")
    jobs = spark.createDataFrame([("o1", "j1", "job-1", "org-1")],
                                 "organization_slug string, job_slug string, job_id string, organization_id string")
    orgs = spark.createDataFrame([("o1", "org-1"), ("o2", "org-2"), ("f1000", "org-3")], "organization_slug string, organization_id string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = fct_form_submissions(netlify, webflow, subs, jobs, orgs)
        rows = {r.form_submission_id: r for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(rows) == 901
    assert (rows["f0"].job_id, rows["f0"].organization_id) == ("job-1", "org-1")
    assert (rows["f1"].job_id, rows["f1"].organization_id, rows["f1"].subscriber_id) == (None, "org-2", "k1")
    assert (rows["f2"].job_id, rows["f2"].organization_id) == (None, None)
    assert (rows["f900"].job_id, rows["f900"].organization_id) == (None, None)
    assert rows["f1000"].organization_id is None
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 3
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 5
    keys = [line for line in plan.splitlines() if "coalesce(organization_slug" in line]
    assert keys and all("form_submission_id" in line for line in keys)
