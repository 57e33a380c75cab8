import pytest

from relaymart.plans.catalog import graph
from relaymart.plans.views import VIEWS, create_views, drop_views


def test_every_model_by_name(spark, sf_small):
    g = graph(spark, sf_small)
    assert len(VIEWS) == 14
    create_views(spark, g)
    for name in VIEWS:
        assert spark.table(name).schema == g[name].schema
    for name in ("stg_jobs", "int_email_subscribers", "dates"):
        assert sorted(map(str, spark.sql(f"select * from {name}").collect())) == sorted(map(str, g[name].collect()))
    create_views(spark, graph(spark, sf_small, as_of="2024-01-20"))  # replaced
    assert spark.sql("select max(date_day) as d from dates").first().d.isoformat() == "2024-01-20"
    drop_views(spark)
    with pytest.raises(Exception, match="stg_jobs"):
        spark.table("stg_jobs")


def test_a_view_reads_only_what_is_asked(spark, sf_small):
    from relaymart.testing.plans import plan_text
    create_views(spark, graph(spark, sf_small), prefix="v_")
    text = plan_text(spark.sql("select count(*) as n from v_stg_sendgrid__email_events where event_id > 'x'"))
    assert "ua" not in text.split("ReadSchema")[1].split("\n")[0]
    drop_views(spark, prefix="v_")
