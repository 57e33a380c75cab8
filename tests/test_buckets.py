import pytest
from pyspark.sql import functions as F

from relaymart.plans.build import build
from relaymart.session import work_path
from relaymart.sinks import buckets
from relaymart.sources.fixtures import load_sources
from relaymart.testing.plans import plan_text, summarize


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_lookup_shuffles_the_fact_only(spark, no_broadcast):
    path, db = work_path(spark, "dim"), "relaymart_buckets"
    dim = spark.range(1000).selectExpr("cast(id as string) as subscriber_id", "id * 2 as v")
    buckets.write_buckets(dim, path, "subscriber_id", 16)
    buckets.register_buckets(spark, db, "dim", path, "subscriber_id", 16)
    fact = spark.range(5000).selectExpr("cast(id % 1500 as string) as subscriber_id", "id as event")
    joined = fact.join(spark.table(f"{db}.dim"), "subscriber_id", "left")
    assert summarize(joined)["shuffles"] == 1 and "Bucketed: true" in plan_text(joined)
    assert summarize(fact.join(dim, "subscriber_id", "left"))["shuffles"] == 2
    assert joined.filter("v is null").count() == 5000 - sum(i % 1500 < 1000 for i in range(5000))
    # new files in the same buckets: the table is pointed at them; other buckets: made anew
    for n in (16, 8):
        path = work_path(spark, "dim")
        buckets.write_buckets(dim.filter(f"v < {n}"), path, "subscriber_id", n)
        buckets.register_buckets(spark, db, "dim", path, "subscriber_id", n)
        assert spark.table(f"{db}.dim").count() == n // 2
        assert summarize(fact.join(spark.table(f"{db}.dim"), "subscriber_id", "left"))["shuffles"] == 1


def test_bucketed_build(spark, sf_small, no_broadcast):
    with pytest.raises(ValueError):
        build(spark, load_sources(spark, sf_small), "2024-02-15", buckets=4)
    plain = build(spark, load_sources(spark, sf_small), "2024-02-15", strict=False, run_checks=False)
    for _ in range(2):
        res = build(spark, load_sources(spark, sf_small), "2024-02-15", strict=False, run_checks=False,
                    database="relaymart_bucketed", buckets=4)
    for name, key in buckets.KEYS.items():
        table = spark.table(f"relaymart_bucketed.{name}")
        assert table.exceptAll(plain.marts[name]).count() == 0 and table.count() == res.marts[name].count() == plain.marts[name].count()
        fact = spark.range(10).select(F.col("id").cast("string").alias(key))
        assert summarize(fact.join(table, key))["shuffles"] == 1


def test_bucket_count():
    assert buckets.bucket_count(1, 8) == 8 and buckets.bucket_count(10 * 2**40, 8000) == 65536
