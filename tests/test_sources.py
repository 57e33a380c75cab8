import datetime as dt

from pyspark.sql import functions as F

from relaymart.operators.sets import combine_properties
from relaymart.session import work_path
from relaymart.sources.freshness import Freshness, freshness_report
from relaymart.testing.plans import plan_text


def test_combine_properties_prunes_partitions(spark):
    base = work_path(spark, "props")
    exports = {}
    for pid in (1, 2):
        df = spark.createDataFrame(
            [(i, dt.date(2024, 1, 1 + i % 10)) for i in range(50)], "event_id int, event_date date")
        df.write.partitionBy("event_date").parquet(f"{base}/{pid}")
        exports[pid] = spark.read.parquet(f"{base}/{pid}")
    out = combine_properties(exports, "20240106")
    rows = out.collect()
    assert len(rows) == 2 * sum(1 for i in range(50) if 1 + i % 10 >= 6)
    assert {r.property_id for r in rows} == {1, 2}
    assert all(r.event_date >= dt.date(2024, 1, 6) for r in rows)
    # the start date is a partition filter on every branch
    assert plan_text(out).count("PartitionFilters: [isnotnull(event_date") == 2


def test_freshness_statuses_and_empty_source(spark):
    now = "2024-01-10 00:00:00"
    src = {
        "fresh": spark.createDataFrame([(dt.datetime(2024, 1, 9, 20),)], "t timestamp_ntz"),
        "stale": spark.createDataFrame([(dt.datetime(2024, 1, 8, 12),)], "t timestamp_ntz"),
        "dead": spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz"),
        "empty": spark.createDataFrame([], "t timestamp_ntz"),
    }
    decl = tuple(Freshness(n, lambda: F.col("t"), 24, 48) for n in src)
    got = {r.source: r.status for r in freshness_report(src, now, decl).collect()}
    assert got == {"fresh": "pass", "stale": "warn", "dead": "error", "empty": "error"}


def test_dates_model_empty_when_first_event_after_as_of(spark):
    from relaymart.plans.intermediate import dates
    ev = spark.createDataFrame([(dt.datetime(2024, 3, 1),)], "event_ts timestamp_ntz")
    assert dates(ev, "2024-02-15").count() == 0
    assert dates(ev, "2024-03-03").count() == 3


def test_freshness_reads_recent_row_groups(spark):
    """A plain load time is looked for by a filter that reaches the files."""
    from relaymart.session import work_path
    from relaymart.sources import freshness as fr
    from relaymart.testing.plans import plan_text
    path = work_path(spark, "fresh")
    (spark.range(100_000).selectExpr("id", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id * 20) as loaded_ts", "uuid() as other")
     .repartitionByRange(8, "id").write.parquet(path))
    df = spark.read.parquet(path)
    plain = fr.Freshness("t", lambda: F.col("loaded_ts"), 12, 24)
    shifted = fr.Freshness("t", lambda: F.timestamp_add("SECOND", F.lit(0), F.col("loaded_ts")), 12, 24)
    assert fr._column(plain.loaded_at()) and not fr._column(shifted.loaded_at())
    text = plan_text(fr.recent(df, plain, F.lit("2024-01-24 00:00:00").cast("timestamp_ntz")))
    assert "GreaterThanOrEqual(loaded_ts,2024-01-23T12:00" in text
    for now, status in (("2024-01-24 00:00:00", "pass"), ("2024-01-24 18:00:00", "warn"), ("2024-01-30 00:00:00", "error"),
                        ("2024-01-01 00:00:00", "pass")):
        a, b = (fr.freshness_report({"t": df}, now, [d]).first() for d in (plain, shifted))
        assert a == b and a.status == status
    assert fr.freshness_report({"t": df.filter("false")}, "2024-01-01 00:00:00", [plain]).first().status == "error"
