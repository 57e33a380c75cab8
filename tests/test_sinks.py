import pytest
from pyspark.sql import functions as F

from relaymart.session import work_path
from relaymart.sinks.publish import load_manifest, publish_exports, read_published
from relaymart.streaming.incremental import rebuild_trailing_window


def test_manifest():
    specs = load_manifest()
    assert [(s.name, s.relation) for s in specs] == [("jobs", "dim_jobs"),
                                                     ("organizations", "dim_organizations")]
    with pytest.raises(ValueError):
        load_manifest('[{"name": "a", "dataset": "d"}]')
    with pytest.raises(ValueError):
        load_manifest('[{"name": "a", "dataset": "d", "relation": "r"},'
                      ' {"name": "a", "dataset": "d", "relation": "s"}]')


def test_publish_switches_all_exports_together(spark):
    base = work_path(spark, "publish-test")
    a = spark.range(5).withColumnRenamed("id", "job")
    b = spark.range(3).withColumnRenamed("id", "org")
    publish_exports(spark, {"dim_jobs": a, "dim_organizations": b}, base, run_id="r1")
    assert read_published(spark, base, "jobs").count() == 5
    publish_exports(spark, {"dim_jobs": spark.range(7).withColumnRenamed("id", "job"),
                            "dim_organizations": b}, base, run_id="r2")
    assert read_published(spark, base, "jobs").count() == 7
    assert read_published(spark, base, "organizations").count() == 3


def _days(spark, factor):
    return spark.createDataFrame(
        [(i, f"2024-01-{1 + i % 20:02d}", float(i)) for i in range(40)], "id int, d string, v double"
    ).select("id", F.col("d").cast("date").alias("event_date"), (F.col("v") * factor).alias("v"))


def test_trailing_window_rebuild(spark):
    path = work_path(spark, "inc-test")
    assert rebuild_trailing_window(spark, _days(spark, 1), path, "event_date", "2024-01-20") == "full"
    assert rebuild_trailing_window(spark, _days(spark, 2), path, "event_date", "2024-01-20", days=3) \
        == "incremental"
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 40
    for r in rows:
        changed = r.event_date.day >= 17
        assert r.v == (2 * r.id if changed else r.id)


def test_full_refresh_and_protection(spark):
    for protected, expect_all in ((False, True), (True, False)):
        path = work_path(spark, "inc-test")
        rebuild_trailing_window(spark, _days(spark, 1), path, "event_date", "2024-01-20")
        mode = rebuild_trailing_window(spark, _days(spark, 2), path, "event_date", "2024-01-20",
                                       days=3, full_refresh=True, protected=protected)
        assert mode == ("full" if expect_all else "incremental")
        rows = spark.read.parquet(path).collect()
        assert len(rows) == 40
        assert all((r.v == 2 * r.id) == (expect_all or r.event_date.day >= 17) or r.id == 0 for r in rows)


def test_read_published_missing_export(spark):
    base = work_path(spark, "publish-missing")
    publish_exports(spark, {"dim_jobs": spark.range(1), "dim_organizations": spark.range(1)},
                    base, run_id="r1")
    with pytest.raises(FileNotFoundError):
        read_published(spark, base, "no-such-export")


def test_cluster_partition_sizing():
    from relaymart.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600   # one 256 MB slice each
    assert int(cluster_conf(1024, 64)["spark.sql.shuffle.partitions"]) == 192  # >= 3 waves
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_vanished_days_go_and_later_days_wait(spark):
    path = work_path(spark, "inc-vanish")
    rebuild_trailing_window(spark, _days(spark, 1), path, "event_date", "2024-01-20")
    restated = _days(spark, 2).filter("event_date <> date '2024-01-18'").unionByName(
        spark.sql("select 99 as id, date '2024-01-21' as event_date, 1.0D as v"))
    assert rebuild_trailing_window(spark, restated, path, "event_date", "2024-01-20", days=3) == "incremental"
    days = {r.event_date.day for r in spark.read.parquet(path).select("event_date").distinct().collect()}
    assert days == set(range(1, 21)) - {18}


def test_failed_listing_leaves_a_protected_table(spark, monkeypatch):
    from relaymart.sinks import files
    path = work_path(spark, "inc-guard")
    rebuild_trailing_window(spark, _days(spark, 1), path, "event_date", "2024-01-20", protected=True)

    def refused(*_):
        raise TimeoutError("listing refused")

    monkeypatch.setattr(files, "exists", refused)
    with pytest.raises(TimeoutError):
        rebuild_trailing_window(spark, _days(spark, 2), path, "event_date", "2024-01-20", protected=True)
    assert spark.read.parquet(path).filter("v = id").count() == 40


def test_files_of_a_day_do_not_follow_the_tasks(spark):
    from relaymart.sinks import files
    path = work_path(spark, "inc-files")
    rebuild_trailing_window(spark, _days(spark, 1).repartition(16), path, "event_date", "2024-01-20")
    parts = [f for d in files.names(spark, path) if "=" in d for f in files.names(spark, f"{path}/{d}") if f.startswith("part")]
    assert len(parts) <= 2 * 20


def test_refresh_decision():
    import datetime as dt

    from relaymart.streaming.incremental import should_full_refresh
    at = lambda d, h=0: dt.datetime(2026, 6, d, h, tzinfo=dt.timezone.utc)
    assert should_full_refresh(at(14), "2026-06-07") and should_full_refresh(at(14, 12), "")
    assert not should_full_refresh(at(14, 18), "2026-06-14")
    assert not should_full_refresh(at(13), "2026-06-07") and not should_full_refresh(at(15), "2026-06-07")


def test_an_unfinished_pointer_is_not_read(spark):
    from relaymart.sinks import files
    base = work_path(spark, "publish-half")
    for n in range(1, 6):
        publish_exports(spark, {"dim_jobs": spark.range(n), "dim_organizations": spark.range(1)}, base, dead_after=0)
    half = files._path(spark, f"{base}/_pointers/{9:012d}")
    half[0].mkdirs(half[1])
    assert read_published(spark, base, "jobs").count() == 5
    assert len(files.names(spark, f"{base}/runs")) == 3


def _exports(spark, n):
    return {"dim_jobs": spark.range(n), "dim_organizations": spark.range(1)}


@pytest.mark.parametrize("step", ["first export", "second export", "pointer", "claim", "clean", "runs"])
def test_publishing_goes_on_after_a_run_that_died(spark, monkeypatch, step):
    from relaymart.sinks import files, publish, versions
    base = work_path(spark, "publish-died")
    publish_exports(spark, _exports(spark, 1), base)
    with monkeypatch.context() as m:
        if step in ("first export", "second export"):
            calls, real = [], publish.export_parquet

            def export(df, path):
                calls.append(path)
                if len(calls) == (1 if step == "first export" else 2):
                    df.limit(1).write.parquet(f"{path}/_temporary/0")  # half written
                    raise OSError("killed")
                return real(df, path)

            m.setattr(publish, "export_parquet", export)
        elif step == "pointer":
            def half(rows, base, version):
                fs, p = files._path(spark, f"{base}/{version}/_temporary")
                fs.mkdirs(p)
                raise OSError("killed")

            m.setattr(versions, "write", half)
        elif step == "claim":  # the pointer is whole, its claim still there
            m.setattr(files, "remove", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        else:
            def die(*_, **__):
                raise OSError("killed")

            m.setattr(versions, "clean" if step == "clean" else "clean_runs", die)
        with pytest.raises(OSError, match="killed"):
            publish_exports(spark, _exports(spark, 2), base)
    assert read_published(spark, base, "jobs").count() == (2 if step in ("claim", "clean", "runs") else 1)
    publish_exports(spark, _exports(spark, 3), base)  # the dead run may still be alive: its files stay
    assert read_published(spark, base, "jobs").count() == 3
    for n in range(4, 8):
        publish_exports(spark, _exports(spark, n), base, dead_after=0)
    assert read_published(spark, base, "jobs").count() == 7
    assert len(files.names(spark, f"{base}/runs")) == 3 == len(files.names(spark, f"{base}/_pointers"))


def test_two_runs_never_write_one_version(spark):
    from relaymart.sinks import versions
    base = work_path(spark, "claims")
    a, b = versions.claim(spark, base), versions.claim(spark, base)
    assert a != b
    versions.write(spark.range(2), base, b)
    versions.write(spark.range(1), base, a)  # the slower, older run does not win
    assert versions.read(spark, base).count() == 2
    assert versions.claim(spark, base) > b


def test_a_damaged_export_is_noticed(spark):
    from relaymart.sinks.publish import DamagedExport
    base = work_path(spark, "publish-damaged")
    df = spark.range(9).selectExpr("id", "array(cast(id as string)) as tags", "cast(null as string) as s").repartition(3)
    publish_exports(spark, {"dim_jobs": df, "dim_organizations": spark.range(0)}, base, run_id="r1")
    assert read_published(spark, base, "jobs").count() == 9 and read_published(spark, base, "organizations").count() == 0
    df.filter("id < 8").unionByName(df.filter("id = 0")).write.mode("overwrite").parquet(f"{base}/runs/r1/jobs")
    with pytest.raises(DamagedExport, match="jobs"):
        read_published(spark, base, "jobs")
    assert read_published(spark, base, "jobs", check=False).count() == 9
