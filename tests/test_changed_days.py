import datetime as dt

import pytest
from pyspark.sql import functions as F

from relaymart.session import work_path
from relaymart.sinks import files, versions
from relaymart.streaming import incremental as inc

AS_OF = "2024-01-20"


def days(spark, factor=1.0, where="true"):
    rows = [(i, f"2024-01-{1 + i % 20:02d}", float(i)) for i in range(1, 41)] + [(99, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, d string, v double").select(
        "id", F.col("d").cast("date").alias("event_date"), (F.col("v") * factor).alias("v"))
    return df.filter(where)


def day(n):
    return dt.date(2024, 1, n)


def stored(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("id", "event_date", "v").collect()), key=str)


def parts(spark, path):
    return {d: sorted(files.names(spark, f"{path}/{d}")) for d in files.names(spark, path) if "=" in d}


def rebuild(spark, rows, path, **kw):
    return inc.rebuild_changed_days(spark, rows, path, "event_date", AS_OF, days=3, **kw)


def test_only_changed_days_are_rewritten(spark):
    path = work_path(spark, "ledger")
    assert rebuild(spark, days(spark), path).mode == "full"
    before = parts(spark, path)
    # nothing new: nothing is written
    got = rebuild(spark, days(spark).repartition(5), path)
    assert (got.rewritten, got.emptied, got.late) == ([], [], []) and got.unchanged == [None, *map(day, range(17, 21))]
    assert parts(spark, path) == before
    # day 18 restated, 19 emptied, 3 late, rows of 21 not yet due
    new = (days(spark, where="event_date is null or event_date not in (date '2024-01-19')")
           .withColumn("v", F.when(F.col("event_date").isin(day(18), day(3)), 5.0).otherwise(F.col("v")))
           .unionByName(spark.sql("select 100 as id, date '2024-01-21' as event_date, 1.0D as v")))
    got = rebuild(spark, new, path)
    assert (got.mode, got.rewritten, got.emptied, got.late) == ("incremental", [day(18)], [day(19)], [day(3)])
    now = parts(spark, path)
    assert {d for d in before if now.get(d) != before[d]} == {"event_date=2024-01-18", "event_date=2024-01-19"}
    want = [(r[0], r[1], 5.0 if r[1] == day(18) else r[2]) for r in sorted(map(tuple, days(spark).collect()), key=str) if r[1] != day(19)]
    assert stored(spark, path) == sorted(want, key=str)
    # the late day stays reported until it is rebuilt
    assert rebuild(spark, new, path).late == [day(3)]


def test_repeated_rows_and_order_count(spark):
    path = work_path(spark, "ledger")
    rebuild(spark, days(spark), path)
    again = days(spark).unionByName(days(spark, where="id = 19"))
    assert rebuild(spark, again, path).rewritten == [day(20)]
    assert spark.read.parquet(path).filter("id = 19").count() == 2


@pytest.mark.parametrize("rows", [
    lambda s: days(s, where="event_date < date '2024-01-10'"), lambda s: days(s, where="false"),
    lambda s: s.createDataFrame([], "id int, event_date date, v double")])
@pytest.mark.parametrize("from_files", [True, False])
def test_a_quiet_window(spark, rows, from_files):
    """A window without rows removes its days and ends well, by either rebuild."""
    quiet = rows(spark)
    if from_files:
        source = work_path(spark, "quiet")
        quiet.write.parquet(source)
        quiet = spark.read.schema("id int, event_date date, v double").parquet(source)
    path = work_path(spark, "ledger")
    rebuild(spark, days(spark), path)
    got = rebuild(spark, quiet, path)
    assert got.rewritten == [] and got.emptied == [None, *map(day, range(17, 21))]
    left = {r.event_date for r in spark.read.parquet(path).select("event_date").distinct().collect()}
    assert left == set(map(day, range(1, 17)))
    plain = work_path(spark, "window")
    inc.rebuild_trailing_window(spark, days(spark, where="event_date is not null"), plain, "event_date", AS_OF)
    assert inc.rebuild_trailing_window(spark, quiet, plain, "event_date", AS_OF, days=3) == "incremental"
    assert {r.event_date for r in spark.read.parquet(plain).select("event_date").distinct().collect()} == left


def test_a_run_that_dies_is_made_good(spark, monkeypatch):
    path = work_path(spark, "ledger")
    rebuild(spark, days(spark), path)
    restated = days(spark, 2.0, "event_date is null or event_date <> date '2024-01-18'")
    for step in ("remove", "write", "done"):
        with monkeypatch.context() as m:
            def die(*_, **__):
                raise OSError("killed")
            if step == "remove":
                m.setattr(files, "remove", die)
            elif step == "write":
                m.setattr(versions, "write", die)
            if step != "done":
                with pytest.raises(OSError, match="killed"):
                    rebuild(spark, restated, path)
    rebuild(spark, restated, path)
    got = {r[0]: r[2] for r in stored(spark, path)}
    assert {r.id: r.v for r in restated.collect() if r.event_date is None or r.event_date >= day(17)}.items() <= got.items()
    assert not any(i % 20 == 17 for i in got)
    assert rebuild(spark, restated, path).rewritten == []
    assert len(files.names(spark, f"{path}/_ledger")) <= inc.KEEP_LEDGERS


def test_protected_tables_keep_their_history(spark):
    path = work_path(spark, "ledger")
    rebuild(spark, days(spark), path, protected=True)
    got = rebuild(spark, days(spark, 2.0), path, full_refresh=True, protected=True)
    assert got.mode == "incremental" and got.rewritten == [None, *map(day, range(17, 21))] and got.late == list(map(day, range(1, 17)))
    assert rebuild(spark, days(spark, 2.0), path, full_refresh=True).mode == "full"
    # a table of an earlier version, without a ledger
    files.remove(spark, f"{path}/_ledger")
    assert rebuild(spark, days(spark, 2.0), path, protected=True).rewritten == []
    assert inc.read_ledger(spark, path).count() == 21
