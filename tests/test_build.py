import pytest

from relaymart.plans.build import build, build_all
from relaymart.quality.contracts import ContractError
from relaymart.session import work_path
from relaymart.sources.fixtures import load_sources


def test_strict_build_rejects_orphan_jobs(spark, sf_small):
    # jobs whose organization file is missing break dim_jobs' NOT NULL contract
    with pytest.raises(ContractError, match="dim_jobs.organization_id"):
        build(spark, load_sources(spark, sf_small), "2024-02-15", run_checks=False)


def test_lenient_build_reports_and_does_not_publish(spark, sf_small):
    res = build_all(spark, sf_small, as_of="2024-02-15",
                    publish_base=work_path(spark, "pub"))
    assert res.published is None
    assert any("dim_jobs.organization_id" in p for p in res.problems)
    report = {(r.model, r.column_name, r.check_name): r.failures for r in res.check_report.collect()}
    assert len(report) == 161
    assert report[("stg_resend__contact_events", "event_type", "accepted_values")] == 1
    assert report[("dim_jobs", "organization_id", "not_null")] > 0
    assert set(res.marts) == {"dim_jobs", "dim_organizations", "dim_email_messages",
                              "dim_email_subscribers", "fct_email_events",
                              "fct_email_subscriber_messages", "fct_email_subscribers_daily",
                              "fct_form_submissions"}


def clean_sources(spark, sf_dir):
    """Every job's organization is present, and every event type accepted."""
    from pyspark.sql import functions as F
    src = dict(load_sources(spark, sf_dir))
    orgs = src["content_organizations"].select(
        F.regexp_extract("file_path", r"(org-\d+)", 1).alias("org"))
    src["content_jobs"] = src["content_jobs"].join(
        orgs, F.regexp_extract("file_path", r"/(org-\d+)/", 1) == F.col("org"), "left_semi")
    src["resend_wh_contacts"] = src["resend_wh_contacts"].filter(
        "event_type in ('contact.created', 'contact.updated')")
    # one recipient an e-mail: addresses that differ by case only repeat ids
    for name in ("resend_wh_emails", "resend_emails_backfill"):
        src[name] = src[name].withColumn("to_addresses", F.slice("to_addresses", 1, 1))
    return src


def test_clean_build_publishes(spark, sf_small):
    """A build without problems publishes both exports, one without checks
    none."""
    from relaymart.sinks import files
    from relaymart.sinks.publish import read_published
    src = clean_sources(spark, sf_small)
    base = work_path(spark, "pub")
    with pytest.raises(ValueError):
        build(spark, src, "2024-02-15", run_checks=False, publish_base=base)
    res = build(spark, src, "2024-02-15", publish_base=base)
    assert res.problems == [], res.check_report.filter("failures > 0").collect()
    assert read_published(spark, base, "jobs").count() == res.marts["dim_jobs"].count() > 0
    assert read_published(spark, base, "organizations").count() == \
        res.marts["dim_organizations"].count()
    # nothing but the set and its pointer is left
    assert sorted(files.names(spark, res.marts_dir)) == ["_generations", "generations"]
    (one,) = files.names(spark, f"{res.marts_dir}/generations")
    assert sorted(files.names(spark, f"{res.marts_dir}/generations/{one}")) == sorted([*res.marts, "_check_report"])


def test_refused_build_leaves_marts_and_tables_as_they_were(spark, sf_small):
    from relaymart.sinks import files, generations
    marts_dir, db = work_path(spark, "marts"), "relaymart_refused"
    build(spark, clean_sources(spark, sf_small), "2024-02-15", marts_dir=marts_dir, run_checks=False, database=db)
    def listing():
        return {path: sorted(files.names(spark, path)) for path in generations.current(spark, marts_dir).values()}
    before = listing()
    rows = sorted(map(str, spark.table(f"{db}.dim_jobs").collect()))
    with pytest.raises(ContractError, match="dim_jobs.organization_id"):
        build(spark, load_sources(spark, sf_small), "2024-02-15", marts_dir=marts_dir, database=db)
    assert listing() == before and len(files.names(spark, f"{marts_dir}/generations")) == 1
    assert sorted(map(str, spark.table(f"{db}.dim_jobs").collect())) == rows
    assert sorted(map(str, generations.read_mart(spark, marts_dir, "dim_jobs").collect())) == rows


def two_sets(spark):
    """Stand-ins for the marts of two builds: every row says which."""
    return [{m: spark.range(3).selectExpr("id", f"{n} as build") for m in ("dim_a", "dim_b", "fct_c")} for n in (1, 2)]


def write_set(spark, marts_dir, marts, dead_after=None):
    from relaymart.sinks import generations, versions
    from relaymart.sinks.publish import write_table
    generation = generations.begin()
    for name, df in marts.items():
        write_table(df, f"{generations.folder(marts_dir, generation)}/{name}")
    generations.switch(spark, marts_dir, generation, marts)
    generations.clean(spark, marts_dir, versions.DEAD_AFTER if dead_after is None else dead_after)
    return generation


def seen(spark, marts_dir):
    from relaymart.sinks import generations
    return {r.build for m in ("dim_a", "dim_b", "fct_c") for r in generations.read_mart(spark, marts_dir, m).collect()}


@pytest.mark.parametrize("step", range(8))
def test_readers_see_one_set_whatever_fails(spark, monkeypatch, step):
    """The n-th call to the file system or a writer fails: whole old or whole new set."""
    from pyspark.sql import DataFrameWriter

    from relaymart.sinks import files
    marts_dir = work_path(spark, "sets")
    one, two = two_sets(spark)
    write_set(spark, marts_dir, one)
    calls = []

    def failing(real):
        def call(*a, **k):
            calls.append(real)
            if len(calls) == step + 1:
                raise OSError("killed")
            return real(*a, **k)
        return call

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", failing(DataFrameWriter.parquet))
        for name in ("names", "create", "remove", "listing"):
            m.setattr(files, name, failing(getattr(files, name)))
        try:
            write_set(spark, marts_dir, two)
        except OSError as e:
            assert str(e) == "killed"
    assert seen(spark, marts_dir) in ({1}, {2})
    write_set(spark, marts_dir, two, dead_after=0)
    assert seen(spark, marts_dir) == {2}
    assert len(files.names(spark, f"{marts_dir}/generations")) <= 3


def test_roll_back(spark):
    from relaymart.sinks import generations
    marts_dir = work_path(spark, "sets")
    one, two = two_sets(spark)
    with pytest.raises(FileNotFoundError):
        generations.read_mart(spark, marts_dir, "dim_a")
    first = write_set(spark, marts_dir, one)
    with pytest.raises(FileNotFoundError):
        generations.roll_back(spark, marts_dir)
    write_set(spark, marts_dir, two)
    assert generations.roll_back(spark, marts_dir) == first and seen(spark, marts_dir) == {1}
    with pytest.raises(FileNotFoundError):
        generations.roll_back(spark, marts_dir)
    write_set(spark, marts_dir, two)
    assert seen(spark, marts_dir) == {2}


def test_tables_follow_the_set(spark, sf_small):
    from relaymart.sinks import generations
    marts_dir, db = work_path(spark, "marts"), "relaymart_follow"
    src = clean_sources(spark, sf_small)
    build(spark, src, "2024-02-15", marts_dir=marts_dir, run_checks=False, database=db)
    first = generations.current(spark, marts_dir)
    build(spark, src, "2024-02-15", marts_dir=marts_dir, run_checks=False, database=db)
    second = generations.current(spark, marts_dir)
    assert not set(first.values()) & set(second.values())
    for name, path in second.items():
        assert spark.table(f"{db}.{name}").inputFiles()[0].removeprefix("file:").lstrip("/").startswith(path.lstrip("/"))


def test_a_bad_document_breaks_the_contract(spark, sf_small):
    src = clean_sources(spark, sf_small)
    from relaymart.plans import marts as M
    real = M.fct_form_submissions

    def spoiled(*a):
        from pyspark.sql import functions as F
        return real(*a).withColumn("form_submission_details", F.when(
            F.col("source") == "webflow", F.lit("{broken")).otherwise(F.col("form_submission_details")))

    M.fct_form_submissions = spoiled
    try:
        with pytest.raises(ContractError, match="form_submission_details: .* no JSON"):
            build(spark, src, "2024-02-15", run_checks=False)
        res = build(spark, src, "2024-02-15", run_checks=False, strict=False)
    finally:
        M.fct_form_submissions = real
    (bad,) = res.json_violations.collect()
    assert bad.n_invalid == res.marts["fct_form_submissions"].filter("source = 'webflow'").count() > 0
    assert len(res.problems) == 1 and res.constraint_violations.count() == 0


def test_zoned_timestamps_give_the_same_marts(spark, sf_small):
    """Sources with TIMESTAMP columns, under two session zones."""
    from pyspark.sql import functions as F

    from relaymart.sources.tables import SourceTables
    derived = load_sources(spark, sf_small)
    base = work_path(spark, "zoned")
    for name in derived:
        df = derived[name]
        ntz = [c for c, t in df.dtypes if t == "timestamp_ntz"]
        df.withColumns({c: F.to_timestamp(F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00")))
                        for c in ntz}).write.parquet(f"{base}/{name}")
    assert "timestamp" in dict(spark.read.parquet(f"{base}/resend_wh_emails").dtypes).values()
    ref = build(spark, derived, "2024-02-15", strict=False, run_checks=False)
    zone = spark.conf.get("spark.sql.session.timeZone")
    for tz in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        try:
            res = build(spark, SourceTables(spark, base), "2024-02-15", strict=False, run_checks=False)
            for m in ref.marts:
                assert res.marts[m].exceptAll(ref.marts[m]).count() == 0
                assert res.marts[m].count() == ref.marts[m].count()
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)


def test_build_from_source_tables(spark, sf_small):
    """The same build reads real per-source Parquet folders."""
    from relaymart.sources.fixtures import SOURCE_NAMES
    from relaymart.sources.tables import SourceTables
    base = work_path(spark, "sources")
    derived = load_sources(spark, sf_small)
    for name in SOURCE_NAMES:
        derived[name].write.parquet(f"{base}/{name}")
    res = build(spark, SourceTables(spark, base), "2024-02-15", strict=False, run_checks=False)
    ref = build(spark, derived, "2024-02-15", strict=False, run_checks=False)
    for m in ("fct_email_subscribers_daily", "fct_form_submissions", "dim_jobs"):
        assert res.marts[m].exceptAll(ref.marts[m]).count() == 0
        assert res.marts[m].count() == ref.marts[m].count()


def test_marts_registered_in_target_schema(spark, sf_small):
    res = build(spark, load_sources(spark, sf_small), "2024-02-15", strict=False,
                run_checks=False, database="relaymart_ci_test")
    for name, df in res.marts.items():
        t = spark.table(f"relaymart_ci_test.{name}")
        assert t.columns == df.columns
        assert t.count() == df.count()
