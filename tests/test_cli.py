from relaymart.__main__ import main


def test_cli_freshness_and_build(spark, sf_small, capsys):
    assert main(["freshness", "--sf-dir", sf_small, "--now", "2024-01-31 00:00:00"]) == 1
    out = capsys.readouterr().out
    assert "resend_wh_emails" in out and "pass" in out
    assert "netlify_form_submissions: error" in out
    # one too old source is enough; without --now ages count to the present
    assert main(["freshness", "--sf-dir", sf_small]) == 1
    assert "pass" not in capsys.readouterr().out
    # the derived fixtures contain orphan jobs and failing checks: exit 1, no publish
    assert main(["build", "--sf-dir", sf_small, "--as-of", "2024-02-15"]) == 1
    err = capsys.readouterr().err
    assert "dim_jobs.organization_id" in err
    # strict mode stops at the contract
    assert main(["build", "--sf-dir", sf_small, "--as-of", "2024-02-15", "--strict"]) == 2


def test_cli_publish(spark, tmp_path):
    marts = str(tmp_path / "marts")
    spark.range(3).write.parquet(f"{marts}/dim_jobs")
    manifest = tmp_path / "m.json"
    manifest.write_text('[{"name": "j", "dataset": "d", "relation": "dim_jobs"}]')
    args = ["publish", "--marts-dir", marts, "--publish-base", str(tmp_path / "pub"), "--manifest", str(manifest)]
    assert main(args) == 1  # never checked
    spark.sql("select 'm' as model, 0L as failures").write.parquet(f"{marts}/_check_report")
    assert main(args) == 0
    from relaymart.sinks.publish import read_published
    assert read_published(spark, str(tmp_path / "pub"), "j").count() == 3
