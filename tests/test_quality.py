import pytest
from pyspark.sql import functions as F

from relaymart.quality import checks as Q
from relaymart.quality.contracts import (
    CONTRACTS, ContractError, contract_schema, enforce_schema, not_null_columns, not_null_violations)


def test_declared_inventory():
    from collections import Counter
    assert Counter(c.kind for c in Q.DECLARED) == {
        "not_null": 93, "unique": 23, "accepted_values": 24, "normalized_email": 12,
        "relationships": 9}
    assert len(CONTRACTS) == 8
    assert sum(len(v) for v in CONTRACTS.values()) == 70
    assert sum(len(not_null_columns(m)) for m in CONTRACTS) == 35


def test_single_checks(spark):
    df = spark.createDataFrame(
        [(1, "a@x.com", "sent"), (2, " B@x.com", "open"), (2, None, None), (3, "c@x.com", "sent")],
        "id int, email string, et string")
    assert Q.failing_not_null(df, "email").count() == 1
    assert [r.id for r in Q.failing_unique(df, "id").collect()] == [2]
    assert [r.et for r in Q.failing_accepted_values(df, "et", ("sent",)).collect()] == ["open"]
    assert [r.email for r in Q.failing_normalized_email(df, "email").collect()] == [" B@x.com"]
    parent = spark.createDataFrame([(1,), (3,)], "id int")
    assert [r.id for r in Q.failing_relationships(df, "id", parent, "id").collect()] == [2, 2]


def test_boolean_accepted_values_are_unquoted(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert Q.failing_accepted_values(df, "b", ("true", "false")).count() == 0


def test_suite_counts_failures(spark):
    models = {
        "m": spark.createDataFrame([(1, "x"), (1, None)], "k int, v string"),
        "p": spark.createDataFrame([(2,)], "k int"),
    }
    checks = [Q.Check("m", "v", "not_null"), Q.Check("m", "k", "unique"),
              Q.Check("m", "v", "accepted_values", ("y",)),
              Q.Check("m", "k", "relationships", parent=("p", "k"))]
    got = {(r.check_name): r.failures for r in Q.run_suite(models, checks).collect()}
    assert got == {"not_null": 1, "unique": 1, "accepted_values": 1, "relationships": 2}


def test_contract_enforcement(spark):
    schema = contract_schema("fct_email_subscribers_daily")
    good = spark.createDataFrame([], schema)
    assert enforce_schema(good, "fct_email_subscribers_daily").columns == [f.name for f in schema]
    bad = good.withColumn("date_day", F.col("date_day").cast("string"))
    with pytest.raises(ContractError):
        enforce_schema(bad, "fct_email_subscribers_daily")
    with pytest.raises(ContractError):
        enforce_schema(good.drop("is_subscribed"), "fct_email_subscribers_daily")


def test_not_null_violations(spark):
    df = spark.createDataFrame(
        [("a", None, "s", True), (None, None, "s", True)],
        "email_subscriber_daily_id string, date_day date, subscriber_id string, is_subscribed boolean")
    got = {r.column_name: r.n_nulls for r in not_null_violations(df, "fct_email_subscribers_daily").collect()}
    assert got == {"email_subscriber_daily_id": 1, "date_day": 2}


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("hashed", [Q.value_hash, lambda v: F.length(v).cast("long")], ids=["hash", "colliding"])
def test_repeated_values_in_two_phases(spark, monkeypatch, hashed, broadcast):
    if not broadcast:
        monkeypatch.setattr(Q, "SUSPECTS", 0)
    a = spark.range(2000).selectExpr("cast(id as string) as u", "cast(id % 700 as string) as w", "cast(null as string) as z")
    b = spark.createDataFrame([(1, True), (1, None), (2, None), (3, True), (None, None)], "n int, t boolean")
    found = Q.repeated_values([(0, a, "u"), (1, a, "w"), (2, a, "z"), (3, b, "n"), (4, b, "t")], hashed)
    assert {r.k: r.failures for r in found.collect()} == {1: 700, 3: 1, 4: 1}
    assert hashed is not Q.value_hash or Q.repeated_values([(0, a, "u"), (2, a, "z")]) is None


def test_unique_columns_alone(spark):
    models = {"m": spark.range(9).selectExpr("cast(id as string) as u")}
    assert [r.failures for r in Q.run_suite(models, [Q.Check("m", "u", "unique")]).collect()] == [0]


def test_json_columns_hold_json(spark):
    from relaymart.quality.contracts import json_violations
    good = ['{}', '{"a": {"b": [1, 2.50, null, "x"]}}', '[1]', '"x"', 'null', '1', ' {"a": 1} ', '{"é": "\\u00e9"}']
    bad = ['', '{', '{"a": }', "{'a': 1}", '{"a": 1} x', 'nothing', '{"a": 1, "a": 2}', '{a: 1}',
           '1] [2', '1} {2', '1,2', '1,"w":2', '  ', 'NaN', '01', '{"a": 1}}']
    df = spark.createDataFrame([(v,) for v in good + bad + [None]], "j string").withColumn("k", F.lit("{}"))
    rows = {r.column_name: (r.n_rows, r.n_invalid) for r in json_violations(df, "t", ["j", "k"]).collect()}
    assert rows == {"j": (25, len(bad)), "k": (25, 0)}
    assert json_violations(df.filter("false"), "t", ["j"]).first().n_invalid == 0


def test_relationships_count_child_rows_before_the_join(spark):
    """Child rows are cut down to their keys first: no join shuffles or sorts them."""
    models = {
        "c": spark.range(1000).selectExpr("if(id % 10 = 9, null, id % 10) as k"),
        "p": spark.range(20).selectExpr("id % 4 as k").union(spark.sql("select cast(null as long)")),
    }
    report = Q.run_suite(models, [Q.Check("c", "k", "relationships", parent=("p", "k"))])
    assert [r.failures for r in report.collect()] == [500]  # keys 4 to 8
    plan = report._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [b for a, b in zip(plan, plan[1:]) if "Join Left" in a]
    assert len(joins) == 2 and any("Aggregate [k#" in b for b in joins), "\n".join(plan)
