"""Plan-shape guards: the properties the marts rely on at scale."""
import re

import pytest

import __spark_entry__ as E
from bench import HEADLINE
from relaymart.testing.plans import plan_text, summarize

Q = E.queries()


@pytest.mark.parametrize("name", HEADLINE)
def test_no_nested_loop_or_cartesian(spark, sf_small, name):
    assert summarize(Q[name](spark, sf_small))["nested_loop"] == 0


def test_daily_state_plan(spark, sf_small):
    text = plan_text(Q["fct_email_subscribers_daily"](spark, sf_small))
    main = text.split("===== Subqueries =====")[0]
    assert len(re.findall(r"^\(\d+\) Window\b", main, flags=re.M)) == 1
    assert len(re.findall(r"^\(\d+\) Exchange\b", main, flags=re.M)) == 2
    assert not re.search(r"^\(\d+\) \w*Join\b", main, flags=re.M)
    assert text.count("Subquery:") == 1
    # column pruning: the contact snapshot scan reads only the key it needs
    assert "ReadSchema: struct<c_custkey:bigint>" in main


def test_backfill_anti_join_dedups_right_side(spark, sf_small):
    text = plan_text(Q["op_backfill_anti_join"](spark, sf_small))
    assert re.search(r"LeftAnti", text)
    # the webhook side is reduced to distinct keys by an aggregate first
    assert re.search(r"HashAggregate[\s\S]*Keys \[2\]: \[message_id", text)
