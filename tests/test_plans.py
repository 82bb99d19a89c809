"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from registra import standin
from registra.plans import marts

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pair_activity_scans_once_and_aggregates_by_hash(spark):
    logs = standin.user_logs(spark, FOLDER)
    text = plan(marts.pair_activity(logs, marts.graded_2_to_5(F.col("namer_level"))))
    assert text.count("lineitem.parquet") == 1
    assert "SortAggregate" not in text and "Window" not in text and "Expand" not in text
    # partial, merged, partial, merged
    assert text.count("HashAggregate") == 4
    assert plan(marts.student_grades(logs)).count("SortAggregate") == 0


def test_columns_are_pruned_and_filters_pushed(spark):
    text = plan(QUERIES["q_weekly_avg_events"](spark, FOLDER))
    assert "l_extendedprice" not in text
    text = plan(standin.bank_tables(spark, FOLDER).accounts.filter("account_id > 5").select("account_id"))
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,5)]" in text and "o_totalprice" not in text


def test_report_cuts_transactions_before_any_shuffle(spark):
    text = plan(QUERIES["b_client_report_flat"](spark, FOLDER))
    before_shuffle = text[text.index("3, Partial") : text.index("lineitem.parquet")]
    assert text.count("lineitem.parquet") == 1
    assert "Exchange" not in before_shuffle and "Join" not in before_shuffle


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert banned not in text
    # A join on constants alone is a cross join: its keys would be literals or columns made of one.
    constants = {name for name in re.findall(r"(?<![\w.#])-?\d+ AS (\w+#\d+)", text)}
    for left, right in re.findall(r"(?:HashJoin|SortMergeJoin(?:\(skew=true\))?) \[([^\]]*)\], \[([^\]]*)\]", text):
        for keys in (left, right):
            named = [key.strip().removesuffix("L") for key in keys.split(", ")]
            assert not all(key in constants or re.fullmatch(r"-?\d+", key) for key in named), (left, right)


def test_class_graph_joins_no_individuals(spark):
    text = plan(QUERIES["o_class_graph"](spark, FOLDER))
    assert "_id#" not in text and "individual" not in text


def test_arrivals_read_no_old_logs(spark):
    text = plan(QUERIES["m_performance_arrivals"](spark, FOLDER))
    assert "lineitem.parquet" not in text
