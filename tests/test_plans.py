"""The plans that the operators are built for."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as registered
from lodewright.operators import scripts
from lodewright.plans import calendar_queries, script_queries, table_queries

FOLDER = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_are_not_shuffled_for_the_calendar(spark):
    plan = _plan(calendar_queries.events_by_workday(spark, FOLDER))
    assert "SortMergeJoin" not in plan
    # One shuffle, of the partial sums.
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan


def test_script_operators_do_not_shuffle(spark):
    frame = spark.createDataFrame([(1, "a; b")], "script_id int, text string")
    for operator in (
        scripts.split_statements,
        scripts.split_statements_simple,
        scripts.extract_variables,
        scripts.render_templates,
        scripts.strip_comments,
        scripts.classify_statements,
        scripts.unwrap_statement_set,
    ):
        plan = _plan(operator(frame))
        assert "Exchange" not in plan and "Window" not in plan, operator
        assert "Python" not in plan, operator


def test_statements_are_computed_once(spark):
    plan = _plan(script_queries.ddl_dictionary_parts(spark, FOLDER))
    assert "Python" not in plan
    assert "Filter (size" not in re.sub(r"\s+", " ", plan).replace("((", "(")


def _tasks(df):
    return df.rdd.getNumPartitions()


@pytest.mark.parametrize("name", ["ddl_dictionary_parts", "ddl_dictionary_folded"])
def test_a_table_of_one_row_group_is_work_for_all_cores(spark, tmp_path, name):
    rows = spark.range(40).selectExpr("id AS p_partkey", "'a' AS p_name", "'b' AS p_type", "1 AS p_size")
    rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = script_queries.QUERIES[name](spark, str(tmp_path))
    assert _tasks(found) >= spark.sparkContext.defaultParallelism
    assert found.count() == 40 * 5


def test_a_table_of_many_splits_is_not_dealt_again(spark, tmp_path):
    splits = 4 * spark.sparkContext.defaultParallelism
    rows = spark.range(splits).selectExpr("id AS p_partkey", "'a' AS p_name", "'b' AS p_type", "1 AS p_size")
    rows.repartition(splits).write.parquet(f"{tmp_path}/part.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        assert "Exchange" not in _plan(script_queries.ddl_dictionary_parts(spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(table_queries.lineitem_count(spark, FOLDER))
    assert "ReadSchema: struct<>" in plan
    plan = _plan(table_queries.order_dates(spark, FOLDER).where("o_orderkey = 7"))
    assert "EqualTo(o_orderkey,7)" in plan and "o_totalprice" not in plan


def test_first_values_need_no_window(spark):
    plan = _plan(table_queries.first_value_per_user(spark, FOLDER))
    assert "Window" not in plan and "partial_min_by" in plan


def test_entry(spark):
    assert registered.entry(spark).columns == ["date_type", "is_workday", "events", "value"]
