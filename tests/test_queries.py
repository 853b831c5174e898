"""Every registered query against its SQL, and the shape of its plan."""

import re

import pytest
from oracle import compare, connect

from millrace.catalogue import ORACLES, QUERIES

#: Operators that do not scale, or leave the JVM.
FORBIDDEN = re.compile(
    "CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas|ExistingRDD"
)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    assert not FORBIDDEN.search(plan(df)), plan(df)
    verdict, count = compare(df, duck, ORACLES[name])
    assert verdict == "ok"
    assert count > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns[0] == "order_id" and df.limit(1).count() == 1
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.items() <= entry.oracle_sql().items()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["incremental_extract"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    text = plan(QUERIES["agg_refunds"](spark, sf_dir))
    assert "EqualTo(l_returnflag,R)" in text
    assert "l_quantity" not in text


def test_latest_per_key_limits_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["dedupe_latest"](spark, sf_dir))
    partial = text.index("row_number(), 1, Partial")
    assert text.index("Exchange hashpartitioning") < partial  # printed from the result down to the scan


def test_sales_join_needs_no_further_shuffle(spark, sf_dir):
    """Both sides come out of their aggregation partitioned by order: one exchange each for
    the two small given tables, one for the latest refund per id, one for the sums."""
    assert plan(QUERIES["fct_sales"](spark, sf_dir)).count("Exchange hashpartitioning") <= 5
