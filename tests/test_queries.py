"""Every registered query against its SQL on the smallest data, and plans of key operators."""

import pytest

import __spark_entry__ as entry_module
import check
from conftest import SF_DIR

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    verdict, _ = check.compare(spark, con, SF_DIR, name, QUERIES[name], SQL.get(name))
    assert verdict == ("ok" if name in SQL else "rows only")


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["label_export_filter"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)" in text
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in text  # the long text is not read


def test_no_query_plans_a_cartesian_product(spark):
    for name in ("snapshot_join", "self_join_candidates", "point_in_polygon", "min_max_scale", "mismatch_share"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_containment_moves_no_points(spark):
    text = plan(QUERIES["cleansing_chain_full"](spark, SF_DIR))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text
