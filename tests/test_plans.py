"""Physical-plan properties the scale design relies on."""

import __spark_entry__ as entry
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_projection_reach_the_scan(spark):
    p = _plan(entry.queries()["filter_year_compound"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate" in p


def test_flagship_prunes_columns_and_aggregates_map_side(spark):
    p = _plan(entry.queries()["agg_year_quarter"](spark, SF_SMALL))
    assert "partial_count" in p and "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in p


def test_distinct_on_uses_partial_group_limit(spark):
    p = _plan(entry.queries()["distinct_on_brand"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_global_row_number_has_no_single_partition_window_over_rows(spark):
    df = entry.queries()["win_row_number"](spark, SF_SMALL)
    p = _plan(df)
    # The only global window is over the per-bucket counts, never over orders.
    assert "Window [row_number() windowspecdefinition(o_orderdate" not in p
    assert "hashpartitioning(_gp_b" in p


def test_range_join_broadcasts_fixed_band_table(spark):
    p = _plan(entry.queries()["join_band_range"](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" in p or "BroadcastExchange" in p
