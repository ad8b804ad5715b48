"""Physical-plan checks: what Catalyst must be able to do with the operators."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cropscope.plans import QUERIES
from cropscope.plans import queries as Q

LAZY = [k for k in QUERIES if k not in {
    "ndvi_masked_stats", "roi_histogram", "label_sections", "ndvi_batch_output", "ndvi_batch_job",
    "yield_linear_1", "yield_linear_5", "yield_forest", "disease_forest", "yield_forest_step",
    "disease_forest_step", "stream_scored_history", "stream_latest_state", "stream_trends",
    "tile_ndvi_stats", "ndvi_run_metrics", "yield_linear_versioned"}]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pair_building_joins(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_flagship_prunes_columns_and_aggregates_partially(spark):
    p = plan(QUERIES["scene_health_report"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_suppkey:bigint,l_discount:double,l_tax:double>" in p
    assert "partial_avg" in p and "partial_stddev_pop" in p


def test_filter_on_rule_output_reaches_scan(spark):
    df = Q.q_economics_guarded(spark, SF_SMALL).where(F.col("field_id") == 7)
    p = plan(df)
    assert "PushedFilters: [IsNotNull(l_orderkey), EqualTo(l_orderkey,7)]" in p


def test_first_ten_limits_before_shuffle(spark):
    p = plan(QUERIES["trend_first_ten"](spark, SF_SMALL))
    # a partial limit runs before the exchange, the final one after it
    partial = p.find("row_number(), 10, Partial")
    exchange = p.find("Exchange hashpartitioning(field_id")
    assert partial > exchange > 0      # tree string lists the child below its parent


def test_trend_reuses_image_partitioning(spark):
    p = plan(QUERIES["trend_per_1000_days"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning") == 2


def test_latest_is_an_aggregate_not_a_window(spark):
    p = plan(QUERIES["latest_observation"](spark, SF_SMALL))
    assert "partial_max_by" in p and "Window" not in p and "SortAggregate" not in p


def test_scenarios_meet_their_field_by_one_equi_join(spark):
    p = plan(QUERIES["scenario_grid"](spark, SF_SMALL))
    assert p.count("Join") == 1 and "Generate" not in p


def test_stress_counts_scan_once(spark):
    p = plan(QUERIES["stress_class_counts"](spark, SF_SMALL))
    assert p.count("FileScan parquet") == 1


def test_exact_median_uses_no_holistic_aggregate(spark):
    p = plan(QUERIES["ndvi_masked_stats"](spark, SF_SMALL))
    assert "percentile(" not in p and "median(" not in p


def test_scene_header_sorts_no_pixel(spark):
    p = plan(QUERIES["scene_metadata"](spark, SF_SMALL))
    assert "SortAggregate" not in p and "Sort " not in p


def test_year_trend_shuffles_once(spark):
    p = plan(QUERIES["trend_per_year"](spark, SF_SMALL))
    assert p.count("Exchange") == 1 and "Window" not in p and "SortAggregate" not in p
