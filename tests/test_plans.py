"""Plan shape: pruning, pushdown, joins by measured size, generated code, no cross joins."""

import pytest

import __spark_entry__ as entry
from stationdw.plans.bridge import orders_staging
from tests.conftest import SF_SMALL
from tests.test_entry import OWN


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_orders_scan_is_pruned(spark):
    text = plan_text(orders_staging(spark, SF_SMALL))
    scan = [line for line in text.splitlines() if "orders.parquet" in line][0]
    assert "o_orderkey" not in scan and "o_orderstatus" not in scan
    assert "o_custkey" in scan and "o_totalprice" in scan


def test_daily_view_pushes_null_filter_and_broadcasts_dims(spark):
    df = entry.queries()["daily_view"](spark, SF_SMALL)
    text = plan_text(df)
    assert "BroadcastHashJoin" in text
    fact_scan = [line for line in text.splitlines()
                 if "FileScan parquet" in line and "dly_tmin_normal" in line][0]
    assert "IsNotNull(dly_tmin_normal)" in fact_scan and "IsNotNull(mtd_prcp_normal)" in fact_scan


def test_station_filter_below_monthly_aggregate(spark):
    df = entry.queries()["q2_compare"](spark, SF_SMALL)
    opt = optimized(df)
    # The IN filter on the grouping column is pushed under the monthly Aggregate, through the
    # join, onto the station dimension (so fact rows of other stations never reach the shuffle).
    below_last_agg = opt[opt.rindex("Aggregate"):]
    assert "IN (1,2)" in below_last_agg


@pytest.mark.parametrize("name", sorted(OWN))
def test_no_cartesian_products(spark, name):
    if name.startswith("stream_"):
        pytest.skip("streaming queries run to completion when called")
    text = plan_text(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_all_station_rollup_shuffles_narrow_keys(spark):
    text = plan_text(entry.queries()["q1_monthly"](spark, SF_SMALL))
    exchanges = [line for line in text.splitlines() if "hashpartitioning(" in line]
    assert any("station_key" in line and "station_name" not in line for line in exchanges)


def executed(df):
    df.write.format("noop").mode("overwrite").save()   # run it so AQE settles the final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_does_not_shuffle_table_rows(spark):
    from pyspark.sql import functions as F
    from stationdw.operators.upsert import upsert_latest
    current = spark.range(0, 20000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    batch = spark.range(0, 50).select(F.col("id").alias("k"), F.lit(-1).alias("v"),
                                      F.col("id").alias("_arrival"))
    text = plan_text(upsert_latest(current, batch, ["k"], ["_arrival"], incoming_unique=True))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert "SortMergeJoin" not in text


def test_distributed_ranks_avoid_single_partition(spark):
    from pyspark.sql import functions as F
    from stationdw.operators.ranking import global_rank, rank_within
    df = spark.range(0, 5000).select("id", (F.col("id") % 17).alias("x"),
                                     (F.col("id") % 3).alias("g"))
    for out in (global_rank(df, ["x"], [False], "r", distributed=True),
                rank_within(df, ["g"], ["x"], [False], "r", distributed=True)):
        lines = executed(out).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                # Only the per-range-partition totals (one row per partition) meet in one task.
                assert "HashAggregate(keys=[_pid" in lines[i + 1], lines[i + 1]


def test_first_per_group_is_a_partial_aggregate(spark):
    from pyspark.sql import functions as F
    from stationdw.operators.ranking import first_per_group
    df = spark.range(0, 5000).select((F.col("id") % 5).alias("g"), "id")
    text = plan_text(first_per_group(df, ["g"], [("id", False)]))
    assert "Window" not in text
    assert "partial_min_by" in text


def test_month_slice_reads_one_month(spark):
    text = plan_text(entry.queries()["month_slice"](spark, SF_SMALL))
    filters = [line for line in text.splitlines() if "PartitionFilters: [" in line]
    assert any("date_month" in line.split("PartitionFilters: [")[1] for line in filters)


def test_annual_profile_has_no_window_per_year(spark):
    df = entry.queries()["q5_annual_profile"](spark, SF_SMALL)
    windows = [line for line in (optimized(df) + plan_text(df)).splitlines() if "Window" in line]
    assert not any("year_num" in line for line in windows)


@pytest.mark.parametrize("name", ["pick_fields", "summary_rejected"])
def test_picked_fields_compile(spark, name):
    """A plan whose generated code does not compile fails instead of running interpreted."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert entry.queries()[name](spark, SF_SMALL).count() > 0
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
