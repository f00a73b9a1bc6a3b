"""Plan-shape checks: the properties the design relies on at scale."""

import re

from lakekit import proxies as P
from lakekit.plans import business as B
from lakekit.plans.jobs import sales_by_category

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_products_broadcast_and_items_aggregated_first(spark):
    plan = _plan(P.sales(spark, SF))
    assert "BroadcastHashJoin" in plan
    assert "partial_" in plan.split("BroadcastHashJoin")[1]
    assert "ReadSchema: struct<l_partkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan


def test_large_products_preaggregate_before_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = sales_by_category(P.order_items(spark, SF), P.products(spark, SF), merge=True)
        plan = _plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    # the item side reaches its only exchange already partially aggregated per product
    items_side = plan.split("SortMergeJoin")[1]
    exchange_at = items_side.index("Exchange hashpartitioning(product_id")
    assert "partial_" in items_side[exchange_at:]


def test_no_cross_join_anywhere(spark):
    sales, emp = P.sales(spark, SF), P.employees(spark, SF)
    for df in (B.executive_kpis(sales, emp), B.top_share(sales), B.cross_domain(sales, emp, P.proxy_map(spark))):
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_top_k_does_not_sort_everything(spark):
    plan = P.sales(spark, SF).transform(lambda s: B.top_categories_raw(s, 5))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_literal_map_is_local_and_broadcast(spark):
    plan = _plan(B.cross_domain(P.sales(spark, SF), P.employees(spark, SF), P.proxy_map(spark)))
    assert "LocalTableScan" in plan and "BroadcastHashJoin" in plan


def test_distinct_count_deduplicates_on_department_and_id(spark):
    plan = _plan(B.cross_domain(P.sales(spark, SF), P.employees(spark, SF), P.proxy_map(spark)))
    assert re.search(r"hashpartitioning\(departamento#\d+, employee_id#\d+", plan)


def test_employee_conform_is_one_narrow_stage(spark):
    plan = P.employees(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "")


def test_all_checks_on_a_table_share_one_scan(spark):
    from pyspark.sql import functions as F

    from lakekit import expect as X

    items = P.table(spark, SF, "lineitem")
    checks = X.expect_all(
        items,
        [
            X.rows_at_least("rows"),
            X.no_nulls("l_partkey"),
            X.metric_within("lines", F.max("l_linenumber"), 7.0),
        ],
    )
    plan = _plan(checks)
    assert plan.count("FileScan parquet") == 1
    assert {r.check: r.status for r in checks.collect()} == {"rows": "OK", "nulls:l_partkey": "OK", "lines": "OK"}
