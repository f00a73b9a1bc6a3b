from pyspark.sql import functions as F

from lakekit.operators import count_by, join_dim, rollup_sum, sum_by, top_k, top_sum, unmatched

ITEMS = "k string, v double, item string"


def test_sum_and_count_by_keep_null_group(spark):
    df = spark.createDataFrame([("a", 1.10, "x"), ("a", 2.20, None), (None, 3.0, "y")], ITEMS)
    s = {r.k: r.total for r in sum_by(df, "k", "v", "total").collect()}
    c = {r.k: r.n for r in count_by(df, "k", "item", "n").collect()}
    assert s == {"a": 3.3, None: 3.0} and c == {"a": 1, None: 1}


def test_rollup_resums_money_and_counts(spark):
    df = spark.createDataFrame([("d", "a", 0.1, 1), ("d", "b", 0.2, 2), ("e", "c", 1.0, 3)], "dept string, cat string, r double, n bigint")
    got = {row.dept: (row.r, row.n) for row in rollup_sum(df, "dept", money=["r"], counts=["n"]).collect()}
    assert got == {"d": (0.3, 3), "e": (1.0, 3)}  # exact: 0.1 + 0.2 == 0.3


def test_top_k_and_top_sum(spark):
    df = spark.createDataFrame([(str(i), float(i % 5)) for i in range(20)], "c string, r double")
    top = top_k(df, [F.desc_nulls_last("r")], 3, tie=["c"]).collect()
    assert [(x.c, x.r) for x in top] == [("14", 4.0), ("19", 4.0), ("4", 4.0)]
    assert top_sum(df, "r", 5, tie=["c"]).first()[0] == 4.0 * 4 + 3.0


def test_join_dim_leaves_the_strategy_to_catalyst(spark):
    fact = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("z", 3.0)], "k string, v double")
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, name string")
    assert sorted(r.name for r in join_dim(fact, dim, "k").collect()) == ["A", "B"]
    merged = join_dim(fact, dim, "k", merge=True)
    assert "SortMergeJoin" in merged._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.name for r in merged.collect()) == ["A", "B"]
    assert [r.k for r in unmatched(fact, dim, "k").collect()] == ["z"]
