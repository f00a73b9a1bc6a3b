"""Differences by key range, malformed rows, and the validator's checks."""

import os

import pytest
from pyspark.sql import functions as F

from lakekit import expect as X
from lakekit import reconcile as R
from lakekit.sources.quarantine import split_csv

SF = "/root/testdata/sf0.001"


def _found(df):
    return sorted(((r.lo, r.hi, r.left_rows, r.right_rows) for r in df.collect()), key=str)


def test_one_changed_item_is_located(spark):
    items = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert R.differing_ranges(items, items.repartition(5), "l_orderkey").count() == 0
    key = items.agg(F.max("l_orderkey")).first()[0]
    n = items.where(F.col("l_orderkey") == key).count()
    changed = items.withColumn("l_tax", F.when((F.col("l_orderkey") == key) & (F.col("l_linenumber") == 1), F.col("l_tax") + 1e-9).otherwise(F.col("l_tax")))
    assert _found(R.differing_ranges(items, changed.orderBy("l_tax"), "l_orderkey", fan=7)) == [(key, key, n, n)]
    (wide,) = R.differing_ranges(items, changed, "l_orderkey", fan=7, leaf=100).collect()
    assert wide.lo <= key <= wide.hi == wide.lo + 99
    assert [r.status for r in R.expect_equal(items, items.repartition(3), "same").unionByName(R.expect_equal(items, changed, "other")).collect()] == ["OK", "FAIL"]


def test_awkward_rows_are_told_apart(spark):
    schema = "k int, a string, b string, `x y` int"
    left = [(-5, "a", None, 1), (None, "n", "n", 1), (7, "d", "d", 2), (7, "d", "d", 2), (100, "", None, 1), (2000, None, None, None)]
    right = [(-5, None, "a", 1), (None, "n", "m", 1), (7, "d", "d", 2), (100, None, "", 1), (2001, None, None, None)]
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    want = [(-5, -5, 1, 1), (100, 100, 1, 1), (2000, 2000, 1, 0), (2001, 2001, 0, 1), (7, 7, 2, 1), (None, None, 1, 1)]
    for fan in (2, 10, 5000):
        assert _found(R.differing_ranges(a, b, "k", fan=fan)) == sorted(want, key=str)
    assert R.differing_ranges(a, b, "k", columns=["k", "x y"], fan=3).count() == 3
    assert R.differing_ranges(a.where("false"), b.where("false"), "k").count() == 0
    assert R.differing_ranges(a.where("false"), b, "k").count() == 5


@pytest.mark.parametrize("quoted", [True, False])
def test_malformed_rows_are_quarantined(spark, tmp_dir, quoted):
    one = 'id,name,price\n1,"a, b",10\n2,short\n3,x,1,long\n4,"open,5\n\n5,,\n6,é,"7"\n'
    two = 'id,name,price\n' + ('7,"say ""hi"", twice",8\n' if quoted else '7,"say \\"hi\\", twice",8\n') + 'alone\n8,"",9\n'
    os.makedirs(f"{tmp_dir}/in")
    for name, body in (("one.csv", one), ("two.csv", two), ("empty.csv", ""), ("header.csv", "id,name,price\n")):
        with open(f"{tmp_dir}/in/{name}", "w") as f:
            f.write(body)
    split = split_csv(spark, f"{tmp_dir}/in", ["id", "name", "price"], quoted=quoted)
    kept = {r.id: (r.name, r.price) for r in split.kept.collect()}
    assert kept == {"1": ("a, b", "10"), "5": (None, None), "6": ("é", "7"), "7": ('say "hi", twice', "8"), "8": (kept["8"][0], "9")}
    bad = {(os.path.basename(r.file), r.line): r.reason for r in split.quarantined.collect()}
    assert bad == {("one.csv", "2,short"): "SHORT", ("one.csv", "3,x,1,long"): "LONG", ("one.csv", '4,"open,5'): "UNBALANCED", ("two.csv", "alone"): "SHORT"}
    got = {r.check: (r.status, r.detail) for r in split.checks.collect()}
    assert got == {"raw:rows_accounted": ("OK", "lines=9 kept=5 quarantined=4"), "raw:malformed_rows": ("WARN", "rows=4")}
    assert X.verdict(split.checks).first().verdict == "WARN"


def test_kept_rows_are_those_of_the_plain_reader(spark, tmp_dir):
    from lakekit.sources.files import read_raw_csv

    part = spark.read.parquet(f"{SF}/part.parquet").select(F.col("p_partkey").cast("string").alias("id"), F.concat(F.col("p_name"), F.lit(' "x", '), F.col("p_brand")).alias("label"))
    part.write.option("header", True).option("quote", '"').option("escape", '"').csv(f"{tmp_dir}/p")
    split = split_csv(spark, f"{tmp_dir}/p")
    assert sorted(map(tuple, split.kept.collect())) == sorted(map(tuple, read_raw_csv(spark, f"{tmp_dir}/p").collect()))
    assert split.quarantined.count() == 0 and {r.status for r in split.checks.collect()} == {"OK"}
