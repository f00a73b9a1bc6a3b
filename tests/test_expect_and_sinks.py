import os

from pyspark.sql import functions as F

from lakekit import expect as X
from lakekit import sinks as K
from lakekit.contracts import SALES_CONTRACT
from lakekit.sources.manifest import changed_files, raw_file_manifest


def test_checks_and_verdict(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "id int, v string")
    checks = X.union_checks(
        [
            X.expect_rows(df, "rows", 1),
            X.expect_rows(df, "many", 10, severity="WARN"),
            X.expect_unique(df, "id"),
            X.expect_no_nulls(df, "v", severity="FAIL"),
            X.expect_metric(df, "sum", F.sum("id"), 5, 0.0),
        ]
    )
    got = {r.check: r.status for r in checks.collect()}
    assert got == {"rows": "OK", "many": "WARN", "unique:id": "WARN", "nulls:v": "FAIL", "sum": "OK"}
    v = X.verdict(checks).first()
    assert (v.ok, v.fail, v.warn, v.verdict) == (2, 1, 2, "FAIL")
    assert {r.status: r.checks for r in X.summarise(checks).collect()} == {"OK": 2, "WARN": 2, "FAIL": 1}


def test_expect_schema(spark):
    ok = spark.createDataFrame([("a", 1.0, 1)], SALES_CONTRACT.schema)
    assert X.expect_schema(ok, SALES_CONTRACT).first().status == "OK"
    bad = ok.withColumn("qtd_itens", F.col("qtd_itens").cast("string"))
    r = X.expect_schema(bad, SALES_CONTRACT).first()
    assert r.status == "FAIL" and "qtd_itens" in r.detail


def test_manifest_change_detection(spark, tmp_dir):
    old_dir, new_dir = os.path.join(tmp_dir, "old"), os.path.join(tmp_dir, "new")
    os.makedirs(old_dir)
    os.makedirs(new_dir)
    for d, files in ((old_dir, {"a.csv": "1", "b.csv": "2", "c.csv": "3"}), (new_dir, {"a.csv": "1", "b.csv": "22", "d.csv": "4"})):
        for name, body in files.items():
            with open(os.path.join(d, name), "w") as f:
                f.write(body)
    rel = lambda m, d: m.withColumn("path", F.regexp_replace("path", "^.*/", ""))
    new = rel(raw_file_manifest(spark, new_dir, glob="*.csv"), new_dir)
    old = rel(raw_file_manifest(spark, old_dir, glob="*.csv"), old_dir)
    got = {r.path: r.status for r in changed_files(new, old).collect()}
    assert got == {"a.csv": "UNCHANGED", "b.csv": "CHANGED", "c.csv": "REMOVED", "d.csv": "ADDED"}
    cheap = raw_file_manifest(spark, new_dir, glob="*.csv", with_md5=False)
    assert "md5" not in cheap.columns and "content" not in cheap._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_result_sink_retention_and_preview(spark, tmp_dir):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "k int, name string")
    for day in ("2024-01-01", "2024-02-10"):
        K.save_result(df.filter(F.col("k") < (5 if day == "2024-01-01" else 20)), tmp_dir, "q1", day)
    all_days = K.read_results(spark, tmp_dir, "q1", schema="k int, name string")
    kept = K.retain(all_days, "run_date", "2024-02-14", 30)
    assert kept.count() == 20
    assert K.read_results(spark, tmp_dir, "q1", schema="k int, name string", run_date="2024-01-01").count() == 5
    assert [r.k for r in K.preview(df.orderBy(F.desc("k")), 3).collect()] == [19, 18, 17]


def test_expect_files(spark, tmp_dir):
    full = os.path.join(tmp_dir, "full")
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(full)
    os.makedirs(empty)
    with open(os.path.join(full, "a.csv"), "w") as f:
        f.write("x\n1\n")
    with open(os.path.join(empty, "b.csv"), "w") as f:
        f.write("")
    got = {r.check: (r.status, r.detail) for r in X.expect_files(spark, {"full": full, "empty": empty, "gone": os.path.join(tmp_dir, "nope")}).collect()}
    assert got["files:full"] == ("OK", "files=1 bytes=4")
    assert got["files:empty"][0] == "FAIL" and got["files:gone"] == ("FAIL", "missing")


def test_conform_to_contract(spark):
    import pytest

    from lakekit.contracts import conform

    df = spark.createDataFrame([("1.5", "a", "2", "x")], "total_receita string, product_category_name string, qtd_itens string, extra string")
    out = conform(df, SALES_CONTRACT)
    assert out.dtypes == [("product_category_name", "string"), ("total_receita", "double"), ("qtd_itens", "bigint")]
    with pytest.raises(ValueError):
        conform(df.drop("qtd_itens"), SALES_CONTRACT)
    assert conform(df.drop("qtd_itens"), SALES_CONTRACT, fill_missing=True).first().qtd_itens is None
