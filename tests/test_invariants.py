"""Invariants on whole proxy tables (sf0.01)."""

from pyspark.sql import functions as F

from lakekit import expect as X
from lakekit import proxies as P
from lakekit.functions import money_sum
from lakekit.plans import business as B
from lakekit.plans.jobs import NUMERIC_SHEET_COLUMNS, parse_rejects

SF = "/root/testdata/sf0.01"


def test_category_revenue_equals_joined_item_revenue(spark):
    sales = P.sales(spark, SF)
    joined = P.order_items(spark, SF).join(P.products(spark, SF), "product_id")
    a = sales.agg(money_sum("total_receita").alias("r"), F.sum("qtd_itens").alias("n")).first()
    b = joined.agg(money_sum("price").alias("r"), F.count("order_item_id").alias("n")).first()
    assert (a.r, a.n) == (b.r, b.n)


def test_employees_in_equals_out_and_bands_partition(spark):
    sheet, emp = P.employee_sheet(spark, SF), P.employees(spark, SF)
    assert sheet.count() == emp.count() == 1500
    bands = {r.faixa_salarial: r.n for r in emp.groupBy("faixa_salarial").agg(F.count("*").alias("n")).collect()}
    assert set(bands) == {"alta", "baixa", "media"} and sum(bands.values()) == 1500
    assert bands == {"alta": 481, "baixa": 584, "media": 435}


def test_top_share_in_bounds_and_rerun_is_stable(spark):
    a = B.top_share(P.sales(spark, SF)).first()
    b = B.top_share(P.sales(spark, SF)).first()
    assert a == b and 0 <= a.pct_receita_top10 <= 100
    assert (round(a.receita_top10, 2), round(a.receita_empresa, 2), a.pct_receita_top10) == (1359249023.81, 3033593946.46, 44.8)


def test_cross_domain_flags_unmatched_rows(spark):
    sales, mapping = P.sales(spark, SF), P.proxy_map(spark)
    assert [tuple(r) for r in B.unmatched_map_rows(sales, mapping).collect()] == [("HOUSEHOLD", "NoSuchBrand")]
    unmapped = B.unmapped_categories(sales, mapping)
    assert unmapped.count() == 25 - 6 - 1 + 0 and unmapped.filter(F.col("categoria").isNull()).count() == 1


def test_rejects_report_unparseable_text(spark):
    raw = spark.createDataFrame(
        [("1", "41 anos", "3", None), ("2", "30", "x", "12.5"), ("3", "", "1", "7")],
        "EmployeeNumber string, Age string, YearsAtCompany string, MonthlyIncome string",
    )
    got = sorted(tuple(r) for r in parse_rejects(raw, NUMERIC_SHEET_COLUMNS, keep=("EmployeeNumber",)).collect())
    assert got == [("1", "Age", "41 anos"), ("2", "YearsAtCompany", "x"), ("3", "Age", "")]
    empty = parse_rejects(raw.select("EmployeeNumber"), NUMERIC_SHEET_COLUMNS, keep=("EmployeeNumber",))
    assert empty.count() == 0 and empty.columns == ["EmployeeNumber", "column", "value"]


def test_expect_tables(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS probe_db LOCATION '{tmp_dir}/probe_db'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS probe_db.t (a INT) USING parquet LOCATION '{tmp_dir}/probe_db/t'")
    got = {r.check: r.status for r in X.expect_tables(spark, ["probe_db.t", "probe_db.missing"]).collect()}
    assert got == {"table:probe_db.t": "OK", "table:probe_db.missing": "FAIL"}


def test_validate_lake_on_proxies(spark):
    from lakekit import policy as G
    from lakekit.validate import validate_lake

    policy = G.Policy(G.reference_grants("lake"))
    checks = validate_lake(
        spark,
        {"lineitem": P.table(spark, SF, "lineitem"), "part": P.table(spark, SF, "part")},
        P.sales(spark, SF),
        P.employees(spark, SF),
        policy,
        expected_grants=G.reference_grants("lake"),
        raw_sheet=P.dirty_employee_sheet(spark, SF),
        mapping=P.PROXY_BUSINESS_MAP,
    )
    got = {r.check: (r.status, r.detail) for r in checks.collect()}
    assert got["map:unmatched_rows"] == ("WARN", "rows=1")
    assert got["raw:unknown_income"][0] == "WARN" and got["raw:unparseable_numbers"] == ("WARN", "rows=215")
    assert got["governance:denied:faixa_salarial"][0] == "OK"
    assert all(v[0] == "OK" for k, v in got.items() if k.startswith("grant:"))
    assert X.verdict(checks).first().verdict == "WARN"


def test_validate_against_expected_totals(spark):
    from lakekit import policy as G
    from lakekit.validate import expected_totals, validate_lake

    sales = spark.createDataFrame([(f"c{i}", 100.0, 2) for i in range(74)], "product_category_name string, total_receita double, qtd_itens bigint")
    checks = validate_lake(
        spark, {}, sales, P.employees(spark, SF), G.Policy(G.reference_grants("lake")), expected_metrics=expected_totals(spark)
    )
    got = {r.check: r.status for r in checks.collect() if r.check.startswith("metric:")}
    assert got == {
        "metric:categorias": "OK",
        "metric:receita_total": "FAIL",
        "metric:funcionarios": "FAIL",
        "metric:departamentos": "FAIL",
    }
