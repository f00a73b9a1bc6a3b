import os

from pyspark.sql import functions as F

from lakekit.plans.jobs import conform_employees, sales_by_category
from lakekit.sources.files import read_raw_csv

ITEMS = "product_id string, order_item_id string, price string"
PRODUCTS = "product_id string, product_category_name string"


def _sales(spark, items, products, **kw):
    out = sales_by_category(spark.createDataFrame(items, ITEMS), spark.createDataFrame(products, PRODUCTS), **kw)
    return {r[0]: (r[1], r[2]) for r in out.collect()}


def test_worked_example(spark):
    assert _sales(spark, [("p1", "1", "58.90")], [("p1", "perfumaria")]) == {"perfumaria": (58.9, 1)}


def test_null_category_is_one_group_and_orphans_drop(spark):
    items = [("p1", "1", "10.00"), ("p1", "2", "5.50"), ("p2", "1", "1.25"), ("p3", "1", "99.99"), ("p4", None, "2")]
    products = [("p1", None), ("p2", None), ("p4", "x")]
    for kw in ({}, {"merge": True}):
        got = _sales(spark, items, products, **kw)
        assert got == {None: (16.75, 3), "x": (2.0, 0)}, kw


def test_malformed_price_is_null_not_error(spark):
    got = _sales(spark, [("p1", "1", "abc"), ("p1", "2", "3.5")], [("p1", "c")])
    assert got == {"c": (3.5, 2)}


def test_duplicate_products_multiply_items_in_both_strategies(spark):
    items = [("p1", "1", "1.00"), ("p1", "2", "2.00")]
    products = [("p1", "a"), ("p1", "a"), ("p1", "b")]
    a = _sales(spark, items, products)
    b = _sales(spark, items, products, merge=True)
    assert a == b == {"a": (6.0, 4), "b": (3.0, 2)}


def test_hot_product_preaggregated_before_shuffle(spark):
    # one product carries a third of the rows; both plans give the same sums
    n = 30000
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 1000).cast("string")).alias("product_id"),
        F.col("id").cast("string").alias("order_item_id"),
        F.lit("1.10").alias("price"),
    )
    products = spark.range(1000).select(F.col("id").cast("string").alias("product_id"), F.lit("c").alias("product_category_name"))
    products = products.unionByName(products.sparkSession.createDataFrame([("hot", "h")], PRODUCTS))
    pre = sales_by_category(items, products, merge=True)
    plan = pre._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan
    got = {r[0]: (round(r[1], 2), r[2]) for r in pre.collect()}
    assert got == {"h": (11000.0, 10000), "c": (22000.0, 20000)}


def test_conform_full_sheet_types_and_order(spark):
    raw = spark.createDataFrame(
        [("7", "Sales", "Manager", "41", "Female", "3", "4", "Yes", "12000", "x")],
        "EmployeeNumber string, Department string, JobRole string, Age string, Gender string, "
        "YearsAtCompany string, JobSatisfaction string, Attrition string, MonthlyIncome string, WorkLifeBalance string",
    )
    out = conform_employees(raw, load_date_value="2024-05-01")
    assert out.columns[0] == "employee_id" and "WorkLifeBalance" not in out.columns
    r = out.first()
    assert (r.employee_id, r.departamento, r.cargo, r.idade, r.genero) == ("7", "Sales", "Manager", 41, "Female")
    assert (r.anos_empresa, r.satisfacao, r.rotatividade, r.faixa_salarial) == (3, 4, "Yes", "alta")
    assert (r.total_funcionarios, r.total_saidas, r.media_satisfacao, r.media_anos_empresa) == (1, 1, 4.0, 3.0)
    assert dict(out.dtypes)["data_carga"] == "date"


def test_conform_reduced_sheet_falls_back(spark):
    raw = spark.createDataFrame(
        [("R&D", "Life Sciences", "4000")], "Department string, EducationField string, MonthlyIncome string"
    )
    r = conform_employees(raw).first()
    assert (r.cargo, r.genero, r.rotatividade, r.faixa_salarial, r.idade) == ("Life Sciences", "N/D", "No", "baixa", None)


def test_quoted_csv_round_trip(spark, tmp_dir):
    path = os.path.join(tmp_dir, "items.csv")
    with open(path, "w") as f:
        f.write('product_id,name,note\n1,"a ""q"" b",\n2,"",x\n')
    quoted = read_raw_csv(spark, path, quoted=True).orderBy("product_id").collect()
    assert quoted[0]["name"] == 'a "q" b' and quoted[0]["note"] is None
    assert quoted[1]["name"] is None
    plain = read_raw_csv(spark, path, quoted=False).orderBy("product_id").collect()
    assert plain[0]["name"] != 'a "q" b'  # doubled quotes are not unescaped without escape='"'
    assert all(t == "string" for _, t in read_raw_csv(spark, path).dtypes)


def test_conformance_report(spark):
    from lakekit.plans.jobs import conformance_report

    raw = spark.createDataFrame([("S", "Life", "30", "x")], "Department string, EducationField string, Age string, WorkLifeBalance string")
    got = {r.column: (r.source, r.status) for r in conformance_report(raw).collect()}
    assert got["cargo"] == ("EducationField", "USED") and got["genero"] == ("N/D", "DEFAULT")
    assert got["employee_id"][1] == "DEFAULT" and got["idade"] == ("Age", "USED") and got["satisfacao"] == ("NULL", "DEFAULT")
    assert got["WorkLifeBalance"] == ("WorkLifeBalance", "IGNORED") and "Age" not in got


def test_multiline_quoted_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m.csv")
    with open(path, "w") as f:
        f.write('id,note\n1,"two\nlines"\n2,x\n')
    rows = read_raw_csv(spark, path, multiline=True).orderBy("id").collect()
    assert [(r.id, r.note) for r in rows] == [("1", "two\nlines"), ("2", "x")]
