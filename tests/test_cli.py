import os

import pytest

from lakekit.__main__ import main


def _write(path, body):
    with open(path, "w") as f:
        f.write(body)


def test_jobs_query_and_validate_end_to_end(spark, tmp_dir, capsys):
    items, products, sheet = (os.path.join(tmp_dir, n) for n in ("items.csv", "products.csv", "hr.csv"))
    _write(items, 'order_id,order_item_id,product_id,price,freight_value\no1,1,p1,"58.90",1\no1,2,p2,10,1\no2,1,p9,5,1\n')
    _write(products, "product_id,product_category_name\np1,perfumaria\np2,pet_shop\n")
    _write(
        sheet,
        "EmployeeNumber,Department,JobRole,Age,Gender,YearsAtCompany,JobSatisfaction,Attrition,MonthlyIncome\n"
        "1,Sales,Rep,30,Male,2,4,No,4000\n2,Human Resources,HR,40,Female,5,1,Yes,12000\n",
    )
    sales_loc, emp_loc = os.path.join(tmp_dir, "sales"), os.path.join(tmp_dir, "emp")
    assert main(["sales", "--items", items, "--products", products, "--output", sales_loc]) == 0
    sales_path = capsys.readouterr().out.strip().splitlines()[-1]
    assert main(["employees", "--sheet", sheet, "--output", emp_loc, "--load-date", "2024-01-01"]) == 0
    emp_path = capsys.readouterr().out.strip().splitlines()[-1]
    results = os.path.join(tmp_dir, "results")
    assert main(["query", "cross_domain", "--sales", sales_path, "--employees", emp_path, "--results", results, "--run-date", "2024-01-02"]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert out[0] == "categoria,departamento,total_receita,qtd_itens,media_satisfacao,total_funcionarios"
    assert out[1].startswith("perfumaria,Sales,58.9,1,4.0,1")
    assert os.path.isdir(os.path.join(results, "cross_domain", "run_date=2024-01-02"))
    sql = os.path.join(tmp_dir, "cross.sql")
    from lakekit.plans.business import cross_domain_sql

    _write(sql, "-- cross-domain as the analytics principal\n" + cross_domain_sql() + ";\n")
    assert main(["sql", sql, "--sales", sales_path, "--employees", emp_path, "--results", results, "--run-date", "2024-01-02"]) == 0
    assert capsys.readouterr().out.strip().splitlines()[1].startswith("perfumaria,Sales,58.9,1,4.0,1")
    denied = os.path.join(tmp_dir, "denied.sql")
    _write(denied, "SELECT departamento, faixa_salarial FROM funcionarios")
    from lakekit.policy import AccessDenied

    with pytest.raises(AccessDenied):
        main(["sql", denied, "--sales", sales_path, "--employees", emp_path])
    rc = main(["validate", "--sales", sales_path, "--employees", emp_path, "--raw", f"items={items}", "--raw", f"products={products}"])
    text = capsys.readouterr().out
    assert rc == 0 and "verdict: OK" in text and "governance:denied:faixa_salarial,OK" in text


def test_query_refuses_unknown_name():
    with pytest.raises(SystemExit):
        main(["query", "nope", "--sales", "x", "--employees", "y"])


def test_refresh_whole_lake(spark, tmp_dir, capsys):
    items, products, sheet = (os.path.join(tmp_dir, n) for n in ("items.csv", "products.csv", "hr.csv"))
    _write(items, "order_id,order_item_id,product_id,price\no1,1,p1,58.90\no1,2,p2,10\n")
    _write(products, "product_id,product_category_name\np1,perfumaria\np2,\n")
    _write(sheet, "Department,EducationField,Age,MonthlyIncome\nSales,Marketing,30,\nSales,Medical,x,4000\n")
    root = os.path.join(tmp_dir, "lake")
    for db in ("vendas_db", "rh_db"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    rc = main(["refresh", "--lake-root", root, "--items", items, "--products", products, "--sheet", sheet, "--load-date", "2024-01-01"])
    out = capsys.readouterr().out
    assert rc == 0 and "verdict: WARN" in out  # unknown income + unparseable age are warnings
    assert "dominio=vendas/refined/vendas_por_categoria/version=" in out
    assert "raw:unparseable_numbers,WARN,rows=1" in out and "grant:role-analytics:rh_db:funcionarios:SELECT,OK" in out
    got = {r.product_category_name: (r.total_receita, r.qtd_itens) for r in spark.table("vendas_db.vendas_por_categoria").collect()}
    assert got == {"perfumaria": (58.9, 1), None: (10.0, 1)}
    emp = spark.table("rh_db.funcionarios").orderBy("idade").collect()
    assert [(e.cargo, e.idade, e.faixa_salarial) for e in emp] == [("Medical", None, "baixa"), ("Marketing", 30, "alta")]


def test_discover_and_changes(spark, tmp_dir, capsys):
    import pyarrow as pa
    import pyarrow.parquet as pq

    data = os.path.join(tmp_dir, "files")
    os.makedirs(data)
    pq.write_table(pa.table({"product_category_name": ["a"], "total_receita": [1.0], "qtd_itens": pa.array([1], pa.int32())}), f"{data}/f1.parquet")
    pq.write_table(pa.table({"product_category_name": ["b"], "total_receita": [2.0], "qtd_itens": pa.array([2], pa.int64()), "canal": ["web"]}), f"{data}/f2.parquet")
    assert main(["discover", data]) == 0
    out = capsys.readouterr().out
    assert "qtd_itens,bigint,2,WIDEN" in out and "canal,string,1,SAME" in out

    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    _write(os.path.join(raw, "a.csv"), "x\n1\n")
    m1, m2 = os.path.join(tmp_dir, "m1"), os.path.join(tmp_dir, "m2")
    assert main(["changes", raw, "--glob", "*.csv", "--save", m1]) == 0
    _write(os.path.join(raw, "a.csv"), "x\n2\n")
    _write(os.path.join(raw, "b.csv"), "x\n3\n")
    capsys.readouterr()
    assert main(["changes", raw, "--glob", "*.csv", "--previous", m1, "--save", m2]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    status = {line.split(",")[0].rsplit("/", 1)[-1]: line.split(",")[1] for line in lines[1:]}
    assert status == {"a.csv": "CHANGED", "b.csv": "ADDED"}
    with pytest.raises(SystemExit):
        main(["changes", raw, "--previous", m1, "--save", m1])


def test_discover_applies_drift_to_a_registered_table(spark, tmp_dir, capsys):
    import pyarrow as pa
    import pyarrow.parquet as pq

    data = os.path.join(tmp_dir, "t")
    os.makedirs(data)
    pq.write_table(pa.table({"a": pa.array([1], pa.int64())}), f"{data}/f1.parquet")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS probe_drift_db LOCATION '{tmp_dir}/db'")
    spark.sql("DROP TABLE IF EXISTS probe_drift_db.t")
    spark.sql(f"CREATE TABLE probe_drift_db.t (a BIGINT) USING parquet LOCATION '{data}'")
    pq.write_table(pa.table({"a": pa.array([2], pa.int64()), "b": ["x"]}), f"{data}/f2.parquet")
    with pytest.raises(PermissionError):
        main(["discover", data, "--table", "probe_drift_db.t", "--apply", "--principal", "role-analytics"])
    capsys.readouterr()
    assert main(["discover", data, "--table", "probe_drift_db.t", "--apply"]) == 0
    out = capsys.readouterr().out
    assert "probe_drift_db.t,b,,string,ADD" in out and "ALTER TABLE probe_drift_db.t ADD COLUMNS (`b` string)" in out
    assert spark.table("probe_drift_db.t").columns == ["a", "b"]


def test_crawl_partitions_split_and_reconcile(spark, tmp_dir, capsys):
    root = os.path.join(tmp_dir, "lake")
    df = spark.createDataFrame([(i, f"n{i}", f"2024-01-0{1 + i % 2}") for i in range(10)], "k int, name string, day string")
    df.coalesce(1).write.partitionBy("day").parquet(f"{root}/events")
    df.coalesce(1).write.parquet(f"{root}/other/flat")
    assert main(["crawl", root]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert [line.split(",")[0] for line in lines[1:]] == ["events", "flat"] and ",10,2,SAME,k int, name string" in lines[1]

    spark.sql("DROP TABLE IF EXISTS cli_parts")
    spark.sql(f"CREATE TABLE cli_parts (k int, name string, day string) USING parquet PARTITIONED BY (day) LOCATION '{root}/events'")
    assert main(["partitions", "cli_parts", f"{root}/events"]) == 0
    assert capsys.readouterr().out.count(",MISSING,") == 2
    assert main(["partitions", "cli_parts", f"{root}/events", "--repair"]) == 0
    assert capsys.readouterr().out.count(",OK,") == 2 and spark.table("cli_parts").count() == 10
    spark.sql("DROP TABLE cli_parts")

    _write(os.path.join(tmp_dir, "in.csv"), 'a,b\n1,"x"\n2\n3,y,z\n')
    assert main(["split", os.path.join(tmp_dir, "in.csv"), "--kept", f"{tmp_dir}/kept", "--quarantined", f"{tmp_dir}/bad"]) == 0
    assert "raw:rows_accounted,OK,lines=3 kept=1 quarantined=2" in capsys.readouterr().out
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/kept").collect()] == [("1", "x")]

    df.where("k <> 7").write.parquet(f"{tmp_dir}/right")
    assert main(["reconcile", f"{root}/other/flat", f"{tmp_dir}/right", "--key", "k"]) == 1
    assert capsys.readouterr().out.strip().splitlines()[1:] == ["7,7,1,0"]
    assert main(["reconcile", f"{tmp_dir}/right", f"{tmp_dir}/right", "--key", "k"]) == 0


def test_discover_widens_a_versioned_table(spark, tmp_dir, capsys):
    from lakekit import sinks as K

    location = f"{tmp_dir}/t"
    path = K.new_version_path(location)
    spark.createDataFrame([(1, (2,))], "a int, s struct<x:int>").write.parquet(path)
    K.publish_version(spark, location, path)
    spark.sql("DROP TABLE IF EXISTS cli_evolved")
    spark.sql(f"CREATE TABLE cli_evolved (a int, s struct<x:int>) USING parquet LOCATION '{path}'")
    spark.createDataFrame([(1 << 40, (1.5, "new"))], "a bigint, s struct<x:double,y:string>").write.parquet(f"{tmp_dir}/new")
    assert main(["discover", f"{tmp_dir}/new", "--table", "default.cli_evolved", "--apply", "--location", location]) == 0
    assert "a BIGINT" in capsys.readouterr().out
    assert [tuple(r) for r in spark.table("cli_evolved").select("a", "s.x", "s.y").collect()] == [(1, 2.0, None)]
    spark.sql("DROP TABLE cli_evolved")


def test_lineage_of_a_statement(spark, tmp_dir, capsys):
    from lakekit.contracts import EMPLOYEE_CONTRACT, SALES_CONTRACT

    spark.createDataFrame([("a", 1.0, 1)], SALES_CONTRACT.schema).write.parquet(f"{tmp_dir}/sales")
    spark.createDataFrame([], EMPLOYEE_CONTRACT.schema).write.parquet(f"{tmp_dir}/emp")
    _write(os.path.join(tmp_dir, "q.sql"), "SELECT departamento, max(idade) AS mais FROM funcionarios GROUP BY departamento;")
    assert main(["lineage", f"{tmp_dir}/q.sql", "--sales", f"{tmp_dir}/sales", "--employees", f"{tmp_dir}/emp"]) == 0
    assert capsys.readouterr().out.strip().splitlines()[1:] == ["0,departamento,rh_db.funcionarios,departamento", "1,mais,rh_db.funcionarios,idade"]
