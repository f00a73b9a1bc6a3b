import pytest

from lakekit import policy as G
from lakekit.contracts import ANALYTICS, EMPLOYEE_CONTRACT, HR, SALES, SALES_CONTRACT
from lakekit.plans import business as B

ROOT = "/lake"


def _emp(spark):
    row = ("1", "Sales", "x", 30, "F", 2, 3, "No", "alta", 1, 0, 3.0, 2.0, None)
    return spark.createDataFrame([row], EMPLOYEE_CONTRACT.schema)


def _policy(mode=G.PolicyMode.STRICT):
    return G.Policy(G.reference_grants(ROOT), mode)


def test_column_allow_list_excludes_sensitive(spark):
    got = G.governed(_emp(spark), _policy(), ANALYTICS, EMPLOYEE_CONTRACT.qualified_name)
    assert "faixa_salarial" not in got.columns and len(got.columns) == 13


def test_denied_column_raises(spark):
    with pytest.raises(G.AccessDenied) as exc:
        G.governed(_emp(spark), _policy(), ANALYTICS, EMPLOYEE_CONTRACT.qualified_name, ["departamento", "faixa_salarial"])
    assert exc.value.columns == ("faixa_salarial",)


def test_no_grant_raises(spark):
    with pytest.raises(G.AccessDenied):
        G.governed(_emp(spark), _policy(), "someone-else", EMPLOYEE_CONTRACT.qualified_name)


def test_open_mode_ignores_column_grants(spark):
    got = G.governed(_emp(spark), _policy(G.PolicyMode.OPEN), ANALYTICS, EMPLOYEE_CONTRACT.qualified_name)
    assert "faixa_salarial" in got.columns


def test_producer_reads_whole_own_domain(spark):
    got = G.governed(_emp(spark), _policy(), HR.producer, EMPLOYEE_CONTRACT.qualified_name)
    assert len(got.columns) == 14


def test_governed_projection_reaches_parquet_scan(spark, tmp_dir):
    _emp(spark).write.parquet(tmp_dir + "/emp")
    df = spark.read.parquet(tmp_dir + "/emp")
    got = G.governed(df, _policy(), ANALYTICS, EMPLOYEE_CONTRACT.qualified_name, ["departamento"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<departamento:string>" in plan


def test_write_guard_by_domain_prefix():
    p = _policy()
    p.write_guard(SALES.producer)(SALES.prefix(ROOT) + "/refined/vendas_por_categoria/v1")
    with pytest.raises(G.AccessDenied):
        p.write_guard(SALES.producer)(HR.prefix(ROOT) + "/refined/funcionarios/v1")
    assert p.allows(HR.producer, "ALTER", HR.database) and not p.allows(ANALYTICS, "ALTER", HR.database)


def test_principal_session_and_denied_sql(spark):
    s = spark.createDataFrame([("perfumaria", 10.0, 1)], SALES_CONTRACT.schema)
    tables = {
        SALES_CONTRACT.qualified_name: lambda sess: sess.createDataFrame(s.collect(), SALES_CONTRACT.schema),
        EMPLOYEE_CONTRACT.qualified_name: lambda sess: sess.createDataFrame(_emp(spark).collect(), EMPLOYEE_CONTRACT.schema),
    }
    session = G.as_principal(spark, _policy(), ANALYTICS, tables)
    assert "faixa_salarial" not in session.table("funcionarios").columns
    assert session is not spark
    cols = {EMPLOYEE_CONTRACT.qualified_name: EMPLOYEE_CONTRACT.columns}
    out = G.run_as(session, _policy(), ANALYTICS, B.cross_domain_sql(), cols).collect()
    assert out[0]["categoria"] == "perfumaria" and out[0]["total_funcionarios"] == 1
    with pytest.raises(G.AccessDenied):
        G.run_as(session, _policy(), ANALYTICS, "SELECT faixa_salarial FROM funcionarios", cols)
    # qualified names mean the governed view, also where the table is registered
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {HR.database}")
    spark.sql(f"DROP TABLE IF EXISTS {EMPLOYEE_CONTRACT.qualified_name}")
    _emp(spark).write.saveAsTable(EMPLOYEE_CONTRACT.qualified_name)
    try:
        with pytest.raises(G.AccessDenied):
            G.run_as(session, _policy(), ANALYTICS, f"SELECT faixa_salarial FROM {EMPLOYEE_CONTRACT.qualified_name} LIMIT 1", cols)
        for name in (EMPLOYEE_CONTRACT.qualified_name, f"spark_catalog.`{HR.database}`.{EMPLOYEE_CONTRACT.table}"):
            assert G.run_as(session, _policy(), ANALYTICS, f"SELECT count(*) AS n, 'a.b;' AS t FROM {name} -- x.y", cols).first().n == 1
        for denied in (f"{HR.database}.other", "parquet.`/tmp/x`"):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {HR.database}.other (x int) USING parquet")
            with pytest.raises(G.AccessDenied):
                G.run_as(session, _policy(), ANALYTICS, f"SELECT * FROM {denied}", cols)
    finally:
        spark.sql(f"DROP DATABASE {HR.database} CASCADE")
    assert G.split_statements("SELECT ';' -- ;\n; SELECT 2 /* ; */;\n-- end\n") == ["SELECT ';' -- ;", "SELECT 2 /* ; */"]


def test_write_guard_respects_path_boundaries():
    policy = _policy()
    location = next(g.location for g in policy.grants if g.principal == SALES.producer and g.location)
    root = location.rstrip("/")
    assert policy.may_write(SALES.producer, root) and policy.may_write(SALES.producer, root + "/x/version=1")
    assert not policy.may_write(SALES.producer, root + "_x/version=1")
    assert not policy.may_write(SALES.producer, root + "/../dominio=rh/x")


def test_denied_columns_frame(spark):
    grants = G.grants_frame(spark, G.reference_grants(ROOT))
    catalog = spark.createDataFrame(
        [(HR.database, EMPLOYEE_CONTRACT.table, c) for c in EMPLOYEE_CONTRACT.columns]
        + [(SALES.database, SALES_CONTRACT.table, c) for c in SALES_CONTRACT.columns],
        "database string, table string, column string",
    )
    got = [tuple(r) for r in G.denied_columns(grants, catalog, ANALYTICS).collect()]
    assert got == [(HR.database, EMPLOYEE_CONTRACT.table, "faixa_salarial")]


def test_audit_grants(spark):
    grants = G.reference_grants(ROOT)
    expected = G.grants_frame(spark, [g for g in grants if g.principal == ANALYTICS] + [G.Grant(SALES.producer, "ALL", database=SALES.database)])
    actual_list = [g for g in grants if g.principal == ANALYTICS]
    # column grant turned into a wildcard
    actual_list = [
        G.Grant(g.principal, g.permission, g.database, g.table, None, g.location) if g.columns else g for g in actual_list
    ]
    sensitive = spark.createDataFrame([(HR.database, EMPLOYEE_CONTRACT.table, "faixa_salarial")], "database string, table string, column string")
    out = {(r.principal, r.table): (r.status, r.detail) for r in G.audit_grants(G.grants_frame(spark, actual_list), expected, sensitive).collect()}
    assert out[(SALES.producer, None)] == ("FAIL", "grant missing")
    assert out[(ANALYTICS, EMPLOYEE_CONTRACT.table)] == ("FAIL", "column wildcard")
    assert out[(ANALYTICS, SALES_CONTRACT.table)] == ("PASS", "ok")
    leaky = [G.Grant(ANALYTICS, "SELECT", HR.database, EMPLOYEE_CONTRACT.table, tuple(EMPLOYEE_CONTRACT.columns))]
    extra = [*actual_list, G.Grant(ANALYTICS, "SELECT", database=HR.database)]
    found = G.audit_grants(G.grants_frame(spark, extra), expected, sensitive).collect()
    assert ("FAIL", "grant not expected") in {(r.status, r.detail) for r in found if r.database == HR.database and r.table is None}
    out2 = G.audit_grants(G.grants_frame(spark, leaky), G.grants_frame(spark, leaky), sensitive).first()
    assert out2.status == "FAIL" and out2.detail == "sensitive: faixa_salarial"


def test_governed_catalog_table(spark, tmp_dir):
    from lakekit import catalog as C
    from lakekit import sinks as K

    C.register_domain(spark, HR, tmp_dir)
    path = K.write_refined(_emp(spark), EMPLOYEE_CONTRACT, EMPLOYEE_CONTRACT.location(tmp_dir))
    C.register_table(spark, EMPLOYEE_CONTRACT, path, replace=True)
    got = G.governed_table(spark, _policy(), ANALYTICS, EMPLOYEE_CONTRACT.qualified_name)
    assert got.count() == 1 and "faixa_salarial" not in got.columns
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "faixa_salarial" not in plan.split("ReadSchema:")[1].split("\n")[0]
    with pytest.raises(G.AccessDenied):
        G.governed_table(spark, _policy(), ANALYTICS, EMPLOYEE_CONTRACT.qualified_name, ["faixa_salarial"])
