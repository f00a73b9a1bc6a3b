"""Governed SQL is judged on the analysed plan."""

import pytest

from lakekit import lineage as L
from lakekit import policy as G
from lakekit.contracts import ANALYTICS, EMPLOYEE_CONTRACT, HR, SALES_CONTRACT
from lakekit.plans import business as B

COLUMNS = {EMPLOYEE_CONTRACT.qualified_name: EMPLOYEE_CONTRACT.columns, SALES_CONTRACT.qualified_name: SALES_CONTRACT.columns}
HIDDEN = "faixa_salarial"


@pytest.fixture(scope="module")
def lake(spark):
    """The registered tables with one more, and an analytics session with views of the granted ones."""
    row = ("1", "Sales", "x", 30, "F", 2, 3, "No", "alta", 1, 0, 3.0, 2.0, None)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {HR.database}")
    for table in (EMPLOYEE_CONTRACT.table, "other"):
        spark.sql(f"DROP TABLE IF EXISTS {HR.database}.{table}")
    spark.createDataFrame([row], EMPLOYEE_CONTRACT.schema).write.saveAsTable(EMPLOYEE_CONTRACT.qualified_name)
    spark.range(2).withColumnRenamed("id", "x").write.saveAsTable(f"{HR.database}.other")
    spark.range(2).createOrReplaceGlobalTempView("shared")
    policy = G.Policy(G.reference_grants("/lake"))
    tables = {
        EMPLOYEE_CONTRACT.qualified_name: lambda s: s.table(EMPLOYEE_CONTRACT.qualified_name),
        SALES_CONTRACT.qualified_name: lambda s: s.createDataFrame([("perfumaria", 10.0, 1)], SALES_CONTRACT.schema),
    }
    session = G.as_principal(spark, policy, ANALYTICS, tables)
    yield lambda sql, p=policy: G.run_as(session, p, ANALYTICS, sql, COLUMNS)
    spark.catalog.dropGlobalTempView("shared")
    for table in (EMPLOYEE_CONTRACT.table, "other"):
        spark.sql(f"DROP TABLE {HR.database}.{table}")


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT faixa_salarial FROM IDENTIFIER('rh_db.funcionarios')",
        "SELECT faixa_salarial FROM IDENTIFIER('rh_db' || '.funcionarios')",
        "EXECUTE IMMEDIATE 'SELECT faixa_salarial FROM rh_db.funcionarios'",
        "USE rh_db",
        "SELECT count(*) FROM IDENTIFIER('rh_db.other')",
        "SELECT * FROM rh_db.other",
        "WITH f AS (SELECT 1) SELECT (SELECT max(x) FROM IDENTIFIER('rh_db.other')) FROM f",
        "SELECT * FROM funcionarios WHERE EXISTS (SELECT 1 FROM IDENTIFIER('rh_db.other'))",
        "SELECT * FROM VALUES (1) AS t(a), LATERAL (SELECT x FROM IDENTIFIER('rh_db.other') WHERE x = a)",
        "SELECT * FROM global_temp.shared",
        "SELECT * FROM parquet.`/tmp/x`",
        "SELECT faixa_salarial FROM funcionarios",
        "SELECT f.FAIXA_SALARIAL FROM funcionarios AS f",
        "SELECT count(*) FROM funcionarios WHERE faixa_salarial = 'alta'",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT try_reflect('java.lang.System', 'getProperty', 'user.home') FROM funcionarios",
        "SET spark.sql.ansi.enabled = false",
        "RESET",
        "CREATE TEMPORARY VIEW v AS SELECT * FROM funcionarios",
        "DROP TABLE rh_db.other",
        "INSERT INTO rh_db.other VALUES (3)",
        "WITH w AS (SELECT 1) INSERT INTO rh_db.other SELECT * FROM w",
        "EXPLAIN SELECT * FROM funcionarios",
        "DESCRIBE rh_db.funcionarios",
        "SHOW TABLES IN rh_db",
        "CACHE TABLE funcionarios",
        "BEGIN SELECT 1; END",
    ],
)
def test_denied(lake, sql):
    with pytest.raises(G.AccessDenied):
        lake(sql)


def test_nothing_ran(spark, lake):
    for sql in ("INSERT INTO rh_db.other VALUES (3)", "EXECUTE IMMEDIATE 'DROP TABLE rh_db.other'", "USE rh_db"):
        with pytest.raises(G.AccessDenied):
            lake(sql)
    assert spark.table(f"{HR.database}.other").count() == 2
    assert lake("SELECT current_database() AS d").first().d == spark.catalog.currentDatabase()


def test_queries_run(lake):
    assert HIDDEN not in lake("SELECT * FROM rh_db.funcionarios").columns
    assert lake("SELECT count(*) AS n FROM `rh_db`.funcionarios AS f JOIN range(3) ON true").first().n == 3
    assert lake("WITH f AS (TABLE funcionarios) SELECT departamento FROM f UNION SELECT 'x' FROM f").count() == 2
    assert lake("FROM funcionarios |> AGGREGATE max(idade) AS m").first().m == 30
    assert lake(B.cross_domain_sql()).first()["total_funcionarios"] == 1


def test_an_older_session_meets_the_policy_of_now(lake):
    narrowed = G.Policy([G.Grant(ANALYTICS, "SELECT", HR.database, EMPLOYEE_CONTRACT.table, ("departamento",))])
    assert lake("SELECT departamento FROM funcionarios", narrowed).count() == 1
    with pytest.raises(G.AccessDenied) as denied:
        lake("SELECT departamento FROM funcionarios ORDER BY idade", narrowed)
    assert denied.value.columns == ("idade",)
    with pytest.raises(G.AccessDenied):
        lake("SELECT * FROM vendas_por_categoria", narrowed)


def test_column_lineage(spark):
    s = spark.newSession()
    s.createDataFrame([(1, 2, "x")], "a int, b int, c string").createOrReplaceTempView("t")
    s.createDataFrame([(1, 5)], "a int, d int").createOrReplaceTempView("u")
    sql = """
    WITH w AS (SELECT a, a + b AS ab, c FROM t), both AS (SELECT a, ab AS v FROM w UNION ALL SELECT a, d FROM u)
    SELECT x.a, sum(v) OVER (PARTITION BY x.a ORDER BY c) AS running, (SELECT max(d) FROM u WHERE u.a = x.a) AS most, e, 1 AS one
    FROM both x JOIN t ON t.a = x.a LATERAL VIEW explode(array(b)) y AS e WHERE c <> ''"""
    got = {}
    for r in L.column_lineage(s, sql, {"t": "db.t", "u": "db.u"}).collect():
        got.setdefault(r.output, set()).add(f"{r.table[3:]}.{r.column}")
    assert got["a"] == {"t.a", "u.a"}
    assert got["running"] == {"t.a", "t.b", "u.d", "u.a", "t.c"}
    assert got["most"] == {"u.d", "t.a", "u.a"}  # with what ties the subquery to its row
    assert got["e"] == {"t.b"} and "one" not in got
    reads = L.query_reads(L.analysed_query(s, L.parsed_query(s, "SELECT count(*) FROM t WHERE b IN (SELECT d FROM u)")), {"t": "t", "u": "u"})
    assert reads.columns == {"t": {"b"}, "u": {"d"}} and reads.others == []
