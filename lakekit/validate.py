"""Lake validation suite: one checks DataFrame for a whole lake.

Covers what a lake operator verifies after a run: raw inputs present,
refined outputs present and on contract, headline metrics, governed reads
allowed and denied as granted, grants as expected, and duplicate surrogate
ids.  Data checks are Spark aggregates; policy checks are plan-time
decisions turned into rows.  ``verdict`` gives the overall status.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit import expect as X
from lakekit import policy as G
from lakekit.contracts import ANALYTICS, EMPLOYEE_CONTRACT, SALES_CONTRACT
from lakekit.plans import business as B
from lakekit.plans.jobs import NUMERIC_SHEET_COLUMNS, reject_count


# --- Fixed values: the reference's documented totals on its full data
# --- (categories, revenue with a cent-level tolerance of the "~" figure,
# --- employees, departments).
REFERENCE_TOTALS = (
    ("categorias", 74.0, 0.0),
    ("receita_total", 13591643.70, 0.5),
    ("funcionarios", 1470.0, 0.0),
    ("departamentos", 3.0, 0.0),
)


def expected_totals(spark: SparkSession, rows=REFERENCE_TOTALS) -> DataFrame:
    """Expected metrics (metric, value, tolerance) for ``validate_lake``."""
    return spark.createDataFrame(list(rows), "metric string, value double, tolerance double")


def _decision_rows(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, X.CHECKS_SCHEMA)


def governance_checks(spark: SparkSession, employees: DataFrame, policy: G.Policy, principal: str = ANALYTICS) -> DataFrame:
    """Allowed columns resolve; a sensitive column and an ungranted principal are denied."""
    name = EMPLOYEE_CONTRACT.qualified_name
    rows = []
    try:
        G.governed(employees, policy, principal, name, ["departamento", "cargo", "satisfacao"])
        rows.append(("governance:allowed_columns", "OK", "departamento,cargo,satisfacao"))
    except G.AccessDenied as exc:
        rows.append(("governance:allowed_columns", "FAIL", str(exc)))
    for col in EMPLOYEE_CONTRACT.sensitive:
        try:
            G.governed(employees, policy, principal, name, [col])
            rows.append((f"governance:denied:{col}", "FAIL", "sensitive column readable"))
        except G.AccessDenied:
            rows.append((f"governance:denied:{col}", "OK", "AccessDenied"))
    try:
        G.governed(employees, policy, "principal-without-grants", name)
        rows.append(("governance:no_grant", "FAIL", "read without grant"))
    except G.AccessDenied:
        rows.append(("governance:no_grant", "OK", "AccessDenied"))
    return _decision_rows(spark, rows)


def grant_checks(spark: SparkSession, policy: G.Policy, expected: list[G.Grant]) -> DataFrame:
    sensitive = spark.createDataFrame(
        [(c.domain.database, c.table, col) for c in (SALES_CONTRACT, EMPLOYEE_CONTRACT) for col in c.sensitive],
        "database string, table string, column string",
    )
    audit = G.audit_grants(G.grants_frame(spark, policy.grants), G.grants_frame(spark, expected), sensitive)
    return audit.select(
        F.concat_ws(":", F.lit("grant"), "principal", F.coalesce("database", F.lit("*")), F.coalesce("table", F.lit("*")), "permission").alias("check"),
        F.when(F.col("status") == "PASS", "OK").otherwise("FAIL").alias("status"),
        F.col("detail"),
    )


def validate_lake(
    spark: SparkSession,
    raw_inputs: Mapping[str, DataFrame],
    sales: DataFrame,
    employees: DataFrame,
    policy: G.Policy,
    expected_grants: list[G.Grant] | None = None,
    expected_metrics: DataFrame | None = None,
    raw_sheet: DataFrame | None = None,
    mapping=None,
    raw_paths: Mapping[str, str] | None = None,
    tables: Sequence[str] = (),
) -> DataFrame:
    """All checks as one DataFrame; ``raw_sheet`` adds HR input checks
    (unknown incomes silently land in the top band; unparseable numbers);
    ``mapping`` (business map, rows or DataFrame) adds a WARN for map rows
    that match no sales category, which the inner join would hide;
    ``raw_paths`` checks that each raw location holds files, ``tables`` that
    these tables are registered.

    Each refined table is scanned once for all its figures, and the employees
    once more for duplicate ids.  Expected metrics are a handful of rows that
    the driver reads."""
    # an input that is also the raw sheet gets its presence check in the
    # sheet's single pass below
    sheet_name = next((n for n, df in raw_inputs.items() if raw_sheet is not None and df is raw_sheet), None)
    others = {n: df for n, df in raw_inputs.items() if n != sheet_name}
    checks = [X.expect_present(others)] if others else []
    if raw_paths:
        checks.append(X.expect_files(spark, raw_paths))
    if tables:
        checks.append(X.expect_tables(spark, tables))
    wanted = {r["metric"]: (r["value"], r["tolerance"]) for r in expected_metrics.collect()} if expected_metrics is not None else {}

    def figures(name: str, measures: Mapping[str, Column]) -> list[X.Check]:
        found = [X.metric_within(f"metric:{m}", e, *wanted[m]) for m, e in measures.items() if m in wanted]
        return [X.rows_at_least(f"refined:{name}"), *found]

    of_sales = {"categorias": F.count(F.lit(1)), "receita_total": F.sum("total_receita"), "itens": F.sum("qtd_itens")}
    of_staff = {"funcionarios": F.count(F.lit(1)), "departamentos": F.countDistinct("departamento")}
    checks += [
        X.expect_all(sales, figures(SALES_CONTRACT.qualified_name, of_sales)),
        X.expect_all(employees, figures(EMPLOYEE_CONTRACT.qualified_name, of_staff)),
        X.expect_schema(sales, SALES_CONTRACT),
        X.expect_schema(employees, EMPLOYEE_CONTRACT),
        X.expect_unique(employees, "employee_id"),
        governance_checks(spark, employees, policy),
    ]
    if expected_metrics is not None:
        checks.append(X.unmeasured(expected_metrics, [*of_sales, *of_staff]))
    if raw_sheet is not None:
        # both sheet checks in one pass over the raw sheet
        sheet_checks = [
            X.Check(
                "raw:unparseable_numbers",
                reject_count(raw_sheet, NUMERIC_SHEET_COLUMNS),
                lambda n: F.when(n > 0, "WARN").otherwise("OK"),
                lambda n: F.concat(F.lit("rows="), n.cast("string")),
            )
        ]
        if "MonthlyIncome" in raw_sheet.columns:
            sheet_checks.insert(0, X.no_nulls("MonthlyIncome", "raw:unknown_income"))
        if sheet_name is not None:
            sheet_checks.insert(0, X.rows_at_least(f"input:{sheet_name}"))
        checks.append(X.expect_all(raw_sheet, sheet_checks))
    if mapping is not None:
        unmatched = B.unmatched_map_rows(sales, mapping)
        checks.append(
            X.expect_rows(unmatched, "map:unmatched_rows", 1).select(
                "check", F.when(F.col("status") == "OK", "WARN").otherwise("OK").alias("status"), "detail"
            )
        )
    if expected_grants is not None:
        checks.append(grant_checks(spark, policy, expected_grants))
    return X.union_checks(checks)
