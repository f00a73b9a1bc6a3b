"""Full refresh of the lake: both domains refined, published and checked.

Each domain's producer writes only under its own prefix (write guard from
the grants); tables are published as fresh versions and the catalog is
pointed at them; finally the whole lake is validated.  Every step is a
Spark job; nothing passes through the driver but paths and check rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakekit import catalog as C
from lakekit import policy as G
from lakekit import sinks as K
from lakekit.contracts import EMPLOYEE_CONTRACT, SALES_CONTRACT, Contract
from lakekit.plans.jobs import conform_employees, sales_by_category
from lakekit.sources.files import read_raw_csv
from lakekit.validate import validate_lake


@dataclass(frozen=True)
class RawDeliveries:
    items: str
    products: str
    employees: str


@dataclass
class RefreshResult:
    sales_path: str
    employees_path: str
    checks: DataFrame


def _publish(spark: SparkSession, df: DataFrame, contract: Contract, lake_root: str, policy: G.Policy) -> str:
    C.register_domain(spark, contract.domain, lake_root)
    guard = policy.write_guard(contract.domain.producer)
    path = K.write_refined(df, contract, contract.location(lake_root), guard=guard)
    if not spark.catalog.tableExists(contract.qualified_name):
        C.register_table(spark, contract, path)
    return path


def refresh_lake(
    spark: SparkSession,
    lake_root: str,
    raw: RawDeliveries,
    policy: G.Policy | None = None,
    load_date=None,
    mapping=None,
) -> RefreshResult:
    """Refine both domains from their raw deliveries and validate the lake."""
    policy = policy or G.Policy(G.reference_grants(lake_root))
    items, products = read_raw_csv(spark, raw.items), read_raw_csv(spark, raw.products)
    sheet = read_raw_csv(spark, raw.employees, quoted=False)
    sales_path = _publish(spark, sales_by_category(items, products), SALES_CONTRACT, lake_root, policy)
    emp_path = _publish(spark, conform_employees(sheet, load_date_value=load_date), EMPLOYEE_CONTRACT, lake_root, policy)
    checks = validate_lake(
        spark,
        {"items": items, "products": products, "employees": sheet},
        spark.table(SALES_CONTRACT.qualified_name),
        spark.table(EMPLOYEE_CONTRACT.qualified_name),
        policy,
        expected_grants=G.reference_grants(lake_root),
        raw_sheet=sheet,
        mapping=mapping,
        raw_paths={"items": raw.items, "products": raw.products, "employees": raw.employees},
        tables=[SALES_CONTRACT.qualified_name, EMPLOYEE_CONTRACT.qualified_name],
    )
    return RefreshResult(sales_path, emp_path, checks)
