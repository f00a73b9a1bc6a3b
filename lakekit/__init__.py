"""lakekit: contract-checked domain lake operators on Spark DataFrames.

The most used entry points are re-exported here; every module can also be
imported on its own (``lakekit.plans.jobs``, ``lakekit.policy``, ...).
"""

__version__ = "0.1.0"

from lakekit.contracts import EMPLOYEE_CONTRACT, SALES_CONTRACT, Contract, Domain, conform, zone_path
from lakekit.plans.business import (
    business_map,
    cross_domain,
    executive_kpis,
    headcount,
    low_satisfaction,
    sales_totals,
    satisfaction_by,
    top_categories,
    top_share,
    turnover_by,
)
from lakekit.plans.jobs import conform_employees, parse_rejects, sales_by_category
from lakekit.plans.lake import RawDeliveries, refresh_lake
from lakekit.policy import AccessDenied, Policy, as_principal, governed
from lakekit.session import get_session, scale_conf
from lakekit.sinks import read_results, retain, save_result, write_refined
from lakekit.sources.files import read_current, read_raw_csv, read_refined
from lakekit.validate import validate_lake

__all__ = [
    "EMPLOYEE_CONTRACT",
    "SALES_CONTRACT",
    "AccessDenied",
    "Contract",
    "Domain",
    "Policy",
    "RawDeliveries",
    "as_principal",
    "business_map",
    "conform",
    "conform_employees",
    "cross_domain",
    "executive_kpis",
    "get_session",
    "governed",
    "headcount",
    "low_satisfaction",
    "parse_rejects",
    "read_current",
    "read_raw_csv",
    "read_refined",
    "read_results",
    "refresh_lake",
    "retain",
    "sales_by_category",
    "sales_totals",
    "satisfaction_by",
    "save_result",
    "scale_conf",
    "top_categories",
    "top_share",
    "turnover_by",
    "validate_lake",
    "write_refined",
    "zone_path",
]
