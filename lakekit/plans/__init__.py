from lakekit.plans.business import (
    REFERENCE_BUSINESS_MAP,
    business_map,
    cross_domain,
    executive_kpis,
    headcount,
    low_satisfaction,
    sales_totals,
    satisfaction_by,
    top_categories,
    top_categories_raw,
    top_share,
    turnover_by,
)
from lakekit.plans.jobs import conform_employees, sales_by_category

__all__ = [
    "REFERENCE_BUSINESS_MAP",
    "business_map",
    "conform_employees",
    "cross_domain",
    "executive_kpis",
    "headcount",
    "low_satisfaction",
    "sales_by_category",
    "sales_totals",
    "satisfaction_by",
    "top_categories",
    "top_categories_raw",
    "top_share",
    "turnover_by",
]
