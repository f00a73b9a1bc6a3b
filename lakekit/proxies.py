"""Raw deliveries derived from the driver's TPC-H-like tables.

The lake's two domains (sales items + products, an HR sheet) are not in
the test data, so both are derived from it with Spark: order items from
``lineitem``, products from ``part``, the employee sheet from
``customer x nation``.  All derivations are narrow projections plus one
join to the 25-row ``nation`` table, so they scale with the inputs.
"""

from __future__ import annotations

import functools
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.operators.joins import join_dim
from lakekit.plans.business import business_map
from lakekit.plans.jobs import conform_employees, sales_by_category

# Load date used wherever results must be reproducible.
FIXED_LOAD_DATE = "2024-01-01"

# Proxy business map for the test data: segment (department) -> brand
# (category).  LOGISTICS has no employees (left-join NULLs) and
# NoSuchBrand has no sales (dropped by the inner join).
PROXY_BUSINESS_MAP = (
    ("AUTOMOBILE", "Brand#1"),
    ("AUTOMOBILE", "Brand#2"),
    ("AUTOMOBILE", "Brand#3"),
    ("BUILDING", "Brand#4"),
    ("BUILDING", "Brand#5"),
    ("HOUSEHOLD", "Brand#6"),
    ("LOGISTICS", "Brand#7"),
    ("HOUSEHOLD", "NoSuchBrand"),
)

# The brand that becomes the NULL category, and the sizes whose parts are
# left out of the product list (their items become orphans).
NULL_BRAND = "Brand#13"
# Product that receives a third of all items, and department that holds a
# third of all employees, in the skew scenarios.
HOT_PRODUCT = 1
HOT_DEPARTMENT = "AUTOMOBILE"
MIN_LISTED_SIZE = 3


# Lazy plans (never data) built once per session: listing files, reading a
# footer for the schema and analysing ~100 expressions is driver work that
# does not need repeating for every query over the same inputs.
_PLANS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _per_session(build):
    @functools.wraps(build)
    def cached(spark: SparkSession, sf_dir: str, *args):
        plans = _PLANS.setdefault(spark, {})
        key = (build.__name__, sf_dir.rstrip("/"), args)
        if key not in plans:
            plans[key] = build(spark, sf_dir, *args)
        return plans[key]

    return cached


def forget(spark: SparkSession) -> None:
    """Drop the session's kept plans."""
    _PLANS.pop(spark, None)


@_per_session
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_per_session
def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_extendedprice").alias("price"),
    )


@_per_session
def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.filter(F.col("p_size") >= MIN_LISTED_SIZE).select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_brand") == NULL_BRAND, F.lit(None).cast("string"))
        .otherwise(F.col("p_brand"))
        .alias("product_category_name"),
    )


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return join_dim(customer, nation, customer.c_nationkey == nation.n_nationkey, "inner")


def _income_text() -> F.Column:
    return F.when(F.col("c_custkey") % 50 == 0, F.lit(None).cast("string")).otherwise(
        F.floor(F.col("c_acctbal") * 1.5).cast("string")
    )


@_per_session
def employee_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full HR sheet: every column as text, plus one ignored extra column."""
    k = F.col("c_custkey")
    return _people(spark, sf_dir).select(
        k.cast("string").alias("EmployeeNumber"),
        F.col("c_mktsegment").alias("Department"),
        F.col("n_name").alias("JobRole"),
        (18 + k % 43).cast("string").alias("Age"),
        F.when(k % 2 == 0, "Female").otherwise("Male").alias("Gender"),
        (k % 30).cast("string").alias("YearsAtCompany"),
        (1 + k % (2 + F.col("c_nationkey") % 3)).cast("string").alias("JobSatisfaction"),
        F.when(F.col("c_acctbal") < 0, "Yes").otherwise("No").alias("Attrition"),
        _income_text().alias("MonthlyIncome"),
        (1 + F.col("c_nationkey") % 4).cast("string").alias("EnvironmentSatisfaction"),
    )


@_per_session
def dirty_employee_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full sheet where every 7th employee's Age is typed as words ('41 anos')."""
    sheet = employee_sheet(spark, sf_dir)
    dirty = F.col("EmployeeNumber").cast("bigint") % 7 == 0
    return sheet.withColumn("Age", F.when(dirty, F.concat(F.col("Age"), F.lit(" anos"))).otherwise(F.col("Age")))


@_per_session
def reduced_employee_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet without EmployeeNumber, JobRole, Age, Gender and Attrition."""
    k = F.col("c_custkey")
    return _people(spark, sf_dir).select(
        F.col("c_mktsegment").alias("Department"),
        F.col("n_name").alias("EducationField"),
        (k % 30).cast("string").alias("YearsAtCompany"),
        (1 + k % (2 + F.col("c_nationkey") % 3)).cast("string").alias("JobSatisfaction"),
        _income_text().alias("MonthlyIncome"),
        (1 + k % 4).cast("string").alias("WorkLifeBalance"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by_category(order_items(spark, sf_dir), products(spark, sf_dir))


@_per_session
def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_employees(employee_sheet(spark, sf_dir), load_date_value=FIXED_LOAD_DATE)


def proxy_map(spark: SparkSession) -> DataFrame:
    return business_map(spark, PROXY_BUSINESS_MAP)
