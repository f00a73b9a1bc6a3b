"""The two refinement jobs: raw deliveries -> contract-shaped DataFrames.

Both return lazy DataFrames; writing them is a sink's job
(``lakekit.sinks.write_refined``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.contracts import EMPLOYEE_CONTRACT, Contract
from lakekit.functions.columns import (
    amount_parts,
    as_double,
    band,
    exact_sql,
    flag,
    legacy_int,
    load_date,
    pick,
    surrogate_id,
)
from lakekit.operators.joins import join_dim

# --- Fixed values (must equal the reference's employee mapping) ---
# Raw sheet column names and their defaults when the column is absent.
EMPLOYEE_NUMBER = "EmployeeNumber"
HASH_PARTS = ("Age", "Department", "MonthlyIncome", "YearsAtCompany", "Attrition")
UNKNOWN = "N/D"
NO_EXIT = "No"
EXIT_VALUE = "Yes"
# Salary bands on MonthlyIncome: < 5000 baixa, < 10000 media, otherwise alta.
SALARY_BANDS = ((5000, "baixa"), (10000, "media"))
TOP_BAND = "alta"


def sales_by_category(
    items: DataFrame,
    products: DataFrame,
    *,
    key: str = "product_id",
    category: str = "product_category_name",
    price: str = "price",
    item: str = "order_item_id",
    revenue_name: str = "total_receita",
    count_name: str = "qtd_itens",
    merge: bool = False,
) -> DataFrame:
    """Revenue and item count per product category.

    Items join products on ``key`` (inner: orphan items are dropped, a
    NULL category is one group).  ``price`` text is parsed leniently and
    summed exactly up to six places (see ``money_sum``), returned as double.

    Items are first aggregated per product (map-side combine collapses a hot
    product inside each task), the partial sums then join products and are
    aggregated by category.  Catalyst and adaptive execution pick the join;
    ``merge`` asks for a sort-merge join.
    """
    prices = items.select(key, item, as_double(items, price).alias("_price"))
    dims = products.select(key, category)
    parts = amount_parts("_price")
    per_product = prices.groupBy(key).agg(*[c.alias(f"_{n}") for n, c in parts.items()], F.count(item).alias("_items"))
    exact = F.expr(exact_sql({n: f"_{n}" for n in parts}))
    per_product = per_product.select(key, exact.alias("_exact"), "_rough", "_items")
    joined = join_dim(per_product, dims, key, merge=merge)
    # a product whose sum is not exact makes its category's the double sum
    odd = F.count_if(F.col("_exact").isNull() & F.col("_rough").isNotNull())
    return joined.groupBy(category).agg(
        F.coalesce(F.when(odd == 0, F.try_sum("_exact").cast("double")), F.sum("_rough")).alias(revenue_name),
        F.sum("_items").cast("bigint").alias(count_name),
    )


def conform_employees(
    raw: DataFrame,
    *,
    load_date_value=None,
    null_band: str | None = None,
    strict_id: bool = False,
    contract: Contract = EMPLOYEE_CONTRACT,
) -> DataFrame:
    """Adaptive raw HR sheet -> the 14-column employee contract.

    Column choices depend on which raw columns exist (decided at plan
    time); values are never used for fallback.  One narrow stage, no
    shuffle.  Undeclared raw columns are dropped.
    """
    cols = set(raw.columns)
    satisfaction = legacy_int(pick(cols, "JobSatisfaction"))
    tenure = legacy_int(pick(cols, "YearsAtCompany"))
    attrition = pick(cols, "Attrition", default=NO_EXIT)
    exprs = {
        "employee_id": surrogate_id(cols, EMPLOYEE_NUMBER, HASH_PARTS, strict=strict_id),
        "departamento": pick(cols, "Department", default=UNKNOWN),
        "cargo": pick(cols, "JobRole", "EducationField", default=UNKNOWN),
        "idade": legacy_int(pick(cols, "Age")),
        "genero": pick(cols, "Gender", default=UNKNOWN),
        "anos_empresa": tenure,
        "satisfacao": satisfaction,
        "rotatividade": attrition,
        "faixa_salarial": band(legacy_int(pick(cols, "MonthlyIncome")), SALARY_BANDS, TOP_BAND, null_band),
        "total_funcionarios": F.lit(1),
        "total_saidas": flag(attrition == EXIT_VALUE),
        "media_satisfacao": satisfaction.cast("double"),
        "media_anos_empresa": tenure.cast("double"),
        "data_carga": load_date(load_date_value),
    }
    return raw.select(*[exprs[f.name].cast(f.dataType).alias(f.name) for f in contract.schema.fields])


# How each contract column is fed: (contract column, raw candidates in
# order, default when none is present).
_SHEET_SOURCES = (
    ("employee_id", (EMPLOYEE_NUMBER,), "sha256(" + "|".join(HASH_PARTS) + ")"),
    ("departamento", ("Department",), UNKNOWN),
    ("cargo", ("JobRole", "EducationField"), UNKNOWN),
    ("idade", ("Age",), None),
    ("genero", ("Gender",), UNKNOWN),
    ("anos_empresa", ("YearsAtCompany",), None),
    ("satisfacao", ("JobSatisfaction",), None),
    ("rotatividade", ("Attrition",), NO_EXIT),
    ("faixa_salarial", ("MonthlyIncome",), TOP_BAND),
)


def conformance_report(raw: DataFrame) -> DataFrame:
    """Which raw column (or default) feeds each contract column, and which
    raw columns are ignored: (column, source, status).

    status: USED (a raw column), DEFAULT (absent: literal or NULL),
    IGNORED (raw column not in the mapping).  Plan-time metadata only.
    """
    present = list(raw.columns)
    rows = []
    used = set()
    for target, candidates, default in _SHEET_SOURCES:
        hit = next((c for c in candidates if c in present), None)
        if hit is not None:
            used.add(hit)
            rows.append((target, hit, "USED"))
        else:
            rows.append((target, "NULL" if default is None else str(default), "DEFAULT"))
    if EMPLOYEE_NUMBER not in present:
        used.update(p for p in HASH_PARTS if p in present)
    rows += [(c, c, "IGNORED") for c in present if c not in used]
    return raw.sparkSession.createDataFrame(rows, "column string, source string, status string")


def parse_rejects(raw: DataFrame, columns, keep=(), parser=legacy_int) -> DataFrame:
    """Raw values that are present but do not parse: (``keep``..., column, value).

    One pass over the sheet: each row is unpivoted into (column, text,
    parsed) triples and only present-but-NULL-after-parsing ones are kept.
    Absent columns are skipped.  This is the reject companion of the
    lenient casts, which turn such values into NULL.
    """
    present = [c for c in columns if c in raw.columns]
    if not present:
        return raw.sparkSession.createDataFrame([], ", ".join([f"{k} string" for k in keep] + ["column string", "value string"]))
    triples = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), parser(F.col(c)).alias("parsed")) for c in present]
    )
    exploded = raw.select(*keep, F.inline(triples))
    return exploded.filter(F.col("value").isNotNull() & F.col("parsed").isNull()).select(*keep, "column", "value")


NUMERIC_SHEET_COLUMNS = ("Age", "YearsAtCompany", "JobSatisfaction", "MonthlyIncome")


def reject_count(raw: DataFrame, columns, parser=legacy_int):
    """Aggregate: number of present-but-unparseable values (as ``parse_rejects``
    would list them), for use inside a one-pass check."""
    present = [c for c in columns if c in raw.columns]
    per_row = sum(
        (F.when(F.col(c).isNotNull() & parser(F.col(c)).isNull(), F.lit(1)).otherwise(F.lit(0)) for c in present),
        F.lit(0),
    )
    return F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint")
