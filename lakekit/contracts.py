"""Domains, zones and table contracts of the lake.

A *domain* owns a path prefix ``dominio=<name>/`` and one catalog
database; each domain has a ``raw`` zone (CSV as delivered) and a
``refined`` zone (Parquet under a fixed contract).  A *contract* is the
declared schema of a refined table plus its sensitive columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ZONES = ("raw", "refined")


@dataclass(frozen=True)
class Domain:
    name: str
    database: str
    producer: str

    def prefix(self, lake_root: str) -> str:
        return f"{lake_root.rstrip('/')}/dominio={self.name}"


@dataclass(frozen=True)
class Contract:
    """Declared columns of a refined table (no partition keys by default)."""

    domain: Domain
    table: str
    schema: T.StructType
    sensitive: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def qualified_name(self) -> str:
        return f"{self.domain.database}.{self.table}"

    def location(self, lake_root: str) -> str:
        return zone_path(lake_root, self.domain, "refined", self.table)

    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)


def conform(df, contract: "Contract", fill_missing: bool = False):
    """Select the contract's columns, in order and cast to the declared types.

    Undeclared columns are dropped.  A declared column that is absent raises,
    unless ``fill_missing`` fills it with a typed NULL.
    """
    from pyspark.sql import functions as F

    present = set(df.columns)
    missing = [f.name for f in contract.schema.fields if f.name not in present]
    if missing and not fill_missing:
        raise ValueError(f"{contract.qualified_name}: missing columns {missing}")
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract.schema.fields
        ]
    )


def zone_path(lake_root: str, domain: Domain, zone: str, table: str, file: str | None = None) -> str:
    """``<root>/dominio=<d>/<zone>/<table>/[file]``.

    Readers must be given this leaf path (or ``basePath``): reading the lake
    root would make Spark discover ``dominio`` as a partition column.
    """
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}; expected one of {ZONES}")
    path = f"{domain.prefix(lake_root)}/{zone}/{table}"
    return f"{path}/{file}" if file else path


# --- Fixed values: names and declared schemas that must equal the
# --- reference's contracts (two domains, two refined tables).
SALES = Domain(name="vendas", database="vendas_db", producer="producer-vendas")
HR = Domain(name="rh", database="rh_db", producer="producer-rh")
ANALYTICS = "role-analytics"

SALES_CONTRACT = Contract(
    domain=SALES,
    table="vendas_por_categoria",
    schema=T.StructType(
        [
            T.StructField("product_category_name", T.StringType()),
            T.StructField("total_receita", T.DoubleType()),
            T.StructField("qtd_itens", T.LongType()),
        ]
    ),
)

EMPLOYEE_CONTRACT = Contract(
    domain=HR,
    table="funcionarios",
    schema=T.StructType(
        [
            T.StructField("employee_id", T.StringType()),
            T.StructField("departamento", T.StringType()),
            T.StructField("cargo", T.StringType()),
            T.StructField("idade", T.IntegerType()),
            T.StructField("genero", T.StringType()),
            T.StructField("anos_empresa", T.IntegerType()),
            T.StructField("satisfacao", T.IntegerType()),
            T.StructField("rotatividade", T.StringType()),
            T.StructField("faixa_salarial", T.StringType()),
            T.StructField("total_funcionarios", T.IntegerType()),
            T.StructField("total_saidas", T.IntegerType()),
            T.StructField("media_satisfacao", T.DoubleType()),
            T.StructField("media_anos_empresa", T.DoubleType()),
            T.StructField("data_carga", T.DateType()),
        ]
    ),
    sensitive=("faixa_salarial",),
)

CONTRACTS = {c.qualified_name: c for c in (SALES_CONTRACT, EMPLOYEE_CONTRACT)}
