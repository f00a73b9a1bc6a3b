"""Readers for the two zones and the catalog.

Raw deliveries are headered CSV read entirely as text (no inference: the
schema comes from the header at plan time and the refined job decides the
types).  Refined tables are Parquet read under their declared contract, so
column pruning and filter pushdown reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakekit.contracts import Contract


def all_text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_raw_csv(
    spark: SparkSession,
    path: str,
    quoted: bool = True,
    columns: Sequence[str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Headered CSV, every column a string.

    ``quoted=True``: quote and escape are both ``"`` (a doubled quote inside
    a quoted field is one quote).  ``quoted=False``: Spark's defaults
    (escape ``\\``), where doubled quotes are kept as written.  Empty
    fields, quoted or not, become NULL.  ``columns`` fixes an all-string
    schema instead of taking it from the header.  ``multiline`` allows line
    breaks inside quoted fields; such files cannot be split, so each file is
    read by one task (keep deliveries to many moderate files).
    """
    reader = spark.read.option("header", True)
    if quoted:
        reader = reader.option("quote", '"').option("escape", '"')
    if columns is not None:
        reader = reader.schema(all_text_schema(columns))
    if multiline:
        reader = reader.option("multiLine", True)
    return reader.csv(path)


def read_refined(spark: SparkSession, contract: Contract, path: str) -> DataFrame:
    """Parquet at ``path`` read under the contract's declared schema.

    ``path`` is a version's folder, or a table location: then the current
    version is read, never several together.
    """
    from lakekit.sinks import current_version

    return spark.read.schema(contract.schema).parquet(current_version(spark, path) or path)


def read_current(spark: SparkSession, contract: Contract, location: str) -> DataFrame:
    """The current published version under a table location, without a catalog.

    The version's name is looked up once, when the plan is built; only its
    files are listed and read.  A location without a published version is an error.
    """
    from lakekit.sinks import current_version

    path = current_version(spark, location)
    if path is None:
        raise FileNotFoundError(f"no published version under {location}")
    return spark.read.schema(contract.schema).parquet(path)


def catalog_scan(spark: SparkSession, qualified_name: str) -> DataFrame:
    return spark.table(qualified_name)
