"""Inline literal relations (``VALUES``).

Planned as a ``LocalTableScan`` whose size statistics are exact, so the
optimizer knows it is small; joins against it broadcast it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_relation(spark: SparkSession, rows: Sequence[Sequence], columns: Sequence[str]) -> DataFrame:
    if not rows:
        raise ValueError("a literal relation needs at least one row")
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    names = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
