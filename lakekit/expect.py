"""Data expectations that come back as ordinary DataFrames.

Every check is a DataFrame of ``(check, status, detail)`` rows with status
in OK / FAIL / WARN / SKIP.  Checks over data are aggregates (partial +
final, never a collect); ``expect_all`` evaluates any number of checks on
one DataFrame in a single aggregation pass, so validating a large table
scans it once, not once per check.  ``summarise`` and ``verdict`` roll
the results up.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.catalog import schema_drift, schema_frame
from lakekit.contracts import Contract

CHECKS_SCHEMA = "check string, status string, detail string"
STATUSES = ("OK", "FAIL", "WARN", "SKIP")


def _row(check: str, status: Column, detail: Column) -> list[Column]:
    return [F.lit(check).alias("check"), status.alias("status"), detail.cast("string").alias("detail")]


@dataclass(frozen=True)
class Check:
    """One check: an aggregate ``measure`` and how it maps to status/detail."""

    name: str
    measure: Column
    status: Callable[[Column], Column]
    detail: Callable[[Column], Column]


def rows_at_least(check: str, min_rows: int = 1, severity: str = "FAIL") -> Check:
    return Check(
        check,
        F.count(F.lit(1)),
        lambda n: F.when(n >= min_rows, "OK").otherwise(severity),
        lambda n: F.concat(F.lit("rows="), n.cast("string")),
    )


def no_nulls(col: str, check: str | None = None, severity: str = "WARN") -> Check:
    return Check(
        check or f"nulls:{col}",
        F.count_if(F.col(col).isNull()),
        lambda n: F.when(n == 0, "OK").otherwise(severity),
        lambda n: F.concat(F.lit("nulls="), n.cast("string")),
    )


def metric_within(check: str, expr: Column, expected: float, tolerance: float = 0.0) -> Check:
    def status(o: Column) -> Column:
        return F.when(F.abs(o.cast("double") - F.lit(float(expected))) <= F.lit(float(tolerance)), "OK").otherwise("FAIL")

    return Check(
        check,
        expr,
        status,
        lambda o: F.concat(F.lit("observed="), o.cast("string"), F.lit(f" expected={expected} tol={tolerance}")),
    )


def expect_all(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate all ``checks`` on ``df`` in one aggregation pass."""
    measured = df.agg(*[c.measure.alias(f"_m{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check"),
                c.status(F.col(f"_m{i}")).alias("status"),
                c.detail(F.col(f"_m{i}")).cast("string").alias("detail"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return measured.select(F.inline(rows))


def expect_rows(df: DataFrame, check: str, min_rows: int = 1, severity: str = "FAIL") -> DataFrame:
    """At least ``min_rows`` rows."""
    return expect_all(df, [rows_at_least(check, min_rows, severity)])


def expect_present(inputs: Mapping[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """Each named input exists and is non-empty (one row per input)."""
    return union_checks([expect_rows(df, f"input:{name}", min_rows) for name, df in inputs.items()])


def expect_files(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Each named raw location holds at least one non-empty file.

    Lists file metadata only (content is never read); a missing location is
    a FAIL row, not an error.
    """
    from pyspark.errors import AnalysisException

    from lakekit.sources.manifest import raw_file_manifest

    checks = []
    for name, path in paths.items():
        try:
            files = raw_file_manifest(spark, path, with_md5=False)
        except AnalysisException:
            checks.append(spark.createDataFrame([(f"files:{name}", "FAIL", "missing")], CHECKS_SCHEMA))
            continue
        agg = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        checks.append(
            agg.select(
                *_row(
                    f"files:{name}",
                    F.when((F.col("n") > 0) & (F.col("bytes") > 0), "OK").otherwise("FAIL"),
                    F.concat(F.lit("files="), F.col("n"), F.lit(" bytes="), F.col("bytes")),
                )
            )
        )
    return union_checks(checks)


def expect_tables(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    rows = [(f"table:{n}", "OK" if spark.catalog.tableExists(n) else "FAIL", "registered") for n in names]
    return spark.createDataFrame(rows, CHECKS_SCHEMA)


def expect_metric(df: DataFrame, check: str, expr: Column, expected: float, tolerance: float = 0.0) -> DataFrame:
    """Aggregate ``expr`` equals ``expected`` within ``tolerance``."""
    return expect_all(df, [metric_within(check, expr, expected, tolerance)])


def expect_metrics(df: DataFrame, expected: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """Many metrics in one aggregate pass over ``df``.

    ``expected``: (metric, value, tolerance).  Returns (check, status,
    observed, expected, tolerance).  Metrics without a measure are SKIP; a
    measure that comes out NULL fails.
    """
    observed = df.agg(*[e.cast("double").alias(name) for name, e in measures.items()])
    stacked = observed.select(
        F.explode(
            F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).alias("observed"), F.lit(True).alias("measured")) for name in measures])
        ).alias("m")
    ).select("m.*")
    j = expected.join(stacked, "metric", "left")
    ok = F.abs(F.col("observed") - F.col("value")) <= F.col("tolerance")
    status = F.when(F.col("measured").isNull(), "SKIP").when(ok, "OK").otherwise("FAIL")
    return j.select(
        F.concat(F.lit("metric:"), F.col("metric")).alias("check"),
        status.alias("status"),
        F.col("observed"),
        F.col("value").cast("double").alias("expected"),
        F.col("tolerance").cast("double").alias("tolerance"),
    )


def unmeasured(expected: DataFrame, measured: Sequence[str]) -> DataFrame:
    """A SKIP row for each expected metric (metric, value, tolerance) that nothing measures."""
    rest = expected.filter(~F.col("metric").isin(*measured)) if measured else expected
    return rest.select(*_row(F.concat(F.lit("metric:"), F.col("metric")), F.lit("SKIP"), F.lit("no such measure")))


def expect_unique(df: DataFrame, key: str, check: str | None = None, severity: str = "WARN") -> DataFrame:
    """No duplicated ``key`` values (e.g. colliding surrogate ids)."""
    dups = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return dups.agg(F.count(F.lit(1)).alias("d")).select(
        *_row(check or f"unique:{key}", F.when(F.col("d") == 0, "OK").otherwise(severity), F.concat(F.lit("duplicated="), F.col("d")))
    )


def expect_no_nulls(df: DataFrame, col: str, check: str | None = None, severity: str = "WARN") -> DataFrame:
    return expect_all(df, [no_nulls(col, check, severity)])


def expect_schema(df: DataFrame, contract: Contract) -> DataFrame:
    """Produced schema equals the contract (drift is all SAME)."""
    spark = df.sparkSession
    drift = schema_drift(schema_frame(spark, contract.schema), schema_frame(spark, df.schema))
    bad = drift.filter(F.col("action") != "SAME")
    return bad.agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("column")), ",").alias("cols")).select(
        *_row(
            f"contract:{contract.qualified_name}",
            F.when(F.col("n") == 0, "OK").otherwise("FAIL"),
            F.when(F.col("n") == 0, F.lit("matches")).otherwise(F.concat(F.lit("drift: "), F.col("cols"))),
        )
    )


def union_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def summarise(checks: DataFrame) -> DataFrame:
    """(status, checks) counts."""
    return checks.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def verdict(checks: DataFrame) -> DataFrame:
    """One row: overall FAIL if any FAIL, else WARN if any WARN, else OK."""
    return checks.agg(
        F.count_if(F.col("status") == "OK").alias("ok"),
        F.count_if(F.col("status") == "FAIL").alias("fail"),
        F.count_if(F.col("status") == "WARN").alias("warn"),
        F.count_if(F.col("status") == "SKIP").alias("skip"),
    ).withColumn(
        "verdict",
        F.when(F.col("fail") > 0, "FAIL").when(F.col("warn") > 0, "WARN").otherwise("OK"),
    )
