"""Governed access: grants as a DataFrame, column-filtered reads, audits.

This narrows what a principal's *queries* can see and makes every grant
auditable; it is cooperative, not a security boundary (code holding the
session can still read files).  Real enforcement belongs to the catalog
and storage layer.

* A grant is one row (principal, database, table, permission, columns,
  location); ``columns`` NULL means the whole table.
* ``governed`` returns the table narrowed to the allowed columns, or
  raises ``AccessDenied`` for a denied column or a missing grant.
* ``as_principal`` gives a separate session holding only governed views;
  ``run_as`` runs queries in it that read nothing else, as their analysed plan shows.
* ``audit_grants`` compares actual with expected grants -> PASS / FAIL.
"""

from __future__ import annotations

import posixpath
import re
import enum
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit import lineage
from lakekit.contracts import ANALYTICS, EMPLOYEE_CONTRACT, HR, SALES, SALES_CONTRACT

GRANTS_SCHEMA = (
    "principal string, database string, table string, permission string, columns array<string>, location string"
)


class AccessDenied(PermissionError):
    def __init__(self, principal: str, table: str, columns: Sequence[str] = ()):
        self.principal, self.table, self.columns = principal, table, tuple(columns)
        what = f"columns {list(columns)} of " if columns else ""
        super().__init__(f"{principal} may not read {what}{table}")


class PolicyMode(enum.Enum):
    STRICT = "strict"  # column grants are enforced
    OPEN = "open"  # any table grant opens every column


@dataclass(frozen=True)
class Grant:
    principal: str
    permission: str
    database: str | None = None
    table: str | None = None
    columns: tuple[str, ...] | None = None
    location: str | None = None

    def row(self):
        return (
            self.principal,
            self.database,
            self.table,
            self.permission,
            list(self.columns) if self.columns is not None else None,
            self.location,
        )


# --- Fixed values: the reference's grants (producers own their domain,
# --- the analytics consumer reads sales whole and employees without the
# --- salary band; producers may run DDL for schema discovery).
def reference_grants(lake_root: str) -> list[Grant]:
    sales_loc = SALES.prefix(lake_root) + "/"
    hr_loc = HR.prefix(lake_root) + "/"
    allowed_hr = tuple(c for c in EMPLOYEE_CONTRACT.columns if c not in EMPLOYEE_CONTRACT.sensitive)
    return [
        Grant(SALES.producer, "ALL", database=SALES.database),
        Grant(SALES.producer, "DATA_LOCATION_ACCESS", location=sales_loc),
        Grant(HR.producer, "ALL", database=HR.database),
        Grant(HR.producer, "DATA_LOCATION_ACCESS", location=hr_loc),
        Grant(ANALYTICS, "SELECT", database=SALES.database, table=SALES_CONTRACT.table),
        Grant(ANALYTICS, "SELECT", database=HR.database, table=EMPLOYEE_CONTRACT.table, columns=allowed_hr),
        *[Grant(SALES.producer, p, database=SALES.database) for p in ("CREATE_TABLE", "ALTER", "DROP")],
        *[Grant(HR.producer, p, database=HR.database) for p in ("CREATE_TABLE", "ALTER", "DROP")],
    ]


def grants_frame(spark: SparkSession, grants: Iterable[Grant]) -> DataFrame:
    return spark.createDataFrame([g.row() for g in grants], GRANTS_SCHEMA)


class Policy:
    """Grants plus the enforcement mode; decisions are made at plan time."""

    def __init__(self, grants: Iterable[Grant], mode: PolicyMode = PolicyMode.STRICT):
        self.grants = list(grants)
        self.mode = mode

    # -- decisions ---------------------------------------------------------
    def _db_grants(self, principal: str, database: str) -> list[Grant]:
        return [g for g in self.grants if g.principal == principal and g.database == database and g.table is None]

    def allows(self, principal: str, permission: str, database: str) -> bool:
        return any(g.permission in (permission, "ALL") for g in self._db_grants(principal, database))

    def allowed_columns(self, principal: str, qualified: str, all_columns: Sequence[str]) -> list[str] | None:
        """Columns ``principal`` may SELECT from ``qualified`` (None: no grant)."""
        database, table = qualified.split(".", 1)
        if any(g.permission in ("SELECT", "ALL") for g in self._db_grants(principal, database)):
            return list(all_columns)
        table_grants = [
            g
            for g in self.grants
            if g.principal == principal and g.database == database and g.table == table and g.permission in ("SELECT", "ALL")
        ]
        if not table_grants:
            return None
        if self.mode is PolicyMode.OPEN or any(g.columns is None for g in table_grants):
            return list(all_columns)
        granted = {c for g in table_grants for c in g.columns}
        return [c for c in all_columns if c in granted]

    def may_write(self, principal: str, path: str) -> bool:
        return any(
            g.principal == principal
            and g.permission == "DATA_LOCATION_ACCESS"
            and g.location
            and _below(path, g.location)
            for g in self.grants
        )

    def ddl_guard(self, principal: str) -> Callable[[str, str], bool]:
        """``allowed(permission, database)`` for DDL such as ``apply_drift``."""
        return lambda permission, database: self.allows(principal, permission, database)

    def write_guard(self, principal: str) -> Callable[[str], None]:
        def guard(path: str) -> None:
            if not self.may_write(principal, path):
                raise AccessDenied(principal, path)

        return guard


def _normal(path: str) -> str:
    """The path without ``.``, ``..`` and repeated slashes, scheme and authority as they are."""
    scheme, sep, rest = path.rpartition("://") if "://" in path else ("", "", path)
    return scheme + sep + posixpath.normpath(rest)


def _below(path: str, location: str) -> bool:
    """Whether ``path`` is ``location`` or lies in it (whole path components)."""
    path, location = _normal(path), _normal(location)
    return path == location or path.startswith(location.rstrip("/") + "/")


def governed(
    table_df: DataFrame,
    policy: Policy,
    principal: str,
    qualified: str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The table as ``principal`` may see it (a narrowing ``select``).

    Asking for a denied column, or reading without any grant, raises
    ``AccessDenied``.  The projection prunes the Parquet ``ReadSchema``.
    """
    allowed = policy.allowed_columns(principal, qualified, table_df.columns)
    if allowed is None:
        raise AccessDenied(principal, qualified)
    if columns is not None:
        denied = [c for c in columns if c not in allowed]
        if denied:
            raise AccessDenied(principal, qualified, denied)
        return table_df.select(*columns)
    return table_df.select(*allowed)


def governed_table(spark: SparkSession, policy: Policy, principal: str, qualified: str, columns=None) -> DataFrame:
    return governed(spark.table(qualified), policy, principal, qualified, columns)


def denied_columns(grants: DataFrame, catalog_columns: DataFrame, principal: str) -> DataFrame:
    """(database, table, column) the principal cannot read.

    ``catalog_columns``: (database, table, column).  A table grant with NULL
    columns covers every column, a grant on the database every table.
    """
    g = grants.filter((F.col("principal") == principal) & F.col("permission").isin("SELECT", "ALL"))
    databases = g.filter(F.col("table").isNull()).select("database").distinct()
    catalog_columns = catalog_columns.join(databases, "database", "left_anti")
    g = g.filter(F.col("table").isNotNull())
    whole = g.filter(F.col("columns").isNull()).select("database", "table").distinct()
    cols = g.filter(F.col("columns").isNotNull()).select("database", "table", F.explode("columns").alias("column"))
    return catalog_columns.join(whole, ["database", "table"], "left_anti").join(
        cols, ["database", "table", "column"], "left_anti"
    )


def as_principal(
    spark: SparkSession,
    policy: Policy,
    principal: str,
    tables: Mapping[str, Callable[[SparkSession], DataFrame]],
) -> SparkSession:
    """New session whose temp views are the principal's governed tables.

    ``tables`` maps a qualified name to a function building that table in
    a given session; the view is named after the bare table name.  Temp
    views do not leak between sessions.
    """
    session = spark.newSession()
    session.lk_views = {}
    for qualified, build in tables.items():
        try:
            view = governed(build(session), policy, principal, qualified)
        except AccessDenied:
            continue
        name = qualified.split(".", 1)[1]
        view.createOrReplaceTempView(name)
        session.lk_views[name] = qualified
    return session


# Parts of a statement: comments and quoted text stay as they are, dotted names are looked at.
_SQL_PARTS = re.compile(r"""(--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|((?:`[^`]+`|\w+)(?:\s*\.\s*(?:`[^`]+`|\w+))+)|(;)""", re.S)


def _bare_names(sql: str, tables: Iterable[str]) -> str:
    """The statement with the database left out before known tables, which then mean the governed views.

    Only a convenience: what a name really stands for is decided on the analysed plan.
    """
    known = {q.lower() for q in tables}

    def place(match: re.Match) -> str:
        if match[1] or match[3]:
            return match[0]
        parts = [p.strip().strip("`") for p in re.split(r"\s*\.\s*(?=(?:[^`]*`[^`]*`)*[^`]*$)", match[2])]
        if parts[0].lower() == "spark_catalog" and len(parts) > 2:
            parts = parts[1:]
        return ".".join(f"`{p}`" for p in parts[1:]) if ".".join(parts[:2]).lower() in known else match[0]

    return _SQL_PARTS.sub(place, sql)


def split_statements(text: str) -> list[str]:
    """The statements of a SQL file, cut at semicolons outside comments and quoted text."""
    out, at = [], 0
    for match in _SQL_PARTS.finditer(text):
        if match[3]:
            out.append(text[at : match.start()])
            at = match.end()
    out.append(text[at:])
    bare = [(s, re.sub(r"--[^\n]*|/\*.*?\*/", "", s, flags=re.S).strip()) for s in out]
    return [s.strip() for s, rest in bare if rest]


def run_as(session: SparkSession, policy: Policy, principal: str, sql: str, tables: Mapping[str, Sequence[str]]) -> DataFrame:
    """Run one query in a principal session (see ``as_principal``).

    Tables may be named bare or with their database: both mean the governed
    view.  ``AccessDenied`` is raised, before anything runs, for a statement
    that is no query, for any relation but the governed views however it is
    named, for a table without a grant and for a column that is not granted
    (by the policy as it is now, also where the session is older).
    """
    views = {v.lower(): q for v, q in getattr(session, "lk_views", {q.split(".", 1)[1]: q for q in tables}).items()}
    sql = _bare_names(sql, {*tables, *views.values()})
    try:
        plan = lineage.parsed_query(session, sql)
        for parts in lineage.named_relations(plan):
            if len(parts) > 1:
                raise AccessDenied(principal, ".".join(parts))
        reads = lineage.query_reads(lineage.analysed_query(session, plan), views)
    except lineage.Refused as exc:
        raise AccessDenied(principal, str(exc)) from exc
    except AnalysisException as exc:
        denied = _denied_by(exc, policy, principal, tables)
        if denied is None:
            raise
        raise denied from exc
    if reads.others:
        raise AccessDenied(principal, reads.others[0])
    for qualified, columns in reads.columns.items():
        allowed = policy.allowed_columns(principal, qualified, tables.get(qualified, sorted(columns)))
        if allowed is None:
            raise AccessDenied(principal, qualified)
        hidden = sorted(columns - set(allowed))
        if hidden:
            raise AccessDenied(principal, qualified, hidden)
    return session.sql(sql)


def _denied_by(exc: AnalysisException, policy: Policy, principal: str, tables: Mapping[str, Sequence[str]]) -> AccessDenied | None:
    """The denial behind a name that analysis didn't find: a hidden column, or a table without a grant."""
    condition, told = exc.getCondition() or "", exc.getMessageParameters() or {}
    name = (told.get("objectName") or told.get("relationName") or told.get("fieldName") or "").replace("`", "").rsplit(".", 1)[-1].lower()
    for qualified, all_columns in tables.items():
        allowed = policy.allowed_columns(principal, qualified, all_columns)
        if condition.startswith("TABLE_OR_VIEW_NOT_FOUND") and allowed is None and name == qualified.split(".", 1)[1].lower():
            return AccessDenied(principal, qualified)
        hidden = [c for c in all_columns if c not in (allowed or []) and c.lower() == name]
        if condition.startswith("UNRESOLVED_COLUMN") and hidden:
            return AccessDenied(principal, qualified, hidden)
    return None


def audit_grants(actual: DataFrame, expected: DataFrame, sensitive: DataFrame) -> DataFrame:
    """Expected grants vs actual -> (principal, database, table, permission, status, detail).

    FAIL if the grant is missing or was not expected, if a column grant became
    a wildcard or other columns are granted, or if a sensitive column of that table is granted.  ``sensitive``:
    (database, table, column).
    """
    keys = ["principal", "database", "table", "permission"]
    a = actual.select(*[F.col(k).alias(f"a_{k}") for k in keys], F.col("columns").alias("actual_columns"), F.lit(True).alias("_present"))
    e = expected.select(*keys, F.col("columns").alias("expected_columns"), F.lit(True).alias("_expected"))
    leaked = (
        actual.select(*keys, F.explode("columns").alias("column"))
        .join(sensitive, ["database", "table", "column"], "inner")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set("column")).alias("leaked"))
        .select(*[F.col(k).alias(f"l_{k}") for k in keys], "leaked")
    )
    # database / table are NULL for location grants: match them null-safely
    on_a = [e[k].eqNullSafe(a[f"a_{k}"]) for k in keys]
    j = e.join(a, on_a, "full_outer")
    j = j.select(*[F.when(F.col("_expected"), F.col(k)).otherwise(F.col(f"a_{k}")).alias(k) for k in keys], "expected_columns", "actual_columns", "_present", "_expected")
    others = F.size(F.array_except("actual_columns", "expected_columns")) > 0
    j = j.join(leaked, [j[k].eqNullSafe(leaked[f"l_{k}"]) for k in keys], "left")
    status = (
        F.when(F.col("_present").isNull(), "FAIL")
        .when(F.col("expected_columns").isNotNull() & F.col("actual_columns").isNull(), "FAIL")
        .when(F.col("_expected").isNull() | others, "FAIL")
        .when(F.col("leaked").isNotNull(), "FAIL")
        .otherwise("PASS")
    )
    detail = (
        F.when(F.col("_present").isNull(), F.lit("grant missing"))
        .when(F.col("expected_columns").isNotNull() & F.col("actual_columns").isNull(), F.lit("column wildcard"))
        .when(F.col("_expected").isNull(), F.lit("grant not expected"))
        .when(F.col("leaked").isNotNull(), F.concat(F.lit("sensitive: "), F.array_join("leaked", ",")))
        .when(others, F.lit("columns not expected"))
        .otherwise(F.lit("ok"))
    )
    return j.select(*keys, status.alias("status"), detail.alias("detail"))
